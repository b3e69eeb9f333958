"""Words that channel names are read with. Everything here is data: another vocabulary can be passed wherever one is taken."""

from __future__ import annotations

from dataclasses import dataclass, field


# ---------------------------------------------------------------- fixed values
#: How, not what, is shown.
TECHNICAL = "hd fhd uhd sd 4k 8k hevc h265 h264 1080p 1080i 720p 2160p 50fps 60fps vip backup raw test multi low hq lq source digital mono stereo".split()
#: Words that a name may have or lack.
OPTIONAL = "tv television channel network the".split()
#: Words that tell editions of a brand apart.
MEANINGFUL = "gold news music movie movies cinema plus extra xtra alternate alt east west pacific local kids junior sports sport cricket religious classic action comedy family mystery science history".split()
#: Words and codes that name a language.
LANGUAGES = {
    "pb": "punjabi", "pun": "punjabi", "punj": "punjabi", "punjab": "punjabi", "punjabi": "punjabi", "panjabi": "punjabi", "my": "malayalam", "mal": "malayalam", "ml": "malayalam", "malayalam": "malayalam",
    "tm": "tamil", "tam": "tamil", "tamil": "tamil", "tg": "telugu", "tel": "telugu", "telugu": "telugu", "guj": "gujarati", "gujrati": "gujarati", "gujarati": "gujarati", "kan": "kannada", "kn": "kannada",
    "kand": "kannada", "kannada": "kannada", "ori": "odia", "od": "odia", "odia": "odia", "odiya": "odia", "oriya": "odia", "mar": "marathi", "marathi": "marathi", "bn": "bengali", "bangla": "bengali",
    "bengali": "bengali", "hindi": "hindi", "hin": "hindi", "urdu": "urdu", "assam": "assamese", "assamese": "assamese", "english": "english", "eng": "english", "en": "english", "spanish": "spanish",
    "espanol": "spanish", "french": "french", "fr": "french", "arabic": "arabic", "ar": "arabic", "pjb": "punjabi", "mly": "malayalam", "gjr": "gujarati", "mrt": "marathi", "tlg": "telugu", "bgl": "bengali",
    "bho": "bhojpuri", "bhoj": "bhojpuri", "tl": "telugu",
}
SOUTH_ASIAN = "punjabi malayalam tamil telugu gujarati kannada odia marathi bengali hindi urdu assamese".split()
#: Words that a language is written with inside names.
LANGUAGE_WORDS = {
    "punjabi": ["punjab", "punjabi", "panjabi"], "malayalam": ["malayalam"], "tamil": ["tamil"], "telugu": ["telugu"], "gujarati": ["gujarati", "gujrat"], "kannada": ["kannada"], "odia": ["odia", "oriya", "odiya"],
    "marathi": ["marathi"], "bengali": ["bengali", "bangla"], "hindi": ["hindi"], "urdu": ["urdu"], "assamese": ["assam", "assamese"], "bhojpuri": ["bhojpuri"], "english": ["english", "eng", "en"], "french": ["french", "fr"],
}
#: Codes that stand before a name, from a separator or as a word.
WRAPPERS = [
    "pb", "mal", "tm", "tl", "tg", "guj", "kan", "kn", "ori", "cri", "cric", "airtel", "d2h", "ts", "at", "tata", "tata play", "tata sky", "dish tv", "videocon d2h", "sky", "live", "ukhd", "ukfhd", "uksd", "ukuhd", "uk4k",
    "uk hd", "uk fhd", "uk sd", "in news", "in guj", "in gujarati", "in punjabi", "in tamil", "in telugu", "in malayalam", "in kannada", "in marathi", "in bangla", "in bengali", "ca fr", "us spanish", "us english", "latin", "religious",
    "ph", "eng", "sports", "sport", "pjb", "mly", "gjr", "mrt", "tlg", "bgl", "tam", "bho", "bhoj", "my", "bd",
]
#: Those of them that need no separator.
LEADING = "pb mal tm tl tg guj kan kn ori cri cric airtel d2h ts at tata my bd eng sports sport pjb mly gjr mrt tlg bgl tam bho bhoj".split()
#: Spellings of one word.
CANONICAL = {
    "sport": "sports", "movie": "movies", "film": "movies", "films": "movies", "color": "colors", "colour": "colors", "colours": "colors", "television": "tv", "sci": "science",
}
IDENTITY = {
    "punjabi": "punjab", "panjabi": "punjab", "punjab": "punjab", "times": "time", "chardikalah": "chardikala", "chardikla": "chardikala", "hp": "himachal", "inter": "international", "tune": "tunes", "tunes": "tunes",
}
NUMBERS = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9", "ten": "10", "eleven": "11", "twelve": "12",
}
#: Spellings of phrases, in order.
REPAIRS = [
    (r"\bchakde\b", "chak de"), (r"\bdisc\s+(science|history|turbo)\b", r"discovery \1"), (r"\bdisc\s+sci\b", "discovery science"), (r"\bs\s+west\b", "south west"), (r"\bn\s+west\b", "north west"), (r"\bs\s+east\b", "south east"),
    (r"\bn\s+east\b", "north east"), (r"\bfox sport\b", "fox sports"), (r"\bnews 18\b", "news18"), (r"\bhome and garden television\b", "hgtv"), (r"\boprah winfrey network\b", "own"), (r"\bnational geographic\b", "nat geo"),
    (r"\bthe discovery channel\b|\bdiscovery channel\b", "discovery"), (r"\bsony entertainment television\b", "sony tv"), (r"\bfilm rise\b", "filmrise"), (r"\bscreen pix\b", "screenpix"), (r"\bcine max\b", "cinemax"), (r"\bcity tv\b", "citytv"),
    (r"\b3 abn\b", "3abn"), (r"\bcp 24\b", "cp24"), (r"\bbe in\b", "bein"), (r"\bsports net\b", "sportsnet"), (r"\bredzone\b", "red zone"), (r"\bfan duel\b", "fanduel"), (r"\bbally sports(?: network)?\b", "fanduel sports"),
    (r"\bfanduel sports network\b", "fanduel sports"), (r"\bb 4 u\b", "b4u"), (r"\benter+r 10\b", "enter 10"), (r"\b(?:bazar|bazaar)\b", "bajar"), (r"\basmitha\b", "asmita"), (r"\bchard(?:h)?ikla\b|\bchardikala\b", "chardikala"),
    (r"\baakaash\b", "akash"), (r"\bsuvana\b", "suvarna"), (r"\bgujrat\b", "gujarat"), (r"\bcheannl\b|\bnetwrk\b", "network"), (r"\bid investigation discovery\b", "investigation discovery"),
]
#: What kind of programme a word speaks of.
CONTENT = {"news": ["news"], "music": ["music"], "movies": ["movie", "movies", "cinema", "film", "films"], "sports": ["sport", "sports", "cricket", "football", "soccer", "tennis", "golf", "racing"], "kids": ["kids", "children", "junior", "jr"], "religious": ["religious", "religion", "faith", "devotional"], "science": ["science"]}
#: Segments that name a market.
MARKETS = {
    "us": "US", "usa": "US", "u s": "US", "united states": "US", "america": "US", "north america": "NA_DIASPORA", "ca": "CA", "can": "CA", "canada": "CA", "toronto": "CA", "to": "CA", "uk": "UK", "gb": "UK", "united kingdom": "UK",
    "britain": "UK", "in": "IN", "india": "IN", "inr": "IN", "pk": "PK", "pakistan": "PK", "bein": "BEIN", "il": "IL", "no": "NO", "fi": "FI", "dz": "DZ", "lb": "LB", "it": "IT", "iq": "IQ", "qa": "QA", "eg": "EG", "ru": "RU",
    "exyu": "EXYU", "ex yu": "EXYU", "ro": "RO", "br": "BR", "nl": "NL", "se": "SE", "cz": "CZ", "bg": "BG", "id": "ID", "lk": "LK", "sl": "LK", "ir": "IR", "af": "AFRICA", "fr": "FR", "es": "ES", "de": "DE", "pt": "PT", "gr": "GR",
    "pl": "PL", "th": "TH", "mt": "MT", "eu": "EU", "ar": "MENA", "sa": "LATAM", "alb": "AL", "bln": "EXYU", "jp": "JP", "japan": "JP", "us in": "NA_DIASPORA", "usa in": "NA_DIASPORA", "us india": "NA_DIASPORA", "usa india": "NA_DIASPORA",
    "us indian": "NA_DIASPORA", "can us": "NA_DIASPORA", "usa canada": "NA_DIASPORA", "in to": "CA", "india to": "CA", "in toronto": "CA", "india toronto": "CA",
}
#: First segments of a category that say whose part of the world it is.
NAMESPACES = "AS SA AR UK EU NA AF ES AM ALB BLN DE PT FR GR PL TH IT MT".split()
#: The market that a namespace means by itself, and the one where its topic names no country.
NAMESPACE_MARKETS = {"UK": "UK", "FR": "FR", "ES": "ES", "DE": "DE", "PT": "PT", "ALB": "AL", "BLN": "EXYU", "GR": "GR", "PL": "PL", "TH": "TH", "IT": "IT", "MT": "MT", "SA": "LATAM"}
NAMESPACE_DEFAULTS = {"NA": "NA", "AS": "ASIA", "AR": "MENA", "EU": "EU", "AM": "LATAM", "AF": "AFRICA"}
#: Patterns of countries in topics, in order, behind a namespace.
COUNTRIES = [
    (r"\b(?:usa|united states|america)\b", "US"), (r"\bcanada\b", "CA"), (r"\bfrance|french\b", "FR"), (r"\bbelgium|belgique|belgie\b", "BE"), (r"\bhungary|hungaria|hungarian\b", "HU"), (r"\bdenmark|danish\b", "DK"), (r"\blatvia|latvian\b", "LV"),
    (r"\bswiss|switzerland\b", "CH"), (r"\blithuania|lithuanian\b", "LT"), (r"\bukraine|ukrainian\b", "UA"), (r"\bcyprus|cypriot\b", "CY"), (r"\bvietnam|vietnamese\b", "VN"), (r"\bsouth korea|korea|korean\b", "KR"), (r"\bhong ?kong\b", "HK"),
    (r"\barmenia|armenian\b", "AM"), (r"\bkurdistan|kurdish\b", "KURD"), (r"\bjapan|japanese\b", "JP"), (r"\bmexico|mexican\b", "MX"), (r"\bcolombia|colombian\b", "CO"), (r"\bperu|peruvian\b", "PE"), (r"\bchile|chilean\b", "CL"),
    (r"\becuador|ecuadorian\b", "EC"), (r"\buruguay|uruguayan\b", "UY"), (r"\bserbia|serbian\b", "RS"), (r"\bcroatia|croatian\b", "HR"), (r"\bbosnia|bosnian\b", "BA"), (r"\bmacedonia|macedonian\b", "MK"), (r"\bslovenia|slovenian\b", "SI"),
    (r"\bnigeria|nigerian\b", "NG"), (r"\bghana|ghanaian\b", "GH"), (r"\bcameroon|cameroonian\b", "CM"), (r"\bsomalia|somali\b", "SO"), (r"\bmali|malian\b", "ML"),
]
#: Patterns of markets in categories without a namespace, in order, before the countries.
CATEGORY_MARKETS = [
    (r"\b(?:mbc\s+arabic|arabic\s+news|arabic|islamic)\b", "MENA"), (r"\bisrael(?:i)?\b", "IL"), (r"\bnorway|norwegian\b", "NO"), (r"\bfinland|finnish\b", "FI"), (r"\balgeria|algerian\b", "DZ"), (r"\blebanon|lebanese\b", "LB"),
    (r"\bitaly|italian\b", "IT"), (r"\biraq|iraqi\b", "IQ"), (r"\bqatar|qatari\b", "QA"), (r"\begypt|egyptian\b", "EG"), (r"\brussia|russian\b", "RU"), (r"\b(?:ex[ -]?yu|exyu|yugoslav(?:ia|ian)?)\b", "EXYU"), (r"\bromania|romanian\b", "RO"),
    (r"\bbrasil|brazil|brazilian\b", "BR"), (r"\bnetherlands|dutch\b", "NL"), (r"\bsweden|swedish\b", "SE"), (r"\bczech(?:ia| republic)?\b", "CZ"), (r"\bbulgaria|bulgarian\b", "BG"), (r"\bindonesia|indonesian\b", "ID"),
    (r"\bsri\s+lanka|sri\s+lankan|ceylon\b", "LK"), (r"\biran|iranian|persian\b", "IR"), (r"\bafghanistan|afghan\b", "AF"),
]
#: Topics of the Indian package.
INDIA_TOPICS = "india indian english sports sport punjabi punjab malayalam bangla bengali marathi gujarati tamil telugu kannada odia oriya bhojpuri assam assamese".split()
#: Codes that names in a category of a topic begin with.
TOPIC_CODES = {
    "english": ["eng"], "sports": ["sports", "sport", "sp"], "punjabi": ["pjb", "pb", "pun", "punj"], "malayalam": ["mly", "mal", "ml", "my"], "bengali": ["bgl", "bn", "bd"], "bangla": ["bgl", "bn", "bd"], "gujarati": ["gjr", "guj"],
    "marathi": ["mrt", "mar"], "telugu": ["tlg", "tg", "tl"], "tamil": ["tam", "tm"], "kannada": ["kan", "kn"], "odia": ["ori", "od"], "assam": ["asm"], "assamese": ["asm"], "bhojpuri": ["bho", "bhoj"],
}
#: Words inside brackets that aren't part of a name, and letters that stand alone there.
BRACKETED = "english eng en audio multi multiaudio dubbed original feed source backup raw vip test".split()
BRACKETED_LETTERS = "a b c d e f f2 fl h l r s x cx pc".split()
#: Parts and languages of India that a provider adds to a name.
REGION_WORDS = "punjab punjabi haryana himachal pradesh hp jammu kashmir gujarat gujarati rajasthan uttar uttarakhand madhya chhattisgarh bihar jharkhand assam odisha odia bengal bangla bengali maharashtra marathi karnataka kannada kerala malayalam tamil telugu andhra telangana delhi mumbai india indian".split()
#: Words of numbered banks of channels, of those for films, of categories of such banks, and of generic numbered channels.
BANK_WORDS = "360 movies cinema box office store premiere premium play ppv event events slot slots feed feeds multiscreen multi".split()
MOVIE_BANK_WORDS = "movies cinema box office store premiere".split()
BANK_CATEGORIES = "premium play store movies cinema ppv events 360".split()
SLOT_WORDS = "movie movies cinema film films sports sport event events channel channels stream streams slot slots feed feeds live ppv tv network playlist radio music".split()
#: Signs of headings.
EDGE_SIGNS = "#*=~_─━═•▪▫◆◇"


@dataclass(frozen=True)
class Vocabulary:
    """The words that names are read with; every field has the fixed values above unless given."""

    technical: frozenset[str] = frozenset(TECHNICAL)
    optional: frozenset[str] = frozenset(OPTIONAL)
    meaningful: frozenset[str] = frozenset(MEANINGFUL)
    south_asian: frozenset[str] = frozenset(SOUTH_ASIAN)
    wrappers: frozenset[str] = frozenset(WRAPPERS)
    leading: frozenset[str] = frozenset(LEADING)
    india_topics: frozenset[str] = frozenset(INDIA_TOPICS)
    bracketed: frozenset[str] = frozenset(BRACKETED)
    bracketed_letters: frozenset[str] = frozenset(BRACKETED_LETTERS)
    region_words: frozenset[str] = frozenset(REGION_WORDS)
    slot_words: frozenset[str] = frozenset(SLOT_WORDS)
    namespaces: frozenset[str] = frozenset(NAMESPACES)
    languages: dict[str, str] = field(default_factory=lambda: dict(LANGUAGES))
    language_words: dict[str, list[str]] = field(default_factory=lambda: dict(LANGUAGE_WORDS))
    canonical: dict[str, str] = field(default_factory=lambda: dict(CANONICAL))
    identity: dict[str, str] = field(default_factory=lambda: dict(IDENTITY))
    numbers: dict[str, str] = field(default_factory=lambda: dict(NUMBERS))
    content: dict[str, list[str]] = field(default_factory=lambda: dict(CONTENT))
    markets: dict[str, str] = field(default_factory=lambda: dict(MARKETS))
    namespace_markets: dict[str, str] = field(default_factory=lambda: dict(NAMESPACE_MARKETS))
    namespace_defaults: dict[str, str] = field(default_factory=lambda: dict(NAMESPACE_DEFAULTS))
    topic_codes: dict[str, list[str]] = field(default_factory=lambda: dict(TOPIC_CODES))
    repairs: tuple[tuple[str, str], ...] = tuple(REPAIRS)
    countries: tuple[tuple[str, str], ...] = tuple(COUNTRIES)
    category_markets: tuple[tuple[str, str], ...] = tuple(CATEGORY_MARKETS)
