"""Channel resolution: an ordered waterfall of exact, rule-based and similarity joins, each decision with a method and a reason.

Channels and candidates are tables with a region, a key struct (key_columns) and semantic marks. Every stage gives attempts (stream_id, stage, method,
score, epg_id, feed, family, action, reason); first_stage() keeps the first stage that decides. Expensive stages get only what is left.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guidemill.functions.names import ID_ENDING, with_candidates, with_channels
from guidemill.functions.similarity import best_choices, blend_of, ratio_of
from guidemill.functions.text import acronym, bag_key, compact_key, split_camel, strict_key, tokens
from guidemill.functions.time import iso
from guidemill.functions.vocabulary import BANK_CATEGORIES, BANK_WORDS, EDGE_SIGNS, MEANINGFUL, MOVIE_BANK_WORDS, OPTIONAL, TECHNICAL, Vocabulary
from guidemill.sources.tables import written

DIRECTIONS = {"west": ["west", "pacific"], "east": ["east", "eastern"]}
#: Method, score and least length of key, in the order in which they are tried, for keys made from plain names: fixed values.
KEY_METHODS = [("strict", 100.0, 1), ("descriptor_relaxed", 99.0, 3), ("spacing_compact", 98.0, 4), ("token_multiset", 98.5, 4)]
#: Column, method and score of the keys that the reader of names gives, in their order: fixed values.
READ_METHODS = [("strict", "strict", 100.0), ("edition_aware", "edition_aware", 99.5), ("descriptor_relaxed", "descriptor_relaxed", 99.0), ("spacing_compact", "spacing_compact", 98.0), ("token_multiset", "token_multiset", 98.5), ("token_multiset", "category_language_default", 98.0)]
#: Least length of a key of one word; of spacing_compact, of any.
ONE_WORD = {"canonical_identity": 4, "edition_aware": 3, "descriptor_relaxed": 5}
MARKS = ["words", "numbers", "direction", "plus", "extra", "alternate", "shift", "languages", "content", "meaningful"]
#: What in_classes() says of a class c of candidates.
CLASS = ["c.lo", "c.hi", "c.best", "c.next"]


def key_columns(name: Column) -> dict[str, Column]:
    """words, four keys, and the marks that must agree, of plain names by built-in functions alone; names that providers wrap are read by functions.names."""
    said = F.regexp_replace(split_camel(name), r"\+\s*([0-9]+)\b", " plusshift$1 ")
    words = F.filter(tokens(F.replace(said, F.lit("+"), F.lit(" plus "))), lambda x: ~x.isin(TECHNICAL))
    core = F.filter(words, lambda x: ~x.isin(OPTIONAL))
    has = lambda *some: F.exists(words, lambda x: x.isin(*some))
    none = F.array().cast("array<string>")
    return {
        "words": words,
        "strict": strict_key(words),
        "descriptor_relaxed": strict_key(core),
        "spacing_compact": compact_key(core),
        "token_multiset": bag_key(core),
        "initials": acronym(core),
        "numbers": F.array_sort(F.array_distinct(F.filter(words, lambda x: x.rlike("^[0-9]+$")))),
        "direction": F.when(has(*DIRECTIONS["west"]), "west").when(has(*DIRECTIONS["east"]), "east").otherwise(""),
        "plus": has("plus"),
        "extra": has("extra", "xtra"),
        "alternate": has("alternate", "alt"),
        "shift": F.coalesce(F.array_max(F.transform(F.filter(words, lambda x: x.rlike("^plusshift[0-9]+$")), lambda x: F.substring(x, 10, 4).try_cast("int"))), F.lit(0)),
        "languages": none,
        "content": none,
        "meaningful": F.array_sort(F.array_distinct(F.filter(words, lambda x: x.isin(MEANINGFUL) & (x != "east")))),
    }


def with_keys(df: DataFrame, name: str) -> DataFrame:
    return df.withColumns(key_columns(F.col(name)))


def compatible(q: str, c: str, east_default: bool = True) -> Column:
    """No mark of a channel q and a candidate c contradicts.

    Shift, plus, extra and alternate are equal. So is the direction, but a channel that says east may have a candidate that says none. A candidate's numbers
    are the channel's; a candidate without numbers goes with any. Languages, and kinds of content, overlap where both have any. Words that tell editions apart are
    the same on both sides."""
    a, b = lambda x: F.col(f"{q}.{x}"), lambda x: F.col(f"{c}.{x}")
    direction = a("direction") == b("direction")
    if east_default:
        direction = direction | (a("direction") == "east") & (b("direction") == "")
    same = (a("plus") == b("plus")) & (a("extra") == b("extra")) & (a("alternate") == b("alternate")) & (a("shift") == b("shift")) & direction
    overlap = lambda x: (F.size(a(x)) == 0) | (F.size(b(x)) == 0) | F.arrays_overlap(a(x), b(x))
    return same & ((F.size(b("numbers")) == 0) | (a("numbers") == b("numbers"))) & overlap("languages") & overlap("content") & (a("meaningful") == b("meaningful"))


def in_regions(channels: DataFrame, regions: str = "regions") -> DataFrame:
    """A row for each region of a channel's plan, in its order."""
    return channels.select("*", F.posexplode(regions).alias("region_pos", "region"))


def preference(c: str = "c") -> Column:
    """Order of candidates of one family: source priority, fewer words, shorter id, id in small letters, id."""
    return F.struct(F.col(f"{c}.source_priority").alias("p"), F.size(f"{c}.words").alias("w"), F.length(f"{c}.epg_id").alias("l"), F.lower(f"{c}.epg_id").alias("f"), F.col(f"{c}.epg_id").alias("epg_id"), F.col(f"{c}.feed").alias("feed"))


def unique_family(matches: DataFrame, by: list[str]) -> DataFrame:
    """Of each attempt the preferred candidate, if all candidates are of one family; otherwise nothing, and the next attempt decides.

    matches: by..., family, pref (preference()). alternate: the preferred candidate with another id."""
    got = matches.groupBy(*by).agg(F.min("family").alias("family"), F.max("family").alias("other"), F.array_sort(F.collect_set("pref")).alias("prefs")).where("family = other")
    best = F.element_at("prefs", 1)
    others = F.filter("prefs", lambda x: F.lower(x["epg_id"]) != F.lower(best["epg_id"]))
    return got.select(*by, "family", best["epg_id"].alias("epg_id"), best["feed"].alias("feed"), F.get(others, F.lit(0))["epg_id"].alias("alternate"))


def _classes(rows: DataFrame, by: list[str]) -> DataFrame:
    """rows (by..., family, pref) that are equal in `by` as one: lo and hi, their least and greatest family, best, the preferred one, and next, of one family's the preferred one with another id."""
    one = rows.groupBy(*by).agg(F.min("family").alias("lo"), F.max("family").alias("hi"), F.min("pref").alias("best"))
    other = rows.join(one.where("lo = hi"), by).where(F.lower("pref.epg_id") != F.lower("best.epg_id")).groupBy(*by).agg(F.min("pref").alias("next"))
    return one.join(other, by, "left")


def in_classes(candidates: DataFrame, by: list[str]) -> DataFrame:
    """Candidates that are equal in `by` as one row (by..., lo, hi, best, next), so that many of one name meet a channel as one. A null in `by` agrees with nothing."""
    return _classes(candidates.alias("c").select(*[F.col(f"c.{x}") for x in by], F.col("c.family").alias("family"), preference().alias("pref")), by)


def unique_class(met: DataFrame, by: list[str]) -> DataFrame:
    """unique_family() of matches with classes of candidates (by..., lo, hi, best, next)."""
    got = met.groupBy(*by).agg(F.min("lo").alias("family"), F.max("hi").alias("other"), F.min("best").alias("best"), F.collect_set("best").alias("prefs"), F.collect_set("next").alias("more")).where("family = other")
    others = F.filter(F.concat("prefs", "more"), lambda x: F.lower(x["epg_id"]) != F.lower(F.col("best.epg_id")))
    return got.select(*by, "family", F.col("best.epg_id").alias("epg_id"), F.col("best.feed").alias("feed"), F.array_min(others)["epg_id"].alias("alternate"))


def of_classes(channels: DataFrame, columns: list[str], stage) -> DataFrame:
    """The rows that stage(channels) has for each stream, found once for all streams whose rows say the same in `columns`, which are all that the stage reads.

    stage: takes stream_id and `columns`, gives rows by stream_id. All rows of a stream_id count together, as they do in the stage."""
    streams = channels.select("stream_id", F.struct(*dict.fromkeys(columns)).alias("row")).groupBy("stream_id").agg(F.array_sort(F.collect_set("row")).alias("rows"))
    classes = written(streams.select("rows").distinct().withColumn("class", F.monotonically_increasing_id()), "classes")
    found = stage(classes.select(F.col("class").alias("stream_id"), F.explode("rows").alias("row")).select("stream_id", "row.*"))
    return streams.join(classes.join(found.withColumnRenamed("stream_id", "class"), "class").drop("class"), "rows").drop("rows")


def _name_attempts(methods: list[tuple[str, float, int]]):
    some = F.array(*[F.struct(F.lit(k).alias("attempt"), F.lit(m).alias("method"), F.lit(s).alias("score"), F.lit(m).alias("index"), F.when(F.length(m) >= n, F.col(m)).alias("key")) for k, (m, s, n) in enumerate(methods)])
    return some, F.array(*[F.struct(F.lit(m).alias("index"), F.when(F.length(m) >= n, F.col(m)).alias("key")) for m, _, n in methods])


def _read_attempts():
    """Attempts of channels and keys of candidates that with_channels() and with_candidates() have read: every identity key, then READ_METHODS."""
    attempt = lambda k, method, score, index, key: F.struct(k.cast("int").alias("attempt"), F.lit(method).alias("method"), F.lit(score).alias("score"), F.lit(index).alias("index"), key.alias("key"))
    long = lambda key, method: F.contains(key, F.lit(" ")) | (F.length(key) >= ONE_WORD.get(method, 1))
    identity = F.transform("canonical_identity", lambda x, k: attempt(k, "canonical_identity", 100.0, "canonical_identity", F.when(long(x, "canonical_identity"), x)))
    rest = []
    for k, (index, method, score) in enumerate(READ_METHODS):
        key = F.when(F.col(method) != F.col("token_multiset"), F.col(method)) if method == "category_language_default" else F.when((F.length(method) >= 5) if method == "spacing_compact" else long(F.col(method), method), F.col(method))
        rest.append(attempt(F.lit(100 + k), method, score, index, key))
    candidate = lambda index, key: F.struct(F.lit(index).alias("index"), key.alias("key"))
    columns = list(dict.fromkeys(index for index, _, _ in READ_METHODS))
    return F.concat(identity, F.array(*rest)), F.concat(F.transform("canonical_identity", lambda x: candidate("canonical_identity", x)), F.array(*[candidate(x, F.col(x)) for x in columns]))


def exact_key_match(channels: DataFrame, candidates: DataFrame, methods: list[tuple[str, float, int]] = KEY_METHODS, read: bool = False) -> DataFrame:
    """Stage of equal keys: by region of the plan, then by method, the first attempt with one family decides.

    channels: stream_id, regions, key columns. candidates: epg_id, feed, region, family, source_priority, key columns. One equi-join over all keys.
    read: the columns are those of functions.names, and all its keys are tried in its order."""
    attempts, keys = _read_attempts() if read else _name_attempts(methods)
    c = candidates.select("epg_id", "feed", "region", "family", "source_priority", *MARKS, F.explode(keys).alias("a")).select("*", "a.index", "a.key").drop("a").where("key is not null and key <> ''")
    c = in_classes(c, ["region", "index", "key", *MARKS])
    said = ["canonical_identity", "token_multiset", *[x for method in READ_METHODS for x in method[:2]]] if read else [m for m, _, _ in methods]

    def stage(channels):
        q = in_regions(channels).select("stream_id", "region_pos", "region", *MARKS, F.explode(attempts).alias("a")).select("stream_id", "region_pos", "region", *MARKS, "a.*").where("key is not null and key <> ''")
        met = q.alias("q").join(c.alias("c"), (F.col("q.region") == F.col("c.region")) & (F.col("q.index") == F.col("c.index")) & (F.col("q.key") == F.col("c.key")) & compatible("q", "c"))
        rows = unique_class(met.select("q.stream_id", "q.region_pos", "q.attempt", "q.method", "q.score", *CLASS), ["stream_id", "region_pos", "attempt", "method", "score"])
        first = Window.partitionBy("stream_id").orderBy("region_pos", "attempt")
        return rows.withColumn("__k", F.row_number().over(first)).where("__k = 1").drop("__k", "region_pos", "attempt")

    return of_classes(channels, ["regions", *MARKS, *said], stage)


def ordered_lookup(channels: DataFrame, aliases: DataFrame, candidates: DataFrame, key: str = "descriptor_relaxed", read: bool = False) -> DataFrame:
    """Stage of approved aliases (alias, regions, epg_ids in order): the first id that the catalogue has. Empty regions, and ALL, hold everywhere.

    read: the alias may be any of the channel's strict, relaxed, edition and identity keys; aliases also have pos, their order, required_languages, all of which the channel
    must have, and timeshift_epg_ids, a map from hours to ids, which count instead where the channel's name has a shift; where the channel's market was said
    outright the id must be of its plan."""
    a = aliases.select(*[c for c in aliases.columns if c != "regions"], F.col("regions").alias("alias_regions"))
    everywhere = (F.size("alias_regions") == 0) | F.array_contains("alias_regions", "ALL") | F.arrays_overlap("alias_regions", "regions")
    if read:
        keys = F.array_distinct(F.concat(F.array("strict", "descriptor_relaxed", "edition_aware"), "canonical_identity"))
        met = channels.select("stream_id", "regions", "languages", "shift", "explicit", F.explode(keys).alias("said")).join(a, (F.col("said") == F.col("alias")) & everywhere & (F.size(F.array_except("required_languages", "languages")) == 0))
        ids = F.when(F.col("shift") > 0, F.coalesce(F.try_element_at("timeshift_epg_ids", F.col("shift").cast("string")), F.array().cast("array<string>"))).otherwise(F.col("epg_ids"))
        met = met.select("stream_id", "regions", "explicit", F.col("pos").alias("alias_pos"), F.posexplode(ids).alias("pos", "wanted"))
        order = ["alias_pos", "pos"]
    else:
        met = channels.join(a, (F.col(key) == F.col("alias")) & everywhere).select("stream_id", "regions", F.posexplode("epg_ids").alias("pos", "wanted"))
        order = ["pos"]
    known = candidates.groupBy(F.lower("epg_id").alias("folded")).agg(F.min(F.struct("source_priority", (F.col("region") == "ALL").alias("everywhere"), "epg_id", "feed", "family", "region")).alias("c"))
    met = met.join(known, F.lower("wanted") == F.col("folded"))
    if read:
        met = met.where(~F.col("explicit") | F.array_contains("regions", F.col("c.region")))
    best = met.groupBy("stream_id").agg(F.min(F.struct(*order, "c")).alias("x"))
    return best.select("stream_id", F.lit("approved_knowledge").alias("method"), F.lit(100.0).alias("score"), F.col("x.c.epg_id").alias("epg_id"), F.col("x.c.feed").alias("feed"), F.col("x.c.family").alias("family"))


def rule_match(channels: DataFrame, rules: DataFrame, candidates: DataFrame, key: str = "strict") -> DataFrame:
    """Stage of rules (pos, region, pattern, category_pattern, epg_ids): the first rule whose pattern the whole key has, and its first known id.

    Regions are the equi-key of the join; the patterns are tested on what that leaves. A rule that no known id follows doesn't decide."""
    r = rules.withColumnRenamed("region", "rule_region")
    q = in_regions(channels)
    fits = F.rlike(F.col(key), F.concat(F.lit("^(?:"), F.col("pattern"), F.lit(")$"))) & (F.col("category_pattern").isNull() | F.rlike(F.col("category_name"), F.col("category_pattern")))
    met = q.join(r, (F.col("region") == F.col("rule_region")) & fits).select("stream_id", "region_pos", "pos", F.posexplode("epg_ids").alias("id_pos", "wanted"))
    known = candidates.groupBy(F.lower("epg_id").alias("folded")).agg(F.min(F.struct("source_priority", "epg_id", "feed", "family")).alias("c"))
    best = met.join(known, F.lower("wanted") == F.col("folded")).groupBy("stream_id").agg(F.min(F.struct("region_pos", "pos", "id_pos", "c")).alias("x"))
    return best.select("stream_id", F.lit("verified_rule").alias("method"), F.lit(100.0).alias("score"), F.col("x.c.epg_id").alias("epg_id"), F.col("x.c.feed").alias("feed"), F.col("x.c.family").alias("family"))


def containment_match(channels: DataFrame, candidates: DataFrame, extras: list[str], least: int = 2, regional: bool = False) -> DataFrame:
    """Stage of containment: all words of a candidate are in the channel's name and what the name has besides are words of `extras`.

    Candidates are met by their longest word only; of those that fit, the ones with most words must be one family. regional: extras name regions, of
    which a candidate must have one itself beside a brand, and the channel's name has three words or more."""
    rare = lambda w: F.element_at(F.array_sort(F.transform(w, lambda x: F.struct((-F.length(x)).alias("l"), x.alias("w")))), 1)["w"]
    known = F.array(*[F.lit(x) for x in extras]).cast("array<string>")
    if regional:
        core = lambda df: df.withColumn("words", F.array_distinct(F.filter("words", lambda x: ~x.isin(OPTIONAL))))
        channels = core(channels).where(F.size("words") >= 3)
        brand = F.filter("words", lambda x: ~F.array_contains(known, x) & (x != "and"))
        candidates = core(candidates).where((F.size(F.array_intersect("words", known)) > 0) & (F.size(brand) > 0))
    c = in_classes(candidates.where(F.size("words") >= least), ["region", *MARKS]).withColumn("block", rare(F.col("words")))

    def stage(channels):
        q = in_regions(channels).select("*", F.explode(F.array_distinct("words")).alias("block"))
        extra = F.array_except("q.words", "c.words")
        met = q.alias("q").join(c.alias("c"), (F.col("q.region") == F.col("c.region")) & (F.col("q.block") == F.col("c.block")) & (F.size(F.array_except("c.words", "q.words")) == 0) & (F.size(extra) > 0) & (F.size(F.array_except(extra, known)) == 0) & compatible("q", "c"))
        most = met.select("q.stream_id", *CLASS, F.size("c.words").alias("n")).withColumn("top", F.max("n").over(Window.partitionBy("stream_id"))).where("n = top")
        return unique_class(most.withColumns({"method": F.lit("regional_context_containment"), "score": F.lit(97.5)}), ["stream_id", "method", "score"])

    return of_classes(channels, ["regions", *MARKS], stage)


def near_exact_match(channels: DataFrame, candidates: DataFrame, least_ratio: float = 84.0, careful: bool = False) -> DataFrame:
    """Stage of spelling variants: names of equally many words that differ in one, and that one by a ratio of least_ratio or more.

    Both sides are met by what their words are without one of them, so no two names are compared that don't share all others. careful: the words that differ
    have five letters or more, begin alike, are at most two letters longer or shorter, and are neither numbers nor words that tell editions apart; a single
    word that is shared has four letters or more; words count in their identity form, and the first region of the plan that has a best family decides."""
    if careful:
        split = lambda df: df.withColumn("words", F.filter(F.split("token_multiset", " "), lambda x: x != ""))
        channels, candidates = split(channels), split(candidates)
    without = lambda: F.transform(F.sequence(F.lit(1), F.size("words")), lambda k: F.struct(bag_key(F.concat(F.slice("words", 1, k - 1), F.slice(F.col("words"), k + 1, F.size("words")))).alias("rest"), F.element_at("words", k).alias("word")))
    some = lambda df: df.where(F.size("words") > 1).select("*", F.explode(without()).alias("w")).select("*", "w.rest", "w.word").drop("w")
    c = some(in_classes(candidates, ["region", *MARKS]))

    def stage(channels):
        q = some(in_regions(channels))
        met = q.alias("q").join(c.alias("c"), (F.col("q.region") == F.col("c.region")) & (F.col("q.rest") == F.col("c.rest")) & (F.col("q.word") != F.col("c.word")) & compatible("q", "c"))
        if careful:
            fine = lambda w: (F.length(w) >= 5) & ~w.rlike("^[0-9]+$") & ~w.isin(MEANINGFUL)
            one, other = F.col("q.word"), F.col("c.word")
            met = met.where(fine(one) & fine(other) & (F.abs(F.length(one) - F.length(other)) <= 2) & (F.substring(one, 1, 1) == F.substring(other, 1, 1)) & (F.contains("q.rest", F.lit(" ")) | (F.length("q.rest") >= 4)))
            scored = met.select("q.stream_id", "q.region_pos", *CLASS, ratio_of(one, other).alias("score")).where(F.col("score") >= least_ratio)
            best = scored.withColumn("top", F.max("score").over(Window.partitionBy("stream_id", "region_pos"))).where("score = top")
            rows = unique_class(best.withColumn("score", F.round("score", 1)), ["stream_id", "region_pos", "score"])
            first = Window.partitionBy("stream_id").orderBy("region_pos")
            return rows.withColumn("__k", F.row_number().over(first)).where("__k = 1").drop("__k", "region_pos").withColumn("method", F.lit("near_exact_orthography"))
        scored = met.select("q.stream_id", *CLASS, ratio_of(F.col("q.word"), F.col("c.word")).alias("score")).where(F.col("score") >= least_ratio)
        best = scored.withColumn("top", F.max("score").over(Window.partitionBy("stream_id"))).where("score = top").withColumn("method", F.lit("near_exact_orthography"))
        return unique_class(best, ["stream_id", "method", "score"])

    return of_classes(channels, ["regions", *MARKS], stage)


def _blocks(keys: DataFrame, name: str, size: int) -> DataFrame:
    """The keys of each region in blocks of about `size`: region, <name>_part, <name> as an array."""
    parts = keys.groupBy("region").agg(F.ceil(F.count("*") / size).cast("long").alias("parts"))
    return keys.join(parts, "region").groupBy("region", F.pmod(F.xxhash64(name), "parts").alias(f"{name}_part")).agg(F.collect_list(name).alias(name))


def _best_of_blocks(limit: int, cutoff: float):
    def run(batches):
        for batch in batches:
            for region, queries, choices in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                rows = [(q, c, s) for q, best in zip(queries, best_choices(queries, choices, limit, cutoff), strict=True) for c, s in best]
                if rows:
                    q, c, s = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array([region] * len(rows), pa.string()), pa.array(q, pa.string()), pa.array(c, pa.string()), pa.array(s, pa.float64())], ["region", "q", "c", "rough"])

    return run


def fuzzy_candidates(channels: DataFrame, candidates: DataFrame, limit: int = 30, cutoff: float = 58.0, key: str = "descriptor_relaxed") -> DataFrame:
    """For each channel and region of its plan the `limit` best of all candidate keys of that region by weighted ratio, at least cutoff.

    Returns stream_id, region, q, candidate_key, rough, place. Each distinct key of a region meets the region's candidate keys in blocks; a pair is
    scored unless its lengths and characters show that it can't reach the cutoff or a place, so none that counts is missed."""
    q = in_regions(channels).select("stream_id", "region", F.col(key).alias("q")).where("q <> ''").distinct()
    c = candidates.select("region", F.col(key).alias("c")).where("c <> ''").distinct()
    met = _blocks(q.select("region", "q").distinct(), "q", 128).join(_blocks(c, "c", 512), "region")
    parts = max(1, int(channels.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    met = met.repartition(parts, "region", "q_part", "c_part").select("region", "q", "c")
    rough = met.mapInArrow(_best_of_blocks(limit, cutoff), "region string, q string, c string, rough double")
    best = Window.partitionBy("region", "q").orderBy(F.desc("rough"), "c")
    top = rough.withColumn("place", F.row_number().over(best)).where(F.col("place") <= limit)
    return q.join(top, ["region", "q"]).select("stream_id", "region", "q", F.col("c").alias("candidate_key"), "rough", "place")


def fuzzy_match(channels: DataFrame, candidates: DataFrame, least: float = 80.0, key: str = "descriptor_relaxed", **options) -> DataFrame:
    """Stage of similarity, for review only: the best family by blend, its margin over the second best family."""
    by = list(dict.fromkeys(["region", "family", key, *MARKS]))
    c = candidates.alias("c").select(*by, preference().alias("pref")).groupBy(*by).agg(F.min("pref").alias("pref"))

    def stage(channels):
        top = written(fuzzy_candidates(channels, candidates, key=key, **options), "similar")
        scored = top.select("q", "candidate_key").distinct().withColumn("score", blend_of("q", "candidate_key"))  # each pair of names once, however many channels have it
        top = top.join(scored, ["q", "candidate_key"])
        q = in_regions(channels)
        met = top.alias("t").join(q.alias("q"), (F.col("t.stream_id") == F.col("q.stream_id")) & (F.col("t.region") == F.col("q.region"))).join(c.alias("c"), (F.col("q.region") == F.col("c.region")) & (F.col("t.candidate_key") == F.col(f"c.{key}")) & compatible("q", "c"))
        by_family = met.select("t.stream_id", "t.score", "c.family", "c.pref").groupBy("stream_id", "family").agg(F.max("score").alias("score"), F.min("pref").alias("pref"))
        order = Window.partitionBy("stream_id").orderBy(F.desc("score"), "family")
        ranked = by_family.withColumn("k", F.row_number().over(order)).withColumn("second", F.lead("score").over(order)).where((F.col("k") == 1) & (F.col("score") >= least))
        return ranked.select("stream_id", F.lit("contextual_fuzzy").alias("method"), "score", F.col("pref.epg_id").alias("epg_id"), F.col("pref.feed").alias("feed"), "family", (F.col("score") - F.coalesce("second", F.lit(0.0))).alias("margin"))

    return of_classes(channels, ["regions", key, *MARKS], stage)


def first_stage(channels: DataFrame, stages: list[DataFrame]) -> DataFrame:
    """For each channel the first stage that has a row for it; channels that none has are UNMATCHED."""
    wanted = {"method": "string", "score": "double", "epg_id": "string", "feed": "string", "family": "string", "alternate": "string", "margin": "double", "action": "string", "reason": "string"}
    rows = None
    for k, stage in enumerate(stages):
        here = stage.select("stream_id", F.lit(k).alias("stage"), *[(F.col(c) if c in stage.columns else F.lit(None)).cast(t).alias(c) for c, t in wanted.items()])
        rows = here if rows is None else rows.union(here)
    best = rows.groupBy("stream_id").agg(F.min_by(F.struct("stage", *wanted), F.col("stage")).alias("x")).select("stream_id", "x.*")
    out = channels.join(best, "stream_id", "left")
    return out.withColumns({"action": F.coalesce("action", F.when(F.col("epg_id").isNotNull(), "AUTO_EPGSHARE").otherwise("UNMATCHED")), "method": F.coalesce("method", F.lit("unmatched")), "reason": F.coalesce("reason", F.when(F.col("stage").isNull(), "no stage decided").otherwise(F.lit("")))})


def decorative_heading(name: Column) -> Column:
    """A name with three signs at either end, or with eight signs or more that are 35 % of it, as headings in channel lists are."""
    raw = F.trim(F.coalesce(name, F.lit("")))
    edge = "[" + EDGE_SIGNS.replace("-", r"\-") + "]"
    signs = F.length(raw) - F.length(F.regexp_replace(raw, edge, ""))
    return (raw.rlike(f"^{edge}{{3}}") & raw.rlike(f"{edge}{{3}}$")) | ((signs >= 8) & (signs >= 0.35 * F.length(raw)))


def language_equivalence_match(channels: DataFrame, candidates: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """Stage of languages that the category says already: names that are equal but for words of those languages at their ends.

    Names meet by their words without those of any language; the words of the category's own languages are then taken off both."""
    v = vocabulary or Vocabulary()
    form = lambda w: v.identity.get(w, w)
    by_language = F.create_map(*[x for k, some in v.language_words.items() for x in (F.lit(k), F.array(*[F.lit(w) for w in sorted({form(w) for w in some})]))])
    every = sorted({form(w) for some in v.language_words.values() for w in some})
    forms = F.create_map(*[F.lit(x) for pair in v.identity.items() for x in pair])
    words = lambda c: F.filter(F.split(c, " "), lambda x: x != "")
    plain = F.array_join(F.filter(words("token_multiset"), lambda x: ~x.isin(every)), " ")
    ordered = F.transform(words("strict"), lambda w: F.coalesce(F.try_element_at(forms, w), w))
    c = in_classes(candidates, ["region", *MARKS, "token_multiset", "strict"]).withColumns({"ordered": ordered, "plain": plain})
    left = lambda side: F.array_join(F.filter(words(f"{side}.token_multiset"), lambda x: ~F.array_contains(F.col("q.gone"), x)), " ")
    inner = lambda side: F.slice(F.col(f"{side}.ordered"), 2, F.greatest(F.size(f"{side}.ordered") - 2, F.lit(0)))
    at_ends = lambda side: ~F.exists(inner(side), lambda x: F.array_contains(F.col("q.gone"), x))

    def stage(channels):
        q = in_regions(channels).select("stream_id", "region_pos", "region", *MARKS, "token_multiset", ordered.alias("ordered"), plain.alias("plain"), F.flatten(F.transform("category_languages", lambda x: F.coalesce(F.try_element_at(by_language, x), F.array().cast("array<string>")))).alias("gone"))
        met = q.alias("q").join(c.alias("c"), (F.col("q.region") == F.col("c.region")) & (F.col("q.plain") == F.col("c.plain")) & (left("q") == left("c")) & (F.length(F.replace(left("q"), F.lit(" "))) >= 4) & at_ends("q") & at_ends("c") & compatible("q", "c"))
        rows = unique_class(met.select("q.stream_id", "q.region_pos", *CLASS), ["stream_id", "region_pos"])
        first = Window.partitionBy("stream_id").orderBy("region_pos")
        return rows.withColumn("__k", F.row_number().over(first)).where("__k = 1").drop("__k", "region_pos").withColumns({"method": F.lit("category_language_equivalence"), "score": F.lit(97.5)})

    return of_classes(channels.where(F.size("category_languages") > 0), ["regions", *MARKS, "token_multiset", "strict", "category_languages"], stage)


def bank_signals(read: DataFrame, least: int = 3) -> DataFrame:
    """stream_id, role (movie or event) and slots of channels in numbered banks: names of a category that are the same but for a last number, with `least` different numbers
    and words of the name or of the category's topic that speak of such banks. read: with_channels() of channels with a category_id."""
    said = F.filter("words", lambda x: x != "")
    rows = read.select("stream_id", "category_id", F.element_at(said, -1).alias("last"), F.slice(said, 1, F.size(said) - 1).alias("base"), F.split(F.lower("category_topic"), "[^a-z0-9]+").alias("topic")).where((F.size(said) > 1) & F.col("last").rlike("^[0-9]{1,3}$"))
    rows = rows.withColumn("slot", F.col("last").cast("int")).where("slot > 0").withColumn("key", F.array_join("base", " "))
    slots = rows.groupBy("category_id", "key").agg(F.countDistinct("slot").alias("slots"), F.min(F.struct("stream_id", "base", "topic")).alias("x")).where(F.col("slots") >= least)
    has = lambda words, some: F.arrays_overlap(words, F.array(*[F.lit(x) for x in some]))
    both = F.concat("x.base", "x.topic")
    movie, sports = has(both, MOVIE_BANK_WORDS), F.array_contains(both, "360")
    banks = slots.where(has(both, BANK_WORDS) & (sports | movie | has(F.col("x.topic"), BANK_CATEGORIES))).select("category_id", "key", "slots", F.when(movie & ~sports, "movie").otherwise("event").alias("role"))
    return rows.select("stream_id", "category_id", "key").join(banks, ["category_id", "key"]).select("stream_id", "role", "slots")


def learned_prefixes(read: DataFrame, least: int = 2, share: float = 0.35, enough: int = 5) -> DataFrame:
    """category_id, learned: prefixes that many names of a category begin with; read: with_channels() of channels with a category_id."""
    found = prefix_profile(read, "category_id", F.col("prefix"), least, share, enough)
    return found.groupBy(F.col("category").alias("category_id")).agg(F.array_sort(F.collect_set("prefix")).alias("learned"))


def read_channels(channels: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """with_channels() with the prefixes that each category's names teach; regions: the plan of a channel's name and category, unless the table has one; then ALL where neither says any.

    Names are read twice: prefixes have to be counted before they can be taken off. Each name of a category is read once, however many channels have it."""
    if "category_id" not in channels.columns:
        channels = channels.withColumn("category_id", F.col("category_name"))
    said = lambda *some: F.struct(*[(F.col(x).cast("string") if x != "learned" else F.col(x)).alias(x) for x in some])

    def read(rows: DataFrame, *some: str) -> DataFrame:
        once = with_channels(rows.select(said(*some).alias("said")).distinct().select("said", "said.*"), learned="learned" if "learned" in some else None, vocabulary=vocabulary).drop(*some)
        fresh = [x for x in once.columns if x != "said"]
        return rows.drop(*fresh).withColumn("said", said(*some)).join(once, "said").drop("said")

    first = read(channels.select("stream_id", "category_id", "channel_name", "category_name"), "channel_name", "category_name")
    taught = channels.join(learned_prefixes(first), "category_id", "left")
    out = read(taught, "channel_name", "category_name", "learned").drop("learned")
    plan = F.when(F.size("plan") > 0, F.col("plan")).otherwise(F.array(F.lit("ALL")))
    return out.withColumn("regions", F.coalesce("regions", plan) if "regions" in channels.columns else plan)


def read_candidates(candidates: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """with_candidates(), each candidate also in region ALL; family: the table's, else what the id's name and marks say."""
    out = with_candidates(candidates, vocabulary=vocabulary)
    out = out.withColumn("family", F.coalesce("family", "signature") if "family" in out.columns else F.col("signature")).drop("signature")
    return out.unionByName(out.where("region <> 'ALL'").withColumn("region", F.lit("ALL")))


#: What resolve() can show of a name beside its regions, core and market.
DETAILS = ["category_namespace", "category_topic", "category_market", "inventory_role", "strict", "wrappers", "languages", "explicit"]


def resolve(channels: DataFrame, candidates: DataFrame, dummies: DataFrame, aliases: DataFrame, rules: DataFrame, special: DataFrame, panel: DataFrame, covered: list[str] | None = None, vocabulary: Vocabulary | None = None, review: bool = True, details: bool = False) -> DataFrame:
    """The waterfall over channels (stream_id, channel_name, category_name, panel_epg_id; category_id and regions if there are any).

    candidates: epg_id, feed, region, source_priority, display_name; family if there is one. dummies: name, epg_id; those named blank, movie and event stand for headings and
    numbered banks. aliases: see ordered_lookup(read). rules: see rule_match(). special: pos, pattern, dummy_name (null: UNMATCHED) on the strict key. panel: epg_id,
    status. covered: regions that have a catalogue, those of candidates if not given; a channel whose market was said outright and has none keeps a usable panel id or stays
    unmatched before any similarity is tried. review: also look for similar names, which are never matched without a person. details:
    also what was read of each name (DETAILS).

    Stages in order: heading, special case, numbered bank of the inventory, generic numbered channel, no catalogue, approved alias, rule, equal keys, containment of regional
    names, languages of the category, regional extension, spelling, panel id, station's call sign, similarity. Names are read once and written."""
    v = vocabulary or Vocabulary()
    q = written(read_channels(channels, vocabulary), "channels")
    c = written(read_candidates(candidates, vocabulary), "candidates")
    named = dummies.groupBy(F.lower("name").alias("dn")).agg(F.min("epg_id").alias("dummy_id"))

    def dummy(rows: DataFrame, method: str, role: Column) -> DataFrame:
        met = rows.select("stream_id", role.alias("dn")).join(named, "dn", "left")
        return met.select("stream_id", F.lit(method).alias("method"), F.lit(100.0).alias("score"), F.col("dummy_id").alias("epg_id"), F.lit("DUMMY_CHANNELS").alias("feed"), F.lit("AUTO_DUMMY").alias("action"))

    heading = dummy(q.where("heading"), "heading_placeholder", F.lit("blank"))
    # patterns meet each distinct key once
    keys = q.select("strict").distinct().join(written(special, "special"), F.rlike(F.col("strict"), F.col("pattern"))).groupBy("strict").agg(F.min(F.struct("pos", F.lower("dummy_name").alias("dn"))).alias("x"))
    safety = q.select("stream_id", "strict").join(keys, "strict").select("stream_id", F.col("x.dn").alias("dn")).join(named, "dn", "left")
    safety = safety.select("stream_id", F.lit("safety_rule").alias("method"), F.lit(100.0).alias("score"), F.col("dummy_id").alias("epg_id"), F.when(F.col("dn").isNotNull(), "DUMMY_CHANNELS").alias("feed"), F.when(F.col("dn").isNotNull(), "AUTO_DUMMY").otherwise("UNMATCHED").alias("action"))
    bank = dummy(bank_signals(q).withColumnRenamed("role", "kind"), "inventory_numbered_bank", F.col("kind"))
    slot = dummy(q.where("slot <> ''"), "synthetic_numbered_genre_slot", F.col("slot"))
    usable = panel.where("status = 'USABLE'").select(F.lower("epg_id").alias("pid")).distinct()
    kept = q.join(usable, F.lower("panel_epg_id") == F.col("pid"), "left_semi")
    as_panel = kept.select("stream_id", F.lit("panel").alias("method"), F.lit(100.0).alias("score"), F.col("panel_epg_id").alias("epg_id"), F.lit("server xmltv.php").alias("feed"), F.lit("KEEP_PANEL").alias("action"))
    known = F.array(*[F.lit(x) for x in covered]).cast("array<string>") if covered is not None else None
    plans = q.where("explicit").select("stream_id", "regions")
    if known is None:
        have = candidates.select("region").distinct()
        outside = plans.join(plans.select("stream_id", F.explode("regions").alias("region")).join(have, "region").select("stream_id").distinct(), "stream_id", "left_anti")
    else:
        outside = plans.where(~F.arrays_overlap("regions", known))
    outside = outside.where(~F.array_contains("regions", "ALL"))
    blocked = outside.select("stream_id", F.lit("unsupported_catalog_scope").alias("method"), F.lit("UNMATCHED").alias("action"), F.concat(F.lit("no catalogue covers "), F.array_join("regions", "/")).alias("reason"))
    exact = [heading, safety, bank, slot, as_panel.join(outside, "stream_id", "left_semi"), blocked, ordered_lookup(q, aliases, c, read=True), rule_match(q, rules, c), exact_key_match(q, c, read=True)]
    exact = [written(x, "attempts") for x in exact]
    decided = exact[0].select("stream_id")
    for x in exact[1:]:
        decided = decided.union(x.select("stream_id"))
    left = written(q.join(decided.distinct(), "stream_id", "left_anti"), "undecided")
    areas = sorted(v.region_words)
    canonical = sorted({v.identity.get(x, x) for x in areas})
    bag = lambda df: df.withColumn("words", F.filter(F.split("token_multiset", " "), lambda x: x != ""))
    known = F.array(*[F.lit(x) for x in canonical])
    local = bag(left.where(F.array_contains("regions", "IN"))).withColumn("regions", F.array(F.lit("IN"))).where((F.size(F.array_intersect("words", known)) > 1) & (F.size(F.array_except("words", known)) > 0))
    extended = extension_match(local, bag(c.where("region = 'IN'")), canonical, marks=True)
    later = [containment_match(left, c, areas, regional=True), language_equivalence_match(left, c, vocabulary), extended, near_exact_match(left, c, careful=True), as_panel, callsign_match(left.where(F.array_contains("regions", "US")), c.where("region = 'US'"))]
    if review:
        short = ~F.contains("descriptor_relaxed", F.lit(" ")) & (F.length("descriptor_relaxed") < 5)
        later.append(fuzzy_match(left.where(~short).join(kept, "stream_id", "left_anti"), c, key="strict").withColumns({"action": F.lit("REVIEW"), "reason": F.lit("similar names are never matched without review")}))
    shown = ["regions", "core", "market"]
    if details:
        roles = bank_signals(q).select("stream_id", F.concat(F.col("role"), F.lit("_bank")).alias("inventory_role"))
        q, shown = q.join(roles, "stream_id", "left").fillna("linear", ["inventory_role"]), [*shown, *DETAILS]
    out = first_stage(q.select(*channels.columns, *[x for x in shown if x not in channels.columns]), [*exact, *later])
    return out.withColumn("source", F.when(F.col("action") == "REVIEW", "epgshare_candidate").when(F.col("feed") == "DUMMY_CHANNELS", "dummy").when(F.col("action") == "KEEP_PANEL", "panel").when(F.col("epg_id").isNotNull(), "epgshare").otherwise(""))


def prefix_profile(channels: DataFrame, category: str, prefix: Column, least: int = 2, share: float = 0.35, enough: int = 5) -> DataFrame:
    """Prefixes that a category's names begin with often: at least `least` times, and with that share of the category or `enough` times."""
    rows = channels.select(F.col(category).alias("category"), prefix.alias("prefix"))
    counts = rows.where("prefix is not null and prefix <> ''").groupBy("category", "prefix").agg(F.count("*").alias("n"))
    total = rows.groupBy("category").agg(F.count("*").alias("total"))
    out = counts.join(total, "category").where((F.col("n") >= least) & ((F.col("n") >= share * F.col("total")) | (F.col("n") >= enough)))
    return out.select("category", "prefix", "n", F.round(F.col("n") * 100.0 / F.col("total"), 2).alias("share_percent"))


def numbered_banks(channels: DataFrame, category: str, base: Column, slot: Column, least: int = 3) -> DataFrame:
    """(category, base) with at least `least` different slot numbers."""
    rows = channels.select(F.col(category).alias("category"), base.alias("base"), slot.alias("slot")).where("slot is not null")
    return rows.groupBy("category", "base").agg(F.countDistinct("slot").alias("slots"), F.count("*").alias("channels"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot")).where(F.col("slots") >= least)


def route_plan(channels: DataFrame, markets: DataFrame) -> DataFrame:
    """channels with regions: those of the strongest market that the channel's name speaks of, unless the category's is strictly stronger; then ALL.

    Each distinct name and category meets the patterns once.
    markets: pos, field (name or category), pattern, regions in order, strength. Among equally strong ones of a field the first in pos counts."""
    said = lambda field, c: channels.select(F.lit(field).alias("field"), F.lower(c).alias("said")).where("said is not null").distinct()
    texts = said("name", "channel_name").union(said("category", "category_name"))
    kind = F.when(F.col("m.field") == "category", "category").otherwise("name")
    met = texts.alias("t").join(written(markets, "markets").alias("m"), (F.col("t.field") == kind) & F.rlike("t.said", F.col("m.pattern")))
    found = met.groupBy("t.field", "t.said").agg(F.max(F.struct("strength", (-F.col("pos")).alias("p"), "regions")).alias("x"))
    rows = channels.select("stream_id", F.explode(F.array(F.struct(F.lit("name").alias("field"), F.lower("channel_name").alias("said")), F.struct(F.lit("category").alias("field"), F.lower("category_name").alias("said")))).alias("s")).select("stream_id", "s.*")
    best = rows.join(found, ["field", "said"]).groupBy("stream_id").agg(F.max(F.struct("x.strength", (F.col("field") != "category").alias("own"), "x.regions")).alias("b"))
    out = channels.drop("regions").join(best.select("stream_id", F.col("b.regions").alias("regions")), "stream_id", "left")
    return out.withColumn("regions", F.array_distinct(F.concat(F.coalesce("regions", F.array().cast("array<string>")), F.array(F.lit("ALL")))))


#: North American call signs: in brackets, or with one of these endings; a number behind is a subchannel.
_SIGN = r"([KkWw][A-Za-z]{2,4})"
_ENDING = "(?:TV|DT|LD|CD)"


def _signs(text: Column, patterns: list[str]) -> Column:
    """Distinct (sign, sub) in order of the patterns; sub: the number of a subchannel or blank."""
    part = lambda p: lambda x: F.struct(F.upper(F.regexp_extract(x, p, 1)).alias("sign"), F.regexp_extract(x, p, 2).alias("sub"))
    found = [F.transform(F.regexp_extract_all(text, F.lit(p), F.lit(0)), part(p)) for p in patterns]
    return F.array_distinct(F.concat(*found))


def callsigns(name: Column) -> Column:
    """(sign, sub) that a channel's name or panel id says: in brackets, or with an ending as -DT or " TV"; a bare word is none."""
    return _signs(F.coalesce(name, F.lit("")), [rf"(?i)[\[(]\s*{_SIGN}(?:[- ]{_ENDING})?(?:[- ]?(\d+))?\s*[\])]", rf"(?i)\b{_SIGN}[- ]{_ENDING}(?:[- ]?(\d+))?\b"])


def candidate_callsigns(guide_id: Column) -> Column:
    """(sign, sub) that a catalogue id has as a part between points or brackets."""
    return _signs(F.regexp_replace(F.coalesce(guide_id, F.lit("")), ID_ENDING, ""), [rf"(?i)(?:^|[.(]){_SIGN}(?:-{_ENDING})?(?:-?(\d+))?(?=[.)]|$)"])


def callsign_match(channels: DataFrame, candidates: DataFrame, display: str | None = None) -> DataFrame:
    """Stage of call signs: candidates that have all call signs of a channel's name and panel id, with the same subchannel; they must be one family.

    display: the candidates' column of names to look in instead of their ids. A sign that no candidate has doesn't count, unless it has a subchannel: then the channel is left alone."""
    said = F.concat_ws(" ", "channel_name", "panel_epg_id") if "panel_epg_id" in channels.columns else F.col("channel_name")
    signs = callsigns(said) if display is None else callsigns_of_words(said)
    found = candidate_callsigns(F.col("epg_id")) if display is None else callsigns_of_words(F.col(display))
    c = candidates.select("epg_id", "feed", "family", "source_priority", "words", F.explode(found).alias("s")).alias("c").select("c.family", preference().alias("pref"), "s")
    c = _classes(c.groupBy("family", "pref").agg(F.array_sort(F.collect_set("s")).alias("signs")), ["signs"])
    c = c.select("*", F.explode("signs").alias("s")).select("*", "s.sign", "s.sub")

    def stage(channels):
        q = channels.where(F.size("signs") > 0).select("stream_id", F.explode("signs").alias("s")).select("stream_id", "s.sign", "s.sub")
        have = c.select("sign", "sub").distinct().withColumn("known", F.lit(True))
        q = q.join(have, ["sign", "sub"], "left")
        wanted = q.groupBy("stream_id").agg(F.count("known").alias("wanted"), F.max(F.col("known").isNull() & (F.col("sub") != "")).alias("lost")).where("wanted > 0 and not lost").select("stream_id", "wanted")
        met = q.where("known").join(wanted, "stream_id").alias("q").join(c.alias("c"), ["sign", "sub"])
        rows = met.select("q.stream_id", "q.wanted", "sign", "c.signs", *CLASS).groupBy("stream_id", "wanted", "signs", "lo", "hi", "best", "next").agg(F.countDistinct("sign").alias("n")).where("n = wanted")
        return unique_class(rows.withColumns({"method": F.lit("verified_station_identity"), "score": F.lit(99.0)}), ["stream_id", "method", "score"])

    return of_classes(channels.select("stream_id", signs.alias("signs")), ["signs"], stage)


def callsigns_of_words(name: Column) -> Column:
    """(sign, sub) of names that are known to be stations: also signs that stand alone, in capitals; subchannels don't count."""
    found = F.regexp_extract_all(name, F.lit(r"(?<![A-Za-z0-9])([KW][A-Z]{2,3})(?:-(?:TV|DT|CD|LD)\d*)?(?![A-Za-z0-9])"), F.lit(1))
    return F.array_distinct(F.transform(found, lambda x: F.struct(x.alias("sign"), F.lit("").alias("sub"))))


def extension_match(channels: DataFrame, candidates: DataFrame, region_words: list[str], most: int = 2, marks: bool = False) -> DataFrame:
    """Stage of catalogue names that say more: all words of the channel are in the candidate's name, which has at most `most` others, all region words.

    marks: the marks of both must agree, too."""
    rare = lambda w: F.element_at(F.array_sort(F.transform(w, lambda x: F.struct((-F.length(x)).alias("l"), x.alias("w")))), 1)["w"]
    c = in_classes(candidates, ["region", *MARKS]).select("*", F.explode(F.array_distinct("words")).alias("block"))
    extra = F.array_except("c.words", "q.words")

    def stage(channels):
        q = in_regions(channels).where(F.size("words") > 0).withColumn("block", rare(F.col("words")))
        met = q.alias("q").join(c.alias("c"), (F.col("q.region") == F.col("c.region")) & (F.col("q.block") == F.col("c.block")) & (F.size(F.array_except("q.words", "c.words")) == 0) & F.size(extra).between(1, most) & (F.size(F.array_except(extra, F.array(*[F.lit(x) for x in region_words]))) == 0) & (compatible("q", "c") if marks else F.lit(True)))
        return unique_class(met.select("q.stream_id", F.lit("regional_catalog_extension").alias("method"), F.lit(97.0).alias("score"), *CLASS), ["stream_id", "method", "score"])

    return of_classes(channels, ["regions", *MARKS], stage)


def multiset_difference(a: Column, b: Column) -> Column:
    """The words of a that b lacks, as often as it lacks them."""
    counted = lambda w: F.transform(w, lambda x, k: F.concat(x, F.lit("\x00"), F.size(F.filter(F.slice(w, 1, k + 1), lambda y: y == x))))
    return F.transform(F.array_except(counted(a), counted(b)), lambda x: F.split_part(x, F.lit("\x00"), F.lit(1)))


def review_report(resolved: DataFrame, quality: DataFrame) -> DataFrame:
    """resolved with the quality of its panel id: NO_PANEL_ID without one, NOT_CHECKED if the id wasn't looked at."""
    q = quality.select(F.lower("epg_id").alias("pid"), F.col("status").alias("panel_status"), "live_rows", "latest_stop")
    out = resolved.join(q, F.lower(F.trim("panel_epg_id")) == F.col("pid"), "left").drop("pid")
    blank = F.trim(F.coalesce("panel_epg_id", F.lit(""))) == ""
    return out.withColumns({"panel_status": F.when(blank, "NO_PANEL_ID").otherwise(F.coalesce("panel_status", F.lit("NOT_CHECKED"))), "live_rows": F.coalesce("live_rows", F.lit(0))})


#: Columns of a match report, in their order: fixed values.
REPORT = [
    "server_id", "stream_id", "category_id", "category_name", "category_namespace", "category_topic", "category_market", "inventory_role", "channel_number", "channel_name", "normalized_name", "parsed_channel_name", "detected_region", "route_plan",
    "route_reason", "provider_wrappers", "language_hints", "panel_epg_id", "panel_epg_status", "panel_usable_programmes", "panel_latest_stop_utc", "action", "source", "epg_id", "epg_feed", "best_score", "second_epg_id", "second_epg_feed", "second_score",
    "score_margin", "reason", "match_method",
]


def match_report(resolved: DataFrame, candidates: DataFrame, quality: DataFrame, server_id: str) -> DataFrame:
    """The report of a server's channels, columns REPORT, from resolve(details=True), its candidates and the quality of panel ids (panel_quality()).

    Text is blank and scores are null where there is nothing to say."""
    rows = review_report(resolved, quality)
    feeds = candidates.groupBy(F.col("epg_id").alias("alternate")).agg(F.min(F.struct("source_priority", "feed"))["feed"].alias("second_epg_feed"))
    rows = rows.join(feeds, "alternate", "left")
    has = F.col("alternate").isNotNull()
    said = lambda c, other="": F.coalesce(F.col(c).cast("string"), F.lit(other)) if c in rows.columns else F.lit(other)
    fresh = {
        "server_id": F.lit(server_id),
        "channel_number": said("channel_number"),
        "category_id": said("category_id"),
        "normalized_name": said("strict"),
        "parsed_channel_name": said("core"),
        "detected_region": F.when(F.coalesce("market", F.lit("")) != "", F.col("market")).otherwise(F.coalesce(F.get("regions", F.lit(0)), F.lit("ALL"))),
        "route_plan": F.array_join("regions", " > "),
        "route_reason": F.when(F.col("explicit"), "the name or its category says so").when(F.coalesce("market", F.lit("")) != "", "the category suggests it").otherwise("no clue to a region"),
        "provider_wrappers": F.array_join("wrappers", " | "),
        "language_hints": F.array_join(F.array_sort("languages"), " | "),
        "panel_epg_id": said("panel_epg_id"),
        "panel_epg_status": said("panel_status"),
        "panel_usable_programmes": F.col("live_rows").cast("long"),
        "panel_latest_stop_utc": F.coalesce(iso(F.col("latest_stop")), F.lit("")),
        "epg_id": said("epg_id"),
        "epg_feed": said("feed"),
        "best_score": F.when(F.col("source").isin("epgshare", "epgshare_candidate"), F.round("score", 1)),
        "second_epg_id": said("alternate"),
        "second_epg_feed": said("second_epg_feed"),
        "second_score": F.when(has, F.round("score", 1)),
        "score_margin": F.when(F.col("margin").isNotNull(), F.round("margin", 1)).when(F.col("source") == "epgshare", F.when(has, 0.0).otherwise(100.0)),
        "match_method": F.col("method"),
    }
    return rows.select(*[fresh[c].alias(c) if c in fresh else said(c).alias(c) for c in REPORT])
