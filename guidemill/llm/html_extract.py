"""HTML extraction by line-block distribution.

Markup is stripped into lines, one for each block of text in page order. Text in elements that never hold an article (menus, headers, footers,
sidebars, notices, adverts, forms, comments) is left out. Lengths of lines are summed over sliding windows of `window` lines. Text begins to surge where
the sum leaves zero and dives where it comes back to it.

On pages that mark their article, the one whose stretches between surge and dive hold most text is the page's, and all its lines are kept. On others,
lines that are mostly links count as blank; the stretch with most text is kept, and so is every other line of the element that holds most of it: an
aside, a list of links or a form in its midst doesn't cut a text in two. Parsing takes time in proportion to the page, however broken its markup is.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A tag whose quoted values may hold any sign, and one that ends at the first sign that could end or begin a tag.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""")
_BROKEN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*+)([^<>]*+)>")
_ATTRIBUTE = re.compile(r"""([^\s/>="']++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?+""")
#: Elements whose content is no markup.
_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in _RAW}
#: Elements that never hold an article's text.
_NEVER = _RAW | {"head", "nav", "header", "footer", "aside", "form", "noscript", "template", "svg", "math", "canvas", "object", "audio", "video", "select", "button", "menu", "dialog", "input", "label", "fieldset", "map", "applet"}
#: Elements that have no end.
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that end a line; all others, unknown ones too, are inside one.
_BLOCK = {"address", "article", "aside", "base", "blockquote", "body", "br", "caption", "center", "col", "colgroup", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "frame", "frameset", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "link", "main", "menu", "meta", "nav", "noframes", "noscript", "ol", "optgroup", "option", "p", "pre", "script", "search", "section", "select", "style", "summary", "table", "tbody", "td", "template", "textarea", "tfoot", "th", "thead", "title", "tr", "ul", "xmp"}
#: Elements that end an open paragraph.
_ENDS_P = {"address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "ul"}
#: Elements that end an open one of the first names, unless one of the second is nearer.
_PEERS = {"li": (["li"], ["ul", "ol", "menu"]), "dt": (["dt", "dd"], ["dl"]), "dd": (["dt", "dd"], ["dl"]), "td": (["td", "th"], ["tr", "table"]), "th": (["td", "th"], ["tr", "table"]), "tr": (["tr"], ["table"]), "option": (["option"], ["select"])}
#: Elements that hold other blocks; a line's container is the nearest of them.
_CONTAINER = {"article", "body", "center", "details", "div", "html", "main", "section", "td"}
#: Words of a class, id or role that say that an element isn't the article.
_MARKS = {"ad", "ads", "adbox", "adslot", "adunit", "adsbygoogle", "adsense", "outbrain", "taboola", "cookiebanner", "cookiebar", "topnav", "sidenav", "subnav", "commentform", "commentsection", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "aside", "complementary", "header", "masthead", "footer", "contentinfo", "comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "share", "sharing", "social", "related", "recommended", "newsletter", "subscribe", "subscription", "signup", "login", "popup", "modal", "overlay", "widget", "toolbar", "pagination", "pager", "skip", "search", "form", "copyright", "disclaimer"}
#: Words that may stand beside them: where, how or as what such an element is shown. Any other word ("notice-period") makes a name say something else.
_BESIDE = {"a", "about", "all", "and", "area", "articles", "bar", "block", "body", "bottom", "box", "button", "buttons", "center", "col", "column", "container", "content", "desktop", "div", "fixed", "floating", "global", "group", "holder", "html", "icons", "inline", "inner", "item", "items", "js", "layer", "left", "legal", "link", "links", "list", "main", "message", "mobile", "more", "news", "of", "outer", "page", "panel", "policy", "post", "posts", "primary", "privacy", "reader", "readers", "right", "row", "secondary", "section", "site", "slot", "space", "sticky", "stories", "teaser", "text", "the", "this", "thread", "title", "to", "top", "ui", "unit", "user", "view", "website", "wrap", "wrapper", "zone"}
_WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+(?![a-z])")


def _marked(name: str) -> bool:
    """A name of words that all say what isn't the article, or stand beside such a word."""
    words = [x.lower() for x in _WORDS.findall(name)]
    return any(x in _MARKS for x in words) and all(x in _MARKS or x in _BESIDE for x in words)


def _kind(tag: str, attributes: str) -> tuple[bool, str]:
    """Whether an element is left out, and whether it marks an "article", its "text" or a page's "main" part, else ""."""
    if tag in _NEVER:
        return True, ""
    found: dict[str, str] = {}
    if attributes.strip():
        for name, value in _ATTRIBUTE.findall(attributes):
            found.setdefault(name.lower(), value.strip("\"'"))
    if tag not in ("html", "body", "main") and ("hidden" in found or any(_marked(x) for key in ("class", "id", "role") for x in found.get(key, "").split())):
        return True, ""
    role = found.get("role", "").lower()
    return False, "article" if "article" in (tag, role) else "main" if "main" in (tag, role) else "text" if "articlebody" in found.get("itemprop", "").lower() else ""


@dataclass
class _Open:
    """An open block element, and the inline ones that are open in it."""

    tag: str
    left_out: bool
    article: int  # the number of the outermost article that the element is in, 0 outside
    main: int  # the same for elements that mark the main part
    container: int
    nested: int = 0  # the number of the article inside the outermost one
    inline: list[tuple[str, bool]] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=dict)


@dataclass
class Line:
    """A line of text: its characters in links, the article, main part, inner article and container that hold it (0: none), and its block's name."""

    text: str
    linked: int
    article: int
    main: int
    nested: int
    container: int
    tag: str


def lines(page: str) -> tuple[list[Line], dict[int, tuple[int, int]]]:
    """The lines of a page in its order, without those in elements that never hold an article, and the first and last + 1 line of each container."""
    out: list[Line] = []
    held: list[str] = []
    root = _Open("", False, 0, 0, 0)
    stack, places = [root], {}  # places: for each tag the depths of its open blocks
    spans: dict[int, tuple[int, int]] = {}
    never, link, linked, numbers = 0, 0, 0, 0
    at, last, broken = 0, page.rfind(">"), False

    def end_line() -> None:
        nonlocal held, linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                top = stack[-1]
                out.append(Line(text, linked, top.article, top.main, top.nested, top.container, top.tag))
        held, linked = [], 0

    def say(piece: str) -> None:
        nonlocal linked
        if not never:
            piece = html.unescape(piece) if "&" in piece else piece
            held.append(piece)
            if link:
                linked += len(piece.strip())

    def end_inline(element: _Open, k: int) -> None:
        nonlocal never, link
        while len(element.inline) > k:
            tag, left_out = element.inline.pop()
            element.counts[tag] -= 1
            never -= left_out
            link -= tag == "a"

    def leave(depth: int) -> None:
        nonlocal never
        while len(stack) > depth:
            element = stack.pop()
            end_inline(element, 0)
            places[element.tag].pop()
            never -= element.left_out
            if element.container != stack[-1].container and element.tag not in ("html", "body"):
                spans[element.container] = spans[element.container][0], len(out)

    while True:
        start = page.find("<", at)
        if start < 0 or start > last:  # no tag ends any more
            say(page[at:])
            break
        if start > at:
            say(page[at:start])
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = end + 3 if end >= 0 else len(page)
            continue
        found = None if broken else _TAG.match(page, start)
        if found is None:
            if not broken and page[start + 1 : start + 2].isalpha():
                broken = True  # a quote that never ends: from here on quotes don't count
            found = _BROKEN_TAG.match(page, start)
        if found is None:
            if page[start + 1 : start + 2] in ("!", "?", "/"):
                at = page.find(">", start) + 1
            else:
                say("<")
                at = start + 1
            continue
        at = found.end()
        tag, block, top = found[2].lower(), found[2].lower() in _BLOCK, stack[-1]
        if found[1]:
            if block:
                end_line()
                if places.get(tag):
                    leave(places[tag][-1])
            elif top.counts.get(tag):
                end_inline(top, next(k for k in range(len(top.inline) - 1, -1, -1) if top.inline[k][0] == tag))
            continue
        if block:
            end_line()
            end_inline(top, 0)  # an inline element that was never closed ends with its line
            if top.tag == "p" and tag in _ENDS_P:
                leave(len(stack) - 1)
            if tag in _PEERS:
                peers, scope = _PEERS[tag]
                depth, bound = (max((places[x][-1] for x in some if places.get(x)), default=-1) for some in (peers, scope))
                if depth > bound:
                    leave(depth)
        if tag in _RAW:
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in _VOID or found[3].rstrip().endswith("/"):
            continue
        left_out, marks = _kind(tag, found[3])
        never += left_out
        top = stack[-1]
        if not block:
            top.inline.append((tag, left_out))
            top.counts[tag] = top.counts.get(tag, 0) + 1
            link += tag == "a"
            continue
        numbers += 1
        container = numbers if tag in _CONTAINER else top.container
        if container != top.container and tag not in ("html", "body"):
            spans[container] = len(out), len(out)
        inner = marks == "article" and top.article > 0
        article = top.article or (numbers if marks in ("article", "text") else 0)
        places.setdefault(tag, []).append(len(stack))
        stack.append(_Open(tag, left_out, article, top.main or (numbers if marks == "main" else 0), container, top.nested or (numbers if inner else 0)))
    end_line()
    leave(1)
    return out, spans


def _stretches(lengths: list[int], window: int) -> list[tuple[int, int, int]]:
    """(surge, dive, text between them) of a distribution of lengths over lines."""
    out, start, total = [], None, 0
    for k in range(len(lengths) + 1):
        total = total + lengths[k] - (lengths[k - window] if k >= window else 0) if k < len(lengths) else 0
        if total and start is None:
            start = k
        elif not total and start is not None:
            out.append((start, k, sum(lengths[start:k])))
            start = None
    return out


def _most(groups: dict[int, list[Line]], window: int) -> list[Line]:
    """Of several marked elements that whose stretches hold most text; of two the same the first."""
    return max(groups.values(), key=lambda g: sum(n for _, _, n in _stretches([len(x.text) for x in g], window)))


def _grouped(found: list[Line], name: str) -> dict[int, list[Line]]:
    out: dict[int, list[Line]] = {}
    for x in found:
        if getattr(x, name):
            out.setdefault(getattr(x, name), []).append(x)
    return out


def main_text(page: str, window: int = 3) -> str:
    """All lines of the article that the page marks, or else those of the stretch with most text and of the element that holds most of it, joined by one space.

    Of several articles the one with most text is the page's; an article inside another one that has paragraphs of its own before is a reader's comment."""
    found, spans = lines(page)
    articles = _grouped(found, "article")
    if articles:
        kept = _most(articles, window)
        own = next((k for k, x in enumerate(kept) if not x.nested and x.tag == "p"), len(kept))
        return " ".join(x.text for k, x in enumerate(kept) if not x.nested or k < own)
    if any(x.main for x in found):
        return " ".join(x.text for x in _most(_grouped(found, "main"), window))
    lengths = [len(x.text) if 2 * x.linked <= len(x.text) else 0 for x in found]
    surge, dive, most = max(_stretches(lengths, window), key=lambda s: s[2], default=(0, 0, 0))
    if not most:
        return ""
    held: dict[int, int] = {}
    for k in range(surge, dive):
        held[found[k].container] = held.get(found[k].container, 0) + lengths[k]
    home = max(held, key=lambda c: held[c])
    own = [k for k, x in enumerate(found) if lengths[k] and x.container == home]
    first, last = max(own[0], spans.get(home, (len(found), 0))[0]), min(own[-1], spans.get(home, (0, 0))[1])  # what stands amid the container's own lines is its, too
    inside = lambda k: found[k].container == home or first <= k <= last
    return " ".join(x.text for k, x in enumerate(found) if lengths[k] and (surge <= k < dive or inside(k)) or inside(k) and x.tag in ("p", "blockquote"))


def extract_main_text(pages: DataFrame, html_col: str = "html", window: int = 3) -> DataFrame:
    """The rows of pages with text, the main text of the whole html, empty if there is none. Null html counts as empty.

    Character references are decoded once, white space inside a block is one space, blocks are trimmed and joined by one space in page order. Repeated
    rows and null columns stay as they are; a column of pages that is named text is replaced. An empty table gives an empty one."""
    kept = [c for c in pages.columns if c != "text"]
    name = "html"
    while name in pages.columns:
        name = f"_{name}"

    def run(batches):
        for batch in batches:
            texts = [main_text(x.as_py() or "", window) for x in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*batch.schema.names[:-1], "text"])

    schema = pages.select(*kept).schema.add("text", "string")
    return pages.select(*kept, F.col(html_col).cast("string").alias(name)).mapInArrow(run, schema)
