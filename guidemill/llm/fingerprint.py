"""Document fingerprints: a Merkle tree over sections, paragraphs and blocks of words, in DataFrame functions only.

A text's paragraphs are its lines; a paragraph is cut into blocks of `block` words. A leaf is the 64-bit hash of a block, as 16 hexadecimal digits, white
space at its edge and a line's end included. A paragraph's node hashes its leaves, a section's node its paragraphs' nodes, the root the sections' nodes, each as
they are written. A section ends after a paragraph whose node begins with one of some digits, so that sections, like paragraphs, meet again after an
edit. The fingerprint writes the whole tree:

    root/section:paragraph=leaf leaf ...,paragraph=leaf ...,/section:...

Equal texts have equal roots; different texts have different ones unless two of their blocks have the same 64-bit hash (or nodes the same 96 bits).
Where two trees differ, locate() goes down the nodes that differ to the blocks that were edited.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAF, NODE, ROOT = 16, 24, 32  # hexadecimal digits
RANGES_MOST = 20_000  # ranges of ids that the documents are dealt into
RANGE_CHARS = 8_000_000  # characters of a range, on average, as long as there are fewer ranges than that


def _leaves(text: Column, block: int) -> Column:
    """Hashes of the blocks in order, a point behind those that end a paragraph; of a paragraph's last block the text has its line feed, if there is one."""
    pieces = F.regexp_extract_all(text, F.lit(rf"(?:[^ \n]* ){{0,{block - 1}}}[^ \n]*(?:[ \n]|$)"), F.lit(0))
    pieces = F.filter(pieces, lambda x: x != "")
    return F.transform(pieces, lambda x: F.concat(F.lpad(F.hex(F.xxhash64(x)), LEAF, "0"), F.when(x.endswith("\n"), ".").otherwise("")))


def _hash(children: Column, digits: int) -> Column:
    return F.substring(F.sha2(children, 256), 1, digits)


def _tree(leaves: Column, section_of: int) -> Column:
    """The written tree of marked leaves."""
    ends = list("0123456789abcdef"[:: min(16, section_of)])
    paragraphs = F.filter(F.split(F.array_join(leaves, " "), r"\.(?: |$)"), lambda x: x != "")
    noded = F.transform(paragraphs, lambda x: F.concat(_hash(x, NODE), F.lit("="), x))
    joined = F.array_join(F.transform(noded, lambda x: F.concat(x, F.when(F.substring(x, 1, 1).isin(ends), ",/").otherwise(","))), "")
    sections = F.filter(F.split(joined, "/"), lambda x: x != "")
    written = F.transform(sections, lambda x: F.concat(_hash(F.regexp_replace(x, "=[^,]*", ""), NODE), F.lit(":"), x))
    nodes = lambda x: F.array_join(F.transform(x, lambda s: F.substring(s, 1, NODE)), ",")
    return F.transform(F.array(written), lambda x: F.concat_ws("/", _hash(nodes(x), ROOT), x))[0]  # an array of one, so that the sections are made once


def fingerprint(text: Column, block: int = 8, section_of: int = 4) -> Column:
    """The fingerprint of a text; null and empty texts have the same one. A section has about section_of (at most 16) paragraphs."""
    return _tree(_leaves(F.coalesce(text, F.lit("")), block), section_of)


def root_of(one: Column) -> Column:
    return F.substring(one, 1, ROOT)


def likeness(one: Column, other: Column) -> Column:
    """Share of leaves that two fingerprints have in common: 2 * common / (distinct leaves of both), 1 for equal roots."""
    leaves = lambda x: F.array_distinct(F.filter(F.split(x, "[ ,:=/]"), lambda y: F.length(y) == LEAF))
    a, b = leaves(one), leaves(other)
    total = F.size(a) + F.size(b)
    share = 2 * F.size(F.array_intersect(a, b)) / F.when(total > 0, total)
    return F.when(root_of(one) == root_of(other), 1.0).otherwise(F.coalesce(share, F.lit(0.0)))


def locate(one: Column, other: Column) -> Column:
    """Where `one` has what `other` lacks: an array of (section, paragraph, block), numbers from 0; a paragraph's numbers begin anew in each section.

    Goes down only below sections and paragraphs whose nodes the other tree lacks. A null number says that the other tree has all parts of the one that
    differs, in another order or number. Equal roots give an empty array, a null fingerprint null. What `other` has besides is locate(other, one)."""
    sections = lambda x: F.slice(F.split(x, "/"), 2, F.greatest(F.size(F.split(x, "/")) - 1, F.lit(0)))
    paragraphs = lambda s: F.filter(F.split(F.substring(s, NODE + 2, 2**31 - 1), ","), lambda x: x != "")
    leaves = lambda p: F.split(F.substring(p, NODE + 2, 2**31 - 1), " ")
    start = lambda xs: F.transform(xs, lambda x: F.substring(x, 1, NODE))
    theirs = sections(other)
    every = F.flatten(F.transform(theirs, paragraphs))
    blocks = F.flatten(F.transform(every, leaves))
    # numbers of the parts whose node (or leaf) the other side lacks; one null if it has them all, in another order or number
    missing = lambda names, known: F.filter(F.transform(names, lambda x, k: F.when(F.array_contains(known, x), -1).otherwise(k)), lambda k: k >= 0)
    lacking = lambda names, known: F.transform(F.array(missing(names, known)), lambda x: F.when(F.size(x) > 0, x).otherwise(F.array(F.lit(None).cast("int"))))[0]
    below = lambda parts, k: F.coalesce(F.get(parts, k), F.lit(""))
    found = F.flatten(
        F.transform(
            lacking(start(sections(one)), start(theirs)),
            lambda i: F.flatten(
                F.transform(
                    lacking(start(paragraphs(below(sections(one), i))), start(every)),
                    lambda j: F.transform(lacking(F.filter(leaves(below(paragraphs(below(sections(one), i)), j)), lambda x: x != ""), blocks), lambda k: F.struct(i.alias("section"), j.alias("paragraph"), k.alias("block"))),
                )
            ),
        )
    )
    return F.when(root_of(one) == root_of(other), F.array().cast("array<struct<section:int,paragraph:int,block:int>>")).otherwise(found)


def _ranges(rows: DataFrame) -> tuple[Column, dict[str, list[int]], list[int]]:
    """A column with the number of the row's range, in descending order of id (null: last) and then of h; for each key (id and hash) that begins a range the
    ranges whose last row it follows, the first key follows the last range; and the ranges' numbers in order.

    An id, or its lack, that many rows have is cut by h into as many ranges as it fills."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chars, with_id, all_rows = rows.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("id"), F.count("*")).first()
    count = max(1, min(RANGES_MOST, max(least, chars // RANGE_CHARS)))
    shares = [k / count for k in range(1, count)]
    found = (rows.agg(F.percentile_approx("id", shares, 10 * count).alias("b")).first()["b"] if shares else None) or []
    bounds = sorted(set(found))
    often = {b: n for b in bounds if (n := found.count(b)) > 1} if len(bounds) < len(found) else {}
    place = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>"), lambda b: b >= F.col("id")))
    share = F.col("h") / float(1 << 64) + 0.5
    sub = lambda n: F.least(F.floor(share * n), n - 1)
    parts = F.lit(count)
    for b, n in often.items():
        parts = F.when(F.col("id") == b, sub(F.lit(n))).otherwise(parts)
    without = max(1, -(-(all_rows - with_id) * count // max(1, all_rows)))
    number = F.when(F.col("id").isNull(), (len(bounds) + 1) * (count + 1) + sub(F.lit(without))).otherwise(place * (count + 1) + parts).cast("int")
    order = F.struct((-F.col("id")).alias("m"), "h")
    firsts = rows.groupBy(number.alias("part")).agg(F.min(F.struct(order.alias("o"), _key().alias("k")))["k"].alias("k")).orderBy("part").collect()  # a row for each range
    after: dict[str, list[int]] = {}
    for k, (part, _) in enumerate(firsts):
        after.setdefault(firsts[(k + 1) % len(firsts)][1], []).append(part)
    return number, after, [part for part, _ in firsts]


def _key() -> Column:
    return F.concat_ws("|", F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("h").cast("string"))


def _apart(spark, parts: list[int]) -> dict[int, int]:
    """For each range a number that hash partitioning gives a partition of its own, as far as there are as many."""
    count = max(1, len(parts))
    found = spark.range(0, 16 * count).groupBy(F.pmod(F.hash(F.col("id").cast("int")), F.lit(count)).alias("p")).agg(F.min("id").cast("int").alias("k")).collect()  # a row for each range
    free = [k for _, k in sorted(map(tuple, found))]
    return {part: free[k % len(free)] for k, part in enumerate(parts)}


def document_fingerprints(docs: DataFrame, edited_share: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, text, edited_text, fingerprint, edited_fingerprint, near_edited, near_next for every row.

    The edited text has its last floor(n_chars / edited_share) code points replaced by the first as many, or all there are, of the next document:
    the next lower id, after the last one the first. near_edited and near_next are the likeness of the row's fingerprint to that of its edited
    text and of the next document, 0 to 1.

    Null text counts as empty and has the fingerprint of an empty text. Rows without an id come after all others. Rows with equal ids follow each other in
    order of a hash of their texts; equal rows follow each other too. A single row follows itself. An empty table gives an empty one. Other
    columns are not read.

    Texts move once: rows are dealt by ranges of id, at least as many as there are shuffle partitions, and each range also gets the row that follows its last."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    part, after, parts = _ranges(rows.select("id", "h", F.length("text").alias("n")))
    apart = _apart(docs.sparkSession, parts)
    table = lambda pairs, kind: F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), v)]) if pairs else F.lit(None).cast(kind)
    follows = table({k: F.array(*[F.lit(p) for p in some]) for k, some in after.items()}, "map<string,array<int>>")
    places = F.concat(F.array(F.struct(part.alias("part"), F.lit(0).alias("guest"))), F.transform(F.coalesce(F.try_element_at(follows, _key()), F.array().cast("array<int>")), lambda p: F.struct(p.alias("part"), F.lit(1).alias("guest"))))
    dealt = rows.select("id", "h", "text", F.explode(places).alias("at")).select("id", "h", "text", "at.part", "at.guest")
    dealt = dealt.withColumn("dealt", F.try_element_at(table({k: F.lit(v) for k, v in apart.items()}, "map<int,int>"), "part")).repartition(max(1, len(parts)), "dealt")
    dealt = dealt.withColumns({"n": F.length("text"), "fingerprint": fingerprint(F.col("text"))})
    inside = Window.partitionBy("dealt", "part").orderBy("guest", F.col("id").desc_nulls_last(), "h")
    both = dealt.withColumns({"next_text": F.lead("text").over(inside), "next_fingerprint": F.lead("fingerprint").over(inside)}).where("guest = 0")
    cut = F.floor(F.col("n") / edited_share).cast("int")
    edited = F.concat(F.left("text", F.col("n") - cut), F.left("next_text", cut))
    both = both.select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_chars"), "text", edited.alias("edited_text"), "fingerprint", "next_fingerprint").withColumn("edited_fingerprint", fingerprint(F.col("edited_text")))
    own, changed, following = F.col("fingerprint"), F.col("edited_fingerprint"), F.col("next_fingerprint")
    return both.select("doc_id", "n_chars", "text", "edited_text", own, changed, likeness(own, changed).alias("near_edited"), likeness(own, following).alias("near_next"))
