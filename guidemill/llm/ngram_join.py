"""N-gram Jaccard join: a grouped prefix join on word shingles.

1. Every text becomes a set of 64-bit shingle hashes; equal sets are one node.
2. A sketch of bounded size orders shingles from rare to frequent. A set's prefix is its n - ceil(t*n) + 1 rarest shingles: two sets whose
   Jaccard similarity reaches t share a shingle of their prefixes.
3. Nodes with the same prefix and size are one group; inverted lists hold groups. Sizes and places in the order filter group pairs.
4. Group pairs are expanded to their members; pairs whose prefixes share enough are verified on the whole sets.

Only components are asked for, so pairs that are already connected need no check. The first round checks every list's members against one of
them; the second round takes each pair of a list whose two sides are still apart, met by bands of size. No link between different components can be lost.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guidemill.llm.common import combined, components, remove, shingle_sets, written

SKETCH_BITS = 18  # the order's sketch has 2**18 cells of one byte, whatever the input
LOCAL_LEAST = 4  # a task reports shingles that it saw in so many of its documents
FILTER_BITS = 24  # the candidates' bitmap: 2 MB at most, whatever the input


def _local_counts(width: int):
    def run(batches):
        whole = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        held, size = [], 0

        def fold(whole, held):
            values, counts = np.unique(np.concatenate([whole[0], *held]), return_inverse=True)
            total = np.bincount(counts, weights=np.concatenate([whole[1], np.ones(len(counts) - len(whole[1]))]), minlength=len(values)).astype(np.int64)
            if len(values) > 600_000:  # bounded memory: once-seen shingles are the ones forgotten
                keep = total > 1
                return values[keep], total[keep]
            return values, total

        for batch in batches:
            for found in shingle_sets(batch.column(0), width):
                held.append(found)
                size += len(found)
                if size > 250_000:
                    whole, held, size = fold(whole, held), [], 0
        if held:
            whole = fold(whole, held)
        keep = whole[1] >= LOCAL_LEAST
        values, counts = whole[0][keep], whole[1][keep]
        for k in range(0, len(values), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(values[k : k + 100_000].view(np.int64)), pa.array(counts[k : k + 100_000])], ["h", "n"])

    return run


def _order_sketch(texts: DataFrame, width: int) -> bytes:
    """One byte for each of 2**SKETCH_BITS cells: log2 of the largest count of documents that a frequent shingle of the cell has.

    Any sketch gives a valid order, the same for all sets; a good one puts shingles of many documents last."""
    counts = texts.mapInArrow(_local_counts(width), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    cells = counts.groupBy((F.col("h").bitwiseAND((1 << SKETCH_BITS) - 1)).cast("int").alias("cell")).agg(F.floor(F.log2(F.max("n"))).cast("int").alias("level"))
    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    for cell, level in cells.collect():  # at most 2**SKETCH_BITS rows
        out[cell] = level
    return out.tobytes()


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def set_id(values: np.ndarray) -> int:
    """A 64-bit name of a set of shingles."""
    if not len(values):
        return 0
    return int(combined(np.array([len(values), np.bitwise_xor.reduce(combined(values, 1)), np.add.reduce(combined(values, 1))], np.uint64), 3).view(np.int64)[0])


def _signatures(width: int, percent: int, sketch: bytes):
    def run(batches):
        level = np.frombuffer(sketch, np.uint8)
        for batch in batches:
            ids, nodes, sizes, prefixes, names = batch.column(0), [], [], [], []
            for values in shingle_sets(batch.column(1), width):
                k = prefix_length(len(values), percent) if len(values) else 0
                order = np.lexsort((values, level[values & np.uint64((1 << SKETCH_BITS) - 1)]))[:k]
                prefix = values[order]
                nodes.append(set_id(values))
                sizes.append(len(values))
                prefixes.append(prefix.view(np.int64))
                names.append(set_id(prefix))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in prefixes])]).astype(np.int32)
            flat = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([ids, pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), flat], ["doc_id", "node", "n", "pname", "prefix"])

    return run


def _sets(width: int, bitmap: bytes):
    """The sets of rows whose id may be needed; a task gives each set once."""

    def run(batches):
        bits, mask, seen = np.frombuffer(bitmap, np.uint8), np.uint64(8 * len(bitmap) - 1), set()
        for batch in batches:
            ids = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), np.int64).view(np.uint64)
            at = (combined(ids, 1) & mask).astype(np.int64) if len(ids) else np.zeros(0, np.int64)
            rows = np.flatnonzero(bits[at >> 3] >> (at & 7) & 1)
            found = [(set_id(x), x.tobytes()) for x in shingle_sets(batch.column(1).take(pa.array(rows, pa.int64())), width)]
            found = [x for x in dict(found).items() if x[0] not in seen]
            seen.update(k for k, _ in found)
            ends = np.cumsum([len(x) for _, x in found]) // 4_000_000  # some MB in a batch, or one set
            for some in np.split(np.arange(len(found)), np.flatnonzero(np.diff(ends)) + 1) if found else ():
                yield pa.RecordBatch.from_arrays([pa.array([found[k][0] for k in some], pa.int64()), pa.array([found[k][1] for k in some], pa.binary())], ["node", "shingles"])

    return run


def _bits(size: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            at = np.unique((combined(ids, 1) & np.uint64((1 << size) - 1)).astype(np.int64)) if len(ids) else np.zeros(0, np.int64)
            word, inverse = np.unique(at >> 5, return_inverse=True)
            value = np.zeros(len(word), np.int64)
            np.bitwise_or.at(value, inverse, np.int64(1) << (at & 31))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(value)], ["word", "bits"])

    return run


def _bitmap(ids: DataFrame) -> bytes:
    """A bitmap that has every id's bit, about 16 bits for an id, at most 2**FILTER_BITS; others may be set too."""
    size = min(FILTER_BITS, max(10, (16 * ids.count()).bit_length()))
    out = np.zeros(1 << (size - 5), np.uint32)
    for word, bits in ids.mapInArrow(_bits(size), "word long, bits long").groupBy("word").agg(F.bit_or("bits")).collect():  # at most 2**(FILTER_BITS - 5) rows
        out[word] = bits
    return out.tobytes()


def _prefixes(bitmap: bytes):
    """node, n and prefix of rows whose id may be needed; a task gives each node once."""

    def run(batches):
        bits, mask, seen = np.frombuffer(bitmap, np.uint8), np.uint64(8 * len(bitmap) - 1), set()
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            at = (combined(ids, 1) & mask).astype(np.int64) if len(ids) else np.zeros(0, np.int64)
            nodes = batch.column(1).to_pylist()
            rows = []
            for k in np.flatnonzero(bits[at >> 3] >> (at & 7) & 1).tolist():
                if nodes[k] not in seen:
                    seen.add(nodes[k])
                    rows.append(k)
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(rows)) for k in (1, 2, 3)], ["node", "n", "prefix"])

    return run


def _shared_enough(pairs: DataFrame, marked: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose prefixes share enough for the similarity.

    Up to the end of the prefix that ends first in the order, all that two sets share is in both prefixes; beyond it, no more than what that set has
    there. So the overlap is at most what the prefixes share and the longer rest."""
    rows = marked.where("n > 0 and doc_id is not null").select("doc_id", "node", "n", "prefix")
    ends = written(rows.mapInArrow(_prefixes(_bitmap(_documents(pairs, nodes))), "node long, n long, prefix array<long>"), "prefixes")
    both = pairs.join(ends.toDF("v", "nv", "pv"), "v").join(ends.toDF("u", "nu", "pu"), "u")
    most = F.size(F.array_intersect("pu", "pv")) + F.greatest(F.col("nu") - F.size("pu"), F.col("nv") - F.size("pv"))
    out = written(both.where(most * (100 + percent) >= percent * (F.col("nu") + F.col("nv"))).select("u", "v").distinct(), "close")
    remove(ends)
    return out


def _documents(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The documents that stand for the nodes of pairs."""
    return pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct().join(nodes.select("node", "doc_id"), "node").select("doc_id")


def _verified(percent: int):
    def run(batches):
        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            keep = np.zeros(batch.num_rows, bool)
            for k in range(batch.num_rows):
                x, y = np.frombuffer(a[k].as_buffer(), np.uint64), np.frombuffer(b[k].as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                same = int(np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x))
                keep[k] = 100 * same >= percent * (len(x) + len(y) - same)
            rows = np.flatnonzero(keep)
            if len(rows):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows))], ["u", "v"])

    return run


def _verify(pairs: DataFrame, texts: DataFrame, marked: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (u, v) of nodes whose whole sets link. Sets are made again from the texts, only of documents that stand for a node in a pair."""
    pairs = written(pairs, "pairs")
    close = _shared_enough(pairs, marked, nodes, percent)
    remove(pairs)
    sets = written(texts.mapInArrow(_sets(width, _bitmap(_documents(close, nodes))), "node long, shingles binary"), "sets")
    both = close.join(sets.toDF("v", "sv"), "v").join(sets.toDF("u", "su"), "u").select("u", "v", "su", "sv")
    out = written(both.mapInArrow(_verified(percent), "u long, v long"), "links")
    remove(close)
    remove(sets)
    return out


def _may_link(percent: int, a: str, b: str):
    """Sizes and places of a shared shingle still allow the similarity: no more is shared than what follows it on either side."""
    n, m, i, j = F.col(f"{a}.n"), F.col(f"{b}.n"), F.col(f"{a}.pos"), F.col(f"{b}.pos")
    least = F.least(n - i, m - j) * (100 + percent) >= percent * (n + m)
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & least


def _apart_pairs(wide: DataFrame, percent: int) -> DataFrame:
    """u < v of nodes on one list (tok, node, n, pos, component) that are in different components and may still link by their sizes and places.

    A node that has the shared shingle at place pos of its order can share n - pos shingles at most, so it can link with sets of up to `most` = (n - pos) *
    (100 + percent) / percent - n shingles only. Of a pair the smaller set must allow the larger one, so its `most` isn't below its own size: most
    entries of long lists (shingles that many share come late in the order) are no smaller side, and two of them never meet. Bands of sizes are part of the
    key, so the rest meets only what its size and place allow."""
    band = lambda n: F.floor(F.log(n.cast("double")) * (2 / math.log(100 / percent)) + 1e-9) if percent < 100 else n
    most = F.floor(((F.col("n") - F.col("pos")) * (100 + percent)) / percent).cast("long") - F.col("n")
    rows = wide.withColumn("most", most)
    least = F.ceil(F.col("n") * percent / 100).cast("long")
    small = rows.where("most >= n").withColumn("band", band(F.col("n")).cast("long"))
    upper = F.least("n", "most")
    large = rows.withColumn("least", least).where(upper >= F.col("least")).withColumn("band", F.explode(F.sequence(band(F.col("least")).cast("long"), band(upper).cast("long"))))
    a, b = small.alias("a"), large.alias("b")
    met = a.join(b, (F.col("a.tok") == F.col("b.tok")) & (F.col("a.band") == F.col("b.band")) & (F.col("a.component") != F.col("b.component")) & F.col("a.n").between(F.col("b.least"), F.least("b.n", "b.most")) & (F.col("b.n") <= F.col("a.most")) & ((F.col("a.n") < F.col("b.n")) | (F.col("a.node") < F.col("b.node"))))
    return met.select(F.least("a.node", "b.node").alias("u"), F.greatest("a.node", "b.node").alias("v")).distinct()


def ngram_jaccard_join(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Words are [^\\x20\\x09-\\x0D]+ after lower-casing A-Z. A text's set is its distinct shingles of `width` words, or all its words as one if it
    has fewer. Two texts link when their sets' Jaccard similarity is at least percent / 100. component_id is the smallest id that links reach.

    Null or word-less texts have no shingles and link with nothing. Rows with equal ids are separate; equal rows link with each other. A row
    without an id is kept, links with nothing and has no component_id. Other columns, whatever their names, are not read."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    named = rows.where("doc_id is not null")
    sketch = _order_sketch(named.select("text"), width)
    marked = written(rows.mapInArrow(_signatures(width, percent, sketch), "doc_id long, node long, n long, pname long, prefix array<long>"), "marked")
    nodes = written(marked.where("n > 0 and doc_id is not null").groupBy("node", "n", "pname").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")), "nodes")

    # groups: the same prefix and size; a group is named by its member with the smallest document
    groups = nodes.groupBy("n", "pname").agg(F.min(F.struct("doc_id", "node")).alias("g"), F.sum("copies").alias("copies"), F.count("*").alias("members"))
    groups = written(groups.select("n", "pname", F.col("g.node").alias("g"), F.col("g.doc_id").alias("doc_id"), "copies", "members"), "groups")
    lists = marked.join(groups, ["n", "pname", "doc_id"]).dropDuplicates(["g"]).select("g", "n", F.posexplode("prefix").alias("pos", "tok"))
    lists = written(lists.select("tok", "g", (F.shiftleft("n", 32) + F.col("pos")).alias("np")), "lists")  # n and pos in one number: half the bytes to move
    shared = lists.groupBy("tok").agg(F.count("*").alias("k")).where("k > 1").select("tok")
    shared = written(lists.join(shared.hint("shuffle_hash"), "tok", "left_semi").select("tok", "g", F.shiftright("np", 32).alias("n"), F.col("np").bitwiseAND((1 << 32) - 1).alias("pos")), "met")
    remove(lists)
    pivots = shared.join(groups.select("g", "copies"), "g").groupBy("tok").agg(F.min(F.struct((-F.col("copies")).alias("c"), "pos", "g", "n")).alias("p"))

    members = nodes.join(groups.where("members > 1").select("n", "pname", "g"), ["n", "pname"]).select("g", "node", "n")
    first = shared.join(pivots, "tok").where("g <> p.g").select(F.struct("n", "pos").alias("a"), F.col("p").alias("b"), "g").where(_may_link(percent, "a", "b")).select(F.col("b.g").alias("u"), F.col("g").alias("v"))
    first = first.union(members.where("node <> g").select("g", "node"))
    pairs = first.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    pairs = written(pairs, "first")
    links = _verify(pairs, named, marked, nodes, width, percent)
    comp = written(components(links), "comp")

    # second round, on members: lists whose members are still in more than one component
    wide = shared.select("tok", "g", "n", "pos").join(members.select("g", "node"), "g", "left").select("tok", F.coalesce("node", "g").alias("node"), "n", "pos")
    wide = wide.union(members.select(F.xxhash64(F.lit("group"), "g").alias("tok"), "node", "n", F.lit(0).cast("long").alias("pos")))
    wide = wide.join(comp, "node", "left").select("tok", "node", "n", "pos", F.coalesce("component", "node").alias("component"))
    apart = wide.groupBy("tok").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("tok")
    wide = written(wide.join(apart.hint("shuffle_hash"), "tok", "left_semi"), "apart")
    second = _apart_pairs(wide, percent).join(pairs, ["u", "v"], "left_anti")
    more = _verify(second, named, marked, nodes, width, percent)
    final = components(links.union(more))
    slim = written(marked.select("doc_id", "node", "n"), "slim")
    remove(marked)
    out = _result(slim, nodes, final)
    for x in (shared, pairs, comp, wide):
        remove(x)
    return out


def _result(slim: DataFrame, nodes: DataFrame, comp: DataFrame) -> DataFrame:
    named = nodes.join(comp, "node", "left").select("node", "doc_id", F.coalesce("component", "node").alias("component"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_node = named.join(least, "component").select("node", "component_id")
    rows = slim.select("doc_id", "node", F.col("n").alias("n_shingles"))
    linked = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    return rows.join(by_node, "node", "left").select("doc_id", "n_shingles", F.when(linked, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
