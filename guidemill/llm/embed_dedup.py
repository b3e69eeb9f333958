"""Embedding near-duplicates through an inverted multi-index.

Each half of a unit vector has a codebook of its own; the product of the two is a grid of cells, and every vector is listed in the cell of its two
nearest codewords. The neighbours of a vector lie in few cells: a multi-sequence traversal visits cells in order of how near the vector is to them,
and goes on until a share of `recall` of its neighbours would be met. Nearness is the sum over both halves of the squared distance to the plane between
the nearest codeword and the cell's: no vector of the cell is nearer than that. So at 2 - 2 * threshold the traversal is exact (recall 1).

The stop is measured when the index is fitted: on all real neighbours of `QUERIES` sampled rows, found by comparing those with every row, counted by
link and by row; and on made-up neighbours at exactly the threshold, in random directions and in directions that the data itself has. The largest
counts. What a traversal meets is verified by cosine in double precision.

Cells are cut into blocks of bounded size, and pairs of blocks are compared as matrices, each pair of blocks a group of its own: a hot cell is many
tasks, and no pair of vectors is written as a row. From a pair of blocks come counts of links and a spanning forest of them. Equal vectors are one node
with a number of copies.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guidemill.llm.common import components, remove, written

SAMPLE = 16_384  # rows that the codebooks and the stop are fitted on, at most; a fourth of it is the most codewords a half can have
LISTED = 48  # vectors that a cell lists on average, as long as there are codewords enough
TRIALS = 4_096  # made-up neighbours that the stop is measured on, at least
QUERIES = 512  # sampled rows whose real neighbours the stop is measured on
BINS = 200  # steps of the stop
BLOCK = 1_024  # vectors of a cell in one block, on average at most
GUESTS = 4_096  # visitors of a cell in one block


def _codebook(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    chance = np.random.default_rng(5)
    centres = x[chance.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = np.concatenate([_distances(x[a : a + 1024], centres).argmin(1) for a in range(0, len(x), 1024)])
        count = np.bincount(near, minlength=k)
        total = np.stack([np.bincount(near, x[:, d], minlength=k) for d in range(x.shape[1])], 1)
        lost = np.flatnonzero(count == 0)
        centres = total / np.maximum(1, count)[:, None]
        centres[lost] = x[chance.integers(len(x), size=len(lost))]
    return centres


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None, :])


def _nearness(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest codeword of each row, and the squared distance of the row to the plane between that one and each other."""
    d = _distances(x, centres)
    near = d.argmin(1)
    rows = np.arange(len(x))
    apart = _distances(centres[near], centres)
    beyond = d - d[rows, near][:, None]
    out = beyond * beyond / (4 * np.maximum(apart, 1e-12))
    out[rows, near] = 0
    return near, out


class Index:
    """Two codebooks and the stop of the traversal."""

    def __init__(self, sample: np.ndarray, threshold: float, recall: float, codewords: int):
        half = sample.shape[1] // 2
        k = max(1, min(codewords, len(np.unique(sample, axis=0))))
        self.half, self.one, self.two = half, _codebook(sample[:, :half], k), _codebook(sample[:, half:], k)
        self.threshold, self.recall, self.exact = threshold, recall, 2 - 2 * threshold + 1e-9
        self.stop = self.exact if recall >= 1 else self._trials(sample)

    def _trials(self, sample: np.ndarray) -> float:
        chance = np.random.default_rng(7)
        sample = np.tile(sample, (-(-TRIALS // len(sample)), 1))
        stops = []
        for away in (chance.standard_normal(sample.shape), sample[chance.permutation(len(sample))] - sample[chance.permutation(len(sample))]):
            away -= (away * sample).sum(1)[:, None] * sample
            size = np.linalg.norm(away, axis=1)
            some = size > 1e-6
            if some.any():
                near = self.threshold * sample[some] + math.sqrt(1 - self.threshold**2) * away[some] / size[some][:, None]
                stops.append(float(np.quantile(self.between(sample[some], near), self.recall)))
        return min(self.exact, max(stops, default=self.exact) + 1e-9)

    def measure(self, counts: np.ndarray) -> None:
        """Raise the stop to what real links need; counts: for each sampled row, of its links, how many need a stop in each of BINS steps up to the exact one."""
        counts = counts[counts.sum(1) > 0]
        if len(counts) and self.recall < 1:
            by_link = np.cumsum(counts.sum(0)) / counts.sum()
            by_row = np.cumsum((counts / counts.sum(1)[:, None]).mean(0))
            steps = max(int(np.searchsorted(x, self.recall - 1e-12)) + 1 for x in (by_link, by_row))
            self.stop = max(self.stop, min(steps, BINS) * self.exact / BINS)

    def sides(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _nearness(x[:, : self.half], self.one)[1], _nearness(x[:, self.half :], self.two)[1]

    def slices(self, n: int) -> range:
        """Where slices of rows begin whose nearness to all codewords takes some MB."""
        return range(0, n, self.rows_at_once)

    @property
    def rows_at_once(self) -> int:
        return max(1, 500_000 // len(self.one))

    def cells(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        for a in self.slices(len(x)):
            some = x[a : a + self.rows_at_once]
            out[a : a + len(some)] = _distances(some[:, : self.half], self.one).argmin(1) * len(self.two) + _distances(some[:, self.half :], self.two).argmin(1)
        return out

    def to_cells(self, x: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """How near the k-th row is to the k-th cell."""
        out = np.zeros(len(x))
        for a in self.slices(len(x)):
            some, (one, two) = x[a : a + self.rows_at_once], np.divmod(cells[a : a + self.rows_at_once], len(self.two))
            p, q = self.sides(some)
            rows = np.arange(len(some))
            out[a : a + len(some)] = p[rows, one] + q[rows, two]
        return out

    def between(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The stop at which the k-th rows meet: the traversal of either side meets the other."""
        return np.minimum(self.to_cells(x, self.cells(y)), self.to_cells(y, self.cells(x)))

    def visited(self, x: np.ndarray) -> list[np.ndarray]:
        """The cells that the traversal from each vector visits: all that are as near as the stop.

        In order of the two sorted sequences, (i, j) comes after (i - 1, j) and (i, j - 1), so for each i the j form a run that only gets shorter. The stop
        being fixed, the cells are given run by run."""
        out = []
        for k in self.slices(len(x)):
            for a, b in zip(*self.sides(x[k : k + self.rows_at_once]), strict=True):
                i, j = np.flatnonzero(a <= self.stop), np.flatnonzero(b <= self.stop)
                i, j = i[a[i].argsort(kind="stable")], j[b[j].argsort(kind="stable")]
                near = a[i][:, None] + b[j][None, :] <= self.stop
                p, q = np.nonzero(near)
                out.append(i[p] * len(b) + j[q])
        return out


def _matrix(column, dim: int) -> np.ndarray:
    """An Arrow list column without nulls as a matrix of its own type."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x /= np.maximum(np.abs(x).max(1), 1e-300)[:, None]
    return x / np.sqrt((x * x).sum(1))[:, None]


def _measured(index: Index, dim: int, nodes: np.ndarray, queries: np.ndarray):
    """For each sampled row and step of the stop, how many of its links need it, by batch."""

    def run(batches):
        home, toward = index.cells(queries), index.sides(queries)
        for batch in batches:
            total = np.zeros((len(queries), BINS), np.int64)
            for at in range(0, batch.num_rows, 2_000):
                some = batch.slice(at, 2_000)
                node, x = some.column(0).to_numpy(), _unit(_matrix(some.column(1), dim))
                r, q = np.nonzero((x @ queries.T >= index.threshold) & (node[:, None] != nodes[None, :]))
                one, two = np.divmod(index.cells(x)[r], len(index.two))
                need = np.minimum(toward[0][q, one] + toward[1][q, two], index.to_cells(x[r], home[q]))
                np.add.at(total, (q, np.minimum((need / index.exact * BINS).astype(int), BINS - 1)), 1)
            q, step = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(step, pa.int32()), pa.array(total[q, step])], ["query", "step", "n"])

    return run


def _counted(index: Index, dim: int):
    """How many vectors each cell lists, and how many visit it, by batch."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = _unit(_matrix(batch.column(0), dim))
                for guest, cells in ((False, index.cells(x)), (True, np.concatenate(index.visited(x)))):
                    cell, n = np.unique(cells, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array([guest] * len(cell)), pa.array(n, pa.int64())], ["cell", "guest", "n"])

    return run


def _dealt(index: Index, dim: int):
    """A row for each vector in its own cell, and one, as a guest, for each cell that it visits."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = _matrix(batch.column(2), dim)
            node, copies, x = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _unit(raw)
            home, visits = index.cells(x), index.visited(x)
            width = raw.dtype.itemsize * dim
            for guest, rows, cells in ((False, np.arange(len(x)), home), (True, np.repeat(np.arange(len(x)), [len(v) for v in visits]), np.concatenate(visits))):
                for k in range(0, len(rows), 20_000):
                    some, cell = rows[k : k + 20_000], cells[k : k + 20_000]
                    data = raw[some].tobytes()
                    vector = pa.array([data[i * width : (i + 1) * width] for i in range(len(some))], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array([guest] * len(some)), pa.array(node[some]), pa.array(copies[some]), pa.array(home[some], pa.int64()), vector], ["cell", "guest", "node", "copies", "home", "vector"])

    return run


def _side(table: pa.Table, guest: bool, dim: int, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """node, copies, home and unit vectors of the listed or the visiting rows of a pair of blocks."""
    rows = table.filter(table.column("guest") if guest else pc.invert(table.column("guest")))
    vectors = np.frombuffer(b"".join(rows.column("vector").to_pylist()), kind).reshape(-1, dim)
    return *(rows.column(c).to_numpy() for c in ("node", "copies", "home")), _unit(vectors) if len(vectors) else vectors


def _compared(index: Index, dim: int, kind):
    """For a pair of blocks of a cell, listed and guests: the links that each node has by it, and a spanning forest: (node, links, other)."""
    names = ["node", "links", "other"]

    def run(table: pa.Table) -> pa.Table:
        nothing = pa.table({c: pa.array([], pa.int64()) for c in names})
        cell = table.column("cell")[0].as_py()
        (node, copies, _, x), (guest, guest_copies, guest_home, y) = _side(table, False, dim, kind), _side(table, True, dim, kind)
        if not len(node) or not len(guest):
            return nothing
        linked = x @ y.T >= index.threshold
        linked &= (guest_home != cell)[None, :] | (node[:, None] < guest[None, :])  # inside a cell each pair once
        r, c = np.nonzero(linked.any(1))[0], np.nonzero(linked.any(0))[0]
        if not len(r):
            return nothing
        linked = linked[np.ix_(r, c)]
        # a pair that the traversals of both sides meet counts where the guest's cell is the lower one
        above = np.flatnonzero(guest_home[c] > cell)
        if len(above):
            one, two = np.divmod(guest_home[c][above], len(index.two))
            for k in index.slices(len(r)):
                a, b = index.sides(x[r[k : k + index.rows_at_once]])
                linked[k : k + len(a), above] &= a[:, one] + b[:, two] > index.stop
        node, copies, guest, guest_copies = node[r], copies[r], guest[c], guest_copies[c]
        label = np.arange(len(node))
        while True:
            by_guest = np.where(linked, label[:, None], len(node)).min(0)
            after = np.minimum(label, np.where(linked, by_guest[None, :], len(node)).min(1))
            if (after == label).all():
                break
            label = after
        ids = np.concatenate([node, guest])
        links = np.concatenate([linked @ guest_copies, copies @ linked])
        other = np.append(node, -1)[np.concatenate([label, by_guest])]
        keep = links > 0
        return pa.table({c: pa.array(x[keep], pa.int64()) for c, x in zip(names, (ids, links, other), strict=True)})

    return run


def _fitted(nodes: DataFrame, dim: int, threshold: float, recall: float, sample: int) -> Index:
    count = nodes.count()
    picked = nodes.select("node", "embedding").orderBy(F.xxhash64("embedding"), "node").limit(sample).collect()
    units = _unit(np.array([r["embedding"] for r in picked]))
    index = Index(units, threshold, recall, max(4, min(sample // 4, math.isqrt(count // LISTED))))
    if recall < 1:
        ids, queries = np.array([r["node"] for r in picked[:QUERIES]]), units[:QUERIES]
        found = nodes.select("node", "embedding").mapInArrow(_measured(index, dim, ids, queries), "query int, step int, n long").groupBy("query", "step").agg(F.sum("n").alias("n"))
        counts = np.zeros((len(queries), BINS))
        for query, step, n in found.collect():  # at most QUERIES * BINS rows
            counts[query, step] = n
        index.measure(counts)
    return index


def embedding_near_duplicates(vectors: DataFrame, threshold: float = 0.9, recall: float = 0.98, sample: int = SAMPLE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors.

    Rows link if the cosine of their vectors is at least threshold; none below it does. Of the links, a share of about recall is found, measured as the
    module says; recall=1 finds all. n_links counts the other rows linked directly, component_id is the smallest id that links reach, kept says that
    it is the row's own.

    The table's dimension is the most frequent length of its usable vectors (of two, the greater). Vectors that are null, zero, of another length, or
    that hold null or non-finite components link with nothing, as do rows without an id, whose component_id is null and which aren't kept. Rows with
    equal ids are separate rows; equal rows link with each other. Other columns are not read. An empty table gives an empty one."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    kind = np.float32 if rows.schema["embedding"].dataType.elementType.typeName() == "float" else np.float64
    if kind is np.float64:
        rows = rows.withColumn("embedding", F.col("embedding").cast("array<double>"))
    fine = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists("embedding", lambda x: x != 0)
    rows = rows.withColumn("embedding", F.when(F.coalesce(fine, F.lit(False)) & F.col("vec_id").isNotNull(), F.col("embedding")))
    usable = rows.where("embedding is not null")
    lengths = usable.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    alone = lambda df: df.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    if lengths is None:
        return alone(rows)
    dim = lengths["dim"]
    # equal vectors meet by 128 bits of hashes, which are all of a row that moves for the last join
    rows = rows.withColumns({"fits": F.coalesce(F.size("embedding") == dim, F.lit(False)), "h": F.xxhash64("embedding"), "g": F.xxhash64(F.lit(1), "embedding")})
    nodes = rows.where("fits").groupBy("h", "g").agg(F.first("embedding").alias("embedding"), F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    index = _fitted(nodes, dim, threshold, recall, sample)

    sizes = nodes.select("embedding").mapInArrow(_counted(index, dim), "cell long, guest boolean, n long")
    blocks = lambda guest, most: F.greatest(F.lit(1), F.ceil(F.sum(F.when(F.col("guest") == guest, F.col("n")).otherwise(0)) / most)).cast("long")
    hot = sizes.groupBy("cell").agg(blocks(False, BLOCK).alias("blocks"), blocks(True, GUESTS).alias("guest_blocks"))
    hot = written(hot.where("blocks > 1 or guest_blocks > 1"), "hot")
    dealt = nodes.select("node", "copies", "embedding").mapInArrow(_dealt(index, dim), "cell long, guest boolean, node long, copies long, home long, vector binary").join(hot, "cell", "left")
    blocks, guest_blocks, own = F.coalesce("blocks", F.lit(1)), F.coalesce("guest_blocks", F.lit(1)), F.xxhash64("node")
    every = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    dealt = dealt.select("cell", "guest", "node", "copies", "home", "vector", F.when(F.col("guest"), every(blocks)).otherwise(F.array(F.pmod(own, blocks))).alias("b"), F.when(F.col("guest"), F.array(F.pmod(own, guest_blocks))).otherwise(every(guest_blocks)).alias("g"))
    pairs = dealt.withColumn("b", F.explode("b")).withColumn("g", F.explode("g"))
    found = written(pairs.groupBy("cell", "b", "g").applyInArrow(_compared(index, dim, kind), "node long, links long, other long"), "found")

    comp = components(found.where("other >= 0 and node <> other").select(F.col("node").alias("u"), F.col("other").alias("v")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    linked = nodes.drop("embedding").join(links, "node", "left").join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = written(linked.join(least, "component").select("h", "g", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"), "component_id"), "linked")
    for x in (nodes, found, hot):
        remove(x)
    out = rows.where("fits").select("vec_id", "h", "g").join(linked, ["h", "g"]).select("vec_id", "n_links", "component_id")
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id")).unionByName(alone(rows.where("not fits")))
