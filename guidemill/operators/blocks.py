"""Schedules compared block by block: the ids of two blocks meet in a worker's memory, so rows that they share are neither joined nor dealt out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from guidemill.sources.tables import written

BLOCK = 8192  # ids of a block, about
PIECE = 256  # members of a class that come together
TASKS = 10_000  # at most
ROWS = 1 << 17  # of a batch that is given back, about


def _dealt(prints: DataFrame, classes: DataFrame | None) -> DataFrame:
    """Each id, or piece of a class, once for each block that its own one meets, itself included; the rows of two blocks (group) are neighbours."""
    whole = F.col("title").isNotNull() & F.col("bucket").isNotNull()
    ids = prints.where("epg_id is not null").groupBy("epg_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_set(F.when(whole, F.struct("title", "bucket")))).alias("said"))
    some = ids.join(classes.select(F.col("node").alias("epg_id"), "members"), "epg_id") if classes is not None else ids.withColumn("members", F.array("epg_id"))
    some = some.select("*", F.explode(F.sequence(F.lit(1), F.size("members"), F.lit(PIECE))).alias("at"))
    pieces = some.select(F.col("epg_id").alias("node"), F.slice("members", F.col("at"), PIECE).alias("members"), "n", F.col("said.title").alias("titles"), F.col("said.bucket").cast("array<long>").alias("buckets"), "at")
    pieces = written(pieces, "pieces")
    total = pieces.agg(F.sum(F.size("members"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK))
    groups = blocks * (blocks + 1) // 2
    met = pieces.withColumn("block", F.pmod(F.xxhash64("node", "at"), F.lit(blocks))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    high, low = F.greatest("block", "other"), F.least("block", "other")
    met = met.select((F.expr("greatest(block, other) * (greatest(block, other) + 1) div 2") + low).alias("group"), "block", (high == low).alias("own"), "node", "members", "n", "titles", "buckets")
    tasks = min(groups, TASKS)
    return met.repartitionById(tasks, F.pmod("group", F.lit(tasks)).cast("int")).sortWithinPartitions("group")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        group = batch.column("group").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
        for at, to in zip(cuts, cuts[1:]):
            if held and group[at] != last:
                yield pa.Table.from_batches(held)
                held = []
            last = group[at]
            held.append(batch.slice(at, to - at))
    if held:
        yield pa.Table.from_batches(held)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, size of them."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class _Lists:
    """For each of the sorted `keys`, the entries that have it, in order."""

    def __init__(self, keys: np.ndarray, have: list[np.ndarray], entries: np.ndarray, size: int):
        found = []
        for some in have:
            at = np.minimum(np.searchsorted(keys, some), len(keys) - 1)
            hit = keys[at] == some
            found.append(at[hit] * size + entries[hit])
        self.size, self.codes = size, np.unique(np.concatenate(found))
        self.ends = np.searchsorted(self.codes, np.arange(1, len(keys) + 1) * size)
        self.entries = self.codes % size

    def of(self, places: np.ndarray, least: int) -> list[np.ndarray]:
        """The entries from `least` on, for each place of a key."""
        starts = np.searchsorted(self.codes, places * self.size + least)
        return [self.entries[a:b] for a, b in zip(starts.tolist(), self.ends[places].tolist())]


class _Side:
    """Entries of one block, those with the smallest last member first; keys are numbers of title and bucket, more than 2 * tolerance apart for two titles."""

    def __init__(self, rows: np.ndarray, ranks: np.ndarray, starts: np.ndarray, sizes: np.ndarray, n: np.ndarray, keys: np.ndarray, key_starts: np.ndarray, key_sizes: np.ndarray):
        last = ranks[starts[rows] + sizes[rows] - 1]
        self.rows = rows = rows[np.argsort(last, kind="stable")]
        self.first, self.last = ranks[starts[rows]], np.sort(last)
        self.starts, self.sizes, self.n = starts[rows], sizes[rows], n[rows]
        self.single = bool((self.sizes == 1).all())
        self.key_sizes = key_sizes[rows]
        self.keys = keys[_ranges(key_starts[rows], self.key_sizes)]
        self.entries = np.repeat(np.arange(len(rows)), self.key_sizes)
        self.key_ends = np.cumsum(self.key_sizes)


def _walked(walkers: _Side, targets: _Side, tolerance: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each walker, the targets with a later member and how many of its rows, in order, find one of theirs: each takes the nearest that is left, of two the earlier.

    A row that is over twice the tolerance away from all others of its title takes none that they could; only rows nearer than that are walked one by one."""
    size = len(targets.rows)
    if not len(walkers.keys) or not len(targets.keys):
        return
    known = np.unique(walkers.keys)
    near = _Lists(known, [targets.keys + d for d in range(-tolerance, tolerance + 1)], targets.entries, size)
    step = np.zeros(size, np.int64)
    steps = 0
    apart = np.ones(len(walkers.keys), bool)
    if tolerance:
        exact_keys = np.unique(targets.keys)
        exact = _Lists(exact_keys, [targets.keys], targets.entries, size)
        order = [0] + [s * d for d in range(1, tolerance + 1) for s in (-1, 1)]
        close = (np.diff(walkers.keys) <= 2 * tolerance) & (np.diff(walkers.entries) == 0)
        apart[1:] &= ~close
        apart[:-1] &= ~close
    places = np.searchsorted(known, walkers.keys)
    froms = np.searchsorted(targets.last, walkers.first, "right").tolist()
    at = 0
    for e, (least, to) in enumerate(zip(froms, walkers.key_ends.tolist())):
        begin, at = at, to
        if least >= size or begin == to:
            continue
        alone = apart[begin:to]
        found = near.of(places[begin:to][alone], least)
        counts = np.bincount(np.concatenate(found), minlength=size) if found else np.zeros(size, np.int64)
        if not alone.all():
            gone: dict[int, np.ndarray] = {}
            for key in walkers.keys[begin:to][~alone].tolist():
                steps += 1
                for d in order:
                    k = int(np.searchsorted(exact_keys, key + d))
                    if k == len(exact_keys) or exact_keys[k] != key + d:
                        continue
                    those = exact.of(np.array([k]), least)[0]
                    left = gone.setdefault(k, np.ones(len(those), bool))
                    free = left & (step[those] != steps)
                    taken = those[free]
                    step[taken] = steps
                    counts[taken] += 1
                    left[free] = False
        met = np.flatnonzero(counts)
        if len(met):
            yield e, met, counts[met]


def _sides(rows: pa.Table, tolerance: int) -> tuple[pa.Array, np.ndarray, pa.Array, list[_Side]]:
    """Members, their order, the entries' nodes, and the one or two blocks of a group."""
    columns = {c: rows.column(c).combine_chunks() for c in ("members", "titles", "buckets", "node")}
    sizes, key_sizes = (pc.list_value_length(columns[c]).to_numpy().astype(np.int64) for c in ("members", "titles"))
    members = columns["members"].flatten()
    ranks = np.empty(len(members), np.int64)
    ranks[pc.sort_indices(members).to_numpy()] = np.arange(len(members))
    buckets = columns["buckets"].flatten().to_numpy(zero_copy_only=False)
    titles = columns["titles"].flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    low = int(buckets.min()) if len(buckets) else 0
    span = int(buckets.max()) - low + 1 + 2 * tolerance if len(buckets) else 1
    keys = titles * span + (buckets - low + tolerance)
    entry = np.repeat(np.arange(len(key_sizes)), key_sizes)
    keys = keys[np.lexsort((keys, entry))]
    starts, key_starts = np.cumsum(sizes) - sizes, np.cumsum(key_sizes) - key_sizes
    block, n = rows.column("block").to_numpy(), rows.column("n").to_numpy()
    return members, ranks, columns["node"], [_Side(np.flatnonzero(block == b), ranks, starts, sizes, n, keys, key_starts, key_sizes) for b in np.unique(block)]


def _meetings(rows: pa.Table, sides: list[_Side]) -> list[tuple[_Side, _Side]]:
    if rows.column("own")[0].as_py():
        return [(sides[0], sides[0])]
    return [(sides[0], sides[1]), (sides[1], sides[0])] if len(sides) == 2 else []


def _alike(same: np.ndarray, most: np.ndarray) -> np.ndarray:
    """An order in which equal counts are neighbours. There are few of them, so columnar files keep them, and their shares, as runs that hardly take room."""
    code = same * (int(most.max()) + 1) + most
    return np.argsort(code.astype(np.uint16) if code.max() < 1 << 16 else code, kind="stable")  # 16 bits are sorted by their digits


def _pairs(tolerance: int, places: int | None) -> Callable:
    def run(batches):
        for rows in _groups(batches):
            members, ranks, _, sides = _sides(rows, tolerance)
            for walkers, targets in _meetings(rows, sides):
                held, size = [], 0
                for e, met, same in _walked(walkers, targets, tolerance):
                    most = np.maximum(walkers.n[e], targets.n[met])
                    order = _alike(same, most)
                    met, same, most = met[order], same[order], most[order]
                    if targets.single:
                        those = targets.starts[met]
                    else:
                        those = _ranges(targets.starts[met], targets.sizes[met])
                        same, most = np.repeat(same, targets.sizes[met]), np.repeat(most, targets.sizes[met])
                    for a in range(walkers.starts[e], walkers.starts[e] + walkers.sizes[e]):
                        if targets.single and walkers.sizes[e] == 1:
                            held.append((a, those, same, most))
                        else:
                            later = ranks[those] > ranks[a]
                            held.append((a, those[later], same[later], most[later]))
                        size += len(held[-1][1])
                        if size >= ROWS:
                            yield _batch(members, held, places)
                            held, size = [], 0
                if size:
                    yield _batch(members, held, places)

    return run


def _batch(members: pa.Array, held: list[tuple], places: int | None) -> pa.RecordBatch:
    a = np.repeat([x[0] for x in held], [len(x[1]) for x in held])
    b, same, most = (np.concatenate([x[k] for x in held]) for k in (1, 2, 3))
    # half up of the exact quotient, as the decimal nearest to it is rounded
    share = same / most if places is None else (2 * same * 10**places + most) // (2 * most) / 10**places
    return pa.RecordBatch.from_arrays([members.take(pa.array(a)), members.take(pa.array(b)), pa.array(same.astype(np.int64)), pa.array(share)], ["a", "b", "same", "similarity"])


def _linked(tolerance: int, least: float) -> Callable:
    def run(batches):
        for rows in _groups(batches):
            _, _, nodes, sides = _sides(rows, tolerance)
            part = np.arange(rows.num_rows)
            parts, a, b = rows.num_rows, [], []
            for walkers, targets in _meetings(rows, sides):
                if parts == 1:
                    break
                for e, met, same in _walked(walkers, targets, tolerance):
                    those = targets.rows[met[same / np.maximum(walkers.n[e], targets.n[met]) >= least]]
                    mine = part[walkers.rows[e]]
                    others, where = np.unique(part[those], return_index=True)
                    where = where[others != mine]
                    if not len(where):
                        continue
                    a += [int(walkers.rows[e])] * len(where)
                    b += those[where].tolist()
                    part[np.isin(part, others)] = mine
                    parts -= len(where)
                    if parts == 1:
                        break
            if a:
                yield pa.RecordBatch.from_arrays([nodes.take(pa.array(a)), nodes.take(pa.array(b))], ["a", "b"])

    return run


def _schema(prints: DataFrame, *more: str) -> StructType:
    kind = prints.schema["epg_id"].dataType
    out = StructType([StructField("a", kind), StructField("b", kind)])
    for c in more:
        out = out.add(*c.split())
    return out


def pairs(prints: DataFrame, tolerance: int, classes: DataFrame | None = None, places: int | None = None) -> DataFrame:
    """a, b (a < b), same, similarity of all ids of which a's rows find one of b's; classes (node, members): prints has nodes, pairs are of members."""
    return _dealt(prints, classes).mapInArrow(_pairs(tolerance, places), _schema(prints, "same long", "similarity double"))


def links(prints: DataFrame, tolerance: int, classes: DataFrame, least: float) -> DataFrame:
    """Enough of the pairs (a, b) of nodes with a similarity of `least` to hold together all that all of them do: of two blocks, those that join what wasn't yet."""
    return _dealt(prints, classes).mapInArrow(_linked(tolerance, least), _schema(prints)).where("a <> b")
