"""Best-fit packing by a grouping genetic algorithm.

Documents become token ids and, where they are longer than a sequence, pieces. Pieces of full length are a sequence each. The others are dealt
at random into shards of about `shard_size` pieces, so a task's work is bounded and every shard has the lengths of the whole. Each shard is
evolved on several islands: crossover injects whole well-filled bins of one parent into another, bins with duplicates are removed, and the
displaced pieces are put back best-fit, longest first. After each epoch an island's elite goes to the next island of its ring. The best island's
elite is the packing. Chance comes from fixed seeds and from ids given when the pieces were written, so a lost task repeats its own work exactly.
"""

from __future__ import annotations

import itertools
import json
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guidemill.llm.common import run_hashes, utf8_slices, written

# ---------------------------------------------------------------- token ids
_REMEMBERED = 2_000_000  # chunks; their ids take some tens of MB
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0D]] = True
_encoders: dict = {}


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _odd_rows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows with white space other than space, tab, newline and return: they are encoded in one go."""
    odd = np.isin(data, np.array([0x0B, 0x0C, *range(0x1C, 0x20)], np.uint8))
    at = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    if len(at):
        one, two, three = (data[np.minimum(at + k, len(data) - 1)] for k in range(3))
        hit = (one == 0xC2) & ((two == 0x85) | (two == 0xA0)) | (one == 0xE1) & (two == 0x9A) & (three == 0x80) | (one == 0xE3) & (two == 0x80) & (three == 0x80)
        hit |= (one == 0xE2) & ((two == 0x80) & ((three <= 0x8A) | (three == 0xA8) | (three == 0xA9) | (three == 0xAF)) | (two == 0x81) & (three == 0x9F))
        odd[at[hit]] = True
    return np.unique(np.searchsorted(offsets, np.flatnonzero(odd), "right") - 1)


class _Encoder:
    """uint32 ids of texts, as a byte-level BPE file of the tokenizers library gives them (add_special_tokens=False).

    Such a BPE never joins what stands before white space with it, so runs of white space and the word after them are encoded alone and
    remembered, up to a fixed number. The merges run in tiktoken, over the ranks of the same file: ids of this kind of file are ranks. Special
    tokens of the file count in texts, as they do there by default."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or before["type"] != "ByteLevel" or before.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError(f"{path} is not a plain byte-level BPE")
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        byte = _byte_of()
        ranks = {bytes(byte[c] for c in word): k for word, k in spec["model"]["vocab"].items() if word not in self.special}
        self.bpe = tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.size_of = np.zeros(max(spec["model"]["vocab"].values()) + 1, np.int64)
        for word, k in ranks.items():
            self.size_of[k] = len(word)
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.begin, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def one(self, text: str) -> list[int]:
        return self.bpe.encode(text, allowed_special="all") if any(x in text for x in self.special) else self.bpe.encode_ordinary(text)

    def _encoded(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all chunks, and where each one's begin and how many they are. Chunks from white space to a word are encoded in one text: no id reaches over their ends."""
        together = [k for k, x in enumerate(chunks) if x[0] in b" \t\n\r" and x[-1] not in b" \t\n\r"]
        text = b"".join([chunks[k] for k in together]).decode()
        if any(x in text for x in self.special):
            together, text = [], ""
        ids = np.array(self.bpe.encode_ordinary(text), np.uint32)
        stops = np.searchsorted(np.cumsum(self.size_of[ids]), np.cumsum([len(chunks[k]) for k in together]), "left") + 1
        begin, count = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        count[together] = np.diff(stops, prepend=0)
        begin[together] = stops - count[together]
        rest = np.setdiff1d(np.arange(len(chunks)), together)
        alone = [np.array(self.one(chunks[k].decode()), np.uint32) for k in rest]
        count[rest] = [len(x) for x in alone]
        begin[rest] = len(ids) + np.cumsum(count[rest]) - count[rest]
        return np.concatenate([ids, *alone]), begin, count

    def _learn(self, hashes: np.ndarray, chunks: list[bytes]) -> None:
        """Remember chunks; the hashes are sorted and new."""
        flat, begin, count = self._encoded(chunks)
        while len(self.ids) < self.used + len(flat):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(flat)] = flat
        begin += self.used
        self.used += len(flat)
        at = np.searchsorted(self.hashes, hashes)
        self.hashes, self.begin, self.count = np.insert(self.hashes, at, hashes), np.insert(self.begin, at, begin), np.insert(self.count, at, count)

    def rows(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """The ids of each row of UTF-8 bytes."""
        n = len(offsets) - 1
        if not len(data):
            return [np.zeros(0, np.uint32)] * n
        space = _WHITE[data]
        first = np.empty(len(data), bool)
        first[0] = True
        first[1:] = space[1:] & ~space[:-1]
        inner = offsets[1:-1]
        first[inner[inner < len(data)]] = True
        starts = np.flatnonzero(first)
        hashes = run_hashes(data, first, starts)
        ends = np.append(starts[1:], len(data))
        values, sample, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, values), max(0, len(self.hashes) - 1))
        new = np.flatnonzero(self.hashes[at] != values) if len(self.hashes) else np.arange(len(values))
        if len(self.hashes) + len(new) > _REMEMBERED:
            self._forget()
            new = np.arange(len(values))
        if len(new):
            whole = data.tobytes()
            self._learn(values[new], [whole[a:b] for a, b in zip(starts[sample[new]].tolist(), ends[sample[new]].tolist(), strict=True)])
            at = np.searchsorted(self.hashes, values)
        begin, count = self.begin[at][inverse], self.count[at][inverse]
        stop = np.cumsum(count)
        flat = self.ids[np.arange(int(stop[-1])) + np.repeat(begin - stop + count, count)]
        edges = np.append(0, stop)[np.searchsorted(starts, offsets)]
        out = [flat[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        for k in _odd_rows(data, offsets):
            out[k] = np.array(self.one(data[offsets[k] : offsets[k + 1]].tobytes().decode()), np.uint32)
        return out


_PIECE_TYPES = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())


def _cut(path: str, capacity: int, end_id: int):
    def run(batches):
        encoder = _encoders[path] if path in _encoders else _encoders.setdefault(path, _Encoder(path))
        end = np.array([end_id], np.uint32)
        for batch in batches:
            docs = batch.column(0).to_pylist()
            for at, data, offsets in utf8_slices(batch.column(1)):
                rows = []
                for doc, ids in zip(docs[at:], encoder.rows(data, offsets), strict=False):
                    ids = np.concatenate([ids, end])
                    n, start = len(ids), 0
                    for piece, stop in enumerate(range(n % capacity or capacity, n + 1, capacity)):
                        rows.append((doc, piece, start, stop - start, ids[start:stop].astype("<u4").tobytes()))
                        start = stop
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), _PIECE_TYPES, strict=True)], ["doc_id", "piece", "start", "length", "ids"])

    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids (binary, little-endian uint32): each row's ids and then end_id, cut only if longer than capacity.

    Of a cut document the first piece may be shorter, all others are full. Null text counts as empty and so is end_id alone. Rows without an id and
    repeated rows are tokenized like any other; other columns are not read."""
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(_cut(tokenizer_path, capacity, end_id), "doc_id long, piece int, start long, length long, ids binary")


# ---------------------------------------------------------------- one shard
class _Bins:
    """Bins under best-fit: a bit for each free length that some bin has."""

    def __init__(self, capacity: int):
        self.capacity, self.items, self.free, self.by_free, self.mask = capacity, [], [], {}, 0

    def put_bin(self, items: list[int], free: int) -> None:
        self._note(len(self.items), free)
        self.items.append(items)
        self.free.append(free)

    def _note(self, bin_: int, free: int) -> None:
        self.by_free.setdefault(free, []).append(bin_)
        self.mask |= 1 << free

    def best_fit(self, item: int, length: int) -> None:
        above = self.mask >> length
        if not above:
            self.put_bin([item], self.capacity - length)
            return
        free = length + (above & -above).bit_length() - 1
        holders = self.by_free[free]
        bin_ = holders.pop()
        if not holders:
            self.mask ^= 1 << free
        self.items[bin_].append(item)
        self.free[bin_] = free - length
        self._note(bin_, free - length)


def _fitness(bins: _Bins) -> tuple[int, float]:
    """Fewer bins, then a higher mean square of their fill."""
    return -len(bins.items), sum((bins.capacity - f) ** 2 for f in bins.free) / max(1, len(bins.items))


def _first(lengths: list[int], capacity: int, chance: random.Random, spread: float) -> _Bins:
    order = sorted(range(len(lengths)), key=lambda k: -lengths[k] * (1 + spread * chance.random()) if spread else -lengths[k])
    bins = _Bins(capacity)
    for k in order:
        bins.best_fit(k, lengths[k])
    return bins


def _cross(lengths: list[int], giver: _Bins, taker: _Bins, chance: random.Random) -> _Bins:
    """Some of the giver's best-filled bins go whole into the taker; its bins that hold any of their pieces, and some of its worst, are emptied; what
    that displaces is put back best-fit, longest first."""
    capacity = giver.capacity
    good = sorted(range(len(giver.items)), key=lambda b: (giver.free[b], chance.random()))
    good = [b for b in good[: max(1, len(good) * 3 // 4)] if chance.random() < 0.3] or good[:1]
    injected = {k for b in good for k in giver.items[b]}
    child, displaced = _Bins(capacity), []
    for b in good:
        child.put_bin(list(giver.items[b]), giver.free[b])
    worst = sorted(taker.free, reverse=True)[: max(1, len(taker.free) // 10)][-1]
    for items, free in zip(taker.items, taker.free, strict=True):
        if not injected.isdisjoint(items) or free and free >= worst and chance.random() < 0.5:
            displaced += [k for k in items if k not in injected]
        else:
            child.put_bin(list(items), free)
    for k in sorted(displaced, key=lambda k: -lengths[k]):
        child.best_fit(k, lengths[k])
    return child


def lower_bound(lengths: list[int], capacity: int) -> int:
    """No packing has fewer bins: the total length, and pieces of over half a bin that no two share."""
    return max(-(-sum(lengths) // capacity), sum(2 * x > capacity for x in lengths))


def _from_places(lengths: list[int], capacity: int, places: list[int]) -> _Bins:
    bins, held = _Bins(capacity), {}
    for k, b in enumerate(places):
        held.setdefault(b, []).append(k)
    for items in held.values():
        bins.put_bin(items, capacity - sum(lengths[k] for k in items))
    return bins


def evolve(lengths: list[int], capacity: int, start: list[list[int]], seed: int, generations: int, population: int) -> list[list[int]]:
    """A population, best first, each as the bin of every piece; start: one of before, or none."""
    chance = random.Random(seed)
    least = lower_bound(lengths, capacity)
    people = [_from_places(lengths, capacity, x) for x in start]
    while len(people) < population:
        people.append(_first(lengths, capacity, chance, 0.0 if not people and not seed % 2 else chance.choice((0.02, 0.1, 0.3))))
        if len(people[-1].items) <= least:
            break
    people.sort(key=_fitness, reverse=True)
    for _ in range(generations):
        if len(people[0].items) <= least:
            break
        one, two = sorted(chance.sample(range(len(people)), 2)) if len(people) > 1 else (0, 0)
        people.append(_cross(lengths, people[one], people[two], chance))
        people.sort(key=_fitness, reverse=True)
        del people[population:]
    out = []
    for bins in people:
        places = [0] * len(lengths)
        for b, items in enumerate(bins.items):
            for k in items:
                places[k] = b
        out.append(places)
    return out


def _epoch(capacity: int, generations: int, population: int):
    def run(batches):
        for batch in batches:
            for shard, island, lengths, start, epoch in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                people = evolve(lengths, capacity, start or [], shard * 1009 + island + 7919 * epoch, generations, population)
                counted = [max(x, default=-1) + 1 for x in people]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int64()), pa.array([island], pa.int32()), pa.array([lengths], pa.list_(pa.int64())), pa.array([people], pa.list_(pa.list_(pa.int32()))), pa.array([epoch + 1], pa.int32()), pa.array([counted[0]], pa.int64())],
                    ["shard", "island", "lengths", "people", "epoch", "bins"],
                )

    return run


_PEOPLE = "shard long, island int, lengths array<bigint>, people array<array<int>>, epoch int, bins long"


def _offsets(batches):
    for batch in batches:
        out = []
        for lengths, places in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            filled, offsets = {}, []
            for n, b in zip(lengths, places, strict=True):
                offsets.append(filled.get(b, 0))
                filled[b] = offsets[-1] + n
            out.append(offsets)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out, pa.list_(pa.int64()))], ["shard", "places", "offsets"])


# ---------------------------------------------------------------- all shards
#: Islands that a task evolves one after the other, a tenth of a second each. Each task writes a file, and a file costs the executor several child
#: processes, during which its memory may be counted twice; so tasks aren't made smaller.
ISLANDS_A_TASK = 12


def pack(pieces: DataFrame, capacity: int = 2048, length_col: str = "length", shard_size: int = 4096, islands: int = 2, epochs: int = 2, generations: int = 12, population: int = 4) -> DataFrame:
    """The rows of pieces with sequence_id and offset: gapless from 0 in every sequence, none above capacity.

    Rows may repeat and any column but the length may be null; each row is placed once. A null length or one outside 1..capacity is an error.
    An empty table gives an empty one. Columns named sequence_id, offset are replaced."""
    spark = pieces.sparkSession
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    length = F.col(length_col)
    checked = F.when(length.between(1, capacity), length.cast("long")).otherwise(F.raise_error(F.lit(f"a piece's length must be 1 to {capacity}")).cast("long"))
    rows = written(pieces.select(F.struct(*kept).alias("row"), checked.alias("n"), F.monotonically_increasing_id().alias("at")), "pieces")
    full = rows.where(F.col("n") == capacity).select("row", (-F.col("at") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = rows.where(F.col("n") < capacity)
    shards = max(1, -(-part.count() // shard_size))
    tasks = min(-(-shards * islands // ISLANDS_A_TASK), 10_000)
    dealt = part.groupBy(F.pmod(F.xxhash64("at"), F.lit(shards)).alias("shard")).agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "at", "row"))).alias("items"))
    dealt = written(dealt, "shards")  # about shard_size rows in each
    people = dealt.select("shard", F.explode(F.array(*[F.lit(k) for k in range(islands)])).alias("island"), F.transform("items", lambda x: -x["m"]).alias("lengths"))
    people = people.withColumns({"start": F.lit(None).cast("array<array<int>>"), "epoch": F.lit(0)})
    for k in range(epochs):
        spread = people.select("shard", "island", "lengths", "start", "epoch").repartition(tasks, "shard", "island")
        people = written(spread.mapInArrow(_epoch(capacity, generations, population), _PEOPLE), "people")
        if k + 1 < epochs:  # the elite of each island joins the next one's people
            guests = people.select("shard", ((F.col("island") + 1) % islands).alias("island"), F.col("people")[0].alias("guest"))
            people = people.join(guests, ["shard", "island"]).withColumn("start", F.concat(F.col("people"), F.array("guest")))
    best = people.groupBy("shard").agg(F.min(F.struct("bins", "island")).alias("b")).select("shard", "b.island")
    best = people.join(best, ["shard", "island"]).select("shard", "lengths", F.col("people")[0].alias("places"))
    placed = best.mapInArrow(_offsets, "shard long, places array<int>, offsets array<bigint>").join(dealt, "shard")
    each = placed.select("shard", F.explode(F.arrays_zip("items", "places", "offsets")).alias("x"))
    each = each.select(F.col("x.items.row").alias("row"), (F.shiftleft(F.col("shard"), 20) + F.col("x.places")).alias("sequence_id"), F.col("x.offsets").alias("offset"))
    return full.union(each).select("row.*", "sequence_id", "offset")


def best_fit_packing(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = True, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """token_pieces() packed by pack(): doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset.

    keep_ids: False leaves the ids out of what is shuffled and returned; their checksum stays."""
    pieces = token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col).withColumn("ids_crc32", F.crc32("ids"))
    return pack(pieces if keep_ids else pieces.drop("ids"), capacity, **options)
