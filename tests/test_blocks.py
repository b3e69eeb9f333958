"""Schedules compared block by block give what each pair by itself gives, whatever the blocks, and no pair is joined or dealt out."""

import random

import pytest
from pyspark.sql import functions as F

from guidemill.operators import blocks, equivalence


def schedules(n, seed):
    """Ids in no order, of few titles and near buckets, copies and ids without a title among them."""
    r, out = random.Random(seed), {}
    for k in range(n):
        out[f"é{k}" if k % 9 == 0 else f"u{k}"] = {(r.choice("xyz"), r.randint(0, 12)) for _ in range(r.randint(1, 7))} if k % 4 else {("x", k % 3), ("y", 5)}
    return out


def matched(a, b, tolerance):
    same, rest = 0, set(b)
    for t, x in sorted(a):
        for y in [x] + [x + s * d for d in range(1, tolerance + 1) for s in (-1, 1)]:
            if (t, y) in rest:
                rest.remove((t, y))
                same += 1
                break
    return same


def every(said, tolerance):
    return {(a, b): (n, n / max(len(said[a]), len(said[b]))) for a in said for b in said if a < b and (n := matched(said[a], said[b], tolerance))}


def frame(spark, said):
    return spark.createDataFrame([(k, x, t) for k, some in said.items() for t, x in some], "epg_id string, bucket long, title string")


@pytest.mark.parametrize("tolerance,block,piece", [(0, 5, 2), (1, 5, 2), (2, 8192, 256), (3, 5, 1)])
def test_blocks_give_what_each_pair_gives(spark, monkeypatch, tolerance, block, piece):
    monkeypatch.setattr(blocks, "BLOCK", block)
    monkeypatch.setattr(blocks, "PIECE", piece)
    said = schedules(40, tolerance)
    got = equivalence.schedule_similarity(frame(spark, said), tolerance).collect()
    assert len(got) == len({(r.a, r.b) for r in got})
    assert {(r.a, r.b): (r.same, r.similarity) for r in got} == every(said, tolerance)


def test_shares_are_rounded_as_spark_rounds(spark):
    said = {"a": {("x", 2 * k) for k in range(128)}, **{f"b{n}": {("x", 2 * k) for k in range(n)} for n in range(1, 128)}}
    got = equivalence.schedule_similarity(frame(spark, said), 0, places=6)
    plain = equivalence.schedule_similarity(frame(spark, said), 0).withColumn("similarity", F.round("similarity", 6))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
    assert got.where("b = 'b1'").first().similarity == 0.007813


@pytest.mark.parametrize("tolerance", [0, 1])
def test_pairs_are_not_shuffled(spark, tolerance):
    plan = equivalence.schedule_similarity(frame(spark, schedules(40, 1)), tolerance)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan and plan.count("Exchange") == 1


@pytest.mark.parametrize("tolerance", [0, 1])
def test_equal_counts_are_neighbours(spark, tolerance):
    """Of one id's pairs, those with the same count and share come in one run, so that a file of all pairs is small."""
    said = schedules(300, 5) | {f"w{k}": {("x", k), ("y", k + 1), ("z", 2 * k)} for k in range(100)}
    rows = [(r.a, r.same, r.similarity) for r in equivalence.schedule_similarity(frame(spark, {k: v for k, v in said.items() if k[0] == "w" or len(v) > 3}), tolerance).collect()]
    runs = sum(x != y for x, y in zip(rows, rows[1:])) + 1
    assert runs == len(set(rows)) < len(rows) / 2


@pytest.mark.parametrize("block,piece,least", [(5, 2, 0.3), (8192, 256, 0.12), (7, 1, 0.45)])
def test_links_hold_together_what_all_pairs_do(spark, monkeypatch, block, piece, least):
    """Groups below 0.5 are those of all pairs, from no more links than there are ids in the blocks that met."""
    monkeypatch.setattr(blocks, "BLOCK", block)
    monkeypatch.setattr(blocks, "PIECE", piece)
    said = {k: v for k, v in schedules(40, 7).items() if len(v) >= 2}
    part = {k: k for k in said}
    linked = {x for p, (_, s) in every(said, 1).items() if s >= least for x in p}
    for (a, b), (_, s) in every(said, 1).items():
        if s >= least:
            low, high = sorted((part[a], part[b]))
            part = {k: low if p == high else p for k, p in part.items()}
    prints = frame(spark, schedules(40, 7))
    seen, plain = [], blocks.links
    monkeypatch.setattr(blocks, "links", lambda *a: seen.append(plain(*a)) or seen[-1])
    got = equivalence.equivalence_groups(prints, least_rows=2, least_similarity=least)
    assert {r.node: r.component for r in got.collect()} == {k: part[k] for k in linked}
    if block > len(said):
        assert seen[0].count() < len(said)
