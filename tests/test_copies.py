"""Stages on many copies of one name: work must not grow with the number of pairs."""

import threading

import pytest
from pyspark.sql import functions as F

from guidemill.operators import equivalence, resolve

N = 20_000


def in_time(spark, df, seconds=90):
    """Distinct rows of df without stream_id and how often they come; jobs that take longer are cancelled, which fails the test."""
    timer = threading.Timer(seconds, spark.sparkContext.cancelAllJobs)
    timer.start()
    try:
        return {tuple(r)[:-1]: r.n for r in df.drop("stream_id").groupBy(*[c for c in df.columns if c != "stream_id"]).agg(F.count("*").alias("n")).collect()}
    finally:
        timer.cancel()


def sides(spark, channel, candidate):
    k = F.col("id")
    q = spark.range(N).select(k.alias("stream_id"), F.array(F.lit("US")).alias("regions"), F.lit(channel).alias("name"), F.lit(channel).alias("channel_name"))
    c = spark.range(N).select(F.concat(F.lit("g"), k).alias("epg_id"), F.lit("F0").alias("feed"), F.lit("US").alias("region"), F.lit("f").alias("family"), (k % 3).alias("source_priority"), F.lit(candidate).alias("name"))
    return resolve.with_keys(q, "name"), resolve.with_keys(c, "name")


STAGES = {
    "exact": ("hot gear", "hot gear", resolve.exact_key_match),
    "containment": ("small hot gear", "hot gear", lambda q, c: resolve.containment_match(q, c, ["small"])),
    "spelling": ("hot gear", "hot gears", lambda q, c: resolve.near_exact_match(q, c, 80.0)),
    "callsign": ("News WABC", "WABC TV", lambda q, c: resolve.callsign_match(q, c, display="name")),
    "extension": ("hot gear", "hot gear large", lambda q, c: resolve.extension_match(q, c, ["large"])),
    "similar": ("hot gear", "hot gaer", resolve.fuzzy_match),
}


@pytest.mark.parametrize("stage", STAGES)
def test_copies(spark, stage):
    channel, candidate, f = STAGES[stage]
    out = f(*sides(spark, channel, candidate)).select("stream_id", "epg_id", "feed", "family", *(["alternate"] if stage != "similar" else []))
    assert in_time(spark, out) == {("g0", "F0", "f", *(["g3"] if stage != "similar" else [])): N}


def test_classes_keep_what_single_rows_say(spark):
    """Streams with several rows, a null id among them, and candidates of one name that differ in family, id's case and marks."""
    q = spark.createDataFrame([(1, ["US"], "hot gear"), (2, ["UK", "US"], "hot gear"), (3, ["US"], "old gear"), (3, ["US"], "hot gear"), (None, ["US"], "hot gear"), (4, ["US"], "red rod"), (5, ["US"], None)], "stream_id long, regions array<string>, name string")
    c = spark.createDataFrame([("b", "US", "f", "hot gear"), ("B", "US", "f", "hot gear"), ("cc", "US", "f", "hot gear"), ("z", "UK", "f", "hot gear"), ("z", "UK", "g", "hot gear"), ("o", "US", "h", "old gear"), ("r", "US", None, "red rod")], "epg_id string, region string, family string, name string").withColumns({"feed": F.lit("F0"), "source_priority": F.lit(1)})
    got = resolve.exact_key_match(resolve.with_keys(q, "name"), resolve.with_keys(c, "name"))
    assert {(r.stream_id, r.method, r.epg_id, r.alternate) for r in got.collect()} == {(1, "strict", "B", "cc"), (2, "strict", "B", "cc"), (None, "strict", "B", "cc")}


def test_equal_schedules_are_one_class(spark):
    """20,000 ids of one schedule, and as many of it but for one row, are one group."""
    rows = spark.range(2 * N).select(F.concat(F.lit("u"), "id").alias("epg_id"), F.explode(F.sequence(F.lit(1), F.lit(10))).alias("bucket"), (F.col("id") % 2).alias("k"))
    prints = rows.select("epg_id", "bucket", F.when((F.col("k") == 1) & (F.col("bucket") == 10), "other").otherwise("news").alias("title"))
    out = equivalence.equivalence_groups(prints, least_rows=8, least_similarity=0.9)
    assert in_time(spark, out.select(F.lit(0).alias("stream_id"), "component")) == {("u0",): 2 * N}


@pytest.mark.parametrize("tolerance", [0, 1])
def test_pairs_of_copies_are_those_of_single_ids(spark, tolerance, monkeypatch):
    """Copies among ids in any order, in which a's rows may take other numbers of b's than b's of a's: the same pairs as of each id by itself; one comparison a class."""
    said = {"a": [1, 2], "b": [2, 3], "c": [1, 2], "d": [2, 3], "e": [1, 2, 3], "f": [9], "g": [1, 2]}
    rows = [(k, x, "t") for k, some in said.items() for x in some] + [("g", 1, "t"), ("h", 1, None), ("i", 1, None), ("h", 2, "t"), ("i", 2, "t")]
    prints = spark.createDataFrame(rows, "epg_id string, bucket long, title string")
    wanted = {tuple(r) for r in equivalence._similar(prints, tolerance).select("a", "b", "same", "similarity").collect()}
    assert {(r.same) for r in equivalence._similar(prints, 1).where("(a, b) in (('a', 'b'), ('b', 'c'))").collect()} == {1, 2}
    seen, plain = [], equivalence._similar
    monkeypatch.setattr(equivalence, "_similar", lambda some, *a: seen.append(some.select("epg_id").distinct().count()) or plain(some, *a))
    assert sorted(map(tuple, equivalence.schedule_similarity(prints, tolerance).collect())) == sorted(wanted)
    assert seen == [7]


def test_each_name_is_read_once(spark, monkeypatch):
    """Names and categories that many channels have, nulls among them, go to the reader once; every channel is kept."""
    seen, plain = [], resolve.with_channels
    monkeypatch.setattr(resolve, "with_channels", lambda df, **options: seen.append(df.count()) or plain(df, **options))
    names = F.when(F.col("id") % 4 == 0, None).when(F.col("id") % 4 == 1, "US: Hot Gear HD").otherwise("Hot Gear")
    q = spark.range(400).select(F.col("id").alias("stream_id"), names.alias("channel_name"), F.when(F.col("id") % 4 == 3, "US | things").alias("category_name"))
    out = resolve.read_channels(q)
    assert out.count() == 400 and out.where("strict = 'hot gear'").count() == 300
    assert seen == [4, 4]
