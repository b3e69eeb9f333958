"""The compact export: usable streams with their guide keys, programmes of a window, and checks of the payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guidemill.operators.mapping import DUMMY_FEED, PANEL_FEED, REJECTED_BY_EXPORT, feed_key, normalize_mapping


def prepare_export(frame: DataFrame, server_id: str, dummy_feeds: list[str], row_col: str = "row_idx") -> DataFrame:
    """The usable rows of a server with feed_key, effective feed and id (own ones if blank), and candidate_ids: the ids to look for, in order.

    Real rows look for their id, then their name; rows on dummy feeds for their name only, as every channel of a dummy has its own entry."""
    rows = normalize_mapping(frame, server_id, row_col, REJECTED_BY_EXPORT)
    extra = [c for c in ("effective_feed_key", "effective_epg_id") if c in frame.columns]
    if extra:
        rows = rows.join(frame.select(row_col, *extra), row_col)
    own = feed_key(F.col("source"), F.col("epg_feed"))
    first = lambda c, other: F.coalesce(F.when(F.trim(F.coalesce(c, F.lit(""))) != "", c), other) if c in extra else other
    named = lambda c: F.col(c) if c in extra else F.lit(None).cast("string")
    rows = rows.withColumn("feed_key", own)
    rows = rows.withColumn("effective_feed", F.coalesce(F.when(F.trim(named("effective_feed_key")) != "", named("effective_feed_key")), F.col("feed_key")))
    rows = rows.withColumn("effective_id", F.coalesce(F.when(F.trim(named("effective_epg_id")) != "", named("effective_epg_id")), F.col("epg_id")))
    dummy = F.col("effective_feed").isin([DUMMY_FEED, *dummy_feeds])
    ids = F.when(dummy, F.array("channel_name", "effective_id")).otherwise(F.array("effective_id", "epg_id", "channel_name"))
    return rows.withColumns({"dummy": dummy, "candidate_ids": F.array_distinct(F.filter(ids, lambda x: F.trim(x) != ""))}).drop("effective_feed_key", "effective_epg_id")


def stream_keys(prepared: DataFrame, channel_ids: DataFrame) -> DataFrame:
    """stream_id, guide_id: the first candidate that the guide (channel_id) declares in any case, in the guide's first spelling (pos)."""
    declared = channel_ids.groupBy(F.lower("channel_id").alias("folded")).agg(F.min(F.struct("pos", "channel_id"))["channel_id"].alias("guide_id"))
    wanted = prepared.select("stream_id", F.posexplode("candidate_ids").alias("pos", "id")).withColumn("folded", F.lower("id"))
    return wanted.join(declared, "folded").groupBy("stream_id").agg(F.min(F.struct("pos", "guide_id"))["guide_id"].alias("guide_id"))


def app_programmes(keys: DataFrame, programmes: DataFrame, start: int, end: int) -> DataFrame:
    """guide_id, start, stop, title of the programmes (channel_id) that overlap [start, end), each once. Placeholder titles stay."""
    rows = programmes.where((F.col("stop") > start) & (F.col("start") < end) & (F.col("stop") > F.col("start")) & (F.trim("title") != ""))
    wanted = keys.select(F.col("guide_id")).distinct().withColumn("folded", F.lower("guide_id"))
    return rows.withColumn("folded", F.lower("channel_id")).join(wanted, "folded").select("guide_id", "start", "stop", "title").distinct()


def payload_programmes(rows: DataFrame) -> DataFrame:
    """guide_id and its programmes in order, as an array of structs."""
    return rows.groupBy("guide_id").agg(F.array_sort(F.collect_list(F.struct("start", "stop", "title"))).alias("programmes"))


def validate_payload(keys: DataFrame, payload: DataFrame) -> DataFrame:
    """One row: streams, streams whose id has no programmes, ids, programmes, reversed ones, and ids whose programmes are out of order."""
    streams = keys.join(payload.select("guide_id", F.lit(1).alias("has")), "guide_id", "left").agg(F.count("*").alias("streams"), F.count_if(F.col("has").isNull()).alias("without_programmes"))
    rows = payload.agg(
        F.count("*").alias("ids"),
        F.coalesce(F.sum(F.size("programmes")), F.lit(0)).cast("long").alias("programmes"),
        F.coalesce(F.sum(F.size(F.filter("programmes", lambda x: x["stop"] <= x["start"]))), F.lit(0)).cast("long").alias("reversed"),
        F.count_if(~F.col("programmes").eqNullSafe(F.array_sort("programmes"))).alias("unordered_ids"),
    )
    return streams.crossJoin(rows)  # one row each


def preserved(previous: dict, core: set[str] = frozenset({"schemaVersion", "serverId", "generatedAt", "windowStart", "windowEnd", "streamToEpg", "programmes"})) -> dict:
    """What an earlier payload has besides the core keys."""
    return {k: v for k, v in previous.items() if k not in core}


def is_panel(feed: Column) -> Column:
    return F.lower(F.trim(feed)) == PANEL_FEED
