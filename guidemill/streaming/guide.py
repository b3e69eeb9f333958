"""Guides as streams: an extension, as guides are otherwise built from finished files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling_counts(programmes: DataFrame, seconds: int) -> DataFrame:
    """feed, window_start, programmes and ids by windows of equal length over the start."""
    at = (F.floor(F.col("start") / seconds) * seconds).cast("long")
    return programmes.where("start is not null").groupBy("feed", at.alias("window_start")).agg(F.count("*").alias("programmes"), F.countDistinct("epg_id").alias("ids"))


def deduplicated(stream: DataFrame, late: str = "3 days") -> DataFrame:
    """Each programme (feed, epg_id, start, stop, title; at: its start as a timestamp) once, as long as a repeat isn't later than `late`."""
    rows = stream.withColumn("at", F.timestamp_seconds("start"))
    return rows.withWatermark("at", late).dropDuplicatesWithinWatermark(["feed", "epg_id", "start", "stop", "title"])


def live_counts(stream: DataFrame, length: str = "6 hours", late: str = "3 days") -> DataFrame:
    """Programmes by feed and window of their start; a window is final once `late` has passed."""
    rows = stream.withColumn("at", F.timestamp_seconds("start")).withWatermark("at", late)
    return rows.groupBy(F.window("at", length), "feed").agg(F.count("*").alias("programmes"))
