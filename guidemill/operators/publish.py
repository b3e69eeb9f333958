"""Sinks: a guide in XML, the compact JSON, report tables and the run's state. Files that must be the same byte for byte on every run are written by
the driver, from rows that come in order and one partition at a time."""

from __future__ import annotations

import gzip
import hashlib
import json
import re
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guidemill.functions.time import stamp

_BAD = "[^\\x09\\x0A\\x0D\\x20-\\uD7FF\\uE000-\\uFFFD\\x{10000}-\\x{10FFFF}]"


def _xml(value, quote: bool = False):
    text = F.regexp_replace(F.coalesce(value, F.lit("")), _BAD, "")
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), *(((chr(34), "&quot;"),) if quote else ())):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def guide_lines(entries: DataFrame, schedules: DataFrame, icons: DataFrame | None = None) -> DataFrame:
    """line in the order of a guide file: channels by id in small letters, then programmes by channel, start, stop and title.

    entries: channel_id, display_names, feed, epg_id; schedules: feed, epg_id, start, stop, title; icons: output_id, url."""
    if icons is not None:
        entries = entries.join(icons.select(F.col("output_id").alias("channel_id"), F.col("url").alias("icon")), "channel_id", "left")
    else:
        entries = entries.withColumn("icon", F.lit(None).cast("string"))
    names = F.array_join(F.transform("display_names", lambda x: F.concat(F.lit("    <display-name>"), _xml(x), F.lit("</display-name>\n"))), "")
    icon = F.when(F.col("icon").isNotNull(), F.concat(F.lit('    <icon src="'), _xml(F.col("icon"), True), F.lit('"/>\n'))).otherwise("")
    head = F.concat(F.lit('  <channel id="'), _xml(F.col("channel_id"), True), F.lit('">\n'), names, icon, F.lit("  </channel>\n"))
    order = F.struct(F.lower("channel_id").alias("a"), F.col("channel_id").alias("b"))
    none = F.lit(None)
    channels = entries.select(F.lit(0).alias("part"), order.alias("o"), none.cast("long").alias("start"), none.cast("long").alias("stop"), F.lit("").alias("title"), head.alias("line"))
    rows = entries.join(schedules, ["feed", "epg_id"])
    body = F.concat(F.lit('  <programme start="'), stamp(F.col("start")), F.lit('" stop="'), stamp(F.col("stop")), F.lit('" channel="'), _xml(F.col("channel_id"), True), F.lit('">\n    <title>'), _xml(F.col("title")), F.lit("</title>\n  </programme>\n"))
    programmes = rows.select(F.lit(1).alias("part"), order.alias("o"), "start", "stop", "title", body.alias("line"))
    return channels.union(programmes).orderBy("part", "o", "start", "stop", "title").select("line")


def write_gzip(path: str | Path, pieces: Iterator[str]) -> str:
    """A gzip file without a time in it; its SHA-256."""
    with open(path, "wb") as raw, gzip.GzipFile("", "wb", 9, raw, mtime=0) as out:
        for piece in pieces:
            out.write(piece.encode())
    return sha256_file(path)


def write_guide(path: str | Path, entries: DataFrame, schedules: DataFrame, icons: DataFrame | None = None) -> str:
    lines = guide_lines(entries, schedules, icons)

    def pieces():
        yield '<?xml version="1.0" encoding="UTF-8"?>\n<tv>\n'
        for row in lines.toLocalIterator():
            yield row[0]
        yield "</tv>\n"

    return write_gzip(path, pieces())


def read_gzip(path: str | Path) -> str:
    with gzip.open(path, "rb") as f:
        return f.read().decode("utf-8-sig")


def sha256_file(path: str | Path) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def write_payload(path: str | Path, server_id: str, generated_at: object, window: tuple[int, int], keys: DataFrame, payload: DataFrame, extra: dict | None = None) -> str:
    """The compact JSON: core keys over those of `extra`, streams in order of their numbers, ids in order. Rows are written as they come, one id at a time."""
    number = F.col("stream_id").try_cast("long")
    streams = keys.orderBy(number.isNull(), number, F.lower("stream_id"), "stream_id").select("stream_id", "guide_id")
    said = lambda x: json.dumps(x, ensure_ascii=False, separators=(",", ":"))
    programmes = payload.orderBy("guide_id").select("guide_id", "programmes")
    core = {"schemaVersion": 1, "serverId": server_id, "generatedAt": generated_at, "windowStart": window[0], "windowEnd": window[1]}
    rest = {k: v for k, v in (extra or {}).items() if k not in (*core, "streamToEpg", "programmes")}

    def pieces():
        yield said(rest | core)[:-1] + ',"streamToEpg":{'
        for k, (stream, guide) in enumerate(streams.toLocalIterator()):
            yield ("," if k else "") + f"{said(stream)}:{said(guide)}"
        yield '},"programmes":{'
        for k, (guide, rows) in enumerate(programmes.toLocalIterator()):
            yield ("," if k else "") + f"{said(guide)}:{said([list(p) for p in rows])}"
        yield "}}"

    return write_gzip(path, pieces())


def write_reports(folder: str, reports: dict[str, DataFrame]) -> None:
    """A folder of CSV files for each report; lists are joined by |."""
    for name, df in reports.items():
        flat = [F.array_join(c, " | ").alias(c) if t.startswith("array<string") else F.col(c) for c, t in df.dtypes]
        df.select(*flat).write.mode("overwrite").option("header", True).csv(f"{folder.rstrip('/')}/{re.sub('[^a-z0-9_]', '_', name.lower())}")


def write_state(path: str | Path, finished_utc: str, run_id: str = "", attempt: str = "", commit: str = "") -> None:
    Path(path).write_text(json.dumps({"schemaVersion": 1, "lastSuccessUtc": finished_utc, "workflowRunId": run_id, "workflowRunAttempt": attempt, "sourceCommit": commit}, indent=2) + "\n")
