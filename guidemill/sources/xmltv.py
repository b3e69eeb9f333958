"""Readers of programme guides in XML, plain or compressed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guidemill.functions.text import squeeze
from guidemill.functions.time import parse_stamp

_TITLE = "title array<struct<_VALUE:string,_lang:string>>"
PROGRAMME = f"_channel string, _start string, _stop string, {_TITLE}"
CHANNEL = "_id string, `display-name` array<struct<_VALUE:string,_lang:string>>, icon array<struct<_src:string>>"


def check_guide(spark: SparkSession, path: str) -> None:
    """An error if the file is empty, an HTML page, or has no guide in its first bytes."""
    import gzip
    import zlib

    rows = spark.read.format("binaryFile").load(path).select("path", F.substring("content", 1, 4096).alias("head")).collect()
    for name, head in ((r[0], bytes(r[1])) for r in rows):
        if head[:2] == b"\x1f\x8b":
            if not name.endswith(".gz"):
                raise ValueError(f"{name} is compressed: name it .gz, as Spark goes by the name")
            try:
                head = zlib.decompressobj(31).decompress(head)
            except (zlib.error, gzip.BadGzipFile) as e:
                raise ValueError(f"{name} can't be decompressed") from e
        text = head[:512].lstrip(b"\xef\xbb\xbf \t\r\n").lower()
        if not text or b"<html" in text or b"<!doctype html" in text or b"<tv" not in text:
            raise ValueError(f"{name} is not a programme guide")


def staged(spark: SparkSession, path: str) -> str:
    """The path, or that of a copy in the shared folder whose name says .gz, if the file is compressed and its own doesn't: Spark goes by the name."""
    import uuid

    from guidemill.sources.tables import shared_dir

    head = bytes(spark.read.format("binaryFile").load(path).select(F.substring("content", 1, 2)).first()[0])
    if head != b"\x1f\x8b" or path.endswith(".gz"):
        return path
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    one, other = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/guide-{uuid.uuid4().hex}.xml.gz")
    system = other.getFileSystem(conf)
    jvm.org.apache.hadoop.fs.FileUtil.copy(one.getFileSystem(conf), one, system, other, False, conf)
    system.deleteOnExit(other)
    return other.toString()


def read_programmes(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """feed, epg_id, start, stop (epoch seconds), title: the English title if there is one, else the first that isn't blank.

    Elements that were cut off have no channel and are left out."""
    rows = spark.read.format("xml").option("rowTag", "programme").option("mode", "PERMISSIVE").schema(PROGRAMME).load(path).where("_channel is not null")
    said = F.filter("title", lambda t: F.trim(F.coalesce(t["_VALUE"], F.lit(""))) != "")
    english = F.filter(said, lambda t: F.lower(t["_lang"]).startswith("en"))
    title = squeeze(F.coalesce(F.get(english, F.lit(0))["_VALUE"], F.get(said, F.lit(0))["_VALUE"], F.lit("")))
    return rows.select(F.lit(feed).alias("feed"), F.trim("_channel").alias("epg_id"), parse_stamp(F.col("_start")).alias("start"), parse_stamp(F.col("_stop")).alias("stop"), title.alias("title"))


def read_channels(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """feed, pos, channel_id, display_names, icons in the order of the file, for one file."""
    rows = spark.read.format("xml").option("rowTag", "channel").schema(CHANNEL).load(path).where("_id is not null")
    names = F.filter(F.transform("display-name", lambda x: F.trim(x["_VALUE"])), lambda x: x != "")
    return rows.select(F.lit(feed).alias("feed"), F.monotonically_increasing_id().alias("pos"), F.trim("_id").alias("channel_id"), names.alias("display_names"), F.transform("icon", lambda x: x["_src"]).alias("icons"))


def source_icons(channels: DataFrame, wanted: DataFrame) -> DataFrame:
    """feed, epg_id, url: the first safe icon of each wanted (feed, epg_id), in any case."""
    from guidemill.operators.icons import safe_url

    each = channels.select("feed", "pos", F.lower("channel_id").alias("folded"), F.posexplode("icons").alias("k", "icon")).withColumn("url", safe_url(F.col("icon"))).where("url is not null")
    first = each.groupBy("feed", "folded").agg(F.min(F.struct("pos", "k", "url"))["url"].alias("url"))
    return wanted.select("feed", "epg_id").distinct().withColumn("folded", F.lower("epg_id")).join(first, ["feed", "folded"]).select("feed", "epg_id", "url")
