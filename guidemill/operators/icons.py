"""Channel icons: safe addresses, overrides by scope, and one icon for each output id."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from guidemill.functions.text import icon_key

EXTENSIONS = ["png", "jpg", "jpeg", "webp", "gif", "svg"]


@F.pandas_udf(StringType())
def joined_url(base: pd.Series, url: pd.Series) -> pd.Series:
    return pd.Series([x if not b or x is None else urljoin(b, x) for b, x in zip(base, url, strict=True)], dtype="object")


def safe_url(url: Column) -> Column:
    """http and https addresses with a host, without user names, blanks or control characters; // counts as https. Others are null."""
    text = F.trim(url)
    text = F.when(text.startswith("//"), F.concat(F.lit("https:"), text)).otherwise(text)
    fine = text.rlike(r"^(?i:https?)://[^/?#@\s\x00-\x1f\x7f]+([/?#][^\s\x00-\x1f\x7f]*)?$")
    return F.when(fine, text)


def safe_file(path: Column) -> Column:
    """Relative paths without .. whose ending is that of an image; others are null."""
    text = F.replace(F.trim(path), F.lit("\\"), F.lit("/"))
    fine = ~text.rlike(r"(^/|(^|/)\.\.(/|$)|[\x00-\x1f\x7f:])") & F.lower(F.regexp_extract(text, r"\.([A-Za-z0-9]+)$", 1)).isin(EXTENSIONS)
    return F.when(fine, text)


def local_url(base: Column, path: Column) -> Column:
    parts = F.transform(F.split(path, "/"), lambda x: F.replace(F.url_encode(x), F.lit("+"), F.lit("%20")))
    return F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/logos/"), F.array_join(parts, "/"))


def icon_overrides(rows: DataFrame, public_base_url: str, row_col: str = "row_idx") -> DataFrame:
    """scope, by, key, url, priority of enabled rows that have a safe url or file; an earlier row has precedence among equal priorities."""
    off = F.lower(F.trim(F.coalesce("enabled", F.lit("")))).isin("0", "false", "no", "n", "off", "disabled")
    out = rows.where(~off).withColumn("url", F.coalesce(safe_url(F.col("icon_url")), local_url(F.lit(public_base_url), safe_file(F.col("local_file")))))
    scope = F.when(F.trim(F.coalesce("server_id", F.lit(""))) == "", "*").otherwise(F.trim("server_id"))
    rank = F.coalesce(F.col("priority").try_cast("long"), F.lit(0)) * 1_000_000 - F.col(row_col)
    keys = F.array(F.struct(F.lit("epg_id").alias("by"), icon_key(F.col("epg_id")).alias("key")), F.struct(F.lit("channel_name").alias("by"), icon_key(F.col("channel_name")).alias("key")))
    return out.where("url is not null").select(scope.alias("scope"), F.explode(keys).alias("k"), "url", rank.alias("priority")).select("scope", "k.by", "k.key", "url", "priority").where("key <> ''")


def resolve_icons(prepared: DataFrame, server_id: str, overrides: DataFrame, source_icons: DataFrame) -> DataFrame:
    """output_id, url, origin: for names and ids of prepared (epg_id, channel_name, feed_key, dummy) the icon that comes first.

    Overrides come before source icons (feed, epg_id, url): the server's own scope before *, ids before names, then priority."""
    rows = prepared.select("epg_id", "channel_name", "feed_key", "dummy", icon_key(F.col("epg_id")).alias("ik"), icon_key(F.col("channel_name")).alias("nk")).distinct()
    o = overrides.where(F.col("scope").isin(server_id, "*"))
    tier = F.when(F.col("scope") == server_id, 0).otherwise(2) + F.when(F.col("by") == "epg_id", 0).otherwise(1)
    o = o.withColumn("tier", tier)
    met = rows.join(o.where("by = 'epg_id'"), F.col("ik") == F.col("key")).unionByName(rows.join(o.where("by = 'channel_name'"), F.col("nk") == F.col("key")))
    found = met.select("epg_id", "channel_name", "dummy", "tier", (-F.col("priority")).alias("p"), "url", F.lit("config").alias("origin"))
    s = source_icons.groupBy(F.col("feed").alias("sf"), icon_key(F.col("epg_id")).alias("sk")).agg(F.min("url").alias("url"))
    own = rows.join(s, (F.col("feed_key") == F.col("sf")) & (F.col("ik") == F.col("sk"))).select("epg_id", "channel_name", "dummy", F.lit(9).alias("tier"), F.lit(0).cast("long").alias("p"), "url", F.concat(F.lit("source_xmltv:"), F.col("sf")).alias("origin"))
    every = found.union(own)
    outputs = F.when(F.col("dummy"), F.array("channel_name")).otherwise(F.array("channel_name", "epg_id"))
    return every.select(F.explode(outputs).alias("output_id"), "tier", "p", "url", "origin").groupBy("output_id").agg(F.min(F.struct("tier", "p", "url", "origin")).alias("x")).select("output_id", "x.url", "x.origin")


#: Columns of a mapping that may hold an icon, in the order in which they count: fixed values.
ICON_COLUMNS = ["icon_url", "stream_icon", "tvg_logo", "tvg-logo", "channel_icon", "logo"]


def mapping_icon(columns: list[str]) -> Column:
    """The first safe icon address of a mapping's row, null without one."""
    found = [safe_url(F.col(f"`{c}`")) for c in ICON_COLUMNS if c in columns]
    return F.coalesce(*found) if found else F.lit(None).cast("string")
