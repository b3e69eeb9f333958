"""Approved mappings: normal form, latest row of a stream, feed keys, coverage by category, alias memory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COLUMNS = ["server_id", "stream_id", "category_id", "category_name", "channel_name", "action", "source", "epg_id", "epg_feed", "reason"]
#: Other names of columns: fixed values.
OTHER_NAMES = {"epg_id": ["selected_epg_id", "chosen_epg_id"], "epg_feed": ["selected_feed", "chosen_feed"]}
REJECTED = ["REVIEW", "UNMATCHED", "NO_EPG", "UNRESOLVED", "SKIP"]
REJECTED_BY_EXPORT = [*REJECTED, "IGNORE", "REJECTED"]
SAFE = ["AUTO_DUMMY", "AUTO_EPGSHARE", "KEEP_PANEL", "MANUAL", "APPROVED"]
PANEL_FEED, DUMMY_FEED, PANEL = "server xmltv.php", "DUMMY_CHANNELS", "PANEL"


def keep_last(df: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """The last row of each key in the given order, which must be total for a result that doesn't change."""
    by = [(F.col(x) if isinstance(x, str) else x).desc_nulls_last() for x in order]
    return df.withColumn("__place", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where("__place = 1").drop("__place")


def keep_first(df: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    by = [(F.col(x) if isinstance(x, str) else x).asc_nulls_first() for x in order]
    return df.withColumn("__place", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where("__place = 1").drop("__place")


def normalize_mapping(frame: DataFrame, server_id: str, row_col: str = "row_idx", rejected: list[str] = REJECTED) -> DataFrame:
    """The usable rows of one server's mapping, the last of each stream, in the ten columns as trimmed strings.

    row_col numbers the rows as they came. A blank server is the expected one. Rejected actions count in any case; a blank source follows the feed."""
    for name, others in OTHER_NAMES.items():
        for other in others:
            if name not in frame.columns and other in frame.columns:
                frame = frame.withColumn(name, F.col(other))
    text = {c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) if c in frame.columns else F.lit("") for c in COLUMNS}
    out = frame.withColumns(text).withColumn("server_id", F.when(F.col("server_id") == "", server_id).otherwise(F.col("server_id")))
    out = out.where((F.col("server_id") == server_id) & ~F.upper("action").isin(rejected))
    for c in ("stream_id", "channel_name", "epg_id", "epg_feed"):
        out = out.where(F.col(c) != "")
    by_feed = F.when(F.lower("epg_feed") == PANEL_FEED, "panel").when(F.col("epg_feed") == DUMMY_FEED, "dummy").otherwise("epgshare")
    out = out.withColumn("source", F.when(F.col("source") == "", by_feed).otherwise(F.col("source")))
    return keep_last(out, ["server_id", "stream_id"], row_col).select(*COLUMNS, row_col)


def feed_key(source: Column, feed: Column, registered: Column | None = None) -> Column:
    """PANEL for the server's own guide; a feed that is registered in capitals goes by that name; others as they are."""
    panel = (F.lower(F.trim(source)) == "panel") | (F.lower(F.trim(feed)) == PANEL_FEED)
    named = F.trim(feed) if registered is None else F.when(registered, F.upper(F.trim(feed))).otherwise(F.trim(feed))
    return F.when(panel, PANEL).otherwise(named)


def prepare_mapping(frame: DataFrame, server_id: str, registry: DataFrame, row_col: str = "row_idx") -> DataFrame:
    """normalize_mapping() with feed_key and dummy (the feed is a dummy one). No usable row, or a feed that the registry (name, kind) lacks, is an error."""
    rows = normalize_mapping(frame, server_id, row_col)
    names = registry.select(F.upper("name").alias("__name"), (F.col("kind") == "dummy").alias("__dummy"))
    out = rows.join(names, F.upper(F.trim("epg_feed")) == F.col("__name"), "left")
    out = out.withColumn("feed_key", feed_key(F.col("source"), F.col("epg_feed"), F.col("__name").isNotNull()))
    out = out.withColumn("dummy", F.coalesce("__dummy", F.lit(False)) & (F.col("feed_key") != PANEL))
    unknown = [r[0] for r in out.where((F.col("feed_key") != PANEL) & F.col("__name").isNull()).select("feed_key").distinct().orderBy("feed_key").limit(10).collect()]
    if unknown:
        raise ValueError(f"feeds that are not registered: {', '.join(unknown)}")
    if out.isEmpty():
        raise ValueError(f"no usable mapping row for {server_id}")
    return out.drop("__name", "__dummy")


def safe_mapping(report: DataFrame, row_col: str = "row_idx") -> DataFrame:
    """Rows of a match report that may be built from without review, the last of each stream."""
    rows = report.where(F.col("action").isin(SAFE) & (F.coalesce("epg_id", F.lit("")) != "") & (F.coalesce("epg_feed", F.lit("")) != ""))
    return keep_last(rows, ["server_id", "stream_id"], row_col)


def category_coverage(report: DataFrame, category: list[str], matched: Column, review: Column, unmatched: Column) -> DataFrame:
    """For each category, null ones too: channels, matched, review, unmatched and match_percent; most first."""
    ones = lambda x: F.sum(x.cast("int")).cast("long")
    out = report.groupBy(*category).agg(F.count("*").alias("channels"), ones(matched).alias("matched"), ones(review).alias("review"), ones(unmatched).alias("unmatched"))
    out = out.withColumn("match_percent", F.round(F.col("matched") * 100.0 / F.col("channels"), 2))
    return out.orderBy(F.desc("matched"), F.desc("channels"), *category)


def programme_coverage(catalog: DataFrame, mapping: DataFrame, key: str, category: list[str], has_programmes: str, catalog_order: str) -> DataFrame:
    """For each category of the catalogue (its first row of a key): channels, those mapped, those with programmes, and both percentages."""
    first = keep_first(catalog, [key], catalog_order)
    rows = first.join(mapping.select(key, F.col(has_programmes).alias("__has")), key, "left")
    mapped = F.col("__has").isNotNull()
    out = rows.groupBy(*category).agg(F.count("*").alias("channels"), F.sum(mapped.cast("int")).cast("long").alias("mapped"), F.sum(F.when(F.col("__has"), 1).otherwise(0)).cast("long").alias("with_programmes"))
    share = lambda a, b: F.round(F.when(F.col(b) > 0, F.col(a) * 100.0 / F.col(b)).otherwise(0.0), 2)
    return out.withColumns({"mapped_percent": share("mapped", "channels"), "programme_percent": share("with_programmes", "channels")})


def action_histogram(report: DataFrame, action: str = "action") -> DataFrame:
    return report.groupBy(action).agg(F.count("*").alias("n"))


def alias_memory(mapping: DataFrame, alias: Column, region: str, guide_id: str, order: str) -> DataFrame:
    """Distinct ids of each alias and region in order of arrival, of approved rows only."""
    rows = mapping.where(F.upper("action").isin("MANUAL", "APPROVED")).select(alias.alias("alias"), F.col(region).alias("region"), F.col(guide_id).alias("id"), F.col(order).alias("at"))
    first = rows.groupBy("alias", "region", "id").agg(F.min("at").alias("at"))
    return first.groupBy("alias", "region").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "id"))), lambda x: x["id"]).alias("epg_ids"))


def mapping_digest(mapping: DataFrame, columns: list[str]) -> DataFrame:
    """One row: a digest of the rows as a multiset, so neither their order nor partitioning counts: SHA-256 of their number and of four sums of 64-bit hashes of them.

    The sums are made where the rows are; nothing is collected."""
    row = F.to_json(F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))
    sums = [F.coalesce(F.sum(F.xxhash64(F.lit(k), row).cast("decimal(38,0)")), F.lit(0)).cast("string").alias(f"s{k}") for k in range(4)]
    out = mapping.agg(F.count("*").alias("rows"), *sums)
    return out.select(F.sha2(F.concat_ws("|", F.col("rows").cast("string"), *[f"s{k}" for k in range(4)]), 256).alias("digest"), "rows")
