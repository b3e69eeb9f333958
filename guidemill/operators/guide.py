"""Programme schedules: repair and window, panel quality, metrics, the best schedule of an id, output entries, refresh plan, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guidemill.functions.text import is_informative
from guidemill.functions.time import iso
from guidemill.operators.mapping import PANEL

DEFAULT_SECONDS = 3600


def repaired_stop(start: Column, stop: Column) -> Column:
    return F.when(stop.isNull() | (stop <= start), start + DEFAULT_SECONDS).otherwise(stop)


def programme_window(programmes: DataFrame, window_start: int, wanted: DataFrame | None = None, folded: bool = False) -> DataFrame:
    """feed, epg_id, start, stop, title of informative programmes with a start, stops repaired, that end at window_start or later, each once.

    wanted (feed, epg_id): only these ids in any case, in the wanted spelling; of two spellings the lower one."""
    rows = programmes.where(is_informative(F.col("title"), folded) & F.col("start").isNotNull())
    if wanted is not None:
        ids = wanted.groupBy("feed", F.lower("epg_id").alias("__id")).agg(F.min("epg_id").alias("__as"))
        rows = rows.withColumn("__id", F.lower(F.trim("epg_id"))).join(ids, ["feed", "__id"]).withColumn("epg_id", F.col("__as"))
    rows = rows.withColumn("stop", repaired_stop(F.col("start"), F.col("stop"))).where(F.col("stop") >= window_start)
    return rows.select("feed", "epg_id", "start", "stop", "title").distinct()


def panel_quality(requested: DataFrame, programmes: DataFrame, now: int, folded: bool = False) -> DataFrame:
    """For each requested epg_id (in any case): counts of its programme rows, the latest stop of current or future ones, and a status.

    A row counts once: as a placeholder before its time is looked at, then as invalid without a start."""
    wanted = requested.groupBy(F.lower(F.trim("epg_id")).alias("__id")).agg(F.min("epg_id").alias("epg_id"))
    good = is_informative(F.col("title"), folded)
    stop = repaired_stop(F.col("start"), F.col("stop"))
    timed = good & F.col("start").isNotNull()
    live = timed & (stop >= now)
    counted = programmes.groupBy(F.lower(F.trim("epg_id")).alias("__id")).agg(
        F.count("*").alias("total_rows"),
        F.count_if(timed).alias("informative_rows"),
        F.count_if(live).alias("live_rows"),
        F.count_if(~good).alias("placeholder_rows"),
        F.count_if(good & F.col("start").isNull()).alias("invalid_rows"),
        F.max(F.when(live, stop)).alias("latest_stop"),
    )
    zero = {c: F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("total_rows", "informative_rows", "live_rows", "placeholder_rows", "invalid_rows")}
    status = F.when(F.col("live_rows") > 0, "USABLE").when(F.col("informative_rows") > 0, "STALE_PAST_ONLY").when(F.col("total_rows") > 0, "NO_USEFUL_INFORMATION").otherwise("NOT_IN_PANEL_XMLTV")
    return wanted.join(counted, "__id", "left").select("epg_id", *zero.values(), "latest_stop").withColumn("status", status)


def panel_quality_unavailable(requested: DataFrame, status: str = "NOT_CHECKED") -> DataFrame:
    zero = [F.lit(0).cast("long").alias(c) for c in ("total_rows", "informative_rows", "live_rows", "placeholder_rows", "invalid_rows")]
    return requested.select("epg_id").distinct().select("epg_id", *zero, F.lit(None).cast("long").alias("latest_stop"), F.lit(status).alias("status"))


def schedule_metrics(schedules: DataFrame, now: int, by: tuple[str, ...] = ("feed", "epg_id")) -> DataFrame:
    """Programme and future rows, latest stop, latest future stop, earliest future start of each schedule; 0 where there is none."""
    rows = schedules.where("stop > start")
    future = F.col("stop") > now
    some = lambda x: F.coalesce(x, F.lit(0))
    return rows.groupBy(*by).agg(
        F.count("*").alias("programme_rows"),
        F.count_if(future).alias("future_rows"),
        some(F.max("stop")).alias("latest_stop"),
        some(F.max(F.when(future, F.col("stop")))).alias("latest_future_stop"),
        some(F.min(F.when(future, F.col("start")))).alias("earliest_future_start"),
    )


def repeated_ids(prepared: DataFrame) -> DataFrame:
    """Ids mapped on more than one real feed, and these feeds."""
    out = prepared.where(~F.col("dummy")).groupBy("epg_id").agg(F.array_sort(F.collect_set("feed_key")).alias("feeds"))
    return out.where(F.size("feeds") > 1).select("epg_id", F.array_join("feeds", " | ").alias("candidate_feeds"), F.size("feeds").cast("long").alias("candidate_feed_count"))


def canonical_schedules(prepared: DataFrame, schedules: DataFrame, feed_order: DataFrame, now: int) -> DataFrame:
    """The best schedule of each id mapped on real feeds: epg_id, chosen_feed and its metrics, candidate_feeds.

    Best is, in this order: has future rows, ends last in the future, more future rows, more rows, more mapped streams, ends last, comes first in
    feed_order (feed, rank). Ids without programmes on any feed have no choice."""
    mapped = prepared.where(~F.col("dummy")).groupBy("epg_id", F.col("feed_key").alias("feed")).agg(F.count("*").alias("mapped_streams"))
    rows = mapped.join(schedule_metrics(schedules, now), ["feed", "epg_id"], "left").join(feed_order, "feed", "left").fillna(0, ["programme_rows", "future_rows", "latest_stop", "latest_future_stop"])
    rank = F.when(F.col("feed") == PANEL, 0).otherwise(F.coalesce("rank", F.lit(100_000)))
    best = F.struct((F.col("future_rows") > 0).cast("int").alias("a"), F.col("latest_future_stop").alias("b"), F.col("future_rows").alias("c"), F.col("programme_rows").alias("d"), F.col("mapped_streams").alias("e"), F.col("latest_stop").alias("f"), (-rank).alias("g"), "feed")
    out = rows.groupBy("epg_id").agg(F.max(F.when(F.col("programme_rows") > 0, best)).alias("x"), F.array_join(F.array_sort(F.collect_set("feed")), " | ").alias("candidate_feeds"))
    out = out.where("x is not null")
    return out.select("epg_id", F.col("x.feed").alias("chosen_feed"), F.col("x.d").alias("programme_rows"), F.col("x.c").alias("future_rows"), F.col("x.b").alias("latest_future_stop"), F.col("x.e").alias("mapped_streams"), "candidate_feeds")


def effective_keys(prepared: DataFrame, choices: DataFrame) -> DataFrame:
    """prepared with effective_feed: the chosen feed of the row's id, but a dummy row keeps its own, as do ids without a choice."""
    out = prepared.join(choices.select("epg_id", "chosen_feed"), "epg_id", "left")
    return out.withColumn("effective_feed", F.when(F.col("dummy"), F.col("feed_key")).otherwise(F.coalesce("chosen_feed", "feed_key"))).drop("chosen_feed")


def output_entries(keyed: DataFrame, available: DataFrame, row_col: str = "row_idx") -> tuple[DataFrame, DataFrame]:
    """Entries of the guide and conflicts between them.

    keyed: rows of effective_keys(); available: the (feed, epg_id) that have a schedule. Every channel name, and every id on a real feed, is an entry.
    It takes the schedule of its first row, unless one of higher priority comes later (ids 400, panel 300, real feeds 250, dummies 100); all names
    of an entry count. Conflicts are rows whose schedule isn't the one that was kept when they came."""
    have = available.select(F.col("feed").alias("effective_feed"), F.col("epg_id")).distinct()
    found = keyed.join(have, ["effective_feed", "epg_id"], "left_semi")
    by_name = F.when(F.col("effective_feed") == PANEL, 300).when(F.col("dummy"), 100).otherwise(250)
    names = found.select(F.trim("channel_name").alias("channel_id"), F.trim("channel_name").alias("name"), "effective_feed", "epg_id", by_name.alias("priority"), F.lit("channel_name").alias("entry_type"), F.struct(F.lit(0).alias("k"), F.col(row_col).cast("string").alias("s"), F.col(row_col).cast("long").alias("n")).alias("at"), "stream_id")
    real = found.where(~F.col("dummy")).withColumn("name", F.trim("channel_name"))
    ids = real.groupBy("epg_id").agg(F.min(F.struct(row_col, "effective_feed"))["effective_feed"].alias("effective_feed"), F.collect_set("name").alias("names"))
    ids = ids.select(F.trim("epg_id").alias("channel_id"), F.explode("names").alias("name"), "effective_feed", "epg_id", F.lit(400).alias("priority"), F.lit("canonical_epg_id").alias("entry_type"), F.struct(F.lit(1).alias("k"), F.lit("").alias("s"), F.lit(0).cast("long").alias("n")).alias("at"), F.lit("").alias("stream_id"))
    names = names.withColumn("at", F.struct(F.col("at.k").alias("k"), F.col("at.n").alias("n")))
    ids = ids.withColumn("at", F.struct(F.col("at.k").alias("k"), F.col("at.n").alias("n")))
    rows = names.union(ids).where("channel_id <> '' and name <> ''")
    key = F.struct("effective_feed", "epg_id")
    rank = F.struct("priority", (-F.col("at.k")).alias("k"), (-F.col("at.n")).alias("n"), key.alias("key"), "entry_type")
    before = Window.partitionBy("channel_id").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    steps = rows.withColumn("rank", rank).withColumn("kept", F.max("rank").over(before))
    differs = steps.where(F.col("kept").isNotNull() & (F.col("kept.key") != key)).dropDuplicates(["channel_id", "at", "effective_feed", "epg_id", "stream_id"])
    conflicts = differs.select("channel_id", F.col("kept.key.effective_feed").alias("kept_feed"), F.col("kept.key.epg_id").alias("kept_epg_id"), F.col("effective_feed").alias("candidate_feed"), F.col("epg_id").alias("candidate_epg_id"), "stream_id", F.when(F.col("priority") > F.col("kept.priority"), "used_candidate").otherwise("kept_existing").alias("resolution"))
    # the type and priority that an entry began with stay unless another schedule takes over
    first = F.min(F.struct("at", "entry_type", "priority", key.alias("key")))
    entries = steps.groupBy("channel_id").agg(F.max("rank").alias("x"), first.alias("f"), F.array_sort(F.collect_set("name")).alias("display_names"))
    same = F.col("x.key") == F.col("f.key")
    entries = entries.select("channel_id", "display_names", F.col("x.key.effective_feed").alias("feed"), F.col("x.key.epg_id").alias("epg_id"), F.when(same, F.col("f.entry_type")).otherwise(F.col("x.entry_type")).alias("entry_type"), F.when(same, F.col("f.priority")).otherwise(F.col("x.priority")).alias("priority"))
    return entries, conflicts


def missing_ids(prepared: DataFrame, schedules: DataFrame, row_col: str = "row_idx", names: int = 10) -> DataFrame:
    """Mapped (feed_key, epg_id) without a schedule: streams, and the first `names` distinct channel names in row order."""
    have = schedules.select(F.col("feed").alias("feed_key"), "epg_id").distinct()
    rows = prepared.join(have, ["feed_key", "epg_id"], "left_anti")
    first = rows.groupBy("feed_key", "epg_id", "channel_name").agg(F.min(row_col).alias("at"), F.count("*").alias("n"))
    listed = F.transform(F.slice(F.array_sort(F.collect_list(F.struct("at", "channel_name"))), 1, names), lambda x: x["channel_name"])
    return first.groupBy("feed_key", "epg_id").agg(F.sum("n").alias("streams"), F.array_join(listed, " | ").alias("channel_names"))


def missing_future(prepared: DataFrame, schedules: DataFrame, now: int, row_col: str = "row_idx", names: int = 10) -> DataFrame:
    """As missing_ids(), for real feeds and schedules that have a row ending after now."""
    return missing_ids(prepared.where(~F.col("dummy")), schedules.where(F.col("stop") > now), row_col, names)


def feed_stats(schedules: DataFrame, now: int) -> DataFrame:
    """For each feed: ids, programme rows, ids with future rows, first start, latest stop, and the earliest of its ids' latest stops."""
    by_id = schedules.groupBy("feed", "epg_id").agg(F.count("*").alias("n"), F.min("start").alias("first_start"), F.max("stop").alias("last_stop"))
    return by_id.groupBy("feed").agg(F.count("*").alias("ids"), F.sum("n").alias("programme_rows"), F.count_if(F.col("last_stop") > now).alias("future_ids"), F.min("first_start").alias("first_start"), F.max("last_stop").alias("latest_stop"), F.min("last_stop").alias("earliest_id_end"))


def refresh_plan(stats: DataFrame, now: int, safety_hours: int = 12) -> DataFrame:
    """One row: the feed whose guide ends first, when that is, and when to build again (now if any id lacks future rows or it is past)."""
    out = stats.agg(F.min(F.struct("earliest_id_end", "feed")).alias("x"), F.coalesce(F.bool_or(F.col("future_ids") < F.col("ids")), F.lit(True)).alias("missing"))
    due = F.when(F.col("missing") | F.col("x").isNull(), F.lit(now)).otherwise(F.greatest(F.lit(now), F.col("x.earliest_id_end") - safety_hours * 3600))
    return out.select(F.col("x.feed").alias("limiting_feed"), F.col("x.earliest_id_end").alias("guide_end"), "missing", due.cast("long").alias("refresh_at"), iso(due).alias("refresh_at_utc"))


def refresh_due(last_success: int | None, now: int, every_hours: int = 72, forced: bool = False) -> bool:
    return forced or last_success is None or now - last_success >= every_hours * 3600


def validate_guide(channels: DataFrame, programmes: DataFrame) -> DataFrame:
    """One row of counts: channels, programmes, repeated channel ids, programmes of undeclared channels, blank ids and blank titles."""
    declared = channels.select("channel_id").distinct()
    counts = channels.groupBy("channel_id").count().agg(F.coalesce(F.sum("count"), F.lit(0)).alias("channels"), F.count_if(F.col("count") > 1).alias("repeated_channels"), F.count_if(F.trim("channel_id") == "").alias("blank_channels"))
    stray = programmes.join(declared, "channel_id", "left_anti").agg(F.count("*").alias("undeclared_programmes"))
    rows = programmes.agg(F.count("*").alias("programmes"), F.count_if(F.trim(F.coalesce("title", F.lit(""))) == "").alias("blank_titles"))
    return counts.crossJoin(stray).crossJoin(rows)  # one row each


def out_of_order(rows: DataFrame, key: str = "epg_id") -> DataFrame:
    """For each key: rows that don't end after their start, and neighbours in (start, stop, title) that overlap."""
    order = Window.partitionBy(key).orderBy("start", "stop", "title")
    steps = rows.withColumn("before", F.lag("stop").over(order))
    return steps.groupBy(key).agg(F.count("*").alias("rows"), F.count_if(F.col("stop") <= F.col("start")).alias("reversed"), F.count_if(F.col("start") < F.col("before")).alias("overlapping"))
