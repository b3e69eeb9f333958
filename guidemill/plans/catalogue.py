"""The operators applied to the driver's tables, and SQL that says the same.

events are programmes (user: guide id, ts: start, value: minutes, 'error' a placeholder title), customers are mapped streams and their nations categories,
parts are channel names. "Now" is 2024-01-20 00:00 UTC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guidemill.functions import text as tx
from guidemill.functions.time import iso, parse_stamp, stamp
from guidemill.operators import equivalence, export, guide, icons, mapping, resolve
from guidemill.operators.components import components

NOW = 1_705_708_800
SINCE = NOW - 3 * 86_400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def programmes(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts as timestamp_ntz))")
    e = table(spark, sf_dir, "events").withColumn("start", start)
    stop = F.when(F.col("event_id") % 7 != 0, F.col("start") + F.floor(F.col("value") * 60))
    title = F.when(F.col("event_type") == "error", "No information").otherwise(F.col("event_type"))
    return e.select(F.concat(F.lit("F"), F.col("event_id") % 3).alias("feed"), F.concat(F.lit("u"), "user_id").alias("epg_id"), "start", stop.alias("stop"), title.alias("title"))


PROG = """prog as (select 'F' || (event_id % 3) feed, 'u' || user_id epg_id, cast(floor(epoch(ts)) as bigint) start,
  case when event_id % 7 <> 0 then cast(floor(epoch(ts)) as bigint) + cast(floor(value * 60) as bigint) end stop,
  case when event_type = 'error' then 'No information' else event_type end title from events)"""
WIN = f"""{PROG}, fixed as (select feed, epg_id, start, case when stop is null or stop <= start then start + 3600 else stop end stop, title from prog),
win as (select distinct * from fixed where title <> 'No information' and stop >= {SINCE})"""


def window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guide.programme_window(programmes(spark, sf_dir), SINCE)


def raw_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    action = F.element_at(F.array(*[F.lit(x) for x in ("APPROVED", "MANUAL", "review", "AUTO_EPGSHARE", "KEEP_PANEL", "IGNORE", "APPROVED", "UNMATCHED")]), (k % 8 + 1).cast("int"))
    return table(spark, sf_dir, "customer").select(
        F.when(k % 11 == 0, " ").when(k % 13 == 0, "s2").otherwise("s1").alias("server_id"), (k % 900).cast("string").alias("stream_id"), F.col("c_nationkey").cast("string").alias("category_id"),
        F.col("c_mktsegment").alias("category_name"), F.concat(F.lit(" ch"), k % 97).alias("channel_name"), action.alias("action"), F.lit("").alias("source"),
        F.concat(F.lit("u"), k % 200).alias("epg_id"), F.when(k % 17 == 0, "Server XMLTV.php").when(k % 4 == 3, "DUMMY_CHANNELS").otherwise(F.concat(F.lit("F"), k % 4)).alias("epg_feed"), F.lit(None).cast("string").alias("reason"), k.alias("row_idx"),
    )


RAW = """raw as (select case when c_custkey % 11 = 0 then 's1' when c_custkey % 13 = 0 then 's2' else 's1' end server_id, cast(c_custkey % 900 as varchar) stream_id,
  cast(c_nationkey as varchar) category_id, c_mktsegment category_name, 'ch' || (c_custkey % 97) channel_name,
  (['APPROVED','MANUAL','review','AUTO_EPGSHARE','KEEP_PANEL','IGNORE','APPROVED','UNMATCHED'])[c_custkey % 8 + 1] "action", 'u' || (c_custkey % 200) epg_id,
  case when c_custkey % 17 = 0 then 'Server XMLTV.php' when c_custkey % 4 = 3 then 'DUMMY_CHANNELS' else 'F' || (c_custkey % 4) end epg_feed, c_custkey row_idx from customer)"""


def normal(rejected: str) -> str:
    return f"""{RAW}, norm as (select * from (select *, case when lower(epg_feed) = 'server xmltv.php' then 'panel' when epg_feed = 'DUMMY_CHANNELS' then 'dummy' else 'epgshare' end source,
  row_number() over (partition by server_id, stream_id order by row_idx desc) k from raw where server_id = 's1' and upper("action") not in ({rejected})) where k = 1),
prep as (select *, case when source = 'panel' then 'PANEL' else epg_feed end feed_key, source = 'dummy' dummy from norm)"""


REJECT = "'REVIEW','UNMATCHED','NO_EPG','UNRESOLVED','SKIP'"
PREP = normal(REJECT)


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mapping.normalize_mapping(raw_mapping(spark, sf_dir), "s1")
    return rows.withColumn("feed_key", mapping.feed_key(F.col("source"), F.col("epg_feed"))).withColumn("dummy", F.col("source") == "dummy")


def feed_order(spark: SparkSession) -> DataFrame:
    return spark.sql("select explode(array('F0','F1','F2')) feed").withColumn("rank", F.substring("feed", 2, 1).cast("int") + 1)


def q01_mapping_keep_last(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return mapping.keep_last(o, ["o_custkey"], "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


def q02_category_coverage(spark, sf_dir):
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    bal = F.col("c_acctbal")
    return mapping.category_coverage(c, ["n_name"], bal >= 5000, (bal >= 0) & (bal < 5000), bal < 0)


def q03_programme_window(spark, sf_dir):
    return window(spark, sf_dir)


def q04_panel_quality(spark, sf_dir):
    wanted = table(spark, sf_dir, "customer").select(F.concat(F.lit("U"), F.col("c_custkey") % 200).alias("epg_id")).distinct()
    p = programmes(spark, sf_dir).withColumn("start", F.when(F.col("start") % 10 != 3, F.col("start")))
    p = p.where((F.col("epg_id") != "u7") | (F.col("title") == "No information")).where((F.col("epg_id") != "u9") | (F.col("start") < NOW - 400_000))
    return guide.panel_quality(wanted, p, NOW)


def q05_schedule_metrics(spark, sf_dir):
    return guide.schedule_metrics(window(spark, sf_dir), NOW)


def q06_repeated_ids(spark, sf_dir):
    return guide.repeated_ids(prepared(spark, sf_dir))


def q07_canonical_choice(spark, sf_dir):
    return guide.canonical_schedules(prepared(spark, sf_dir), window(spark, sf_dir), feed_order(spark), NOW)


def _keyed(spark, sf_dir):
    p, w = prepared(spark, sf_dir), window(spark, sf_dir)
    return guide.effective_keys(p, guide.canonical_schedules(p, w, feed_order(spark), NOW)), w


def q08_entry_conflicts(spark, sf_dir):
    keyed, w = _keyed(spark, sf_dir)
    return guide.output_entries(keyed, w.union(w.withColumn("feed", F.lit("DUMMY_CHANNELS"))))[1]


def q09_missing_ids(spark, sf_dir):
    return guide.missing_ids(prepared(spark, sf_dir), window(spark, sf_dir))


def q10_missing_future(spark, sf_dir):
    return guide.missing_future(prepared(spark, sf_dir), window(spark, sf_dir), NOW)


def q11_programme_coverage(spark, sf_dir):
    rated = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("has_programmes"))
    return mapping.programme_coverage(table(spark, sf_dir, "documents"), rated, "doc_id", ["lang", "source"], "has_programmes", "n_chars")


def q12_feed_stats(spark, sf_dir):
    return guide.feed_stats(window(spark, sf_dir), NOW)


def q13_refresh_plan(spark, sf_dir):
    return guide.refresh_plan(guide.feed_stats(window(spark, sf_dir), SINCE - 10 * 86_400), NOW - 20 * 86_400)


def q14_action_histogram(spark, sf_dir):
    return mapping.action_histogram(raw_mapping(spark, sf_dir))


def q15_prefix_profile(spark, sf_dir):
    return resolve.prefix_profile(table(spark, sf_dir, "part"), "p_brand", F.split_part("p_name", F.lit(" "), F.lit(1)), share=0.1, enough=20)


def q16_numbered_banks(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    return resolve.numbered_banks(s, "s_nationkey", F.regexp_extract("s_name", r"^(\D+)", 1), F.regexp_extract("s_name", r"(\d+)$", 1).cast("long"))


def q17_title_normalise(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.normal_title(F.col("text")).alias("title"), tx.is_informative(F.col("text")).alias("informative"))


def q18_camel_split(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", tx.split_camel(F.concat("p_brand", "p_type", F.lit("Xy"), "p_name")).alias("name"))


def _sides(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    channels = resolve.with_keys(p.where("p_size > 10").select(F.col("p_partkey").alias("stream_id"), F.array("p_brand").alias("regions"), F.col("p_name").alias("name"), F.col("p_type").alias("category_name")), "name")
    some = p.where("p_size <= 10").select(F.concat("p_name", F.lit("."), "p_partkey").alias("epg_id"), F.concat(F.lit("F"), F.col("p_partkey") % 3).alias("feed"), F.col("p_brand").alias("region"), F.col("p_type").alias("family"), (F.col("p_partkey") % 3).alias("source_priority"), "p_name")
    return channels, resolve.with_keys(some, "p_name")


SIDES = """q as (select p_partkey stream_id, p_brand region, p_name nm, p_type category_name from part where p_size > 10),
c as (select p_name || '.' || p_partkey epg_id, 'F' || (p_partkey % 3) feed, p_brand region, p_type family, p_partkey % 3 pr, p_name nm from part where p_size <= 10)"""


def q19_strict_key_join(spark, sf_dir):
    return resolve.exact_key_match(*_sides(spark, sf_dir)).select("stream_id", "method", "score", "epg_id", "feed", "family", "alternate")


def q20_bag_key_groups(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", tx.bag_key(tx.tokens(F.concat_ws(" ", "p_type", "p_name"))).alias("bag"))
    return p.groupBy("bag").agg(F.count("*").alias("n"), F.min("p_partkey").alias("first_part"))


def q21_family_uniqueness(spark, sf_dir):
    _, c = _sides(spark, sf_dir)
    return resolve.unique_family(c.alias("c").select("c.region", "c.p_name", "c.family", resolve.preference().alias("pref")), ["region", "p_name"])


EXTRAS = ["economy", "standard", "small", "medium", "large", "promo"]


def q22_containment_join(spark, sf_dir):
    channels, c = _sides(spark, sf_dir)
    longer = resolve.with_keys(channels.select("stream_id", "regions", F.concat_ws(" ", F.lower("category_name"), "name").alias("name")), "name")
    return resolve.containment_match(longer, c, EXTRAS).select("stream_id", "method", "score", "epg_id", "feed", "family")


RULES = [(0, "Brand#2", "small (ring|bolt)", None, ["none", "small ring.0"]), (1, "Brand#3", "hot .*", "E.*Y", ["hot gear.3"]), (2, "Brand#3", "(hot|red) gear", None, ["small ring.0", "hot gear.3"]), (3, "Brand#17", "red widget", None, ["nowhere"])]


def q23_rule_join(spark, sf_dir):
    channels, _ = _sides(spark, sf_dir)
    p = table(spark, sf_dir, "part")
    known = p.select(F.concat("p_name", F.lit("."), "p_partkey").alias("epg_id"), F.lit("F0").alias("feed"), F.col("p_type").alias("family"), F.lit(1).alias("source_priority"))
    rules = spark.createDataFrame(RULES, "pos int, region string, pattern string, category_pattern string, epg_ids array<string>")
    return resolve.rule_match(channels, rules, known).select("stream_id", "method", "epg_id", "feed", "family")


def q24_ordered_fallback(spark, sf_dir):
    channels, c = _sides(spark, sf_dir)
    aliases = table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("alias")).agg(F.min("p_partkey").alias("k"))
    ids = F.array(F.concat(F.upper("alias"), F.lit("."), F.col("k") + 7), F.concat("alias", F.lit("."), F.col("k")), F.concat(F.upper("alias"), F.lit("."), F.col("k") + 50))
    aliases = aliases.select("alias", F.array().cast("array<string>").alias("regions"), ids.alias("epg_ids"))
    return resolve.ordered_lookup(channels, aliases, c, key="strict").select("stream_id", "method", "score", "epg_id", "feed", "family")


def q25_stage_waterfall(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("stream_id"), "c_acctbal", "c_mktsegment")
    rich = c.where("c_acctbal > 9000").select("stream_id", F.lit("rich").alias("method"), F.lit(100.0).alias("score"), F.concat(F.lit("r"), "stream_id").alias("epg_id"), F.lit("A").alias("feed"))
    poor = c.where("c_acctbal < 0").select("stream_id", F.lit("poor").alias("method"), F.lit("UNMATCHED").alias("action"), F.lit("below zero").alias("reason"))
    house = c.where("c_mktsegment = 'HOUSEHOLD'").select("stream_id", F.lit("house").alias("method"), F.lit(97.5).alias("score"), F.concat(F.lit("h"), "stream_id").alias("epg_id"), F.lit("B").alias("feed"))
    return resolve.first_stage(c, [rich, poor, house]).select("stream_id", "stage", "method", "score", "epg_id", "feed", "action", "reason")


def q26_topk_fuzzy(spark, sf_dir):
    return resolve.fuzzy_candidates(*_sides(spark, sf_dir), limit=5).select("stream_id", "candidate_key", "place", F.round("rough", 6).alias("rough"))


def q27_best_second_margin(spark, sf_dir):
    return resolve.fuzzy_match(*_sides(spark, sf_dir)).select("stream_id", "method", F.round("score", 6).alias("score"), "epg_id", "family", F.round("margin", 6).alias("margin"))


def _prints(spark, sf_dir):
    return equivalence.fingerprints(programmes(spark, sf_dir), NOW, horizon_hours=240, minutes=60)


def q28_fingerprint(spark, sf_dir):
    return _prints(spark, sf_dir)


def q29_similarity(spark, sf_dir):
    return equivalence.schedule_similarity(_prints(spark, sf_dir), 0, places=6)


def q30_components(spark, sf_dir):
    k = F.col("p_partkey")  # a part hangs on the part of half its number, but every fifth on itself
    edges = table(spark, sf_dir, "part").select(k.alias("a"), F.when(k % 5 != 0, F.floor(k / 2)).otherwise(k).alias("b"))
    return components(edges, "a", "b")


def q31_safe_url(spark, sf_dir):
    u, k = F.col("url"), F.col("page_id")
    url = F.when(k % 5 == 1, F.regexp_replace(u, "^https?:", "")).when(k % 5 == 2, F.replace(u, F.lit("://"), F.lit("://me:pw@"))).when(k % 5 == 3, F.concat(F.lit("file:"), u)).otherwise(u)
    return table(spark, sf_dir, "pages").select("page_id", icons.safe_url(url).alias("safe"))


def q32_icon_precedence(spark, sf_dir):
    p = prepared(spark, sf_dir)
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        F.when(k % 9 == 0, "no").otherwise("yes").alias("enabled"), F.when(k % 3 == 0, "s1").when(k % 3 == 1, "*").otherwise("s2").alias("server_id"), F.when(k % 2 == 0, F.concat(F.lit("U"), k % 50)).otherwise("").alias("epg_id"),
        F.when(k % 2 == 1, F.concat(F.lit("CH"), k % 60)).otherwise("").alias("channel_name"), F.concat(F.lit("https://icons.example/"), k, F.lit(".png")).alias("icon_url"), F.lit("").alias("local_file"), (k % 4).cast("string").alias("priority"), k.alias("row_idx"),
    )
    source = table(spark, sf_dir, "events").select(F.concat(F.lit("F"), F.col("event_id") % 3).alias("feed"), F.concat(F.lit("u"), "user_id").alias("epg_id")).distinct().withColumn("url", F.concat(F.lit("https://x.example/"), "feed", "epg_id"))
    return icons.resolve_icons(p, "s1", icons.icon_overrides(rows, "https://pub.example"), source)


def _export(spark, sf_dir):
    p = export.prepare_export(raw_mapping(spark, sf_dir), "s1", [])
    w = programmes(spark, sf_dir).where("start is not null and stop > start").select(F.upper("epg_id").alias("channel_id"), "start", "stop", "title")
    ids = w.groupBy("channel_id").agg(F.min("start").alias("pos"))
    return export.stream_keys(p, ids), w


def q33_app_payload(spark, sf_dir):
    keys, w = _export(spark, sf_dir)
    payload = export.payload_programmes(export.app_programmes(keys, w, NOW - 6 * 3600, NOW + 72 * 3600))
    return keys.join(payload.select("guide_id", F.explode("programmes").alias("p")), "guide_id").select("stream_id", "guide_id", "p.start", "p.stop", "p.title")


def q34_order_validation(spark, sf_dir):
    return guide.out_of_order(programmes(spark, sf_dir).where("stop is not null"))


def q35_tumbling_counts(spark, sf_dir):
    from guidemill.streaming.guide import tumbling_counts

    return tumbling_counts(programmes(spark, sf_dir), 6 * 3600)


def q36_stamps(spark, sf_dir):
    s = programmes(spark, sf_dir).select("start").distinct().withColumn("k", F.col("start") % 6)
    text = F.when(F.col("k") == 0, F.replace(stamp(F.col("start")), F.lit("+0000"), F.lit("+0530"))).when(F.col("k") == 1, F.substring(stamp(F.col("start")), 1, 12)).when(F.col("k") == 2, F.concat(F.substring(stamp(F.col("start")), 1, 14), F.lit(" bad"))).when(F.col("k") == 3, F.lit("20241301000000")).otherwise(stamp(F.col("start")))
    return s.select("start", text.alias("stamp"), parse_stamp(text).alias("parsed"), iso(F.col("start")).alias("iso"))


def q37_alias_memory(spark, sf_dir):
    out = mapping.alias_memory(raw_mapping(spark, sf_dir), F.trim("channel_name"), "category_id", "epg_id", "row_idx")
    return out.select("alias", "region", F.array_join("epg_ids", "|").alias("epg_ids"))


def q38_entries(spark, sf_dir):
    keyed, w = _keyed(spark, sf_dir)
    entries, _ = guide.output_entries(keyed, w)
    return entries.select("channel_id", "feed", "epg_id", "entry_type", "priority", F.array_join("display_names", "|").alias("display_names"))


def q39_safe_mapping(spark, sf_dir):
    return mapping.safe_mapping(raw_mapping(spark, sf_dir).withColumn("server_id", F.lit("s1"))).select("stream_id", "action", "epg_id", "epg_feed", "row_idx")


def q40_guide_validation(spark, sf_dir):
    w = window(spark, sf_dir)
    channels = prepared(spark, sf_dir).select(F.col("epg_id").alias("channel_id")).where("channel_id <> 'u3'")
    return guide.validate_guide(channels, w.withColumnRenamed("epg_id", "channel_id"))


def q41_equivalence_groups(spark, sf_dir):
    return equivalence.group_labels(equivalence.equivalence_groups(_prints(spark, sf_dir), least_rows=3, least_similarity=0.12)).select("label", F.array_join("members", "|").alias("members"))


def q42_near_exact_join(spark, sf_dir):
    channels, c = _sides(spark, sf_dir)
    return resolve.near_exact_match(channels, c, 40.0).select("stream_id", "method", F.round("score", 6).alias("score"), "epg_id", "family")


MARKETS = [(0, "category", "auto|mach", ["US", "CA"], 3), (1, "name", "[02468]$", ["IN"], 3), (2, "name", "7$", ["UK"], 4), (3, "category", "build", ["DE"], 1), (4, "name", "11", ["FR"], 1)]


def q43_route_plan(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("stream_id"), F.col("c_name").alias("channel_name"), F.col("c_mktsegment").alias("category_name"))
    markets = spark.createDataFrame(MARKETS, "pos int, field string, pattern string, regions array<string>, strength int")
    return resolve.route_plan(c, markets).select("stream_id", F.array_join("regions", "|").alias("regions"))


def q44_callsign_join(spark, sf_dir):
    letters = lambda k: F.concat(F.char(65 + k % 5), F.char(65 + F.floor(k / 5) % 4), F.char(65 + F.floor(k / 20) % 3))
    k = F.col("c_custkey")
    channels = table(spark, sf_dir, "customer").select(k.alias("stream_id"), F.concat(F.lit("News "), F.when(k % 2 == 0, "W").otherwise("K"), letters(k), F.when(k % 3 == 0, "-DT2").otherwise("")).alias("channel_name"))
    s = F.col("s_suppkey")
    c = table(spark, sf_dir, "supplier").select(F.concat(F.lit("id"), s).alias("epg_id"), F.lit("F1").alias("feed"), F.concat(F.lit("f"), s % 70).alias("family"), (s % 4).alias("source_priority"), F.concat(F.when(s % 2 == 0, "W").otherwise("K"), letters(s), F.lit(" TV")).alias("display_name"))
    return resolve.callsign_match(channels, resolve.with_keys(c, "display_name"), display="display_name").select("stream_id", "score", "epg_id", "family")


def q45_extension_join(spark, sf_dir):
    channels, c = _sides(spark, sf_dir)
    longer = resolve.with_keys(c.select("epg_id", "feed", "region", "family", "source_priority", F.concat_ws(" ", "p_name", F.lower("family")).alias("name")), "name")
    return resolve.extension_match(channels, longer, ["economy", "small", "large"]).select("stream_id", "score", "epg_id", "family")


def q46_multiset_difference(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.split(F.concat_ws(" ", "p_name", F.lower("p_type"), "p_name"), " ").alias("a"), F.split(F.concat_ws(" ", F.lower("p_type"), F.lit("ring"), "p_name"), " ").alias("b"))
    return p.select("p_partkey", F.array_join(F.array_sort(resolve.multiset_difference(F.col("a"), F.col("b"))), " ").alias("rest"))


def q47_resolve(spark, sf_dir):
    """The whole waterfall: parts over size 10 are channels of the markets that their brands stand for, the others a catalogue; every stage that plain names can reach decides some."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    market = F.element_at(F.array(*[F.lit(x) for x in RESOLVE_MARKETS]), (F.substring("p_brand", 7, 3).cast("int") % 4 + 1))
    wrapped = F.when(k % 29 == 0, F.concat(F.lit("### "), F.upper("p_name"), F.lit(" ###"))).when(k % 3 == 0, F.concat(F.lower(market), F.lit(": "), F.initcap("p_name"), F.lit(" HD"))).when(k % 3 == 1, F.concat("p_name", F.lit(" ("), market, F.lit(")"))).otherwise(F.concat_ws(" ", F.split_part("p_name", F.lit(" "), F.lit(2)), F.split_part("p_name", F.lit(" "), F.lit(1))))
    channels = p.where("p_size > 10").select(k.alias("stream_id"), wrapped.alias("channel_name"), F.concat(market, F.lit(" | things")).alias("category_name"), F.when(k % 5 == 0, F.concat(F.lit("P"), k % 100)).alias("panel_epg_id"))
    c = p.where("p_size <= 10").select(F.concat(F.replace("p_name", F.lit(" "), F.lit(".")), F.lit(".us"), k).alias("epg_id"), F.concat(F.lit("F"), k % 3).alias("feed"), market.alias("region"), (k % 3).cast("int").alias("source_priority"))
    c = c.where("region <> 'FR'")
    dummies = spark.createDataFrame([("Blank", "Blank.d"), ("Plate", "Plate.d")], "name string, epg_id string")
    known = spark.createDataFrame([(0, "old anvil", ["US", "CA"], ["nowhere", "blue.gear.us0"], {}, []), (1, "gizmo hot", ["ALL"], ["gone"], {}, [])], "pos int, alias string, regions array<string>, epg_ids array<string>, timeshift_epg_ids map<string,array<string>>, required_languages array<string>")
    rules = spark.createDataFrame([(0, "US", "new .*", None, ["none"])], "pos int, region string, pattern string, category_pattern string, epg_ids array<string>")
    special = spark.createDataFrame([(0, "^(plate|.* plate)$", "plate"), (1, "^(anvil red|red anvil)$", None)], "pos int, pattern string, dummy_name string")
    panel = spark.createDataFrame([(f"p{x}", "USABLE" if x % 2 else "STALE_PAST_ONLY") for x in range(0, 100, 5)], "epg_id string, status string")
    out = resolve.resolve(channels, c, dummies, known, rules, special, panel, review=False)
    return out.select("stream_id", F.col("core").alias("name"), F.array_join("regions", "|").alias("regions"), "method", "score", "epg_id", "feed", "alternate", "action", "source")


RESOLVE_MARKETS = ["US", "CA", "UK", "FR"]


def q48_similarity_tolerance(spark, sf_dir):
    return equivalence.schedule_similarity(_prints(spark, sf_dir), 1, places=6)


QUERIES = {k: f for k, f in dict(globals()).items() if k[0] == "q" and k[1:3].isdigit()}

CANON = f"""{PREP}, {WIN}, met as (select feed, epg_id, count(*) programme_rows, count(*) filter (stop > {NOW}) future_rows, max(stop) latest_stop,
  coalesce(max(stop) filter (stop > {NOW}), 0) latest_future_stop from win where stop > start group by all),
mapd as (select epg_id, feed_key feed, count(*) mapped_streams from prep where not dummy group by all),
cand as (select m.*, coalesce(programme_rows, 0) programme_rows, coalesce(future_rows, 0) future_rows, coalesce(latest_stop, 0) latest_stop, coalesce(latest_future_stop, 0) latest_future_stop,
  case when m.feed = 'PANEL' then 0 when m.feed in ('F0', 'F1', 'F2') then cast(substr(m.feed, 2) as int) + 1 else 100000 end rnk from mapd m left join met using (feed, epg_id)),
choice as (select * from (select *, string_agg(feed, ' | ' order by feed) over (partition by epg_id rows between unbounded preceding and unbounded following) candidate_feeds0,
  row_number() over (partition by epg_id order by (programme_rows > 0)::int desc, (future_rows > 0)::int desc, latest_future_stop desc, future_rows desc, programme_rows desc, mapped_streams desc, latest_stop desc, rnk, feed desc) k from cand) where k = 1 and programme_rows > 0),
keyed as (select p.*, case when dummy then feed_key else coalesce(c.feed, feed_key) end ef from prep p left join (select epg_id, feed from choice) c using (epg_id))"""

TITLE = "trim(regexp_replace(replace(lower(strip_accents(text)), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"
_EMPTY = ", ".join(f"'{x}'" for x in tx.EMPTY_TITLES)
PRINTS = f"{PROG}, prints as (select distinct epg_id, cast(floor(start / 3600) as bigint) bucket, title from prog where start <= {NOW} + 240 * 3600 and coalesce(stop, start + 3600) >= {NOW} and title <> 'No information')"
EXP = normal(REJECT + ",'IGNORE','REJECTED'")


#: prints -> alike: pairs of ids, each title's buckets in order with the nearest that is left within one.
_SIMILAR = """n as (select epg_id, count(*) n from prints group by all), ids as (select distinct a.epg_id a, b.epg_id b, a.title from prints a join prints b on a.title = b.title and abs(a.bucket - b.bucket) <= 1 and a.epg_id < b.epg_id),
      l as (select epg_id, title, list_sort(list(bucket)) k from prints group by all), start as (select a, b, x.k xs, y.k ys, title from ids join l x using (title) join l y using (title) where x.epg_id = a and y.epg_id = b),
      walk(a, b, title, i, xs, rest, same) as (select a, b, title, 1, xs, ys, 0 from start union all
        select a, b, title, i + 1, xs, case when f is null then rest else list_filter(rest, lambda z: z <> f) end, same + (f is not null)::int from (select *, case when list_contains(rest, xs[i]) then xs[i] when list_contains(rest, xs[i] - 1) then xs[i] - 1 when list_contains(rest, xs[i] + 1) then xs[i] + 1 end f from walk where i <= len(xs))),
      t as (select a, b, cast(sum(same) as bigint) same from walk where i = len(xs) + 1 group by a, b),
      alike as (select t.a, t.b, same, round(same / greatest(x.n, y.n), 6) similarity, same / greatest(x.n, y.n) similarity0, x.n na, y.n nb from t join n x on x.epg_id = t.a join n y on y.epg_id = t.b)"""


def _entries(available: str) -> str:
    """names and ids in order of arrival, with the running best before each."""
    return f"""{CANON}, have as ({available}), found as (select k.* from keyed k semi join have h on k.ef = h.feed and k.epg_id = h.epg_id),
names as (select channel_name channel_id, channel_name nm, ef, epg_id, case when ef = 'PANEL' then 300 when dummy then 100 else 250 end pr, 'channel_name' et, 0 k0, row_idx n0, stream_id from found),
ids as (select distinct f.epg_id channel_id, f.channel_name nm, g.ef, f.epg_id, 400 pr, 'canonical_epg_id' et, 1 k0, 0 n0, '' stream_id from found f join (select epg_id, arg_min(ef, row_idx) ef from found where not dummy group by epg_id) g using (epg_id) where not f.dummy),
arr as (select * from names union all select * from ids)"""


ORACLE_SQL = {
    "q01_mapping_keep_last": "select o_custkey, o_orderkey, o_orderstatus, o_totalprice from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) k from orders) where k = 1",
    "q02_category_coverage": """select n_name, count(*) channels, count(*) filter (c_acctbal >= 5000) matched, count(*) filter (c_acctbal >= 0 and c_acctbal < 5000) review, count(*) filter (c_acctbal < 0) unmatched,
      round(count(*) filter (c_acctbal >= 5000) * 100.0::double / count(*), 2) match_percent from customer join nation on c_nationkey = n_nationkey group by n_name""",
    "q03_programme_window": f"with {WIN} select feed, epg_id, start, stop, title from win",
    "q04_panel_quality": f"""with {PROG}, w as (select distinct 'U' || (c_custkey % 200) epg_id from customer),
      p as (select lower(epg_id) id, case when start % 10 <> 3 then start end start, stop, title from prog), p2 as (select id, start, case when stop is null or stop <= start then start + 3600 else stop end stop, title from p where (id <> 'u7' or title = 'No information') and (id <> 'u9' or start < {NOW} - 400000)),
      a as (select id, count(*) total_rows, count(*) filter (title <> 'No information' and start is not null) informative_rows, count(*) filter (title <> 'No information' and start is not null and stop >= {NOW}) live_rows,
        count(*) filter (title = 'No information') placeholder_rows, count(*) filter (title <> 'No information' and start is null) invalid_rows, max(stop) filter (title <> 'No information' and start is not null and stop >= {NOW}) latest_stop from p2 group by id)
      select epg_id, coalesce(total_rows, 0) total_rows, coalesce(informative_rows, 0) informative_rows, coalesce(live_rows, 0) live_rows, coalesce(placeholder_rows, 0) placeholder_rows, coalesce(invalid_rows, 0) invalid_rows, latest_stop,
        case when live_rows > 0 then 'USABLE' when informative_rows > 0 then 'STALE_PAST_ONLY' when total_rows > 0 then 'NO_USEFUL_INFORMATION' else 'NOT_IN_PANEL_XMLTV' end status from w left join a on lower(epg_id) = id""",
    "q05_schedule_metrics": f"with {WIN} select feed, epg_id, count(*) programme_rows, count(*) filter (stop > {NOW}) future_rows, max(stop) latest_stop, coalesce(max(stop) filter (stop > {NOW}), 0) latest_future_stop, coalesce(min(start) filter (stop > {NOW}), 0) earliest_future_start from win where stop > start group by feed, epg_id",
    "q06_repeated_ids": f"with {PREP} select epg_id, string_agg(distinct feed_key, ' | ' order by feed_key) candidate_feeds, count(distinct feed_key) candidate_feed_count from prep where not dummy group by epg_id having count(distinct feed_key) > 1",
    "q07_canonical_choice": f"with {CANON} select epg_id, feed chosen_feed, programme_rows, future_rows, latest_future_stop, mapped_streams, (select string_agg(distinct m.feed, ' | ' order by m.feed) from mapd m where m.epg_id = choice.epg_id) candidate_feeds from choice",
    "q08_entry_conflicts": f"""with {_entries("select distinct feed, epg_id from win union select distinct 'DUMMY_CHANNELS', epg_id from win")},
      st as (select *, max({{'pr': pr, 'k': -k0, 'n': -n0, 'ef': ef, 'epg_id': epg_id}}) over (partition by channel_id order by k0, n0 rows between unbounded preceding and 1 preceding) kept from arr)
      select distinct channel_id, kept.ef kept_feed, kept.epg_id kept_epg_id, ef candidate_feed, epg_id candidate_epg_id, stream_id, case when pr > kept.pr then 'used_candidate' else 'kept_existing' end resolution from st where kept is not null and (kept.ef <> ef or kept.epg_id <> epg_id)""",
    "q09_missing_ids": f"""with {PREP}, {WIN}, m as (select * from prep p anti join win w on w.feed = p.feed_key and w.epg_id = p.epg_id), f as (select feed_key, epg_id, channel_name, min(row_idx) a, count(*) n from m group by all),
      r as (select *, row_number() over (partition by feed_key, epg_id order by a, channel_name) k from f) select feed_key, epg_id, cast(sum(n) as bigint) streams, string_agg(channel_name, ' | ' order by a, channel_name) filter (k <= 10) channel_names from r group by all""",
    "q10_missing_future": f"""with {PREP}, {WIN}, m as (select * from prep p anti join (select * from win where stop > {NOW}) w on w.feed = p.feed_key and w.epg_id = p.epg_id where not dummy), f as (select feed_key, epg_id, channel_name, min(row_idx) a, count(*) n from m group by all),
      r as (select *, row_number() over (partition by feed_key, epg_id order by a, channel_name) k from f) select feed_key, epg_id, cast(sum(n) as bigint) streams, string_agg(channel_name, ' | ' order by a, channel_name) filter (k <= 10) channel_names from r group by all""",
    "q11_programme_coverage": """with r as (select d.lang, d.source, l.quality from documents d left join labels l using (doc_id)) select lang, source, count(*) channels, count(quality) mapped, count(*) filter (quality = 1) with_programmes,
      round(count(quality) * 100.0::double / count(*), 2) mapped_percent, round(count(*) filter (quality = 1) * 100.0::double / count(*), 2) programme_percent from r group by lang, source""",
    "q12_feed_stats": f"with {WIN}, i as (select feed, epg_id, count(*) n, min(start) a, max(stop) b from win group by all) select feed, count(*) ids, cast(sum(n) as bigint) programme_rows, count(*) filter (b > {NOW}) future_ids, min(a) first_start, max(b) latest_stop, min(b) earliest_id_end from i group by feed",
    "q13_refresh_plan": f"""with {WIN}, i as (select feed, epg_id, max(stop) b from win group by all), s as (select feed, min(b) e from i group by feed), l as (select arg_min(feed, (e, feed)) limiting_feed, min(e) guide_end from s)
      select limiting_feed, guide_end, false missing, greatest({NOW} - 20 * 86400, guide_end - 12 * 3600) refresh_at, strftime(make_timestamp(greatest({NOW} - 20 * 86400, guide_end - 12 * 3600) * 1000000), '%Y-%m-%dT%H:%M:%SZ') refresh_at_utc from l""",
    "q14_action_histogram": f'with {RAW} select "action", count(*) n from raw group by "action"',
    "q15_prefix_profile": """with r as (select p_brand category, split_part(p_name, ' ', 1) prefix from part), t as (select category, count(*) total from r group by all), c as (select category, prefix, count(*) n from r group by all)
      select category, prefix, n, round(n * 100.0::double / total, 2) share_percent from c join t using (category) where n >= 2 and (n >= 0.1 * total or n >= 20)""",
    "q16_numbered_banks": r"select s_nationkey category, regexp_extract(s_name, '^(\D+)', 1) base, count(distinct cast(regexp_extract(s_name, '(\d+)$', 1) as bigint)) slots, count(*) channels, min(cast(regexp_extract(s_name, '(\d+)$', 1) as bigint)) first_slot, max(cast(regexp_extract(s_name, '(\d+)$', 1) as bigint)) last_slot from supplier group by all having slots >= 3",
    "q17_title_normalise": f"select doc_id, {TITLE} title, {TITLE} not in ({_EMPTY}) and not regexp_full_match({TITLE}, '(no|not)\\s+((programme|program|event|epg|schedule)\\s+)?(information\\s*)?(available|unavailable)?') informative from documents",
    "q18_camel_split": r"select p_partkey, regexp_replace(regexp_replace(p_brand || p_type || 'Xy' || p_name, '([a-z0-9])([A-Z])', '\1 \2', 'g'), '([A-Z]+)([A-Z][a-z])', '\1 \2', 'g') as name from part",
    "q19_strict_key_join": f"""with {SIDES}, m as (select stream_id, c.*, row_number() over (partition by stream_id order by pr, length(c.epg_id), lower(c.epg_id)) k, count(distinct family) over (partition by stream_id rows between unbounded preceding and unbounded following) f from q join c using (region, nm))
      select stream_id, 'strict' as "method", 100.0::double score, epg_id, feed, family, (select epg_id from m n where n.stream_id = m.stream_id and n.k = 2) alternate from m where k = 1 and f = 1""",
    "q20_bag_key_groups": "select array_to_string(list_sort(string_split(lower(p_type || ' ' || p_name), ' ')), ' ') bag, count(*) n, min(p_partkey) first_part from part group by all",
    "q21_family_uniqueness": f"""with {SIDES}, m as (select c.*, row_number() over (partition by region, nm order by pr, length(epg_id), lower(epg_id)) k, count(distinct family) over (partition by region, nm rows between unbounded preceding and unbounded following) f from c)
      select region, nm p_name, family, epg_id, feed, (select epg_id from m n where n.region = m.region and n.nm = m.nm and n.k = 2) alternate from m where k = 1 and f = 1""",
    "q22_containment_join": f"""with {SIDES}, qq as (select stream_id, region, list_distinct(string_split(lower(category_name) || ' ' || nm, ' ')) w from q), cc as (select *, string_split(nm, ' ') w2 from c),
      m as (select stream_id, cc.*, len(w2) n from qq join cc using (region) where list_has_all(w, w2) and len(w2) >= 2 and len(list_filter(w, lambda x: not list_contains(w2, x))) > 0 and list_has_all({EXTRAS!r}, list_filter(w, lambda x: not list_contains(w2, x)))),
      t as (select * from m qualify n = max(n) over (partition by stream_id)), u as (select *, row_number() over (partition by stream_id order by pr, length(epg_id), lower(epg_id)) k, count(distinct family) over (partition by stream_id rows between unbounded preceding and unbounded following) f from t)
      select stream_id, 'regional_context_containment' as "method", 97.5::double score, epg_id, feed, family from u where k = 1 and f = 1""",
    "q23_rule_join": f"""with {SIDES}, r(pos, region, pat, cpat, ids) as (values (0, 'Brand#2', 'small (ring|bolt)', null, ['none', 'small ring.0']), (1, 'Brand#3', 'hot .*', 'E.*Y', ['hot gear.3']), (2, 'Brand#3', '(hot|red) gear', null, ['small ring.0', 'hot gear.3']), (3, 'Brand#17', 'red widget', null, ['nowhere'])),
      k as (select p_name || '.' || p_partkey epg_id, p_type family from part), e as (select stream_id, pos, unnest(ids) id, generate_subscripts(ids, 1) ip from q join r using (region) where regexp_full_match(nm, pat) and (cpat is null or regexp_matches(category_name, cpat)))
      select stream_id, 'verified_rule' as "method", epg_id, 'F0' feed, family from (select *, row_number() over (partition by stream_id order by pos, ip) z from e join k on lower(id) = lower(epg_id)) where z = 1""",
    "q24_ordered_fallback": f"""with {SIDES}, a as (select p_name al, min(p_partkey) k from part group by all), i as (select al, unnest([upper(al) || '.' || (k + 7), al || '.' || k, upper(al) || '.' || (k + 50)]) id, unnest([0, 1, 2]) ip from a)
      select stream_id, 'approved_knowledge' as "method", 100.0::double score, epg_id, feed, family from (select *, row_number() over (partition by stream_id order by ip) z from q join i on nm = al join (select epg_id, feed, family from c) c on lower(id) = lower(epg_id)) where z = 1""",
    "q25_stage_waterfall": """select c_custkey stream_id, case when c_acctbal > 9000 then 0 when c_acctbal < 0 then 1 when c_mktsegment = 'HOUSEHOLD' then 2 end stage, case when c_acctbal > 9000 then 'rich' when c_acctbal < 0 then 'poor' when c_mktsegment = 'HOUSEHOLD' then 'house' else 'unmatched' end as "method",
      case when c_acctbal > 9000 then 100.0::double when c_acctbal < 0 then null when c_mktsegment = 'HOUSEHOLD' then 97.5 end score, case when c_acctbal > 9000 then 'r' || c_custkey when c_acctbal < 0 then null when c_mktsegment = 'HOUSEHOLD' then 'h' || c_custkey end epg_id,
      case when c_acctbal > 9000 then 'A' when c_acctbal < 0 then null when c_mktsegment = 'HOUSEHOLD' then 'B' end feed, case when c_acctbal > 9000 or c_acctbal >= 0 and c_mktsegment = 'HOUSEHOLD' then 'AUTO_EPGSHARE' else 'UNMATCHED' end as "action",
      case when c_acctbal > 9000 then '' when c_acctbal < 0 then 'below zero' when c_mktsegment = 'HOUSEHOLD' then '' else 'no stage decided' end reason from customer""",
    "q28_fingerprint": f"with {PRINTS} select epg_id, bucket, title from prints",
    "q29_similarity": f"with {PRINTS}, n as (select epg_id, count(*) n from prints group by all), m as (select a.epg_id a, b.epg_id b, count(*) same from prints a join prints b on a.title = b.title and a.bucket = b.bucket and a.epg_id < b.epg_id group by all) select m.a, m.b, same, round(same / greatest(x.n, y.n), 6) similarity from m join n x on x.epg_id = m.a join n y on y.epg_id = m.b",
    "q47_resolve": """with p as (select *, (['US', 'CA', 'UK', 'FR'])[cast(substr(p_brand, 7, 3) as int) % 4 + 1] market, string_split(p_name, ' ') w, p_partkey k from part),
      q as (select k stream_id, market, case when k % 3 = 2 and k % 29 <> 0 then w[2] || ' ' || w[1] else p_name end nm, case when k % 29 = 0 then '### ' || upper(p_name) || ' ###' when k % 3 = 0 then array_to_string(list_transform(w, lambda x: upper(x[1]) || x[2:]), ' ') || ' HD' when k % 3 = 1 then p_name else w[2] || ' ' || w[1] end "name",
          k % 29 = 0 heading, case when k % 5 = 0 then 'P' || (k % 100) end pid, k % 5 = 0 and (k % 100) % 2 = 1 usable from p where p_size > 10),
      c as (select replace(p_name, ' ', '.') || '.us' || k epg_id, 'F' || (k % 3) feed, market, k % 3 pr, p_name nm, array_to_string(list_sort(w), ' ') bag from p where p_size <= 10 and market <> 'FR'),
      have as (select distinct market from c),
      m as (select stream_id, q.nm = c.nm strict, c.*, row_number() over (partition by stream_id, q.nm = c.nm order by pr, length(c.epg_id), lower(c.epg_id)) r from q join c on q.market = c.market and array_to_string(list_sort(string_split(q.nm, ' ')), ' ') = c.bag),
      best as (select stream_id, strict, epg_id, feed, (select epg_id from m n where n.stream_id = m.stream_id and n.strict = m.strict and n.r = 2) alternate0 from m where r = 1),
      bags as (select stream_id, epg_id, row_number() over (partition by stream_id order by pr, length(epg_id), lower(epg_id)) r, feed from m),
      s as (select q.*, a.epg_id id1, a.feed feed1, a.alternate0 alt1, b.epg_id id2, b.feed feed2, b2.epg_id alt2,
          case when heading then 0 when regexp_full_match(nm, 'plate|.* plate') then 1 when regexp_full_match(nm, 'anvil red|red anvil') then 2 when q.market not in (select market from have) and usable then 3 when q.market not in (select market from have) then 4 when a.epg_id is not null then 5 when b.epg_id is not null then 6 when usable then 7 else 8 end st
        from q left join best a on a.stream_id = q.stream_id and a.strict left join bags b on b.stream_id = q.stream_id and b.r = 1 left join bags b2 on b2.stream_id = q.stream_id and b2.r = 2)
      select stream_id, case when heading then '### ' || upper(nm) || ' ###' else "name" end as "name", market regions, (['heading_placeholder', 'safety_rule', 'safety_rule', 'panel', 'unsupported_catalog_scope', 'canonical_identity', 'token_multiset', 'panel', 'unmatched'])[st + 1] as "method",
        ([100.0, 100.0, 100.0, 100.0, null, 100.0, 98.5, 100.0, null]::double[])[st + 1] score, case st when 0 then 'Blank.d' when 1 then 'Plate.d' when 3 then pid when 5 then id1 when 6 then id2 when 7 then pid end epg_id,
        case st when 0 then 'DUMMY_CHANNELS' when 1 then 'DUMMY_CHANNELS' when 3 then 'server xmltv.php' when 5 then feed1 when 6 then feed2 when 7 then 'server xmltv.php' end feed, case st when 5 then alt1 when 6 then alt2 end alternate,
        (['AUTO_DUMMY', 'AUTO_DUMMY', 'UNMATCHED', 'KEEP_PANEL', 'UNMATCHED', 'AUTO_EPGSHARE', 'AUTO_EPGSHARE', 'KEEP_PANEL', 'UNMATCHED'])[st + 1] as "action", (['dummy', 'dummy', '', 'panel', '', 'epgshare', 'epgshare', 'panel', ''])[st + 1] as source from s""",
    "q48_similarity_tolerance": f"with recursive {PRINTS}, {_SIMILAR} select a, b, same, similarity from alike",
    "q41_equivalence_groups": f"""with recursive {PRINTS}, {_SIMILAR}, e as (select a u, b v from alike where similarity0 >= 0.12 and least(na, nb) >= 3 union select b, a from alike where similarity0 >= 0.12 and least(na, nb) >= 3), reach(u, v) as (select u, v from e union select r.u, e.v from reach r join e on r.v = e.u),
      top as (select u, min(v) component from reach group by u) select sha256(string_agg(lower(u), '|' order by lower(u)))[1:24] label, string_agg(lower(u), '|' order by lower(u)) members from top group by component""",
    "q42_near_exact_join": f"""with recursive {SIDES}, k as (select q.stream_id, string_split(q.nm, ' ') a, string_split(c.nm, ' ') b, c.epg_id, c.pr, c.family from q join c using (region)),
      m as (select *, case when a[1] = b[1] then a[2] when a[2] = b[2] then a[1] when a[1] = b[2] then a[2] else a[1] end x, case when a[1] = b[1] then b[2] when a[2] = b[2] then b[1] when a[1] = b[2] then b[1] else b[2] end y from k where len(a) = 2 and len(b) = 2 and (a[1] = b[1]) <> (a[2] = b[2]) or len(a) = 2 and len(b) = 2 and (a[1] = b[2]) <> (a[2] = b[1]) and a[1] <> b[1] and a[2] <> b[2]),
      w(x, y, i, best) as (select distinct x, y, 0, list_transform(range(0, length(y) + 1), lambda j: 0) from m where x <> y union all
        select x, y, i + 1, list_transform(range(1, length(y) + 2), lambda j: list_max(list_transform(range(1, j + 1), lambda k: greatest(best[k], case when k > 1 and x[i + 1] = y[k - 1] then best[k - 1] + 1 else 0 end)))) from w where i < length(x)),
      r as (select x, y, 200.0::double * best[length(y) + 1] / (length(x) + length(y)) score from w where i = length(x)), s as (select m.*, score from m join r using (x, y) where score >= 40), t as (select * from s qualify score = max(score) over (partition by stream_id)),
      u as (select *, row_number() over (partition by stream_id order by pr, length(epg_id), lower(epg_id)) z, count(distinct family) over (partition by stream_id rows between unbounded preceding and unbounded following) f from t)
      select stream_id, 'near_exact_orthography' as "method", round(score, 6) score, epg_id, family from u where z = 1 and f = 1""",
    "q30_components": "with recursive up(node, top) as (select p_partkey, p_partkey from part union select p_partkey // 2, p_partkey // 2 from part where p_partkey % 5 <> 0 union select node, top // 2 from up where top % 5 <> 0) select node, min(top) component from up group by node",
    "q31_safe_url": "select page_id, case when page_id % 5 = 1 then 'https:' || regexp_replace(url, '^https?:', '') when page_id % 5 in (2, 3) then null else url end safe from pages",
    "q32_icon_precedence": f"""with {PREP}, o as (select c_custkey k, case when c_custkey % 3 = 0 then 's1' when c_custkey % 3 = 1 then '*' else 's2' end scope, case when c_custkey % 2 = 0 then 'epg_id' else 'channel_name' end b, case when c_custkey % 2 = 0 then 'u' || (c_custkey % 50) else 'ch' || (c_custkey % 60) end ky,
        'https://icons.example/' || c_custkey || '.png' url, (c_custkey % 4) * 1000000 - c_custkey pr from customer where c_custkey % 9 <> 0), p as (select distinct epg_id, channel_name, feed_key, dummy from prep),
      s as (select distinct 'F' || (event_id % 3) feed, 'u' || user_id epg_id from events), f as (select p.*, (case when scope = 's1' then 0 else 2 end) + (case when b = 'epg_id' then 0 else 1 end) tier, -pr np, url, 'config' origin from p join o on (b = 'epg_id' and ky = p.epg_id or b = 'channel_name' and ky = p.channel_name) where scope <> 's2'
        union all select p.*, 9, 0, 'https://x.example/' || s.feed || s.epg_id, 'source_xmltv:' || s.feed from p join s on s.feed = p.feed_key and s.epg_id = p.epg_id), e as (select channel_name output_id, tier, np, url, origin from f union all select epg_id, tier, np, url, origin from f where not dummy)
      select output_id, url, origin from (select *, row_number() over (partition by output_id order by tier, np, url, origin) z from e) where z = 1""",
    "q33_app_payload": f"""with {EXP}, {PROG}, w as (select upper(epg_id) channel_id, start, stop, title from prog where stop > start), ids as (select distinct channel_id from w),
      i as (select stream_id, unnest(case when dummy then [channel_name, epg_id] else [epg_id, channel_name] end) id, unnest([0, 1]) pos from prep), k as (select stream_id, arg_min(channel_id, pos) guide_id from i join ids on lower(id) = lower(channel_id) group by stream_id),
      g as (select distinct channel_id, start, stop, title from w where stop > {NOW} - 6 * 3600 and start < {NOW} + 72 * 3600) select stream_id, guide_id, start, stop, title from k join g on channel_id = guide_id""",
    "q34_order_validation": f"""with {PROG}, s as (select *, lag(stop) over (partition by epg_id order by start, stop, title) b from prog where stop is not null) select epg_id, count(*) as "rows", count(*) filter (stop <= start) reversed, count(*) filter (start < b) overlapping from s group by epg_id""",
    "q35_tumbling_counts": f"with {PROG} select feed, cast(floor(start / 21600) * 21600 as bigint) window_start, count(*) programmes, count(distinct epg_id) ids from prog where start is not null group by all",
    "q36_stamps": f"""with {PROG}, s as (select distinct start, strftime(make_timestamp(start * 1000000), '%Y%m%d%H%M%S') t from prog) select start, case start % 6 when 0 then t || ' +0530' when 1 then t[1:12] when 2 then t || ' bad' when 3 then '20241301000000' else t || ' +0000' end as stamp,
      case start % 6 when 0 then start - 19800 when 1 then start - cast(t[13:14] as bigint) when 3 then null else start end parsed, strftime(make_timestamp(start * 1000000), '%Y-%m-%dT%H:%M:%SZ') iso from s""",
    "q37_alias_memory": f"""with {RAW}, f as (select channel_name alias, category_id region, epg_id, min(row_idx) a from raw where upper("action") in ('MANUAL', 'APPROVED') group by all) select alias, region, string_agg(epg_id, '|' order by a, epg_id) epg_ids from f group by all""",
    "q38_entries": f"""with {_entries("select distinct feed, epg_id from win")}, b as (select channel_id, max({{'pr': pr, 'k': -k0, 'n': -n0, 'ef': ef, 'epg_id': epg_id, 'et': et}}) x, min({{'k': k0, 'n': n0, 'et': et, 'pr': pr, 'ef': ef, 'epg_id': epg_id}}) f, string_agg(distinct nm, '|' order by nm) display_names from arr group by channel_id)
      select channel_id, x.ef feed, x.epg_id epg_id, case when x.ef = f.ef and x.epg_id = f.epg_id then f.et else x.et end entry_type, case when x.ef = f.ef and x.epg_id = f.epg_id then f.pr else x.pr end priority, display_names from b""",
    "q39_safe_mapping": f"""with {RAW} select stream_id, "action", epg_id, epg_feed, row_idx from (select *, row_number() over (partition by stream_id order by row_idx desc) k from raw where "action" in ('AUTO_DUMMY', 'AUTO_EPGSHARE', 'KEEP_PANEL', 'MANUAL', 'APPROVED')) where k = 1""",
    "q40_guide_validation": f"""with {PREP}, {WIN}, c as (select epg_id, count(*) n from prep where epg_id <> 'u3' group by all) select cast((select sum(n) from c) as bigint) channels, (select count(*) from c where n > 1) repeated_channels, 0::bigint blank_channels, (select count(*) from win w anti join c on c.epg_id = w.epg_id) undeclared_programmes, (select count(*) from win) programmes, 0::bigint blank_titles""",
    "q43_route_plan": """with m as (select c_custkey, case when regexp_matches(lower(c_mktsegment), 'auto|mach') then 3 when regexp_matches(lower(c_mktsegment), 'build') then 1 else 0 end cs, case when regexp_matches(lower(c_mktsegment), 'auto|mach') then 'US|CA|' when regexp_matches(lower(c_mktsegment), 'build') then 'DE|' else '' end cr,
      case when regexp_matches(c_name, '7$') then 4 when regexp_matches(c_name, '[02468]$') then 3 when regexp_matches(c_name, '11') then 1 else 0 end ns, case when regexp_matches(c_name, '7$') then 'UK|' when regexp_matches(c_name, '[02468]$') then 'IN|' when regexp_matches(c_name, '11') then 'FR|' else '' end nr from customer)
      select c_custkey stream_id, (case when cs > ns then cr else nr end) || 'ALL' regions from m""",
    "q44_callsign_join": """with q as (select c_custkey stream_id, (case when c_custkey % 2 = 0 then 'W' else 'K' end) || chr(cast(65 + c_custkey % 5 as int)) || chr(cast(65 + (c_custkey // 5) % 4 as int)) || chr(cast(65 + (c_custkey // 20) % 3 as int)) sign from customer),
      c as (select 'id' || s_suppkey epg_id, 'f' || (s_suppkey % 70) family, s_suppkey % 4 pr, (case when s_suppkey % 2 = 0 then 'W' else 'K' end) || chr(cast(65 + s_suppkey % 5 as int)) || chr(cast(65 + (s_suppkey // 5) % 4 as int)) || chr(cast(65 + (s_suppkey // 20) % 3 as int)) sign from supplier)
      select stream_id, 99.0::double score, epg_id, family from (select *, row_number() over (partition by stream_id order by pr, length(epg_id), epg_id) k, count(distinct family) over (partition by stream_id rows between unbounded preceding and unbounded following) f from q join c using (sign)) where k = 1 and f = 1""",
    "q45_extension_join": f"""with {SIDES}, w as (select *, string_split(nm || ' ' || lower(family), ' ') w2 from c), m as (select stream_id, w.*, list_filter(list_distinct(w2), lambda x: not list_contains(string_split(q.nm, ' '), x)) e from q join w using (region) where list_has_all(w2, string_split(q.nm, ' '))),
      t as (select *, row_number() over (partition by stream_id order by pr, len(w2), length(epg_id), lower(epg_id)) k, count(distinct family) over (partition by stream_id rows between unbounded preceding and unbounded following) f from m where len(e) between 1 and 2 and list_has_all(['economy', 'small', 'large'], e))
      select stream_id, 97.0::double score, epg_id, family from t where k = 1 and f = 1""",
    "q46_multiset_difference": """with p as (select p_partkey, unnest(string_split(p_name || ' ' || lower(p_type) || ' ' || p_name, ' ')) w, 1 n from part union all select p_partkey, unnest(string_split(lower(p_type) || ' ring ' || p_name, ' ')), -1 from part),
      d as (select p_partkey, w, sum(n) n from p group by all having sum(n) > 0), r as (select p_partkey, w, unnest(generate_series(1, cast(n as bigint))) from d) select k.p_partkey, coalesce((select string_agg(w, ' ' order by w) from r where r.p_partkey = k.p_partkey), '') rest from part k""",
}
