"""Schedules that say the same: fingerprints, their similarity, and groups of ids whose schedules agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guidemill.functions.text import is_informative, normal_title
from guidemill.functions.time import bucket
from guidemill.operators import blocks
from guidemill.operators.components import components
from guidemill.sources.tables import written


def fingerprints(programmes: DataFrame, now: int, horizon_hours: int = 72, minutes: int = 5, folded: bool = False) -> DataFrame:
    """epg_id, bucket, title: the distinct (start bucket, normal title) of programmes that start within the horizon and haven't ended; one without a stop ends after an hour."""
    rows = programmes.where((F.col("start") <= now + horizon_hours * 3600) & (F.coalesce("stop", F.col("start") + 3600) >= now) & is_informative(F.col("title"), folded))
    return rows.select("epg_id", bucket(F.col("start"), minutes).alias("bucket"), normal_title(F.col("title"), folded).alias("title")).distinct()


def fingerprint_summary(prints: DataFrame, requested: DataFrame) -> DataFrame:
    """One row for each requested id, also without programmes: rows, first and last bucket."""
    got = prints.groupBy("epg_id").agg(F.count("*").alias("rows"), F.min("bucket").alias("first_bucket"), F.max("bucket").alias("last_bucket"))
    return requested.select("epg_id").distinct().join(got, "epg_id", "left").fillna(0, ["rows"])


def _matched(left: Column, right: Column, tolerance: int) -> Column:
    """How many buckets of left, in order, find one of right: each takes the nearest that is left within the tolerance, of two the earlier."""
    start = F.struct(F.array_sort(right).alias("rest"), F.lit(0).alias("n"))

    def step(state, bucket):
        near = F.filter(F.transform(state["rest"], lambda x: F.struct(F.abs(x - bucket).alias("d"), x.alias("x"))), lambda y: y["d"] <= tolerance)
        found = F.array_min(near)["x"]
        return F.when(found.isNull(), state).otherwise(F.struct(F.filter(state["rest"], lambda x: x != found).alias("rest"), (state["n"] + 1).alias("n")))

    return F.aggregate(F.array_sort(left), start, step, lambda state: state["n"])


def candidate_pairs(prints: DataFrame, least: float) -> DataFrame:
    """a < b of ids whose titles alone allow a similarity of `least`.

    Matched rows share their title, so of a's n rows, as a multiset of titles, ceil(least * n) must be b's, too: two such ids share one of the n - ceil(least * n) + 1
    rarest titles of each. Ids meet by those only, so titles that every guide has bring none together; sizes must allow the similarity as well."""
    order = Window.partitionBy("epg_id", "title").orderBy("bucket")
    often = prints.groupBy("title").agg(F.count("*").alias("often"))
    rows = prints.withColumn("k", F.row_number().over(order)).join(often, "title")
    whole = Window.partitionBy("epg_id")
    rows = rows.withColumn("n", F.count("*").over(whole)).withColumn("rank", F.row_number().over(whole.orderBy("often", "title", "k")))
    rare = rows.where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1).select("epg_id", "title", "k", "n")
    p, q = rare.alias("p"), rare.alias("q")
    met = p.join(q, (F.col("p.title") == F.col("q.title")) & (F.col("p.k") == F.col("q.k")) & (F.col("p.epg_id") < F.col("q.epg_id")) & (F.least("p.n", "q.n") >= least * F.greatest("p.n", "q.n") - 1e-9))
    return met.select(F.col("p.epg_id").alias("a"), F.col("q.epg_id").alias("b")).distinct()


def same_schedules(prints: DataFrame) -> DataFrame:
    """Classes of ids with equal fingerprints: members in order, node (the first of them), n (rows). An id with repeated rows or rows without title or bucket is a class of its own."""
    odd = F.max(F.col("title").isNull() | F.col("bucket").isNull())
    got = prints.where("epg_id is not null").groupBy("epg_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_set(F.struct("title", "bucket"))).alias("said"), odd.alias("odd"))
    own = F.when(F.col("odd") | (F.size("said") < F.col("n")), F.col("epg_id"))
    return got.groupBy(own.alias("own"), "said", "n").agg(F.array_sort(F.collect_list("epg_id")).alias("members")).select(F.element_at("members", 1).alias("node"), "members", "n")


def schedule_similarity(prints: DataFrame, tolerance: int = 1, pairs: DataFrame | None = None, places: int | None = None) -> DataFrame:
    """a, b (a < b), similarity of ids that share a title within the tolerance: matched rows, title by title, over the larger number of rows; rounded to `places`, if given.

    Ids meet by title and bucket only, or, if they are given, are the pairs (a, b); each title's rows of two ids are matched one to one, a's in order of time with the nearest
    of b's that is left. Ids with equal fingerprints are compared with others once; no pair is shuffled."""
    if pairs is not None:
        return _similar(prints, tolerance, pairs).select("a", "b", "same", (F.round("similarity", places) if places is not None else F.col("similarity")).alias("similarity"))
    prints = written(prints, "prints")
    classes = written(same_schedules(prints), "classes")
    return _similar(prints.join(classes.select(F.col("node").alias("epg_id")), "epg_id", "left_semi"), tolerance, None, classes, places)


def _similar(prints: DataFrame, tolerance: int, pairs: DataFrame | None = None, classes: DataFrame | None = None, places: int | None = None) -> DataFrame:
    """a, b, same and similarity, a's rows taking b's, of all ids, or members of classes, that share a title; of pairs also back and back_similarity, b's taking a's."""
    if pairs is None:
        return blocks.pairs(prints, tolerance, classes, places)
    sizes = prints.groupBy("epg_id").agg(F.count("*").alias("n"))
    near = lambda df: df.select(*[c for c in df.columns if c != "bucket"], "bucket", F.explode(F.sequence(F.col("bucket") - tolerance, F.col("bucket") + tolerance)).alias("at")) if tolerance else df.withColumn("at", F.col("bucket"))
    p = pairs.join(prints.toDF(*["a" if c == "epg_id" else c for c in prints.columns]), "a").select("a", "b", "title", F.col("bucket").alias("x"))
    q = near(prints).select(F.col("epg_id").alias("b"), "title", F.col("bucket").alias("y"), "at")
    rows = p.alias("p").join(q.alias("q"), (F.col("p.b") == F.col("q.b")) & (F.col("p.title") == F.col("q.title")) & (F.col("p.x") == F.col("q.at"))).select("a", "p.b", "p.title", "x", "y").distinct()
    if tolerance == 0:
        counts = rows.groupBy("a", "b").agg(F.count("*").alias("same")).withColumn("back", F.col("same"))
    else:
        by_title = rows.groupBy("a", "b", "title").agg(F.collect_set("x").alias("x"), F.collect_set("y").alias("y"))
        counts = by_title.select("a", "b", _matched(F.col("x"), F.col("y"), tolerance).alias("n"), _matched(F.col("y"), F.col("x"), tolerance).alias("m")).groupBy("a", "b").agg(F.sum("n").alias("same"), F.sum("m").alias("back"))
    sized = counts.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b")
    share = lambda c: (F.col(c) / F.greatest("na", "nb")).alias({"same": "similarity", "back": "back_similarity"}[c])
    return sized.select("a", "b", "same", share("same"), "back", share("back"))


def equivalence_groups(prints: DataFrame, least_rows: int = 8, least_similarity: float = 0.92, tolerance: int = 1) -> DataFrame:
    """node, component of ids with at least least_rows rows whose schedules agree; chains of agreeing ids are one group."""
    prints = written(prints, "prints")
    enough = prints.groupBy("epg_id").agg(F.count("*").alias("n")).where(F.col("n") >= least_rows).select("epg_id")
    prints = prints.join(enough, "epg_id", "left_semi")
    classes = written(same_schedules(prints), "classes")
    prints = prints.join(classes.select(F.col("node").alias("epg_id")), "epg_id", "left_semi")
    if least_similarity < 0.5:  # nearly all titles are among an id's rarest
        near = blocks.links(prints, tolerance, classes, least_similarity)
    else:
        last = classes.select(F.col("node").alias("a"), F.array_max("members").alias("last"))
        # a's first member is before b's; b's rows take a's only in pairs whose member of b comes first
        near = _similar(prints, tolerance, candidate_pairs(prints, least_similarity)).join(last, "a").where((F.col("similarity") >= least_similarity) | (F.col("last") > F.col("b")) & (F.col("back_similarity") >= least_similarity))
    copies = classes.where(F.size("members") > 1).select("node", F.explode("members").alias("b")).where("node <> b")
    return components(near.select("a", "b").union(copies), "a", "b")


def group_labels(groups: DataFrame) -> DataFrame:
    """component, label, members: a label from the sorted members in small letters."""
    out = groups.groupBy("component").agg(F.array_sort(F.collect_set(F.lower("node"))).alias("members"))
    return out.select("component", F.substring(F.sha2(F.array_join("members", "|"), 256), 1, 24).alias("label"), "members")
