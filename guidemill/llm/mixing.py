"""Mixing sources to target weights by Pareto order sampling.

Every document of a source should be taken `ratio` = target / size of the source times. The whole part of that is certain: so many copies of each
document. The words that are then still wanted come from one more copy of some documents, drawn with unequal probabilities: a document's inclusion
probability goes with size ** power, so that all of a source's together are worth the wanted words, and none is above 1. Documents are ranked by their
random odds u / (1 - u) divided by their inclusion odds p / (1 - p), and the first are taken until the wanted words are reached. u comes from a hash of
the row, so reruns agree; rows that are equal in all columns are told apart by their number in a written table.

Sizes enter the probabilities by steps of a sixteenth of a power of two, so the sums that fix them have a bounded number of rows for each source. The cut
by words needs running sums in rank order. They are taken step by step, so that no source and no group of equal rows is one task's work: over 4,096 bins
of rank, 4,096 bins of the bin that the cut is in, 4,096 bins of the hashed numbers of the rows that have the same rank, and then over what has one of those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guidemill.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """How many runs of other than ASCII white space a text has; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """source, source_size and target for a table (source, source_size) with one row for each source.

    Sources by code point, null last, have the weights in turn. Targets share the sum of all sizes by weight but stop at `most` times the size;
    what is above is shared again by weight among the others until nothing is. So a target is the lower of its stop and weight * level, where one
    level holds for all: with the stops in order of stop / weight, it is what remains after the first stops over the weights that remain.
    Every row here is a source, not a document."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    by_level = Window.orderBy("level_at", F.col("source").isNull(), "source")
    rows = sources.withColumn("place", F.row_number().over(by_name)).withColumn("weight", w).withColumn("stop", F.col("source_size") * F.lit(float(most)))
    rows = rows.withColumn("level_at", F.col("stop") / F.col("weight"))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(every)
    rows = rows.withColumn("level", (total - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    # the first source in order whose stop is not below the level of those from it on fixes the level
    level = F.min(F.when(F.col("level") <= F.col("level_at"), F.struct("level_at", "level"))).over(every)["level"]
    return rows.withColumn("found", level).select("source", "source_size", F.least("stop", F.coalesce(F.col("found") * F.col("weight"), F.col("stop"))).alias("target"))


BITS = 12  # of a step of the cut
STEPS_A_DOUBLING = 16


def _step(size: Column) -> Column:
    """The number of a size's step, a sixteenth of a power of two; 0 has none."""
    return F.when(size > 0, F.floor(F.log2(size) * STEPS_A_DOUBLING))


def _inclusion(sizes: DataFrame, targets: DataFrame, power: float) -> DataFrame:
    """source, scale: the inclusion probability of a document is scale * 2 ** (power * step / 16), at most 1.

    Probabilities times sizes add up to the wanted words of the source. With the steps in descending order, the first ones are certain; the scale is what
    the others must give over their weighted words, for the first split at which none of them is above 1."""
    weight = F.pow(F.lit(2.0), F.col("step") * (power / STEPS_A_DOUBLING))
    by_step = sizes.where("size > 0").groupBy("source", _step(F.col("size")).alias("step")).agg(F.sum("size").cast("double").alias("words")).withColumn("weight", weight)
    rows = by_step.alias("b").join(targets.where("wanted > 0").alias("t"), F.col("b.source").eqNullSafe(F.col("t.source"))).select("b.*", "wanted")
    down = Window.partitionBy("source").orderBy(F.desc("step"))
    before, rest = down.rowsBetween(Window.unboundedPreceding, -1), down.rowsBetween(0, Window.unboundedFollowing)
    rows = rows.withColumn("scale", (F.col("wanted") - F.coalesce(F.sum("words").over(before), F.lit(0.0))) / F.sum(F.col("words") * F.col("weight")).over(rest))
    fits = (F.col("scale") * F.col("weight") <= 1 + 1e-9) & (F.col("scale") >= 0)
    return rows.where(fits).groupBy("source").agg(F.max(F.struct("step", "scale"))["scale"].alias("scale"))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0, power: float = 0.5, seed: int = 11, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of docs with doc_size, source_size, target and copies; doc_size * copies is what the mix takes of a row.

    doc_size is the number of words of the whole text; null or word-less texts have 0 and, like all rows of a source of size 0, get no copies
    unless certain. power: 0 gives all documents of a source the same chance of a copy beyond the certain ones, 1 a chance in proportion to size. Null
    sources are one source. Rows without an id, with equal ids and repeated rows are taken each by itself: of equal rows as many as the target needs get
    a copy more. An empty table gives an empty one. Columns of docs that have one of the new names are hidden by the new ones. After the cut by rank,
    one more document of a source, the one whose size is nearest to the words still missing, is taken if that brings it nearer to its target."""
    names = [c for c in docs.columns if c not in ("doc_size", "source_size", "target", "copies")]
    hashed = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col), *[F.col(c) for c, t in docs.select(*names).dtypes if "map<" not in t and "variant" not in t and c not in (id_col, text_col)])
    rows = docs.select(F.struct(*names).alias("row"), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"), hashed.alias("h"), F.monotonically_increasing_id().alias("number"))
    rows = written(rows, "sizes")  # words are counted once; later steps read what they need
    slim = rows.select("source", "size", "h", "number")
    targets = source_targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = targets.withColumn("ratio", ratio).withColumn("whole", F.floor(F.col("ratio") + 1e-12))
    targets = written(targets.withColumn("wanted", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))), "targets")
    scales = _inclusion(slim, targets, power)
    plan = targets.alias("t").join(scales.alias("s"), F.col("t.source").eqNullSafe(F.col("s.source")), "left").select("t.*", "scale")
    # a row for each source, written, so that Spark knows its size and, if it is small, joins it without moving the documents
    plan = written(plan, "plan")

    u = (F.col("h").bitwiseAND((1 << 52) - 1) + 0.5) / float(1 << 52)
    p = F.when(F.col("size") > 0, F.least(F.lit(1.0), F.col("scale") * F.pow(F.lit(2.0), _step(F.col("size")) * (power / STEPS_A_DOUBLING)))).otherwise(F.lit(0.0))
    odds = u * (1 - p) / (u * (1 - p) + (1 - u) * p)  # r / (1 + r) of the ratio r of the odds: the same order, from 0 to 1
    rank = F.least(F.lit((1 << 2 * BITS) - 1), F.floor(odds * (1 << 2 * BITS)))
    tie = F.xxhash64("number").bitwiseAND((1 << BITS) - 1)
    key = lambda: F.struct(F.shiftright("rank", BITS).alias("a"), F.col("rank").bitwiseAND((1 << BITS) - 1).alias("b"), tie.alias("c"), F.col("number").alias("d"))
    with_plan = lambda df, plan: df.alias("r").join(plan.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source")))
    ranked = with_plan(slim, plan.where("wanted > 0")).select("r.*", "wanted", rank.alias("rank")).withColumn("key", key()).select("source", "size", "wanted", "key")

    # the bin that the wanted words end in, one step of the key after the other; sources whose words don't reach them have none
    edge = plan.where("wanted > 0").select("source", F.lit(0).cast("long").alias("before"))
    steps: list[str] = []
    for step in ("a", "b", "c"):
        here = with_plan(ranked, edge).where(" and ".join([f"key.{x} = t.{x}" for x in steps]) or "true").select("r.*", "before")
        by_bin = here.groupBy("source", F.col(f"key.{step}").alias(step)).agg(F.sum("size").alias("size"), F.first("wanted").alias("wanted"), F.first("before").alias("before"))
        by_bin = by_bin.withColumn("upto", F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy(step).rowsBetween(Window.unboundedPreceding, 0)))
        first = by_bin.where("upto > wanted").groupBy("source").agg(F.min(F.struct(step, (F.col("upto") - F.col("size")).alias("before"))).alias("e"))
        known = [f"t.{x}" for x in steps]
        edge = written(first.alias("f").join(edge.alias("t"), F.col("f.source").eqNullSafe(F.col("t.source"))).select("f.source", *known, "e.*"), "edge")
        steps.append(step)
    inside = with_plan(ranked, edge).where(" and ".join(f"key.{x} = t.{x}" for x in steps)).select("r.*", "before")
    cut = inside.withColumn("upto", F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy("key.d").rowsBetween(Window.unboundedPreceding, 0)))
    last = cut.where("upto <= wanted").groupBy("source").agg(F.max(F.struct("key", "upto")).alias("x")).select("source", F.col("x.key").alias("last"), F.col("x.upto").alias("reached"))
    edge = edge.alias("e").join(last.alias("l"), F.col("e.source").eqNullSafe(F.col("l.source")), "left").select("e.source", F.coalesce("last", F.struct("a", "b", "c", F.lit(-1).cast("long").alias("d"))).alias("last"), F.coalesce("reached", "before").alias("reached"))
    edge = written(edge, "edge")  # for each source the last key that is taken
    chosen = with_plan(ranked, edge).where("key > last and size > 0")
    gap = F.abs(F.col("wanted") - F.col("reached") - F.col("size"))
    extra = chosen.where(gap < F.col("wanted") - F.col("reached")).groupBy("r.source").agg(F.min(F.struct(gap.alias("gap"), "key"))["key"].alias("extra"))
    plan = plan.alias("t").join(edge.alias("e"), F.col("t.source").eqNullSafe(F.col("e.source")), "left").select("t.*", "last")
    plan = written(plan.alias("t").join(extra.alias("x"), F.col("t.source").eqNullSafe(F.col("x.source")), "left").select("t.*", "extra"), "plan")

    out = with_plan(rows, plan).withColumn("rank", rank).withColumn("key", key())
    taken = F.when((F.col("wanted") > 0) & (F.col("last").isNull() | (F.col("key") <= F.col("last")) | F.col("key").eqNullSafe(F.col("extra"))), 1).otherwise(0)
    return out.select("row.*", F.col("size").alias("doc_size"), "source_size", "target", (F.col("whole") + taken).cast("long").alias("copies"))
