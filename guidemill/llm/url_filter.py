"""URL filters by association rules, in DataFrame functions and Spark's own FP-growth only.

A labelled url is a transaction of tokens (top-level domain, registered name, host, first path segment, segments below it, all query keys, file
ending, scheme) and its label. FP-growth mines the frequent sets; rules tokens -> label stay if their support and confidence are high enough. A rule is indexed by its
rarest token: a set of tokens is compared with the rules of its own tokens only. Urls with the same tokens are judged once.

Rules that people write (host, path, verdict) come first: the longest one that fits decides.
"""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guidemill.llm.common import written

GOOD, BAD = "!good", "!bad"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; null or no ://: empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; null or no ://: empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    """The sorted tokens of a url; numbers are left out, so there are far fewer sets of tokens than urls."""
    host, path = host_of(url), path_of(url)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    size = F.size(labels)
    tail = lambda n: F.array_join(F.slice(labels, F.greatest(F.lit(1), size - n + 1), F.lit(n)), ".")
    segments = F.filter(F.split(path, "/"), lambda x: (x != "") & ~x.rlike("^[0-9]+$"))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("key:"), F.split_part(x, F.lit("="), F.lit(1))))
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1)
    one = lambda name, x: F.when(x != "", F.concat(F.lit(f"{name}:"), x))
    folded = F.transform(segments, lambda x: F.regexp_replace(x, "[0-9]+", "0"))
    first = F.when(F.size(folded) > 0, F.concat(F.lit("at:"), F.element_at(folded, 1)))
    deeper = F.transform(F.slice(folded, 2, F.greatest(F.size(folded) - 1, F.lit(0))), lambda x: F.concat(F.lit("in:"), x))
    parts = F.array(
        F.when(size > 0, one("top", tail(1))),
        F.when(size > 1, one("name", tail(2))),
        F.when(size > 2, one("site", tail(3))),
        F.when(size > 3, one("host", host)),
        first,
        one("ending", ending),
        one("scheme", F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^([A-Za-z][A-Za-z0-9+.-]*)://", 1)),
    )
    return F.array_sort(F.array_distinct(F.filter(F.concat(parts, deeper, keys), lambda x: x.isNotNull())))


def mine_rules(labelled: DataFrame, support: float = 0.005, confidence: float = 0.6, url_col: str = "url", bad_col: str = "bad") -> DataFrame:
    """Rules (tokens, key, verdict, confidence, support) that labelled urls (url, bad) support; key: the rarest token of a rule.

    Rows with a null label or without tokens don't count. A rule that a shorter one of its tokens implies with no less confidence and the same verdict
    goes. Without labelled urls there are no rules.
    Only support bounds the frequent sets: of n tokens that many urls have together there are 2**n."""
    rows = labelled.select(tokens_of(F.col(url_col)).alias("tokens"), F.col(bad_col).cast("boolean").alias("bad")).where("bad is not null and size(tokens) > 0")
    rows = written(rows.select(F.concat("tokens", F.array(F.when(F.col("bad"), BAD).otherwise(GOOD))).alias("items")), "labelled")
    schema = "tokens array<string>, key string, verdict string, confidence double, support double"
    if rows.isEmpty():
        return labelled.sparkSession.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(rows)
    counts = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    label = F.col("consequent")[0]
    rules = model.associationRules.where(label.isin(GOOD, BAD) & ~F.arrays_overlap("antecedent", F.array(F.lit(GOOD), F.lit(BAD))))
    rules = written(rules.select(F.array_sort("antecedent").alias("tokens"), F.when(label == BAD, "block").otherwise("allow").alias("verdict"), "confidence", "support"), "rules")
    keys = rules.select("tokens", "verdict", F.explode("tokens").alias("token")).join(counts, "token").groupBy("tokens", "verdict").agg(F.min(F.struct("freq", "token"))["token"].alias("key"))
    # a rule that says less has its first token among those of the one that says more
    more, less = rules.select("tokens", "verdict", "confidence", F.explode("tokens").alias("token")).alias("r"), rules.withColumn("token", F.element_at("tokens", 1)).alias("s")
    within = (F.size("s.tokens") < F.size("r.tokens")) & (F.col("s.confidence") >= F.col("r.confidence")) & (F.size(F.array_except("s.tokens", "r.tokens")) == 0)
    needless = more.join(less, (F.col("r.token") == F.col("s.token")) & (F.col("r.verdict") == F.col("s.verdict")) & within).select("r.tokens", "r.verdict").distinct()
    part = rules.join(needless, ["tokens", "verdict"], "left_anti")
    return part.join(keys, ["tokens", "verdict"]).select("tokens", "key", "verdict", "confidence", "support")


def match_rules(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """For each row of sets (tokens) that a rule fits: tokens and the verdict of the rule with the highest confidence, then support, then block first."""
    near = sets.select("tokens", F.explode("tokens").alias("key")).join(rules.select("key", F.col("tokens").alias("wanted"), "verdict", "confidence", "support"), "key")
    fits = near.where(F.size(F.array_except("wanted", "tokens")) == 0)
    return fits.groupBy("tokens").agg(F.max(F.struct("confidence", "support", "verdict"))["verdict"].alias("mined"))


def written_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule (host, path, verdict) that fits, as a struct of rule and verdict, or null. Of two the same, the one that blocks."""
    found = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.struct(F.lit(len(h + p)).alias("n"), F.lit(v).alias("verdict"), F.lit(h + p).alias("rule"))) for h, p, v in rules]
    return F.array_max(F.array(*found)) if found else F.lit(None).cast("struct<n:int,verdict:string,rule:string>")


def filter_urls(urls: DataFrame, labelled: DataFrame, rules: list[tuple[str, str, str]] = (), support: float = 0.005, confidence: float = 0.6, default: str = "allow", url_col: str = "url") -> DataFrame:
    """The rows of urls with host, path, rule, mined and verdict.

    rule: the written rule that decides, else null. mined: the verdict of the mined rules, null if none fits. verdict: the written rule's, else the
    mined one, else default. Null urls and urls without :// have an empty host and path, no tokens, and the default. Repeated rows are judged alike
    and all stay; columns of urls that have the new names are replaced. An empty table gives an empty one."""
    kept = [c for c in urls.columns if c not in ("host", "path", "rule", "mined", "verdict")]
    url = F.col(url_col)
    rows = urls.select(F.struct(*kept).alias("row"), host_of(url).alias("host"), path_of(url).alias("path"), tokens_of(url).alias("tokens"))
    sets = written(rows.select("tokens").distinct(), "sets")
    mined = written(match_rules(sets, written(mine_rules(labelled, support, confidence), "mined")), "matched")
    out = rows.join(mined, "tokens", "left").withColumn("found", written_rule(F.col("host"), F.col("path"), list(rules)))
    return out.select("row.*", "host", "path", F.col("found.rule").alias("rule"), "mined", F.coalesce("found.verdict", "mined", F.lit(default)).alias("verdict"))
