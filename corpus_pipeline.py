"""The corpus pipeline: quality, toxicity, near duplicates, mixing, packing. Each stage is written as Parquet and read by the next one.

Stages need doc_id, text and source, and keep all columns that documents have, whatever their names; the last returns pieces. Every stage takes an empty table and gives
an empty one, and works on whole texts; what it does with nulls and repeated rows its docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guidemill.llm.common import written
from guidemill.llm.mixing import mix_sources
from guidemill.llm.ngram_join import ngram_jaccard_join
from guidemill.llm.packing import best_fit_packing
from guidemill.llm.quality import quality_classifier
from guidemill.llm.queries import table, tokenizer_path
from guidemill.llm.toxicity import toxicity
from guidemill.sources.session import shipped


def _apart(docs: DataFrame, taken: list[str]) -> tuple[DataFrame, list]:
    """docs with other names for columns whose names an operator takes, and the columns that give them theirs back."""
    names = {c: c for c in docs.columns}
    for c in names:
        while names[c].lower() in taken:
            names[c] = f"{names[c]}_"
            while names[c] in docs.columns:
                names[c] += "_"
    return docs.withColumnsRenamed({c: n for c, n in names.items() if c != n}), [F.col(n).alias(c) for c, n in names.items()]


@shipped
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps. Its model is fitted on the rated rows of this stage's documents.

    Null text counts as empty and is judged like any other; rows without an id and repeated rows are judged each by itself. Without ratings of two grades every
    row has the one grade there is; without any, all stay."""
    docs, back = _apart(docs, ["expected_grade", "tail_probability", "keep"])
    return quality_classifier(docs, table(spark, sf_dir, "labels")).where("keep").select(back)


@shipped
def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't toxic.

    Null text counts as empty, which isn't toxic unless ratings say so; rows without an id and repeated rows are judged each by itself. Without ratings of two grades
    every row has the one grade there is, or 0."""
    docs, back = _apart(docs, ["expected_severity", "toxic_probability", "toxic"])
    return toxicity(docs, table(spark, sf_dir, "labels")).where("not toxic").select(back)


@shipped
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest doc_id (rows without one last), of rows with that id the one with the smallest hash.

    Rows are told apart by a hash of all they hold, not by doc_id: rows that share an id but not a text are different documents, and of rows that are
    equal in all columns one stays. Documents without words, null text among them, are nobody's duplicates and all stay."""
    plain = [F.col(c) for c, t in docs.dtypes if "map<" not in t and "variant" not in t]
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"), F.xxhash64(*plain).alias("key"))
    said = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    found = ngram_jaccard_join(rows.where(said).select("key", "text"), width=5, percent=80, id_col="key").select(F.col("doc_id").alias("key"), "component_id").distinct()
    ids = rows.where(said).select("key", "id").distinct()
    first = ids.join(found, "key").groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("without"), "id", "key"))["key"].alias("key")).select("key")
    one = rows.where(said).groupBy("key").agg(F.first("row").alias("row")).join(first, "key", "left_semi")
    return one.select("row.*").union(rows.where(~said).select("row.*"))


@shipped
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    Null text has no words and null sources are one source; documents without words come along only as often as all of their source do. Rows without an id and
    repeated rows are taken each by itself."""
    docs, back = _apart(docs, ["doc_size", "source_size", "target", "copies"])
    mixed = mix_sources(docs).where("copies > 0")
    return mixed.select(F.struct(back).alias("row"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


@shipped
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens.

    Null text is a piece of the end token alone; rows without an id and repeated rows are packed each by itself."""
    out = best_fit_packing(docs, tokenizer_path(), capacity=2048, end_id=0, keep_ids=False)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality classifier", quality_stage),
    ("toxicity", toxicity_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: The classifiers and the packing cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
