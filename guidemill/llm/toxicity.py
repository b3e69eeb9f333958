"""Toxicity: cumulative-link ordinal regression of severity grades on sparse text features, words and their stems."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guidemill.llm import ordinal

SAMPLE = 8_000  # rated rows that the model is fitted on, at most


def toxicity(docs: DataFrame, ratings: DataFrame, grade_col: str = "toxic", at_least: int = 1, least_probability: float = 0.5, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs with expected_severity, toxic_probability = P(severity >= at_least) and toxic (toxic_probability >= least_probability).

    Every row is scored on its whole text; null text counts as empty. Rows without an id, repeated ids and equal rows are scored like any other.
    Without ratings of two grades all rows have the one grade there is, or 0. Columns of docs that have the new names are replaced. Few weights are
    other than zero (L1), so that long harmless texts gather nothing."""
    model = ordinal.train(docs, ratings, grade_col, sample, words_only=True, l1=2e-4, l2=0.0, least_docs=5, id_col=id_col, text_col=text_col)
    out = ordinal.score(docs, model, at_least, id_col, text_col, ("expected_severity", "toxic_probability"))
    return out.withColumn("toxic", F.col("toxic_probability") >= least_probability)
