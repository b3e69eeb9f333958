"""Quality classifier: cumulative-link ordinal regression on graded ratings over hashed text features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guidemill.llm import ordinal

SAMPLE = 8_000  # rated rows that the model is fitted on, at most


def quality_classifier(docs: DataFrame, ratings: DataFrame, grade_col: str = "quality", at_least: int = 1, least_probability: float = 0.5, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs with expected_grade, tail_probability = P(grade >= at_least) and keep (tail_probability >= least_probability).

    Every row is scored on its whole text; null text counts as empty. Rows without an id, repeated ids and equal rows are scored like any other.
    Without ratings of two grades all rows have the one grade there is, or 0, and those below at_least are kept only if there are no ratings at
    all. Columns of docs that have the new names are replaced."""
    model = ordinal.train(docs, ratings, grade_col, sample, words_only=False, l1=0.0, l2=1e-5, id_col=id_col, text_col=text_col)
    out = ordinal.score(docs, model, at_least, id_col, text_col)
    unrated = model.grades == [0] and not len(model.thresholds)
    return out.withColumn("keep", F.lit(True) if unrated else F.col("tail_probability") >= least_probability)
