"""What a Python worker holds at once: batches of some MB and small slices, whatever the texts; and every row still comes."""

import tracemalloc

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from guidemill.llm import ordinal
from guidemill.sources import session


def _long_texts(spark):
    return spark.range(6000).coalesce(1).select("id", F.repeat(F.lit("word "), 800).alias("text")).union(spark.range(6000, 6001).select("id", F.repeat(F.lit("word "), 2_000_000).alias("text")))


def test_batches_are_bounded_by_bytes_and_hold_all_rows(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "bytes"])

    spark.conf.unset(session.BATCH)
    try:
        got = session.shipped(lambda s: _long_texts(s).mapInArrow(sizes, "n long, bytes long"))(spark).collect()
        assert sum(r.n for r in got) == 6001
        assert max(r.bytes for r in got if r.n > 1) < 5_000_000 < max(r.bytes for r in got)  # a longer text comes by itself, whole
    finally:
        spark.conf.unset(session.BATCH)


def test_stages_bound_batches_and_leave_a_session_s_own_bound(spark, sf):
    stage, docs = corpus_pipeline.STAGES[0][1], spark.read.parquet(f"{sf}/documents.parquet")
    try:
        spark.conf.unset(session.BATCH)
        stage(spark, docs, sf)
        assert int(spark.conf.get(session.BATCH)) == session.BATCH_BYTES
        spark.conf.set(session.BATCH, "100000")
        stage(spark, docs, sf)
        assert spark.conf.get(session.BATCH) == "100000"
    finally:
        spark.conf.unset(session.BATCH)


def test_features_hold_little_more_than_a_slice():
    texts = pa.array(["A few words, and some more of them. " * 80] * 1000)
    for words_only in (True, False):
        tracemalloc.start()
        rows = sum(x[0] for x in ordinal.features(texts, words_only))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows == 1000 and peak < 25e6
