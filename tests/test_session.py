"""What the package does to the session's driver."""

from guidemill.sources import session
from guidemill.sources.tables import remove, written


def test_the_jvm_gives_freed_memory_back(spark):
    assert session.give_back(spark).startswith("Trim native heap")


def test_a_jvm_that_cannot_is_left_alone():
    class Other:
        _jvm = sparkContext = None

    assert session.give_back(Other()) is None


def test_written_tables_give_memory_back_now_and_then(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(session, "give_back", asked.append)
    monkeypatch.setattr(session, "_trimmed", float("-inf"))
    for _ in range(2):
        remove(written(spark.range(3), "some"))
    assert asked == [spark]
    monkeypatch.setattr(session, "TRIM_SECONDS", 0)
    remove(written(spark.range(3), "some"))
    assert asked == [spark, spark]
