"""Every query of the catalogue against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from guidemill.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = entry.queries(), entry.oracle_sql()


def plain(row):
    return repr([round(v, 9) if isinstance(v, float) else v for v in row])


@pytest.mark.parametrize("name", sorted(k for k in QUERIES if k[0] == "q"))
def test_query(spark, sf, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted(plain([r[c] for c in columns]) for r in df.collect())
    if name not in SQL:
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    found = con.sql(SQL[name])
    names = list(found.columns)
    assert sorted(names) == columns
    assert got == sorted(plain([r[names.index(c)] for c in columns]) for r in found.fetchall())


def test_rules_find_parts_of_any_number(spark, monkeypatch):
    sf = "/root/testdata/sf0.01"
    part = spark.read.parquet(f"{sf}/part.parquet").where("p_partkey > 1000").first()
    wanted = f"{part.p_name}.{part.p_partkey}"
    monkeypatch.setattr(catalogue, "RULES", [(0, "Brand#2", ".*", None, [wanted])])
    assert {r.epg_id for r in catalogue.q23_rule_join(spark, sf).collect()} == {wanted}


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
