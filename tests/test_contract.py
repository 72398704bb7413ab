"""The driver contract: names, the flagship query, and a few SQL comparisons."""

import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 140


@needs_data
def test_flagship_query(spark):
    rows = {r["assignment_class"]: r["n_features"] for r in entry.entry(spark).collect()}
    assert rows["TOTAL"] == sum(v for k, v in rows.items() if k != "TOTAL") > 0


@needs_data
@pytest.mark.parametrize("name", ["feature_classes", "tier_coverage", "source_agreement", "reference_losses"])
def test_queries_equal_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted(str(tuple(r[names.index(c)] for c in cols)) for r in cur.fetchall())
    assert sorted(str(tuple(r[c] for c in cols)) for r in df.collect()) == want
