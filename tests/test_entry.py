"""The driver contract and a sample of oracle comparisons at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.compare import TABLES, rows_of

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["owner_id", "open_opportunity_count", "open_pipeline_value", "weighted_pipeline_value"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ["rep_scorecard", "silver_current_state", "silver_incremental_merge",
                                  "dq_reasons", "health_summary", "opportunity_snapshot", "change_feed",
                                  "silver_late_data", "gold_incremental_merge", "feed_formats", "dq_duplicate_keys"])
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    a, ac = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(E.oracle_sql()[name])
    b, bc = rows_of([d[0] for d in res.description], res.fetchall())
    assert ac == bc
    assert a == b
