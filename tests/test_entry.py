"""The driver contract: entry runs; every query has a matching oracle that
DuckDB agrees with (checked at sf0.001 for speed)."""

import hashlib
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
NO_ORACLE = set()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert "fire_alert" in df.columns and df.count() >= 0


def test_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = {k for k in q if not k.startswith("op") and k != "pipeline"}
    assert own - set(o) == NO_ORACLE


def _h(df):
    df = df[sorted(df.columns)]
    rows = sorted(repr(tuple(r)) for r in df.itertuples(index=False, name=None))
    return len(rows), hashlib.sha256("\n".join(rows).encode()).hexdigest()


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", sorted(k for k in E.queries() if not k.startswith("op") and k != "pipeline"))
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("events", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = E.queries()[name](spark, SF).toPandas()
    want = con.execute(E.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert _h(got) == _h(want)
