"""Registered queries against their DuckDB oracle SQL on the smallest tables,
plus the driver contract (entry, queries, oracle_sql)."""

import pytest

import __spark_entry__ as E
from barlab.plans.check import compare, duck
from tests.conftest import SF_SMOKE

# every registered query with SQL; the numbered ones have tests of their own
KEYS = sorted(k for k in E.oracle_sql() if not k.startswith("op") and k != "pipeline")


def test_contract(spark):
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 90
    df = E.entry(spark)
    assert df.columns == ["symbol", "ts", "dt", "close", "ema_9", "ema_21", "trend_up"]
    assert df.count() > 0


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMOKE)


@pytest.mark.parametrize("name", KEYS)
def test_query_matches_oracle(spark, con, name):
    qs, sqls = E.queries(), E.oracle_sql()
    sdf = qs[name](spark, SF_SMOKE).toPandas()
    ddf = con.execute(sqls[name]).df()
    r = compare(sdf, ddf)
    assert r["ok"], r
