"""Every registered query against its DuckDB SQL on the smallest tables."""

import pytest

import __spark_entry__ as E
from check_oracle import compare
from couponlens.plans.oracle import ORACLE
from couponlens.plans.registry import QUERIES

from conftest import SMALL


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, duck, name):
    ok, msg = compare(E.queries()[name](spark, SMALL), duck, ORACLE[name])
    assert ok, msg


def test_every_sql_expressible_query_has_an_oracle():
    no_sql = {"fit_trees", "importance_splits", "importance_gain", "score"}
    assert set(QUERIES) - set(ORACLE) == no_sql
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["weekday", "received", "redeemed"]
    assert df.count() == 7
