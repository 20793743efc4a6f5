"""Every registered query against its DuckDB SQL on the sf0.01 driver tables."""

import pytest

import __spark_entry__ as E
from cinelens.queries import QUERIES
from oracle_check import compare, duck

from paths import SF01


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_oracle_sql():
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, SF01)
    assert res["ok"], res


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle_with_ansi_off(spark, con, name):
    # a caller's session may run with ANSI off (e.g. size(NULL) is -1 there)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        res = compare(spark, con, name, SF01)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert res["ok"], res
