"""Every query of the catalog against its SQL, and the driver's contract."""

import pytest

from oracle import connect, differences

import __spark_entry__ as contract
from shelfcurve.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(name, spark, sf_dir, con):
    df = QUERIES[name](spark, sf_dir)
    assert differences(df, con, ORACLES[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry_returns_rows(spark):
    df = contract.entry(spark)
    assert {"grp_art_id", "exp_trend_a", "exp_trend_b"} <= set(df.columns)
    assert df.where("art_grp_lvl = 3 AND brand = '-1' AND gs_fo_id = -1 AND frmt_id = -1").count() == 6
