"""The queries that SQL can express against their SQL."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from oracle import connect, differences

from shelfcurve.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(name, spark, sf_dir, con):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []


def test_which_queries_have_sql():
    assert {n.split("_")[0] for n in ORACLES} == {"op4", "op6", "op10", "op11", "op12"}
