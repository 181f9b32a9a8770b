"""Every registered query equals its DuckDB oracle on the small fixture
tables (sf0.001); the driver runs the same check at sf0.01."""

import pytest

import __spark_entry__ as entry
from quayside.plans import named
from tests.oracle import compare, duck_connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = named.QUERIES, named.ORACLE


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert name in ORACLE, "every query has an oracle"
    r = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert r["ok"], r
    assert r["exact"], r
    assert not r["types"], r        # column types equal the oracle's too


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["owner_ref_num", "mfest_info_id", "readiness_state_distinct", "rec_upd_dt",
                          "rec_cre_ts"]
