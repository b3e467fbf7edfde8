"""Every query with SQL gives DuckDB's rows on the smallest tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as spark_functions

from riskloom.operators import referrals
from riskloom.plans import capture_queries, domain_queries, landed_queries, page_queries, queries as plans, scorer_queries  # noqa: F401

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return c


def rows(values):
    show = lambda v: "" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(map(show, r)) for r in values)


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_matches_sql(spark, duck, name):
    got = plans.queries()[name](spark, SF)
    want = duck.execute(plans.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows(tuple(r) for r in got.select(*columns).collect()) == rows(want.fetchall())


@pytest.mark.parametrize("name", sorted(set(plans.queries()) - set(plans.oracle_sql())))
def test_runs(spark, name):
    assert plans.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", ["referral_metrics", "traffic_class_v2"])
def test_one_scan_of_the_facts(spark, monkeypatch, name):
    """The facts are read once, when they are rolled up; what is asked then reads the roll-up, without unions over the facts and cross joins."""
    rolled, real = [], referrals.rollup
    monkeypatch.setattr(referrals, "rollup", lambda rt: rolled.append(rt) or real(rt))
    plan = plans.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert len(rolled) == 1 and rolled[0]._jdf.queryExecution().optimizedPlan().toString().count("l_orderkey#") >= 1
    assert "l_orderkey" not in plan and "Cross" not in plan and "scalar-subquery" in plan
    assert name != "referral_metrics" or "Union" not in plan
