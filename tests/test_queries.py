"""Every registered query beside its SQL text, and the shape of important plans."""

import pytest
from compare import check, duck

import __spark_entry__ as entry_points
from feedloom.workload import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
# At this scale no document's journal or retry state need occur.
MAY_BE_EMPTY = {"pending_delete"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    problem = check(con, df, ORACLES.get(name))
    assert problem is None or (name in MAY_BE_EMPTY and problem == "no rows")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry_points(spark):
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert entry_points.entry(spark).columns == ["journal", "rank_in_journal", "uid"]


def _plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["topic_primary", "link_normalize", "uid_compute", "backfill_meta_plan", "digest_lines", "page_jsonld"])
def test_native_operators_stay_in_the_jvm(spark, name):
    assert "EvalPython" not in _plan(spark, name)


def test_expected_operators(spark):
    assert "LeftAnti" in _plan(spark, "seen_anti_join")
    assert "TakeOrderedAndProject" in _plan(spark, "latest_n")
    assert "LeftSemi" in _plan(spark, "doi_lookup")
    assert "WindowGroupLimit" in _plan(spark, "feed_first_n")
