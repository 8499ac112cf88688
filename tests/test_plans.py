"""Physical-plan properties that the scale design relies on."""

import pytest

from tessera.plans import queries as Q
from tessera.plans.oracle import oracle_sql
from tessera.sources import observations as O


def plan(df) -> str:
    """Analyzed, optimized and physical plan text (what ``explain(True)`` prints)."""
    return df._jdf.queryExecution().toString()


def test_lifecycle_prunes_and_pushes(spark, sf_small):
    p = plan(Q.q_lifecycle(spark, sf_small))
    assert "PushedFilters: [IsNotNull(launch_phase)]" in p
    assert "obs_key" not in p.split("ReadSchema:")[1].split("\n")[0]


def test_reports_aggregate_before_broadcast_join(spark, sf_small):
    for q in (Q.q_platform_comparison, Q.q_calendar_rollup, Q.q_genre_revenue):
        p = plan(q(spark, sf_small))
        assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p, q.__name__


def test_recast_shuffles_line_rows_once(spark, sf_small):
    p = plan(O.observations(spark, sf_small))
    assert "SortAggregate" not in p
    physical = p.split("== Physical Plan ==")[1]
    assert physical.count("REPARTITION_BY_COL") >= 1
    assert "hashpartitioning(l_partkey" in physical


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_no_cartesian_or_nested_loop(spark, sf_small, name):
    p = plan(Q.QUERIES[name](spark, sf_small))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p
