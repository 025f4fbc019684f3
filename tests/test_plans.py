"""Plan guards: no cartesian products; nested-loop joins only where the
build side is one broadcast row (the centroid-array metrics)."""
import pytest

from __spark_entry__ import oracle_sql, queries
from tests.conftest import SF01

ONE_ROW_BROADCAST = {"metric_calinski_harabasz", "metric_davies_bouldin", "metric_silhouette_sq"}


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_no_cross_joins(spark, name):
    plan = queries()[name](spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    if name not in ONE_ROW_BROADCAST:
        assert "BroadcastNestedLoopJoin" not in plan


def test_scan_prunes_and_pushes(spark):
    plan = queries()["scan_parquet"](spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_discount), GreaterThan(l_discount,0.05)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in plan
