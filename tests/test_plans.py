"""Plan shape: the properties that must hold at scale."""

import re

import pytest

from tests.conftest import SF_SMALL
from tests.test_ordered_scan import assert_row_level_work_is_partitioned
from tillsight.operators import customers, products
from tillsight.plans import ordered
from tillsight.plans.ordered import checkpointed
from tillsight.registry import queries
from tillsight.sources import bindings, landed


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["get_rfm_segments", "customer_abc_segments", "customer_abc_segments_total",
                                  "product_abc_segments", "get_repurchase_rates", "get_next_purchase_date"])
def test_global_orderings_are_not_single_task(spark, name):
    assert_row_level_work_is_partitioned(queries()[name](spark, SF_SMALL))


@pytest.fixture
def stages(monkeypatch):
    """The plans of all materialised stages of a query, besides its last one."""
    seen = []

    def recording(df):
        seen.append(_plan(df))
        return checkpointed(df)

    for module in (bindings, customers, landed, ordered, products):
        monkeypatch.setattr(module, "checkpointed", recording, raising=False)
    return seen


# materialised stages per query: input grains and ordered scans
MATERIALISED = {"get_customers": 0, "get_cohort_matrix": 0, "get_latency": 0, "get_multi_brands_loyalty": 1,
                "basket_product_analytics": 1, "customer_abc_segments": 2, "replace_profile_window": 0}


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_cartesian_or_nested_loop_joins_or_python(spark, stages, name):
    plans = [_plan(queries()[name](spark, SF_SMALL)), *stages]
    for plan in plans:
        assert "CartesianProduct" not in plan
        assert "BroadcastNestedLoopJoin" not in plan
        # every registered query stays JVM-side (no Python UDF / pandas stages)
        for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "MapInArrow"):
            assert node not in plan
    assert any("FileScan parquet" in plan for plan in plans)
    if name in MATERIALISED:
        assert len(stages) == MATERIALISED[name]
    for plan in stages:  # no stage copies whole lines: sums or distinct rows, or an ordering of such
        assert "Aggregate" in plan or "ExistingRDD" in plan or "rangepartitioning" in plan


# shuffles of whole lines or grains keep the number of partitions that was asked for
DEALT = {"get_multi_brands_loyalty": ["l_orderkey", "customer_id"],
         "get_multi_brands_loyalty_returns": ["l_orderkey", "customer_id"],
         "get_repurchase_rates": ["l_orderkey", "product#\\d+L?, order_id", "order_id#\\d+L?, product"],
         "basket_product_analytics": ["l_orderkey", "order_id#\\d+L?, _ca#\\d+, _cb"],
         "basket_brand_analytics": ["l_orderkey", "order_id#\\d+L?, _ca#\\d+, _cb"]}


@pytest.mark.parametrize("name", sorted(DEALT))
def test_large_shuffles_are_not_merged_into_a_task_per_core(spark, stages, name):
    plans = "\n".join([_plan(queries()[name](spark, SF_SMALL)), *stages])
    for keys in DEALT[name]:
        assert re.search(rf"hashpartitioning\({keys}#\d+L?, 8\), REPARTITION_BY_NUM", plans), keys


def test_replaced_window_reads_the_existing_rows_twice(spark):
    plan = _plan(queries()["replace_profile_window"](spark, SF_SMALL))
    plan = plan[:plan.find("Initial Plan")] if "Initial Plan" in plan else plan
    # rows outside the window, the slice, the re-fetch and its profile list
    assert plan.count("FileScan parquet") <= 4


def test_scan_prunes_columns_and_pushes_filters(spark):
    plan = _plan(queries()["get_lifetimes_rfmt"](spark, SF_SMALL))
    li = [ln for ln in plan.splitlines() if "lineitem" in ln and "FileScan" in ln]
    assert li and "l_tax" not in li[0] and "l_shipdate" not in li[0]
    plan = _plan(queries()["create_model_bigquery_cost"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(ts)" in plan


def test_history_rfm_does_not_expand_days(spark):
    """Intervals are cut at change points only: a few rows each, where days would be hundreds."""
    days = bindings.sales_lines(spark, SF_SMALL, with_part=False).select("customer_id", "order_date").distinct().count()
    df = queries()["history_rfm_segments"](spark, SF_SMALL)
    assert "BroadcastNestedLoopJoin" not in _plan(df)
    assert df.count() <= 30 * days


@pytest.mark.parametrize("name", ["get_rfm_segments", "get_repurchase_rates"])
def test_tiles_of_all_measures_come_from_one_scalar(spark, name):
    df = queries()[name](spark, SF_SMALL)
    logical = df._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("scalar-subquery#") <= 2
    assert len(_plan(df)) < 60_000
