"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tillsight.registry import queries
from tillsight.sources.bindings import TABLES
from tools.compare import frame_rows


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(queries()) <= set(E.queries())
    assert set(queries()) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    assert frame_rows(got, cols) == frame_rows(want, cols)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "rfm_segments_name" in df.columns


# Every query re-run on a small fixture with null customers, dates and parts,
# duplicate lines, zero quantities, ties, and events with null fields.
EDGE_QUERIES = ["get_customers", "get_rfm_segments", "history_rfm_segments", "customer_abc_segments",
                "customer_abc_segments_total", "product_abc_segments", "basket_product_analytics",
                "basket_brand_analytics", "get_cohort_matrix", "get_latency", "get_lifetimes_rfmt",
                "get_next_purchase_date", "get_repurchase_rates", "get_multi_brands_loyalty",
                "get_multi_brands_loyalty_returns",
                # events with null types, times, values and props; objects / arrays as JSON values
                "create_source_model_from_raw_table_airbyte", "create_source_model_stg_klaviyo_data",
                "klaviyo_campaign_performance", "klaviyo_campaign_performance_by_customer_type",
                "klaviyo_contact_segmentation", "splio_campaign_performance", "splio_contact_segmentation",
                "create_model_bigquery_cost", "web_traffic_sessions", "replace_profile_window",
                "replace_metrics_tail", "export_posts", "export_posts_discovered_keys", "union_profiles",
                "profile_ids", "unpack_metric_cube", "incremental_legal_units", "incremental_legal_units_deduped",
                "history_rfm_segments_daily", "get_cohort_matrix_by_status", "web_traffic_sessions_by_position",
                "replace_metrics_tail_in_place", "export_posts_landed_json"]


@pytest.fixture(scope="module")
def edge(tmp_path_factory):
    from tools.edge_fixture import write
    out = str(tmp_path_factory.mktemp("edge"))
    write(out, seed=7)
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{out}/{t}.parquet')")
    return out, c


@pytest.mark.parametrize("name", EDGE_QUERIES)
def test_edge_fixture_matches_oracle(spark, edge, name):
    path, c = edge
    got = E.queries()[name](spark, path).toPandas()
    want = c.execute(E.oracle_sql()[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert frame_rows(got, cols) == frame_rows(want, cols)
