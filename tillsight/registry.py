"""Registered queries: every operator bound to the test tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
column names and types line up with the matching oracle SQL (decimals are
reported as double, integers as long).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.operators import campaigns, cohorts, customers, job_costs, products, raw_json
from tillsight.session import ensure_checkpoint_dir
from tillsight.sources import bindings as B
from tillsight.sources import landed, legal_units, metrics, posts, profiles, sinks, web_traffic

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Report decimals as double, every integer width as long and zoned
    timestamps as wall-clock timestamps."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, T.TimestampType):
            # wall-clock time in the session zone, like the oracle's TIMESTAMP
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)


def _customers(spark, sf):
    return customers.get_customers(B.sales_lines(spark, sf, with_part=False), customer_id="customer_id", revenue="revenue",
                                   order_id="order_id", quantity="quantity", date="order_date",
                                   transaction_type="transaction_type", as_of=B.ORDERS_AS_OF)


def _products(spark, sf):
    return B.sales_lines(spark, sf, with_part=False).groupBy("product").agg(F.sum("revenue").alias("revenue"))


def q_get_customers(spark, sf):
    return _customers(spark, sf)


def q_get_rfm_segments(spark, sf):
    return customers.get_rfm_segments(_customers(spark, sf), customer_id="customer_id",
                                      first_order_date="first_order_date", last_order_date="last_order_date",
                                      recency="recency", orders="orders", revenue="revenue", tenure="tenure")


def q_history_rfm(spark, sf, scope="customer"):
    return customers.history_rfm_segments(B.sales_lines(spark, sf, with_part=False), customer_id="customer_id",
                                          transaction_type="transaction_type", date="order_date",
                                          revenue="revenue", order_id="order_id", as_of=B.ORDERS_AS_OF,
                                          revenue_scope=scope)


def q_customer_abc_segments(spark, sf, scope="customer"):
    return customers.customer_abc_segments(_customers(spark, sf), customer_id="customer_id", revenue="revenue",
                                           recency="recency", threshold=80, total_scope=scope)


def q_product_abc_segments(spark, sf):
    return products.product_abc_segments(_products(spark, sf), product="product", revenue="revenue", threshold=80)


def q_basket(spark, sf, product="product"):
    lines = B.sales_lines(spark, sf, with_part=product != "product")
    return products.basket_product_analytics(lines, product=product, order_id="order_id")


def q_cohort_matrix(spark, sf, dims=()):
    return cohorts.get_cohort_matrix(B.table(spark, sf, "orders"), order_id="o_orderkey", customer_id="o_custkey",
                                     order_created_at="o_orderdate", dims=dims)


def q_latency(spark, sf):
    return customers.get_latency(B.sales_lines(spark, sf, with_part=False), customer_id="customer_id", order_date="order_date",
                                 order_id="order_id", as_of=B.ORDERS_AS_OF)


def q_lifetimes(spark, sf):
    return customers.get_lifetimes_rfmt(B.sales_lines(spark, sf, with_part=False), replacement="replacement",
                                        customer_id="customer_id", order_date="order_date", order_id="order_id",
                                        revenue="revenue", observation_periode_end=B.ORDERS_AS_OF)


def q_next_purchase(spark, sf):
    return customers.get_next_purchase_date(B.sales_lines(spark, sf, with_part=False), customer_id="customer_id",
                                            order_date="order_date", order_id="order_id", revenue="revenue",
                                            quantity="quantity", row_condition="transaction_type = 'VENTE'")


def q_repurchase(spark, sf):
    prices = B.table(spark, sf, "part").select(F.col("p_partkey").alias("product"),
                                               F.col("p_retailprice").cast("decimal(18,2)").alias("unit_price"))
    return products.get_repurchase_rates(B.sales_lines(spark, sf, with_part=False), product="product",
                                         order_id="order_id", quantity="quantity", customer_id="customer_id",
                                         line_price="revenue", unit_prices=prices)


def q_loyalty(spark, sf, min_days=0):
    return products.get_multi_brands_loyalty(B.sales_lines(spark, sf), customer_id="customer_id",
                                             date="order_date", order_id="order_id", brand="brand",
                                             revenue="revenue", quantity="quantity", days_threshold=90,
                                             row_condition="transaction_type = 'VENTE'", min_days=min_days)


def q_airbyte(spark, sf):
    return raw_json.create_source_model_from_raw_table_airbyte(
        B.raw_json(spark, sf), json_data="json_data", date_columns=["day"], string_columns=["id"],
        numeric_columns=["amount"])


def q_stg_klaviyo(spark, sf):
    return raw_json.create_source_model_stg_klaviyo_data(
        B.raw_json(spark, sf), json_data="json_data", json_data_1="attributes", date_columns=["day"],
        string_columns=["id"], numeric_columns=["amount"], second_level_numeric_columns=["k"],
        second_level_string_columns=["missing"])


def q_klaviyo_perf(spark, sf):
    return campaigns.klaviyo_campaign_performance(B.campaign_events(spark, sf), dimension_columns=["campaign"],
                                                  campaign_event_name="event_a", email="email")


def q_klaviyo_perf_by_type(spark, sf):
    return campaigns.klaviyo_campaign_performance_by_customer_type_rfm_segmentation(
        B.campaign_events(spark, sf), dimension_columns=["campaign"], campaign_event_name="event_a", email="email",
        first_purchase_date="first_purchase_date")


def q_klaviyo_contacts(spark, sf):
    return campaigns.klaviyo_contact_segmentation(B.campaign_events(spark, sf), dimension_columns=["email"],
                                                  email="email", campaign_event_name="event_a",
                                                  event_date="event_date", number_of_days=10,
                                                  as_of=B.EVENTS_AS_OF)


def q_splio_perf(spark, sf):
    return campaigns.splio_campaign_performance(B.campaign_events(spark, sf), dimension_columns=["campaign"],
                                                campaign_event_type="event_b", email="email")


def q_splio_contacts(spark, sf):
    return campaigns.splio_contact_segmentation(B.campaign_events(spark, sf), dimension_columns=["email"],
                                                email="email", campaign_event_type="event_b",
                                                event_date="event_date", number_of_days=10, as_of=B.EVENTS_AS_OF)


def q_job_cost(spark, sf):
    return job_costs.create_model_bigquery_cost(B.job_log(spark, sf), as_of=B.EVENTS_AS_OF)


def q_web_traffic(spark, sf):
    return web_traffic.sessions_by_competitor(B.traffic_series(spark, sf), "FR")


def q_web_traffic_by_position(spark, sf):
    return web_traffic.sessions_by_competitor(B.traffic_series(spark, sf), "FR", by="position", order=["date"])


def q_legal_units(spark, sf, dedupe_on=None):
    src = B.legal_units(spark, sf)
    target = legal_units.conform_legal_units(src.where(F.col("dateCreationUniteLegale") < "2000-01-01"))
    return legal_units.incremental_append(src, target, extracted_at="2024-01-31 00:00:00", dedupe_on=dedupe_on)


def q_replace_window(spark, sf):
    """The re-fetch holds three of the event types on purpose: what it lacks is dropped from the window."""
    return posts.replace_profile_window(B.post_rows(spark, sf), B.post_rows(spark, sf, refetch=True),
                                        network="instagram", as_of=B.EVENTS_AS_OF)


def q_replace_tail(spark, sf):
    existing = metrics.union_metrics(B.profile_metrics(spark, sf))
    new = metrics.union_metrics(B.profile_metrics(spark, sf, since="2024-01-21"))
    return metrics.replace_tail(existing, new, date_col="date", days=10, as_of=B.EVENTS_AS_OF)


def q_replace_tail_in_place(spark, sf):
    """The same table as ``replace_metrics_tail``, by rewriting only the touched days of a table."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tail-{uuid.uuid4().hex}"
    day = lambda df: metrics.as_date(df, "date")
    sinks.write_by_day(metrics.union_metrics(B.profile_metrics(spark, sf)), f"{folder}/table", day)
    new = metrics.union_metrics(B.profile_metrics(spark, sf, since="2024-01-21"))
    as_of = B.EVENTS_AS_OF
    sinks.replace_in_place(f"{folder}/table", new, lambda e, n: metrics.replace_tail(e, n, days=10, as_of=as_of),
                           day=day, low=as_of - dt.timedelta(days=10), high=None, stage=f"{folder}/stage")
    return spark.read.parquet(f"{folder}/table").drop("day")


def q_profiles(spark, sf):
    return profiles.clean_profiles(profiles.union_profiles(B.social_profiles(spark, sf)))


def q_profile_ids(spark, sf):
    return profiles.profile_ids(profiles.union_profiles(B.social_profiles(spark, sf)), "instagram")


def q_metric_cube(spark, sf):
    return metrics.unpack_metric_cube(B.metric_cubes(spark, sf), "instagram")


def q_export_posts_landed(spark, sf):
    """The pages as JSON text, one payload a row: schema and values come from the text alone."""
    text = B.post_pages(spark, sf).select(F.to_json(F.struct("data")).alias("payload"))
    return posts.export_posts(landed.landed_payloads(text).drop(landed.BAD_RECORD), "facebook", reaction_keys=("like", "love"))


def q_export_posts(spark, sf, reaction_keys=("like", "love")):
    return posts.export_posts(B.post_pages(spark, sf), "facebook", reaction_keys=reaction_keys)


_QUERIES: dict[str, Query] = {
    "get_customers": q_get_customers,
    "get_rfm_segments": q_get_rfm_segments,
    "history_rfm_segments": q_history_rfm,
    "history_rfm_segments_daily": lambda s, sf: q_history_rfm(s, sf, "day"),
    "customer_abc_segments": q_customer_abc_segments,
    "customer_abc_segments_total": lambda s, sf: q_customer_abc_segments(s, sf, "all"),
    "product_abc_segments": q_product_abc_segments,
    "basket_product_analytics": q_basket,
    "basket_brand_analytics": lambda s, sf: q_basket(s, sf, "brand"),
    "get_cohort_matrix": q_cohort_matrix,
    "get_cohort_matrix_by_status": lambda s, sf: q_cohort_matrix(s, sf, ["o_orderstatus"]),
    "get_latency": q_latency,
    "get_lifetimes_rfmt": q_lifetimes,
    "get_next_purchase_date": q_next_purchase,
    "get_repurchase_rates": q_repurchase,
    "get_multi_brands_loyalty": q_loyalty,
    "get_multi_brands_loyalty_returns": lambda s, sf: q_loyalty(s, sf, 1),
    "create_source_model_from_raw_table_airbyte": q_airbyte,
    "create_source_model_stg_klaviyo_data": q_stg_klaviyo,
    "klaviyo_campaign_performance": q_klaviyo_perf,
    "klaviyo_campaign_performance_by_customer_type": q_klaviyo_perf_by_type,
    "klaviyo_contact_segmentation": q_klaviyo_contacts,
    "splio_campaign_performance": q_splio_perf,
    "splio_contact_segmentation": q_splio_contacts,
    "create_model_bigquery_cost": q_job_cost,
    "web_traffic_sessions": q_web_traffic,
    "web_traffic_sessions_by_position": q_web_traffic_by_position,
    "incremental_legal_units": q_legal_units,
    "incremental_legal_units_deduped": lambda s, sf: q_legal_units(s, sf, ["siren", legal_units.UPDATED_AT]),
    "replace_profile_window": q_replace_window,
    "replace_metrics_tail": q_replace_tail,
    "replace_metrics_tail_in_place": q_replace_tail_in_place,
    "union_profiles": q_profiles,
    "profile_ids": q_profile_ids,
    "unpack_metric_cube": q_metric_cube,
    "export_posts": q_export_posts,
    "export_posts_landed_json": q_export_posts_landed,
    "export_posts_discovered_keys": lambda s, sf: q_export_posts(s, sf, None),
}


def queries() -> dict[str, Query]:
    return {name: (lambda fn: (lambda spark, sf: comparable(fn(spark, sf))))(fn) for name, fn in _QUERIES.items()}
