"""tillsight: customer, product and campaign analytics on Spark.

Every operator is a function ``DataFrame -> DataFrame`` taking column
names (or SQL expressions / Columns) as keyword arguments.
"""

from tillsight.operators.campaigns import (
    campaign_performance,
    contact_segmentation,
    klaviyo_campaign_performance,
    klaviyo_campaign_performance_by_customer_type_rfm_segmentation,
    klaviyo_contact_segmentation,
    splio_campaign_performance,
    splio_contact_segmentation,
)
from tillsight.operators.cohorts import get_cohort_matrix
from tillsight.operators.customers import (
    customer_abc_segments,
    get_customers,
    get_latency,
    get_lifetimes_rfmt,
    get_next_purchase_date,
    get_rfm_segments,
    history_rfm_segments,
)
from tillsight.operators.job_costs import create_model_bigquery_cost
from tillsight.operators.products import (
    basket_product_analytics,
    get_multi_brands_loyalty,
    get_repurchase_rates,
    product_abc_segments,
)
from tillsight.operators.raw_json import (
    create_source_model_from_raw_table_airbyte,
    create_source_model_stg_klaviyo_data,
)
from tillsight.plans.ordered import ordered_scan

__all__ = [
    "basket_product_analytics", "campaign_performance", "contact_segmentation", "create_model_bigquery_cost",
    "create_source_model_from_raw_table_airbyte", "create_source_model_stg_klaviyo_data", "customer_abc_segments",
    "get_cohort_matrix", "get_customers", "get_latency", "get_lifetimes_rfmt", "get_multi_brands_loyalty",
    "get_next_purchase_date", "get_repurchase_rates", "get_rfm_segments", "history_rfm_segments",
    "klaviyo_campaign_performance", "klaviyo_campaign_performance_by_customer_type_rfm_segmentation",
    "klaviyo_contact_segmentation", "ordered_scan", "product_abc_segments", "splio_campaign_performance",
    "splio_contact_segmentation",
]
