"""Monthly acquisition-cohort retention matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.functions.columns import col, dim_names
from tillsight.functions.dates import month_label


def get_cohort_matrix(df: DataFrame, *, order_id, customer_id, order_created_at, dims: Sequence = (),
                      sort_output: bool = True) -> DataFrame:
    """Acquisition month x order month: distinct customers, periods and retention.

    The original takes ``min(date) over (partition by customer)`` on every
    order.  Here orders are reduced to distinct ``(customer, order month)``
    rows first, so the window per customer is bounded by its active months.  ``dims`` adds grouping
    columns (the original declared channel / platform but never used them).
    ``sort_output=False`` skips the final global ``order by``.
    """
    names = dim_names(dims)
    dim_cols = [col(d).alias(n) for d, n in zip(dims, names)]
    base = (df.where(col(customer_id).isNotNull() & col(order_id).isNotNull())
            .select(*dim_cols, col(customer_id).alias("_cid"), col(order_created_at).alias("_ts")))
    months = base.select(*names, "_cid", month_label(F.col("_ts")).alias("order_cohort")).distinct()
    # 'yyyy-MM' text orders like the dates
    first = F.min("order_cohort").over(Window.partitionBy("_cid"))
    retention = (months.withColumn("acquisition_cohort", first)
                 .groupBy(*names, "acquisition_cohort", "order_cohort")
                 .agg(F.count(F.lit(1)).alias("customers")))
    as_month = lambda c: F.to_date(F.col(c), "yyyy-MM")
    periods = ((F.year(as_month("order_cohort")) - F.year(as_month("acquisition_cohort"))) * 12
               + F.month(as_month("order_cohort")) - F.month(as_month("acquisition_cohort"))).cast("long")
    # the retention table has at most months^2 rows per dimension value
    w = Window.partitionBy(*names, "acquisition_cohort").orderBy(F.col("order_cohort").asc_nulls_first())
    first_customers = F.first("customers").over(w)
    out = retention.select(*names, "acquisition_cohort", "order_cohort", periods.alias("periods"), "customers",
                           first_customers.alias("cohort_customers"),
                           F.round(F.col("customers") / first_customers, 3).alias("retention_percentage"))
    return out.orderBy(*names, "acquisition_cohort", "order_cohort", "periods") if sort_output else out
