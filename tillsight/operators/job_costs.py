"""Warehouse query-cost report over a job log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.columns import as_of_date

# fixed values: on-demand price per TiB billed and the label groups
USD_PER_TIB = 5
LABEL_GROUPS = (("key_like", "%dbt%", "DBT"), ("value", "looker_studio", "LOOKER STUDIO"),
                ("value", "scheduled_query", "SCHEDULED QUERY"))
OTHERS = "OTHERS"


def create_model_bigquery_cost(jobs: DataFrame, *, as_of=None, days: int = 7, usd_per_tib=USD_PER_TIB,
                               time_zone: str = "Europe/Paris") -> DataFrame:
    """Cost by day, user, label group and label key for the last ``days`` days.

    ``jobs`` has ``creation_time``, ``user_email``, ``labels`` (array of
    key/value structs) and ``total_bytes_billed``.  A job with k labels counts
    k times, as in the original's left join on the unnested labels.  Bytes
    are summed as exact integers and priced once per group.
    """
    if as_of is None:
        today = F.to_date(F.from_utc_timestamp(F.current_timestamp(), time_zone))
    else:
        today = as_of_date(as_of)
    j = jobs.where(F.to_date("creation_time") >= F.date_sub(today, days))
    j = j.select("creation_time", "user_email", "total_bytes_billed", F.explode_outer("labels").alias("_l"))
    key, value = F.col("_l.key"), F.col("_l.value")
    group = None
    for kind, pattern, name in LABEL_GROUPS:
        cond = key.like(pattern) if kind == "key_like" else value == pattern
        group = F.when(cond, name) if group is None else group.when(cond, name)
    group = group.otherwise(OTHERS)
    g = j.groupBy(F.to_date("creation_time").alias("date"), F.col("user_email").alias("user"),
                  group.alias("label_group"), key.alias("label_key"))
    tib = float(1024 ** 4)
    return g.agg((F.sum(F.col("total_bytes_billed").cast("decimal(38,0)")).cast("double") / tib
                  * usd_per_tib).alias("cost_usd"))
