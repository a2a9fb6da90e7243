"""Daily profile metric cubes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.functions.columns import as_of_date
from tillsight.sources.posts import distinct_names


def unpack_metric_cube(payloads: DataFrame, network: str, metric_names: Iterable[str] | None = None) -> DataFrame:
    """Dense ``data[date][profile][metric]`` cubes -> one row per
    (date, profile) with a ``{network}_{metric}`` column per metric (P11).

    ``payloads`` has ``header`` (array of ``{rows: array<string>}``: dates,
    profiles, metrics) and ``data`` (array<array<array<double>>>).  Payloads
    without a full header or without data are skipped.  Metric names come
    from the caller or from one distinct-names job (a bounded number).  Both axes are exploded
    with positions, so no cube is ever collected.
    """
    valid = payloads.where(F.col("data").isNotNull() & (F.size("header") >= 3))
    metrics = F.col("header").getItem(2).getField("rows")
    if metric_names is None:
        metric_names = distinct_names(valid.select(F.explode(metrics)))
    cells = (valid.select(F.posexplode(F.col("header").getItem(0).getField("rows")).alias("_di", "date"),
                          F.col("header").getItem(1).getField("rows").alias("_profiles"),
                          metrics.alias("_metrics"), "data")
             .select("date", F.posexplode("_profiles").alias("_pi", "profile_id"), "_metrics", "data", "_di")
             .select("date", "profile_id", "_metrics",
                     F.try_element_at(F.try_element_at(F.col("data"), F.col("_di") + 1),
                                      F.col("_pi") + 1).alias("_values")))

    def value(m: str) -> Column:
        pos = F.array_position(F.col("_metrics"), m).cast("int")
        return F.when(pos > 0, F.try_element_at(F.col("_values"), pos))

    return cells.select("date", "profile_id", F.lit(network).alias("network"),
                        *[value(m).alias(f"{network}_{m}") for m in metric_names])


def union_metrics(frames: Iterable[DataFrame]) -> DataFrame:
    """Append networks with different metric columns; missing numbers -> 0.

    Only numeric columns are filled; text and dates stay null.
    """
    out = None
    for df in frames:
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no frames given")
    return out.fillna(0)


def as_date(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    t = df.schema[name].dataType
    if isinstance(t, T.StringType):
        return F.to_date(F.try_to_timestamp(c))
    return c.cast("date")


def replace_tail(existing: DataFrame, new: DataFrame, *, date_col: str = "date", days: int = 30,
                 as_of=None) -> DataFrame:
    """Drop every existing row dated on or after ``as_of - days`` (whether or
    not ``new`` covers it), then append ``new`` (P13)."""
    cutoff = F.date_sub(as_of_date(as_of), days)
    d = as_date(existing, date_col)
    kept = existing.where(d.isNull() | (d < cutoff))
    return kept.unionByName(new, allowMissingColumns=True)
