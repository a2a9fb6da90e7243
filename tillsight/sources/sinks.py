"""Table writes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write(df: DataFrame, target: str, mode: str = "append", fmt: str = "parquet",
          partition_by: Sequence[str] | None = None) -> None:
    """Append to or replace a table.  ``target`` is a path (contains "/") or
    a catalog table name.

    The delete-and-append jobs (P07, P13) replace the touched days of a table with
    :func:`replace_in_place`; a plan must never overwrite the input it is still reading.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be 'append' or 'overwrite'")
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if "/" in target:
        w.save(target)
    else:
        w.saveAsTable(target)


def _path(spark: SparkSession, text: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def write_by_day(df: DataFrame, target: str, day: Callable[[DataFrame], Column], day_col: str = "day") -> None:
    """A new table with one partition per day, as :func:`replace_in_place` expects it."""
    df.withColumn(day_col, day(df)).write.mode("overwrite").partitionBy(day_col).parquet(target)


def replace_in_place(target: str, new: DataFrame, replaced: Callable[[DataFrame, DataFrame], DataFrame], *,
                     day: Callable[[DataFrame], Column], low: dt.date, high: dt.date | None, stage: str,
                     day_col: str = "day") -> None:
    """Replace rows of a table partitioned by ``day_col``, rewriting only the touched days.

    ``replaced(existing, new)`` gives the table that should be (P07, P13); rows that it may drop are dated from
    ``low`` to ``high`` (None: open).  Touched are those days and the days of ``new``.  Their rows are computed from the target
    once and written to ``stage``, a folder of this run; then they overwrite their partitions, and a
    touched day that is left without rows is removed.  A run that failed is repeated with the same ``stage``: until the stage is complete
    the target is as it was, and from then on the same rows are written again.  So a repeated or
    half-done run gives the same table as one that ended.
    """
    spark = new.sparkSession
    files, marker = _path(spark, f"{stage}/days/_SUCCESS")
    if not files.exists(marker):
        existing = spark.read.parquet(target)
        d = F.col(day_col)
        window = (d >= F.lit(low)) & (d <= F.lit(high) if high is not None else F.lit(True))
        # one row per day
        days = (existing.select(day_col).where(window).unionByName(new.select(day(new).alias(day_col))).distinct())
        known = [r[0] for r in days.collect()]
        touched = d.isin([x for x in known if x is not None]) | (d.isNull() if None in known else F.lit(False))
        rows = replaced(existing.where(touched).drop(day_col), new)
        rows.withColumn(day_col, day(rows)).write.mode("overwrite").parquet(f"{stage}/rows")
        spark.createDataFrame([(x,) for x in known], f"{day_col} date").coalesce(1).write.mode("overwrite").parquet(f"{stage}/days")
    rows, days = spark.read.parquet(f"{stage}/rows"), spark.read.parquet(f"{stage}/days")
    _overwrite_days(rows, target, day_col)
    for r in days.join(rows.select(day_col).distinct(), day_col, "left_anti").where(F.col(day_col).isNotNull()).collect():
        files, path = _path(spark, f"{target}/{day_col}={r[0]}")
        files.delete(path, True)


def _overwrite_days(rows: DataFrame, target: str, day_col: str) -> None:
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day_col).parquet(target))
