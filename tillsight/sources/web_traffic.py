"""Competitor web-traffic series: align per-domain daily visits, clean the
column names, tag and reshape to long form (P17-P20)."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.plans.ordered import ordered_scan

# fixed values: what becomes an underscore and what disappears from a column name
UNDERSCORED = (r"\.+", "en", "& ", "[/() -]")
DROPPED = "[&+]"
_NAME_PART = re.compile(f"(?P<line>{'|'.join(UNDERSCORED)})|{DROPPED}")


def clean_name(text: str) -> str:
    """One column name in plain ASCII.  Note that the substring "en" is
    replaced anywhere ("centre" -> "c_tre"), as in the original."""
    marked = _NAME_PART.sub(lambda m: "_" if m["line"] else "", text)
    return "".join(c for c in unicodedata.normalize("NFD", marked) if c < "\x80")


def clean_column_names(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`clean_name` (P17; metadata only)."""
    return df.toDF(*[clean_name(c) for c in df.columns])


def with_file_position(df: DataFrame) -> DataFrame:
    """Add ``_file`` and ``_row``, a landed Parquet file's name and the row's place in it: an order that no task changes."""
    return df.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})


def align_series(frames: Mapping[str, DataFrame], *, date_col: str = "date", value_col: str = "visits",
                 by: str = "date", order: Sequence[str] | None = None) -> DataFrame:
    """Per-domain daily series side by side: column ``<domain>`` holds the
    visits and ``date_<domain>`` that domain's date (P18).

    The original glued the frames by row position.  ``by="position"`` does that: every series is
    numbered in the given ``order`` (default: date, then value; landed files keep theirs with
    :func:`with_file_position` and ``order=["_file", "_row"]``) and row k stands beside row k.  The numbers come
    from one ordered scan over all series, so a long series is split over tasks.

    By default rows are matched by date (identical for equal date grids).  A domain's repeated rows of one date
    are numbered in the order of their values and matched by date and number, so
    every row is kept.  All series go through one union + pivot, i.e. a single
    aggregation instead of a chain of joins.
    """
    if by not in ("date", "position"):
        raise ValueError("by must be 'date' or 'position'")
    domains = list(frames)
    keys = [f"_o{i}" for i in range(len(order))] if order else ["_date", "_v"]
    long = None
    for d, df in frames.items():
        part = df.select(F.col(date_col).alias("_date"), F.lit(d).alias("_domain"),
                         F.col(value_col).cast("double").alias("_v"),
                         *[F.col(c).alias(k) for c, k in zip(order or (), keys, strict=False)])
        long = part if long is None else long.unionByName(part)
    nth = F.row_number().over(Window.partitionBy("_domain", "_date").orderBy(F.col("_v").asc_nulls_first()))
    if by == "date":
        matched = long.withColumn("_nth", nth).groupBy("_date", "_nth")
    else:
        matched = ordered_scan(long, keys, partition_by=["_domain"], row_number="_nth").groupBy("_nth")
    wide = matched.pivot("_domain", domains).agg(F.max("_v").alias("v"), F.max("_date").alias("d"))
    cols = []
    for d in domains:
        cols += [F.col(f"`{d}_d`").alias(f"date_{d}"), F.col(f"`{d}_v`").alias(d)]
    return wide.select(*cols)


def tag_and_prune(df: DataFrame, country: str, rename: Mapping[str, str]) -> DataFrame:
    """Add ``country``, apply ``rename`` (the kept date column), drop every
    other column whose name contains "date" (P19)."""
    df = df.withColumn("country", F.lit(country)).withColumnsRenamed(dict(rename))
    return df.drop(*[c for c in df.columns if "date" in c])


def melt(df: DataFrame, ids: Sequence[str] = ("event_timestamp", "country"), var: str = "competitors",
         value: str = "sessions") -> DataFrame:
    """Wide -> long (P20)."""
    values = [c for c in df.columns if c not in ids]
    casted = df.select(*ids, *[F.col(f"`{c}`").cast("double").alias(c) for c in values])
    return casted.unpivot(list(ids), values, var, value)


def sessions_by_competitor(frames: Mapping[str, DataFrame], country: str, *, date_col: str = "date",
                           value_col: str = "visits", by: str = "date", order: Sequence[str] | None = None) -> DataFrame:
    """The whole export: P18 -> P17 -> P19 (first domain's date kept as
    ``event_timestamp``) -> P20."""
    first = clean_name(f"date_{next(iter(frames))}")
    wide = clean_column_names(align_series(frames, date_col=date_col, value_col=value_col, by=by, order=order))
    return melt(tag_and_prune(wide, country, {first: "event_timestamp"}))
