"""Argument helpers shared by every operator.

Operators take column *references* the way the original macros took column
text: a column name, a SQL expression string, or a ``Column``.  ``as_of``
replaces every ``current_date()`` so results are reproducible.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F




def col(c) -> Column:
    """Name, SQL expression text or Column -> Column."""
    if isinstance(c, Column):
        return c
    if isinstance(c, str):
        # plain identifiers go through F.col (keeps pushdown-friendly
        # attribute references); anything else is parsed as SQL text
        if c.replace("_", "").isalnum():
            return F.col(c)
        return F.expr(c)
    raise TypeError(f"expected a column name, SQL text or Column, got {type(c)!r}")


def cols(cs: Iterable | None) -> list[Column]:
    return [col(c) for c in (cs or ())]


def predicate(p) -> Column | None:
    """Optional caller predicate (``row_condition``)."""
    if p is None or (isinstance(p, str) and not p.strip()):
        return None
    return col(p) if isinstance(p, Column) else F.expr(p)


def where(df: DataFrame, p) -> DataFrame:
    cond = predicate(p)
    return df if cond is None else df.where(cond)


def as_of_date(as_of=None) -> Column:
    """``current_date()`` unless a fixed reference date is given."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        return F.lit(as_of.isoformat()[:10]).cast("date")
    return F.lit(str(as_of)).cast("date")


def dim_names(dims: Sequence | None) -> list[str]:
    """Output names for dimension arguments (names stay, expressions keep their SQL text)."""
    out = []
    for d in dims or ():
        if isinstance(d, str):
            out.append(d)
        else:
            out.append(d._jc.toString())  # noqa: SLF001 - Column has no public name accessor
    return out


def join_nullsafe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null matches null (SQL ``PARTITION BY`` groups
    nulls together, so a window rewritten as aggregate + join needs this).
    Right-side keys are renamed first, so frames that share lineage (an
    aggregate joined back to its own input) stay unambiguous."""
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_r_{k}")
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])
