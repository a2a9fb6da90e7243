"""Typed projection of raw JSON text columns (landed loader tables)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.functions.columns import col

NUMERIC = "decimal(38,9)"


def json_path(*keys: str) -> str:
    """``$.a.b`` for simple names, bracket-quoted otherwise."""
    parts = []
    for k in keys:
        if k.replace("_", "").isalnum():
            parts.append(f".{k}")
        else:
            parts.append("['" + k.replace("'", "\\'") + "']")
    return "$" + "".join(parts)


def json_scalar(text: Column, path: str, as_written: bool = True) -> Column:
    """Scalar at ``path`` as text; objects, arrays, JSON null, a missing path
    and malformed JSON give null.

    The text is parsed once per row for all fields (a shared subexpression);
    strings, and with ``as_written=False`` whole and decimal numbers too, come from that parse.  The
    text of other scalars is read at the path, since a parsed number may drop trailing zeros.
    """
    v = F.try_variant_get(F.try_parse_json(text), F.lit(path), "variant")
    kind = F.schema_of_variant(v)
    parsed = kind == "STRING" if as_written else kind.rlike("^(STRING|BIGINT|DECIMAL)")
    return (F.when(parsed, F.try_variant_get(v, F.lit("$"), "string"))
            .when(v.isNotNull() & ~kind.rlike("^(OBJECT|ARRAY)"), F.get_json_object(text, path)))


def create_source_model_from_raw_table_airbyte(df: DataFrame, *, json_data, date_columns: Sequence[str] = (),
                                               string_columns: Sequence[str] = (),
                                               numeric_columns: Sequence[str] = ()) -> DataFrame:
    """One-level typed projection: dates, strings and numerics out of a JSON column."""
    j = col(json_data)
    out = [json_scalar(j, json_path(c)).cast("date").alias(c) for c in date_columns]
    out += [json_scalar(j, json_path(c)).alias(c) for c in string_columns]
    out += [json_scalar(j, json_path(c), as_written=False).cast(NUMERIC).alias(c) for c in numeric_columns]
    return df.select(*out)


def create_source_model_stg_klaviyo_data(df: DataFrame, *, json_data, json_data_1: str,
                                         date_columns: Sequence[str] = (),
                                         second_level_date_columns: Sequence[str] = (),
                                         string_columns: Sequence[str] = (),
                                         second_level_string_columns: Sequence[str] = (),
                                         numeric_columns: Sequence[str] = (),
                                         second_level_numeric_columns: Sequence[str] = ()) -> DataFrame:
    """One- and two-level typed projection (timestamp / string / numeric);
    second-level fields live under the object ``json_data_1``."""
    j = col(json_data)
    top = lambda c, *a: json_scalar(j, json_path(c), *a)
    nested = lambda c, *a: json_scalar(j, json_path(json_data_1, c), *a)
    out = [top(c).cast("timestamp").alias(c) for c in date_columns]
    out += [nested(c).cast("timestamp").alias(c) for c in second_level_date_columns]
    out += [top(c).alias(c) for c in string_columns]
    out += [nested(c).alias(c) for c in second_level_string_columns]
    out += [top(c, False).cast(NUMERIC).alias(c) for c in numeric_columns]
    out += [nested(c, False).cast(NUMERIC).alias(c) for c in second_level_numeric_columns]
    return df.select(*out)
