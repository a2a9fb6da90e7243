"""Landed JSON payloads -> typed columns: the batch source of the export jobs.

Payloads differ from each other: a field may be absent, null, or of another type in some of
them.  The schema is therefore aggregated over all payloads, not read from a sample.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.plans.ordered import checkpointed

BAD_RECORD = "_bad_record"


def read_payload_files(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Text files of JSON as ``payload``, one per line (or one per file)."""
    return spark.read.text(path, wholetext=whole_files).withColumnRenamed("value", "payload")


def _columns(kind: T.DataType) -> T.DataType:
    """The aggregated type with text where payloads disagree or hold nulls alone."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _columns(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_columns(kind.elementType))
    return T.StringType() if isinstance(kind, (T.VariantType, T.NullType)) else kind


def payload_schema(variant_schema: str) -> T.StructType:
    """The columns of a schema in the notation of ``schema_of_variant_agg``; payloads that are no objects have none."""
    parts = re.split("(`(?:[^`]|``)*`)", variant_schema)  # names in quotes stay as they are
    ddl = "".join(p if i % 2 else p.replace("OBJECT<", "STRUCT<") for i, p in enumerate(parts))
    kind = T._parse_datatype_string(ddl) if ddl.startswith("STRUCT<") else T.StructType()
    return _columns(kind)


def landed_payloads(payloads: DataFrame, text_col: str = "payload") -> DataFrame:
    """The fields of all payloads as columns, and ``_bad_record``: the text of a payload that is no JSON object.

    Each payload is parsed once, into a variant that is written to the shared checkpoint folder; the schema is one
    aggregate over it (a row per task is shuffled) and the columns are read from it.  A field that some payloads
    lack is null there; one whose type differs between payloads is text.  Null payloads give a row of nulls.
    """
    text = F.col(f"`{text_col}`")
    parsed = checkpointed(payloads.select(text.alias("t"), F.try_parse_json(text).alias("v")))
    found = parsed.where("schema_of_variant(v) like 'OBJECT<%'").agg(F.schema_of_variant_agg("v")).first()[0]
    schema = payload_schema(found or "VOID")
    kind = ", ".join(f"`{f.name.replace('`', '``')}`: {f.dataType.simpleString()}" for f in schema.fields)
    row = F.expr(f"try_variant_get(v, '$', {_quoted(f'struct<{kind}>')})") if schema.fields else F.lit(None)
    out = parsed.select("t", row.alias("_row"))
    bad = F.when(F.col("_row").isNull(), F.col("t")).alias(BAD_RECORD)
    return out.select(*[F.col("_row").getField(f.name).alias(f.name) for f in schema.fields], bad)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
