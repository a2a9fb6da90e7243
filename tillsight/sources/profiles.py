"""Social-media profile lists."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_profiles(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Tag each network's profiles with ``network`` and append them.

    Networks with differing fields are aligned by name; an empty network
    simply contributes no rows.
    """
    out = None
    for network, df in frames.items():
        tagged = df.withColumn("network", F.lit(network))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if out is None:
        raise ValueError("no networks given")
    return out


def clean_profiles(df: DataFrame) -> DataFrame:
    """``profile_labels`` list -> JSON text; ``community_enabled`` ->
    'True' / 'False' / null (P09)."""
    repl = {}
    if "profile_labels" in df.columns:
        t = df.schema["profile_labels"].dataType
        c = F.col("profile_labels")
        repl["profile_labels"] = F.to_json(c, {"ignoreNullFields": "false"}) if isinstance(t, (T.ArrayType, T.StructType, T.MapType)) \
            else c.cast("string")
    if "community_enabled" in df.columns:
        c = F.col("community_enabled").cast("boolean")
        repl["community_enabled"] = F.when(c.isNull(), F.lit(None).cast("string")) \
            .when(c, "True").otherwise("False")
    return df.withColumns(repl) if repl else df


def profile_ids(df: DataFrame, network: str, id_col: str = "id") -> DataFrame:
    """Profile ids of one network (P10)."""
    return df.where(F.col("network") == network).select(id_col)
