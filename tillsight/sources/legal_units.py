"""Company-register (legal unit) increments."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.functions.columns import join_nullsafe

# fixed values: the 20-column load contract of the legal-unit table
LEGAL_UNIT_COLUMNS = (
    "siren", "statutDiffusionUniteLegale", "dateCreationUniteLegale", "sigleUniteLegale", "sexeUniteLegale",
    "prenom1UniteLegale", "prenom2UniteLegale", "prenom3UniteLegale", "prenom4UniteLegale",
    "prenomUsuelUniteLegale", "pseudonymeUniteLegale", "identifiantAssociationUniteLegale",
    "trancheEffectifsUniteLegale", "anneeEffectifsUniteLegale", "dateDernierTraitementUniteLegale",
    "nombrePeriodesUniteLegale", "categorieEntreprise", "anneeCategorieEntreprise", "periodesUniteLegale",
    "date_extraction",
)
UPDATED_AT = "dateDernierTraitementUniteLegale"
COUNT_COLUMN = "nombrePeriodesUniteLegale"
DEFAULT_WATERMARK = "1970-01-01"


def conform_legal_units(df: DataFrame) -> DataFrame:
    """Project onto the 20 contract columns (absent -> null), period count
    -> number or null, nested values -> JSON text, NaN -> null (P14)."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for name in LEGAL_UNIT_COLUMNS:
        if name not in fields:
            out.append(F.lit(None).cast("string").alias(name))
            continue
        c, t = F.col(name), fields[name]
        if name == COUNT_COLUMN:
            v = c.cast("double") if isinstance(t, T.NumericType) else c.try_cast("double")
            c = F.nanvl(v, F.lit(None).cast("double"))
        elif isinstance(t, (T.StructType, T.ArrayType, T.MapType)):
            c = F.to_json(c, {"ignoreNullFields": "false"})
        elif isinstance(t, (T.DoubleType, T.FloatType)):
            c = F.nanvl(c, F.lit(None).cast(t))
        out.append(c.alias(name))
    return df.select(*out)


def _timestamp(text: Column) -> Column:
    """ISO timestamp text with any fraction (or none); unparsable text fails the job."""
    ts = text.try_cast("timestamp")
    return F.when(text.isNotNull() & ts.isNull(),
                  F.raise_error(F.concat(F.lit("not an ISO timestamp: "), text)).cast("timestamp")).otherwise(ts)


def high_watermark(target: DataFrame, col: str = UPDATED_AT) -> DataFrame:
    """One-row frame ``watermark``: the date of the newest ISO timestamp text
    in ``target``, 1970-01-01 when empty (P15)."""
    newest = F.to_date(F.max(_timestamp(F.col(col))))
    return target.agg(F.coalesce(newest, F.lit(DEFAULT_WATERMARK).cast("date")).alias("watermark"))


ROW_DIGEST = "_row_digest"


def with_identity(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``ROW_DIGEST``: null where all ``keys`` are known, else a digest of the whole row but its load time.

    A record without a full key is identified by all it holds, so two such records are only the same if
    nothing differs.
    """
    whole = F.struct(*[F.col(c).cast("string").alias(c) for c in sorted(df.columns) if c != "date_extraction"])
    unknown = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in keys])
    return df.withColumn(ROW_DIGEST, F.when(unknown, F.sha2(F.to_json(whole), 256)))


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the first one in the order of all columns' JSON text."""
    first = Window.partitionBy(*keys).orderBy(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))
    return df.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")


def not_yet_loaded(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` that ``target`` does not hold, one per key (per whole row where a key is null)."""
    identity = [*keys, ROW_DIGEST]
    same = target.select(*[F.col(c) if c in target.columns else F.lit(None).alias(c) for c in batch.columns])
    loaded = with_identity(same, keys).select(*identity).distinct()
    return join_nullsafe(one_per_key(with_identity(batch, keys), identity), loaded, identity, "left_anti").drop(ROW_DIGEST)


def since(source: DataFrame, bound: dt.date, ts_col: str = UPDATED_AT) -> DataFrame:
    """Rows whose timestamp text lies on or after the day ``bound``.

    Text that begins with an ISO date sorts like its own day, which an offset moves by a day at most: a
    bound two days earlier on the text reaches the scan and loses nothing.  Text below that bound is read apart, and only what does not begin with an ISO date goes on.
    The exact timestamp decides in either case; text that is no timestamp fails the job.
    """
    text = F.col(ts_col)
    low = F.lit((bound - dt.timedelta(days=2)).isoformat())
    odd = ~text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ]|$)")
    rows = source.where(text >= low).unionByName(source.where((text < low) & odd))
    return rows.where(F.to_date(_timestamp(text)) >= F.lit(bound.isoformat()).cast("date"))


def incremental_append(source: DataFrame, target: DataFrame, *, ts_col: str = UPDATED_AT,
                       extracted_at: str | None = None, dedupe_on=None) -> DataFrame:
    """Rows of ``source`` updated on or after the target's watermark date,
    stamped with ``date_extraction`` and conformed: the batch to append (P16).

    The bound is inclusive (the boundary day is fetched again), as in the
    original.  It is one value, read first, so that it reaches the scan (see :func:`since`).  Days are
    those of the session's time zone.
    ``dedupe_on`` (e.g. ``["siren", UPDATED_AT]``) drops batch rows whose key is
    already in ``target`` and repeats inside the batch; a row with a null in its key is compared as a whole.
    """
    bound = high_watermark(target, ts_col).first().watermark
    stamp = F.lit(extracted_at) if extracted_at is not None else \
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    batch = conform_legal_units(since(source, bound, ts_col).withColumn("date_extraction", stamp))
    return not_yet_loaded(batch, target, list(dedupe_on)) if dedupe_on else batch
