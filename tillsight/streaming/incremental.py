"""Incremental loads as Structured Streaming jobs.

The batch form (:func:`tillsight.sources.legal_units.incremental_append`)
re-derives a watermark from the target table on every run.  When the
extracts are landed as files, a file-source stream does the bookkeeping
itself: its checkpoint records which files were already loaded, so each
run (``availableNow``) appends exactly the new files, and a lost executor or
a crashed run resumes from the checkpoint without duplicates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillsight.session import ensure_checkpoint_dir
from tillsight.sources.legal_units import conform_legal_units, not_yet_loaded


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """A stream checkpoint under the cluster's shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def legal_unit_stream(spark: SparkSession, source_dir: str, schema: T.StructType | str, *,
                      fmt: str = "json", extracted_at: str | None = None) -> DataFrame:
    """Streaming frame of conformed legal units from landed extract files."""
    stream = spark.readStream.schema(schema).format(fmt).load(source_dir)
    stamp = F.lit(extracted_at) if extracted_at is not None else \
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    return conform_legal_units(stream.withColumn("date_extraction", stamp))


def append_available(df: DataFrame, target_dir: str, checkpoint: str, fmt: str = "parquet", *,
                     dedupe_on: Sequence[str] | None = None) -> StreamingQuery:
    """Append everything available now to ``target_dir`` and stop.

    ``dedupe_on`` (e.g. ``["siren", UPDATED_AT]``) drops re-delivered records: a
    batch's rows whose key the target already holds, however old, and repeats
    inside the batch; a row with a null in its key is compared as a whole, as in the batch form.  The key is checked against the target itself, so there is no
    state that grows and no record is too late.
    """
    if not dedupe_on:
        return (df.writeStream.format(fmt).option("path", target_dir).option("checkpointLocation", checkpoint)
                .outputMode("append").trigger(availableNow=True).start())
    keys = list(dedupe_on)

    def append(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        # an empty append makes the first batch's target readable
        batch.limit(0).write.mode("append").format(fmt).save(target_dir)
        target = spark.read.schema(batch.schema).format(fmt).load(target_dir)
        new = not_yet_loaded(batch, target, keys)
        # written in one piece: a retried batch finds its own rows and appends nothing twice
        new.write.mode("append").format(fmt).save(target_dir)

    return (df.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
