"""Ordered scans (row number, ntile, running sums, lag/lead) that never
collapse to one task.

``Window.orderBy(...)`` without ``partitionBy`` plans as ``Exchange
SinglePartition``: at scale one task would sort the whole table.  And a
``partitionBy(customer)`` window puts a hot customer (say a third of all rows)
into a single task.  ``ordered_scan`` computes the same values in two passes:

1. ``repartitionByRange`` on ``partition_by + order_by`` - Spark samples the
   *compound* key, so heavy ties on the leading column are split across
   buckets by the trailing tie-break columns.  The bucket id is materialised
   with a reliable ``checkpoint()`` so every later pass sees the same buckets
   (and so that a lost executor cannot re-draw them).
2. The rows of a bucket stay together (``repartitionById``), and a local window runs per
   ``(bucket, partition key)`` segment.  Global scans add one aggregate row per bucket.  With partition keys
   only the keys cut by a bucket's end need more than their own bucket: those are the
   least and greatest keys of the buckets, so at most two aggregate rows per bucket (count,
   sums, minimums, first/last values).  A window over these rows turns them into offsets,
   a broadcast of that bounded size.

Row numbers / ntiles alone (global) skip the local window: each bucket is
sorted in place after the range shuffle and a row's position is the low part
of ``monotonically_increasing_id()``.

Any associative operator can be carried across buckets: sums, counts, running minimums and
maximums, and the last non-null value.

The result equals the single global window (ties broken by the given order).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.session import ensure_checkpoint_dir, shuffle_partitions

BUCKET = "_scan_bucket"
_SEG = "_scan_seg"
#: running operators: over rows, and of what came before a segment with what lies in it
_RUNNING = {"min": (F.min, F.least), "max": (F.max, F.greatest),
            "last": (lambda c: F.last(c, ignorenulls=True), lambda before, here: F.coalesce(here, before))}


def _by_range(df: DataFrame, keys: list[Column], buckets: int | None) -> DataFrame:
    """Range-partition on ``keys``.

    Without an explicit count the shuffle uses ``spark.sql.shuffle.partitions``
    (or AQE's ``initialPartitionNum``) and AQE merges adjacent ranges up to the
    advisory partition size, so bucket sizes follow the data.  Bucket ids are
    read in the same stage (``spark_partition_id``) and then checkpointed, so
    coalescing cannot make them disagree.
    """
    return df.repartitionByRange(buckets, *keys) if buckets else df.repartitionByRange(*keys)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the session's ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Hash ``df`` by ``keys`` into ``spark.sql.shuffle.partitions`` partitions.

    AQE merges the partitions of its own shuffles into about one per core, so a
    task that sorts or groups them holds a share of the table that no number of
    partitions makes smaller.  A count that is asked for stays.
    """
    return df.repartition(shuffle_partitions(df.sparkSession), *keys)


def _sort_cols(order_by) -> tuple[list[Column], bool]:
    """``name`` / ``(name, ascending)`` -> sort columns (BigQuery and Spark
    null placement: first when ascending, last when descending)."""
    out, all_asc = [], True
    for o in order_by:
        name, asc = (o, True) if isinstance(o, str) else o
        out.append(F.col(name).asc_nulls_first() if asc else F.col(name).desc_nulls_last())
        all_asc = all_asc and asc
    return out, all_asc


def ordered_scan(
    df: DataFrame,
    order_by: Sequence,
    *,
    partition_by: Sequence[str] = (),
    row_number: str | None = None,
    ntiles: Mapping[str, int] | None = None,
    running_sums: Mapping[str, Column] | None = None,
    lag: Mapping[str, str] | None = None,
    lead: Mapping[str, str] | None = None,
    totals: Mapping[str, str] | None = None,
    mins: Mapping[str, str] | None = None,
    running: Mapping[str, tuple[str, Column]] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Add global (or per-``partition_by``) ordered values to ``df``.

    * ``row_number``: output name of ``row_number() over (partition by .. order by ..)``
    * ``ntiles``: ``{name: n}`` for ``ntile(n)``
    * ``running_sums``: ``{name: expr}`` for ``sum(expr) rows between unbounded preceding and current row``
    * ``lag`` / ``lead``: ``{name: source column}`` for offset 1
    * ``totals``: ``{name: running sum name}`` for the sum over the whole
      partition (``sum(expr) over (partition by ..)``), from the bucket sums
    * ``mins``: ``{name: source column}`` for ``min(src) over (partition by ..)``,
      from the bucket minimums (no join of the rows with a per-key aggregate)
    * ``running``: ``{name: (op, expr)}`` for the ``"min"``, ``"max"`` or ``"last"`` (non-null) of ``expr``
      over ``rows between unbounded preceding and current row``

    ``order_by`` items are column names or ``(name, ascending)`` pairs.
    """
    order_names = [o if isinstance(o, str) else o[0] for o in order_by]
    order_by, all_asc = _sort_cols(order_by)
    ntiles = dict(ntiles or {})
    sums = dict(running_sums or {})
    lag = dict(lag or {})
    lead = dict(lead or {})
    totals = dict(totals or {})
    mins = dict(mins or {})
    running = dict(running or {})
    pb = list(partition_by)
    n = buckets
    original = df.columns

    if not (pb or sums or lag or lead or totals or mins or running):
        return _ranks_only(df, order_by, row_number, ntiles, n)

    for name, expr in sums.items():
        df = df.withColumn(f"_sx_{name}", expr)
    for name, (_, expr) in running.items():
        df = df.withColumn(f"_rx_{name}", expr)
    if pb:
        # one struct key: null-safe by construction and a single hash key
        df = df.withColumn(_SEG, F.struct(*[F.col(p) for p in pb]))
        seg_keys = [BUCKET, _SEG]
        keys = [F.col(_SEG).asc_nulls_first(), *order_by]
    else:
        seg_keys = [BUCKET]
        keys = list(order_by)

    bucketed = checkpointed(_by_range(df, keys, n).withColumn(BUCKET, F.spark_partition_id()))
    # one task per bucket (hashing the ids would double some up); the windows need no further shuffle
    if not pb or bucketed.rdd.getNumPartitions() > 1:  # keys of one bucket are dealt by hash
        bucketed = bucketed.repartitionById(max(1, bucketed.rdd.getNumPartitions()), BUCKET)

    w = Window.partitionBy(*seg_keys).orderBy(*order_by)
    w_run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_all = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    local = bucketed.withColumn("_lrn", F.row_number().over(w)).withColumn("_lcnt", F.count(F.lit(1)).over(w_all))
    for name in sums:
        local = local.withColumn(f"_lsum_{name}", F.sum(f"_sx_{name}").over(w_run))
    for name, (op, _) in running.items():
        local = local.withColumn(f"_lrun_{name}", _RUNNING[op][0](F.col(f"_rx_{name}")).over(w_run))
    if pb:  # what a key that lies in one bucket needs
        local = local.withColumns({f"_ltot_{name}": F.sum(f"_sx_{src}").over(w_all) for name, src in totals.items()}
                                  | {f"_lmin_{name}": F.min(src).over(w_all) for name, src in mins.items()})
    for name, src in lag.items():
        local = local.withColumn(f"_llag_{name}", F.lag(src).over(w))
    for name, src in lead.items():
        local = local.withColumn(f"_llead_{name}", F.lead(src).over(w))

    across = bucketed
    if pb:
        ends = bucketed.groupBy(BUCKET).agg(F.min(_SEG).alias("_lo"), F.max(_SEG).alias("_hi"))
        cut = (ends.select(BUCKET, F.explode(F.array("_lo", "_hi")).alias(_SEG)).distinct()
               .groupBy(_SEG).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(_SEG))
        across = bucketed.join(F.broadcast(cut), _SEG, "left_semi")  # at most one key per bucket end
    # partial aggregation straight from the buckets, no second sort; the order as a struct of ranks of its own direction
    seg_aggs = [F.count(F.lit(1)).alias("_scnt")]
    seg_aggs += [F.sum(f"_sx_{name}").alias(f"_ssum_{name}") for name in sums]
    seg_aggs += [F.min(src).alias(f"_smin_{name}") for name, src in mins.items()]
    lasts = [name for name, (op, _) in running.items() if op == "last"]
    seg_aggs += [_RUNNING[op][0](F.col(f"_rx_{name}")).alias(f"_srun_{name}") for name, (op, _) in running.items()
                 if op != "last"]
    if (lag or lead or lasts) and not all_asc:
        # segment first/last values taken from windows over the segments that are cut
        edge = across
        for name, src in lag.items():
            edge = edge.withColumn(f"_slast_{name}", F.last(src).over(w_all))
        for name, src in lead.items():
            edge = edge.withColumn(f"_sfirst_{name}", F.first(src).over(w_all))
        for name in lasts:
            edge = edge.withColumn(f"_srun_{name}", F.last(f"_rx_{name}", ignorenulls=True).over(w_all))
        seg_aggs += [F.first(c).alias(c) for c in edge.columns if c.startswith(("_slast_", "_sfirst_", "_srun_"))]
        seg = edge.groupBy(*seg_keys).agg(*seg_aggs)
    else:
        key = F.struct(*[F.col(c) for c in order_names])
        seg_aggs += [F.max_by(F.col(src), key).alias(f"_slast_{name}") for name, src in lag.items()]
        seg_aggs += [F.min_by(F.col(src), key).alias(f"_sfirst_{name}") for name, src in lead.items()]
        seg_aggs += [F.max_by(f"_rx_{name}", F.when(F.col(f"_rx_{name}").isNotNull(), key)).alias(f"_srun_{name}")
                     for name in lasts]
        seg = across.groupBy(*seg_keys).agg(*seg_aggs)

    ws = (Window.partitionBy(_SEG) if pb else Window.partitionBy()).orderBy(BUCKET)
    ws_before = ws.rowsBetween(Window.unboundedPreceding, -1)
    whole = ws.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seg = seg.withColumn("_ocnt", F.coalesce(F.sum("_scnt").over(ws_before), F.lit(0)))
    if ntiles:
        seg = seg.withColumn("_ntot", F.sum("_scnt").over(whole))
    for name in sums:
        seg = seg.withColumn(f"_osum_{name}", F.sum(f"_ssum_{name}").over(ws_before))
    for name, (op, _) in running.items():
        seg = seg.withColumn(f"_orun_{name}", _RUNNING[op][0](F.col(f"_srun_{name}")).over(ws_before))
    for name, src in totals.items():
        seg = seg.withColumn(f"_tot_{name}", F.sum(f"_ssum_{src}").over(whole))
    for name in mins:
        seg = seg.withColumn(f"_pmin_{name}", F.min(f"_smin_{name}").over(whole))
    for name in lag:
        seg = seg.withColumn(f"_pprev_{name}", F.lag(f"_slast_{name}").over(ws))
    for name in lead:
        seg = seg.withColumn(f"_pnext_{name}", F.lead(f"_sfirst_{name}").over(ws))
    keep = [c for c in seg.columns
            if c.startswith(("_ocnt", "_ntot", "_osum_", "_orun_", "_tot_", "_pmin_", "_pprev_", "_pnext_"))]
    seg = seg.select(*seg_keys, *keep)
    # one row per bucket, or two per bucket end: a size bounded by the bucket count
    joined = local.join(F.broadcast(seg), on=seg_keys, how="left" if pb else "inner")
    if pb:  # keys of one bucket have no offsets
        inside = F.col("_ocnt").isNull()
        joined = joined.withColumns(
            {"_ntot": F.when(inside, F.col("_lcnt")).otherwise(F.col("_ntot")) if ntiles else F.lit(0)}
            | {f"_tot_{c}": F.when(inside, F.col(f"_ltot_{c}")).otherwise(F.col(f"_tot_{c}")) for c in totals}
            | {f"_pmin_{c}": F.when(inside, F.col(f"_lmin_{c}")).otherwise(F.col(f"_pmin_{c}")) for c in mins}
        ).withColumn("_ocnt", F.coalesce("_ocnt", F.lit(0)))

    out = joined
    rn = (F.col("_ocnt") + F.col("_lrn")).cast("long")
    if row_number:
        out = out.withColumn(row_number, rn)
    for name, k in ntiles.items():
        out = out.withColumn(name, _ntile(rn, F.col("_ntot").cast("long"), k))
    for name in sums:
        off, loc = F.col(f"_osum_{name}"), F.col(f"_lsum_{name}")
        out = out.withColumn(name, F.when(off.isNull() & loc.isNull(), F.lit(None))
                             .otherwise(F.coalesce(off, F.lit(0)) + F.coalesce(loc, F.lit(0))))
    for name, (op, _) in running.items():
        out = out.withColumn(name, _RUNNING[op][1](F.col(f"_orun_{name}"), F.col(f"_lrun_{name}")))
    for name in totals:
        out = out.withColumn(name, F.col(f"_tot_{name}"))
    for name in mins:
        out = out.withColumn(name, F.col(f"_pmin_{name}"))
    for name in lag:
        out = out.withColumn(name, F.when(F.col("_lrn") == 1, F.col(f"_pprev_{name}"))
                             .otherwise(F.col(f"_llag_{name}")))
    for name in lead:
        out = out.withColumn(name, F.when(F.col("_lrn") == F.col("_lcnt"), F.col(f"_pnext_{name}"))
                             .otherwise(F.col(f"_llead_{name}")))
    added = [row_number] if row_number else []
    added += list(ntiles) + list(sums) + list(totals) + list(mins) + list(running) + list(lag) + list(lead)
    return out.select(*original, *added)


def _ranks_only(df: DataFrame, order_by: list[Column], row_number: str | None, ntiles: Mapping[str, int],
                n: int | None) -> DataFrame:
    """Global row number / ntile without a window.

    After the range shuffle each bucket is sorted in place, so a row's
    position inside its bucket is the low part of
    ``monotonically_increasing_id()`` (partition index in the upper bits,
    row position in the lower 33).  Bucket, position and the per-bucket
    counts all come from one checkpointed copy; the offsets table has one
    row per bucket.
    """
    original = df.columns
    pinned = checkpointed(_by_range(df, order_by, n).sortWithinPartitions(*order_by)
                          .withColumns({BUCKET: F.spark_partition_id(), "_mid": F.monotonically_increasing_id()}))
    counts = pinned.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("_scnt"))
    ws = Window.partitionBy().orderBy(BUCKET)
    offsets = counts.select(
        BUCKET,
        F.coalesce(F.sum("_scnt").over(ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_ocnt"),
        F.sum("_scnt").over(ws.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_ntot"))
    joined = pinned.join(F.broadcast(offsets), BUCKET)
    local = F.col("_mid") - F.shiftleft(F.col(BUCKET).cast("long"), 33) + 1
    rn = (F.col("_ocnt") + local).cast("long")
    out = joined
    if row_number:
        out = out.withColumn(row_number, rn)
    for name, k in ntiles.items():
        out = out.withColumn(name, _ntile(rn, F.col("_ntot").cast("long"), k))
    added = ([row_number] if row_number else []) + list(ntiles)
    return out.select(*original, *added)


def tile_ends(df: DataFrame, measures: Sequence[str], key: str, n: int) -> Column:
    """The last (value, key) of every tile but the top one, of ``ntile(n) over (order by measure, key)``, all measures.

    One struct, as one scalar subquery: a field per measure with at most ``n - 1``
    pairs.  The measures are unpivoted to rows ``(measure, value, key)``, each
    value in a column of its own type, and ordered by one range shuffle with the
    measure leading.  Row positions come from the sorted buckets, the buckets'
    counts (one row per bucket and measure) tell which position ends a tile, and only those
    rows leave the scan.  ``df`` is read once more: materialise it if it is expensive.
    """
    values = [f"v{i}" for i in range(len(measures))]
    types = [df.schema[m].dataType for m in measures]

    def row(i: int) -> Column:
        own = [(F.col(m) if i == j else F.lit(None)).cast(t).alias(v)
               for j, (m, t, v) in enumerate(zip(measures, types, values, strict=True))]
        return F.struct(F.lit(i).alias("m"), *own, F.col(key).alias("k"))

    rows = df.select(F.explode(F.array(*[row(i) for i in range(len(measures))])).alias("r")).select("r.*")
    order = [F.col(c).asc_nulls_first() for c in ("m", *values, "k")]
    pinned = checkpointed(_by_range(rows, order, None).sortWithinPartitions(*order)
                          .withColumns({BUCKET: F.spark_partition_id(), "_mid": F.monotonically_increasing_id()}))
    runs = pinned.groupBy(BUCKET, "m").agg(F.count(F.lit(1)).alias("rows"), F.min("_mid").alias("first"))
    by_measure = Window.partitionBy("m").orderBy(BUCKET)
    everything = by_measure.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = runs.select("first", "rows", (F.sum("rows").over(by_measure) - F.col("rows")).alias("before"),
                         F.sum("rows").over(everything).alias("total"))
    # tile i ends at row i * floor(total / n) + min(i, total mod n); in this bucket if that lies among its rows
    ends = (placed.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(n - 1))))
            .withColumn("at", F.expr(f"i * (total div {n}) + least(i, total % {n}) - before"))
            .where("at between 1 and rows").select((F.col("first") + F.col("at") - 1).alias("_mid")).distinct())
    # at most (n - 1) rows per measure
    picked = pinned.join(F.broadcast(ends), "_mid", "left_semi")
    lists = [F.sort_array(F.collect_list(F.when(F.col("m") == i, F.struct(F.col(v).alias("m"), F.col("k"))))).alias(m)
             for i, (m, v) in enumerate(zip(measures, values, strict=True))]
    return picked.agg(*lists).select(F.struct(*measures)).scalar()


def with_tiles(df: DataFrame, tiles: Mapping[str, str], key: str, n: int) -> DataFrame:
    """Add ``{name: measure}`` columns ``ntile(n) over (order by measure, key)``; rows with equal pairs share a tile.

    The ends are attached once, so every row is labelled by comparisons and the
    wide rows are never shuffled.
    """
    attached = df.withColumn("_ends", tile_ends(df, list(dict.fromkeys(tiles.values())), key, n))

    def tile(measure: str) -> Column:
        pair = F.struct(F.col(measure).alias("m"), F.col(key).alias("k"))
        ends = F.col("_ends").getField(measure)
        return sum((F.when(pair > F.try_element_at(ends, F.lit(i)), 1).otherwise(0) for i in range(1, n)), F.lit(1))

    return attached.withColumns({name: tile(m) for name, m in tiles.items()}).drop("_ends")


def _ntile(r: Column, total: Column, n: int) -> Column:
    """SQL ``ntile(n)`` from the 1-based row number ``r`` of ``total`` rows:
    the first ``total % n`` tiles hold one extra row."""
    q = F.floor(total / F.lit(n)).cast("long")
    m = total - q * F.lit(n)
    big = m * (q + 1)
    return (F.when(q == 0, r)
            .when(r <= big, F.floor((r - 1) / (q + 1)) + 1)
            .otherwise(m + F.floor((r - big - 1) / F.greatest(q, F.lit(1))) + 1)).cast("long")
