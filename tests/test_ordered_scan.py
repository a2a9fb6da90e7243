"""ordered_scan equals the single global / partitioned window."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillsight.plans.ordered import ordered_scan


def _frame(spark, n=2000, seed=7):
    rnd = random.Random(seed)
    rows = [(rnd.choice([None, 1, 2, 3]), rnd.choice([None, 5, 5, 5, 5, 6, 7]), i,
             rnd.choice([None, "1.50", "2.00", "-3.25"])) for i in range(n)]
    return spark.createDataFrame(rows, "g long, k long, id long, v string").withColumn(
        "v", F.col("v").cast("decimal(18,2)"))


def _reference(df, order, pb):
    cols = [F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last() for c, asc in order]
    w = (Window.partitionBy(*pb) if pb else Window.partitionBy()).orderBy(*cols)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    return df.select("*", F.row_number().over(w).cast("long").alias("rn"),
                     F.ntile(5).over(w).cast("long").alias("nt"),
                     F.sum("v").over(run).alias("rs"), F.lag("k").over(w).alias("pk"),
                     F.lead("v").over(w).alias("nv"))


@pytest.mark.parametrize("pb", [[], ["g"]])
@pytest.mark.parametrize("order", [[("k", True), ("id", True)], [("k", False), ("id", True)]])
def test_matches_window(spark, pb, order):
    df = _frame(spark)
    got = ordered_scan(df, order, partition_by=pb, row_number="rn", ntiles={"nt": 5},
                       running_sums={"rs": F.col("v")}, lag={"pk": "k"}, lead={"nv": "v"}, buckets=7,
                       totals={"tot": "rs"}, mins={"mk": "k"})
    ref = _reference(df, order, pb)
    whole = Window.partitionBy(*pb) if pb else Window.partitionBy()
    ref = ref.select(*df.columns, "rn", "nt", "rs", F.sum("v").over(whole).alias("tot"),
                     F.min("k").over(whole).alias("mk"), "pk", "nv")
    assert got.exceptAll(ref).count() == 0
    assert ref.exceptAll(got).count() == 0


@pytest.mark.parametrize("pb", [[], ["g"]])
@pytest.mark.parametrize("order", [[("k", True), ("id", True)], [("k", False), ("id", True)]])
def test_running_minimum_maximum_and_last_value(spark, pb, order):
    df = _frame(spark).withColumn("s", F.when(F.col("id") % 7 == 0, F.col("id")))
    got = ordered_scan(df, order, partition_by=pb, buckets=9,
                       running={"lo": ("min", F.col("v")), "hi": ("max", F.col("v")), "prev": ("last", F.col("s"))})
    cols = [F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last() for c, asc in order]
    run = (Window.partitionBy(*pb) if pb else Window.partitionBy()).orderBy(*cols).rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("*", F.min("v").over(run).alias("lo"), F.max("v").over(run).alias("hi"),
                    F.last("s", ignorenulls=True).over(run).alias("prev"))
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_only_cut_keys_need_other_buckets(spark):
    """Many keys: the rows that carry offsets across buckets are bounded by the buckets, not by the keys."""
    df = spark.range(5000).select((F.col("id") % 1000).alias("g"), F.col("id").alias("k"), F.col("id"))
    got = ordered_scan(df, ["k"], partition_by=["g"], row_number="rn", buckets=6)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert got.groupBy("g").agg(F.max("rn").alias("m")).where("m != 5").isEmpty()


@pytest.mark.parametrize("order", [[("k", True), ("id", True)], [("k", False), ("id", False)]])
def test_rank_only_path_matches_window(spark, order):
    df = _frame(spark)
    got = ordered_scan(df, order, row_number="rn", ntiles={"nt": 5, "nt7": 7}, buckets=5)
    cols = [F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last() for c, asc in order]
    w = Window.partitionBy().orderBy(*cols)
    ref = df.select("*", F.row_number().over(w).cast("long").alias("rn"), F.ntile(5).over(w).cast("long").alias("nt"),
                    F.ntile(7).over(w).cast("long").alias("nt7"))
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_all_ties_and_fewer_rows_than_tiles(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 0)], "id long, k long")
    got = ordered_scan(df, ["k", "id"], ntiles={"nt": 5}, row_number="rn", buckets=4)
    assert sorted((r.id, r.rn, r.nt) for r in got.collect()) == [(1, 1, 1), (2, 2, 2), (3, 3, 3)]


def test_empty_input(spark):
    df = spark.createDataFrame([], "id long, k long")
    assert ordered_scan(df, ["k", "id"], row_number="rn", buckets=3).count() == 0


def test_no_single_partition_exchange(spark):
    df = _frame(spark)
    got = ordered_scan(df, ["k", "id"], row_number="rn", running_sums={"rs": F.col("v")}, buckets=4)
    assert_row_level_work_is_partitioned(got)


def assert_row_level_work_is_partitioned(df):
    """The only single-partition exchange allowed sits on an aggregate (one
    row per bucket), never on row-level data."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "Aggregate" in lines[i + 1], "\n".join(lines[i - 2:i + 3])


def test_hot_key_is_split_across_buckets(spark):
    """One partition key holding half of all rows is still spread over several
    buckets (the range sample covers the compound key), and results stay exact."""
    rows = [(0 if i % 2 == 0 else i % 50, i % 13, i) for i in range(4000)]
    df = spark.createDataFrame(rows, "g long, k long, id long").withColumn("v", F.col("id").cast("decimal(18,2)"))
    seg = F.struct(F.col("g"))
    spread = (df.repartitionByRange(8, seg.asc_nulls_first(), F.col("k").asc_nulls_first(), F.col("id").asc_nulls_first())
              .where("g = 0").select(F.spark_partition_id().alias("p")).distinct().count())
    assert spread >= 3
    got = ordered_scan(df, ["k", "id"], partition_by=["g"], row_number="rn", running_sums={"rs": F.col("v")},
                       lag={"pk": "k"}, buckets=8)
    w = Window.partitionBy("g").orderBy("k", "id")
    ref = df.select("*", F.row_number().over(w).cast("long").alias("rn"),
                    F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rs"),
                    F.lag("k").over(w).alias("pk"))
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


@pytest.mark.parametrize("pb", [[], ["g"]])
def test_default_buckets_follow_aqe(spark, pb):
    """No explicit bucket count: ranges come from the shuffle-partition
    setting and AQE may merge them; results must not change."""
    df = _frame(spark, n=3000)
    order = [("k", True), ("id", True)]
    got = ordered_scan(df, order, partition_by=pb, row_number="rn", ntiles={"nt": 5},
                       running_sums={"rs": F.col("v")}, lag={"pk": "k"}, lead={"nv": "v"})
    ref = _reference(df, order, pb)
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0
    ranks = ordered_scan(df, order, row_number="rn", ntiles={"nt": 5})
    ref2 = _reference(df, order, []).select(*df.columns, "rn", "nt")
    assert ranks.exceptAll(ref2).count() == 0 and ref2.exceptAll(ranks).count() == 0
