
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillsight.operators import products as P
from tillsight.plans.ordered import ordered_scan

ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(-2, 2))),
                min_size=0, max_size=40)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(rows=ROWS, n=st.integers(1, 7), buckets=st.integers(1, 5))
def test_ntile_sizes_and_equality(spark, rows, n, buckets):
    df = spark.createDataFrame([(g, k, i) for i, (g, k) in enumerate(rows)], "g long, k long, id long")
    got = ordered_scan(df, [("k", False), "id"], ntiles={"t": n}, row_number="rn", buckets=buckets)
    w = Window.partitionBy().orderBy(F.col("k").desc_nulls_last(), "id")
    ref = df.select("*", F.row_number().over(w).cast("long").alias("rn"), F.ntile(n).over(w).cast("long").alias("t"))
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0
    sizes = Counter(r.t for r in got.collect())
    if sizes:
        assert max(sizes.values()) - min(sizes.values()) <= 1


@SETTINGS
@given(rows=ROWS, buckets=st.integers(1, 5))
def test_partitioned_running_sum_and_lag(spark, rows, buckets):
    df = spark.createDataFrame([(g, k, i) for i, (g, k) in enumerate(rows)], "g long, k long, id long")
    got = ordered_scan(df, ["k", "id"], partition_by=["g"], running_sums={"s": F.col("k")}, lag={"p": "id"},
                       lead={"q": "k"}, buckets=buckets)
    w = Window.partitionBy("g").orderBy(F.col("k").asc_nulls_first(), "id")
    ref = df.select("*", F.sum("k").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
                    F.lag("id").over(w).alias("p"), F.lead("k").over(w).alias("q"))
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d", None]), st.integers(1, 6)), max_size=30))
def test_basket_pairs_symmetric(spark, rows):
    df = spark.createDataFrame(rows, "p string, o long")
    out = {(r.product_item, r.product_item_b): r.associated_orders
           for r in P.basket_product_analytics(df, product="p", order_id="o").collect()}
    grid = {(r.product_item, r.product_item_b): r.associated_orders
            for r in P.basket_product_analytics(df, product="p", order_id="o", max_pairs_per_task=2).collect()}
    assert grid == out
    assert all(out[(b, a)] == n for (a, b), n in out.items())
    expected = Counter()
    for o in {o for _, o in rows}:
        items = {p for p, oo in rows if oo == o and p is not None}
        expected.update((a, b) for a in items for b in items if a != b)
    assert out == dict(expected)
