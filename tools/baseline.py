"""Reference points for bench.py at one scale factor.

* ``duckdb``: each registered query's oracle SQL (the literal macro form) on
  single-node DuckDB over the same parquet files, all cores.
* ``naive``: the literal Spark forms of the four operators whose plans are
  shaped by hand - global windows (one task), the daily calendar join,
  the both-directions self-join with distinct counts, and distinct-count
  windows via ``size(collect_set)``.

    python tools/baseline.py [sf_dir]   -> one JSON line
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from oracle import ORACLE  # noqa: E402
from tillsight.registry import _customers, comparable  # noqa: E402
from tillsight.session import build_session  # noqa: E402
from tillsight.sources import bindings as B  # noqa: E402


def naive_rfm(spark, sf):
    c = _customers(spark, sf)
    r = lambda m: F.ntile(5).over(Window.orderBy(F.col(m), "customer_id"))
    return c.select("customer_id", (r("recency") * 100 + r("orders") * 10 + r("revenue")).alias("label"))


def naive_history(spark, sf):
    s = B.sales_lines(spark, sf).where("transaction_type = 'VENTE'")
    wc, wd = Window.partitionBy("customer_id"), Window.partitionBy("customer_id", "order_date")
    agg = s.select("order_date", "customer_id", F.sum("revenue").over(wc).alias("tr"),
                   F.size(F.collect_set("order_id").over(wd)).alias("tor"),
                   F.min("order_date").over(wc).alias("first")).distinct()
    w = Window.partitionBy("customer_id").orderBy("order_date")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    prep = agg.select("order_date", "customer_id", F.round(F.sum("tr").over(run), 2).alias("rev"),
                      F.sum("tor").over(run).alias("ord"), "first",
                      F.coalesce(F.date_sub(F.lead("order_date").over(w), 1), F.lit(B.ORDERS_AS_OF)).alias("nxt"))
    cal = spark.sql("select explode(sequence(date'1990-01-01', date'2100-01-01')) as d")
    days = cal.join(prep, (cal.d >= prep.order_date) & (cal.d <= prep.nxt))
    rec = F.datediff("d", "order_date")
    f = F.coalesce(F.try_divide(F.col("ord"), F.year("d") - F.year("first")), F.lit(1))
    return days.groupBy("customer_id", "rev", "ord", "order_date", "first",
                        F.when(rec > 12, 1).when(rec >= 6, 2).otherwise(3).alias("r"),
                        F.when(f < 1, 1).when(f <= 2, 2).otherwise(3).alias("f")).agg(F.min("d"), F.max("d"))


def naive_basket(spark, sf):
    od = B.sales_lines(spark, sf).select(F.col("product").alias("p"), "order_id").distinct()
    a, b = od.alias("a"), od.alias("b")
    pairs = a.join(b, (F.col("a.order_id") == F.col("b.order_id")) & (F.col("a.p") != F.col("b.p")))
    return pairs.groupBy("a.p", F.col("b.p").alias("p_b")).agg(F.countDistinct("a.order_id").alias("n"))


def naive_repurchase(spark, sf):
    s = B.sales_lines(spark, sf)
    wo, wpc, wp = Window.partitionBy("order_id"), Window.partitionBy("product", "customer_id"), \
        Window.partitionBy("product")
    pm = s.select("product", "order_id", "quantity", "customer_id",
                  F.size(F.collect_set("product").over(wo)).alias("types"),
                  F.size(F.collect_set(F.when(F.col("quantity") > 0, F.col("order_id"))).over(wpc)).alias("times"))
    return pm.select("product", F.size(F.collect_set(F.when(F.col("types") == 1, F.col("order_id"))).over(wp)).alias("pi"),
                     F.size(F.collect_set(F.when(F.col("times") == 1, F.col("order_id"))).over(wp)).alias("po")) \
        .distinct()


NAIVE = {"get_rfm_segments": naive_rfm, "history_rfm_segments": naive_history,
         "basket_product_analytics": naive_basket, "get_repurchase_rates": naive_repurchase}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    con = duckdb.connect()
    for t in B.TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    duck = {}
    for name, sql in ORACLE.items():
        con.execute(sql).fetchall()  # warm
        t0 = time.perf_counter()
        con.execute(sql).fetchall()
        duck[name] = round(time.perf_counter() - t0, 3)
    spark = build_session()
    naive = {}
    for name, fn in NAIVE.items():
        comparable(fn(spark, sf)).write.format("noop").mode("overwrite").save()  # warm
        t0 = time.perf_counter()
        comparable(fn(spark, sf)).write.format("noop").mode("overwrite").save()
        naive[name] = round(time.perf_counter() - t0, 3)
    print(json.dumps({"sf": sf, "duckdb_literal_sql": duck, "duckdb_total": round(sum(duck.values()), 3),
                      "spark_naive": naive}))


if __name__ == "__main__":
    main()
