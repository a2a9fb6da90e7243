"""Quirks and edge cases of the product-grain operators."""

import datetime as dt

from pyspark.sql import functions as F

from tillsight.operators import customers
from tillsight.operators import products as P

D = dt.date


def test_product_abc_classes_and_ranks(spark):
    df = spark.createDataFrame([("a", "60"), ("b", "25"), ("c", "10"), ("d", "5")], "p string, r string") \
        .withColumn("r", F.col("r").cast("decimal(18,2)"))
    out = {r.product: (r.abc_class_name, r.abc_rank_name) for r in P.product_abc_segments(
        df, product="p", revenue="r", threshold=80).collect()}
    assert out == {"a": ("A", 1), "b": ("B", 2), "c": ("C", 3), "d": ("C", 4)}


def test_basket_pairs_symmetric_and_unassigned(spark):
    df = spark.createDataFrame([("x", 1), ("y", 1), ("y", 1), ("x", 2), ("y", 2), ("z", 2),
                                ("Unassigned", 2), (None, 3), ("x", 3)], "p string, o long")
    rows = {(r.product_item, r.product_item_b): r for r in P.basket_product_analytics(
        df, product="p", order_id="o").collect()}
    assert rows[("x", "y")].associated_orders == rows[("y", "x")].associated_orders == 2
    assert not any("Unassigned" in k for k in rows)
    r = rows[("z", "x")]
    assert (r.item_total_orders, r.item_total_orders_b, r.total_orders) == (1, 3, 3)
    assert r.attachment_percentage == 1.0 and r.expected_attachment_percentage == 1.0


def test_repurchase_rates_flags(spark):
    rows = [  # product, order, qty, customer, line, unit
        ("a", 1, 1, 10, "5.00", "5.00"),   # order 1 holds only product a
        ("a", 2, 1, 10, "5.00", "5.00"), ("b", 2, 1, 10, "3.00", "3.00"),
        ("a", 3, 0, 11, "0.00", "5.00"),   # zero quantity: not a purchase
        ("Unassigned", 3, 1, 11, "1.00", "1.00"),
    ]
    df = spark.createDataFrame(rows, "p string, o long, q long, c long, line string, unit string") \
        .withColumns({"line": F.col("line").cast("decimal(18,2)"), "unit": F.col("unit").cast("decimal(18,2)")})
    out = {r.product: r for r in P.get_repurchase_rates(df, product="p", order_id="o", quantity="q",
                                                        customer_id="c", line_price="line",
                                                        unit_price="unit").collect()}
    a = out["a"]
    assert (a.orders, a.customers, a.purchased_individually, a.purchased_once) == (3, 2, 2, 0)
    assert a.bulk_purchases == 1 and abs(a.bulk_purchase_rate - 0.33) < 1e-9
    assert "Unassigned" not in out and a.bulk_and_repurchase_label.endswith("repurchase")


def test_multi_brand_loyalty_min_days(spark):
    rows = [(1, D(2024, 1, 1), 1, "A", "10", "1"), (1, D(2024, 1, 20), 2, "B", "5", "1"),
            (2, D(2024, 1, 1), 3, "A", "7", "2")]
    df = spark.createDataFrame(rows, "c long, d date, o long, b string, r string, q string") \
        .withColumns({"r": F.col("r").cast("decimal(18,2)"), "q": F.col("q").cast("decimal(18,2)")})
    lit = {(r.date, r.brand): r for r in P.get_multi_brands_loyalty(
        df, customer_id="c", date="d", order_id="o", brand="b", revenue="r", quantity="q",
        days_threshold=30).collect()}
    a = lit[(D(2024, 1, 1), "A")]
    assert (a.new_clients_to_brand, a.new_clients, a.customer_returned) == (2, 2, 2)
    real = {(r.date, r.brand): r for r in P.get_multi_brands_loyalty(
        df, customer_id="c", date="d", order_id="o", brand="b", revenue="r", quantity="q",
        days_threshold=30, min_days=1).collect()}
    a = real[(D(2024, 1, 1), "A")]
    assert (a.customer_returned, a.customer_returned_to_same_brand) == (1, 0)
    assert real[(D(2024, 1, 20), "B")].new_clients == 0


def test_basket_hot_order_grid_is_exact(spark):
    # order 0 holds a third of the rows; a tiny pair budget forces a grid
    hot = [(f"p{i}", 0) for i in range(60)]
    rest = [(f"p{i % 17}", 1 + i % 40) for i in range(120)]
    df = spark.createDataFrame(hot + rest, "p string, o long")
    plain = P.basket_product_analytics(df, product="p", order_id="o")
    grid = P.basket_product_analytics(df, product="p", order_id="o", max_pairs_per_task=50)
    assert plain.count() > 0
    assert plain.exceptAll(grid).count() == 0 and grid.exceptAll(plain).count() == 0



def test_abc_shares_below_a_cent(spark):
    rows = [("a", 0.004), ("b", 0.003), ("c", 0.001)]
    for kind in ("double", "decimal(12,4)"):
        df = spark.createDataFrame(rows, "p string, r double").withColumn("r", F.col("r").cast(kind))
        out = {r.product: r.abc_class_name for r in P.product_abc_segments(df, product="p", revenue="r").collect()}
        assert out == {"a": "A", "b": "B", "c": "C"}
        c = df.withColumn("age", F.lit(1))
        got = customers.customer_abc_segments(c, customer_id="p", revenue="r", recency="age", total_scope="all")
        assert {r.p: r.abc_class_name for r in got.collect()} == {"a": "A", "b": "B", "c": "C"}


def test_repurchase_with_a_hot_guest(spark):
    # half of one product's purchases have no customer
    rows = [("p", i, None if i % 2 else i, 1, 2.0) for i in range(40)] + [("q", 1, 7, 1, 3.0), ("p", 100, 0, 1, 2.0)]
    df = spark.createDataFrame(rows, "product string, order_id long, customer_id long, quantity int, price double")
    prices = spark.createDataFrame([("p", 2.0), ("q", 3.0)], "product string, unit_price double")
    got = {r.product: r for r in P.get_repurchase_rates(
        df, product="product", order_id="order_id", quantity="quantity", customer_id="customer_id",
        line_price="price", unit_prices=prices).collect()}
    same = {r.product: r for r in P.get_repurchase_rates(
        df, product="product", order_id="order_id", quantity="quantity", customer_id="customer_id",
        line_price="price", unit_price="price").collect()}
    assert got == same
    p = got["p"]
    # customer 0 bought twice; the guests are one customer group with 20 orders
    assert (p.orders, p.customers, p.purchased_once, p.repurchases) == (41, 20, 19, 22)
    assert (p.purchased_individually, p.avg_unit_price) == (40, 2.0)


def test_repurchase_counts_orders_without_a_quantity_of_a_pair_that_bought_once(spark):
    rows = [("p", 1, 7, 1), ("p", 2, 7, 0), ("p", 3, 7, None),  # bought once, in three orders
            ("p", 4, None, 1), ("p", 5, None, 0), ("p", None, None, 1),  # guests: once, an order more, no order
            ("p", 6, 8, 1), ("p", 7, 8, 1), ("p", 8, 8, 0),  # bought twice
            ("p", 9, 9, 0),  # never
            ("p", 2, 10, 1), ("q", 2, 10, 1)]  # an order of two customers
    df = spark.createDataFrame(rows, "product string, order_id long, customer_id long, quantity int").withColumn(
        "price", F.lit(1.0))
    got = {r.product: r for r in P.get_repurchase_rates(
        df, product="product", order_id="order_id", quantity="quantity", customer_id="customer_id",
        line_price="price", unit_price="price").collect()}
    assert (got["p"].orders, got["p"].customers, got["p"].purchased_once) == (9, 4, 5)
    assert (got["q"].orders, got["q"].customers, got["q"].purchased_once) == (1, 1, 1)
