"""Quirks and edge cases of the customer-grain operators (literal frames)."""

import datetime as dt

from pyspark.sql import functions as F

from tillsight.operators import customers as C

D = dt.date


def _lines(spark, rows):
    df = spark.createDataFrame(
        [(c, o, d, str(r), str(q), t) for c, o, d, r, q, t in rows],
        "customer_id long, order_id long, order_date date, revenue string, quantity string, transaction_type string")
    return df.withColumns({"revenue": F.col("revenue").cast("decimal(18,2)"),
                           "quantity": F.col("quantity").cast("decimal(18,2)")})


def test_get_customers_sales_only_and_rounding(spark):
    df = _lines(spark, [
        (1, 10, D(2024, 1, 1), 10.01, 1, "VENTE"),
        (1, 11, D(2024, 1, 3), 0.00, 2, "VENTE"),
        (1, 12, D(2024, 1, 5), 99.00, 5, "RETOUR"),
        (2, 20, D(2023, 12, 31), 5.00, 1, "VENTE"),
    ])
    out = {r.customer_id: r for r in C.get_customers(
        df, customer_id="customer_id", revenue="revenue", order_id="order_id", quantity="quantity",
        date="order_date", transaction_type="transaction_type", as_of=D(2024, 1, 10)).collect()}
    assert out[1].orders == 2 and float(out[1].revenue) == 10.01
    assert float(out[1].avg_order_value) == 5.01  # 5.005 rounds half up
    assert out[1].tenure == 9 and out[1].recency == 7
    assert out[1].cohort == "2024-Q1" and out[2].cohort == "2023-Q4"


def test_rfm_segments_fewer_customers_than_tiles(spark):
    df = spark.createDataFrame([(i, D(2024, 1, 1), D(2024, 1, 2), i, i, i * 10, 5) for i in range(1, 4)],
                               "c long, f date, l date, r long, o long, m long, t long")
    out = C.get_rfm_segments(df, customer_id="c", first_order_date="f", last_order_date="l", recency="r",
                             orders="o", revenue="m", tenure="t")
    # ranks 1,2,3 on every measure -> labels 111, 222, 333
    assert sorted((r.customer_id, r.rfm_segments_name) for r in out.collect()) == [
        (1, "Risky"), (2, "Hold and improve"), (3, "Potential loyal")]


def test_customer_abc_literal_and_total(spark):
    df = spark.createDataFrame([(1, 100.0, 10), (2, 50.0, 20), (3, 30.0, 400), (4, 20.0, 5)],
                               "c long, rev double, rec long").withColumn("rev", F.col("rev").cast("decimal(18,2)"))
    lit = {r.c: (r.abc_class_name, r.abc_rank_name) for r in C.customer_abc_segments(
        df, customer_id="c", revenue="rev", recency="rec").collect()}
    assert lit[3] == ("D", 4)  # inactive: rank = active count + 1
    assert {v[0] for k, v in lit.items() if k != 3} == {"C"}  # per-customer denominator
    tot = {r.c: r.abc_class_name for r in C.customer_abc_segments(
        df, customer_id="c", revenue="rev", recency="rec", total_scope="all").collect()}
    # cumulative shares 58.82, 88.24, 100 -> A, B, C
    assert (tot[1], tot[2], tot[4], tot[3]) == ("A", "B", "C", "D")


def test_latency_labels_and_single_order(spark):
    df = _lines(spark, [
        (1, 1, D(2024, 1, 1), 1, 1, "VENTE"), (1, 2, D(2024, 1, 11), 1, 1, "VENTE"),
        (1, 3, D(2024, 1, 21), 1, 1, "VENTE"), (1, 3, D(2024, 1, 21), 1, 1, "VENTE"),
        (2, 9, D(2024, 1, 5), 1, 1, "VENTE"),
    ])
    out = {r.customer_id: r for r in C.get_latency(df, customer_id="customer_id", order_date="order_date",
                                                   order_id="order_id", as_of=D(2024, 1, 31)).collect()}
    # gaps 10, 10, 0 (same-day line)
    assert out[1].frequency == 3 and out[1].min_latency == 0 and out[1].max_latency == 10
    assert abs(out[1].avg_latency - 7.0) < 1e-9 and out[1].recency == 10
    assert out[2].avg_latency is None and out[2].latency_label == "Not sure"


def test_lifetimes_filters_replacements(spark):
    df = spark.createDataFrame([(1, 0, D(2024, 1, 1), 10, 5.555), (1, 0, D(2024, 1, 4), 11, 1.0),
                                (1, 1, D(2024, 2, 1), 12, 7.0)],
                               "c long, rep int, d date, o long, rev double")
    r = C.get_lifetimes_rfmt(df, replacement="rep", customer_id="c", order_date="d", order_id="o", revenue="rev",
                             observation_periode_end="2024-01-31").collect()[0]
    assert (r.frequency, r.recency, r.T) == (2, 30, 3) and r.last_order_date == D(2024, 1, 4)


def test_next_purchase_features(spark):
    df = _lines(spark, [(1, 1, D(2024, 1, 1), 10, 1, "VENTE"), (1, 2, D(2024, 1, 3), 20, 2, "VENTE"),
                        (1, 3, D(2024, 1, 8), 30, 3, "RETOUR")])
    rows = sorted(C.get_next_purchase_date(df, customer_id="customer_id", order_date="order_date",
                                           order_id="order_id", revenue="revenue", quantity="quantity",
                                           row_condition="transaction_type = 'VENTE'").collect(),
                  key=lambda r: r.order_id)
    assert [r.total_transactions for r in rows] == [1, 2]
    assert rows[0].days_to_next_purchase == 2 and float(rows[0].next_purchase_revenue) == 20
    assert rows[0].frequency is None and rows[1].frequency == 0.5
    assert rows[1].previous_order_date == D(2024, 1, 1) and rows[1].next_purchase_quantity is None


def test_history_rfm_intervals_cover_and_split(spark):
    df = _lines(spark, [(1, 1, D(2023, 12, 20), 100, 1, "VENTE"), (1, 2, D(2024, 1, 20), 600, 1, "VENTE")])
    out = C.history_rfm_segments(df, customer_id="customer_id", transaction_type="transaction_type",
                                 date="order_date", revenue="revenue", order_id="order_id",
                                 as_of=D(2024, 1, 31)).collect()
    first = sorted((r.first_date_state, r.last_date_state, r.recency_segment) for r in out
                   if r.latest_conversion_date == D(2023, 12, 20))
    # recency 0-5 -> 3, 6-12 -> 2, then 1; the new year starts a new frequency state
    assert first[0] == (D(2023, 12, 20), D(2023, 12, 25), 3)
    days = sum((r.last_date_state - r.first_date_state).days + 1 for r in out)
    assert days == (D(2024, 1, 31) - D(2023, 12, 20)).days + 1
    # the running revenue adds the all-time total per purchase date (literal quirk)
    assert {float(r.total_revenue_to_date) for r in out} == {700.0, 1400.0}


def test_history_rfm_day_scope(spark):
    df = _lines(spark, [(1, 1, D(2024, 1, 10), 100, 1, "VENTE"), (1, 2, D(2024, 1, 20), 600, 1, "VENTE")])
    out = C.history_rfm_segments(df, customer_id="customer_id", transaction_type="transaction_type",
                                 date="order_date", revenue="revenue", order_id="order_id",
                                 as_of=D(2024, 1, 31), revenue_scope="day").collect()
    assert {float(r.total_revenue_to_date) for r in out} == {100.0, 700.0}
    assert {r.total_order_to_date for r in out} == {1, 2}


def test_history_rfm_unsorted_option_same_rows(spark):
    df = _lines(spark, [(1, 1, D(2024, 1, 10), 100, 1, "VENTE"), (2, 2, D(2024, 1, 20), 600, 1, "VENTE")])
    kw = dict(customer_id="customer_id", transaction_type="transaction_type", date="order_date",
              revenue="revenue", order_id="order_id", as_of=D(2024, 1, 31))
    a = C.history_rfm_segments(df, **kw)
    b = C.history_rfm_segments(df, sort_output=False, **kw)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
