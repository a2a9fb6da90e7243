"""Customer-grain analytics: summary, RFM, ABC classes, latency, lifetime
inputs and next-purchase features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.functions.columns import as_of_date, col, where
from tillsight.functions.dates import day_diff, quarter_label
from tillsight.operators.products import percentage
from tillsight.plans.ordered import checkpointed, ordered_scan, with_tiles

# fixed values: sale marker and RFM segment labels of the original macros
SALE = "VENTE"
RFM_LABELS = ("Risky", "Hold and improve", "Potential loyal", "Loyal", "Star", "Other")


def get_customers(df: DataFrame, *, customer_id, revenue, order_id, quantity, date, transaction_type,
                  sale_value: str = SALE, as_of=None) -> DataFrame:
    """Sales-only customer summary (one row per customer)."""
    today = as_of_date(as_of)
    agg = (df.where(col(transaction_type) == F.lit(sale_value))
           .groupBy(col(customer_id).alias("customer_id"))
           .agg(F.sum(col(revenue)).alias("revenue"),
                F.countDistinct(col(order_id)).alias("orders"),
                F.sum(col(quantity)).alias("items"),
                F.min(col(date)).try_cast("date").alias("first_order_date"),
                F.max(col(date)).try_cast("date").alias("last_order_date")))
    return agg.withColumns({
        "avg_items": F.round(F.col("items") / F.col("orders"), 2),
        "avg_order_value": F.round(F.col("revenue") / F.col("orders"), 2),
        "tenure": day_diff(today, F.col("first_order_date")),
        "recency": day_diff(today, F.col("last_order_date")),
        "cohort": quarter_label(F.col("first_order_date")),
    })


def _rfm_segment(label):
    risky, hold, potential, loyal, star, other = RFM_LABELS
    return (F.when(label.between(111, 155), risky)
            .when(label.between(211, 255), hold)
            .when(label.between(311, 353), potential)
            .when(label.between(354, 454) | label.between(511, 535) | (label == 541), loyal)
            .when((label == 455) | label.between(542, 555), star)
            .otherwise(other))


def get_rfm_segments(df: DataFrame, *, customer_id, first_order_date, last_order_date, recency, orders,
                     revenue, tenure) -> DataFrame:
    """Quintiles of recency, frequency and monetary value -> named segment.

    Recency is ranked ascending as in the original (rank 5 = stalest).
    Ties are broken by customer id.
    """
    p = df.select(col(customer_id).alias("customer_id"), col(first_order_date).alias("acquisition_date"),
                  col(last_order_date).alias("recency_date"), col(recency).alias("recency"),
                  col(orders).alias("frequency"), col(revenue).alias("monetary"), col(tenure).alias("tenure"))
    # one row per customer, read by one ordering of all three measures and one projection
    p = checkpointed(p)
    tiles = with_tiles(p, {"_r": "recency", "_f": "frequency", "_m": "monetary"}, "customer_id", 5)
    # the label is a column of its own, so that it is computed once and not in every comparison
    label = tiles.withColumn("_label", F.col("_r") * 100 + F.col("_f") * 10 + F.col("_m"))
    return label.select("customer_id", "acquisition_date", "recency_date", "recency", "frequency", "monetary",
                        "tenure", _rfm_segment(F.col("_label")).alias("rfm_segments_name"))


def _abc_class(pct, threshold, with_d: bool):
    c = F.when(pct.isNull(), "D") if with_d else None
    a_cond = (pct > 0) & (pct <= threshold)
    b_cond = (pct > threshold) & (pct <= 90)
    c = c.when(a_cond, "A") if c is not None else F.when(a_cond, "A")
    return c.when(b_cond, "B").otherwise("C")


def customer_abc_segments(df: DataFrame, *, customer_id, revenue, recency, threshold=80,
                          total_scope: str = "customer", active_days: int = 365) -> DataFrame:
    """ABC (Pareto) class and rank of customers active in the last year; D for the others.

    ``total_scope="customer"`` keeps the original's per-customer denominator
    (every active customer lands in C); ``"all"`` divides by the grand total.
    """
    rows = df.select(col(customer_id).alias("_cid"), col(revenue).alias("_rev"), col(recency).alias("_rec"))
    # every row goes through the scans, the inactive ones behind the active:
    # the input is read once and no rank is joined back
    on = F.coalesce(F.col("_rec") <= active_days, F.lit(False))
    rows = rows.select("_cid", F.when(on, F.col("_rev")).alias("_rev"), F.when(on, 0).otherwise(1).alias("_off"))
    if total_scope not in ("customer", "all"):
        raise ValueError("total_scope must be 'customer' or 'all'")
    ran = ordered_scan(rows, ["_off", ("_rev", False), "_cid"],
                       running_sums={"_cumsum": F.col("_rev"), "_seen": (1 - F.col("_off")).cast("long")},
                       totals={"_total": "_cumsum", "_active": "_seen"})
    if total_scope == "customer":
        # a customer's rows: one in a customer table
        ran = ran.withColumn("_total", F.sum("_rev").over(Window.partitionBy("_off", "_cid")))
    share = F.round(percentage(F.col("_cumsum"), F.col("_total"), rows.schema["_rev"].dataType), 2)
    ran = ran.withColumn("_pct", F.when(F.col("_off") == 0, share))
    ranked = ordered_scan(ran, ["_off", "_pct", "_cid"], row_number="_rank")
    known = (F.col("_off") == 0) & F.col("_cid").isNotNull()
    return ranked.select(F.col("_cid").alias(_name(customer_id)),
                         _abc_class(F.when(known, F.col("_pct")), threshold, with_d=True).alias("abc_class_name"),
                         F.when(known, F.col("_rank")).otherwise(F.col("_active") + 1).cast("long")
                         .alias("abc_rank_name"))


def _name(c) -> str:
    return c if isinstance(c, str) else "customer_id"


def get_latency(df: DataFrame, *, customer_id, order_date, order_id, as_of=None) -> DataFrame:
    """Inter-purchase latency statistics and a due / overdue label.

    The original takes ``lag`` over every line of a customer.  The gaps only
    depend on the sorted multiset of dates, so lines are first reduced to
    ``(customer, day, lines)``: a day with ``c`` lines contributes ``c - 1`` zero
    gaps plus one gap to the previous day.  Per-customer work is then bounded
    by the number of distinct days, however many lines a customer has, and
    the variance comes from exact integer sums.
    """
    today = as_of_date(as_of)
    base = df.select(col(customer_id).alias("customer_id"), col(order_id).alias("order_id"),
                     col(order_date).alias("order_date"))
    # an order counts once, on its first row of the (customer, date, order) grain
    grain = base.groupBy("customer_id", "order_date", "order_id").agg(F.count(F.lit(1)).alias("_n"))
    nth = F.row_number().over(Window.partitionBy("customer_id", "order_id").orderBy(F.col("order_date").asc_nulls_first()))
    grain = grain.withColumn("_new", F.when(F.col("order_id").isNotNull() & (nth == 1), 1).otherwise(0))
    days = grain.groupBy("customer_id", F.col("order_date").cast("date").alias("_d")).agg(
        F.sum("_n").alias("_c"), F.sum("_new").alias("_f"), F.max("order_date").alias("_latest"))
    w = Window.partitionBy("customer_id").orderBy(F.col("_d").asc_nulls_first())
    days = days.withColumn("_g", F.datediff("_d", F.lag("_d").over(w)).cast("long"))
    nonnull = F.col("_d").isNotNull()
    gaps = days.groupBy("customer_id").agg(
        F.sum("_f").alias("frequency"),
        F.max("_latest").alias("recency_date"),
        F.sum(F.when(nonnull, F.col("_c")).otherwise(0)).alias("_rows"),
        F.coalesce(F.sum("_g"), F.lit(0)).alias("_s"),
        F.coalesce(F.sum(F.col("_g") * F.col("_g")), F.lit(0)).alias("_q"),
        F.min("_g").alias("_gmin"),
        F.max("_g").alias("_gmax"),
        F.max(F.when(nonnull, F.col("_c"))).alias("_cmax"))
    m = F.greatest(F.col("_rows") - 1, F.lit(0))
    dup = F.col("_cmax") > 1
    mean = F.when(m > 0, F.col("_s") / m)
    lo = F.when(m > 0, F.least(F.coalesce("_gmin", F.lit(0)), F.when(dup, 0).otherwise(F.col("_gmin"))))
    hi = F.when(m > 0, F.greatest(F.coalesce("_gmax", F.lit(0)), F.when(dup, 0).otherwise(F.col("_gmax"))))
    num = (m.cast("decimal(38,0)") * F.col("_q") - F.col("_s").cast("decimal(38,0)") * F.col("_s")).cast("double")
    std = F.when(m > 1, F.sqrt(num / (m * (m - 1)).cast("double")))
    j = gaps.select("customer_id", "frequency", "recency_date", mean.alias("_avg"), lo.alias("_min"), hi.alias("_max"),
                    std.alias("_std"))
    j = j.select("customer_id", "frequency", "recency_date",
                 day_diff(today, F.col("recency_date")).alias("recency"),
                 F.round("_avg").alias("avg_latency"),
                 F.round(F.col("_min").cast("double")).alias("min_latency"),
                 F.round(F.col("_max").cast("double")).alias("max_latency"),
                 F.round("_std").alias("std_latency"),
                 F.try_divide(F.col("_std"), F.col("_avg")).alias("cv"))
    upper = F.col("avg_latency") - (F.col("recency") - F.col("std_latency"))
    lower = F.col("avg_latency") - (F.col("recency") + F.col("std_latency"))
    r = F.col("recency")
    label = (F.when(r < lower, "Order not due")
             .when((r <= lower) | (r <= upper), "Order due soon")
             .when(r > upper, "Order overdue")
             .otherwise("Not sure"))
    return j.withColumns({"days_to_next_order_upper": upper, "days_to_next_order_lower": lower,
                          "latency_label": label})


def get_lifetimes_rfmt(df: DataFrame, *, replacement, customer_id, order_date, order_id, revenue,
                       observation_periode_end) -> DataFrame:
    """Frequency / recency / T / monetary inputs for lifetime-value models
    (``recency`` and ``T`` keep the original's naming)."""
    end = as_of_date(observation_periode_end)
    t = df.where(col(replacement) == 0).select(col(customer_id).alias("customer_id"),
                                              col(order_date).alias("order_date"),
                                              col(order_id).alias("order_id"), col(revenue).alias("revenue"))
    first = F.min("order_date").try_cast("date")
    last = F.max("order_date").try_cast("date")
    return t.groupBy("customer_id").agg(
        last.alias("last_order_date"),
        F.countDistinct("order_id").alias("frequency"),
        day_diff(end, first).alias("recency"),
        day_diff(last, first).alias("T"),
        F.round(F.sum("revenue"), 2).alias("monetary"))


def get_next_purchase_date(df: DataFrame, *, customer_id, order_date, order_id, revenue, quantity,
                           row_condition=None) -> DataFrame:
    """Per-line purchase history features and next-purchase targets.

    Per-customer windows run through ``ordered_scan`` so that one customer
    with a large share of the lines is still split over many tasks.
    Ties on the date are broken by order id, revenue and quantity.
    """
    ft = (where(df, row_condition)
          .select(col(customer_id).alias("customer_id"), col(order_date).cast("date").alias("order_date"),
                  col(order_id).alias("order_id"), col(revenue).alias("revenue"),
                  col(quantity).alias("quantity"))
          .distinct())
    has_id = F.when(F.col("order_id").isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("long")
    s = ordered_scan(ft, ["order_date", "order_id", "revenue", "quantity"], partition_by=["customer_id"],
                     running_sums={"total_transactions": has_id, "total_revenue": F.col("revenue")},
                     lag={"previous_order_date": "order_date"},
                     lead={"_next_date": "order_date", "next_purchase_quantity": "quantity",
                           "next_purchase_revenue": "revenue"},
                     # min(order_date) over (partition by customer), from the
                     # scan's bucket minimums: no join of the lines
                     mins={"first_order_date": "order_date"})
    lifetime = day_diff(F.col("order_date"), F.col("first_order_date"))
    prior = F.col("total_transactions") - has_id
    return s.select(
        "order_id", "order_date", "customer_id", "previous_order_date",
        F.coalesce(F.col("total_transactions"), F.lit(0)).cast("long").alias("total_transactions"),
        "total_revenue",
        day_diff(F.col("order_date"), F.col("previous_order_date")).alias("recency"),
        lifetime.alias("customer_lifetime"),
        day_diff(F.col("_next_date"), F.col("order_date")).alias("days_to_next_purchase"),
        F.try_divide(prior.cast("double"), lifetime.cast("double")).alias("frequency"),
        "next_purchase_quantity", "next_purchase_revenue")


# fixed values: the original's daily calendar bounds
CALENDAR_START = "1990-01-01"
CALENDAR_END = "2100-01-01"


def history_rfm_segments(df: DataFrame, *, customer_id, transaction_type, date, revenue, order_id,
                         sale_value: str = SALE, as_of=None, revenue_scope: str = "customer",
                         sort_output: bool = True) -> DataFrame:
    """Slowly-changing RFM state: validity intervals per customer and segment.

    The original joins every purchase interval ``[d, next purchase - 1]`` to a
    daily calendar (1990-01-01..2100-01-01), scores each day, then groups the
    days by state.  Within an interval the state only changes when recency
    crosses 6 or 13 days or the year changes, so each interval is cut at those
    change points instead (at most ~2 + years pieces, not one row per day),
    and the same group-by yields identical intervals.

    ``revenue_scope="customer"`` keeps the original's running sum of the
    customer's *all-time* revenue per purchase date; ``"day"`` sums that
    day's revenue instead.  ``sort_output=False`` skips the original's final
    global ``order by`` (a sampling pass and a range shuffle); rows stay
    grouped by customer.
    """
    today = as_of_date(as_of)
    raw = col(date)
    sales = df.where(col(transaction_type) == F.lit(sale_value)).select(
        col(customer_id).alias("customer_id"), raw.alias("_raw"), col(order_id).alias("_oid"),
        col(revenue).alias("_rev"))
    # one pass over the lines; everything after works on (customer, day) rows
    per_raw = sales.groupBy("customer_id", "_raw").agg(F.countDistinct("_oid").alias("total_order"),
                                                     F.sum("_rev").alias("_day_rev"))
    # running sums, the customer's total and first day, and the next day come from one scan over range
    # buckets: a customer (or the null one) with a large share of the rows is split
    day = F.col("_raw").cast("date")
    if revenue_scope == "customer":
        # distinct (day, order count) rows; each adds the customer's all-time revenue, so the sum so far is a product
        rows = (per_raw.groupBy("customer_id", day.alias("date"), "total_order").agg(F.sum("_day_rev").alias("_rev")))
        order = ["date", "total_order"]
    elif revenue_scope == "day":
        rows = per_raw.select("customer_id", day.alias("date"), "total_order", F.col("_day_rev").alias("_rev"), "_raw")
        order = ["date", "total_order", "_raw"]
    else:
        raise ValueError("revenue_scope must be 'customer' or 'day'")
    scan = ordered_scan(rows, order, partition_by=["customer_id"], row_number="_nth",
                        running_sums={"_rev_to_date": F.col("_rev"), "total_order_to_date": F.col("total_order")},
                        totals={"_all_rev": "_rev_to_date"}, lead={"_next_date": "date"},
                        mins={"first_transaction_date": "date"})
    to_date = F.col("_nth") * F.col("_all_rev") if revenue_scope == "customer" else F.col("_rev_to_date")
    prep = scan.select(
        "date", "customer_id", F.round(to_date, 2).alias("total_revenue_to_date"), "total_order_to_date",
        "first_transaction_date", F.coalesce(F.date_sub("_next_date", 1), today).alias("_next"))

    start = F.greatest(F.col("date"), F.lit(CALENDAR_START).cast("date"))
    end = F.least(F.col("_next"), F.lit(CALENDAR_END).cast("date"))
    # greatest/least skip nulls: a null purchase day must give no days (it
    # still counts in the running sums above)
    prep = prep.withColumns({"_start": start, "_end": end}).where(
        F.col("date").isNotNull() & F.col("_next").isNotNull() & (F.col("_start") <= F.col("_end")))
    s, e = F.col("_start"), F.col("_end")
    new_years = F.when(F.year(e) > F.year(s),
                       F.transform(F.sequence(F.year(s) + 1, F.year(e)), lambda y: F.make_date(y, F.lit(1), F.lit(1))))
    cuts = F.filter(F.array(F.date_add("date", 6), F.date_add("date", 13)), lambda c: (c > s) & (c <= e))
    points = F.array_sort(F.array_distinct(F.concat(F.array(s), cuts, F.coalesce(
        new_years, F.array().cast("array<date>")))))
    # each change point with the day before the next one, built once per interval
    pts = F.col("_points")
    ends = F.concat(F.transform(F.slice(pts, 2, F.size(pts)), lambda d: F.date_sub(d, 1)), F.array(e))
    piece = F.arrays_zip(pts.alias("p"), ends.alias("q"))
    pieces = prep.withColumn("_points", points).select("*", F.explode(piece).alias("_piece")).select(
        "*", F.col("_piece")[F.lit("p")].alias("_p"), F.col("_piece")[F.lit("q")].alias("_q"))

    recency = F.datediff("_p", "date")
    years = (F.year("_p") - F.year("first_transaction_date")).cast("long")
    freq = F.coalesce(F.try_divide(F.col("total_order_to_date").cast("double"), years.cast("double")), F.lit(1.0))
    r_seg = F.when(recency > 12, 1).when(recency.between(6, 12), 2).otherwise(3)
    f_seg = F.when(freq < 1, 1).when(freq.between(1, 2), 2).when(freq > 2, 3).otherwise(3)
    m = F.col("total_revenue_to_date")
    m_seg = F.when(m <= 150, 1).when(m.between(150, 500), 2).when(m > 500, 3).otherwise(3)
    scored = pieces.select("_p", "_q", "customer_id", "total_revenue_to_date", "total_order_to_date",
                           F.col("date").alias("latest_conversion_date"), "first_transaction_date",
                           r_seg.alias("recency_segment"), f_seg.alias("frequency_segment"),
                           m_seg.alias("monetary_segment"))
    keys = ["customer_id", "total_revenue_to_date", "total_order_to_date", "latest_conversion_date",
            "first_transaction_date", "recency_segment", "frequency_segment", "monetary_segment"]
    out = scored.groupBy(*keys).agg(F.min("_p").alias("first_date_state"), F.max("_q").alias("last_date_state"))
    score = (F.col("recency_segment") * F.col("frequency_segment") * F.col("monetary_segment")).cast("long")
    out = out.select("first_date_state", "last_date_state", *keys, score.alias("score"))
    order = [F.col("customer_id").asc_nulls_first(), F.col("first_date_state").asc_nulls_first()]
    return out.orderBy(*order) if sort_output else out.sortWithinPartitions(*order)
