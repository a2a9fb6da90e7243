"""Product-grain analytics: ABC classes, basket associations, repurchase
rates and multi-brand loyalty."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.functions.columns import col, join_nullsafe, where
from tillsight.plans.ordered import checkpointed, dealt, ordered_scan, with_tiles

# fixed value: placeholder product excluded by the original macros
UNASSIGNED = "Unassigned"

# fixed values: quintile labels of the repurchase report, tile 1 to 5
BULK_LABELS = ("Very low bulk", "Low bulk", "Moderate bulk", "High bulk", "Very high bulk")
REPURCHASE_LABELS = ("Very low repurchase", "Low repurchase", "Moderate repurchase", "High repurchase",
                     "Very high repurchase")


def _assigned(c, unassigned: str):
    """``product != 'Unassigned'``; also drops null products.  Non-string
    product keys are compared through their text."""
    return c.cast("string") != F.lit(unassigned)


def percentage(part, whole, kind: T.DataType):
    """``part * 100 / whole`` of sums over a column of type ``kind``.

    Decimal sums keep their scale; their precision is brought down to 23 digits
    before the point, so that the ratio keeps its fractional digits (38-digit
    operands leave only 6).  Other numbers are divided as doubles.
    """
    if isinstance(kind, T.DecimalType):
        narrow = f"decimal({min(38, 23 + kind.scale)},{kind.scale})"
        return F.try_divide(part.cast(narrow) * 100, whole.cast(narrow))
    return F.try_divide(part.cast("double") * 100, whole.cast("double"))


def product_abc_segments(df: DataFrame, *, product, revenue, threshold=80) -> DataFrame:
    """ABC class and rank of every input row by running revenue share."""
    p = df.select(col(product).alias("product"), col(revenue).alias("revenue"))
    # sum() over () comes from the scan's bucket sums: the input is read once
    ran = ordered_scan(p, [("revenue", False), "product"], running_sums={"_cumsum": F.col("revenue")},
                       totals={"_total": "_cumsum"})
    ran = ran.withColumn("_pct", F.round(percentage(F.col("_cumsum"), F.col("_total"), p.schema["revenue"].dataType), 2))
    ranked = ordered_scan(ran, ["_pct", "product"], row_number="abc_rank_name")
    pct = F.col("_pct")
    cls = (F.when((pct > 0) & (pct <= threshold), "A")
           .when((pct > threshold) & (pct <= 90), "B")
           .otherwise("C"))
    return ranked.select("product", cls.alias("abc_class_name"), "abc_rank_name")


# orders that would build more pairs than this in one task are split into a grid of cells
DEFAULT_MAX_PAIRS_PER_TASK = 10_000_000


def basket_product_analytics(df: DataFrame, *, product, order_id, unassigned: str = UNASSIGNED,
                             max_pairs_per_task: int = DEFAULT_MAX_PAIRS_PER_TASK) -> DataFrame:
    """Ordered product pairs bought in the same order, attachment rate vs. base rate.

    Pairs are built once with ``a < b`` and mirrored after aggregation, which
    halves the self-join.  ``(product, order)`` is distinct, so the distinct
    order counts of the original become plain counts; each row carries its
    product's order count through the pair aggregate.  An order of ``k`` products is
    laid out on an s x s grid of product-hash cells, ``s = ceil(k / side)``
    with ``side**2 / 2 <= max_pairs_per_task``: side a is placed in its own cell row
    and copied across the s columns, side b the other way round, so every pair meets
    in exactly one cell and no task builds more than about ``max_pairs_per_task``
    pairs.  Normal orders have a single cell.
    """
    # both join sides, the counts and the total read the distinct
    # (product, order) rows: materialise them once
    od = checkpointed(df.select(col(product).alias("product_item"), col(order_id).alias("order_id"))
                      .where(_assigned(F.col("product_item"), unassigned))
                      .distinct())
    side = max(2, int(math.isqrt(2 * max_pairs_per_task)))
    items = od.groupBy("product_item").agg(F.count("order_id").alias("_n"))
    grid = od.groupBy("order_id").agg(F.ceil(F.count(F.lit(1)) / side).cast("int").alias("_s"))
    total = od.agg(F.countDistinct("order_id")).scalar()  # count(distinct) over (): a scalar
    cells = od.join(items, "product_item").join(grid, "order_id")
    span = F.explode(F.sequence(F.lit(0), F.col("_s") - 1))
    own = F.pmod(F.xxhash64("product_item"), F.col("_s")).cast("int")
    a = cells.select("order_id", F.col("product_item").alias("p1"), F.col("_n").alias("_n1"), own.alias("_ca"),
                     span.alias("_cb"))
    b = cells.select("order_id", F.col("product_item").alias("p2"), F.col("_n").alias("_n2"), span.alias("_ca"),
                     own.alias("_cb"))
    cell = ["order_id", "_ca", "_cb"]
    half = (dealt(a, *cell).join(dealt(b, *cell), cell).where(F.col("p1") < F.col("p2"))
            .groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("associated_orders"), F.max("_n1").alias("_n1"),
                                     F.max("_n2").alias("_n2")))
    # each unordered pair gives two rows
    both = F.explode(F.array(
        F.struct(F.col("p1").alias("a"), F.col("p2").alias("b"), F.col("_n1").alias("na"), F.col("_n2").alias("nb")),
        F.struct(F.col("p2").alias("a"), F.col("p1").alias("b"), F.col("_n2").alias("na"), F.col("_n1").alias("nb"))))
    j = half.select("associated_orders", both.alias("_p")).select(
        F.col("_p.a").alias("product_item"), F.col("_p.b").alias("product_item_b"), "associated_orders",
        F.col("_p.na").alias("item_total_orders"), F.col("_p.nb").alias("item_total_orders_b"),
        total.alias("total_orders"))
    return j.select(
        "product_item", "product_item_b", "associated_orders", "item_total_orders", "item_total_orders_b",
        "total_orders",
        F.round(F.col("associated_orders") / F.col("item_total_orders"), 5).alias("attachment_percentage"),
        F.round(F.col("item_total_orders_b") / F.col("total_orders"), 5).alias("expected_attachment_percentage"))


def _label(tile, labels):
    expr = None
    for i, text in enumerate(labels, start=1):
        expr = F.when(tile == i, text) if expr is None else expr.when(tile == i, text)
    return expr


def get_repurchase_rates(df: DataFrame, *, product, order_id, quantity, customer_id, line_price, unit_price=None,
                         unit_prices: DataFrame | None = None, unassigned: str = UNASSIGNED) -> DataFrame:
    """Per-product sales metrics, bulk and repurchase rates, quintile label.

    The original's distinct-count windows become aggregations over the
    ``(product, order, customer)`` grain.  How often a (product, customer) pair
    bought is an aggregate, and so is the order of a pair that bought once; only
    rows without a bought quantity meet the pairs in a null-safe join, a sort-merge join whose
    hot pairs AQE can split.  No window gathers a product, an order or a customer.

    The unit price is a column of the lines, or ``unit_prices`` gives it per product
    (``product``, ``unit_price``): it is then joined to the report, not to the lines.
    """
    price = F.lit(None).cast("double") if unit_price is None else col(unit_price)
    pm = (df.select(col(product).alias("product"), col(order_id).alias("order_id"),
                    col(quantity).alias("quantity"), col(customer_id).alias("customer_id"),
                    col(line_price).alias("line_price"), price.alias("unit_price"))
          .where(_assigned(F.col("product"), unassigned)))
    # one pass over the lines: everything below reads this (product, order,
    # customer) grain, materialised once (three consumers)
    grain = checkpointed(pm.groupBy("product", "order_id", "customer_id").agg(
        F.count(F.lit(1)).alias("_lines"),
        F.sum("line_price").alias("_sl"), F.count("line_price").alias("_cl"),
        F.sum("unit_price").alias("_su"), F.count("unit_price").alias("_cu"),
        F.sum("quantity").alias("_sq"), F.max(F.col("quantity") > 0).alias("_pos")))
    # orders holding a single product, counted per that product: aggregations
    # only (map-side combined), so a hot order never meets a join
    individually = (dealt(grain.where(F.col("order_id").isNotNull()), "order_id", "product").groupBy("order_id")
                    .agg(F.countDistinct("product").alias("_n"), F.min("product").alias("product"))
                    .where(F.col("_n") == 1)
                    .groupBy("product").agg(F.count(F.lit(1)).alias("purchased_individually")))
    bought = F.when(F.col("_pos"), F.col("order_id"))
    pairs = checkpointed(grain.groupBy("product", "customer_id").agg(
        F.count(bought).alias("_times"), F.min(bought).alias("order_id"), F.count("order_id").alias("_orders")))
    customers = pairs.groupBy("product").agg(F.count("customer_id").alias("customers"))
    # the order of a pair that bought once is in its aggregate; only its orders without a quantity are looked up
    single = pairs.where(F.col("_times") == 1)
    unbought = grain.where(F.col("order_id").isNotNull() & ~F.coalesce("_pos", F.lit(False)))
    more = join_nullsafe(unbought.select("product", "customer_id", "order_id"),
                         single.where(F.col("_orders") > 1).select("product", "customer_id"),
                         ["product", "customer_id"], "left_semi")
    once = (single.select("product", "order_id").union(more.select("product", "order_id")).distinct()
            .groupBy("product").agg(F.count(F.lit(1)).alias("purchased_once")))
    sku = (dealt(grain, "product", "order_id").groupBy("product", "order_id").agg(
        *[F.sum(c).alias(c) for c in ("_lines", "_sl", "_cl", "_su", "_cu", "_sq")])
        .groupBy("product").agg(*[F.sum(c).alias(c) for c in ("_lines", "_sl", "_cl", "_su", "_cu")],
                                F.sum("_sq").alias("items"), F.count("order_id").alias("orders")))
    # one row per product each
    sku = sku.join(customers, "product").join(individually, "product", "left").join(once, "product", "left")
    sku = sku.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("purchased_individually", "purchased_once")})
    unit_type = pm.schema["unit_price"].dataType
    if unit_prices is not None:
        unit_type = unit_prices.schema["unit_price"].dataType
        sku = sku.join(unit_prices.select("product", "unit_price"), "product", "left").withColumns({
            "_su": F.col("unit_price") * F.col("_lines"), "_cu": F.when(F.col("unit_price").isNotNull(), F.col("_lines"))})

    # two-level sums widen decimals twice; bring them back to the width of a
    # single sum so that the divisions below keep 12 fractional digits
    sku = sku.withColumns({c: _one_sum_type(F.col(c), pm.schema[src].dataType)
                           for c, src in (("_sl", "line_price"), ("items", "quantity"))}).withColumn(
        "_su", _one_sum_type(F.col("_su"), unit_type))

    def avg(s, c):
        return F.col(s) / F.col(c)

    rep = sku.select(
        "product",
        F.round("_sl", 2).alias("revenue"),
        "items", "orders", "customers",
        F.round(avg("_su", "_cu"), 2).alias("avg_unit_price"),
        F.round(avg("_sl", "_cl"), 2).alias("avg_line_price"),
        F.round(F.col("items") / F.col("orders"), 2).alias("avg_items_per_order"),
        F.round(F.col("items") / F.col("customers"), 2).alias("avg_items_per_customer"),
        "purchased_individually", "purchased_once")
    rep = rep.withColumns({
        "bulk_purchases": F.col("orders") - F.col("purchased_individually"),
        "bulk_purchase_rate": F.round((F.col("orders") - F.col("purchased_individually")) / F.col("orders"), 2),
        "repurchases": F.col("orders") - F.col("purchased_once"),
        "repurchase_rate": F.round((F.col("orders") - F.col("purchased_once")) / F.col("orders"), 2),
    })
    # product grain from here on; only (rate, product) is ordered
    rep = checkpointed(rep)
    tiles = with_tiles(rep, {"_bulk": "bulk_purchase_rate", "_again": "repurchase_rate"}, "product", 5)
    label = F.concat(_label(F.col("_bulk"), BULK_LABELS), F.lit("_"), _label(F.col("_again"), REPURCHASE_LABELS))
    return tiles.withColumn("bulk_and_repurchase_label", label).drop("_bulk", "_again")


def _one_sum_type(c, t):
    """Cast to the type of ``sum()`` over a column of type ``t``."""
    if t.typeName() == "decimal":
        return c.cast(f"decimal({min(38, t.precision + 10)},{t.scale})")
    return c


def get_multi_brands_loyalty(df: DataFrame, *, customer_id, date, order_id, brand, revenue, quantity,
                             days_threshold: int, row_condition=None, min_days: int = 0) -> DataFrame:
    """Daily brand sales, new customers and customers returning within N days.

    ``min_days=0`` keeps the original's inclusive lower bound (the first
    purchase counts as a return); ``min_days=1`` counts real returns.

    Every figure besides the sums is a distinct-customer count, so purchases
    are first reduced to ``(customer, brand, day)``; the original's range
    join becomes an as-of lookup by running minimum (no pairs are formed).
    """
    lines = (where(df, row_condition)
             .select(col(customer_id).alias("customer_id"), col(date).cast("date").alias("date"),
                     col(order_id).alias("order_id"), col(brand).alias("brand"),
                     col(revenue).alias("revenue"), col(quantity).alias("quantity"))
             .distinct())
    # the sums and the (customer, brand, day) rows both read this grain,
    # materialised once; the distinct lines are not
    grain = checkpointed(lines.groupBy("customer_id", "date", "order_id", "brand").agg(
        F.sum("revenue").alias("revenue"), F.sum("quantity").alias("quantity")))
    # one distinct aggregate (two-level, no row expansion); distinct customers
    # come from the (customer, brand, day) rows below
    brand_purchase = grain.groupBy("date", "brand").agg(
        F.sum("revenue").alias("brand_revenue"), F.sum("quantity").alias("brand_quantity"),
        F.countDistinct("order_id").alias("brand_orders"))

    dcb = dealt(grain.where(F.col("customer_id").isNotNull()).select("customer_id", "brand", "date").distinct(),
                "customer_id")

    # One window pass over probes (one per customer and brand, at first-brand-day +
    # min_days) and purchases, in descending time with purchases before probes
    # on the same day: the running min of purchase days is then the first
    # purchase at or after the probe (an as-of lookup), for any brand
    # (per customer) and for the same brand (per customer and brand; the same
    # hash partitioning).  Rows per customer: brands x days, never pairs.
    first_day = F.min("date").over(Window.partitionBy("customer_id", "brand"))
    none = F.lit(None).cast("date")
    buy = F.struct(none.alias("_fbd"), F.col("date").alias("_t"), F.lit(1).alias("_kind"))
    probe_row = F.struct(F.col("_fbd"), F.date_add("_fbd", min_days).alias("_t"), F.lit(0).alias("_kind"))
    opens = F.col("date").eqNullSafe(F.col("_fbd"))
    steps = (dcb.withColumn("_fbd", first_day)
             .select("customer_id", "brand", F.explode(F.when(opens, F.array(buy, probe_row)).otherwise(F.array(buy)))
                     .alias("_e")).select("customer_id", "brand", "_e.*"))
    order = [F.col("_t").desc_nulls_last(), F.col("_kind").desc()]
    w_any = Window.partitionBy("customer_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    w_same = Window.partitionBy("customer_id", "brand").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    buy_day = F.when(F.col("_kind") == 1, F.col("_t"))
    flags = (steps.select("brand", "_fbd", "_kind", "_t",
                     F.min(buy_day).over(w_any).alias("_next_any"),
                     F.min(buy_day).over(w_same).alias("_next_same"),
                     F.min(buy_day).over(Window.partitionBy("customer_id")).alias("_cfd")))
    probe = (F.col("_kind") == 0) & F.col("_fbd").isNotNull()
    hi = F.date_add("_fbd", days_threshold)
    # keyed by purchase day (purchase rows) or first-brand day (probe rows);
    # a customer is new overall on its first brand day iff that day is its
    # first day at all
    day = F.when(F.col("_kind") == 1, F.col("_t")).otherwise(F.col("_fbd"))
    counts = flags.groupBy(day.alias("_ld"), F.col("brand").alias("_lb")).agg(
        F.count(F.when(F.col("_kind") == 1, 1)).alias("_customers"),
        F.count(F.when(probe, 1)).alias("_new_brand"),
        F.count(F.when(probe & (F.col("_fbd") == F.col("_cfd")), 1)).alias("_new"),
        F.count(F.when(probe & (F.col("_next_any") <= hi), 1)).alias("_ret"),
        F.count(F.when(probe & (F.col("_next_same") <= hi), 1)).alias("_same"))

    out = brand_purchase.join(counts, brand_purchase["date"].eqNullSafe(counts["_ld"])
                              & brand_purchase["brand"].eqNullSafe(counts["_lb"]), "left")
    # the original matches loyalty rows (one per first-brand day) on plain
    # equality: no profile, null brand or null day -> null
    loyal = F.col("brand").isNotNull() & F.col("date").isNotNull() & (F.col("_new_brand") > 0)
    out = out.select("date", "brand", "brand_revenue", "brand_quantity", "brand_orders",
                     F.coalesce("_customers", F.lit(0)).alias("brand_customers"),
                     F.coalesce("_new_brand", F.lit(0)).alias("new_clients_to_brand"),
                     F.coalesce("_new", F.lit(0)).alias("new_clients"),
                     F.when(loyal, F.col("_ret")).alias("customer_returned"),
                     F.when(loyal, F.col("_same")).alias("customer_returned_to_same_brand"))
    return out.select("date", "brand", "brand_revenue", "brand_quantity", "brand_orders", "brand_customers",
                      "new_clients_to_brand", "new_clients", "customer_returned", "customer_returned_to_same_brand")
