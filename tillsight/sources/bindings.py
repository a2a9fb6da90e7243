"""Bindings from the TPC-H-like test tables to the operators' column
contracts (FIXTURES.md section 2).  Every view is a lazy DataFrame over the
parquet scans, so filters and column pruning reach the files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.plans.ordered import checkpointed, dealt

# fixed reference dates of the fixtures
ORDERS_AS_OF = dt.date(2001, 8, 2)
EVENTS_AS_OF = dt.date(2024, 1, 31)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sales_lines(spark: SparkSession, sf_dir: str, with_part: bool = True) -> DataFrame:
    """``lineitem`` joined to ``orders`` (and ``part``): one row per order line.

    ``with_part=False`` is the same view without ``brand`` and ``unit_price``
    for operators that need neither: at scale the part join is a second full
    shuffle of the lines (every line has its part, so no row changes).
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice",
                                                 "l_returnflag", "l_linestatus")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if with_part:
        p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
        li = li.join(p, li["l_partkey"] == p["p_partkey"])
    # grouping by order and more needs no further shuffle
    li, o = dealt(li, "l_orderkey"), dealt(o, "o_orderkey")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    money = "decimal(18,2)"
    part_cols = [F.col("p_brand").alias("brand"), F.col("p_retailprice").cast(money).alias("unit_price")] \
        if with_part else []
    return j.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        *part_cols,
        F.col("l_extendedprice").cast(money).alias("revenue"),
        F.col("l_quantity").cast(money).alias("quantity"),
        F.when(F.col("l_returnflag") != "R", "VENTE").otherwise("RETOUR").alias("transaction_type"),
        F.when(F.col("l_linestatus") == "O", 0).otherwise(1).alias("replacement"))


def campaign_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` read as an e-mail campaign log in both vocabularies."""
    e = table(spark, sf_dir, "events")
    t = F.col("event_type")
    event_a = (F.when(t == "view", "Opened Email").when(t == "click", "Clicked Email")
               .when(t == "error", "Unsubscribed").when(t == "signup", "Marked Email as Spam")
               .when(t == "purchase", "Received Email"))
    event_b = (F.when(t == "view", "open").when(t == "click", "click").when(t == "error", "unsub")
               .otherwise("sent"))
    return e.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("email"),
        event_a.alias("event_a"), event_b.alias("event_b"),
        F.col("ts").alias("event_date"),
        F.get_json_object("props", "$.k").alias("campaign"),
        F.when(F.col("user_id") % 3 == 0, F.lit(dt.date(2024, 1, 1))).alias("first_purchase_date"))


def raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` serialised as a loader's raw JSON column."""
    e = table(spark, sf_dir, "events")
    text = F.concat(F.lit('{"id":"'), F.col("event_id").cast("string"),
                    F.lit('","day":"'), F.to_date("ts").cast("string"),
                    F.lit('","amount":'), F.col("value").cast("decimal(18,2)").cast("string"),
                    F.lit(',"attributes":'), F.col("props"), F.lit("}"))
    return e.select(text.alias("json_data"))


def job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` read as a warehouse job log with labels."""
    e = table(spark, sf_dir, "events")
    t = F.col("event_type")

    def lab(k, v):
        return F.struct(F.lit(k).alias("key"), v.alias("value"))

    labels = (F.when(t == "view", F.array().cast("array<struct<key:string,value:string>>"))
              .when(t == "click", F.array(lab("dbt_model", F.concat(F.lit("m"), (F.col("user_id") % 5).cast("string")))))
              .when(t == "purchase", F.array(lab("source", F.lit("looker_studio"))))
              .when(t == "signup", F.array(lab("source", F.lit("scheduled_query")), lab("team", F.lit("crm")))))
    return e.select(
        F.col("ts").alias("creation_time"),
        t.alias("query"),
        F.concat(F.lit("user"), (F.col("user_id") % 10).cast("string")).alias("user_email"),
        F.struct(t.alias("dataset_id"), F.concat(F.lit("t"), F.col("user_id").cast("string")).alias("table_id"))
        .alias("destination_table"),
        labels.alias("labels"),
        (F.round(F.col("value") * 100).cast("long") * 10_000_000).alias("total_bytes_billed"))


# --- landed-export views for the ingest operators ---------------------------

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def traffic_series(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Daily event counts per event type, read as one visits series per domain."""
    daily = checkpointed(table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("date"), "event_type")
                         .agg(F.count(F.lit(1)).cast("double").alias("visits")))
    return {f"{t}.fr": daily.where(F.col("event_type") == t).select("date", "visits") for t in EVENT_TYPES}


def legal_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` read as a company-register extract (plus one surplus column)."""
    o = table(spark, sf_dir, "orders")
    n = F.col("o_custkey")
    return o.select(
        F.col("o_orderkey").cast("string").alias("siren"),
        F.col("o_orderstatus").alias("statutDiffusionUniteLegale"),
        F.to_date("o_orderdate").cast("string").alias("dateCreationUniteLegale"),
        F.col("o_orderpriority").alias("categorieEntreprise"),
        F.when(n % 11 == 0, F.lit("x")).otherwise((n % 7).cast("string")).alias("nombrePeriodesUniteLegale"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("dateDernierTraitementUniteLegale"),
        F.array(F.struct(F.to_date("o_orderdate").cast("string").alias("dateDebut"),
                         F.col("o_orderstatus").alias("etatAdministratifUniteLegale"))).alias("periodesUniteLegale"),
        F.col("o_totalprice").alias("surplus"))


def post_rows(spark: SparkSession, sf_dir: str, as_of=EVENTS_AS_OF, refetch: bool = False) -> DataFrame:
    """``events`` read as exported posts keyed by ``instagram_profileId``.
    ``refetch`` gives the re-read of the last 14 days, which returns only the
    view / click / purchase posts (so other posts in the window are dropped)."""
    e = table(spark, sf_dir, "events")
    if refetch:
        e = e.where((F.to_date("ts") >= F.date_sub(F.lit(as_of), 14))
                    & F.col("event_type").isin("view", "click", "purchase"))
    return e.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("instagram_profileId"),
        F.col("ts").alias("created_time"),
        F.col("event_type").alias("content_type"),
        F.col("event_id").alias("instagram_id"),
        (F.col("value") * (2 if refetch else 1)).alias("instagram_insights_reach"))


def profile_metrics(spark: SparkSession, sf_dir: str, since=None) -> list[DataFrame]:
    """Per network daily metrics per user (different metric sets per network)."""
    e = table(spark, sf_dir, "events")
    if since is not None:
        e = e.where(F.to_date("ts") >= F.lit(since))
    day = F.to_date("ts").cast("string").alias("date")
    who = F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("profile_id")
    t = F.col("event_type")
    fb_types = t.isin("purchase", "signup")
    ig = (e.where(~F.coalesce(fb_types, F.lit(False))).groupBy(day, who)
          .agg(F.count(F.when(t == "view", 1)).alias("instagram_views"),
               F.count(F.when(t == "click", 1)).alias("instagram_clicks"),
               F.count(F.when(t == "error", 1)).alias("instagram_errors"))
          .withColumn("network", F.lit("instagram")))
    fb = (e.where(fb_types).groupBy(day, who)
          .agg(F.count(F.when(t == "purchase", 1)).alias("facebook_purchases"),
               F.count(F.when(t == "signup", 1)).alias("facebook_signups"),
               F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("facebook_revenue"))
          .withColumn("network", F.lit("facebook")))
    return [ig, fb]


def social_profiles(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """``customer`` read as profile lists of four networks (one of them empty); every customer is in one."""
    c = table(spark, sf_dir, "customer")
    bal = F.col("c_acctbal")
    base = c.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.array(F.col("c_mktsegment"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))).alias("profile_labels"),
        F.when(bal < 0, F.lit(None).cast("boolean")).otherwise(bal > 5000).alias("community_enabled"),
        F.col("c_mktsegment").alias("_segment"), F.col("c_nationkey").alias("_nation"))
    facebook = F.col("_segment").isin("BUILDING", "AUTOMOBILE")
    instagram = F.col("_segment").isin("MACHINERY", "HOUSEHOLD")
    return {
        "facebook": base.where(facebook).drop("_segment", "_nation"),
        "instagram": base.where(instagram).withColumnRenamed("_nation", "nation").drop("_segment"),
        "tiktok": base.where(~F.coalesce(facebook | instagram, F.lit(False))).drop("_segment", "_nation"),
        "youtube": base.where(F.lit(False)).drop("_segment", "_nation"),
    }


def metric_cubes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` read as dense metric cubes: one payload per day and block of 100 users."""
    e = table(spark, sf_dir, "events")
    t = F.col("event_type")
    cells = e.groupBy(F.to_date("ts").cast("string").alias("_day"), "user_id").agg(
        F.count(F.when(t == "view", 1)).cast("double").alias("views"),
        F.count(F.when(t == "click", 1)).cast("double").alias("clicks"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("revenue"))
    cell = F.struct("user_id", F.array("views", "clicks", "revenue").alias("v"))
    block = cells.groupBy("_day", F.floor(F.col("user_id") / 100).alias("_block")).agg(
        F.array_sort(F.collect_list(cell)).alias("_c"))
    users = F.transform("_c", lambda c: F.concat(F.lit("u"), c["user_id"].cast("string")))
    rows = lambda a: F.struct(a.alias("rows"))
    return block.select(
        F.array(rows(F.array("_day")), rows(users), rows(F.array(*map(F.lit, ("views", "clicks", "revenue")))))
        .alias("header"),
        F.array(F.transform("_c", lambda c: c["v"])).alias("data"))


def post_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` read as API pages of at most 100 posts (``data.posts``)."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    post = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("authorId"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("created_time"),
        F.col("event_type").alias("content_type"),
        F.concat(F.lit("post "), F.col("event_id").cast("string")).alias("content"),
        F.array(F.struct(F.lit("k").alias("id"), F.concat(F.lit("k"), k).alias("name")),
                F.struct(F.lit("x").alias("id"), F.lit("").alias("name"))).alias("post_labels"),
        F.col("value").cast("string").alias("insights_reach"),
        F.when(F.col("event_type") == "error", F.lit("n/a"))
        .otherwise(F.floor(F.col("value") * 10).cast("long").cast("string")).alias("insights_impressions"),
        F.create_map(F.lit("like"), F.col("user_id") % 7, F.lit("love"), F.col("event_id") % 3)
        .alias("reactions_by_type"),
        F.struct(F.col("event_type").alias("type"),
                 F.concat(F.lit("https://example.org/p/"), F.col("event_id").cast("string")).alias("url"))
        .alias("attachments"))
    page = F.floor(F.col("event_id") / 100)
    return (e.groupBy("user_id", page.alias("_page"))
            .agg(F.collect_list(post).alias("posts"))
            .select(F.struct("posts", F.lit(0).alias("remaining"), F.lit(None).cast("string").alias("next"))
                    .alias("data")))
