"""E-mail campaign performance and contact engagement for two event
vocabularies (a marketing-automation export and a newsletter-tool export)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.columns import as_of_date, col, dim_names
from tillsight.functions.dates import day_diff

# fixed values: event names of the two vocabularies
KLAVIYO = {
    "open": ("Opened Email",),
    "click": ("Clicked Email",),
    "unsubscribe": ("Unsubscribed", "Unsubscribed from List"),
    "spam": ("Marked Email as Spam",),
}
SPLIO = {
    "open": ("open",),
    "click": ("click",),
    "unsubscribe": ("unsub",),
}

# output names per event kind: (total, unique, rate)
_NAMES = {
    "open": ("nb_opening", "nb_unique_opening", "percentage_opening"),
    "click": ("nb_clicks", "nb_clicks_unique", "percentage_of_clicks"),
    "unsubscribe": ("nb_unsubscribe", "nb_unique_unsubscribe", "percentage_unsubscribe"),
    "spam": ("nb_spam", "nb_unique_spam", "percentage_spam"),
}


def _dims(df: DataFrame, dimension_columns: Sequence) -> tuple[list, list[str]]:
    names = dim_names(dimension_columns)
    return [col(d).alias(n) for d, n in zip(dimension_columns or (), names)], names


def _per_contact(df: DataFrame, dims, email, event, vocabulary, extra=()) -> DataFrame:
    """First level: one row per (dimensions, e-mail) with event counts.

    Unique counts become "contacts with at least one event" at the second
    level, so no distinct aggregate (and no row expansion) is needed, and a
    very active contact is pre-aggregated map-side.
    """
    e, ev = col(email), col(event)
    aggs = [F.count(e).alias("_n")]
    for kind, values in vocabulary.items():
        aggs.append(F.count(F.when(ev.isin(*values), e)).alias(f"_n_{kind}"))
    return df.groupBy(*dims, *extra, e.alias("_email")).agg(*aggs)


def campaign_performance(df: DataFrame, *, dimension_columns: Sequence, event, email,
                         vocabulary=KLAVIYO) -> DataFrame:
    """Recipients, opens, clicks, unsubscribes (and spam): total, unique and rate."""
    dims, names = _dims(df, dimension_columns)
    pc = _per_contact(df, dims, email, event, vocabulary)
    aggs = [F.sum("_n").alias("nb_recipients"),
            F.count(F.when(F.col("_n") > 0, F.lit(1))).alias("nbre_unique_recipients")]
    for kind in vocabulary:
        total, unique, _ = _NAMES[kind]
        aggs += [F.sum(f"_n_{kind}").alias(total),
                 F.count(F.when(F.col(f"_n_{kind}") > 0, F.lit(1))).alias(unique)]
    out = pc.groupBy(*names).agg(*aggs)
    cols = [*names, "nb_recipients", "nbre_unique_recipients"]
    for kind in vocabulary:
        total, unique, rate = _NAMES[kind]
        cols += [total, unique, (F.col(total) / F.col("nb_recipients")).alias(rate)]
    return out.select(*cols)


def klaviyo_campaign_performance(df: DataFrame, *, dimension_columns: Sequence, campaign_event_name,
                                 email) -> DataFrame:
    return campaign_performance(df, dimension_columns=dimension_columns, event=campaign_event_name, email=email,
                                vocabulary=KLAVIYO)


def splio_campaign_performance(df: DataFrame, *, dimension_columns: Sequence, campaign_event_type,
                               email) -> DataFrame:
    return campaign_performance(df, dimension_columns=dimension_columns, event=campaign_event_type, email=email,
                                vocabulary=SPLIO)


def klaviyo_campaign_performance_by_customer_type_rfm_segmentation(
        df: DataFrame, *, dimension_columns: Sequence, campaign_event_name, email, first_purchase_date,
        vocabulary=KLAVIYO) -> DataFrame:
    """Campaign performance split into Prospect (never purchased) and Client."""
    dims, names = _dims(df, dimension_columns)
    status = F.when(col(first_purchase_date).isNull(), "Prospect").otherwise("Client").alias("customer_status")
    pc = _per_contact(df, dims, email, campaign_event_name, vocabulary, extra=(status,))
    aggs = [F.sum("_n").alias("nb_recipients")]
    for kind in vocabulary:
        total, unique, _ = _NAMES[kind]
        aggs.append(F.sum(f"_n_{kind}").alias(total))
        if kind in ("unsubscribe", "spam"):
            aggs.append(F.count(F.when(F.col(f"_n_{kind}") > 0, F.lit(1))).alias(unique))
    out = pc.groupBy(*names, "customer_status").agg(*aggs)
    cols = [*names, "customer_status", "nb_recipients"]
    for kind in vocabulary:
        total, unique, rate = _NAMES[kind]
        cols.append(total)
        if kind in ("unsubscribe", "spam"):
            cols.append(unique)
        cols.append((F.col(total) / F.col("nb_recipients")).alias(rate))
    return out.select(*cols)


def contact_segmentation(df: DataFrame, *, dimension_columns: Sequence, email, event, event_date,
                         number_of_days: int, vocabulary=KLAVIYO, as_of=None) -> DataFrame:
    """Open / click rates, inactivity over N days, activity labels, last interaction."""
    dims, names = _dims(df, dimension_columns)
    e, ev, ts = col(email), col(event), col(event_date)
    opened = ev.isin(*vocabulary["open"])
    clicked = ev.isin(*vocabulary["click"])
    g = df.groupBy(*dims).agg(
        F.count(e).alias("_n"), F.count(F.when(clicked, e)).alias("_clicks"),
        F.count(F.when(opened, e)).alias("_opens"), F.max(F.when(opened, ts)).alias("_last_open"),
        F.max(ts).alias("last_interaction_date"))
    click_rate = F.col("_clicks") / F.col("_n")
    open_rate = F.col("_opens") / F.col("_n")
    today = as_of_date(as_of)
    inactive = (F.when(F.col("_last_open").isNull(), "Inactive")
                .when(day_diff(today, F.col("_last_open").cast("date")) > number_of_days, "Inactive")
                .otherwise("Active"))
    active = F.when((open_rate > 0.70) & (click_rate > 0.20), "Active").otherwise("Inactive")
    engagement = (F.when((F.col("_clicks") == 0) & (open_rate > 0), "Opened but never clicked")
                  .when(open_rate == 0, "Never Opened")
                  .otherwise("Opened and Clicked"))
    return g.select(*names, click_rate.alias("percentage_of_clicks"), open_rate.alias("percentage_of_opens"),
                    inactive.alias(f"contact_inactive_over_{number_of_days}_days"),
                    active.alias("is_contact_active"), engagement.alias("opened_but_never_clicked"),
                    "last_interaction_date")


def klaviyo_contact_segmentation(df: DataFrame, *, dimension_columns: Sequence, email, campaign_event_name,
                                 event_date, number_of_days: int, as_of=None) -> DataFrame:
    return contact_segmentation(df, dimension_columns=dimension_columns, email=email, event=campaign_event_name,
                                event_date=event_date, number_of_days=number_of_days, vocabulary=KLAVIYO,
                                as_of=as_of)


def splio_contact_segmentation(df: DataFrame, *, dimension_columns: Sequence, email, campaign_event_type,
                               event_date, number_of_days: int, as_of=None) -> DataFrame:
    return contact_segmentation(df, dimension_columns=dimension_columns, email=email, event=campaign_event_type,
                                event_date=event_date, number_of_days=number_of_days, vocabulary=SPLIO,
                                as_of=as_of)
