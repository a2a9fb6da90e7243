"""Campaign, cohort, JSON projection and job-cost operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillsight.operators import campaigns as K
from tillsight.operators import cohorts, job_costs, raw_json

D = dt.date
TS = dt.datetime


def _events(spark):
    rows = [("c1", "a@x", "Opened Email", TS(2024, 1, 2)), ("c1", "a@x", "Opened Email", TS(2024, 1, 3)),
            ("c1", "a@x", "Clicked Email", TS(2024, 1, 3)), ("c1", "b@x", "Unsubscribed from List", TS(2024, 1, 4)),
            ("c1", None, "Opened Email", TS(2024, 1, 4)), ("c2", "b@x", "Clicked Email", TS(2024, 1, 30))]
    return spark.createDataFrame(rows, "campaign string, email string, ev string, ts timestamp")


def test_campaign_performance_counts(spark):
    r = {x.campaign: x for x in K.klaviyo_campaign_performance(
        _events(spark), dimension_columns=["campaign"], campaign_event_name="ev", email="email").collect()}["c1"]
    assert (r.nb_recipients, r.nbre_unique_recipients, r.nb_opening, r.nb_unique_opening) == (4, 2, 2, 1)
    assert r.nb_unsubscribe == 1 and r.percentage_opening == 0.5 and r.nb_spam == 0


def test_contact_segmentation_null_email_group_divides_by_zero(spark):
    # as in the source: count(email) is 0 for the null-email group
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        K.klaviyo_contact_segmentation(_events(spark), dimension_columns=["email"], email="email",
                                       campaign_event_name="ev", event_date="ts", number_of_days=10,
                                       as_of=D(2024, 1, 31)).collect()


def test_contact_segmentation_labels(spark):
    out = {x.email: x for x in K.klaviyo_contact_segmentation(
        _events(spark).where("email is not null"), dimension_columns=["email"], email="email", campaign_event_name="ev", event_date="ts",
        number_of_days=10, as_of=D(2024, 1, 31)).collect()}
    assert out["a@x"].contact_inactive_over_10_days == "Inactive"  # last open 28 days ago
    assert out["a@x"].opened_but_never_clicked == "Opened and Clicked"
    assert out["b@x"].opened_but_never_clicked == "Never Opened"  # a click without an open
    assert out["a@x"].is_contact_active == "Inactive"  # open rate 2/3 is not above 0.70


def test_customer_type_split(spark):
    df = _events(spark).withColumn("fp", F.when(F.col("email") == "a@x", F.lit(D(2024, 1, 1))))
    rows = {(r.campaign, r.customer_status) for r in K.klaviyo_campaign_performance_by_customer_type_rfm_segmentation(
        df, dimension_columns=["campaign"], campaign_event_name="ev", email="email",
        first_purchase_date="fp").collect()}
    assert ("c1", "Client") in rows and ("c1", "Prospect") in rows


def test_cohort_matrix_periods_and_first_retention(spark):
    rows = [(1, 10, TS(2023, 12, 31)), (2, 10, TS(2024, 1, 1)), (3, 11, TS(2024, 1, 5)), (4, 11, TS(2024, 3, 1))]
    out = cohorts.get_cohort_matrix(spark.createDataFrame(rows, "o long, c long, ts timestamp"),
                                    order_id="o", customer_id="c", order_created_at="ts").collect()
    cells = {(r.acquisition_cohort, r.order_cohort): r for r in out}
    assert cells[("2023-12", "2024-01")].periods == 1  # boundaries, not whole months
    assert all(r.retention_percentage == 1.0 for r in out if r.periods == 0)
    assert cells[("2024-01", "2024-03")].periods == 2


@pytest.mark.parametrize("text,expected", [
    ('{"a": "x", "n": 1.5}', ("x", 1.5)), ('{"a": {"b": 1}, "n": [1]}', (None, None)),
    ('{"a": null}', (None, None)), ('{}', (None, None)), ('not json', (None, None)),
    ('{"a": "{curly"}', ("{curly", None))])
def test_json_scalar_only(spark, text, expected):
    df = spark.createDataFrame([(text,)], "j string")
    r = raw_json.create_source_model_from_raw_table_airbyte(df, json_data="j", string_columns=["a"],
                                                             numeric_columns=["n"]).collect()[0]
    assert (r.a, None if r.n is None else float(r.n)) == expected


def test_json_second_level(spark):
    df = spark.createDataFrame([('{"t": "2024-01-05 10:00:00", "in": {"k": 3, "s": "v"}}',)], "j string")
    r = raw_json.create_source_model_stg_klaviyo_data(df, json_data="j", json_data_1="in", date_columns=["t"],
                                                      second_level_numeric_columns=["k"],
                                                      second_level_string_columns=["s"]).collect()[0]
    assert r.t == TS(2024, 1, 5, 10) and float(r.k) == 3 and r.s == "v"


def test_job_cost_labels(spark):
    lab = "array<struct<key:string,value:string>>"
    rows = [(TS(2024, 1, 30, 23, 30), "u1", None, 1024 ** 4),
            (TS(2024, 1, 30), "u1", [("dbt_x", "1"), ("k", "looker_studio")], 2 * 1024 ** 4),
            (TS(2024, 1, 20), "u1", [("k", "scheduled_query")], 1024 ** 4)]
    df = spark.createDataFrame(rows, f"creation_time timestamp, user_email string, labels {lab}, "
                                     f"total_bytes_billed long")
    out = {(r.label_group, r.label_key): r.cost_usd for r in job_costs.create_model_bigquery_cost(
        df, as_of=D(2024, 1, 31)).collect()}
    assert out == {("OTHERS", None): 5.0, ("DBT", "dbt_x"): 10.0, ("LOOKER STUDIO", "k"): 10.0}


def test_cohort_matrix_with_dimension(spark):
    rows = [(1, 10, TS(2024, 1, 1), "web"), (2, 10, TS(2024, 2, 1), "web"), (3, 11, TS(2024, 1, 9), "app")]
    out = cohorts.get_cohort_matrix(spark.createDataFrame(rows, "o long, c long, ts timestamp, ch string"),
                                    order_id="o", customer_id="c", order_created_at="ts", dims=["ch"]).collect()
    assert {(r.ch, r.acquisition_cohort, r.order_cohort, r.customers) for r in out} == {
        ("web", "2024-01", "2024-01", 1), ("web", "2024-01", "2024-02", 1), ("app", "2024-01", "2024-01", 1)}


def test_job_cost_default_date_is_today(spark):
    now = dt.datetime.now()
    df = spark.createDataFrame([(now, "u", None, 1024 ** 4)],
                               "creation_time timestamp, user_email string, "
                               "labels array<struct<key:string,value:string>>, total_bytes_billed long")
    assert [r.cost_usd for r in job_costs.create_model_bigquery_cost(df).collect()] == [5.0]
