import datetime
import json

import pytest
from pyspark.sql import functions as F

from tidecast.functions.rounding import round_half_up
from tidecast.functions.timestamps import iso_format
from tidecast.operators.aggregates import ads_by_type
from tidecast.operators.facts import create_tables, store, viewership_records
from tidecast.operators.latest import latest_ads, latest_viewership
from tidecast.plans import dashboard, history
from tidecast.schemas import VIEWERSHIP_TABLE

ASOF = datetime.datetime(2024, 1, 2, 12)


def hours_ago(h, **more):
    return ASOF - datetime.timedelta(hours=h, **more)


@pytest.fixture
def regional(spark):
    rows = [(hours_ago(h), r, h * 10 + i, 1.5) for h in (0, 1, 2, 30) for i, r in enumerate("BA")]
    return spark.createDataFrame(rows, "event_ts timestamp, region string, viewers int, engagement_rate float")


@pytest.fixture
def windows(spark):
    rows = [(hours_ago(h), 0.1, 0.2, 0.3, float(h)) for h in (0, 1, 5)]
    return spark.createDataFrame(rows, "window_end timestamp, avg_positive double, avg_neutral double, "
                                       "avg_negative double, avg_compound double")


@pytest.fixture
def ads(spark):
    rows = [(hours_ago(0, microseconds=5), "A", 10, 1, 10.0, 2.0, 1, 2.0), (hours_ago(3), "A", 30, 3, 20.0, 4.0, 1, 4.0),
            (hours_ago(2), "B", 5, 0, 0.0, 1.0, 0, 0.0)]
    return spark.createDataFrame(rows, "event_ts timestamp, type string, impressions int, clicks int, ctr float, cost float, "
                                       "conversions int, cost_per_conversion float")


def test_history_is_bounded_and_sorted(regional, windows, ads):
    got = [(r.timestamp, r.region) for r in history.viewership_history(regional, ASOF).collect()]
    assert got == [("2024-01-02T11:00:00", "A"), ("2024-01-02T11:00:00", "B"),
                   ("2024-01-02T12:00:00", "A"), ("2024-01-02T12:00:00", "B")]
    assert history.viewership_history(regional, ASOF, 48).count() == 8
    assert [r.compound for r in history.sentiment_history(windows, ASOF, 2).collect()] == [1.0, 0.0]
    assert [r.timestamp for r in history.ads_history(ads, ASOF, 2).collect()] == [
        "2024-01-02T10:00:00", "2024-01-02T11:59:59.999995"]


def test_history_bound_reaches_the_scan(regional, tmp_path):
    regional.write.parquet(str(tmp_path / "r"))
    stored = regional.sparkSession.read.parquet(str(tmp_path / "r"))
    plan = history.viewership_history(stored, ASOF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_ts" in plan


def test_export(regional, windows, ads):
    tables = {"viewership": regional, "sentiment": windows, "ads": ads}
    assert set(history.export(tables, ASOF)) == {"viewership", "sentiment", "ads"}
    assert set(history.export(tables, ASOF, "ads")) == {"ads"}
    assert history.export(tables, ASOF, "other") == {} and history.export_rows({}) is None
    rows = history.export_rows(history.export(tables, ASOF, "all", 24)).collect()
    assert sorted(r.section for r in rows) == ["ads"] * 3 + ["sentiment"] * 3 + ["viewership"] * 6
    payload = json.loads(next(r.payload_json for r in rows if r.section == "ads"))
    assert list(payload) == ["timestamp", *history.AD_COLUMNS]


def test_recent_posts_drop_the_store_key(spark):
    rows = [(f"k{i}", str(i), hours_ago(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "_id string, id string, created_ts timestamp")
    recent = history.recent_posts(df)
    assert recent.columns == ["id", "created_ts"] and [r.id for r in recent.collect()] == [str(i) for i in range(10)]


def test_totals_and_latest_ads(ads):
    totals = {r.type: r for r in ads_by_type(ads).collect()}
    assert (totals["A"].impressions, totals["A"].ctr, totals["A"].cost) == (40, 15.0, 6.0)
    latest = latest_ads(ads).collect()
    assert {r.timestamp for r in latest} == {"2024-01-02T11:59:59.999995"} and len(latest) == 2


def test_latest_viewership_breaks_ties(spark):
    empty = [], []
    rows = [(ASOF, "t", 5, *empty), (ASOF, "t", 9, *empty), (None, "?", 99, *empty), (hours_ago(1), "s", 50, *empty)]
    df = spark.createDataFrame(rows, "event_ts timestamp, timestamp string, total_viewers int, "
                                     "regional_data array<string>, platform_data array<string>")
    assert [r.total_viewers for r in latest_viewership(df).collect()] == [9]
    assert latest_viewership(df.limit(0)).count() == 0
    assert dashboard.card_total_viewers(df).first().total_viewers == 9


def test_dashboard(regional, ads, windows):
    assert {r.region: r.viewers for r in dashboard.viewers_by_region(regional).collect()} == {"A": 334, "B": 330}
    card = dashboard.card_ctr(ads).first()
    assert card.ctr == 10.0 and card.weighted_ctr == pytest.approx(400 / 45)
    assert {r.type: r.conversions for r in dashboard.ad_performance_by_type(ads).collect()} == {"A": 2, "B": 0}
    assert [r.cost for r in dashboard.ad_cost_over_time(ads).collect()] == [4.0, 1.0, 2.0]
    assert dashboard.card_compound(windows).first().compound == 2.0


def test_iso_format_and_rounding(spark):
    df = spark.createDataFrame([(ASOF, 2.675), (ASOF + datetime.timedelta(microseconds=10), -0.125)], "t timestamp, x double")
    got = [tuple(r) for r in df.select(iso_format(F.col("t")), round_half_up(F.col("x"), 2)).collect()]
    assert got == [("2024-01-02T12:00:00", 2.68), ("2024-01-02T12:00:00.000010", -0.12)]


def test_warehouse_tables(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS tide_test LOCATION '%s'" % (tmp_path / "db"))
    for _ in range(2):
        create_tables(spark, str(tmp_path / "wh"), "tide_test")
    records = spark.createDataFrame([("1", ASOF, 5)], "id string, timestamp timestamp, total_viewers bigint")
    for _ in range(2):
        store(records, str(tmp_path / "wh/viewership"), VIEWERSHIP_TABLE)
    spark.catalog.refreshTable("tide_test.VIEWERSHIP")
    table = spark.table("tide_test.VIEWERSHIP")
    assert table.count() == 2 and table.first().match_id is None
    assert viewership_records(records).schema == VIEWERSHIP_TABLE
    spark.sql("DROP DATABASE tide_test CASCADE")
