import datetime
import json

import pytest

from tidecast.operators import flatten
from tidecast.schemas import ADS, POST, VIEWERSHIP
from tidecast.sources.campaigns import read_campaigns
from tidecast.sources.messages import (
    decode, decode_once, kafka_options, message_batch, parse_ads, parse_posts, parse_rejects, parse_viewership, parsed_rows, payload, rejected_rows,
)
from tidecast.sources.warehouse import warehouse_sql
from tidecast.operators.ad_metrics import ad_metrics, regional_ad_metrics

VIEW = {"timestamp": "2025-05-01T12:00:00Z", "total_viewers": 30,
        "regional_data": [{"region": "north", "viewers": 10, "engagement_rate": 5.25},
                          {"region": "south", "viewers": 20, "engagement_rate": 7.5}],
        "platform_data": [{"platform": "web", "viewers": 30, "buffer_rate": 0.5, "avg_resolution": "4K"}]}

# One ad in two regions; a banner that nobody saw in a third.
AD = {"timestamp": "2023-11-20T06:30:00Z", "ads": [
    {"type": "corner-banner", "impressions": 733, "clicks": 41, "ctr": 5.59, "cost": 88.2, "conversions": 7,
     "cost_per_conversion": 12.6, "regions": [
         {"region": "coast", "impressions": 612, "clicks": 40, "ctr": 6.54},
         {"region": "hills", "impressions": 121, "clicks": 1, "ctr": 0.83},
         {"region": "isles", "impressions": 0, "clicks": 0, "ctr": 0.0}]}]}


def test_bad_payloads_are_rejected_and_bad_fields_are_null(messages):
    good = json.dumps(VIEW)
    overflow = json.dumps({**VIEW, "total_viewers": 3_000_000_000})
    text_number = json.dumps({**VIEW, "total_viewers": "7"})
    extra = json.dumps({**VIEW, "more": 1})
    other = '{"k": 1}'
    no_time = json.dumps({**VIEW, "timestamp": "yesterday"})
    df = messages(good, overflow, text_number, extra, "not json", None, other, no_time)
    parsed = parse_viewership(df).collect()
    assert [r.total_viewers for r in parsed] == [30, None, None, 30, 30]
    assert [r.event_ts is None for r in parsed] == [False, False, False, False, True]
    assert {r.value for r in parse_rejects(df, VIEWERSHIP).collect()} == {"not json", None, other}
    assert {r.value for r in parse_rejects(df, VIEWERSHIP, "timestamp").collect()} == {"not json", None, other, no_time}


def test_times_with_and_without_zone(messages):
    df = messages(*[json.dumps({"id": str(i), "created_at": t}) for i, t in enumerate(
        ["2024-01-01T00:00:07Z", "2024-01-01T00:00:07.179575", "2024-01-01T02:00:07+02:00", "soon"])])
    got = [r.created_ts for r in parse_posts(df).orderBy("id").collect()]
    assert got[0] == got[2] and got[1] - got[0] == datetime.timedelta(microseconds=179575) and got[3] is None


def test_number_for_a_text_field_is_kept_as_text(messages):
    assert parse_posts(messages('{"id": 12, "text": 3.5}')).select("id", "text").first() == ("12", "3.5")


def test_flatten_viewership(messages):
    empty = json.dumps({**VIEW, "regional_data": [], "platform_data": None})
    parsed = parse_viewership(messages(json.dumps(VIEW), empty))
    regional = flatten.regional_viewership(parsed).drop("event_ts").collect()
    assert [tuple(r) for r in regional] == [(VIEW["timestamp"], "north", 10, 5.25), (VIEW["timestamp"], "south", 20, 7.5)]
    platform = flatten.platform_viewership(parsed).drop("event_ts").collect()
    assert [tuple(r) for r in platform] == [(VIEW["timestamp"], "web", 30, 0.5, "4K")]


def test_flatten_golden_ad(messages):
    parsed = parse_ads(messages(json.dumps(AD), json.dumps({"timestamp": AD["timestamp"], "ads": [{"type": "x", "regions": []}]})))
    ads = flatten.ads_flat(parsed).where("type = 'corner-banner'").drop("event_ts").collect()
    assert [tuple(a)[:2] for a in ads] == [(AD["timestamp"], "corner-banner")]
    assert list(ads[0])[2:] == pytest.approx([733, 41, 5.59, 88.2, 7, 12.6], rel=1e-6)  # 32-bit floats
    regions = flatten.regional_ads(parsed).collect()
    assert len(regions) == 3 and sum(r.impressions for r in regions) == 733 and sum(r.clicks for r in regions) == 41
    again = ad_metrics(flatten.ads_flat(parsed).where("type = 'corner-banner'")).first()
    assert (again.ctr, again.cost_per_conversion) == (5.59, 12.6)
    assert {r.ctr for r in regional_ad_metrics(flatten.regional_ads(parsed)).collect()} == {6.54, 0.83, None}


def test_ad_ratios_with_nothing_to_divide_by(spark):
    rows = [(0, 0, 9.0, 0), (100, 3, 9.0, 4), (8, 1, 1.005, 1)]
    df = spark.createDataFrame(rows, "impressions int, clicks int, cost double, conversions int")
    got = [(r.ctr, r.cost_per_conversion) for r in ad_metrics(df).collect()]
    assert got == [(None, 0.0), (3.0, 2.25), (12.5, 1.0)]


# Three campaigns in one array over several lines; the last one was never shown.
CAMPAIGNS = """[
  {"campaign": "kites", "impressions": 907, "clicks": 13, "cost": 71.9, "conversions": 3, "date": "2022-02-09"},
  {"campaign": "lamps", "impressions": 48, "clicks": 6, "cost": 5.0, "conversions": 0, "date": "2022-02-11"},
  {"campaign": "maps", "impressions": 0, "clicks": 0, "cost": 0.75, "conversions": 0, "date": "2022-03-30"}
]"""


def test_campaign_files(spark, tmp_path):
    (tmp_path / "one.json").write_text(CAMPAIGNS)
    rows = ad_metrics(read_campaigns(spark, str(tmp_path), one_array_per_file=True)).orderBy("campaign").collect()
    assert [(r.ctr, r.cost_per_conversion) for r in rows] == [(1.43, 23.97), (12.5, 0.0), (None, 0.0)]
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "a.json").write_text(" ".join(CAMPAIGNS.split()) + "\n" + " ".join(CAMPAIGNS.split()) + "\n")
    assert read_campaigns(spark, str(lines), one_array_per_file=False).count() == 6
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        read_campaigns(spark, str(tmp_path / "one.json"), one_array_per_file=False).collect()


def test_payload_is_decoded_from_bytes(spark):
    raw = spark.createDataFrame([(bytearray("é".encode()),)], "value binary")
    assert payload(raw).first().value == "é"


def test_text_and_parquet_replays_hold_the_same_messages(spark, messages, tmp_path):
    df = messages(json.dumps(VIEW), json.dumps(AD))
    df.write.parquet(str(tmp_path / "p"))
    df.write.text(str(tmp_path / "t"))
    both = [message_batch(spark, str(tmp_path / "p")), message_batch(spark, str(tmp_path / "t"), "text")]
    assert sorted(both[0].collect()) == sorted(both[1].collect()) == sorted(df.collect())


def test_kafka_options():
    options = kafka_options("broker:9092", "ad-data", max_offsets_per_trigger=10_000, min_partitions=64,
                            **{"kafka.security.protocol": "SASL_SSL"})
    assert options == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "ad-data", "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "10000", "minPartitions": "64", "kafka.security.protocol": "SASL_SSL"}


def test_warehouse_sql_binds_values(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    out = warehouse_sql(spark, "SELECT k FROM {t} WHERE k = :k", {"t": df}, {"k": "b' OR '1'='1"})
    assert out.count() == 0
    assert warehouse_sql(spark, "SELECT k FROM {t} WHERE v > :v", {"t": df}, {"v": 1}).first().k == "b"


def test_schemas_name_every_field():
    assert [len(s.fields) for s in (POST, VIEWERSHIP, ADS)] == [9, 4, 2]


def test_a_kept_batch_holds_payloads_of_rejects_only(messages):
    good, timeless = json.dumps(VIEW), json.dumps({**VIEW, "timestamp": "soon"})
    texts = [good, timeless, "broken", "{}", "", None]
    kept = decode_once(messages(*texts), VIEWERSHIP, "timestamp")
    whole = decode(messages(*texts), VIEWERSHIP)
    assert kept.where("value is not null").count() == 4
    assert good not in {r.value for r in kept.collect()}

    def rows(found):
        return sorted(map(repr, found.collect()))
    assert rows(rejected_rows(kept, VIEWERSHIP, "timestamp")) == rows(rejected_rows(whole, VIEWERSHIP, "timestamp"))
    assert rows(parsed_rows(kept, VIEWERSHIP, "timestamp", "event_ts")) == rows(parsed_rows(whole, VIEWERSHIP, "timestamp", "event_ts"))
