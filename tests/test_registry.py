"""All registered queries against their SQL, and the plans they would run with at scale."""

import duckdb
import pytest

from __spark_entry__ import entry
from checks.compare import TABLES, rows_of
from checks.oracle import ORACLE
from tidecast.plans.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cursor.fetchall())


def test_entry(spark):
    assert entry(spark).columns[:2] == ["window_start", "window_end"]


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


NARROW = ["parse_tweets", "parse_viewership", "parse_ads", "tweets_normalize", "tweets_keyword_filter", "tweets_keyword_tags",
          "regional_viewership", "platform_viewership", "ads_flat", "regional_ads", "ad_metrics", "text_clean",
          "text_tokens_filtered", "lexicon_sentiment"]


@pytest.mark.parametrize("name", NARROW)
def test_narrow_queries_do_not_shuffle(spark, name):
    assert "Exchange hash" not in plan(spark, name) and "Exchange Round" not in plan(spark, name)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_and_no_row_python(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text and "BatchEvalPython" not in text
    assert "Window [" not in text


@pytest.mark.parametrize("name", ["viewership_history", "sentiment_history", "ads_history", "export_viewership", "export_sentiment", "export_ads", "export_all"])
def test_history_is_pruned(spark, name):
    """Every scan of a table is limited to dates, and opens few of its folders."""
    df = QUERIES[name](spark, SF_DIR)
    scans = [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan parquet" in line]
    assert scans and all("PartitionFilters: [isnotnull(event_date" in line for line in scans)
    assert len(df.inputFiles()) <= 12


def test_posts_once(spark):
    assert QUERIES["sink_tweets_once"](spark, SF_DIR).count() == QUERIES["sink_tweets"](spark, SF_DIR).count()
