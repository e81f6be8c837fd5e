import pytest
from pyspark.sql import functions as F

from tidecast.operators.skew import lookup_join


@pytest.fixture
def shuffled_joins(spark):
    """Keep Spark from broadcasting the small tables of a test."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, value in before.items():
        spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def test_lookup_join_keeps_every_row(spark, shuffled_joins):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"),
        F.create_map(F.lit("a"), F.col("id")).alias("m"))
    lookup = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    out = lookup_join(rows, lookup, "k")
    assert out.columns == ["k", "v", "m", "w"]
    plain = rows.join(lookup, "k", "left")
    sums = [F.count("*"), F.sum("v"), F.sum("w"), F.count("w"), F.count_distinct("v")]
    assert out.agg(*sums).first() == plain.agg(*sums).first()


def test_hot_key_is_spread_over_tasks(spark, shuffled_joins):
    rows = spark.range(40_000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    lookup = spark.createDataFrame([("hot", 1)], "k string, w int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = lookup_join(rows, lookup, "k", salts=8, spread_by="v").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1 and sum(r["count"] for r in sizes) == 40_000


def test_null_keys_find_nothing(spark, shuffled_joins):
    rows = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    lookup = spark.createDataFrame([(None, 9), ("a", 8)], "k string, w int")
    assert sorted((r.v, r.w) for r in lookup_join(rows, lookup, "k").collect()) == [(1, None), (2, 8)]
