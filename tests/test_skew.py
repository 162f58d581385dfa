"""Hot keys: a third of the fact rows on one key (or on null)."""

from pyspark.sql import functions as F

from tabulae.operators.lookups import lookup


def _facts(spark, n=30_000, hot=None):
    # a third of the rows share one key (``hot``; None = missing code)
    ids = spark.range(n)
    key = F.when(F.col("id") % 3 == 0, F.lit(hot).cast("long")).otherwise(F.col("id") % 500)
    return ids.select("id", key.alias("k"), F.repeat(F.lit("x"), 50).alias("pad"))


def test_null_keys_spread_over_reducers(spark):
    facts = _facts(spark, hot=None)
    dim = spark.range(500).select(F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # look at the raw shuffle layout
    try:
        joined = lookup(facts, dim, "k", "left", max_broadcast_rows=0)
        per_part = joined.where(F.col("k").isNull()).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in per_part) == 10_000
    assert len(per_part) > 1                    # not one reducer for all missing codes
    assert max(r["count"] for r in per_part) < 10_000
    assert joined.count() == 30_000


def test_hot_key_is_split_by_aqe(spark):
    facts = _facts(spark, hot=7)
    dim = spark.range(500).select(F.col("id").alias("k"), F.lit("label").alias("name"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joined = lookup(facts, dim, "k", "inner", max_broadcast_rows=0)
        assert len(joined.collect()) == 30_000  # runs this plan: AQE finalises it
        final = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "isFinalPlan=true" in final
    assert "SortMergeJoin(skew=true)" in final  # the hot key's partition was split


def test_partitioned_write_rebalances_a_hot_value(spark, tmp):
    import os

    from tabulae.sinks import write_table

    df = spark.range(300_000).repartition(8).select(
        "id",
        F.when(F.col("id") % 3 == 0, "SP").otherwise(F.concat(F.lit("U"), (F.col("id") % 20).cast("string"))).alias("uf"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),  # incompressible payload
    )
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_table(df, f"{tmp}/p", partition_by=["uf"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot = [f for f in os.listdir(f"{tmp}/p/uf=SP") if f.endswith(".parquet")]
    assert len(hot) > 1                      # the hot value is split over several tasks
    assert spark.read.parquet(f"{tmp}/p").count() == 300_000
