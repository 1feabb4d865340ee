"""Joins and sorts that must not put a hot key into one task."""

from pyspark.sql import functions as F

from votestream.operators import attach, joining, materialise, ordered
from votestream.operators.joining import leave_out

from rows import tuples


def hot_rows(spark):
    """Two thirds of the rows have key 1, and some have none."""
    key = F.when(F.col("id") % 3 < 2, 1).when(F.col("id") % 30 == 2, None).otherwise(F.col("id"))
    return spark.range(0, 3000, 1, 12).select(key.alias("key"), (F.col("id") % 5).alias("x"))


def facts(spark):
    return spark.createDataFrame(
        [(1, "one"), (None, "none"), (5, "five"), (-7, "unused")], "key bigint, name string"
    )


def test_attach_either_way(spark):
    few = attach(hot_rows(spark), facts(spark), ["key"])
    many = attach(hot_rows(spark), facts(spark), ["key"], broadcast_rows=0)
    assert few.columns == many.columns == ["key", "x", "name"]
    assert tuples(few, "*") == tuples(many, "*")
    found = {r["name"]: r["count"] for r in few.groupBy("name").count().collect()}
    assert found == {"one": 2000, "none": 100, "five": 1}
    assert "BroadcastHashJoin" in plan(few)


def test_leave_out_either_way(spark):
    few = leave_out(hot_rows(spark), facts(spark), ["key"])
    many = leave_out(hot_rows(spark), facts(spark), ["key"], broadcast_rows=0)
    assert few.columns == many.columns == ["key", "x"]
    assert tuples(few, "*") == tuples(many, "*")
    assert few.count() == 3000 - 2101


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def partitions_with(df, condition):
    return df.where(condition).select(F.spark_partition_id().alias("p")).distinct().count()


def test_a_hot_key_is_joined_in_many_tasks(spark, monkeypatch):
    # As on a cluster, where neither side is small enough to be broadcast.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        usual = attach(hot_rows(spark), facts(spark), ["key"], broadcast_rows=0)
        assert "BroadcastHashJoin" not in plan(usual)
        assert partitions_with(usual, "key = 1") == 1
        joined = attach(hot_rows(spark), facts(spark), ["key"], broadcast_rows=0, hot_rows=50)
        assert partitions_with(joined, "key = 1") > 1
        assert tuples(joined, "*") == tuples(usual, "*")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_equal_rows_are_sorted_in_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        same = ordered(spark.range(0, 8000, 1, 8).select(F.lit(3).alias("x")), "x")
        assert same.columns == ["x"]
        assert partitions_with(same, "x = 3") > 1
        numbers = spark.range(0, 500, 1, 8).select(F.pmod(F.hash("id"), F.lit(40)).alias("x"))
        assert [r.x for r in ordered(numbers, "x").collect()] == sorted(
            r.x for r in numbers.collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_materialised_rows_are_read_from_the_shared_folder(spark):
    kept = materialise(hot_rows(spark).groupBy("key").count())
    assert "Scan ExistingRDD" in plan(kept) and "Aggregate" not in plan(kept)
    assert spark.sparkContext.getCheckpointDir() is not None
    assert kept.count() == hot_rows(spark).select("key").distinct().count()


def test_only_hot_facts_are_copied(spark):
    """Facts of 2,000 cold keys are read once; the hot key's are, once per salt."""
    sized = spark.range(2000).select("id", F.when(F.col("id") == 7, 1000).otherwise(1).alias("n"), F.lit("x").alias("name"))
    rows = spark.range(2999).select(F.when(F.col("id") < 2000, F.col("id")).otherwise(7).alias("id"))
    joined = attach(rows, sized, ["id"], broadcast_rows=0, sizes="n", hot_rows=100)
    assert joined.columns == ["id", "name"] and joined.count() == 2999
    assert joined.where("id = 7").count() == 1000
    hot = joining._hot_keys(rows, sized, ["id"], "n", 100).collect()
    assert [tuple(r) for r in hot] == [(7, 10)]
    assert joining._hot_keys(rows, sized, ["id"], "n", 1000) is None
    counted = joining._hot_keys(rows, sized.drop("n"), ["id"], None, 100).collect()
    assert [tuple(r) for r in counted] == [(7, 10)]


def test_hot_keys_are_bounded(spark, monkeypatch):
    """Where very many keys are large, only the largest are salted."""
    monkeypatch.setattr(joining, "HOT_KEYS", 4)
    sized = spark.range(100).select("id", F.when(F.col("id") < 2, 500).otherwise(20).alias("n"))
    hot = joining._hot_keys(None, sized, ["id"], "n", 10).collect()
    assert len(hot) <= 4
    sized = sized.withColumn("n", F.when(F.col("id") < 2, 5000).otherwise(F.col("n")))
    assert sorted(tuple(r) for r in joining._hot_keys(None, sized, ["id"], "n", 10).collect()) == [(0, 2), (1, 2)]


def test_leave_out_of_hot_keys(spark):
    rows = hot_rows(spark)
    few = leave_out(rows, facts(spark), ["key"])
    assert tuples(few, "*") == tuples(leave_out(rows, facts(spark), ["key"], 0, hot_rows=50), "*")
