from pyspark.sql import functions as F

from fraudlane.operators.joins import heavy_keys, join_spreading_heavy
from fraudlane.operators.reconcile import mispredictions
from fraudlane.sources import tables


def skewed(spark, n, name):
    """A third of the rows have key 7, some have none, the others a key of their own."""
    rows = spark.range(n).selectExpr(f"CASE WHEN id % 3 = 0 THEN 7L WHEN id % 50 = 1 THEN NULL ELSE id + 1000 END AS id", f"cast(id % 2 AS int) AS {name}")
    return rows.repartition(5)


def test_heavy_keys_are_found(spark):
    assert heavy_keys(skewed(spark, 30_000, "v"), "id") == [7]
    assert heavy_keys(spark.range(5000), "id") == []
    assert heavy_keys(spark.range(0), "id") == []
    names = spark.createDataFrame([("a",)] * 50 + [(f"k{i}",) for i in range(50)], "k string")
    assert heavy_keys(names, "k", 0.2) == ["a"]


def test_spread_join_equals_the_join(spark):
    left, right = skewed(spark, 900, "prediction"), skewed(spark, 600, "label")
    got, want = join_spreading_heavy(left, right, "id"), left.join(right, "id")
    assert got.columns == want.columns
    assert got.count() == want.count() > 300 * 200 - 1
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_a_heavy_key_goes_to_many_tasks(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "64")
    left, right = skewed(spark, 9000, "prediction"), skewed(spark, 60, "label")
    parts = lambda df: df.where("id = 7").groupBy(F.spark_partition_id().alias("p")).count().collect()
    wide = parts(join_spreading_heavy(left, right, "id"))
    assert len(parts(left.join(right, "id"))) == 1
    assert len(wide) > 20 and max(r["count"] for r in wide) < 0.15 * 3000 * 20


def test_bucketed_tables_with_a_heavy_id(spark, database, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    test = tables.create_table(skewed(spark, 30_000, "prediction").withColumn("pad", F.sha2(F.rand(1).cast("string"), 512)), f"{database}.test", "id", 8)
    valid = tables.create_table(skewed(spark, 300, "label"), f"{database}.valid", "id", 8)
    files = test.where("id = 7").select("_metadata.file_path").distinct().count()
    assert files > 1
    got = mispredictions(test.drop("pad"), valid, spread=True)
    want = mispredictions(test.drop("pad"), valid)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
