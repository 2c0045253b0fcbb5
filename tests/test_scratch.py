from pyspark.sql import functions as F

from fraudlane import scratch


def shuffle_files(spark):
    """The shuffle files of a local session; its one process holds them all."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = manager.getAllFiles().mkString("\n").split("\n")
    return {n for n in names if n.rsplit("/", 1)[-1].startswith("shuffle_") and n.endswith(".data")}


def test_stored_rows_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    setting = spark.conf.get(scratch._CLEANUP)
    rows = spark.range(2_000).repartition(3, "id").groupBy((F.col("id") % 50).alias("k")).agg(F.sum("id").alias("s"))
    stored = scratch.materialise(rows, "sums")
    assert not shuffle_files(spark) - before
    assert spark.conf.get(scratch._CLEANUP) == setting
    assert stored.agg(F.sum("s")).first()[0] == sum(range(2_000))
