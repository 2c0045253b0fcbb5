import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fraudlane.operators.numbering import dense_row_number, sort_for_storage, with_batches
from fraudlane.operators.reshape import arrays_to_rows, rows_to_arrays, rows_to_literals
from fraudlane.scratch import scratch_path


def test_equals_row_number(txn):
    rows = txn.select("amountRange", "id")
    got = dense_row_number(rows, ["amountRange", "id"], "n")
    want = rows.select(
        F.row_number().over(Window.orderBy("amountRange", "id")).cast("bigint").alias("n"), "amountRange", "id"
    )
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_numbers_do_not_depend_on_partitioning(txn):
    rows = txn.select("time", "id")
    one = dense_row_number(rows, ["time", "id"])
    two = dense_row_number(rows.repartition(5), ["time", "id"])
    assert one.columns == ["id", "time", "id"]
    assert one.toDF("n", "time", "key").exceptAll(two.toDF("n", "time", "key")).count() == 0


def test_hot_key_and_copies_are_spread(spark, conf):
    """Three quarters of the rows are copies of one row; they still leave in many files."""
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(0, 40_000, 1, 4).select(F.when(F.col("id") % 4 > 0, -1).otherwise(F.col("id")).alias("k"))
    numbered = dense_row_number(rows, ["k"], "n")
    check = numbered.agg(F.min("n"), F.max("n"), F.count_distinct("n"), F.count("*")).first()
    assert tuple(check) == (1, 40_000, 40_000, 40_000)
    assert numbered.where("k = -1").agg(F.max("n")).first()[0] == 30_000
    path = scratch_path(spark, "hot")
    sort_for_storage(rows, ["k"]).write.parquet(path)
    in_file = spark.read.parquet(path).where("k = -1").groupBy("_metadata.file_name").count()
    assert in_file.count() > 3 and in_file.agg(F.max("count")).first()[0] < 15_000


def test_empty(txn):
    assert dense_row_number(txn.where("id < 0"), ["id"], "n").count() == 0


@pytest.mark.parametrize("rows, sizes", [(30, [10, 10, 10]), (31, [10, 10, 10, 1]), (9, [9]), (0, [])])
def test_batches_are_exact(spark, rows, sizes):
    batched = with_batches(spark.range(rows), ["id"], 10, position="place")
    got = batched.groupBy("batch_no").agg(F.count("*").alias("n"), F.max("place").alias("last")).orderBy("batch_no")
    assert [(r["batch_no"], r["n"], r["last"]) for r in got.collect()] == [
        (i, n, n - 1) for i, n in enumerate(sizes)
    ]


def test_a_hot_key_fills_many_batches(spark):
    rows = spark.range(1000).select(F.lit(5).alias("id"), F.col("id").alias("v"))
    assert with_batches(rows, ["id"], 100).groupBy("batch_no").count().where("count = 100").count() == 10


def test_arrays_and_back(txn):
    rows = txn.select("id", "pca0", "label")
    arrays = rows_to_arrays(rows, "id", 100)
    assert arrays.count() == 10 and arrays.columns == ["block", "id", "pca0", "label"]
    assert arrays_to_rows(arrays, rows.columns).exceptAll(rows).count() == 0


def test_arrays_stay_small_under_one_hot_key(spark):
    rows = spark.range(1000).select(F.lit(5).cast("long").alias("id"), F.col("id").alias("v"))
    arrays = rows_to_arrays(rows, "id", 100)
    assert arrays.agg(F.max(F.size("v"))).first()[0] == 100 and arrays.count() == 10


def test_literals(spark):
    rows = spark.createDataFrame([(2, -0.5, 1.0), (1, 1.25, 1e-7)], "id long, a double, b double")
    got = {r["column_name"]: r["literal"] for r in rows_to_literals(rows, ["a", "b"]).collect()}
    assert got == {"a": "1.250000, -0.500000", "b": "0.000000, 1.000000"}
