import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlane import scratch
from fraudlane.functions.features import FEATURES, rename_features
from fraudlane.operators import reconcile
from fraudlane.operators.joins import fits_broadcast, join_measured
from fraudlane.plans import medallion
from fraudlane.plans.transactions import raw_transactions, transactions
from fraudlane.sources import files, tables
from fraudlane.sources.warehouse import Warehouse


def test_second_create_fails(spark, txn, database):
    tables.create_table(txn.select("id"), f"{database}.t")
    with pytest.raises(AnalysisException, match="TABLE_OR_VIEW_ALREADY_EXISTS"):
        tables.create_table(txn.select("id"), f"{database}.t")


def test_overwrite_replaces(spark, txn, database):
    for limit in (100, 50):
        tables.overwrite_table(txn.where(F.col("id") < limit), f"{database}.t")
    assert spark.table(f"{database}.t").count() == 50


def test_drop_of_a_missing_table_is_fine(spark, database):
    tables.drop_table(spark, f"{database}.nothing")


def test_insert_matches_by_position(spark, database):
    tables.create_empty_table(spark, f"{database}.t", "a int, b int")
    tables.insert_by_position(spark.createDataFrame([(1, 2)], "b int, a int"), f"{database}.t")
    tables.insert_by_position(spark.createDataFrame([(3, 4)], "x int, y int"), f"{database}.t", ["b", "a"])
    assert sorted(map(tuple, spark.table(f"{database}.t").collect())) == [(1, 2), (4, 3)]


def test_database_lies_in_the_shared_folder(spark, database):
    described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE DATABASE {database}").collect()}
    assert scratch.scratch_root(spark) in described["Location"]


class _Session:
    """What the scratch module asks of a session."""

    def __init__(self, setting, master):
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}
        self.sparkContext = self
        self.master = master

    def getCheckpointDir(self):
        return None


def test_scratch_follows_the_session_setting():
    path = scratch.scratch_path(_Session("hdfs://shared/work/", "yarn"), "x")
    assert path.startswith("hdfs://shared/work/x_")


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_path(_Session(None, "yarn"), "x")


def test_medallion(spark, sf_dir, database):
    medallion.build_bronze(raw_transactions(spark, sf_dir), database)
    silver = medallion.build_silver(spark, database)
    gold = medallion.build_gold(silver, database)
    n = transactions(spark, sf_dir).count()
    assert silver.columns == ["id", "time", "amountRange", "label", *FEATURES]
    assert tuple(silver.agg(F.min("id"), F.max("id"), F.count_distinct("id")).first()) == (1, n, n)
    times = [r["time"] for r in silver.orderBy("id").select("time").collect()]
    assert times == sorted(times)
    assert gold.columns == ["id", "time", "amountRange", "prediction"] and gold.count() == n
    before = sorted(map(tuple, silver.collect()))
    assert sorted(map(tuple, medallion.build_silver(spark, database).collect())) == before


def test_bucketed_tables_join_without_shuffle(spark, txn, database, conf, plan_of):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    test, valid = medallion.build_test_and_valid(txn, database, buckets=4)
    scored = medallion.gold_rows(rename_features(test, "silver"))
    wrong = reconcile.mispredictions(scored, valid)
    plan = plan_of(wrong, "simple")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert wrong.count() == 21
    assert test.columns == valid.columns[:-1] and valid.columns[-1] == "label"


def test_external_table_copies_nothing(spark, sf_dir, database):
    table = f"{database}.events"
    tables.external_table(spark, table, f"{sf_dir}/events.parquet")
    detail = tables.table_detail(spark, table).first()
    assert detail["format"] == "parquet" and detail["n_files"] == 1 and detail["size_bytes"] > 0
    assert detail["location"].endswith("events.parquet")
    tables.drop_table(spark, table)
    assert files.read_table(spark, sf_dir, "events").count() == 1000


def test_warehouse_filter_and_columns_reach_the_scan(spark, txn, plan_of):
    warehouse = Warehouse(root=scratch.scratch_path(spark, "warehouse"))
    view = scratch.unique_name("warehouse")
    stored = warehouse.round_trip(rename_features(txn, "warehouse"), "t", view)
    plan = plan_of(stored.where("id <= 5").select("id", "pca_0_"))
    assert "LessThanOrEqual(id,5)" in plan
    assert "ReadSchema: struct<id:bigint,pca_0_:double>" in plan
    assert spark.table(view).where("id <= 5").count() == 6


def test_warehouse_with_a_table_option(spark, database, txn):
    class Recorder:
        def __init__(self):
            self.calls = []

        def __getattr__(self, name):
            def call(*args, **kwargs):
                self.calls.append((name, args, kwargs))
                return self

            return call

    recorder = Recorder()
    handle, path = Warehouse("some_connector", options={"bucket": "b"})._address(recorder, "p.d.t")
    assert path is None and recorder.calls == [
        ("format", ("some_connector",), {}),
        ("options", (), {"bucket": "b"}),
        ("option", ("table", "p.d.t"), {}),
    ]


def test_scan_prunes_and_names_missing_columns(spark, sf_dir, plan_of):
    lines = files.read_table(spark, sf_dir, "lineitem", ["l_quantity"])
    assert "ReadSchema: struct<l_quantity:double>" in plan_of(lines)
    with pytest.raises(ValueError, match="nothing"):
        files.read_table(spark, sf_dir, "lineitem", ["nothing"])


def test_csv_keeps_nulls_and_doubles(spark):
    df = spark.createDataFrame([(1, 0.1 + 0.2, "a,b"), (None, None, None)], "i int, d double, s string")
    path = scratch.scratch_path(spark, "csv")
    files.write_csv(df, path)
    assert files.scan_csv(spark, path, "i int, d double, s string").exceptAll(df).count() == 0


def test_rows_with_explicit_schema(spark):
    schema = T.StructType(
        [T.StructField("number", T.IntegerType(), False), T.StructField("name", T.StringType(), False)]
    )
    df = spark.createDataFrame([[1, "a"], [2, "b"]], schema)
    assert df.schema == schema and df.count() == 2
    conformed = files.conform(df.selectExpr("name", "CAST(number AS bigint) AS number"), schema)
    assert conformed.schema == schema
    with pytest.raises(Exception, match="name must not be NULL"):
        files.conform(spark.createDataFrame([(1, None)], "number int, name string"), schema).collect()


def test_small_side_is_broadcast_only_when_it_fits(spark, conf, plan_of):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    big = spark.range(1000).selectExpr("id % 50 AS k", "id AS v")
    small = spark.range(50).selectExpr("id AS k", "id * 2 AS w")
    assert fits_broadcast(small, 50 * 24) and not fits_broadcast(small, 49 * 24)
    by_broadcast = join_measured(big, small, "k", max_bytes=50 * 24)
    by_sort = join_measured(big, small, "k", max_bytes=49 * 24)
    assert "BroadcastHashJoin" in plan_of(by_broadcast, "simple")
    assert "BroadcastHashJoin" not in plan_of(by_sort, "simple")
    assert by_broadcast.exceptAll(by_sort).count() == 0 and by_sort.count() == 1000


def test_transactions_read_only_what_they_need(txn, plan_of):
    plan = plan_of(txn.select("id", "amountRange"))
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan
    assert "Subquery" not in plan


def test_time_does_not_depend_on_the_session_zone(spark, sf_dir, conf):
    expected = transactions(spark, sf_dir).agg(F.sum("time")).first()[0]
    conf("spark.sql.session.timeZone", "America/New_York")
    assert transactions(spark, sf_dir).agg(F.sum("time")).first()[0] == expected


def test_sql_over_named_parameters_and_session_variables(spark, txn, database, conf):
    tables.overwrite_table(medallion.gold_rows(txn), f"{database}.gold")
    conf("var.db_name", database)
    by_variable = spark.sql("SELECT id FROM ${var.db_name}.gold WHERE prediction = 1")
    by_parameter = spark.sql(
        "SELECT id FROM IDENTIFIER(:name) WHERE prediction = :wanted",
        {"name": f"{database}.gold", "wanted": 1},
    )
    assert by_variable.count() == 44 and by_variable.exceptAll(by_parameter).count() == 0
