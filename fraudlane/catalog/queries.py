"""Every registered query as a function of a session and a data directory.

Each one starts from the given tables and runs over all of their rows. Queries that write use
names and paths of their own, so they can share a session.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import features as feat
from ..functions import names, scoring
from ..operators import evaluate, explore, numbering, reconcile, reshape, sampling
from ..plans import medallion, runs, training
from ..plans.transactions import feature_vectors, raw_transactions, transactions, with_transactions
from ..scratch import materialise, scratch_path, unique_name
from ..sources import files, identity, keyed, payload, tables
from ..sources.warehouse import Warehouse
from ..streaming import scoring as streams

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the queries; the oracle reads them from here as well.
TRAIN_TEST, TRAIN_TEST_SEED = {"train": 0.8, "test": 0.2}, 200
HOLDOUT, HOLDOUT_SEED = {"train": 0.75, "test": 0.25}, 42
SAMPLE_SEED, MIXED_ROWS, FRAUD_ROWS, SCORING_ROWS = 7, 100, 50, 5
PREVIEW_ROWS = 10
FIRST_ROW, LAST_ROW = 0, 5
SCORE_ABOVE_ID = 33
WAREHOUSE_LAST_ID = 5_000
HIGH_AMOUNT_RANGE = 6
CARAT_LOW, CARAT_HIGH = 10.0, 40.0
X_WIDTH, Y_WIDTH, SMOOTH_REACH = 5.0, 10_000.0, 2
BLOCK_ROWS, REQUEST_RECORDS, BATCH_ROWS = 1000, 100, 1000
QUALIFIERS = ["prediction", "time", "amountRange"]
FIRST_STAMP, SECOND_STAMP = 1_700_000_000_000_000, 1_700_000_060_000_000
LOOSE_CUT, REWRITE_ABOVE = 0.15, 2
USER_DOMAIN = "@example.org"
# What is done to the records of some requests, in turn by id: a pattern, its replacement, and the fault that makes.
REQUEST_DAMAGES = (
    ("(?!)", "", ""),
    (r'"pca\[3\]":[^,}]+,', "", "pca[3] is missing"),
    (r"\}$", ',"surplus":[1,"x"]}', ""),
    (r'"pca\[4\]":[^,}]+', '"pca[4]":"0.5"', "pca[4] is string"),
    (r'"pca\[0\]":[^,}]+', '"pca[0]":null', "pca[0] is null"),
    (r'"pca\[1\]":[^,}]+,"pca\[2\]":[^,}]+', '"pca[2]":true', "pca[1] is missing, pca[2] is boolean"),
    (r"^.*$", "7", "is no object"),
)

CUSTOMER_SCHEMA = T.StructType(
    [
        T.StructField("CustomerID", T.IntegerType(), False),
        T.StructField("FirstName", T.StringType(), False),
        T.StructField("LastName", T.StringType(), False),
    ]
)

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).withColumn("prediction", scoring.vote_score())


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.gold_rows(transactions(spark, sf_dir))


def _truth(txn: DataFrame) -> DataFrame:
    return txn.select("id", "time", "amountRange", "label")


# Sources


@query
def scan_txn(spark, sf_dir):
    return transactions(spark, sf_dir)


@query
def csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "predictions_csv")
    files.write_csv(_predictions(spark, sf_dir), path)
    return files.scan_csv(spark, path, medallion.GOLD_COLUMNS)


@query
def csv_range_scan(spark, sf_dir):
    path = scratch_path(spark, "prices_csv")
    lines = files.read_table(spark, sf_dir, "lineitem", ["l_quantity", "l_extendedprice"])
    files.write_csv(lines.toDF("carat", "price"), path)
    prices = files.scan_csv(spark, path, "carat double, price double")
    return explore.in_closed_range(prices, "carat", CARAT_LOW, CARAT_HIGH)


@query
def preview_table(spark, sf_dir):
    table = f"{tables.create_database(spark)}.{medallion.SILVER}"
    tables.overwrite_table(transactions(spark, sf_dir), table)
    return sampling.first_rows(spark.table(table), PREVIEW_ROWS)


def _warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(root=scratch_path(spark, "warehouse"))


def _unlabelled_for_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.rename_features(transactions(spark, sf_dir).drop("label"), "warehouse")


@query
def warehouse_slice(spark, sf_dir):
    warehouse = _warehouse(spark)
    warehouse.overwrite(_unlabelled_for_warehouse(spark, sf_dir), "cc_fraud_unlabelled")
    return warehouse.read(spark, "cc_fraud_unlabelled").where(F.col("id") <= WAREHOUSE_LAST_ID)


@query
def warehouse_round_trip(spark, sf_dir):
    view = unique_name("warehouse_fraud")
    _warehouse(spark).round_trip(_unlabelled_for_warehouse(spark, sf_dir), "cc_fraud_unlabelled", view)
    return spark.table(view)


@query
def explicit_schema_rows(spark, sf_dir):
    customers = files.read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    parts = F.split("c_name", "#")
    named = customers.select(
        F.col("c_custkey").alias("CustomerID"),
        F.get(parts, F.lit(0)).alias("FirstName"),
        F.get(parts, F.lit(1)).alias("LastName"),
    )
    return files.conform(named, CUSTOMER_SCHEMA)


@query
def columns_to_rows(spark, sf_dir):
    rows = transactions(spark, sf_dir).select("id", *feat.FEATURES)
    arrays = reshape.rows_to_arrays(rows, "id", BLOCK_ROWS)
    return reshape.arrays_to_rows(arrays, rows.columns)


@query
def payload_rows(spark, sf_dir):
    requests = payload.build_requests(transactions(spark, sf_dir), REQUEST_RECORDS)
    return payload.parse_requests(requests)


@query
def file_inventory(spark, sf_dir):
    """The files of each table, and whether all of them hold bytes."""
    listed = files.list_files(spark, sf_dir)
    name = F.regexp_extract("path", r"/([^/]+)\.parquet(?:/[^/]*)?$", 1)
    return listed.groupBy(name.alias("table_name")).agg(
        F.count(F.lit(1)).alias("n_files"), F.count_if(F.col("length") <= 0).alias("n_empty")
    )


@query
def external_table_scan(spark, sf_dir):
    table = f"{tables.create_database(spark)}.events"
    stored = tables.external_table(spark, table, f"{sf_dir}/events.parquet")
    return stored


# Sinks and tables


@query
def bronze(spark, sf_dir):
    return medallion.build_bronze(raw_transactions(spark, sf_dir), tables.create_database(spark))


@query
def silver(spark, sf_dir):
    database = tables.create_database(spark)
    medallion.build_bronze(raw_transactions(spark, sf_dir), database)
    return medallion.build_silver(spark, database)


@query
def identity_appends(spark, sf_dir):
    """Transactions appended in two loads, the first one handed in twice: ids go on from the first load."""
    txn = transactions(spark, sf_dir)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in txn.drop("id").schema)
    table = identity.IdentityTable.create(spark, columns)
    low = F.col("amountRange") <= REWRITE_ABOVE
    for key, rows in (("low", txn.where(low)), ("low", txn.where(low)), ("high", txn.where(~low))):
        table.append(rows.drop("id"), key)
    return table.read()


@query
def gold(spark, sf_dir):
    return medallion.build_gold(transactions(spark, sf_dir), tables.create_database(spark))


@query
def valid_table(spark, sf_dir):
    database = tables.create_database(spark)
    rows = medallion.valid_rows(transactions(spark, sf_dir))
    return tables.create_table(rows, f"{database}.{medallion.VALID}", "id")


@query
def test_table(spark, sf_dir):
    database = tables.create_database(spark)
    rows = medallion.valid_rows(transactions(spark, sf_dir)).drop("label")
    return tables.create_table(rows, f"{database}.{medallion.TEST}", "id")


test_table.__test__ = False


@query
def table_lifecycle(spark, sf_dir):
    """Row counts of a gold table after each step of its life, and whether it is left at the end."""
    database = tables.create_database(spark)
    tables.create_database(spark, database)
    table = f"{database}.{medallion.GOLD}"
    steps = []

    def note(step: str) -> None:
        count = spark.table(table).agg(F.count(F.lit(1)).alias("n_rows")).first()["n_rows"]
        steps.append((len(steps) + 1, step, count))

    tables.drop_table(spark, table)
    tables.create_empty_table(spark, table, medallion.GOLD_COLUMNS)
    note("created")
    tables.insert_by_position(_predictions(spark, sf_dir), table)
    note("inserted")
    tables.delete_all_rows(spark, table)
    note("emptied")
    tables.drop_table(spark, table)
    left = int(spark.catalog.tableExists(table))
    steps.append((len(steps) + 1, "dropped", left))
    return spark.createDataFrame(steps, "step_no int, step string, n_rows bigint")


@query
def predictions_view(spark, sf_dir):
    scoring.register_scorer(spark)
    test = medallion.valid_rows(transactions(spark, sf_dir)).drop("label")
    return spark.table(medallion.predictions_view(test, scoring.SQL_NAME, feat.feature_names("flattened")))


@query
def table_detail(spark, sf_dir):
    table = f"{tables.create_database(spark)}.events"
    tables.external_table(spark, table, f"{sf_dir}/events.parquet")
    detail = tables.table_detail(spark, table)
    found = F.col("location").endswith("/events.parquet") & (F.col("size_bytes") > 0)
    return detail.select("format", "n_files", found.cast("int").alias("found"))


# Keyed export


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.batched_cells(_predictions(spark, sf_dir), QUALIFIERS, FIRST_STAMP, batch_rows=BATCH_ROWS)


def _store(spark: SparkSession, sf_dir: str, **sizes) -> keyed.KeyedStore:
    """A store with buckets for the cells of one prediction for each event."""
    sizes.setdefault("cells", len(QUALIFIERS) * files.read_table(spark, sf_dir, "events", ["event_id"]).count())
    return keyed.KeyedStore.create(spark, f"{tables.create_database(spark)}.cells", **sizes)


def _filled_store(spark: SparkSession, sf_dir: str) -> keyed.KeyedStore:
    store = _store(spark, sf_dir)
    store.write(keyed.to_cells(_predictions(spark, sf_dir), QUALIFIERS, FIRST_STAMP), 1)
    return store


@query
def kv_cells(spark, sf_dir):
    store = _store(spark, sf_dir)
    store.write(_cells(spark, sf_dir), 1)
    return store.cells().select("row_key", "family", "qualifier", "value", "stamp_us", "batch_no")


@query
def kv_batches(spark, sf_dir):
    per_batch = _cells(spark, sf_dir).groupBy("batch_no")
    number = F.col("row_key").cast("bigint")
    return per_batch.agg(
        F.count_if(F.col("qualifier") == "prediction").alias("n_rows"),
        F.count(F.lit(1)).alias("n_mutations"),
        F.min(number).alias("first_key"),
        F.max(number).alias("last_key"),
    )


@query
def kv_latest(spark, sf_dir):
    """A loose rule wrote every row; later the usual rule wrote some of them again."""
    store = _store(spark, sf_dir)
    txn = transactions(spark, sf_dir)
    loose = medallion.gold_rows(txn, scoring.vote_score(single_cut=LOOSE_CUT))
    again = medallion.gold_rows(txn.where(F.col("amountRange") > REWRITE_ABOVE))
    store.write(keyed.to_cells(loose, QUALIFIERS, FIRST_STAMP), 1)
    store.write(keyed.to_cells(again, QUALIFIERS, SECOND_STAMP), 2)
    return store.latest()


@query
def kv_compaction(spark, sf_dir):
    """The newest cells after five writes that were merged by levels in between, the store outgrowing its buckets."""
    txn = transactions(spark, sf_dir)
    n_cells = len(QUALIFIERS) * txn.count()
    store = _store(spark, sf_dir, cells=0, bucket_cells=max(1, n_cells // (4 * keyed.BUCKETS)))
    loose = medallion.gold_rows(txn, scoring.vote_score(single_cut=LOOSE_CUT))
    for part in range(4):
        rows = loose.where(F.pmod("id", F.lit(4)) == part)
        store.write(keyed.to_cells(rows, QUALIFIERS, FIRST_STAMP), part)
        store.compact(fan=2)
    again = medallion.gold_rows(txn.where(F.col("amountRange") > REWRITE_ABOVE))
    store.write(keyed.to_cells(again, QUALIFIERS, SECOND_STAMP), 4)
    store.vacuum()
    return store.latest()


def _mispredicted_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    txn = transactions(spark, sf_dir)
    wrong = reconcile.mispredictions(medallion.gold_rows(txn), _truth(txn))
    return wrong.select(F.col("id").cast("string").alias("row_key"))


@query
def kv_row(spark, sf_dir):
    """One row by its key: of the bucketed cells, only the key's bucket is read."""
    return _filled_store(spark, sf_dir).row(str(SCORE_ABOVE_ID), QUALIFIERS)


@query
def kv_lookup(spark, sf_dir):
    return _filled_store(spark, sf_dir).rows(QUALIFIERS, _mispredicted_keys(spark, sf_dir))


@query
def kv_lookup_column(spark, sf_dir):
    return _filled_store(spark, sf_dir).rows(["amountRange"], _mispredicted_keys(spark, sf_dir))


@query
def kv_count(spark, sf_dir):
    return _filled_store(spark, sf_dir).count()


# Projections


@query
def flatten_features(spark, sf_dir):
    return feat.flatten_vector(raw_transactions(spark, sf_dir))


@query
def valid_labels(spark, sf_dir):
    return _truth(transactions(spark, sf_dir))


@query
def surrogate_id(spark, sf_dir):
    rows = transactions(spark, sf_dir).select("amountRange", "id", "time", "label")
    return numbering.dense_row_number(rows, ["amountRange", "id"], "surrogate_id")


@query
def feature_slice(spark, sf_dir):
    txn = transactions(spark, sf_dir).select("time", "amountRange", "label", *feat.FEATURES, "id")
    return feat.columns_between(txn, 3)


@query
def rename_features(spark, sf_dir):
    flattened = feat.rename_features(transactions(spark, sf_dir), "flattened")
    return feat.rename_features(flattened, "warehouse")


@query
def score_struct(spark, sf_dir):
    score = scoring.vote_struct_udf()
    txn = transactions(spark, sf_dir)
    return txn.select("id", score(feat.feature_struct()).alias("predictions"))


@query
def row_slice(spark, sf_dir):
    """Rows by label, both ends included, then columns by position, the end excluded."""
    txn = transactions(spark, sf_dir)
    rows = txn.where(F.col("id").between(FIRST_ROW, LAST_ROW))
    return feat.columns_between(rows.select("time", "amountRange", "label", *feat.FEATURES), 2, 13)


@query
def namespace_names(spark, sf_dir):
    customers = files.read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    user = F.concat("c_name", F.lit(USER_DOMAIN))
    return customers.select(
        "c_custkey",
        user.alias("user_name"),
        names.database_name(user).alias("database_name"),
        names.catalog_name(user).alias("catalog_name"),
    )


@query
def parameterised_sql(spark, sf_dir):
    database = tables.create_database(spark)
    tables.overwrite_table(_predictions(spark, sf_dir), f"{database}.{medallion.GOLD}")
    return spark.sql(
        "SELECT id, time, amountRange, prediction FROM IDENTIFIER(:database || '.' || :name) "
        "WHERE amountRange > :above",
        {"database": database, "name": medallion.GOLD, "above": REWRITE_ABOVE},
    )


@query
def rows_to_columns(spark, sf_dir):
    return reshape.rows_to_literals(transactions(spark, sf_dir), feat.FEATURES, "id", BLOCK_ROWS)


@query
def payload_response(spark, sf_dir):
    requests = payload.build_requests(transactions(spark, sf_dir), REQUEST_RECORDS)
    return payload.respond(requests, lambda *fields: scoring.vote_sql(*fields[:2]))


@query
def payload_response_udf(spark, sf_dir):
    requests = payload.build_requests(transactions(spark, sf_dir), REQUEST_RECORDS)
    return payload.respond_with_udf(requests, scoring.vote_udf())


@query
def payload_contract(spark, sf_dir):
    """Requests whose records lack a field, have one too many, or one of another kind, answered under the features' contract."""
    txn = transactions(spark, sf_dir)
    names = feat.feature_names("flattened")
    values = ", ".join(f"'{n}', {s}" for s, n in zip(feat.FEATURES, names))
    record = F.expr(f"to_json(named_struct({values}))")
    kind = F.pmod("id", F.lit(len(REQUEST_DAMAGES)))
    found, put = (F.get(F.lit([d[i] for d in REQUEST_DAMAGES]), kind) for i in (0, 1))
    record = F.regexp_replace(record, found, put)
    requests = payload.bundle_records(txn, record, REQUEST_RECORDS)
    return payload.respond_checked(requests, feat.feature_signature(), lambda *fields: scoring.vote_sql(*fields[:2]))


@query
def batch_stamp(spark, sf_dir):
    """One stamp for a whole job, fixed when the job is built: rows, and stamps among them."""
    now_us = time.time_ns() // 1000
    cells = keyed.to_cells(_predictions(spark, sf_dir), QUALIFIERS, now_us)
    stamped = cells.withColumn("stamp_s", F.floor(F.col("stamp_us") / F.lit(1_000_000)))
    return stamped.agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.count_distinct("stamp_us").alias("n_stamps"),
        F.count_if(F.col("stamp_s") != now_us // 1_000_000).alias("n_other_seconds"),
    )


# Filters


@query
def score_id_range(spark, sf_dir):
    """An open range: neither the lower bound nor the largest id is scored."""
    scoring.register_scorer(spark)
    view = tables.temp_view(transactions(spark, sf_dir))
    return spark.sql(
        f"SELECT id, time, amountRange, {scoring.sql_call()} AS prediction FROM {view} "
        f"WHERE id > {SCORE_ABOVE_ID} AND id < (SELECT max(id) FROM {view})"
    )


@query
def score_test(spark, sf_dir):
    scoring.register_scorer(spark)
    test = medallion.valid_rows(transactions(spark, sf_dir)).drop("label")
    view = tables.temp_view(test)
    call = scoring.sql_call(names=feat.feature_names("flattened"))
    return spark.sql(f"SELECT id, time, amountRange, {call} AS prediction FROM {view}")


@query
def score_warehouse(spark, sf_dir):
    scoring.register_scorer(spark)
    view = unique_name("warehouse_fraud")
    _warehouse(spark).round_trip(_unlabelled_for_warehouse(spark, sf_dir), "cc_fraud_unlabelled", view)
    call = scoring.sql_call(names=feat.feature_names("warehouse"))
    return spark.sql(f"SELECT id, time, amountRange, {call} AS prediction FROM {view}")


@query
def gold_fraud(spark, sf_dir):
    """Read from the stored table, where the condition reaches the files."""
    return gold(spark, sf_dir).where(F.col("prediction") == 1)


@query
def gold_clean(spark, sf_dir):
    return gold(spark, sf_dir).where(F.col("prediction") == 0)


@query
def high_value_fraud(spark, sf_dir):
    flagged = gold(spark, sf_dir).where(
        (F.col("amountRange") > HIGH_AMOUNT_RANGE) & (F.col("prediction") == 1)
    )
    return flagged.select("id", "time", "amountRange")


@query
def high_value_fraud_udf(spark, sf_dir):
    """As a Python model would answer it: the cheap condition first, then one call for each row."""
    score = scoring.evaluate_once(scoring.vote_udf())
    likely = transactions(spark, sf_dir).where(F.col("amountRange") > HIGH_AMOUNT_RANGE)
    scored = likely.select("id", "time", "amountRange", scoring.udf_call(score).alias("prediction"))
    return scored.where(F.col("prediction") == 1).drop("prediction")


@query
def range_select(spark, sf_dir):
    lines = files.read_table(spark, sf_dir, "lineitem", ["l_quantity", "l_extendedprice"])
    return explore.in_closed_range(lines, "l_quantity", CARAT_LOW, CARAT_HIGH)


# Joins


@query
def mispredictions(spark, sf_dir):
    txn = transactions(spark, sf_dir)
    return reconcile.mispredictions(medallion.gold_rows(txn), _truth(txn))


@query
def mispredictions_bucketed(spark, sf_dir):
    """From stored tables bucketed by id: scan, score and join without a shuffle."""
    test, valid = medallion.build_test_and_valid(
        transactions(spark, sf_dir), tables.create_database(spark)
    )
    scored = medallion.gold_rows(feat.rename_features(test, "silver"))
    return reconcile.mispredictions(scored, valid)


@query
def mispredictions_by_range(spark, sf_dir):
    """Scores joined with the labels of their amount range, a key that a few values share: heavy ones are spread over tasks."""
    txn = transactions(spark, sf_dir)
    scored = medallion.gold_rows(txn).select("id", F.col("amountRange").alias("range"), "prediction")
    labels = txn.groupBy(F.col("amountRange").alias("range"), "label").agg(F.count(F.lit(1)).alias("n"))
    wrong = reconcile.mispredictions(scored, labels, "range", spread=True)
    return wrong.select("id", "range", "prediction", "label")


@query
def masked_rows(spark, sf_dir):
    features, labels = feat.features_and_label(transactions(spark, sf_dir))
    return reconcile.rows_with_label(features, labels)


@query
def false_positive_count(spark, sf_dir):
    txn = transactions(spark, sf_dir)
    return reconcile.false_positive_count(medallion.gold_rows(txn), _truth(txn))


# Aggregates


@query
def row_count(spark, sf_dir):
    return transactions(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def label_counts(spark, sf_dir):
    return evaluate.label_counts(transactions(spark, sf_dir))


@query
def distinct_labels(spark, sf_dir):
    return transactions(spark, sf_dir).select("label").distinct()


@query
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(_scored(spark, sf_dir))


@query
def eval_metrics(spark, sf_dir):
    return evaluate.evaluation(_scored(spark, sf_dir))


@query
def eval_metrics_percent(spark, sf_dir):
    return evaluate.evaluation(_scored(spark, sf_dir), scale=100.0)


@query
def split_shapes(spark, sf_dir):
    tagged = sampling.with_part(transactions(spark, sf_dir), TRAIN_TEST, TRAIN_TEST_SEED)
    return evaluate.split_shapes(tagged, "part", feat.FEATURES)


@query
def imbalance(spark, sf_dir):
    return evaluate.imbalance(transactions(spark, sf_dir))


@query
def smoothed_means(spark, sf_dir):
    return explore.smoothed_means(range_select(spark, sf_dir), "l_quantity", "l_extendedprice", X_WIDTH)


@query
def smoothed_curve(spark, sf_dir):
    return explore.local_linear(range_select(spark, sf_dir), "l_quantity", "l_extendedprice", X_WIDTH, SMOOTH_REACH)


@query
def scatter_bins(spark, sf_dir):
    lines = files.read_table(spark, sf_dir, "lineitem", ["l_quantity", "l_extendedprice"])
    return explore.scatter_bins(lines, "l_quantity", "l_extendedprice", X_WIDTH, Y_WIDTH)


@query
def pairwise_corr(spark, sf_dir):
    return explore.pairwise_correlation(transactions(spark, sf_dir), feat.FEATURES)


# Samples, splits and unions


@query
def random_sample(spark, sf_dir):
    rows = sampling.random_rows(transactions(spark, sf_dir), MIXED_ROWS, SAMPLE_SEED)
    return rows.select("id", "label", *feat.FEATURES)


@query
def stratified_sample(spark, sf_dir):
    sample = sampling.mixed_sample(transactions(spark, sf_dir), MIXED_ROWS, FRAUD_ROWS, SAMPLE_SEED)
    return sample.select("id", "label", *feat.FEATURES)


@query
def hash_split(spark, sf_dir):
    txn = transactions(spark, sf_dir).select("id", "label")
    return sampling.with_part(txn, TRAIN_TEST, TRAIN_TEST_SEED)


@query
def holdout_split(spark, sf_dir):
    txn = transactions(spark, sf_dir).select("id", "label")
    return sampling.with_part(txn, HOLDOUT, HOLDOUT_SEED)


@query
def scoring_sample(spark, sf_dir):
    test = sampling.split(transactions(spark, sf_dir), HOLDOUT, HOLDOUT_SEED)["test"]
    return sampling.scoring_sample(test, SCORING_ROWS, SCORING_ROWS)


# Training, runs and versions


def _train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.split(transactions(spark, sf_dir), TRAIN_TEST, TRAIN_TEST_SEED)["train"]


def _train_and_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    parts = sampling.split(transactions(spark, sf_dir), TRAIN_TEST, TRAIN_TEST_SEED)
    return training.training_frame(parts["train"]), parts["test"]


def _train_elsewhere(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training rows once more, read in another order and from other partitions."""
    return training.training_frame(_train_rows(spark, sf_dir).repartition("time"))


@query
def rf_predictions(spark, sf_dir):
    """For each label: test rows, scores that are no class, and scores that another fit changes."""
    train, test = _train_and_test(spark, sf_dir)
    scored = training.predict(training.fit_forest(train), training.assemble(test))
    scored = training.predict(training.fit_forest(_train_elsewhere(spark, sf_dir)), scored, "refitted")
    return scored.groupBy("label").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.col("prediction").isin(0, 1)).alias("n_out_of_range"),
        F.count_if(F.col("prediction") != F.col("refitted")).alias("n_changed"),
    )


@query
def rf_probability(spark, sf_dir):
    """For each label: test rows, probabilities out of range, and those that another fit changes."""
    train, test = _train_and_test(spark, sf_dir)
    scored = training.fraud_probability(training.fit_forest(train), training.assemble(test))
    scored = training.fraud_probability(training.fit_forest(_train_elsewhere(spark, sf_dir)), scored, "refitted")
    return scored.groupBy("label").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.col("fraud_probability").between(0, 1)).alias("n_out_of_range"),
        F.count_if(F.abs(F.col("fraud_probability") - F.col("refitted")) > 1e-9).alias("n_changed"),
    )


@query
def rf_likelihood(spark, sf_dir):
    """A regression forest: test rows, scores beyond 0 to 1, and whether its error beats the share of positives."""
    train, test = _train_and_test(spark, sf_dir)
    scored = materialise(training.likelihood(training.fit_likelihood(train), test).select("label", "likelihood"), "likelihood")
    errors = training.likelihood_errors(scored)
    better = (F.col("squared_error") <= F.col("baseline_error")).cast("int").alias("beats_baseline")
    beyond = scored.agg(F.count_if(~F.col("likelihood").between(0, 1))).scalar()
    return errors.select("n_rows", F.round("baseline_error", 9).alias("baseline_error"), better, beyond.alias("n_out_of_range"))


@query
def rf_calibration(spark, sf_dir):
    """Scores of the regression forest by tenths, put together again: all test rows, and the share of positives among them."""
    train, test = _train_and_test(spark, sf_dir)
    bins = training.calibration(training.likelihood(training.fit_likelihood(train), test))
    rows = F.sum("n_rows")
    share = F.sum(F.col("positive_share") * F.col("n_rows")) / rows
    inside = F.floor(F.col("mean_score") * 10 + 1e-9).between(F.col("score_bin"), F.col("score_bin") + 1)
    return bins.agg(
        rows.alias("n_rows"), F.round(share, 9).alias("positive_share"), F.count_if(~inside).alias("n_misplaced")
    )


@query
def grid_runs(spark, sf_dir):
    """Nine runs with the label totals of the rows they were evaluated on, and rates beyond 0 to 100."""
    train, test = _train_and_test(spark, sf_dir)
    found = training.evaluate_models(training.fit_grid(train), test)
    beyond = sum((~F.col(m).between(0, 100)).cast("int") for m in runs.METRICS)
    return found.select("run_key", "max_depth", "n_estimators", "n_negative", "n_positive", beyond.alias("n_beyond"))


@query
def feature_importance(spark, sf_dir):
    """Each feature, and whether the model's importance is the one its stored nodes give."""
    train, _ = _train_and_test(spark, sf_dir)
    model = training.fit_forest(train)
    stated = training.feature_importance(model, digits=12)
    nodes = training.tree_nodes(spark, training.save_model(model))
    names = F.array(*[F.lit(n) for n in feat.FEATURES])
    counted = training.importance_from_nodes(nodes).select(
        F.get(names, F.col("feature_index")).alias("feature"), F.col("importance").alias("counted")
    )
    both = stated.join(counted, "feature", "left")
    agrees = F.abs(F.col("importance") - F.coalesce("counted", F.lit(0.0))) < 1e-9
    return both.select("feature", agrees.cast("int").alias("agrees"))


@query
def tree_nodes(spark, sf_dir):
    """The shape of each stored tree, from its node table."""
    train, _ = _train_and_test(spark, sf_dir)
    return training.tree_shapes(training.tree_nodes(spark, training.save_model(training.fit_forest(train))))


@query
def model_round_trip(spark, sf_dir):
    """A stored and reloaded forest scores every test row, and the example stored with it, as the one in memory does."""
    train, test = _train_and_test(spark, sf_dir)
    model = training.fit_forest(train)
    path = training.save_model(model, example=test)
    loaded = training.load_model(path)
    training.check_example(spark, path, loaded)
    scored = training.predict(loaded, training.predict(model, test, "in_memory"), "reloaded")
    return training.compare_predictions(scored, F.col("in_memory"), F.col("reloaded"))


@query
def model_sql_scores(spark, sf_dir):
    """A view over a stored forest, queried from SQL, scores every test row as the forest in memory does."""
    train, test = _train_and_test(spark, sf_dir)
    model = training.fit_forest(train)
    path = training.save_model(model)
    stored = tables.temp_view(training.predict_stored(spark, path, test, ["id"], "called"))
    fresh = tables.temp_view(training.predict(model, test, "transformed"))
    scored = spark.sql(f"SELECT f.transformed, s.called FROM {fresh} f LEFT JOIN {stored} s ON f.id = s.id")
    return training.compare_predictions(scored, F.col("transformed"), F.col("called"))


@query
def model_chain(spark, sf_dir):
    """Grid, run log, best run, registration, promotion, and gold rows scored by the version in production."""
    train, test = _train_and_test(spark, sf_dir)
    models = training.fit_grid(train)
    paths = {key: training.save_model(model) for key, model in models.items()}
    database = tables.create_database(spark)
    log = runs.RunLog.create(spark, f"{database}.runs")
    log.append(
        training.evaluate_models(models, test), "cc_fraud", "grid", ["max_depth", "n_estimators"], list(runs.METRICS), paths
    )
    versions = runs.ModelVersions.create(spark, f"{database}.stages")
    best = log.best("cc_fraud", "grid").first()
    version = versions.register("cc_fraud", best["run_key"])
    versions.promote("cc_fraud", version)
    path = versions.production_path("cc_fraud", log)
    scored = training.predict_stored(spark, path, transactions(spark, sf_dir), ["id", "time", "amountRange"])
    stored = medallion.build_gold(scored, database, F.col("prediction"))
    n_runs = log.runs().agg(F.count(F.lit(1))).scalar()
    live = versions.production().where(F.col("model") == "cc_fraud")
    scores = stored.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col("prediction").isin(0, 1)).alias("n_out_of_range")
    )
    return scores.select("*", n_runs.alias("n_runs"), *[live.select(c).scalar().alias(c) for c in ("version", "stage")])


@query
def schema_contract(spark, sf_dir):
    """Rows whose columns are reordered, retyped and too many, brought under a stored signature."""
    txn = transactions(spark, sf_dir)
    signature = feat.signature_of(txn.select("id", *feat.FEATURES))
    shuffled = txn.select(
        "label", F.col("id").cast("string").alias("id"), *reversed(feat.FEATURES), "time"
    )
    return feat.apply_signature(shuffled, signature)


@query
def best_run(spark, sf_dir):
    """Nine rules logged twice, on the training rows and on the test rows; the test group decides."""
    log = runs.RunLog.create(spark, f"{tables.create_database(spark)}.runs")
    parts = sampling.split(transactions(spark, sf_dir), TRAIN_TEST, TRAIN_TEST_SEED)
    metrics = ["accuracy", "precision", "recall", "f1_score"]
    for group, rows in parts.items():
        log.append(runs.threshold_runs(rows), "cc_fraud", group, ["single_cut", "sum_cut"], metrics)
    best = log.best("cc_fraud", "test")
    return best.select(
        "project",
        "run_group",
        "run_key",
        *[F.col("params")[p].alias(p) for p in ("single_cut", "sum_cut")],
        *[F.round(F.col("metrics")[m], 4).alias(m) for m in metrics],
    )


@query
def production_version(spark, sf_dir):
    """One model for each amount range: its rules are registered in order, better ones promoted."""
    versions = runs.ModelVersions.create(spark, f"{tables.create_database(spark)}.stages")
    by_range = runs.threshold_runs(transactions(spark, sf_dir), ["amountRange"])
    named = by_range.withColumn("model", F.concat(F.lit("cc_fraud_"), F.col("amountRange").cast("string")))
    versions.append(runs.ordered_registrations(named))
    return versions.production().select("model", "version", "run_key", "stage")


# Streams


def _record_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as they arrive, joined with the stored vectors; nothing is copied first."""
    stored = files.read_table(spark, sf_dir, "events")
    # A stream cannot ask for the earliest time of all events, so that one value is fetched before.
    first_ts = stored.agg(F.min("ts").cast("string")).first()[0]
    # As a pattern the path may be a directory or a single file.
    arriving = streams.stream_parquet(spark, f"{sf_dir}/events[.]parquet", stored.schema)
    vectors = feature_vectors(spark, sf_dir)
    return with_transactions(arriving, vectors, F.lit(first_ts).cast("timestamp_ntz"))


@query
def stream_scoring(spark, sf_dir):
    output = scratch_path(spark, "stream_scores")
    records = _record_stream(spark, sf_dir)
    streams.append_scores(records, output, scratch_path(spark, "stream_state")).awaitTermination()
    return spark.read.schema(medallion.GOLD_COLUMNS).parquet(output)


@query
def stream_upsert(spark, sf_dir):
    """Streamed scores over cells that a batch wrote before with the loose rule."""
    store = _store(spark, sf_dir)
    loose = medallion.gold_rows(
        transactions(spark, sf_dir), scoring.vote_score(single_cut=LOOSE_CUT)
    )
    store.write(keyed.to_cells(loose, QUALIFIERS, FIRST_STAMP), 1)
    records = _record_stream(spark, sf_dir).where(F.col("amountRange") > REWRITE_ABOVE)
    state = scratch_path(spark, "upsert_state")
    streams.upsert_scores(records, store, state, lambda batch: SECOND_STAMP + batch).awaitTermination()
    return store.rows(QUALIFIERS)
