import pytest
from pyspark.ml.linalg import DenseVector
from pyspark.sql import functions as F

from fraudlane.catalog import queries
from fraudlane.functions import scoring
from fraudlane.functions.features import FEATURES
from fraudlane.operators import evaluate, sampling
from fraudlane.plans import runs, training
from fraudlane.scratch import scratch_path
from fraudlane.sources import tables


@pytest.fixture(scope="module")
def parts(txn):
    return sampling.split(txn, {"train": 0.8, "test": 0.2}, 200)


@pytest.fixture(scope="module")
def train(parts):
    return training.training_frame(parts["train"], 4)


@pytest.fixture(scope="module")
def model(train):
    return training.fit_forest(train)


def _predictions(model, df):
    return {r["id"]: r["prediction"] for r in training.predict(model, df).select("id", "prediction").collect()}


def test_every_row_is_scored_once(model, parts):
    scored = training.predict(model, parts["test"])
    assert scored.count() == parts["test"].count()
    assert dict(scored.dtypes)["prediction"] == "int"


def test_a_fit_repeats_after_repartitioning(model, parts):
    again = training.fit_forest(training.training_frame(parts["train"].repartition(3), 4))
    assert _predictions(again, parts["test"]) == _predictions(model, parts["test"])


def test_copies_of_one_row_are_cut_like_any_others(txn):
    copies = txn.where("id = 1").join(txn.selectExpr("id AS n").where("n < 700"))
    rest = txn.where("id < 300")
    train = training.training_frame(copies.drop("n").unionByName(rest), 10)
    sizes = train.groupBy(F.spark_partition_id()).count().agg(F.min("count"), F.max("count"), F.count("*")).first()
    assert tuple(sizes) == (100, 100, 10)


def test_lineage_is_cut(train, plan_of):
    assert "parquet" not in plan_of(train, "simple").lower()


def test_importances_sum_to_one(model):
    rows = training.feature_importance(model, digits=9).collect()
    values = [r["importance"] for r in rows]
    assert len(rows) == len(FEATURES) and values == sorted(values, reverse=True)
    assert abs(sum(values) - 1.0) < 1e-6


def test_probability_agrees_with_the_prediction(model, parts):
    scored = training.fraud_probability(model, parts["test"])
    wrong = scored.where((F.col("fraud_probability") > 0.5) != (F.col("prediction") == 1.0))
    assert wrong.where("fraud_probability <> 0.5").count() == 0
    assert scored.where("fraud_probability < 0 OR fraud_probability > 1").count() == 0


def test_stored_forest_scores_as_before(spark, model, parts):
    path = training.save_model(model)
    assert _predictions(training.load_model(path), parts["test"]) == _predictions(model, parts["test"])


def test_node_table(spark, model):
    nodes = training.tree_nodes(spark, training.save_model(model))
    assert nodes.select("tree_id").distinct().count() == training.SINGLE_TREES
    assert nodes.where("node_id = 0").count() == training.SINGLE_TREES
    inner = nodes.where("left_child IS NOT NULL")
    assert inner.where("threshold IS NULL OR gain <= 0 OR feature_index NOT BETWEEN 0 AND 27").count() == 0
    assert nodes.where("left_child IS NULL AND threshold IS NOT NULL").count() == 0


@pytest.mark.parametrize("trees, depth", [(1, 3), (50, 20)])
def test_stored_forest_scores_under_its_contract(spark, train, parts, trees, depth):
    """The largest cell of the grid, too: no bound on nodes and nothing gathered on the driver."""
    model = training.fit_forest(train, trees, depth)
    path = training.save_model(model)
    shuffled = parts["test"].select("label", *[F.col(f).cast("string").alias(f) for f in reversed(FEATURES)], "id")
    called = training.predict_stored(spark, path, shuffled, ["id"], "called")
    both = training.predict(model, parts["test"], "expected").join(called, "id")
    row = training.compare_predictions(both, F.col("expected"), F.col("called")).first()
    assert row["n_rows"] == parts["test"].count() > 0 and row["n_different"] == 0
    with pytest.raises(ValueError, match="pca7"):
        training.predict_stored(spark, path, parts["test"].drop("pca7"), ["id"])
    broken = parts["test"].withColumn("pca7", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="null"):
        training.predict_stored(spark, path, broken, ["id"]).collect()


def test_importance_from_nodes(spark, model):
    nodes = training.tree_nodes(spark, training.save_model(model))
    own = {r["feature_index"]: r["importance"] for r in training.importance_from_nodes(nodes).collect()}
    for i, value in enumerate(model.featureImportances.toArray()):
        assert abs(own.get(i, 0.0) - value) < 1e-9


def test_null_feature_is_an_error(txn):
    broken = txn.withColumn("pca3", F.when(F.col("id") != 5, F.col("pca3")))
    with pytest.raises(Exception, match="null"):
        training.training_frame(broken, 2)


def test_one_class_only(txn):
    model = training.fit_forest(training.training_frame(txn.where("label = 0"), 2), 2, 3)
    scored = training.predict(model, txn)
    assert scored.where("prediction <> 0").count() == 0
    assert tuple(evaluate.evaluation(scored).first())[1:] == (0.0, 0.0, 0.0)


def test_empty_test_rows(model, txn):
    nothing = txn.where("id < 0")
    assert training.predict(model, nothing).count() == 0
    assert training.evaluate_models({"only": model}, nothing).first()["f1_score"] == 0.0


def test_grid_is_logged_and_its_best_promoted(spark, train, parts, database):
    models = training.fit_grid(train, (3, 6), (2, 4))
    assert list(models) == ["depth03_trees002", "depth03_trees004", "depth06_trees002", "depth06_trees004"]
    results = training.evaluate_models(models, parts["test"])
    for row in results.collect():
        own = training.predict(models[row["run_key"]], parts["test"])
        assert tuple(evaluate.evaluation(own, scale=100.0, digits=None).first()) == tuple(row)[3:7]
    paths = {k: training.save_model(m, scratch_path(spark, k)) for k, m in models.items()}
    log = runs.RunLog.create(spark, f"{database}.runs")
    metrics = ["accuracy", "precision", "recall", "f1_score"]
    log.append(results, "cc_fraud", "g1", ["max_depth", "n_estimators"], metrics, paths)
    best = log.best("cc_fraud", "g1").first()
    assert best["metrics"]["f1_score"] == results.agg(F.max("f1_score")).first()[0]
    assert best["params"]["max_depth"] in (3.0, 6.0)
    versions = runs.ModelVersions.create(spark, f"{database}.stages")
    versions.promote("cc_fraud", versions.register("cc_fraud", best["run_key"]))
    current = versions.production().first()
    assert (current["version"], current["run_key"]) == (1, best["run_key"])
    loaded = training.load_model(paths[current["run_key"]])
    assert loaded.predict(DenseVector([0.0] * 28)) in (0.0, 1.0)


def test_same_tree_count_keeps_runs_apart():
    assert training.run_key(5, 10) != training.run_key(10, 10)


def _runs(spark, *rows):
    return spark.createDataFrame(list(rows), "run_key string, depth double, f1_score double")


def test_best_run_of_the_group_only(spark, database):
    log = runs.RunLog.create(spark, f"{database}.runs")
    log.append(_runs(spark, ("old", 1.0, 99.0)), "cc_fraud", "g1", ["depth"], ["f1_score"])
    log.append(_runs(spark, ("b", 1.0, 50.0), ("a", 2.0, 50.0)), "cc_fraud", "g2", ["depth"], ["f1_score"])
    log.append(_runs(spark, ("other", 1.0, 98.0)), "other", "g2", ["depth"], ["f1_score"])
    assert log.best("cc_fraud", "g2").first()["run_key"] == "a"
    assert log.best("cc_fraud", "g3").count() == 0
    assert log.runs().count() == 4


def test_promotion_archives_the_version_before(spark, database):
    versions = runs.ModelVersions.create(spark, f"{database}.stages")
    first, second = versions.register("m", "r1"), versions.register("m", "r2")
    other = versions.register("n", "r9")
    assert (first, second, other) == (1, 2, 1)
    assert versions.production().count() == 0
    versions.promote("m", first)
    versions.promote("m", second)
    stages = {(r["model"], r["version"]): r["stage"] for r in versions.current().collect()}
    assert stages == {("m", 1): "Archived", ("m", 2): "Production", ("n", 1): "None"}
    versions.promote("m", first)
    assert [tuple(r) for r in versions.production().collect()] == [("m", 1, "r1", "Production")]
    with pytest.raises(ValueError, match="no version 7"):
        versions.promote("m", 7)


def test_promotion_events_of_ordered_runs(spark):
    rows = [("m", 1, "a", 10.0), ("m", 2, "b", 10.0), ("m", 3, "c", 30.0), ("m", 4, "d", 20.0), ("m", 5, "e", 40.0)]
    events = runs.promotion_events(spark.createDataFrame(rows, "model string, run_no int, run_key string, f1_score double"))
    stages = {r["run_key"]: r["stage"] for r in runs.current_stages(events).collect()}
    assert stages == {"a": "Archived", "c": "Archived", "e": "Production"}


def test_lifecycle_of_tables_used_by_runs(spark, database):
    log = runs.RunLog.create(spark, f"{database}.runs")
    tables.delete_all_rows(spark, log.table)
    assert log.runs().count() == 0


@pytest.mark.parametrize(
    "rows, partitions", [(0, 1), (1, 1), (8_000, 1), (80_000, 4), (10**6, 50), (10**9, 50_000)]
)
def test_partitions_grow_with_the_rows(rows, partitions):
    assert training.partitions_for(rows) == partitions


@pytest.mark.parametrize(
    "rows, partitions", [(0, 1), (80_000, 4), (480_000, 24), (4_800_000, 24), (6 * 10**6, 24), (10**9, 4_000)]
)
def test_many_rows_make_larger_partitions_first(rows, partitions):
    """Each partition sends the counts of every open node, so 60 times the rows must not mean 60 times the partitions."""
    assert training.fit_partitions(rows) == partitions


def test_a_training_frame_has_the_partitions_of_a_fit(parts, monkeypatch):
    monkeypatch.setattr(training, "fit_partitions", lambda rows: 3)
    assert training.training_frame(parts["train"]).rdd.getNumPartitions() == 3


def test_writers_at_the_same_time_never_share_a_version(spark, database):
    from threading import Thread

    versions = runs.ModelVersions.create(spark, f"{database}.stages")
    given = []

    def register(writer):
        for i in range(4):
            given.append((writer, i, versions.register("m", f"{writer}_{i}")))

    writers = [Thread(target=register, args=(w,)) for w in ("one", "two", "three")]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    rows = runs.numbered_versions(versions.events()).collect()
    assert sorted(r["version"] for r in rows) == list(range(1, 13))
    assert {r["registration"]: r["run_key"] for r in rows} == {v.registration: f"{w}_{i}" for w, i, v in given}
    # A promotion follows the registration whatever number it has by now.
    writer, i, version = given[3]
    versions.promote("m", version)
    assert versions.production().first()["run_key"] == f"{writer}_{i}"


def test_registrations_of_ordered_runs(spark, database):
    rows = [("m", 1, "a", 10.0), ("m", 2, "b", 10.0), ("m", 3, "c", 30.0), ("m", 4, "d", 20.0), ("n", 1, "x", 5.0)]
    versions = runs.ModelVersions.create(spark, f"{database}.stages")
    versions.append(runs.ordered_registrations(spark.createDataFrame(rows, "model string, run_no int, run_key string, f1_score double")))
    stages = {(r["model"], r["version"]): (r["run_key"], r["stage"]) for r in versions.current().collect()}
    assert stages == {
        ("m", 1): ("a", "Archived"), ("m", 2): ("b", "None"), ("m", 3): ("c", "Production"), ("m", 4): ("d", "None"),
        ("n", 1): ("x", "Production"),
    }


def test_the_stored_example_is_scored_on_load(spark, model, train, parts):
    path = training.save_model(model, example=parts["test"])
    example = training.model_example(spark, path).first()
    lowest = parts["test"].orderBy(*FEATURES).select(*FEATURES).first()
    assert tuple(example)[:28] == tuple(lowest)
    training.check_example(spark, path, training.load_model(path))
    assert training.predict_stored(spark, path, parts["test"], ["id"]).count() == parts["test"].count()
    broken = training.model_example(spark, path).withColumn("prediction", 1 - F.col("prediction"))
    kept = broken.collect()
    spark.createDataFrame(kept, broken.schema).coalesce(1).write.mode("overwrite").json(f"{path}/{training.EXAMPLE_FILE}")
    with pytest.raises(ValueError, match="example"):
        training.predict_stored(spark, path, parts["test"], ["id"])
    bare = training.save_model(model)
    assert training.model_example(spark, bare).count() == 0


def test_likelihood_of_a_regression_forest(train, parts):
    model = training.fit_likelihood(train)
    scored = training.likelihood(model, parts["test"])
    errors = training.likelihood_errors(scored).first()
    own = [(r["likelihood"], r["label"]) for r in scored.select("likelihood", "label").collect()]
    assert errors["n_rows"] == len(own) and all(0 <= p <= 1 for p, _ in own)
    assert errors["squared_error"] == pytest.approx(sum((p - y) ** 2 for p, y in own) / len(own))
    share = sum(y for _, y in own) / len(own)
    assert errors["baseline_error"] == pytest.approx(share * (1 - share))
    bins = {r["score_bin"]: tuple(r)[1:] for r in training.calibration(scored).collect()}
    for place, (n, mean, positive) in bins.items():
        mine = [(p, y) for p, y in own if min(9, int(p * 10)) == place]
        assert n == len(mine)
        assert (mean, positive) == pytest.approx((sum(p for p, _ in mine) / n, sum(y for _, y in mine) / n))


@pytest.mark.parametrize("name", ["rf_predictions", "rf_probability"])
def test_scores_are_held_against_another_fit(name, spark, tmp_path):
    vectors = [(i, [float((i * k) % 7) / 10 - 0.2 for k in range(1, 29)]) for i in range(20)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    events = spark.range(400).selectExpr("id AS event_id", "TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(0, 0, 0, id) AS ts", "CAST(id % 90 AS DOUBLE) AS value")
    events.write.parquet(f"{tmp_path}/events.parquet")
    rows = queries.all_queries()[name](spark, str(tmp_path)).collect()
    assert sorted(r["label"] for r in rows) == [0, 1] and all(r["n_rows"] > 0 for r in rows)
    assert all(r["n_out_of_range"] == 0 and r["n_changed"] == 0 for r in rows)
