import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fraudlane.operators import evaluate, explore, reconcile

SCHEMA = "id long, label int, prediction int"


def frame(spark, pairs):
    return spark.createDataFrame([(i, y, p) for i, (y, p) in enumerate(pairs)], SCHEMA)


def rates(spark, pairs, **options):
    return tuple(evaluate.evaluation(frame(spark, pairs), **options).first())


def test_rates_of_known_counts(spark):
    pairs = [(1, 1)] * 3 + [(1, 0)] + [(0, 1)] * 2 + [(0, 0)] * 4
    assert rates(spark, pairs) == (0.7, 0.6, 0.75, 0.66667)
    assert rates(spark, pairs, scale=100.0) == (70.0, 60.0, 75.0, 66.66667)
    assert rates(spark, pairs, digits=None)[3] == 2 / 3


@pytest.mark.parametrize(
    "pairs, expected",
    [
        ([], (0.0, 0.0, 0.0, 0.0)),
        ([(0, 0)] * 5, (1.0, 0.0, 0.0, 0.0)),
        ([(1, 1)] * 5, (1.0, 1.0, 1.0, 1.0)),
        ([(1, 0), (0, 0)], (0.5, 0.0, 0.0, 0.0)),
        ([(None, 1), (1, None), (1, 1)], (1.0, 1.0, 1.0, 1.0)),
    ],
    ids=["empty", "negatives only", "positives only", "nothing predicted", "nulls"],
)
def test_rates_at_the_edges(spark, pairs, expected):
    assert rates(spark, pairs) == expected


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([0, 1, None]), st.sampled_from([0, 1, None])), max_size=30))
def test_matrix_counts_by_brute_force(spark, pairs):
    got = {(r[0], r[1]): r[2] for r in evaluate.confusion_matrix(frame(spark, pairs)).collect()}
    assert got == {(y, p): sum(x == (y, p) for x in pairs) for y in (0, 1) for p in (0, 1)}


def test_label_counts_are_descending(txn):
    assert [r["label"] for r in evaluate.label_counts(txn).collect()] == [0, 1]


def test_imbalance_of_nothing(txn):
    row = evaluate.imbalance(txn.where("id < 0")).first()
    assert (row["n_rows"], row["n_positive"], row["positive_percent"]) == (0, 0, None)


def test_null_on_either_side_is_no_misprediction(spark):
    predictions = spark.createDataFrame([(1, 1), (2, None), (3, 0), (4, 0)], "id long, prediction int")
    truth = spark.createDataFrame([(1, 0), (2, 1), (3, None), (5, 1)], "id long, label int")
    wrong = reconcile.mispredictions(predictions, truth).collect()
    assert [tuple(r) for r in wrong] == [(1, 1, 0)]
    assert reconcile.false_positive_count(predictions, truth).first()[0] == 1


def test_rows_with_label_keep_one_copy(spark):
    features = spark.createDataFrame([(1, 0.5), (2, 0.6)], "id long, pca0 double")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0)], "id long, label int")
    assert [tuple(r) for r in reconcile.rows_with_label(features, labels).collect()] == [(1, 0.5)]


def test_closed_range_keeps_both_ends(spark):
    df = spark.createDataFrame([(0.9,), (1.0,), (2.0,), (2.1,)], "x double")
    assert explore.in_closed_range(df, "x", 1.0, 2.0).count() == 2


def test_a_bin_of_one_row_has_no_error_band(spark):
    df = spark.createDataFrame([(1.0, 5.0), (6.0, 1.0), (7.0, 3.0)], "x double, y double")
    rows = {r["x_bin"]: (r["mean_y"], r["standard_error"]) for r in explore.smoothed_means(df, "x", "y", 5.0).collect()}
    assert rows == {0: (5.0, None), 1: (2.0, 1.0)}


def test_bins_of_negative_values(spark):
    df = spark.createDataFrame([(-0.5, 0.5), (-1.0, 0.5)], "x double, y double")
    assert [tuple(r) for r in explore.scatter_bins(df, "x", "y", 1.0, 1.0).collect()] == [(-1, 0, 2)]


def test_correlation_of_lines(spark):
    df = spark.createDataFrame([(0, float(i), 2.0 * i, -float(i)) for i in range(5)], "label int, a double, b double, c double")
    got = {(r["column_a"], r["column_b"]): r["correlation"] for r in explore.pairwise_correlation(df, ["a", "b", "c"]).collect()}
    assert got == {("a", "b"): 1.0, ("a", "c"): -1.0, ("b", "c"): -1.0}


def test_correlation_keeps_its_digits_far_from_zero(spark):
    """Means near 1e9 with a spread of one, hot and small groups, a NULL group, a constant."""
    import numpy as np

    pick = np.random.default_rng(4)
    x = pick.normal(size=(3000, 3)) @ np.array([[1, 0.5, 0], [0, 1, 0.2], [0, 0, 1]]) + 1e9
    groups = [None if i % 100 == 7 else int(i % 3 == 0) for i in range(3000)]
    data = [(g, *map(float, r), 0.1) for g, r in zip(groups, x)] + [(0, None, 1.0, 1.0, 1.0), (1, float("nan"), 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(data, "label int, a double, b double, c double, d double").repartition(11)
    got = {(r["label"], r["column_a"], r["column_b"]): r["correlation"] for r in explore.pairwise_correlation(df, list("abcd"), digits=9).collect()}
    assert len(got) == 3 * 6
    for group in (0, 1, None):
        own = np.array([r for g, r in zip(groups, x) if g == group]) - 1e9
        want = np.corrcoef(own.T)
        for i, j in ((0, 1), (0, 2), (1, 2)):
            assert abs(got[group, "abc"[i], "abc"[j]] - want[i, j]) < 1e-6
        assert got[group, "a", "d"] is None


def test_correlation_of_nothing(spark):
    assert explore.pairwise_correlation(spark.createDataFrame([], "label int, a double, b double"), ["a", "b"]).count() == 0


def test_local_line_matches_a_weighted_fit(spark):
    import numpy as np

    pick = np.random.default_rng(8)
    x = pick.uniform(-7, 13, 500)
    y = 3 + 0.5 * x * x + pick.normal(size=500) + 1e6
    df = spark.createDataFrame([*map(tuple, np.stack([x, y], 1).tolist()), (None, 1.0), (2.0, None)], "x double, y double").repartition(7)
    got = {r["x_bin"]: r for r in explore.local_linear(df, "x", "y", 2.0, 2, 9).collect()}
    bins = np.floor(x / 2)
    assert set(got) == set(bins.astype(int).tolist())
    for b, row in got.items():
        w = np.clip(1 - (np.abs(bins - b) / 3) ** 3, 0, None) ** 3
        use = w > 0
        design = np.stack([np.ones(use.sum()), x[use] - (b + 0.5) * 2], 1)
        solved = np.linalg.inv(design.T @ (design * w[use, None]))
        fit = solved @ (design.T @ (w[use] * (y[use] - 1e6)))
        rest = (y[use] - 1e6) - design @ fit
        variance = (w[use] * rest**2).sum() / w.sum() * use.sum() / (use.sum() - 2)
        error = np.sqrt(variance * ((solved @ (design * w[use, None]).T)[0] ** 2).sum())
        assert row["n_rows"] == (bins == b).sum()
        assert abs(row["smooth_y"] - 1e6 - fit[0]) < 1e-5 and abs(row["standard_error"] - error) < 1e-5


def test_local_line_of_few_rows(spark):
    one = [tuple(r) for r in explore.local_linear(spark.createDataFrame([(1.0, 5.0)], "x double, y double"), "x", "y", 2.0).collect()]
    assert one == [(0, 1, 5.0, None)]
    same = spark.createDataFrame([(1.0, 5.0), (1.0, 7.0), (1.0, 9.0)], "x double, y double")
    row = explore.local_linear(same, "x", "y", 2.0).first()
    assert (row["n_rows"], row["smooth_y"]) == (3, 7.0) and row["standard_error"] > 0
    assert explore.local_linear(same.limit(0), "x", "y", 2.0).count() == 0
