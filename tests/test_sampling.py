import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fraudlane.functions.hashing import seeded_bucket
from fraudlane.operators import sampling

SHARES = {"train": 0.8, "test": 0.2}


def test_parts_are_disjoint_and_complete(txn):
    parts = sampling.split(txn, SHARES, 200)
    ids = {k: {r["id"] for r in df.select("id").collect()} for k, df in parts.items()}
    assert not ids["train"] & ids["test"]
    assert len(ids["train"] | ids["test"]) == txn.count()
    assert parts["train"].columns == txn.columns


def test_split_does_not_depend_on_partitioning(txn):
    once = sampling.with_part(txn, SHARES, 200).select("id", "part")
    again = sampling.with_part(txn.repartition(7), SHARES, 200).select("id", "part")
    assert once.exceptAll(again).count() == 0


def test_share_is_about_right(spark):
    ids = spark.range(20_000)
    share = sampling.with_part(ids, SHARES, 200).where("part = 'train'").count() / 20_000
    assert abs(share - 0.8) < 0.01


def test_three_parts(spark):
    parts = sampling.split(spark.range(5000), {"a": 0.5, "b": 0.3, "c": 0.2}, 1)
    assert sum(p.count() for p in parts.values()) == 5000 and parts["b"].count() > 1200


def test_shares_must_be_complete(txn):
    with pytest.raises(ValueError):
        sampling.with_part(txn, {"train": 0.8, "test": 0.1}, 1)


def test_seed_changes_the_split(txn):
    one, two = (sampling.with_part(txn, SHARES, s).select("id", "part") for s in (1, 2))
    assert one.exceptAll(two).count() > 0


def test_sample_repeats_and_is_exact(txn):
    one = sampling.random_rows(txn, 100, 7).select("id")
    two = sampling.random_rows(txn.repartition(5), 100, 7).select("id")
    assert one.count() == 100 and one.exceptAll(two).count() == 0


def test_sample_larger_than_the_table(txn):
    few = txn.where("id < 20")
    assert sampling.random_rows(few, 100, 7).count() == 20


def test_mixed_sample_keeps_rows_drawn_twice(txn):
    few = txn.where("label = 1")
    assert sampling.mixed_sample(few, 10, 10, 7).count() == 20
    assert sampling.mixed_sample(few, 10, 10, 7).select("id").distinct().count() == 10


def test_scoring_sample_ends_with_positives(txn):
    sample = sampling.scoring_sample(txn, 5, 5).collect()
    assert len(sample) == 10 and sum(r["label"] for r in sample) >= 5


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10**6), start=st.integers(-(10**12), 10**12))
def test_buckets_are_in_range_for_any_key(spark, seed, start):
    ids = spark.range(start, start + 50)
    low, high = ids.select(seeded_bucket("id", seed).alias("b")).agg(F.min("b"), F.max("b")).first()
    assert 0 <= low <= high < 10_000
