import json

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from fraudlane.functions import features as feat


def test_names_of_each_style():
    assert feat.feature_names("flattened")[:2] == ["pca[0]", "pca[1]"]
    assert feat.feature_names("warehouse")[27] == "pca_27_"
    assert feat.FEATURES[-1] == "pca27" and len(feat.FEATURES) == 28


@pytest.mark.parametrize("first", feat.NAME_STYLES)
@pytest.mark.parametrize("second", feat.NAME_STYLES)
def test_any_style_renames_to_any_other(txn, first, second):
    renamed = feat.rename_features(feat.rename_features(txn, first), second)
    assert renamed.columns == ["id", "time", "amountRange", *feat.feature_names(second), "label"]


def test_other_columns_that_look_alike_keep_their_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "pca int, pcax1 int, pca1 int")
    assert feat.rename_features(df, "warehouse").columns == ["pca", "pcax1", "pca_1_"]


def test_pack_and_flatten_are_inverse(txn):
    flat = feat.flatten_vector(feat.pack_vector(txn), style="silver").select(txn.columns)
    assert flat.exceptAll(txn).count() == 0 and flat.count() == txn.count()


def test_flattened_columns_follow_the_others(spark):
    df = spark.createDataFrame([([1.0, 2.0], 5)], "a array<double>, time int")
    vector = df.select(array_to_vector("a").alias("pcaVector"), "time")
    assert feat.flatten_vector(vector, count=2).first().asDict() == {"time": 5, "pca[0]": 1.0, "pca[1]": 2.0}


def test_columns_between_excludes_the_end(txn):
    assert feat.columns_between(txn, 1, 3).columns == ["time", "amountRange"]


def test_features_and_label_can_be_aligned(txn):
    x, y = feat.features_and_label(txn)
    assert x.columns == ["id", *feat.FEATURES] and y.columns == ["id", "label"]


@pytest.fixture
def signature(txn):
    return feat.signature_of(txn.select("id", "pca0", "pca1"))


def test_contract_reorders_casts_and_drops(spark, signature):
    given = spark.createDataFrame([("x", 0.5, "0.25", 7)], "extra string, pca1 double, pca0 string, id int")
    got = feat.apply_signature(given, signature)
    assert got.dtypes == [("id", "bigint"), ("pca0", "double"), ("pca1", "double")]
    assert tuple(got.first()) == (7, 0.25, 0.5)


def test_contract_names_the_missing_column(spark, signature):
    with pytest.raises(ValueError, match="pca1"):
        feat.apply_signature(spark.createDataFrame([(1, 0.5)], "id long, pca0 double"), signature)


def test_contract_accepts_null_features(spark, signature):
    given = spark.createDataFrame([(1, None, 0.5)], "id long, pca0 double, pca1 double")
    assert feat.apply_signature(given, signature).where(F.col("pca0").isNull()).count() == 1


def test_signature_is_text(signature):
    assert [f["name"] for f in json.loads(signature)["fields"]] == ["id", "pca0", "pca1"]
