"""Feature columns: naming in each stage, flattening, packing and the scoring contract."""

from __future__ import annotations

import json
import re

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The width of the feature vector and the name of one feature in each stage.
FEATURE_COUNT = 28
NAME_STYLES = {
    "flattened": "pca[{}]",
    "warehouse": "pca_{}_",
    "silver": "pca{}",
}

_ANY_STYLE = re.compile(r"^pca(?:\[(\d+)\]|_(\d+)_|(\d+))$")


def feature_names(style: str = "silver", count: int = FEATURE_COUNT) -> list[str]:
    return [NAME_STYLES[style].format(i) for i in range(count)]


FEATURES = feature_names()


def quoted(name: str) -> Column:
    """A column whose name may hold brackets or dots."""
    return F.col(f"`{name}`")


def rename_fields(names: list[str], style: str) -> list[str]:
    """Feature names of any style in ``style``; other names as they are."""
    renamed = []
    for name in names:
        match = _ANY_STYLE.match(name)
        position = match and next(group for group in match.groups() if group is not None)
        renamed.append(NAME_STYLES[style].format(position) if match else name)
    return renamed


def rename_features(df: DataFrame, style: str) -> DataFrame:
    """Rename feature columns of any style to ``style``; other columns keep their names."""
    return df.withColumnsRenamed(dict(zip(df.columns, rename_fields(df.columns, style))))


def feature_signature() -> str:
    """The contract of the features alone, as doubles."""
    return T.StructType([T.StructField(name, T.DoubleType()) for name in FEATURES]).json()


def pack_vector(df: DataFrame, name: str = "pcaVector") -> DataFrame:
    """Replace the silver feature columns by one vector column."""
    others = [c for c in df.columns if c not in FEATURES]
    return df.select(*others, array_to_vector(F.array(*FEATURES)).alias(name))


def flatten_vector(
    df: DataFrame, vector: str = "pcaVector", style: str = "flattened", count: int = FEATURE_COUNT
) -> DataFrame:
    """Spread a vector column over scalar columns, behind the remaining columns."""
    others = [f"`{c}`" for c in df.columns if c != vector]
    spread = [f"_values[{i}] AS `{name}`" for i, name in enumerate(feature_names(style, count))]
    return df.withColumn("_values", vector_to_array(quoted(vector))).selectExpr(*others, *spread)


def feature_struct(names: list[str] | None = None, alias: str = "features") -> Column:
    packed = ", ".join(f"`{n}`" for n in names or FEATURES)
    return F.expr(f"struct({packed})").alias(alias)


def columns_between(df: DataFrame, start: int | None, stop: int | None = None) -> DataFrame:
    """Columns by position, ``stop`` excluded."""
    return df.select(*[f"`{c}`" for c in df.columns[start:stop]])


def features_and_label(df: DataFrame, label: str = "label", keep: tuple[str, ...] = ("id",)):
    """The feature frame and the label frame; ``keep`` stays in both so that they can be aligned."""
    return df.select(*keep, *FEATURES), df.select(*keep, label)


def signature_of(df: DataFrame) -> str:
    """The input contract of a frame, as text that can be stored beside a model."""
    fields = [T.StructField(f.name, f.dataType, True) for f in df.schema.fields]
    return T.StructType(fields).json()


def apply_signature(df: DataFrame, signature: str) -> DataFrame:
    """Reorder by name, cast, and drop what the contract does not name.

    A column that the contract names and the frame lacks is an error: no model may guess it.
    """
    wanted = T.StructType.fromJson(json.loads(signature))
    missing = [f.name for f in wanted.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"input lacks columns of the model signature: {', '.join(missing)}")
    return df.selectExpr(
        *[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in wanted.fields]
    )
