"""Rows to column arrays and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import quoted
from .numbering import with_batches


def _blocks(df: DataFrame, key: str, block_rows: int) -> DataFrame:
    """Rows gathered in key order, never more than ``block_rows`` of them in one group."""
    placed = with_batches(df, [key], block_rows, "block", "_place")
    fields = ", ".join(f"`{c}`" for c in df.columns)
    rows = F.expr(f"array_sort(collect_list(struct(_place, {fields})))")
    return placed.groupBy("block").agg(rows.alias("_rows"))


def rows_to_arrays(df: DataFrame, key: str = "id", block_rows: int = 1000) -> DataFrame:
    """One row for each block of keys with one array for each column, in key order."""
    arrays = [f"transform(_rows, r -> r.`{c}`) AS `{c}`" for c in df.columns]
    return _blocks(df, key, block_rows).selectExpr("block", *arrays)


def arrays_to_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """The inverse: element i of every array becomes row i."""
    zipped = F.arrays_zip(*[quoted(c) for c in columns])
    return df.select(F.inline(zipped))


def rows_to_literals(
    df: DataFrame, columns: list[str], key: str = "id", block_rows: int = 1000, digits: int = 6
) -> DataFrame:
    """One line for each block and column: the values as comma-separated text with fixed decimals."""
    blocks = _blocks(df.select(key, *[quoted(c) for c in columns]), key, block_rows)
    lines = ", ".join(
        f"'{c}', array_join(transform(_rows, r -> format_string('%.{digits}f', r.`{c}`)), ', ')"
        for c in columns
    )
    return blocks.selectExpr("block", f"stack({len(columns)}, {lines}) AS (column_name, literal)")
