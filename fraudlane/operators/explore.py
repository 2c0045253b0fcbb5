"""Summaries that stand in for plots: only aggregates leave the executors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import materialise

# Groups a task holds before it passes their moments on.
_GROUPS = 256


def in_closed_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.where(F.col(column).between(low, high))


def _bin(column: str, width: float) -> Column:
    return F.floor(F.col(column) / F.lit(float(width))).cast("bigint")


def smoothed_means(df: DataFrame, x: str, y: str, width: float, digits: int = 4) -> DataFrame:
    """Mean of ``y`` in each bin of ``x`` with the standard error as its band."""
    per_bin = df.groupBy(_bin(x, width).alias("x_bin")).agg(
        F.count(y).alias("n_rows"),
        F.avg(y).alias("mean"),
        F.stddev_samp(y).alias("spread"),
    )
    error = F.col("spread") / F.sqrt(F.col("n_rows").cast("double"))
    return per_bin.select(
        "x_bin",
        "n_rows",
        F.round("mean", digits).alias("mean_y"),
        F.round(error, digits).alias("standard_error"),
    )


def local_linear(
    df: DataFrame, x: str, y: str, width: float, reach: int = 2, digits: int = 4
) -> DataFrame:
    """A smooth curve of ``y`` over ``x``: at the middle of each bin a straight line fitted to the bins around it.

    Bins up to ``reach`` away count with a weight that falls with their distance (tricube). A bin is six sums around its
    own middle, merged before the shuffle; moving these to a neighbour's middle is arithmetic, so rows are read once
    and only bins meet. ``standard_error`` is that of the fitted value, from the weighted residuals with two degrees of
    freedom taken by the line. Where all rows around have one ``x`` the curve is their mean; with two rows or fewer there is no
    error. Rows with a NULL on either side are left out; only bins with rows of their own are answered.
    """
    middle = f"(x_bin + 0.5D) * {float(width)}D"
    known = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), _bin(x, width).alias("x_bin")
    )
    # Sums of squares around the mean of all keep their digits.
    level = known.agg(F.avg("y")).scalar()
    placed = known.select("x_bin", F.expr(f"x - {middle}").alias("u"), (F.col("y") - level).alias("v"))
    sums = {"n": "count(1)", "u": "sum(u)", "uu": "sum(u * u)", "v": "sum(v)", "uv": "sum(u * v)", "vv": "sum(v * v)"}
    bins = placed.groupBy("x_bin").agg(*[F.expr(f"{e} AS {c}") for c, e in sums.items()])
    near = bins.selectExpr("*", f"explode(sequence(x_bin - {reach}, x_bin + {reach})) AS at")
    moved = near.selectExpr(
        "at",
        "at = x_bin AS own",
        "n",
        f"pow(1 - pow(abs(x_bin - at) / {reach + 1}D, 3), 3) AS w",
        f"(x_bin - at) * {float(width)}D AS d",
        "u", "uu", "v", "uv", "vv",
    )
    merged = moved.groupBy("at").agg(
        *[
            F.expr(f"sum({e}) AS {c}")
            for c, e in {
                "rows": "CASE WHEN own THEN n END",
                "m": "n",
                "s0": "w * n",
                "s1": "w * (u + n * d)",
                "s2": "w * (uu + 2 * d * u + n * d * d)",
                "t0": "w * v",
                "t1": "w * (uv + d * v)",
                "q": "w * vv",
                "w0": "w * w * n",
                "w1": "w * w * (u + n * d)",
                "w2": "w * w * (uu + 2 * d * u + n * d * d)",
            }.items()
        ]
    ).where("rows IS NOT NULL")
    flat = f"s0 * s2 - s1 * s1 <= 1e-12D * s0 * s0 * {float(width) ** 2}D"
    fitted = merged.selectExpr(
        "*", f"{flat} AS flat", f"CASE WHEN NOT {flat} THEN (s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1) ELSE t0 / s0 END AS b0",
        f"CASE WHEN NOT {flat} THEN (s0 * t1 - s1 * t0) / (s0 * s2 - s1 * s1) ELSE 0D END AS b1",
    )
    spread = fitted.selectExpr(
        "*",
        "CASE WHEN m > 2 THEN greatest(q - b0 * t0 - b1 * t1, 0D) / s0 * m / (m - 2) END AS variance",
        "CASE WHEN NOT flat THEN (s2 * s2 * w0 - 2 * s1 * s2 * w1 + s1 * s1 * w2) / pow(s0 * s2 - s1 * s1, 2) ELSE w0 / (s0 * s0) END AS lever",
    )
    return spread.select(
        F.col("at").alias("x_bin"),
        F.col("rows").alias("n_rows"),
        F.round(F.col("b0") + level, digits).alias("smooth_y"),
        F.round(F.sqrt(F.col("variance") * F.col("lever")), digits).alias("standard_error"),
    )


def scatter_bins(df: DataFrame, x: str, y: str, x_width: float, y_width: float) -> DataFrame:
    bins = [_bin(x, x_width).alias("x_bin"), _bin(y, y_width).alias("y_bin")]
    return df.groupBy(*bins).agg(F.count(F.lit(1)).alias("n_rows"))


def _block_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(group, n, mean, gram) of the rows of a task: products are centred in each block and blocks merged by Chan's rule."""
    held: dict = {}

    def told() -> pa.RecordBatch:
        found = list(held.items())
        upper = None if not found else np.triu_indices(len(found[0][1][1]))
        columns = [
            pa.array([g for g, _ in found], kind),
            pa.array([n for _, (n, _, _) in found], pa.int64()),
            pa.array([mean for _, (_, mean, _) in found], pa.list_(pa.float64())),
            pa.array([gram[upper] for _, (_, _, gram) in found], pa.list_(pa.float64())),
        ]
        held.clear()
        return pa.RecordBatch.from_arrays(columns, ["group", "n", "mean", "gram"])

    kind = None
    for batch in batches:
        if not batch.num_rows:
            continue
        kind = batch.column(0).type
        rows = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        coded = batch.column(0).dictionary_encode(null_encoding="encode")
        codes = coded.indices.to_numpy(zero_copy_only=False)
        for code, group in enumerate(coded.dictionary.to_pylist()):
            block = rows[codes == code]
            n, mean = len(block), block.mean(axis=0)
            gram = (block - mean).T @ (block - mean)
            if group in held:
                n0, mean0, gram0 = held[group]
                apart = mean - mean0
                gram = gram0 + gram + np.outer(apart, apart) * (n0 * n / (n0 + n))
                mean = mean0 + apart * (n / (n0 + n))
                n += n0
            held[group] = (n, mean, gram)
        if len(held) > _GROUPS:
            yield told()
    if held:
        yield told()


def moments(df: DataFrame, columns: list[str], by: str) -> DataFrame:
    """``by``, n, mean and gram of each group: the centred products of every pair of columns, in the order of the upper triangle.

    Tasks give the moments of their blocks; these are merged around the mean of the group, so nothing is ever subtracted from
    a sum of squares, and a mean that is large against the spread costs no digits. Rows with a NULL or a NaN in any
    of the columns are left out.
    """
    usable = " AND ".join(f"`{c}` IS NOT NULL AND NOT isnan(`{c}`)" for c in columns)
    values = ", ".join(f"CAST(`{c}` AS DOUBLE)" for c in columns)
    packed = df.where(usable).selectExpr(f"`{by}` AS `group`", f"array({values}) AS x")
    made = packed.select("group").schema.add("n", T.LongType())
    for name in ("mean", "gram"):
        made = made.add(name, T.ArrayType(T.DoubleType()))
    blocks = materialise(packed.mapInArrow(_block_moments, made), "block_moments")
    # A mean of means is off by its last digits only; the products then take what each block's mean is off from it.
    shares = [F.sum(F.col("n") * F.get("mean", F.lit(i))) / F.sum("n") for i in range(len(columns))]
    whole = blocks.groupBy(F.col("group").alias("g")).agg(F.sum("n").alias("total"), F.array(*shares).alias("centre"))
    joined = blocks.join(whole, F.col("group").eqNullSafe(F.col("g")))
    off = joined.withColumn("off", F.zip_with("mean", "centre", lambda m, c: m - c))
    each = off.select("group", "total", "centre", "n", "off", F.posexplode("gram").alias("pair", "own"))
    left, right = (F.get("off", _member(len(columns), side)) for side in (0, 1))
    summed = each.groupBy("group", "total", "centre", "pair").agg(F.sum(F.col("own") + F.col("n") * left * right).alias("sum"))
    # One entry for each pair of columns, whatever the rows are.
    listed = F.array_sort(F.collect_list(F.struct("pair", "sum")))
    merged = summed.groupBy("group", "total", "centre").agg(F.transform(listed, lambda x: x["sum"]).alias("gram"))
    return merged.select(F.col("group").alias(by), F.col("total").alias("n"), F.col("centre").alias("mean"), "gram")


def _member(n_columns: int, side: int) -> Column:
    """The first or second column of ``pair``, a place in the upper triangle."""
    return F.get(F.lit([int(x) for x in np.triu_indices(n_columns)[side]]), F.col("pair"))


def pairwise_correlation(
    df: DataFrame, columns: list[str], by: str = "label", digits: int = 6
) -> DataFrame:
    """Correlation of each pair of columns in each group, from one Gram matrix for each group (:func:`moments`).

    A pair with a constant column has no correlation.
    """
    size, names = len(columns), F.lit(columns)
    diagonal = F.lit([i * size - i * (i - 1) // 2 for i in range(size)])
    # What rounding leaves of the spread of a constant.
    rest = lambda i: F.lit(1e-28) * F.col("n") * F.get("mean", i) * F.get("mean", i)
    spread = lambda i: F.when(F.get("gram", F.get(diagonal, i)) > rest(i), F.get("gram", F.get(diagonal, i)))
    first, second = _member(size, 0), _member(size, 1)
    pairs = moments(df, columns, by).select("*", F.posexplode("gram").alias("pair", "sum")).where(first < second)
    return pairs.select(
        by,
        F.get(names, first).alias("column_a"),
        F.get(names, second).alias("column_b"),
        F.round(F.col("sum") / (F.sqrt(spread(first)) * F.sqrt(spread(second))), digits).alias("correlation"),
    )
