"""The fixed three-vote scorer, as a native column and as vectorised functions.

The native form stays inside whole-stage code generation and serves every plan that only needs
the rule. The vectorised forms show how a Python model is called from SQL or on a struct.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .features import FEATURES, quoted

# A vote is cast by each feature above its cut and by the sum above its own cut.
SINGLE_CUT = 0.2
SUM_CUT = 0.25
VOTES_NEEDED = 2
SQL_NAME = "cc_fraud_model"


def vote_sql(
    first: str = "pca0",
    second: str = "pca1",
    single_cut: float = SINGLE_CUT,
    sum_cut: float = SUM_CUT,
) -> str:
    """The rule over two SQL expressions: 0 or 1; a NULL feature never casts a vote."""
    conditions = (
        f"{first} > {single_cut}D",
        f"{second} > {single_cut}D",
        f"{first} + {second} > {sum_cut}D",
    )
    votes = " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for c in conditions)
    return f"CASE WHEN {votes} >= {VOTES_NEEDED} THEN 1 ELSE 0 END"


def vote_score(single_cut: float = SINGLE_CUT, sum_cut: float = SUM_CUT) -> Column:
    return F.expr(vote_sql(single_cut=single_cut, sum_cut=sum_cut))


def _vote_counter():
    """A function that travels to the executors whole, so they need not have this package."""

    def positive(a: pd.Series, b: pd.Series) -> pd.Series:
        votes = (a > SINGLE_CUT).astype("int32") + (b > SINGLE_CUT) + (a + b > SUM_CUT)
        return votes >= VOTES_NEEDED

    return positive


def vote_udf():
    """One argument per feature, in feature order."""
    positive = _vote_counter()

    def score(*features: pd.Series) -> pd.Series:
        return positive(features[0], features[1]).astype("int32")

    return F.pandas_udf(score, "int")


def vote_struct_udf():
    """One struct argument whose fields carry the silver names, result as double."""
    positive = _vote_counter()

    def score(features: pd.DataFrame) -> pd.Series:
        return positive(features["pca0"], features["pca1"]).astype("float64")

    return F.pandas_udf(score, "double")


def evaluate_once(udf):
    """Stop Catalyst from copying the call into a filter on its result.

    A deterministic function that is both selected and filtered on is planned twice, so every
    row would be sent to Python twice. Pushed below a projection that computes its arguments, the
    filter also makes the optimiser derive a constraint for each subset of the 28 arguments, and
    planning does not end. The price: conditions on other columns stay above the call as well, so
    they belong into the source of the call.
    """
    return udf.asNondeterministic()


def register_scorer(spark: SparkSession, udf=None, name: str = SQL_NAME) -> str:
    """Make a scorer callable from SQL, so that a view over it scores each row once."""
    spark.udf.register(name, evaluate_once(udf or vote_udf()))
    return name


def sql_call(function: str = SQL_NAME, names: list[str] | None = None) -> str:
    """The SQL text of a call over the feature columns."""
    return f"{function}({', '.join(f'`{n}`' for n in names or FEATURES)})"


def udf_call(udf, names: list[str] | None = None) -> Column:
    return udf(*[quoted(n) for n in names or FEATURES])
