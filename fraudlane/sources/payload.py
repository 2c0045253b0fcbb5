"""Scoring requests and responses as JSON columns.

``respond`` and ``respond_with_udf`` trust their requests. ``respond_checked`` holds every record against the input contract
of the model first: a field that is missing, null or of another kind is named in the answer, and its record gets no
prediction.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.features import FEATURE_COUNT, feature_names, quoted, rename_fields
from ..operators.numbering import with_batches

# The field names of a request and of a response.
RECORDS = "dataframe_records"
PREDICTIONS = "predictions"


def request_schema(style: str = "flattened", count: int = FEATURE_COUNT) -> T.StructType:
    record = T.StructType([T.StructField(n, T.DoubleType()) for n in feature_names(style, count)])
    return T.StructType([T.StructField(RECORDS, T.ArrayType(record))])


def build_requests(
    df: DataFrame, records_per_request: int = 100, key: str = "id", style: str = "flattened"
) -> DataFrame:
    """Requests of exactly ``records_per_request`` rows in key order, the last one of the rest."""
    fields = ", ".join(f"'{n}', {s}" for s, n in zip(feature_names(), feature_names(style)))
    placed = with_batches(
        df.select(key, *feature_names()), [key], records_per_request, "request_id", "_place"
    )
    rows = F.expr(f"array_sort(collect_list(struct(_place, named_struct({fields}) AS r)))")
    body = f"to_json(named_struct('{RECORDS}', transform(_rows, row -> row.r))) AS body"
    return placed.groupBy("request_id").agg(rows.alias("_rows")).selectExpr("request_id", body)


def bundle_records(
    df: DataFrame, record: Column, records_per_request: int = 100, key: str = "id"
) -> DataFrame:
    """Requests of records that are JSON already, whatever they hold, cut as by :func:`build_requests`."""
    placed = with_batches(
        df.select(key, record.alias("_record")), [key], records_per_request, "request_id", "_place"
    )
    rows = F.expr("array_sort(collect_list(struct(_place, _record AS r)))")
    body = f"concat('{{\"{RECORDS}\":[', array_join(transform(_rows, row -> row.r), ','), ']}}') AS body"
    return placed.groupBy("request_id").agg(rows.alias("_rows")).selectExpr("request_id", body)


def _records(style: str) -> Column:
    return F.from_json("body", request_schema(style)).getField(RECORDS)


def parse_requests(requests: DataFrame, style: str = "flattened") -> DataFrame:
    """One row for each record with its position in the request; a request without records has none."""
    rows = requests.select("request_id", F.posexplode(_records(style)).alias("position", "record"))
    return _spread(rows, style, "request_id", "position")


def _spread(rows: DataFrame, style: str, *keep: str) -> DataFrame:
    fields = [f"record.`{n}` AS {s}" for n, s in zip(feature_names(style), feature_names())]
    return rows.selectExpr(*keep, *fields)


def respond(
    requests: DataFrame, score_sql: Callable[..., str], style: str = "flattened"
) -> DataFrame:
    """One response for each request, predictions in request order.

    ``score_sql`` gets the SQL names of a record's features, all of them in order. Records are
    scored inside their array, so a request is never taken apart and nothing is shuffled. A body
    that is not a request gets a NULL response.
    """
    fields = [f"r.`{n}`" for n in feature_names(style)]
    predictions = f"transform(_records, r -> {score_sql(*fields)})"
    response = f"to_json(named_struct('{PREDICTIONS}', {predictions}))"
    return requests.withColumn("_records", _records(style)).selectExpr(
        "request_id", f"CASE WHEN _records IS NOT NULL THEN {response} END AS response"
    )


def respond_with_udf(requests: DataFrame, udf, style: str = "flattened") -> DataFrame:
    """As :func:`respond` for a vectorised Python model over all features.

    Records are regrouped by request, which bounds a group by the size of one request. A request
    without records keeps a row of its own, so each request is answered: ``[]`` for an empty list,
    NULL for a body that is not a request.
    """
    # Told before the records are taken apart: otherwise each of them would carry all of its request along.
    told = requests.select("request_id", _records(style).alias("_records")).withColumn("_valid", F.col("_records").isNotNull())
    opened = told.select("request_id", "_valid", F.posexplode_outer("_records").alias("position", "record"))
    scored = _spread(opened, style, "request_id", "_valid", "position").select(
        "request_id", "_valid", "position", udf(*[quoted(n) for n in feature_names()]).alias("p")
    )
    # collect_list passes over the NULL of a request without records.
    rows = F.expr("array_sort(collect_list(CASE WHEN position IS NOT NULL THEN struct(position, p) END))")
    grouped = scored.groupBy("request_id").agg(F.bool_or("_valid").alias("_valid"), rows.alias("_rows"))
    response = f"to_json(named_struct('{PREDICTIONS}', transform(_rows, row -> row.p)))"
    return grouped.selectExpr("request_id", f"CASE WHEN _valid THEN {response} END AS response")


# Kinds of JSON values that a column of a contract takes, by the type of the column: how their names begin.
_KINDS = {
    "double": ("DECIMAL", "DOUBLE", "FLOAT", "BIGINT"),
    "float": ("DECIMAL", "DOUBLE", "FLOAT", "BIGINT"),
    "bigint": ("BIGINT",),
    "string": ("STRING",),
    "boolean": ("BOOLEAN",),
}


def _contract(signature: str, style: str) -> list[tuple[str, str, str]]:
    """Of each column of a contract its name, its name in a record, and its type."""
    contract = T.StructType.fromJson(json.loads(signature))
    kinds = [f.dataType.simpleString() for f in contract.fields]
    return list(zip(contract.names, rename_fields(contract.names, style), kinds))


def _checked(columns: list[tuple[str, str, str]], wanted: list[str]) -> str:
    """For the fields ``r`` of a record, a struct of its ``wanted`` values and of what is wrong with any of its fields.

    Each field's kind is found once, and a value is cast only where it is wanted or its type is one that only the cast
    can judge: a cast of each value costs more than all else.
    """
    found, faults = [], ["CASE WHEN x.found IS NULL THEN 'is no object' END"]
    for i, (own, name, kind) in enumerate(columns):
        found.append(f"schema_of_variant(try_element_at(r, '{name}'))")
        # A value of these kinds always fits its type. Other types are what a cast from the JSON value gives.
        fits = " OR ".join(f"startswith(x.found[{i}], '{k}')" for k in _KINDS.get(kind, ()))
        other = f"NOT ({fits})" if fits else f"x.record.`{own}` IS NULL"
        faults.append(
            f"CASE WHEN x.found IS NULL THEN NULL "
            f"WHEN x.found[{i}] IS NULL THEN '{name} is missing' WHEN x.found[{i}] = 'VOID' THEN '{name} is null' "
            f"WHEN {other} THEN concat('{name} is ', lower(x.found[{i}])) END"
        )
    cast = [c for c in columns if c[0] in wanted or c[2] not in _KINDS] or columns[:1]
    values = ", ".join(f"try_variant_get(try_element_at(r, '{name}'), '$', '{kind}') AS `{own}`" for own, name, kind in cast)
    fault = f"nullif(array_join(array({', '.join(faults)}), ', '), '')"
    seen = f"array(named_struct('record', struct({values}), 'found', CASE WHEN r IS NOT NULL THEN array({', '.join(found)}) END))"
    return f"transform({seen}, x -> named_struct('record', x.record, 'fault', {fault}))[0]"


def _opened(requests: DataFrame, columns: list[tuple[str, str, str]], wanted: list[str]) -> DataFrame:
    """Records as structs of values and fault; one that is no object has no fields to look at."""
    records = F.try_variant_get(F.try_parse_json("body"), f"$.{RECORDS}", "array<map<string,variant>>")
    opened = requests.select("request_id", records.alias("_fields"))
    return opened.selectExpr("request_id", f"transform(_fields, r -> {_checked(columns, wanted)}) AS _records")


def check_records(requests: DataFrame, signature: str, style: str = "flattened") -> DataFrame:
    """One row for each record: request_id, position, the columns of the contract, and ``error``, null for a record that fits.

    ``signature`` is the stored contract of a model. Fields beyond it are left out, the order of fields is free.
    A body that is not a request has no rows.
    """
    columns = _contract(signature, style)
    names = [own for own, _, _ in columns]
    opened = _opened(requests, columns, names)
    rows = opened.select("request_id", F.posexplode("_records").alias("position", "r"))
    return rows.select("request_id", "position", *[F.col("r.record").getField(n).alias(n) for n in names], F.col("r.fault").alias("error"))


def respond_checked(
    requests: DataFrame, signature: str, score_sql: Callable[..., str], style: str = "flattened"
) -> DataFrame:
    """As :func:`respond` under the contract of a model: ``{"predictions":[..],"errors":[..]}``.

    A record that breaks the contract is never scored: its prediction is null, and ``errors`` names its place and what is
    wrong. ``errors`` is absent when there are none. A body that is not a request gets a NULL response. ``score_sql`` gets
    the SQL names of the contract's columns in order.
    """
    columns = _contract(signature, style)
    fields = {own: f"r.record.`{own}`" for own, _, _ in columns}
    score = score_sql(*fields.values())
    opened = _opened(requests, columns, [own for own, field in fields.items() if field in score])
    predictions = f"transform(_records, r -> CASE WHEN r.fault IS NULL THEN {score} END)"
    told = "transform(_records, (r, i) -> CASE WHEN r.fault IS NOT NULL THEN concat('record ', i, ': ', r.fault) END)"
    errors = f"CASE WHEN exists(_records, r -> r.fault IS NOT NULL) THEN array_compact({told}) END"
    response = f"to_json(named_struct('{PREDICTIONS}', {predictions}, 'errors', {errors}))"
    return opened.selectExpr("request_id", f"CASE WHEN _records IS NOT NULL THEN {response} END AS response")
