import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlane.functions import features, scoring
from fraudlane.functions.features import FEATURES, feature_names
from fraudlane.sources import payload


def _votes(*fields):
    return scoring.vote_sql(*fields[:2])


@pytest.fixture(scope="module")
def requests(txn):
    return payload.build_requests(txn, 64)


def test_requests_hold_records_in_key_order(requests, txn):
    bodies = {r["request_id"]: json.loads(r["body"]) for r in requests.collect()}
    assert [len(bodies[i]["dataframe_records"]) for i in sorted(bodies)] == [64] * 15 + [40]
    first = bodies[0]["dataframe_records"][1]
    assert list(first) == feature_names("flattened")
    assert first["pca[3]"] == txn.where("id = 1").first()["pca3"]


def test_doubles_survive_the_trip(requests, txn):
    rows = payload.parse_requests(requests)
    back = rows.select((F.col("request_id") * 64 + F.col("position")).alias("id"), *FEATURES)
    assert back.exceptAll(txn.select("id", *FEATURES)).count() == 0 and back.count() == txn.count()


def test_responses_follow_the_request_order(requests, txn):
    expected = [r["p"] for r in txn.orderBy("id").select(scoring.vote_score().alias("p")).collect()]
    for respond in (
        payload.respond(requests, _votes),
        payload.respond_with_udf(requests, scoring.vote_udf()),
    ):
        got = [json.loads(r["response"]) for r in respond.orderBy("request_id").collect()]
        assert [p for g in got for p in g["predictions"]] == expected


def test_native_response_needs_no_shuffle(spark, requests, plan_of):
    stored = spark.createDataFrame(requests.limit(3).collect(), requests.schema)
    assert "Exchange" not in plan_of(payload.respond(stored, _votes), "simple")


def test_three_records_in_one_request(spark):
    """Shape of an answer: one list with one prediction for each record."""
    records = [dict.fromkeys(feature_names("flattened"), 0.0) for _ in range(3)]
    records[1].update({"pca[0]": 0.3, "pca[1]": 0.3})
    body = json.dumps({"dataframe_records": records})
    df = spark.createDataFrame([(1, body)], "request_id long, body string")
    assert payload.respond(df, _votes).first()["response"] == '{"predictions":[0,1,0]}'


def test_odd_bodies(spark):
    bodies = [
        (1, "not json"),
        (2, '{"dataframe_records":[]}'),
        (3, '{"something":1}'),
        (4, '{"dataframe_records":[{"pca[0]":0.5}]}'),
        (5, None),
    ]
    df = spark.createDataFrame(bodies, "request_id long, body string")
    for answers in (payload.respond(df, _votes), payload.respond_with_udf(df, scoring.vote_udf())):
        got = {r["request_id"]: r["response"] for r in answers.collect()}
        assert got == {1: None, 2: '{"predictions":[]}', 3: None, 4: '{"predictions":[0]}', 5: None}


def test_native_scoring_gets_every_feature(spark, requests):
    last = payload.respond(requests, lambda *fields: f"CAST({fields[27]} > 0 AS INT)")
    first = json.loads(requests.where("request_id = 0").first()["body"])["dataframe_records"]
    got = json.loads(last.where("request_id = 0").first()["response"])["predictions"]
    assert got == [int(r["pca[27]"] > 0) for r in first]


def test_requests_stay_small_under_one_hot_key(txn):
    hot = txn.withColumn("id", F.lit(1).cast("long"))
    counts = payload.build_requests(hot, 100).select(F.from_json("body", payload.request_schema()).alias("b"))
    assert counts.agg(F.max(F.size("b.dataframe_records"))).first()[0] == 100


def _checked(spark, *records):
    body = json.dumps({"dataframe_records": list(records)})
    df = spark.createDataFrame([(1, body)], "request_id long, body string")
    return df, json.loads(payload.respond_checked(df, SIGNATURE, _votes).first()["response"])


SIGNATURE = features.feature_signature()


def _record(**changes):
    record = dict.fromkeys(feature_names("flattened"), 0.3) | changes
    return {k: v for k, v in record.items() if v != "gone"}


def test_a_record_that_fits_is_answered_as_before(spark, requests):
    checked = payload.respond_checked(requests, SIGNATURE, _votes)
    assert checked.exceptAll(payload.respond(requests, _votes)).count() == 0 and checked.count() == requests.count()


@pytest.mark.parametrize(
    "changes, fault",
    [
        ({"pca[3]": "gone"}, "pca[3] is missing"),
        ({"pca[3]": None}, "pca[3] is null"),
        ({"pca[3]": "0.5"}, "pca[3] is string"),
        ({"pca[3]": True}, "pca[3] is boolean"),
        ({"pca[3]": [1]}, "pca[3] is array<bigint>"),
        ({"pca[0]": "gone", "pca[27]": None}, "pca[0] is missing, pca[27] is null"),
        ({"other": 1, "pca[3]": 1}, None),
        ({"pca[3]": 10**30}, None),
    ],
)
def test_faults_are_named_and_never_scored(spark, changes, fault):
    df, answer = _checked(spark, _record(), _record(**changes), _record())
    assert answer["predictions"] == [1, None if fault else 1, 1]
    assert answer.get("errors") == ([f"record 1: {fault}"] if fault else None)
    rows = {r["position"]: r["error"] for r in payload.check_records(df, SIGNATURE).collect()}
    assert rows == {0: None, 1: fault, 2: None}


def test_records_that_are_no_objects(spark):
    _, answer = _checked(spark, 7, None, _record())
    assert answer == {"predictions": [None, None, 1], "errors": ["record 0: is no object", "record 1: is no object"]}


def test_other_types_of_a_contract(spark):
    signature = features.signature_of(spark.createDataFrame([], "id long, name string, flag boolean, x float"))
    body = '{"dataframe_records":[{"id":5,"name":"a","flag":true,"x":1},{"id":5.5,"name":1,"flag":"true","x":2.5},{"x":1e400}]}'
    df = spark.createDataFrame([(1, body)], "request_id long, body string")
    rows = payload.check_records(df, signature).orderBy("position").collect()
    assert tuple(rows[0])[2:] == (5, "a", True, 1.0, None) and rows[0].asDict()["id"] == 5
    assert rows[1]["error"].startswith("id is decimal(2,1), name is bigint, flag is string")


def test_odd_bodies_under_a_contract(spark):
    bodies = [(1, "not json"), (2, '{"dataframe_records":[]}'), (3, '{"something":1}'), (4, '{"dataframe_records":5}'), (5, None)]
    df = spark.createDataFrame(bodies, "request_id long, body string")
    got = {r["request_id"]: r["response"] for r in payload.respond_checked(df, SIGNATURE, _votes).collect()}
    assert got == {1: None, 2: '{"predictions":[]}', 3: None, 4: None, 5: None}
    assert payload.check_records(df, SIGNATURE).count() == 0


def test_checked_response_needs_no_shuffle(spark, requests, plan_of):
    stored = spark.createDataFrame(requests.limit(3).collect(), requests.schema)
    assert "Exchange" not in plan_of(payload.respond_checked(stored, SIGNATURE, _votes), "simple")


def test_records_leave_their_request_before_python(spark, requests, plan_of):
    """A record that carried its whole request along would fill the disk: its size times its records."""
    stored = spark.createDataFrame(requests.limit(3).collect(), requests.schema)
    plan = plan_of(payload.respond_with_udf(stored, scoring.vote_udf()), "simple")
    opened = [line for line in plan.splitlines() if "Generate posexplode" in line]
    assert len(opened) == 1 and "_valid" in opened[0] and opened[0].count("_records") == 1


def test_only_values_that_are_scored_are_cast(spark, requests, plan_of):
    """Casting all 28 values of each record, scored or not, took much of the time."""
    stored = spark.createDataFrame(requests.limit(3).collect(), requests.schema)
    answers = payload.respond_checked(stored, features.feature_signature(), _votes)
    plan = answers._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("variant_get(") == 3


def test_contract_faults_of_odd_records(spark):
    """Values of other kinds, nested namesakes, and elements that are no objects."""
    fields = [("pca0", T.DoubleType()), ("pca1", T.IntegerType()), ("pca2", T.StringType())]
    contract = T.StructType([T.StructField(*field) for field in fields]).json()
    records = [
        '{"pca[0]":1,"pca[1]":2,"pca[2]":"a"}',
        '{"pca[2]":"a","pca[0]":1e30,"pca[1]":2.5,"other":{"pca[0]":true}}',
        '{"pca[0]":{"pca[0]":1},"pca[1]":"x","pca[2]":[1]}',
        '{"pca[0]":null,"pca[1]":99999999999}',
        "null",
        "[1]",
    ]
    body = '{"dataframe_records":[' + ",".join(records) + "]}"
    df = spark.createDataFrame([(1, body)], "request_id long, body string")
    rows = payload.check_records(df, contract).orderBy("position").collect()
    assert [tuple(r)[2:] for r in rows] == [
        (1.0, 2, "a", None),
        (1e30, 2, "a", None),
        (None, None, "[1]", "pca[0] is object<`pca[0]`: bigint>, pca[1] is string, pca[2] is array<bigint>"),
        (None, None, None, "pca[0] is null, pca[1] is bigint, pca[2] is missing"),
        (None, None, None, "is no object"),
        (None, None, None, "is no object"),
    ]
