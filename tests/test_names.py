import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fraudlane.functions.names import catalog_name, database_name


def named(spark, users):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(users)], "i int, u string")
    rows = df.select("i", database_name("u").alias("d"), catalog_name("u").alias("c")).orderBy("i")
    return [(r["d"], r["c"]) for r in rows.collect()]


@pytest.mark.parametrize(
    "user, database, catalog",
    [
        ("ann.lee@example.org", "ann_lee", "al_catalog"),
        ("ann.lee", "ann_lee", "al_catalog"),
        ("ann@lee@example.org", "ann_lee", "al_catalog"),
        ("ann--lee.x@example.org", "ann_lee_x", "al_catalog"),
        ("ann@example.org", "ann", "a_catalog"),
        ("@example.org", "_example_org", "e_catalog"),
        ("jörg.ünal@example.org", "jörg_ünal", "jü_catalog"),
        ("", "", "_catalog"),
        (None, None, None),
    ],
)
def test_names(spark, user, database, catalog):
    assert named(spark, [user]) == [(database, catalog)]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.sampled_from("ab1_.-@ é"), max_size=12), min_size=1, max_size=20))
def test_database_name_by_brute_force(spark, users):
    def expected(user):
        at = user.rfind("@")
        return re.sub(r"\W+", "_", user[:at] if at > 0 else user)

    assert [d for d, _ in named(spark, users)] == [expected(u) for u in users]
