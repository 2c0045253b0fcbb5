import collections
import re

import pytest
from pyspark.sql import functions as F

from fraudlane.llm import quality_rules as qr


def counts_of(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated))


def test_counts_match_brute_force(spark, sf_dir, odd_docs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").union(odd_docs.select("doc_id", "text"))
    docs = docs.withColumn("doc_id", F.monotonically_increasing_id())
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in qr.judge(docs, []).collect():
        want = counts_of(texts[r.doc_id])
        assert tuple(r)[1:6] == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and r.kept == (not r.base_failed)


def test_held_out_verdicts(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = qr.quality_rules(docs, labels).join(labels, "doc_id").where(qr.held_out()).where("NOT base_failed").collect()
    assert sum(r.kept == bool(r.quality) for r in rows) >= 0.95 * len(rows) > 0


def test_a_hidden_conjunction_is_found(spark):
    rows = spark.range(3000).select(
        *((F.rand(i) * 10).alias(s) if s != "n_words" else F.lit(100.0).alias(s) for i, s in enumerate(qr.STATISTICS)), "id"
    )
    bad = (F.col("symbol_share") > 7) & (F.col("upper_share") <= 4)
    rows = rows.withColumn("bad", bad.cast("int")).withColumn("grow", F.col("id") % 3 > 0)
    rules = qr.learn_rules(rows)
    wrong = rows.where((qr.verdict(rules).isNotNull()).cast("int") != F.col("bad")).count()
    assert rules and wrong < 60


@pytest.fixture(scope="module")
def some_labels(spark):
    return spark.createDataFrame([(4, 1), (6, 0), (8, None), (None, 1), (99, 0), (7, 1)], "doc_id long, quality int")


def test_odd_rows(odd_docs, clashing, no_docs, some_labels, rows_of):
    got = qr.quality_rules(odd_docs, some_labels)
    rows = got.collect()
    assert len(rows) == odd_docs.count() and all(not r.kept for r in rows if r.doc_id in (1, 2, 3, 8))
    assert rows_of(qr.quality_rules(clashing, some_labels)) == rows_of(got)
    assert qr.quality_rules(no_docs, some_labels).count() == 0
    assert qr.train(odd_docs, some_labels.limit(0)) == []


def test_no_python_in_the_plan(odd_docs, plan_of):
    plan = plan_of(qr.judge(odd_docs, [(qr.Condition("symbol_share", True, 0.1),)]), "simple")
    assert "Python" not in plan and "Arrow" not in plan
