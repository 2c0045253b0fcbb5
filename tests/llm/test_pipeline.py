"""The stages one after another, and the registered queries against their SQL."""

import math

import pytest

import corpus_pipeline
from fraudlane.llm.catalog import llm_oracles, llm_queries
from fraudlane.scratch import materialise


def test_stages_on_given_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    given = {r.doc_id: r.text for r in docs.collect()}
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name != "mixing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    assert all(b <= a for a, b in zip([given.keys(), *kept], kept))
    good = {i for i, q in quality.items() if q == 1}
    assert len(good - kept[0]) <= 0.03 * len(good)
    assert len([i for i, q in quality.items() if q == 0 and i in kept[0]]) <= 2
    first = {}
    for i in sorted(kept[0]):
        first.setdefault(given[i], i)
    assert not [i for i in kept[2] if first[given[i]] != i], "an exact copy is left"
    rows = docs.collect()
    assert len(rows) == len({(r.doc_id, r.copy) for r in rows}) and len(rows) > len(kept[3])
    again = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, again.select("doc_id", "copy", "shard").collect())) == sorted((r.doc_id, r.copy, r.shard) for r in rows)


def test_odd_rows(spark, odd_docs, no_docs, tmp_path):
    spark.createDataFrame([(7, 1, 0), (6, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing like it here at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (odd_docs, no_docs):
        docs = docs.selectExpr("*", "1 AS node", "2 AS crf_score", "3 AS shard")
        for name, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, str(tmp_path)), name)
        assert docs.count() == 0 or {5, 7} <= {r.doc_id for r in docs.collect()}


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_matches_oracle(name, spark, sf_dir, duck):
    got, want = llm_queries()[name](spark, sf_dir), duck.sql(llm_oracles()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    key = lambda row: tuple((x is None, x) for x in row)
    rows = sorted(map(tuple, got.select(columns).collect()), key=key)
    expected = sorted(want.project(", ".join(columns)).fetchall(), key=key)
    assert len(rows) == len(expected)
    for mine, theirs in zip(rows, expected, strict=True):
        assert all(a == b or isinstance(a, float) and math.isclose(a, b, rel_tol=1e-12) for a, b in zip(mine, theirs, strict=True))


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in llm_queries()] == [f"op{i}" for i in range(1, 11)]
