import itertools

import numpy as np
import pyarrow as pa
import pytest

from fraudlane.llm import quality_crf as crf


def test_messages_give_the_marginals_of_all_labelings():
    pick = np.random.default_rng(4)
    bounds = np.array([0, 5, 6, 9])
    odds, pairs = pick.normal(size=9), pick.normal(size=(2, 2))
    got = 1 / (1 + np.exp(-sum(crf.messages(odds, bounds, pairs))))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        total, good = 0.0, np.zeros(b - a)
        for labels in itertools.product((0, 1), repeat=b - a):
            score = np.dot(labels, odds[a:b]) + sum(pairs[i, j] for i, j in itertools.pairwise(labels))
            total += np.exp(score)
            good += np.exp(score) * np.array(labels)
        assert np.allclose(got[a:b], good / total)


def test_scores_do_not_depend_on_the_batch(write_prose):
    texts = [write_prose(i, 20 + 7 * i) for i in range(20)] + ["", None, "\n\n", "A!!! B### C$$$"]
    own, _, bounds = crf.line_features(pa.array(texts, pa.string()))
    chain = crf.fit_chain(own, bounds, np.array([1] * 20 + [0] * 4))
    whole = crf.document_scores(chain, pa.array(texts, pa.string()))
    single = [crf.document_scores(chain, pa.array([t], pa.string()))[0] for t in texts]
    assert np.allclose(whole, single) and (0 <= whole).all() and (whole <= 1).all()


def test_held_out_accuracy(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = crf.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows) > 0


@pytest.fixture(scope="module")
def some_labels(spark):
    return spark.createDataFrame([(4, 1, 0), (6, 0, 0), (6, 1, 0), (8, None, 1), (None, 1, 0), (99, 0, 0), (7, 1, 1)], "doc_id long, quality int, toxic int")


def test_odd_rows(odd_docs, clashing, no_docs, some_labels, rows_of):
    got = crf.quality_scores(odd_docs, some_labels)
    rows = got.collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert rows_of(crf.quality_scores(clashing, some_labels)) == rows_of(got)
    assert crf.quality_scores(no_docs, some_labels).count() == 0
    assert {r.score for r in crf.quality_scores(odd_docs, some_labels.limit(0)).collect()} == {0.5}
