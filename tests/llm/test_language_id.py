import numpy as np

from fraudlane.llm import language_id as li


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = li.language_of_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL")
    rows = got.collect()
    assert sum(r.lang == r.lang_pred for r in rows) > 0.97 * len(rows) > 0
    assert all(0 <= r.score <= 1 for r in rows)


def test_words_come_first_and_grams_get_shorter():
    vector = lambda a, b: np.log([a, b])
    tables = {0: {"known": vector(0.9, 0.1)}, 5: {"<abcd": vector(0.1, 0.9)}, 4: {}, 3: {"xyz": vector(0.8, 0.2)}, 2: {}, 1: {"q": vector(0.3, 0.7)}}
    scorer = li.Scorer(li.LanguageModel(["aa", "bb"], np.log([0.5, 0.5]), tables))
    assert [scorer.predict(t)[0] for t in ("Known!", "abcde", "wxyz", "q", "known q")] == ["aa", "bb", "aa", "bb", "aa"]
    assert scorer.predict("12 ² ...") == ("und", 0.0) == scorer.predict(None)
    assert scorer.predict("zz")[0] == "aa" and scorer.predict("zz")[1] == 0.5


def test_odd_rows(odd_docs, clashing, no_docs, rows_of):
    got = li.language_of_documents(odd_docs)
    by_id = {r.doc_id: r for r in got.collect()}
    assert got.count() == odd_docs.count()
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1, 2, 3))
    assert by_id[4].lang_pred in ("en", "de", "fr") and not by_id[None].held_out
    assert rows_of(li.language_of_documents(clashing)) == rows_of(got)
    assert li.language_of_documents(no_docs).count() == 0
    unlabelled = odd_docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {r.lang_pred for r in li.language_of_documents(unlabelled).collect()} == {"und"}
