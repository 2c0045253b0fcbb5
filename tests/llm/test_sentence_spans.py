from fraudlane.llm.sentence_spans import remove_repeated_passages


def test_a_passage_stays_once_and_only_there(docs_of, write_prose):
    passage = write_prose(77, 60, 300)
    texts = {i: write_prose(100 + i, 90) for i in range(6)}
    rows = [(i, f"{t}\n{passage}\n{write_prose(200 + i, 30)}" if i in (1, 3, 4) else t) for i, t in texts.items()]
    rows.append((9, f"Own start here. {texts[5]}"))
    got = {r.doc_id: r for r in remove_repeated_passages(docs_of(rows)).collect()}
    given = dict(rows)
    assert {i for i, r in got.items() if r.n_removed} == {3, 4, 9}
    assert all(got[i].text == given[i] for i in (0, 1, 2, 5))
    for i in (3, 4):
        assert passage[20:-20] not in got[i].text and got[i].text.startswith(texts[i])
    assert got[9].text.startswith("Own start here.") and len(got[9].text) < 120


def test_repeats_inside_a_document(docs_of):
    run = "One two three four five six seven. Eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen. "
    got = remove_repeated_passages(docs_of([(1, run * 3 + "End of it."), (2, "Short. Text. Short. Text.")])).collect()
    texts = {r.doc_id: r.text for r in got}
    assert texts == {1: run + "End of it.", 2: "Short. Text. Short. Text."}


def test_odd_rows(odd_docs, clashing, no_docs, rows_of):
    got = remove_repeated_passages(odd_docs)
    rows = got.collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].text is None and by_id[1].n_sentences == 0 and by_id[3].text == " \t\n\x0b\f\r \n"
    assert by_id[6].n_removed == by_id[6].n_sentences > 0 and by_id[6].text == ""
    assert all(not r.n_removed for r in rows if r.doc_id == 5)
    assert by_id[4].n_removed == 0 and by_id[None].n_removed == 0
    assert rows_of(remove_repeated_passages(clashing)) == rows_of(got)
    assert remove_repeated_passages(no_docs).count() == 0
