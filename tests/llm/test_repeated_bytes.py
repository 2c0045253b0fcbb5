import random
from collections import Counter

import numpy as np
import pytest

from fraudlane.llm import repeated_bytes as rb


def brute(texts, span):
    """(kept bytes, number of removed runs) of each text."""
    raw = [(t or "").encode() for t in texts]
    counts = Counter(r[p : p + span] for r in raw for p in range(len(r) - span + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r) + 1, dtype=bool)
        for p in range(len(r) - span + 1):
            if counts[r[p : p + span]] > 1:
                gone[p : p + span] = True
        runs = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if r else 0
        out.append((bytes(b for b, g in zip(r, gone) if not g), runs))
    return out


def check(docs_of, texts, span, gram, widths, parts=5):
    docs = docs_of(list(enumerate(texts))).repartition(parts)
    got = {r.doc_id: r for r in rb.remove_repeated_bytes(docs, span, gram, widths).collect()}
    for i, (kept, runs) in enumerate(brute(texts, span)):
        n = len((texts[i] or "").encode())
        assert (bytes(got[i].kept), got[i].n_spans, got[i].n_bytes, got[i].n_removed) == (kept, runs, n, n - len(kept))


def copies(seed, n, length, alphabet):
    """Texts that share altered pieces of one another."""
    pick = random.Random(seed)
    texts = []
    for _ in range(n):
        text = "".join(pick.choice(alphabet) for _ in range(pick.randint(0, length)))
        for _ in range(pick.randint(0, 3)):
            if texts:
                source = pick.choice(texts)
                a = pick.randint(0, len(source))
                piece = list(source[a : a + pick.randint(0, length)])
                for _ in range(pick.randint(0, 2)):
                    if piece:
                        piece[pick.randrange(len(piece))] = pick.choice(alphabet)
                at = pick.randint(0, len(text))
                text = text[:at] + "".join(piece) + text[at:]
        texts.append(text)
    return texts


@pytest.mark.parametrize("seed,alphabet", [(1, "ab"), (2, "abcdefgh"), (3, "aé漢")])
def test_equals_brute_force_on_short_spans(docs_of, seed, alphabet):
    check(docs_of, copies(seed, 150, 60, alphabet), 16, 5, (6, 2, 1))


def test_equals_brute_force_on_prose(docs_of, write_prose):
    base = [write_prose(i, 150, 90) for i in range(12)]
    texts = copies(7, 40, 900, "abcdefghij ") + base
    pick = random.Random(5)
    for i in range(60):
        words = base[i % 12].split(" ")
        words[pick.randrange(len(words))] = f"other{i}"
        texts.append(" ".join(words[pick.randrange(20) :]))
    texts += [base[0]] * 4 + ["-" * 1500, "x" + "-" * 700, "ab" * 600, None, "", "short"]
    check(docs_of, texts, rb.SPAN, rb.GRAM, rb.WIDTHS)


def test_places_of_a_long_text_are_all_owned_once():
    pick = np.random.default_rng(3)
    sizes = [rb._BLOCK + 500, 0, 199, 200, 201, 40_000]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    buffer = pick.integers(0, 4, int(offsets[-1]), dtype=np.uint8)
    first, last, anchor = rb.find_anchors(buffer, offsets, 200, 40)
    places = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)])
    want = np.concatenate([np.arange(a, max(a, b - 199)) for a, b in zip(offsets[:-1], offsets[1:])])
    assert np.array_equal(np.sort(places), want)
    assert ((anchor >= last) & (anchor <= first + 160)).all()
    assert len(anchor) < len(buffer) / 60


def test_repeated_rows_and_ids(docs_of, write_prose):
    same, other = write_prose(1, 100), write_prose(2, 100)
    rows = [(1, same), (1, same), (2, other), (2, write_prose(3, 100)), (None, write_prose(4, 100)), (None, None)]
    got = sorted((r.doc_id or -1, r.n_removed) for r in rb.remove_repeated_bytes(docs_of(rows)).collect())
    n = len(same.encode())
    assert got == [(-1, 0), (-1, 0), (1, n), (1, n), (2, 0), (2, 0)]


def test_odd_rows(odd_docs, clashing, no_docs, rows_of):
    got = rb.remove_repeated_bytes(odd_docs)
    assert got.count() == odd_docs.count()
    assert rows_of(rb.remove_repeated_bytes(clashing)) == rows_of(got)
    assert rb.remove_repeated_bytes(no_docs).count() == 0
    by_id = {r.doc_id: r for r in got.collect() if r.doc_id is not None}
    assert by_id[6].n_removed == by_id[6].n_bytes == by_id[5].n_removed and by_id[4].n_spans == 0
