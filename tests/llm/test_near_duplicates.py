import itertools
import random
import re

import numpy as np
import pytest

from fraudlane.llm import near_duplicates as nd
from fraudlane.llm import text_arrays as ta
from fraudlane.llm.linking import connected_components, hamming_lanes


def sets_of(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(rows, size, percent):
    sets = {i: sets_of(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if both and 100 * both >= percent * either:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def altered(text, share, seed):
    pick = random.Random(seed)
    return " ".join(f"new{seed}x{i}" if pick.random() < share else w for i, w in enumerate(text.split()))


def test_groups_of_copies_match_brute_force(docs_of, write_prose):
    """A group of drifting copies whose links form chains, exact copies, short texts and clean ones."""
    base = write_prose(3, 150)
    rows = [(i, altered(base, 0.004 * (i % 12), i)) for i in range(90)]
    rows += [(100 + i, base.upper() if i % 2 else base) for i in range(10)]
    rows += [(200 + i, write_prose(900 + i, 60)) for i in range(40)]
    rows += [(300, "one two"), (301, "One  two"), (302, "one"), (303, ""), (304, None), (305, "one two three")]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in nd.near_duplicates(docs_of(rows), 3, 85).collect()}
    assert got == brute(rows, 3, 85)
    assert sum(not x[2] for x in got.values()) > 60


def test_odd_rows(odd_docs, clashing, no_docs, rows_of):
    got = nd.near_duplicates(odd_docs)
    rows = got.collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].n_shingles == by_id[2].n_shingles == by_id[3].n_shingles == 0
    assert by_id[6].component_id == 5 and not by_id[6].kept
    assert all(r.kept and r.component_id == 5 for r in rows if r.doc_id == 5)
    assert rows_of(nd.near_duplicates(clashing)) == rows_of(got)
    assert nd.near_duplicates(no_docs).count() == 0
    left = nd.drop_near_duplicates(clashing)
    assert left.columns == clashing.columns and left.count() == odd_docs.count() - 2


def test_signatures_within_the_distance_share_a_key():
    pick = np.random.default_rng(1)
    a = pick.integers(0, 256, (300, nd.LANES), dtype=np.uint8)
    b = a.copy()
    for row in b:
        at = pick.choice(nd.LANES, nd.MAX_DISTANCE, replace=False)
        row[at] ^= pick.integers(1, 256, nd.MAX_DISTANCE, dtype=np.uint8)
    x, y = nd.chunk_keys(a), nd.chunk_keys(b)
    assert all(set(p) & set(q) for p, q in zip(x.tolist(), y.tolist(), strict=True))


def test_distance_of_signatures(spark):
    pick = np.random.default_rng(2)
    a, b = pick.integers(0, 3, (2, 50, 16), dtype=np.uint8)
    rows = [(x.view(np.int64).tolist(), y.view(np.int64).tolist(), int((x != y).sum())) for x, y in zip(a, b, strict=True)]
    df = spark.createDataFrame(rows, "a array<long>, b array<long>, far int")
    assert df.where(hamming_lanes(df.a, df.b, 2) != df.far).count() == 0


@pytest.mark.parametrize("links", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(7, 7), (3, 9), (9, 5), (5, 3), (20, 21)]])
def test_components(spark, links):
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {n: n for pair in links for n in pair}
    for _ in links:
        for a, b in links:
            want[a] = want[b] = min(want[a], want[b])
    assert got == {n: r for n, r in want.items() if n != r}


def test_one_row_of_each_component_stays(spark, docs_of, write_prose):
    same, near = write_prose(1, 200), write_prose(1, 200) + " more."
    rows = [(None, same), (None, same), (5, same), (5, same), (6, near), (None, write_prose(2, 90)), (None, write_prose(2, 90)), (7, ""), (7, ""), (8, None)]
    left = sorted((r.doc_id or -1, r.text or "") for r in nd.drop_near_duplicates(docs_of(rows)).collect())
    assert left == sorted([(5, same), (-1, write_prose(2, 90)), (7, ""), (7, ""), (8, "")])
    only = docs_of([(None, same), (None, near), (None, same)])
    assert nd.drop_near_duplicates(only).count() == 1


def thue_morse(steps, a, b):
    for _ in range(steps):
        a, b = a + b, b + a
    return a, b


def test_texts_that_collide_under_polynomials_stay_apart(docs_of):
    """Words, and sequences of words, that no odd base tells apart modulo 2**64."""
    letters = thue_morse(11, "a", "b")
    words = [" ".join(x) for x in thue_morse(11, ["left"], ["right"])]
    rows = list(enumerate([*letters, *words, letters[0]], 1))
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in nd.near_duplicates(docs_of(rows), 3, 85).collect()}
    assert [got[i][0] for i in (1, 2, 5)] == [1, 2, 1] and got[1][1] == 1
    # The sets of the two word sequences are equal, so these two are linked, by their sets.
    assert got[3] == got[4] and got[3][0] == 3


def test_sequence_hashes_follow_the_words():
    texts = ["a b  c", " a\tb c ", "ab c", "", "a bc", "A b c"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    words = ta.find_words(np.frombuffer(b"".join(raw), np.uint8), offsets, ta.NOT_SPACE, lower=True)
    h = nd.sequence_hashes(words).tolist()
    assert h[0] == h[1] == h[5] and len(set(h)) == 4
