import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from fraudlane.llm import importance as im
from fraudlane.llm import text_arrays as ta


def features(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def brute(docs, target, percent=25, min_words=20):
    """doc_id: (n_features, weight, score, rank), for unique ids."""
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = [0] * 10_000, [0] * 10_000
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for f in features(text)[1]:
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10_000) / ((a + 1) * (sum(t) + 10_000)))) for a, b in zip(s, t)]
    rows = {}
    for i, text in docs:
        words, own = features(text)
        weight = sum(gain[bucket(f)] for f in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        rows[i] = (len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words))
    able = sorted((-r[2], i) for i, r in rows.items() if r[3] >= min_words)
    rank = {i: n for n, (_, i) in enumerate(able[: percent * len(able) // 100], 1)}
    return {i: (*r[:3], rank.get(i)) for i, r in rows.items()}


def answer(df):
    return {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()}


def test_crc_of_words_of_any_length():
    texts = ["", "a", "été", "x" * 64, "y" * 65, "z" * 5000, "ab"]
    raw = [t.encode() for t in texts]
    ends = np.cumsum([len(r) for r in raw])
    buffer = np.frombuffer(b"".join(raw), np.uint8)
    starts = ends - [len(r) for r in raw]
    for lead in (b"", b"lead "):
        crc = np.full(len(raw), zlib.crc32(lead), np.uint32)
        assert im.crc32_after(crc, buffer, starts, ends).tolist() == [zlib.crc32(lead + r) for r in raw]


def test_pairs_stay_inside_a_text():
    raw = [b"one two", b"", b"three", b"four five six"]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    words = ta.find_words(np.frombuffer(b"".join(raw), np.uint8), offsets, ta.LETTER_OR_DIGIT, lower=True)
    single, pair, first = im.feature_buckets(words, 1 << 31)
    want = [zlib.crc32(x) % (1 << 31) for x in (b"one two", b"four five", b"five six")]
    assert pair.tolist() == want and first.tolist() == [0, 3, 4] and len(single) == 6


@pytest.mark.parametrize("pivots", [1, 2, 15])
def test_selected_key_is_the_kth(spark, pivots):
    rows = [(i * 37 % 11, 0, i // 2, i % 3, i) for i in range(200)]
    keys = spark.createDataFrame(rows, "down long, anon long, id long, fp long, tie long").repartition(5)
    for k in (0, 1, 50, 200, 201) if pivots > 1 else (7,):
        got = im.kth_key(keys, k, 200, pivots)
        assert (got and tuple(got)) == (sorted(rows)[k - 1] if 0 < k <= 200 else None)


def test_equals_brute_force(spark, docs_of, write_prose):
    docs = [(i, write_prose(i, 5 + i % 60, vocabulary=80)) for i in range(300)]
    docs += [(300, None), (301, ""), (302, "  ."), (303, "ÉTÉ 中文 Abc" * 30), (304, "w" * 9000 + " v " * 40), (305, "solo")]
    target = [write_prose(1000 + i, 30, vocabulary=40) for i in range(20)] + [None, ""]
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    got = im.resample(docs_of(docs).repartition(7), aim)
    assert answer(got) == brute(docs, target)
    assert [f.dataType.simpleString() for f in got.schema.fields] == ["bigint"] * 5


def test_ties_repeats_and_null_ids(spark, docs_of, write_prose):
    same = write_prose(3, 40)
    rows = [(None, same), (None, same), (1, same), (1, same), (1, same), (1, write_prose(4, 40)), (2, write_prose(5, 40))]
    aim = spark.createDataFrame([(same,)], "text string")
    got = im.resample(docs_of(rows), aim, percent=100).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 8))
    by_rank = sorted(got, key=lambda r: r["rank"])
    keys = [(-r.score, r.doc_id is None, r.doc_id or 0) for r in by_rank]
    assert keys == sorted(keys)


def test_odd_rows(spark, odd_docs, clashing, no_docs, rows_of):
    aim = odd_docs.select("text")
    got = im.resample(odd_docs, aim)
    assert got.count() == odd_docs.count()
    assert rows_of(im.resample(clashing, aim)) == rows_of(got)
    assert im.resample(no_docs, aim).count() == 0
    assert im.resample(odd_docs, no_docs).count() == odd_docs.count()
    taken = im.resample(odd_docs, aim, carry=("text", "lang")).select("own.*", "rank").where("rank = 1")
    assert taken.columns == ["text", "lang", "rank"] and taken.count() == 1
