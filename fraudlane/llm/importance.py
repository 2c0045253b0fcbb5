"""Importance resampling towards a target: documents whose words look like the target are drawn more often.

Features are all runs of one and two words, hashed into ``BUCKETS`` buckets. The counts of a bucket in the corpus and in
the target give its gain, an integer; an array of all gains scores whole texts in Arrow tasks. Noise from a hash of the
id turns the ``k`` highest scores into a weighted draw without replacement.

The k-th highest key is found by a distributed quickselect: a few random keys among the candidates are pivots, one pass
counts what lies below, at and above each of them, and the part that holds the k-th goes on. No rows but the pivots
reach the driver, and nothing is sorted until the k-th key is known; then the winners alone are sorted and ranked.

Both counts are 10,000 numbers whatever the corpus holds, summed in each task before the shuffle.

Defined results: a null or wordless text has no features and weight 0; it is scored by its noise and drawn only if
documents of fewer words are asked for. Keys are ordered by score, then ``doc_id``, a null one last, then by a hash of
the text; rows equal in all of that are separate documents, and it does not matter which of them is drawn. A null id's
noise comes from ``7:null``. An empty target makes all gains depend on the corpus only; an empty table gives an empty
result. Extra columns are ignored unless ``carry`` names them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlane.llm import text_arrays as ta
from fraudlane.operators.numbering import dense_row_number
from fraudlane.scratch import materialise

BUCKETS, SEED, PERCENT, MIN_WORDS = 10_000, 7, 25, 20
#: Keys that are pivots of one round of the selection.
PIVOTS = 15
#: Longer words are hashed one by one.
_LONG = 64
_KEY = ("down", "anon", "id", "fp", "tie")


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


_CRC = _crc_table()


def crc32_after(crc: np.ndarray, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of what ``crc`` stands for followed by ``buffer[starts[i]:ends[i]]``, for each i."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    at, state = starts[order], crc[order] ^ np.uint32(0xFFFFFFFF)
    # How many words have more than k bytes, for each k.
    more = np.searchsorted(-size[order], -np.arange(min(_LONG, int(size.max(initial=0)))), "left")
    for k, n in enumerate(more):
        head = state[:n]
        state[:n] = _CRC[(head ^ buffer[at[:n] + k]) & np.uint32(255)] ^ (head >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > _LONG):
        out[i] = zlib.crc32(buffer[starts[i] : ends[i]].tobytes(), int(crc[i]))
    return out


def feature_buckets(words: ta.Words, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of each word, the bucket of each pair of neighbours, and the first word of each pair."""
    none = np.zeros(len(words.starts), dtype=np.uint32)
    single = crc32_after(none, words.buffer, words.starts, words.ends)
    inside = np.ones(max(0, len(single) - 1), dtype=bool)
    cut = words.bounds[1:-1] - 1
    inside[cut[(cut >= 0) & (cut < len(inside))]] = False
    first = np.flatnonzero(inside)
    state = single[first] ^ np.uint32(0xFFFFFFFF)
    spaced = (_CRC[(state ^ np.uint32(0x20)) & np.uint32(255)] ^ (state >> np.uint32(8))) ^ np.uint32(0xFFFFFFFF)
    pair = crc32_after(spaced, words.buffer, words.starts[first + 1], words.ends[first + 1])
    n = np.uint32(buckets)
    return (single % n).astype(np.int64), (pair % n).astype(np.int64), first


def _found(batches: Iterator[pa.RecordBatch], buckets: int):
    """(rows, words, buckets of words, buckets of pairs, first words of pairs) of each piece of the batches."""
    for batch in batches:
        for part in ta.slices(batch, "text"):
            column = part.column(part.schema.get_field_index("text"))
            words = ta.find_words(*ta.text_buffer(column), ta.LETTER_OR_DIGIT, lower=True)
            yield part, words, *feature_buckets(words, buckets)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for _, _, single, pair, _ in _found(batches, buckets):
            total += np.bincount(single, minlength=buckets) + np.bincount(pair, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    rows = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, dtype=np.int64)
    for row in rows.collect():
        counts[row["bucket"]] = row["n"]
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket: a thousand times the logarithm of target share by corpus share, one added to each count."""
    s, t = corpus.astype(float), target.astype(float)
    buckets = len(corpus)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def _weights(gains: np.ndarray):
    buckets = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words, single, pair, first in _found(batches, buckets):
            n_words = np.diff(words.bounds)
            ends = np.searchsorted(first, words.bounds)
            n = n_words + np.diff(ends)
            sums = [np.concatenate([[0], np.cumsum(gains[x])]) for x in (single, pair)]
            total = np.diff(sums[0][words.bounds]) + np.diff(sums[1][ends])
            weight = total // np.maximum(n, 1)
            keep = [part.column(i) for i, name in enumerate(part.schema.names) if name != "text"]
            names = [name for name in part.schema.names if name != "text"]
            columns = [pa.array(x.astype(np.int64)) for x in (n_words, n, weight)]
            yield pa.RecordBatch.from_arrays([*keep, *columns], [*names, "n_words", "n_features", "weight"])

    return run


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """A Gumbel variable in thousandths from a hash of the id, the same in every run."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def _literal(key) -> Column:
    return F.struct(*(F.lit(key[c]).cast("long").alias(c) for c in _KEY))


def kth_key(keys: DataFrame, k: int, n: int, pivots: int = PIVOTS):
    """The k-th smallest of ``n`` distinct keys (columns ``_KEY``, longs without nulls), as a row; None if there is none."""
    if not 0 < k <= n:
        return None
    own = F.struct(*_KEY)
    left, low, high, turn = n, None, None, 0
    while True:
        among = keys
        # The first part of the key alone reaches the files.
        if low is not None:
            among = among.where(F.col("down") >= low["down"]).where(own > _literal(low))
        if high is not None:
            among = among.where(F.col("down") <= high["down"]).where(own < _literal(high))
        turn += 1
        drawn = among.orderBy(F.xxhash64(F.lit(turn), *_KEY), *_KEY).limit(pivots).collect()
        drawn.sort(key=lambda r: tuple(r[c] for c in _KEY))
        counts = among.agg(
            *(F.count_if(own < _literal(p)).alias(f"below{i}") for i, p in enumerate(drawn)),
            *(F.count_if(own == _literal(p)).alias(f"at{i}") for i, p in enumerate(drawn)),
        ).first()
        end = left
        for i, pivot in enumerate(drawn):
            below, at = counts[f"below{i}"], counts[f"at{i}"]
            if k <= below:
                end, high = below, pivot
                break
            if k <= below + at:
                return pivot
            start, low = below + at, pivot
        else:
            i = len(drawn)
        passed = start if i else 0
        k, left = k - passed, end - passed


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs`` (doc_id, text), and the columns ``carry`` as ``own``.

    Of the documents with at least ``min_words`` words, ``percent`` in a hundred are drawn and ranked from 1; the rank of
    all others is null. ``target`` is any table with a ``text``.
    """
    gains = bucket_gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    own = [F.struct(*carry).alias("own")] if carry else []
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("fp"), "text", *own)
    made = rows.drop("text").schema.add("n_words", "long").add("n_features", "long").add("weight", "long")
    weighed = rows.mapInArrow(_weights(gains), made).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = materialise(weighed.withColumn("tie", F.monotonically_increasing_id()), "importance")
    keyed = scored.withColumns(
        {"down": -F.col("score"), "anon": F.col("doc_id").isNull().cast("long"), "id": F.coalesce("doc_id", F.lit(0).cast("long"))}
    )
    long_enough = F.col("n_words") >= min_words
    n = scored.where(long_enough).count()
    last = kth_key(keyed.where(long_enough).select(*_KEY), percent * n // 100, n)
    wins = (long_enough & (F.struct(*_KEY) <= _literal(last))) if last else F.lit(False)
    kept = ["doc_id", "n_features", "weight", "score", "rank", *(["own"] if carry else [])]
    ranked = dense_row_number(keyed.where(wins), list(_KEY), "rank") if last else keyed.withColumn("rank", F.lit(0).cast("long")).limit(0)
    others = keyed.where(~wins).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*kept).unionByName(others.select(*kept))
