"""Removal of passages that repeat across documents, by sliding runs of sentences.

A sentence ends after a word that ends in . ! or ? and at a line break. From every sentence the shortest run of
consecutive sentences is taken that has at least two sentences and ``min_words`` words (a single sentence of twice
as many words is a run too), once going forward and once going backward, so that a repeated passage is covered to its
last whole sentence wherever it stands. Each run is hashed over its words. A hash's first occurrence, the smallest
(doc_id, place), is kept; sentences covered by any other occurrence are removed.

Only (hash, doc_id) travels in the global join: repeats inside a document are found where it is read, the smallest
doc_id of a hash is an aggregate merged before the shuffle, and a hash that a third of all documents share is split by
adaptive execution when joined back.

Defined results: null and blank texts have no sentences and are kept as they are, as are texts without repeats.
A run is known by two independent 64-bit hashes over its words, compared without regard to case A-Z.
Rows that share a ``doc_id`` are one document, and a run that only they share stays in each of them. A null ``doc_id``
counts as the smallest. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlane.llm import text_arrays as ta
from fraudlane.scratch import materialise

MIN_WORDS = 20
_STOPS = np.zeros(256, dtype=bool)
_STOPS[list(b".!?")] = True
_NO_ID = -(1 << 63)
_SEEN = "doc_id long, part long, h1 long, h2 long, first int, stop int, again boolean"


def sentences(words: ta.Words) -> tuple[np.ndarray, np.ndarray]:
    """The first word of every sentence, and the bounds of each text's sentences."""
    n = len(words.starts)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(words.n_texts + 1, dtype=np.int64)
    head = np.zeros(n, dtype=bool)
    head[1:] = _STOPS[words.buffer[words.ends[:-1] - 1]]
    lines = np.flatnonzero(words.buffer == 0x0A)
    after = np.searchsorted(words.starts, lines)
    head[after[after < n]] = True
    starts = words.bounds[:-1]
    head[starts[starts < n]] = True
    first = np.flatnonzero(head)
    return first, np.searchsorted(first, words.bounds)


def runs(first: np.ndarray, bounds: np.ndarray, n_words: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(sentence, sentence after the last) of every forward and backward run, each once."""
    n = len(first)
    edge = np.append(first, n_words)
    text_stop = np.repeat(bounds[1:], np.diff(bounds))
    text_start = np.repeat(bounds[:-1], np.diff(bounds))
    at = np.arange(n)
    # Forward: the first sentence end with enough words after the start of sentence i.
    stop = np.searchsorted(edge, edge[at] + min_words)
    stop = np.maximum(stop, at + 2)
    alone = edge[at + 1] - edge[at] >= 2 * min_words
    stop = np.where(alone, at + 1, stop)
    ahead = stop <= text_stop
    # Backward: the last sentence start with enough words before the end of sentence i.
    start = np.searchsorted(edge, edge[at + 1] - min_words, "right") - 1
    start = np.minimum(start, at - 1)
    start = np.where(alone, at, start)
    behind = start >= text_start
    pairs = np.concatenate([np.stack([at[ahead], stop[ahead]], 1), np.stack([start[behind], at[behind] + 1], 1)])
    pairs = np.unique(pairs, axis=0) if len(pairs) else pairs.reshape(0, 2)
    return pairs[:, 0], pairs[:, 1]


def _seen(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ta.slices(batch, "text"):
                words = ta.find_words(*ta.text_buffer(part.column(1)), ta.NOT_SPACE, lower=True)
                first, bounds = sentences(words)
                a, b = runs(first, bounds, len(words.starts), min_words)
                edge = np.append(first, len(words.starts))
                values = words.hashes()
                h1 = ta.run_hashes(values, edge[a], edge[b])
                h2 = ta.run_hashes(ta.mix(values + np.uint64(1)), edge[a], edge[b])
                text = np.searchsorted(bounds, a, "right") - 1
                # A run equal to an earlier one of its text is a repeat whatever other documents hold.
                order = np.lexsort((a, h2, h1, text))
                again = np.zeros(len(a), dtype=bool)
                x, y = order[1:], order[:-1]
                again[x] = (text[x] == text[y]) & (h1[x] == h1[y]) & (h2[x] == h2[y])
                base = bounds[text]
                ids = part.column(0).take(pa.array(text))
                # Which text of this doc_id the places belong to.
                name = ta.run_hashes(values, words.bounds[:-1], words.bounds[1:])[text] if len(a) else h1
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, pa.array(name.view(np.int64)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)),
                        pa.array((a - base).astype(np.int32)), pa.array((b - base).astype(np.int32)), pa.array(again),
                    ],
                    ["doc_id", "part", "h1", "h2", "first", "stop", "again"],
                )

    return run


def repeated_runs(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, found) for documents with something to remove; found has (part, first, stop) of sentence runs."""
    seen = materialise(docs.mapInArrow(_seen(min_words), _SEEN), "sentence_runs")
    once = seen.where("NOT again")
    shared = once.groupBy("h1", "h2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    later = once.join(shared.select("h1", "h2", "low"), ["h1", "h2"]).where("doc_id > low")
    drop = later.select("doc_id", "part", "first", "stop").union(seen.where("again").select("doc_id", "part", "first", "stop"))
    return drop.groupBy("doc_id").agg(F.collect_set(F.struct("part", "first", "stop")).alias("found"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in ta.slices(batch, "text"):
            column = part.column(1)
            raw, places = ta.text_buffer(column)
            words = ta.find_words(raw, places, ta.NOT_SPACE, lower=True)
            first, bounds = sentences(words)
            edge = np.append(first, len(words.starts))
            names = ta.run_hashes(words.hashes(), words.bounds[:-1], words.bounds[1:]).view(np.int64)
            n_removed = np.zeros(part.num_rows, dtype=np.int64)
            words_removed = np.zeros(part.num_rows, dtype=np.int64)
            texts = column.to_pylist()
            for d, found in enumerate(part.column(2).to_pylist()):
                gone = np.zeros(bounds[d + 1] - bounds[d] + 1, dtype=np.int64)
                for one in found or ():
                    if one["part"] == names[d]:
                        gone[one["first"]] += 1
                        gone[one["stop"]] -= 1
                gone = np.flatnonzero(np.cumsum(gone[:-1]) > 0) + bounds[d]
                if not len(gone):
                    continue
                n_removed[d] = len(gone)
                words_removed[d] = np.sum(edge[gone + 1] - edge[gone])
                # A sentence reaches from its first word to the next sentence's, so the gap after it goes with it.
                pieces, left = [], int(places[d])
                for i in gone:
                    pieces.append(raw[left : words.starts[edge[i]]].tobytes())
                    left = int(words.starts[edge[i + 1]]) if i + 1 < bounds[d + 1] else int(places[d + 1])
                pieces.append(raw[left : places[d + 1]].tobytes())
                texts[d] = b"".join(pieces).decode()
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), pa.array(np.diff(bounds).astype(np.int64)), pa.array(n_removed),
                    pa.array(words_removed), pa.array(texts, pa.string()),
                ],
                ["doc_id", "n_sentences", "n_removed", "n_words_removed", "text"],
            )


def remove_repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_sentences, n_removed, n_words_removed and the remaining text of every row of ``docs``."""
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id"), "text")
    found = materialise(repeated_runs(docs, min_words), "repeated_runs")
    cut = docs.join(found, "doc_id", "left").select("doc_id", "text", "found").mapInArrow(
        _cut, "doc_id long, n_sentences long, n_removed long, n_words_removed long, text string"
    )
    return cut.withColumn("doc_id", F.nullif("doc_id", F.lit(_NO_ID)))
