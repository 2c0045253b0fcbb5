"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are counts of its bytes and words; a line also sees the features of the line
before and after. The chain adds a weight for each pair of neighbouring labels. Forward-backward messages give each
line's probability of being good, and the mean of these, weighted by line length, is the document's score.

Labels are known for documents only, so in training every line carries its document's label. The fit takes the
``SAMPLE_DOCS`` labelled documents with the smallest hashes (a documented bound); only their line features, about
two dozen numbers a line, reach the driver. Scoring reads every line of every document.

Defined results: a null, empty or blank text is one line without bytes and is scored as such. Without labelled
documents every score is 0.5. Several labels of one document count as bad if one of them is; a null label counts as
none. Repeated rows are answered once each; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlane.llm import text_arrays as ta

SAMPLE_DOCS = 6000
THRESHOLD = 0.3
_STEPS, _RATE, _RIDGE = 200, 0.1, 1e-3

_NOT_NEWLINE = np.ones(256, dtype=bool)
_NOT_NEWLINE[0x0A] = False


def _counter(*classes: bytes | range) -> np.ndarray:
    """A byte table that counts two classes at once, 32 bits each."""
    table = np.zeros(256, dtype=np.uint64)
    for shift, members in zip((0, 32), classes, strict=False):
        table[list(members)] += np.uint64(1 << shift)
    return table


#: Bytes counted in a line, two classes a table.
_COUNTERS = [
    _counter(b"#*$%&<>^~=+@\\{}[]_", b"|"),
    _counter(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"),
    _counter(b"!?", b"0123456789"),
    _counter(b".,;:", range(0x80, 0x100)),
]
N_OWN = 16


def line_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, feature) values, bytes of each line, and the bounds of each text's lines; no text is without a line."""
    buffer, offsets = ta.text_buffer(column)
    lines = ta.find_words(buffer, offsets, _NOT_NEWLINE, lower=False)
    n = len(lines.starts)
    bytes_ = (lines.ends - lines.starts).astype(np.float64)
    own = np.zeros((n, N_OWN))
    if n:
        size = np.maximum(bytes_, 1)
        counts = []
        for table in _COUNTERS:
            both = np.add.reduceat(table[buffer], lines.starts)
            counts += [both & np.uint64(0xFFFFFFFF), both >> np.uint64(32)]
        for i, count in enumerate(counts):
            own[:, i] = count / size
        words = ta.find_words(buffer, offsets, ta.NOT_SPACE, lower=False)
        at = np.searchsorted(words.starts, lines.starts)
        to = np.searchsorted(words.starts, lines.ends)
        n_words = np.maximum(to - at, 1)
        own[:, 8] = np.log1p(to - at)
        own[:, 9] = np.log1p(bytes_ / n_words)
        if len(words.starts):
            hashes = words.hashes()
            line_of = np.searchsorted(lines.starts, words.starts, "right") - 1
            for i, back in ((10, 1), (11, 2)):
                again = np.zeros(len(hashes) + 1)
                again[back:-1] = (hashes[back:] == hashes[:-back]) & (line_of[back:] == line_of[:-back])
                total = np.concatenate([[0], np.cumsum(again)])
                own[:, i] = (total[to] - total[at]) / n_words
            tail = buffer[words.ends - 1]
            odd = np.concatenate([[0], np.cumsum(_COUNTERS[0][tail] > 0)])
            own[:, 12] = (odd[to] - odd[at]) / n_words
            # Distinct words of the line: sort by line and word, and count the changes.
            order = np.lexsort((hashes, line_of))
            h, l = hashes[order], line_of[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (l[1:] != l[:-1])
            distinct = np.bincount(l[new], minlength=n)
            own[:, 13] = np.where(to > at, distinct / n_words, 1) ** np.where(n_words >= 8, 1, 0)
        text = np.searchsorted(lines.bounds, np.arange(n), "right") - 1
        name = ta.span_hashes(buffer, lines.starts, lines.ends)
        order = np.lexsort((np.arange(n), name, text))
        same = np.zeros(n, dtype=bool)
        same[order[1:]] = (name[order[1:]] == name[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
        own[:, 14] = same
    own[:, 15] = 1
    count = np.diff(lines.bounds)
    if (count == 0).any():
        # A text without a line gets one without bytes.
        place = lines.bounds[:-1][count == 0]
        blank = np.zeros((1, N_OWN))
        blank[0, 15] = 1
        own = np.insert(own, place, blank, axis=0)
        bytes_ = np.insert(bytes_, place, 0)
    bounds = np.concatenate([[0], np.cumsum(np.maximum(count, 1))])
    return own, bytes_, bounds


def with_neighbours(own: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Own features, then those of the line before and after; beyond the text's ends they are 0."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[bounds[:-1]] = 0
    after[bounds[1:] - 1] = 0
    return np.hstack([own, before, after])


@dataclass
class Chain:
    """``scale``/``centre`` standardise own features; ``weights`` score a line as good; ``pairs[i, j]``: i then j."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    pairs: np.ndarray

    def inputs(self, own: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return with_neighbours((own - self.centre) / self.scale, bounds)


def messages(odds: np.ndarray, bounds: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward messages as log odds of good. All texts advance one line at a time, together."""
    size = np.diff(bounds)
    order = np.argsort(-size, kind="stable")
    head, size = bounds[:-1][order], size[order]
    forward, backward = odds.copy(), np.zeros_like(odds)
    active = np.searchsorted(-size, -np.arange(1, size[0] + 1 if len(size) else 1), "right")
    for t in range(1, int(size[0]) if len(size) else 0):
        at = head[: active[t]] + t
        a = forward[at - 1]
        forward[at] += np.logaddexp(pairs[1, 1] + a, pairs[0, 1]) - np.logaddexp(pairs[1, 0] + a, pairs[0, 0])
    last = head + size
    for t in range(2, int(size[0]) + 1 if len(size) else 0):
        at = last[: active[t - 1]] - t
        b = odds[at + 1] + backward[at + 1]
        backward[at] = np.logaddexp(pairs[1, 1] + b, pairs[1, 0]) - np.logaddexp(pairs[0, 1] + b, pairs[0, 0])
    return forward, backward


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit_chain(own: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> Chain:
    """Maximum likelihood with a ridge by Adam; ``labels`` has one 0 or 1 for each text."""
    centre, scale = own.mean(axis=0), own.std(axis=0) + 1e-6
    centre[15], scale[15] = 0, 1
    chain = Chain(centre, scale, np.zeros(3 * N_OWN), np.zeros((2, 2)))
    x = chain.inputs(own, bounds)
    y = np.repeat(labels, np.diff(bounds)).astype(float)
    inner = np.ones(len(y), dtype=bool)
    inner[bounds[1:] - 1] = False
    left = np.flatnonzero(inner)
    n = len(labels)
    flat = np.zeros(3 * N_OWN + 4)
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    same = np.array([[np.sum(inner & (y == i)) if i == j else 0.0 for j in (0, 1)] for i in (0, 1)])
    for step in range(1, _STEPS + 1):
        weights, pairs = flat[:-4], flat[-4:].reshape(2, 2)
        odds = x @ weights
        forward, backward = messages(odds, bounds, pairs)
        p = _sigmoid(forward + backward)
        a, b = forward[left], (odds + backward)[left + 1]
        logs = np.stack([i * a + pairs[i, j] + j * b for i in (0, 1) for j in (0, 1)])
        logs -= logs.max(axis=0)
        joint = np.exp(logs)
        joint = (joint / joint.sum(axis=0)).sum(axis=1)
        slope = np.concatenate([x.T @ (y - p), same.ravel() - joint]) / n - _RIDGE * flat
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        flat = flat + _RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Chain(centre, scale, flat[:-4], flat[-4:].reshape(2, 2))


def document_scores(chain: Chain | None, column: pa.Array) -> np.ndarray:
    """The length-weighted mean probability of good of each text's lines."""
    own, bytes_, bounds = line_features(column)
    if chain is None or not len(bounds) > 1:
        return np.full(len(bounds) - 1, 0.5)
    odds = chain.inputs(own, bounds) @ chain.weights
    good = _sigmoid(sum(messages(odds, bounds, chain.pairs)))
    weight = bytes_ + 1
    return np.add.reduceat(good * weight, bounds[:-1]) / np.add.reduceat(weight, bounds[:-1])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in ta.slices(batch, "text"):
            own, _, bounds = line_features(part.column(1))
            flat = ta.list_column(own.astype(np.float32).ravel(), bounds * N_OWN)
            yield pa.RecordBatch.from_arrays([part.column(0), flat], ["quality", "own"])


def _scores(broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ta.slices(batch, "text"):
                score = np.clip(document_scores(broadcast.value, part.column(part.schema.get_field_index("text"))), 0, 1)
                names = [*part.schema.names, "crf_score"]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], names)

    return run


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Chain | None:
    """Fit on the ``sample_docs`` labelled documents with the smallest hashes."""
    known = (
        labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")
    rows = texts.select("quality", "text").mapInArrow(_features, "quality int, own array<float>").toArrow()
    if not rows.num_rows:
        return None
    flat = rows.column("own").combine_chunks()
    own = flat.values.to_numpy().reshape(-1, N_OWN).astype(float)
    bounds = flat.offsets.to_numpy().astype(np.int64) // N_OWN
    labels_ = rows.column("quality").to_numpy()
    # One order whatever the partitioning, so that sums round alike in every run.
    key = np.lexsort((np.diff(bounds), np.add.reduceat(own.sum(axis=1), bounds[:-1]), labels_))
    lines = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in key])
    sizes = np.diff(bounds)[key]
    return fit_chain(own[lines], np.concatenate([[0], np.cumsum(sizes)]), labels_[key])


def score_quality(docs: DataFrame, chain: Chain | None) -> DataFrame:
    """``docs`` with ``crf_score``, from 0 to 1; higher is better. All columns stay."""
    model = docs.sparkSession.sparkContext.broadcast(chain)
    return docs.mapInArrow(_scores(model), f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in docs.schema)}, crf_score double")


def held_out(doc_id="doc_id"):
    """Rows kept from training: crc32 of the id as text, modulo 5, is 0. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``; learns from rows not held out."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chain = train(docs, labels.where(~held_out()), sample_docs)
    scored = score_quality(docs, chain)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("crf_score").alias("score"),
        (F.col("crf_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
