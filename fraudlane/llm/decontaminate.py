"""Removal of benchmark text from training documents.

The windows of the benchmark (runs of ``window`` consecutive words, or a shorter item as a whole) are a hash set
that every task gets by broadcast. A task hashes the windows of its documents, keeps those whose hash is in the
set, and verifies them by comparing the words themselves. Only as much of the benchmark as ``BLOCK_BYTES`` of
text is broadcast at once: a larger benchmark is cut into blocks, and documents pass once for each block, with
what was found so far written between two passes.

Words are runs of digits, letters a-z and characters outside ASCII, after A-Z became a-z.

Defined results: null or blank texts have no words and no hits, as have items without words. Repeated items and
rows count once each where an identifier is counted; every row is answered. An item without ``item_id`` hits words
but is not named or counted. Extra columns are passed through by ``remove_contaminated`` and ignored otherwise. An
empty benchmark hits nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlane.llm import text_arrays as ta
from fraudlane.scratch import materialise, unique_name

BLOCK_BYTES = 16 << 20
_FOUND = "doc_id long, text string, spans array<long>, items array<string>, n_words long"


class BenchmarkWindows:
    """The windows of one block of items: their words, and for each length a filter on hashes."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        self.window = window
        self.items: dict[bytes, set[str]] = {}
        hashes: dict[int, list[np.ndarray]] = {}
        column = pa.array([text for _, text in items], pa.string())
        words = ta.find_words(*ta.text_buffer(column), ta.LETTER_OR_DIGIT, lower=True)
        values = words.hashes()
        for i, (item_id, _) in enumerate(items):
            a, b = int(words.bounds[i]), int(words.bounds[i + 1])
            size = min(window, b - a)
            if not size:
                continue
            starts = np.arange(a, b - size + 1)
            hashes.setdefault(size, []).append(ta.run_hashes(values, starts, starts + size))
            for start in starts:
                named = self.items.setdefault(joined(words, start, start + size), set())
                if item_id is not None:
                    named.add(item_id)
        self.by_size = {size: np.unique(np.concatenate(h)) for size, h in hashes.items()}
        self.maybe = {}
        for size, h in self.by_size.items():
            self.maybe[size] = np.zeros(1 << 20, dtype=bool)
            self.maybe[size][(h >> np.uint64(44)).astype(np.int64)] = True


def joined(words: ta.Words, first: int, stop: int) -> bytes:
    return b" ".join(words.buffer[words.starts[i] : words.ends[i]].tobytes() for i in range(first, stop))


def find_hits(words: ta.Words, values: np.ndarray, known: BenchmarkWindows) -> list[tuple[int, int, set[str]]]:
    """(first word, word after the last, items) of every verified occurrence of a window."""
    found = []
    for size, hashes in known.by_size.items():
        first, seen = ta.windows(words, values, size)
        near = np.flatnonzero(known.maybe[size][(seen >> np.uint64(44)).astype(np.int64)])
        place = np.minimum(np.searchsorted(hashes, seen[near]), len(hashes) - 1)
        for start in first[near[hashes[place] == seen[near]]]:
            items = known.items.get(joined(words, int(start), int(start) + size))
            if items is not None:
                found.append((int(start), int(start) + size, items))
    return found


#: The block a Python worker used last, kept from task to task.
_LAST: dict[str, BenchmarkWindows] = {}


def _windows_of(name: str, broadcast, window: int) -> BenchmarkWindows:
    if name not in _LAST:
        _LAST.clear()
        _LAST[name] = BenchmarkWindows(broadcast.value, window)
    return _LAST[name]


def _scanner(broadcast, window: int, emit):
    name = unique_name("block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _windows_of(name, broadcast, window)
        for batch in batches:
            for part in ta.slices(batch, "text"):
                text = part.column(part.schema.get_field_index("text"))
                words = ta.find_words(*ta.text_buffer(text), ta.LETTER_OR_DIGIT, lower=True)
                hits = find_hits(words, words.hashes(), known)
                yield emit(part, words, hits)

    return run


def by_text(words: ta.Words, hits: list[tuple[int, int, set[str]]]) -> dict[int, list[tuple[int, int, set[str]]]]:
    """Hits of each text that has any, with word places counted from the text's first word."""
    out: dict[int, list[tuple[int, int, set[str]]]] = {}
    for start, stop, items in hits:
        d = int(np.searchsorted(words.bounds, start, "right")) - 1
        base = int(words.bounds[d])
        out.setdefault(d, []).append((start - base, stop - base, items))
    return out


def covered(spans: list[int]) -> list[int]:
    """Flat, sorted, disjoint [first, stop, first, stop, ...] of flat spans that may overlap."""
    out: list[int] = []
    for a, b in sorted(zip(spans[::2], spans[1::2], strict=True)):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _emit_found(part: pa.RecordBatch, words: ta.Words, hits) -> pa.RecordBatch:
    """Adds this block's spans and items to those of earlier blocks."""
    found = by_text(words, hits)
    before = part.select(["spans", "items"]).to_pylist() if "spans" in part.schema.names else [None] * part.num_rows
    spans, items = [], []
    for d, old in enumerate(before):
        new = found.get(d, ())
        spans.append(covered([*(old["spans"] if old else ()), *(x for h in new for x in h[:2])]))
        items.append(sorted({*(old["items"] if old else ())}.union(*(h[2] for h in new))))
    return pa.RecordBatch.from_arrays(
        [
            part.column(0), part.column(1), pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string())),
            pa.array(np.diff(words.bounds).astype(np.int64)),
        ],
        ["doc_id", "text", "spans", "items", "n_words"],
    )


def _emit_digest(part: pa.RecordBatch, words: ta.Words, hits) -> pa.RecordBatch:
    part = _emit_found(part, words, hits)
    spans, items = part.column(2).to_pylist(), part.column(3).to_pylist()
    n_hit = [sum(s[1::2]) - sum(s[::2]) for s in spans]
    return pa.RecordBatch.from_arrays(
        [
            part.column(0), part.column(4), pa.array(n_hit, pa.int64()), pa.array(map(len, items), pa.int64()),
            pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in items], pa.string()),
            pa.array([n > 0 for n in n_hit], pa.bool_()),
        ],
        ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    )


def _emit_clean_rows(part: pa.RecordBatch, words: ta.Words, hits) -> pa.RecordBatch:
    clean = np.ones(part.num_rows, dtype=bool)
    clean[list(by_text(words, hits))] = False
    return part.filter(pa.array(clean))


def _emit_spans(name: str):
    """Adds this block's spans to those of earlier blocks, in the column ``name``."""

    def emit(part: pa.RecordBatch, words: ta.Words, hits) -> pa.RecordBatch:
        found = by_text(words, hits)
        before = part.column(name).to_pylist() if name in part.schema.names else [[]] * part.num_rows
        spans = [covered([*old, *(x for h in found.get(d, ()) for x in h[:2])]) for d, old in enumerate(before)]
        column = pa.array(spans, pa.list_(pa.int64()))
        if name in part.schema.names:
            return part.set_column(part.schema.get_field_index(name), name, column)
        return part.append_column(name, column)

    return emit


def _emit_cut_text(name: str):
    """Cuts from the first hit word to the last of each stretch that all blocks together cover, and one space if two words would meet."""
    add = _emit_spans(name)

    def emit(part: pa.RecordBatch, words: ta.Words, hits) -> pa.RecordBatch:
        part = add(part, words, hits)
        own = part.column(name).to_pylist()
        part = part.remove_column(part.schema.get_field_index(name))
        at = part.schema.get_field_index("text")
        column = part.column(at)
        raw, places = ta.text_buffer(column)
        texts = column.to_pylist()
        for d, spans in enumerate(own):
            if not spans:
                continue
            base, left, pieces = int(words.bounds[d]), int(places[d]), []
            for a, b in zip(spans[::2], spans[1::2], strict=True):
                pieces.append(raw[left : words.starts[base + a]].tobytes())
                left = int(words.ends[base + b - 1])
            pieces.append(raw[left : places[d + 1]].tobytes())
            texts[d] = b"".join(pieces).decode()
        return part.set_column(at, part.schema.field(at), pa.array(texts, column.type))

    return emit


def _blocks(benchmark: DataFrame) -> Iterator[tuple[bool, list[tuple[str | None, str]]]]:
    """(is the last, items) for each block of about ``BLOCK_BYTES``, fetched when its pass begins.

    Equal rows count once, and copies of one text under many ids are dealt to all blocks.
    """
    items = benchmark.select(F.col("item_id").cast("string"), "text").where("text IS NOT NULL").distinct()
    n_bytes = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-n_bytes // BLOCK_BYTES))
    for k in range(n):
        block = items.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(n)) == k) if n > 1 else items
        yield k == n - 1, [tuple(r) for r in block.collect()]


def scan_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for every row of ``docs``."""
    context = docs.sparkSession.sparkContext
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for last, items in _blocks(benchmark):
        block = context.broadcast(items)
        if last:
            schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
            return docs.mapInArrow(_scanner(block, window, _emit_digest), schema)
        docs = materialise(docs.mapInArrow(_scanner(block, window, _emit_found), _FOUND), "contamination")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, mode: str = "document") -> DataFrame:
    """``docs`` without contaminated rows, or with mode "span" without the hit words only; all columns stay.

    Hits are those of the text as it comes in, whatever the number of blocks: spans are gathered over all blocks and cut
    once, at the end.
    """
    name = unique_name("spans")
    emit = {"document": _emit_clean_rows, "span": _emit_spans(name)}[mode]
    spans = [T.StructField(name, T.ArrayType(T.LongType()))] if mode == "span" else []
    schema = T.StructType([*docs.schema.fields, *spans])
    context, kept = docs.sparkSession.sparkContext, docs.schema
    for last, items in _blocks(benchmark):
        block = context.broadcast(items)
        if last:
            return docs.mapInArrow(_scanner(block, window, _emit_cut_text(name) if mode == "span" else emit), kept)
        docs = materialise(docs.mapInArrow(_scanner(block, window, emit), schema), "decontaminated")
