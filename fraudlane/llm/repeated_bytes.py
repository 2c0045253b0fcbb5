"""Removal of every byte that lies in a string of ``SPAN`` bytes which also starts somewhere else.

The suffixes of all texts are sorted into buckets, but only as deep as ``SPAN`` bytes and only where a bucket has
several members: bucket-pointer refinement. Buckets of runs of ``GRAM`` bytes come first; a member's next bucket is
found from its pointer, the identifier of the bucket it is in, and from what stands at the offsets before and behind
the run. The pointer that this gives, equal for equal strings only, is what the next round refines.

Not every suffix has to take part on its own. The string of ``SPAN`` bytes from place p has one smallest run (by a hash,
leftmost first), its anchor; equal strings have theirs at the same offset. So about one byte in 80 is an anchor, and it
stands for the places that chose it. Members of a bucket (``core``) whose whole surroundings (``hull``) are equal are
settled at once: all of their places repeat. A member that is alone in its bucket is settled too: none of its places
does. Only buckets whose members have different surroundings go on, one member for each of them, and the places of a
member are cut into blocks of ``WIDTHS`` offsets. The core of a block is what all of its strings have in common, so it
is longer from round to round, until a block is one string.

A hot string costs little: buckets and surroundings are aggregates merged before the shuffle, and the joins back have
one row for each bucket on one side, so adaptive execution splits the other. Pointer and surroundings together are a
key of 128 bits of BLAKE2b, and no decision rests on less.

Defined results: a null text is empty and, like any of fewer than ``SPAN`` bytes, left as it is. Strings never cross two
texts. Fully equal rows are separate documents, so all they hold of ``SPAN`` bytes and more goes from both; rows that
share a ``doc_id`` are told apart by a hash of their text. A cut may fall inside a character, so what is kept is binary.
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlane.llm import text_arrays as ta
from fraudlane.scratch import materialise

SPAN, GRAM, WIDTHS = 200, 40, (32, 8, 1)
_NO_ID = -(1 << 63)
_BLOCK = 1 << 20
_PLACE_BITS = np.uint64(24)
_PLACE = np.uint64((1 << 24) - 1)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MARK = "doc_id long, fp long, places array<int>, low int, high int, core long, hull long"
_PART = "doc_id long, fp long, place int, low int, high int, done boolean, bytes binary, blocks array<struct<first:int,core:long,hull:long>>"


def _gram_hashes(buffer: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each run of ``gram`` bytes, from those of half the length."""
    have, width, out, covered = ta.mix(buffer.astype(np.uint64) + np.uint64(1)), 1, None, 0
    while True:
        if gram & width:
            if out is None:
                out = have
            else:
                size = min(len(have), len(out) - width)
                out = have[:size] * _FACTOR + out[width : width + size]
                out ^= out >> np.uint64(29)
            covered += width
        if covered == gram:
            return ta.mix(out[: len(buffer) - gram + 1].copy())
        have = have[:-width] * _FACTOR + have[width:]
        have ^= have >> np.uint64(32)
        width *= 2


def _window_minima(values: np.ndarray, size: int) -> np.ndarray:
    width = 1
    while 2 * width <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = size - width
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def find_anchors(buffer: np.ndarray, offsets: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first place, last place, anchor) of runs of places that have one anchor; every place with ``span`` bytes of its text is in one."""
    found = []
    for at in range(0, len(buffer) - span + 1, _BLOCK):
        part = buffer[at : at + _BLOCK + span - 1]
        values = _gram_hashes(part, gram)
        # The place breaks ties and tells which run it was.
        values = (values >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(values), dtype=np.uint64)
        anchor = (_window_minima(values, span - gram + 1) & _PLACE).astype(np.int64) + at
        inside = np.zeros(len(anchor) + 1, dtype=np.int8)
        first, last = offsets[:-1] - at, offsets[1:] - span + 1 - at
        own = (last > first) & (last > 0) & (first < len(anchor))
        first, last = np.maximum(first[own], 0), np.minimum(last[own], len(anchor))
        np.add.at(inside, first, 1)
        np.add.at(inside, last, -1)
        inside = np.cumsum(inside[:-1]).astype(bool)
        change = np.ones(len(anchor), dtype=bool)
        change[1:] = anchor[1:] != anchor[:-1]
        change[first] = True
        starts = np.flatnonzero(change & inside)
        ends = np.zeros(len(anchor) + 1, dtype=bool)
        ends[:-1] = change | ~inside
        ends[-1] = True
        stops = np.flatnonzero(ends)
        ends = stops[np.searchsorted(stops, starts, "right")]
        found.append((starts + at, ends + at - 1, anchor[starts]))
    if not found:
        return (np.zeros(0, dtype=np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _digests(pieces: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(pieces), dtype=np.int64)


def _marks(span: int, gram: int):
    """The anchors of each text, equal ones of one text together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ta.slices(batch, "text"):
                buffer, offsets = ta.text_buffer(part.column(2))
                first, last, anchor = find_anchors(buffer, offsets, span, gram)
                if not len(anchor):
                    continue
                raw = memoryview(np.ascontiguousarray(buffer))
                core = _digests([blake2b(raw[a : a + gram], digest_size=8).digest() for a in anchor.tolist()])
                hull = _digests(
                    [blake2b(raw[a:b], digest_size=8).digest() for a, b in zip(first.tolist(), (last + span).tolist(), strict=True)]
                )
                text = np.searchsorted(offsets, first, "right") - 1
                order = np.lexsort((anchor, hull, core, text))
                text, core, hull = text[order], core[order], hull[order]
                new = np.ones(len(order), dtype=bool)
                new[1:] = (text[1:] != text[:-1]) | (core[1:] != core[:-1]) | (hull[1:] != hull[:-1])
                heads = np.flatnonzero(new)
                rows, at = text[heads], order[heads]
                places = (anchor - offsets[np.searchsorted(offsets, first, "right") - 1])[order]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(rows)),
                        part.column(1).take(pa.array(rows)),
                        ta.list_column(places.astype(np.int32), np.append(heads, len(order))),
                        pa.array((anchor - last)[at].astype(np.int32)),
                        pa.array((anchor - first)[at].astype(np.int32)),
                        pa.array(core[heads]),
                        pa.array(hull[heads]),
                    ],
                    ["doc_id", "fp", "places", "low", "high", "core", "hull"],
                )

    return run


def _blocks(raw: bytes, high: int, low: int, span: int, first: int, last: int, pointer: int, width: int):
    """(first offset, core, hull) of the blocks of ``width`` of the offsets ``first`` to ``last``.

    ``raw`` holds the bytes from offset ``high`` before the anchor to the end of the string at offset ``low``.
    """
    lead = pointer.to_bytes(8, "little", signed=True)
    for a in range(first, last + 1, width):
        b = min(a + width - 1, last)
        if a > high or b < low:
            continue
        core = blake2b(lead, digest_size=8)
        core.update(a.to_bytes(2, "little"))
        core.update(raw[high - a : high - first])
        core.update(raw[high - last + span : high - b + span])
        hull = blake2b(raw[high - min(b, high) : high - max(a, low) + span], digest_size=8)
        yield a, core.digest(), hull.digest()


def _listed(found: list[list[tuple]]) -> pa.Array:
    """One list of (first, core, hull) for each member."""
    flat = [x for one in found for x in one]
    edge = np.concatenate([[0], np.cumsum([len(one) for one in found])]).astype(np.int32)
    columns = [pa.array([x[0] for x in flat], pa.int32()), pa.array(_digests([x[1] for x in flat])), pa.array(_digests([x[2] for x in flat]))]
    return pa.ListArray.from_arrays(pa.array(edge), pa.StructArray.from_arrays(columns, ["first", "core", "hull"]))


def _first_parts(span: int, gram: int, width: int):
    """Members with the bytes around them and their blocks, from whole texts and their members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ta.slices(batch, "text"):
                buffer, offsets = ta.text_buffer(part.column(2))
                raw = buffer.tobytes()
                items = part.column(3)
                rows = np.repeat(np.arange(part.num_rows), np.diff(items.offsets.to_numpy()))
                place, low, high, core, done = (items.flatten().field(i) for i in range(5))
                around, found = [], []
                each = zip(place.to_pylist(), low.to_pylist(), high.to_pylist(), core.to_pylist(), offsets[rows].tolist(), strict=True)
                for p, a, b, pointer, base in each:
                    own = raw[base + p - b : base + p - a + span]
                    around.append(own)
                    found.append(list(_blocks(own, b, a, span, 0, span - gram, pointer, width)))
                ids = [part.column(i).take(pa.array(rows)) for i in (0, 1)]
                columns = [*ids, place, low, high, done, pa.array(around, pa.binary()), _listed(found)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fp", "place", "low", "high", "done", "bytes", "blocks"])

    return run


def _next_parts(span: int, gram: int, wide: int, width: int):
    """Blocks of blocks: of each member with its bytes, the blocks of ``wide`` offsets that go on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            around, low, high = (column[x].to_pylist() for x in ("bytes", "low", "high"))
            rows, done, found = [], [], []
            for row, items in enumerate(column["items"].to_pylist()):
                for item in items:
                    first = item["first"]
                    last = min(first + wide - 1, span - gram)
                    rows.append(row)
                    done.append(item["done"])
                    found.append(list(_blocks(around[row], high[row], low[row], span, first, last, item["core"], width)))
            take = pa.array(rows, pa.int64())
            kept = [column[x].take(take) for x in ("doc_id", "fp", "place", "low", "high")]
            empty = pa.array([None] * len(rows), pa.binary())
            columns = [*kept, pa.array(done, pa.bool_()), empty, _listed(found)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fp", "place", "low", "high", "done", "bytes", "blocks"])

    return run


def _settle(marks: DataFrame, width: int, last: bool) -> tuple[DataFrame, DataFrame | None]:
    """(spans, members): what repeats for certain, as (doc_id, fp, span), and what has to be refined.

    ``marks`` has doc_id, fp, places, low, high, first, done, core and hull; the offsets of a mark are ``width`` from
    ``first`` on, as far as they lie from ``low`` to ``high``. Members that are done stand for others that are equal.
    """
    n = F.sum(F.size("places")).alias("n")
    shared = marks.groupBy("core").agg(n, F.min("hull").alias("lo"), F.max("hull").alias("hi")).where("n > 1")
    joined = marks.join(shared.select("core", (F.col("lo") < F.col("hi")).alias("mixed")), "core")
    joined = materialise(joined, "repeated_grams")
    alike, mixed = joined.where("NOT mixed"), joined.where("mixed")
    members = None
    if not last:
        one = [F.first(c).alias(c) for c in ("doc_id", "fp", "low", "high", "first", "done")]
        hulls = materialise(mixed.groupBy("core", "hull").agg(n, F.first(F.get("places", F.lit(0))).alias("place"), *one), "hulls")
        alike = alike.unionByName(mixed.join(hulls.where("n > 1").select("core", "hull"), ["core", "hull"]))
        members = hulls.select("doc_id", "fp", "place", "low", "high", "first", "core", (F.col("done") | (F.col("n") > 1)).alias("done"))
    low, high = F.greatest("low", "first"), F.least("high", F.col("first") + (width - 1))
    return alike.where("NOT done").select("doc_id", "fp", F.explode("places").alias("place"), low.alias("low"), high.alias("high")), members


def _exploded(parts: DataFrame) -> DataFrame:
    each = parts.select("doc_id", "fp", F.array("place").alias("places"), "low", "high", "done", F.explode("blocks").alias("b"))
    return each.select("doc_id", "fp", "places", "low", "high", "done", "b.first", "b.core", "b.hull")


def repeated_spans(texts: DataFrame, span: int = SPAN, gram: int = GRAM, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """(doc_id, fp, spans) of ``texts`` (doc_id, fp, text) with anything repeated; spans are (start, end), in no order."""
    marks = materialise(texts.select("doc_id", "fp", "text").mapInArrow(_marks(span, gram), _MARK), "anchors")
    marks = marks.withColumn("first", F.lit(0)).withColumn("done", F.lit(False))
    found, members = _settle(marks, span - gram + 1, False)
    item = F.struct("place", "low", "high", "core", "done")
    items = members.groupBy("doc_id", "fp").agg(F.collect_list(item).alias("items"))
    whole = texts.join(items, ["doc_id", "fp"]).select("doc_id", "fp", "text", "items")
    parts = materialise(whole.mapInArrow(_first_parts(span, gram, widths[0]), _PART), "around_anchors")
    around = parts.select("doc_id", "fp", "place", "low", "high", "bytes")
    for i, width in enumerate(widths):
        spans, members = _settle(_exploded(parts), width, i + 1 == len(widths))
        found = found.unionByName(spans)
        if members is not None:
            own = ["doc_id", "fp", "place", "low", "high"]
            items = members.groupBy(*own).agg(F.collect_list(F.struct("first", "core", "done")).alias("items"))
            whole = around.join(items, own)
            parts = materialise(whole.mapInArrow(_next_parts(span, gram, width, widths[i + 1]), _PART), "blocks")
    one = F.struct((F.col("place") - F.col("high")).alias("start"), (F.col("place") - F.col("low") + span).alias("end"))
    return found.select("doc_id", "fp", one.alias("span")).groupBy("doc_id", "fp").agg(F.collect_set("span").alias("spans"))


def merge_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the spans, in order."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    head = np.ones(len(start), dtype=bool)
    head[1:] = start[1:] > end[:-1]
    tail = np.ones(len(start), dtype=bool)
    tail[:-1] = head[1:]
    return start[head], end[tail]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in ta.slices(batch, "text"):
            buffer, offsets = ta.text_buffer(part.column(1))
            raw, spans = buffer.tobytes(), part.column(2)
            bounds = spans.offsets.to_numpy()
            start, end = (spans.values.field(i).to_numpy().astype(np.int64) for i in (0, 1))
            kept, removed, runs = [], [], []
            for i in range(part.num_rows):
                a, b = merge_spans(start[bounds[i] : bounds[i + 1]], end[bounds[i] : bounds[i + 1]])
                base, stop = int(offsets[i]), int(offsets[i + 1])
                edges = [base, *(base + np.stack([a, b], axis=1).ravel()).tolist(), stop]
                kept.append(b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)))
                removed.append(int((b - a).sum()))
                runs.append(len(a))
            columns = [part.column(0), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeated_bytes(docs: DataFrame, span: int = SPAN, gram: int = GRAM, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and ``kept``, the bytes that are left, for every row of ``docs`` (doc_id, text)."""
    given: Column = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))
    texts = docs.select(given.alias("doc_id"), F.xxhash64("text").alias("fp"), "text")
    spans = materialise(repeated_spans(texts, span, gram, widths), "repeated_bytes")
    none = F.array().cast("array<struct<start:int,end:int>>")
    joined = texts.join(spans, ["doc_id", "fp"], "left").select("doc_id", "text", F.coalesce("spans", none).alias("spans"))
    out = joined.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(_NO_ID)))
