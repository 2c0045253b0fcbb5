"""Words of a batch of texts as NumPy arrays.

Used inside Arrow tasks. A batch arrives as one UTF-8 buffer with offsets; words are found by a byte
table and hashed with a polynomial over their bytes, so no Python object is made for a word. Batches are
cut to about ``SLICE_BYTES`` of text, and the hash runs over blocks of that size, so a very long text
costs a few bytes for each of its bytes and no more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
_HASH_BLOCK = 1 << 20
_ODD = 0x9E3779B97F4A7C15
_U64 = np.uint64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Of lower-cased text: digits, a-z and everything outside ASCII.
LETTER_OR_DIGIT = np.zeros(256, dtype=bool)
LETTER_OR_DIGIT[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=_U64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Table:
    """Powers of an odd number and of its inverse modulo 2**64, made longer on demand."""

    def __init__(self, base: int):
        self.base, self.inverse, self.n = base, pow(base, -1, 1 << 64), 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, 2 * self.n, 1024)
            self.up, self.down = _powers(self.base, self.n), _powers(self.inverse, self.n)
        return self.up, self.down


_BYTES, _WORDS = _Table(_ODD), _Table(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal in, equal out, and near values far apart."""
    h = h ^ (h >> _U64(33))
    h *= _U64(0xFF51AFD7ED558CCD)
    h ^= h >> _U64(33)
    h *= _U64(0xC4CEB9FE1A85EC53)
    h ^= h >> _U64(33)
    return h


@dataclass
class Words:
    """``bounds[d] : bounds[d + 1]`` are the words of text ``d``; ``starts`` and ``ends`` are byte places."""

    buffer: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def n_texts(self) -> int:
        return len(self.offsets) - 1

    def hashes(self) -> np.ndarray:
        """A hash of each word's bytes, with A-Z as a-z if the words were found so."""
        return span_hashes(self.buffer, self.starts, self.ends)


def span_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash ``buffer[starts[i]:ends[i]]`` for ascending, disjoint spans."""
    out = np.empty(len(starts), dtype=_U64)
    at = 0
    while at < len(starts):
        first = int(starts[at])
        stop = max(at + 1, int(np.searchsorted(ends, first + _HASH_BLOCK, "right")))
        block = buffer[first : int(ends[stop - 1])]
        up, down = _BYTES.upto(len(block) + 1)
        total = np.zeros(len(block) + 1, dtype=_U64)
        np.cumsum((block.astype(_U64) + _U64(1)) * up[: len(block)], out=total[1:])
        a, b = starts[at:stop] - first, ends[at:stop] - first
        out[at:stop] = (total[b] - total[a]) * down[a]
        at = stop
    return mix(out)


def find_words(buffer: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, lower: bool) -> Words:
    """Maximal runs of bytes in ``is_word``, never across two texts."""
    if lower:
        buffer = LOWER[buffer]
    inside = is_word[buffer]
    n = len(buffer)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return Words(buffer, offsets, none, none, np.zeros(len(offsets), dtype=np.int64))
    before, after = np.empty(n, dtype=bool), np.empty(n, dtype=bool)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    heads = offsets[:-1]
    before[heads[heads < n]] = False
    tails = offsets[1:]
    after[tails[tails > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(buffer, offsets, starts, ends, np.searchsorted(starts, offsets))


def run_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash the word runs ``words[starts[i]:ends[i]]``; runs may overlap."""
    if not len(starts):
        return np.zeros(0, dtype=_U64)
    up, down = _WORDS.upto(len(words) + 1)
    total = np.zeros(len(words) + 1, dtype=_U64)
    np.cumsum((words | _U64(1)) * up[: len(words)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U64))


def windows(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every run of ``size`` consecutive words of one text."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=_U64)
    whole = np.ones(n, dtype=bool)
    for back in range(1, size):
        cut = words.bounds[1:-1] - back
        whole[cut[(cut >= 0) & (cut < n)]] = False
    first = np.flatnonzero(whole)
    return first, run_hashes(hashes, first, first + size)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[places[0] : places[-1]], places - places[0]


def slices(batch: pa.RecordBatch, *texts: str) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of about ``SLICE_BYTES`` of the named columns, whole rows each."""
    if not batch.num_rows:
        return
    size = sum(np.diff(text_buffer(batch.column(batch.schema.get_field_index(t)))[1]) for t in texts)
    total = np.cumsum(size)
    at = 0
    while at < batch.num_rows:
        done = total[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(total, done + SLICE_BYTES, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def list_column(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """``values`` cut at ``bounds`` as a list column."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))
