"""Near-duplicate documents by a multi-index Hamming join of MinHash signatures.

A document is the set of its runs of ``shingle_words`` words. Each of 64 MinHash values is kept to 8 bits. The
signature is split into ten chunks of six bytes, in each of which one byte may be wrong, and one of four bytes,
in which none may. By the pigeonhole principle two signatures that differ in at most 20 bytes agree, within the
allowed error, in at least one chunk. The allowed error is enumerated by leaving out each byte of a chunk in
turn, so agreement is equality of a key. Every pair within distance 20 therefore shares a key, and shared keys
are compared on the whole sets (``linking.link_classes``).

At a similarity of 0.85 a byte differs with probability 0.15; a pair shares no key with probability 3e-7. That is the
only loss: of pairs that share a key, none is left out but by bounds that prove it to be no link.

Defined results: a null or blank text has no words, an empty set and no links. Texts with the same word sequence
are one class and linked. Repeated rows are answered once each; rows that share a ``doc_id`` are one node of the
relation if their texts are equal and separate ones if not. A null ``doc_id`` never becomes a ``component_id``
unless every row of the component lacks one. Extra columns are ignored, whatever their names. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlane.llm import text_arrays as ta
from fraudlane.llm.linking import link_classes
from fraudlane.scratch import discard, materialise, temporary_rows

LANES, LONG_WORD = 64, 256
_NO_ID = -(1 << 63)
MAX_DISTANCE = 20
CHUNKS = [(6 * i, 6, 1) for i in range(10)] + [(60, 4, 0)]
assert sum(errors + 1 for _, _, errors in CHUNKS) >= MAX_DISTANCE + 1

_RANDOM = np.random.default_rng(20)
_XOR = _RANDOM.integers(0, 1 << 63, LANES, dtype=np.uint64)
_ODD = _RANDOM.integers(0, 1 << 63, LANES, dtype=np.uint64) | np.uint64(1)


def word_hashes(words: ta.Words) -> np.ndarray:
    """Hashes of words; of long ones by BLAKE2b, since long words are known that collide under any polynomial modulo 2**64."""
    hashes = words.hashes()
    for i in np.flatnonzero(words.ends - words.starts > LONG_WORD):
        digest = blake2b(words.buffer[words.starts[i] : words.ends[i]].tobytes(), digest_size=8).digest()
        hashes[i] = int.from_bytes(digest, "little")
    return hashes


def sequence_hashes(words: ta.Words) -> np.ndarray:
    """BLAKE2b of the words of each text, one space between them."""
    n = len(words.starts)
    edge = np.zeros(len(words.buffer) + 1, dtype=np.int8)
    edge[words.starts] += 1
    edge[words.ends] -= 1
    inside = np.cumsum(edge[:-1]).astype(bool)
    # Each word with one byte after it, which no word has.
    size = words.ends - words.starts + 1
    ends = np.concatenate([[0], np.cumsum(size)])
    packed = np.full(int(ends[-1]), 0x20, dtype=np.uint8)
    held = np.ones(len(packed), dtype=bool)
    held[ends[1:] - 1] = False
    packed[held] = words.buffer[inside]
    raw, bounds = memoryview(packed), ends[words.bounds] if n else np.zeros(len(words.bounds), dtype=np.int64)
    digests = [blake2b(raw[a:b], digest_size=8).digest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    return np.frombuffer(b"".join(digests), dtype=np.uint64)


def shingles(words: ta.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles and their bounds for each text, repeats included."""
    hashes = word_hashes(words)
    first, values = ta.windows(words, hashes, size)
    count = np.diff(words.bounds)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        first = np.concatenate([first, words.bounds[short]])
        values = np.concatenate([values, ta.run_hashes(hashes, words.bounds[short], words.bounds[short + 1])])
        order = np.argsort(first, kind="stable")
        first, values = first[order], values[order]
    return values, np.searchsorted(first, words.bounds)


def signatures(values: np.ndarray, bounds: np.ndarray, lanes: int = LANES) -> np.ndarray:
    """(text, lane) bytes: the low byte of each MinHash value; texts without shingles get zeros."""
    out = np.zeros((len(bounds) - 1, lanes), dtype=np.uint8)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if len(full):
        heads = bounds[full]
        for lane in range(lanes):
            least = np.minimum.reduceat((values ^ _XOR[lane]) * _ODD[lane], heads)
            out[full, lane] = ta.mix(least).astype(np.uint8)
    return out


def chunk_keys(signature: np.ndarray) -> np.ndarray:
    """(text, key) 64-bit keys: every chunk with every allowed choice of bytes left out."""
    keys = []
    wide = signature.astype(np.uint64)
    for at, size, errors in CHUNKS:
        for left_out in range(size if errors else 1):
            key = np.full(len(wide), at * 16 + left_out, dtype=np.uint64)
            for byte in range(size):
                if not errors or byte != left_out:
                    key = key * np.uint64(257) + wide[:, at + byte]
            keys.append(ta.mix(key))
    return np.stack(keys, axis=1)


def _index(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ta.slices(batch, "text"):
                words = ta.find_words(*ta.text_buffer(part.column(1)), ta.NOT_SPACE, lower=True)
                values, bounds = shingles(words, size)
                distinct = [len(np.unique(values[a:b])) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                signature = signatures(values, bounds)
                keys = chunk_keys(signature)
                # The class is the word sequence, so texts with equal classes need no comparison.
                node = sequence_hashes(words)
                edge = np.arange(len(distinct) + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array(np.array(distinct, dtype=np.int64)),
                        pa.array(node.view(np.int64)),
                        ta.list_column(keys.view(np.int64).ravel(), edge * keys.shape[1]),
                        ta.list_column(signature.view(np.int64).ravel(), edge * (LANES // 8)),
                    ],
                    ["doc_id", "fp", "n_shingles", "node", "keys", "sig"],
                )

    return run


def _items(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ta.slices(batch, "text"):
                words = ta.find_words(*ta.text_buffer(part.column(1)), ta.NOT_SPACE, lower=True)
                values, bounds = shingles(words, size)
                sets = [np.unique(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
                items = np.concatenate(sets)
                columns = [part.column(0), ta.list_column(items.view(np.int64), ends)]
                yield pa.RecordBatch.from_arrays(columns, ["node", "items"])

    return run


def _verified(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ta.slices(batch, "text_a", "text_b"):
                sets = []
                for column in (2, 3):
                    words = ta.find_words(*ta.text_buffer(part.column(column)), ta.NOT_SPACE, lower=True)
                    values, bounds = shingles(words, size)
                    sets.append([np.unique(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
                keep = []
                for a, b in zip(*sets, strict=True):
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    keep.append(100 * common >= percent * (len(a) + len(b) - common) > 0)
                yield pa.RecordBatch.from_arrays(part.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, a hash of the text, ``fp``, and ``component``, a name of the component that
    does not depend on ids (null without words), for every row of ``docs`` (doc_id, text).

    Two documents are linked when 100 * |intersection| >= ``percent`` * |union| of their shingle sets;
    ``component_id`` is the smallest ``doc_id`` reachable over links.
    """
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id"), "text")
    # An id with the hash of its text names a row's text even where ids repeat.
    docs = docs.withColumn("fp", F.xxhash64("text"))
    indexed = materialise(
        docs.mapInArrow(_index(shingle_words), "doc_id long, fp long, n_shingles long, node long, keys array<long>, sig array<long>"),
        "shingle_index",
    )
    filled = indexed.where("n_shingles > 0")
    classes = materialise(filled.selectExpr("node", "doc_id", "fp", "keys", "sig").dropDuplicates(["node"]), "classes")
    # The keys are most of the index, and those of the classes are enough.
    whole, indexed = indexed, materialise(indexed.select("doc_id", "fp", "n_shingles", "node"), "shingle_counts")
    filled = indexed.where("n_shingles > 0")
    discard(whole)

    def texts(nodes: DataFrame) -> DataFrame:
        """The text of one row of each class is read again."""
        places = classes.join(nodes, "node").select("node", "doc_id", "fp")
        return docs.join(places, ["doc_id", "fp"]).select("node", "text").dropDuplicates(["node"])

    def verify(pairs: DataFrame) -> DataFrame:
        return pairs.mapInArrow(_verified(shingle_words, percent), "a long, b long")

    def contents(nodes: DataFrame) -> DataFrame:
        return nodes.mapInArrow(_items(shingle_words), "node long, items array<long>")

    _, roots = link_classes(classes, texts, verify, contents, percent, LANES // 8)
    given = F.nullif("doc_id", F.lit(_NO_ID))
    least = filled.groupBy("node").agg(F.min(given).alias("least"))
    rooted = least.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = rooted.groupBy("root").agg(F.min("least").alias("first"))
    named = materialise(rooted.join(first, "root").select("node", "first", F.col("root").alias("component")), "component_ids")
    discard(classes, roots)
    out = indexed.select(given.alias("doc_id"), "fp", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("node")).alias("node"))
    return out.join(named, "node", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("first", "doc_id").alias("component_id"),
        F.coalesce(F.col("first") == F.col("doc_id"), F.lit(True)).alias("kept"),
        "fp",
        "component",
    )


def drop_near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component; all columns stay.

    The row with the smallest ``doc_id`` stays, of several with that id the one whose text has the smallest hash, and
    of equal ones any. A component of rows without an id keeps one of them; null ids come last. Rows without words
    have no component and stay.
    """
    # A row is known by its id and the hash of its text; rows that share both are copies.
    one, key = F.struct(F.col("doc_id").isNull().alias("anon"), "doc_id", "fp"), ["_near_id", "_near_text"]
    named = [F.coalesce("doc_id", F.lit(_NO_ID)).alias("_near_id"), F.col("fp").alias("_near_text")]
    with temporary_rows(docs.sparkSession) as keep:
        found = near_duplicates(docs, shingle_words, percent).where("n_shingles > 0")
        known = materialise(found.groupBy("doc_id", "fp", "component").agg(F.count("*").alias("n")), "near_rows")
        ranked = known.join(known.groupBy("component").agg(F.min(one).alias("first")), "component")
        gone = materialise(ranked.where(one != F.col("first")).select(*named), "near_copies")
        repeated = materialise(ranked.where((one == F.col("first")) & (F.col("n") > 1)).select(*named), "near_repeats")
        keep(gone, repeated)
    own = F.struct(*(docs[c] for c in docs.columns)).alias("_row")
    rows = docs.select(
        own, F.coalesce(docs["doc_id"].cast("long"), F.lit(_NO_ID)).alias("_near_id"), F.xxhash64(docs["text"]).alias("_near_text")
    )
    left = rows.join(gone, key, "left_anti")
    if not repeated.isEmpty():
        # One of each group of copies, by an aggregate that is merged before the shuffle.
        among = rows.join(repeated, key, "left_semi").groupBy(*key).agg(F.first("_row").alias("_row"))
        left = left.join(repeated, key, "left_anti").select("_row").unionByName(among.select("_row"))
    return left.select("_row.*")
