"""Language of a text by word-first backoff.

A word known from training gives each language the logarithm of its smoothed relative frequency there. A word that
is not known falls back to character n-grams of the bounded word: the longest length of which any n-gram is known
gives the mean of its n-grams' values, and a word of which nothing is known says nothing. The language with the
largest sum wins; the score is its share after at most ``EVIDENCE`` words' worth of evidence is put through a softmax.

Words are runs of letters, lower-cased. The model is fitted on a bounded sample, ``SAMPLE_DOCS`` labelled documents
expected, taken by a hash of their ids; counts are made by Spark, and only the ``TOP_WORDS`` most frequent words and
``TOP_GRAMS`` most frequent n-grams of each length of a language come to the driver and go to the tasks. Every
document is scored on its whole text.

Defined results: a null text, or one without a letter, is ``und`` with score 0. A text with letters of which the model
knows nothing gets the most frequent training language with its share of the training documents; without any training
documents every text is ``und``. Ties go to the smaller language code. Repeated rows are answered once each; a null
``doc_id`` is never held out and is not learned from; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlane.llm import text_arrays as ta
from fraudlane.scratch import materialise, unique_name

SAMPLE_DOCS = 20_000
TOP_WORDS, TOP_GRAMS = 20_000, 8_000
GRAM_SIZES = (5, 4, 3, 2, 1)
EVIDENCE = 20
_CACHE_WORDS = 200_000
_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def grams_of(word: str, size: int) -> list[str]:
    """Runs of ``size`` characters of the word between two marks; of size 1, its letters."""
    if size == 1:
        return list(word)
    bounded = f"<{word}>"
    return [bounded[i : i + size] for i in range(len(bounded) - size + 1)]


@dataclass
class LanguageModel:
    """``tables[0]`` has the words and ``tables[n]`` the n-grams: name to log frequencies, one for each language."""

    languages: list[str]
    prior: np.ndarray
    tables: dict[int, dict[str, np.ndarray]]

    def backoff(self, word: str) -> np.ndarray | None:
        for size in GRAM_SIZES:
            table = self.tables[size]
            known = [v for g in grams_of(word, size) if (v := table.get(g)) is not None]
            if known:
                return np.mean(known, axis=0)
        return None


class Scorer:
    """Looks words up as rows of one matrix; rows of unseen words are made once and dropped when there are many."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.known = list(model.tables[0].values())
        self.clear()

    def clear(self) -> None:
        self.place = {w: i + 1 for i, w in enumerate(self.model.tables[0])}
        n = len(self.known) + 1
        self.rows = np.zeros((n + _CACHE_WORDS, len(self.model.languages)))
        self.rows[1:n] = self.known if self.known else 0
        self.used = n

    def unseen(self, word: str) -> int:
        vector = self.model.backoff(word)
        if vector is None:
            at = 0
        else:
            at, self.used = self.used, self.used + 1
            self.rows[at] = vector
        if len(self.place) < len(self.known) + _CACHE_WORDS:
            self.place[word] = at
        return at

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text) if text else []
        # A run can consist of numerals such as superscripts alone, so letters are looked for.
        if not self.model.languages or not any(c.isalpha() for w in words for c in w):
            return "und", 0.0
        total, count = self.model.prior, 0
        at = 0
        while at < len(words):
            # Whole texts, a block of words at a time, so that a block's unseen words fit the cache.
            block = words[at : at + _CACHE_WORDS // 2]
            if self.used + len(block) > len(self.rows):
                self.clear()
            place, unseen = self.place, self.unseen
            rows = np.array([place[w] if w in place else unseen(w) for w in block])
            total = total + self.rows[rows].sum(axis=0)
            count += int(np.count_nonzero(rows))
            at += len(block)
        best = int(np.argmax(total))
        evidence = total if not count else self.model.prior + (total - self.model.prior) * min(1, EVIDENCE / count)
        share = np.exp(evidence - evidence.max())
        return self.model.languages[best], float(share[best] / share.sum())


_SCORERS: dict[str, Scorer] = {}


def _scorer(name: str, broadcast) -> Scorer:
    """One scorer for each Python worker, kept from task to task."""
    if name not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[name] = Scorer(broadcast.value)
    return _SCORERS[name]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, size, name, n) of the words (size 0) and n-grams of each slice of texts."""
    for batch in batches:
        for part in ta.slices(batch, "text"):
            counts: dict[str, list[Counter]] = {}
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                own = counts.setdefault(lang, [Counter() for _ in range(6)])
                own[0].update(words_of(text or ""))
            for own in counts.values():
                for word, n in own[0].items():
                    for size in GRAM_SIZES:
                        for gram in grams_of(word, size):
                            own[size][gram] += n
            rows = [(lang, size, name, n) for lang, own in counts.items() for size in range(6) for name, n in own[size].items()]
            if rows:
                lang, size, name, n = zip(*rows, strict=True)
                columns = [pa.array(lang, pa.string()), pa.array(size, pa.int32()), pa.array(name, pa.string()), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "size", "name", "n"])


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> LanguageModel:
    """Fit on about ``sample_docs`` of the rows with a language, an id and a text."""
    known = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", "text")
    share = min(1.0, sample_docs / max(1, known.select("doc_id").count()))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)
    per_language = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    counts = known.select("lang", "text").mapInArrow(_counted, "lang string, size int, name string, n long")
    counts = materialise(counts.groupBy("lang", "size", "name").agg(F.sum("n").alias("n")), "language_counts")
    totals = {(r.lang, r["size"]): (r.n, r.kinds) for r in counts.groupBy("lang", "size").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect()}
    rank = F.row_number().over(Window.partitionBy("lang", "size").orderBy(F.desc("n"), "name"))
    top = counts.withColumn("place", rank).where(F.col("place") <= F.when(F.col("size") == 0, TOP_WORDS).otherwise(TOP_GRAMS))
    # A name that is frequent in one language needs its counts in all of them.
    rows = counts.join(top.select("size", "name").distinct(), ["size", "name"]).select("lang", "size", "name", "n").toArrow()
    languages = sorted(per_language)
    total_docs = sum(per_language.values())
    prior = np.log([per_language[x] / total_docs for x in languages]) if languages else np.zeros(0)
    at = {x: i for i, x in enumerate(languages)}
    n, kinds = np.ones((6, len(languages))), np.ones((6, len(languages)))
    for (lang, size), (sum_, distinct) in totals.items():
        n[size, at[lang]], kinds[size, at[lang]] = sum_, distinct
    raw: dict[int, dict[str, np.ndarray]] = {size: {} for size in range(6)}
    for row in rows.to_pylist():
        vector = raw[row["size"]].setdefault(row["name"], np.zeros(len(languages)))
        vector[at[row["lang"]]] = row["n"]
    tables = {size: {name: np.log((v + 0.5) / (n[size] + 0.5 * kinds[size])) for name, v in sorted(t.items())} for size, t in raw.items()}
    return LanguageModel(languages, prior, tables)


def _predicted(name: str, broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(name, broadcast)
        for batch in batches:
            for part in ta.slices(batch, "text"):
                found = [scorer.predict(text.as_py()) for text in part.column(1)]
                lang, score = pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())
                yield pa.RecordBatch.from_arrays([part.column(0), lang, score], ["doc_id", "lang_pred", "score"])

    return run


def held_out():
    """Rows kept from training: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def identify_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred and score of every row of ``docs`` (doc_id, text)."""
    broadcast = docs.sparkSession.sparkContext.broadcast(model)
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return scored.mapInArrow(_predicted(unique_name("languages"), broadcast), "doc_id long, lang_pred string, score double")


def language_of_documents(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Learns from rows not held out, then predicts every row: doc_id, held_out, lang_pred, score."""
    model = train(docs.where(~held_out()), sample_docs)
    return identify_language(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
