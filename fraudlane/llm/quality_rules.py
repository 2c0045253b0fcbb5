"""Quality rules: a learned decision list over text statistics; DataFrame functions only.

Statistics of each text are computed in one expression without a shuffle. Rules are learned by sequential covering: a
rule is a conjunction of thresholds that names bad documents. It is grown on two thirds of the sample by the literal
with the most information gain (from counts of quantile bins, one small aggregate for each step), pruned on the other
third to the prefix with the best balance of right and wrong, and kept while it is right more often than wrong; what
it covers is set aside for the next rule. The list is applied as one ordered conditional expression; a document that
no rule names is kept.

Only the ``SAMPLE_DOCS`` labelled documents with the smallest hashes are learned from (a documented bound); all
documents are judged on their whole texts. The driver sees counts of bins, never rows.

Defined results: a null, empty or blank text has no words, all counts 0, and fails the base rule. Statistics that would
divide by zero are 0. Without labelled documents, or with one class only, there are no rules. Several labels of one
document count as bad if one of them is; a null label counts as none. Repeated rows are answered once each; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlane.scratch import materialise

SAMPLE_DOCS = 6_000
BINS, MAX_CONDITIONS, MAX_RULES = 32, 4, 12
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"
STATISTICS = (
    "n_words", "word_length", "symbol_share", "upper_share", "mark_share", "digit_share", "dup_line_share",
    "repeat_word_share", "words_per_line",
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), use)[0]


def _of(text: str, characters: str) -> Column:
    """How many characters of the class ``text`` has."""
    return F.length(F.regexp_replace(text, f"[^{characters}]+", ""))


def _repeated_words(words: Column) -> Column:
    """How many words lie in a window of three words that occurs twice or more."""
    windows = F.when(F.size(words) < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2])
        )
    )

    def places(hashes: Column) -> Column:
        """Sorted (hash, place) pairs put equal windows side by side."""
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def again(s: Column) -> Column:
            twice = F.filter(
                s,
                lambda x, j: ((j > 0) & F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False)))
                | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)),
            )
            return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

        return _let(pairs, again)

    # Most texts are done after the first, cheaper test: as many distinct windows as windows.
    return _let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(places(h)))


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts and further counts of every text."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\f\r"))) > 0)
    counted = text.select(
        "doc_id",
        _let(
            F.regexp_extract_all("text", F.lit(_WORD), 0),
            lambda w: F.struct(F.size(w).alias("n_words"), _repeated_words(w).alias("n_repeat_words")),
        ).alias("w"),
        F.length(F.regexp_replace("text", _SPACE, "")).cast("long").alias("word_chars"),
        _of("text", r"#*$%&|<>").cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))).alias("l"),
        _of("text", "A-Z").alias("n_upper"),
        _of("text", "!?").alias("n_marks"),
        _of("text", "0-9").alias("n_digits"),
    )
    return counted.select(
        "doc_id", F.col("w.n_words").cast("long").alias("n_words"), "word_chars", "n_symbols",
        F.col("l.dup").cast("long").alias("n_dup_lines"), F.col("w.n_repeat_words").cast("long").alias("n_repeat_words"),
        F.col("l.n").alias("n_lines"), "n_upper", "n_marks", "n_digits",
    )


def statistics() -> list[Column]:
    """The statistics rules speak of, from the columns of ``text_counts``."""

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)

    return [
        F.col("n_words").cast("double"), share("word_chars", "n_words"), share("n_symbols", "word_chars"),
        share("n_upper", "word_chars"), share("n_marks", "word_chars"), share("n_digits", "word_chars"),
        share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words"), share("n_words", "n_lines"),
    ]


def base_failed() -> Column:
    few = F.col("n_words") < MIN_WORDS
    return few | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    bound: float

    def column(self) -> Column:
        value = F.col(self.statistic)
        return value > self.bound if self.above else value <= self.bound

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.bound:g}"


Rule = tuple[Condition, ...]


def holds(rule: Rule) -> Column:
    out = F.lit(True)
    for condition in rule:
        out = out & condition.column()
    return out


def verdict(rules: list[Rule]) -> Column:
    """The place from 1 of the first rule that names the document bad; null if none does."""
    out = F.lit(None).cast("int")
    for i, rule in reversed([*enumerate(rules, 1)]):
        out = F.when(holds(rule), i).otherwise(out)
    return out


def _binned(rows: DataFrame) -> tuple[DataFrame, dict[str, list[float]]]:
    """Adds ``bins``, for each statistic the number of cuts below its value; the cuts are approximate quantiles."""
    shares = [i / BINS for i in range(1, BINS)]
    found = rows.agg(*(F.percentile_approx(s, shares, 10_000).alias(s) for s in STATISTICS)).first()
    cuts = {s: sorted(set(found[s] or ())) for s in STATISTICS}
    bins = [sum((F.when(F.col(s) > c, 1).otherwise(0) for c in cuts[s]), F.lit(0)) for s in STATISTICS]
    return rows.withColumn("bins", F.array(*bins)), cuts


def _best_literal(rows: DataFrame, cuts: dict[str, list[float]]) -> tuple[Condition, int, int] | None:
    """The condition with the most gain on ``rows``, with the bad and good documents it leaves."""
    counts = rows.select(F.posexplode("bins").alias("s", "bin"), "bad").groupBy("s", "bin").agg(
        F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")
    )
    table: dict[int, dict[int, tuple[int, int]]] = {}
    for r in counts.collect():
        table.setdefault(r.s, {})[r.bin] = (r.p, r.n)
    best, best_gain = None, 1e-9
    for s, name in enumerate(STATISTICS):
        own = table.get(s, {})
        all_p, all_n = (sum(x[i] for x in own.values()) for i in (0, 1))
        if not all_p:
            continue
        low_p = low_n = 0
        for i, cut in enumerate(cuts[name]):
            p, n = own.get(i, (0, 0))
            low_p, low_n = low_p + p, low_n + n
            for above, p, n in ((False, low_p, low_n), (True, all_p - low_p, all_n - low_n)):
                if p:
                    gain = p * (math.log2(p / (p + n)) - math.log2(all_p / (all_p + all_n)))
                    if gain > best_gain:
                        best, best_gain = (Condition(name, above, cut), p, n), gain
    return best


def learn_rules(rows: DataFrame) -> list[Rule]:
    """An ordered list of rules that name bad documents, from ``statistics`` columns, ``bad`` 0/1 and ``grow``."""
    rows, cuts = _binned(materialise(rows, "rule_statistics"))
    rows = materialise(rows, "rule_sample")
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        left = rows.where(verdict(rules).isNull())
        rule: Rule = ()
        while len(rule) < MAX_CONDITIONS:
            found = _best_literal(left.where("grow").where(holds(rule)), cuts)
            if found is None:
                break
            rule += (found[0],)
            if not found[2]:
                break
        if not rule:
            break
        prefixes = [rule[:i] for i in range(1, len(rule) + 1)]
        sums = [F.sum(F.when(holds(x), y).otherwise(0)) for x in prefixes for y in (F.col("bad"), 1 - F.col("bad"))]
        pruned = left.where("NOT grow").agg(*sums).first()
        p = [pruned[2 * i] or 0 for i in range(len(prefixes))]
        n = [pruned[2 * i + 1] or 0 for i in range(len(prefixes))]
        worth = [(a - b) / (a + b) if a + b else -1.0 for a, b in zip(p, n, strict=True)]
        at = max(range(len(prefixes)), key=lambda i: (worth[i], -i))
        if worth[at] <= 0:
            break
        rules.append(_centred(left.where("grow"), prefixes[at]))
    return rules


def _centred(rows: DataFrame, rule: Rule) -> Rule:
    """Each bound moved half way from the values left out to those of the bad documents named."""
    sums = []
    for i, c in enumerate(rule):
        value = F.col(c.statistic)
        named, out = F.when(holds(rule) & (F.col("bad") == 1), value), F.when(~c.column(), value)
        ends = (F.min(named), F.max(out)) if c.above else (F.max(named), F.min(out))
        sums += [ends[0].alias(f"in{i}"), ends[1].alias(f"out{i}")]
    found = rows.agg(*sums).first()
    bounds = [(found[f"in{i}"], found[f"out{i}"]) for i in range(len(rule))]
    return tuple(
        c if None in ends else Condition(c.statistic, c.above, sum(ends) / 2) for c, ends in zip(rule, bounds, strict=True)
    )


def held_out() -> Column:
    """Rows not learned from: crc32 of the id as text, modulo 5, is 0. A null id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> list[Rule]:
    """Learns from the ``sample_docs`` labelled documents with the smallest hashes that pass the base rule."""
    known = (
        labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg((1 - F.min("quality")).cast("int").alias("bad"))
        .orderBy(F.xxhash64("id"), "id").limit(sample_docs)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = texts.join(F.broadcast(known.select("id")), F.col("doc_id") == F.col("id"), "left_semi")
    # Written first: a condition on the counts must not be pushed below the choice, to all texts.
    counted = text_counts(materialise(chosen, "rule_texts")).where(~base_failed())
    named = [c.alias(s) for c, s in zip(statistics(), STATISTICS, strict=True)]
    rows = counted.select("doc_id", *named).join(F.broadcast(known), F.col("doc_id") == F.col("id"))
    grow = F.pmod(F.xxhash64("doc_id", F.lit("grow")), F.lit(3)) > 0
    return learn_rules(rows.select(*STATISTICS, "bad", grow.alias("grow")))


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and the number of the rule that decided, of every row of ``docs``."""
    named = [c.alias(f"s_{s}") for c, s in zip(statistics(), STATISTICS, strict=True)]
    counted = text_counts(docs).select("doc_id", *COUNTS, base_failed().alias("base_failed"), *named)
    # The rules name plain statistics; n_words is both a count and a statistic.
    ruled = verdict([tuple(Condition(f"s_{c.statistic}", c.above, c.bound) for c in r) for r in rules])
    return counted.withColumn("rule", ruled).select(
        "doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"), "rule"
    )


def quality_rules(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    return judge(docs, train(docs, labels.where(~held_out()), sample_docs))
