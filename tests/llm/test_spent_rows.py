import functools
import random
from pathlib import Path

from fraudlane.llm import linking
from fraudlane.llm import near_duplicates as near_duplicate_module
from fraudlane.llm.fuzzy_lines import dedup_lines
from fraudlane.llm.near_duplicates import drop_near_duplicates, near_duplicates
from fraudlane.scratch import scratch_root


def stored(spark, before=frozenset()):
    """Kinds of rows in the shared folder."""
    names = {p.name for p in Path(scratch_root(spark).removeprefix("file:")).glob("*_*")} - set(before)
    return names if not before else sorted(n.rsplit("_", 1)[0] for n in names)


def copies(n):
    """Groups of four altered copies."""
    pick = random.Random(n)
    texts = [[f"w{pick.randrange(500)}" for _ in range(150)] for _ in range(6)]
    return [(i, " ".join(w if pick.random() > 0.004 else "other" for w in texts[i % 6])) for i in range(24)]


def test_only_what_the_result_reads_is_left_of_near_duplicates(spark, docs_of):
    before = stored(spark) | {""}
    out = near_duplicates(docs_of(copies(1)))
    assert set(stored(spark, before)) == {"shingle_counts", "component_ids", "links"}
    assert out.where("kept").count() == 6
    before = stored(spark)
    out = drop_near_duplicates(docs_of(copies(1)))
    assert stored(spark, before) == ["near_copies", "near_repeats"]
    assert out.count() == 6


def test_only_what_the_result_reads_is_left_of_line_dedup(spark, docs_of):
    before = stored(spark) | {""}
    rows = [(i, f"line {i} that stands alone {i * 7919}\n{text}") for i, text in copies(1)]
    out = dedup_lines(docs_of(rows))
    assert stored(spark, before) == ["repeated_lines"]
    assert out.agg({"n_removed": "sum"}).first()[0] == 18


def test_leftovers_of_neighbouring_sizes_meet(docs_of, monkeypatch):
    """Each of these pairs is of two steps of size, and either side may have the smaller hash."""
    monkeypatch.setattr(near_duplicate_module, "link_classes", functools.partial(linking.link_classes, rounds=0))
    rows = []
    for i in range(8):
        words = [f"a{i}x{k}" for k in range(184)]
        rows += [(10 * i, " ".join(words)), (10 * i + 1, " ".join(words[:150]))]
    got = {r.doc_id: r.component_id for r in near_duplicates(docs_of(rows)).collect()}
    assert got == {10 * i + k: 10 * i for i in range(8) for k in (0, 1)}


def test_maps_of_sets(spark):
    """A set's bits and hidden items make up its size, and an empty set has neither."""
    store = spark.createDataFrame([(i, [i * 1000 + k for k in range(200 * i)]) for i in range(12)], "node long, items array<long>")
    made = store.mapInArrow(linking._maps, "node long, n long, hidden long, map array<long>").collect()
    assert {r.node: r.n for r in made} == {i: 200 * i for i in range(12)}
    assert all(sum((x & (2**64 - 1)).bit_count() for x in r.map) + r.hidden == r.n and len(r.map) == linking.MAP_WORDS for r in made)
