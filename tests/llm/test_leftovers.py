import functools
import itertools
import random

from pyspark.sql import functions as F

from fraudlane.llm import linking
from fraudlane.llm import near_duplicates as nd


def pair(i):
    """Two texts with 160 of 200 runs of five words in common."""
    words = [f"a{i}x{k}" for k in range(184)]
    return " ".join(words), " ".join(f"b{i}x{k}" if k in (20, 60, 100, 140) else w for k, w in enumerate(words))


def test_pairs_at_the_threshold_are_linked_without_leads(docs_of, monkeypatch):
    """The first 512 bits of a long signature of these pairs differ more than it was allowed."""
    monkeypatch.setattr(nd, "link_classes", functools.partial(linking.link_classes, rounds=0))
    rows = [(10 * i + k, text) for i in (818, 1841) for k, text in enumerate(pair(i))]
    got = {r.doc_id: r.component_id for r in nd.near_duplicates(docs_of(rows)).collect()}
    assert got == {8180: 8180, 8181: 8180, 18410: 18410, 18411: 18410}


def test_bounds_hold_for_every_pair(spark):
    pick = random.Random(4)
    base = range(60)
    sets = {i: {x if pick.random() > 0.01 * i else pick.randrange(60, 4000) for x in base} for i in range(24)}
    store = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "node long, items array<long>")
    found = linking._with_shared(store.select("node"), store, lambda nodes: nodes, 10)
    x, y = found.alias("x"), found.alias("y")
    most = linking.bits_in_common(F.col("x.map"), F.col("y.map")) + F.least("x.hidden", "y.hidden")
    bounds = {(r.a, r.b): r.most for r in x.crossJoin(y).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), most.alias("most")).collect()}
    common = {(a, b): len(sets[a] & sets[b]) for a, b in itertools.combinations(sets, 2)}
    assert all(bounds[p] >= n for p, n in common.items())
    assert sum(bounds[p] - n for p, n in common.items()) < sum(60 - n for n in common.values()) / 4


def test_leftover_pairs_are_the_same_in_slices(docs_of, monkeypatch):
    """Each pair comes out in one slice, so that only a part of the rows with bit maps is moved at a time."""
    slices, stored = {}, linking.materialise

    def kept(df, purpose):
        out = stored(df, purpose)
        if purpose == "slice_pairs":
            slices.setdefault(linking.SLICES, []).append([tuple(r) for r in out.collect()])
        return out

    monkeypatch.setattr(linking, "materialise", kept)
    monkeypatch.setattr(nd, "link_classes", functools.partial(linking.link_classes, rounds=0))
    docs = docs_of([(10 * i + k, text) for i in range(8) for k, text in enumerate(pair(i))])
    components = []
    for n in (1, 4):
        monkeypatch.setattr(linking, "SLICES", n)
        components.append({r.doc_id: r.component_id for r in nd.near_duplicates(docs).collect()})
    assert components[0] == components[1] == {10 * i + k: 10 * i for i in range(8) for k in range(2)}
    assert len(slices[4]) == 4 and max(map(len, slices[4])) < len(slices[1][0])
    assert sorted(sum(slices[4], [])) == sorted(slices[1][0])


def test_bounds_are_the_same_in_slices(spark, monkeypatch):
    """Items are counted a slice at a time, so that only a part of all sets is moved at a time."""
    written, stored = [], linking.materialise
    monkeypatch.setattr(linking, "materialise", lambda df, purpose: written.append(purpose) or stored(df, purpose))
    store = spark.createDataFrame([(i, [*range(i, i + 9), 100 + i]) for i in range(6)] + [(9, [900, 901])], "node long, items array<long>")
    found = []
    for n in (1, 4):
        monkeypatch.setattr(linking, "SLICES", n)
        found.append(sorted(tuple(r) for r in linking._with_shared(store.select("node"), store, lambda nodes: nodes, 10).collect()))
    assert found[0] == found[1] and [(r[0], r[1], r[2]) for r in found[0]] == [(i, 10, 8 if i in (0, 5) else 9) for i in range(6)]
    assert written.count("own_items") == 5


def test_compared_pairs_of_two_are_no_leftovers(spark):
    """A bucket of two that were compared and are no link asks for nothing more; one of three is looked at again."""
    sizes = [2, 2, 2, 2, 3, 3]
    rooted = spark.createDataFrame([(i, 10 * i + k, 10 * i + k) for i, n in enumerate(sizes) for k in range(n)], "key long, node long, root long")
    done = spark.createDataFrame([(0, 1), (10, 11), (40, 41), (22, 30)], "a long, b long")
    assert {r.key for r in linking._mixed(rooted, done).collect()} == {2, 3, 4, 5}
    assert linking._mixed(rooted, done).count() == 10
    assert linking._mixed(rooted).count() == sum(sizes)
