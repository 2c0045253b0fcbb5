"""Components of a similarity relation, from buckets, without pairs of all members.

``link_classes`` compares each member of a bucket with one chosen member first; whoever is linked joins that
component. Only pairs of one bucket that are still in different components are compared in the end, so the
result is that of comparing every pair that shares a bucket, while a bucket of thousands of copies costs a
number of comparisons near its size.

Every step is a join or an aggregate whose hot keys adaptive execution can split; nothing is collected but
single counts, and each round goes on from a table written to the shared folder.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlane.llm import text_arrays as ta
from fraudlane.scratch import discard, materialise, temporary_rows


#: Leads whose signatures are compared for each member and turn; the rest is left to the comparison of leftovers.
LEADS = 4
#: Longs of the bit map of a set that bounds what two sets have in common, and the bits of a place in it.
MAP_WORDS = 32
_MAP_BITS = (64 * MAP_WORDS).bit_length() - 1
#: Leftover pairs are looked for in so many slices of the keys, one after the other, as each row brings its bit map three
#: times: the shuffle files of one slice are gone before the next is written. The results don't depend on it.
SLICES = 4


def connected_components(links: DataFrame, most: int | None = None) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b) but the roots; root is the smallest node of its component.

    Alternates large-star and small-star steps, which keep the number of links and halve long chains, until all
    links point at roots. Null ends and self links are ignored. After ``most`` steps, if given, a node's root is the
    smallest node known to be in its component, which may not be the smallest there is.
    """
    links = links.where("a <> b")
    edges = materialise(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    step = 0
    while True:
        step += 1
        before = edges
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(*(F.struct(F.col(x).alias("a"), F.col("low").alias("b")) for x in "ab"))).alias("e"))
            .select(F.col("e.a").alias("a"), F.col("e.b").alias("b"))
            .where("a <> b")
            .distinct()
        )
        edges = materialise(small, "edges")
        discard(before)
        if step == most:
            return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
        # Done when every node has one link or is linked to, and no node both.
        ends = edges.select(F.col("a").alias("node"), F.lit(2).alias("end")).union(edges.select("b", F.lit(3)).distinct())
        if ends.groupBy("node").agg(F.sum("end").alias("s")).where("s > 3").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def bits_in_common(left: Column, right: Column) -> Column:
    """How many bits are set in both of two arrays of longs, in code that does not grow with their length."""
    each = F.zip_with(left, right, lambda x, y: F.bit_count(x.bitwiseAND(y)))
    return F.aggregate(each, F.lit(0), lambda total, x: total + x)


def hamming_lanes(left: Column, right: Column, words: int) -> Column:
    """How many bytes differ between two arrays of ``words`` longs."""
    total = F.lit(0)
    for i in range(words):
        # Each step folds the upper half of what is left of a byte onto its lower half.
        bits = F.get(left, F.lit(i)).bitwiseXOR(F.get(right, F.lit(i)))
        for half, kept in ((4, 0x0F0F0F0F0F0F0F0F), (2, 0x0303030303030303), (1, 0x0101010101010101)):
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, half)).bitwiseAND(F.lit(kept))
        total = total + F.bit_count(bits)
    return total


def _maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The size, the bit map and the number of items without a bit of their own for each set."""
    for batch in batches:
        # A map takes 256 bytes, so blocks of rows are bounded however small their sets are.
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            items = part.column(1)
            size = np.diff(items.offsets.to_numpy())
            bits = ta.mix(items.flatten().to_numpy(zero_copy_only=False).view(np.uint64)) >> np.uint64(64 - _MAP_BITS)
            place = np.unique((np.repeat(np.arange(len(size)), size) << _MAP_BITS) + bits.astype(np.int64))
            full = np.zeros(len(size) << _MAP_BITS, dtype=np.uint8)
            full[place] = 1
            words = np.packbits(full, bitorder="little").view(np.int64)
            hidden = size - np.bincount(place >> _MAP_BITS, minlength=len(size))
            maps = ta.list_column(words, np.arange(len(size) + 1) * MAP_WORDS)
            columns = [part.column(0), pa.array(size.astype(np.int64)), pa.array(hidden.astype(np.int64)), maps]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "hidden", "map"])


Step = Callable[[DataFrame], DataFrame]


def _with_shared(mixed: DataFrame, store: DataFrame, contents: Step, percent: int) -> DataFrame:
    """Adds what bounds the similarity of two sets without comparing them; drops nodes without a chance.

    ``n`` is a set's size and ``shared`` its items that any other node here has; two sets have at most the smaller
    ``shared`` in common. ``map`` has the bit of each item, ``hidden`` is ``n`` less the bits set. A bit that
    only one of two sets has stands for an item the other lacks, so they have at most the bits of both and the smaller
    ``hidden`` in common. Both bounds hold for every pair; in a group of altered copies they are close to the truth.
    The items themselves are moved only to be counted.
    """
    nodes = mixed.select("node").distinct()
    sets = materialise(contents(store.join(nodes, "node", "left_semi")), "sets")
    found = []
    for i in range(SLICES):
        items = sets.select("node", F.explode("items").alias("item")).where(F.pmod(F.xxhash64("item"), F.lit(SLICES)) == i)
        alone = items.groupBy("item").agg(F.min("node").alias("node"), F.count("*").alias("c")).where("c = 1")
        found.append(materialise(alone.select("node"), "own_items"))
    own = reduce(DataFrame.union, found).groupBy("node").agg(F.count("*").alias("own"))
    maps = sets.select("node", "items").mapInArrow(_maps, "node long, n long, hidden long, map array<long>").join(own, "node", "left")
    maps = maps.select("node", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("shared"), "map", "hidden")
    maps = materialise(maps.where((F.col("n") > 0) & (100 * F.col("shared") >= percent * F.col("n"))), "maps")
    discard(sets, *found)
    return mixed.join(maps, "node")


def _mixed(rooted: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """The rows of buckets that hold more than one component, but for buckets of two nodes whose pair is in ``done``."""
    ends = rooted.groupBy("key").agg(
        F.min("root").alias("r0"), F.max("root").alias("r1"), F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("c")
    )
    ends = ends.where("r0 < r1")
    if done is not None:
        ends = ends.join(done, (F.col("lo") == F.col("a")) & (F.col("hi") == F.col("b")) & (F.col("c") == 2), "left_anti")
    return rooted.join(ends.select("key"), "key")


def link_classes(
    classes: DataFrame,
    texts: Step,
    verify: Step,
    contents: Step,
    percent: int,
    words: int = 0,
    rounds: int = 3,
) -> tuple[DataFrame, DataFrame]:
    """Links and components of classes whose sets have 100 * common >= ``percent`` * union and that share a key.

    ``classes`` has ``node`` long, ``keys`` array<long>, and ``sig`` array<long> of ``words`` longs where ``words`` is
    not 0; without ``sig`` a node may stand in several equal rows. ``texts`` gives (node, text) of the nodes passed,
    one row each; it is called once, for the nodes that share a key with another. ``verify`` keeps (a, b) of those
    rows of (a, b, text_a, text_b) that are links, and ``contents`` makes (node, items) of (node, text), the set, for the
    few nodes whose links are not settled by the leads.

    Leftover pairs are all compared, but for those that the bounds of ``_with_shared`` prove to be no links. Returns links
    (a, b) and (node, root) of linked nodes that are no roots.
    """
    with temporary_rows(classes.sparkSession) as keep:
        links, roots = _links_and_roots(classes, texts, verify, contents, percent, words, rounds)
        keep(roots, *links)
    return reduce(DataFrame.union, links), roots


def _links_and_roots(
    classes: DataFrame, texts: Step, verify: Step, contents: Step, percent: int, words: int, rounds: int
) -> tuple[list[DataFrame], DataFrame]:
    spark = classes.sparkSession
    rows = classes.select(F.explode(F.array_distinct("keys")).alias("key"), "node")
    shared = rows.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    members = rows.join(shared.select("key"), "key")
    members = materialise(members if words else members.distinct(), "members")
    near = materialise(members.select("node").distinct(), "nodes")
    store = materialise(texts(near), "texts")
    sigs = materialise(classes.select("node", "sig").join(near, "node", "left_semi"), "signatures") if words else None
    none = spark.range(0)
    done, links = [none.selectExpr("id AS a", "id AS b")], []
    labels = none.selectExpr("id AS node", "id AS root")

    def linked(pairs: DataFrame) -> DataFrame:
        for x in "ab":
            pairs = pairs.join(store.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}")), x)
        return materialise(verify(pairs.select("a", "b", "text_a", "text_b")), "links")

    def distance(pairs: DataFrame) -> DataFrame:
        """Adds ``far``: the signature distance, or a number that depends on the pair alone."""
        if not words:
            return pairs.withColumn("far", F.xxhash64("a", "b"))
        a, b = (sigs.select(F.col("node").alias(x), F.col("sig").alias(f"sig_{x}")) for x in "ab")
        far = hamming_lanes(F.col("sig_a"), F.col("sig_b"), words)
        return pairs.join(a, "a").join(b, "b").withColumn("far", far).drop("sig_a", "sig_b")

    def rooted() -> DataFrame:
        named = members.join(labels.withColumnRenamed("root", "r"), "node", "left")
        return named.select("key", "node", F.coalesce("r", "node").alias("root"))

    for turn in range(rounds):
        stored = materialise(_mixed(rooted(), reduce(DataFrame.union, done)), "mixed") if turn else rooted()
        at = stored.withColumn("o", F.xxhash64("node", F.lit(turn)) if turn else F.col("node"))
        # A lead for each bucket, and another for members of the first one's component. Of the leads a member shares the
        # most buckets with, it is compared with the nearest.
        one = F.struct("o", F.col("node").alias("lead"), F.col("root").alias("lead_root"))
        ends = at.groupBy("key").agg(F.min(one).alias("first"), F.max(one).alias("last"))
        chosen = F.when(F.col("first.lead_root") != F.col("root"), F.col("first")).otherwise(F.col("last"))
        pairs = (
            at.join(ends, "key").select("node", "root", chosen.alias("c")).where("c.lead_root <> root")
            .select(F.least("node", "c.lead").alias("a"), F.greatest("node", "c.lead").alias("b"), F.col("node").alias("own"))
            .groupBy("a", "b", "own").agg(F.count("*").alias("times"))
        )
        if turn:
            pairs = pairs.join(reduce(DataFrame.union, done), ["a", "b"], "left_anti")
        order = Window.partitionBy("own").orderBy(F.desc("times"), F.xxhash64("a", "b"), "a", "b")
        pairs = pairs.withColumn("place", F.row_number().over(order)).where(F.col("place") <= LEADS)
        best = distance(pairs).groupBy("own").agg(F.min(F.struct("far", "a", "b")).alias("p")).select("p.a", "p.b").distinct()
        best = materialise(best, "pairs")
        discard(stored)
        found = linked(best)
        done, links = [*done, best], [*links, found]
        labels = connected_components(reduce(DataFrame.union, links), most=2)
    left = materialise(_mixed(rooted(), reduce(DataFrame.union, done)), "mixed")
    chance = materialise(_with_shared(left, store, contents, percent), "chances")
    mixed = _mixed(chance)
    keys = mixed.groupBy("node").agg(F.array_sort(F.collect_set("key")).alias("own_keys"))
    mixed = materialise(mixed.join(keys, "node"), "leftovers")
    discard(left, chance)
    # Linked sets differ in size by one step of the threshold at most, so a set meets those that are no smaller, of its own
    # step and the next.
    step = F.floor(F.log("n") / math.log(100 / percent)).cast("int")
    common = F.least("x.shared", "y.shared")
    apart = (F.col("x.key") == F.col("y.key")) & (F.col("x.step") == F.col("y.step"))
    apart &= (F.struct("x.n", "x.node") < F.struct("y.n", "y.node")) & (F.col("x.root") != F.col("y.root"))
    apart &= 100 * common >= percent * (F.col("x.n") + F.col("y.n") - common)
    # A pair with several keys in common comes out at the first of them only.
    apart &= F.get(F.array_intersect("x.own_keys", "y.own_keys"), F.lit(0)) == F.col("x.key")
    most = bits_in_common(F.col("x.map"), F.col("y.map")) + F.least("x.hidden", "y.hidden")
    apart &= 100 * most >= percent * (F.col("x.n") + F.col("y.n") - most)
    found = []
    for i in range(SLICES):
        own = mixed.where(F.pmod(F.xxhash64("key"), F.lit(SLICES)) == i)
        x = own.withColumn("step", step).alias("x")
        y = own.withColumn("step", F.explode(F.array(step - 1, step))).alias("y")
        pairs = x.join(y, apart).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
        found.append(materialise(pairs, "slice_pairs"))
    # A pair is found once, at its first common key.
    rest = materialise(reduce(DataFrame.union, found).join(reduce(DataFrame.union, done), ["a", "b"], "left_anti"), "pairs")
    discard(mixed, *found)
    links = [*links, linked(rest)]
    return links, materialise(connected_components(reduce(DataFrame.union, links)), "roots")
