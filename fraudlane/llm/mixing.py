"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Sources share a budget of words by weight. A target never exceeds ``max_repeat`` times its source; what is cut off is
shared again by weight until no target is above its bound (the level is found in closed form from sums over the
sources sorted by the bound for each unit of weight).

A source's documents are permuted by a hash and cut into blocks, ranges of that hash. The mix takes whole passes over a
source and one partial pass that ends at the document nearest to the target, so each source has an exact quota of block
draws. A binary tree over the output shards splits the quotas: at each node the left half of all draws is taken without
regard to source, so that each source's share of it is multivariate hypergeometric, drawn source by source from the
exact distribution. Shards then take disjoint ranges of each source's draws, and ``place`` orders a shard's rows
locally.

Everything is SQL on three small tables (sources, blocks, tree nodes) and two passes over (doc_id, source, size); the
texts are read once, to count words, and twice more where columns are carried. The table of blocks is measured and
broadcast, so rows learn their draws where they lie; only those of the block in which a source's partial pass ends, one
block for each source, are moved to be put in order. The number of blocks of a source is bounded by ``MAX_BLOCKS``, beyond which blocks
grow; a source with a third of all documents has as many blocks as its share, so no task holds a source.

Defined results: a null text has size 0 and is never taken, like any document without words; null sources are one
source, the last. Ties of the hash are ordered by ``doc_id``; equal rows are interchangeable. A source without words has
target 0. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlane.operators.joins import join_measured
from fraudlane.scratch import materialise

WEIGHTS = (3, 1, 2)
BUDGET, MAX_REPEAT = 1.5, 2
SHARD_WORDS = 4_000_000
BLOCK_WORDS, BLOCK_DOCS, MAX_BLOCKS = 100_000, 1_000, 1 << 16
SEED = "mix"
_WORD = r"[^\x20\x09-\x0D]+"
_SPREAD = 10  # standard deviations kept on each side of a draw's mean; less than 1e-22 lies outside


def _size() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long")


def keyed(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, source and the permutation key, below 2**60; then columns of ``docs``."""
    name = F.concat(F.lit(f"{SEED} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("long").alias("key"),
        *more,
    )


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and the permutation key."""
    return keyed(docs, _size().alias("size"))


def source_targets(rows: DataFrame, weights=WEIGHTS, budget: float = BUDGET, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row for each source: source, rank, source_size, n_docs and target."""
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = sums.withColumn("rank", rank).withColumn("weight", weight)
    # Ordered by the bound for each unit of weight, in whole numbers.
    whole = 1
    for w in weights:
        whole *= w
    order = Window.orderBy(F.col("source_size") * (F.lit(whole) / F.col("weight")).cast("long"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.partitionBy()
    level = (F.lit(budget) * F.sum("source_size").over(all_) - max_repeat * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (
        F.sum("weight").over(all_) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    leveled = ranked.withColumn("level", level).withColumn("level", F.max("level").over(all_))
    target = F.least(F.col("weight") * F.col("level"), max_repeat * F.col("source_size").cast("double"))
    return leveled.select("source", "rank", "source_size", "n_docs", target.alias("target"))


def _uniform(*names) -> Column:
    """A number strictly between 0 and 1 that depends on the values alone."""
    return (F.pmod(F.xxhash64(*names), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def hypergeometric(population: Column, marked: Column, drawn: Column, uniform: Column) -> Column:
    """How many of ``drawn`` out of ``population`` are ``marked``, by inversion of the exact distribution."""
    n, k, d = (x.cast("double") for x in (population, marked, drawn))
    lo, hi = F.greatest(F.lit(0.0), d + k - n), F.least(k, d)
    mean = d * k / n
    spread = _SPREAD * F.sqrt(F.greatest(mean * (1 - k / n) * (n - d) / F.greatest(n - 1, F.lit(1.0)), F.lit(0.0))) + _SPREAD
    start = F.greatest(lo, F.floor(mean - spread).cast("double"))
    stop = F.least(hi, F.ceil(mean + spread).cast("double"))
    steps = F.sequence(start.cast("long"), stop.cast("long"))

    def after(weight: Column, i: Column) -> Column:
        return weight * (k - i) * (d - i) / ((i + 1) * F.greatest(n - k - d + i + 1, F.lit(1.0)))

    total = F.aggregate(
        steps,
        F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum")),
        lambda at, i: F.struct(after(at["w"], i).alias("w"), (at["sum"] + at["w"]).alias("sum")),
        lambda at: at["sum"],
    )
    bound = F.array(uniform * total)  # evaluated once, as an element
    found = F.transform(
        bound,
        lambda goal: F.aggregate(
            steps,
            F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), F.lit(-1).cast("long").alias("found")),
            lambda at, i: F.struct(
                after(at["w"], i).alias("w"),
                (at["sum"] + at["w"]).alias("sum"),
                F.when((at["found"] < 0) & (at["sum"] + at["w"] >= goal), i).otherwise(at["found"]).alias("found"),
            ),
            lambda at: F.when(at["found"] < 0, stop.cast("long")).otherwise(at["found"]),
        ),
    )
    return F.when((lo >= hi) | (n <= 0), F.least(lo, hi).cast("long")).otherwise(found[0])


def split_quotas(quotas: DataFrame, shards: int) -> DataFrame:
    """(shard, rank, offset, quota) from (rank, quota): what each shard takes of each source, and after which draw.

    ``shards`` is a power of two. A node's quotas stand in one array with an element for each source.
    """
    node = quotas.agg(F.sort_array(F.collect_list(F.struct("rank", "quota"))).alias("q")).select(
        F.lit(1).alias("node"), F.transform("q", lambda x: x["rank"]).alias("ranks"), F.transform("q", lambda x: x["quota"]).alias("q")
    )
    for _ in range(shards.bit_length() - 1):
        total = F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x)
        node = node.withColumn("total", total).withColumn("wanted", F.floor(F.col("total") / 2).cast("long"))
        start = F.struct(
            F.col("total").alias("rest"), F.col("wanted").alias("need"), F.array().cast("array<long>").alias("left"), F.lit(0).alias("i")
        )

        def draw(at: Column, quota: Column) -> Column:
            got = F.transform(
                F.array(hypergeometric(at["rest"], quota, at["need"], _uniform(F.lit(SEED), F.col("node"), at["i"]))), lambda x: x
            )[0]
            return F.transform(
                F.array(got),
                lambda x: F.struct(
                    (at["rest"] - quota).alias("rest"), (at["need"] - x).alias("need"), F.concat(at["left"], F.array(x)).alias("left"), (at["i"] + 1).alias("i")
                ),
            )[0]

        left = F.aggregate("q", start, draw, lambda at: at["left"])
        node = materialise(node.select("node", "ranks", "q", left.alias("left")), "mix_nodes")
        right = F.zip_with("q", "left", lambda a, b: a - b)
        node = node.select("ranks", F.explode(F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("q")), F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("q"))
        )).alias("child")).select("child.node", "ranks", "child.q")
    each = node.select((F.col("node") - shards).alias("shard"), F.explode(F.arrays_zip("ranks", "q")).alias("x"))
    each = each.select("shard", F.col("x.ranks").alias("rank"), F.col("x.q").alias("quota"))
    before = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return each.withColumn("offset", F.coalesce(F.sum("quota").over(before), F.lit(0)))


def mix_sources(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, max_repeat: int = MAX_REPEAT, **more) -> DataFrame:
    """The mix alone, see :func:`mix_and_shards`."""
    return mix_and_shards(docs, weights, budget, max_repeat, **more)[0]


def mix_in_order(docs: DataFrame, carry: tuple[str, ...], **more) -> DataFrame:
    """The columns ``carry`` of each draw of the mix, shard by shard in order, see :func:`write_order`."""
    return write_order(*mix_and_shards(docs, carry=carry, **more))


def mix_and_shards(
    docs: DataFrame,
    weights=WEIGHTS,
    budget: float = BUDGET,
    max_repeat: int = MAX_REPEAT,
    shard_words: int = SHARD_WORDS,
    carry: tuple[str, ...] = (),
) -> tuple[DataFrame, int]:
    """The mix and its number of shards: for every row of ``docs`` (doc_id, text, source) its size, its source's size and target, and its draws.

    ``draws`` has (copy, shard, place) for each time the mix takes the document: write shard by shard, ordered by place.
    There is a power of two of shards, so many that one has at most ``shard_words`` on average. ``own`` holds the columns
    ``carry`` of ``docs``.
    """
    rows = materialise(sized(docs), "mix_sizes")
    targets = materialise(source_targets(rows, weights, budget, max_repeat), "mix_targets")
    words = targets.agg(F.sum("target")).first()[0] or 0
    shards = 1 << math.ceil(math.log2(max(1.0, words / shard_words)))
    n_blocks = F.greatest(
        F.lit(1), F.least(F.lit(MAX_BLOCKS), F.ceil(F.greatest(F.col("source_size") / BLOCK_WORDS, F.col("n_docs") / BLOCK_DOCS)))
    )
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = targets.withColumn("n_blocks", n_blocks).withColumn("passes", passes)
    plan = plan.withColumn("partial", F.col("target") - F.col("passes") * F.col("source_size"))
    plan = plan.withColumnRenamed("source", "of")
    block = F.least(F.floor(F.col("key") / float(1 << 60) * F.col("n_blocks")), F.col("n_blocks") - 1).cast("long")

    def in_blocks(sized_rows: DataFrame) -> DataFrame:
        return sized_rows.join(plan, F.col("source").eqNullSafe(F.col("of"))).withColumn("block", block)

    placed = in_blocks(rows)
    sums = placed.groupBy("rank", "block").agg(
        F.sum("size").alias("words"), F.first("partial").alias("partial"), F.first("passes").alias("passes")
    )
    earlier = Window.partitionBy("rank").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sums.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    # A block is drawn once for each whole pass, and once more if the partial pass reaches into it.
    times = F.col("passes") + F.when(F.col("before") < F.col("partial"), 1).otherwise(0)
    ends = (F.col("before") < F.col("partial")) & (F.col("before") + F.col("words") > F.col("partial"))
    blocks = materialise(blocks.select("rank", "block", "before", times.alias("times"), ends.alias("ends")), "mix_blocks")
    draws = blocks.where("times > 0").select("rank", "block", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))
    draws = draws.withColumn("draw", F.row_number().over(Window.partitionBy("rank").orderBy("copy", F.xxhash64("block", "copy"), "block")) - 1)
    quotas = blocks.groupBy("rank").agg(F.sum("times").cast("long").alias("quota"))
    shares = split_quotas(quotas, shards).where("quota > 0")
    taken_by = shares.select("rank", "shard", F.explode(F.sequence(F.col("offset"), F.col("offset") + F.col("quota") - 1)).alias("draw"))
    homes = draws.join(taken_by, ["rank", "draw"]).groupBy("rank", "block").agg(
        F.sort_array(F.collect_list(F.struct("copy", "shard"))).alias("homes")
    )
    homes = materialise(blocks.join(homes, ["rank", "block"], "left"), "mix_homes")
    filled = F.col("size") > 0
    if carry:
        # The text is read again and goes with its row, so that rows need not be found again by an id.
        placed = in_blocks(keyed(docs, "text", F.struct(*carry).alias("own")))
        filled = F.col("text").rlike(_WORD)
    known = homes.select("rank", "block", "before", "ends", "homes")
    # The partial pass takes all of a block or nothing, but for the block it ends in, whose rows are put in order.
    order = Window.partitionBy("rank", "block").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    whole, cut = (join_measured(placed.withColumn("filled", filled), known.where(x), ["rank", "block"]) for x in ("NOT ends", "ends"))
    if carry:
        whole, cut = (x.withColumn("size", _size()).drop("text") for x in (whole, cut))
    whole = whole.withColumn("reached", F.col("before") < F.col("partial"))
    cut = cut.withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0)))
    # The document nearest to the end of the partial pass is its last.
    cut = cut.withColumn("reached", 2 * F.col("before") + F.col("size") <= 2 * F.col("partial"))
    times = F.col("passes") + F.col("reached").cast("long")
    place = F.transform(
        F.filter("homes", lambda x: x["copy"] <= times),
        lambda x: F.struct(x["copy"].alias("copy"), x["shard"].alias("shard"), F.xxhash64(F.lit(SEED), F.col("key"), x["copy"]).alias("place")),
    )
    # A row without words is never taken. That is asked outside, as the optimiser asks again for rows with a draw.
    place = F.when(F.col("filled"), place)
    mix = whole.unionByName(cut).select(
        "doc_id", "size", "source_size", "target", F.coalesce(place, F.array().cast("array<struct<copy:bigint,shard:int,place:bigint>>")).alias("draws"), *(["own"] if carry else [])
    )
    return mix, shards


def write_order(mix: DataFrame, shards: int | None = None) -> DataFrame:
    """One row for each draw: the carried columns, copy and shard; a shard is one partition, ordered by place.

    Without the number of shards it is counted, which computes the mix a first time.
    """
    if shards is None:
        shards = mix.select(F.explode("draws.shard").alias("shard")).agg(F.max("shard") + 1).first()[0] or 1
    each = mix.select("own.*", F.explode("draws").alias("draw"))
    each = each.select(*mix.select("own.*").columns, "draw.copy", "draw.shard", "draw.place")
    return each.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("place").drop("place")
