import pytest
from pyspark.sql import functions as F

from fraudlane.llm import mixing


def water_filling(sizes, weights, budget, most):
    """Targets by giving out what is left, by weight, until nobody is above the bound."""
    target = dict.fromkeys(sizes, 0.0)
    full, left = set(), budget * sum(sizes.values())
    while left > 1e-9 and len(full) < len(sizes):
        share = left / sum(weights[s] for s in sizes if s not in full)
        left = 0.0
        for s in sizes:
            if s not in full:
                target[s] += share * weights[s]
                if target[s] >= most * sizes[s]:
                    left += target[s] - most * sizes[s]
                    target[s] = most * sizes[s]
                    full.add(s)
    return target


@pytest.fixture(scope="module")
def corpus(docs_of, write_prose):
    rows = []
    for i in range(900):
        source = ("big", "big", "c", "small", None, "mid")[i % 6] if i % 50 else "zz"
        rows.append((i, (write_prose(i % 40, 5 + i % 60), "en", source, 1)))
    return docs_of(rows)


def test_targets_and_taken(corpus):
    mix = mixing.mix_sources(corpus, shard_words=2_000)
    rows = mix.join(corpus.select("doc_id", "source"), "doc_id").collect()
    names = sorted({r.source for r in rows if r.source}) + [None]
    sizes = {s: sum(r["size"] for r in rows if r.source == s) for s in names}
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    want = water_filling(sizes, weights, 1.5, 2)
    for s in names:
        own = [r for r in rows if r.source == s]
        assert all(abs(r.target - want[s]) < 1e-6 and r.source_size == sizes[s] for r in own)
        taken = sum(r["size"] * len(r.draws) for r in own)
        assert abs(taken - want[s]) <= max(r["size"] for r in own)
    assert all(len(r.draws) <= 2 for r in rows)
    assert sorted(map(str, mix.collect())) == sorted(map(str, mixing.mix_sources(corpus.repartition(7), shard_words=2_000).collect()))


def test_shards_take_disjoint_draws_in_proportion(corpus, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 300)
    mix = mixing.mix_sources(corpus, shard_words=3_000, carry=("doc_id", "source"))
    rows = mixing.write_order(mix)
    assert rows.columns == ["doc_id", "source", "copy", "shard"]
    drawn = rows.collect()
    assert len(drawn) == len({(r.doc_id, r.copy) for r in drawn}) == mix.select(F.sum(F.size("draws"))).first()[0]
    shards = {r.shard for r in drawn}
    assert len(shards) == max(shards) + 1 >= 8
    sizes = {s: sum(r.shard == s for r in drawn) for s in shards}
    assert min(sizes.values()) > 0.5 * len(drawn) / len(shards)


def test_hypergeometric_draws(spark):
    n, k, d = 60, 25, 20
    u = spark.range(4000).select(((F.col("id") + 0.5) / 4000).alias("u"))
    draws = [r.x for r in u.select(mixing.hypergeometric(F.lit(n), F.lit(k), F.lit(d), F.col("u")).alias("x")).collect()]
    mean = sum(draws) / len(draws)
    spread = sum((x - mean) ** 2 for x in draws) / len(draws)
    assert abs(mean - d * k / n) < 0.01
    assert abs(spread - d * (k / n) * (1 - k / n) * (n - d) / (n - 1)) < 0.02
    edge = spark.range(1).select(*(mixing.hypergeometric(*map(F.lit, x), F.lit(0.5)).alias(f"c{i}") for i, x in enumerate([(9, 0, 4), (9, 9, 4), (9, 5, 0), (9, 5, 9), (0, 0, 0)])))
    assert tuple(edge.first()) == (0, 4, 0, 5, 0)


def test_quotas_are_exact(spark):
    quotas = {0: 1, 1: 57, 2: 1000, 3: 0}
    shares = mixing.split_quotas(spark.createDataFrame([*quotas.items()], "rank int, quota long"), 8).collect()
    for rank, quota in quotas.items():
        own = sorted((r.shard, r.offset, r.quota) for r in shares if r["rank"] == rank)
        assert sum(x[2] for x in own) == quota and [x[1] for x in own] == [sum(y[2] for y in own[:i]) for i in range(8)]
    totals = [sum(r.quota for r in shares if r.shard == s) for s in range(8)]
    assert sum(totals) == 1058 and max(totals) - min(totals) <= 3


def test_odd_rows(odd_docs, clashing, no_docs, rows_of):
    got = mixing.mix_sources(odd_docs)
    assert got.count() == odd_docs.count()
    assert all(not r.draws and r["size"] == 0 for r in got.collect() if r.doc_id in (1, 2, 3))
    assert rows_of(mixing.mix_sources(clashing)) == rows_of(got)
    assert mixing.mix_sources(no_docs).count() == 0
    assert mixing.write_order(mixing.mix_sources(no_docs, carry=("doc_id",))).count() == 0


def test_order_without_a_second_mix(corpus):
    rows = mixing.mix_in_order(corpus, ("doc_id", "source"), shard_words=3_000)
    again = mixing.write_order(mixing.mix_sources(corpus, shard_words=3_000, carry=("doc_id", "source")))
    assert rows.columns == again.columns and rows.exceptAll(again).count() == 0 and rows.count() == again.count()
    by_part = rows.groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct("shard").alias("n"), F.min("shard").alias("s")).collect()
    assert all(r.n == 1 and r.p == r.s for r in by_part)


def shuffled_bytes(df):
    """What the shuffles of a plan that has run moved, each counted once."""
    def stages(node):
        if "AdaptiveSparkPlan" in node.nodeName():
            node = node.executedPlan()
        inner = [node.plan()] if "QueryStage" in node.nodeName() else [node.children().apply(i) for i in range(node.children().size())]
        own = node.metrics().apply("dataSize").value() if node.nodeName() == "Exchange" else 0
        return own + sum(map(stages, inner))

    return stages(df._jdf.queryExecution().executedPlan())


def test_texts_are_moved_once(docs_of, write_prose, monkeypatch):
    """The shards are all that texts are dealt out for; what comes before needs few of them."""
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 400)
    rows = [(i, (write_prose(i, 200), "en", "abc"[i % 3], 1)) for i in range(600)]
    mix = mixing.mix_in_order(docs_of(rows), ("doc_id", "text", "source"), shard_words=20_000)
    taken = sum(len(r.text) for r in mix.collect())
    assert taken > 1.4 * sum(len(t) for _, (t, *_) in rows)
    assert taken < shuffled_bytes(mix) < 1.3 * taken


def test_the_partial_pass_ends_inside_a_block(docs_of, monkeypatch):
    """Whatever the size of blocks, the mix takes a prefix of each permuted source."""
    rows = [(i, ("w " * (1 + i * 7 % 23), "en", "abcd"[i % 4 if i % 3 else 0], 1)) for i in range(400)]
    drawn = []
    for words, most in ((1, 1 << 16), (37, 1 << 16), (500, 1 << 16), (37, 3), (10**9, 1)):
        monkeypatch.setattr(mixing, "BLOCK_WORDS", words)
        monkeypatch.setattr(mixing, "MAX_BLOCKS", most)
        drawn.append({r.doc_id: len(r.draws) for r in mixing.mix_sources(docs_of(rows)).collect()})
    assert all(d == drawn[-1] for d in drawn) and len(set(drawn[-1].values())) > 1
