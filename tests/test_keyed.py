import pytest
from pyspark.sql import functions as F

from fraudlane.sources.keyed import KeyedStore, batched_cells, to_cells

QUALIFIERS = ["prediction", "time", "amountRange"]
ROWS = "id long, time int, amountRange int, prediction int"


@pytest.fixture
def store(spark, database):
    return KeyedStore.create(spark, f"{database}.cells")


def rows(spark, *values):
    return spark.createDataFrame(list(values), ROWS)


def wide(store):
    return sorted(map(tuple, store.rows(QUALIFIERS).collect()))


def test_cells_are_text_and_skip_nulls(spark):
    cells = to_cells(rows(spark, (7, 5, 3, None)), QUALIFIERS, 99).collect()
    assert sorted(tuple(c) for c in cells) == [
        ("7", "predict", "amountRange", "3", 99),
        ("7", "predict", "time", "5", 99),
    ]


def test_newest_cell_wins(spark, store):
    store.write(to_cells(rows(spark, (1, 5, 3, 0), (2, 6, 4, 0)), QUALIFIERS, 200), 1)
    store.write(to_cells(rows(spark, (1, 5, 3, 1)), ["prediction"], 300, ), 2)
    store.write(to_cells(rows(spark, (2, 6, 4, 1)), ["prediction"], 100), 3)
    assert wide(store) == [("1", "1", "5", "3"), ("2", "0", "6", "4")]
    assert store.latest().count() == 6
    assert store.count().first()[0] == 2


def test_equal_stamps_go_to_the_later_write(spark, store):
    store.write(to_cells(rows(spark, (1, 5, 3, 1)), QUALIFIERS, 100), 2)
    store.write(to_cells(rows(spark, (1, 5, 3, 0)), QUALIFIERS, 100), 10)
    assert wide(store) == [("1", "0", "5", "3")]


def test_writing_again_replaces(spark, store):
    for prediction in (0, 1):
        store.write(to_cells(rows(spark, (1, 5, 3, prediction)), QUALIFIERS, 100), 1)
    assert store.cells().count() == 3 and wide(store) == [("1", "1", "5", "3")]


def test_a_writer_is_a_plain_name(spark, store):
    with pytest.raises(ValueError):
        store.write(to_cells(rows(spark, (1, 5, 3, 0)), QUALIFIERS, 100), 1, "a'b")


def test_duplicate_keys_in_one_write_count_once(spark, store):
    store.write(to_cells(rows(spark, (1, 5, 3, 0), (1, 5, 3, 0)), QUALIFIERS, 100), 1)
    assert store.count().first()[0] == 1 and store.latest().count() == 3


def test_lookup_by_key_and_column(spark, store, plan_of):
    store.write(to_cells(rows(spark, (1, 5, 3, 0), (2, 6, 4, 1)), QUALIFIERS, 100), 1)
    assert [tuple(r) for r in store.row("2", QUALIFIERS).collect()] == [("2", "1", "6", "4")]
    assert [tuple(r) for r in store.row("2", ["amountRange"]).collect()] == [("2", "4")]
    assert store.row("9", QUALIFIERS).count() == 0
    assert "EqualTo(row_key,2)" in plan_of(store.row("2", ["amountRange"]))
    keys = spark.createDataFrame([("1",), ("9",)], "row_key string")
    assert [r["row_key"] for r in store.rows(QUALIFIERS, keys).collect()] == ["1"]


def test_clear(spark, store):
    store.write(to_cells(rows(spark, (1, 5, 3, 0)), QUALIFIERS, 100), 1)
    store.clear()
    assert store.cells().count() == 0 and store.count().first()[0] == 0


def test_newest_cells_need_no_shuffle(spark, store, plan_of):
    plan = plan_of(store.latest(), "simple")
    assert "max" in plan and "Exchange" not in plan


def test_one_key_reads_one_bucket(spark, store, plan_of):
    plan = plan_of(store.row("5", ["prediction"]), "formatted")
    assert "SelectedBucketsCount: 1 out of 8" in plan and "Exchange" not in plan


def test_compaction_keeps_the_newest_cells(spark, store):
    store.write(to_cells(rows(spark, (1, 5, 3, 0), (2, 6, 4, 1)), QUALIFIERS, 100), 1)
    store.write(to_cells(rows(spark, (2, 7, 4, 0)), QUALIFIERS, 200), 2)
    before = store.latest()
    kept = sorted(map(tuple, before.collect()))
    store.compact()
    assert sorted(map(tuple, store.latest().collect())) == kept
    assert store.cells().count() == len(kept)
    assert [r["writer"] for r in store.cells().select("writer").distinct().collect()] == ["compacted"]


@pytest.mark.parametrize("n, sizes", [(20, [10, 10]), (21, [10, 10, 1])])
def test_batches(spark, n, sizes):
    data = spark.range(n).selectExpr("id", "1 AS time", "2 AS amountRange", "0 AS prediction")
    cells = batched_cells(data, QUALIFIERS, 100, batch_rows=10)
    got = cells.groupBy("batch_no").agg(F.count_distinct("row_key").alias("n"), F.count("*").alias("m")).orderBy("batch_no")
    assert [tuple(r) for r in got.collect()] == [(i, s, 3 * s) for i, s in enumerate(sizes)]


def numbered(spark, low, high, prediction):
    return spark.range(low, high).selectExpr("id", "5 AS time", "3 AS amountRange", f"{prediction} AS prediction")


def test_levels_merge_when_they_are_full(spark, store):
    for i in range(5):
        store.write(to_cells(numbered(spark, 0, 10, i % 2), QUALIFIERS, 100 + i), i)
        store.compact(fan=2)
    live, left_out = store.writes()
    # Writes 0 to 3 went up two levels together, write 4 waits.
    assert sorted(live.values()) == [0, 2] and len(left_out) == 6
    assert store.compact(fan=2) == 0
    assert store.cells().count() == 60 and wide(store) == sorted((str(i), "0", "5", "3") for i in range(10))
    before = sorted(map(tuple, store.cells().collect()))
    assert store.vacuum() == 6 and store.vacuum() == 0
    assert sorted(map(tuple, store.cells().collect())) == before


def test_buckets_follow_the_cells(spark, database, plan_of):
    store = KeyedStore.create(spark, f"{database}.grown", bucket_cells=30)
    assert store.buckets() == 8
    store.write(to_cells(numbered(spark, 0, 200, 0), QUALIFIERS, 100), 1)
    store.write(to_cells(numbered(spark, 100, 400, 1), QUALIFIERS, 200), 2)
    store.compact()
    assert store.generation() == 1 and store.buckets() == 50
    plan = plan_of(store.row("150", ["prediction"]), "formatted")
    assert "SelectedBucketsCount: 1 out of 50" in plan and "Exchange" not in plan
    assert "Exchange" not in plan_of(store.latest(), "simple")
    store.write(to_cells(numbered(spark, 0, 1, 1), QUALIFIERS, 300), 3)
    got = {int(k): p for k, p, *_ in wide(store)}
    assert got == {i: "1" if i >= 100 or i == 0 else "0" for i in range(400)}
    with pytest.raises(ValueError, match="merged"):
        store.write(to_cells(numbered(spark, 0, 1, 1), QUALIFIERS, 300), 2)
    store.clear()
    assert store.count().first()[0] == 0
    store.write(to_cells(numbered(spark, 0, 3, 1), QUALIFIERS, 1), 2)
    assert store.count().first()[0] == 3


def test_size_at_creation(spark, database):
    assert KeyedStore.create(spark, f"{database}.a", cells=100, bucket_cells=5).buckets() == 20
    assert KeyedStore.create(spark, f"{database}.b", buckets=3).buckets() == 3


def test_a_hot_key_fills_several_tasks(spark, store, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    hot = spark.range(20_000).selectExpr("7L AS id", "cast(id AS int) AS time", "3 AS amountRange", "cast(id % 2 AS int) AS prediction")
    store.write(to_cells(hot, QUALIFIERS, 100), 1)
    files = store.cells().select("_metadata.file_path").distinct().count()
    assert files > 1 and store.cells().count() == 60_000
    assert store.latest().count() == 3


def test_compaction_while_others_write_loses_nothing(spark, store):
    from threading import Thread

    failed = []

    def run(writer):
        try:
            for i in range(4):
                store.write(to_cells(numbered(spark, 0, 50, i % 2), QUALIFIERS, 100 + i), i, writer)
                store.write(to_cells(numbered(spark, 1000 * (1 + i), 1000 * (1 + i) + 10, 1), QUALIFIERS, 100), 10 + i, writer)
        except Exception as problem:
            failed.append(problem)

    writers = [Thread(target=run, args=(w,)) for w in ("one", "two")]
    for w in writers:
        w.start()
    merges = 0
    while any(w.is_alive() for w in writers):
        merges += store.compact(fan=2)
    for w in writers:
        w.join()
    assert not failed
    merges += store.compact(fan=2)
    assert merges > 2
    expected = sorted((str(k), "1", "5", "3") for k in [*range(50), *(1000 * (1 + i) + j for i in range(4) for j in range(10))])
    assert wide(store) == expected
    store.compact()
    store.vacuum()
    assert wide(store) == expected and store.cells().count() == 3 * len(expected)


def test_of_two_merges_of_one_write_the_earlier_counts(spark, store):
    store.write(to_cells(numbered(spark, 0, 5, 0), QUALIFIERS, 100), 1)
    store.write(to_cells(numbered(spark, 0, 5, 1), QUALIFIERS, 200), 2)
    live, _ = store.writes()
    for _ in range(2):
        store._merge(list(live), [], 1)
    assert len(store.merges()) == 1 and store.cells().count() == 15
    store.compact()
    assert store.cells().count() == 15 and {p for _, p, *_ in wide(store)} == {"1"}


def test_an_unlogged_merge_is_not_read(spark, store, monkeypatch):
    from fraudlane.sources.events import EventFolder

    store.write(to_cells(numbered(spark, 0, 5, 0), QUALIFIERS, 100), 1)
    store.write(to_cells(numbered(spark, 0, 5, 1), QUALIFIERS, 200), 2)
    monkeypatch.setattr(EventFolder, "append", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.compact()
    assert store.cells().count() == 30 and len(store.writes()[1]) == 1
