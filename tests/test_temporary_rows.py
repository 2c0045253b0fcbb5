from pathlib import Path

import pytest

from fraudlane import scratch


def folders(spark):
    return {p.name for p in Path(scratch.scratch_root(spark).removeprefix("file:")).glob("*_*")}


def test_rows_stored_inside_go_at_the_end(spark):
    before = folders(spark)
    with scratch.temporary_rows(spark) as keep:
        outer = scratch.materialise(spark.range(3), "outer")
        with scratch.temporary_rows(spark) as keep_inner:
            scratch.materialise(spark.range(5), "passing")
            lasting, passed = (scratch.materialise(spark.range(n), "kept") for n in (7, 9))
            keep_inner(lasting, passed)
        assert outer.count() == 3 and len(folders(spark) - before) == 3
        keep(lasting)
    assert lasting.count() == 7
    assert [n.split("_")[0] for n in folders(spark) - before] == ["kept"]
    scratch.discard(lasting, spark.range(2))
    assert folders(spark) == before


def test_discarded_rows_are_not_removed_twice_and_errors_keep_all(spark):
    before = folders(spark)
    with scratch.temporary_rows(spark) as keep:
        gone = scratch.materialise(spark.range(4), "gone")
        scratch.discard(gone, gone)
        keep(gone)
    assert folders(spark) == before
    with pytest.raises(ValueError), scratch.temporary_rows(spark):
        scratch.materialise(spark.range(4), "left")
        raise ValueError
    assert len(folders(spark) - before) == 1
