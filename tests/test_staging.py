"""Staged tables: written, read back, released."""

import os

import pytest

from tallyframe.staging import release, shared_dir, stage


def folders(spark):
    root = shared_dir(spark).removeprefix("file:")
    return {name for name in os.listdir(root) if name.startswith("kept-")}


def test_released_tables_leave_no_files_and_others_stay(spark):
    before = folders(spark)
    first = stage(spark.range(10), "kept-a")
    second = stage(first.where("id > 6"), "kept-b")
    release(first, spark.range(3))
    assert len(folders(spark) - before) == 1
    assert [r.id for r in second.orderBy("id").collect()] == [7, 8, 9]
    release(first, second)
    assert folders(spark) == before
    with pytest.raises(Exception):
        second.collect()
