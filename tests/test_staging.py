"""Staged tables of a block go with it, and only they."""

import os

import pytest

from cartloom.plans.staging import scratch, stage, stage_all, staged_folder


def local(folder):
    return folder.removeprefix("file://").removeprefix("file:")


def test_a_block_keeps_its_tables_apart_and_deletes_them(spark):
    df = spark.range(5)
    before, outer = stage(df, "kept"), staged_folder(spark)
    with scratch(spark):
        inner = staged_folder(spark)
        assert inner.startswith(f"{outer}/block-")
        staged = stage_all({"a": df, "b": df.limit(2)})
        assert {n: d.count() for n, d in staged.items()} == {"a": 5, "b": 2}
        assert len(os.listdir(local(inner))) == 2
        with scratch(spark):
            stage(df, "deeper")
            deeper = staged_folder(spark)
        assert deeper.startswith(inner) and not os.path.exists(local(deeper))
        assert staged["a"].count() == 5
    assert staged_folder(spark) == outer and not os.path.exists(local(inner))
    assert before.count() == 5 and stage(df, "later").count() == 5


def test_a_failing_block_deletes_its_tables(spark):
    with pytest.raises(ZeroDivisionError), scratch(spark):
        folder = staged_folder(spark)
        stage(spark.range(3), "lost")
        assert os.path.exists(local(folder))
        raise ZeroDivisionError
    assert not os.path.exists(local(folder))


def test_a_block_without_tables(spark):
    with scratch(spark):
        pass
