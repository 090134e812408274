"""Tasks that fail and run again change nothing in the outputs."""

import pytest
from pyspark import TaskContext

from cartloom.plans.refresh import refresh
from cartloom.sources.star import typed_sources

STAMPS = {"created_at", "updated_at"}


def rows(name, table):
    unstable = STAMPS | ({"id"} if name == "order_master" else set())
    return sorted(map(str, table.select([c for c in table.columns if c not in unstable]).collect()))


@pytest.mark.parametrize("cell_rows", [1_000_000, 3])
def test_refresh_survives_lost_tasks(spark, tmp_path, cell_rows):
    def fail_once(batches):
        """Hand rows on, then break the first attempt of the task."""
        for batch in batches:
            yield batch
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("task lost")

    sound = typed_sources(spark, "/root/testdata/sf0.001")
    shaky = {name: df.mapInArrow(fail_once, df.schema) for name, df in sound.items()}
    spark.sparkContext.setLogLevel("OFF")
    want = refresh(spark, sound, str(tmp_path / "sound"), cell_rows)
    got = refresh(spark, shaky, str(tmp_path / "shaky"), cell_rows)
    spark.sparkContext.setLogLevel("ERROR")
    assert sorted(got.rows.collect()) == sorted(want.rows.collect())
    for name, table in want.tables.items():
        assert rows(name, got.tables[name]) == rows(name, table)
