"""Written intermediate tables in the folder the cluster shares between executors."""

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import DataFrame, SparkSession

_block = ContextVar("block", default="")  # subfolder of the innermost scratch block


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, from spark.checkpoint.dir or setCheckpointDir.

    Where neither is set, a local session, whose one process is all there is, gets a
    folder of its own that goes when Python ends; a cluster must name one.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    own = tempfile.mkdtemp(prefix="cartloom-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    context.setCheckpointDir(own)
    return context.getCheckpointDir()


def staged_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/cartloom/{spark.conf.get('spark.app.id')}{_block.get()}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is staged inside the block goes when it ends, also by an error.

    Write results elsewhere before that; frames built on the staged tables cannot be read
    afterwards. Blocks nest, and threads of stage_all belong to the block they start in.
    """
    mark = _block.set(f"{_block.get()}/block-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        folder = staged_folder(spark)
        _block.reset(mark)
        _delete(spark, folder)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write the frame and read it back: lineage is cut and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{staged_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_all(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Stage several frames side by side."""
    with ThreadPoolExecutor() as pool:
        staged = {n: pool.submit(copy_context().run, stage, df, n) for n, df in frames.items()}
        return {name: written.result() for name, written in staged.items()}


def release(spark: SparkSession) -> None:
    """Delete what this application staged. Frames built on it cannot be read afterwards."""
    _delete(spark, staged_folder(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
