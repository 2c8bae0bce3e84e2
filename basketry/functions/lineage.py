"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Folders of local sessions without spark.checkpoint.dir, by application.
_LOCAL: dict[str, str] = {}
# Stages of the run that removes them at its end, if one is under way.
_RUN: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. A local session without one gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL:
        _LOCAL[application] = tempfile.mkdtemp(prefix="basketry-")
    return _LOCAL[application]


def use_checkpoints(spark: SparkSession) -> None:
    """Let iterative fits checkpoint into the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/rdd")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def complete_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders whose writer has left _SUCCESS, which it does when all rows are in place."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{pattern}/_SUCCESS")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return sorted(x.getPath().getParent().toString() for x in found or ())


@contextmanager
def stages_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the stages written inside at the end, also after a failure; results must be written before.

    Frames that read a stage of the run are of no use afterwards. One run at a time in a process, as stages are
    also written by threads of the run.
    """
    if _RUN:
        raise RuntimeError("another run of this process removes its stages")
    _RUN.append([])
    try:
        yield
    finally:
        for path in _RUN.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def staged(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write the rows once and go on from the written table.

    Later stages then read fixed files: a lost executor repeats a scan rather than the work before it,
    and values that depend on the physical layout cannot change between two uses.
    """
    path = fresh_path(df.sparkSession, name)
    for stages in _RUN:
        stages.append(path)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(_stage_schema(df, partition_by)).parquet(path)


def _stage_schema(df: DataFrame, partition_by: tuple[str, ...]):
    from pyspark.sql.types import StructType

    body = [f for f in df.schema.fields if f.name not in partition_by]
    return StructType(body + [df.schema[name] for name in partition_by])
