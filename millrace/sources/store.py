"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where the session names none and runs on one machine (tests) is a
    folder made here and set as the checkpoint folder; on a cluster that is an error.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        at = spark.sparkContext.getCheckpointDir()
    if not at:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
        at = spark.sparkContext.getCheckpointDir()
    return at.rstrip("/")


#: Tables written so far, by the scratch they were written in.
_open: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Delete the tables that ``materialize`` writes inside, but for those passed to the function it yields."""
    made: list[str] = []
    kept: set[str] = set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df._path)
        return df

    _open.append(made)
    try:
        yield keep
    finally:
        _open.remove(made)
        drop(spark, [p for p in made if p not in kept])
        if _open:
            _open[-1].extend(kept)


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables, whatever file system they are on."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing reads any more."""
    drop(spark, [t._path for t in tables])


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again.

    Cuts the lineage like ``checkpoint()``, but columnar and compressed, and it
    outlives any executor. Shuffle files of the write go once it is done.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/millrace/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    if _open:
        _open[-1].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._path = path
    return out


#: Rows of a written table up to which it is broadcast; beyond, both sides of a join are shuffled.
FEW = 200_000


def few(table: DataFrame) -> DataFrame:
    """``table``, to be broadcast if it has few rows. It should be a written one: it is counted."""
    return F.broadcast(table) if table.count() <= FEW else table
