"""Tables that cut lineage: written to the folder that the cluster's nodes share, and deleted once nobody needs them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark then deletes what a write has shuffled as soon as the write has ended.
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_open: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where that is unset, one machine alone gets a temporary one; a cluster's nodes would
    each write to their own disk, so there it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all nodes share")
        folder = tempfile.mkdtemp(prefix="veilspark-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Writes a table into the shared folder and reads it again: a lost executor costs no more than the read. What the write has
    shuffled goes when it ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/veilspark-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    before = spark.conf.get(_RELEASE)
    spark.conf.set(_RELEASE, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the tables cut inside; what is made from them has to be written by then."""
    own: list[str] = []
    _open.append(own)
    try:
        yield
    finally:
        _open.remove(own)
        for path in own:
            delete(spark, path)


def numbered(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers n of the finished tables ``path/name=n``, in order."""
    jvm = spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm.Path(path)):
        return []
    found = [f.getPath().getName() for f in fs.listStatus(jvm.Path(path)) if f.isDirectory()]
    return sorted(int(f.removeprefix(f"{name}=")) for f in found if f.startswith(f"{name}=") and fs.exists(jvm.Path(f"{path}/{f}/_SUCCESS")))


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a table's files, wherever Spark's file systems reach."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
