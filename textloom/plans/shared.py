"""Where intermediate tables go, and how they are cut off from their lineage.

Every executor must be able to read an intermediate table after any other
executor is lost, so such tables are written to the folder the cluster names in
``spark.checkpoint.dir``. Only where that is unset and the session runs on one
machine (tests, a laptop) does the engine pick a folder of its own; on a cluster it is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a few numbers and a hash up to which a side of a join is broadcast; they take some megabytes.
BROADCAST_ROWS = 50_000

_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session as a URI, without a trailing slash."""
    named = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY, None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{_KEY} isn't set; on a cluster it must name a folder that all executors share")
        named = "file://" + os.path.join(tempfile.gettempdir(), f"textloom-{os.getuid()}")
    path = spark._jvm.org.apache.hadoop.fs.Path(named)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri


_OPEN: ContextVar[list[str] | None] = ContextVar("open", default=None)


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    An empty input gives an empty table of the same schema. The files are removed
    at the end of the :func:`scratch` block they are made in, else when the session's driver ends.
    """
    path = temporary_folder(df.sparkSession, tag)
    if _OPEN.get() is not None:
        _OPEN.get().append(path)
    df.write.parquet(path)
    return _expiring(df.sparkSession, path).read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A block at whose end the tables materialised in it are removed; for steps whose results are written before it ends."""
    made: list[str] = []
    token = _OPEN.set(made)
    try:
        yield
    finally:
        _OPEN.reset(token)
        for path in made:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` in as many partitions as there are cores, if it has at most half as many: a scan of one small file would keep one core busy.

    A table of more splits stays as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() <= cores else df


def joinable(df: DataFrame, most: int) -> DataFrame:
    """``df``, of at most ``most`` rows, as a side of a join: broadcast where that is few, merged otherwise.

    Left alone, Spark goes by the bytes of files and shuffles. The same rows take many times as much in the driver that
    broadcasts them, and several such tables may be there at once.
    """
    return F.broadcast(df) if most <= BROADCAST_ROWS else df.hint("merge")


def temporary_folder(spark: SparkSession, tag: str) -> str:
    """A new name in the shared folder."""
    return f"{shared_dir(spark)}/textloom/{tag}-{uuid.uuid4().hex}"


def expire(spark: SparkSession, path: str) -> None:
    """Have a folder removed when the session's driver ends."""
    _expiring(spark, path)


def _expiring(spark: SparkSession, path: str) -> SparkSession:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark
