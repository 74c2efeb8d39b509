"""Session helpers shared by every operator: reading tables, cutting lineage
and checking the size of what is broadcast.

Lineage is cut by writing a Parquet table into the folder the cluster names in
``spark.checkpoint.dir`` (shared by all executors, so a lost executor costs
nothing but the running tasks). Where that setting is absent, as in tests on a
local master, a folder of this process is used and removed at its end; on a
cluster its absence is an error, for no folder of one machine is seen by all.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []
_SHIPPED: str | None = None
_SCOPES: list[list[Cut]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder for written intermediates: ``spark.checkpoint.dir`` or, where unset and the master is local, one of this process."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="tenderloom-"))
        atexit.register(shutil.rmtree, _OWN[0], True)
    return "file://" + _OWN[0]


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per session, wherever the driver was started."""
    global _SHIPPED
    context = spark.sparkContext
    if _SHIPPED == context.applicationId:
        return
    _SHIPPED = context.applicationId
    here = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="tenderloom-code-")
    atexit.register(shutil.rmtree, folder, True)
    context.addPyFile(shutil.make_archive(f"{folder}/tenderloom", "zip", os.path.dirname(here), os.path.basename(here)))


class Cut:
    """A table written to the shared folder. ``df`` reads it, ``drop()`` deletes it once nothing reads it any more; what is left goes when the driver ends."""

    def __init__(self, df: DataFrame, name: str = "cut"):
        self.spark = df.sparkSession
        ship(self.spark)
        self.path = f"{shared_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(self.path)
        fs, path = self._place()
        fs.deleteOnExit(path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)
        if _SCOPES:
            _SCOPES[-1].append(self)

    def _place(self) -> tuple:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def drop(self) -> None:
        fs, path = self._place()
        fs.delete(path, True)


@contextmanager
def scope() -> Iterator[None]:
    """Deletes at its end every table that operators wrote within; their results must have been used or written by then."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for written in _SCOPES.pop():
            written.drop()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the test data."""
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def parts(spark: SparkSession) -> int:
    """The number of shuffle partitions of this session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fits(df: DataFrame, limit: int) -> bool:
    """Whether ``df`` has at most ``limit`` rows; reads no more than ``limit`` + 1 of them."""
    return df.limit(limit + 1).count() <= limit
