"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session zone to UTC, which all date columns here are stated in."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Hold a setting of the session within this."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder of its own.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="cinderlog-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.conf.set(CHECKPOINT_SETTING, own)
    return own


def work_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below this application's folder in the shared folder."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/cinderlog/{spark.sparkContext.applicationId}"


def clean(spark: SparkSession) -> None:
    """Remove all working tables of this application; frames that read them can't be used any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Spark then removes the shuffle files of a query when the query has ended, instead of at some later collection of garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def freeze(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back, so that later steps see one fixed state."""
    spark = df.sparkSession
    path = work_path(spark, label)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    frozen = spark.read.schema(df.schema).parquet(path)
    frozen._frozen_at = path
    return frozen


def discard(*frozen: DataFrame) -> None:
    """Remove working tables that `freeze` made; frames that read them can't be used any more."""
    for df in frozen:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._frozen_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
