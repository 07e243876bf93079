"""Where intermediate tables go: a folder that every executor can reach."""

import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="residua-")


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.

    Where that is unset a local master gets a temporary folder, and a cluster an error:
    a folder of one machine would lose the tables with the machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()


# Paths given out within ``stored_alone``.
_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    scratch = _SCRATCH.get()
    if scratch is not None:
        scratch.append(path)
    return path


# Catalog tables by the folder they are kept in.
_TABLES: dict[str, str] = {}


def on_delete(path: str, table: str) -> str:
    """Has the catalog's ``table`` dropped with its folder; gives its name."""
    _TABLES[path] = table
    return table


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder of the shared file system, if it is there, and the table kept in it."""
    if path in _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop(path)}")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def stored_alone(spark: SparkSession, build: Callable[[], DataFrame], name: str) -> DataFrame:
    """The result of ``build`` written and read back; the tables that it stored are deleted.

    They are of no use once the result is there, as nothing is computed from them again.
    """
    path = new_path(spark, name)
    inner: list[str] = []
    token = _SCRATCH.set(inner)
    try:
        df = build()
        df.write.parquet(path)
    finally:
        _SCRATCH.reset(token)
        for other in inner:
            delete(spark, other)
    return spark.read.schema(df.schema).parquet(path)


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back, which cuts its lineage."""
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def session_settings(spark: SparkSession, values: dict[str, str]):
    """The session's options are ``values`` within the block, and what they were behind it."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
