"""Named queries and their SQL."""

from collections.abc import Callable
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .standins import Tables


def joined(column: str):
    """An array as text, so that results compare by value in any engine."""
    return F.array_join(F.col(column).cast("array<string>"), " ").alias(column)


def file_no():
    """Number of the task that wrote a shard; the rest of the name is random."""
    return F.regexp_extract("file_name", r"^part-(\d+)-", 1).cast("bigint").alias("file_no")


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, build: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
        if name in self.queries:
            raise ValueError(f"query {name!r} is registered twice")
        self.queries[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            self.sql[name] = dedent(sql).strip()
