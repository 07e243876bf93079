"""Connected components of a table of links, in a number of rounds that grows slowly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.workspace import stored
from .tasks import map_arrow_partition

# When so few links are left, one task closes them; a fixed bound, whatever the input.
LAST_LINKS = 10_000


def _rank(column: str, round_no: int) -> Column:
    """Orders vertices: by id, and every third round by a hash, so that no order of ids is slow."""
    if round_no % 3 < 2:
        return F.col(column)
    return F.xxhash64(F.col(column), F.lit(round_no))


def _closed(batches):
    """The least id of the component of every vertex of the last links."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    yield {"a": list(root), "name": [find(x) for x in root]}


def _renamed(names: DataFrame, new: DataFrame) -> DataFrame:
    """Names after another round."""
    after = new.select(F.col("a").alias("name"), F.col("name").alias("next"))
    return names.join(after, "name", "left").select("a", F.coalesce("next", "name").alias("name"))


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for every id in ``links`` (``a, b``, bigint, not null).

    Each round gives every vertex the name of its least neighbour, or keeps its own if that
    is less, and drops the links that have closed. The least id of a component names it. A
    vertex with many links is counted in the tasks first and joined by splittable joins; a
    round's links are written to the shared folder, which cuts the lineage. The last
    ``LAST_LINKS`` are closed in one step, as chains shrink slowly at the end.
    """
    spark = links.sparkSession
    left = stored(spark, links.where("a <> b").distinct(), "links")
    names: DataFrame | None = None
    round_no = 0
    while (count := left.count()) > LAST_LINKS:
        both = left.select("a", "b").unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.struct(_rank("b", round_no).alias("rank"), F.col("b"))).alias("least"))
        mine = _rank("a", round_no)
        new = stored(
            spark,
            least.select("a", F.when(F.col("least.rank") < mine, F.col("least.b")).otherwise(F.col("a")).alias("name")),
            "names",
        )
        here, there = new.withColumnRenamed("name", "na"), new.select(F.col("a").alias("b"), F.col("name").alias("nb"))
        left = stored(
            spark,
            left.join(here, "a").join(there, "b").where("na <> nb").select(F.col("na").alias("a"), F.col("nb").alias("b")).distinct(),
            "links",
        )
        names = new if names is None else _renamed(names, new)
        round_no += 1
    if names is None or count:
        last = map_arrow_partition(left.repartition(1), "a bigint, name bigint", _closed)
        names = last if names is None else _renamed(names, last)
    least = names.groupBy("name").agg(F.min("a").alias("component"))
    return stored(spark, names.join(least, "name").select(F.col("a").alias("id"), "component"), "components")
