"""Near-duplicate vectors by random hyperplanes, checked by exact cosine.

Equal vectors of a label are one class from the start. The signs of a class's products with
some random planes are its key in a table; classes that share a key in one of several tables
are compared in double precision, as blocks of a matrix product in the tasks. A pair counts in
the first table in which it meets. The number of planes grows with the logarithm of the
largest label and the number of tables with it, so that a pair at the threshold is missed with
a fixed small probability and a table's buckets stay small.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and
rows with a null label or a null id, link with nothing and are kept; so do vectors of different
length. Each row is a vector: a row that repeats another counts as a link of it. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.workspace import stored
from .graph import components
from .tasks import map_arrow, map_arrow_partition
from .words import U64, mix


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.93
    miss: float = 0.005
    min_planes: int = 8
    max_planes: int = 24
    # Members of a bucket that are compared as one block; larger buckets are cut into blocks.
    block: int = 1024
    seed: int = 11


@dataclass(frozen=True)
class Tables:
    planes: int
    tables: int
    seed: int


def tables_for(largest: int, settings: Settings = Settings()) -> Tables:
    """Planes so that few unrelated vectors of the largest label share a key, and tables
    so that a pair at the threshold is missed with probability ``miss`` at most."""
    planes = min(max(math.ceil(math.log2(max(largest, 2))) + 2, settings.min_planes), settings.max_planes)
    together = (1 - math.acos(settings.threshold) / math.pi) ** planes
    return Tables(planes, math.ceil(math.log(settings.miss) / math.log(1 - together)), settings.seed)


def keys_of(x: np.ndarray, tables: Tables) -> np.ndarray:
    """The key of each vector in each table. Float sums decide signs, so equal rows agree."""
    rng = np.random.default_rng(tables.seed)
    normals = rng.normal(size=(x.shape[1], tables.tables * tables.planes))
    signs = (x @ normals > 0).reshape(len(x), tables.tables, tables.planes)
    return signs @ (1 << np.arange(tables.planes))


def _usable(vector: Column, label: Column, vec_id: Column) -> Column:
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    nonzero = F.exists(vector, lambda c: c != 0)
    return vec_id.isNotNull() & label.isNotNull() & F.coalesce(finite & nonzero, F.lit(False))


def classes_of(rows: DataFrame) -> DataFrame:
    """``cid, rep, n_rows, label, v``: equal vectors of a label once."""
    grouped = rows.where("usable").groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n_rows"))
    return grouped.withColumn("cid", F.monotonically_increasing_id())


def _unit_vectors(lists: pa.Array) -> np.ndarray:
    x = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _by_length(lists: pa.Array) -> Iterator[np.ndarray]:
    lengths = np.diff(lists.offsets.to_numpy())
    for n in np.unique(lengths):
        yield np.flatnonzero(lengths == n)


def buckets(classes: DataFrame, tables: Tables) -> DataFrame:
    """``cid, bucket, t``: a class's bucket in each table."""

    def each(batch):
        lists, cid = batch.column("v"), batch.column("cid").to_numpy()
        label = batch.column("label_hash").to_numpy().astype(U64)
        for rows in _by_length(lists):
            x = _unit_vectors(lists.take(pa.array(rows)))
            keys = keys_of(x, tables).astype(U64)
            t = np.arange(tables.tables, dtype=U64)
            own = mix(mix(keys * U64(64) + U64(1)) ^ mix(t + U64(1000 * x.shape[1])) ^ label[rows][:, None])
            yield {
                "cid": np.repeat(cid[rows], tables.tables), "bucket": own.view(np.int64).ravel(),
                "t": np.tile(np.arange(tables.tables), len(rows)),
            }

    return map_arrow(classes.select("cid", "v", F.xxhash64("label").alias("label_hash")), "cid bigint, bucket bigint, t int", each)


def _runs(batches, names: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows that agree in ``names``, from batches sorted by them."""
    rest: pa.Table | None = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        rest = part if rest is None else pa.concat_tables([rest, part])
        change = np.zeros(max(len(rest) - 1, 0), bool)
        for name in names:
            values = rest.column(name).to_numpy()
            change |= values[1:] != values[:-1]
        ends = np.flatnonzero(change) + 1
        at = 0
        for end in ends:
            yield rest.slice(at, end - at)
            at = int(end)
        rest = rest.slice(at).combine_chunks()
    if rest is not None and len(rest):
        yield rest


def _linked(run: pa.Table, tables: Tables, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of a run that are similar enough, in either order."""
    x = _unit_vectors(run.column("v").combine_chunks())
    cross = run.column("lo")[0].as_py() != run.column("hi")[0].as_py()
    if cross:
        block = run.column("block").to_numpy()
        one, two = np.flatnonzero(block == run.column("lo")[0].as_py()), np.flatnonzero(block == run.column("hi")[0].as_py())
        i, j = np.nonzero(x[one] @ x[two].T >= threshold)
        i, j = one[i], two[j]
    else:
        i, j = np.nonzero(np.triu(x @ x.T >= threshold, 1))
    return i, j


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least member that each of ``n`` members reaches by the links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def links_in_buckets(members: DataFrame, tables: Tables, settings: Settings) -> DataFrame:
    """``cid, n, root``: rows linked to a class that it met here first, and a class linked to it."""

    def whole(batches):
        for run in _runs(batches, ["bucket", "t", "lo", "hi"]):
            if len(run) < 2:
                continue
            i, j = _linked(run, tables, settings.threshold)
            if not len(i):
                continue
            cid, n_rows = run.column("cid").to_numpy(), run.column("n_rows").to_numpy()
            root = _roots(len(run), i, j)
            t = run.column("t")[0].as_py()
            if t:
                keys = keys_of(_unit_vectors(run.column("v").combine_chunks()), tables)[:, :t]
                fresh = np.ones(len(i), bool)
                for at in range(0, len(i), 1 << 16):
                    some = slice(at, at + (1 << 16))
                    fresh[some] = ~(keys[i[some]] == keys[j[some]]).any(axis=1)
                i, j = i[fresh], j[fresh]
            n = np.zeros(len(run), np.int64)
            np.add.at(n, i, n_rows[j])
            np.add.at(n, j, n_rows[i])
            some = np.flatnonzero((n > 0) | (root != np.arange(len(run))))
            yield {"cid": cid[some], "n": n[some], "root": cid[root[some]]}

    return map_arrow_partition(members, "cid bigint, n bigint, root bigint", whole)


def near_duplicates(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vec_id, embedding, label``."""
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label"), F.col("embedding").cast("array<double>").alias("v")
    ).withColumn("usable", _usable(F.col("v"), F.col("label"), F.col("vec_id")))
    classes = stored(spark, classes_of(rows), "vector-classes")
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    tables = tables_for(largest, settings)

    places = stored(spark, buckets(classes, tables), "vector-buckets")
    shared = places.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1")
    blocks = F.ceil(F.col("m") / settings.block).cast("int")
    members = (
        places.join(shared, "bucket")
        .withColumn("block", F.pmod(F.xxhash64("cid"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
        .join(classes.select("cid", "n_rows", "v"), "cid")
        .repartition("bucket", "t", "lo", "hi").sortWithinPartitions("bucket", "t", "lo", "hi")
        .select("bucket", "t", "lo", "hi", "block", "cid", "n_rows", "v")
    )
    found = stored(spark, links_in_buckets(members, tables, settings), "vector-links")
    linked = found.groupBy("cid").agg(F.sum("n").alias("n"))
    parts = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b"))).withColumnRenamed("id", "cid")
    named = classes.join(parts, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = (
        named.join(least, "component").join(linked, "cid", "left")
        .select("label", "v", "component_id", (F.coalesce("n", F.lit(0)) + F.col("n_rows") - 1).alias("n_links"))
    )
    alone = rows.where(~F.col("usable")).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    together = rows.where("usable").join(of_class, ["label", "v"]).select("vec_id", "n_links", "component_id")
    return together.unionAll(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
