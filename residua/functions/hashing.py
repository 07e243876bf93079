"""Seeded hashes. Everything random in the package is a hash of data, so a task
that is run again after an executor loss makes the same choices."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_BITS = 60


def hash_key(df: DataFrame, name: str) -> Column:
    """The column as a hash input; every integer width hashes alike."""
    column = F.col(name)
    return column.cast("bigint") if isinstance(df.schema[name].dataType, T.IntegralType) else column


def xx_hash(*parts: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 64 - HASH_BITS)


def md5_hash(*parts: Column) -> Column:
    """Slower; for splits that a system without xxHash must reproduce."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


HASHES = {"xxhash64": xx_hash, "md5": md5_hash}


def seeded_hash(seed: int, *parts: Column, name: str = "xxhash64") -> Column:
    """Hash in ``[0, 2**HASH_BITS)`` of the seed and the parts."""
    if name not in HASHES:
        raise ValueError(f"unknown hash {name!r}, expected one of {sorted(HASHES)}")
    return HASHES[name](F.lit(seed).cast("bigint"), *parts)


# Rounds of the bijection, and how often a number that fell outside may be sent on.
ROUNDS = 3
WALKS = 64


def _turned(of: str, by: str, side: str, seed: int, epoch: int, turn: str) -> str:
    """``of`` turned within ``side`` by the hash of ``by``, as SQL."""
    hashed = f"shiftrightunsigned(xxhash64({int(seed)}L, {int(epoch)}L, {turn}, {by}), {64 - HASH_BITS})"
    return f"({of} + {hashed} % {side}) % {side}"


def with_bijection(df: DataFrame, number: str, n: Column, seed: int, epoch: int, name: str) -> DataFrame:
    """Adds ``name``, a shuffle of ``[0, n)``: each number to its place, without looking at others.

    The numbers stand in a grid of ``a`` by ``b`` with ``a * b`` barely above ``n``. A round turns
    the row by a hash of the column, then the column by a hash of the row; each turn can be
    undone, so the rounds are a bijection of the grid. A place beyond ``n`` is sent on until it
    falls inside: one in the root of ``n`` is, and it takes fewer than ``a`` steps, as there are
    fewer such places. Numbers outside ``[0, n)`` fail the job, nulls stay null. A projection:
    every turn is a step of its own, so that generated code computes it once.
    """
    placed = df.withColumns({"_id": F.col(number).cast("bigint"), "_n": n.cast("bigint")})
    placed = placed.withColumn("_a", F.expr("greatest(cast(ceil(sqrt(cast(_n AS double))) AS bigint), 1L)"))
    placed = placed.withColumn("_b", F.expr("greatest((_n + _a - 1) div _a, 1L)"))
    placed = placed.withColumns({"_row": F.expr("_id div _b"), "_column": F.expr("pmod(_id, _b)")})
    for i in range(ROUNDS):
        placed = placed.withColumn("_row", F.expr(_turned("_row", "_column", "_a", seed, epoch, f"{2 * i}L")))
        placed = placed.withColumn("_column", F.expr(_turned("_column", "_row", "_b", seed, epoch, f"{2 * i + 1}L")))
    placed = placed.withColumn("_place", F.expr("_row * _b + _column"))
    row = _turned("s.row", "s.column", "_a", seed, epoch, "2 * i")
    column = _turned("s.column", row, "_b", seed, epoch, "2 * i + 1")
    again = f"""aggregate(
        sequence(0L, {ROUNDS - 1}L), named_struct('row', x div _b, 'column', pmod(x, _b)),
        (s, i) -> named_struct('row', {row}, 'column', {column}), s -> s.row * _b + s.column)"""
    walked = f"aggregate(sequence(1, {WALKS}), _place, (x, step) -> CASE WHEN x < _n THEN x ELSE {again} END)"
    placed = placed.withColumn("_place", F.expr(f"CASE WHEN _place < _n THEN _place ELSE {walked} END"))
    checked = """CASE
        WHEN _id < 0 OR _id >= _n THEN cast(raise_error(concat('not a number below the row count: ', _id)) AS bigint)
        WHEN _place >= _n THEN cast(raise_error('a place was not found') AS bigint) ELSE _place END"""
    return placed.withColumn(name, F.expr(checked)).drop("_id", "_a", "_b", "_n", "_row", "_column", "_place")
