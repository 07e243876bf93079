"""Small helpers to run Arrow functions in the tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string


def columns_as(df: DataFrame, **named: tuple[str, str]) -> DataFrame:
    """Only the named columns, ``name=(column, type)``; a column that is absent is null."""
    return df.select(*[
        (F.col(f"`{column}`") if column in df.columns else F.lit(None)).cast(kind).alias(name)
        for name, (column, kind) in named.items()
    ])


def map_arrow(
    df: DataFrame, schema: str | StructType, each: Callable[[pa.RecordBatch], Iterable[dict]]
) -> DataFrame:
    """Applies ``each`` to every record batch; it yields columns by name."""
    return map_arrow_partition(df, schema, lambda batches: (out for b in batches for out in each(b)))


def map_arrow_partition(
    df: DataFrame, schema: str | StructType, whole: Callable[[Iterator[pa.RecordBatch]], Iterable[dict]]
) -> DataFrame:
    """Like ``map_arrow`` for a function over all batches of a partition."""
    fields: StructType = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in whole(batches):
            yield pa.RecordBatch.from_arrays(
                [_array(columns[f.name], f.type) for f in arrow], schema=arrow
            )

    return df.mapInArrow(run, fields)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def fixed_lists(matrix, kind: pa.DataType) -> pa.Array:
    """A two-dimensional array as a list column."""
    rows, width = matrix.shape
    offsets = pa.array(range(0, rows * width + 1, width) if width else [0] * (rows + 1), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.ravel(), kind))
