"""Declared schemas of every table the package reads or writes."""

from pyspark.sql import types as T

SEQUENCES = T.StructType(
    [
        T.StructField("sequence", T.StringType()),
        T.StructField("sequence_id", T.StringType()),
    ]
)

TOKENISED = T.StructType(
    [
        T.StructField("sequence_id", T.StringType()),
        T.StructField("input_ids", T.ArrayType(T.IntegerType())),
        T.StructField("attention_mask", T.ArrayType(T.IntegerType())),
    ]
)

INDEX_MAP = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("num_sequences", T.LongType()),
        T.StructField("start_line", T.LongType()),
        T.StructField("end_line", T.LongType()),
    ]
)

KEYED_ITEMS = T.StructType(
    [
        T.StructField("sequence_id", T.LongType()),
        T.StructField("input_ids", T.ArrayType(T.DecimalType(38, 0))),
        T.StructField("attention_mask", T.ArrayType(T.DecimalType(38, 0))),
    ]
)

BATCH_LOSSES = T.StructType(
    [
        T.StructField("epoch", T.IntegerType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("batch_idx", T.IntegerType()),
        T.StructField("batch_size", T.IntegerType()),
        T.StructField("loss", T.DoubleType()),
        T.StructField("seconds", T.DoubleType()),
    ]
)

LOG_LINES = T.StructType([T.StructField("value", T.StringType())])
