"""Index-map queries, on shards and on other tables with a file-like column."""

from pyspark.sql import functions as F

from ..operators import index
from ..operators.lookup import with_global_index
from ..operators.split import hash_split, write_shards
from ..plans.workspace import new_path, stored
from ..sources import index_file_path, read_index_map, read_index_map_folder, read_shard, read_shards
from .registry import Registry, file_no, joined
from .standins import INDEX_MAP_SQL, ROWS_PER_FILE_SQL, TOKENISED_SQL, Tables, text

LINES = ["num_sequences", "start_line", "end_line"]


def numbered(df, *columns):
    return df.select(file_no(), *(columns or LINES))


def by_ship_month(t: Tables):
    """A month of shipments plays a file."""
    month = F.date_format("l_shipdate", "yyyy-MM")
    return t("lineitem").select(month.alias("file_name"))


def parquet_scan(t: Tables):
    rows = t.spark.read.parquet(t.shards_path)
    return rows.select("doc_id", joined("input_ids"), joined("attention_mask"))


def provenance(t: Tables):
    return t.shards.select("doc_id", file_no(), "row_index")


def listing(t: Tables):
    return numbered(
        index.with_line_num_names(index.index_map(t.shards)),
        "num_sequences", "start_line_num", "end_line_num",
    )


def index_csv_scan(t: Tables):
    path = index_file_path(t.spark, t.index_base, "train_index_map")
    return numbered(read_index_map(t.spark, path))


def index_folder(t: Tables):
    return numbered(t.index_map)


def index_parts(t: Tables):
    """A map that was written as several files."""
    def write(base):
        index.write_index_map(index.index_map(read_shards(t.spark, t.shards_path, [])).repartition(3), f"{base}/parts")

    return numbered(read_index_map_folder(t.spark, t.staged("index-parts", write), "parts"))


def both_splits(t: Tables):
    """Rows of a corpus whose splits repeat base names, numbered over the root."""
    def write(path):
        rows = hash_split(t.tokenised, "doc_id", 0.8, 42).select("doc_id", "split", "input_ids")
        write_shards(rows, path, by_split=True)

    shards = read_shards(t.spark, t.staged("both-splits", write), ["doc_id"])
    rows = with_global_index(shards, index.index_map(shards))
    return rows.agg(
        F.count("*").alias("rows"), F.count_distinct("global_idx").alias("places"),
        F.min("global_idx").alias("first_place"), F.max("global_idx").alias("last_place"),
        F.count_distinct("doc_id").alias("documents"),
    )


def one_shard(t: Tables):
    """The first shard by name; shards grow with the table."""
    name = index.first_files(t.index_map, 1).first().file_name
    return read_shard(t.spark, t.shards_path, name).select("doc_id", joined("input_ids"))


def csv_files_only(t: Tables):
    """Part files of the index folder, markers left out."""
    path = index_file_path(t.spark, t.index_base, "train_index_map")
    rows = read_index_map(t.spark, path)
    return rows.agg(
        F.lit(path.endswith(".csv")).alias("is_csv"), F.count("*").alias("files_in_map")
    )


def rows_per_month(t: Tables):
    return index.rows_per_file(by_ship_month(t))


def rows_per_shard(t: Tables):
    return numbered(index.rows_per_file(t.shards), "num_sequences")


def month_map(t: Tables):
    return index.index_map(by_ship_month(t))


def month_starts(t: Tables):
    return month_map(t).select("file_name", "start_line")


def part_starts(t: Tables):
    """Lines of a part play a file; its start by the lines of all parts before it."""
    named = t("lineitem").select(F.lpad(F.col("l_partkey").cast("string"), 12, "0").alias("file_name"))
    return index.index_map(named).select("file_name", "start_line")


def month_ends(t: Tables):
    return month_map(t).select("file_name", "end_line")


def customer_map(t: Tables):
    """Orders of a customer play a file: many files, no common size."""
    named = t("orders").select(F.col("o_custkey").cast("string").alias("customer"))
    return index.index_map(named, file_col="customer")


def priority_map(t: Tables):
    rows = t("orders").withColumnRenamed("o_orderpriority", "file_name")
    return index.with_line_num_names(index.index_map(rows))


def length_of_shards(t: Tables):
    return index.dataset_length(t.index_map)


def length_of_lineitem(t: Tables):
    return index.dataset_length(month_map(t))


def sample_map(t: Tables):
    return numbered(index.first_files(t.index_map, 3))


def name_order(t: Tables):
    """Files in name order: each starts where the one before it ended."""
    ordered = month_map(t).orderBy("file_name")
    return ordered.select("file_name", (F.col("start_line") == 0).alias("is_first"), "end_line")


def single_file(t: Tables):
    path = new_path(t.spark, "snk3")
    index.write_index_map(index.index_map(read_shards(t.spark, t.shards_path, [])), path, single_file=True)
    files = read_index_map(t.spark, path).groupBy(F.col("_metadata.file_name")).agg(
        F.count("*").alias("n")
    )
    return files.agg(F.count("*").alias("csv_files"), F.sum("n").alias("rows"))


def index_written(t: Tables):
    path = new_path(t.spark, "snk3-months")
    index.write_index_map(month_map(t), path)
    return read_index_map(t.spark, path)


def sample_written(t: Tables):
    path = new_path(t.spark, "snk4")
    index.write_index_map(index.first_files(month_map(t), 3), path)
    return read_index_map(t.spark, path)


MONTHS_SQL = """
    SELECT file_name, num_sequences, (through - num_sequences)::BIGINT AS start_line,
           (through - 1)::BIGINT AS end_line
    FROM (SELECT file_name, num_sequences, sum(num_sequences) OVER (ORDER BY file_name) AS through
          FROM (SELECT strftime(l_shipdate, '%Y-%m') AS file_name, count(*) AS num_sequences
                FROM lineitem GROUP BY 1))"""


def incremental_map(t: Tables):
    """A folder that gets a second batch of files: only those are counted."""
    path = new_path(t.spark, "growing-shards")
    size = t("documents").agg(F.floor(F.sqrt(F.count("*"))).alias("n")).first().n
    rows = t("documents").select("doc_id", (F.col("doc_id") >= F.floor(F.lit(size * size / 2))).cast("int").alias("late"))
    known = None
    for late in (0, 1):
        part = rows.where(F.col("late") == late).drop("late")
        write_shards(part.repartitionByRange(int(size) // 2 + 1, "doc_id"), f"{path}/batch={late}")
        if known is None:
            known = stored(t.spark, index.index_map(read_shards(t.spark, path, [])), "known-map")
        else:
            known = index.extended_index_map(t.spark, known, path)
    batch = F.regexp_extract("file_name", r"^batch=(\d)/", 1).cast("bigint").alias("batch")
    return known.groupBy(batch).agg(
        F.sum("num_sequences").alias("num_sequences"), F.min("start_line").alias("start_line"), F.max("end_line").alias("end_line"),
    )


def register(r: Registry) -> None:
    lines = f"SELECT file_no, num_sequences, start_line, end_line FROM ({INDEX_MAP_SQL})"
    months = f"SELECT file_name, num_sequences, start_line, end_line FROM ({MONTHS_SQL})"
    r.add("src3_parquet_scan", parquet_scan, f"""
        SELECT doc_id, {text("input_ids")}, {text("attention_mask")} FROM ({TOKENISED_SQL})""")
    r.add("src4_file_provenance", provenance, f"""
        SELECT doc_id, doc_id // {ROWS_PER_FILE_SQL} AS file_no,
               doc_id % {ROWS_PER_FILE_SQL} AS row_index
        FROM documents""")
    r.add("src5_directory_listing", listing, f"""
        SELECT file_no, num_sequences, start_line AS start_line_num, end_line AS end_line_num
        FROM ({INDEX_MAP_SQL})""")
    r.add("src5_incremental_map", incremental_map, """
        SELECT late AS batch, count(*) AS num_sequences, (sum(count(*)) OVER (ORDER BY late) - count(*))::BIGINT AS start_line,
               (sum(count(*)) OVER (ORDER BY late) - 1)::BIGINT AS end_line
        FROM (SELECT (doc_id >= floor(floor(sqrt(n)) * floor(sqrt(n)) / 2))::BIGINT AS late
              FROM documents, (SELECT count(*) AS n FROM documents)) GROUP BY late""")
    r.add("src6_index_map_csv", index_csv_scan, lines)
    r.add("src7_index_map_folder", index_folder, lines)
    r.add("src7_index_map_parts", index_parts, lines)
    r.add("join3_both_splits", both_splits, """
        SELECT count(*) AS rows, count(*) AS places, 0::BIGINT AS first_place,
               count(*) - 1 AS last_place, count(*) AS documents
        FROM documents""")
    r.add("src8_one_shard", one_shard, f"""
        SELECT doc_id, {text("input_ids")} FROM ({TOKENISED_SQL})
        WHERE doc_id < {ROWS_PER_FILE_SQL}""")
    r.add("fil6_csv_files_only", csv_files_only, f"""
        SELECT true AS is_csv, count(*) AS files_in_map FROM ({INDEX_MAP_SQL})""")
    r.add("agg1_rows_per_file", rows_per_month, """
        SELECT strftime(l_shipdate, '%Y-%m') AS file_name, count(*) AS num_sequences
        FROM lineitem GROUP BY 1""")
    r.add("agg1_rows_per_shard", rows_per_shard, f"""
        SELECT file_no, num_sequences FROM ({INDEX_MAP_SQL})""")
    r.add("win1_running_total", month_map, months)
    r.add("win2_previous_total", month_starts, f"SELECT file_name, start_line FROM ({MONTHS_SQL})")
    r.add("win3_sequential_carry", priority_map, """
        SELECT o_orderpriority AS file_name, count(*) AS num_sequences,
               (sum(count(*)) OVER (ORDER BY o_orderpriority) - count(*))::BIGINT
                   AS start_line_num,
               (sum(count(*)) OVER (ORDER BY o_orderpriority) - 1)::BIGINT AS end_line_num
        FROM orders GROUP BY 1""")
    r.add("prj6_start_line", part_starts, """
        SELECT file_name, (sum(n) OVER (ORDER BY file_name) - n)::BIGINT AS start_line
        FROM (SELECT lpad(l_partkey::VARCHAR, 12, '0') AS file_name, count(*) AS n FROM lineitem GROUP BY 1)""")
    r.add("prj7_end_line", month_ends, f"SELECT file_name, end_line FROM ({MONTHS_SQL})")
    r.add("prj8_four_columns", customer_map, """
        SELECT file_name, num_sequences, (through - num_sequences)::BIGINT AS start_line,
               (through - 1)::BIGINT AS end_line
        FROM (SELECT file_name, num_sequences,
                     sum(num_sequences) OVER (ORDER BY file_name) AS through
              FROM (SELECT o_custkey::VARCHAR AS file_name, count(*) AS num_sequences
                    FROM orders GROUP BY 1))""")
    r.add("agg2_dataset_length", length_of_shards, "SELECT count(*) AS num_rows FROM documents")
    r.add("lim2_last_end_line", length_of_lineitem, "SELECT count(*) AS num_rows FROM lineitem")
    r.add("lim1_first_files", sample_map, f"""
        SELECT file_no, num_sequences, start_line, end_line FROM ({INDEX_MAP_SQL})
        ORDER BY start_line LIMIT 3""")
    r.add("srt1_name_order", name_order, f"""
        SELECT file_name, start_line = 0 AS is_first, end_line FROM ({MONTHS_SQL})""")
    r.add("par2_single_file", single_file, f"""
        SELECT 1::BIGINT AS csv_files, count(*) AS rows FROM ({INDEX_MAP_SQL})""")
    r.add("snk3_index_map_csv", index_written, months)
    r.add("snk4_sample_index_map", sample_written, f"{months} ORDER BY start_line LIMIT 3")
