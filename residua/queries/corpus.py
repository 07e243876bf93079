"""FASTA and CSV sources, record assembly, splits and shard files."""

from pyspark.sql import functions as F

from ..functions.hashing import HASH_BITS
from ..operators import split
from ..operators.tokenize import tokenize
from ..plans.workspace import new_path
from ..sources import fasta, read_fasta, read_sequences_csv
from .registry import Registry, joined
from .sqlhash import seeded_hash_sql
from .standins import FASTA_SQL, MAX_LENGTH, SEQUENCES_SQL, TOKENISED_SQL, WRAP, Tables, text

SEED = 42
FILES = 16
# Bytes of a file that are asked for, whatever the size of the table.
MOST_BYTES = 64 << 20


def fasta_scan(t: Tables):
    """Gzip scan, one row per record, header and wrapped body still together."""
    records = fasta.record_text(t.spark, t.fasta_gzip)
    return records.select(F.regexp_replace("value", r"\n$", "").alias("record"))


def csv_scan(t: Tables):
    return read_sequences_csv(t.spark, t.sequences_csv)


def assembled(t: Tables):
    return read_fasta(t.spark, t.fasta)


def to_table(t: Tables):
    """Record statistics over the table form, column order as declared."""
    return read_fasta(t.spark, t.fasta_gzip, partitions=8).select(
        "sequence_id", F.length("sequence").alias("residues")
    )


def joined_lines(t: Tables):
    """Bodies of wrapped records come back as one whole sequence, with its length and checksum."""
    sequence = F.col("sequence")
    return read_fasta(t.spark, t.fasta).select(
        sequence, "sequence_id", F.length(sequence).alias("residues"), F.md5(sequence.cast("binary")).alias("checksum"),
        (sequence.contains("\n") | sequence.contains(">")).alias("marks_left"),
    )


def sequences_written(t: Tables):
    """The CSV that a job writes from FASTA, read back."""
    path = new_path(t.spark, "snk1-fasta")
    split.write_sequences_csv(read_fasta(t.spark, t.fasta), path)
    return read_sequences_csv(t.spark, path)


def header_lines(t: Tables):
    lines = t.spark.read.text(t.fasta)
    return lines.where(F.col("value").startswith(">")).select(F.col("value").alias("header"))


def flushed_records(t: Tables):
    """No empty leading record, and the last record of every file is there."""
    return read_fasta(t.spark, t.fasta).agg(
        F.count("*").alias("records"),
        F.sum((F.col("sequence_id") == "").cast("bigint")).alias("without_id"),
        F.sum(F.length("sequence")).alias("residues"),
    )


def hash_split(t: Tables):
    return split.hash_split(t.sequences, "doc_id", 0.8, SEED).select("doc_id", "split")


def hash_split_text_key(t: Tables):
    sides = split.hash_split(t.sequences, "sequence_id", 0.8, SEED, hash="md5")
    return sides.select("sequence_id", "split")


def random_split(t: Tables):
    """Row split: disjoint sides of the right shares, the same for the same seed."""
    def sides(df):
        train, test = split.random_split(df, seed=SEED)
        return train.withColumn("side", F.lit("train")).unionAll(test.withColumn("side", F.lit("test")))

    ids = t("documents").select("doc_id")
    once, again = sides(ids), sides(ids).withColumnRenamed("side", "other")
    share = F.avg((F.col("side") == "train").cast("int"))
    return once.join(again, "doc_id").agg(
        F.count("*").alias("rows"), F.count_distinct("doc_id").alias("ids"),
        share.between(0.65, 0.95).alias("share_holds"), F.every(F.col("side") == F.col("other")).alias("repeats"),
    )


def edge_records(t: Tables):
    """Headers that are empty, begin with ``>`` or have no body, with whole wrapped sequences."""
    case = F.col("doc_id") % 4
    header = F.when(case == 0, "").when(case == 1, F.concat(F.lit(">"), "sequence_id")).otherwise(F.col("sequence_id"))
    body = F.when(case == 2, "").otherwise(F.concat(F.lit("\n"), F.regexp_replace("sequence", f"(.{{{WRAP}}})", "$1\n")))
    record = F.concat(F.lit(">"), header, body)
    path = t.staged("edge-fasta", lambda path: t.sequences.select(record).write.text(path))
    return read_fasta(t.spark, path)


def written_csv(t: Tables):
    """Ids that are empty or have blanks around them."""
    case = F.col("doc_id") % 3
    name = F.when(case == 0, "").when(case == 1, F.concat(F.lit(" "), "sequence_id", F.lit("  "))).otherwise(F.col("sequence_id"))
    path = new_path(t.spark, "snk1")
    split.write_sequences_csv(t.sequences.withColumn("sequence_id", name), path)
    return read_sequences_csv(t.spark, path)


def target_files(t: Tables):
    """As many files as a target of rows per file asks for, whatever the ids are."""
    rows = t.sequences.select("sequence_id")
    path = new_path(t.spark, "target")
    split.write_shards(rows, path, files=split.files_for(rows, 100))
    return _file_sizes(t, path)


def float_cast(t: Tables):
    """Losses in single precision, as a training script logs them."""
    loss = (F.col("value") / 997).cast("float")
    return t("events").select("event_id", loss.cast("double").alias("loss"))


def _file_sizes(t: Tables, path: str):
    rows = t.spark.read.parquet(path)
    sizes = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").alias("files"), F.sum("n").alias("rows"))


def round_robin_files(t: Tables):
    path = new_path(t.spark, "par1")
    split.write_shards(t.sequences, path, files=FILES)
    return _file_sizes(t, path)


def target_bytes(t: Tables):
    """Files of half to twice a target size, from rows in any order and by three hot keys."""
    rows = t.spread("lineitem")
    trial = new_path(t.spark, "trial-bytes")
    split.write_shards(rows, trial)
    total = split.file_sizes(t.spark, trial).agg(F.sum("bytes")).first()[0]
    target = min(total // 6, MOST_BYTES)
    # A hot key is split between the tasks that bring it. They read the trial's files, as a table
    # of one file may be one task, and a repartition before the writer's is left out by Spark.
    dealt = t.spark.read.parquet(trial)
    out = None
    for name, keys in (("even", []), ("hot", ["l_returnflag"])):
        ratio = 1.0
        for _ in range(2):
            path = new_path(t.spark, "target-bytes")
            split.write_shards_of_size(dealt, path, target, ratio, keys)
            ratio = split.measured_ratio(t.spark, path, target, ratio)
        within = F.col("bytes").between(target / 2, target * 2)
        sizes = split.file_sizes(t.spark, path).agg(F.every(within).alias("within"), (F.count("*") >= 3).alias("several"))
        here = t.spark.read.parquet(path).agg(F.count("*").alias("rows")).join(sizes).select(F.lit(name).alias("kind"), "rows", "within", "several")
        out = here if out is None else out.unionAll(here)
    return out


def bounded_files(t: Tables):
    """No file above the cap, no shuffle."""
    path = new_path(t.spark, "bounded")
    split.write_shards(t.sequences.select("doc_id"), path, rows_per_file=100)
    files = t.spark.read.parquet(path).groupBy(F.col("_metadata.file_name")).agg(
        F.count("*").alias("n")
    )
    return files.agg(F.sum("n").alias("rows"), (F.max("n") <= 100).alias("within_cap"))


def split_directories(t: Tables):
    path = new_path(t.spark, "snk2")
    rows = tokenize(split.hash_split(t.sequences, "doc_id", 0.8, SEED), MAX_LENGTH)
    rows = rows.select("doc_id", "split", "input_ids", "attention_mask")
    split.write_shards(rows, path, by_split=True)
    return t.spark.read.parquet(path).select(
        "doc_id", "split", joined("input_ids"), joined("attention_mask")
    )


def path_functions(t: Tables):
    """String functions of the record and path steps, over every page address."""
    url = F.col("url")
    return t("pages").select(
        "page_id",
        url.startswith("https:").alias("secure"),
        F.substr(url, F.lit(2)).alias("without_first"),
        F.concat(url, F.lit("/train")).alias("extended"),
        F.array_join(F.split(url, "/"), "").alias("joined"),
        F.regexp_extract(url, r".*/([^/]+)$", 1).alias("base_name"),
    )


def register(r: Registry) -> None:
    sequences = f"SELECT sequence, sequence_id FROM ({SEQUENCES_SQL})"
    limit = split.split_threshold(0.8)
    side = f"CASE WHEN {seeded_hash_sql(SEED, 'doc_id')} < {limit} THEN 'train' ELSE 'test' END"
    digits = HASH_BITS // 4
    md5_place = f"('0x' || substr(md5(concat('{SEED}:', sequence_id)), 1, {digits}))::BIGINT"

    r.add("src1_fasta_scan", fasta_scan, f"""
        SELECT regexp_replace(record, chr(10) || '$', '') AS record FROM ({FASTA_SQL})""")
    r.add("src2_csv_scan", csv_scan, sequences)
    r.add("prj1_assemble_records", assembled, sequences)
    r.add("prj2_records_to_table", to_table, f"""
        SELECT sequence_id, length(sequence)::INTEGER AS residues FROM ({SEQUENCES_SQL})""")
    r.add("fil1_header_lines", header_lines, f"""
        SELECT concat('>', sequence_id) AS header FROM ({SEQUENCES_SQL})""")
    r.add("fil2_flushed_records", flushed_records, f"""
        SELECT count(*) AS records, 0::BIGINT AS without_id,
               sum(length(sequence))::BIGINT AS residues
        FROM ({SEQUENCES_SQL})""")
    r.add("spl1_hash_split", hash_split, f"""
        SELECT doc_id, {side} AS split FROM documents""")
    r.add("spl1_hash_split_text_key", hash_split_text_key, f"""
        SELECT sequence_id, CASE WHEN {md5_place} < {limit} THEN 'train' ELSE 'test' END AS split
        FROM ({SEQUENCES_SQL})""")
    r.add("spl1_random_split", random_split, """
        SELECT count(*) AS rows, count(*) AS ids, true AS share_holds, true AS repeats
        FROM documents""")
    r.add("prj1_edge_records", edge_records, f"""
        SELECT CASE WHEN doc_id % 4 = 2 THEN '' ELSE sequence END AS sequence,
               CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN concat('>', sequence_id)
                    ELSE sequence_id END AS sequence_id
        FROM ({SEQUENCES_SQL})""")
    r.add("par1_target_files", target_files, """
        SELECT ceil(count(*) / 100)::BIGINT AS files, count(*) AS rows FROM documents""")
    r.add("fun_cast_float", float_cast, """
        SELECT event_id, (value / 997)::FLOAT::DOUBLE AS loss FROM events""")
    r.add("par1_round_robin_files", round_robin_files, f"""
        SELECT {FILES}::BIGINT AS files, count(*) AS rows FROM documents""")
    r.add("par1_target_bytes", target_bytes, """
        SELECT kind, count(*) AS rows, true AS within, true AS several
        FROM lineitem, (VALUES ('even'), ('hot')) k(kind) GROUP BY kind""")
    r.add("par1_bounded_files", bounded_files, """
        SELECT count(*) AS rows, true AS within_cap FROM documents""")
    r.add("snk1_sequences_csv", sequences_written, sequences)
    r.add("snk1_written_csv", written_csv, f"""
        SELECT sequence, CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN concat(' ', sequence_id, '  ')
                              ELSE sequence_id END AS sequence_id
        FROM ({SEQUENCES_SQL})""")
    r.add("snk2_split_directories", split_directories, f"""
        SELECT doc_id, {side} AS split, {text("input_ids")}, {text("attention_mask")}
        FROM ({TOKENISED_SQL})""")
    r.add("udf2_lines_to_records", joined_lines, f"""
        SELECT sequence, sequence_id, length(sequence)::INTEGER AS residues, md5(sequence) AS checksum,
               false AS marks_left
        FROM ({SEQUENCES_SQL})""")
    r.add("fun_paths_and_strings", path_functions, r"""
        SELECT page_id, starts_with(url, 'https:') AS secure,
               substr(url, 2) AS without_first, concat(url, '/train') AS extended,
               array_to_string(string_split(url, '/'), '') AS joined,
               regexp_extract(url, '.*/([^/]+)$', 1) AS base_name
        FROM pages""")
