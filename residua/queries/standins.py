"""The inputs of the registered queries, all derived from the given tables.

Documents stand in for sequences and events for per-batch losses. Files that an
operator is to scan are written once per session and data directory, into the shared
folder of the session.
"""

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import index, keyed, numbered, reports, split
from ..operators.tokenize import tokenize
from ..plans.sizing import spread_if_narrow
from ..plans.workspace import new_path
from ..sources import read_index_map_folder, read_items, read_shards

MAX_LENGTH = 142
WRAP = 60
RANKS = 5
ACCUMULATION = 7
BUCKETS = 16

_STAGED: dict[tuple[str, str, str], str] = {}


def table_name(path: str) -> str:
    return "residua_" + path.rsplit("/", 1)[1].replace("-", "_")


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def spread(self, name: str) -> DataFrame:
        """A table whose rows are costly to work on, over all cores even if it is one split."""
        return spread_if_narrow(self(name))

    def staged(self, name: str, write) -> str:
        """Path of a data set, written by ``write(path)`` on first use."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _STAGED:
            path = new_path(self.spark, name)
            write(path)
            _STAGED[key] = path
        return _STAGED[key]

    @cached_property
    def sequences(self) -> DataFrame:
        return self.sequences_with()

    def sequences_with(self, *columns: str) -> DataFrame:
        """``doc_id, sequence, sequence_id``; letters of a document as residues."""
        return self.spread("documents").select(
            "doc_id",
            *columns,
            F.upper(F.regexp_replace("text", "[^A-Za-z]", "")).alias("sequence"),
            F.concat_ws(" ", "doc_id", "source").alias("sequence_id"),
        )

    @cached_property
    def tokenised(self) -> DataFrame:
        return tokenize(self.sequences, MAX_LENGTH).drop("sequence")

    def _fasta(self, path: str, codec: str) -> None:
        wrapped = F.regexp_replace("sequence", f"(.{{{WRAP}}})", "$1\n")
        record = F.concat(F.lit(">"), F.col("sequence_id"), F.lit("\n"), wrapped)
        self.sequences.select(record).write.option("compression", codec).text(path)

    @property
    def fasta(self) -> str:
        return self.staged("fasta", lambda path: self._fasta(path, "none"))

    @property
    def fasta_gzip(self) -> str:
        return self.staged("fasta-gzip", lambda path: self._fasta(path, "gzip"))

    @property
    def sequences_csv(self) -> str:
        return self.staged("csv", lambda path: split.write_sequences_csv(self.sequences, path))

    def _shards(self, path: str) -> None:
        # As many files as rows per file, so that both grow with the table.
        rows = self("documents").agg(F.ceil(F.sqrt(F.count("*")))).first()[0]
        split.write_shards(split.spread_by_id(self.tokenised, "doc_id", rows), path)

    @property
    def shards_path(self) -> str:
        return self.staged("shards", self._shards)

    @property
    def shards(self) -> DataFrame:
        return read_shards(self.spark, self.shards_path)

    def _index_maps(self, base: str) -> None:
        shards = read_shards(self.spark, self.shards_path, columns=[])
        index.write_index_map(index.index_map(shards), f"{base}/train_index_map", single_file=True)

    @property
    def index_base(self) -> str:
        return self.staged("index", self._index_maps)

    @property
    def index_map(self) -> DataFrame:
        return read_index_map_folder(self.spark, self.index_base, "train_index_map")

    def _items(self, path: str) -> None:
        keyed.write_items(keyed.as_items(self.tokenised, "doc_id"), path)

    @property
    def items_path(self) -> str:
        return self.staged("items", self._items)

    @property
    def items(self) -> DataFrame:
        return read_items(self.spark, self.items_path)

    @property
    def bucketed_items(self) -> DataFrame:
        """The items as a table bucketed by key; it is named after its folder."""
        def write(path: str) -> None:
            items = keyed.as_items(self.tokenised, "doc_id")
            keyed.write_bucketed_items(items, table_name(path), path, BUCKETS)

        return self.spark.table(table_name(self.staged("bucketed-items", write)))

    def _numbered(self, path: str) -> None:
        rows = self("documents").agg(F.ceil(F.sqrt(F.count("*")))).first()[0]
        samples = self.tokenised.withColumn("global_idx", F.col("doc_id"))
        numbered.write_numbered(samples, path, rows)

    @property
    def numbered_path(self) -> str:
        return self.staged("numbered", self._numbered)

    @property
    def numbered(self) -> DataFrame:
        return numbered.read_numbered(self.spark, self.numbered_path)

    @cached_property
    def batch_losses(self) -> DataFrame:
        """The prime in the losses keeps their means off the ties of decimal rounding."""
        event = F.col("event_id")
        return self("events").select(
            (F.floor(event / RANKS) % 2).cast("int").alias("epoch"),
            (event % RANKS).cast("int").alias("rank"),
            F.floor(event / (2 * RANKS)).cast("int").alias("batch_idx"),
            (1 + F.col("user_id") % 8).cast("int").alias("batch_size"),
            (F.round(F.col("value") * 100) / 997).alias("loss"),
            ((1 + F.col("user_id") % 10) / 4).alias("seconds"),
        )

    @cached_property
    def training_lines(self) -> DataFrame:
        steps = reports.training_report(self.batch_losses, ACCUMULATION, MAX_LENGTH)
        return reports.format_metrics(steps, "Training")

    @cached_property
    def eval_lines(self) -> DataFrame:
        epochs = reports.eval_report(self.batch_losses, MAX_LENGTH)
        return reports.format_metrics(epochs, "Eval")

    def _log(self, path: str) -> None:
        reports.write_log(self.training_lines.unionAll(self.eval_lines), path)

    @property
    def log(self) -> str:
        return self.staged("log", self._log)


# The same inputs in SQL.

SEQUENCES_SQL = """
    SELECT doc_id, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS sequence,
           concat(doc_id, ' ', source) AS sequence_id
    FROM documents"""

FASTA_SQL = f"""
    SELECT sequence_id, sequence,
           concat(sequence_id, chr(10),
                  regexp_replace(sequence, '(.{{{WRAP}}})', '\\1' || chr(10), 'g')) AS record
    FROM ({SEQUENCES_SQL})"""

LETTERS = "LAGVSERTIDPKQNFYMHWCXBUZO.-"
LETTER_CLASS = "LAGVSERTIDPKQNFYMHWCXBUZO.\\-"
LITERAL_IDS = {"<cls>": 0, "<pad>": 1, "<eos>": 2, "<unk>": 3, "<null_1>": 31, "<mask>": 32}
WHITE = (
    "\\x09-\\x0d\\x1c-\\x20\\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
)


def symbols_sql(text: str) -> str:
    """Literals become control characters 1 to 6 first, so that no lookahead is needed."""
    for i, literal in enumerate(LITERAL_IDS, 1):
        text = f"replace({text}, '{literal}', chr({i}))"
    pattern = f"[{LETTER_CLASS}\\x01-\\x06]|[^{LETTER_CLASS}\\x01-\\x06{WHITE}]+"
    return f"regexp_extract_all({text}, '{pattern}')"


def literal_names_sql(symbols: str) -> str:
    names = ", ".join(f"'{name}'" for name in LITERAL_IDS)
    return (
        f"list_transform({symbols}, lambda s: "
        f"CASE WHEN unicode(s) BETWEEN 1 AND 6 THEN [{names}][unicode(s)] ELSE s END)"
    )


def ids_sql(symbols: str) -> str:
    ids = ", ".join(str(i) for i in LITERAL_IDS.values())
    return (
        f"list_transform({symbols}, lambda s: CASE WHEN unicode(s) BETWEEN 1 AND 6 "
        f"THEN [{ids}][unicode(s)] WHEN instr('{LETTERS}', s) > 0 "
        f"THEN 3 + instr('{LETTERS}', s) ELSE 3 END)"
    )


def framed_sql(text: str, n: int = MAX_LENGTH) -> str:
    return f"([0] || ({ids_sql(symbols_sql(text))})[1:{n - 2}] || [2])"


TOKENISED_SQL = f"""
    SELECT doc_id, sequence_id, framed, list_resize(framed, {MAX_LENGTH}, 1) AS input_ids,
           list_resize(list_transform(framed, lambda x: 1), {MAX_LENGTH}, 0) AS attention_mask
    FROM (SELECT doc_id, sequence_id, {framed_sql("sequence")} AS framed
          FROM ({SEQUENCES_SQL}))"""

ROWS_PER_FILE_SQL = "(SELECT ceil(sqrt(count(*)))::BIGINT FROM documents)"

INDEX_MAP_SQL = f"""
    SELECT doc_id // {ROWS_PER_FILE_SQL} AS file_no, count(*) AS num_sequences,
           min(doc_id) AS start_line, max(doc_id) AS end_line
    FROM documents GROUP BY 1"""

BATCH_LOSSES_SQL = f"""
    SELECT (event_id // {RANKS}) % 2 AS epoch, event_id % {RANKS} AS rank,
           event_id // {2 * RANKS} AS batch_idx, 1 + user_id % 8 AS batch_size,
           round(value * 100) / 997 AS loss, (1 + user_id % 10) / 4 AS seconds
    FROM events"""


def text(column: str) -> str:
    return f"array_to_string({column}, ' ') AS {column}"
