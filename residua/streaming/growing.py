"""Metrics from log files that grow: appended lines arrive once, in whole lines.

The source keeps a byte offset per file, behind the last line break that was there, so an
unfinished last line waits until it is complete. The offsets are the stream's own, kept in its
checkpoint: after a restart it goes on where the last finished batch ended. A file that has
become shorter, or whose beginning has changed, fails the stream, or is read from its start
with ``truncated="restart"``. A file that is gone is forgotten.

Lines end with a line feed; a carriage return before it is dropped. Files are read with
pyarrow's file systems, local and remote, in pieces, so that a large backlog is the work of
many tasks; a driver call lists the folder and reads the last block of each file that grew.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..functions.metrics import METRIC_PATTERNS
from ..operators.reports import parse_metrics

FORMAT = "residua_growing_text"
# Bytes of one task, of one read, and of the beginning by which a file is known again.
PIECE = 64 << 20
BLOCK = 1 << 20
HEAD = 256


@dataclass
class Piece(InputPartition):
    """Lines that begin in ``[low, high)``; the lines of the batch begin at ``first``."""

    file: str
    first: int
    low: int
    high: int


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(path)


class GrowingReader(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.path, self.files = options["path"], options.get("files", "*")
        self.piece = int(options.get("pieceBytes", PIECE))
        self.truncated = options.get("truncated", "fail")
        if self.truncated not in ("fail", "restart"):
            raise ValueError(f"truncated must be 'fail' or 'restart', got {self.truncated!r}")
        # Where each file was found to end, to look no further back again.
        self.seen: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """``file: [end, bytes of the beginning, their checksum]`` of every file."""
        system, root = open_folder(self.path)
        out = {}
        for info in system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            name = info.base_name
            if info.type != fs.FileType.File or name.startswith(("_", ".")) or not fnmatch(name, self.files):
                continue
            with system.open_input_file(info.path) as file:
                end = _whole_lines(file, min(self.seen.get(info.path, 0), info.size), info.size)
                n = min(HEAD, end)
                out[info.path] = [end, n, zlib.crc32(file.read_at(n, 0))]
            self.seen[info.path] = end
        return out

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        system, _ = open_folder(self.path)
        pieces = []
        for file, (stop, *_) in sorted(end.items()):
            first, n, checksum = start.get(file, (0, 0, 0))
            if n:
                with system.open_input_file(file) as opened:
                    same = stop >= first and zlib.crc32(opened.read_at(n, 0)) == checksum
                if not same:
                    if self.truncated == "fail":
                        raise RuntimeError(f"{file} was truncated or replaced after byte {first}")
                    first = 0
            for low in range(first, stop, self.piece):
                pieces.append(Piece(file, first, low, min(low + self.piece, stop)))
        return pieces

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        system, _ = open_folder(self.path)
        with system.open_input_file(partition.file) as file:
            for start, lines in _lines(file, partition):
                text = [line.removesuffix(b"\r").decode("utf-8", "replace") for line in lines]
                at = [start]
                for line in lines[:-1]:
                    at.append(at[-1] + len(line) + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(text, pa.string()), pa.array([partition.file] * len(text), pa.string()), pa.array(at, pa.int64())],
                    names=["value", "file", "start"],
                )


def _whole_lines(file, known: int, size: int) -> int:
    """The place behind the last line break, ``known`` if there is none behind it."""
    high = size
    while high > known:
        low = max(known, high - BLOCK)
        at = file.read_at(high - low, low).rfind(b"\n")
        if at >= 0:
            return low + at + 1
        high = low
    return known


def _lines(file, piece: Piece) -> Iterator[tuple[int, list[bytes]]]:
    """Start and lines of each block; the line over the piece's end belongs to it."""
    at, rest, skip = piece.low, b"", False
    if piece.low > piece.first:
        # The line that holds the byte before belongs to the piece before.
        at, skip = piece.low - 1, True
    while True:
        if not skip and at - len(rest) >= piece.high:
            return
        block = file.read_at(BLOCK, at)
        if not block:
            return
        begin, data = at - len(rest), rest + block
        at += len(block)
        if skip:
            cut = data.find(b"\n") + 1
            if not cut:
                continue
            begin, data, skip = begin + cut, data[cut:], False
        lines = data.split(b"\n")
        rest = lines.pop()
        # Only lines that begin within the piece.
        keep, place = 0, begin
        while keep < len(lines) and place < piece.high:
            place += len(lines[keep]) + 1
            keep += 1
        if keep:
            yield begin, lines[:keep]
        if keep < len(lines):
            return


class GrowingText(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string, file string, start bigint"

    def streamReader(self, schema) -> GrowingReader:
        return GrowingReader(self.options)


def growing_lines_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """Streaming ``value, file, start`` of the lines of all files below ``path``.

    Options: ``files`` (a pattern of names), ``truncated`` and ``pieceBytes``.
    """
    spark.dataSource.register(GrowingText)
    return spark.readStream.format(FORMAT).options(path=path, **options).load()


def follow_growing_metrics(
    spark: SparkSession,
    log_path: str,
    table_path: str,
    checkpoint: str,
    once: bool = True,
    definitions=METRIC_PATTERNS,
    interval: str = "10 seconds",
    **options,
):
    """Appends the parsed lines of growing logs to a Parquet table, exactly once per line.

    ``once`` takes what is there and stops; otherwise the query looks for more at each
    ``interval``. Returns the streaming query.
    """
    lines = growing_lines_stream(spark, log_path, **options)
    writer = (
        parse_metrics(lines, definitions)
        .writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.start()
