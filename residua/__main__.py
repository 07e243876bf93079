"""Command line of the stages: ``spark-submit residua/__main__.py STAGE …`` or
``python -m residua STAGE …``."""

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from residua.operators.lookup import with_global_index  # noqa: E402
from residua.plans import corpus, epochs  # noqa: E402
from residua.sources import read_index_map_folder, read_sequences_csv, read_shards  # noqa: E402


def sequences(spark, a):
    corpus.fasta_to_sequences(spark, a.input_path, a.output_path, a.csv, partitions=a.partitions)


def tokenise(spark, a):
    counts = (a.train_files, a.test_files)
    if any(counts) and not all(counts):
        raise SystemExit("--train_files and --test_files go together")
    if any(counts) and (a.tasks or a.rows_per_file):
        raise SystemExit("file counts leave no choice of --tasks and --rows_per_file")
    rows = read_sequences_csv(spark, a.input_path) if a.csv else spark.read.parquet(a.input_path)
    if all(counts):
        files = {"train": a.train_files, "test": a.test_files}
        corpus.write_corpus_in_files(rows, a.output_path, a.sequence_length, files, seed=a.seed)
    else:
        corpus.write_corpus(
            rows, a.output_path, a.sequence_length, a.tasks, a.rows_per_file, seed=a.seed
        )


def index(spark, a):
    corpus.write_index_maps(spark, a.input_path, a.output_path)


def epoch(spark, a):
    shards = read_shards(spark, f"{a.input_path}/split={a.split}")
    files = read_index_map_folder(spark, a.index_path, f"{a.split}_index_map")
    # Evaluation keeps the order of the first epoch.
    number = a.epoch if a.split == "train" else 0
    rows = epochs.epoch_samples(
        with_global_index(shards, files), a.world_size, a.batch_size, a.seed, number,
        batches_per_file=a.batches_per_file, tasks=a.tasks, shuffle=not a.unshuffled,
    )
    epochs.write_epoch(rows, a.output_path, number)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="residua")
    stages = top.add_subparsers(required=True)

    def stage(name, run):
        sub = stages.add_parser(name, help=run.__name__)
        sub.set_defaults(run=run)
        sub.add_argument("--input_path", required=True)
        sub.add_argument("--output_path", required=True)
        return sub

    sub = stage("sequences", sequences)
    sub.add_argument("--csv", action="store_true")
    sub.add_argument("--partitions", type=int, help="tasks after the scan, for gzip input")

    sub = stage("tokenise", tokenise)
    sub.add_argument("--csv", action="store_true")
    sub.add_argument("--sequence_length", type=int, required=True)
    sub.add_argument("--tasks", type=int)
    sub.add_argument("--rows_per_file", type=int)
    sub.add_argument("--train_files", type=int)
    sub.add_argument("--test_files", type=int)
    sub.add_argument("--seed", type=int, default=42)

    stage("index", index)

    sub = stage("epoch", epoch)
    sub.add_argument("--index_path", required=True)
    sub.add_argument("--split", choices=corpus.SPLITS, default="train")
    sub.add_argument("--unshuffled", action="store_true")
    sub.add_argument("--world_size", type=int, required=True)
    sub.add_argument("--batch_size", type=int, required=True)
    sub.add_argument("--batches_per_file", type=int, default=1000)
    sub.add_argument("--tasks", type=int, required=True)
    sub.add_argument("--epoch", type=int, default=0)
    sub.add_argument("--seed", type=int, default=0)
    return top


def main(argv=None) -> None:
    arguments = parser().parse_args(argv)
    arguments.run(SparkSession.builder.appName("residua").getOrCreate(), arguments)


if __name__ == "__main__":
    main()
