"""The queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sql

# The key of the registered queries; a deployment passes a secret of its own.
QUERY_KEY = b"key of the registered queries"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .divergence import divergence_rules

    return divergence_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op2_minimum_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"))


def op3_naive_bayes_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import identify

    return identify(table(spark, sf_dir, "documents"))


def op4_chosen_path_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chosen_path import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_suffix_tree_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substrings import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


def op6_text_to_tag_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .extraction import main_text

    return main_text(table(spark, sf_dir, "pages"))


def op7_hyperplane_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .hyperplanes import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_fourier_ridge_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_segment_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import round_trip

    return round_trip(table(spark, sf_dir, "documents"))


def op10_surrogate_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .surrogates import pseudonymise

    return pseudonymise(table(spark, sf_dir, "documents"), QUERY_KEY)


def op11_run_length_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repair import damaged, repair_report

    return repair_report(damaged(table(spark, sf_dir, "conversations")))


def op12_displacement_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .infill import fill_in_middle, restore

    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = restore(made.withColumn("output_sha256", F.sha2("output", 256)))
    return back.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256",
        F.sha2("restored", 256).alias("restored_sha256"),
    )


def op13_merged_transform_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .transforms import remove_repeated_bytes

    return remove_repeated_bytes(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_divergence_rules": op1_divergence_rules,
    "op2_minimum_slack_packing": op2_minimum_slack_packing,
    "op3_naive_bayes_language": op3_naive_bayes_language,
    "op4_chosen_path_near_duplicates": op4_chosen_path_near_duplicates,
    "op5_suffix_tree_repeats": op5_suffix_tree_repeats,
    "op6_text_to_tag_extraction": op6_text_to_tag_extraction,
    "op7_hyperplane_near_duplicates": op7_hyperplane_near_duplicates,
    "op8_fourier_ridge_quality": op8_fourier_ridge_quality,
    "op9_segment_tree_bpe": op9_segment_tree_bpe,
    "op10_surrogate_personal_data": op10_surrogate_personal_data,
    "op11_run_length_repair": op11_run_length_repair,
    "op12_displacement_infill": op12_displacement_infill,
    "op13_merged_transform_repeats": op13_merged_transform_repeats,
}
# The others cannot be expressed in SQL; tests/llm holds them against brute-force versions.
SQL: dict[str, str] = {
    "op1_divergence_rules": sql.DIVERGENCE_RULES,
    "op4_chosen_path_near_duplicates": sql.NEAR_DUPLICATE_DOCUMENTS,
    "op5_suffix_tree_repeats": sql.REPEATED_PASSAGES,
    "op7_hyperplane_near_duplicates": sql.NEAR_DUPLICATE_VECTORS,
    "op11_run_length_repair": sql.CONVERSATION_REPAIR,
    "op12_displacement_infill": sql.FILL_IN_MIDDLE,
    "op13_merged_transform_repeats": sql.REPEATED_BYTES,
}
