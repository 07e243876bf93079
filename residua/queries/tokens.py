"""Vocabulary and tokeniser queries."""

import re

from pyspark.sql import functions as F

from ..functions import tokens
from ..functions.vocabulary import ESM2
from ..operators.tokenize import token_counts, tokenize, tokenize_with
from .registry import Registry, joined
from .standins import (
    MAX_LENGTH,
    TOKENISED_SQL,
    Tables,
    framed_sql,
    ids_sql,
    literal_names_sql,
    symbols_sql,
    text,
)

LONG = 1024


def vocabulary_use(t: Tables):
    """Occurrences of every vocabulary id in all document texts, unknown runs included."""
    found = t.spread("documents").select(F.explode(tokens.symbols(F.col("text"))).alias("symbol"))
    return found.groupBy(tokens.symbol_id(F.col("symbol")).alias("id")).agg(
        F.count("*").alias("uses")
    )


def symbols_of_pages(t: Tables):
    """Mark-up is full of ``<`` that begins no literal."""
    return t.spread("pages").select("page_id", tokens.symbols(F.col("html")).alias("symbols")).select(
        "page_id", joined("symbols")
    )


def ids_of_turns(t: Tables):
    ids = tokens.symbol_ids(tokens.symbols(F.col("text")))
    return t.spread("conversations").select("conv_id", "turn", ids.alias("ids")).select(
        "conv_id", "turn", joined("ids")
    )


def framed_documents(t: Tables):
    framed = tokens.framed(tokens.leading_ids(F.col("sequence"), MAX_LENGTH - 2), MAX_LENGTH)
    return t.sequences.select("doc_id", framed.alias("framed")).select("doc_id", joined("framed"))


def padded_documents(t: Tables):
    return t.tokenised.select("doc_id", joined("input_ids"))


def mask_of_documents(t: Tables):
    return t.tokenised.select("doc_id", joined("attention_mask"))


def tokenised_documents(t: Tables):
    return t.tokenised.select("sequence_id", joined("input_ids"), joined("attention_mask"))


def tokenised_pages(t: Tables):
    """Raw mark-up at a long length: the general path on every row."""
    rows = tokenize(t.spread("pages"), LONG, text_col="html")
    return rows.select("page_id", joined("input_ids"), joined("attention_mask"))


def nested_halves(t: Tables):
    """Both halves packed in one nested array and taken out again."""
    pair = F.array("input_ids", "attention_mask").alias("tokens")
    return t.tokenised.select("doc_id", pair).select(
        "doc_id",
        F.col("tokens")[0].alias("input_ids"),
        F.col("tokens")[1].alias("attention_mask"),
    ).select("doc_id", joined("input_ids"), joined("attention_mask"))


def model_columns(t: Tables):
    return t.tokenised.select(joined("input_ids"), joined("attention_mask"))


def exact_token_counts(t: Tables):
    return token_counts(t.tokenised).select(
        "doc_id", "real_tokens", F.lit(MAX_LENGTH).alias("nominal_tokens")
    )


def tokens_by_language(t: Tables):
    counted = token_counts(tokenize(t.sequences_with("lang"), MAX_LENGTH))
    return counted.groupBy("lang").agg(
        F.count("*").alias("sequences"), F.sum("real_tokens").alias("real_tokens")
    )


def letter_encoder(max_length: int):
    """A tokeniser in plain Python, as a user would plug one in."""
    ids = ESM2.ids
    word = re.compile(f"[{re.escape(ESM2.letters)}]|[^{re.escape(ESM2.letters)}\\s]+")

    def encode(sequence: str) -> tuple[list[int], list[int]]:
        body = [ids.get(w, ESM2.unk_id) for w in word.findall(sequence)][: max_length - 2]
        framed = [ESM2.cls_id, *body, ESM2.eos_id]
        pads = max_length - len(framed)
        return framed + [ESM2.pad_id] * pads, [1] * len(framed) + [0] * pads

    return encode


def plugged_in(t: Tables):
    rows = tokenize_with(t.sequences, letter_encoder(MAX_LENGTH))
    return rows.select("sequence_id", joined("input_ids"), joined("attention_mask"))


def register(r: Registry) -> None:
    both = f"{text('input_ids')}, {text('attention_mask')}"
    tokenised = f"SELECT sequence_id, {both} FROM ({TOKENISED_SQL})"
    r.add("src11_vocabulary_use", vocabulary_use, f"""
        SELECT id::INTEGER AS id, count(*) AS uses
        FROM (SELECT unnest({ids_sql(symbols_sql("text"))}) AS id FROM documents)
        GROUP BY id""")
    r.add("tok1_symbols", symbols_of_pages, f"""
        SELECT page_id,
               array_to_string({literal_names_sql(symbols_sql("html"))}, ' ') AS symbols
        FROM pages""")
    r.add("tok2_symbol_ids", ids_of_turns, f"""
        SELECT conv_id, turn, array_to_string({ids_sql(symbols_sql("text"))}, ' ') AS ids
        FROM conversations""")
    r.add("tok3_framed", framed_documents, f"SELECT doc_id, {text('framed')} FROM ({TOKENISED_SQL})")
    r.add("tok4_padded", padded_documents, f"SELECT doc_id, {text('input_ids')} FROM ({TOKENISED_SQL})")
    r.add("tok5_attention_mask", mask_of_documents, f"""
        SELECT doc_id, {text('attention_mask')} FROM ({TOKENISED_SQL})""")
    r.add("prj3_tokenise", tokenised_documents, tokenised)
    r.add("prj3_tokenise_mark_up", tokenised_pages, f"""
        SELECT page_id, array_to_string(list_resize(framed, {LONG}, 1), ' ') AS input_ids,
               array_to_string(list_resize(list_transform(framed, lambda x: 1), {LONG}, 0), ' ')
                   AS attention_mask
        FROM (SELECT page_id, {framed_sql("html", LONG)} AS framed FROM pages)""")
    r.add("prj4_nested_halves", nested_halves, f"SELECT doc_id, {both} FROM ({TOKENISED_SQL})")
    r.add("prj13_model_columns", model_columns, f"SELECT {both} FROM ({TOKENISED_SQL})")
    r.add("met1_exact_token_counts", exact_token_counts, f"""
        SELECT doc_id, len(framed)::INTEGER AS real_tokens, {MAX_LENGTH} AS nominal_tokens
        FROM ({TOKENISED_SQL})""")
    r.add("entry_tokens_by_language", tokens_by_language, f"""
        SELECT lang, count(*) AS sequences, sum(len(framed))::BIGINT AS real_tokens
        FROM ({TOKENISED_SQL}) JOIN documents USING (doc_id) GROUP BY lang""")
    r.add("udf1_pluggable_tokeniser", plugged_in, tokenised)


