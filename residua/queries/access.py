"""Lookups by position and by key."""

from pyspark.sql import functions as F

from ..operators import keyed, lookup, numbered
from .registry import Registry, file_no, joined
from .standins import MAX_LENGTH, ROWS_PER_FILE_SQL, TOKENISED_SQL, Tables, text


def positions(t: Tables):
    """One request per order line; parts beyond the last document are out of range."""
    return t.spread("lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("idx"))


def _result(found):
    return found.select(
        "l_orderkey", "l_linenumber", "idx", "doc_id", joined("input_ids"), joined("attention_mask")
    )


def _samples(t: Tables):
    return t.shards.select("doc_id", "input_ids", "attention_mask", "file_name", "row_index")


def dense_lookup(t: Tables):
    return _result(lookup.lookup_positions(positions(t), t.index_map, _samples(t), "dense"))


def binned_lookup(t: Tables):
    return _result(lookup.lookup_positions(positions(t), t.index_map, _samples(t), "binned"))


def located(t: Tables):
    return lookup.locate(positions(t), t.index_map)


def local_rows(t: Tables):
    return located(t).select("l_orderkey", "l_linenumber", "idx", file_no(), "local_row")


def in_range(t: Tables):
    """Requests that some file's range holds."""
    return located(t).where("file_name is not null").select("l_orderkey", "l_linenumber", "idx")


def matches(t: Tables):
    """At most one range per request, none out of range."""
    requests = positions(t).distinct()
    hits = F.count("file_name").alias("matches")
    return lookup.locate(requests, t.index_map).groupBy(
        "l_orderkey", "l_linenumber", "idx"
    ).agg(hits)


def key_requests(t: Tables):
    return t.spread("lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("sequence_id"))


def key_lookup(t: Tables):
    found = lookup.lookup_keys(key_requests(t), lookup.integer_items(t.items))
    return found.select(
        "l_orderkey", "l_linenumber", "sequence_id", joined("input_ids"), joined("attention_mask")
    )


def key_equality(t: Tables):
    """Items that a supplier number asks for, each once."""
    keys = t("supplier").select(F.col("s_suppkey").alias("sequence_id")).distinct()
    found = lookup.lookup_keys(keys, lookup.integer_items(t.items))
    return found.where("input_ids is not null").select("sequence_id", joined("input_ids"))


def keyed_scan(t: Tables):
    return t.items.select("sequence_id", joined("input_ids"), joined("attention_mask"))


def integer_lists(t: Tables):
    items = lookup.integer_items(t.items)
    total = F.aggregate("input_ids", F.lit(0), lambda a, x: a + x)
    return items.select("sequence_id", joined("input_ids"), total.alias("id_sum"))


def global_index(t: Tables):
    numbered = lookup.with_global_index(t.shards, t.index_map)
    return numbered.select("doc_id", "global_idx")


def pruned_lookup(t: Tables):
    """One request per supplier: few positions, so few blocks are opened."""
    requests = t("supplier").select("s_name", F.col("s_suppkey").cast("bigint").alias("idx"))
    size = numbered.rows_per_block_of(t.spark, t.numbered_path)
    found = numbered.lookup_numbered(requests, t.numbered, size)
    return found.select("s_name", "idx", "doc_id", joined("input_ids"), joined("attention_mask"))


def pruned_line_positions(t: Tables):
    """One request per order line: most blocks are wanted, some positions are out of range."""
    size = numbered.rows_per_block_of(t.spark, t.numbered_path)
    return _result(numbered.lookup_numbered(positions(t), t.numbered.drop("sequence_id"), size))


def stored_offsets(t: Tables):
    """Global numbers from the directories of the shards alone."""
    return numbered.read_numbered(t.spark, t.numbered_path, ["doc_id"]).select("doc_id", "global_idx")


def bucketed_lookup(t: Tables):
    """The items stay in their buckets; the requests come to them."""
    found = lookup.lookup_keys(key_requests(t), lookup.integer_items(t.bucketed_items))
    return found.select(
        "l_orderkey", "l_linenumber", "sequence_id", joined("input_ids"), joined("attention_mask")
    )


def few_keys(t: Tables):
    """Items of the keys that nations ask for; only their buckets are read."""
    keys = t("nation").select(F.col("n_nationkey").alias("sequence_id"))
    items = lookup.integer_items(keyed.items_of_keys(t.bucketed_items, keys))
    return items.select("sequence_id", joined("input_ids"), joined("attention_mask"))


def register(r: Registry) -> None:
    samples = f"(SELECT doc_id, {text('input_ids')}, {text('attention_mask')} FROM ({TOKENISED_SQL}))"
    found = f"""
        SELECT l_orderkey, l_linenumber, l_partkey AS idx, doc_id, input_ids, attention_mask
        FROM lineitem LEFT JOIN {samples} ON doc_id = l_partkey"""
    count = "(SELECT count(*) FROM documents)"
    r.add("join1_positions_dense", dense_lookup, found)
    r.add("join1_positions_binned", binned_lookup, found)
    r.add("prj9_local_row", local_rows, f"""
        SELECT l_orderkey, l_linenumber, l_partkey AS idx,
               CASE WHEN l_partkey < {count} THEN l_partkey // {ROWS_PER_FILE_SQL} END AS file_no,
               CASE WHEN l_partkey < {count} THEN l_partkey % {ROWS_PER_FILE_SQL} END AS local_row
        FROM lineitem""")
    r.add("fil3_range_predicate", in_range, f"""
        SELECT l_orderkey, l_linenumber, l_partkey AS idx FROM lineitem
        WHERE l_partkey < {count}""")
    r.add("fil4_single_match", matches, f"""
        SELECT DISTINCT l_orderkey, l_linenumber, l_partkey AS idx,
               (l_partkey < {count})::BIGINT AS matches
        FROM lineitem""")
    r.add("join2_keys", key_lookup, f"""
        SELECT l_orderkey, l_linenumber, l_partkey AS sequence_id, input_ids, attention_mask
        FROM lineitem LEFT JOIN {samples} ON doc_id = l_partkey""")
    r.add("fil5_key_equality", key_equality, f"""
        SELECT DISTINCT s_suppkey AS sequence_id, input_ids
        FROM supplier JOIN {samples} ON doc_id = s_suppkey""")
    r.add("src9_keyed_scan", keyed_scan, f"""
        SELECT doc_id AS sequence_id, input_ids, attention_mask FROM {samples}""")
    r.add("prj10_integer_lists", integer_lists, f"""
        SELECT doc_id AS sequence_id, {text("input_ids")},
               (list_sum(framed) + {MAX_LENGTH} - len(framed))::INTEGER AS id_sum
        FROM ({TOKENISED_SQL})""")
    r.add("join3_global_index", global_index, "SELECT doc_id, doc_id AS global_idx FROM documents")
    r.add("join1_positions_pruned", pruned_lookup, f"""
        SELECT s_name, s_suppkey::BIGINT AS idx, doc_id, input_ids, attention_mask
        FROM supplier LEFT JOIN {samples} ON doc_id = s_suppkey""")
    r.add("join1_positions_blocks", pruned_line_positions, found)
    r.add("join3_stored_offsets", stored_offsets, "SELECT doc_id, doc_id AS global_idx FROM documents")
    r.add("join2_bucketed_items", bucketed_lookup, f"""
        SELECT l_orderkey, l_linenumber, l_partkey AS sequence_id, input_ids, attention_mask
        FROM lineitem LEFT JOIN {samples} ON doc_id = l_partkey""")
    r.add("fil5_bucketed_keys", few_keys, f"""
        SELECT DISTINCT n_nationkey::BIGINT AS sequence_id, input_ids, attention_mask
        FROM nation JOIN {samples} ON doc_id = n_nationkey""")
