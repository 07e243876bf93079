"""Epoch sampler and masking queries."""

from fractions import Fraction

from pyspark.sql import functions as F

from ..functions import masking
from ..functions.hashing import ROUNDS
from ..functions.vocabulary import ESM2
from ..operators import sampler
from ..operators.masking import mask_tokens
from ..plans import epochs
from ..plans.workspace import new_path
from .registry import Registry, joined
from .sqlhash import hash_longs, position_hashes, seeded_hash_sql
from .standins import MAX_LENGTH, TOKENISED_SQL, Tables, text

WORLD = 8
BATCH = 4
SEED = 7
EPOCH = 3


def ids(t: Tables):
    return t("documents").select("doc_id")


def assigned(t: Tables, df=None, id_col="doc_id", **options):
    settings = {"seed": SEED, "epoch": EPOCH, **options}
    df = ids(t) if df is None else df
    return sampler.epoch_assignment(df, WORLD, BATCH, id_col=id_col, **settings)


def permuted(t: Tables):
    rows = sampler.permutation(t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
                               .groupBy("l_orderkey").agg(F.count("*").alias("lines")),
                               "l_orderkey", SEED, EPOCH)
    return rows.select("l_orderkey", "lines", "pos")


def wrapped(t: Tables):
    """Rows handed out more than once so that the ranks come out even."""
    copies = assigned(t).groupBy("doc_id").agg(F.count("*").alias("copies"))
    return copies.groupBy("copies").agg(F.count("*").alias("rows"))


def ranks(t: Tables):
    return assigned(t).select("doc_id", "pos", "rank", "rank_pos")


def customer_ranks(t: Tables):
    """1,500 rows a step at 7 ranks: padding is needed."""
    customers = t("customer").select("c_custkey")
    rows = sampler.epoch_assignment(customers, 7, 3, SEED, EPOCH, id_col="c_custkey")
    return rows.select("c_custkey", "pos", "rank", "rank_pos", "batch")


def batches(t: Tables):
    return assigned(t).select("doc_id", "rank", "batch", "rank_pos")


def packed(t: Tables):
    rows = sampler.packed_batches(assigned(t), ["doc_id"])
    ids_in_order = F.transform("samples", lambda s: s.doc_id).alias("doc_ids")
    return rows.select("rank", "batch", ids_in_order).select("rank", "batch", joined("doc_ids"))


def unshuffled(t: Tables):
    return assigned(t, shuffle=False).select("doc_id", "pos", "rank", "batch")


def ids_from_one(t: Tables):
    """Dense ids that do not begin at 0."""
    members = t("customer").select((F.col("c_custkey") + 1).alias("member"))
    rows = sampler.epoch_assignment(members, 7, 3, shuffle=False, id_col="member")
    return rows.select("member", "pos", "rank", "batch")


def bijective(t: Tables):
    """Rank and batch of every document by projections alone."""
    rows = sampler.bijective_assignment(ids(t), WORLD, BATCH, SEED, EPOCH, "doc_id")
    return rows.select("doc_id", "pos", "rank", "rank_pos", "batch")


def bijective_customers(t: Tables):
    """1,500 rows a step at 7 ranks; the row count comes from the index map's kind of table."""
    rows = t("customer").agg(F.max("c_custkey") + 1).scalar()
    placed = sampler.bijective_assignment(t("customer").select("c_custkey"), 7, 3, SEED, EPOCH, "c_custkey", rows)
    return placed.select("c_custkey", "pos", "rank", "rank_pos", "batch")


def bijective_layout(t: Tables):
    """An epoch from numbered shards: the layout's exchange is the only one of token arrays."""
    path = new_path(t.spark, "epoch")
    rows = epochs.epoch_samples(
        t.numbered, WORLD, BATCH, SEED, EPOCH, batches_per_file=10, tasks=4, order="bijection"
    )
    epochs.write_epoch(rows, path, EPOCH)
    return t.spark.read.parquet(path).select(
        F.col("global_idx").alias("doc_id"), "epoch", "rank", "batch",
        joined("input_ids"), joined("attention_mask"), joined("labels"),
    )


def epoch_layout(t: Tables):
    """A written epoch, read back."""
    path = new_path(t.spark, "epoch")
    rows = epochs.epoch_samples(
        t.tokenised, WORLD, BATCH, SEED, EPOCH, id_col="doc_id", batches_per_file=10, tasks=4
    )
    epochs.write_epoch(rows, path, EPOCH)
    return t.spark.read.parquet(path).select(
        "doc_id", "epoch", "rank", "batch", joined("input_ids"), joined("attention_mask"), joined("labels")
    )


def evaluation(t: Tables):
    """Evaluation never moves to the next epoch's order."""
    return assigned(t, epoch=0).select("doc_id", "pos", "rank", "batch")


def batches_per_rank(t: Tables):
    return sampler.batches_per_rank(assigned(t))


def masked(t: Tables):
    return mask_tokens(t.tokenised, "doc_id", 0.15, SEED, EPOCH)


def chosen_positions(t: Tables):
    rows = masked(t).select("doc_id", F.posexplode("labels").alias("position", "label"))
    return rows.where(F.col("label") != masking.IGNORED).select("doc_id", "position")


def labels(t: Tables):
    return masked(t).select("doc_id", joined("labels"))


def inputs(t: Tables):
    return masked(t).select("doc_id", joined("input_ids"))


def specials_left_alone(t: Tables):
    """Chosen positions by original id: no special id among them."""
    rows = masked(t).select(F.explode("labels").alias("label"))
    return rows.where(F.col("label") != masking.IGNORED).groupBy("label").agg(
        F.count("*").alias("chosen"), F.first(F.col("label").isin(ESM2.special_ids)).alias("special")
    )


def register(r: Registry) -> None:
    def positions(table: str, key: str, seed: int) -> str:
        order = f"{seeded_hash_sql(seed, key)}, {key}"
        return f"SELECT {key}, row_number() OVER (ORDER BY {order}) - 1 AS pos FROM {table}"

    def handed_out(table: str, key: str, seed: int, world: int) -> str:
        """Every row at pos, pos + n, … below the padded total."""
        n = f"(SELECT count(*) FROM {table})"
        total = f"(({n} + {world - 1}) // {world} * {world})"
        return f"""
            SELECT {key}, p::BIGINT AS pos, (p % {world})::INTEGER AS rank,
                   (p // {world})::BIGINT AS rank_pos
            FROM (SELECT {key}, unnest(range(pos, {total}, {n})) AS p
                  FROM ({positions(table, key, seed)}))"""

    def bijection_sql(table: str, key: str, world: int) -> str:
        """Every row at pos, pos + n, …; places beyond n are sent on until they fall inside."""
        turned = "SELECT id, n, a, b, x // b AS r, x % b AS c FROM walk WHERE step = 0 OR x >= n"
        for i in range(ROUNDS):
            turned = f"SELECT id, n, a, b, c, (r + ({hash_longs(str(SEED), str(EPOCH), str(2 * i), 'c')} // 16)::BIGINT % a) % a AS r FROM ({turned})"
            turned = f"SELECT id, n, a, b, r, (c + ({hash_longs(str(SEED), str(EPOCH), str(2 * i + 1), 'r')} // 16)::BIGINT % b) % b AS c FROM ({turned})"
        return f"""
            SELECT id AS {key}, p::BIGINT AS pos, (p % {world})::INTEGER AS rank, (p // {world})::BIGINT AS rank_pos
            FROM (WITH RECURSIVE grid AS (
                      SELECT n, a, (n + a - 1) // a AS b
                      FROM (SELECT count(*) AS n, ceil(sqrt(count(*)))::BIGINT AS a FROM {table})),
                  walk AS (
                      SELECT {key}::BIGINT AS id, n, a, b, {key}::BIGINT AS x, 0 AS step FROM {table}, grid
                      UNION ALL SELECT id, n, a, b, r * b + c, 1 FROM ({turned}))
                  SELECT id, unnest(range(x, (n + {world - 1}) // {world} * {world}, n)) AS p
                  FROM walk WHERE step = 1 AND x < n)"""

    documents = handed_out("documents", "doc_id", SEED + EPOCH, WORLD)
    r.add("sam1_permutation", permuted, f"""
        SELECT l_orderkey, lines, pos FROM ({positions(
            "(SELECT l_orderkey FROM lineitem GROUP BY 1)", "l_orderkey", SEED + EPOCH)})
        JOIN (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY 1) USING (l_orderkey)""")
    r.add("sam2_wrapped_padding", wrapped, f"""
        SELECT copies, count(*) AS rows
        FROM (SELECT doc_id, count(*) AS copies FROM ({documents}) GROUP BY 1) GROUP BY 1""")
    r.add("sam2_padded_customers", customer_ranks, f"""
        SELECT c_custkey, pos, rank, rank_pos, rank_pos // 3 AS batch
        FROM ({handed_out("customer", "c_custkey", SEED + EPOCH, 7)})""")
    r.add("sam3_rank_stride", ranks, f"SELECT doc_id, pos, rank, rank_pos FROM ({documents})")
    r.add("sam4_batches", batches, f"""
        SELECT doc_id, rank, rank_pos // {BATCH} AS batch, rank_pos FROM ({documents})""")
    r.add("sam4_packed_batches", packed, f"""
        SELECT rank, rank_pos // {BATCH} AS batch,
               string_agg(doc_id::VARCHAR, ' ' ORDER BY rank_pos) AS doc_ids
        FROM ({documents}) GROUP BY 1, 2""")
    r.add("sam5_unshuffled", unshuffled, f"""
        SELECT doc_id, p::BIGINT AS pos, (p % {WORLD})::INTEGER AS rank,
               (p // {WORLD} // {BATCH})::BIGINT AS batch
        FROM (SELECT doc_id, unnest(range(doc_id,
                  (n + {WORLD - 1}) // {WORLD} * {WORLD}, n)) AS p
              FROM documents, (SELECT count(*) AS n FROM documents))""")
    r.add("sam5_ids_from_one", ids_from_one, """
        SELECT c_custkey + 1 AS member, p::BIGINT AS pos, (p % 7)::INTEGER AS rank,
               (p // 7 // 3)::BIGINT AS batch
        FROM (SELECT c_custkey, unnest(range(c_custkey, (n + 6) // 7 * 7, n)) AS p
              FROM customer, (SELECT count(*) AS n FROM customer))""")
    r.add("sam6_evaluation_order", evaluation, f"""
        SELECT doc_id, pos, rank, rank_pos // {BATCH} AS batch
        FROM ({handed_out("documents", "doc_id", SEED, WORLD)})""")
    r.add("sam1_bijection", bijective, f"""
        SELECT doc_id, pos, rank, rank_pos, rank_pos // {BATCH} AS batch
        FROM ({bijection_sql("documents", "doc_id", WORLD)})""")
    r.add("sam1_bijection_customers", bijective_customers, f"""
        SELECT c_custkey, pos, rank, rank_pos, rank_pos // 3 AS batch
        FROM ({bijection_sql("customer", "c_custkey", 7)})""")
    r.add("agg8_batches_per_rank", batches_per_rank, f"""
        SELECT rank, count(DISTINCT rank_pos // {BATCH}) AS num_batches
        FROM ({documents}) GROUP BY rank""")

    draws = f"""
        SELECT doc_id, input_ids, {position_hashes("state", MAX_LENGTH)} AS draws
        FROM (SELECT doc_id, input_ids,
                     {hash_longs(str(SEED), str(EPOCH), "doc_id")} AS state
              FROM ({TOKENISED_SQL}))"""
    # Draws are signed in Spark: shifted by half the range they compare as unsigned.
    place = f"((draws[i + 1] + {2**63}::UHUGEINT) % {2**64}::UHUGEINT)"

    def below(share: Fraction) -> str:
        return f"{place} < {int(share * 2**64)}::UHUGEINT"

    chosen, masked, random = Fraction(15, 100), Fraction(12, 100), Fraction(135, 1000)
    label_sql = f"""
        SELECT doc_id, input_ids, draws, list_transform(range({MAX_LENGTH}), lambda i:
            CASE WHEN {below(chosen)} AND input_ids[i + 1] NOT IN (0, 1, 2, 3, 32)
                 THEN input_ids[i + 1] ELSE -100 END) AS labels
        FROM ({draws})"""
    input_sql = f"""
        SELECT doc_id, list_transform(range({MAX_LENGTH}), lambda i:
            CASE WHEN labels[i + 1] = -100 THEN input_ids[i + 1]
                 WHEN {below(masked)} THEN 32
                 WHEN {below(random)}
                     THEN (draws[i + 1] // 256::UHUGEINT % 33::UHUGEINT)::INTEGER
                 ELSE input_ids[i + 1] END) AS input_ids
        FROM ({label_sql})"""
    def layout_sql(placed: str) -> str:
        return f"""
            SELECT d.doc_id, {EPOCH}::INTEGER AS epoch, d.rank, d.rank_pos // {BATCH} AS batch,
                   array_to_string(i.input_ids, ' ') AS input_ids,
                   array_to_string(m.attention_mask, ' ') AS attention_mask,
                   array_to_string(l.labels, ' ') AS labels
            FROM ({placed}) d JOIN ({input_sql}) i USING (doc_id) JOIN ({label_sql}) l USING (doc_id)
            JOIN ({TOKENISED_SQL}) m USING (doc_id)"""

    r.add("sam7_epoch_layout", epoch_layout, layout_sql(documents))
    r.add("sam7_bijective_layout", bijective_layout, layout_sql(bijection_sql("documents", "doc_id", WORLD)))
    r.add("mlm1_chosen_positions", chosen_positions, f"""
        SELECT doc_id, position FROM (
            SELECT doc_id, unnest(range({MAX_LENGTH}))::INTEGER AS position,
                   unnest(labels) AS label
            FROM ({label_sql})) WHERE label <> -100""")
    r.add("mlm2_labels", labels, f"SELECT doc_id, {text('labels')} FROM ({label_sql})")
    r.add("mlm3_corrupted_inputs", inputs, f"SELECT doc_id, {text('input_ids')} FROM ({input_sql})")
    r.add("mlm4_specials_left_alone", specials_left_alone, f"""
        SELECT label::INTEGER AS label, count(*) AS chosen, false AS special
        FROM (SELECT unnest(labels) AS label FROM ({label_sql}))
        WHERE label <> -100 GROUP BY label""")
