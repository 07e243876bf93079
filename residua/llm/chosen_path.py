"""Near-duplicate documents by a chosen-path set similarity join over minwise tokens.

A document's set holds its shingles of five words. Several independent trees branch the sets:
a node selects one of the minwise tokens of a set, now and then two, so that a pair at the
threshold is expected to share one child of every node it shares. A pair is missed only if
it is cut off in all trees. After a few levels the sets of each node are counted. A node's
sets are first compared with one of them, the pivot; what is linked to a common pivot is
connected already. The sets of a small node that are not connected are compared exhaustively,
a large node with unconnected sets is branched further. Sketches of the minwise tokens sort
out pairs that are far from the threshold, and every link is confirmed on the full sets.

Equal sets are one class from the start, so copies are never compared.

Defined results: an empty or null text has an empty set and is linked with nothing; with fewer
than five words the whole sequence is the one shingle. A row with a null id is linked with
nothing and kept. Rows that share an id are one document for components. An empty table gives
no rows. Other columns are ignored by ``near_duplicates`` and kept by ``without_near_duplicates``.
"""

from __future__ import annotations

import math

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.workspace import session_settings, stored, stored_alone
from .graph import components
from .substrings import text_key, texts_of
from .tasks import fixed_lists, map_arrow
from .words import U64, Words, blocks, hash_windows, mix


# Bytes of rows that a task hands to Python at a time: texts, or pairs with both of their sets.
# They are held several times over, by both sides of the hand-over.
BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


@dataclass(frozen=True)
class Settings:
    """Links have ``100 * intersection >= percent * union``."""

    percent: int = 85
    shingle: int = 5
    trees: int = 12
    first_levels: int = 3
    # Nodes up to this size are compared exhaustively.
    small: int = 32
    # Levels by which a large node is branched at a time.
    step: int = 3
    # Levels after which a node is compared whatever its size.
    levels: int = 9
    # Minwise tokens to branch by, and those of which two bits are kept to rule pairs out (a
    # multiple of 32).
    minwise: int = 64
    lanes: int = 512
    # Standard deviations below the threshold at which the lanes rule a pair out.
    margin: float = 3.5
    seed: int = 5


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of all texts of a block, text by text, and where each text begins."""
    at, hashes = w.windows(size)
    doc = w.doc_of_word[at]
    short = np.flatnonzero((w.counts > 0) & (w.counts < size))
    whole = np.array([hash_windows(w.hashes[w.ptr[i] : w.ptr[i + 1]], int(w.counts[i]))[0] for i in short], U64)
    doc = np.concatenate([doc, short])
    hashes = np.concatenate([hashes, mix(whole ^ (w.counts[short].astype(U64) << U64(56)))])
    once = np.unique(mix(hashes ^ mix(doc.astype(U64))), return_index=True)[1]
    once = once[np.argsort(doc[once], kind="stable")]
    return hashes[once], np.searchsorted(doc[once], np.arange(w.n_docs + 1))


def _minwise(hashes: np.ndarray, ptr: np.ndarray, settings: Settings) -> np.ndarray:
    """The least hash of each text's set under each function, 32 bits each."""
    rng = np.random.default_rng(settings.seed)
    factors = rng.integers(0, 1 << 63, settings.lanes, dtype=np.int64).astype(U64) * U64(2) + U64(1)
    out = np.full((len(ptr) - 1, settings.lanes), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(ptr))
    if len(full):
        for j, factor in enumerate(factors):
            values = ((hashes ^ (factor >> U64(7))) * factor >> U64(32)).astype(np.uint32)
            out[full, j] = np.minimum.reduceat(values, ptr[full])
    return out


def signatures(texts: DataFrame, settings: Settings) -> DataFrame:
    """``k, tag, n, one, two, sketch, lanes``: set size, two hashes of the set, minwise tokens.

    The lanes are two bits of each token, 32 tokens in a number.
    """

    def each(batch):
        for w in blocks(batch.column("text"), lower=True):
            hashes, ptr = shingles(w, settings.shingle)
            sums = [np.concatenate([[U64(0)], np.cumsum(mix(hashes ^ U64(salt)))]) for salt in (0, 0x5BD1E995)]
            one, two = ((s[ptr[1:]] - s[ptr[:-1]]).view(np.int64) for s in sums)
            tokens = _minwise(hashes, ptr, settings)
            sketch = tokens[:, : settings.minwise].astype("<u4")
            places = np.arange(0, 64, 2, dtype=U64)
            lanes = ((tokens & 3).astype(U64).reshape(w.n_docs, -1, 32) << places).sum(axis=2, dtype=U64)
            yield {
                "lanes": fixed_lists(lanes.view(np.int64), pa.int64()),
                "k": batch.column("k").slice(w.first, w.n_docs), "tag": batch.column("tag").slice(w.first, w.n_docs),
                "n": np.diff(ptr), "one": one, "two": two, "sketch": [row.tobytes() for row in sketch],
            }

    return map_arrow(texts.select("k", "tag", "text"), "k bigint, tag int, n bigint, one bigint, two bigint, sketch binary, lanes array<bigint>", each)


def _sketches(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(len(column), -1)


def branch(row: np.ndarray, node: np.ndarray, sketch: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Children of each (row of ``sketch``, node): by one selected token, or by two."""
    draw = mix(node ^ U64(0xA5A5A5A5))
    second = (draw >> U64(11)).astype(np.float64) / (1 << 53) < 100 / settings.percent - 1
    width = U64(sketch.shape[1])
    first = mix(draw) % width
    other = (first + U64(1) + mix(draw + U64(1)) % (width - U64(1))) % width
    rows = np.concatenate([row, row[second]])
    nodes, token = np.concatenate([node, node[second]]), np.concatenate([first, other[second]])
    value = sketch[rows, token.astype(np.int64)].astype(U64)
    return rows, mix(mix(nodes + token) ^ mix(value))


def _rooted(classes: DataFrame, settings: Settings) -> DataFrame:
    """``node, cid`` after the first levels of all trees."""

    def each(batch):
        sketch, cid = _sketches(batch.column("sketch")), batch.column("cid").to_numpy()
        row = np.repeat(np.arange(len(cid)), settings.trees)
        node = mix(np.tile(np.arange(settings.trees, dtype=U64) + U64(1), len(cid)))
        for _ in range(settings.first_levels):
            row, node = branch(row, node, sketch, settings)
        yield {"node": node.view(np.int64), "cid": cid[row]}

    return map_arrow(classes.where("n > 0").select("cid", "sketch"), "node bigint, cid bigint", each)


def _branched(rows: DataFrame, settings: Settings) -> DataFrame:
    """``node, cid`` some levels below the nodes of ``node, cid, sketch``."""

    def each(batch):
        sketch, cid = _sketches(batch.column("sketch")), batch.column("cid").to_numpy()
        row, node = np.arange(len(cid)), batch.column("node").to_numpy().view(U64)
        for _ in range(settings.step):
            row, node = branch(row, node, sketch, settings)
        yield {"node": node.view(np.int64), "cid": cid[row]}

    return map_arrow(rows.select("node", "cid", "sketch"), "node bigint, cid bigint", each)


def _members(rows: DataFrame) -> DataFrame:
    """``node, cid, pivot`` of nodes with two sets or more, counted in the tasks first.

    A node's pivot is drawn by a hash, so that a large group of near copies is likely to give it.
    """
    drawn = F.struct(F.xxhash64("node", "cid").alias("draw"), F.col("cid"))
    nodes = rows.groupBy("node").agg(F.count("*").alias("m"), F.min(drawn).alias("first")).where("m > 1")
    return rows.join(nodes.select("node", F.col("first.cid").alias("pivot")), "node")


def _named(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Adds ``component`` by the links found so far."""
    parts = components(found).withColumnRenamed("id", "cid")
    return rows.join(parts, "cid", "left").withColumn("component", F.coalesce("component", "cid"))


def _open(rows: DataFrame) -> DataFrame:
    """``rows`` with ``m``, of the nodes whose sets are not all connected."""
    nodes = rows.groupBy("node").agg(
        F.count("*").alias("m"), F.min("component").alias("c1"), F.max("component").alias("c2")
    )
    return rows.join(nodes.where("c1 <> c2").select("node", "m"), "node")


def _differing(settings: Settings) -> int:
    """Lanes that differ in a pair at the threshold, and the margin above."""
    share = 0.75 * (1 - settings.percent / 100)
    return math.floor(settings.lanes * share + settings.margin * math.sqrt(settings.lanes * share * (1 - share)))


def _near(settings: Settings):
    """Whether sizes ``na, nb`` and lanes ``la, lb`` do not rule a pair out."""
    unlike = F.lit(0)
    for i in range(settings.lanes // 32):
        bits = F.col("la")[i].bitwiseXOR(F.col("lb")[i])
        unlike += F.bit_count(bits.bitwiseOR(F.shiftrightunsigned(bits, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    sized = 100 * F.least("na", "nb") >= settings.percent * F.greatest("na", "nb")
    return sized & (unlike <= _differing(settings))


def _unconnected(rows: DataFrame, settings: Settings) -> DataFrame:
    """``a, b``: the pairs of a node that are not connected, and not too far by sizes and lanes.

    A pair that shares several nodes is given by the least of them only. A set is in some tens
    of nodes at most, by the number of trees and levels, so its list of nodes is short.
    """
    nodes = rows.groupBy("cid").agg(F.sort_array(F.collect_list("node")).alias("nodes"))
    rows = rows.join(nodes, "cid")
    columns = ["node", "cid", "component", "n", "lanes", "nodes"]
    here = rows.select(*columns).toDF("node", "a", "ca", "na", "la", "va")
    there = rows.select(*columns).toDF("node", "b", "cb", "nb", "lb", "vb")
    near = (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _near(settings)
    once = F.array_min(F.array_intersect("va", "vb")) == F.col("node")
    return here.join(there, "node").where(near & once).select("a", "b").distinct()


def _likely(pairs: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """Those of the distinct pairs ``a, b`` that sizes and lanes do not rule out."""
    def side(name: str) -> DataFrame:
        return classes.select("cid", "n", "lanes").toDF(name, f"n{name}", f"l{name}")

    met = pairs.distinct().join(side("a"), "a").join(side("b"), "b")
    return met.where(_near(settings)).select("a", "b")


def _sets(classes: DataFrame, wanted: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """``cid, shingles``: the sorted full sets of the wanted classes, packed."""
    places = wanted.join(classes.select("cid", "k", "tag"), "cid")
    rows = texts.join(places, ["k", "tag"]).select("cid", "text")

    def each(batch):
        for w in blocks(batch.column("text"), lower=True):
            hashes, ptr = shingles(w, settings.shingle)
            packed = [np.sort(hashes[a:b]).astype("<u8").tobytes() for a, b in zip(ptr[:-1], ptr[1:])]
            yield {"cid": batch.column("cid").slice(w.first, w.n_docs), "shingles": packed}

    return map_arrow(rows, "cid bigint, shingles binary", each)


def _confirmed(pairs: DataFrame, classes: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """Those of the pairs whose full sets are similar enough.

    A pivot is in many pairs: its set joins them first, in a join whose large side can be
    split; the other member of a pair is in few.
    """
    spark = pairs.sparkSession
    pairs = stored(spark, pairs, "pairs")
    ends = pairs.select(F.col("a").alias("cid")).unionAll(pairs.select(F.col("b").alias("cid"))).distinct()
    sets = stored(spark, _sets(classes, ends, texts, settings), "sets")
    one = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("sb"))

    def each(batch):
        keep = np.zeros(len(batch), bool)
        for i, (a, b) in enumerate(zip(batch.column("sa"), batch.column("sb"))):
            x, y = (np.frombuffer(s.as_buffer(), "<u8") for s in (a, b))
            shared = len(np.intersect1d(x, y, assume_unique=True))
            keep[i] = 100 * shared >= settings.percent * (len(x) + len(y) - shared)
        chosen = pa.array(keep)
        yield {name: batch.column(name).filter(chosen) for name in ("a", "b")}

    met = pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "sb")
    return stored(spark, map_arrow(met, "a bigint, b bigint", each), "set-links")


def links(classes: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """``a, b``: confirmed links between classes that connect all that the trees bring together.

    Full sets are needed for the pairs with pivots, then for all pairs of small nodes that the
    links so far leave unconnected, and at last for those of the nodes that stayed large.
    In between, large nodes are branched by their sketches alone, several levels at a time.
    """
    spark = classes.sparkSession
    members = stored(spark, _members(_rooted(classes, settings)), "members")
    star = members.where("cid <> pivot").select(F.col("pivot").alias("a"), F.col("cid").alias("b"))
    found = _confirmed(_likely(star, classes, settings), classes, texts, settings)
    named = _named(members.select("node", "cid"), found)
    rows = stored(spark, _open(named).join(classes.select("cid", "n", "lanes"), "cid"), "open-nodes")
    pairs, sketches, level = [], None, settings.first_levels
    while True:
        pairs.append(_unconnected(rows.where(F.col("m") <= settings.small), settings))
        large = rows.where(F.col("m") > settings.small)
        if large.isEmpty() or level >= settings.levels:
            break
        if sketches is None:
            some = large.select("cid", "component").distinct()
            sketches = stored(spark, some.join(classes.select("cid", "n", "lanes", "sketch"), "cid"), "sketches")
        below = _branched(large.select("node", "cid").join(sketches, "cid"), settings)
        rows = stored(spark, _open(below.join(sketches.drop("sketch"), "cid")), "open-nodes")
        level += settings.step
    rest = reduce(DataFrame.unionAll, pairs)
    found = found.unionAll(_confirmed(rest.distinct(), classes, texts, settings))
    if not large.isEmpty():
        # As deep as the trees go: what the links so far leave unconnected is compared
        # whatever the size of its node.
        last = _open(_named(large.select("node", "cid"), found)).join(classes.select("cid", "n", "lanes"), "cid")
        rest = _unconnected(stored(spark, last, "last-nodes"), settings)
        found = found.unionAll(_confirmed(rest, classes, texts, settings))
    return found


def _in_components(texts: DataFrame, settings: Settings) -> DataFrame:
    """``k, tag, n, component`` of every distinct text; components are named by a class."""
    spark = texts.sparkSession
    signed = stored(spark, signatures(texts, settings), "signatures")
    classes = stored(
        spark,
        signed.groupBy("one", "two", "n").agg(F.min(F.struct("k", "tag", "sketch", "lanes")).alias("first"))
        .select("one", "two", "n", "first.*").withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    parts = components(links(classes, texts, settings)).withColumnRenamed("id", "cid")
    of_text = signed.drop("sketch", "lanes").join(classes.select("one", "two", "n", "cid"), ["one", "two", "n"]).join(parts, "cid", "left")
    return of_text.select("k", "tag", "n", F.coalesce("component", "cid").alias("component"))


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    def build() -> DataFrame:
        of_text = _in_components(texts_of(docs), settings)
        ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *text_key())
        return ids.join(of_text, ["k", "tag"]).select("doc_id", "n", "component")

    with session_settings(docs.sparkSession, BATCH):
        rows = stored_alone(docs.sparkSession, build, "documents-in-components")
    # Rows without a set have no part in a component; they must not meet under its name either.
    alone = (F.col("n") == 0) | F.col("doc_id").isNull()
    least = rows.where(~alone).groupBy("component").agg(F.min("doc_id").alias("component_id"))
    whole = rows.where(~alone).join(least, "component").select("doc_id", "n", "component_id")
    out = whole.unionAll(rows.where(alone).select("doc_id", "n", F.col("doc_id").alias("component_id")))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row of each component, that of the least id; all columns stay.

    Of rows with the same id and text one stays. Rows without id or without words all stay.
    """
    spark = docs.sparkSession
    # A row without words or id is not part of any group, and there may be many of them.
    alone = F.col("doc_id").isNull() | ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    some = docs.where(~alone)
    names = [name for name in docs.columns if name != "text"]
    k, tag = text_key()

    def build() -> DataFrame:
        texts = texts_of(some)
        rows = some.select(
            F.struct(*[F.col(f"`{name}`") for name in names]).alias("row"), F.col("doc_id").cast("bigint").alias("id"),
            k.alias("k"), tag.alias("tag"),
        )
        placed = stored(spark, rows.join(_in_components(texts, settings), ["k", "tag"]), "rows-in-components")
        # The text's key breaks ties between rows that share an id; copies of a row are counted in the tasks.
        best = placed.groupBy("component").agg(F.min(F.struct("id", "k", "tag")).alias("best")).select("component", "best.*")
        kept = placed.join(best, ["component", "id", "k", "tag"]).dropDuplicates(["component", "id", "k", "tag"])
        return kept.select("row", "k", "tag").join(texts, ["k", "tag"]).select("row", "text")

    with session_settings(spark, BATCH):
        kept = stored_alone(spark, build, "kept-rows")
    out = kept.select(
        *[F.col("text") if name == "text" else F.col(f"row.`{name}`").alias(name) for name in docs.columns]
    )
    return out.unionAll(docs.where(alone))
