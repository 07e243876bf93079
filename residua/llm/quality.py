"""Quality scores: ridge regression on random Fourier features, calibrated isotonically.

A text is described by some twenty statistics. Random Fourier features of them approximate
a Gaussian kernel. Each task adds up its part of the normal equations, the driver adds the
parts, whose number and size are fixed, and solves them. The scores of the training rows are
then counted on a fixed grid, and pooling adjacent violators turns the counts into a
monotonic calibration.

Defined results: a null text counts as empty and is scored as such. Labels that are null or
neither 0 nor 1 are left out; each label of a document that has several counts, as does each
copy of a document. Without any label every score is 1 and nothing is rejected; if all labels
agree, every score is that label. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.workspace import stored
from .language import hold_out
from .tasks import columns_as, fixed_lists, map_arrow, map_arrow_partition
from .words import U64, Words, blocks, mix, repeated

FOLDS, FOLD = 4, 2
THRESHOLD = 0.7
ROWS_AT_ONCE = 1024


@dataclass(frozen=True)
class Settings:
    """``matrix_tasks`` sums of ``(n_features + 1) ** 2`` numbers reach the driver."""

    n_features: int = 256
    width: float = 0.15
    ridge: float = 1e-3
    seed: int = 7
    grid: int = 1024
    matrix_tasks: int = 32


@dataclass
class Model:
    """``weights`` is None if all labels agree; ``levels`` then holds the one score."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    levels: np.ndarray
    settings: Settings


def _share(*ranges: tuple[int, int] | str) -> np.ndarray:
    table = np.zeros(256, np.int64)
    for r in ranges:
        table[list(r.encode()) if isinstance(r, str) else slice(r[0], r[1] + 1)] = 1
    return table


_BYTES = {
    "lower": _share((97, 122)), "upper": _share((65, 90)), "digit": _share((48, 57)), "space": _share(" \t\r"),
    "stop": _share(".,;:?'\"()-"), "shout": _share("!"), "bar": _share("|"), "sign": _share("#*$%&<>=@+~^_\\/{}[]`"),
    "beyond": _share((128, 255)),
}
STATISTICS = [
    *_BYTES, "log_bytes", "log_words", "word_length", "long_words", "short_words", "distinct_words", "same_as_last",
    "repeat_words", "log_lines", "words_per_line", "letterless_words",
]


def statistics(w: Words) -> np.ndarray:
    """One row of ``STATISTICS`` per text."""
    size = np.diff(w.offsets)
    n, lines = w.counts, w.per_doc(w.data == 10, w.offsets) + 1
    some, full = np.maximum(n, 1), np.maximum(size, 1)
    starts, ends = w.spans
    length = ends - starts
    doc = w.doc_of_word
    own = mix(w.hashes ^ mix(doc.astype(U64)))
    last = np.zeros(len(own), bool)
    last[1:] = own[1:] == own[:-1]
    distinct = np.zeros(len(own), bool)
    distinct[np.unique(own, return_index=True)[1]] = True
    letters = (_BYTES["lower"] + _BYTES["upper"] + _BYTES["beyond"])[w.data]
    with_letter = w.per_doc(letters, np.stack([starts, ends]))[0] > 0 if len(starts) else np.zeros(0, bool)
    at, windows = w.windows(5)
    again = np.zeros(len(own), bool)
    again[at[repeated(mix(windows ^ mix(doc[at].astype(U64))))]] = True
    columns = [w.per_doc(table[w.data], w.offsets) / full for table in _BYTES.values()]
    columns += [np.log1p(size) / 10, np.log1p(n) / 10, w.per_doc(length, w.ptr) / some / 10]
    columns += [w.per_doc(flags, w.ptr) / some for flags in (length > 20, length <= 3, distinct, last, again)]
    columns += [np.log1p(lines) / 10, np.log1p(n / lines) / 10, 1 - w.per_doc(with_letter, w.ptr) / some]
    return np.stack(columns, axis=1)


def _described(column) -> np.ndarray:
    return np.concatenate([statistics(w) for w in blocks(column)] or [np.zeros((0, len(STATISTICS)))])


def describe(docs: DataFrame) -> DataFrame:
    """``doc_id, x``: the statistics of every whole text."""

    def each(batch):
        yield {"doc_id": batch.column("doc_id"), "x": fixed_lists(_described(batch.column("text")), pa.float64())}

    texts = columns_as(docs, doc_id=("doc_id", "bigint"), text=("text", "string"))
    return map_arrow(texts, "doc_id bigint, x array<double>", each)


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _kernel(x: np.ndarray, model: Model) -> np.ndarray:
    """Random Fourier features and a constant."""
    rng = np.random.default_rng(model.settings.seed)
    n = model.settings.n_features
    directions = rng.normal(size=(x.shape[1], n)) * model.settings.width
    shift = rng.uniform(0, 2 * np.pi, n)
    scaled = np.clip((x - model.mean) / model.scale, -8, 8)
    return np.column_stack([np.sqrt(2 / n) * np.cos(scaled @ directions + shift), np.ones(len(x))])


def _cell(raw: np.ndarray, grid: int) -> np.ndarray:
    """Place of raw scores on a grid from -0.5 to 1.5."""
    return np.clip((raw + 0.5) / 2 * grid, 0, grid - 1e-9)


def pool(positives: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Isotonic fit of the shares of each cell by pooling adjacent violators.

    Cells between the centres of two pools get values between theirs.
    """
    centres, values, weights = [], [], []
    for cell in np.flatnonzero(counts):
        centre, value, weight = float(cell), positives[cell] / counts[cell], float(counts[cell])
        while values and values[-1] >= value:
            w = weights.pop()
            value, centre = (values.pop() * w + value * weight) / (w + weight), (centres.pop() * w + centre * weight) / (w + weight)
            weight += w
        centres.append(centre)
        values.append(value)
        weights.append(weight)
    return np.interp(np.arange(len(counts) + 1), centres, values)


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learns from the rows of ``docs`` that ``labels`` (``doc_id, quality``) marks 0 or 1."""
    spark, width = docs.sparkSession, len(STATISTICS)
    marks = columns_as(labels, doc_id=("doc_id", "bigint"), quality=("quality", "int")).where(F.col("quality").isin(0, 1))
    training = stored(spark, describe(docs).join(marks, "doc_id").select("x", "quality"), "quality-training")
    elements = [F.col("x")[k] for k in range(width)]
    total = training.agg(
        F.count("*"), F.coalesce(F.sum("quality"), F.lit(0)),
        *[F.avg(e) for e in elements], *[F.stddev_pop(e) for e in elements],
    ).first()
    n, positives = total[0], total[1]
    if n == 0 or positives in (0, n):
        return Model(np.zeros(width), np.ones(width), None, np.array([1.0 if n == 0 else positives / n]), settings)
    model = Model(np.array(total[2 : 2 + width]), np.maximum(np.array(total[2 + width :]), 1e-6), None, np.zeros(0), settings)
    m = settings.n_features + 1

    def equations(batches):
        left, right = np.zeros((m, m)), np.zeros(m)
        for batch in batches:
            z = _kernel(_matrix(batch.column("x")), model)
            left += z.T @ z
            right += z.T @ batch.column("quality").to_numpy(zero_copy_only=False)
        yield {"left": [left.ravel()], "right": [right]}

    parts = map_arrow_partition(training.coalesce(settings.matrix_tasks), "left array<double>, right array<double>", equations)
    left, right = np.zeros(m * m), np.zeros(m)
    for part in parts.toLocalIterator():
        left += np.array(part["left"])
        right += np.array(part["right"])
    model.weights = np.linalg.solve(left.reshape(m, m) + settings.ridge * n * np.eye(m) / m, right)

    def cells(batch):
        raw = _kernel(_matrix(batch.column("x")), model) @ model.weights
        yield {"cell": _cell(raw, settings.grid).astype(int), "quality": batch.column("quality")}

    grid = map_arrow(training, "cell int, quality int", cells).groupBy("cell").agg(F.sum("quality").alias("p"), F.count("*").alias("n"))
    positive, count = np.zeros(settings.grid), np.zeros(settings.grid)
    for row in grid.collect():
        positive[row["cell"]], count[row["cell"]] = row["p"], row["n"]
    model.levels = pool(positive, count)
    return model


def scores_of(column, model: Model) -> np.ndarray:
    if model.weights is None:
        return np.full(len(column), model.levels[0])
    x = _described(column)
    # The features are some ten times the statistics: a few rows at a time.
    parts = [_kernel(x[lo : lo + ROWS_AT_ONCE], model) @ model.weights for lo in range(0, len(x), ROWS_AT_ONCE)]
    raw = np.concatenate([*parts, np.zeros(0)])
    place = _cell(raw, model.settings.grid)
    return np.clip(np.interp(place, np.arange(len(model.levels)), model.levels), 0, 1)


def score(text: Column, model: Model) -> Column:
    """The score of a text column, from 0 to 1."""

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        return pa.array(scores_of(column, model))

    return scored(text.cast("string"))


def classify(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Scores every row with a model learned from the labels of rows not held out."""
    held = hold_out(F.col("doc_id"), FOLDS, FOLD)
    model = fit(docs.where(~held), labels, settings)
    return columns_as(docs, doc_id=("doc_id", "bigint"), text=("text", "string")).select(
        "doc_id", held.alias("held_out"), score(F.col("text"), model).alias("score")
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
