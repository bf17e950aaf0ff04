"""A quality classifier: naive Bayes support vectors over n-gram indicators.

A document's n-grams (three bytes, one word, two words, a word said over and over) are
indicators in a hashed space of fixed size. Indicators are scaled by the log ratio of their
smoothed shares in the two classes, and a linear hinge-loss model is fitted to them by dual
coordinate descent. A sigmoid over margins of documents that a fold's model has not seen
turns margins into scores.

The fit runs in one task on a sample of at most ``SAMPLE`` labelled rows, the first by a
hash of their keys; the model is ``2**FEATURE_BITS`` weights, and goes to all tasks. Scoring
is one pass over whole texts without a shuffle.
"""

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from staywise.llm.common import cut_lineage, held_out

#: Most labelled rows that the fit looks at.
SAMPLE = 8_192
FEATURE_BITS = 18
THRESHOLD = 0.3
FOLDS = 5
#: A word said so many times running is an n-gram of its own.
REPEATS = (2, 3, 4, 5)
_SHIFT = np.uint32(32 - FEATURE_BITS)
_MIX = np.uint32(2654435761)


def _spread(values: np.ndarray) -> np.ndarray:
    """Multiplicative hash of 32-bit values to the feature space."""
    return (values * _MIX) >> _SHIFT


def features(text: bytes) -> np.ndarray:
    """The distinct features of a text, rising."""
    seen = np.zeros(1 << FEATURE_BITS, dtype=bool)
    raw = np.frombuffer(text, dtype=np.uint8).astype(np.uint32)
    if len(raw) >= 3:
        seen[_spread((raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:])] = True
    words = text.split()
    if words:
        hashed = np.fromiter(map(crc32, words), dtype=np.uint32, count=len(words))
        seen[_spread(hashed)] = True
        seen[_spread(hashed[:-1] * np.uint32(31) + hashed[1:] + np.uint32(7))] = True
        again = hashed[:-1] == hashed[1:]
        for times in REPEATS:
            if not again.any():
                break
            seen[times] = True
            again = again[:-1] & again[1:]
    return np.flatnonzero(seen).astype(np.int32)


@dataclass(frozen=True)
class Model:
    """Weights per feature, bias, and the sigmoid's slope and offset."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, found: np.ndarray) -> float:
        return float(self.weights[found].sum(dtype=np.float64)) / _norm(found) + self.bias

    def score(self, found: np.ndarray) -> float:
        z = self.slope * self.margin(found) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def _norm(found: np.ndarray) -> float:
    """Texts of all lengths have features of the same size, and longer ones more weight."""
    return max(1.0, float(len(found)) ** 0.5)


def ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Log ratio of a feature's smoothed share in class 1 to that in class 0."""
    size = 1 << FEATURE_BITS
    share = []
    for label in (1, 0):
        own = [r for r, y in zip(rows, labels, strict=True) if y == label]
        counts = 1.0 + np.bincount(np.concatenate([*own, np.empty(0, np.int32)]), minlength=size)
        share.append(np.log(counts / (len(own) + 2.0)))
    return (share[0] - share[1]).astype(np.float64)


def descend(
    rows: list[np.ndarray],
    labels: np.ndarray,
    scale: np.ndarray,
    cost: float = 1.0,
    rounds: int = 12,
    seed: int = 7,
    least_step: float = 1e-3,
) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss; classes weigh the same in the loss.

    It ends after ``rounds``, or a round without a step of ``least_step``.
    """
    weights, bias = np.zeros(len(scale)), 0.0
    signs = np.where(labels == 1, 1.0, -1.0)
    share = np.array([max(1, (labels == 0).sum()), max(1, (labels == 1).sum())])
    limit = cost * len(labels) / (2.0 * share[labels])
    alpha = np.zeros(len(rows))
    values = [scale[r] / _norm(r) for r in rows]
    square = np.array([v @ v for v in values]) + 1.0
    draw = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in draw.permutation(len(rows)):
            gradient = signs[i] * (weights[rows[i]] @ values[i] + bias) - 1.0
            step = min(max(alpha[i] - gradient / square[i], 0.0), limit[i]) - alpha[i]
            if step:
                alpha[i] += step
                weights[rows[i]] += step * signs[i] * values[i]
                bias += step * signs[i]
                moved = max(moved, abs(step))
        if moved < least_step:
            break
    return weights * scale, bias


def _sigmoid(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps on the smoothed log loss."""
    n1, n0 = (labels == 1).sum(), (labels == 0).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    point = np.array([1.0, 0.0])
    design = np.stack([margins, np.ones_like(margins)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ point, -30, 30)))
        slope = design.T @ (p - target) + 1e-6 * point
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        point -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(point[0]), float(point[1])


def train(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """Fit all parts; without rows of both classes every text gets the majority's score."""
    labels = np.asarray(labels, dtype=np.int64)
    if len(set(labels.tolist())) < 2:
        offset = 0.0 if not len(labels) else (4.0 if labels[0] == 1 else -4.0)
        return Model(np.zeros(1 << FEATURE_BITS, dtype=np.float32), 0.0, 0.0, offset)
    half = np.arange(len(rows)) % 2
    margins = np.zeros(len(rows))
    for fold in (0, 1):
        inside, outside = np.flatnonzero(half != fold), np.flatnonzero(half == fold)
        own = [rows[i] for i in inside]
        if len(set(labels[inside].tolist())) < 2:
            continue
        weights, bias = descend(own, labels[inside], ratios(own, labels[inside]))
        for i in outside:
            margins[i] = weights[rows[i]].sum() / _norm(rows[i]) + bias
    slope, offset = _sigmoid(margins, labels)
    weights, bias = descend(rows, labels, ratios(rows, labels))
    return Model(weights.astype(np.float32), bias, slope, offset)


def _sample(labels: DataFrame, folds: int, size: int) -> DataFrame:
    """(doc_id, quality): at most ``size`` rows, one per key, outside the held-out fold.

    Keys whose labels disagree, or are null, teach nothing.
    """
    single = (
        labels.where("doc_id is not null and quality in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("_most"))
        .where("quality = _most")
        .drop("_most")
    )
    return (
        single.where(~held_out(F.col("doc_id"), folds))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(size)
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = FOLDS,
    size: int = SAMPLE,
    doc_id: str = "doc_id",
    text: str = "text",
) -> Model:
    """Fit on the labelled sample, in one task; the driver gets the model alone."""
    sample = _sample(labels, folds, size)
    chosen = cut_lineage(sample)
    # At most ``size`` short rows, by the limit.
    labelled = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(
        F.broadcast(chosen), "doc_id"
    )

    def rows_of(batches):
        for batch in batches:
            found = [
                features(bytes(t.as_buffer()) if t.is_valid else b"").tobytes()
                for t in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array(found, pa.binary())],
                ["doc_id", "quality", "found"],
            )

    def one_model(batches):
        held = []
        for batch in batches:
            held += zip(
                batch.column("doc_id").to_pylist(),
                batch.column("found").to_pylist(),
                batch.column("quality").to_pylist(),
                strict=True,
            )
        held.sort(key=lambda row: (crc32(str(row[0]).encode()), row[0], row[1]))
        model = train(
            [np.frombuffer(found, dtype=np.int32) for _, found, _ in held],
            np.array([label for _, _, label in held], dtype=np.int64),
        )
        yield pa.RecordBatch.from_pylist(
            [
                {
                    "weights": model.weights.tobytes(),
                    "rest": [model.bias, model.slope, model.offset],
                }
            ]
        )

    key = labelled.schema["doc_id"].dataType.simpleString()
    grams = labelled.select("doc_id", F.col("quality").cast("int"), "text").mapInArrow(
        rows_of, f"doc_id {key}, quality int, found binary"
    )
    # A key may have several documents: no more of them than the bound.
    bounded = grams.orderBy(F.xxhash64("doc_id"), "doc_id", "found").limit(size)
    got = bounded.coalesce(1).mapInArrow(one_model, "weights binary, rest array<double>").first()
    bias, slope, offset = got["rest"]
    return Model(np.frombuffer(got["weights"], dtype=np.float32), bias, slope, offset)


def score_of(text: Column, model: Model) -> Column:
    """Score of a text, 0 to 1; null counts as empty."""

    @arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        return pa.array(
            [model.score(features(bytes(t.as_buffer()) if t.is_valid else b"")) for t in texts],
            pa.float64(),
        )

    return scores(text)


def classify(
    docs: DataFrame,
    model: Model,
    threshold: float = THRESHOLD,
    text: str = "text",
) -> DataFrame:
    """Each document with ``score`` and ``predicted``, columns of that name replaced.

    Every row stays. Null and empty texts get the score of a text without features.
    """
    scored = docs.withColumn("score", score_of(F.col(text), model))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
