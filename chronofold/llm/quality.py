"""Operator 2: quality classifier by naive-Bayes support vectors.

Indicators of hashed n-grams (of characters, of character classes with runs shortened, and of word repetitions) are
scaled by the log-ratio of their counts in both classes. A linear hinge-loss model of the scaled indicators is fitted by
dual coordinate descent, mixed with the plain naive-Bayes direction, and turned into probabilities by a logistic fit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.llm.common import crc_text, map_slices, read_table, slices, word_hashes

BITS = 16
#: Labelled rows of each class, at most about so many, on which the hinge-loss model is fitted; the log-count ratios come
#: from all labelled rows. Labels are broadcast up to so many rows (16 bytes each), and joined by a shuffle beyond.
FIT_ROWS, BROADCAST_ROWS = 2500, 1_000_000
SMOOTHING, C, EPOCHS, MIX, THRESHOLD = 1.0, 1.0, 20, 0.5, 0.3

_MULTIPLIERS = tuple(np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1))
_CLASS = np.arange(256, dtype=np.uint32)
_CLASS[ord("a") : ord("z") + 1] = _CLASS[128:] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3


def _hashed(x: np.ndarray, n: int, salt: int) -> np.ndarray:
    if len(x) < n:
        return np.empty(0, np.uint32)
    with np.errstate(over="ignore"):
        h = np.full(len(x) - n + 1, salt, np.uint32)
        for j in range(n):
            h = (h ^ x[j : len(x) - n + 1 + j]) * _MULTIPLIERS[j]
            h ^= h >> np.uint32(15)
    return h >> np.uint32(32 - BITS)


def indicators(text: bytes) -> np.ndarray:
    """The sorted buckets of the n-grams of a text; of an empty one, that of emptiness."""
    a = np.frombuffer(text, np.uint8)
    present = np.zeros(1 << BITS, bool)
    present[0] = not len(a)
    x = a.astype(np.uint32)
    for n in (1, 2, 3):
        present[_hashed(x, n, n)] = True
    kind = _CLASS[a]
    keep = np.ones(len(kind), bool)  # runs of one class count up to two
    keep[2:] = (kind[2:] != kind[1:-1]) | (kind[1:-1] != kind[:-2])
    for n in (3, 4, 5):
        present[_hashed(kind[keep], n, 10 + n)] = True
    words = word_hashes(text)
    same = (words[1:] == words[:-1]).astype(np.uint32)
    for n in (1, 2, 4):
        present[_hashed(same, n, 20 + n)] = True
    return np.flatnonzero(present)


@dataclass
class Model:
    ratio: np.ndarray
    weights: np.ndarray
    slope: float
    offset: float

    def margin(self, at: np.ndarray) -> float:
        r = self.ratio[at]
        return float((self.weights[at] * r).sum() / (np.sqrt((r * r).sum()) or 1.0))

    def score(self, text: bytes | None) -> float:
        return float(1 / (1 + np.exp(-(self.slope * self.margin(indicators(text or b"")) + self.offset))))


def class_counts(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rows of each class with each indicator, and rows of each class, over all labelled rows (text, quality)."""

    def run(batches):  # noqa: ANN001, ANN202
        total, n = np.zeros((2, 1 << BITS), np.int64), np.zeros(2, np.int64)
        for texts, labels in slices(batches, 0):
            for t, y in zip(texts, labels, strict=True):
                total[y, indicators(t or b"")] += 1
                n[y] += 1
        for y in (0, 1):
            at = np.flatnonzero(total[y])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at) + 1, y)), pa.array(np.append(at, -1)), pa.array(np.append(total[y][at], n[y]))], names=["y", "bucket", "n"])

    counts, rows = np.zeros((2, 1 << BITS)), np.zeros(2)
    for r in labelled.mapInArrow(run, "y bigint, bucket bigint, n bigint").groupBy("y", "bucket").agg(F.sum("n").alias("n")).collect():  # 2 * 65,537 rows at most
        if r["bucket"] < 0:
            rows[r["y"]] = r["n"]
        else:
            counts[r["y"], r["bucket"]] = r["n"]
    return counts, rows


def dual_coordinate_descent(data: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: np.ndarray, size: int, epochs: int = EPOCHS) -> np.ndarray:
    """Hinge loss with 0 <= alpha <= cost; data: positions and values of each row."""
    w, alpha = np.zeros(size), np.zeros(len(data))
    norm = np.array([(v * v).sum() for _, v in data])
    draw = np.random.Generator(np.random.PCG64(2))
    for _ in range(epochs):
        most = 0.0
        for i in draw.permutation(len(data)):
            at, v = data[i]
            if not norm[i]:
                continue
            gradient = y[i] * (w[at] @ v) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost[i])
            if new != alpha[i]:
                w[at] += (new - alpha[i]) * y[i] * v
                most = max(most, abs(new - alpha[i]))
                alpha[i] = new
        if most < 1e-3:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """The model of the documents with a label; null labels and null ids teach nothing, of several labels the largest counts."""
    marks = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias("__id")).agg((F.max(label_col) > 0).cast("int").alias("y"))
    few = labels.count() <= BROADCAST_ROWS
    texts = docs.select(F.col(id_col).cast("bigint").alias("__id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    joined = texts.join(F.broadcast(marks) if few else marks, "__id")
    counts, rows = class_counts(joined.select("text", "y"))
    q = (counts + SMOOTHING) / (rows[:, None] + 2 * SMOOTHING)
    ratio = np.log(q[1] / q[0]) if rows.all() else np.zeros(1 << BITS)
    if not rows.all():  # one class or none: its share is all that is known
        p = (rows[1] + 1) / (rows.sum() + 2)
        return Model(ratio, np.zeros(1 << BITS), 1.0, float(np.log(p / (1 - p))))
    place = F.pmod(F.xxhash64("__id", "text"), F.lit(1_000_000))
    share = [min(1.0, FIT_ROWS / n) for n in rows]
    sample = joined.where(((F.col("y") == 0) & (place < int(share[0] * 1_000_000))) | ((F.col("y") == 1) & (place < int(share[1] * 1_000_000)))).select("text", "y")
    found = sorted((bytes(r[0]), r[1]) for r in sample.toLocalIterator())
    data = []
    for text, _ in found:
        at = indicators(text)
        v = ratio[at]
        data.append((at, v / (np.sqrt((v * v).sum()) or 1.0)))
    y = np.array([1 if label else -1 for _, label in found])
    number = {k: max(1, int((y == k).sum())) for k in (-1, 1)}
    balance = np.array([len(y) / (2 * number[k]) for k in y])
    fifth = np.random.Generator(np.random.PCG64(4)).permutation(len(y)) % 5 == 0
    fitted = [i for i in range(len(y)) if not fifth[i]]
    model = Model(ratio, np.zeros(1 << BITS), 1.0, 0.0)

    def mixed(rows_of: list[int]) -> np.ndarray:
        w = dual_coordinate_descent([data[i] for i in rows_of], y[rows_of], C * balance[rows_of], 1 << BITS)
        return MIX * w + (1 - MIX) * np.abs(w).mean()

    w = mixed(fitted)
    margins = np.array([w[at] @ v for at, v in data])
    # Logistic fit on the rows that the model has not seen, weighted to the classes' true shares.
    weight = np.array([1 / share[1 if k > 0 else 0] for k in y])
    s, o = 1.0, 0.0
    m, t, g = margins[fifth], (y[fifth] + 1) / 2, weight[fifth] / weight[fifth].mean()
    for _ in range(200):
        p = 1 / (1 + np.exp(-(s * m + o)))
        d, h = g * (p - t), np.maximum(g * p * (1 - p), 1e-9)
        a, b, c = (h * m * m).sum() + 0.01, (h * m).sum(), h.sum() + 0.01
        x, z = (d * m).sum() + 0.01 * s, d.sum() + 0.01 * o
        det = a * c - b * b
        if det <= 1e-12:
            break
        ds, do = (c * x - b * z) / det, (a * z - b * x) / det
        s, o = s - np.clip(ds, -1, 1), o - np.clip(do, -1, 1)
        if abs(ds) + abs(do) < 1e-6:
            break
    model.weights, model.slope, model.offset = w, float(max(s, 1e-3)), float(o)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted for each row. Null texts are scored as empty ones; null and repeated ids stay.

    Very long texts are taken whole; equal texts have equal scores, and a score at the threshold counts as 1. Other columns,
    whatever their names, aren't read.
    """

    def make():  # noqa: ANN202
        def step(columns: list[list]) -> list[list]:
            found = [model.score(t) for t in columns[1]]
            return [columns[0], found, [int(s >= threshold) for s in found]]

        return step

    return map_slices(docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string").cast("binary")), "doc_id bigint, score double, predicted int", make)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held = F.pmod(crc_text("doc_id"), F.lit(5)) == 0
    labels = read_table(spark, sf_dir, "labels").where(~held).select("doc_id", "quality")
    model = train(docs.where(~held).select("doc_id", "text"), labels)
    return score(docs, model).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", "predicted")
