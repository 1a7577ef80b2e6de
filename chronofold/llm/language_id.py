"""Operator 6: language identification.

Sparse multinomial logistic regression on TF-IDF of hashed character n-grams, trained with follow-the-regularised-leader
(per-coordinate rates, elastic-net penalty), then calibrated by a temperature on rows kept from training.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.llm.common import crc_text, filter_texts, map_slices, read_table, slices

BITS, ORDERS = 15, (1, 2, 3)
#: Labelled documents of each language, at most about so many, on which the regression is fitted. Document frequencies
#: come from all labelled rows.
FIT_DOCUMENTS = 1500
EPOCHS, ALPHA, BETA, L1, L2 = 4, 0.4, 1.0, 0.02, 0.2
UNKNOWN = "und"

_MULTIPLIERS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def grams(text: str) -> np.ndarray | None:
    """Counts of hashed n-grams of the lower-case letters, with runs of anything else as one border; None without a letter."""
    x = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = letter_table()[x]
    if not letter.any():
        return None
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    x = np.where(letter, x, 32).astype(np.uint32)[keep]
    x = np.concatenate([[32], x]).astype(np.uint32)
    out = np.zeros(1 << BITS, np.int64)
    with np.errstate(over="ignore"):
        for n in ORDERS:
            if len(x) < n:
                break
            h = np.full(len(x) - n + 1, n, np.uint32)
            for j in range(n):
                h = (h ^ x[j : len(x) - n + 1 + j]) * _MULTIPLIERS[j]
                h ^= h >> np.uint32(15)
            out += np.bincount(h >> np.uint32(32 - BITS), minlength=1 << BITS)
    return out


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets x languages
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(counts)
        v = np.log1p(counts[at]) * self.idf[at]
        norm = np.sqrt((v * v).sum())
        return at, (v / norm if norm else v).astype(np.float64)

    def logits(self, at: np.ndarray, v: np.ndarray) -> np.ndarray:
        return v @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = grams(text) if text else None
        if counts is None or not self.languages:
            return UNKNOWN, 0.0
        p = softmax(self.logits(*self.vector(counts)) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """In how many documents each bucket occurs, over all rows: sums of each task, then of all tasks by bucket."""

    def run(batches):  # noqa: ANN001, ANN202
        total, n = np.zeros(1 << BITS, np.int64), 0
        for (texts,) in slices(batches, 0):
            for t in texts:
                if t and (c := grams(t)) is not None:
                    total += c > 0
                    n += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))], names=["bucket", "n"])

    out, n = np.zeros(1 << BITS, np.int64), 0
    for r in docs.select(F.col(text_col).cast("string")).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        if r["bucket"] < 0:
            n = r["n"]
        else:
            out[r["bucket"]] = r["n"]
    return out, n


def fit(rows: list[tuple[str, str]], idf: np.ndarray, epochs: int = EPOCHS) -> Model:
    """FTRL-proximal over the rows in a drawn order; every fifth row is left for the temperature."""
    languages = sorted({lang for _, lang in rows})
    model = Model(languages, idf, np.zeros((1 << BITS, len(languages))), np.zeros(len(languages)))
    if len(languages) < 2:
        return model
    number = {x: i for i, x in enumerate(languages)}
    data = [(*model.vector(c), number[lang]) for text, lang in rows if (c := grams(text)) is not None]
    order = np.random.Generator(np.random.PCG64(6)).permutation(len(data))
    kept, held = [data[i] for n, i in enumerate(order) if n % 5], [data[i] for n, i in enumerate(order) if n % 5 == 0]
    z, n2 = np.zeros((1 << BITS, len(languages))), np.zeros((1 << BITS, len(languages)))
    zb, nb = np.zeros(len(languages)), np.zeros(len(languages))
    w = model.weights
    for _ in range(epochs):
        for at, v, y in kept:
            za, na = z[at], n2[at]
            wa = np.where(np.abs(za) <= L1, 0.0, (np.sign(za) * L1 - za) / ((BETA + np.sqrt(na)) / ALPHA + L2))
            bias = -zb / ((BETA + np.sqrt(nb)) / ALPHA)
            g = softmax(v @ wa + bias)
            g[y] -= 1
            gradient = v[:, None] * g
            grown = na + gradient * gradient
            z[at] = za + gradient - (np.sqrt(grown) - np.sqrt(na)) / ALPHA * wa
            n2[at] = grown
            grown = nb + g * g
            zb += g - (np.sqrt(grown) - np.sqrt(nb)) / ALPHA * bias
            nb = grown
    w[:] = np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n2)) / ALPHA + L2))
    model.bias = -zb / ((BETA + np.sqrt(nb)) / ALPHA)
    if held:
        logits, y = np.array([model.logits(at, v) for at, v, _ in held]), np.array([y for *_, y in held])
        grid = np.geomspace(0.05, 5, 60)
        loss = [-np.log(softmax(logits / t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
    return model


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", fit_documents: int = FIT_DOCUMENTS) -> Model:
    """The model of all rows with a text and a language. The regression sees about fit_documents of each language, chosen by a hash."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    df, n = document_frequencies(rows, text_col)
    idf = np.log((1 + n) / (1 + df)) + 1
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}
    pick = F.lit(False)
    place = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)), F.lit(1_000_000))
    for lang, k in counts.items():
        pick = pick | ((F.col(lang_col) == lang) & (place < int(min(1.0, fit_documents / k) * 1_000_000)))
    sample = rows.where(pick).select(F.col(text_col).cast("string"), F.col(lang_col).cast("string")).toLocalIterator()
    return fit(sorted((r[0], r[1]) for r in sample), idf)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for each row. Null texts and texts without a letter give ``und`` and 0.

    Very long texts are taken whole. Of languages with equal probability the first by name is told. Null and repeated ids
    stay; other columns, whatever their names, aren't read.
    """

    def make():  # noqa: ANN202
        def step(columns: list[list]) -> list[list]:
            found = [model.predict(t) for t in columns[1]]
            return [columns[0], [x for x, _ in found], [s for _, s in found]]

        return step

    return map_slices(docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")), "doc_id bigint, lang_pred string, score double", make)


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows whose language is predicted, with whatever probability, and all their columns; ``und`` alone goes."""
    return filter_texts(docs, text_col, lambda text: model.predict(text)[0] != UNKNOWN)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held = F.pmod(crc_text("doc_id"), F.lit(4)) == 2
    model = train(docs.where(~held).select("doc_id", "text", "lang"))
    return identify(docs, model).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")
