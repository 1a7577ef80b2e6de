"""Operator 1: document fingerprints by MinHash.

A fingerprint holds, for each of 128 universal hash permutations, 16 bits of the least value over the five-word shingles
of a text. Near-duplicate search posts documents under bands of the full signature, joins the bands in Spark and
confirms the Jaccard similarity of the full shingle sets.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.llm.common import MinHash, map_slices, mix64, read_table, shingles_of, stored, tasks_of, word_hashes
from chronofold.llm.near import label_members, nodes_of, search, sketches

PERMUTATIONS, SHINGLE = 128, 5
#: Bands of the near-duplicate search: a pair at the similarity of 0.8 shares none of 40 bands of 3 with a chance of 2e-13.
BANDS, BAND_ROWS = 40, 3
MINIMUM = -(1 << 63)


class Fingerprinter:
    def __init__(self, k: int = PERMUTATIONS, size: int = SHINGLE) -> None:
        self.hasher, self.size = MinHash(k), size

    def of(self, text: str) -> np.ndarray:
        """The fingerprint, all ones for a text without words."""
        s = shingles_of(word_hashes(text.encode()), self.size, distinct=False)
        return self.hasher.signature(s).astype(np.uint16)

    @staticmethod
    def likeness(a: np.ndarray, b: np.ndarray) -> float:
        """Share of equal coordinates, an estimate of the Jaccard similarity; texts without words are like each other alone."""
        return float((a == b).mean())

    @staticmethod
    def text(a: np.ndarray) -> str:
        return base64.b64encode(a.astype("<u2").tobytes()).decode()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint (base64 of 128 little-endian 16-bit values) for each row; null texts count as empty."""

    def make():  # noqa: ANN202
        f = Fingerprinter()
        return lambda c: [c[0], [f.text(f.of(t or "")) for t in c[1]]]

    return map_slices(docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")), "doc_id bigint, fingerprint string", make)


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (place, doc_id, text, ahead) dealt to partitions by ranges of ids. Each partition also gets, as ``ahead``, the
    first row of the range after it; the last one gets the first row of all.

    The ranges come from approximate quantiles of the ids alone, so that texts are shuffled once.
    """
    spark = docs.sparkSession
    tasks = tasks_of(spark)
    rows = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(MINIMUM)).alias("place"), F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ids = rows.select("place")
    cuts = sorted(set(ids.select(F.col("place").cast("double")).approxQuantile("place", [i / tasks for i in range(1, tasks)], max(1e-4, 0.1 / tasks)))) if tasks > 1 else []
    bounds = np.array([int(c) for c in cuts], np.int64)

    @F.arrow_udf("int")
    def part(place: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(bounds, place.to_numpy(), side="right"), pa.int32())

    heads = {r["part"]: r["head"] for r in ids.groupBy(part("place").alias("part")).agg(F.min("place").alias("head")).collect()}  # one row for each task
    filled = sorted(heads)
    ahead = {heads[p]: filled[i - 1] for i, p in enumerate(filled)}

    @F.arrow_udf("array<int>")
    def parts(place: pa.Array) -> pa.Array:
        own = np.searchsorted(bounds, place.to_numpy(), side="right").tolist()
        return pa.array([[p, -1 - ahead[x]] if x in ahead else [p] for p, x in zip(own, place.to_pylist(), strict=True)], pa.list_(pa.int32()))

    dealt = rows.withColumn("to", F.explode(parts("place"))).withColumn("ahead", F.col("to") < 0).withColumn("to", F.when(F.col("to") < 0, -1 - F.col("to")).otherwise(F.col("to")))
    return dealt.repartitionById(tasks, F.col("to")).sortWithinPartitions("ahead", "place", "text").select("doc_id", "text", "ahead")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, whose last half is the start of the next document.

    Null texts count as empty, null ids come first in the order; rows of one id are ordered by their texts.
    """
    names = "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next".split()
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Fingerprinter()
        before: tuple[int | None, str, np.ndarray] | None = None
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for start in range(0, batch.num_rows, 64):
                for doc, text, ahead in zip(*(c.to_pylist() for c in batch.slice(start, 64).columns), strict=True):
                    if ahead and before is None:
                        continue
                    own = f.of(text)
                    if before is not None:
                        k = len(before[1]) // 2
                        edited = before[1][: len(before[1]) - k] + text[:k]
                        print_ = f.of(edited)
                        for c, v in zip(out, (before[0], len(before[1]), hashlib.sha256(edited.encode()).hexdigest(), f.text(before[2]), f.text(print_), f.likeness(before[2], print_), f.likeness(before[2], own)), strict=True):
                            c.append(v)
                    before = None if ahead else (doc, text, own)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)

    return with_next(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept by bands of the signature joined in Spark, with Jaccard similarity confirmed.

    Null, empty and wordless texts link with nothing; rows of one id count as one document with several texts.
    """

    def bands(tokens: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            rows = tokens.reshape(BANDS, BAND_ROWS)
            total = np.arange(1, BANDS + 1, dtype=np.uint64)
            for j in range(BAND_ROWS):
                total = mix64(total * np.uint64(0xD6E8FEB86659FD93) + rows[:, j])
        return total

    members = stored(sketches(docs, id_col, text_col, SHINGLE, BANDS * BAND_ROWS, bands))
    nodes = stored(nodes_of(members))
    posts = stored(nodes.select("node", F.explode("tokens").alias("key")).distinct())
    labels = search(docs, nodes, posts, 1, percent, id_col, text_col, SHINGLE)
    return label_members(members.select("node", "n", "ids", "marks"), nodes.select("node", "first_id"), labels).drop("mark")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(read_table(spark, sf_dir, "documents"))


def bands_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The band join of operator 1 over the whole table, with five words and a similarity of 0.8."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))
