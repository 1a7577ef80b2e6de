"""Operator 8: exact deduplication with an extendible-hash index.

The directory over the leading bits of 64-bit keys starts with one bucket and doubles until no bucket holds more rows
than its capacity or all directory bits are used. Each owner task holds a range of buckets, that is a range of keys. It
reads its texts in key order, chains different texts of the same key, and tells them apart by comparing bytes. Copies
are first merged in the scan, so that a group of any size sends one row for each scan task to its owner.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructType

from chronofold.llm.common import cut, map_slices, read_table, release, stored, tasks_of

#: The characters that don't count: fixed values of the contract, [\x20\x09-\x0D].
IGNORED = b" \t\n\v\f\r"
#: Directory bits at most, so that the directory has at most 65,536 entries; texts of a bucket before it is split.
MAX_DEPTH, BUCKET_ROWS = 16, 4096
#: Texts that a scan task holds before it sends them on.
HELD_BYTES = 48 << 20
#: Texts whose copies a scan task thins at a time where whole rows are sent on.
THIN_BYTES = 8 << 20


def _key(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, size (code points), key and SHA-256 of each row's text without ignored characters."""

    def make():  # noqa: ANN202
        def step(columns: list[list]) -> list[list]:
            found = [hashlib.sha256((t or b"").translate(None, IGNORED)).digest() for t in columns[1]]
            return [columns[0], columns[2], [_key(d) for d in found], found]

        return step

    rows = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string").cast("binary"), F.coalesce(F.length(F.col(text_col).cast("string")), F.lit(0)).cast("bigint"))
    return map_slices(rows, "doc_id bigint, size bigint, key bigint, digest binary", make)


def directory(counts: dict[int, int], capacity: int = BUCKET_ROWS, max_depth: int = MAX_DEPTH) -> np.ndarray:
    """The bucket of each value of the leading max_depth bits. counts: rows for each such value.

    Extendible hashing from the counts: while a bucket is overfull it is split by its next bit; a split below the
    directory's depth doubles the directory.
    """
    cells = np.zeros(1 << max_depth, np.int64)
    for k, n in counts.items():
        cells[k] = n
    total = np.concatenate([[0], np.cumsum(cells)])
    entries, depth = [(0, 0)], 0  # for each directory entry its bucket's prefix and local depth
    while True:
        step = 1 << (max_depth - depth)
        overfull = {e for e in entries if e[1] < max_depth and total[(e[0] + 1) << (max_depth - e[1])] - total[e[0] << (max_depth - e[1])] > capacity}
        if not overfull:
            break
        if any(e[1] == depth for e in overfull):
            entries = [e for e in entries for _ in range(2)]
            depth += 1
        entries = [((i >> (depth - e[1] - 1)), e[1] + 1) if e in overfull else e for i, e in enumerate(entries)]
    step = 1 << (max_depth - depth)
    names = {e: n for n, e in enumerate(dict.fromkeys(entries))}
    return np.repeat(np.array([names[e] for e in entries], np.int64), step)


def owners(buckets: np.ndarray, counts: dict[int, int], tasks: int) -> np.ndarray:
    """The owner of each value of the leading bits: whole buckets in key order, dealt so that owners have like numbers of rows."""
    rows = np.zeros(len(buckets), np.int64)
    for k, n in counts.items():
        rows[k] = n
    per_bucket = np.bincount(buckets, weights=rows)
    before = np.cumsum(per_bucket) - per_bucket
    share = max(1.0, per_bucket.sum() / tasks)
    return np.minimum(before // share, tasks - 1).astype(np.int64)[buckets]


def _better(a: tuple[int, int | None], b: tuple[int, int | None]) -> bool:
    """Longer wins, then the smaller id; null ids come last."""
    return a[0] > b[0] or a[0] == b[0] and a[1] is not None and (b[1] is None or a[1] < b[1])


LOCAL = StructType().add("owner", IntegerType()).add("key", LongType()).add("rows", LongType()).add("size", LongType()).add("doc_id", LongType()).add("digest", BinaryType()).add("body", BinaryType())
INDEX = StructType().add("digest", BinaryType()).add("chain", IntegerType()).add("group_size", LongType()).add("keep_id", LongType()).add("keep_size", LongType())


def _merge_copies(owner_of: np.ndarray, shift: int):  # noqa: ANN202
    """In a scan task: one row for each different text."""

    def emit(held: dict[bytes, list]) -> pa.RecordBatch:
        digests = [hashlib.sha256(b).digest() for b in held]
        keys = [_key(d) for d in digests]
        cells = (np.array(keys, np.int64).astype(np.uint64) >> np.uint64(shift)).astype(np.int64)
        columns = [owner_of[cells].tolist(), keys, *([v[i] for v in held.values()] for i in range(3)), digests, list(held)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=LOCAL.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        kept = 0
        for batch in batches:
            for doc, text, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                body = (text or b"").translate(None, IGNORED)
                if (x := held.get(body)) is None:
                    held[body] = [1, size, doc]
                    kept += len(body)
                    if kept > HELD_BYTES:
                        yield emit(held)
                        held, kept = {}, 0
                else:
                    x[0] += 1
                    if _better((size, doc), (x[1], x[2])):
                        x[1:] = [size, doc]
        if held:
            yield emit(held)

    return run


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In an owner task, over rows in key order: the chain of different texts of each key, with their groups."""
    key, chain = None, []  # of [body, digest, rows, size, doc]
    done: list[list] = []

    def flush() -> pa.RecordBatch:
        columns = zip(*done, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=INDEX.names)

    for batch in batches:
        for _, k, rows, size, doc, digest, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if k != key:
                done += [[x[1], n, x[2], x[4], x[3]] for n, x in enumerate(chain)]
                key, chain = k, []
            for x in chain:
                if x[0] == body:
                    x[2] += rows
                    if _better((size, doc), (x[3], x[4])):
                        x[3:] = [size, doc]
                    break
            else:
                chain.append([body, digest, rows, size, doc])
        if len(done) > 10_000:
            yield flush()
            done = []
    done += [[x[1], n, x[2], x[4], x[3]] for n, x in enumerate(chain)]
    if done:
        yield flush()


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and size for each row, dropped ones too.

    Null texts count as empty and form a group with texts of ignored characters alone. Rows with the same id and text
    are copies of each other; only one of them is kept if they tie in all. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    members = stored(fingerprints(docs, id_col, text_col))
    shift = 64 - MAX_DEPTH
    counts = {r["cell"]: r["count"] for r in members.groupBy(F.shiftrightunsigned("key", shift).alias("cell")).count().collect()}  # 65,536 rows at most
    tasks = tasks_of(spark)
    owner_of = owners(directory(counts), counts, tasks)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"), F.coalesce(F.length(F.col(text_col).cast("string")), F.lit(0)).cast("bigint").alias("size"))
    local = rows.mapInArrow(_merge_copies(owner_of, shift), LOCAL)
    index = stored(local.repartitionById(tasks, F.col("owner")).sortWithinPartitions("key").mapInArrow(_own, INDEX))
    # A text that occurs once keeps itself; only the others are looked up. Large groups are split as a skewed join.
    many = index.where("group_size > 1")
    joined = members.join(many, "digest", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"), keep.eqNullSafe(F.col("doc_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "size")


def _winners(bodies: list[bytes], sizes: list[int], ids: list) -> list[int]:
    """The places of the rows that stay among some, one for each different text."""
    best: dict[bytes, int] = {}
    for i, body in enumerate(bodies):
        j = best.setdefault(body, i)
        if j != i and _better((sizes[i], ids[i]), (sizes[j], ids[j])):
            best[body] = i
    return list(best.values())


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Of rows that tie in id and text, one stays.

    Rows of equal text are first thinned in the scan task; what is left goes once, as whole rows, to the owner of its
    key. Null texts count as empty. Columns may have any names but those of clashing case.
    """
    spark = docs.sparkSession
    body = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), IGNORED.decode(), "").cast("binary")
    key = F.conv(F.substring(F.sha2(body, 256), 1, 4), 16, 10).cast("int")
    counts = {r["cell"]: r["count"] for r in docs.select(key.alias("cell")).groupBy("cell").count().collect()}  # 65,536 rows at most
    tasks = tasks_of(spark)
    owner_of = owners(directory(counts), counts, tasks)
    names = [f"c{i}" for i in range(len(docs.columns))]  # the columns by place, so that no name clashes
    plain = docs.toDF(*names)
    at = docs.columns.index(text_col)
    size = F.coalesce(F.length(F.col(names[at]).cast("string")), F.lit(0)).cast("bigint")
    rows = plain.withColumns({"id": F.col(names[docs.columns.index(id_col)]).cast("bigint"), "size": size})
    width, dealt = len(names), StructType([*rows.schema.fields, *StructType().add("key", LongType()).add("owner", IntegerType()).fields])

    def bodies_of(table: pa.Table) -> list[bytes]:
        return [(t or b"").translate(None, IGNORED) for t in table.column(at).cast(pa.string()).cast(pa.binary()).to_pylist()]

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(parts: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
            table = pa.Table.from_batches(parts)
            bodies = bodies_of(table)
            stay = _winners(bodies, table.column(width + 1).to_pylist(), table.column(width).to_pylist())
            keys = [_key(hashlib.sha256(bodies[i]).digest()) for i in stay]
            cells = (np.array(keys, np.int64).astype(np.uint64) >> np.uint64(64 - MAX_DEPTH)).astype(np.int64)
            table = table.take(pa.array(stay, pa.int64()))
            return table.append_column("key", pa.array(keys, pa.int64())).append_column("owner", pa.array(owner_of[cells], pa.int32())).combine_chunks().to_batches()

        held, kept = [], 0
        for batch in batches:
            for part in cut(batch, at):
                held.append(part)
                kept += part.column(at).nbytes
                if kept > THIN_BYTES:
                    yield from emit(held)
                    held, kept = [], 0
        if held:
            yield from emit(held)
        del held
        release()

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in the order of keys. The winners so far of the last key are carried from part to part."""
        carried: pa.Table | None = None
        for batch in batches:
            for part in cut(batch, at):
                table = pa.Table.from_batches([part])
                if carried is not None:
                    table = pa.concat_tables([carried, table])
                keys = table.column(width + 2).to_pylist()
                stay = sorted(_winners(bodies_of(table), table.column(width + 1).to_pylist(), table.column(width).to_pylist()))
                open_, done = [i for i in stay if keys[i] == keys[-1]], [i for i in stay if keys[i] != keys[-1]]
                carried = table.take(pa.array(open_, pa.int64()))
                yield from table.select(range(width)).take(pa.array(done, pa.int64())).combine_chunks().to_batches()
        if carried is not None:
            yield from carried.select(range(width)).combine_chunks().to_batches()
        del carried
        release()

    local = rows.mapInArrow(thin, dealt)
    kept = local.repartitionById(tasks, F.col("owner")).sortWithinPartitions("key").mapInArrow(own, plain.schema)
    return kept.toDF(*docs.columns)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read_table(spark, sf_dir, "documents")).drop("size")


OP8_SQL = """
WITH base AS (
  SELECT doc_id, length(coalesce(text, '')) AS size, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       first_value(doc_id) OVER w = doc_id AS kept, text_sha256
FROM base
WINDOW w AS (PARTITION BY text_sha256 ORDER BY size DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""
