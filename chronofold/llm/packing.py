"""Operator 9: best-fit packing with certified bounds.

Each partition packs its pieces by best-fit decreasing and holds the number of bins against dual-feasible-function
lower bounds. A partition that meets its bound can only lose what the bound was rounded up by: it gives up its emptiest
bins, one bin's room together. Partitions with a gap give up all bins that aren't full. What is given goes to a smaller
number of partitions and is packed again, until one partition is left, the whole corpus meets its bound, or a round no
longer saves a bin.
"""

from __future__ import annotations

import functools
import json
import logging
import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.llm.bpe import SPACES, byte_alphabet
from chronofold.llm.common import map_slices, read_table, stored

CAPACITY, END_ID = 2048, 0
#: Pieces that a task packs at a time, about as many as an input split of 128 MB has, and their bytes where ids go along.
TASK_PIECES, TASK_BYTES = 20_000, 64 << 20
TABLE_ENTRIES = 900_000
#: The word pattern of the tokenizer family that the fast path knows; a fixed value.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters that str.split() takes for white space and the tokenizer doesn't.
_SEPARATORS = "\x1c\x1d\x1e\x1f"


class PieceEncoder:
    """Ids of a tokenizer that drops white space and never crosses it: pieces between spaces are encoded once.

    New pieces whose normalised form is plain are split into words and merged by the rank-ordered BPE library, with the
    word end as one more byte that merges first; that holds where ids order the merges, which the constructor checks.
    All other pieces, and all pieces of other vocabularies, go through the tokenizer itself.
    """

    def __init__(self, path: str, entries: int = TABLE_ENTRIES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.entries, self.table, self.merge = entries, Table(self.encode_piece), None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, special = spec["model"], {x["content"] for x in spec["added_tokens"]}
        suffix, alphabet = model.get("end_of_word_suffix"), byte_alphabet()
        split = [x.get("pattern", {}).get("Regex") for x in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        if suffix and split[:1] == [WORDS] and len(split) == 2:
            ranks = {}
            for t, i in model["vocab"].items():
                if t not in special:
                    body, end = (t[: -len(suffix)], b"\xff") if t.endswith(suffix) else (t, b"")
                    ranks[bytes(alphabet[c] for c in body) + end] = i
            made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
            short = [i for b, i in ranks.items() if len(b.rstrip(b"\xff")) <= 1]
            if made == sorted(made) and max(short) < made[0] and len(made) + len(short) == len(ranks):
                self.merge = tiktoken.Encoding("word ends", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})._encode_single_piece
        self.words = regex.compile(WORDS)

    def split_piece(self, piece: str) -> list[str] | None:
        """The words of a piece, or None where only the tokenizer knows."""
        if piece.isascii():
            if "<" in piece:
                return None
        elif "Σ" in piece or "<" in piece or not unicodedata.is_normalized("NFC", piece):
            return None
        p = piece.lower()
        if p.isalpha():
            return [p]
        if p[-1] in ".," and p[:-1].isalpha():
            return [p[:-1], p[-1]]
        return self.words.findall(p)

    def encode_piece(self, piece: str) -> bytes:
        words = self.split_piece(piece) if self.merge else None
        if words is None:
            return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()
        merge = self.merge
        ids = merge(words[0].encode() + b"\xff")
        for w in words[1:]:
            ids = ids + merge(w.encode() + b"\xff")
        return array("I", ids).tobytes()

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.table) > self.entries:
            self.table.clear()
        get, out = self.table.__getitem__, []
        for t in texts:
            parts = [p for p in re.split(f"[{SPACES}]+", t) if p] if any(c in t for c in _SEPARATORS) else t.split()
            out.append(b"".join(map(get, parts)))
        return out


class Table(dict):
    """Pieces and their ids; a missing piece is encoded and kept."""

    def __init__(self, encode) -> None:  # noqa: ANN001
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        self[piece] = ids = self.encode(piece)
        return ids


@functools.lru_cache(2)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids. Null text: empty, the end id alone."""
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    end = np.array([END_ID], "<u4").tobytes()

    def make():  # noqa: ANN202
        enc = encoder(path)

        def step(columns: list[list]) -> list[list]:
            out: list[list] = [[] for _ in range(5 + with_ids)]
            for doc, ids in zip(columns[0], enc.encode_batch([t or "" for t in columns[1]]), strict=True):
                ids += end
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for c, v in zip(out, (doc, n, at // 4, len(part) // 4, zlib.crc32(part), part), strict=False):
                        c.append(v)
            return out

        return step

    return map_slices(docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")), schema, make, after=lambda: encoder(path).table.clear())


def lower_bound(counts: np.ndarray) -> int:
    """The least number of bins for counts[size] items of each size 1..capacity, by three families of dual feasible functions.

    The area bound; for each t the function that takes sizes over capacity - t for whole bins and drops sizes under t;
    and for k = 1..64 the function that rounds (k + 1) size / capacity down to a multiple of 1 / k unless it is whole.
    """
    cap = len(counts) - 1
    size = np.arange(cap + 1)
    best = -(-int((counts * size).sum()) // cap)
    number, area = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(counts * size)])
    t = np.arange(1, cap // 2 + 1)
    large = number[-1] - number[cap - t + 1]
    middle = area[cap - t + 1] - area[t]
    best = max(best, int((large + -(-middle // cap)).max(initial=0)))
    for k in range(1, 65):
        whole = (k + 1) * size % cap == 0
        value = np.where(whole, size * k, (k + 1) * size // cap * cap)  # in units of 1 / (k * cap)
        best = max(best, -(-int((counts * value).sum()) // (k * cap)))
    return best


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing. Returns each item's bin and offset, and each bin's room left."""
    order = np.argsort(-sizes, kind="stable")
    bin_of, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    room: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0  # bit r: some bin has room r
    for i, s in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fit = mask >> s
        if fit:
            r = s + (fit & -fit).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                mask &= ~(1 << r)
        else:
            b, r = len(room), capacity
            room.append(capacity)
        bin_of[i], offset[i] = b, capacity - r
        room[b] = r - s
        if r > s:
            by_room[r - s].append(b)
            mask |= 1 << (r - s)
    return bin_of, offset, np.array(room, np.int64)


def pack_round(items: DataFrame, capacity: int, number: int) -> DataFrame:
    """Packs each partition's rows; adds sequence_id, offset, and ``given`` for rows that a partition with a gap gives up."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import BooleanType, LongType, StructType

    kept = StructType([f for f in items.schema if f.name not in ("sequence_id", "offset", "given")])
    schema = StructType([*kept, *StructType().add("sequence_id", LongType()).add("offset", LongType()).add("given", BooleanType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        sizes = table.column("length").to_numpy()
        bin_of, offset, room = best_fit(sizes, capacity)
        open_ = room > 0
        if len(room) == lower_bound(np.bincount(sizes, minlength=capacity + 1)):
            order = np.argsort(-room, kind="stable")
            emptiest = order[: int(np.searchsorted(np.cumsum(room[order]), capacity)) + 1]
            open_ = np.isin(np.arange(len(room)), emptiest) & open_
        given = open_[bin_of]
        first = (number << 58) + (TaskContext.get().partitionId() << 32)
        for name, values in (("sequence_id", bin_of + first), ("offset", offset), ("given", given)):
            table = table.append_column(name, pa.array(values))
        yield from table.cast(arrow).combine_chunks().to_batches(max_chunksize=100_000)

    return items.select(*kept.names).mapInArrow(run, schema)


def pack(items: DataFrame, capacity: int = CAPACITY, rounds: int = 6, rows_a_task: int = TASK_PIECES) -> DataFrame:
    """Adds sequence_id and offset to rows with a ``length`` of 1..capacity.

    ``items`` should be a stored table: it is read again in each round. A task holds about ``rows_a_task`` rows, fewer
    where a column ``ids`` makes them large. Ties go by the order in which rows come. An empty table gives an empty one.
    """
    whole = items.where(F.col("length") >= capacity).withColumn("sequence_id", F.monotonically_increasing_id() + F.lit(7 << 58)).withColumn("offset", F.lit(0).cast("bigint"))
    rest = items.where(F.col("length") < capacity)
    histogram = rest.groupBy("length").count().collect()  # at most ``capacity`` rows
    counts = np.zeros(capacity + 1, np.int64)
    for r in histogram:
        counts[r["length"]] = r["count"]
    bound, n = lower_bound(counts), int(counts.sum())
    if "ids" in items.columns and n:
        rows_a_task = max(1, min(rows_a_task, TASK_BYTES // (100 + 4 * int((counts * np.arange(capacity + 1)).sum()) // n)))
    parts = max(1, -(-n // rows_a_task))
    done, used, total, last = [whole], 0, None, None
    work = rest.repartition(parts) if n else rest
    for number in range(rounds):
        packed = stored(pack_round(work, capacity, number))
        found = {r["given"]: (r["bins"], r["n"]) for r in packed.groupBy("given").agg(F.count_distinct("sequence_id").alias("bins"), F.count("*").alias("n")).collect()}
        bins, given = found.get(True, (0, 0))
        kept = found.get(False, (0, 0))[0]
        before, total = total, used + kept + bins
        if before is not None and total > before:  # the pieces were better off where they were
            done.append(last.where("given").drop("given"))
            total = before
            break
        if not given or parts == 1 or total in (bound, before) or number == rounds - 1:
            done.append(packed.drop("given"))
            break
        done.append(packed.where(~F.col("given")).drop("given"))
        used, last = used + kept, packed
        parts = max(1, min(parts // 4, -(-given // rows_a_task)))
        work = packed.where("given").repartition(parts)
    logging.getLogger(__name__).info("%d bins of pieces under %d tokens, lower bound %d, after %d rounds", total or 0, capacity, bound, number + 1)
    out = done[0]
    for other in done[1:]:
        out = out.unionByName(other)
    return out


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence and place; ``with_ids`` keeps the token ids for training readers.

    Null texts count as empty (the end id alone); null and repeated ids are packed like others. Very long texts are cut
    into pieces of the capacity. Other columns, whatever their names, aren't read.
    """
    return pack(stored(pieces(docs, path, id_col, text_col, capacity, with_ids)), capacity)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
