"""Operator 5: token counts, with overlapping chunks for huge documents.

A long text is encoded in overlapping chunks with offsets. Two neighbouring chunks are spliced at a place where both
have a token border and the text proves that no token can cross: before a space that follows a non-space, as no piece
of the vocabulary holds a space after another character. Where the overlap has no such place, it is widened.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.llm.common import map_slices, read_table

CHUNK, OVERLAP, LIMIT = 16_384, 256, 4096


class Counter:
    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> None:
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunk, self.overlap = chunk, overlap
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        # The proof needs a vocabulary without inner spaces; other models get whole texts.
        self.provable = not any("▁" in p.lstrip("▁") for p in names)
        # Bytes of text that a token covers; the space before a text that the model adds counts as one.
        self.covers = np.array([1 if model.is_byte(i) else len(p.replace("▁", " ").encode()) for i, p in enumerate(names)], np.int64)
        self.widened = 0

    def starts(self, text: bytes, base: int) -> tuple[np.ndarray, int] | None:
        """The offset at which each token starts, and the number of tokens; None if the model has changed the text."""
        ids = np.array(self.model.encode(text.decode(), num_threads=1), np.int64)
        ends = np.cumsum(self.covers[ids])
        if not len(ids) or ends[-1] != len(text) + 1:
            return None
        return base + np.concatenate([[0], ends[:-1] - 1]), len(ids)

    @staticmethod
    def border(text: bytes, at: int) -> int:
        """The next start of a character."""
        while at < len(text) and text[at] & 0xC0 == 0x80:
            at += 1
        return at

    def tokens_of_long(self, whole: str) -> int:
        text, total, begin, skip_to = whole.encode(), 0, 0, -1
        while True:
            end, overlap = self.border(text, begin + self.chunk), self.overlap
            while True:
                stop = self.border(text, end + overlap)
                here = self.starts(text[begin:stop], begin)
                if here is None:
                    return len(self.model.encode(whole, num_threads=1))
                skipped = int(np.searchsorted(here[0], skip_to)) if skip_to >= 0 else 0
                if stop >= len(text):
                    return total + here[1] - skipped
                there = self.starts(text[end : self.border(text, stop + overlap)], end)
                if there is None:
                    return len(self.model.encode(whole, num_threads=1))
                # Not at the last token of the one chunk or the first of the other: those may be cut.
                both = np.intersect1d(here[0][skipped + 1 : -1], there[0][1:])
                at = next((p for p in both[both > end].tolist() if text[p] == 32 and text[p - 1] not in b" \t\n\v\f\r"), None)
                if at is not None:
                    break
                self.widened += 1
                overlap *= 2
            total += int(np.searchsorted(here[0], at)) - skipped
            begin, skip_to = end, at

    def count(self, texts: list[str]) -> list[int]:
        short = [i for i, t in enumerate(texts) if len(t) <= 2 * self.chunk or not self.provable]
        out = [0] * len(texts)
        for i, ids in zip(short, self.model.encode([texts[i] for i in short], num_threads=1), strict=True):
            out[i] = len(ids)
        for i in set(range(len(texts))).difference(short):
            out[i] = self.tokens_of_long(texts[i])
        return out


@functools.lru_cache(2)
def counter(path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Counter:
    return Counter(path, chunk, overlap)


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row. Null texts count as empty; null and repeated ids stay.

    Very long texts are counted whole, in spliced chunks. Other columns, whatever their names, aren't read.
    """

    def make():  # noqa: ANN202
        count = counter(path)

        def step(columns: list[list]) -> list[list]:
            texts = [t or "" for t in columns[1]]
            n = count.count(texts)
            return [columns[0], [len(t.encode()) for t in texts], n, pa.array([x > limit for x in n], pa.bool_())]

        return step

    return map_slices(docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")), "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean", make)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
