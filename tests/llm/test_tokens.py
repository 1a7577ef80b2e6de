"""Operators 4, 5 and 9 against the tokenizer libraries."""

import hashlib
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

os.environ["TOKENIZERS_PARALLELISM"] = "false"
from tokenizers import Tokenizer

from chronofold.llm import bpe, packing, token_counts

from .helpers import collect, edge_texts, frame

BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))


def odd_texts(n, seed=1):
    draw = random.Random(seed)
    return ["".join(draw.choice("ab '\n stionhe.é1!<　 ,,.\x85\xa0\x1d ΣİÉ́|>") for _ in range(draw.randint(1, 80))) for _ in range(n)] + ["".join(draw.choice("etaoinshrdlu") for _ in range(draw.randint(1, 500))) for _ in range(200)]


def test_byte_bpe_is_the_library():
    texts = odd_texts(1500) + [t or "" for t in edge_texts()]
    tokenizer, own = Tokenizer.from_file(BYTE), bpe.ByteBPE(BYTE, entries=3000)
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        for t, ids, e in zip(part, own.encode_batch(part), tokenizer.encode_batch(part, add_special_tokens=False), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == e.ids, t
            assert own.decode(ids) == tokenizer.decode(e.ids, skip_special_tokens=False)


def test_own_merging_and_verification_agree():
    own = bpe.ByteBPE(BYTE)
    words = [w.encode() for w in {"".join(random.Random(i).choice("stionhea er") for _ in range(i % 14 + 1)).strip() or "a" for i in range(800)}]
    fast, own.by_rank = own.by_rank, None
    for w in words:
        merged = own.merge(w)
        assert merged == fast._encode_single_piece(w) == own.merge_long([own.ids[w[i : i + 1]] for i in range(len(w))])
        tokens, owner = own.propose([w.decode()])
        assert bool(own.verify(tokens, owner, 1)[0]) == (tokens.tolist() != merged)


def test_decode_of_broken_bytes():
    own = bpe.ByteBPE(BYTE)
    assert own.decode(np.array([own.ids[b"\xc3"]], "<u4").tobytes()) == "�" and own.decode(b"") == ""


def test_encode_rows(spark):
    df = frame(spark, edge_texts())
    got = bpe.encode(df, BYTE, with_ids=True).collect()
    assert len(got) == df.count()
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[0]["n_tokens"] == by_id[1]["n_tokens"] == 0 and by_id[0]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    assert all(by_id[i]["decoded"] == (t or "") for i, t in enumerate(edge_texts()) if t != "NULL-ID") and None in by_id
    assert bpe.encode(df.limit(0), BYTE).count() == 0


def test_token_counts_of_long_texts():
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    small = token_counts.Counter(PIECE, chunk=150, overlap=8)
    texts = [t for t in odd_texts(100, 4) if len(t) > 60] + ["x" * 2000, " " * 900, "ab " * 700, "a  " * 300 + "y" * 600 + " z" * 400, "日本" * 400, "é ñ" * 300, "\n".join(["word"] * 400)]
    assert [small.tokens_of_long(t * 3) for t in texts] == [len(model.encode(t * 3)) for t in texts]
    assert small.widened > 0


def test_token_count_rows(spark):
    texts = edge_texts()
    got = token_counts.count_tokens(frame(spark, texts), PIECE).collect()
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    for r in got:
        if r["doc_id"] is not None:
            t = texts[r["doc_id"]] or ""
            assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), len(model.encode(t)), len(model.encode(t)) > 4096)
    assert token_counts.count_tokens(frame(spark, []), PIECE).count() == 0


def test_word_encoder_is_the_library():
    texts = odd_texts(1500, 2) + [t or "" for t in edge_texts()]
    tokenizer, own = Tokenizer.from_file(WORD), packing.PieceEncoder(WORD, entries=2000)
    assert own.merge is not None
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        for t, ids, e in zip(part, own.encode_batch(part), tokenizer.encode_batch(part, add_special_tokens=False), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == e.ids, t


@pytest.mark.parametrize("case", ["small", "large", "mixed", "halves"])
def test_best_fit_and_bound(case):
    draw = np.random.Generator(np.random.PCG64(3))
    sizes = {"small": draw.integers(1, 40, 500), "large": draw.integers(60, 100, 200), "mixed": draw.integers(1, 100, 400), "halves": np.full(31, 50)}[case]
    bins, offset, room = packing.best_fit(sizes, 100)
    bound = packing.lower_bound(np.bincount(sizes, minlength=101))
    assert bound <= len(room) <= 1.25 * bound + 1 and (room >= 0).all()
    for b in range(len(room)):
        at = 0
        for i in sorted(np.flatnonzero(bins == b), key=lambda i: offset[i]):
            assert offset[i] == at
            at += sizes[i]
        assert at + room[b] == 100


def test_lower_bound_against_search():
    """No bound is above the best packing, found by trying all."""

    def least(items, cap):
        best = len(items)

        def go(i, rooms):
            nonlocal best
            if len(rooms) >= best:
                return
            if i == len(items):
                best = len(rooms)
                return
            for n in range(len(rooms)):
                if rooms[n] >= items[i]:
                    rooms[n] -= items[i]
                    go(i + 1, rooms)
                    rooms[n] += items[i]
            go(i + 1, [*rooms, cap - items[i]])

        go(0, [])
        return best

    draw = np.random.Generator(np.random.PCG64(8))
    for _ in range(40):
        items = sorted(draw.integers(1, 21, 7).tolist(), reverse=True)
        assert packing.lower_bound(np.bincount(items, minlength=21)) <= least(items, 20)


def check_packing(rows, capacity):
    by_sequence: dict = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packed_documents(spark):
    texts = edge_texts()
    got = packing.pack_documents(frame(spark, texts), WORD, with_ids=True).collect()
    tokenizer = Tokenizer.from_file(WORD)
    n = check_packing(got, 2048)
    assert n <= -(-sum(r["length"] for r in got) // 2048) + 1
    for i, t in enumerate(texts):
        if t == "NULL-ID":
            continue
        parts = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["piece"])
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        assert np.frombuffer(b"".join(bytes(r["ids"]) for r in parts), "<u4").tolist() == ids
        assert [r["start"] for r in parts] == list(range(0, len(ids), 2048)) and all(r["ids_crc32"] == zlib.crc32(bytes(r["ids"])) for r in parts)
    assert packing.pack_documents(frame(spark, []), WORD).count() == 0


def test_partitions_exchange_documents(spark):
    """Small partitions leave gaps; the exchange closes them."""
    draw = random.Random(2)
    from chronofold.llm.common import stored

    items = stored(spark.createDataFrame([(i, draw.randint(1, 99)) for i in range(4000)], "doc_id bigint, length bigint"))
    got = packing.pack(items, capacity=100, rows_a_task=200).collect()
    counts = np.bincount([r["length"] for r in got], minlength=101)
    assert sorted(r["doc_id"] for r in got) == list(range(4000))
    assert check_packing(got, 100) <= 1.03 * packing.lower_bound(counts)


def test_identical_rows_are_all_packed(spark):
    got = packing.pack_documents(frame(spark, ["one two"] * 50), WORD).collect()
    assert len(got) == 50 and collect(frame(spark, ["a"]), "doc_id") == [(0,)]
