"""Operator 4: byte-level BPE by speculation and verification.

Greedy longest match proposes the tokens of each new word; a vectorised check of every adjacent pair tells which
proposals are what merging would give (a segmentation is the merge result exactly if each neighbouring pair, merged
alone, stays a pair); only words with a failing pair are merged exactly. Texts are cut before each space that a
non-space follows, where no pre-token can cross, and the ids of such pieces are kept in a bounded table per worker.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
from array import array
from operator import itemgetter

import ahocorasick
import numpy as np
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.llm.common import map_slices, read_table

#: Entries after which a worker's table of pieces and words begins anew (about 200 MB).
TABLE_ENTRIES = 900_000
#: Unicode White_Space; fixed values of the pre-tokeniser's \\s.
SPACES = "".join(map(chr, [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies: printable Latin-1 stands for itself, the rest follow from U+0100."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBPE:
    """Encoder and decoder for one tokenizer file of the byte-level kind."""

    def __init__(self, path: str, entries: int = TABLE_ENTRIES) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet, model = byte_alphabet(), spec["model"]
        raw = {t: i for t, i in model["vocab"].items()}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        plain = {t: i for t, i in raw.items() if t not in self.special}
        self.ids = {bytes(alphabet[c] for c in t): i for t, i in plain.items()}
        self.entries = entries
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.size = size
        spelled = [b""] * size
        for b, i in self.ids.items():
            spelled[i] = b
        for t, i in self.special.items():
            spelled[i] = t.encode()
        self.lengths = np.array([len(b) for b in spelled], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.automaton = ahocorasick.Automaton()
        for b, i in self.ids.items():
            self.automaton.add_word(b.decode("latin-1"), i)
        self.automaton.make_automaton()
        # Merge rank of each pair, and how each token was put together; a token of one byte is its own half.
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        self.codes: dict[int, int] = {}
        left, right, made = np.arange(size), np.arange(size), np.full(size, -1)
        pairs = np.empty(len(model["merges"]), np.int64)
        for n, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            a, b, c = raw[a], raw[b], raw[a + b]
            self.rank[a, b] = (n, c)
            self.codes[a * size + b] = n * size + c
            pairs[n] = a * size + b
            if made[c] < 0:
                left[c], right[c], made[c] = a, b, n
        self.left, self.right, self.made = left, right, made
        order = np.argsort(pairs)
        self.pair_codes, self.pair_ranks = pairs[order], order
        self.pieces: dict[str, bytes] = {}
        # Where a token's id orders its merge, the library for rank-ordered BPE merges the failing words.
        many = np.array([i for b, i in self.ids.items() if len(b) > 1])
        self.by_rank = None
        if len(many) and (made[many] >= 0).all() and (np.diff(made[np.sort(many)]) > 0).all() and len(self.ids) - len(many) == 256:
            self.by_rank = tiktoken.Encoding("bytes", pat_str=r"(?s:.+)", mergeable_ranks=self.ids, special_tokens={})
        self.known = np.empty(0, np.int64)
        self.known_ok = np.empty(0, bool)
        letters = r"\p{L}"
        self.split_words = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?{letters}+| ?\p{{N}}+| ?[^{SPACES}\p{{L}}\p{{N}}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
        self.cut = regex.compile(rf"(?= [^{SPACES}])")
        self.odd = [" " + c for c in SPACES]
        self.odd_ascii = [" " + c for c in SPACES if c.isascii()]
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.exact_merges = 0

    # Speculation and verification -----------------------------------------------------------------------

    def propose(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match of all words in one pass of an automaton over their bytes, kept apart by a character
        that no token has. Returns the tokens and the index of each token's word."""
        text = "\u0100".join([w if w.isascii() else w.encode().decode("latin-1") for w in words])
        found = list(self.automaton.iter_long(text))
        ends = np.fromiter(map(itemgetter(0), found), np.int64, len(found))
        tokens = np.fromiter(map(itemgetter(1), found), np.int64, len(found))
        borders = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), "<u4") == 256)
        return tokens, np.searchsorted(borders, ends)

    def compatible(self, codes: np.ndarray) -> np.ndarray:
        """For each pair code first * size + second: does merging the two tokens' bytes give these two tokens?

        Unwinds the merges of both sides from the last back. At each step the tokens that touch the border existed
        together for a span of ranks; a merge of the two within that span would have crossed the border.
        """
        a, b = codes // self.size, codes % self.size
        until_a, until_b = np.full(len(a), 1 << 40), np.full(len(a), 1 << 40)
        ok, live = np.ones(len(a), bool), np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            code = x * self.size + y
            at = np.minimum(np.searchsorted(self.pair_codes, code), len(self.pair_codes) - 1)
            rank = np.where(self.pair_codes[at] == code, self.pair_ranks[at], 1 << 41)
            # A merge on the border wins if it comes before the merge that next consumes either side: the left one's
            # rival, of the same rank at most, stands earlier in the text and goes first.
            bad = (rank < until_a[live]) & (rank <= until_b[live])
            ok[live[bad]] = False
            live = live[~bad]
            x, y = a[live], b[live]
            ra, rb = self.made[x], self.made[y]
            more = (ra >= 0) | (rb >= 0)
            live, x, y, ra, rb = live[more], x[more], y[more], ra[more], rb[more]
            first = ra >= rb
            p, q = live[first], live[~first]
            until_a[p], a[p] = ra[first], self.right[x[first]]
            until_b[q], b[q] = rb[~first], self.left[y[~first]]
        return ok

    def verify(self, tokens: np.ndarray, owner: np.ndarray, words: int) -> np.ndarray:
        """Which words, given their tokens in order, have a failing pair. Pairs met before are looked up."""
        failing = np.zeros(words, bool)
        same = owner[1:] == owner[:-1]
        codes = tokens[:-1][same] * self.size + tokens[1:][same]
        distinct, back = np.unique(codes, return_inverse=True)
        at = np.searchsorted(self.known, distinct)
        hit = at < len(self.known)
        hit[hit] = self.known[at[hit]] == distinct[hit]
        ok = np.empty(len(distinct), bool)
        ok[hit] = self.known_ok[at[hit]]
        new = distinct[~hit]
        ok[~hit] = self.compatible(new)
        if len(new):
            if len(self.known) > 2 * self.entries:
                self.known, self.known_ok = np.empty(0, np.int64), np.empty(0, bool)
                at = np.zeros(len(distinct), np.int64)
            self.known, self.known_ok = np.insert(self.known, at[~hit], new), np.insert(self.known_ok, at[~hit], ok[~hit])
        failing[owner[1:][same][~ok[back]]] = True
        return failing

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: always the pair of least rank, the leftmost of equals."""
        self.exact_merges += 1
        if self.by_rank is not None:
            return self.by_rank._encode_single_piece(word)
        ids = [self.ids[word[i : i + 1]] for i in range(len(word))]
        if len(ids) > 200:
            return self.merge_long(ids)
        get, size, never = self.codes.get, self.size, 1 << 60
        ranks = [get(a * size + b, never) for a, b in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < never:
            at = ranks.index(best)
            ids[at] = made = best % size
            del ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = get(ids[at - 1] * size + made, never)
            if at < len(ranks):
                ranks[at] = get(made * size + ids[at + 1], never)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and linked neighbours, for words of hundreds of bytes and more."""
        import heapq

        n = len(ids)
        ids, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*self.rank[p][:1], i, p) for i in range(n - 1) if (p := (ids[i], ids[i + 1])) in self.rank]
        heapq.heapify(heap)
        while heap:
            _, i, p = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or (ids[i], ids[j]) != p:
                continue
            ids[i], ids[j] = self.rank[p][1], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (q := (ids[x], ids[y])) in self.rank:
                    heapq.heappush(heap, (self.rank[q][0], x, q))
        return [t for t in ids if t >= 0]

    # Texts ---------------------------------------------------------------------------------------------------

    def learn(self, pieces: set[str]) -> None:
        """Puts the ids of new pieces, and of the words inside them, into the table."""
        table, parts, new = self.pieces, {}, set()
        for p in pieces:
            if p.isalpha() or p[0] == " " and p[1:].isalpha():
                new.add(p)
            else:
                parts[p] = ws = self.split_words.findall(p) if not (p[-1] in ".," and (p[:-1].isalpha() or p[0] == " " and p[1:-1].isalpha())) else [p[:-1], p[-1]]
                new.update([w for w in ws if w not in table])
        words = [w for w in new if w not in table]
        tokens, owner = self.propose(words)
        failing = np.flatnonzero(self.verify(tokens, owner, len(words))).tolist()
        ends = (np.searchsorted(owner, np.arange(1, len(words) + 1)) * 4).tolist()
        packed, start = tokens.astype("<u4").tobytes(), 0
        for w, end in zip(words, ends, strict=True):
            table[w] = packed[start:end]
            start = end
        for i in failing:
            table[words[i]] = array("I", self.merge(words[i].encode())).tobytes()
        for p, ws in parts.items():
            table[p] = b"".join([table[w] for w in ws])

    def cut_text(self, text: str) -> list[str]:
        """Pieces that join to the text, each later one starting at a space before a non-space."""
        for pair in self.odd_ascii if text.isascii() else self.odd:
            if pair in text:
                return [p for p in self.cut.split(text) if p]
        first, *rest = text.split(" ")
        if rest and not rest[-1]:
            rest[-1:] = []
            return ([first] if first else []) + [" " + p for p in rest] + [" "]
        return ([first] if first else []) + [" " + p for p in rest]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        spans: list[list[str | bytes]] = []
        for t in texts:
            if self.specials and any(s in t for s in self.special):
                spans.append([np.array([self.special[x]], "<u4").tobytes() if x in self.special else x for x in self.specials.split(t) if x])
            else:
                spans.append([t] if t else [])
        if len(self.pieces) > self.entries:
            self.pieces.clear()
        cuts = [[x if isinstance(x, bytes) else self.cut_text(x) for x in s] for s in spans]
        get, missing = self.pieces.get, set()
        got = []
        for c in cuts:
            got.append(row := [])
            for x in c:
                if isinstance(x, bytes):
                    row.append(x)
                    continue
                row.append(ids := list(map(get, x)))
                if None in ids:
                    missing.update([p for p, v in zip(x, ids) if v is None])
        if missing:
            self.learn(missing)
        out = []
        for c, row in zip(cuts, got, strict=True):
            whole = []
            for x, ids in zip(c, row, strict=True):
                whole.append(ids if isinstance(ids, bytes) else b"".join([get(p) if v is None else v for p, v in zip(x, ids)] if None in ids else ids))
            out.append(whole[0] if len(whole) == 1 else b"".join(whole))
        return out

    def decode(self, ids: bytes) -> str:
        """Joins the tokens' bytes; what isn't UTF-8 becomes U+FFFD."""
        x = np.frombuffer(ids, "<u4").astype(np.int64)
        if not len(x):
            return ""
        n = self.lengths[x]
        ends = np.cumsum(n)
        at = np.arange(ends[-1])
        at += np.repeat(self.offsets[x] - (ends - n), n)
        return self.bytes[at].tobytes().decode("utf-8", errors="replace")


@functools.lru_cache(2)
def tokenizer(path: str) -> ByteBPE:
    return ByteBPE(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, and with ``with_ids`` also the ids and the decoded text, one row for each row.

    Null texts count as empty (no tokens). Null ids and repeated rows stay, very long texts are encoded whole, and other
    columns, whatever their names, aren't read.
    """
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * with_ids

    def make():  # noqa: ANN202
        bpe = tokenizer(path)

        def step(columns: list[list]) -> list[list]:
            ids, texts = columns
            found = bpe.encode_batch([t or "" for t in texts])
            back = [bpe.decode(x) for x in found]
            out = [ids, [len(x) // 4 for x in found], [hashlib.sha256(x).hexdigest() for x in found], [hashlib.sha256(t.encode()).hexdigest() for t in back]]
            return out + [found, back] * with_ids

        return step

    return map_slices(docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")), schema, make)


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
