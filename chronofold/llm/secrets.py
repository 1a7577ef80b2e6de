"""Operator 3: secret scans.

Three patterns find assignments, access keys and hexadecimal keys. Two character Markov models, of random strings and
of ordinary identifiers, add long tokens whose log-likelihood ratio speaks for a random string.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.llm.common import map_slices, read_table, replace_texts, slices

#: Fixed values of the contract: the base patterns, and how long a match must be.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a run that is too short fails from each of its starts, so the bound may stand here
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "markov")

#: Candidates for the models, and the log-likelihood ratio (in nats, over the whole token) from which one is a secret.
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
TOKEN_LEAST, THRESHOLD = 20, 12.0
#: Nats for each character that tokens without a digit or a letter must have too, above most long names; and
#: what rests under TOKEN_LEAST beside base findings must have, as a path or label before a key has up to about 30.
EACH_LEAST, REST_LEAST = 3.5, 40.0
#: Documents, at most, from which ordinary identifiers are taken; random strings that are drawn for the other class.
TRAINING_DOCUMENTS, RANDOM_STRINGS = 3000, 20_000
SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-="


def random_strings(n: int, seed: int = 3) -> list[str]:
    """Labelled samples of random strings over the alphabets in use for keys: hexadecimal, base 32, 36, 62 and 64."""
    draw = np.random.Generator(np.random.PCG64(seed))
    alphabets = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", SYMBOLS[:26] + SYMBOLS[52:62], SYMBOLS[:62], SYMBOLS[:64], SYMBOLS[:62] + "_-")
    return ["".join(np.array(list(a))[draw.integers(0, len(a), 20 + int(draw.integers(0, 45)))]) for a in (alphabets[i % len(alphabets)] for i in range(n))]


def ordinary_identifiers(texts: Iterable[str]) -> list[str]:
    """Labelled samples of ordinary identifiers: the words of texts without the base findings, alone and joined as names are."""
    out: list[str] = []
    joins = ("_", "-", "/", "", "")
    for text in texts:
        n = len(text)
        for _, start, end in reversed(base_spans(text)):
            text = text[:start] + " " + text[end:]
        words = _WORDS.findall(text)
        out += words
        for i in range(0, len(words) - 3, 3):
            by = joins[(n + i) % 5]
            three = words[i : i + 3]
            out.append(by.join(w.capitalize() for w in three) if by == "" else by.join(three))
            if i % 30 == 0:
                out.append(f"{by.join(three)}{(n + i) % 1000}")
    return out


_WORDS = re.compile(r"[A-Za-z][A-Za-z0-9]*")
_INDEX = np.zeros(128, np.int32)  # 0 stands for the border before a token
_INDEX[[ord(c) for c in SYMBOLS]] = np.arange(1, len(SYMBOLS) + 1)
_M = len(SYMBOLS) + 1


def trigrams(tokens: Iterable[str]) -> np.ndarray:
    """The code of each character of the tokens with the two before it."""
    x = _INDEX[np.frombuffer("".join(["\n\n" + t for t in tokens]).encode("ascii"), np.uint8)]
    codes = (x[:-2] * _M + x[1:-1]) * _M + x[2:]
    return codes[x[2:] > 0]


class Markov:
    """Order-two character models of both classes with additive smoothing; scores are sums of log-ratios."""

    def __init__(self, random: np.ndarray, ordinary: np.ndarray, smoothing: float = 0.5) -> None:
        """random, ordinary: how often each trigram code occurs in the labelled samples of the class."""
        self.ratio = self.fit(random, smoothing) - self.fit(ordinary, smoothing)

    @staticmethod
    def fit(counts: np.ndarray, smoothing: float) -> np.ndarray:
        counts = counts.astype(float).reshape(_M, _M, _M)
        # Trigrams back off to bigrams, and those to single characters.
        one = counts.sum((0, 1)) + smoothing
        one = one / one.sum()
        two = counts.sum(0)
        two = (two + 4 * one) / (two.sum(1, keepdims=True) + 4)
        return np.log((counts + 4 * two) / (counts.sum(2, keepdims=True) + 4)).ravel()

    def score(self, token: str) -> float:
        return float(self.ratio[trigrams([token])].sum())


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base findings, by start and then kind."""
    out: list[tuple[int, int, int]] = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(0, *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(1, *m.span()) for m in ACCESS.finditer(text)]
    if any(len(w) >= HEX_LEAST for w in text.split()):
        out += [(2, *m.span()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], s[0]))


def outside(start: int, end: int, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """What the base findings, by start, leave of a candidate."""
    out = []
    for _, s, e in base:
        if s < end and start < e:
            if start < s:
                out.append((start, s))
            start = e
    return [*out, (start, end)] if start < end else out


def is_random(token: str, model: Markov) -> bool:
    """Whether the ratio speaks for a random string. Rules of signs alone, without a letter or digit, are none."""
    digit, letter = any(c.isdigit() for c in token), any(c.isalpha() for c in token)
    if not digit and not letter:
        return False
    least = THRESHOLD if len(token) >= TOKEN_LEAST else REST_LEAST
    return model.score(token) > (least if digit and letter else max(least, EACH_LEAST * len(token)))


def all_spans(text: str, model: Markov) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The base findings, and those with what the models add outside them."""
    base = base_spans(text)
    more = []
    if any(len(w) >= TOKEN_LEAST for w in text.split()):
        for m in TOKEN.finditer(text):
            more += [(3, start, end) for start, end in outside(*m.span(), base) if is_random(text[start:end], model)]
    return base, sorted(base + more, key=lambda s: (s[1], s[0])) if more else base


def identifier_counts(texts: DataFrame) -> np.ndarray:
    """How often each trigram occurs in the ordinary identifiers of a column of texts: sums of each task, then of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_M**3, np.int64)
        for (part,) in slices(batches, 0):
            for at in range(0, len(part), 50):
                total += np.bincount(trigrams(ordinary_identifiers(t for t in part[at : at + 50] if t)), minlength=_M**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["code", "n"])

    out = np.zeros(_M**3, np.int64)
    for r in texts.mapInArrow(run, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).collect():  # 314,432 rows at most
        out[r["code"]] = r["n"]
    return out


def labelled_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = TRAINING_DOCUMENTS) -> Markov:
    """The models, fitted on drawn random strings and on identifiers of about ``bound`` documents at most.

    The documents are chosen by a hash of their ids, without regard to order or place, and their identifiers are counted
    in tasks. An empty table leaves the ordinary class to built-in English-like names.
    """
    n = docs.count()
    share = min(1.0, bound / max(1, n))
    picked = docs.where(F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1_000_000)) < int(share * 1_000_000)).select(F.col(text_col).cast("string"))
    names = ["get user name from config value of default session handler and return response status to client"]
    own = np.bincount(trigrams(ordinary_identifiers(names)), minlength=_M**3)
    return Markov(np.bincount(trigrams(random_strings(RANDOM_STRINGS)), minlength=_M**3), own + identifier_counts(picked))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join([f"{KINDS[k]}:{s}:{e}" for k, s, e in spans])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Markov | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans for each row; offsets in code points, end exclusive.

    Null texts count as empty (no spans). Null and repeated ids stay as they are, very long texts are scanned whole, and
    other columns, whatever their names, aren't read.
    """
    model = model or labelled_model(docs, id_col, text_col)

    def make():  # noqa: ANN202
        def step(columns: list[list]) -> list[list]:
            found = [all_spans(t or "", model) for t in columns[1]]
            number = [[sum(k == n for k, _, _ in spans) for _, spans in found] for n in range(4)]
            return [columns[0], *number, [hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in found], [joined(x) for _, x in found]]

        return step

    return map_slices(docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")), "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_markov bigint, base_sha256 string, spans string", make)


def mask(text: str, model: Markov, by: str = "[SECRET]") -> str:
    """The text with every span, overlapping ones together, replaced. Of an assignment only the value goes."""
    _, spans = all_spans(text, model)
    cuts: list[list[int]] = []
    for k, start, end in spans:
        if k == 0:
            m = ASSIGN.match(text, start)
            start = m.start(2)
        if cuts and start < cuts[-1][1]:
            cuts[-1][1] = max(cuts[-1][1], end)
        else:
            cuts.append([start, end])
    for start, end in reversed(cuts):
        text = text[:start] + by + text[end:]
    return text


def mask_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Markov | None = None) -> DataFrame:
    """``docs`` with secrets in the text masked; all rows and other columns stay, null texts stay null."""
    model = model or labelled_model(docs, id_col, text_col)
    return replace_texts(docs, text_col, lambda text: mask(text, model))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(read_table(spark, sf_dir, "documents"))
