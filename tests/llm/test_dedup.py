"""Operators 1, 8 and 10 against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from chronofold.llm import common, exact_dedup, fingerprints, minhash_join, near

from .helpers import WORDS, edge_texts, frame


def normal(t):
    return re.sub("[\x20\x09-\x0d]", "", t or "")


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append((-len(t or ""), i is None, i or 0, i))
    return sorted([(i, min(g)[3], len(g), min(g)[3] == i, hashlib.sha256(normal(t).encode()).hexdigest()) for i, t in rows for g in [groups[normal(t)]]], key=str)


def test_exact_groups(spark):
    texts = edge_texts() + ["copy"] * 30 + ["co py"] * 3 + [None, "a\x85b", "a b", "ab"]
    df = frame(spark, texts).repartition(5)
    got = exact_dedup.exact_groups(df).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got), key=str) == brute_exact([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()])
    kept = exact_dedup.deduplicate(df)
    assert kept.columns == df.columns and kept.count() == len({normal(t) for t in texts})
    assert exact_dedup.exact_groups(df.limit(0)).count() == 0 and exact_dedup.deduplicate(df.limit(0)).count() == 0


def test_repeated_rows_keep_one(spark):
    df = frame(spark, ["t"]).unionByName(frame(spark, ["t"])).unionByName(frame(spark, ["t "]))
    assert exact_dedup.exact_groups(df).select("group_size").distinct().collect()[0][0] == 3
    assert [r["text"] for r in exact_dedup.deduplicate(df).collect()] == ["t "]


def test_names_of_columns_may_clash(spark):
    rows = [(1, "a b", "x", "y", 5, b"z"), (2, "ab", "x", "y", 6, b"z"), (3, "c", "p", "q", 7, None), (None, "c", "r", "s", 8, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, __digest string, __keep string, c0 bigint, body binary")
    assert sorted(map(tuple, exact_dedup.deduplicate(df).collect())) == [(1, "a b", "x", "y", 5, b"z"), (3, "c", "p", "q", 7, None)]


def test_kept_rows_of_one_id(spark):
    """Rows of one id with different texts are kept or dropped by their own groups."""
    draw = random.Random(9)
    a, b = ([draw.choice(WORDS) + str(draw.randint(0, 99)) for _ in range(80)] for _ in range(2))
    rows = [(1, " ".join(a)), (5, " ".join([*a, "more"])), (5, " ".join(b)), (6, " ".join([*b, "end"])), (7, ""), (8, None)]
    got = minhash_join.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([rows[0], rows[2], rows[4], rows[5]], key=str)


def test_a_hub_of_thousands(spark):
    """Far copies of one text, each list far over LONG_LIST, and as many exact copies: all in one component, each row once."""
    draw = random.Random(12)
    base = [draw.choice(WORDS) + str(draw.randint(0, 999)) for _ in range(300)]
    texts = [" ".join(base)] * 1500
    for i in range(1500):
        copy = list(base)
        copy[draw.randrange(300)] = f"new{i}"
        texts.append(" ".join(copy))
    texts += [f"lonely text number {i} of {i * 7}" for i in range(200)]
    got = {r["doc_id"]: r["component_id"] for r in minhash_join.near_components(frame(spark, texts).select("doc_id", "text").repartition(8), size=3, percent=85).collect()}
    assert len(got) == 3200 and {got[i] for i in range(3000)} == {0} and all(got[i] == i for i in range(3000, 3200))


def test_directory_doubles():
    counts = {0: 10, 1: 10, 2: 1, 9: 50, 15: 1}
    d = exact_dedup.directory(counts, capacity=12, max_depth=4)
    assert len(d) == 16 and (np.diff(d) >= 0).all() and d[8] != d[9] and d[14] == d[15]
    rows = {}
    for cell, bucket in enumerate(d.tolist()):
        rows.setdefault(bucket, []).append(cell)
    assert all(sum(counts.get(c, 0) for c in cells) <= 12 or len(cells) == 1 for cells in rows.values())
    owner = exact_dedup.owners(d, counts, 3)
    assert (np.diff(owner) >= 0).all() and owner.max() <= 2
    assert exact_dedup.directory({}, 10, 4).tolist() == [0] * 16


def test_chains_tell_texts_of_one_key_apart():
    import pyarrow as pa

    rows = [(0, 7, 2, 3, 5, b"d1", b"one"), (0, 7, 1, 9, 4, b"d2", b"two"), (0, 7, 1, 3, 1, b"d1", b"one"), (0, 8, 1, 1, 2, b"d3", b"one")]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=exact_dedup.LOCAL.names)
    out = [r for b in exact_dedup._own(iter([batch])) for r in b.to_pylist()]
    assert [(r["digest"], r["chain"], r["group_size"], r["keep_id"]) for r in out] == [(b"d1", 0, 3, 1), (b"d2", 1, 1, 4), (b"d3", 0, 1, 2)]


def shingles(t, size):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    n = min(size, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def brute_near(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common_ = len(sets[i] & sets[j])
            same_row = rows[i][0] == rows[j][0] and sets[i] == sets[j]
            if sets[i] and sets[j] and (same_row or 100 * common_ >= percent * (len(sets[i]) + len(sets[j]) - common_)):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(x for x in (least.get(root(i)), d) if x is not None) if least.get(root(i)) is not None or d is not None else None
    return sorted([(d, len(sets[i]), d if not sets[i] else least[root(i)], (d if not sets[i] else least[root(i)]) == d) for i, (d, _) in enumerate(rows)], key=str)


def near_texts(seed):
    draw = random.Random(seed)
    out = []
    for _ in range(8):
        base = [draw.choice(WORDS) + str(draw.randint(0, 99)) for _ in range(draw.randint(5, 150))]
        for _ in range(draw.randint(1, 14)):
            copy = list(base)
            for _ in range(draw.randint(0, max(1, len(base) // 18))):
                copy[draw.randrange(len(copy))] = draw.choice(WORDS)
            out.append(" ".join(copy))
    passage = " ".join(draw.choice(WORDS) for _ in range(60))
    out += [passage + " " + " ".join(draw.choice(WORDS) + str(draw.randint(0, 9999)) for _ in range(draw.randint(8, 40))) for _ in range(40)]
    return out


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_components(spark, size, percent):
    texts = edge_texts() + near_texts(size) + ["Short one", "short ONE", "short"]
    df = frame(spark, texts).repartition(4)
    got = minhash_join.near_components(df, size=size, percent=percent).collect()
    expected = brute_near([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()], size, percent)
    assert sorted(map(tuple, got), key=str) == expected
    assert minhash_join.near_components(df.limit(0)).count() == 0


@pytest.mark.parametrize(("rounds", "long"), [(0, 2), (1, 2), (5, 4), (2, 10**9)])
def test_long_lists_lose_no_link(spark, monkeypatch, rounds, long):
    """What passes leave is found pair by pair, and the bound of own shingles drops no link."""
    monkeypatch.setattr(near, "STAR_ROUNDS", rounds)
    monkeypatch.setattr(near, "BLOCK_BYTES", 8000)
    monkeypatch.setattr(near, "LEADER_PAIRS", 3)
    monkeypatch.setattr(near, "HELD_NODES", 5)
    monkeypatch.setattr(near, "LONG_LIST", long)
    texts = near_texts(11)
    df = frame(spark, texts)
    assert sorted(map(tuple, minhash_join.near_components(df, size=3, percent=85).collect()), key=str) == brute_near(list(enumerate(texts)), 3, 85)


def test_bands_find_the_same(spark):
    texts = near_texts(5)
    df = frame(spark, texts)
    assert sorted(map(tuple, fingerprints.near_duplicates(df).collect()), key=str) == brute_near(list(enumerate(texts)), 5, 80)


def test_match_threshold():
    from math import comb

    for k, s in ((32, 0.85), (32, 0.8), (64, 0.9)):
        t = minhash_join.match_threshold(k, s)
        miss = sum(comb(k, i) * s**i * (1 - s) ** (k - i) for i in range(t))
        assert 0 < t < k and miss <= 1e-7


def test_components_of_a_path(spark):
    order = list(range(60))
    random.Random(1).shuffle(order)
    name = lambda i: order[i].to_bytes(16, "big")
    edges = spark.createDataFrame([(name(i), name(i + 1)) for i in range(39)] + [(name(50), name(51))], "a binary, b binary")
    got = {bytes(r["node"]): bytes(r["component"]) for r in near.components(edges).collect()}
    assert len(got) == 42 and {got[name(i)] for i in range(40)} == {min(name(i) for i in range(40))} and got[name(50)] == got[name(51)] == min(name(50), name(51))


def least_reachable(edges):
    """node and the least node of its component, by union."""
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return sorted((x, root(x)) for x in up)


def random_graph(seed):
    """A random path or tree of 3 to 15 nodes."""
    draw = random.Random(seed)
    names = list(range(draw.randint(3, 15)))
    draw.shuffle(names)
    return [(names[i], names[i - 1 if seed % 2 else draw.randrange(i)]) for i in range(1, len(names))]


# The first splits when every target merely leads nowhere, as do the paths and trees of these seeds; the last is 400 graphs at once.
@pytest.mark.parametrize("edges", [[(1, 4), (4, 3), (3, 5), (5, 2)], *map(random_graph, (15, 26, 44, 65)), [(100 * s + a, 100 * s + b) for s in range(400) for a, b in random_graph(s)]])
def test_components_have_one_row_a_node(spark, edges):
    pairs = spark.createDataFrame([(a.to_bytes(16, "big"), b.to_bytes(16, "big")) for a, b in edges], "a binary, b binary")
    got = sorted((int.from_bytes(r["node"], "big"), int.from_bytes(r["component"], "big")) for r in near.components(pairs).collect())
    assert got == least_reachable(edges)


def test_word_hashes():
    a, b = common.word_hashes(b" One two\nTHREE  one\x0b"), common.word_hashes(b"one TWO three one")
    assert a.tolist() == b.tolist() and a[0] == a[3] and len(set(a.tolist())) == 3
    assert len(common.word_hashes(b" \t")) == 0 and len(common.shingle_hashes(b"a b", 3)) == 1 and common.shingle_hashes(b"a b", 3)[0] != common.shingle_hashes(b"a b c", 3)[0]


def test_edited_fingerprints(spark):
    texts = [t for t in edge_texts() if t != "NULL-ID"] + near_texts(2)[:20]
    df = frame(spark, texts).repartition(3)
    got = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(df).collect()}
    own = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(df).collect()}
    f = fingerprints.Fingerprinter()
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        t, after = t or "", texts[(i + 1) % len(texts)] or ""
        k = len(t) // 2
        edited = t[: len(t) - k] + after[:k]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest(), own[i], f.text(f.of(edited)))
        assert r["near_next"] == f.likeness(f.of(t), f.of(after)) and r["near_edited"] == f.likeness(f.of(t), f.of(edited))
    assert own[5] == own[7] == own[6]
    assert fingerprints.edited_fingerprints(frame(spark, ["alone here"])).first()["near_next"] == 1.0
    assert fingerprints.edited_fingerprints(frame(spark, [])).count() == 0
    assert fingerprints.edited_fingerprints(frame(spark, ["a", "NULL-ID", "b"]).unionByName(frame(spark, ["a", "c"]))).count() == 5


def test_likeness_estimates_jaccard():
    draw = random.Random(4)
    f, words = fingerprints.Fingerprinter(), [draw.choice(WORDS) + str(i) for i in range(600)]
    a, b = " ".join(words[:400]), " ".join(words[200:])
    true = len(shingles(a, 5) & shingles(b, 5)) / len(shingles(a, 5) | shingles(b, 5))
    assert abs(f.likeness(f.of(a), f.of(b)) - true) < 0.15
