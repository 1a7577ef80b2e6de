"""Verified links and components for near-duplicate search, without emitting all pairs of a group.

Nodes are different shingle sets. Each search method posts nodes under keys such that every pair to be found shares a
key. In a posting list first the least node is compared with all others, which is linear and settles most groups.
Lists whose nodes are then still in several components give their remaining pairs across components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.llm.common import MinHash, cut, discard, map_slices, mix64, release, shingle_hashes, slices, stored

#: Ids of candidate nodes that are broadcast (24 bytes each); beyond, their texts are found by a shuffled join.
BROADCAST_ROWS = 500_000
#: Passes over the lists in which one node is compared with the others. Lists over LONG_LIST give way to prefixes of full
#: sets. In the end what is left of the lists is compared in blocks of about BLOCK_BYTES of sets and signatures.
STAR_ROUNDS, LONG_LIST, BLOCK_BYTES = 1, 64, 8 << 20
#: Pairs with one leader that a task compares before another task gets its own copy of the leader's set.
LEADER_PAIRS = 512
#: Different sets, and ids, that a scan task gathers before it sends them on.
HELD_NODES, HELD_IDS = 10_000, 100_000


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values) if values else np.empty(0, np.int64), pa.int64()))


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int, k: int, keys: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """node (128-bit digest of a set, null if empty), n (shingles), ``k`` coordinate tokens, and ids and marks of its rows.

    A token stands for a coordinate and the shingle of least permuted value. ``keys`` may turn the tokens into others.
    A mark is a hash of the row's text. Rows of one set are gathered in the scan task, so that a group of copies of any
    size gives one row for each task.
    """
    hasher = MinHash(k)
    a, b = hasher.a[:, None], hasher.b[:, None]
    salts = mix64(np.arange(1, k + 1, dtype=np.uint64) << np.uint64(32))

    def tokens(s: np.ndarray) -> np.ndarray:
        x, best, at = s >> np.uint64(32), None, None
        with np.errstate(over="ignore"):
            for start in range(0, len(x), 4096):
                block = x[None, start : start + 4096] * a
                block += b
                i = block.argmin(axis=1)
                least = block[np.arange(k), i]
                if best is None:
                    best, at = least, i
                else:
                    less = least < best
                    best, at = np.where(less, least, best), np.where(less, i + start, at)
        return mix64(s[at] ^ salts)

    def emit(held: dict) -> pa.RecordBatch:
        columns = [pa.array(list(held), pa.binary()), pa.array([v[0] for v in held.values()], pa.int64()), _lists([v[1] for v in held.values()])]
        columns += [pa.array([v[i] for v in held.values()], pa.list_(pa.int64())) for i in (2, 3)]
        return pa.RecordBatch.from_arrays(columns, names=["node", "n", "tokens", "ids", "marks"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids = {}, 0
        for columns in slices(batches):
            for doc, text, mark in zip(*columns, strict=True):
                s = shingle_hashes(text or b"", size)
                node = hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                if node not in held:
                    found = tokens(s) if len(s) else s
                    held[node] = (len(s), (keys(found) if keys and len(s) else found).view(np.int64), [], [])
                held[node][2].append(doc)
                held[node][3].append(mark)
                ids += 1
            if len(held) > HELD_NODES or ids > HELD_IDS:
                yield emit(held)
                held, ids = {}, 0
        if held:
            yield emit(held)
        del held
        release()

    rows = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string").cast("binary"), mark_of(F.col(text_col)))
    return rows.mapInArrow(run, "node binary, n bigint, tokens array<bigint>, ids array<bigint>, marks array<bigint>")


def mark_of(text: Column) -> Column:
    """A hash that tells the texts of one id apart."""
    return F.xxhash64(text.cast("string"))


def nodes_of(members: DataFrame) -> DataFrame:
    """One row for each different set: node, n, tokens, first_id (least doc_id)."""
    return members.where("n > 0").groupBy("node").agg(F.min(F.array_min("ids")).alias("first_id"), F.max("n").alias("n"), F.first("tokens").alias("tokens"))


def sets_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """A stored table of node and shingles (sorted 64-bit hashes) of the wanted nodes (node, first_id), from their first documents."""
    count = wanted.count()
    texts = docs.select(F.col(id_col).cast("bigint").alias("first_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    small = wanted.select("first_id", "node")
    found = texts.join(F.broadcast(small) if count <= BROADCAST_ROWS else small, texts["first_id"].eqNullSafe(small["first_id"])).select("node", "text")

    def make():  # noqa: ANN202
        def step(columns: list[list]) -> list[list]:
            nodes, shingles = [], []
            for node, t in zip(*columns, strict=True):
                s = shingle_hashes(t or b"", size).tobytes()
                if hashlib.blake2b(s, digest_size=16).digest() == node:  # not another row under the same id
                    nodes.append(node)
                    shingles.append(s)
            return [nodes, shingles]

        return step

    sets = stored(map_slices(found, "node binary, shingles binary", make))
    if sets.count() == count:
        return sets
    once = stored(sets.dropDuplicates(["node"]))  # repeated rows
    discard(sets)
    return once


def _numbers(cells: pa.Array) -> Iterator[np.ndarray]:
    """Each cell of a column of packed 64-bit numbers, without a copy."""
    for cell in cells:
        yield np.frombuffer(cell.as_buffer(), np.uint64)


def common_size(x: np.ndarray, y: np.ndarray) -> int:
    """How many values two sorted sets share."""
    if len(x) < len(y):
        x, y = y, x
    return int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum()) if len(x) else 0


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union.

    The set of ``a`` is sent once for each LEADER_PAIRS pairs that it leads, and that of ``b`` follows it, so a task
    holds one set and a hub is spread over tasks.
    """
    hubs = pairs.groupBy("a").agg(F.count("*").alias("c")).where(F.col("c") > LEADER_PAIRS).select("a", F.ceil(F.col("c") / LEADER_PAIRS).alias("chunks"))
    dealt = stored(pairs.join(hubs, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), F.coalesce("chunks", F.lit(1))).alias("chunk")))
    leaders = dealt.select("a", "chunk").distinct().withColumn("node", F.col("a")).withColumn("follows", F.lit(False))
    others = dealt.select("a", "chunk", F.col("b").alias("node"), F.lit(True).alias("follows"))
    rows = leaders.unionByName(others).join(sets, "node").select("a", "chunk", "follows", "node", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = np.empty(0, np.uint64)
        for batch in batches:
            good = []
            for follows, x in zip(batch.column(2).to_pylist(), _numbers(batch.column(4)), strict=True):
                if follows:
                    common = common_size(lead, x)
                    good.append(100 * common >= percent * (len(lead) + len(x) - common))
                else:
                    lead = x.copy()
                    good.append(False)
            found = batch.select([0, 3]).filter(pa.array(good, pa.bool_()))
            if found.num_rows:
                yield pa.RecordBatch.from_arrays(found.columns, names=["a", "b"])
        release()

    return rows.repartition("a", "chunk").sortWithinPartitions("a", "chunk", "follows").mapInArrow(run, "a binary, b binary")


class Parts:
    """Union of component names."""

    def __init__(self) -> None:
        self.up: dict[bytes, bytes] = {}

    def root(self, x: bytes) -> bytes:
        while (above := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(above, above)
            x = above
        return x


class Block:
    """The nodes of one block of a list, and the links of others with them."""

    def __init__(self, percent: int, threshold: int) -> None:
        self.percent, self.threshold, self.parts = percent, threshold, Parts()
        self.nodes: list[bytes] = []
        self.components: list[bytes] = []
        self.sets: list[np.ndarray] = []
        self.tokens = np.empty((0, 0), np.int64)
        self.sizes = np.empty(0, np.int64)

    def add(self, node: bytes, component: bytes, tokens: np.ndarray, shingles: np.ndarray) -> None:
        at = len(self.nodes)
        if at == len(self.sizes):
            grown = np.empty((max(64, 2 * at), len(tokens)), np.int64), np.empty(max(64, 2 * at), np.int64)
            if at:
                grown[0][:at], grown[1][:at] = self.tokens, self.sizes
            self.tokens, self.sizes = grown
        self.tokens[at], self.sizes[at] = tokens, len(shingles)
        self.nodes.append(node)
        self.components.append(component)
        self.sets.append(shingles.copy())

    def links(self, component: bytes, tokens: np.ndarray, shingles: np.ndarray) -> Iterator[bytes]:
        """Nodes of the block that a node links with, one of each component that it isn't in yet."""
        n, size = len(self.nodes), len(shingles)
        if not n:
            return
        own, sizes = self.sizes[:n], np.minimum(self.sizes[:n], size)
        match = 100 * sizes >= self.percent * np.maximum(own, size)
        match &= (self.tokens[:n] == tokens).sum(axis=1) >= self.threshold
        for i in np.flatnonzero(match).tolist():
            mine, other = self.parts.root(component), self.parts.root(self.components[i])
            if mine != other:
                common = common_size(self.sets[i], shingles)
                if 100 * common >= self.percent * (size + len(self.sets[i]) - common):
                    self.parts.up[mine] = other
                    yield self.nodes[i]


def links_in_lists(posts: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, threshold: int) -> DataFrame:
    """A stored table of a, b: links across components within each list (key, node, component, n), enough of them to join
    all that are linked.

    The largest component of a list is not compared with itself. The other nodes are cut into blocks by bytes; a block
    is a unit of work with itself, with each other block, and with each block of the largest component. A task holds one
    block, and the other one passes it row by row. Pairs are formed in memory, count collisions of whole signatures
    first, and confirm what reaches the threshold.
    """
    weight = F.sum(8 * F.col("n") + 400)
    groups = posts.groupBy("key", "component").agg(weight.alias("bytes"))
    lists = groups.groupBy("key").agg(F.max(F.struct("bytes", "component")).alias("most"), F.sum("bytes").alias("all"))
    own, rest = F.ceil(F.col("most.bytes") / BLOCK_BYTES), F.greatest(F.lit(1), F.ceil((F.col("all") - F.col("most.bytes")) / BLOCK_BYTES))
    lists = stored(lists.select("key", F.col("most.component").alias("largest"), own.alias("large_blocks"), rest.alias("rest_blocks")))
    units = posts.join(lists, "key").withColumn("inside", F.col("component") == F.col("largest"))
    block = F.when(F.col("inside"), F.col("rest_blocks") + F.pmod(F.xxhash64("node"), "large_blocks")).otherwise(F.pmod(F.xxhash64("node"), "rest_blocks"))
    last = F.when(F.col("inside"), F.col("rest_blocks")).otherwise(F.col("rest_blocks") + F.col("large_blocks")) - 1
    units = units.withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    units = units.select("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "node", "component")
    rows = units.join(nodes.select("node", "tokens"), "node").join(sets, "node").select("key", "x", "y", "own", "node", "component", "tokens", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, block = None, Block(percent, threshold)
        for batch in batches:
            found: list[tuple[bytes, bytes]] = []
            names = zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True)
            flat, width = batch.column(6).flatten().to_numpy(), batch.column(6).value_lengths().to_numpy()
            ends = width.cumsum()
            for (key, x, y, own, node, component), start, end, shingles in zip(names, (ends - width).tolist(), ends.tolist(), _numbers(batch.column(7)), strict=True):
                if (key, x, y) != unit:
                    unit, block = (key, x, y), Block(percent, threshold)
                tokens = flat[start:end]
                if own == y:
                    found += [(node, other) for other in block.links(component, tokens, shingles)]
                if own == x:
                    block.add(node, component, tokens, shingles)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([min(p) for p in found], pa.binary()), pa.array([max(p) for p in found], pa.binary())], names=["a", "b"])
        del block
        release()

    found = stored(rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "own").mapInArrow(run, "a binary, b binary").distinct())
    discard(lists)
    return found


def components(edges: DataFrame) -> DataFrame:
    """node, component (least node reachable) for all ends of the edges (a, b), by alternating large and small stars.

    Ends when every node has one edge at most, to a node that leads nowhere: then each hangs on the least of its component.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    while True:
        # Large star: of each node, its larger neighbours go to its least neighbour or itself.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = stored(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # Small star: of each node, its smaller neighbours and itself go to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        after = stored(large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        discard(now, large)
        now = after
        split = now.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
        if now.join(now.select(F.col("v").alias("u")).distinct(), "u", "left_semi").select("u").unionByName(split).isEmpty():
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def shared_keys(rows: DataFrame, name: str) -> DataFrame:
    """A stored table of the keys that several rows (key, ...) have, with their number as ``name``.

    Stored, so that a join with it isn't tied to the shuffle that counted: Spark broadcasts it while its files are below
    the session's threshold, and beyond can split a partition of rows with a hot key.
    """
    return stored(rows.groupBy("key").agg(F.count("*").alias(name)).where(F.col(name) > 1))


def rare_shingle_posts(posts: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """key and node for the nodes of long lists, by prefixes of their full sets instead of those lists; and the stored table
    of shared shingles that this plan reads.

    With shingles in order of how many of these sets have them, two sets of the similarity share one among the rarest
    n - ceil(percent n / 100) + 1 of each. Far copies of one text have too many rare ones to meet there. Also gives n and
    rest, the number of shingles from this one on: two sets whose first common shingle this is share no more than that.
    """
    inside = sets.join(posts.where(F.col("length") > LONG_LIST).select("node").distinct(), "node").select("node", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in cut(batch, 1):
                sets = list(_numbers(part.column(1)))
                digests = np.array([np.frombuffer(c.as_buffer(), np.uint8) for c in part.column(0)])
                data = np.repeat(digests, [len(s) for s in sets], axis=0)
                ends = np.arange(0, 16 * len(data) + 1, 16, dtype=np.int32)
                names = pa.BinaryArray.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(ends), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([names, pa.array(np.concatenate(sets).view(np.int64))], names=["node", "key"])

    every = inside.mapInArrow(run, "node binary, key bigint")
    shared = shared_keys(every, "sets")
    own = every.join(shared, "key").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("sets", "key"))).alias("own"))
    n = inside.select("node", (F.octet_length("shingles") / 8).cast("bigint").alias("n"))
    room = (F.size("own") - F.ceil(percent * F.col("n") / 100) + 1).cast("int")  # those that no other set has come first
    rows = own.join(n, "node").where(room > 0).select("node", "n", F.size("own").alias("shared"), F.posexplode(F.slice("own", F.lit(1), room)).alias("at", "x"))
    return rows.select(F.xxhash64("x.key").alias("key"), "node", "n", (F.col("shared") - F.col("at")).cast("bigint").alias("rest")), shared


def search(docs: DataFrame, nodes: DataFrame, posts: DataFrame, threshold: int, percent: int, id_col: str, text_col: str, size: int) -> DataFrame | None:
    """Components (node, component) of the verified links between nodes that share a key and ``threshold`` tokens or more.

    posts: key, node, a stored table that is removed in the end. None: no links at all.

    Nodes of long lists are posted anew under the rarest shingles of their full sets, which is exact too and keeps far
    copies of one text, or texts with one common passage, from being compared pair by pair.
    """
    lists, before = shared_keys(posts, "length"), posts
    posts = stored(before.join(lists, "key").select("key", "node", "length"))
    discard(before, lists)
    wanted = stored(posts.select("node").distinct().join(nodes.select("node", "n", "tokens", "first_id"), "node"))
    if wanted.isEmpty():
        discard(posts, wanted)
        return None
    sets = sets_of(docs, wanted, id_col, text_col, size)
    facts = wanted.select("node", "n").join(posts.groupBy("node").agg(F.sum("length").alias("weight")), "node")
    kept = posts.where(F.col("length") <= LONG_LIST).join(facts, "node").select("key", "node", "n", F.col("n").alias("rest"), "weight")
    before = [posts]
    if not posts.where(F.col("length") > LONG_LIST).isEmpty():
        rare, shared = rare_shingle_posts(posts, sets, percent)
        kept = kept.unionByName(rare.join(facts.select("node", "weight"), "node"))
        before.append(shared)
    posts = stored(kept)
    discard(*before)
    most = F.least("rest", "rest2")
    close = (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")) & (100 * most >= percent * (F.col("n") + F.col("n2") - most))

    def links(pairs: DataFrame) -> DataFrame:
        a = wanted.select(F.col("node").alias("a"), "tokens")
        b = wanted.select(F.col("node").alias("b"), F.col("tokens").alias("tokens2"))
        # Equal tokens stand at equal places, so collisions are counted place by place.
        collisions = F.aggregate(F.zip_with("tokens", "tokens2", lambda x, y: (x == y).cast("int")), F.lit(0), lambda x, y: x + y)
        return verified(pairs.join(b, "b").join(a, "a").where(collisions >= threshold).select("a", "b"), sets, percent)

    labels = None
    for number in range(STAR_ROUNDS + 1):
        now = posts.withColumn("component", F.col("node")) if labels is None else posts.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        several = now.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("l")).where("x != y" if number == 0 else "x != y and l > 2")
        several = stored(several.select("key", "l"))
        now = stored(now.join(several, "key"))
        discard(several)
        if now.isEmpty():
            discard(now)
            break
        if number == STAR_ROUNDS:
            found = links_in_lists(now, wanted, sets, percent, threshold)
        else:
            # The node that shares most leads, as a text that others copy does; in later rounds that of another third.
            mark = F.xxhash64("node", F.lit(number))
            order = F.struct(F.when(F.lit(number == 0) | (F.pmod(mark, F.lit(3)) == 0), -F.col("weight")).otherwise(0), mark)
            leaders = now.groupBy("key").agg(F.min(F.struct(order.alias("order"), *[F.col(c).alias(f"{c}2") for c in ("node", "component", "n", "rest")])).alias("x"))
            leaders = stored(leaders.select("key", "x.*"))
            pairs = now.join(leaders, "key").where((F.col("component") != F.col("component2")) & close)
            # Of several leaders a node is held against the foremost; only lists of two are settled at once.
            ends = [F.col("other").alias("a"), F.col("node").alias("b")]
            first = pairs.where("l > 2").groupBy("node").agg(F.min_by("node2", "order").alias("other")).select(*ends)
            both = first.unionByName(pairs.where("l = 2").withColumnRenamed("node2", "other").select(*ends)) if number == 0 else first
            found = stored(links(both.distinct()))
            discard(leaders)
        if not found.isEmpty():
            old = labels
            labels = stored(components(found if old is None else found.unionByName(old.select(F.col("node").alias("a"), F.col("component").alias("b")))))
            if old is not None:
                discard(old)
        discard(now, found)
    discard(posts, wanted, sets)
    return labels


def label_members(members: DataFrame, nodes: DataFrame, labels: DataFrame | None) -> DataFrame:
    """doc_id, mark, n_shingles, component_id, kept of all rows. Empty sets link with nothing; rows of null id keep to their
    component. Members come gathered by scan task, so a set with very many rows joins its label in few."""
    if labels is None:
        named = nodes.select("node", F.col("first_id").alias("component_id"))
    else:
        linked = nodes.join(labels, "node")
        least = linked.groupBy("component").agg(F.min("first_id").alias("component_id"))
        inside = linked.join(least, "component").select("node", "component_id")
        named = nodes.join(inside, "node", "left").select("node", F.coalesce("component_id", "first_id").alias("component_id"))
    rows = members.select("node", "n", F.arrays_zip("ids", "marks").alias("rows"))
    filled = rows.where("node is not null").join(named, "node").select("n", "component_id", F.explode("rows").alias("row"))
    empty = rows.where("node is null").select("n", F.explode("rows").alias("row")).select("n", F.col("row.ids").alias("component_id"), "row")
    component = F.col("component_id")
    return filled.unionByName(empty).select(F.col("row.ids").alias("doc_id"), F.col("row.marks").alias("mark"), F.col("n").alias("n_shingles"), component, component.eqNullSafe(F.col("row.ids")).alias("kept"))
