"""Operator 10: near-duplicates by an inverted join over signature coordinates.

Each different shingle set has a signature of K coordinates and is posted under its coordinate-value pairs. Two sets
match if they share at least T of K; T is so low that a pair above the similarity is missed with a probability under
1e-7. Pairs are sorted by how many sets have them: of the rarest K - T + 1 of each set, two sets that share T have one
in common (prefix), and those that no other set has are skipped. Collisions are then counted over whole signatures, and
what matches is confirmed on full shingle sets.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.llm.common import discard, read_table, stored
from chronofold.llm.near import label_members, mark_of, nodes_of, search, shared_keys, sketches

COORDINATES, MISS = 32, 1e-7


def match_threshold(k: int, similarity: float, miss: float = MISS) -> int:
    """The largest T for which fewer than T of k coordinates agree with a probability of at most ``miss``."""
    below, t = 0.0, 0
    while t < k:
        below += comb(k, t) * similarity**t * (1 - similarity) ** (k - t)
        if below > miss:
            return max(1, t)
        t += 1
    return k


def prefix_posts(nodes: DataFrame, k: int, threshold: int) -> DataFrame:
    """A stored table of key and node for the coordinate-value pairs in each set's prefix that other sets have too."""
    tokens = nodes.select("node", F.explode("tokens").alias("key"))
    shared = shared_keys(tokens, "sets")
    # Pairs that one set alone has come first in its prefix and find nothing; they shorten what is posted.
    own = tokens.join(shared, "key").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("sets", "key"))).alias("own"))  # k at most
    room = F.size("own") - F.lit(threshold) + 1
    posts = stored(own.where(room > 0).select("node", F.explode(F.slice("own", 1, room)).alias("x")).select("node", F.col("x.key").alias("key")))
    discard(shared)
    return posts


def near_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80, k: int = COORDINATES) -> DataFrame:
    """As near_components, with ``mark``, a hash that tells the texts of one id apart."""
    threshold = match_threshold(k, percent / 100)
    members = stored(sketches(docs, id_col, text_col, size, k))
    nodes = stored(nodes_of(members))
    labels = search(docs, nodes, prefix_posts(nodes, k, threshold), threshold, percent, id_col, text_col, size)
    return label_members(members.select("node", "n", "ids", "marks"), nodes.select("node", "first_id"), labels)


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80, k: int = COORDINATES) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable over links) and kept for each row.

    Links are pairs with 100 * intersection >= percent * union of their sets of ``size``-word shingles. Null, empty and
    wordless texts have no shingles and link with nothing. Rows of one id count as one document with several texts. Very
    long texts are taken whole. Other columns, whatever their names, aren't read.
    """
    return near_rows(docs, id_col, text_col, size, percent, k).drop("mark")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each group of near-duplicates the row of the least id.

    Rows with equal id and text stay or go together; exact deduplication leaves one of them. Texts without words stay.
    """
    kept = near_rows(docs, id_col, text_col, size, percent).where("kept").select("doc_id", "mark").distinct()
    same = docs[id_col].cast("bigint").eqNullSafe(kept["doc_id"]) & (mark_of(docs[text_col]) == kept["mark"])
    return docs.join(kept, same, "left_semi")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(read_table(spark, sf_dir, "documents"), size=3, percent=85)
