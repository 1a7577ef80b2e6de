"""Aggregates, lookups and orders of the reports, and the checks that resolution makes on its results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.operators.events import first_seen, with_groups
from chronofold.operators.resolve import top_k
from chronofold.operators.temporal import as_of_join


# Reports -----------------------------------------------------------------------------------------------------
def notice_groups(listing: DataFrame) -> DataFrame:
    """entity, t, eff, doc of each group: its classes in order, products, and products that no earlier group has."""
    groups = with_groups(listing).groupBy("entity", "t").agg(
        F.min("eff").alias("eff"), F.min("doc").alias("doc"), F.array_join(F.array_sort(F.collect_set("kubun")), "/").alias("kubuns"), F.count_distinct("product").alias("n_products")
    )
    new = first_seen(listing.where("product is not null"), ["product"]).groupBy("entity", "t").agg(F.count("*").alias("n_new"))
    return groups.join(new, ["entity", "t"], "left").withColumn("n_new", F.coalesce("n_new", F.lit(0)).cast("bigint"))


def category_sizes(state: DataFrame) -> DataFrame:
    """entity, category: the products that are in it now."""
    return state.groupBy("entity", "category").agg(F.count_distinct("product").alias("n_products"))


def histogram(df: DataFrame, column: str) -> DataFrame:
    """How many rows have each value, of a status or a kind of repair."""
    return df.groupBy(column).agg(F.count("*").alias("n"))


def date_span(df: DataFrame, column: str, default: str | None = None) -> DataFrame:
    """first and last date of a column, with a default for the first of an empty table."""
    first = F.min(column) if default is None else F.coalesce(F.min(column), F.lit(default).cast("date"))
    return df.agg(first.alias("first"), F.max(column).alias("last"))


def changes_per_notice(notices: DataFrame, changes: DataFrame) -> DataFrame:
    """Notices that change something: doc_id, their changes and the first day of effect."""
    return notices.join(changes, "doc_id").groupBy("doc_id").agg(F.count("*").alias("n_changes"), F.min("effective").alias("first_effective"))


def snapshot_state(rows: DataFrame, entity: str, key: Column, attributes: list[str], order: str) -> DataFrame:
    """entity, key: the attributes of its first row, and the number of its rows."""
    return rows.groupBy(entity, key.alias("key")).agg(*[F.min_by(c, order).alias(c) for c in attributes], F.count("*").alias("n_rows"))


def category_pairs(rows: DataFrame) -> DataFrame:
    """entity: its different pairs of category and product, in order, as one text."""
    pairs = F.transform(F.array_sort(F.collect_set(F.struct("category", "product"))), lambda x: F.concat_ws(":", x["category"], x["product"].cast("string")))
    return rows.groupBy("entity").agg(F.array_join(pairs, ",").alias("pairs"))


def match_rates(rows: DataFrame, code: str = "code", verified: str = "verified") -> DataFrame:
    """Rows, rows with a code, rows whose price is confirmed, and both as shares."""
    return rows.agg(F.count("*").alias("n"), F.count(code).alias("n_code"), F.count_if(verified).alias("n_verified")).withColumns({"code_rate": F.try_divide("n_code", "n"), "verified_rate": F.try_divide("n_verified", "n")})


# Lookups and key sets ----------------------------------------------------------------------------------------
def rows_of(df: DataFrame, column: str, value: str) -> DataFrame:
    """The rows of one key, as it is typed: case and outer spaces don't count. The filter reaches the scan."""
    return df.where(F.col(column) == value.strip().upper())


def full_snapshots(files: DataFrame, name: str = "file") -> DataFrame:
    return files.where(F.upper(name).contains("ALL"))


def not_present(new: DataFrame, old: DataFrame, key: list[str]) -> DataFrame:
    """Rows of new documents, files or designated codes whose key the old ones lack."""
    return new.join(old.select(*key).distinct(), key, "left_anti")


def key_union(frames: list[DataFrame], key: list[str]) -> DataFrame:
    out = frames[0].select(*key)
    for df in frames[1:]:
        out = out.unionByName(df.select(*key))
    return out.distinct()


# Orders ------------------------------------------------------------------------------------------------------
def ordinal(rows: DataFrame, by: list[str], order: list[str], name: str = "ordinal") -> DataFrame:
    """The place of each row of a key, 1, 2, ...; missing dates come first. ``order`` should tell all rows apart."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*[F.col(c).asc_nulls_first() for c in order])))


def top_moves(moves: DataFrame, k: int = 3) -> DataFrame:
    """Of each group the moves of most products."""
    return top_k(moves, ["entity", "eff", "doc"], [F.col("n_products").desc(), F.col("from"), F.col("to")], k)


def shortened(c: Column, most: int) -> Column:
    return F.substring(c, 1, most)


# Tables read from pages --------------------------------------------------------------------------------------
def carry_down(cells: DataFrame, table: list[str], order: str, columns: list[str]) -> DataFrame:
    """Blank cells take the last filled one above them in their table: merged cells, and headings over their rows."""
    w = Window.partitionBy(*table).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cells.withColumns({c: F.last(F.nullif(F.col(c), F.lit("")), ignorenulls=True).over(w) for c in columns})


# Checks of resolution ----------------------------------------------------------------------------------------
def price_verified(rows: DataFrame, history: DataFrame, least: float = 0.5) -> DataFrame:
    """rows (row_id, code, eff, price) with master_price, the code's price in force, and verified: whether both agree.

    history: code, valid_from, master_price.
    """
    found = as_of_join(rows, history, ["code"], "eff", "valid_from", ["master_price"])
    return found.withColumn("verified", F.coalesce(F.abs(F.col("master_price") - F.col("price")) < least, F.lit(False)))


def name_fallback(rows: DataFrame, names: DataFrame, score: Callable[[Column, Column], Column], least: float = 0.45) -> DataFrame:
    """row_id, code, score for rows (row_id, category_no, name) that nothing else resolved: the code of the most similar name of
    the same number (names: category_no, code, label) from ``least`` on, for half its score. Different names are scored once."""
    pairs = rows.select("category_no", "name").distinct().join(names.select("category_no", "label").distinct(), "category_no").withColumn("score", score(F.col("name"), F.col("label"))).where(F.col("score") >= least)
    codes = names.groupBy("category_no", "label").agg(F.min("code").alias("code"))
    best = top_k(pairs.join(codes, ["category_no", "label"]), ["category_no", "name"], [F.col("score").desc(), F.col("code")], 1)
    return rows.join(best.select("category_no", "name", "code", F.round(0.5 * F.col("score"), 2).alias("score")), ["category_no", "name"]).select("row_id", "code", "score")


def reconcile_histories(a: DataFrame, b: DataFrame, key: list[str], least: float = 0.5) -> DataFrame:
    """counter, n over two systems' rows (key, price, start, end): keys on one side only, prices that agree or differ, starts
    that agree, and ends that one side alone knows, that are equal, near (in one calendar year) or different."""
    x = a.select(*key, *[F.col(c).alias(f"{c}_a") for c in ("price", "start", "end")], F.lit(True).alias("in_a"))
    y = b.select(*key, *[F.col(c).alias(f"{c}_b") for c in ("price", "start", "end")], F.lit(True).alias("in_b"))
    both = x.join(y, key, "full_outer")
    inside = F.col("in_a").isNotNull() & F.col("in_b").isNotNull()
    ends = inside & F.col("end_a").isNotNull() & F.col("end_b").isNotNull()
    near = F.year("end_a") == F.year("end_b")
    counters = {
        "only_left": F.col("in_b").isNull(), "only_right": F.col("in_a").isNull(), "both": inside,
        "price_equal": inside & (F.abs(F.col("price_a") - F.col("price_b")) < least), "price_different": inside & (F.abs(F.col("price_a") - F.col("price_b")) >= least),
        "start_equal": inside & (F.col("start_a") == F.col("start_b")), "end_left_only": inside & F.col("end_a").isNotNull() & F.col("end_b").isNull(), "end_right_only": inside & F.col("end_a").isNull() & F.col("end_b").isNotNull(),
        "end_equal": ends & (F.col("end_a") == F.col("end_b")), "end_near": ends & (F.col("end_a") != F.col("end_b")) & near, "end_different": ends & ~near,
    }
    sums = both.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in counters.items()])
    return sums.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, counters)), F.array(*counters))).alias("counter", "n"))
