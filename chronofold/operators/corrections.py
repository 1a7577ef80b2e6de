"""Ordered corrections and replacements of documents, as set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def resolve_targets(corrections: DataFrame, notices: DataFrame) -> DataFrame:
    """Adds target_doc: the first notice, in manifest order (seq), of the date that a correction names."""
    first = notices.groupBy("notice_date").agg(F.min_by("doc_id", "seq").alias("target_doc"))
    return corrections.join(first, corrections["ref_notice_date"] == first["notice_date"], "left").drop(first["notice_date"])


def drop_replaced(rows: DataFrame, replacements: DataFrame) -> DataFrame:
    """Rows without those of documents (target_doc) that a replacement stands for."""
    gone = replacements.where("target_doc is not null").select(F.col("target_doc").alias("__gone")).distinct()
    return rows.join(gone, rows["doc_id"] == gone["__gone"], "left_anti")


def number_corrections(corrections: DataFrame) -> DataFrame:
    """Adds step: the place 1, 2, ... of each correction document among those of its target, by date and manifest order."""
    w = Window.partitionBy("target_doc").orderBy(F.col("notice_date").asc_nulls_first(), "seq")
    return corrections.withColumn("step", F.dense_rank().over(w))


def apply_corrections(base: DataFrame, deletes: DataFrame, adds: DataFrame) -> DataFrame:
    """Rows that survive. base: target_doc, entity, category, code, ...; deletes and adds also have step.

    A row born at step b (0 for base rows) goes if a later step deletes its entity and category, with its code or with
    none. One inequality anti-join replaces the replay. Deletes of a step come before its adds.
    """
    rows = base.withColumns({"birth": F.lit(0), "corrected": F.lit(0)}).unionByName(adds.withColumn("birth", F.col("step").cast("int")).withColumn("corrected", F.lit(1)).drop("step"), allowMissingColumns=True)
    d = deletes.select(*[F.col(c).alias(f"__{c}") for c in ("target_doc", "entity", "category", "code", "step")])
    gone = (
        (rows["target_doc"] == d["__target_doc"]) & rows["entity"].eqNullSafe(d["__entity"]) & rows["category"].eqNullSafe(d["__category"])
        & (d["__step"] > rows["birth"]) & (d["__code"].isNull() | (rows["code"] == d["__code"]))
    )
    return rows.join(d, gone, "left_anti")


def match_status(base: DataFrame, deletes: DataFrame, adds: DataFrame) -> DataFrame:
    """Each delete with matched = 1 if a row that is alive at its step is hit: the delete of least step takes a row."""
    keys = ["target_doc", "entity", "category", "code"]
    rows = base.select(*keys, F.lit(0).alias("birth")).unionByName(adds.select(*keys, F.col("step").cast("int").alias("birth"))).distinct()
    d = deletes.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("step").alias("__step"))

    def same(a: DataFrame, b: DataFrame):  # noqa: ANN202
        return (a["target_doc"] == b["__target_doc"]) & a["entity"].eqNullSafe(b["__entity"]) & a["category"].eqNullSafe(b["__category"]) & (b["__code"].isNull() | (a["code"] == b["__code"]))

    first = rows.join(d, same(rows, d) & (rows["birth"] < d["__step"])).groupBy(*keys, "birth").agg(F.min("__step").alias("__step"))
    taken = first.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__step").alias("__taken")).distinct()
    hit = (deletes["target_doc"] == taken["__target_doc"]) & deletes["entity"].eqNullSafe(taken["__entity"]) & deletes["category"].eqNullSafe(taken["__category"]) & (deletes["step"] == taken["__taken"]) & (deletes["code"].isNull() | (deletes["code"] == taken["__code"]))
    return deletes.join(taken, hit, "left_semi").withColumn("matched", F.lit(1)).unionByName(deletes.join(taken, hit, "left_anti").withColumn("matched", F.lit(0)))


def inherit_class(rows: DataFrame, key: list[str], column: str = "kubun") -> DataFrame:
    """Null classes of added rows take the entity's earlier class: of a row just deleted, else its first surviving one."""
    w = Window.partitionBy(*key).orderBy("birth", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    any_ = Window.partitionBy(*key).orderBy("birth", "seq").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.withColumn(column, F.coalesce(F.col(column), F.last(column, ignorenulls=True).over(w), F.first(column, ignorenulls=True).over(any_)))


def expand_annex(rows: DataFrame, items: DataFrame) -> DataFrame:
    """Rows that point to an annex become one row for each of its items, under ``side:number`` or else the number.

    rows: doc_id, annex, side, ...; items: doc_id, key, position, product_name, product_code. Rows whose annex is
    missing stay as they are.
    """
    lists = items.groupBy("doc_id", "key").agg(F.array_sort(F.collect_list(F.struct("position", "product_name", "product_code"))).alias("list"))
    own, plain = lists.select("doc_id", F.col("key").alias("__own"), F.col("list").alias("l1")), lists.select("doc_id", F.col("key").alias("__plain"), F.col("list").alias("l2"))
    keyed = rows.withColumns({"__own": F.concat_ws(":", F.col("side"), F.col("annex")), "__plain": F.col("annex")})
    joined = keyed.join(own, ["doc_id", "__own"], "left").join(plain, ["doc_id", "__plain"], "left")
    item = joined.withColumn("__item", F.explode_outer(F.coalesce("l1", "l2")))
    keep = [c for c in rows.columns if c not in ("product_name", "product_code")]
    return item.select(*keep, F.coalesce("__item.product_name", *(["product_name"] if "product_name" in rows.columns else [])).alias("product_name"), F.coalesce("__item.product_code", *(["product_code"] if "product_code" in rows.columns else [])).alias("product_code"))
