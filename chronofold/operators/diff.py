"""Differences of snapshots and reconciliation of two systems."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_two(df: DataFrame, snapshot: str) -> DataFrame:
    """Rows of the last and the last but one snapshot, with age 1 and 2."""
    names = df.select(snapshot).distinct().withColumn("age", F.dense_rank().over(Window.orderBy(F.col(snapshot).desc()))).where("age <= 2")
    return df.join(F.broadcast(names), snapshot)


def snapshot_diff(new: DataFrame, old: DataFrame, key: list[str], value: str) -> DataFrame:
    """key, change (added, removed, changed), before, after; values are compared with nulls as equal."""
    a, b = new.select(*key, F.col(value).alias("after"), F.lit(1).alias("in_new")), old.select(*key, F.col(value).alias("before"), F.lit(1).alias("in_old"))
    both = a.join(b, key, "full_outer")
    change = F.when(F.col("in_old").isNull(), "added").when(F.col("in_new").isNull(), "removed").when(~F.col("after").eqNullSafe(F.col("before")), "changed")
    return both.withColumn("change", change).where("change is not null").select(*key, "change", "before", "after")


def not_listed(snapshot: DataFrame, listed: DataFrame, entity: str, code: str) -> DataFrame:
    """Codes of the snapshot that aren't listed for their entity, for entities that are listed at all."""
    return snapshot.join(listed.select(entity).distinct(), entity, "left_semi").join(listed.select(entity, code).distinct(), [entity, code], "left_anti")


def snapshot_only(snapshot: DataFrame, entities: DataFrame, entity: str) -> DataFrame:
    return snapshot.join(entities.select(entity).distinct(), entity, "left_anti")


def reconcile(a: DataFrame, b: DataFrame, key: list[str], value: str, tolerance: Column | float = 0.5) -> DataFrame:
    """kind, n: keys on one side only, and keys of both whose values agree within the tolerance, differ or are missing."""
    x, y = a.select(*key, F.col(value).alias("va"), F.lit(1).alias("ina")), b.select(*key, F.col(value).alias("vb"), F.lit(1).alias("inb"))
    kind = (
        F.when(F.col("inb").isNull(), "only_left").when(F.col("ina").isNull(), "only_right").when(F.col("va").isNull() | F.col("vb").isNull(), "unknown")
        .when(F.abs(F.col("va") - F.col("vb")) < tolerance, "equal").otherwise("different")
    )
    return x.join(y, key, "full_outer").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def supersede(rows: DataFrame, official: DataFrame, key: list[str]) -> DataFrame:
    """Rows without those that an official one of the same key stands for (nulls are equal), and the official ones."""
    o = official.select(*[F.col(k).alias(f"__{k}") for k in key]).distinct()
    on = [rows[k].eqNullSafe(o[f"__{k}"]) for k in key]
    return rows.join(o, on, "left_anti").unionByName(official, allowMissingColumns=True)


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def first_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def unpivot_slots(df: DataFrame, ids: list[str], slots: list[dict[str, str]], name: str = "slot") -> DataFrame:
    """Wide groups of columns as rows: slots[i] maps output fields to the columns of slot i + 1; empty slots are left out."""
    items = F.array(*[F.struct(F.lit(i + 1).alias(name), *[F.col(c).alias(f) for f, c in s.items()]) for i, s in enumerate(slots)])
    rows = df.select(*ids, F.explode(items).alias("__s")).select(*ids, "__s.*")
    return rows.where(F.coalesce(*[F.col(f).cast("string") for f in slots[0]]).isNotNull())
