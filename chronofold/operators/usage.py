"""Periods in which entities use codes, what master data adds to them, and inferred successors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.operators.successors import successor_chain
from chronofold.operators.temporal import version_changes


def master_events(used: DataFrame, history: DataFrame, as_of: Column) -> DataFrame:
    """entity, code, event_date, type, before, after from master data of the codes that entities use.

    used: entity, code, since. history: code, valid_from, price, name, retired. A revision or rename counts after the
    entity's first listing and up to ``as_of``; a rename needs both names. The last version's end counts even if it lies ahead.
    """
    changes = version_changes(history, ["code"], "valid_from", ["price", "name"], until=as_of)
    named = (F.col("field") == "price") | ((F.coalesce("before", F.lit("")) != "") & (F.coalesce("after", F.lit("")) != ""))
    kind = F.when(F.col("field") == "price", "price_revision").otherwise("category_renamed")
    revised = used.join(changes.where(named), "code").where("valid_from > since").select("entity", "code", F.col("valid_from").alias("event_date"), kind.alias("type"), "before", "after")
    last = history.groupBy("code").agg(F.max_by("retired", "valid_from").alias("retired")).where("retired is not null")
    none = F.lit(None).cast("string")
    ended = used.join(last, "code").select("entity", "code", F.col("retired").alias("event_date"), F.lit("category_abolished").alias("type"), none.alias("before"), none.alias("after"))
    return revised.unionByName(ended)


def usage_periods(usage: DataFrame, current: DataFrame, moves: DataFrame, retired: DataFrame) -> DataFrame:
    """usage (entity, category, code, since, until) with end and end_reason.

    No end while in use; else the last move away from the category, else the last listing. The code's own end wins if
    it comes first. current: entity, category. moves: entity, from, eff. retired: code, retired.
    """
    now = current.select("entity", "category").distinct().withColumn("__now", F.lit(1))
    away = moves.groupBy("entity", F.col("from").alias("category")).agg(F.max("eff").alias("__away"))
    rows = usage.join(now, ["entity", "category"], "left").join(away, ["entity", "category"], "left").join(retired.select("code", F.col("retired").alias("__retired")), "code", "left")
    end = F.when(F.col("__now").isNotNull(), None).otherwise(F.coalesce("__away", "until"))
    reason = F.when(F.col("__now").isNotNull(), "in use").when(F.col("__away").isNotNull(), "moved").otherwise("not listed again")
    first = F.col("__retired").isNotNull() & (end.isNull() | (F.col("__retired") < end))
    return rows.select(*usage.columns, F.when(first, F.col("__retired")).otherwise(end).alias("end"), F.when(first, "abolished").otherwise(reason).alias("end_reason"))


def inferred_usage(ended: DataFrame, edges: DataFrame, retired: DataFrame, hops: int = 6) -> DataFrame:
    """entity, code, since, until of the successors that follow a used code's end, hop by hop.

    ended: entity, code, retired. edges: code, next, where a code has one successor alone. A successor is used from the
    day after its predecessor's end; a chain goes on while codes end.
    """
    single = edges.groupBy("code").agg(F.count("*").alias("n"), F.min("next").alias("next")).where("n = 1").drop("n")
    ends = retired.where("retired is not null").select("code", F.col("retired").alias("until"))
    # Only codes that end lead on.
    live = single.join(ends.select("code"), "code", "left_semi")
    chain = successor_chain(ended.select(F.struct("entity", "code").alias("key"), "code"), live, hops)
    before = chain.select("key", F.col("hop") + 1, F.col("code").alias("previous")).toDF("key", "hop", "previous").unionByName(ended.select(F.struct("entity", "code").alias("key"), F.lit(1).alias("hop"), F.col("code").alias("previous")))
    rows = chain.join(before, ["key", "hop"]).join(ends.select(F.col("code").alias("previous"), F.date_add("until", 1).alias("since")), "previous").join(ends, "code", "left")
    return rows.select(F.col("key.entity").alias("entity"), "code", "since", "until")


def prefer_listed(rows: DataFrame) -> DataFrame:
    """Of each entity's code one source: listed rows stay, an inferred one only if it is the earliest and nothing is listed."""
    w = Window.partitionBy("entity", "code")
    listed = F.max(F.when(F.col("source") != "inferred", 1).otherwise(0)).over(w)
    place = F.row_number().over(w.orderBy((F.col("source") == "inferred").cast("int"), F.col("since").asc_nulls_first()))
    marked = rows.withColumn("__listed", listed).withColumn("__n", place)
    return marked.where((F.col("source") != "inferred") | ((F.col("__listed") == 0) & (F.col("__n") == 1))).drop("__listed", "__n")
