"""Successors of retired codes and bounded successor chains."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The end of versions without one.
LAST = date(9999, 12, 31)


def successors(history: DataFrame) -> DataFrame:
    """code, successor: codes of the same schedule and name (in any version) that are in force on the day after retirement.

    history: code, valid_from, valid_to, schedule, name (normalised, undesignated), retired (date or null).
    """
    last = history.groupBy("code").agg(F.max_by(F.struct("schedule", "name", "retired"), "valid_from").alias("x")).select("code", "x.*").where("retired is not null").withColumn("day", F.date_add("retired", 1))
    ended = last.select("schedule", "name", "code", "day")
    # Each code brings the stretches in which it is in force along. They don't overlap, so a pair is made once and isn't sent anywhere.
    named = history.select("schedule", "name", F.col("code").alias("successor")).distinct().join(in_force(history).withColumnRenamed("code", "successor"), "successor")
    return named.join(ended, ["schedule", "name"]).where("successor != code and f <= day and day < u").select("code", "successor")


def in_force(history: DataFrame) -> DataFrame:
    """code, f, u: the stretches from day f up to u on which some version is in force; versions that meet are one stretch.

    A version without a start, or that ends before it starts, is never in force.
    """
    end = F.least(F.coalesce("valid_to", F.lit(LAST)), F.coalesce(F.date_add("retired", 1), F.lit(LAST)))
    spans = history.select("code", F.col("valid_from").alias("f"), end.alias("u")).where("f < u")
    w = Window.partitionBy("code").orderBy("f", "u")
    new = F.coalesce((F.col("f") > F.max("u").over(w.rowsBetween(Window.unboundedPreceding, -1))).cast("int"), F.lit(1))
    joined = spans.withColumn("new", new).withColumn("n", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return joined.groupBy("code", "n").agg(F.min("f").alias("f"), F.max("u").alias("u")).drop("n")


def successor_chain(start: DataFrame, edges: DataFrame, hops: int = 6) -> DataFrame:
    """start: key, code. edges: code, next (one each), until. Adds the codes reached in 1..hops steps: key, hop, code.

    Bounded self-joins; a chain that meets a code again stops there.
    """
    frontier = start.select("key", "code", F.array("code").alias("seen"))
    step = edges.select("code", F.col("next"))
    out = None
    for hop in range(1, hops + 1):
        frontier = frontier.join(step, "code").where(~F.array_contains("seen", F.col("next"))).select("key", F.col("next").alias("code"), F.array_append("seen", F.col("next")).alias("seen"))
        rows = frontier.select("key", F.lit(hop).alias("hop"), "code")
        out = rows if out is None else out.unionByName(rows)
    return out
