"""History from deltas and snapshots: forward fill, collapse, as-of lookup, inferred retirement, interval joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def forward_fill(df: DataFrame, key: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Blank (null) fields keep the last value of their key."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def last_write(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row for each key: the last in ``order``."""
    w = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def collapse_runs(df: DataFrame, key: list[str], order: list[str], state: list[str]) -> DataFrame:
    """Drops rows whose state is that of the row before, nulls being equal."""
    w = Window.partitionBy(*key).orderBy(*order)
    s = F.struct(*state)
    marked = df.withColumn("__first", F.row_number().over(w) == 1).withColumn("__same", F.lag(s).over(w).eqNullSafe(s))
    return marked.where("__first or not __same").drop("__first", "__same")


def with_validity(df: DataFrame, key: list[str], start: str, end: str = "valid_to") -> DataFrame:
    """Adds the start of the key's next version; null for the last."""
    return df.withColumn(end, F.lead(start).over(Window.partitionBy(*key).orderBy(start)))


def build_history(deltas: DataFrame, key: list[str], start: str, order: list[str], state: list[str]) -> DataFrame:
    """Versions (key, start, state, valid_to) from sparse deltas: fill, last write of a day, collapse, validity.

    All steps share the partitioning by key, so the data is shuffled once. Rows without a start date are left out.
    """
    rows = forward_fill(deltas.where(F.col(start).isNotNull()), key, [start, *order], state)
    rows = last_write(rows, [*key, start], order)
    return with_validity(collapse_runs(rows.select(*key, start, *state), key, [start], state), key, start)


def as_of_join(probes: DataFrame, history: DataFrame, key: list[str], at: str, start: str, columns: list[str], broadcast_history: bool = False) -> DataFrame:
    """Adds the columns of the version in force at each probe's time (start <= at), null before the first.

    Probes and versions are sorted together in each key and values carried forward, so the work is linear whatever
    the number of versions, and no pair is made. ``history`` must have one row for each key and start.
    """
    if broadcast_history:
        h = with_validity(history.select(*key, F.col(start).alias("__start"), *[F.col(c).alias(f"__{c}") for c in columns]), key, "__start", "__end")
        return probes.join(F.broadcast(h), [probes[k].eqNullSafe(h[k]) for k in key] + [h["__start"] <= probes[at], h["__end"].isNull() | (probes[at] < h["__end"])], "left").select(*[probes[c] for c in probes.columns], *[F.col(f"__{c}").alias(c) for c in columns])
    value = F.struct(*columns)
    left = probes.withColumns({"__at": F.col(at), "__probe": F.lit(1), "__value": F.lit(None).cast(history.select(value.alias("v")).schema["v"].dataType)})
    right = history.select(*key, F.col(start).alias("__at"), F.lit(0).alias("__probe"), value.alias("__value"))
    w = Window.partitionBy(*key).orderBy("__at", "__probe").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = left.unionByName(right, allowMissingColumns=True).withColumn("__value", F.last("__value", ignorenulls=True).over(w))
    return both.where("__probe = 1").select(*probes.columns, *[F.col(f"__value.{c}").alias(c) for c in columns])


def as_of_or_first(probes: DataFrame, history: DataFrame, key: list[str], at: str, start: str, columns: list[str]) -> DataFrame:
    """As as_of_join, but before the first version the first one holds."""
    first = history.groupBy(*key).agg(F.min_by(F.struct(*columns), start).alias("__first"))
    found = as_of_join(probes, history.withColumn("__hit", F.lit(True)), key, at, start, [*columns, "__hit"])
    joined = found.join(first, key, "left")
    return joined.select(*probes.columns, *[F.when(F.col("__hit"), F.col(c)).otherwise(F.col(f"__first.{c}")).alias(c) for c in columns])


def version_changes(history: DataFrame, key: list[str], start: str, columns: list[str], after: str | Column | None = None, until: Column | None = None) -> DataFrame:
    """One row for each column that a version changes: key, start, field, before, after. The differences are taken before the time filter."""
    w = Window.partitionBy(*key).orderBy(start)
    marked = history.withColumn("__n", F.row_number().over(w)).withColumns({f"__{c}": F.lag(c).over(w) for c in columns})
    changes = F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"__{c}")), F.struct(F.lit(c).alias("field"), F.col(f"__{c}").cast("string").alias("before"), F.col(c).cast("string").alias("after"))) for c in columns])
    rows = marked.where("__n > 1")
    if after is not None:
        rows = rows.where(F.col(start) > (F.col(after) if isinstance(after, str) else after))
    if until is not None:
        rows = rows.where(F.col(start) <= until)
    return rows.select(*key, start, F.explode(F.filter(changes, lambda x: x.isNotNull())).alias("__x")).select(*key, start, "__x.*")


def interval_join(facts: DataFrame, intervals: DataFrame, key: list[str], at: str, start: str, end: str, how: str = "inner") -> DataFrame:
    """Facts with the intervals of their key that hold at their time; ``end`` is inclusive, null is open."""
    i = intervals.select(*[F.col(k).alias(f"__{k}") for k in key], *[c for c in intervals.columns if c not in key])
    on = [facts[k] == i[f"__{k}"] for k in key] + [i[start] <= facts[at], i[end].isNull() | (facts[at] <= i[end])]
    return facts.join(i, on, how).drop(*[f"__{k}" for k in key])


def modal(df: DataFrame, group: list[str], value: str, first: str | None = None) -> DataFrame:
    """The most frequent value of each group; of equals the one seen first, else the least."""
    counts = df.groupBy(*group, value).agg(F.count("*").alias("n"), F.min(first or value).alias("__first"))
    w = Window.partitionBy(*group).orderBy(F.col("n").desc(), "__first")
    return counts.withColumn("__r", F.row_number().over(w)).where("__r = 1").select(*group, value, "n")


def infer_retirements(history: DataFrame, presence: DataFrame, mentions: DataFrame, changes: DataFrame, horizon_days: int = 62) -> DataFrame:
    """Codes that vanish from full snapshots without a recorded end: code, effective, retired, last_seen, first_absent.

    history: code, valid_from, retired (last version's end or null). presence: code, file_date of full snapshots.
    mentions: code, file_date of any file. changes: file_date, change_date of the rows of full snapshots, with ``seq``
    for the order of appearance. The end is the day before the most frequent change date of the first snapshot without
    the code, if one lies after the last sighting and last version and within the horizon; else before that snapshot.
    """
    snaps = presence.select("file_date").distinct()
    after = snaps.withColumn("next", F.lead("file_date").over(Window.orderBy("file_date")))  # one row for each snapshot file
    last = presence.groupBy("code").agg(F.max("file_date").alias("last_seen"))
    any_ = mentions.groupBy("code").agg(F.max("file_date").alias("last_any"))
    final = history.groupBy("code").agg(F.max("valid_from").alias("last_from"), F.max_by("retired", "valid_from").alias("retired"))
    gone = (
        final.where("retired is null").join(last, "code").join(F.broadcast(after.select(F.col("file_date").alias("last_seen"), "next")), "last_seen")
        .where("next is not null").join(any_, "code").where("last_any <= next")
    )
    dates = changes.groupBy("file_date", "change_date").agg(F.count("*").alias("n"), F.min("seq").alias("seq"))
    options = gone.join(dates.withColumnRenamed("file_date", "next"), "next", "left")
    usable = (F.col("change_date") > F.greatest("last_seen", "last_from")) & (F.col("change_date") <= F.date_add("next", horizon_days))
    best = options.groupBy("code", "last_seen", "next", "last_from").agg(F.max_by("change_date", F.when(usable, F.struct("n", -F.col("seq")))).alias("mode"))
    return best.withColumn("effective", F.coalesce("mode", "next")).where("effective > last_from").select("code", "effective", F.date_sub("effective", 1).alias("retired"), "last_seen", F.col("next").alias("first_absent"))
