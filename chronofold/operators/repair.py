"""Repair of misread identifiers against a dictionary: exact, context, vote, then blocked approximate matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.functions import text
from chronofold.operators.resolve import runner_up_gap, top_k


def _parts(column: str) -> Column:
    c = F.col(column)
    return F.array(F.substring(c, 1, 6), F.right(c, F.lit(6)), F.substring(c, 6, 6), F.substring(c, 3, 6), F.substring(c, 9, 6))


def _blocked(df: DataFrame, column: str) -> DataFrame:
    """One row for each of five overlapping parts of a number, with all of them; close numbers share at least one."""
    return df.withColumn(f"__{column}", _parts(column)).select("*", F.posexplode(f"__{column}").alias("__at", "__block"))



def _without(rows: DataFrame, found: DataFrame, by: list[str]) -> DataFrame:
    """Rows whose key isn't among the found ones; null parts of a key are equal."""
    keys = found.select(*[F.col(k).alias(f"__{k}") for k in by])
    return rows.join(keys, [rows[k].eqNullSafe(keys[f"__{k}"]) for k in by], "left_anti")


def _nearest(pairs: DataFrame, by: list[str], reach: float, gap: float) -> DataFrame:
    """by, known, score: each key's nearest number, if it is ahead of the next by ``gap``. Distances of ``reach`` + 1 are bounds, which never are too near."""
    scored = pairs.withColumn("score", text.weighted_distance(F.col("number"), F.col("known"), reach)).where(F.col("score") < reach + 1)
    return runner_up_gap(top_k(scored, by, [F.col("score"), F.col("known")], 2), by, gap)


def repair_numbers(read: DataFrame, dictionary: DataFrame, votes: DataFrame | None = None, limit: float = 2.0, gap: float = 0.6, page: list[str] | None = None) -> DataFrame:
    """number, page columns, repaired, how (exact, page, vote, fuzzy, none) for each different number read on a page.

    read: number, page columns, code (may be null), one row for each line. dictionary: number. votes: code, number pairs of
    the dictionary. page: the columns that together name one page of one document, if numbers should be sought there first.
    In order: exact; the nearest of the page's exact numbers, within ``limit`` or, with the same last eight characters,
    within 4.5; the number most often paired with the codes read beside it, if it leads and is within 6; the nearest of the
    dictionary within ``limit``. Near ones must be ahead of the next by ``gap``. Null numbers stay null.
    """
    by = ["number", *(page or [])]
    rest = read.select(*by).distinct()
    known = dictionary.select(F.col("number").alias("known")).distinct()
    same = lambda found, how: found.select(*by, F.col("known").alias("repaired"), F.lit(how).alias("how"))
    out = exact = same(rest.join(known, rest["number"] == known["known"]), "exact")
    rest = _without(rest, exact, by)
    if page:
        context = exact.select(F.col("repaired").alias("known"), *[F.col(c).alias(f"__{c}") for c in page])
        pairs = rest.join(context, [rest[c].eqNullSafe(context[f"__{c}"]) for c in page]).select(*by, "known")
        alike = F.right("number", F.lit(8)) == F.right("known", F.lit(8))
        found = same(_nearest(pairs, by, 4.5, gap).where((F.col("score") <= limit) | ((F.col("score") <= 4.5) & alike)), "page")
        out, rest = out.unionByName(found), _without(rest, found, by)
    if votes is not None:
        # Keys with the same codes beside them have the same ballots, which are counted once for all of them.
        lines = read.where("code is not null").groupBy(*by, "code").agg(F.count("*").alias("lines"))
        codes = lines.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("code", "lines"))).alias("__codes"))
        codes = codes.withColumn("__codes", F.when(F.size("__codes") > 1, F.col("__codes")).otherwise(F.array(F.struct(F.col("__codes")[0]["code"].alias("code"), F.lit(1).cast("bigint").alias("lines")))))
        beside = codes.select("__codes").distinct().withColumn("__c", F.explode("__codes")).select("__codes", "__c.*")
        ballots = beside.join(votes.select("code", F.col("number").alias("known")).distinct(), "code").groupBy("__codes", "known").agg(F.sum("lines").alias("n"))
        led = top_k(ballots, ["__codes"], [F.col("n").desc(), F.col("known")], 2).withColumn("second", F.lead("n").over(Window.partitionBy("__codes").orderBy("rank")))
        ahead = led.where("rank = 1 and (second is null or n > second)").select("__codes", "known")
        won = codes.join(ahead, "__codes").where(text.weighted_distance(F.col("number"), F.col("known"), 6.0) <= 6)
        open_ = rest.select(*[F.col(k).alias(f"__{k}") for k in by])
        found = same(won.join(open_, [won[k].eqNullSafe(open_[f"__{k}"]) for k in by], "left_semi"), "vote")
        out, rest = out.unionByName(found), _without(rest, found, by)
    reach = limit + 0.5
    # A pair that shares several parts is taken at the first of them.
    pairs = _blocked(rest.select("number").distinct(), "number").join(_blocked(known, "known"), ["__at", "__block"]).where(F.abs(F.length("number") - F.length("known")) <= reach)
    pairs = pairs.where(~F.exists(F.slice(F.arrays_zip("__number", "__known"), F.lit(1), F.col("__at")), lambda x: x["__number"] == x["__known"])).select("number", "known")
    near = _nearest(pairs, ["number"], reach, gap).where(F.col("score") <= limit).select("number", "known")
    found = same(rest.join(near, "number"), "fuzzy")
    none = _without(rest, found, by).select(*by, F.col("number").alias("repaired"), F.lit("none").alias("how"))
    return out.unionByName(found).unionByName(none)


def repair_codes(read: DataFrame, dictionary: DataFrame) -> DataFrame:
    """code, number, repaired, how. read and dictionary: number, code. In order: exact; leading zeros; one digit off within
    the number's codes; one digit off within the codes of the same seven first digits if the check digit is wrong; one
    confusable or missing digit that makes the check digit right, if that gives one code alone.
    """
    rows = read.select("number", "code").distinct()
    codes = dictionary.select(F.col("code").alias("known")).distinct()
    stage = [rows.join(codes, rows["code"] == codes["known"]).select("number", "code", F.col("known").alias("repaired"), F.lit("exact").alias("how"))]
    trimmed = codes.withColumn("bare", F.ltrim("known", F.lit("0")))
    stage.append(rows.withColumn("bare", F.ltrim("code", F.lit("0"))).join(trimmed, "bare").groupBy("number", "code").agg(F.min("known").alias("repaired")).withColumn("how", F.lit("zeros")))
    own = rows.join(dictionary.select("number", F.col("code").alias("known")).distinct(), "number").where(text.hamming_one(F.col("code"), F.col("known")))
    stage.append(own.groupBy("number", "code").agg(F.count_distinct("known").alias("n"), F.min("known").alias("repaired")).where("n = 1").select("number", "code", "repaired", F.lit("appr1").alias("how")))
    bad = rows.where(~text.gtin_ok(F.col("code"))).withColumn("prefix", F.substring("code", 1, 7))
    near = bad.join(codes.withColumn("prefix", F.substring("known", 1, 7)), "prefix").where(text.hamming_one(F.col("code"), F.col("known")))
    stage.append(near.groupBy("number", "code").agg(F.count_distinct("known").alias("n"), F.min("known").alias("repaired")).where("n = 1").select("number", "code", "repaired", F.lit("prefix1").alias("how")))
    fixes = bad.withColumn("fixes", text.digit_repairs(F.col("code"))).where(F.size("fixes") == 1)
    stage.append(fixes.select("number", "code", F.col("fixes")[0].alias("repaired"), F.lit("digit").alias("how")))
    stage.append(rows.select("number", "code", F.col("code").alias("repaired"), F.lit("none").alias("how")))
    every = None
    for n, s in enumerate(stage):
        s = s.select("number", "code", "repaired", "how", F.lit(n).alias("stage"))
        every = s if every is None else every.unionByName(s)
    return every.groupBy("number", "code").agg(F.min_by(F.struct("repaired", "how"), "stage").alias("x")).select("number", "code", "x.*")


def prefix_majority(rows: DataFrame, by: list[str], code: str = "code", length: int = 7, valid: str | None = None) -> DataFrame:
    """by, prefix, n: the most frequent code prefix of each group, the least of equals; of rows where ``valid`` is true, if given."""
    n = F.count("*") if valid is None else F.count_if(valid)
    counts = rows.groupBy(*by, F.substring(code, 1, length).alias("prefix")).agg(n.alias("n")).where("n > 0")
    return top_k(counts, by, [F.col("n").desc(), F.col("prefix")], 1).drop("rank")


def repair_by_prefix(rows: DataFrame, by: list[str], most: int = 2) -> DataFrame:
    """13-digit codes with a wrong check digit get their group's majority prefix, if at most ``most`` digits differ and the result is right."""
    checked = rows.withColumn("__ok", text.gtin_ok(F.col("code")))
    joined = checked.join(prefix_majority(checked, by, valid="__ok").drop("n"), by, "left").withColumn("__fixed", F.concat("prefix", F.substring("code", 8, 6)))
    differ = sum((F.when(F.substring("code", i, 1) == F.substring("prefix", i, 1), 0).otherwise(1) for i in range(1, 8)), F.lit(0))
    use = (F.length("code") == 13) & ~F.col("__ok") & F.col("prefix").isNotNull() & (differ <= most) & text.gtin_ok(F.col("__fixed"))
    return joined.withColumn("repaired", F.when(use, F.col("__fixed")).otherwise(F.col("code"))).drop("prefix", "__ok", "__fixed")


def structurally_valid(rows: DataFrame, least: int = 3) -> DataFrame:
    """Numbers of the right form in at least ``least`` documents."""
    return rows.where(text.is_approval(F.col("number"))).groupBy("number").agg(F.count_distinct("doc_id").alias("n_docs")).where(F.col("n_docs") >= least)


def enrich(rows: DataFrame, dictionary: DataFrame, key: str) -> DataFrame:
    """Product names only where blank; seller and maker from the dictionary, with what was read kept beside them."""
    d = dictionary.groupBy(key).agg(*[F.min(c).alias(f"__{c}") for c in ("product_name", "sales_name", "applicant")])
    joined = rows.join(d, key, "left")
    out = joined.withColumn("product_name", F.coalesce(F.nullif("product_name", F.lit("")), "__product_name"))
    for c in ("sales_name", "applicant"):
        out = out.withColumn(f"{c}_ocr", F.when(F.col(f"__{c}").isNotNull(), F.col(c))).withColumn(c, F.coalesce(f"__{c}", c))
    return out.drop("__product_name", "__sales_name", "__applicant")
