"""Entity resolution: blocked similarity joins, top-k and gaps, price and interval evidence."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.functions import text

#: Schedules that belong to each setting; fixed values.
SETTING_SCHEDULES = {"医科": ("2", "1", "8", "9", "3"), "歯科": ("5", "6", "7", "4", "9"), "調剤": ("8",)}


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= k)


def similar_by_name(rows: DataFrame, block: str, key: str, name: str, score: Callable[[Column, Column], Column], k: int) -> DataFrame:
    """key, candidate, score, rank: the k other keys of each key's block whose names are nearest, the least key of equals.

    A score is computed for pairs of different names only, and of each name its first k + 1 keys stand for all, since no
    key can have more than those among its nearest. So the work grows with the names of a block, not with its rows.
    """
    heads = top_k(rows.select(block, F.col(name).alias("__name"), F.col(key).alias("candidate")), [block, "__name"], [F.col("candidate")], k + 1).drop("rank")
    names = rows.select(block, name).distinct()
    pairs = names.join(heads.select(block, "__name").distinct(), block).withColumn("score", score(F.col(name), F.col("__name"))).where("score is not null")
    near = top_k(pairs.join(heads, [block, "__name"]).drop("__name"), [block, name], [F.col("score"), F.col("candidate")], k + 1).drop("rank")
    every = rows.select(block, key, name).join(near, [block, name]).where(F.col(key) != F.col("candidate"))
    return top_k(every.select(key, "candidate", "score"), [key], [F.col("score"), F.col("candidate")], k)


def runner_up_gap(ranked: DataFrame, by: list[str], least: float) -> DataFrame:
    """Rank-one rows whose score (smaller is better) is ahead of the second by ``least``, or that stand alone."""
    w = Window.partitionBy(*by).orderBy("rank")
    return ranked.withColumn("runner_up", F.lead("score").over(w)).where(F.col("rank") == 1).where(F.col("runner_up").isNull() | (F.col("runner_up") - F.col("score") >= least))


def category_candidates(listing: DataFrame, master: DataFrame, k: int = 8) -> DataFrame:
    """setting, category, code, schedule, score, rank. listing: setting, category. master: schedule, category_no, code, name.

    Candidates share the leading number of the category. A name scores its ratio to the category, equal names 1; codes
    of schedules outside the setting lose 0.05.
    """
    wanted = listing.select("setting", "category").distinct().withColumns({"category_no": text.category_no(F.col("category")), "target": text.norm_category("category")}).where("category_no is not null and target != ''")
    names = master.select("schedule", "category_no", "code", text.norm_master("name").alias("norm")).where("norm != ''").distinct()
    allowed = F.create_map(*[F.lit(x) if isinstance(x, str) else F.array(*map(F.lit, x)) for kv in SETTING_SCHEDULES.items() for x in kv])
    pairs = wanted.join(names, "category_no")
    fits = F.array_contains(F.coalesce(allowed[F.col("setting")], F.array()), F.col("schedule"))
    same = pairs.where("target = norm").withColumn("score", F.lit(1.0))
    other = pairs.where("target != norm").withColumn("score", text.sequence_ratio("target", "norm"))
    scored = same.unionByName(other).withColumn("score", F.col("score") - F.when(fits, 0.0).otherwise(0.05))
    best = scored.groupBy("setting", "category", "code").agg(F.max_by("schedule", "score").alias("schedule"), F.max("score").alias("score"))
    return top_k(best, ["setting", "category"], [F.col("score").desc(), F.col("code")], k)


def decide(candidates: DataFrame, by: list[str], accept: float = 0.75, close: float = 0.05, lone: float = 0.55) -> DataFrame:
    """The accepted candidate of each key. candidates: by, code, score, rank, price_ok.

    The best one from ``accept`` on, or rather the first within ``close`` of it whose price fits; below that the only
    one from ``lone`` on whose price fits; else none (code null, best score).
    """
    ok = F.col("price_ok") & (F.col("score") >= lone)
    c = candidates.groupBy(*by).agg(
        F.max("score").alias("best"), F.min_by("code", "rank").alias("first"), F.min_by(F.struct("code", "score"), F.when(ok, F.col("rank"))).alias("ok"), F.count_if(ok).alias("n_ok")
    )
    chosen = F.when(F.col("best") >= accept, F.when((F.col("n_ok") > 0) & (F.col("ok.score") >= F.col("best") - close), F.col("ok")).otherwise(F.struct(F.col("first").alias("code"), F.col("best").alias("score"))))
    chosen = chosen.when(F.col("n_ok") == 1, F.col("ok")).otherwise(F.struct(F.lit(None).cast(candidates.schema["code"].dataType).alias("code"), F.col("best").alias("score")))
    return c.select(*by, chosen.alias("x")).select(*by, "x.code", "x.score")


def price_matches(listing: DataFrame, prices: DataFrame, on: list[str]) -> DataFrame:
    """Listings with master codes of the same rounded price, also after up to three misread leading digits are dropped."""
    options = listing.withColumn("__options", F.arrays_zip(text.price_suffixes(F.col("price")).alias("p"))).select("*", F.posexplode("__options").alias("source", "__o")).drop("__options")
    keyed = options.withColumn("rounded", F.bround(F.col("__o.p"))).drop("__o")
    return keyed.join(prices.where("price != 0").select(*on, "code", F.bround("price").alias("rounded")), [*on, "rounded"])


def one_apart(a: DataFrame, b: DataFrame, on: list[str], x: str, y: str) -> DataFrame:
    """on, x, y: the different texts x of a and y of b in a block that have equal lengths and differ in exactly one character.

    Texts meet under what is left of them without one character, so each pair is made once, and no other pair is.
    """

    def left(df: DataFrame, name: str) -> DataFrame:
        c, n = F.col(name), F.length(name)
        rest = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(F.substring(c, F.lit(1), i - 1).alias("__head"), F.substring(c, i + 1, n).alias("__tail")))
        return df.select(*on, name).distinct().where(n > 0).select(*on, name, F.posexplode(rest).alias("__at", "__r")).select(*on, name, "__at", "__r.*")

    return left(a, x).join(left(b, y), [*on, "__at", "__head", "__tail"]).where(F.col(x) != F.col(y)).select(*on, x, y)


def one_digit_off(listing: DataFrame, prices: DataFrame, on: list[str], by: list[str]) -> DataFrame:
    """by, code where exactly one code of the block has a price that differs in one digit."""
    a = listing.select(*on, *by, text.price_digits(F.col("price")).alias("__p"))
    codes = prices.groupBy(*on, text.price_digits(F.col("price")).alias("__q")).agg(F.min("code").alias("__lo"), F.max("code").alias("__hi"))
    ends = [F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi")]  # one code alone is the least and the greatest
    near = one_apart(a, codes, on, "__p", "__q").join(codes, [*on, "__q"]).groupBy(*on, "__p").agg(*ends)
    return a.join(near, [*on, "__p"]).groupBy(*by).agg(*ends).where("__lo = __hi").select(*by, F.col("__lo").alias("code"))


def count_one_apart(rows: DataFrame, on: list[str], key: str, value: str) -> DataFrame:
    """key, n: how many different keys of the block have a value that differs from the key's in one character; keys without such
    a value are left out.

    A key that stands at one value counts there, and sums of counts are enough; pairs are made only with keys at several.
    """
    places = rows.select(*on, key, value).distinct()
    places = places.withColumn("__single", (F.count("*").over(Window.partitionBy(key)) == 1) & F.col(key).isNotNull())
    single, several = places.where("__single"), places.where("not __single")
    other = lambda df: df.select(*on, F.col(value).alias("__other"), F.col(key).alias("__code"))
    apart = one_apart(places, other(places), on, value, "__other")
    near = apart.join(other(single).groupBy(*on, "__other").agg(F.count("*").alias("n")), [*on, "__other"]).groupBy(*on, value).agg(F.sum("n").alias("n"))
    with_several = single.join(apart.join(other(several), [*on, "__other"]), [*on, value])
    of_several = several.join(apart, [*on, value]).join(other(places), [*on, "__other"])
    pairs = with_several.select(key, "__code").unionByName(of_several.select(key, "__code")).groupBy(key).agg(F.count_distinct("__code").alias("n"))
    return single.join(near, [*on, value]).select(key, "n").unionByName(pairs).groupBy(key).agg(F.sum("n").alias("n"))


def designated_first(rows: DataFrame, own_codes: DataFrame, foreign: DataFrame, alternatives: DataFrame) -> DataFrame:
    """rows: entity, eff, row_id, code. The entity's own code in force at eff goes first; a code that another entity owns is
    replaced by the best alternative (row_id, alternative, score) that nobody owns, or null.
    """
    own = rows.join(own_codes.select("entity", F.col("code").alias("own"), "start", "end"), "entity").where("start <= eff and (end is null or eff <= end)").groupBy("row_id").agg(F.min("own").alias("own"))
    free = alternatives.join(foreign.select(F.col("code").alias("alternative")).distinct(), "alternative", "left_anti").groupBy("row_id").agg(F.max_by("alternative", F.struct("score", "alternative")).alias("free"))
    owner = foreign.select(F.col("code"), F.col("entity").alias("owner"))
    out = rows.join(owner, "code", "left").join(own, "row_id", "left").join(free, "row_id", "left")
    code = F.when(F.col("own").isNotNull(), F.col("own")).when(F.col("owner").isNotNull() & (F.col("owner") != F.col("entity")), F.col("free")).otherwise(F.col("code"))
    return out.select("row_id", "entity", "eff", code.alias("code"))


def best_per_key(df: DataFrame, by: list[str], score: str, tie: str) -> DataFrame:
    return top_k(df, by, [F.col(score).desc(), F.col(tie)], 1).drop("rank")
