"""Change events of entities from listings in document order, in closed form over windows.

Listings: entity, eff (date), doc, product, category, category_no, price, kubun. A group is one (eff, doc) of an entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_groups(listing: DataFrame) -> DataFrame:
    """Adds t, the rank of the row's (eff, doc) among its entity's; missing dates come first."""
    w = Window.partitionBy("entity").orderBy(F.col("eff").asc_nulls_first(), "doc")
    return listing.withColumn("t", F.dense_rank().over(w))


def live_intervals(listing: DataFrame) -> DataFrame:
    """Each (entity, product, category, t) with t_end, the group that lists it anew or moves it away, moved: whether the
    product then stands in other categories of the same number, and next: that group with the categories there (t, eff,
    doc, categories). Rows without a number never move; of several numbers of a category the least counts.

    The groups are dealt by entity, and all that follows keeps to that partitioning.
    """
    rows = with_groups(listing).where("product is not null").groupBy("entity", "product", "category", "t").agg(F.min("category_no").alias("category_no"), F.min("eff").alias("eff"), F.min("doc").alias("doc"))
    groups = rows.groupBy("entity", "product", "category_no", "t").agg(F.min("eff").alias("eff"), F.min("doc").alias("doc"), F.collect_set("category").alias("categories"))
    later = F.lead(F.struct("t", "eff", "doc", "categories")).over(Window.partitionBy("entity", "product", "category_no").orderBy("t"))
    groups = groups.withColumn("next", F.when(F.col("category_no").isNotNull(), later))
    rows = groups.select("entity", "product", "category_no", "t", "eff", "doc", "next", F.explode("categories").alias("category"))
    rows = rows.withColumn("t_again", F.lead("t").over(Window.partitionBy("entity", "product", "category").orderBy("t")))
    moved = F.coalesce(F.col("next.t") < F.coalesce("t_again", F.lit(2**31 - 1)), F.lit(False))
    return rows.withColumn("moved", moved).withColumn("t_end", F.least("t_again", "next.t")).drop("t_again")


def category_moves(listing: DataFrame) -> DataFrame:
    """entity, product, from, to, t of each move, with the moving group's eff and doc."""
    gone = live_intervals(listing).where("moved").select("entity", "product", F.col("category").alias("from"), "next")
    return gone.select("entity", "product", "from", F.explode("next.categories").alias("to"), "next.t", "next.eff", "next.doc").distinct()


def move_counts(moves: DataFrame) -> DataFrame:
    return moves.groupBy("entity", "eff", "doc", "from", "to").agg(F.count("*").alias("n_products"))


def current_state(listing: DataFrame) -> DataFrame:
    """entity, product, category of the rows that no later group lists anew or moves, and of listings without a product
    that no later row of their number follows (product null).
    """
    rows = with_groups(listing)
    now = live_intervals(listing).where("t_end is null").select("entity", "product", "category", "category_no")
    last = rows.groupBy("entity", "category_no").agg(F.max("t").alias("last_t"))
    plain = rows.where("product is null").groupBy("entity", "category", "category_no").agg(F.max("t").alias("t"))
    stays = plain.join(last, plain["entity"].eqNullSafe(last["entity"]) & plain["category_no"].eqNullSafe(last["category_no"])).where("t >= last_t")
    return now.unionByName(stays.select(plain["entity"], F.lit(None).cast(now.schema["product"].dataType).alias("product"), "category", plain["category_no"]))


def before_state(listing: DataFrame) -> DataFrame:
    """The (entity, t, product, category) that hold just before each group: those of live intervals that began earlier and
    end at t or later. Groups are numbered without gaps, so an interval is spread over its groups without a join to them."""
    last = with_groups(listing).groupBy("entity").agg(F.max("t").alias("last_t"))
    live = live_intervals(listing).join(last, "entity").withColumn("until", F.coalesce("t_end", "last_t")).where("until > t")
    return live.select("entity", F.explode(F.sequence(F.col("t") + 1, F.col("until"))).alias("t"), "product", "category")


def first_seen(listing: DataFrame, by: list[str]) -> DataFrame:
    """entity, by, first group and its date and document."""
    return with_groups(listing).groupBy("entity", *by).agg(F.min("t").alias("t"), F.min_by("eff", "t").alias("eff"), F.min_by("doc", "t").alias("doc"))


def products_added(listing: DataFrame) -> DataFrame:
    """entity, eff, doc, n_new: products first seen in a group other than the entity's first."""
    new = first_seen(listing.where("product is not null"), ["product"]).where("t > 1")
    return new.groupBy("entity", "eff", "doc").agg(F.count("*").alias("n_new"))


def categories_added(listing: DataFrame) -> DataFrame:
    """entity, category, eff, doc of categories unseen before, neither in the first group nor the target of a move."""
    new = first_seen(listing, ["category"]).where("t > 1")
    targets = category_moves(listing).select("entity", F.col("to").alias("category"), "t").distinct()
    return new.join(targets, ["entity", "category", "t"], "left_anti")


def price_differences(listing: DataFrame, least: float = 0.5, explained: Column | None = None) -> DataFrame:
    """Prices that differ by ``least`` or more from the category's earlier group; ``explained`` rows don't count."""
    rows = with_groups(listing).groupBy("entity", "category", "t").agg(F.first("eff").alias("eff"), F.first("doc").alias("doc"), F.min_by("price", F.struct(F.col("product").isNotNull(), "product")).alias("price"))
    w = Window.partitionBy("entity", "category").orderBy("t")
    rows = rows.withColumn("price_before", F.lag("price").over(w)).where(F.abs(F.col("price") - F.col("price_before")) >= least)
    return rows if explained is None else rows.where(~F.coalesce(explained, F.lit(False)))


def class_changes(listing: DataFrame) -> DataFrame:
    """entity, t, added: classes unseen in earlier groups; "C?" is never seen. Not for groups with new products.

    A class is new where it stands for the first time, and something was seen before if the entity's first known class is
    older: two minima, without gathering what each group has seen.
    """
    rows = with_groups(listing).where("kubun is not null").groupBy("entity", "t", "kubun").agg(F.first("eff").alias("eff"), F.first("doc").alias("doc"))
    rows = rows.withColumn("first_t", F.min("t").over(Window.partitionBy("entity", "kubun"))).withColumn("known_t", F.min(F.when(F.col("kubun") != "C?", F.col("t"))).over(Window.partitionBy("entity")))
    new = rows.where((F.col("known_t") < F.col("t")) & ((F.col("kubun") == "C?") | (F.col("t") == F.col("first_t"))))
    found = new.groupBy("entity", "t").agg(F.min("eff").alias("eff"), F.min("doc").alias("doc"), F.array_sort(F.collect_set("kubun")).alias("added"))
    products = first_seen(listing.where("product is not null"), ["product"]).select("entity", "t").distinct()
    return found.join(products, ["entity", "t"], "left_anti")


def last_names(listing: DataFrame, column: str) -> DataFrame:
    """Groups whose last non-blank name differs from the one carried from before: entity, t, name, name_before."""
    groups = with_groups(listing).where(F.coalesce(F.col(column), F.lit("")) != "").groupBy("entity", "t").agg(F.max(column).alias("name"))
    w = Window.partitionBy("entity").orderBy("t")
    return groups.withColumn("name_before", F.lag("name").over(w)).where("name_before is not null and name != name_before")


def code_usage(listing: DataFrame) -> DataFrame:
    """entity, category: since and its document, last date and its document, classes, number of products."""
    place = F.struct(F.col("eff"), F.col("doc"))
    return listing.groupBy("entity", "category").agg(
        F.min("eff").alias("since"), F.min_by("doc", place).alias("since_doc"), F.max("eff").alias("until"), F.max_by("doc", place).alias("until_doc"),
        F.array_join(F.array_sort(F.collect_set("kubun")), "/").alias("kubuns"), F.count_distinct("product").alias("n_products"),
    )


def entity_summary(listing: DataFrame) -> DataFrame:
    place = F.struct("eff", "doc")
    return listing.groupBy("entity").agg(
        F.min("eff").alias("first_date"), F.max("eff").alias("last_date"), F.max_by("doc", place).alias("last_doc"),
        F.count_distinct("product").alias("n_products"), F.count_distinct("category").alias("n_categories"), F.array_join(F.array_sort(F.collect_set("kubun")), "/").alias("kubuns"),
    )


def correction_summary(lines: DataFrame) -> DataFrame:
    """entity, doc: products and categories taken out, put in and in both, from correction lines with side wrong/deleted or right/added."""
    old, new = F.col("side").isin("wrong", "deleted"), F.col("side").isin("right", "added")
    both = lines.groupBy("entity", "doc").agg(*[F.collect_set(F.when(s, F.col(c))).alias(f"{n}_{c}") for c in ("product", "category") for s, n in ((old, "old"), (new, "new"))])
    for c in ("product", "category"):
        both = both.withColumns({f"{c}_removed": F.array_sort(F.array_except(f"old_{c}", f"new_{c}")), f"{c}_added": F.array_sort(F.array_except(f"new_{c}", f"old_{c}")), f"{c}_kept": F.array_sort(F.array_intersect(f"old_{c}", f"new_{c}"))})
    return both.drop("old_product", "new_product", "old_category", "new_category")


#: Order of events of one day.
EVENT_ORDER = ("listing_new", "category_changed", "category_added", "products_added", "notice_price_diff", "price_revision", "category_renamed", "category_abolished", "correction")


def all_events(listing: DataFrame) -> DataFrame:
    """entity, event_date, doc, type, detail of the events that listings alone give, one row each."""
    event = lambda df, kind, detail: df.select("entity", F.col("eff").alias("event_date"), "doc", F.lit(kind).alias("type"), detail.cast("string").alias("detail"))
    first = with_groups(listing).where("t = 1").groupBy("entity").agg(F.min("eff").alias("eff"), F.min("doc").alias("doc"))
    out = event(first, "listing_new", F.lit(""))
    out = out.unionByName(event(move_counts(category_moves(listing)), "category_changed", F.concat_ws(" > ", "from", "to")))
    out = out.unionByName(event(categories_added(listing), "category_added", F.col("category")))
    out = out.unionByName(event(products_added(listing), "products_added", F.col("n_new")))
    out = out.unionByName(event(price_differences(listing), "notice_price_diff", F.col("category")))
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(EVENT_ORDER) for x in (k, i)])
    return out.withColumn("type_rank", rank[F.col("type")])


def quality_flags(conditions: dict[str, Column]) -> Column:
    """The labels whose condition holds, joined by ``;``."""
    return F.array_join(F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in conditions.items()]), lambda x: x.isNotNull()), ";")
