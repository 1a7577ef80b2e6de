"""From listings, corrections and master history to the tables of a history, in one declarative plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.operators import corrections, events, reports


def history_events(listing: DataFrame, master: DataFrame | None = None, corrected: DataFrame | None = None) -> DataFrame:
    """entity, event_date, doc, type, detail, type_rank, ordinal of all nine kinds, in the order of a report.

    master: entity, event_date, type, before, after of price revisions, renamings and abolitions. corrected: entity, doc,
    event_date and the text arrays of correction_summary.
    """
    out = events.all_events(listing).drop("type_rank")
    doc = out.schema["doc"].dataType
    if master is not None:
        out = out.unionByName(master.select("entity", "event_date", F.lit(None).cast(doc).alias("doc"), "type", F.concat_ws(" > ", "before", "after").alias("detail")))
    if corrected is not None:
        changes = F.concat_ws(" ", *[F.concat(F.lit(sign), F.array_join(F.col(c).cast("array<string>"), ",")) for sign, c in (("-", "category_removed"), ("+", "category_added"), ("-", "product_removed"), ("+", "product_added"))])
        out = out.unionByName(corrected.select("entity", "event_date", F.col("doc").cast(doc).alias("doc"), F.lit("correction").alias("type"), changes.alias("detail")))
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(events.EVENT_ORDER) for x in (k, i)])
    return reports.ordinal(out.withColumn("type_rank", rank[F.col("type")]), ["entity"], ["event_date", "type_rank", "doc", "detail"])


def build(base: DataFrame, deletes: DataFrame, adds: DataFrame, history: DataFrame, master: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables of a history: rows, events, usage, state, summary.

    base, deletes, adds: as for apply_corrections, with eff, price, category_no and kubun; a row's code is its product.
    history: code, valid_from, master_price. Rows have the master's price in force and whether it agrees.
    """
    rows = corrections.apply_corrections(base, deletes, adds)
    listing = rows.withColumns({"doc": F.col("target_doc"), "product": F.col("code")})
    checked = reports.price_verified(listing.withColumn("row_id", F.xxhash64("target_doc", "entity", "category", "code")), history)
    return {
        "rows": checked, "events": history_events(listing, master), "usage": events.code_usage(listing),
        "state": events.current_state(listing), "summary": events.entity_summary(listing),
    }
