"""Registered queries of row rules, resolution checks, reports and the whole build, each with its SQL oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.functions import text
from chronofold.operators import build, corrections, diff, events, projections, repair, reports, resolve
from chronofold.plans.queries import CORRECTIONS, LISTING, MOVES, iso, listing, register, table
from chronofold.sources import local_documents

KINDS = "CASE o_orderpriority WHEN '1-URGENT' THEN 'notice' WHEN '2-HIGH' THEN 'correction' WHEN '3-MEDIUM' THEN 'replacement' WHEN '5-LOW' THEN 'amendment' END"
SIDES = "CASE o_orderstatus WHEN 'O' THEN 'added' WHEN 'F' THEN 'wrong' END"


@register(f"""WITH x AS (SELECT *, {KINDS} AS kind, {SIDES} AS side, CAST(o_orderdate AS DATE) AS d, CASE WHEN o_custkey % 3 > 0 THEN DATE '1996-01-01' + CAST(o_custkey % 900 AS INT) END AS retired FROM orders)
SELECT o_orderkey, coalesce(kind IN ('notice', 'replacement', 'amendment') AND coalesce(side, 'added') IN ('added', 'right'), false) AS feeds, retired IS NULL OR retired >= d AS in_force,
CASE WHEN CAST(o_custkey % 10 AS VARCHAR) IN ('4', '5', '6', '7') THEN '歯科' ELSE '医科' END AS setting, CASE WHEN o_totalprice BETWEEN 100000 / 2.5 AND 100000 * 2.5 THEN o_totalprice END AS plausible,
CASE WHEN o_custkey % 2 = 0 THEN '未解析' WHEN o_orderstatus = 'P' THEN 'OCR' WHEN o_orderstatus = 'F' THEN 'スキャン画像' ELSE '解析済' END AS status,
coalesce(nullif(kind, 'notice'), nullif(side, ''), '') AS address FROM x""")
def q54_row_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document kind and side, codes in force, settings, plausible prices, status and address."""
    o = table(spark, sf_dir, "orders").withColumns({"kind": F.expr(KINDS), "side": F.expr(SIDES), "d": F.to_date("o_orderdate")})
    o = o.withColumn("retired", F.when(F.col("o_custkey") % 3 > 0, F.date_add(F.lit("1996-01-01").cast("date"), (F.col("o_custkey") % 900).cast("int"))))
    return o.select(
        "o_orderkey", F.coalesce(projections.feeds_listing(F.col("kind"), F.col("side")), F.lit(False)).alias("feeds"), projections.in_force(F.col("retired"), F.col("d")).alias("in_force"),
        projections.setting_of((F.col("o_custkey") % 10).cast("string")).alias("setting"), projections.plausible_price(F.col("o_totalprice"), F.lit(100000)).alias("plausible"),
        projections.document_status(F.col("o_custkey") % 2 != 0, F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "P").alias("status"),
        projections.document_address(F.nullif(F.col("kind"), F.lit("notice")), F.col("side")).alias("address"),
    )


@register("""WITH x AS (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, '令和' || (year(d) - 2018) || '年' || month(d) || '月' || day(d) || '日' AS era, translate(lpad(CAST(o_custkey % 60 AS VARCHAR), 2, '0'), '0123456789', '０１２３４５６７８９') AS slot,
CASE WHEN o_custkey % 4 > 0 THEN '¥' || CASE WHEN p = floor(p) THEN format('{:,}', CAST(p AS BIGINT)) ELSE format('{:,.2f}', p) END || CASE WHEN o_custkey % 4 = 1 THEN '/1組' ELSE '' END ELSE '—' END AS price,
coalesce(nullif(ltrim(lpad(CAST(o_custkey % 100 AS VARCHAR), 3, '0'), '0'), ''), lpad(CAST(o_custkey % 100 AS VARCHAR), 3, '0')) AS schedule, lpad(CAST(o_custkey % 100 AS VARCHAR), 3, '0') AS class_no,
CASE WHEN o_custkey % 7 > 0 THEN CAST(d AS VARCHAR) END AS compact, CASE WHEN o_custkey % 2 = 0 THEN strftime(d, '%Y%m%d') ELSE '20' || strftime(d, '%y%m%d') END AS file_date, p + 1000 AS number
FROM (SELECT *, CASE WHEN o_custkey % 5 = 0 THEN floor(o_totalprice) ELSE o_totalprice END AS p FROM x)""")
def q55_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Era dates, slots, prices, schedule and class numbers, dates of files and compact fields, numbers with separators."""
    o = table(spark, sf_dir, "orders").withColumn("d", F.to_date("o_orderdate")).withColumn("p", F.when(F.col("o_custkey") % 5 == 0, F.floor("o_totalprice").cast("double")).otherwise(F.col("o_totalprice")))
    small = (F.col("o_custkey") % 100).cast("string")
    day = F.date_format("d", "yyyyMMdd")
    return o.select(
        "o_orderkey", text.era_text(F.col("d")).alias("era"), text.slot_label(F.col("o_custkey") % 60).alias("slot"),
        text.price_label(F.when(F.col("o_custkey") % 4 > 0, F.col("p")), F.when(F.col("o_custkey") % 4 == 1, "1組")).alias("price"),
        text.schedule_no(F.lpad(small, 3, "0")).alias("schedule"), text.class_no(small).alias("class_no"),
        text.compact_date(F.when(F.col("o_custkey") % 7 > 0, day).otherwise("99999999")).cast("string").alias("compact"),
        text.file_date(F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("t_ALL"), day, F.lit(".zip"))).otherwise(F.concat(F.lit("m"), F.date_format("d", "yyMMdd"), F.lit(".zip")))).alias("file_date"),
        text.number(F.regexp_replace(F.format_number(F.col("p") + 1000, 2), "\\.00$", "")).alias("number"),
    )


@register(f"""WITH {LISTING}, n AS (SELECT entity, t, max(nullif(kubun, 'F')) AS name FROM g GROUP BY ALL HAVING max(nullif(kubun, 'F')) IS NOT NULL UNION ALL SELECT entity + 10000000, t, max(category) FROM g GROUP BY ALL),
b AS (SELECT *, lag(name) OVER (PARTITION BY entity ORDER BY t) AS name_before FROM n) SELECT entity, t, name, name_before FROM b WHERE name_before IS NOT NULL AND name <> name_before""")
def q56_last_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listing(spark, sf_dir)
    blank = events.last_names(rows.withColumn("kubun", F.nullif("kubun", F.lit("F"))), "kubun")
    return blank.unionByName(events.last_names(rows.withColumn("entity", F.col("entity") + 10000000), "category"))


@register("SELECT o_orderkey, o_custkey AS target_doc, dense_rank() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) NULLS FIRST, o_orderkey % 3) AS step FROM orders")
def q57_correction_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("target_doc"), F.to_date("o_orderdate").alias("notice_date"), (F.col("o_orderkey") % 3).alias("seq"))
    return corrections.number_corrections(o).select("o_orderkey", "target_doc", "step")


PRICED = "a AS (SELECT p_partkey AS row_id, p_brand, 1000 + p_partkey * 7 % 3000 + CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE 0.5 END AS price FROM part), b AS (SELECT p_partkey AS code, p_brand, 5 + p_partkey * 13 % 4000 AS price FROM part)"


def priced(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p = table(spark, sf_dir, "part")
    half = F.when(F.col("p_partkey") % 2 == 0, 0.0).otherwise(0.5)
    return p.select(F.col("p_partkey").alias("row_id"), "p_brand", (1000 + F.col("p_partkey") * 7 % 3000 + half).alias("price")), p.select(F.col("p_partkey").alias("code"), "p_brand", (5 + F.col("p_partkey") * 13 % 4000).cast("double").alias("price"))


@register(f"""WITH {PRICED}, t AS (SELECT *, CASE WHEN price = floor(price) THEN CAST(CAST(price AS BIGINT) AS VARCHAR) ELSE CAST(CAST(price AS DOUBLE) AS VARCHAR) END AS s FROM a),
x AS (SELECT row_id, p_brand, substr(s, i + 1) AS tail, CAST(i AS INT) AS i FROM t, range(0, 4) r(i) WHERE regexp_matches(substr(s, CAST(i AS INT) + 1), '^[1-9]')),
k AS (SELECT row_id, p_brand, CAST(row_number() OVER (PARTITION BY row_id ORDER BY i) - 1 AS INT) AS source, round_even(CAST(tail AS DOUBLE), 0) AS rounded FROM x)
SELECT k.row_id, b.code, k.source FROM k JOIN b ON b.p_brand = k.p_brand AND round_even(CAST(b.price AS DOUBLE), 0) = k.rounded WHERE b.price <> 0""")
def q58_price_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = priced(spark, sf_dir)
    return resolve.price_matches(a, b, ["p_brand"]).select("row_id", "code", "source")


@register(f"""WITH {PRICED}, p AS (SELECT row_id, p_brand, CAST(CAST(floor(price) AS BIGINT) AS VARCHAR) AS s FROM a), q AS (SELECT code, p_brand, CAST(CAST(price AS BIGINT) AS VARCHAR) AS s FROM b)
SELECT p.row_id, min(q.code) AS code FROM p JOIN q ON p.p_brand = q.p_brand AND length(p.s) = length(q.s) AND hamming(p.s, q.s) = 1 GROUP BY p.row_id HAVING count(DISTINCT q.code) = 1""")
def q59_one_digit_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = priced(spark, sf_dir)
    return resolve.one_digit_off(a.withColumn("price", F.floor("price").cast("double")), b, ["p_brand"], ["row_id"])


@register("""SELECT c_nationkey, c_custkey, c_acctbal FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) = 1""")
def q60_best_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.best_per_key(table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_acctbal"), ["c_nationkey"], "c_acctbal", "c_custkey")


@register("""WITH d AS (SELECT o_custkey AS k, min(o_orderpriority) AS p, min(o_orderstatus) AS s, min(CAST(o_orderdate AS DATE)) AS a FROM orders WHERE o_custkey % 2 = 0 GROUP BY 1)
SELECT c_custkey, coalesce(nullif(CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END, ''), d.p) AS product_name, coalesce(d.s, c_mktsegment) AS sales_name, CASE WHEN d.s IS NOT NULL THEN c_mktsegment END AS sales_name_ocr,
coalesce(CAST(d.a AS VARCHAR), CAST(c_nationkey AS VARCHAR)) AS applicant, CASE WHEN d.a IS NOT NULL THEN CAST(c_nationkey AS VARCHAR) END AS applicant_ocr FROM customer LEFT JOIN d ON d.k = c_custkey""")
def q61_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_name")).alias("product_name"), F.col("c_mktsegment").alias("sales_name"), F.col("c_nationkey").cast("string").alias("applicant"))
    d = table(spark, sf_dir, "orders").where("o_custkey % 2 = 0").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("product_name"), F.col("o_orderstatus").alias("sales_name"), F.to_date("o_orderdate").cast("string").alias("applicant"))
    return repair.enrich(c, d, "c_custkey")


@register("""WITH s AS (SELECT o_custkey, o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders), f AS (SELECT o_custkey, o_orderkey, o_orderstatus FROM s WHERE n = 1)
SELECT 'first' AS part, o_custkey, o_orderkey, o_orderstatus FROM f
UNION ALL SELECT 'upserted', o_custkey, o_orderkey, o_orderstatus FROM f WHERE o_orderstatus <> 'O' UNION ALL SELECT 'upserted', o_custkey, o_orderkey, 'new' FROM f WHERE o_orderstatus = 'O'
UNION ALL SELECT 'absent', o_custkey, o_orderkey, o_orderstatus FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
UNION ALL SELECT DISTINCT 'keys', o_custkey, NULL, NULL FROM orders WHERE o_orderstatus <> 'F'""")
def q62_key_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row of each key, upsert, keys of one table that another lacks, union of key sets."""
    o = table(spark, sf_dir, "orders")
    first = diff.first_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderstatus")
    upserted = diff.upsert(first, first.where("o_orderstatus = 'O'").withColumn("o_orderstatus", F.lit("new")), ["o_custkey"])
    absent = diff.snapshot_only(o.select("o_custkey", "o_orderkey", "o_orderstatus"), o.where("o_orderstatus = 'P'"), "o_custkey")
    keys = reports.key_union([o.where("o_orderstatus = 'O'"), o.where("o_orderstatus = 'P'")], ["o_custkey"]).withColumns({"o_orderkey": F.lit(None).cast("bigint"), "o_orderstatus": F.lit(None).cast("string")})
    parts = {"first": first, "upserted": upserted, "absent": absent, "keys": keys}
    out = None
    for name, df in parts.items():
        df = df.select(F.lit(name).alias("part"), "o_custkey", "o_orderkey", "o_orderstatus")
        out = df if out is None else out.unionByName(df)
    return out


@register(f"""WITH {LISTING}, f AS (SELECT entity, product, min(t) AS t FROM g GROUP BY ALL), n AS (SELECT entity, t, count(*) AS n_new FROM f GROUP BY ALL)
SELECT g.entity, g.t, CAST(min(eff) AS VARCHAR) AS eff, min(doc) AS doc, array_to_string(list_sort(list_distinct(list(kubun))), '/') AS kubuns, count(DISTINCT product) AS n_products, coalesce(any_value(n_new), 0) AS n_new
FROM g LEFT JOIN n ON n.entity = g.entity AND n.t = g.t GROUP BY g.entity, g.t""")
def q63_notice_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.notice_groups(listing(spark, sf_dir)).withColumns(iso("eff"))


@register(f"WITH {MOVES} SELECT entity, category, count(DISTINCT product) AS n_products FROM v WHERE t_number IS NULL AND t_again IS NULL GROUP BY ALL")
def q64_category_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.category_sizes(events.current_state(listing(spark, sf_dir)))


@register("""SELECT 'status ' || o_orderstatus AS what, CAST(count(*) AS VARCHAR) AS value FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'first', CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) FROM orders UNION ALL SELECT 'last', CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) FROM orders
UNION ALL SELECT 'default', '2012-04-01'""")
def q65_status_and_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("d", F.to_date("o_orderdate"))
    status = reports.histogram(o, "o_orderstatus").select(F.concat(F.lit("status "), "o_orderstatus").alias("what"), F.col("n").cast("string").alias("value"))
    span = reports.date_span(o, "d").select(F.explode(F.create_map(F.lit("first"), F.col("first").cast("string"), F.lit("last"), F.col("last").cast("string"))).alias("what", "value"))
    empty = reports.date_span(o.where("o_orderkey < 0"), "d", "2012-04-01").select(F.lit("default").alias("what"), F.col("first").cast("string").alias("value"))
    return status.unionByName(span).unionByName(empty)


@register("SELECT o_orderkey AS doc_id, count(*) AS n_changes, CAST(min(CAST(l_shipdate AS DATE)) AS VARCHAR) AS first_effective FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def q66_changes_per_notice(spark: SparkSession, sf_dir: str) -> DataFrame:
    notices = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"))
    return reports.changes_per_notice(notices, table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.to_date("l_shipdate").alias("effective"))).withColumns(iso("first_effective"))


@register("""SELECT o_custkey, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE o_orderstatus END AS key, arg_min(o_totalprice, o_orderkey) AS o_totalprice, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority, count(*) AS n_rows FROM orders GROUP BY ALL""")
def q67_snapshot_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.coalesce(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")), F.col("o_orderpriority"))
    return reports.snapshot_state(table(spark, sf_dir, "orders"), "o_custkey", key, ["o_totalprice", "o_orderpriority"], "o_orderkey")


@register(f"""WITH {LISTING}, d AS (SELECT DISTINCT entity, category, product FROM l) SELECT entity, string_agg(category || ':' || product, ',' ORDER BY category, product) AS pairs FROM d GROUP BY 1""")
def q68_category_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.category_pairs(listing(spark, sf_dir))


@register(f"""WITH {MOVES}, c AS (SELECT entity, eff, doc, "from", "to", count(*) AS n_products FROM m GROUP BY ALL)
SELECT entity, CAST(eff AS VARCHAR) AS eff, doc, "from" AS from_category, "to" AS to_category, n_products, rank FROM (SELECT *, row_number() OVER (PARTITION BY entity, eff, doc ORDER BY n_products DESC, "from", "to") AS rank FROM c) WHERE rank <= 3""")
def q69_top_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = reports.top_moves(events.move_counts(events.category_moves(listing(spark, sf_dir))))
    return top.withColumnsRenamed({"from": "from_category", "to": "to_category"}).withColumns(iso("eff"))


@register("""WITH h AS (SELECT l_partkey AS code, CAST(l_shipdate AS DATE) AS valid_from, min(l_extendedprice) AS master_price FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL),
r AS (SELECT l_orderkey * 10 + l_linenumber AS row_id, l_partkey AS code, CAST(l_shipdate AS DATE) AS eff, l_extendedprice AS price FROM lineitem),
x AS (SELECT r.row_id, r.price, h.master_price FROM r ASOF LEFT JOIN h ON r.code = h.code AND h.valid_from <= r.eff)
SELECT row_id, master_price, coalesce(abs(master_price - price) < 0.5, false) AS verified FROM x""")
def q70_price_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").withColumn("d", F.to_date("l_shipdate"))
    history = l.where("l_linestatus = 'F'").groupBy(F.col("l_partkey").alias("code"), F.col("d").alias("valid_from")).agg(F.min("l_extendedprice").alias("master_price"))
    rows = l.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"), F.col("l_partkey").alias("code"), F.col("d").alias("eff"), F.col("l_extendedprice").alias("price"))
    return reports.price_verified(rows, history).select("row_id", "master_price", "verified")


@register(f"""WITH {LISTING}, d AS (SELECT DISTINCT c_custkey AS entity, c_custkey % 10 + 1 AS product FROM customer) SELECT entity, product FROM d WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.entity = d.entity AND l.product = d.product)""")
def q71_never_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Designated codes of an entity that no listing has; new documents and files are found the same way."""
    designated = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity"), (F.col("c_custkey") % 10 + 1).alias("product")).distinct()
    return reports.not_present(designated, listing(spark, sf_dir), ["entity", "product"])


@register("""WITH c AS (SELECT *, CASE WHEN l_quantity > 25 THEN l_returnflag ELSE '' END AS a, CASE WHEN l_tax > 0.04 THEN l_linestatus END AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, last_value(nullif(a, '') IGNORE NULLS) OVER w AS a, last_value(b IGNORE NULLS) OVER w AS b FROM c WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_tax ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q72_carried_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged cells and headings: blank cells take what stands above them in their table."""
    c = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax").alias("place"), F.when(F.col("l_quantity") > 25, F.col("l_returnflag")).otherwise("").alias("a"), F.when(F.col("l_tax") > 0.04, F.col("l_linestatus")).alias("b"))
    return reports.carry_down(c, ["l_orderkey"], "place", ["a", "b"]).drop("place")


SYSTEMS = """a AS (SELECT o_orderkey AS k, o_totalprice AS price, CAST(o_orderdate AS DATE) AS s, CASE WHEN o_custkey % 3 = 0 THEN CAST(o_orderdate AS DATE) + 100 END AS e FROM orders WHERE o_orderkey % 7 > 0),
b AS (SELECT o_orderkey AS k, o_totalprice + o_orderkey % 4 * 0.25 AS price, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 2 AS INT) AS s, CASE WHEN o_custkey % 4 < 2 THEN CAST(o_orderdate AS DATE) + 100 + CAST(o_orderkey % 3 * 200 AS INT) END AS e FROM orders WHERE o_orderkey % 5 > 0),
x AS (SELECT a.k AS ka, b.k AS kb, a.price AS pa, b.price AS pb, a.s AS sa, b.s AS sb, a.e AS ea, b.e AS eb FROM a FULL JOIN b ON a.k = b.k)"""


@register(f"""WITH {SYSTEMS} SELECT 'only_left' AS counter, count(*) AS n FROM x WHERE kb IS NULL UNION ALL SELECT 'only_right', count(*) FROM x WHERE ka IS NULL UNION ALL SELECT 'both', count(*) FROM x WHERE ka = kb
UNION ALL SELECT 'price_equal', count(*) FROM x WHERE abs(pa - pb) < 0.4 UNION ALL SELECT 'price_different', count(*) FROM x WHERE abs(pa - pb) >= 0.4 UNION ALL SELECT 'start_equal', count(*) FROM x WHERE sa = sb
UNION ALL SELECT 'end_left_only', count(*) FROM x WHERE ka = kb AND ea IS NOT NULL AND eb IS NULL UNION ALL SELECT 'end_right_only', count(*) FROM x WHERE ka = kb AND ea IS NULL AND eb IS NOT NULL
UNION ALL SELECT 'end_equal', count(*) FROM x WHERE ea = eb UNION ALL SELECT 'end_near', count(*) FROM x WHERE ea <> eb AND year(ea) = year(eb) UNION ALL SELECT 'end_different', count(*) FROM x WHERE year(ea) <> year(eb)""")
def q73_reconciled_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumns({"k": F.col("o_orderkey"), "d": F.to_date("o_orderdate")})
    a = o.where("k % 7 > 0").select("k", F.col("o_totalprice").alias("price"), F.col("d").alias("start"), F.when(F.col("o_custkey") % 3 == 0, F.date_add("d", 100)).alias("end"))
    b = o.where("k % 5 > 0").select("k", (F.col("o_totalprice") + F.col("k") % 4 * 0.25).alias("price"), F.date_add("d", (F.col("k") % 2).cast("int")).alias("start"), F.when(F.col("o_custkey") % 4 < 2, F.date_add("d", (100 + F.col("k") % 3 * 200).cast("int"))).alias("end"))
    return reports.reconcile_histories(a, b, ["k"], 0.4)


@register("""WITH f AS (SELECT DISTINCT CASE WHEN o_custkey % 2 = 0 THEN 't_all' ELSE 't_' END || strftime(o_orderdate, '%Y%m%d') AS file FROM orders) SELECT file FROM f WHERE contains(upper(file), 'ALL')""")
def q74_full_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "orders").select(F.concat(F.when(F.col("o_custkey") % 2 == 0, "t_all").otherwise("t_"), F.date_format("o_orderdate", "yyyyMMdd")).alias("file")).distinct()
    return reports.full_snapshots(files)


@register("""WITH r AS (SELECT p_partkey AS row_id, p_brand AS category_no, p_name AS name FROM part WHERE p_size % 2 = 0), n AS (SELECT p_brand AS category_no, p_partkey AS code, p_name AS label FROM part WHERE p_size % 2 = 1),
c AS (SELECT category_no, label, min(code) AS code FROM n GROUP BY ALL), x AS (SELECT row_id, code, 1 - levenshtein(name, label) / CAST(greatest(length(name), length(label)) AS DOUBLE) AS score FROM r JOIN c USING (category_no))
SELECT row_id, code, round(0.5 * score, 2) AS score FROM x WHERE score >= 0.45 QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY score DESC, code) = 1""")
def q75_name_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    rows = p.where("p_size % 2 = 0").select(F.col("p_partkey").alias("row_id"), F.col("p_brand").alias("category_no"), F.col("p_name").alias("name"))
    names = p.where("p_size % 2 = 1").select(F.col("p_brand").alias("category_no"), F.col("p_partkey").alias("code"), F.col("p_name").alias("label"))
    return reports.name_fallback(rows, names, lambda a, b: 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)).cast("double"))


BUILT = f"""{CORRECTIONS}, q AS (SELECT l_orderkey AS target_doc, l_partkey AS entity, l_returnflag AS category, l_suppkey AS code, CAST(o_orderdate AS DATE) AS eff, l_extendedprice AS price, l_linestatus AS kubun,
greatest(l_linenumber - 4, 0) AS birth FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
l AS (SELECT entity, target_doc AS doc, eff, code AS product, category, 'n' AS category_no, price, kubun FROM q WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.target_doc = q.target_doc AND d.entity = q.entity AND d.category = q.category AND d.step > q.birth AND (d.code IS NULL OR d.code = q.code))),
g AS (SELECT *, dense_rank() OVER (PARTITION BY entity ORDER BY eff NULLS FIRST, doc) AS t FROM l){MOVES[len(LISTING):]}"""


def built(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    l = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("eff")), F.col("l_orderkey") == F.col("o_orderkey"))
    row = [F.col("l_orderkey").alias("target_doc"), F.col("l_partkey").alias("entity"), F.col("l_returnflag").alias("category"), F.col("l_suppkey").alias("code"), F.col("l_linenumber").alias("seq"), "eff", F.lit("n").alias("category_no"), F.col("l_extendedprice").alias("price"), F.col("l_linestatus").alias("kubun")]
    from chronofold.plans.queries import correction_lines

    deletes = correction_lines(spark, sf_dir)[1]
    history = table(spark, sf_dir, "lineitem").where("l_linestatus = 'F'").groupBy(F.col("l_suppkey").alias("code"), F.to_date("l_shipdate").alias("valid_from")).agg(F.min("l_extendedprice").alias("master_price"))
    return build.build(l.where("l_linenumber <= 4").select(*row), deletes, l.where("l_linenumber > 4").select(*row, (F.col("l_linenumber") - 4).alias("step")), history)


@register(f"""WITH {BUILT}, f AS (SELECT entity, category, min(t) AS t FROM g GROUP BY ALL), p AS (SELECT entity, product, min(t) AS t FROM g GROUP BY ALL),
p0 AS (SELECT entity, category, t, product, min(price) AS price FROM g GROUP BY ALL), p1 AS (SELECT entity, category, t, arg_min(price, product) AS price FROM p0 GROUP BY ALL), p2 AS (SELECT *, lag(price) OVER (PARTITION BY entity, category ORDER BY t) AS before FROM p1)
SELECT entity, type, count(*) AS n FROM (SELECT DISTINCT entity, 'listing_new' AS type FROM g UNION ALL SELECT entity, 'category_changed' FROM (SELECT DISTINCT entity, eff, doc, "from", "to" FROM m)
UNION ALL SELECT entity, 'category_added' FROM f WHERE t > 1 AND NOT EXISTS (SELECT 1 FROM m WHERE m.entity = f.entity AND m."to" = f.category AND m.t = f.t)
UNION ALL SELECT entity, 'products_added' FROM (SELECT DISTINCT entity, t FROM p WHERE t > 1) UNION ALL SELECT entity, 'notice_price_diff' FROM p2 WHERE abs(price - before) >= 0.5) GROUP BY ALL""")
def q76_built_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of the whole build, after corrections, by entity and kind."""
    return built(spark, sf_dir)["events"].groupBy("entity", "type").agg(F.count("*").alias("n"))


@register(f"""WITH {BUILT}, h AS (SELECT l_suppkey AS code, CAST(l_shipdate AS DATE) AS valid_from, min(l_extendedprice) AS master_price FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL)
SELECT count(*) AS n, count(product) AS n_code, count(*) FILTER (WHERE abs(master_price - price) < 0.5) AS n_verified FROM l ASOF LEFT JOIN h ON l.product = h.code AND h.valid_from <= l.eff""")
def q77_built_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows of the whole build have a code, and a price that agrees with the master's in force."""
    return reports.match_rates(built(spark, sf_dir)["rows"]).select("n", "n_code", "n_verified")


@register("SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) NULLS FIRST, o_orderkey) AS ordinal, substr(o_orderpriority, 1, 4) AS short FROM orders WHERE o_orderpriority = '1-URGENT'")
def q78_final_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one key, as it is typed, in their final order with shortened labels."""
    o = reports.rows_of(table(spark, sf_dir, "orders").withColumn("d", F.to_date("o_orderdate")), "o_orderpriority", " 1-urgent ")
    return reports.ordinal(o, ["o_custkey"], ["d", "o_orderkey"]).select("o_custkey", "o_orderkey", "ordinal", reports.shortened(F.col("o_orderpriority"), 4).alias("short"))


def gtin13_sql(code: str) -> str:
    """Whether a code of 13 digits has the right check digit."""
    return f"((10 - list_sum([CAST(substr({code}, i, 1) AS INT) * CASE WHEN i % 2 = 0 THEN 3 ELSE 1 END FOR i IN range(1, 13)]) % 10) % 10 = CAST(substr({code}, 13, 1) AS INT))"


FIXES = "CASE o_orderkey % 4 WHEN 0 THEN 'exact' WHEN 1 THEN 'none' WHEN 2 THEN 'fuzzy' END"
NUMBERS = "CASE WHEN o_custkey % 3 = 0 THEN 'ABC' ELSE lpad(CAST(o_custkey % 1000 AS STRING), 3, '0') END || CASE WHEN o_custkey % 5 = 0 THEN ' aabzx' ELSE 'AABZX' END || lpad(CAST(o_orderkey AS STRING), CASE WHEN o_custkey % 7 = 0 THEN 4 ELSE 8 END, '0')"


@register(f"""WITH x AS (SELECT *, {FIXES} AS fix, upper(replace({NUMBERS}, ' ', '')) AS number, '490' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS read FROM orders)
SELECT o_orderkey, coalesce(fix IN ('exact', 'jan', 'fuzzy', 'page'), false) OR (length(number) >= 14 AND regexp_matches(substr(number, 1, 3), '[0-9]')) AS usable,
CASE WHEN fix = 'none' AND NOT {gtin13_sql("read")} THEN NULL ELSE read END AS code,
CASE WHEN o_custkey % 3 = 2 THEN 'c' || o_custkey ELSE replace(o_orderpriority, ' ', '') END AS category FROM x""")
def q79_usable_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and codes that may be used after repair, and keys of categories."""
    o = table(spark, sf_dir, "orders").withColumns({"fix": F.expr(FIXES), "number": F.expr(NUMBERS), "read": F.concat(F.lit("490"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0"))})
    known = F.when(F.col("o_custkey") % 3 == 2, F.concat(F.lit("c"), F.col("o_custkey").cast("string"))).when(F.col("o_custkey") % 3 == 0, "")
    return o.select(
        "o_orderkey", projections.usable_approval(F.col("number"), F.col("fix")).alias("usable"), projections.usable_code(F.col("read"), F.col("fix")).alias("code"),
        projections.category_key(known, F.concat(F.lit("  "), "o_orderpriority", F.lit(" "))).alias("category"),
    )


@register(f"""WITH x AS (SELECT l_orderkey, l_linenumber, l_suppkey, lpad(CAST(l_suppkey * 37 + 4000000 AS VARCHAR), 7, '0') || lpad(CAST(l_partkey % 100000 AS VARCHAR), 5, '0') AS body FROM lineitem),
y AS (SELECT *, body || CAST((10 - list_sum([CAST(substr(body, i, 1) AS INT) * CASE WHEN i % 2 = 0 THEN 3 ELSE 1 END FOR i IN range(1, 13)]) % 10) % 10 AS VARCHAR) AS good FROM x),
z AS (SELECT *, list_aggregate([CASE WHEN (l_linenumber = 3 AND i = 3) OR (l_linenumber = 4 AND i IN (3, 5, 7)) OR (l_linenumber = 5 AND i = 10) THEN CAST((CAST(substr(good, i, 1) AS INT) + 1) % 10 AS VARCHAR) ELSE substr(good, i, 1) END FOR i IN range(1, 14)], 'string_agg', '') AS code FROM y),
p AS (SELECT l_suppkey, substr(code, 1, 7) AS prefix FROM z WHERE {gtin13_sql("code")} GROUP BY l_suppkey, substr(code, 1, 7) QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, substr(code, 1, 7)) = 1),
f AS (SELECT z.*, prefix || substr(code, 8, 6) AS fixed FROM z LEFT JOIN p USING (l_suppkey))
SELECT l_orderkey, l_linenumber, code, CASE WHEN NOT {gtin13_sql("code")} AND fixed IS NOT NULL AND {gtin13_sql("fixed")} AND list_sum([CASE WHEN substr(code, i, 1) = substr(fixed, i, 1) THEN 0 ELSE 1 END FOR i IN range(1, 14)]) <= 2 THEN fixed ELSE code END AS repaired FROM f""")
def q80_prefix_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes misread in one place or three of their prefix, or behind it, against the majority prefix of their group."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.expr("lpad(CAST(l_suppkey * 37 + 4000000 AS STRING), 7, '0') || lpad(CAST(l_partkey % 100000 AS STRING), 5, '0')").alias("body"))
    check = "(10 - (" + " + ".join(f"CAST(substring(body, {i}, 1) AS INT) * {1 if i % 2 else 3}" for i in range(1, 13)) + ") % 10) % 10"
    good = lines.withColumn("good", F.concat("body", F.expr(check).cast("string")))
    misread = {3: (3,), 4: (3, 5, 7), 5: (10,)}
    code = F.col("good")
    for line, places in misread.items():
        digits = [((F.substring("good", i, 1).cast("int") + 1) % 10).cast("string") if i in places else F.substring("good", i, 1) for i in range(1, 14)]
        code = F.when(F.col("l_linenumber") == line, F.concat(*digits)).otherwise(code)
    read = good.withColumn("code", code)
    return repair.repair_by_prefix(read, ["l_suppkey"]).select("l_orderkey", "l_linenumber", "code", "repaired")


@register("""SELECT CASE WHEN l_partkey % 4 = 0 THEN 'ABC' ELSE lpad(CAST(l_suppkey % 1000 AS VARCHAR), 3, '0') END || 'AABZX' || lpad(CAST(l_partkey % 50 AS VARCHAR), 8, '0') AS number, count(DISTINCT l_orderkey) AS n_docs
FROM lineitem WHERE l_partkey % 4 <> 0 GROUP BY 1 HAVING count(DISTINCT l_orderkey) >= 3""")
def q81_structurally_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of the right form that stand in three documents or more."""
    number = F.expr("CASE WHEN l_partkey % 4 = 0 THEN 'ABC' ELSE lpad(CAST(l_suppkey % 1000 AS STRING), 3, '0') END || 'AABZX' || lpad(CAST(l_partkey % 50 AS STRING), 8, '0')")
    return repair.structurally_valid(table(spark, sf_dir, "lineitem").select(number.alias("number"), F.col("l_orderkey").alias("doc_id")))


@register()
def q82_page_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repairs with the exact numbers of the same page, the codes beside them and the dictionary; weighted edit distance has no
    SQL form, and a sequential model is in the tests. Each order is a page with the numbers of its parts."""
    number = F.expr("'2' || lpad(CAST(p_partkey * 37 % 10000 AS STRING), 4, '0') || 'BZX' || lpad(CAST(p_partkey * 101 % 100000 AS STRING), 5, '0') || '000'")
    known = table(spark, sf_dir, "part").select("p_partkey", number.alias("known"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").cast("string").alias("code"))
    misread = F.when(F.col("l_linenumber") > 1, F.concat(F.substring("known", 1, 8), F.translate(F.substring("known", 9, 2), "058", "OSB"), F.substring("known", 11, 6))).otherwise(F.col("known"))
    read = lines.join(known, "p_partkey").select(misread.alias("number"), "l_orderkey", F.when(F.col("l_linenumber") > 2, F.col("code")).alias("code"))
    votes = lines.join(known, "p_partkey").where("l_linenumber = 3").select("code", F.col("known").alias("number"))
    return repair.repair_numbers(read, known.select(F.col("known").alias("number")), votes, page=["l_orderkey"])


@register("""WITH x AS (SELECT o_orderkey, CAST(o_custkey % 100 AS VARCHAR) AS no, CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderstatus = 'F' THEN 'correction' WHEN o_orderstatus = 'P' THEN 'amendment' ELSE 'notice' END AS kind, o_orderpriority AS p FROM orders)
SELECT o_orderkey, CASE WHEN p <> '5-LOW' THEN 'local_' || strftime(d, '%Y%m%d') || '_' || kind || '_' || no END AS doc_id, CASE WHEN p <> '5-LOW' THEN kind END AS kind,
CASE WHEN p <> '5-LOW' THEN CAST(d AS VARCHAR) END AS notice_date, CASE WHEN p <> '5-LOW' AND p <> '1-URGENT' THEN CAST(d + 30 AS VARCHAR) END AS effective_date FROM x""")
def q83_covers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the covers of documents say that no index lists yet."""
    era = "'平成' || CAST(year({0}) - 1988 AS STRING) || '年 ' || CAST(month({0}) AS STRING) || '月' || CAST(day({0}) AS STRING) || '日'"
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.to_date("o_orderdate").alias("d")).withColumn("since", F.expr("date_add(d, 30)"))
    base = "機器の適用について"
    cover = F.concat(
        F.lit("保 医 発0930第"), (F.col("o_custkey") % 100).cast("string"), F.lit("号\n"), F.expr(era.format("d")), F.lit("\n"), F.when(F.col("o_orderpriority") != "5-LOW", F.lit(base)).otherwise(F.lit("機器")),
        F.when(F.col("o_orderstatus") == "F", "の一部訂正").when(F.col("o_orderstatus") == "P", "の一部改正").otherwise(""), F.when(F.col("o_orderpriority") != "1-URGENT", F.concat(F.lit("\n標記は"), F.expr(era.format("since")), F.lit("から適用"))).otherwise(""),
    )
    c = F.col("cover")
    return o.withColumn("cover", text.cover(cover, base)).select("o_orderkey", c["doc_id"].alias("doc_id"), c["kind"].alias("kind"), c["notice_date"].cast("string").alias("notice_date"), c["effective_date"].cast("string").alias("effective_date"))


@register("""WITH x AS (SELECT 'local_' || o_orderkey AS doc_id, o_orderstatus <> 'P' AS listed, o_orderpriority < '3' AS kept, o_orderpriority > '2' AND o_orderpriority < '5' AS shown FROM orders)
SELECT doc_id, CASE WHEN listed AND kept AND NOT shown THEN 'publish' WHEN listed AND shown AND NOT kept THEN 'restore' WHEN shown AND NOT listed THEN 'remove' END AS action FROM x
WHERE (listed AND kept <> shown) OR (shown AND NOT listed)""")
def q84_copies_wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What keeps two folders of local documents and the manifest alike."""
    o = table(spark, sf_dir, "orders").withColumn("doc_id", F.concat(F.lit("local_"), F.col("o_orderkey").cast("string")))
    return local_documents.copies_wanted(o.where("o_orderstatus <> 'P'"), o.where("o_orderpriority < '3'"), o.where("o_orderpriority > '2' and o_orderpriority < '5'"))


@register("""WITH m AS (SELECT CASE WHEN o_orderstatus = 'O' THEN 'local_' ELSE '' END || o_orderkey AS doc_id, CASE WHEN o_orderpriority = '1-URGENT' THEN 'correction' ELSE 'notice' END AS kind, CAST(o_orderdate AS VARCHAR)[1:10] AS notice_date, CAST(o_custkey % 3 AS VARCHAR) AS effective_date FROM orders),
k AS (SELECT *, CASE WHEN kind = 'notice' THEN effective_date END AS e FROM m)
SELECT * EXCLUDE (e) FROM k WHERE doc_id NOT LIKE 'local_%'
UNION ALL SELECT * EXCLUDE (e) FROM k WHERE doc_id LIKE 'local_%' AND NOT EXISTS (SELECT 1 FROM k AS b WHERE b.doc_id NOT LIKE 'local_%' AND b.kind = k.kind AND b.notice_date = k.notice_date AND b.e IS NOT DISTINCT FROM k.e)""")
def q85_registered_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest with the local documents that no listed one stands for."""
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "correction").otherwise("notice")
    o = table(spark, sf_dir, "orders").select(
        F.concat(F.when(F.col("o_orderstatus") == "O", "local_").otherwise(""), F.col("o_orderkey").cast("string")).alias("doc_id"), kind.alias("kind"), F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("notice_date"), (F.col("o_custkey") % 3).cast("string").alias("effective_date")
    )
    return local_documents.register(o.where("doc_id not like 'local\\_%'"), o.where("doc_id like 'local\\_%'"))
