"""Registered queries of the history operators over the driver's tables, each with its SQL oracle.

Roles: a listing is lineitem with its order (entity = part, document = order, product = supplier, category = return flag
and line status, its number = return flag, class = line status). Deltas are events of a user, history are orders of a
customer, snapshots are the days of events.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronofold.functions import text
from chronofold.operators import corrections, diff, events, repair, resolve, successors, temporal, usage
from chronofold.sources import readers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    l, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return l.join(o, l["l_orderkey"] == o["o_orderkey"]).select(
        F.col("l_partkey").alias("entity"), F.col("o_orderkey").alias("doc"), F.to_date("o_orderdate").alias("eff"), F.col("l_suppkey").alias("product"),
        F.concat("l_returnflag", "l_linestatus").alias("category"), F.col("l_returnflag").alias("category_no"), F.col("l_extendedprice").alias("price"), F.col("l_linestatus").alias("kubun"),
    )


def iso(*columns: str) -> dict:
    return {c: F.col(c).cast("string") for c in columns}


LISTING = """l AS (
  SELECT l_partkey AS entity, o_orderkey AS doc, CAST(o_orderdate AS DATE) AS eff, l_suppkey AS product, l_returnflag || l_linestatus AS category,
         l_returnflag AS category_no, l_extendedprice AS price, l_linestatus AS kubun
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), g AS (SELECT *, dense_rank() OVER (PARTITION BY entity ORDER BY eff NULLS FIRST, doc) AS t FROM l)"""
MOVES = LISTING + """, r AS (SELECT DISTINCT entity, product, category, category_no, t, eff, doc FROM g),
n AS (SELECT *, lead(t) OVER (PARTITION BY entity, product, category_no ORDER BY t) AS t_number FROM (SELECT DISTINCT entity, product, category_no, t FROM r)),
v AS (SELECT r.*, n.t_number, lead(r.t) OVER (PARTITION BY r.entity, r.product, r.category ORDER BY r.t) AS t_again FROM r JOIN n USING (entity, product, category_no, t)),
m AS (SELECT DISTINCT v.entity, v.product, v.category AS "from", w.category AS "to", w.t, w.eff, w.doc
      FROM v JOIN r w ON v.entity = w.entity AND v.product = w.product AND v.category_no = w.category_no AND w.t = v.t_number
      WHERE v.t_number < coalesce(v.t_again, 2147483647))"""


@register("""
WITH h AS (SELECT user_id, ts, arg_max(value, event_id) AS value FROM events WHERE event_type = 'purchase' GROUP BY ALL)
SELECT e.event_id, h.value AS price FROM events e ASOF LEFT JOIN h ON e.user_id = h.user_id AND h.ts <= e.ts WHERE e.event_type <> 'purchase'""")
def q01_asof_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    history = e.where("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max_by("value", "event_id").alias("price"))
    return temporal.as_of_join(e.where("event_type <> 'purchase'").select("event_id", "user_id", "ts"), history, ["user_id"], "ts", "ts", ["price"]).select("event_id", "price")


DELTAS = """d AS (SELECT user_id, CAST(ts AS DATE) AS valid_from, ts, event_id, CASE WHEN event_type <> 'error' THEN value END AS amount, nullif(event_type, 'view') AS kind FROM events),
f AS (SELECT user_id, valid_from, ts, event_id, last_value(amount IGNORE NULLS) OVER w AS amount, last_value(kind IGNORE NULLS) OVER w AS kind FROM d
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
s AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY user_id, valid_from ORDER BY ts DESC, event_id DESC) = 1),
c AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY valid_from) = 1
      OR amount IS DISTINCT FROM lag(amount) OVER (PARTITION BY user_id ORDER BY valid_from) OR kind IS DISTINCT FROM lag(kind) OVER (PARTITION BY user_id ORDER BY valid_from)),
h AS (SELECT user_id, valid_from, amount, kind, lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) AS valid_to FROM c)"""


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumns({"valid_from": F.to_date("ts"), "amount": F.when(F.col("event_type") != "error", F.col("value")), "kind": F.nullif("event_type", F.lit("view"))})
    return temporal.build_history(e, ["user_id"], "valid_from", ["ts", "event_id"], ["amount", "kind"])


@register(f"WITH {DELTAS} SELECT user_id, CAST(valid_from AS VARCHAR) AS valid_from, amount, kind, CAST(valid_to AS VARCHAR) AS valid_to FROM h")
def q02_scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history(spark, sf_dir).withColumns(iso("valid_from", "valid_to"))


@register("SELECT event_id, user_id, event_type FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id) QUALIFY row_number() OVER w = 1 OR event_type IS DISTINCT FROM lag(event_type) OVER w")
def q03_run_length_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.collapse_runs(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], ["event_type"]).select("event_id", "user_id", "event_type")


ORDERS = "o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, arg_max(o_totalprice, o_orderkey) AS price, arg_max(o_orderpriority, o_orderkey) AS priority FROM orders GROUP BY ALL)"


def order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_custkey", F.to_date("o_orderdate").alias("d")).agg(F.max_by("o_totalprice", "o_orderkey").alias("price"), F.max_by("o_orderpriority", "o_orderkey").alias("priority"))


@register(f"""WITH {ORDERS}, x AS (SELECT *, lag(price) OVER w AS p0, lag(priority) OVER w AS q0, row_number() OVER w AS n FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY d))
SELECT o_custkey, CAST(d AS VARCHAR) AS d, 'priority' AS field, q0 AS before, priority AS after FROM x WHERE n > 1 AND d > DATE '1995-01-01' AND d <= DATE '1998-01-01' AND priority IS DISTINCT FROM q0
UNION ALL SELECT o_custkey, CAST(d AS VARCHAR), 'price', CAST(CAST(round(p0 * 100) AS BIGINT) AS VARCHAR), CAST(CAST(round(price * 100) AS BIGINT) AS VARCHAR) FROM x
WHERE n > 1 AND d > DATE '1995-01-01' AND d <= DATE '1998-01-01' AND price IS DISTINCT FROM p0""")
def q04_price_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = order_history(spark, sf_dir).withColumn("price", F.round(F.col("price") * 100).cast("bigint"))
    return temporal.version_changes(h, ["o_custkey"], "d", ["price", "priority"], F.lit("1995-01-01").cast("date"), F.lit("1998-01-01").cast("date")).withColumns(iso("d"))


@register(f'WITH {MOVES} SELECT entity, CAST(eff AS VARCHAR) AS eff, doc, "from" AS from_category, "to" AS to_category, count(*) AS n_products FROM m GROUP BY ALL')
def q05_category_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.move_counts(events.category_moves(listing(spark, sf_dir))).select("entity", F.col("eff").cast("string").alias("eff"), "doc", F.col("from").alias("from_category"), F.col("to").alias("to_category"), "n_products")


@register(f"WITH {MOVES} SELECT entity, product, category, category_no FROM v WHERE t_number IS NULL AND t_again IS NULL")
def q06_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.current_state(listing(spark, sf_dir)).select("entity", "product", "category", "category_no")


@register(f"""WITH {LISTING} SELECT entity, category, min(t) AS t, CAST(min(eff) AS VARCHAR) AS eff, arg_min(doc, t) AS doc FROM g GROUP BY entity, category""")
def q07_first_seen_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.first_seen(listing(spark, sf_dir), ["category"]).withColumns(iso("eff"))


@register(f"""WITH {LISTING}, f AS (SELECT entity, product, min(t) AS t, arg_min(eff, t) AS eff, arg_min(doc, t) AS doc FROM g GROUP BY ALL)
SELECT entity, CAST(eff AS VARCHAR) AS eff, doc, count(*) AS n_new FROM f WHERE t > 1 GROUP BY ALL""")
def q08_products_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.products_added(listing(spark, sf_dir)).withColumns(iso("eff"))


@register(f"""WITH {LISTING}, p0 AS (SELECT entity, category, t, product, min(eff) AS eff, min(doc) AS doc, min(price) AS price FROM g GROUP BY ALL),
p AS (SELECT entity, category, t, min(eff) AS eff, min(doc) AS doc, arg_min(price, product) AS price FROM p0 GROUP BY ALL),
x AS (SELECT *, lag(price) OVER (PARTITION BY entity, category ORDER BY t) AS price_before FROM p)
SELECT entity, category, t, CAST(eff AS VARCHAR) AS eff, doc, price, price_before FROM x WHERE abs(price - price_before) >= 0.5""")
def q09_price_diff_vs_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listing(spark, sf_dir).groupBy("entity", "category", "category_no", "doc", "eff", "product").agg(F.min("price").alias("price"))
    return events.price_differences(rows).withColumns(iso("eff"))


CORRECTIONS = """b AS (SELECT l_orderkey AS target_doc, l_partkey AS entity, l_returnflag AS category, l_suppkey AS code, l_linenumber AS seq, 0 AS birth FROM lineitem WHERE l_linenumber <= 4),
x AS (SELECT *, l_linenumber - 4 AS step FROM lineitem WHERE l_linenumber > 4),
a AS (SELECT l_orderkey AS target_doc, l_partkey AS entity, l_returnflag AS category, l_suppkey AS code, l_linenumber AS seq, step AS birth FROM x),
d AS (SELECT l_orderkey AS target_doc, k.l_partkey AS entity, k.l_returnflag AS category, CASE WHEN x.l_quantity > 25 THEN k.l_suppkey END AS code, x.step FROM x JOIN lineitem k USING (l_orderkey) WHERE k.l_linenumber = x.l_linenumber - 4)"""


def correction_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    l = table(spark, sf_dir, "lineitem")
    row = [F.col("l_orderkey").alias("target_doc"), F.col("l_partkey").alias("entity"), F.col("l_returnflag").alias("category"), F.col("l_suppkey").alias("code"), F.col("l_linenumber").alias("seq")]
    base, x = l.where("l_linenumber <= 4").select(*row), l.where("l_linenumber > 4").withColumn("step", F.col("l_linenumber") - 4)
    k = l.select(F.col("l_orderkey").alias("target_doc"), F.col("l_partkey").alias("entity"), F.col("l_returnflag").alias("category"), F.col("l_suppkey").alias("k_code"), F.col("l_linenumber").alias("step"))
    deletes = x.select(F.col("l_orderkey").alias("target_doc"), "step", "l_quantity").join(k, ["target_doc", "step"]).withColumn("code", F.when(F.col("l_quantity") > 25, F.col("k_code")))
    return base, deletes.select("target_doc", "entity", "category", "code", "step"), x.select(*row, "step")


@register(f"""WITH {CORRECTIONS}, r AS (SELECT *, 0 AS corrected FROM b UNION ALL SELECT *, 1 FROM a)
SELECT target_doc, entity, category, code, seq, corrected FROM r WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.target_doc = r.target_doc AND d.entity = r.entity AND d.category = r.category
AND d.step > r.birth AND (d.code IS NULL OR d.code = r.code))""")
def q10_corrections_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, deletes, adds = correction_lines(spark, sf_dir)
    return corrections.apply_corrections(base, deletes, adds).select("target_doc", "entity", "category", "code", "seq", "corrected")


@register("""WITH t AS (SELECT CAST(o_orderdate AS DATE) AS d, min(o_orderkey) AS target FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
r AS (SELECT DISTINCT t.target FROM orders o JOIN t ON t.d = CAST(o.o_orderdate AS DATE) WHERE o.o_orderstatus = 'P')
SELECT o_orderkey AS doc_id, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT target FROM r)""")
def q11_replacement_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumns({"doc_id": F.col("o_orderkey"), "seq": F.col("o_orderkey"), "notice_date": F.to_date("o_orderdate"), "ref_notice_date": F.to_date("o_orderdate")})
    named = corrections.resolve_targets(o.where("o_orderstatus = 'P'").select("ref_notice_date"), o.where("o_orderstatus <> 'P'"))
    return corrections.drop_replaced(o, named).select("doc_id", "o_custkey")


@register("""WITH f AS (SELECT DISTINCT user_id AS code, CAST(ts AS DATE) AS fd FROM events), s AS (SELECT fd, lead(fd) OVER (ORDER BY fd) AS nxt FROM (SELECT DISTINCT fd FROM f)),
h AS (SELECT user_id AS code, min(CAST(ts AS DATE)) AS first_date FROM events GROUP BY 1),
p AS (SELECT code, max(fd) AS last_seen FROM f GROUP BY 1),
c AS (SELECT CAST(ts AS DATE) AS fd, CAST(ts AS DATE) AS cd, count(*) AS n, min(event_id) AS seq FROM events GROUP BY ALL),
z AS (SELECT p.code, p.last_seen, s.nxt, h.first_date FROM p JOIN s ON s.fd = p.last_seen JOIN h USING (code) WHERE s.nxt IS NOT NULL),
m AS (SELECT z.code, arg_max(c.cd, c.n * 1000000000 - c.seq) AS mode FROM z JOIN c ON c.fd = z.nxt AND c.cd > greatest(z.last_seen, z.first_date) AND c.cd <= z.nxt + 62 GROUP BY 1)
SELECT code, CAST(coalesce(mode, nxt) AS VARCHAR) AS effective, CAST(coalesce(mode, nxt) - 1 AS VARCHAR) AS retired, CAST(last_seen AS VARCHAR) AS last_seen, CAST(nxt AS VARCHAR) AS first_absent
FROM z LEFT JOIN m USING (code) WHERE coalesce(mode, nxt) > first_date""")
def q12_disappearance(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("code"), F.to_date("ts").alias("file_date"), F.to_date("ts").alias("change_date"), F.col("event_id").alias("seq"))
    versions = e.groupBy("code").agg(F.min("change_date").alias("valid_from")).withColumn("retired", F.lit(None).cast("date"))
    presence = e.select("code", "file_date").distinct()
    return temporal.infer_retirements(versions, presence, presence, e.select("file_date", "change_date", "seq")).withColumns(iso("effective", "retired", "last_seen", "first_absent"))


PAIRS = """p AS (SELECT DISTINCT p_brand, p_partkey, p_name FROM part),
x AS (SELECT a.p_partkey, b.p_partkey AS candidate, levenshtein(a.p_name, b.p_name) AS score FROM p a JOIN p b ON a.p_brand = b.p_brand AND a.p_partkey <> b.p_partkey),
r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY score, candidate) AS rank FROM x QUALIFY rank <= 3)"""


def similar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_name")
    return resolve.similar_by_name(p, "p_brand", "p_partkey", "p_name", F.levenshtein, 3)


@register(f"WITH {PAIRS} SELECT p_partkey, candidate, score, rank FROM r")
def q13_blocked_fuzzy_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_parts(spark, sf_dir).select("p_partkey", "candidate", "score", "rank")


@register(f"WITH {PAIRS} SELECT p_partkey, candidate, score FROM (SELECT *, lead(score) OVER (PARTITION BY p_partkey ORDER BY rank) AS s2 FROM r) WHERE rank = 1 AND (s2 IS NULL OR s2 - score >= 1)")
def q14_runner_up_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.runner_up_gap(similar_parts(spark, sf_dir), ["p_partkey"], 1).select("p_partkey", "candidate", "score")


@register("""SELECT l.l_orderkey, l.l_linenumber, i.o_orderkey AS during FROM lineitem l JOIN orders own ON l.l_orderkey = own.o_orderkey
JOIN orders i ON i.o_custkey = own.o_custkey AND CAST(i.o_orderdate AS DATE) <= CAST(l.l_shipdate AS DATE) AND (i.o_orderstatus = 'O' OR CAST(l.l_shipdate AS DATE) <= CAST(i.o_orderdate AS DATE) + 60)""")
def q15_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    facts = table(spark, sf_dir, "lineitem").join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey").select("l_orderkey", "l_linenumber", "o_custkey", F.to_date("l_shipdate").alias("at"))
    spans = o.select("o_custkey", F.col("o_orderkey").alias("during"), F.to_date("o_orderdate").alias("start"), F.when(F.col("o_orderstatus") != "O", F.date_add(F.to_date("o_orderdate"), 60)).alias("end"))
    return temporal.interval_join(facts, spans, ["o_custkey"], "at", "start", "end").select("l_orderkey", "l_linenumber", "during")


@register("""WITH RECURSIVE e AS (SELECT o_orderkey AS code, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nxt FROM orders),
s AS (SELECT o_custkey AS key, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS code FROM orders GROUP BY 1),
c AS (SELECT key, 0 AS hop, code FROM s UNION ALL SELECT c.key, c.hop + 1, e.nxt FROM c JOIN e ON e.code = c.code WHERE e.nxt IS NOT NULL AND c.hop < 6)
SELECT key, hop, code FROM c WHERE hop > 0""")
def q16_successor_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    edges = o.select(F.col("o_orderkey").alias("code"), F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")).alias("next")).where("next is not null")
    start = o.groupBy(F.col("o_custkey").alias("key")).agg(F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("code"))
    return successors.successor_chain(start, edges).select("key", "hop", "code")


@register("""WITH w AS (SELECT CAST(ts AS DATE) AS snap, user_id, event_type, max(value) AS v FROM events GROUP BY ALL), k AS (SELECT DISTINCT snap FROM w ORDER BY snap DESC LIMIT 2),
a AS (SELECT * FROM w WHERE snap = (SELECT max(snap) FROM k)), b AS (SELECT * FROM w WHERE snap = (SELECT min(snap) FROM k))
SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.event_type, b.event_type) AS event_type,
CASE WHEN b.user_id IS NULL THEN 'added' WHEN a.user_id IS NULL THEN 'removed' ELSE 'changed' END AS change, b.v AS before, a.v AS after
FROM a FULL OUTER JOIN b ON a.user_id = b.user_id AND a.event_type = b.event_type WHERE a.user_id IS NULL OR b.user_id IS NULL OR a.v IS DISTINCT FROM b.v""")
def q17_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("snap"), "user_id", "event_type").agg(F.max("value").alias("v"))
    two = diff.latest_two(w, "snap")
    return diff.snapshot_diff(two.where("age = 1"), two.where("age = 2"), ["user_id", "event_type"], "v")


@register("""WITH s AS (SELECT DISTINCT o_custkey AS entity, o_orderpriority AS code FROM orders), l AS (SELECT DISTINCT o_custkey AS entity, o_orderpriority AS code FROM orders WHERE o_orderstatus = 'F')
SELECT entity, code FROM s WHERE entity IN (SELECT entity FROM l) AND (entity, code) NOT IN (SELECT (entity, code) FROM l)""")
def q18_not_in_notice(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("entity"), F.col("o_orderpriority").alias("code"), "o_orderstatus")
    return diff.not_listed(o.select("entity", "code").distinct(), o.where("o_orderstatus = 'F'"), "entity", "code").select("entity", "code")


@register(f"""WITH {LISTING} SELECT entity, category, CAST(min(eff) AS VARCHAR) AS since, arg_min(doc, (eff, doc)) AS since_doc, CAST(max(eff) AS VARCHAR) AS until, arg_max(doc, (eff, doc)) AS until_doc,
string_agg(DISTINCT kubun, '/' ORDER BY kubun) AS kubuns, count(DISTINCT product) AS n_products FROM l GROUP BY ALL""")
def q19_code_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.code_usage(listing(spark, sf_dir)).withColumns(iso("since", "until"))


@register(f"""WITH {LISTING} SELECT entity, product, CAST(min(eff) AS VARCHAR) AS first_date, arg_min(doc, (eff, doc)) AS first_doc, string_agg(DISTINCT category_no, ',' ORDER BY category_no) AS numbers FROM l GROUP BY ALL""")
def q20_products_min_bare(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = listing(spark, sf_dir).groupBy("entity", "product")
    return g.agg(F.min("eff").cast("string").alias("first_date"), F.min_by("doc", F.struct("eff", "doc")).alias("first_doc"), F.array_join(F.array_sort(F.collect_set("category_no")), ",").alias("numbers"))


@register("""WITH c AS (SELECT o_orderstatus, CAST(o_orderdate AS DATE) AS d, count(*) AS n, min(o_orderkey) AS k FROM orders GROUP BY ALL)
SELECT o_orderstatus, CAST(d AS VARCHAR) AS d, n FROM c QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY n DESC, k) = 1""")
def q21_modal_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.modal(table(spark, sf_dir, "orders").withColumn("d", F.to_date("o_orderdate")), ["o_orderstatus"], "d", "o_orderkey").withColumns(iso("d"))


@register("SELECT l_partkey, count(DISTINCT l_orderkey) AS n_docs FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_orderkey) >= 3")
def q22_having_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count_distinct("l_orderkey").alias("n_docs")).where("n_docs >= 3")


@register("""WITH c AS (SELECT user_id, string_agg(event_type, ',' ORDER BY event_id) AS types FROM events GROUP BY 1)
SELECT user_id, change, count(*) AS n FROM (SELECT user_id, unnest(string_split(types, ',')) AS change FROM c) GROUP BY ALL""")
def q23_change_type_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))), lambda x: x["event_type"]), ",").alias("types"))
    return c.select("user_id", F.explode(F.split("types", ",")).alias("change")).groupBy("user_id", "change").agg(F.count("*").alias("n"))


@register("""WITH a AS (SELECT o_orderkey AS k, o_totalprice AS va FROM orders WHERE o_orderstatus <> 'P'), b AS (SELECT l_orderkey AS k, max(l_extendedprice) AS vb FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1)
SELECT CASE WHEN b.k IS NULL THEN 'only_left' WHEN a.k IS NULL THEN 'only_right' WHEN va IS NULL OR vb IS NULL THEN 'unknown' WHEN abs(va - vb) < 50000 THEN 'equal' ELSE 'different' END AS kind, count(*) AS n
FROM a FULL OUTER JOIN b ON a.k = b.k GROUP BY 1""")
def q24_reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    b = table(spark, sf_dir, "lineitem").where("l_linestatus = 'O'").groupBy(F.col("l_orderkey").alias("k")).agg(F.max("l_extendedprice").alias("v"))
    return diff.reconcile(a, b, ["k"], "v", 50000)


@register("SELECT o_orderkey, c_name, n_name, CAST(o_orderdate AS DATE)::VARCHAR AS d FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey")
def q25_left_join_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    return o.join(c, o["o_custkey"] == c["c_custkey"], "left").join(n, c["c_nationkey"] == n["n_nationkey"], "left").select("o_orderkey", "c_name", "n_name", F.to_date("o_orderdate").cast("string").alias("d"))


@register("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def q26_semi_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(urgent, "c_custkey", "left_semi").select("c_custkey", "c_name")


@register("""WITH p AS (SELECT p_brand, p_partkey, CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) AS s FROM part),
x AS (SELECT a.p_partkey, b.p_partkey AS code FROM p a JOIN p b ON a.p_brand = b.p_brand AND length(a.s) = length(b.s) AND hamming(a.s, b.s) = 1)
SELECT p_partkey, count(DISTINCT code) AS n FROM x GROUP BY 1""")
def q27_hamming_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_brand", "p_partkey", text.price_digits(F.floor("p_retailprice").cast("double")).alias("s"))
    return resolve.count_one_apart(p, ["p_brand"], "p_partkey", "s")


@register("""WITH c AS (SELECT p_partkey, lpad(CAST(p_partkey * 7919 AS VARCHAR), CASE p_partkey % 4 WHEN 0 THEN 8 WHEN 1 THEN 12 WHEN 2 THEN 13 ELSE 14 END, '0') AS code FROM part),
s AS (SELECT p_partkey, code, (SELECT sum(CAST(substr(code, length(code) - i, 1) AS INT) * CASE WHEN i % 2 = 1 THEN 3 ELSE 1 END) FROM range(1, length(code)) r(i)) AS total FROM c)
SELECT p_partkey, (10 - total % 10) % 10 = CAST(right(code, 1) AS INT) AS ok FROM s""")
def q28_gtin_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    size = F.when(k % 4 == 0, 8).when(k % 4 == 1, 12).when(k % 4 == 2, 13).otherwise(14)
    code = F.lpad((k * 7919).cast("string"), size, F.lit("0"))  # as in the SQL, longer numbers lose their end
    return table(spark, sf_dir, "part").select("p_partkey", text.gtin_ok(code).alias("ok"))


@register("""WITH r AS (SELECT p_partkey, '2' || chr(CAST(48 + p_partkey % 10 AS INT)) || 'O' || chr(CAST(48 + p_partkey % 7 AS INT)) || 'I' || 'B2X' || translate(lpad(CAST(p_partkey % 100000 AS VARCHAR), 5, '0'), '015', 'OIS') || 'A' || 'O1' AS s FROM part)
SELECT p_partkey, CASE WHEN substr(s, 4, 1) = '4' AND regexp_matches(substr(s, 5, 1), '[A-Z84]')
THEN translate(substr(s, 1, 3), 'ODQILTSBGZA', '00011158624') || translate(substr(s, 4, 5), '8201564', 'BZOISGA') || translate(substr(s, 9, 5), 'ODQILTSBGZA', '00011158624') || 'A' || translate(substr(s, 15, 2), 'ODQILTSBGZA', '00011158624')
ELSE translate(substr(s, 1, 5), 'ODQILTSBGZA', '00011158624') || 'BZX' || translate(substr(s, 9, 5), 'ODQILTSBGZA', '00011158624') || 'A' || translate(substr(s, 15, 2), 'ODQILTSBGZA', '00011158624') END AS fixed FROM r""")
def q29_positional_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    digit = lambda n: (k % n).cast("string")
    number = F.translate(F.lpad((k % 100000).cast("string"), 5, "0"), "015", "OIS")
    read = F.concat(F.lit("2"), digit(10), F.lit("O"), digit(7), F.lit("IB2X"), number, F.lit("AO1"))
    return table(spark, sf_dir, "part").select("p_partkey", text.repair_approval(read).alias("fixed"))


@register("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d FROM orders")
def q30_era_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.to_date("o_orderdate")
    era = F.concat(F.lit("適用開始年月日：平成"), (F.year(d) - 1988).cast("string"), F.lit("年"), F.month(d).cast("string"), F.lit("月　"), F.dayofmonth(d).cast("string"), F.lit("日から"))
    full = F.translate(era, "0123456789", "０１２３４５６７８９")
    return table(spark, sf_dir, "orders").select("o_orderkey", text.era_date(full, unicode=False).cast("string").alias("d"))


@register("SELECT doc_id, md5(lower(regexp_replace(translate(text, '　', ' '), '[ \\t\\n\\x0b\\f\\r]+', '', 'g'))) AS h, length(trim(regexp_replace(text, '[ \\t]+', ' ', 'g'), E' \\t\\n\\r\\x0b\\x0c')) AS n FROM documents")
def q31_text_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(F.lower(F.regexp_replace(F.translate(t, "　", " "), r"\s+", "")).cast("binary")).alias("h"), F.length(text.clean(t)).cast("bigint").alias("n"))


@register("""SELECT page_id, count(*) AS n_links, count(DISTINCT u) AS n_different FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS u FROM pages) GROUP BY 1""")
def q32_html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))).alias("u")).groupBy("page_id").agg(F.count("*").alias("n_links"), F.count_distinct("u").alias("n_different"))


@register("SELECT o_custkey, count(*) AS n, CAST(min(o_orderkey) AS BIGINT) AS first_key, CAST(max(o_orderkey) AS BIGINT) AS last_key FROM orders GROUP BY 1")
def q33_json_nesting(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.to_json(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderstatus")))).alias("j"))
    back = nested.withColumn("x", F.from_json("j", "array<struct<o_orderkey:bigint,o_orderstatus:string>>"))
    return back.select("o_custkey", F.size("x").cast("bigint").alias("n"), F.col("x")[0]["o_orderkey"].alias("first_key"), F.element_at("x", -1)["o_orderkey"].alias("last_key"))


@register("""SELECT l_orderkey, l_linenumber, slot, value FROM (
SELECT l_orderkey, l_linenumber, 1 AS slot, l_quantity AS value FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 2, l_extendedprice FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 3, nullif(l_discount, 0) FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 4, nullif(l_tax, 0) FROM lineitem) WHERE value IS NOT NULL""")
def q34_unpivot_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").withColumns({"l_discount": F.nullif("l_discount", F.lit(0.0)), "l_tax": F.nullif("l_tax", F.lit(0.0))})
    return diff.unpivot_slots(l, ["l_orderkey", "l_linenumber"], [{"value": c} for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")])


@register("""WITH r AS (SELECT o_orderkey, o_orderstatus AS side, CAST(o_orderkey % 3 AS VARCHAR) AS annex FROM orders),
i AS (SELECT l_orderkey, CASE WHEN l_linenumber % 2 = 0 THEN l_linestatus || ':' ELSE '' END || CAST(l_orderkey % 3 + l_linenumber // 3 AS VARCHAR) AS key, l_linenumber AS pos, l_partkey FROM lineitem),
j AS (SELECT r.*, EXISTS (SELECT 1 FROM i WHERE i.l_orderkey = r.o_orderkey AND i.key = r.side || ':' || r.annex) AS own FROM r)
SELECT j.o_orderkey, i.pos, CAST(i.l_partkey AS VARCHAR) AS product_code FROM j LEFT JOIN i ON i.l_orderkey = j.o_orderkey AND i.key = CASE WHEN own THEN side || ':' || annex ELSE annex END""")
def q35_expand_annex(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_orderstatus").alias("side"), (F.col("o_orderkey") % 3).cast("string").alias("annex"))
    key = F.concat(F.when(F.col("l_linenumber") % 2 == 0, F.concat("l_linestatus", F.lit(":"))).otherwise(""), (F.col("l_orderkey") % 3 + F.floor(F.col("l_linenumber") / 3)).cast("string"))
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), key.alias("key"), F.col("l_linenumber").alias("position"), F.col("l_linenumber").alias("product_name"), F.col("l_partkey").cast("string").alias("product_code"))
    return corrections.expand_annex(rows, items).select(F.col("doc_id").alias("o_orderkey"), F.col("product_name").alias("pos"), "product_code")


@register("""WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS nd, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 160 - 60 AS INT) END AS eff FROM orders)
SELECT o_orderkey, CAST(CASE WHEN eff - nd BETWEEN -40 AND 70 THEN eff ELSE CAST(date_trunc('month', nd + INTERVAL 1 MONTH) AS DATE) END AS VARCHAR) AS eff FROM o""")
def q36_default_effective(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronofold.operators.projections import default_effective, sane_effective

    nd = F.to_date("o_orderdate")
    eff = F.when(F.col("o_orderkey") % 5 != 0, F.date_add(nd, (F.col("o_orderkey") % 160 - 60).cast("int")))
    return table(spark, sf_dir, "orders").select("o_orderkey", sane_effective(eff, nd, default_effective(F.lit(None).cast("date"), nd)).cast("string").alias("eff"))


@register("""SELECT c_custkey, concat_ws(';', CASE WHEN c_acctbal < 0 THEN 'negative' END, CASE WHEN c_mktsegment = 'BUILDING' THEN 'building' END, CASE WHEN c_nationkey < 5 THEN 'near' END) AS flags FROM customer""")
def q37_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = events.quality_flags({"negative": F.col("c_acctbal") < 0, "building": F.col("c_mktsegment") == "BUILDING", "near": F.col("c_nationkey") < 5})
    return table(spark, sf_dir, "customer").select("c_custkey", flags.alias("flags"))


@register("""WITH r AS (SELECT o_orderkey AS row_id, o_custkey AS entity, CAST(o_orderdate AS DATE) AS eff, o_custkey % 97 AS code FROM orders),
own AS (SELECT c_custkey AS entity, c_custkey % 97 + 1000 AS code, DATE '1994-01-01' AS s, CASE WHEN c_custkey % 2 = 0 THEN DATE '1996-12-31' END AS e FROM customer WHERE c_custkey % 7 = 0),
fo AS (SELECT k AS code, k * 3 AS entity FROM range(0, 40) t(k)), alt AS (SELECT o_orderkey AS row_id, (o_orderkey % 80) AS alternative, 0.7 AS score FROM orders WHERE o_orderkey % 3 = 0),
free AS (SELECT row_id, max(alternative) AS free FROM alt WHERE alternative NOT IN (SELECT code FROM fo) GROUP BY 1),
best AS (SELECT r.row_id, min(own.code) AS own FROM r JOIN own ON own.entity = r.entity AND s <= eff AND (e IS NULL OR eff <= e) GROUP BY 1)
SELECT r.row_id, CAST(CASE WHEN own IS NOT NULL THEN own WHEN fo.entity <> r.entity THEN free ELSE r.code END AS BIGINT) AS code FROM r LEFT JOIN best USING (row_id) LEFT JOIN fo ON fo.code = r.code LEFT JOIN free USING (row_id)""")
def q38_designated_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    rows = o.select(F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("entity"), F.to_date("o_orderdate").alias("eff"), (F.col("o_custkey") % 97).alias("code"))
    own = c.where("c_custkey % 7 = 0").select(F.col("c_custkey").alias("entity"), (F.col("c_custkey") % 97 + 1000).alias("code"), F.lit("1994-01-01").cast("date").alias("start"), F.when(F.col("c_custkey") % 2 == 0, F.lit("1996-12-31").cast("date")).alias("end"))
    foreign = spark.range(40).select(F.col("id").alias("code"), (F.col("id") * 3).alias("entity"))
    alternatives = o.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("row_id"), (F.col("o_orderkey") % 80).alias("alternative"), F.lit(0.7).alias("score"))
    return resolve.designated_first(rows, own, foreign, alternatives).select("row_id", "code")


@register("""WITH c AS (SELECT l_suppkey, substr(CAST(l_partkey * 1000003 AS VARCHAR), 1, 2) AS prefix, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT l_suppkey, prefix, n FROM c QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, prefix) = 1""")
def q39_prefix_majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", (F.col("l_partkey") * 1000003).cast("string").alias("code"))
    return repair.prefix_majority(rows, ["l_suppkey"], length=2)


@register("""WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d, o_orderkey % 2 AS official FROM orders)
SELECT o_orderkey, official FROM o WHERE official = 1 UNION ALL SELECT o_orderkey, official FROM o x WHERE official = 0 AND NOT EXISTS (SELECT 1 FROM o y WHERE y.official = 1 AND y.o_custkey = x.o_custkey AND date_trunc('year', y.d) = date_trunc('year', x.d))""")
def q40_two_way_supersede(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"), (F.col("o_orderkey") % 2).alias("official"))
    return diff.supersede(o.where("official = 0"), o.where("official = 1"), ["o_custkey", "y"]).select("o_orderkey", "official")


@register(f"""WITH {MOVES}, f AS (SELECT entity, category, min(t) AS t, arg_min(eff, t) AS eff, arg_min(doc, t) AS doc FROM g GROUP BY ALL)
SELECT f.entity, f.category, CAST(f.eff AS VARCHAR) AS eff, f.doc FROM f WHERE t > 1 AND NOT EXISTS (SELECT 1 FROM m WHERE m.entity = f.entity AND m."to" = f.category AND m.t = f.t)""")
def q41_categories_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.categories_added(listing(spark, sf_dir)).select("entity", "category", F.col("eff").cast("string").alias("eff"), "doc")


@register(f"""WITH {MOVES}, lv AS (SELECT entity, product, category, t AS t0, least(t_again, t_number) AS t1 FROM v), gs AS (SELECT DISTINCT entity, t FROM g)
SELECT gs.entity, gs.t, count(*) AS n_rows, count(DISTINCT product) AS n_products FROM gs JOIN lv ON lv.entity = gs.entity AND t0 < gs.t AND (t1 IS NULL OR t1 >= gs.t) GROUP BY ALL""")
def q42_before_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.before_state(listing(spark, sf_dir)).groupBy("entity", "t").agg(F.count("*").alias("n_rows"), F.count_distinct("product").alias("n_products"))


@register(f"""WITH {LISTING}, k AS (SELECT entity, t, kubun, min(t) OVER (PARTITION BY entity, kubun) AS first_t FROM g), n AS (SELECT entity, min(t) AS t FROM g GROUP BY entity, product)
SELECT entity, t, string_agg(DISTINCT kubun, '/' ORDER BY kubun) AS added FROM k WHERE first_t = t AND t > 1 AND NOT EXISTS (SELECT 1 FROM n WHERE n.entity = k.entity AND n.t = k.t) GROUP BY ALL""")
def q43_class_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.class_changes(listing(spark, sf_dir)).select("entity", "t", F.array_join("added", "/").alias("added"))


@register(f"""WITH {LISTING} SELECT entity, CAST(min(eff) AS VARCHAR) AS first_date, CAST(max(eff) AS VARCHAR) AS last_date, arg_max(doc, (eff, doc)) AS last_doc, count(DISTINCT product) AS n_products,
count(DISTINCT category) AS n_categories, string_agg(DISTINCT kubun, '/' ORDER BY kubun) AS kubuns FROM l GROUP BY entity""")
def q44_entity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.entity_summary(listing(spark, sf_dir)).withColumns(iso("first_date", "last_date"))


@register("""SELECT l_partkey AS entity, l_orderkey AS doc,
coalesce(list_aggregate(list_sort(list_distinct(list(l_suppkey) FILTER (l_linenumber % 2 = 1 AND l_suppkey NOT IN (SELECT z.l_suppkey FROM lineitem z WHERE z.l_orderkey = lineitem.l_orderkey AND z.l_partkey = lineitem.l_partkey AND z.l_linenumber % 2 = 0)))), 'string_agg', '/'), '') AS removed,
coalesce(list_aggregate(list_sort(list_distinct(list(l_suppkey) FILTER (l_linenumber % 2 = 0 AND l_suppkey NOT IN (SELECT z.l_suppkey FROM lineitem z WHERE z.l_orderkey = lineitem.l_orderkey AND z.l_partkey = lineitem.l_partkey AND z.l_linenumber % 2 = 1)))), 'string_agg', '/'), '') AS added
FROM lineitem GROUP BY ALL""")
def q45_correction_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("entity"), F.col("l_orderkey").alias("doc"), F.col("l_suppkey").alias("product"), F.col("l_returnflag").alias("category"), F.when(F.col("l_linenumber") % 2 == 1, "wrong").otherwise("right").alias("side"))
    out = events.correction_summary(lines)
    return out.select("entity", "doc", F.array_join(F.col("product_removed").cast("array<string>"), "/").alias("removed"), F.array_join(F.col("product_added").cast("array<string>"), "/").alias("added"))


@register(f"""WITH {CORRECTIONS}, r AS (SELECT * FROM b UNION ALL SELECT * FROM a),
h AS (SELECT r.target_doc, r.entity, r.category, r.code, r.seq, min(d.step) AS step FROM r JOIN d ON d.target_doc = r.target_doc AND d.entity = r.entity AND d.category = r.category AND r.birth < d.step AND (d.code IS NULL OR d.code = r.code) GROUP BY ALL)
SELECT d.target_doc, d.step, CAST(EXISTS (SELECT 1 FROM h WHERE h.target_doc = d.target_doc AND h.step = d.step AND h.entity = d.entity AND h.category = d.category AND (d.code IS NULL OR d.code = h.code)) AS INT) AS matched FROM d""")
def q46_correction_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, deletes, adds = correction_lines(spark, sf_dir)
    return corrections.match_status(base, deletes, adds).select("target_doc", "step", "matched")


@register("""WITH h AS (SELECT o_custkey AS code, CAST(o_orderdate AS DATE) AS f, lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS u, o_orderpriority || o_orderkey % 97 AS name, o_orderkey FROM orders),
l AS (SELECT code, arg_max(name, (f, o_orderkey)) AS name, max(f) AS f FROM h GROUP BY 1), d AS (SELECT code, name, f + 31 AS day FROM l WHERE code % 2 = 0)
SELECT DISTINCT d.code, n.code AS successor FROM d JOIN (SELECT DISTINCT name, code FROM h) n ON n.name = d.name AND n.code <> d.code JOIN h a ON a.code = n.code AND a.f <= d.day AND (a.u IS NULL OR d.day < a.u)""")
def q47_successors(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("f", F.to_date("o_orderdate")).withColumn("name", F.concat("o_orderpriority", (F.col("o_orderkey") % 97).cast("string")))
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    h = o.select(F.col("o_custkey").alias("code"), F.col("f").alias("valid_from"), F.lead("f").over(w).alias("valid_to"), F.lit("2").alias("schedule"), "name", F.lit(None).cast("date").alias("retired"), "o_orderkey")
    # A code's end is a version of its own, never in force, so that an ended code may still succeed another, as in the SQL.
    last = h.groupBy("code").agg(F.max_by("name", F.struct("valid_from", "o_orderkey")).alias("name"), F.max("valid_from").alias("f")).where("code % 2 = 0")
    ends = last.select("code", F.date_add("f", 1).alias("valid_from"), F.date_add("f", 1).alias("valid_to"), F.lit("2").alias("schedule"), "name", F.date_add("f", 30).alias("retired"))
    return successors.successors(h.drop("o_orderkey").unionByName(ends))


@register()
def q48_category_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts ask for candidates. Ratio of difflib has no SQL form; tested against a sequential model."""
    p = table(spark, sf_dir, "part")
    number = F.lpad((F.col("p_size") % 50).cast("string"), 3, "0")
    names = p.select(F.lit("2").alias("schedule"), number.alias("category_no"), F.col("p_partkey").alias("code"), F.col("p_name").alias("name"))
    wanted = p.select(F.lit("医科").alias("setting"), F.concat(number, F.lit(" "), F.col("p_name")).alias("category"))
    return resolve.category_candidates(wanted, names, 5)


@register()
def q49_number_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted edit distance has no SQL form; tested against a sequential model."""
    number = F.concat(F.lit("2"), F.lpad((F.col("p_partkey") * 37 % 10000).cast("string"), 4, "0"), F.lit("BZX"), F.lpad((F.col("p_partkey") * 101 % 100000).cast("string"), 5, "0"), F.lit("000"))
    known = table(spark, sf_dir, "part").select(number.alias("number"))
    read = known.select(F.concat(F.substring("number", 1, 8), F.translate(F.substring("number", 9, 1), "058", "OSB"), F.substring("number", 10, 7)).alias("number"), F.lit(None).cast("string").alias("code"))
    return repair.repair_numbers(read, known)


@register()
def q50_index_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of pages by a parser; tested on planted pages."""
    return readers.parse_index(table(spark, sf_dir, "pages"), suffix=None).select("page", "position", "url", "title", "doc_id")


@register(f"""WITH {MOVES}, u AS (SELECT entity, category, min(eff) AS since, max(eff) AS until FROM l GROUP BY ALL), c AS (SELECT DISTINCT entity, category FROM v WHERE t_number IS NULL AND t_again IS NULL),
w AS (SELECT entity, "from" AS category, max(eff) AS away FROM m GROUP BY ALL), x AS (SELECT u.*, c.entity IS NOT NULL AS cur, away, CASE WHEN category IN ('AF', 'RF') THEN DATE '1997-06-01' END AS retired FROM u LEFT JOIN c USING (entity, category) LEFT JOIN w USING (entity, category)),
y AS (SELECT *, CASE WHEN cur THEN NULL ELSE coalesce(away, until) END AS e FROM x)
SELECT entity, category, CAST(since AS VARCHAR) AS since, CAST(CASE WHEN retired IS NOT NULL AND (e IS NULL OR retired < e) THEN retired ELSE e END AS VARCHAR) AS "end",
CASE WHEN retired IS NOT NULL AND (e IS NULL OR retired < e) THEN 'abolished' WHEN cur THEN 'in use' WHEN away IS NOT NULL THEN 'moved' ELSE 'not listed again' END AS end_reason FROM y""")
def q51_usage_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listing(spark, sf_dir)
    used = events.code_usage(rows).withColumn("code", F.col("category")).select("entity", "category", "code", "since", "until")
    retired = spark.createDataFrame([("AF",), ("RF",)], "code string").withColumn("retired", F.lit("1997-06-01").cast("date"))
    out = usage.usage_periods(used, events.current_state(rows), events.category_moves(rows), retired)
    return out.select("entity", "category", F.col("since").cast("string").alias("since"), F.col("end").cast("string").alias("end"), "end_reason")


@register("""WITH r AS (SELECT o_custkey AS entity, o_orderpriority AS code, CAST(o_orderdate AS DATE) AS since, CASE WHEN o_orderstatus = 'P' THEN 'listed' ELSE 'inferred' END AS source, o_orderkey FROM orders),
k AS (SELECT *, max(CASE WHEN source <> 'inferred' THEN 1 ELSE 0 END) OVER (PARTITION BY entity, code) AS listed, row_number() OVER (PARTITION BY entity, code ORDER BY source = 'inferred', since) AS n FROM r)
SELECT entity, code, CAST(since AS VARCHAR) AS since, source FROM k WHERE source <> 'inferred' OR (listed = 0 AND n = 1)""")
def q52_listed_over_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("entity"), F.col("o_orderpriority").alias("code"), F.to_date("o_orderdate").alias("since"), F.when(F.col("o_orderstatus") == "P", "listed").otherwise("inferred").alias("source"))
    return usage.prefer_listed(o).withColumns(iso("since"))


@register(f"""WITH {ORDERS}, h AS (SELECT o_custkey AS code, d, CAST(round(price * 100) AS BIGINT) AS price, nullif(priority, '5-LOW') AS name, CASE WHEN priority = '1-URGENT' THEN d + 30 END AS retired FROM o),
x AS (SELECT *, lag(price) OVER w AS p0, lag(name) OVER w AS n0, row_number() OVER w AS n FROM h WINDOW w AS (PARTITION BY code ORDER BY d)), u AS (SELECT c_nationkey AS entity, c_custkey AS code, DATE '1994-06-01' AS since FROM customer)
SELECT entity, code, CAST(d AS VARCHAR) AS event_date, 'price_revision' AS type, CAST(p0 AS VARCHAR) AS before, CAST(price AS VARCHAR) AS after FROM x JOIN u USING (code) WHERE n > 1 AND d > since AND d <= DATE '1998-01-01' AND price IS DISTINCT FROM p0
UNION ALL SELECT entity, code, CAST(d AS VARCHAR), 'category_renamed', n0, name FROM x JOIN u USING (code) WHERE n > 1 AND d > since AND d <= DATE '1998-01-01' AND n0 <> name
UNION ALL SELECT entity, code, CAST(r AS VARCHAR), 'category_abolished', NULL, NULL FROM (SELECT code, last(retired ORDER BY d) AS r FROM h GROUP BY 1) JOIN u USING (code) WHERE r IS NOT NULL""")
def q53_master_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = order_history(spark, sf_dir).select(F.col("o_custkey").alias("code"), F.col("d").alias("valid_from"), F.round(F.col("price") * 100).cast("bigint").alias("price"), F.nullif("priority", F.lit("5-LOW")).alias("name"), F.when(F.col("priority") == "1-URGENT", F.date_add("d", 30)).alias("retired"))
    used = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("entity"), F.col("c_custkey").alias("code"), F.lit("1994-06-01").cast("date").alias("since"))
    return usage.master_events(used, h, F.lit("1998-01-01").cast("date")).withColumns(iso("event_date"))


from chronofold.plans import rules  # noqa: E402, F401  registers further queries
