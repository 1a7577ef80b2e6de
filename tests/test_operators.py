"""Operators on small inputs: golden cases, sequential models and edge cases."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from chronofold.operators import corrections, diff, events, projections, repair, resolve, successors, temporal, usage
from chronofold.sources import readers, writers
from chronofold.streaming import incremental


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_history_against_a_sequential_model(spark):
    draw = random.Random(5)
    data = [(k, date(2020, 1, draw.randint(1, 9)), i, draw.choice([None, 1.0, 2.0]), draw.choice([None, "a", "b"])) for i, k in enumerate(draw.choices("xyz", k=120))]
    got = temporal.build_history(spark.createDataFrame(data, "k string, d date, seq int, price double, name string"), ["k"], "d", ["seq"], ["price", "name"])
    expected = []
    for k in "xyz":
        state, by_day = (None, None), {}
        for _, d, _, p, n in sorted((r for r in data if r[0] == k), key=lambda r: (r[1], r[2])):
            state = (state[0] if p is None else p, state[1] if n is None else n)
            by_day[d] = state
        kept = []
        for d, s in sorted(by_day.items()):
            if not kept or kept[-1][1] != s:
                kept.append((d, s))
        expected += [(k, d, *s, kept[i + 1][0] if i + 1 < len(kept) else None) for i, (d, s) in enumerate(kept)]
    assert rows(got, "k", "d", "price", "name", "valid_to") == sorted(expected, key=str)


def test_as_of_joins_agree(spark):
    h = spark.createDataFrame([("a", 1, 10.0), ("a", 5, 20.0), ("b", 3, 30.0)], "k string, t int, price double")
    p = spark.createDataFrame([(1, "a", 0), (2, "a", 1), (3, "a", 4), (4, "a", 9), (5, "c", 9), (6, None, 1)], "id int, k string, t int")
    expected = [(1, None), (2, 10.0), (3, 10.0), (4, 20.0), (5, None), (6, None)]
    assert rows(temporal.as_of_join(p, h, ["k"], "t", "t", ["price"]), "id", "price") == sorted(expected, key=str)
    assert rows(temporal.as_of_join(p, h, ["k"], "t", "t", ["price"], broadcast_history=True), "id", "price") == sorted(expected, key=str)
    first = temporal.as_of_or_first(p.where("k is not null"), h, ["k"], "t", "t", ["price"])
    assert rows(first, "id", "price") == sorted([(1, 10.0), (2, 10.0), (3, 10.0), (4, 20.0), (5, None)], key=str)


def test_retirement_from_snapshots(spark):
    master = [("20151228", "710010008", "20140401"), ("20151228", "710010001", "20140401"), ("20160304", "710010001", "20160401"), ("20160304", "710010002", "20160401"), ("20171130", "710010001", "20160401"), ("20171130", "710010003", "20170701")]
    m = spark.createDataFrame([(f, c, d, i) for i, (f, c, d) in enumerate(master)], "f string, code string, d string, seq int").select(F.to_date("f", "yyyyMMdd").alias("file_date"), "code", F.to_date("d", "yyyyMMdd").alias("change_date"), "seq")
    history = m.groupBy("code").agg(F.max("change_date").alias("valid_from")).withColumn("retired", F.lit(None).cast("date"))
    got = temporal.infer_retirements(history, m.select("code", "file_date").distinct(), m.select("code", "file_date"), m.select("file_date", "change_date", "seq"))
    found = {r["code"]: r for r in got.collect()}
    assert set(found) == {"710010008", "710010002"}
    assert (found["710010008"]["effective"], found["710010008"]["retired"]) == (date(2016, 4, 1), date(2016, 3, 31))


def test_corrections_against_replay(spark):
    draw = random.Random(3)
    for _ in range(8):
        base = [(1, draw.choice("ab"), draw.choice("xy"), draw.choice("12")) for _ in range(6)]
        deletes = [(1, draw.choice("ab"), draw.choice("xy"), draw.choice(["1", "2", None]), draw.randint(1, 3)) for _ in range(3)]
        adds = [(1, draw.choice("ab"), draw.choice("xy"), draw.choice("12"), draw.randint(1, 3)) for _ in range(3)]
        live = [(*r, 0) for r in base]
        for step in (1, 2, 3):
            for d in (d for d in deletes if d[4] == step):
                live = [r for r in live if not (r[1] == d[1] and r[2] == d[2] and (d[3] is None or r[3] == d[3]))]
            live += [(*a[:4], 1) for a in adds if a[4] == step]
        schema = "target_doc int, entity string, category string, code string"
        got = corrections.apply_corrections(spark.createDataFrame(base, schema), spark.createDataFrame(deletes, schema + ", step int"), spark.createDataFrame(adds, schema + ", step int"))
        assert rows(got, "target_doc", "entity", "category", "code", "corrected") == sorted(live, key=str)


def test_moves_and_current_state(spark):
    data = [("A", date(2020, 1, 1), 1, "p", "010a", "010"), ("A", date(2020, 2, 1), 2, "p", "010b", "010"), ("A", date(2020, 3, 1), 3, "p", "020a", "020"), ("A", date(2020, 3, 1), 3, "q", "none", None)]
    listing = spark.createDataFrame([(*r, 1.0, "B1") for r in data], "entity string, eff date, doc int, product string, category string, category_no string, price double, kubun string")
    assert rows(events.category_moves(listing), "product", "from", "to", "t") == [("p", "010a", "010b", 2)]
    assert rows(events.current_state(listing), "product", "category") == [("p", "010b"), ("p", "020a"), ("q", "none")]
    assert rows(events.categories_added(listing), "category") == [("020a",), ("none",)]
    assert {r["type"] for r in events.all_events(listing).collect()} == {"listing_new", "category_changed", "category_added", "products_added"}
    empty = listing.limit(0)
    assert events.all_events(empty).count() == 0 and events.before_state(empty).count() == 0


def test_repair(spark):
    known = spark.createDataFrame([("22700BZI00025000", "4580000000000"), ("20600BZZ00666A01", "4547531706101")], "number string, code string")
    read = spark.createDataFrame([("22700B2I00025000", None), ("22700BZI0002500", None), ("20600BZZ00666A01", None), ("2270082X0025000", "4580000000000"), ("99999XXX99999999", None)], "number string, code string")
    found = {r["number"]: (r["repaired"], r["how"]) for r in repair.repair_numbers(read, known, known).collect()}
    assert found["22700B2I00025000"] == ("22700BZI00025000", "fuzzy") and found["22700BZI0002500"] == ("22700BZI00025000", "fuzzy")
    assert found["20600BZZ00666A01"] == ("20600BZZ00666A01", "exact") and found["2270082X0025000"] == ("22700BZI00025000", "vote") and found["99999XXX99999999"][1] == "none"
    codes = spark.createDataFrame([("20600BZZ00666A01", "4547531706101"), ("20600BZZ00666A01", "4547531706181")], "number string, code string")
    assert {r["code"]: (r["repaired"], r["how"]) for r in repair.repair_codes(codes, known).collect()} == {"4547531706101": ("4547531706101", "exact"), "4547531706181": ("4547531706101", "appr1")}


def test_repair_by_page_against_a_sequential_model(spark):
    """Numbers of the same page, votes by lines and runners-up just beyond the limit, one number after the other."""
    groups = ("B83", "Z27", "O0DQ", "I1LT", "S5", "G6", "A4")

    def distance(a, b):
        row = [float(j) for j in range(len(b) + 1)]
        for i, x in enumerate(a, 1):
            old, row = row, [float(i)]
            for j, y in enumerate(b, 1):
                cost = 0.0 if x == y else 0.4 if any(x in g and y in g for g in groups) else 1.0
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + cost))
        return row[-1]

    def nearest(number, among):
        near = sorted((distance(number, k), k) for k in among)
        return near[0] if near and (len(near) == 1 or near[1][0] - near[0][0] >= 0.6 - 1e-9) else None

    draw = random.Random(11)
    # Five or more own characters keep different numbers far apart, so that bounds of distances can't matter.
    known = ["".join(draw.choices("0123456789", k=5)) + "BZX" + "".join(draw.choices("0123456789", k=5)) + "000" for _ in range(40)]
    votes = [(f"c{i % 25}", k) for i, k in enumerate(known)]
    lines = []
    for page in ["p1", "p2", "p3", None]:
        for k in draw.sample(known, 8):
            for _ in range(draw.randint(1, 2)):
                read = list(k)
                for _ in range(draw.choice([0, 0, 1, 2, 3, 5])):
                    read[draw.randrange(8)] = draw.choice("08B2ZA4X")
                lines += [("".join(read), page, draw.choice([None, *[c for c, n in votes if n == k]]))] * draw.randint(1, 3)
    lines.append((known[0][:-1], None, None))
    expected = {}
    for number, page in {x[:2] for x in lines}:
        ballots = {}
        for n, p, c in lines:
            if (n, p) == (number, page):
                for code, k in votes:
                    if code == c:
                        ballots[k] = ballots.get(k, 0) + 1
        top = sorted(ballots.items(), key=lambda x: (-x[1], x[0]))
        lead = top[0][0] if top and (len(top) == 1 or top[0][1] > top[1][1]) else None
        context = nearest(number, {n for n, p, _ in lines if p == page and n in known})
        parts = lambda x: {x[:6] + "h", x[-6:] + "t", x[5:11] + "m", x[2:8] + "a", x[8:14] + "b"}
        near = nearest(number, [k for k in known if parts(k) & parts(number)])
        if number in known:
            expected[number, page] = (number, "exact")
        elif context and (context[0] <= 2 or (context[0] <= 4.5 and number[-8:] == context[1][-8:])):
            expected[number, page] = (context[1], "page")
        elif lead and distance(number, lead) <= 6:
            expected[number, page] = (lead, "vote")
        elif near and near[0] <= 2:
            expected[number, page] = (near[1], "fuzzy")
        else:
            expected[number, page] = (number, "none")
    frame = spark.createDataFrame(lines, "number string, page string, code string")
    dictionary = spark.createDataFrame(votes, "code string, number string")
    found = repair.repair_numbers(frame, dictionary, dictionary, page=["page"]).collect()
    assert {(r["number"], r["page"]): (r["repaired"], r["how"]) for r in found} == expected and len(found) == len(expected)
    assert {how for _, how in expected.values()} == {"exact", "page", "vote", "fuzzy", "none"}


def test_ballots_are_counted_once_for_the_same_codes(spark):
    """300 lines with one code that many numbers have: ballots grow with the codes, not with codes times lines."""
    votes = spark.createDataFrame([("c", f"9{i:04}BZX{i:05}000") for i in range(50)] + [("d", "70000BZX70000000")], "code string, number string")
    read = spark.createDataFrame([(f"4{i:04}QQQ{i:05}111", f"p{i}", "c") for i in range(300)] + [("7000YYYX70000000", "p", "d"), ("7000YYYX70000000", "p", "c")], "number string, page string, code string")
    got = repair.repair_numbers(read, votes, votes, page=["page"])
    assert [r for r in rows(got, "number", "repaired", "how") if r[2] != "none"] == [] and got.count() == 301
    alone = repair.repair_numbers(read.where("code = 'd'"), votes, votes, page=["page"])
    assert rows(alone, "repaired", "how") == [("70000BZX70000000", "vote")]
    counted = [x for x in got._jdf.queryExecution().optimizedPlan().toString().split("\n") if "sum(lines#" in x]
    assert counted and not any("number#" in x for x in counted)


def test_runner_up_just_beyond_the_limit_counts(spark):
    """Nearest at 2.0, next at 2.4: too close to tell."""
    known = spark.createDataFrame([("AAAAAACCDDDDDDDD",), ("AAAAAAC8DDDDDDD0",)], "number string")
    read = spark.createDataFrame([("AAAAAAXXDDDDDDDD", None), (None, None)], "number string, code string")
    assert rows(repair.repair_numbers(read, known.limit(1)), "repaired", "how") == [("AAAAAACCDDDDDDDD", "fuzzy"), (None, "none")]
    assert rows(repair.repair_numbers(read, known), "repaired", "how") == [("AAAAAAXXDDDDDDDD", "none"), (None, "none")]
    assert repair.repair_numbers(read.limit(0), known).count() == 0


def test_successors(spark):
    h = spark.createDataFrame([("710010739", date(2013, 10, 1), None, "2", "B", date(2015, 9, 30)), ("710010737", date(2014, 4, 1), None, "2", "B", None), ("710010736", date(2014, 4, 1), None, "2", "C", None)], "code string, valid_from date, valid_to date, schedule string, name string, retired date")
    assert rows(successors.successors(h), "code", "successor") == [("710010739", "710010737")]


def test_successors_make_each_pair_once(spark):
    """Versions that overlap, meet, leave gaps or hold nothing, against pairs of versions; nothing is dealt out or merged after the pairs."""
    draw, days = random.Random(4), [date(2020, 1, x) for x in range(1, 28)]
    data = [(f"c{draw.randint(1, 14)}", draw.choice(days), draw.choice([None, *days]), draw.choice("12"), draw.choice("BC"), draw.choice([None, None, *days])) for _ in range(90)]
    data = list({r[:2]: r for r in data}.values())  # one version a day, so that the last one is certain
    expected = set()
    for code in {r[0] for r in data}:
        _, _, _, schedule, name, retired = max((r for r in data if r[0] == code), key=lambda r: r[1])
        for x in data if retired else []:
            day = retired + timedelta(1)
            named = any(r[0] == x[0] and r[3:5] == (schedule, name) for r in data)
            if x[0] != code and named and x[1] <= day and (x[2] is None or day < x[2]) and (x[5] is None or x[5] >= day):
                expected.add((code, x[0]))
    got = successors.successors(spark.createDataFrame(data, "code string, valid_from date, valid_to date, schedule string, name string, retired date"))
    assert rows(got, "code", "successor") == sorted(expected, key=str) and len(expected) > 5
    above = got._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "Aggregate" not in above and "Repartition" not in above


def test_candidates_and_decision(spark):
    listing = spark.createDataFrame([("医科", "010 カテーテル(1)標準型")], "setting string, category string")
    master = spark.createDataFrame([("2", "010", "c1", "カテーテル・標準型"), ("2", "010", "c2", "カテーテル・特殊型"), ("5", "010", "c3", "カテーテル・標準型"), ("2", "011", "c4", "カテーテル・標準型")], "schedule string, category_no string, code string, name string")
    c = resolve.category_candidates(listing, master)
    assert [(r["code"], round(r["score"], 2)) for r in c.orderBy("rank").collect()][:2] == [("c1", 1.0), ("c3", 0.95)]
    chosen = resolve.decide(c.withColumn("price_ok", F.col("code") == "c3"), ["setting", "category"]).first()
    assert chosen["code"] == "c3"


def test_annex_and_unpivot(spark):
    r = spark.createDataFrame([("d", "1", "right"), ("d", "2", None), ("d", "9", None)], "doc_id string, annex string, side string")
    items = spark.createDataFrame([("d", "right:1", 1, "a", "1"), ("d", "1", 1, "b", "2"), ("d", "2", 1, "c", "3"), ("d", "2", 2, "d", "4")], "doc_id string, key string, position int, product_name string, product_code string")
    assert rows(corrections.expand_annex(r, items), "annex", "product_name") == sorted([("1", "a"), ("2", "c"), ("2", "d"), ("9", None)], key=str)
    w = spark.createDataFrame([(1, "a", None)], "id int, x1 string, x2 string")
    assert rows(diff.unpivot_slots(w, ["id"], [{"x": "x1"}, {"x": "x2"}]), "id", "slot", "x") == [(1, 1, "a")]


def test_projections(spark):
    df = spark.createDataFrame([("R", date(2018, 3, 1), None), ("A1", date(2019, 1, 1), "x")], "kubun string, eff date, code string")
    got = df.select(projections.is_target_class(F.col("kubun")).alias("t"), projections.class_before_reform(F.col("kubun"), F.col("eff")).alias("k"), projections.default_effective(F.lit(None).cast("date"), F.col("eff")).alias("d")).collect()
    assert [tuple(r) for r in got] == [(True, "B", date(2018, 4, 1)), (False, "A1", date(2019, 2, 1))]


def test_master_files(spark, tmp_path):
    import zipfile

    fields = [""] * 37
    for i, v in ((0, "5"), (1, "T"), (2, "710010001"), (11, "1200"), (27, "20140401"), (29, "99999999"), (30, "02"), (31, "1"), (36, "カテーテル")):
        fields[i] = v
    line = ",".join(f'"{x}"' for x in fields) + "\r\n"
    (tmp_path / "t20140401.csv").write_bytes((line + '"5","X","2"\r\n').encode("cp932"))
    with zipfile.ZipFile(tmp_path / "t_ALL20160304.zip", "w") as z:
        z.writestr("all.csv", line.encode("cp932"))
    m = readers.read_master(spark, str(tmp_path))
    assert rows(m, "file", "file_date", "code", "price", "beppyo", "kubun_no", "basic_name") == [("t20140401.csv", "20140401", "710010001", 1200.0, "2", "001", "カテーテル"), ("t_ALL20160304.zip", "20160304", "710010001", 1200.0, "2", "001", "カテーテル")]
    assert readers.master_deltas(m).where("abolish = ''").count() == 2


def test_index_pages(spark):
    html = "<h3>令和8年度</h3><a href='/a/000502873.pdf'>医療機器の保険適用について（令和8年8月31日）</a><a href='b c.html'>x</a><a href='/a/000502873.pdf'>again</a>"
    df = spark.createDataFrame([("http://x.example/i.html", html), ("p", None)], "url string, html string")
    got = readers.parse_index(df, title_base="医療機器の保険適用について").collect()
    assert [(r["url"], r["section"], r["doc_id"], r["kind"], r["notice_date"]) for r in got] == [("http://x.example/a/000502873.pdf", "令和8年度", "000502873", "notice", date(2026, 8, 31))]


def test_sinks_and_streams(spark, tmp_path):
    df = spark.createDataFrame([("s1", 1), ("s2", 2)], "snapshot string, v int")
    out = str(tmp_path / "snaps")
    writers.replace_partitions(df, out)
    writers.replace_partitions(df.where("v = 2").withColumn("v", F.lit(5)), out)
    assert rows(spark.read.parquet(out), "snapshot", "v") == [("s1", 1), ("s2", 5)]
    src = str(tmp_path / "in")
    df.write.parquet(src)
    stream = incremental.new_files(spark, src, "snapshot string, v int")
    incremental.run_once(stream, incremental.snapshots_into(str(tmp_path / "o2")), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o2")).count() == 2
    assert len(writers.payload({"a": df})) > 10
    writers.write_csv(df.withColumn("t", F.lit("a\x07")), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first()["t"] == "a"


def test_reconcile_and_supersede(spark):
    a, b = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double"), spark.createDataFrame([(2, 2.2), (3, 1.0)], "k int, v double")
    assert rows(diff.reconcile(a, b, ["k"], "v"), "kind", "n") == [("equal", 1), ("only_left", 1), ("only_right", 1)]
    assert rows(diff.upsert(a, b, ["k"]), "k", "v") == [(1, 1.0), (2, 2.2), (3, 1.0)]


def test_inferred_usage_follows_single_successors(spark):
    d = date
    ended = spark.createDataFrame([("A", "c1"), ("B", "x1")], "entity string, code string")
    edges = spark.createDataFrame([("c1", "c2"), ("c2", "c3"), ("x1", "x2"), ("x1", "x3"), ("c3", "c4")], "code string, next string")
    retired = spark.createDataFrame([("c1", d(2015, 9, 30)), ("c2", d(2018, 3, 31)), ("c3", None), ("x1", d(2016, 1, 1))], "code string, retired date")
    got = usage.inferred_usage(ended, edges, retired)
    assert rows(got, "entity", "code", "since", "until") == [("A", "c2", d(2015, 10, 1), d(2018, 3, 31)), ("A", "c3", d(2018, 4, 1), None)]
