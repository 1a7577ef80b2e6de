"""Golden cases of the text functions."""

import random
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from chronofold.functions import text


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(("value", "expected"), [("令和８年９月１日から", date(2026, 9, 1)), ("平成31年3月29日", date(2019, 3, 29)), ("令和元年8月30日", date(2019, 8, 30)), ("令和8年13月1日", None), (None, None)])
def test_era_date(spark, value, expected):
    assert one(spark, value, text.era_date) == expected
    assert one(spark, value, lambda c: text.era_date(c, unicode=False)) == expected


@pytest.mark.parametrize("value", ["30800BZX00176000", "308AABZX00017000", "13B1X10166001027", "229ABBZX00080Z00", "22500BZX00021A03"])
def test_is_approval(spark, value):
    assert one(spark, value, text.is_approval)


@pytest.mark.parametrize("value", ["承認番号又は認証番号", "4580580441388", None])
def test_is_no_approval(spark, value):
    assert not one(spark, value, text.is_approval)


def test_gtin(spark):
    assert one(spark, "4580580441388", text.gtin_ok)
    assert not one(spark, "4580580441389", text.gtin_ok)
    assert not one(spark, "45805804413", text.gtin_ok)


@pytest.mark.parametrize(
    ("cell", "products", "annex"),
    [
        ("ULTRABRIDGEキット 4580387600308", [("ULTRABRIDGEキット", "4580387600308")], None),
        ("PICO創傷治療システム PICO7-T 陰圧維持管理装置 4580443838317\n4580443838324", [("PICO創傷治療システム PICO7-T 陰圧維持管理装置", "4580443838317"), ("PICO創傷治療システム PICO7-T 陰圧維持管理装置", "4580443838324")], None),
        ("別表３のとおり", [], "3"), (None, [], None), ("名前だけ", [("名前だけ", None)], None),
    ],
)
def test_split_products(spark, cell, products, annex):
    got = one(spark, cell, text.split_products)
    assert [(p["name"], p["code"]) for p in got["products"]] == products and got["annex"] == annex


@pytest.mark.parametrize(
    ("cell", "products"),
    [
        ("A\n45805804413\n88", [("A", "4580580441388")]),  # a broken code
        ("4580387600308\nName after\nand more", [("Name after and more", "4580387600308")]),
        ("One 4580387600308\ntail\n4580443838317", [("One tail", "4580387600308"), ("One tail", "4580443838317")]),
        ("One 4580387600308 4580443838317\nNext\n4580443838324\nlast", [("One", "4580387600308"), ("One", "4580443838317"), ("Next", "4580443838324"), ("last", None)]),
        ("4580580441388\n12", [("12", "4580580441388")]),  # a right code isn't made wrong
    ],
)
def test_names_and_codes_by_place(spark, cell, products):
    assert [(p["name"], p["code"]) for p in one(spark, cell, text.split_products)["products"]] == products


@pytest.mark.parametrize(
    ("title", "kind"),
    [("医療の適用について(令和8年)", "notice"), ("「医療の適用について」（令和8年）", "notice"), ("｢医療の適用について｣ (1)", "notice"), ("先の医療の適用について(令和8年)", None), ("「医療の適用について」の一部訂正について", "correction"), ("医療の適用について(差替)", "replacement"), ("「医療の適用について」の一部改正", "amendment"), ("別の件", None), (None, None)],
)
def test_document_kind(spark, title, kind):
    assert one(spark, title, lambda c: text.document_kind(c, "医療の適用について")) == kind


def test_name_keys(spark):
    assert one(spark, "コーヒ―・ｺｰﾋ- Ⅻ", text.norm_name) == one(spark, "コーヒ－ コーヒ～ Ⅻ", text.norm_name) != one(spark, "コーヒーコーヒーⅫ", text.norm_name)
    assert one(spark, "カテーテル・カテーテル（Ⅱ）・先", text.norm_master) == "カテーテル2先"
    assert one(spark, None, text.norm_master) == "" and one(spark, "012　Ａ ①Ａ-B", text.norm_category) == "AーB"


def plain_distance(a, b, limit):
    group = {(x, y) for g in text.CONFUSABLE for x in g for y in g}
    table = [[float(i + j) if not i or not j else 0.0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            swap = 0.0 if a[i - 1] == b[j - 1] else 0.4 if (a[i - 1], b[j - 1]) in group else 1.0
            table[i][j] = min(table[i - 1][j - 1] + swap, table[i - 1][j] + 1, table[i][j - 1] + 1)
    return limit + 1 if abs(len(a) - len(b)) > limit or any(min(r) > limit for r in table[1:]) else table[-1][-1]


def test_distances_of_many_pairs():
    import random

    draw = random.Random(3)
    a = ["".join(draw.choice("B8Z2O01IX") for _ in range(draw.randint(0, 16))) for _ in range(500)]
    b = ["".join(c if draw.random() > 0.2 else draw.choice(["", "8", "0", "X1"]) for c in x) for x in a]
    assert text._distances(a, b, 3.0) == pytest.approx([plain_distance(x, y, 3.0) for x, y in zip(a, b, strict=True)])


def test_price(spark):
    assert tuple(one(spark, "¥29,600", text.price)) == (29600.0, None)
    assert one(spark, "1㎠当たり¥452", text.price)["value"] == 452.0
    assert one(spark, "1㎠当たり¥452", text.price)["unit"] == "1cm2当たり"
    assert one(spark, "2枚1組¥17,600", text.price)["value"] == 17600.0
    assert tuple(one(spark, "なし", text.price)) == (None, None)


def test_heading(spark):
    h = one(spark, "製品（販売）名・製品コードに追加・変更があったものの保険適用（区分Ｂ１）保険適用開始年月日：令和8年9月1日", text.heading)
    assert (h["action"], h["class"], h["effective"]) == ("add", "B1", date(2026, 9, 1))
    h = one(spark, "２．歯科\n新たな保険適用 区分Ｃ１（新機能）", text.heading)
    assert (h["setting"], h["action"], h["class"]) == ("歯科", "new", "C1")


def test_category_names_agree(spark):
    a = one(spark, "010 血管造影用ﾏｲｸﾛｶﾃｰﾃﾙ (1)ｵｰﾊﾞｰｻﾞﾜｲﾔｰ ①選択的ｱﾌﾟﾛｰﾁ型 ｱ ﾌﾞﾚｰﾄﾞあり", text.norm_category)
    assert a == one(spark, "血管造影用マイクロカテーテル・オーバーザワイヤー・選択的アプローチ型・ブレードあり", text.norm_master)
    assert one(spark, "010 血管造影用", text.category_no) == "010"


@pytest.mark.parametrize(("read", "fixed"), [("2O6OOBZZOO666AO1", "20600BZZ00666A01"), ("22OADBZXOO121OOO", "220ADBZX00121000"), ("21800B2X10056000", "21800BZX10056000"), ("short", "short")])
def test_repair_approval(spark, read, fixed):
    assert one(spark, read, text.repair_approval) == fixed


def test_small_helpers(spark):
    assert [one(spark, k, text.norm_class) for k in ("B", "C1", "C")] == ["B1", "C1", "C?"]
    assert one(spark, "ＫＺＲ－ＣＡＤ ファイバーブロック", text.norm_name) == one(spark, "ＫＺＲ―ＣＡＤ　ファイバーブロック", text.norm_name)
    assert one(spark, "B・指定承認番号２２５００ＢＺＸ００２９４０００", text.designated_approval) == "22500BZX00294000"
    assert one(spark, "B・指定承認番号２２５００ＢＺＸ００２９４０００", text.strip_designation) == "B"
    assert one(spark, "t_ALL20151228.zip", text.file_date) == "20151228"
    assert one(spark, "0", text.schedule_no) == "0" and one(spark, "02", text.schedule_no) == "2" and one(spark, "", text.class_no) == "000"
    assert one(spark, "a\x07b", text.strip_control) == "ab"


def test_hamming_and_distance(spark):
    df = spark.createDataFrame([("4521", "4527"), ("452", "4521"), ("8000", "B000"), ("12", "21")], "a string, b string")
    rows = df.select(text.hamming_one(F.col("a"), F.col("b")).alias("h"), text.weighted_distance(F.col("a"), F.col("b")).alias("d")).collect()
    assert [r["h"] for r in rows] == [True, False, True, False]
    assert [r["d"] for r in rows] == [1.0, 1.0, 0.4, 2.0]


def test_check_digits_by_arithmetic(spark):
    """Against the plain rule; codes aren't split into arrays of characters."""
    draw = random.Random(8)
    codes = ["".join(draw.choices("0123456789", k=n)) for n in (7, 8, 9, 12, 13, 14, 15) for _ in range(150)] + ["00000000", "99999999999999", "1234567a", "-1234567", " 1234567", "４５８０４５８０", "12345670\n", "", None]
    df = spark.createDataFrame([(x,) for x in codes], "code string").withColumn("ok", text.gtin_ok(F.col("code")))
    assert {r["code"]: r["ok"] for r in df.collect()} == {x: x is not None and bool(re.fullmatch("[0-9]*", x)) and text._gtin_ok(x) for x in codes}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "aggregate(" not in plan
