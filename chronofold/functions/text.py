"""Text functions as columns. Built-in functions where Spark has them; Arrow UDFs for Unicode forms and similarity."""

from __future__ import annotations

import difflib
import itertools
import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructType

PRODUCTS = StructType().add("products", ArrayType(StructType().add("name", StringType()).add("code", StringType()))).add("annex", StringType())

# Fixed values ------------------------------------------------------------------------------------------------
#: Years before the first year of each era.
ERA_BASE = {"令和": 2018, "平成": 1988, "昭和": 1925}
APPROVAL = "^[0-9A-Z]{3,5}[0-9A-Z]{2,4}[0-9A-Z]{6,10}$"
PRODUCT_CODE = r"(?<![0-9A-Za-z])(\d{8,14})(?![0-9A-Za-z])"
ANNEX = r"別表\s*([0-9０-９]+)\s*の?とおり"
CLASS = r"区分\s*([ABCEFR])\s*([0-9]?)"
PRICE = r"[¥￥]\s*([0-9,，]+(?:\.[0-9]+)?)"
DESIGNATION = r"指定承認番号[・･\s]*([0-9A-Z]{14,17})"
ROMAN = {"Ⅰ": "1", "Ⅱ": "2", "Ⅲ": "3", "Ⅳ": "4", "Ⅴ": "5", "Ⅵ": "6", "Ⅶ": "7", "Ⅷ": "8", "Ⅸ": "9", "Ⅹ": "10", "Ⅺ": "11", "Ⅻ": "12"}
ENUMERATION = (
    r"[（(]\s*[0-9０-９]+\s*[）)]",
    r"[①-⑳㉑-㉟]",
    r"(?<![^\s　・･])[ｱｲｳｴｵｶｷｸｹｺｻｼｽｾｿﾀﾁﾂﾃﾄアイウエオカキクケコサシスセソタチツテト](?=[\s　])",
    r"[ⅰ-ⅿ]+",
    r"(?<![^\s　])(?:i|ii|iii|iv|v|vi|vii|viii|ix|x)(?=[\s　])",
)
#: What a local document's title says after its base, by kind, and the start of its id.
KIND_TITLES = {"notice": "", "correction": "の一部訂正", "replacement": "（別紙の差し替え）", "amendment": "の一部改正"}
LOCAL_PREFIX = "local_"
DASHES = "‐‑‒–—―−－~〜～"
#: In compared names: the signs that don't count, and those that are read as the long-vowel mark.
IGNORED, LONG_VOWELS = "・･,，、()（）[]「」", "―－-"
NUMBERED = r"^\s*[0-9０-９]{3}\s*"
DESIGNATED = r"[・･]?指定承認番号[・･\s]*[0-9A-Z０-９Ａ-Ｚ]{14,17}|[・･]?指定(番号\S*)?$"
#: Groups of characters that readers confuse, and the letters and digits that stand for each other by position.
CONFUSABLE = ("B83", "Z27", "O0DQ", "I1LT", "S5", "G6", "A4")
LETTERS_READ, DIGITS_MEANT = "ODQILTSBGZA", "00011158624"
DIGITS_READ, LETTERS_MEANT = "8201564", "BZOISGA"

FULL_WIDTH = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
HALF_WIDTH = "".join(chr(c) for c in range(0x21, 0x7F)) + " "


# Unicode forms -----------------------------------------------------------------------------------------------
@pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def half_width(c: Column) -> Column:
    """Full-width ASCII and the ideographic space in half width: the part of NFKC that needs no Python."""
    return F.translate(c, FULL_WIDTH, HALF_WIDTH)


def clean(c: Column) -> Column:
    """Ideographic spaces become spaces, runs of spaces and tabs one, ends are trimmed; null becomes empty."""
    return F.regexp_replace(F.regexp_replace(F.translate(F.coalesce(c, F.lit("")), "　", " "), "[ \\t]+", " "), "^(?U)\\s+|(?U)\\s+$", "")


def one_line(c: Column) -> Column:
    """Lines joined, with a space only between alphanumerics or parentheses on both sides."""
    c = F.regexp_replace(clean(c), r"(?U)\s*\n\s*", "\n")
    c = F.regexp_replace(c, r"(?<=[0-9A-Za-z)）])\n(?=[0-9A-Za-z(（])", " ")
    return F.regexp_replace(c, "\n", "")


def norm_approval(c: Column, unicode: bool = True) -> Column:
    return F.upper(F.regexp_replace((nfkc if unicode else half_width)(F.coalesce(c, F.lit(""))), r"(?U)\s+", ""))


def is_approval(c: Column, unicode: bool = True) -> Column:
    v = norm_approval(c, unicode)
    return (F.length(v) >= 14) & v.rlike(APPROVAL) & F.substring(v, 1, 3).rlike("[0-9]")


def norm_category_text(c: Column) -> Column:
    return F.regexp_replace(nfkc(F.coalesce(c, F.lit(""))), r"(?U)\s+", "")


def norm_name(c: Column) -> Column:
    """For comparing names: one kind of dash, no spaces or middle dots, upper case."""
    c = F.translate(nfkc(F.coalesce(c, F.lit(""))), DASHES, "-" * len(DASHES))
    return F.upper(F.regexp_replace(c, r"(?U)[\s・･]", ""))


_READ = str.maketrans(ROMAN)
_MEANT = str.maketrans({**dict.fromkeys(IGNORED), **dict.fromkeys(LONG_VOWELS, "ー")})


def _name_key(text: str, border: re.Pattern) -> str:
    """The letters of a name's parts, from the last part to the first; one that the part after it begins with is left out."""
    key = after = ""
    for part in reversed(border.split(text)):
        letters = "".join(unicodedata.normalize("NFKC", part.translate(_READ)).translate(_MEANT).split())
        if letters:
            key = key if after.startswith(letters) else letters + key
            after = letters
    return key


@pandas_udf(StringType())
def norm_category(s: pd.Series) -> pd.Series:
    """A listed category for comparison: without its number and enumeration marks, repeated upper names folded."""
    border, numbered = re.compile("|".join(["[|]", *ENUMERATION])), re.compile(NUMBERED)
    return s.map(lambda x: _name_key(numbered.sub("", x or ""), border))


@pandas_udf(StringType())
def norm_master(s: pd.Series) -> pd.Series:
    """A master name for comparison: its parts between middle dots, repeated upper names folded."""
    border = re.compile("[・･]")
    return s.map(lambda x: _name_key(x or "", border))


def category_no(c: Column) -> Column:
    return F.nullif(F.regexp_extract(half_width(c), r"^(?U)\s*([0-9]{3})", 1), F.lit(""))


# Dates -------------------------------------------------------------------------------------------------------
def era_dates(c: Column, unicode: bool = True) -> Column:
    """All era dates in a text, in order; impossible ones are left out."""
    t = (nfkc if unicode else half_width)(F.coalesce(c, F.lit("")))
    pattern = F.lit(r"(?U)(令和|平成|昭和)\s*(元|\d+)\s*年\s*(\d+)\s*月\s*(\d+)\s*日")
    era, year, month, day = (F.regexp_extract_all(t, pattern, F.lit(i)) for i in range(1, 5))
    base = F.create_map(*[F.lit(x) for kv in ERA_BASE.items() for x in kv])

    def iso(x: Column) -> Column:
        y = base[x["e"]] + F.when(x["y"] == "元", F.lit("1")).otherwise(x["y"]).try_cast("int")
        return F.try_to_date(F.format_string("%04d-%02d-%02d", y, x["m"].try_cast("int"), x["d"].try_cast("int")), "yyyy-MM-dd")

    parts = F.arrays_zip(era.alias("e"), year.alias("y"), month.alias("m"), day.alias("d"))
    return F.filter(F.transform(parts, iso), lambda d: d.isNotNull())


def era_date(c: Column, unicode: bool = True) -> Column:
    return F.try_element_at(era_dates(c, unicode), F.lit(1))


def era_text(d: Column) -> Column:
    """A date of the current era as text."""
    return F.concat(F.lit("令和"), (F.year(d) - ERA_BASE["令和"]).cast("string"), F.lit("年"), F.month(d).cast("string"), F.lit("月"), F.dayofmonth(d).cast("string"), F.lit("日"))


def compact_date(c: Column) -> Column:
    """yyyyMMdd with the sentinels of no date as null."""
    return F.when(~c.isin("", "00000000", "99999999"), F.try_to_date(c, "yyyyMMdd"))


def file_date(name: Column) -> Column:
    """The eight digits of a file name, or 20 and six digits, as text; else empty."""
    eight, six = F.regexp_extract(name, "([0-9]{8})", 1), F.regexp_extract(name, "([0-9]{6})", 1)
    return F.when(eight != "", eight).when(six != "", F.concat(F.lit("20"), six)).otherwise("")


# Codes, prices and labels ------------------------------------------------------------------------------------
def gtin_ok(c: Column) -> Column:
    """Whether a code of 8, 12, 13 or 14 digits has the right GS1 check digit."""
    digit = lambda v, i: F.call_function("div", v, F.lit(10**i).cast("bigint")) % 10
    total = lambda v: sum((digit(v, i) * (3 if i % 2 else 1) for i in range(1, 14)), digit(v, 0))
    ok = F.transform(F.array(c.try_cast("bigint")), lambda v: total(v) % 10 == 0)[0]  # names the code once, as plans put its expression in place of its name
    return F.when(c.rlike(r"^([0-9]{8}|[0-9]{12,14})\z"), ok).otherwise(False)


def price(c: Column) -> Column:
    """struct(value, unit): the first amount in yen, and what stands before it."""
    t = nfkc(one_line(c))
    value = F.regexp_replace(F.regexp_extract(t, PRICE, 1), "[,，]", "").try_cast("double")
    unit = F.nullif(F.trim(F.regexp_extract(t, r"^(?s)(.*?)[¥￥]\s*[0-9,，]+", 1)), F.lit(""))
    return F.struct(value.alias("value"), F.when(value.isNotNull(), unit).alias("unit"))


def price_label(p: Column, unit: Column | None = None) -> Column:
    whole = F.when(p == F.floor(p), F.format_number(p, 0)).otherwise(F.format_number(p, 2))
    text = F.concat(F.lit("¥"), whole)
    if unit is not None:
        text = F.concat(text, F.when(F.coalesce(unit, F.lit("")) != "", F.concat(F.lit("/"), unit)).otherwise(""))
    return F.coalesce(text, F.lit("—"))


def price_digits(p: Column) -> Column:
    """A price as digits, without a decimal point where it is whole."""
    return F.when(p == F.floor(p), p.cast("bigint").cast("string")).otherwise(p.cast("string"))


def price_suffixes(p: Column, most: int = 3) -> Column:
    """The price and what is left after up to ``most`` leading digits are dropped, if that doesn't start with 0."""
    t = price_digits(p)
    tails = F.transform(F.sequence(F.lit(0), F.lit(most)), lambda i: F.substring(t, i + 1, F.length(t)))
    return F.transform(F.filter(tails, lambda x: x.rlike("^[1-9]")), lambda x: x.try_cast("double"))


def norm_class(c: Column) -> Column:
    t = F.trim(F.coalesce(c, F.lit("")))
    return F.when(t == "B", "B1").when(t == "C", "C?").otherwise(t)


def strip_designation(c: Column) -> Column:
    """A class without the designation that may follow it."""
    return F.trim(F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), DESIGNATED, ""))


def designated_approval(c: Column) -> Column:
    return F.nullif(F.regexp_extract(half_width(c), DESIGNATION, 1), F.lit(""))


def heading(c: Column) -> Column:
    """What a table heading says: struct(setting, action, class, effective, heading); null where it says nothing."""
    t = half_width(F.coalesce(c, F.lit("")))
    setting = F.when(t.rlike(r"3[.．]\s*調剤"), "調剤").when(t.rlike(r"(?m)[123][.．]\s*歯科|^\s*歯科\s*$"), "歯科").when(t.rlike(r"(?m)[12][.．]\s*医科|^\s*医科\s*$"), "医科")
    action = F.when(t.contains("新たな保険適用"), "new").when(t.contains("追加・変更") | t.contains("追加･変更"), "add")
    kind = F.nullif(F.concat(F.regexp_extract(t, CLASS, 1), F.regexp_extract(t, CLASS, 2)), F.lit(""))
    after = F.when(t.contains("適用開始"), F.substring(t, F.instr(t, "適用開始"), F.length(t)))
    title = F.when(action.isNotNull() | kind.isNotNull(), F.substring(F.trim(F.regexp_replace(t, r"(?U)\s+", " ")), 1, 200))
    return F.struct(setting.alias("setting"), action.alias("action"), kind.alias("class"), era_date(after, unicode=False).alias("effective"), title.alias("heading"))


def document_kind(title: Column, base: str) -> Column:
    """notice, correction, replacement or amendment by title; null for others.

    A notice's title starts with the base, which may stand in corner brackets, and goes on with a parenthesis.
    """
    t = nfkc(title)
    plain = t.rlike("^「?" + re.escape(base) + r"」?(?U)\s*\(")
    return F.when(~t.contains(base), None).when(t.contains("一部訂正"), "correction").when(t.rlike("差し替え|差替"), "replacement").when(t.contains("一部改正"), "amendment").when(plain, "notice")


def cover(c: Column, base: str) -> Column:
    """What a cover says: struct(doc_id, kind, title, notice_date, effective_date) of a document that no index lists yet.

    Null if the base or a date is missing. The first date is the notice's; the one before "から" is that of effect.
    """
    t = F.regexp_replace(nfkc(F.coalesce(c, F.lit(""))), r"(?U)\s+", "")
    kind = F.when(t.contains("一部訂正"), "correction").when(t.rlike("差し替え|差替"), "replacement").when(t.contains("一部改正"), "amendment").otherwise("notice")
    number = r"保医発(\d{4})第(\d+)号"
    series, no = F.regexp_extract(t, number, 1), F.coalesce(F.nullif(F.regexp_extract(t, number, 2), F.lit("")), F.lit("0"))
    noticed, effective = era_date(t, unicode=False), era_date(F.regexp_extract(t, r"((令和|平成)(元|\d+)年\d+月\d+日)から", 1), unicode=False)
    label = F.create_map(*[F.lit(x) for kv in KIND_TITLES.items() for x in kv])[kind]
    since = F.when((kind == "notice") & effective.isNotNull(), F.concat(F.lit("（"), era_text(effective), F.lit("から新たに適用）"))).otherwise("")
    title = F.concat(F.lit(base), label, since, F.lit("（"), era_text(noticed), F.lit("）［手元PDF・保医発"), series, F.lit("第"), no, F.lit("号］"))
    doc_id = F.concat(F.lit(LOCAL_PREFIX), F.date_format(noticed, "yyyyMMdd"), F.lit("_"), kind, F.lit("_"), no)
    found = F.struct(doc_id.alias("doc_id"), kind.alias("kind"), title.alias("title"), noticed.alias("notice_date"), effective.alias("effective_date"))
    return F.when(t.contains(base) & noticed.isNotNull(), found)


def document_id(url: Column) -> Column:
    """The nine-digit stem of a document's address, else its path with other characters as underscores."""
    stem = F.regexp_extract(url, r"([0-9]{9})\.pdf$", 1)
    path = F.regexp_replace(F.regexp_replace(url, r"^[a-z]+://[^/]*/?", ""), r"\.pdf$", "")
    return F.when(stem != "", stem).otherwise(F.trim(F.regexp_replace(path, "[^0-9A-Za-z]+", "_")))


def slot_label(n: Column) -> Column:
    """A slot number in two full-width digits."""
    return F.translate(F.lpad(n.cast("string"), 2, "0"), "0123456789", "０１２３４５６７８９")


def number(c: Column) -> Column:
    """A number with separators; empty and bad texts are null."""
    return F.regexp_replace(c, "[,，]", "").try_cast("double")


def strip_control(c: Column) -> Column:
    return F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")


def schedule_no(c: Column) -> Column:
    """Without leading zeros, but not empty for a zero."""
    return F.coalesce(F.nullif(F.ltrim(c, F.lit("0")), F.lit("")), c)


def class_no(c: Column) -> Column:
    return F.when(F.length(c) >= 3, c).otherwise(F.lpad(c, 3, "0"))


# Similarity and repair ---------------------------------------------------------------------------------------
@pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """difflib's ratio, which depends on the order of its arguments; 1 for equal texts."""
    return pd.Series([None if x is None or y is None else 1.0 if x == y else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)])


_GROUP = np.full(0x110000, -1, np.int8)
for _i, _g in enumerate(CONFUSABLE):
    _GROUP[[ord(_c) for _c in _g]] = _i


def _coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts in rows of equal width, and the texts' lengths."""
    size = np.array([len(t) for t in texts], np.int64)
    width = int(size.max(initial=0))
    return np.frombuffer("".join(t.ljust(width, "\0") for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(texts), width), size


def _distances(a: list[str], b: list[str], limit: float) -> np.ndarray:
    """Edit distances of many pairs at once, in which swaps inside a confusable group cost 0.4; limit + 1 for a pair as soon
    as it must exceed the limit."""
    (x, m), (y, n) = _coded(a), _coded(b)
    far = np.abs(m - n) > limit
    cells = np.arange(y.shape[1] + 1)
    beyond = cells[None, :] > n[:, None]
    row = np.repeat(cells[None, :].astype(float), len(a), axis=0)
    out = row[np.arange(len(a)), n]
    for i in range(x.shape[1]):
        same = x[:, i, None] == y
        alike = (_GROUP[x[:, i, None]] == _GROUP[y]) & (_GROUP[y] >= 0)
        best = np.minimum(row[:, :-1] + np.where(same, 0.0, np.where(alike, 0.4, 1.0)), row[:, 1:] + 1)
        row = np.concatenate([np.full((len(a), 1), i + 1.0), best], axis=1)
        for j in range(1, row.shape[1]):  # the steps along a row depend on each other
            np.minimum(row[:, j], row[:, j - 1] + 1, out=row[:, j])
        now = i < m
        far |= now & (np.where(beyond, np.inf, row).min(axis=1) > limit)
        last = i + 1 == m
        out[last] = row[last, n[last]]
    return np.where(far, limit + 1, out)


def weighted_distance(a: Column, b: Column, limit: float = 3.0) -> Column:
    @pandas_udf(DoubleType())
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        both = (x.notna() & y.notna()).to_numpy()
        out = np.full(len(x), np.nan)
        at = np.flatnonzero(both)
        for start in range(0, len(at), 4096):
            part = at[start : start + 4096]
            out[part] = _distances(x.iloc[part].tolist(), y.iloc[part].tolist(), limit)
        return pd.Series(out).astype(object).where(both, None)

    return run(a, b)


def hamming_one(a: Column, b: Column) -> Column:
    """Equal lengths and exactly one different character."""
    differ = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x == y, 0).otherwise(1))
    return (F.length(a) == F.length(b)) & (F.aggregate(differ, F.lit(0), lambda s, d: s + d) == 1)


def repair_approval(c: Column) -> Column:
    """Letters and digits of a 16-character number put right by position, for its two layouts; others stay."""
    digits = lambda x: F.translate(x, LETTERS_READ, DIGITS_MEANT)
    letters = lambda x: F.translate(x, DIGITS_READ, LETTERS_MEANT)
    part = lambda start, n: F.substring(c, start, n)
    tail = F.when(part(14, 1).rlike("[A-CE-NPR-Z]"), F.concat(part(14, 1), digits(part(15, 2)))).otherwise(digits(part(14, 3)))
    certified = part(4, 1).isin("A", "4") & part(5, 1).rlike("[A-Z84]")
    approved = part(6, 2).isin("BZ", "8Z", "B2", "82") | (part(6, 1).isin("B", "8") & part(8, 1).rlike("[XZYGI2]"))
    return (
        F.when(F.length(c) != 16, c)
        .when(certified, F.concat(digits(part(1, 3)), letters(part(4, 5)), digits(part(9, 5)), tail))
        .when(approved, F.concat(digits(part(1, 5)), F.lit("BZ"), letters(part(8, 1)), digits(part(9, 5)), tail))
        .otherwise(c)
    )


def digit_repairs(c: Column) -> Column:
    """Codes with a right check digit that differ from ``c`` in one confusable digit, or have one digit more."""
    like = {d: [y for g in CONFUSABLE for y in g if d in g and y != d and y.isdigit()] for d in "0123456789"}
    other = F.create_map(*[F.lit(x) if isinstance(x, str) else F.array(*[F.lit(y) for y in x]).cast("array<string>") for kv in like.items() for x in kv])
    n = F.length(c)
    swapped = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(other[F.substring(c, i, F.lit(1))], lambda d: F.concat(F.substring(c, F.lit(1), i - 1), d, F.substring(c, i + 1, n)))))
    every = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: d.cast("string"))
    longer = F.flatten(F.transform(F.sequence(F.lit(0), n), lambda i: F.transform(every, lambda d: F.concat(F.substring(c, F.lit(1), i), d, F.substring(c, i + 1, n)))))
    return F.array_distinct(F.filter(F.when(n == 12, longer).otherwise(swapped), gtin_ok))


# Cells with products -----------------------------------------------------------------------------------------
def _gtin_ok(code: str) -> bool:
    if len(code) not in (8, 12, 13, 14):
        return False
    return sum(int(d) * (3 if i % 2 else 1) for i, d in enumerate(reversed(code))) % 10 == 0


def _join_lines(lines: list[str]) -> str:
    text = "\n".join(x.strip() for x in lines if x.strip())
    return re.sub("\n", "", re.sub(r"(?<=[0-9A-Za-z)）])\n(?=[0-9A-Za-z(（])", " ", text))


def _mended(text: str) -> list[str]:
    """The filled lines of a cell, with codes that it broke made whole: one or two digits on a line of their own belong to
    the code above if they make it right, or if it wasn't right anyway."""

    def whole(m: re.Match) -> str:
        code, tail = m.groups()
        return code + tail if len(code + tail) <= 14 and (_gtin_ok(code + tail) or not _gtin_ok(code)) else m[0]

    text, before = "\n".join(filter(None, map(str.strip, text.split("\n")))), None
    while text != before:
        text, before = re.sub(r"(\d{8,13})\n(\d{1,2})$", whole, text, count=0, flags=re.MULTILINE), text
    return text.split("\n") if text else []


def _products(cell: str | None) -> dict:
    """Names and codes by place. Lines with codes cut a cell into stretches of name text.

    A stretch names the codes that follow it, together with the text beside them; codes without any take the name before.
    The stretch after a first line of one code ends that product's name instead. What is left at the end is a product
    without a code.
    """
    text = re.sub("[ \t]+", " ", (cell or "").replace("　", " ")).strip()
    if m := re.search(ANNEX, unicodedata.normalize("NFKC", text)):
        return {"products": [], "annex": m[1]}
    lines = _mended(text)
    codes = [re.findall(PRODUCT_CODE, x) for x in lines]
    at = [i for i, c in enumerate(codes) if c]
    stretches = [lines[i + 1 : j] for i, j in zip([-1, *at], [*at, len(lines)], strict=True)]
    beside = [re.sub(PRODUCT_CODE, "", lines[i]) for i in at]
    after = []
    if at and len(codes[at[0]]) == 1:
        after, stretches[1] = stretches[1], []
    named = [[*before, own] for before, own in zip(stretches, beside, strict=False)]
    if named:
        named[0] += after
    names = itertools.accumulate(map(_join_lines, named), lambda last, own: own or last)
    found = [(name, code) for name, i in zip(names, at, strict=True) for code in codes[i]]
    if stretches[-1]:
        found.append((_join_lines(stretches[-1]), None))
    return {"products": [{"name": n, "code": c} for n, c in found], "annex": None}


@pandas_udf(PRODUCTS)
def split_products(cell: pd.Series) -> pd.DataFrame:
    """The products (name, code) of a cell, or the number of the annex it points to."""
    return pd.DataFrame([_products(x) for x in cell], columns=["products", "annex"])
