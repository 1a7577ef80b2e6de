"""Row-level rules: target classes, date sanity, defaults, status and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronofold.functions import text

#: Schedules of dental items; fixed values.
DENTAL_SCHEDULES = ("4", "5", "6", "7")


def is_target_class(kubun: Column) -> Column:
    return F.coalesce(kubun.rlike("^[BCR]"), F.lit(False))


def feeds_listing(kind: Column, side: Column) -> Column:
    return kind.isin("notice", "replacement", "amendment") & F.coalesce(side, F.lit("added")).isin("added", "right")


def usable_approval(number: Column, fix: Column) -> Column:
    return F.coalesce(fix.isin("exact", "jan", "fuzzy", "page"), F.lit(False)) | text.is_approval(number)


def usable_code(code: Column, fix: Column) -> Column:
    return F.when((fix == "none") & ~text.gtin_ok(code), None).otherwise(code)


def default_effective(own: Column, notice_date: Column) -> Column:
    """The document's own date, else the first day of the month after the notice."""
    return F.coalesce(own, F.trunc(F.add_months(notice_date, 1), "MM"))


def sane_effective(effective: Column, notice_date: Column, default: Column) -> Column:
    return F.when(F.datediff(effective, notice_date).between(-40, 70), effective).otherwise(default)


def in_force(retired: Column, day: Column) -> Column:
    return F.coalesce(retired >= day, F.lit(True))


def setting_of(schedule: Column) -> Column:
    return F.when(schedule.isin(*DENTAL_SCHEDULES), "歯科").otherwise("医科")


def class_before_reform(kubun: Column, effective: Column) -> Column:
    """Class R did not exist before April 2018."""
    return F.when((kubun == "R") & (effective < F.lit("2018-04-01").cast("date")), "B").otherwise(kubun)


def plausible_price(read: Column, reference: Column) -> Column:
    return F.when(read.between(reference / 2.5, reference * 2.5), read)


def category_key(code: Column, category: Column) -> Column:
    return F.coalesce(F.nullif(code, F.lit("")), text.norm_category_text(category))


def document_status(parsed: Column, scanned: Column, ocr: Column) -> Column:
    return F.when(~F.coalesce(parsed, F.lit(False)), "未解析").when(F.coalesce(ocr, F.lit(False)), "OCR").when(F.coalesce(scanned, F.lit(False)), "スキャン画像").otherwise("解析済")


def labels(c: Column, names: dict) -> Column:
    """Labels of codes; codes without one stay."""
    out = None
    for k, v in names.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out.otherwise(c.cast("string"))


def document_address(url: Column, local: Column) -> Column:
    return F.coalesce(F.nullif(url, F.lit("")), F.nullif(local, F.lit("")), F.lit(""))
