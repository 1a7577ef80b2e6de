"""Readers: master files (CSV or ZIP in cp932), index pages, manifests, parsed documents, wide product tables, foreign events."""

from __future__ import annotations

import csv
import io
import itertools
import re
import sys
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from chronofold.functions import text
from chronofold.sources import schemas

#: Places of the fields in a master row; fixed values of the format.
MASTER_FIELDS = {"change_flag": 0, "code": 2, "name": 4, "unit": 9, "price_kind": 10, "price": 11, "change_date": 27, "abolish_date": 29, "beppyo": 30, "kubun_no": 31, "basic_name": 36}
LEAST_FIELDS, ROW_TYPE = 32, "T"


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _members(path: str, content: bytes) -> Iterator[bytes]:
    if path.lower().endswith(".zip"):
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for name in sorted(z.namelist()):
                if name.lower().endswith(".csv"):
                    yield z.read(name)
    else:
        yield content


def read_master(spark: SparkSession, path: str) -> DataFrame:
    """Master rows of all CSV and ZIP files below a path: one task for each file, rows of the right type and width alone."""
    schema = "path string, " + ", ".join(f"{c} string" for c in MASTER_FIELDS)
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows: list[list] = []
                for data in _members(p, content):
                    for r in csv.reader(io.StringIO(data.decode("cp932", errors="replace"), newline="")):
                        if len(r) >= LEAST_FIELDS and r[1] == ROW_TYPE:
                            rows.append([p, *[r[i] if i < len(r) else "" for i in MASTER_FIELDS.values()]])
                for at in range(0, len(rows), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows[at : at + 10_000], strict=True)], schema=arrow)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{csv,CSV,zip,ZIP}").load(path).select("path", "content")
    raw = files.mapInArrow(run, schema)
    name = F.regexp_extract("path", "([^/]+)$", 1)
    return raw.select(
        name.alias("file"), text.file_date(name).alias("file_date"), "change_flag", "code", "name", "unit", "price_kind", text.number(F.col("price")).alias("price"),
        "change_date", "abolish_date", text.schedule_no(F.col("beppyo")).alias("beppyo"), text.class_no(F.col("kubun_no")).alias("kubun_no"), "basic_name",
    )


def master_deltas(master: DataFrame) -> DataFrame:
    """Master rows as deltas: blanks are null (unchanged), a reset end is an empty text. Rows without a code or date go."""
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    end = F.when(F.col("abolish_date").isin("00000000", "99999999"), "").otherwise(F.date_format(text.compact_date(F.col("abolish_date")), "yyyy-MM-dd"))
    return master.where("code != '' and change_date != '' and change_date != '00000000'").select(
        "code", text.compact_date(F.col("change_date")).alias("valid_from"), "file_date", "price",
        *[blank(c).alias(c) for c in ("unit", "name", "basic_name", "beppyo")],
        F.when(F.col("kubun_no") != "000", blank("kubun_no")).alias("kubun_no"), end.alias("abolish"),
    )


class _Index(HTMLParser):
    """Links to documents with the last heading of a fiscal year before them."""

    def __init__(self, base: str) -> None:
        super().__init__(convert_charrefs=True)
        self.base, self.section, self.found = base, None, []
        self.heading: list[str] | None = None
        self.link: list | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("h2", "h3", "h4"):
            self.heading = []
        elif tag == "a" and (href := dict(attrs).get("href")):
            self.link = [href, []]

    def handle_data(self, data: str) -> None:
        if self.heading is not None:
            self.heading.append(data)
        if self.link is not None:
            self.link[1].append(data)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("h2", "h3", "h4") and self.heading is not None:
            title = " ".join("".join(self.heading).split())
            if "年度" in title:
                self.section = title
            self.heading = None
        elif tag == "a" and self.link is not None:
            self.found.append((urljoin(self.base, self.link[0]), " ".join("".join(self.link[1]).split()), self.section))
            self.link = None


def parse_index(pages: DataFrame, url_col: str = "url", html_col: str = "html", suffix: str | None = ".pdf", title_base: str | None = None) -> DataFrame:
    """Links of index pages: page, position, url, title, section, doc_id, kind, notice_date, effective_date. Of equal addresses of a page the first stays."""
    schema = "page string, position int, url string, title string, section string"
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parser = _Index(page or "")
                parser.feed(html or "")
                parser.close()
                seen = set()
                for n, (url, title, section) in enumerate(parser.found):
                    if url not in seen and (suffix is None or url.lower().endswith(suffix)):
                        seen.add(url)
                        rows.append((page, n, url, title, section))
            yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, r, strict=True)) for r in rows], schema=arrow)

    links = pages.select(F.col(url_col).cast("string"), F.col(html_col).cast("string")).mapInArrow(run, schema)
    dates = text.era_dates(F.col("title"))
    out = links.withColumns({"doc_id": text.document_id(F.col("url")), "notice_date": F.try_element_at(dates, F.lit(1)), "effective_date": F.try_element_at(dates, F.lit(2))})
    if title_base:
        out = out.withColumn("kind", text.document_kind(F.col("title"), title_base)).where("kind is not null")
    return out


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MANIFEST).option("multiLine", True).json(path)


def read_parsed(spark: SparkSession, path: str) -> DataFrame:
    """Parsed documents (JSON, also gzip), one row each, with the file's stem as doc_id."""
    rows = spark.read.schema(schemas.PARSED).option("multiLine", True).json(path)
    return rows.withColumn("doc_id", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)\.json(\.gz)?$", 1))


def records_of(parsed: DataFrame) -> DataFrame:
    return parsed.select(F.explode("records").alias("r")).select("r.*")


def stale_documents(manifest: DataFrame, parsed: DataFrame, version: int) -> DataFrame:
    """Manifest rows whose parsed document is missing, unreadable or of another version and not read by OCR."""
    fresh = parsed.where((F.col("error").isNull()) & ((F.col("version") == version) | F.coalesce("ocr", F.lit(False)))).select("doc_id")
    return manifest.join(fresh, "doc_id", "left_anti")


def read_wide_products(spark: SparkSession, path: str, required: list[str], encoding: str = "cp932") -> DataFrame:
    """Wide product tables with headers, as strings: one task for each file, columns by name, absent and empty fields null.

    Fails if a file's header lacks a required column, or if no file has one.
    """
    files = spark.read.format("binaryFile").load(path).select("content")

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[list[str]]]:
        for batch in batches:
            for content in batch.column(0):
                yield csv.reader(io.TextIOWrapper(io.BytesIO(content.as_buffer()), encoding, errors="replace", newline=""))

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables(batches):
            yield pa.RecordBatch.from_arrays([pa.array([next(table, [])], pa.list_(pa.string()))], names=["header"])

    headers = sorted(r["header"] for r in files.mapInArrow(heads, "header array<string>").distinct().collect())  # one row for each layout
    if missing := [c for c in required if not headers or any(c not in h for h in headers)]:
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    names = [c for c in dict.fromkeys(c for h in headers for c in h) if c]
    kinds = StructType()
    for c in names:
        kinds.add(c, "string")
    arrow = to_arrow_schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables(batches):
            places = {c: i for i, c in enumerate(next(table, []))}
            order = [places.get(c, sys.maxsize) for c in names]
            while rows := list(itertools.islice(table, 10_000)):
                filled = [r for r in rows if r]
                yield pa.RecordBatch.from_arrays([pa.array([(r[i] if i < len(r) else "") or None for r in filled], pa.string()) for i in order], schema=arrow)

    return files.mapInArrow(run, kinds)


def foreign_events(df: DataFrame) -> DataFrame:
    """Events of another system with their changed fields as rows' arrays."""
    return df.withColumn("changed_fields", F.from_json("changed_fields", schemas.CHANGED_FIELDS))


