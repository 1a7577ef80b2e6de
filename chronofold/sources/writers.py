"""Sinks: full rebuild, replaced partitions, CSV, report sheets and a self-contained HTML view."""

from __future__ import annotations

import base64
import gzip
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.functions import text


def rebuild(tables: dict[str, DataFrame], folder: str) -> None:
    """Writes each table anew as Parquet."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def replace_partitions(df: DataFrame, folder: str, by: str = "snapshot") -> None:
    """Replaces only the partitions that ``df`` has rows of."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(folder)


def write_manifest(df: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").json(folder)


def write_csv(df: DataFrame, folder: str) -> None:
    """CSV with a header; control characters are left out of texts."""
    clean = df.select(*[text.strip_control(F.col(c)).alias(c) if t == "string" else F.col(c).cast("string").alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes])
    clean.write.mode("overwrite").option("header", True).csv(folder)


def write_sheets(sheets: dict[str, DataFrame], folder: str) -> None:
    for name, df in sheets.items():
        write_csv(df, f"{folder}/{name}")


def payload(sections: dict[str, DataFrame], limit_bytes: int = 256 << 20) -> str:
    """The sections as one JSON object of arrays, gzipped, in base64. Meant for views of one catalogue; beyond the limit it fails."""
    parts, size = [], 0
    for name, df in sections.items():
        rows = []
        for r in df.select(F.to_json(F.struct("*")).alias("j")).toLocalIterator():
            size += len(r[0])
            if size > limit_bytes:
                raise ValueError("the view is too large for one page")
            rows.append(r[0])
        parts.append(f'"{name}":[{",".join(rows)}]')
    return base64.b64encode(gzip.compress(("{" + ",".join(parts) + "}").encode())).decode()


def write_view(sections: dict[str, DataFrame], template: str, path: str, mark: str = "__DATA__") -> None:
    Path(path).write_text(template.replace(mark, payload(sections)), encoding="utf-8")
