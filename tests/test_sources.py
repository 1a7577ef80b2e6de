"""Readers, sinks and streams on small files."""

import gzip
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chronofold.functions import text
from chronofold.sources import local_documents, readers, writers
from chronofold.streaming import incremental


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_manifest_and_parsed_documents(spark, tmp_path):
    manifest = spark.createDataFrame([(d, "t", "http://x.example/" + d, "notice", "2026-08-31", None, "s") for d in ("a", "b", "c", "d")], "doc_id string, title string, url string, kind string, notice_date string, effective_date string, fiscal_section string")
    writers.write_manifest(manifest, str(tmp_path / "manifest"))
    again = readers.read_manifest(spark, str(tmp_path / "manifest"))
    assert rows(again, *manifest.columns) == rows(manifest, *manifest.columns)
    folder = tmp_path / "parsed"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps({"version": 3, "records": [{"doc_id": "a", "page": 1, "price": 5.5}, {"doc_id": "a", "page": 2}]}))
    (folder / "b.json.gz").write_bytes(gzip.compress(json.dumps({"version": 2, "ocr": True, "records": []}).encode()))
    (folder / "c.json").write_text(json.dumps({"version": 3, "error": "broken", "records": []}))
    parsed = readers.read_parsed(spark, str(folder))
    assert rows(parsed, "doc_id", "version") == [("a", 3), ("b", 2), ("c", 3)]
    assert rows(readers.records_of(parsed), "doc_id", "page", "price") == [("a", 1, 5.5), ("a", 2, None)]
    assert rows(readers.stale_documents(again, parsed, 3), "doc_id") == [("c",), ("d",)]


def test_wide_products(spark, tmp_path):
    folder = tmp_path / "wide"
    folder.mkdir()
    (folder / "1.csv").write_bytes("コード,名称,備考\r\n1,\"名,前\",\r\n2,カテーテル\r\n".encode("cp932"))
    (folder / "2.csv").write_bytes("名称,コード\r\nステント,3\r\n".encode("cp932"))
    before = spark.conf.get("spark.sql.legacy.javaCharsets")
    got = readers.read_wide_products(spark, str(folder), ["コード", "名称"])
    assert rows(got, "コード", "名称", "備考") == [("1", "名,前", None), ("2", "カテーテル", None), ("3", "ステント", None)]
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == before
    with pytest.raises(ValueError, match="価格"):
        readers.read_wide_products(spark, str(folder), ["コード", "価格"])


def test_foreign_events(spark):
    df = spark.createDataFrame([("1", '[{"field":"price","old":"1","new":"2"}]'), ("2", None), ("3", "x")], "code string, changed_fields string")
    got = readers.foreign_events(df).select("code", F.col("changed_fields")[0]["new"].alias("new"))
    assert rows(got, "code", "new") == [("1", "2"), ("2", None), ("3", None)]


def test_rebuild_sheets_and_view(spark, tmp_path):
    a, b = spark.createDataFrame([(1, "x\x07")], "k int, t string"), spark.createDataFrame([(2,)], "k int")
    writers.rebuild({"a": a, "b": b}, str(tmp_path / "all"))
    writers.rebuild({"a": b}, str(tmp_path / "all"))
    assert rows(spark.read.parquet(str(tmp_path / "all" / "a.parquet")), "k") == [(2,)] and rows(spark.read.parquet(str(tmp_path / "all" / "b.parquet")), "k") == [(2,)]
    writers.write_sheets({"first": a, "second": b}, str(tmp_path / "sheets"))
    assert spark.read.option("header", True).csv(str(tmp_path / "sheets" / "first")).first()["t"] == "x"
    writers.write_view({"a": a, "b": b}, "<script>__DATA__</script>", str(tmp_path / "view.html"))
    import base64

    packed = (tmp_path / "view.html").read_text(encoding="utf-8").removeprefix("<script>").removesuffix("</script>")
    assert json.loads(gzip.decompress(base64.b64decode(packed))) == {"a": [{"k": 1, "t": "x\x07"}], "b": [{"k": 2}]}
    with pytest.raises(ValueError, match="too large"):
        writers.payload({"a": a}, limit_bytes=3)


def test_streams_count_and_deduplicate(spark, tmp_path):
    at = [datetime(2026, 1, 1, 0, m) for m in (5, 10, 50)] + [datetime(2026, 1, 1, 1, 5)]
    spark.createDataFrame([(at[0], "k", 1.0), (at[1], "k", 2.0), (at[2], "j", 4.0), (at[3], "k", 8.0)], "ts timestamp, key string, value double").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = incremental.new_files(spark, str(tmp_path / "in"), "ts timestamp, key string, value double")

    def run(df, name, mode):
        df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination()
        return spark.table(name)

    counted = run(incremental.windowed_counts(stream, "ts", ["key"]), "counted", "complete")
    assert rows(counted.withColumn("start", F.hour("start")), "start", "key", "n", "total") == [(0, "j", 1, 4.0), (0, "k", 2, 3.0), (1, "k", 1, 8.0)]
    assert rows(run(incremental.deduplicated(stream, "ts", ["key"]), "single", "append"), "key") == [("j",), ("k",)]


BASE = "医療機器の保険適用について"


def test_cover(spark):
    covers = [
        "保 医 発0930第４号\n令和８年９月30日\n地 方 厚 生 ( 支 ) 局 医 療 課 長 殿\n" + BASE + "\n標記について、別紙のとおり令和８年 10 月１日から新たに保険適用とするので通知する。",
        "令和８年９月30日 「" + BASE + "」の一部訂正について", "令和８年９月30日", BASE, "", None,
    ]
    df = spark.createDataFrame(list(enumerate(covers)), "n int, cover string").withColumn("d", text.cover(F.col("cover"), BASE))
    got = [r["d"] for r in df.orderBy("n").collect()]
    assert [(d["doc_id"], d["kind"], str(d["notice_date"]), str(d["effective_date"])) for d in got[:2]] == [("local_20260930_notice_4", "notice", "2026-09-30", "2026-10-01"), ("local_20260930_correction_0", "correction", "2026-09-30", "None")]
    assert got[0]["title"].startswith(BASE + "（令和8年10月1日から新たに適用）（令和8年9月30日）") and got[2:] == [None] * 4


def test_local_documents(spark, tmp_path):
    schema = "doc_id string, title string, kind string, notice_date string, effective_date string"
    manifest = spark.createDataFrame([("000503000", "t", "notice", "2026-09-30", "2026-10-01"), ("000502873", "t", "correction", "2026-08-31", None), ("local_20261030_notice_2", "old", "notice", "2026-10-30", "2026-11-01")], schema)
    new = spark.createDataFrame([("local_20260930_notice_4", "t", "notice", "2026-09-30", "2026-10-01"), ("local_20260831_correction_1", "t", "correction", "2026-08-31", "2026-09-01"), ("local_20261030_notice_2", "new", "notice", "2026-10-30", "2026-11-01"), ("local_20260831_notice_3", "t", "notice", "2026-08-31", None)], schema)
    got = local_documents.register(manifest, new)
    assert rows(got, "doc_id", "title") == [("000502873", "t"), ("000503000", "t"), ("local_20260831_notice_3", "t"), ("local_20261030_notice_2", "new")]
    kept, shown = tmp_path / "kept", tmp_path / "docs" / "shown"
    kept.mkdir()
    (kept / "local_20261030_notice_2.pdf").write_bytes(b"first")
    (kept / "000502873.pdf").write_bytes(b"listed")
    assert local_documents.sync(got, str(kept), str(shown)) == [("local_20261030_notice_2", "publish")]
    assert (shown / "local_20261030_notice_2.pdf").read_bytes() == b"first" and not (shown / "000502873.pdf").exists()
    (kept / "local_20261030_notice_2.pdf").unlink()
    (shown / "local_20260930_notice_4.pdf").write_bytes(b"replaced")
    assert local_documents.sync(got, str(kept), str(shown)) == [("local_20260930_notice_4", "remove"), ("local_20261030_notice_2", "restore")]
    assert (kept / "local_20261030_notice_2.pdf").read_bytes() == b"first" and not (shown / "local_20260930_notice_4.pdf").exists()
    assert local_documents.sync(got, str(kept), str(shown)) == []
