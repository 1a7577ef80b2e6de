"""Documents that come as files before an index lists them: registration, and two folders kept alike."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.functions.text import LOCAL_PREFIX
from chronofold.operators.diff import upsert


def _path(spark: SparkSession, *parts: str):
    """A Hadoop path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def local_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id of the local documents in a folder; none if it doesn't exist. Contents aren't read."""
    path, fs = _path(spark, folder)
    if not fs.exists(path):
        return spark.createDataFrame([], "doc_id string")
    files = spark.read.format("binaryFile").option("pathGlobFilter", LOCAL_PREFIX + "*.pdf").load(folder)
    return files.select(F.regexp_extract("path", r"([^/]+)\.pdf$", 1).alias("doc_id"))


def register(manifest: DataFrame, documents: DataFrame) -> DataFrame:
    """The manifest with local documents, each in place of an earlier one of its id. A document stays out if a listed one
    has its kind, notice date and, for notices, date of effect (nulls are equal).
    """
    names = ("kind", "notice_date", "effective_date")
    key = {n: F.col(n) if n != "effective_date" else F.when(F.col("kind") == "notice", F.col(n)) for n in names}
    listed = manifest.where(~F.col("doc_id").startswith(LOCAL_PREFIX)).select(*[c.cast("string").alias(f"__{n}") for n, c in key.items()]).distinct()
    same = reduce(lambda a, b: a & b, [c.cast("string").eqNullSafe(F.col(f"__{n}")) for n, c in key.items()])
    return upsert(manifest, documents.join(listed, same, "left_anti"), ["doc_id"])


def copies_wanted(manifest: DataFrame, kept: DataFrame, shown: DataFrame) -> DataFrame:
    """doc_id, action: publish what only the kept folder has, restore what only the shown one has, remove shown files that
    the manifest lacks. All take doc_id; documents that aren't local need nothing.
    """
    sets = {"listed": manifest, "kept": kept, "shown": shown}
    marked = reduce(DataFrame.unionByName, [d.select("doc_id", *[F.lit(n == m).alias(m) for m in sets]) for n, d in sets.items()])
    held = marked.where(F.col("doc_id").startswith(LOCAL_PREFIX)).groupBy("doc_id").agg(*[F.bool_or(m).alias(m) for m in sets])
    action = F.when(F.expr("listed and kept and not shown"), "publish").when(F.expr("listed and shown and not kept"), "restore").when(F.expr("shown and not listed"), "remove")
    return held.select("doc_id", action.alias("action")).where("action is not null")


def sync(manifest: DataFrame, kept: str, shown: str) -> list[tuple[str, str]]:
    """Brings both folders to what the manifest says and returns (doc_id, action). Documents registered by hand are few:
    the driver copies them one by one, by Hadoop's file systems.
    """
    spark = manifest.sparkSession
    util, conf = spark._jvm.org.apache.hadoop.fs.FileUtil, spark._jsc.hadoopConfiguration()
    done = [(r["doc_id"], r["action"]) for r in copies_wanted(manifest, local_files(spark, kept), local_files(spark, shown)).orderBy("doc_id").toLocalIterator()]
    for doc_id, action in done:
        (a, afs), (b, bfs) = _path(spark, kept, doc_id + ".pdf"), _path(spark, shown, doc_id + ".pdf")
        if action == "remove":
            bfs.delete(b, False)
        elif action == "publish":
            bfs.mkdirs(b.getParent())
            util.copy(afs, a, bfs, b, False, conf)
        else:
            afs.mkdirs(a.getParent())
            util.copy(bfs, b, afs, a, False, conf)
    return done
