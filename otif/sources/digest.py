"""Digests of source files that depend on every byte in its place (SRC-7).

A file is read as lines by as many tasks as it has splits. Lines are numbered
through the file, each is hashed (SHA-256), and a Merkle tree is built over them: a
node hashes up to ``FANOUT`` consecutive children in order, level by level. The
root, hashed with the file's length, is the digest; it does not depend on
how the file was split. A swapped line, a moved header or a lost line end changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from otif.plans.stage import Stager
from otif.sources.records import BLOCK, FILE, numbered_lines

FANOUT = 1024


def list_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, length, modificationTime) of all files, empty ones included; folders stand for the data files in them.

    The driver lists the files, as it does for every read of them.
    """
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    rows, todo = [], [hadoop.Path(p) for p in paths]
    while todo:
        path = todo.pop()
        system = path.getFileSystem(conf)
        status = system.getFileStatus(path)
        if status.isDirectory():
            todo += [s.getPath() for s in system.listStatus(path) if not s.getPath().getName().startswith(("_", "."))]
        else:
            rows.append((status.getPath().toUri().toString(), status.getLen(), status.getModificationTime()))
    files = spark.createDataFrame(rows, "path string, length long, ms long")
    return files.select("path", "length", F.timestamp_millis("ms").alias("modificationTime"))


def _plain(path: str) -> F.Column:
    """A path as text that is alike in the listing and in the reader's metadata (``file:/a`` and ``file:///a``)."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def fingerprints(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, length, modificationTime, content_digest) of every file."""
    files, stage = list_files(spark, paths), Stager(spark)
    filled = [r.path for r in files.filter("length > 0").select("path").collect()]  # the list of files came from the driver
    tops = None
    if filled:
        hashed = numbered_lines(spark, filled).select(FILE, BLOCK, "_at", F.unhex(F.sha2(F.col("value").cast("binary"), 256)).alias("hash"))
        lines = stage(hashed, "line_hashes")
        splits = lines.groupBy(FILE, BLOCK).agg(F.min("_at").alias("_from"), F.count("*").alias("_n"))
        earlier = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        splits = splits.withColumn("_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
        nodes = lines.join(splits, [FILE, BLOCK]).select(FILE, (F.col("_first") + F.col("_at") - F.col("_from")).alias("place"), "hash")
        level = 0
        while True:
            level += 1
            children = F.transform(F.sort_array(F.collect_list(F.struct("place", "hash"))), lambda c: F.hex(c["hash"]))  # FANOUT at most
            nodes = stage(nodes.groupBy(FILE, F.floor(F.col("place") / FANOUT).alias("place")).agg(
                F.unhex(F.sha2(F.array_join(children, ""), 256)).alias("hash")), f"level_{level}")
            if nodes.agg(F.max("place")).first()[0] == 0:
                break
        tops = nodes.select(_plain(FILE).alias("_key"), F.lower(F.hex("hash")).alias("_root"))
    if tops is None:
        tops = spark.createDataFrame([], "_key string, _root string")
    joined = files.withColumn("_key", _plain("path")).join(tops, "_key", "left")
    digest = F.sha2(F.concat_ws(":", F.col("length").cast("string"), F.coalesce("_root", F.lit(""))), 256)
    return joined.select("path", "length", "modificationTime", digest.alias("content_digest"))


def assert_unchanged(before: DataFrame, after: DataFrame) -> None:
    """Fail when a source changed between two fingerprints.

    Both are rows per file; a file that is not in both with the same values counts, and only their number reaches the driver.
    """
    columns = ["path", "length", "modificationTime", "content_digest"]
    both = before.select(*columns).union(after.select(*columns))
    changed = both.groupBy(*columns).agg(F.count("*").alias("n")).filter("n <> 2").select("path").distinct().count()
    if changed:
        raise ValueError(f"{changed} source file(s) changed during execution")
