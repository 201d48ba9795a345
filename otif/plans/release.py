"""All-or-nothing publication of a run's tables (SNK-1..3, SRC-3).

Every run writes into a folder of its own, ``<root>/runs/<run>``. Rows are counted by the
writes themselves (``DataFrame.observe``). ``publish`` compares each count with the
rows of the written files, writes a manifest (tables, rows, columns) into the folder, and then
replaces one small file, ``<root>/CURRENT``, by an atomic rename. Until then readers see the
previous run, whole; a run that fails leaves nothing that they could read. ``sweep``
removes folders of runs that were never published and of earlier ones.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from otif.session import sized_shuffles

POINTER, MANIFEST = "CURRENT", "MANIFEST.json"


class Files:
    """Small files and folders on whatever file system a path names."""

    def __init__(self, spark: SparkSession, root: str):
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.spark, conf = spark, spark._jsc.hadoopConfiguration()
        self.system = self.hadoop.Path(root).getFileSystem(conf)
        self.context = self.hadoop.FileContext.getFileContext(self.path(root).toUri(), conf)

    def path(self, name: str):
        return self.system.makeQualified(self.hadoop.Path(name))

    def exists(self, name: str) -> bool:
        return self.system.exists(self.path(name))

    def read(self, name: str) -> str:
        stream = self.system.open(self.path(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Write a file beside ``name`` and rename it over ``name``."""
        beside = self.path(f"{name}.{uuid.uuid4().hex}")
        stream = self.system.create(beside, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        over = getattr(self.hadoop, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(over, 1)
        how[0] = over.OVERWRITE
        self.context.rename(beside, self.path(name), how)

    def folders(self, name: str) -> list[str]:
        if not self.exists(name):
            return []
        return [s.getPath().getName() for s in self.system.listStatus(self.path(name)) if s.isDirectory()]

    def delete(self, name: str) -> None:
        self.system.delete(self.path(name), True)


@dataclass
class Release:
    """Tables of one run; nothing of it is visible before ``publish``."""

    spark: SparkSession
    root: str
    run: str = field(default_factory=lambda: uuid.uuid4().hex)
    tables: dict[str, dict] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.root = self.root.rstrip("/")
        self.files = Files(self.spark, self.root)

    @property
    def folder(self) -> str:
        return f"{self.root}/runs/{self.run}"

    def write(self, frame: DataFrame, name: str, layer: str, partition_by: str | None = None, **observed: Column) -> DataFrame:
        """Write a table and read it back; ``observed`` aggregates of its rows are taken while writing (``metrics``)."""
        seen = Observation()
        if partition_by:  # rows of a partition are brought together: large ones in several files, small ones in one
            frame = frame.hint("rebalance", partition_by)
        frame = frame.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in observed.items()])
        writer = frame.write.partitionBy(partition_by) if partition_by else frame.write
        path = f"{layer}/{name}" if layer else name
        with sized_shuffles(self.spark):
            writer.parquet(f"{self.folder}/{path}")
        metrics = dict(seen.get)
        self.tables[f"{layer}_{name}" if layer else name] = {"path": path, "rows": metrics.pop("rows"), "columns": frame.columns, "metrics": metrics}
        return self.spark.read.schema(frame.schema).parquet(f"{self.folder}/{path}")

    def metric(self, table: str, name: str):
        return self.tables[table]["metrics"][name]

    def publish(self) -> None:
        """Check what was written and make it the current run."""
        for name, table in self.tables.items():
            written = self.spark.read.parquet(f"{self.folder}/{table['path']}").count() if table["rows"] else 0  # from the file footers
            if written != table["rows"]:
                raise ValueError(f"{name}: {table['rows']} rows were written, {written} are in the files")
        listed = {n: {k: v for k, v in t.items() if k != "metrics"} for n, t in self.tables.items()}
        self.files.replace(f"{self.folder}/{MANIFEST}", json.dumps({"run": self.run, "tables": listed}))
        self.files.replace(f"{self.root}/{POINTER}", self.run)

    def abandon(self) -> None:
        self.files.delete(self.folder)


def manifest(spark: SparkSession, root: str) -> dict:
    """What the current run published; fails where none did."""
    files, root = Files(spark, root), root.rstrip("/")
    if not files.exists(f"{root}/{POINTER}"):
        raise ValueError(f"nothing was published in {root}")
    return json.loads(files.read(f"{root}/runs/{files.read(f'{root}/{POINTER}')}/{MANIFEST}"))


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the current run."""
    now = manifest(spark, root)
    return spark.read.parquet(f"{root.rstrip('/')}/runs/{now['run']}/{now['tables'][name]['path']}")


def sweep(spark: SparkSession, root: str) -> list[str]:
    """Remove every run but the current one; returns their names. Not while another run is writing."""
    files, root = Files(spark, root), root.rstrip("/")
    current = files.read(f"{root}/{POINTER}") if files.exists(f"{root}/{POINTER}") else None
    stale = [r for r in files.folders(f"{root}/runs") if r != current]
    for run in stale:
        files.delete(f"{root}/runs/{run}")
    return sorted(stale)
