"""Materialised stages: written tables in the cluster's shared checkpoint folder.

A stage writes a frame as parquet under ``spark.checkpoint.dir`` and reads it
back. That cuts the lineage (a lost executor recomputes from the written files,
not from the raw extracts), lets later reads prune columns and push filters
into the scan, and keeps each downstream plan small.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from otif.session import ensure_checkpoint_dir, sized_shuffles


class Stager:
    """Callable ``stage(frame, name) -> frame`` writing to one run folder, with shuffles of bounded size (``sized_shuffles``)."""

    def __init__(self, spark: SparkSession, root: str | None = None, partitions: int | None = None):
        self.spark, self.partitions = spark, partitions
        self.root = root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/otif-stages/{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def __call__(self, frame: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        with sized_shuffles(self.spark, self.partitions):
            frame.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.parquet(path)


class Staged(Mapping[str, DataFrame]):
    """Frames by name, each written by ``stage`` when it is first asked for."""

    def __init__(self, frames: Mapping[str, DataFrame], stage: Stager, prefix: str):
        self.frames, self.stage, self.prefix, self.written = frames, stage, prefix, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.written:
            self.written[name] = self.stage(self.frames[name], f"{self.prefix}_{name}")
        return self.written[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.frames)

    def __len__(self) -> int:
        return len(self.frames)
