"""Spark session defaults, sizes of shuffles and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


#: Compressed size that AQE gives a shuffle partition of a stage. Extracts are texts that take up to 28 times as much in
#: memory (705 MB for 25); with Spark's 64 MB the sorts of a task spill once the tables are large enough to fill such partitions.
PARTITION_BYTES = 16 << 20
#: Lookups whose parent side is at most that large in every partition hash it and need no sort of the wide child rows.
SHUFFLES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
            "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(PARTITION_BYTES)}
#: Rows that lie by a part of a join's or an aggregation's key stay there: crowded parts are found and split beforehand.
CO_PARTITION = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
_lock = threading.Lock()
_sized: dict[int, tuple[int, dict[str, str | None]]] = {}  # by session: how many use its sizes, and what was set before


@contextmanager
def sized_shuffles(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Within it, ``spark`` deals shuffles into partitions of bounded size, at least ``partitions`` before they are merged.

    Smaller sizes and more partitions that are set already stay. Threads may share it; the last one restores the settings.
    """
    with _lock:
        users, before = _sized.get(id(spark), (0, {}))
        if not users:
            wanted = {**SHUFFLES, **CO_PARTITION}
            if partitions and partitions > int(spark.conf.get("spark.sql.shuffle.partitions")):
                wanted["spark.sql.shuffle.partitions"] = str(partitions)
            advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
            if _bytes(spark.conf.get(advisory, None)) <= PARTITION_BYTES:
                del wanted[advisory]
            before = {name: spark.conf.get(name, None) for name in wanted}
            for name, value in wanted.items():
                spark.conf.set(name, value)
        _sized[id(spark)] = users + 1, before
    try:
        yield
    finally:
        with _lock:
            users, before = _sized.pop(id(spark))
            if users > 1:
                _sized[id(spark)] = users - 1, before
            else:
                for name, value in before.items():
                    spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _bytes(size: str | None) -> int:
    """A size as Spark writes it (``64MB``, ``16k``, ``1048576b``); 64 MB where none is given."""
    text = (size or "64m").strip().lower().removesuffix("b")
    units = {"k": 10, "m": 20, "g": 30, "t": 40, "p": 50}
    return int(text[:-1]) << units[text[-1]] if text[-1:] in units else int(text)


def build_session(master: str | None = None, partitions: int | None = None, app_name: str = "otif",
                  driver_memory: str | None = None) -> SparkSession:
    """Session with the engine's SQL settings: AQE with skew-join splitting, ANSI, UTC, no UI.

    Master, number of shuffle partitions and memory are the cluster's own; they are set only where given.
    """
    given = {"spark.master": master, "spark.sql.shuffle.partitions": partitions, "spark.driver.memory": driver_memory}
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
    )
    for name, value in given.items():
        if value is not None:
            builder = builder.config(name, str(value))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this setting names shared storage and is only read here; a cluster
    session without it is an error. Only a local session gets a scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="otif-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", current)
        except Exception:  # some deployments refuse core settings at runtime
            pass
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current
