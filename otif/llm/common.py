"""Helpers shared by the text operators: staging, row order, word hashes.

Staged tables cut lineage and are written to the folder that the session names
in ``spark.checkpoint.dir``, which every executor and the driver can read.
"""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MASK64 = (1 << 64) - 1


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only a local session gets one of its own."""
    sc = spark.sparkContext
    if found := sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir"):
        return found
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="otif-llm-"))
    return sc.getCheckpointDir()


class Staging:
    """Tables of one operator run, as Parquet in a folder of its own."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def text_key(text: Column) -> Column:
    """128-bit identity of a text; null for null."""
    return F.unhex(F.md5(text))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that does not begin any of ``df``."""
    while any(c.lower().startswith(name) for c in df.columns):
        name = f"_{name}"
    return name


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def release_memory() -> None:
    """Give a worker's free memory back to the system; workers are reused by later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def tidy(run):
    """``run`` for mapInArrow, giving its memory back at the end of each task."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return tidied


#: What Spark hands to a worker at a time where ``small_batches`` holds: rows, and their bytes.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Actions within it send batches of bounded size to the workers, so neither side holds 10,000 whole texts a task."""
    before = {name: spark.conf.get(name, None) for name in BATCH}
    for name, most in BATCH.items():
        value = str(before[name] or "0").lower().removesuffix("b")
        if not value.isdigit() or not 0 < int(value) <= most:  # smaller ones stay; a size may have a unit
            spark.conf.set(name, str(most))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def parts(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive slices whose texts in ``column`` have about ``limit`` bytes, never cutting a text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        end = min(int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + limit)) + 1, batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def arrow_batch(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def prefix_sums(staging: Staging, df: DataFrame, order: Sequence, sums: dict[str, str], name: str) -> DataFrame:
    """Add to each row the inclusive running sums ``{new: column}`` over all rows in ``order``.

    Rows are range-partitioned and sorted; each task sums its own slice, and the
    slice totals (one row per partition) give every slice its start. The columns
    summed must be non-negative longs. Returns a staged table in no stated order.
    """
    schema = T.StructType([*df.schema, T.StructField("_slice", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in sums)])
    fields = [(new, df.columns.index(column)) for new, column in sums.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, totals = TaskContext.get().partitionId(), dict.fromkeys(sums, 0)
        for batch in batches:
            arrays, names = [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32))], [*batch.schema.names, "_slice"]
            for new, i in fields:
                cum = np.cumsum(batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64)) + totals[new]
                if len(cum):
                    totals[new] = int(cum[-1])
                arrays.append(pa.array(cum))
                names.append(new)
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    done = staging.put(df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema), name)
    ends = done.groupBy("_slice").agg(*(F.max(c).alias(c) for c in sums)).orderBy("_slice").collect()  # a row per partition
    base, rows = dict.fromkeys(sums, 0), []
    for r in ends:
        rows.append((r["_slice"], *(base[c] for c in sums)))
        base = {c: base[c] + r[c] for c in sums}
    spark = df.sparkSession
    starts = spark.createDataFrame(rows, "_slice int, " + ", ".join(f"_base_{c} long" for c in sums))
    out = done.join(F.broadcast(starts), "_slice", "left")
    return out.select(*df.columns, *((F.col(c) + F.col(f"_base_{c}")).alias(c) for c in sums))


SPACE = b" \t\n\r\x0b\x0c"
BYTES = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


def fold(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z and À-Þ in lower case; no byte moves."""
    lead = np.concatenate([[False], data[:-1] == 0xC3])
    upper = ((data >= 0x41) & (data <= 0x5A)) | (lead & (data >= 0x80) & (data <= 0x9E) & (data != 0x97))
    return data + upper * np.uint8(0x20)


class Words(NamedTuple):
    """Words of some texts, which are joined as UTF-8 ``data`` with a line feed after each."""

    data: np.ndarray
    texts: np.ndarray  # where each text begins in data, and the end
    starts: np.ndarray  # of the words, in data
    ends: np.ndarray
    hashes: np.ndarray
    begins: np.ndarray  # number of each text's first word, and the number of words


def scan_words(texts: Sequence[str], separators: bytes = SPACE, folded: bool = True) -> Words:
    """Runs of bytes other than ``separators``, hashed (polynomials over random values of the bytes, folded or not)."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    at_text = np.cumsum([0, *(len(r) + 1 for r in raw)])
    inside = np.concatenate([[False], ~_table(separators)[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    begins = np.searchsorted(starts, at_text)
    if not len(starts):
        return Words(data, at_text, starts, ends, np.zeros(0, np.uint64), begins)
    at = np.flatnonzero(inside[1:-1])
    return Words(data, at_text, starts, ends, polynomials(BYTES[(fold(data) if folded else data)[at]], ends - starts), begins)


def polynomials(values: np.ndarray, lengths: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Mixed polynomial hashes of consecutive runs of ``values`` with these (positive) lengths."""
    firsts = np.cumsum(lengths) - lengths
    powers = np.cumprod(np.full(int(lengths.max(initial=1)), base, np.uint64))
    return mix64(np.add.reduceat(values * powers[np.arange(len(values)) - np.repeat(firsts, lengths)], firsts)) if len(lengths) else np.zeros(0, np.uint64)


def word_hashes(texts: Sequence[str], separators: bytes = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text's words begin (and the last end)."""
    words = scan_words(texts, separators)
    return words.hashes, words.begins


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads 64-bit values (in place on a copy)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def components(staging: Staging, edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the least node of its component.

    Alternates large-star and small-star rounds until the edge set no longer
    changes. A hub's rows meet one row per key in each join, so a skewed join can
    be split; the minima are pre-aggregated.
    """

    def seen(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def both(e: DataFrame) -> DataFrame:
        return e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    now = staging.put(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-0")
    state, k = seen(now), 0
    while True:
        k += 1
        around = both(now)
        least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = around.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
        large = staging.put(large.distinct(), f"{name}-{k}-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).filter("a != b")
        now = staging.put(small.distinct(), f"{name}-{k}")
        staging.drop(f"{name}-{k}-large", f"{name}-{k - 1}")
        if (after := seen(now)) == state:
            break
        state = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
