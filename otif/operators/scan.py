"""Skew-safe running sums within a key (parallel prefix scan).

A plain ``sum(..).over(partitionBy(key).orderBy(..))`` sends every row of a key
to one task; a key holding a third of all rows then serialises a third of the
job. Here rows are range-partitioned on ``(key, order)`` into ordered slices
(Spark samples the data for the slice bounds), so one hot key spans many
slices that are scanned in parallel. Of the keys in a slice only the first can
have begun in an earlier one, and only the last can go on in a later one, so
the sums handed from slice to slice are those of two keys a slice: at most
twice as many rows as slices, broadcast to the scanned rows. The rows
themselves move twice, into the ranges and to their scan by ``(key, slice)``.
Every input takes this path, whatever its size.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from otif.session import ensure_checkpoint_dir, sized_shuffles


def default_slices(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def written(frame: DataFrame) -> DataFrame:
    """``frame`` as a table written in the shared checkpoint folder; runs a job."""
    spark = frame.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/otif-scans/{uuid.uuid4().hex}"
    with sized_shuffles(spark):
        frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def border_sums(ranged: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``_off_<name>`` per (slice, key) for the first and last key of each slice: its sums in earlier slices."""
    key = F.struct(*keys)
    edges = ranged.groupBy("_slice").agg(F.min(key).alias("_first"), F.max(key).alias("_last"))
    totals = (ranged.join(F.broadcast(edges), "_slice").filter((key == F.col("_first")) | (key == F.col("_last")))
              .groupBy("_slice", *keys).agg(*[F.sum(f"_val_{name}").alias(f"_tot_{name}") for name in names]))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*keys, "_slice", *[F.sum(f"_tot_{name}").over(before).alias(f"_off_{name}") for name in names])


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 values: Mapping[str, Column], slices: int | None = None) -> DataFrame:
    """Add an inclusive running sum column per ``values`` entry.

    ``keys`` must be non-null; ``order`` must be a total order within a key for
    the result to be deterministic. Returns all input columns plus one column
    per name in ``values``. Writing the slices runs a job.
    """
    n = slices or default_slices(df)
    keys, order = list(keys), list(order)
    names = list(values)
    # The slice id must be fixed once: both the local scan and the border sums
    # read it, and a re-planned or re-sampled exchange could otherwise move a
    # row to another slice between the two reads. A table written in
    # ``spark.checkpoint.dir`` pins it and cuts the lineage at this point; the
    # border sums then read the key and value columns only.
    ranged = written(df.select("*", *[expr.alias(f"_val_{name}") for name, expr in values.items()])
                     .repartitionByRange(n, *keys, *order)
                     .withColumn("_slice", F.spark_partition_id()))
    within = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = ranged.select("*", *[F.sum(f"_val_{name}").over(within).alias(f"_run_{name}") for name in names])
    joined = local.join(F.broadcast(border_sums(ranged, keys, names)), [*keys, "_slice"], "left")
    return joined.select(
        *[c for c in df.columns],
        *[(F.col(f"_run_{name}") + F.coalesce(F.col(f"_off_{name}"), F.lit(0))).alias(name)
          for name in names],
    )
