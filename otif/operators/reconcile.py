"""Load summary and reconciliation (AGG-2, AGG-3, REC-1, SNK-3).

All sources are tagged and unioned so one aggregation job yields every count:
raw rows, distinct raw rows, valid, quarantined and superseded rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from otif.functions.reasons import has_reasons
from otif.operators.quality import Validated, source_fields, union_all

ROWS = "source_table string, _digest struct<a: bigint, b: bigint>, _occurrences long, _superseded boolean, _rejected boolean"


def record_digest(fields: Sequence[str]) -> Column:
    """128 bits of a raw record: two chained 64-bit hashes with different beginnings, over the lengths (-1 where null) and the fields."""
    parts = [F.coalesce(F.length(c), F.lit(-1)) for c in fields] + [F.col(c) for c in fields]
    return F.struct(F.xxhash64(F.lit(1), *parts).alias("a"), F.xxhash64(F.lit(2), *parts).alias("b"))


def load_summary(validated: Mapping[str, Validated], bronze: Mapping[str, DataFrame]) -> DataFrame:
    """Per source: raw rows, removed duplicates, distinct, valid, quarantined, superseded.

    Raw and distinct rows are counted from the raw tables (a 128-bit digest of
    the raw record per row), the rest from the validated variants, in one job. A
    source reconciles when its distinct records equal valid + quarantine +
    superseded and its rows equal the occurrences of all variants, so lost and
    multiplied rows both show. Every source has a row, an empty one too.
    """
    spark = next(iter(bronze.values())).sparkSession
    parts = [spark.createDataFrame([(name, None, None, None, None) for name in validated], ROWS)]
    for name, v in validated.items():
        parts.append(bronze[name].select(
            F.lit(name).alias("source_table"), record_digest(source_fields(bronze[name])).alias("_digest"),
            F.lit(None).cast("long").alias("_occurrences"), F.lit(None).cast("boolean").alias("_superseded"),
            F.lit(None).cast("boolean").alias("_rejected")))
        parts.append(v.rows.select(
            F.lit(name).alias("source_table"), F.lit(None).cast("struct<a: bigint, b: bigint>").alias("_digest"),
            F.col("_source_occurrences").cast("long").alias("_occurrences"), "_superseded",
            has_reasons("_dq_errors").alias("_rejected")))
    sup, rej = F.col("_superseded"), F.col("_rejected")
    counts = union_all(parts).groupBy("source_table").agg(
        F.count("_digest").alias("bronze_rows"),
        F.count_distinct("_digest").alias("distinct_rows"),
        F.coalesce(F.sum("_occurrences"), F.lit(0)).alias("_validated_rows"),
        F.count_if(~sup & ~rej).alias("silver_rows"),
        F.count_if(~sup & rej).alias("quarantine_rows"),
        F.count_if(sup).alias("superseded_rows"),
    )
    variants = F.col("silver_rows") + F.col("quarantine_rows") + F.col("superseded_rows")
    return counts.select(
        "source_table", "bronze_rows",
        (F.col("bronze_rows") - F.col("distinct_rows")).alias("duplicate_rows_removed"),
        "distinct_rows", "silver_rows", "quarantine_rows", "superseded_rows",
        ((F.col("distinct_rows") == variants) & (F.col("bronze_rows") == F.col("_validated_rows"))).alias("is_reconciled"),
    )


def assert_reconciled(summary: DataFrame) -> None:
    """Fail when the validated rows of a source do not account for its raw rows."""
    broken = [r.source_table for r in summary.filter(~F.col("is_reconciled")).select("source_table").collect()]
    if broken:
        raise ValueError(f"Silver/quarantine/superseded reconciliation failed: {sorted(broken)}")
