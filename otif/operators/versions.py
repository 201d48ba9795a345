"""Duplicate collapse, key conflicts and version resolution (AGG-1, WIN-1, WIN-2, DQ-6).

Where a key may hold many rows its facts are computed with aggregations (map-side
combined, so a key that holds a third of all rows costs one partial row per task) and
joined back with a null-safe equi-join; AQE splits a hot key on the big side of that
join. Rows of all other keys, once brought together, need no such join: their facts
are windows partitioned by the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from otif.model import SELECTION_RULE

MOST_FILES = 62  # bits of a positive long


def few_files(bronze: DataFrame) -> list[str] | None:
    """The sorted names of a table's files, or null where a set of them does not fit the bits of a long (one job)."""
    rows = bronze.select("_source_file").dropna().distinct().limit(MOST_FILES + 1).collect()
    return sorted(r[0] for r in rows) if len(rows) <= MOST_FILES else None


def collapse_duplicates(bronze: DataFrame, fields: Sequence[str], files: Sequence[str] | None = None) -> DataFrame:
    """One row per identical raw record with multiplicity, sorted file set, first load.

    Where all ``files`` are known (``few_files``), a record's set of them is a number, and one
    code-generated hash aggregation suffices. Else two levels: a code-generated hash aggregation per (record, file) first, so
    the file list of a record is built from at most one entry per file (and a
    record repeated a billion times in one file is one row after the map side).
    """
    if files is not None:
        bits = F.coalesce(*[F.when(F.col("_source_file") == f, F.lit(1 << i)) for i, f in enumerate(files)], F.lit(0)).cast("long")
        several = F.array_except(F.array(*[F.when(F.col("_bits").bitwiseAND(F.lit(1 << i)) != 0, F.lit(f)) for i, f in enumerate(files)])
                              .cast("array<string>"), F.array(F.lit(None).cast("string")))
        held = F.coalesce(*[F.when(F.col("_bits") == 1 << i, F.array(F.lit(f))) for i, f in enumerate(files)], several)  # mostly one file
        grouped = bronze.groupBy(*fields).agg(F.count(F.lit(1)).alias("_source_occurrences"), F.bit_or(bits).alias("_bits"),
                                              F.min("_loaded_at").alias("_bronze_loaded_at"))
        return grouped.select(*fields, "_source_occurrences", held.alias("_source_files"), "_bronze_loaded_at")
    per_file = bronze.groupBy(*fields, "_source_file").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_loaded_at").alias("_first"))
    return per_file.groupBy(*fields).agg(
        F.sum("_n").alias("_source_occurrences"),
        F.sort_array(F.collect_list("_source_file")).alias("_source_files"),
        F.min("_first").alias("_bronze_loaded_at"),
    )


def join_key_facts(frame: DataFrame, facts: DataFrame, key: Sequence[str], how: str = "inner") -> DataFrame:
    """Attach per-key columns; null key parts match each other (like a window partition)."""
    left, right = frame.alias("_l"), facts.alias("_r")
    cond = [F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}")) for k in key]
    extra = [F.col(f"_r.{c}") for c in facts.columns if c not in key]
    return left.join(right, cond, how).select("_l.*", *extra)


def key_variants(frame: DataFrame, key: Sequence[str], together: bool = False) -> DataFrame:
    """``_key_variants``: number of distinct raw variants per normalised key.

    Where the rows of a key already lie ``together`` in one partition they are counted
    there. Else only keys with several variants are joined back (all others have one), so
    the joined table is usually small enough for AQE to broadcast it and the
    wide rows are not shuffled for it.
    """
    if together:
        return frame.withColumn("_key_variants", F.count(F.lit(1)).over(Window.partitionBy(*key)))
    counts = (frame.groupBy(*key).agg(F.count(F.lit(1)).alias("_key_variants"))
              .filter(F.col("_key_variants") > 1))
    out = join_key_facts(frame, counts, key, "left")
    return out.withColumn("_key_variants", F.coalesce("_key_variants", F.lit(1)))


def version_facts(frame: DataFrame, key: Sequence[str], version: str) -> DataFrame:
    """Per key: variants, dated variants, latest version date and how many rows carry it."""
    per_date = frame.groupBy(*key, version).agg(F.count(F.lit(1)).alias("_n"))
    return per_date.groupBy(*key).agg(
        F.sum("_n").alias("_key_variants"),
        F.coalesce(F.sum(F.when(F.col(version).isNotNull(), F.col("_n"))), F.lit(0)).alias("_dated_variants"),
        F.max(version).alias("_latest_version"),
        F.coalesce(F.max_by("_n", version), F.lit(0)).alias("_latest_variants"),
    )


def resolve_versions(frame: DataFrame, key: Sequence[str], version: str, together: bool = False) -> DataFrame:
    """Mark resolvable keys: every variant dated and exactly one carries the latest date.

    ``together`` is as in ``key_variants``. Adds ``_key_variants``, ``_latest_version``, ``_can_resolve`` and ``_superseded``.
    Selection happens before any reference validation, so an invalid newest
    variant never revives an older one.
    """
    # A key with one variant never conflicts and has nothing to supersede, so
    # only keys with several variants are joined back (see ``key_variants``).
    if together:
        of_key = Window.partitionBy(*key)
        many = F.count(F.lit(1)).over(of_key) > 1
        out = frame.withColumns({
            "_key_variants": F.when(many, F.count(F.lit(1)).over(of_key)), "_latest_version": F.when(many, F.max(version).over(of_key)),
            "_dated_variants": F.count(version).over(of_key)})
        out = out.withColumn("_latest_variants", F.count_if(F.col(version) == F.col("_latest_version")).over(of_key))
    else:
        facts = version_facts(frame, key, version).filter(F.col("_key_variants") > 1)
        out = join_key_facts(frame, facts, key, "left")
    single = F.col("_key_variants").isNull()
    can = single | ((F.col("_dated_variants") == F.col("_key_variants")) & (F.col("_latest_variants") == 1))
    return (out.withColumn("_can_resolve", can)
            .withColumn("_superseded", ~single & can & F.coalesce(F.col(version) < F.col("_latest_version"),
                                                                  F.lit(False)))
            .withColumn("_key_variants", F.coalesce("_key_variants", F.lit(1)))
            .drop("_dated_variants", "_latest_variants"))


def conflicting(resolvable: Column | None = None) -> Column:
    """Condition for ``CONFLICTING_KEY``: several variants that were not resolved."""
    many = F.col("_key_variants") > 1
    return many if resolvable is None else many & ~resolvable


def superseded_records(resolved: DataFrame, source_table: str, key: Sequence[str],
                       version: str) -> DataFrame:
    """Archive of older variants of resolved keys (not quality failures)."""
    return resolved.filter(F.col("_superseded")).select(
        F.lit(source_table).alias("source_table"),
        F.to_json(F.struct(*[F.col(k) for k in key])).alias("candidate_key"),
        "_raw_record", "_source_occurrences", "_source_files", "_bronze_loaded_at",
        F.col(version).alias("reference_date"),
        F.col("_selected_version").alias("selected_reference_date"),
        F.lit(SELECTION_RULE).alias("selection_rule"),
        F.current_timestamp().alias("_processed_at"),
    )
