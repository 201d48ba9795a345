"""Records of delimited files whose quoted fields may hold line breaks, read in splits (SRC-1).

Spark's own multi-line reader gives each file to one task. Here a file is read as
lines by as many tasks as it has splits, and a line is taken as a function of the
quote state it begins in (outside or inside a quoted field): it keeps the state,
swaps it, or ends in a fixed one. Functions of consecutive lines compose, so

* within a chunk of a split the state before each line, for both states the split may begin
  in, follows from the last line with a fixed end and the swaps since;
* over the chunks of a file the same composition of whole chunks gives the state
  each really begins in, and how many records begin before it.

A line outside of quotes begins a record. Lines that are whole records go straight
to ``from_csv``; only the lines of broken records are grouped. A quoted
field that never ends fails the read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from otif.operators.scan import default_slices
from otif.plans.stage import Stager

FILE, BLOCK, CHUNK = "_source_file", "_block", "_chunk"
CHUNK_BITS = 14  # lines of a split that are scanned together: 16,384


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with file, first byte of their split, and a number that rises by one from line to line of a split."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK),
                       F.monotonically_increasing_id().alias("_at"), "value")


def ends_inside(line: Column, sep: str) -> Column:
    """Whether a line that begins outside of quotes ends inside: doubled quotes and closed fields go, an opening one stays."""
    edge = f"(^|[{sep}])"
    single = F.regexp_replace(line, '""', "")
    return F.regexp_replace(single, f'{edge}"[^"]*"', "$1").rlike(f'{edge}"')


def state_after(entry: int | Column, swaps: Column, fixed: Column) -> Column:
    """The state after some functions: from the last fixed one (its state and the swaps up to it) or from ``entry``, swapped on."""
    entry = F.lit(entry) if isinstance(entry, int) else entry
    return (F.coalesce(fixed["state"] + swaps - fixed["swaps"], entry + swaps)) % 2


def composed(frame: DataFrame, window, from_outside: str, from_inside: str) -> DataFrame:
    """Adds ``_swaps`` and ``_fixed`` of the composition of all functions up to each row."""
    swaps = F.sum(((F.col(from_outside) == 1) & (F.col(from_inside) == 0)).cast("int")).over(window)
    counted = frame.withColumn("_swaps", swaps)
    fixed = F.when(F.col(from_outside) == F.col(from_inside), F.struct(F.col(from_outside).alias("state"), F.col("_swaps").alias("swaps")))
    return counted.withColumn("_fixed", F.last(fixed, ignorenulls=True).over(window))


def records(lines: DataFrame, stage: Stager, sep: str = ";", tasks: int | None = None) -> DataFrame:
    """(file, record, value): each record with its number in the file, from 0.

    ``tasks`` should rise with the text, so that the lines sorted by one task do not.
    """
    n = max(tasks or 1, default_slices(lines))
    piece = [FILE, BLOCK, CHUNK]
    quoted = F.contains("value", F.lit('"'))
    known = lines.select("*", F.when(quoted, ends_inside(F.col("value"), sep)).otherwise(False).cast("int").alias("_out"),
                         F.when(quoted, ends_inside(F.concat(F.lit('"'), "value"), sep)).otherwise(True).cast("int").alias("_in"),
                         F.shiftright("_at", CHUNK_BITS).alias(CHUNK)).repartition(n, *piece)
    in_split = Window.partitionBy(*piece).orderBy("_at")
    up_to = in_split.rowsBetween(Window.unboundedPreceding, 0)
    before = in_split.rowsBetween(Window.unboundedPreceding, -1)
    scanned = composed(known, up_to, "_out", "_in")
    states = [state_after(s, F.col("_swaps"), F.col("_fixed")) for s in (0, 1)]
    for s in (0, 1):
        scanned = scanned.withColumn(f"_after{s}", states[s])
    scanned = scanned.withColumns({f"_before{s}": F.coalesce(F.last(f"_after{s}").over(before), F.lit(s)) for s in (0, 1)})
    scanned = scanned.withColumns({f"_begun{s}": F.count_if(F.col(f"_before{s}") == 0).over(up_to) for s in (0, 1)})
    scanned = stage(scanned.drop("_swaps", "_fixed", "_out", "_in"), "scanned_lines")

    # A row per chunk of a split: the state it ends in and the records it begins, for both states it may begin in.
    splits = scanned.groupBy(*piece).agg(
        *[F.max_by(f"_after{s}", "_at").alias(f"_end{s}") for s in (0, 1)],
        *[F.count_if(F.col(f"_before{s}") == 0).alias(f"_begun{s}") for s in (0, 1)])
    in_file = Window.partitionBy(FILE).orderBy(BLOCK, CHUNK)
    whole = composed(splits, in_file.rowsBetween(Window.unboundedPreceding, 0), "_end0", "_end1")
    whole = whole.withColumn("_end", state_after(0, F.col("_swaps"), F.col("_fixed")))
    whole = whole.withColumn("_entry", F.coalesce(F.lag("_end").over(in_file), F.lit(0)))
    begun = F.when(F.col("_entry") == 0, F.col("_begun0")).otherwise(F.col("_begun1"))
    whole = whole.withColumn("_first", F.coalesce(F.sum(begun).over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    whole = stage(whole.select(*piece, "_entry", "_first", "_end"), "splits")
    open_files = whole.groupBy(FILE).agg(F.max_by("_end", F.struct(BLOCK, CHUNK)).alias("_end")).filter("_end = 1").limit(1).collect()
    if open_files:
        raise ValueError(f"a quoted field never ends: {open_files[0][0]}")

    def actual(name: str) -> Column:
        return F.when(F.col("_entry") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))

    placed = scanned.join(F.broadcast(whole.drop("_end")), piece)  # a row per 16,384 lines
    placed = placed.withColumns({"_begins": (actual("_before") == 0), "_closed": (actual("_after") == 0),
                                 "record": F.col("_first") + actual("_begun") - 1})
    alone = F.col("_begins") & F.col("_closed")
    single = placed.filter(alone).select(FILE, "record", "value")
    parts = F.sort_array(F.collect_list(F.struct(BLOCK, "_at", "value")))
    several = placed.filter(~alone).select(FILE, "record", BLOCK, "_at", "value").repartition(n, FILE, "record")
    broken = several.groupBy(FILE, "record").agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"))
    return single.union(broken)


def parsed_records(spark: SparkSession, path: str, schema: T.StructType, options: Mapping[str, str]) -> DataFrame:
    """Rows of all files of ``path`` with ``_source_file``, parsed strictly and written once, so every row is checked.

    The first record of each file is its header and must name the schema's columns.
    """
    stage = Stager(spark)
    numbered = numbered_lines(spark, path)
    tasks = numbered.rdd.getNumPartitions()
    lines = stage(numbered, "lines")
    text = F.regexp_replace("value", r"\r$", "")
    whole = records(lines, stage, options["sep"], tasks).withColumn(
        "value", F.when(F.col("record") == 0, F.regexp_replace(text, "^﻿", "")).otherwise(text))
    parse = {**options, "header": "false", "multiLine": "true"}
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema)
    rows = whole.filter((F.col("value") != "") | (F.col("record") == 0)).withColumn("_row", F.from_csv("value", ddl, parse))
    wrong = F.raise_error(F.concat(F.lit("a file begins with another header: "), FILE))
    named = F.array(*[F.col("_row")[f.name] for f in schema]) == F.array(*[F.lit(f.name) for f in schema])
    checked = rows.withColumn("_header", F.when(F.col("record") > 0, False).when(named, True).otherwise(wrong.cast("boolean")))
    return stage(checked.filter(~F.col("_header")).select("_row.*", FILE), "records")
