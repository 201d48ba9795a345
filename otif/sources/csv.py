"""Strict delimited extracts as all-string frames (SRC-1..4).

Files are read by Spark executors with an explicit all-string schema built from
the header (no inference, leading zeros kept): ``;`` separator, ``"`` quotes
with doubled quotes, UTF-8 with an optional BOM, blank lines skipped, empty
fields as null and any row with a wrong field count failing the read
(FAILFAST). Only the header line of each source is read on the driver, to
check the header contract before any data is touched. Extracts whose quoted
fields hold line breaks are read in splits too (``otif.sources.records``).
"""

from __future__ import annotations

import csv
import io
from collections import Counter
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from otif.model import SPECS, TableSpec
from otif.operators.quality import check_contract
from otif.sources.records import parsed_records

OPTIONS = {"sep": ";", "header": "true", "quote": '"', "escape": '"', "mode": "FAILFAST",
           "encoding": "UTF-8", "enforceSchema": "false", "ignoreLeadingWhiteSpace": "false",
           "ignoreTrailingWhiteSpace": "false", "columnPruning": "false"}  # pruned rows would not be checked
BOM = "\N{ZERO WIDTH NO-BREAK SPACE}"
METADATA_PREFIX = "_"


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Parse the first line of the source with the extract's quoting rules."""
    first = spark.read.option("lineSep", "\n").text(path).limit(1).collect()
    if not first:
        raise ValueError(f"no header, the extract is empty or absent: {path}")
    line = first[0][0].removeprefix(BOM).rstrip("\r")
    return next(csv.reader(io.StringIO(line), delimiter=";", quotechar='"', doublequote=True, strict=True))


def header_faults(header: list[str]) -> list[str]:
    """What a header breaks: every column needs a name of its own, and metadata names are reserved (SRC-2)."""
    times = Counter(header)
    return [*(f"column {i + 1} has no name" for i, name in enumerate(header) if not name), *([] if header else ["there are no columns"]),
            *(f"{name} stands {n} times" for name, n in times.items() if name and n > 1),
            *(f"{name} begins like a metadata column" for name in times if name.startswith(METADATA_PREFIX))]


def check_header(header: list[str], path: str) -> None:
    if faults := header_faults(header):
        raise ValueError(f"header of {path}: {'; '.join(faults)}")


def read_extract(spark: SparkSession, path: str, header: list[str] | None = None,
                 multiline: bool = False) -> DataFrame:
    """One extract with provenance columns ``_source_file`` and ``_loaded_at`` (SRC-1, SRC-4).

    ``multiline`` is only needed when quoted fields contain line breaks: records
    are then put together from lines over all splits of a file.
    """
    header = header or read_header(spark, path)
    check_header(header, path)
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in header])
    if multiline:
        return parsed_records(spark, path, schema, OPTIONS).withColumn("_loaded_at", F.current_timestamp())
    frame = spark.read.schema(schema).options(**OPTIONS).csv(path)
    return frame.select("*", F.col("_metadata.file_path").alias("_source_file"),
                        F.current_timestamp().alias("_loaded_at"))


def read_extracts(spark: SparkSession, folder: str, specs: Mapping[str, TableSpec] = SPECS,
                  multiline: bool = False) -> dict[str, DataFrame]:
    """All sources; every header and contract is checked before any data is read (SRC-3)."""
    paths = {name: f"{folder.rstrip('/')}/{spec.source_file}" for name, spec in specs.items()}
    headers = {name: read_header(spark, p) for name, p in paths.items()}
    for name, header in headers.items():
        check_header(header, paths[name])
        check_contract(name, specs[name], header)
    return {name: read_extract(spark, paths[name], headers[name], multiline) for name in specs}


def write_extract(frame: DataFrame, path: str, one_file: bool = True) -> None:
    """Write an extract the way the reader expects it: as one file by one task (fixtures), or as a file from every task."""
    ((frame.coalesce(1) if one_file else frame).write.mode("overwrite").options(**{k: v for k, v in OPTIONS.items()
                                                          if k not in ("mode", "enforceSchema")})
     .option("emptyValue", "").csv(path))
