"""Removal of repeated passages by hashing normalised units.

A unit is a sentence or a part of one: text is cut at line breaks and after sentence marks
followed by white space, and, where none of these is within ``NEAR`` words on either side, after
each word whose hash is the least of those words. So every cut depends on its ``NEAR``
neighbours only, and equal passages are cut alike wherever they stand, but for their outermost
words. A unit is normalised (words only; A-Z and À-Þ in lower case) and hashed to 128 bits;
digests are counted over all documents and the occurrence ranked first (least doc_id, then row,
then place) stays. Neighbouring repeated units form a run; a run of at least ``MIN_WORDS`` words
is removed, a shorter one (a licence line, a stock phrase) is left. A run ends at unit borders,
so a few words of a passage without punctuation may stay at either end.

Offsets are those of the original text, in code points, end exclusive. Defined cases:
null and blank texts have no units; repeated rows count as repetitions of the first; a
null doc_id ranks last; an empty table gives an empty result; columns other than
doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from otif.llm.common import SPACE, Staging, arrow_batch, polynomials, scan_words
from otif.llm.tokens import groups

MIN_WORDS = 25
NEAR = 3  # words on either side that decide about a cut without a mark
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)

SEPARATORS = SPACE + b".,;:!?\"'()[]{}<>|*#$%&-"
UNITS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("unit", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
                   ("words", pa.int32()), ("hi", pa.int64()), ("lo", pa.int64())])


def spans(texts: Sequence[str]) -> dict[str, np.ndarray]:
    """Columns of the units of some texts: text (its number), unit, start, end, words, hi, lo."""
    w = scan_words(texts, SEPARATORS)
    if not len(w.starts):
        return {c: np.zeros(0, np.int64) for c in ("text", "unit", "start", "end", "words", "hi", "lo")}
    space = np.isin(w.data, np.frombuffer(SPACE, np.uint8))
    passed = [np.concatenate([[0], np.cumsum(x)]) for x in (w.data == 10, np.isin(w.data, np.frombuffer(b".!?", np.uint8)), space)]
    after = np.append(w.starts[1:], len(w.data))
    lines, marks, spaces = (p[after] - p[w.ends] for p in passed)
    last = (lines > 0) | ((marks > 0) & (spaces > 0))  # words that end a unit
    last |= inner_cuts(w.hashes, last)
    first = np.flatnonzero(np.concatenate([[True], last[:-1]]))
    sizes = np.diff(np.append(first, len(last)))
    hi, lo = (polynomials(w.hashes, sizes, base).view(np.int64) for base in BASES)
    text = np.searchsorted(w.begins, first, "right") - 1
    gaps = np.flatnonzero(space)
    # Marks next to the words belong to the unit: from the white space before it to that after it.
    before = np.searchsorted(gaps, w.starts[first]) - 1
    start = np.maximum(np.where(before < 0, 0, gaps[before] + 1), w.texts[text])
    end = gaps[np.searchsorted(gaps, w.ends[first + sizes - 1])]
    points = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
    unit = np.arange(len(first)) - np.searchsorted(text, text)
    return {"text": text, "unit": unit, "start": points[start] - points[w.texts[text]], "end": points[end] - points[w.texts[text]], "words": sizes, "hi": hi, "lo": lo}


def inner_cuts(hashes: np.ndarray, last: np.ndarray, near: int = NEAR) -> np.ndarray:
    """Words whose hash is the least among their neighbours (of equal ones none), no unit ending there."""
    cut = np.zeros(len(hashes), bool)
    if len(hashes) > 2 * near:
        own = hashes[near:-near]
        ended = np.concatenate([[0], np.cumsum(last)])
        inner = ended[2 * near + 1 :] == ended[: -2 * near - 1]
        for k in range(2 * near + 1):
            if k != near:
                inner &= own < hashes[k : k + len(own)]
        cut[near:-near] = inner
    return cut


def numbered(docs: DataFrame) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")


def units(rows: DataFrame) -> DataFrame:
    """A row per unit of numbered rows (row, doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, doc_id, texts = (batch.column(i) for i in range(3))
            texts = texts.to_pylist()
            for part in groups(texts):
                found = spans(texts[part])
                text = pa.array(found.pop("text") + part.start)
                yield arrow_batch(UNITS, {"row": row.take(text), "doc_id": doc_id.take(text), **found})

    return rows.filter("text is not null").mapInArrow(run, "row long, doc_id long, unit int, start long, end long, words int, hi long, lo long")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """A row per removed run: row, doc_id, start, end, words, units, first_doc_id (where its first unit stays), first_start."""
    return _runs(Staging(docs.sparkSession, "substring"), numbered(docs), min_words)


def _runs(staging: Staging, rows: DataFrame, min_words: int) -> DataFrame:
    found = staging.put(units(rows), "units")
    digest = ["hi", "lo"]
    often = found.groupBy(*digest).agg(F.count("*").alias("n")).filter("n > 1").select(*digest)
    shared = staging.put(found.join(often, digest), "shared")  # a hot digest meets one row: the skewed join is split
    staging.drop("units")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "start")
    firsts = shared.groupBy(*digest).agg(F.min(rank).alias("first"))
    later = shared.join(firsts, digest).filter((F.col("row") != F.col("first.row")) | (F.col("start") != F.col("first.start")))
    later = later.select("row", "doc_id", "unit", "start", "end", "words", F.col("first.doc_id").alias("first_doc_id"), F.col("first.start").alias("first_start"))
    place = Window.partitionBy("row").orderBy("unit")
    runs = later.withColumn("run", F.col("unit") - F.row_number().over(place))
    runs = runs.groupBy("row", "doc_id", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("words"), F.count("*").alias("units"),
        F.min(F.struct("start", "first_doc_id", "first_start")).alias("f"))
    return runs.filter(F.col("words") >= min_words).select("row", "doc_id", "start", "end", "words", "units", "f.first_doc_id", "f.first_start")


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id and text of every row, repeated runs cut out, and the removed spans of the original text."""
    staging = Staging(docs.sparkSession, "substring")
    rows = staging.put(numbered(docs), "rows")  # written, so that the numbers hold
    cuts = _runs(staging, rows, min_words).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "first_doc_id"))).alias("removed"))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, removed: pd.Series) -> pd.Series:
        out = []
        for text, gone in zip(texts, removed, strict=True):
            for r in reversed(gone if gone is not None else []):
                text = text[: r["start"]] + text[r["end"] :]
            out.append(text)
        return pd.Series(out, dtype=object)

    kept = rows.join(cuts, "row", "left")
    return kept.select("doc_id", cut("text", "removed").alias("text"), F.coalesce("removed", F.array()).alias("removed"))
