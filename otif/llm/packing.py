"""Best-fit packing by large-item matching.

Texts are tokenized, ended with id 0 and, only where longer than the capacity,
cut into full pieces after a shorter first one. Pieces of equal length are
interchangeable, so the packing is planned on the length histogram (at most
``capacity`` rows, whatever the corpus) and pieces find their place by their rank
among pieces of their length, from one range-partitioned sort. Ids take no part in
that: they are joined to the placed pieces by the number of the written row. The plan: pieces
above a third of the capacity go at most two to a sequence, the longest first,
each with the longest partner that still fits; shorter pieces, longest first, go
into the sequence with the smallest gap that holds them.

Defined cases: a null or empty text is the single end id; repeated rows are packed
once each; a null doc_id stays null; an empty table gives an empty result; columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from otif.llm.common import Staging, arrow_batch, parts, prefix_sums, small_batches, tidy
from otif.llm.tokens import GROUP_CHARS, encode_texts

CAPACITY = 2048
PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("ids", pa.binary())])
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, {row}sequence_id long, offset long"


@dataclass(frozen=True)
class Fill:
    """``count`` pieces of one length, from rank ``rank`` on: ``each`` to a sequence from ``sequence`` on, at ``offset``."""

    length: int
    rank: int
    count: int
    each: int
    sequence: int
    offset: int


class Plan:
    """Packs a length histogram; ``fills`` lists where each run of ranks goes."""

    def __init__(self, histogram: dict[int, int], capacity: int = CAPACITY):
        self.capacity, self.left = capacity, dict(histogram)
        self.used = dict.fromkeys(histogram, 0)
        self.fills: list[Fill] = []
        self.sequences = 0
        self.by_gap: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> runs (first sequence, how many)
        self.gaps: list[int] = []
        self._match_large()
        for length in sorted((x for x in self.left if x <= capacity // 3), reverse=True):
            self._best_fit(length)

    def _put(self, length: int, count: int, each: int, sequence: int, offset: int) -> None:
        self.fills.append(Fill(length, self.used[length], count, each, sequence, offset))
        self.used[length] += count
        self.left[length] -= count

    def _open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def _leave(self, gap: int, first: int, n: int) -> None:
        if n and gap:
            if gap not in self.by_gap or not self.by_gap[gap]:
                insort(self.gaps, gap)
            self.by_gap[gap].append((first, n))

    def _match_large(self) -> None:
        large = sorted(x for x in self.left if x > self.capacity // 3)
        for length in reversed(large):
            while self.left[length]:
                rest = self.capacity - length
                fits = next((x for x in reversed(large) if x <= min(rest, length) and self.left[x] > (x == length)), None)
                if fits is None:
                    n = self.left[length]
                    first = self._open(n)
                    self._put(length, n, 1, first, 0)
                    self._leave(rest, first, n)
                elif fits == length:
                    n = self.left[length] // 2
                    first = self._open(n)
                    self._put(length, 2 * n, 2, first, 0)
                    self._leave(rest - length, first, n)
                else:
                    n = min(self.left[length], self.left[fits])
                    first = self._open(n)
                    self._put(length, n, 1, first, 0)
                    self._put(fits, n, 1, first, length)
                    self._leave(rest - fits, first, n)

    def _best_fit(self, length: int) -> None:
        while self.left[length]:
            at = bisect_left(self.gaps, length)
            if at == len(self.gaps):
                each = self.capacity // length
                n = -(-self.left[length] // each)
                self._into(self.capacity, self._open(n), n, length)
                continue
            gap = self.gaps[at]
            first, n = self.by_gap[gap].pop()
            if not self.by_gap[gap]:
                self.gaps.pop(at)
            self._into(gap, first, n, length)

    def _into(self, gap: int, first: int, n: int, length: int) -> None:
        """Fill a run of ``n`` sequences with ``gap`` left by as many pieces as they hold or are left."""
        each, offset = gap // length, self.capacity - gap
        full = min(n, self.left[length] // each)
        if full:
            self._put(length, full * each, each, first, offset)
            self._leave(gap - each * length, first, full)
        if full < n and (rest := self.left[length]) and rest < each:
            self._put(length, rest, rest, first + full, offset)
            self._leave(gap - rest * length, first + full, 1)
            full += 1
        self._leave(gap, first + full, n - full)


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids)."""
    schema = PIECES if with_ids else pa.schema([f for f in PIECES if f.name != "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, 1, GROUP_CHARS):  # a batch of its own each: only the texts and ids of one part are held
                out = {f.name: [] for f in schema}
                for doc_id, ids in zip(part.column(0).to_pylist(), encode_texts(tokenizer, part.column(1).to_pylist()), strict=True):
                    first = (len(ids) - 1) % capacity + 1
                    bounds = [0, *range(first, len(ids) + 1, capacity)]
                    for piece, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                        raw = ids[a:b].tobytes()
                        row = {"doc_id": doc_id, "piece": piece, "start": a, "length": b - a, "ids_crc32": zlib.crc32(raw), "ids": raw}
                        for name in out:
                            out[name].append(row[name])
                yield arrow_batch(schema, out)

    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), ddl)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Every piece with its sequence_id and offset; ``with_ids`` adds its ids (little-endian unsigned 32-bit)."""
    staging = Staging(docs.sparkSession, "packing")
    cut = cut_pieces(docs, tokenizer, capacity, with_ids)
    # Written once: the range partitioning reads its input twice, and ``_row`` must not change.
    with small_batches(docs.sparkSession):
        pieces = staging.put(cut.withColumn("_row", F.monotonically_increasing_id()) if with_ids else cut, "cut")
    pieces_only = pieces.drop("ids").withColumn("_one", F.lit(1).cast("long"))
    order = ["length", "doc_id", "piece", "ids_crc32"]
    ranked = prefix_sums(staging, pieces_only, order, {"_rank": "_one"}, "pieces")
    histogram = {r["length"]: r["count"] for r in ranked.groupBy("length").count().collect()}  # at most `capacity` rows
    below, base = {}, 0
    for length in sorted(histogram):
        below[length], base = base, base + histogram[length]
    by_length: dict[int, list[Fill]] = defaultdict(list)
    for fill in Plan(histogram, capacity).fills:
        by_length[fill.length].append(fill)
    plan = {length: (below[length], np.array([(f.rank, f.each, f.sequence, f.offset) for f in fills], np.int64)) for length, fills in by_length.items()}
    shared = docs.sparkSession.sparkContext.broadcast(plan)  # bounded by the capacity, not by the corpus
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["_row"] * with_ids]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(batch.schema.names.index(c)).to_numpy() for c in ("length", "_rank"))
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths):
                at = lengths == length
                first, fills = shared.value[int(length)]
                rank = ranks[at] - 1 - first
                rank0, each, seq, start = fills[np.searchsorted(fills[:, 0], rank, "right") - 1].T
                sequence[at] = seq + (rank - rank0) // each
                offset[at] = start + (rank - rank0) % each * length
            columns = [batch.column(batch.schema.names.index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    placed = ranked.mapInArrow(place, PACKED.format(row="_row long, " * with_ids))
    if not with_ids:
        return placed
    return placed.join(pieces.select("_row", "ids"), "_row").select(*names[:-1], "ids", "sequence_id", "offset")
