"""Minimax contiguous partition of ordered atomic groups into shards.

Rows with equal texts form one group; groups are ordered by their first doc_id and
cut into consecutive shards so that the largest shard is as small as possible. The
smallest feasible capacity is found by binary search with a greedy check, as on one
machine, but the prefix sums stay distributed: each round collects a bounded sketch
of group ends (about ``SKETCH`` buckets), which proves some capacities
feasible (greedy on group ends that are known) and some infeasible (greedy that may
cut anywhere a hidden end might be). The next round looks only between the cuts of
the two bounds, until they meet; the result is exact.

Defined cases: a null text has size ``OVERHEAD`` and null rows form one group; rows
with equal doc_id are ordered by text; a group larger than an even share fills its
shard alone; with fewer groups than shards the last ones stay empty; an empty table
gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from otif.llm.common import Staging, prefix_sums, text_key, utf8_bytes

OVERHEAD = 8
SKETCH = 32768  # group ends collected in a round, over all open cuts


def reach(ends: list[int], hidden: list[tuple[int, int]], capacity: int, shards: int, total: int) -> list[int]:
    """Ends of ``shards`` shards, each filled as far as ``capacity`` allows.

    ``ends`` are known group ends; a cut may also fall anywhere inside a span of
    ``hidden`` (low, high), where unseen ends may lie.
    """
    cuts, at, lows = [], 0, [a for a, _ in hidden]
    for _ in range(shards):
        if at + capacity >= total:
            at = total
        else:
            i = bisect_right(ends, at + capacity)
            best = ends[i - 1] if i else 0
            if j := bisect_right(lows, at + capacity):
                best = max(best, min(hidden[j - 1][1], at + capacity))
            at = max(at, best)
        cuts.append(at)
    return cuts


def greedy(ends: list[int], hidden: list[tuple[int, int]], capacity: int, shards: int, total: int) -> list[int] | None:
    """The greedy check: the cuts, or None if ``shards`` shards do not reach the end."""
    cuts = reach(ends, hidden, capacity, shards, total)
    return cuts if cuts[-1] == total else None


def smallest(feasible, low: int, high: int) -> int:
    """Least value of (low, high] that is feasible; ``high`` is known to be."""
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (low, mid) if feasible(mid) else (mid, high)
    return high


def minimax_cuts(groups: DataFrame, shards: int, sketch: int = SKETCH) -> list[int]:
    """Ends (prefix sums of bytes) of the shards; ``groups`` has size and end, one row per group."""
    total, largest = groups.agg(F.max("end"), F.max("size")).first()
    if total is None:
        return []
    low, high = max(-(-total // shards), largest) - 1, -(-total // shards) + largest
    spans, known = [(0, total)], {total}
    while True:
        buckets = max(sketch // len(spans), 64)
        span = F.lit(None).cast("int")
        for k, (a, b) in enumerate(spans):
            span = F.when((F.col("end") > a) & (F.col("end") <= b), F.lit(k)).otherwise(span)
        starts, widths = (F.array(*(F.lit(x).cast("long") for x in xs)) for xs in zip(*((a, max(1, -(-(b - a) // buckets))) for a, b in spans), strict=True))
        inside = groups.select("end", span.alias("span")).filter("span is not null")
        bucket = F.expr("(end - start - 1) div width")
        inside = inside.select("end", "span", starts[F.col("span")].alias("start"), widths[F.col("span")].alias("width")).withColumn("bucket", bucket)
        found = inside.groupBy("span", "bucket").agg(F.min("end").alias("lo"), F.max("end").alias("hi"), F.count_distinct("end").alias("n")).collect()
        known.update(e for r in found for e in (r["lo"], r["hi"]))
        ends, hidden = sorted(known), sorted((r["lo"], r["hi"]) for r in found if r["n"] > 2)
        before = high - low
        high = smallest(lambda c: greedy(ends, [], c, shards, total) is not None, low, high)
        low = smallest(lambda c: greedy(ends, hidden, c, shards, total) is not None, low, high) - 1
        if high - low <= 1:
            return greedy(ends, [], high, shards, total)
        if high - low > before // 2:
            sketch *= 4
        early, late = reach(ends, [], low + 1, shards, total), reach(ends, hidden, high, shards, total)
        spans = merge_spans(list(zip(early, late, strict=True)))


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        elif b > a:
            out.append((a, b))
    return out


def shard_by_bytes(docs: DataFrame, shards: int, sketch: int = SKETCH) -> DataFrame:
    """Per row: doc_id, size, text_crc32, shard, slot (gapless from 0 in its shard)."""
    staging = Staging(docs.sparkSession, "sharding")
    rows = staging.put(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (utf8_bytes(F.col("text")) + OVERHEAD).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.coalesce(text_key(F.col("text")), F.lit(b"")).alias("key")), "rows")
    groups = rows.groupBy("key").agg(F.min("doc_id").alias("first"), F.sum("size").alias("size"), F.count("*").alias("n"))
    groups = prefix_sums(staging, groups, ["first", "key"], {"end": "size", "rows": "n"}, "groups")
    cuts = minimax_cuts(groups, shards, sketch)
    shard = sum((F.when(F.col("end") > c, 1).otherwise(0) for c in cuts[:-1]), F.lit(0))
    groups = groups.select("key", "first", shard.alias("shard"), (F.col("rows") - F.col("n")).alias("before"))
    begins = {r["shard"]: r["before"] for r in groups.groupBy("shard").agg(F.min("before").alias("before")).collect()}  # a row per shard
    placed = rows.join(groups.drop("before"), "key").withColumn("one", F.lit(1).cast("long"))
    placed = prefix_sums(staging, placed, ["first", "key", "doc_id"], {"position": "one"}, "placed")
    begin = F.array(*(F.lit(begins.get(k, 0)).cast("long") for k in range(shards)))
    return placed.select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
                         (F.col("position") - 1 - begin[F.col("shard")]).alias("slot"))
