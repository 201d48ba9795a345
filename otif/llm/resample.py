"""Target-distribution importance resampling with a selected cutoff.

Every run of 1 to ``NGRAM`` words falls into one of ``BUCKETS`` buckets (crc32 of its
UTF-8 bytes). Bucket counts of the corpus and of the target give each bucket a gain;
the gains form one array, and a text's weight is the sum of the array over its
features. A Gumbel draw, fixed by seed and doc_id, is added to the weight, so the
highest scores are a sample without replacement in proportion to exp(weight / SCALE).

The cutoff is selected, not sorted for: each partition of the candidates names its median, the
median of these weighted by the candidates left in each partition is the pivot,
and the side that cannot hold the cutoff, at least a quarter of the candidates, is
discarded. Candidates are written anew once seven of eight are gone, so all
rounds together read a small multiple of the rows. Only the winners are sorted.

Defined cases: a null text is an empty one, without features, of weight 0; rows with fewer than
``min_words`` words are never drawn; equal scores go to the smaller doc_id (null last),
then to fewer features, then to the row read first; repeated rows are drawn one by one;
a null doc_id draws as an empty id; an empty target has zero counts; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from otif.llm.common import Staging, arrow_batch, prefix_sums

BUCKETS, NGRAM, SCALE = 10_000, 1, 1000
MIN_WORDS, PERCENT, SEED = 20, 10, 2024
MEMO = 300_000  # words whose gain a task remembers
BLOCK = 1 << 20  # bytes of a text that are cut into words at a time
CANDIDATES = 1_000_000  # of one partition, when they are written anew

#: A-Z become a-z; any other byte below 0x80 that is no digit and no letter parts words.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def word_blocks(raw: bytes, fold: bytes = FOLD) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text, about ``BLOCK`` bytes of them at a time."""
    raw, at = raw.translate(fold), 0
    while at < len(raw):
        end = raw.find(b" ", at + BLOCK)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def features(raw: bytes, ngram: int = NGRAM) -> Iterator[tuple[int, list[bytes]]]:
    """(number of words, features that end among them) per block of a text."""
    tail: list[bytes] = []
    for words in word_blocks(raw):
        found, run = words, [*tail, *words]
        for n in range(2, ngram + 1):
            found = found + [b" ".join(run[i - n + 1 : i + 1]) for i in range(max(n - 1, len(tail)), len(run))]
        tail = run[max(0, len(run) - ngram + 1) :] if ngram > 1 else []
        yield len(words), found


def bucket_counts(texts: DataFrame, ngram: int = NGRAM, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows of ``text``; each task sends at most one row per bucket."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(buckets, np.int64), Counter()

        def settle() -> None:
            for feature, n in seen.items():
                total[zlib.crc32(feature) % buckets] += n
            seen.clear()

        for batch in batches:
            for raw in batch.column(0).to_pylist():
                for _, found in features(raw or b"", ngram):
                    seen.update(found)
                    if len(seen) > MEMO:
                        settle()
        settle()
        at = np.flatnonzero(total)
        yield arrow_batch(schema, {"bucket": at, "n": total[at]})

    rows = texts.select(F.col("text").cast("binary")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows.collect():  # at most ``buckets`` rows
        out[bucket] = n
    return out


def gains_of(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """floor(SCALE * ln of the smoothed share in the target over that in the source) per bucket."""
    size, t_all, s_all = len(source), int(target.sum()), int(source.sum())
    shares = zip(target.tolist(), source.tolist(), strict=True)
    return np.array([math.floor(SCALE * math.log((t + 1) * (s_all + size) / ((s + 1) * (t_all + size)))) for t, s in shares], np.int64)


class Gains(dict):
    """Gain of a feature, looked up in the array once and remembered while there is room."""

    def __init__(self, array: np.ndarray):
        self.array = array

    def __missing__(self, feature: bytes) -> int:
        if len(self) > MEMO:
            self.clear()
        got = self[feature] = int(self.array[zlib.crc32(feature) % len(self.array)])
        return got


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """floor(SCALE * Gumbel) of the id's uniform draw."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gains: np.ndarray, ngram: int = NGRAM, seed: int = SEED) -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight, score."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_words", "n_features", "weight", "score")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = Gains(gains)
        for batch in batches:
            out = {f.name: [] for f in schema}
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = n = weight = 0
                for count, found in features(raw or b"", ngram):
                    words, n, weight = words + count, n + len(found), weight + sum(map(gain.__getitem__, found))
                row = (doc_id, words, n, weight, weight + noise(doc_id, seed))
                for name, value in zip(out, row, strict=True):
                    out[name].append(value)
            yield arrow_batch(schema, out)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


Key = tuple[int, ...]


def weighted_median(medians: Sequence[tuple[Key, int]]) -> Key:
    """The first key, in order, up to which half of the weight lies."""
    ordered = sorted(medians)
    sums = list(accumulate(n for _, n in ordered))
    return ordered[bisect_left(sums, (sums[-1] + 1) // 2)][0]


def _partition_medians(columns: Sequence[str], pivot: Key | None):
    """For mapInArrow: per side of the pivot (-1 below, 0 at it, 1 above), its rows in this partition and their median key."""
    names = [f"m{i}" for i in range(len(columns))]
    schema = pa.schema([("side", pa.int32()), ("n", pa.int64()), *((m, pa.int64()) for m in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns]) for b in batches]
        keys = np.concatenate(parts, axis=1) if parts else np.zeros((len(columns), 0), np.int64)
        side = np.ones(keys.shape[1], np.int32)
        if pivot is not None:
            side[:] = 0
            for column, p in zip(keys, pivot, strict=True):
                side = np.where(side == 0, np.sign(column - p), side)
        for s in (-1, 0, 1):
            some = keys[:, side == s]
            if n := some.shape[1]:
                middle = some[:, np.lexsort(some[::-1])[(n - 1) // 2]] if s else some[:, 0]
                yield arrow_batch(schema, {"side": [s], "n": [n], **{m: [int(v)] for m, v in zip(names, middle, strict=True)}})

    return run, "side int, n long, " + ", ".join(f"{m} long" for m in names)


def _beyond(columns: Sequence[str], key: Key, below: bool) -> Column:
    """Whether a row's key lies below (or above) ``key``, by the columns in turn."""
    found = F.lit(False)
    for column, value in reversed(list(zip(columns, key, strict=True))):
        found = ((F.col(column) < value) if below else (F.col(column) > value)) | ((F.col(column) == value) & found)
    first = F.col(columns[0]) <= key[0] if below else F.col(columns[0]) >= key[0]
    return first & found  # the first column alone reaches the scan


def smallest(staging: Staging, rows: DataFrame, columns: Sequence[str], k: int) -> Key:
    """The ``k``-th smallest key (1-based) of a written table whose keys, tuples of longs, are distinct."""
    table, held, low, high, pivot = rows, None, None, None, None
    step = 0
    while True:
        now = table.select(*columns)
        now = now.filter(_beyond(columns, low, False)) if low is not None else now
        now = now.filter(_beyond(columns, high, True)) if high is not None else now
        found = now.mapInArrow(*_partition_medians(columns, pivot)).collect()  # three rows a partition at most
        sides = {s: [(tuple(r[2:]), r[1]) for r in found if r[0] == s] for s in (-1, 0, 1)}
        below, at, above = (sum(n for _, n in sides[s]) for s in (-1, 0, 1))
        held = held or below + at + above
        if k <= below:
            high, medians, left = pivot, sides[-1], below
        elif k <= below + at:
            return pivot
        else:
            k, low, medians, left = k - below - at, pivot if pivot is not None else low, sides[1], above
        if left * 8 <= held:
            step += 1
            rest = rows if table is rows else table
            rest = rest.filter(_beyond(columns, low, False)) if low is not None else rest
            rest = rest.filter(_beyond(columns, high, True)) if high is not None else rest
            table, held = staging.put(rest.select(*columns).coalesce(left // CANDIDATES + 1), f"candidates-{step}"), left
        pivot = weighted_median(medians)


KEY = ["_score", "_id", "_size", "_row"]


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, ngram: int = NGRAM,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: doc_id, n_features, weight, score and, for the drawn ``percent``, the rank."""
    staging = Staging(docs.sparkSession, "resample")
    gains = gains_of(bucket_counts(target, ngram, buckets), bucket_counts(docs, ngram, buckets))
    keyed = scored(docs, gains, ngram, seed).select(
        "*", (-F.col("score")).alias("_score"), F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("_id"), F.col("n_features").alias("_size"),
        F.monotonically_increasing_id().alias("_row"))
    keyed = staging.put(keyed, "scored")
    able = keyed.filter(F.col("n_words") >= min_words)
    k = percent * able.count() // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    if not k:
        return keyed.select(*columns, F.lit(None).cast("long").alias("rank"))
    cutoff = smallest(staging, able, KEY, k)
    drawn = ~_beyond(KEY, cutoff, False) & (F.col("n_words") >= min_words)
    winners = keyed.filter(drawn).select(*columns, *KEY, F.lit(1).cast("long").alias("_one"))
    ranked = prefix_sums(staging, winners, KEY, {"rank": "_one"}, "winners")
    return ranked.select(*columns, "rank").union(keyed.filter(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")))


#: The query in DuckDB; crc32 is folded over the bytes of the distinct words.
SQL = r"""
WITH crc AS MATERIALIZED (
    SELECT list_transform(range(256), lambda i: list_reduce([i, 1, 1, 1, 1, 1, 1, 1, 1],
        lambda c, one: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
folded AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
words AS MATERIALIZED (SELECT doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM folded),
wanted AS MATERIALIZED (
    SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
distinct_words AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM words UNION SELECT word FROM wanted)),
bytes AS (SELECT word, list_transform(range(length(h) // 2), lambda i: ('0x' || h[2 * i + 1 : 2 * i + 2])::BIGINT) AS b FROM distinct_words),
hashed AS MATERIALIZED (
    SELECT word, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
    FROM bytes, crc),
s AS (SELECT bucket, count(*) AS n FROM words JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM wanted JOIN hashed USING (word) GROUP BY bucket),
sizes AS (SELECT (SELECT count(*) FROM words) AS s_all, (SELECT count(*) FROM wanted) AS t_all),
gains AS (
    SELECT b.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (s_all + 10000) / ((coalesce(s.n, 0) + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain
    FROM (SELECT unnest(range(10000)) AS bucket) b CROSS JOIN sizes LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
summed AS (SELECT doc_id, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM words JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
    SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
        + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || d.doc_id::VARCHAR)[1:8])::BIGINT + 0.5) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM documents d LEFT JOIN summed USING (doc_id)),
ranked AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, 10 * count(*) OVER () // 100 AS k FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= k THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""
