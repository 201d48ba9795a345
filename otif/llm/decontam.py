"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit check.

Texts and items are sequences of words (lower case, cut at ASCII white space and
marks). The random walk of a CGK embedding reads a sequence word by word; at
each step it notes the word under its pointer and moves on if a random bit of that
word and step is 1, so sequences at a small edit distance keep most noted words
equal (a small Hamming distance). Repeated bit sampling takes ``SAMPLES`` noted
words as a key, ``REPEATS`` times in each of ``WALKS`` independent walks; the steps
sampled lie within a length class of up to ``WINDOW`` words. An item is indexed by
windows that begin at every ``HOP``-th of its words and by one at its end, so the
windows grow in number with the item and some have fewer edits than the item as a
whole; recall does not fall with length.

Windows begin at every ``STRIDE``-th word of a text; an item's windows are indexed without
their first 0 to STRIDE - 1 words, so every alignment meets one window exactly. Hits are
verified by the exact edit distance (insert, delete or replace a word) between the
item and its best stretch of the text around the window; up to ``RATE`` of the
item's words may differ.

Items are taken in blocks of bounded size; each block is broadcast and met with all
documents. Defined cases: items of fewer than ``MIN_WORDS`` words prove nothing and
are never found; a null or blank text contains no item; equal items are found under
each of their ids; repeated rows are found once each; empty tables give no match; columns
other than those named are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from otif.llm.common import MASK64, SPACE, arrow_batch, mix64, word_hashes
from otif.llm.tokens import groups

RATE = 0.2
MIN_WORDS = 8
STRIDE = 4
WINDOW, HOP = 13, 8  # words of an item's windows, and between their begins
WALKS, REPEATS, SAMPLES = 4, 8, 4  # recall at RATE over 0.95 for items of any length (test)
LANES = 4  # 64-bit lanes of a sketch of words
REACH = 1.4  # steps sampled, as a multiple of the least length of the class; a walk advances a word every two steps
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 2 << 20
SEPARATORS = SPACE + b".,;:!?\"'()[]{}<>|*#$%&-"
GOLDEN = 0x9E3779B97F4A7C15
PRIME = np.uint64(0xD6E8FEB86659FD93)


def edit_search(item: Sequence[int], text: Sequence[int]) -> int:
    """Least edit distance between ``item`` and any stretch of ``text`` (bit-parallel)."""
    places: dict[int, int] = defaultdict(int)
    for i, w in enumerate(item):
        places[w] |= 1 << i
    m = len(item)
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best = m
    for w in text:
        eq = places.get(w, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up, down = minus | (full & ~(horizontal | plus)), plus & horizontal
        score += bool(up & high) - bool(down & high)
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = down | (full & ~(vertical | up)), up & vertical
        best = min(best, score)
    return best


def length_class(n: int) -> int:
    """Least length of the class of ``n`` words: 5, 8, 13, 21, ..."""
    a, b = 5, 8
    while b <= n:
        a, b = b, a + b
    return a


def window_starts(n: int) -> list[int]:
    """Words of an item of ``n`` words at which its windows begin, each with STRIDE shifts."""
    last = max(n - WINDOW - STRIDE + 1, 0)
    return sorted({s for begin in {*range(0, last, HOP), last} | {0} for s in range(begin, begin + STRIDE)})


def sketches(words: np.ndarray) -> np.ndarray:
    """One bit of LANES * 64 for each word."""
    out = np.zeros((len(words), LANES), np.uint64)
    bit = (words >> np.uint64(20)) % np.uint64(64 * LANES)
    out[np.arange(len(words)), (bit // np.uint64(64)).astype(np.intp)] = np.uint64(1) << (bit % np.uint64(64))
    return out


class Index:
    """LSH tables of a block of items; picklable, of a size bounded by the block."""

    def __init__(self, items: Sequence[tuple[int | None, str]], rate: float = RATE, walks: int = WALKS, repeats: int = REPEATS, samples: int = SAMPLES):
        self.rate, self.repeats = rate, repeats
        self.items = [(item_id, h) for item_id, text in items if len(h := word_hashes([text], SEPARATORS)[0]) >= MIN_WORDS]
        self.distinct = [set(h.tolist()) for _, h in self.items]
        self.sizes = np.array([len(h) for _, h in self.items], np.int64)
        self.sketches = np.array([np.bitwise_or.reduce(sketches(h), axis=0) for _, h in self.items]).reshape(-1, LANES)
        variants = [(i, s, min(length_class(len(h) - s), WINDOW)) for i, (_, h) in enumerate(self.items) for s in window_starts(len(h))]
        self.plans = []  # per walk: step -> the keys (class, repeat) that sample it
        for walk in range(walks):
            plan = defaultdict(list)
            for c in sorted({c for *_, c in variants}):
                for r in range(repeats):
                    steps = np.random.default_rng([walk, c, r]).choice(max(int(REACH * c), samples), samples, replace=False)
                    for step in steps:
                        plan[int(step)].append((c, r))
            self.plans.append(dict(plan))
        self.tables = {}
        if not self.items:
            return
        pad = int(2 * max(len(h) for _, h in self.items)) + 8
        joined = np.concatenate([np.concatenate([h, np.zeros(pad, np.uint64)]) for _, h in self.items])
        begins = np.cumsum([0, *(len(h) + pad for _, h in self.items)])
        starts = np.array([begins[i] + s for i, s, _ in variants])
        of_class = np.array([c for *_, c in variants])
        for walk in range(walks):
            for (c, r), keys in self.keys(joined, starts, walk).items():
                mine = np.flatnonzero(of_class == c)
                order = mine[np.argsort(keys[mine], kind="stable")]
                size = 1 << int(np.clip(np.ceil(np.log2(len(mine) * 32 + 1)), 12, 22))
                seen = np.zeros(size, bool)
                seen[keys[mine] & np.uint64(size - 1)] = True
                self.tables[walk, c, r] = seen, keys[order], np.array([variants[i][0] for i in order]), np.array([variants[i][1] for i in order])

    def keys(self, words: np.ndarray, starts: np.ndarray, walk: int) -> dict[tuple[int, int], np.ndarray]:
        """LSH keys of the windows that begin at ``starts``; ``words`` go on past the last start by all steps."""
        plan = self.plans[walk]
        out: dict[tuple[int, int], np.ndarray] = {}
        at = starts.astype(np.intp)
        for step in range(max(plan, default=-1) + 1):
            if step % 64 == 0:  # 64 fresh random bits of each word; as a word's image under a bijection it also stands for the word
                images = mix64(words + np.uint64((1 + walk * 1000 + step) * GOLDEN & MASK64))
            noted = images.take(at)
            for key in plan.get(step, ()):
                if key in out:
                    out[key] ^= noted
                    out[key] *= PRIME
                else:
                    out[key] = noted * PRIME
            noted >>= np.uint64(step % 64)
            noted &= np.uint64(1)
            at += noted.view(np.intp)
        return {k: v ^ (v >> np.uint64(29)) for k, v in out.items()}

    def scan(self, texts: Sequence[str | None]) -> list[dict[int, tuple[int, int]]]:
        """Per text: item number -> (distance, word of the text near which it begins)."""
        found: list[dict[int, tuple[int, int]]] = [{} for _ in texts]
        if not self.items:
            return found
        filled, distinct = [t or "" for t in texts], self.distinct
        for part in groups(filled):
            joined, begins = word_hashes(filled[part], SEPARATORS)
            if not len(joined):
                continue
            for d, i, begin in self._plausible(joined, begins, self._candidates(joined)):
                item, place = self.items[i][1], begin - int(begins[d])
                slack = int(self.rate * len(item)) + 1
                near = joined[begins[d] + max(0, place - slack) : min(begins[d] + max(0, place + len(item) + slack), begins[d + 1])]
                if len(distinct[i].intersection(near.tolist())) < len(distinct[i]) - int(self.rate * len(item)):
                    continue  # an edit takes at most one of the item's words away
                distance = edit_search(item.tolist(), near.tolist())
                best = found[part.start + d].get(i, (distance + 1, 0))
                if distance <= self.rate * len(item) and distance < best[0]:
                    found[part.start + d][i] = distance, max(place, 0)
        return found

    def _candidates(self, words: np.ndarray) -> np.ndarray:
        """Rows (window start, item, shift) whose keys meet."""
        starts, out = np.arange(0, len(words), STRIDE), [np.zeros((0, 3), np.int64)]
        words = np.concatenate([words, np.zeros(max(max(plan) for plan in self.plans) + 1, np.uint64)])
        for walk in range(len(self.plans)):
            for key, got in self.keys(words, starts, walk).items():
                seen, known, item, shift = self.tables[walk, *key]
                maybe = np.flatnonzero(seen[got & np.uint64(len(seen) - 1)])
                low, high = np.searchsorted(known, got[maybe], "left"), np.searchsorted(known, got[maybe], "right")
                n = high - low
                if n.any():
                    entry = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
                    out.append(np.column_stack([np.repeat(starts[maybe], n), item[entry], shift[entry]]))
        return np.concatenate(out)

    def _plausible(self, words: np.ndarray, begins: np.ndarray, hits: np.ndarray) -> list[list[int]]:
        """(text, item, word at which it would begin) of the hits whose surroundings may hold enough of the item's words.

        An edit takes at most one of the item's words away, hence at most one bit of its sketch.
        """
        if not len(hits):
            return []
        start, item, shift = hits.T
        doc = np.searchsorted(begins, start, "right") - 1
        pad = int(shift.max())
        code = np.unique((doc * (len(words) + pad + 1) + start - shift + pad) * len(self.items) + item)
        item, code = code % len(self.items), code // len(self.items)
        doc, begin = code // (len(words) + pad + 1), code % (len(words) + pad + 1) - pad
        allowed = (self.rate * self.sizes[item]).astype(np.int64)
        low = np.maximum(begins[doc], begin - allowed - 1)
        high = np.minimum(begins[doc + 1], np.maximum(begin, begins[doc]) + self.sizes[item] + allowed + 1)
        missing = np.zeros(len(code), np.int64)
        level, ors = 0, sketches(words)
        depth = np.frexp((high - low).astype(np.float64))[1] - 1  # 2 ** depth words are at most the stretch
        while True:  # ors[i] covers 2 ** level words from i on
            at = np.flatnonzero(depth == level)
            held = ors[low[at]] | ors[high[at] - (1 << level)]
            missing[at] = np.bitwise_count(self.sketches[item[at]] & ~held).sum(axis=1)
            if level >= depth.max():
                break
            ors = ors[: len(ors) - (1 << level)] | ors[1 << level :]
            level += 1
        keep = missing <= allowed
        return np.column_stack([doc, item, begin])[keep].tolist()


def blocks(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes over all items, each of a bounded number and size."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null")
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    count = max(1, -(-n // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    for k in range(count):
        yield Index([tuple(r) for r in items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).collect()])


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per document and item found in it: doc_id, item_id, distance, item_words, word."""
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()), ("item_words", pa.int32()), ("word", pa.int64())])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for index in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                found = {f.name: [] for f in schema}
                for doc_id, items in zip(batch.column(0).to_pylist(), index.scan(batch.column(1).to_pylist()), strict=True):
                    for i, (distance, word) in items.items():
                        for name, x in zip(found, (doc_id, index.items[i][0], distance, len(index.items[i][1]), word), strict=True):
                            found[name].append(x)
                yield arrow_batch(schema, found)

        part = rows.mapInArrow(run, "doc_id long, item_id long, distance int, item_words int, word long")
        out = part if out is None else out.union(part)
    return out


def _clean(shared: Broadcast):
    """A function that tells which texts contain no item of a broadcast index."""

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([not items for items in shared.value.scan(list(texts))], dtype=bool)

    return clean


def without_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text contains no item, with all their columns."""
    for index in blocks(benchmark):
        docs = docs.filter(_clean(docs.sparkSession.sparkContext.broadcast(index))("text"))
    return docs
