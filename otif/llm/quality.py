"""Quality rules as a short-circuit cascade.

The base counts are taken of every text. Texts that pass the base limits go through
the rules in turn; a rule looks only at texts that all earlier rules let pass. The
order is by rejections per second, both estimated on a sample of about
``SAMPLE_ROWS`` rows (a documented bound): it changes the cost, never the verdict.

Defined cases: a null or empty text has no words and fails the base; repeated rows are
judged alike; an empty table gives an empty result; columns other than doc_id and text
are not read.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from otif.llm.common import SPACE, arrow_batch, mix64, scan_words
from otif.llm.tokens import groups

MIN_WORDS = 50
SAMPLE_ROWS = 2000
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Group:
    """Some texts and their counts; the rules read both."""

    texts: Sequence[str]
    counts: dict[str, np.ndarray]
    words: np.ndarray
    begins: np.ndarray


def repeats(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the keys that occur twice or more under their owner, and of those that are not the first."""
    order = np.lexsort((keys, owners))
    same = (keys[order][1:] == keys[order][:-1]) & (owners[order][1:] == owners[order][:-1])
    more, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    more[order[1:][same]] = more[order[:-1][same]] = True
    return more, later


def count(texts: Sequence[str]) -> Group:
    """Base counts of some texts."""
    w = scan_words(texts, SPACE, folded=False)

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[w.texts[1:]] - total[w.texts[:-1]]

    inside = ~np.isin(w.data, np.frombuffer(SPACE, np.uint8))
    counts = {"n_words": np.diff(w.begins), "word_chars": per_text(inside & ((w.data & 0xC0) != 0x80)),
              "n_symbols": per_text(np.isin(w.data, np.frombuffer(SYMBOLS, np.uint8)))}
    lines = scan_words(texts, b"\n", folded=False)
    filled = np.concatenate([[0], np.cumsum(inside)])
    kept = filled[lines.ends] > filled[lines.starts]
    owner = np.repeat(np.arange(len(texts)), np.diff(lines.begins))
    _, later = repeats(lines.hashes[kept], owner[kept])
    counts["n_dup_lines"] = np.bincount(owner[kept], later, minlength=len(texts)).astype(np.int64)
    counts["n_lines"] = np.bincount(owner[kept], minlength=len(texts))
    owner = np.repeat(np.arange(len(texts)), counts["n_words"])
    covered = np.zeros(len(owner), bool)
    if len(owner) > 2:
        h = w.hashes
        runs = mix64(mix64(mix64(h[:-2] + GOLDEN) + h[1:-1]) + h[2:])
        whole = owner[:-2] == owner[2:]
        more, _ = repeats(runs[whole], owner[:-2][whole])
        at = np.flatnonzero(whole)[more]
        for i in range(3):
            covered[at + i] = True
    counts["n_repeat_words"] = np.bincount(owner, covered, minlength=len(texts)).astype(np.int64)
    return Group(texts, counts, w.hashes, w.begins)


def base_failed(g: Group) -> np.ndarray:
    return (g.counts["n_words"] < MIN_WORDS) | (100 * g.counts["n_repeat_words"] > 50 * g.counts["n_words"])


def _each(g: Group, at: np.ndarray, value: Callable[[str], int]) -> np.ndarray:
    return np.fromiter((value(g.texts[i]) for i in at), np.int64, len(at))


def _upper(text: str) -> int:
    """Letters A-Z."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    return int(((data >= 65) & (data <= 90)).sum())


#: name -> which of the texts at these places it rejects.
RULES: dict[str, Callable[[Group, np.ndarray], np.ndarray]] = {
    "symbols": lambda g, at: 10 * g.counts["n_symbols"][at] > g.counts["n_words"][at],
    "word_length": lambda g, at: (g.counts["word_chars"][at] < 2 * g.counts["n_words"][at]) | (g.counts["word_chars"][at] > 20 * g.counts["n_words"][at]),
    "duplicate_lines": lambda g, at: 2 * g.counts["n_dup_lines"][at] > g.counts["n_lines"][at],
    "shouting": lambda g, at: 10 * _each(g, at, lambda t: t.count("!")) > g.counts["n_words"][at],
    "capitals": lambda g, at: 10 * _each(g, at, _upper) > 3 * g.counts["word_chars"][at],
    "variety": lambda g, at: 10 * np.array([len(np.unique(g.words[g.begins[i] : g.begins[i + 1]])) for i in at], np.int64) < g.counts["n_words"][at],
}


def passed(g: Group, order: Sequence[str]) -> np.ndarray:
    """Which texts pass the base and, in this order, all rules."""
    at = np.flatnonzero(~base_failed(g))
    for name in order:
        at = at[~RULES[name](g, at)]
    out = np.zeros(len(g.texts), bool)
    out[at] = True
    return out


def rule_order(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rules by rejections per second on a sample, the most first."""
    n = docs.count()
    schema = pa.schema([("rule", pa.string()), ("seconds", pa.float64()), ("rejected", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for part in groups(texts):
                g = count(texts[part])
                at = np.flatnonzero(~base_failed(g))
                for name, rule in RULES.items():
                    began = time.perf_counter()
                    rejected = int(rule(g, at).sum())
                    yield arrow_batch(schema, {"rule": [name], "seconds": [time.perf_counter() - began], "rejected": [rejected]})

    sample = docs.select("text").sample(min(1.0, sample_rows / max(n, 1)), seed=7)
    seen = sample.mapInArrow(run, "rule string, seconds double, rejected long").groupBy("rule").agg(F.sum("seconds").alias("s"), F.sum("rejected").alias("r"))
    rate = {r["rule"]: r["r"] / max(r["s"], 1e-9) for r in seen.collect()}  # a row per rule
    return sorted(RULES, key=lambda name: (-rate.get(name, 0.0), name))


def judge(docs: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Per row: doc_id, the base counts, base_failed and kept."""
    order = order or rule_order(docs)
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("base_failed", pa.bool_()), ("kept", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for part in groups(texts):
                g = count(texts[part])
                yield arrow_batch(schema, {"doc_id": batch.column(0).slice(part.start, part.stop - part.start), **{c: g.counts[c] for c in COUNTS},
                                           "base_failed": base_failed(g), "kept": passed(g, order)})

    ddl = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ddl)


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, string_split(text, chr(10)) AS lines FROM d),
l AS (SELECT *, list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS full_lines,
        list_transform(range(1, len(words) - 1), lambda i: words[i:i + 2]) AS runs FROM w),
t AS (SELECT *, list_sort(runs) AS sorted FROM l),
r AS (SELECT *, list_filter(range(1, len(sorted)), lambda i: sorted[i] = sorted[i + 1]) AS pairs FROM t),
s AS (SELECT *, list_distinct(list_transform(pairs, lambda i: sorted[i])) AS often FROM r),
m AS (SELECT *, list_filter(range(1, len(runs) + 1), lambda i: list_contains(often, runs[i])) AS places FROM s),
c AS (SELECT doc_id, text, len(words) AS n_words, len(list_distinct(words)) AS n_distinct, len(full_lines) AS n_lines,
        coalesce(list_sum(list_transform(words, lambda x: len(x))), 0)::BIGINT AS word_chars,
        len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(full_lines) - len(list_distinct(full_lines)) AS n_dup_lines,
        len(list_distinct(list_concat(places, list_concat(list_transform(places, lambda i: i + 1), list_transform(places, lambda i: i + 2))))) AS n_repeat_words
      FROM m),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND NOT (10 * n_symbols > n_words) AND NOT (word_chars < 2 * n_words OR word_chars > 20 * n_words)
  AND NOT (2 * n_dup_lines > n_lines) AND NOT (10 * (len(text) - len(replace(text, '!', ''))) > n_words)
  AND NOT (10 * (len(text) - len(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * word_chars)
  AND NOT (10 * n_distinct < n_words) AS kept
FROM b
"""
