"""Secret scan: fixed patterns, and guess cost of values that stand in a credential context.

The patterns find assignments, access keys and long hex runs. Besides, the value in
a credential context (``CONTEXT``) is scored as a password: dynamic programming
finds its cheapest segmentation into words, dates, repeats, keyboard walks and
brute-force spans, costs being log10 of the guesses each needs. A word costs its rank
in a lexicon: ``WORDS``, then the most frequent words (``LEXICON`` at most) of all documents, counted
outside the values of credential contexts and patterns; a run of letters that is no such word is
guessed letter by letter. Values of at least ``MIN_GUESSES`` that overlap no pattern become
spans of kind ``value``.

Spans are code points, end exclusive. Defined cases: a null text is empty; an empty
text has no spans; repeated rows are scanned alike; an empty table gives an empty
result; columns other than doc_id and text are not read (``redacted`` passes all on).
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from otif.llm.common import Staging, arrow_batch

KINDS = ("assign", "access", "hex", "value")
MIN_GUESSES = 10.0  # log10
MASK = "[SECRET]"

# Fixed patterns of the base spans.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

CONTEXT = re.compile(
    r"""(?<![A-Za-z0-9])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|auth|bearer|pin|(?:api|access|private|signing)[_ -]?key)["']?"""
    r"""(?:\x20*(?:[:=]|=>)\x20*|\x20is\x20)["']?([^\s"'<>,;]{6,})""", re.IGNORECASE | re.ASCII)
HINTS = ("pass", "pwd", "secret", "token", "credential", "auth", "bearer", "pin", "key")

#: Common words of passwords and of credential lines, the most common first.
WORDS = (
    "password pass admin user login welcome letmein master hello secret dragon monkey shadow sunshine princess football "
    "baseball superman batman iloveyou love qwerty abc test guest root default changeme access key token private public "
    "example sample please none null true false your my the and for with from this that here enter value string "
    "account system server client service database data home work summer winter spring autumn monday friday january "
    "march april june july august october december green blue red black white orange silver gold star magic freedom "
    "family friend angel baby happy money power king queen tiger eagle lion bear wolf horse flower cookie coffee cheese "
    "pepper ginger london paris berlin madrid america england forever always nothing something environment variable "
    "required optional expired invalid missing hidden placeholder redacted removed"
).split()
RANK = {w: i + 1 for i, w in enumerate(dict.fromkeys(WORDS))}
LEXICON = 50_000  # words taken from the documents at most
LONGEST = 20  # letters of a word of the lexicon
FLUSH = 200_000  # words that a task counts before it passes them on
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
LEET = str.maketrans("0134578@$!", "oieastbasi")
DATE = re.compile(r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d|(?:19|20)\d\d")
WORD = re.compile(rf"(?<![a-z])[a-z]{{3,{LONGEST}}}(?![a-z])")


def _neighbours() -> dict[str, set[str]]:
    near: dict[str, set[str]] = {}
    for r, row in enumerate(KEY_ROWS):
        for i, c in enumerate(row):
            beside = {row[j] for j in (i - 1, i + 1) if 0 <= j < len(row)}
            for other in (r - 1, r + 1):
                if 0 <= other < len(KEY_ROWS):
                    beside |= set(KEY_ROWS[other][max(0, i - 1) : i + 2])
            near[c] = beside
    return near


NEAR = _neighbours()


def _brute(c: str) -> float:
    return math.log10(10 if c.isdigit() else 26 if c.isalpha() else 33)


def segments(value: str, ranks: dict[str, int] = RANK) -> Iterator[tuple[int, int, float]]:
    """(start, end, log10 guesses) of the patterned stretches of a value."""
    low = value.lower()
    plain = low.translate(LEET)
    for i in range(len(value)):
        for j in range(i + 2, min(len(value), i + LONGEST) + 1):
            rank = ranks.get(low[i:j]) or (ranks.get(plain[i:j], 0) * 4 if not low[i:j].isdigit() else 0)
            if rank:
                yield i, j, math.log10(rank * (1 if low[i:j] == value[i:j] else 3) + 1)
        if m := DATE.match(value, i):
            yield i, m.end(), math.log10(200 if m.end() - i == 4 else 40_000)
    i = 0
    while i < len(value):  # runs of one character
        j = i
        while j < len(value) and value[j] == value[i]:
            j += 1
        if j - i >= 3:
            yield i, j, math.log10(95 * (j - i))
        i = j
    for size in (2, 3, 4):  # blocks that repeat
        i = 0
        while i + 2 * size <= len(value):
            block, j = value[i : i + size], i + size
            while value.startswith(block, j):
                j += size
            if j - i >= 2 * size and len(set(block)) > 1:
                yield i, j, sum(map(_brute, block)) + math.log10((j - i) // size)
                i = j - size
            i += 1
    for step in ("walk", 1, -1):  # keyboard walks; alphabetic and numeric runs up and down
        i = 0
        while i < len(low) - 1:
            j = i + 1
            while j < len(low) and (low[j] in NEAR.get(low[j - 1], ()) if step == "walk" else ord(low[j]) - ord(low[j - 1]) == step and low[j].isalnum()):
                j += 1
            if j - i >= 4 or (step != "walk" and j - i >= 3):
                yield i, j, math.log10(47 * (j - i)) + (0.5 * (j - i) if step == "walk" else 0)
            i = j


def guess_cost(value: str, ranks: dict[str, int] = RANK) -> float:
    """log10 of the guesses of the cheapest segmentation; ``ranks`` gives the words their places in the lexicon."""
    best = [0.0] * (len(value) + 1)
    ending: dict[int, list[tuple[int, float]]] = {}
    for i, j, cost in segments(value, ranks):
        ending.setdefault(j, []).append((i, cost))
    for j in range(1, len(value) + 1):
        best[j] = min([best[j - 1] + _brute(value[j - 1]), *(best[i] + cost for i, cost in ending.get(j, ()))])
    return best[-1]


def scan(text: str, ranks: dict[str, int] = RANK) -> list[tuple[int, int, int, int]]:
    """(start, number of the kind, end, start of the secret itself), in order."""
    low = text.lower()
    found = []
    if any(h in low for h in HINTS):
        found += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    if any(h in low for h in HINTS):
        base = sorted((a, b) for a, _, b, _ in found)
        begins, reach = [a for a, _ in base], list(accumulate((b for _, b in base), max, initial=0))
        for m in CONTEXT.finditer(text):
            value = m[1].rstrip(".!?:)")
            a, b = m.start(1), m.start(1) + len(value)
            if len(value) >= 6 and reach[bisect_left(begins, b)] <= a and guess_cost(value, ranks) >= MIN_GUESSES:
                found.append((a, 3, b, a))
    return sorted(found)


def prose(text: str) -> str:
    """The text in lower case, the values of patterns and credential contexts left out."""
    low = text.lower()
    text = HEX.sub(" ", ACCESS.sub(" ", text))
    if any(h in low for h in HINTS):
        for pattern, value in ((ASSIGN, 2), (CONTEXT, 1)):
            text = pattern.sub(lambda m, value=value: m[0][: m.start(value) - m.start()] + " ", text)
    return text.lower()


def lexicon(docs: DataFrame, size: int = LEXICON) -> dict[str, int]:
    """Ranks of the words: ``WORDS``, then the most frequent words of all documents (ties by the word).

    Words are taken by whole classes of frequency, an eighth of a power of two each, as
    long as there are ``size`` words at most; so no more than these reach the driver.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(WORD.findall(prose(text)))
                if len(counts) > FLUSH:
                    yield arrow_batch(schema, {"word": list(counts), "n": list(counts.values())})
                    counts.clear()
        yield arrow_batch(schema, {"word": list(counts), "n": list(counts.values())})

    counted = docs.filter("text is not null").select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    staging = Staging(docs.sparkSession, "lexicon")
    counted = staging.put(counted.withColumn("class", F.floor(F.log2("n") * 8).cast("int")), "counted")
    words, least = 0, 8 * 64
    for frequency, n in sorted(map(tuple, counted.groupBy("class").count().collect()), reverse=True):  # 8 * 64 rows at most
        if (words := words + n) > size:
            break
        least = frequency
    found = sorted((-r["n"], r["word"]) for r in counted.filter(F.col("class") >= least).select("word", "n").collect())
    staging.drop("counted")
    return {w: i for i, w in enumerate(dict.fromkeys([*WORDS, *(word for _, word in found)]), 1)}


def spans_text(found: list[tuple[int, int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b, _ in found)


def find_secrets(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_value."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
                        ("base_sha256", pa.string()), ("spans", pa.string()), ("n_value", pa.int64())])

    known = docs.sparkSession.sparkContext.broadcast(lexicon(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {f.name: [] for f in schema}
            for text in batch.column(1).to_pylist():
                found = scan(text or "", known.value)
                kinds = [kind for _, kind, _, _ in found]
                for k, name in enumerate(("n_assign", "n_access", "n_hex", "n_value")):
                    out[name].append(kinds.count(k))
                base = spans_text([x for x in found if x[1] < 3])
                out["base_sha256"].append(hashlib.sha256(base.encode()).hexdigest())
                out["spans"].append(spans_text(found))
            yield arrow_batch(schema, {**out, "doc_id": batch.column(0)})

    ddl = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_value long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ddl)


def mask(text: str | None, ranks: dict[str, int] = RANK) -> str | None:
    """The text with each secret replaced; keywords stay."""
    if text is None:
        return None
    out, at = [], 0
    for _, _, end, secret in sorted(scan(text, ranks), key=lambda x: (x[3], -x[2])):
        if end > at:
            if secret >= at:
                out += [text[at:secret], MASK]
            at = end
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with the secrets in their texts masked; n_chars, where it is a column, follows the text."""

    known = docs.sparkSession.sparkContext.broadcast(lexicon(docs))

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        return pd.Series([mask(t, known.value) for t in texts], dtype=object)

    out = docs.withColumn("text", masked("text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull() & F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
