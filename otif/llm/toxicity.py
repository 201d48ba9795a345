"""Toxicity by noisy-channel deobfuscation and a linear model on the restored words.

A character language model (trigrams within words) is counted over all documents. A
word that looks disguised - digits or signs between letters, a letter three times in a row,
letters spaced out or dotted - becomes a lattice: each character may stand for itself
or for a letter it imitates, and repetitions may collapse. Viterbi decoding
picks the path with the best product of language model and channel. The restored
words and their beginnings (``PREFIXES``) are the features.

Labels are read from a bounded sample (``TRAIN_ROWS`` labelled rows in hash order);
features that stand out among toxic rows (``MIN_Z``) enter a logistic
regression, fitted on that sample. Scores use the text alone.

Defined cases: a null text scores as an empty one; an empty text scores the model's
bias; without labels of both kinds every score is 0; repeated rows score alike; null
labels and null doc_ids of labels are not learned from; of contradictory labels of an id the toxic one counts; a null doc_id is not
held out; an empty table gives an empty result; other
columns are not read (``without_toxic`` passes all on).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from otif.llm.common import arrow_batch, parts, release_memory, small_batches, tidy

TRAIN_ROWS = 12_000
MAX_FEATURES = 600
MIN_Z = 5.0
MIN_TOXIC = 3
PREFIXES = (4, 5)  # ascending
REJECT = 0.7
MEMO = 60_000  # words remembered by a task
PART_BYTES = 1 << 18  # of the texts that a worker holds as strings and arrays

#: What a sign may stand for, and its channel cost (fixed values).
IMITATES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "b", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i",
            "|": "il", "+": "t", "(": "c", "*": "aeiou", "#": "aeiou", "€": "e", "£": "l", "¡": "i"}
SIGN_COST, DROP_COST, KEEP_COST = 2.0, 1.0, 6.0

SYMBOLS = 28  # 0: edge of a word, 1-26: a-z, 27: any other letter
_CODES = np.zeros(256, np.int32)
_CODES[97:123] = _CODES[65:91] = np.arange(1, 27)
_CODES[192:] = 27  # a letter beyond ASCII counts once, by its first byte

_EDGES = "\"'`.,;:?)]}>…»“”„‘’"
_TRAIL = _EDGES + "!*$%&#|+(-_<"
_LEAD = "\"'`.,;:?([{<«“”„‘’-_%&"
_DOTTED = re.compile(r"\w(?:[.\-_*·]\w){3,}\Z")
_PERHAPS_SPACED = re.compile(r" \S \S ")
_SPACED = re.compile(r"(?<!\S)\S(?: \S){3,}(?!\S)")
_ODD = re.compile(r"[^\W\d_][013456789@$!|+(*#€£¡]+|[013456789@$!|+(*#€£¡]+[^\W\d_]|([^\W\d_])\1\1", re.IGNORECASE)


def count_trigrams(docs: DataFrame) -> np.ndarray:
    """Trigram counts over the words of all documents; the table has SYMBOLS ** 3 cells."""
    schema = pa.schema([("cell", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for part in parts(batch, 0, PART_BYTES):
                texts = [t or "" for t in part.column(0).to_pylist()]
                data = np.frombuffer(" ".join(["", *texts, ""]).encode("utf-8", "surrogatepass"), np.uint8)
                data = data[(data & 0xC0) != 0x80]
                codes = _CODES[data]
                first = (codes == 0) & np.concatenate([[True], codes[:-1] != 0])
                seq = np.repeat(codes, np.where(codes > 0, 1, 2 * first))  # two edges between words
                total += np.bincount((seq[:-2] * SYMBOLS + seq[1:-1]) * SYMBOLS + seq[2:], minlength=SYMBOLS**3)
        at = np.flatnonzero(total)
        yield arrow_batch(schema, {"cell": at, "n": total[at]})

    cells = docs.select("text").mapInArrow(tidy(run), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    with small_batches(docs.sparkSession):
        counted = cells.collect()  # at most SYMBOLS ** 3 rows
    out = np.zeros(SYMBOLS**3, np.int64)
    for cell, n in counted:
        out[cell] = n
    return out


def log_costs(counts: np.ndarray) -> np.ndarray:
    """-log P(c | a, b), smoothed, as a cube."""
    cube = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS) + 0.1
    return -np.log(cube / cube.sum(axis=2, keepdims=True))


def _code(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27


def restore(token: str, lm: np.ndarray) -> str:
    """Viterbi decoding of a disguised word."""
    states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    last = ""
    for c in token.lower():
        options = [(x, SIGN_COST) for x in IMITATES.get(c, "")]
        options.append((c, 0.0) if c.isalpha() else (c, KEEP_COST))
        following: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, text) in states.items():
            for letter, extra in options:
                moves = [((b, _code(letter)), cost + extra + lm[a, b, _code(letter)], text + letter)]
                if text and letter == text[-1]:
                    moves.append(((a, b), cost + extra * 0.5 + (DROP_COST if c == last else 2 * DROP_COST), text))
                for state, total, word in moves:
                    if state not in following or (total, word) < following[state]:
                        following[state] = total, word
        states, last = following, c
    return min((cost + lm[a, b, 0], text) for (a, b), (cost, text) in states.items())[1]


def plain(token: str, lm: np.ndarray) -> str:
    """A word without marks at its edges, restored if it looks disguised."""
    word = token.strip(_EDGES)
    if _DOTTED.match(word):
        word = re.sub(r"[.\-_*·]", "", word)
    if not _ODD.search(word):
        return word.rstrip(_TRAIL).lstrip(_LEAD).lower()
    word = word.lstrip(_LEAD).rstrip(_TRAIL)
    return restore(word, lm) if _ODD.search(word) else word.lower()


def features_of(word: str) -> tuple[str, ...]:
    return (word, *(f"{word[:n]}-" for n in PREFIXES if len(word) >= n)) if len(word) > 2 else ()


def tokens_of(text: str) -> set[str]:
    """Distinct tokens of a text in lower case, without marks at their edges; letters that are spaced out are joined to one token more."""
    text = text.lower()
    out = {token.strip(_EDGES) for token in text.split()}
    if _PERHAPS_SPACED.search(text):
        out.update(m.group().replace(" ", "").strip(_EDGES) for m in _SPACED.finditer(text))
    return out


def triples(text: str) -> set[str]:
    """Letters that come three times in a row."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.flatnonzero((points[2:] == points[1:-1]) & (points[2:] == points[:-2]) & (points[2:] > 64))
    return {text[i : i + 3] for i in at.tolist() if text[i].isalnum()}


@dataclass
class Model:
    """Picklable; of bounded size."""

    lm: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    trained: bool = False
    memo: dict[str, tuple[str, ...]] = field(default_factory=dict)  # tokens with more than letters

    def __post_init__(self) -> None:
        self.starts = {f[: PREFIXES[0]] for f in self.weights}

    def _features(self, text: str) -> set[str]:
        seen: set[str] = set()
        text = text.lower()
        words = tokens_of(text)
        # ``plain`` leaves words of letters alone unless one comes three times in a row; most of them begin like no feature.
        odd = {w for t in triples(text) for w in words if t in w}
        for word in odd.union(w for w in words if w[: PREFIXES[0]] in self.starts or not w.isalpha()):
            if (found := self.memo.get(word)) is None:
                if len(self.memo) > MEMO:
                    self.memo.clear()
                found = self.memo[word] = tuple(f for f in features_of(plain(word, self.lm)) if f in self.weights)
            seen.update(found)
        return seen

    def score(self, text: str | None) -> float:
        if not self.trained:
            return 0.0
        seen = self._features(text or "")
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + sum(self.weights[f] for f in sorted(seen))))))

    def scores(self, arrays: Iterator[pa.Array]) -> Iterator[np.ndarray]:
        """Scores of a task's texts; what was remembered is dropped at the task's end."""
        try:
            for texts in arrays:
                yield np.fromiter((self.score(t.as_py()) for t in texts), float, len(texts))
        finally:
            self.memo.clear()
            release_memory()


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Language model over all ``docs``; weights from ``train_rows`` labelled rows that are not held out."""
    lm = log_costs(count_trigrams(docs))
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    usable = usable.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    shared = docs.sparkSession.sparkContext.broadcast(lm)
    schema = pa.schema([("row", pa.binary()), ("toxic", pa.int32()), ("feature", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, tuple[str, ...]] = {}
        for part in (p for batch in batches for p in parts(batch, 2, PART_BYTES)):
            for row, toxic, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                seen = set()
                for token in tokens_of(text):
                    if token not in memo:
                        memo[token] = features_of(plain(token, shared.value))
                    seen.update(memo[token])
                if len(memo) > MEMO:
                    memo.clear()
                yield arrow_batch(schema, {"row": [row] * (len(seen) + 1), "toxic": [toxic] * (len(seen) + 1), "feature": ["", *seen]})

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("text is not null").join(F.broadcast(sample), "doc_id")  # bounded by train_rows
    texts = texts.select(F.unhex(F.md5("text")).alias("row"), "toxic", "text").groupBy("row").agg(F.max("toxic").alias("toxic"), F.first("text").alias("text"))
    rows = texts.mapInArrow(tidy(run), "row binary, toxic int, feature string").persist()
    try:
        counts = rows.groupBy("feature").agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).filter((F.col("t") >= MIN_TOXIC) | (F.col("feature") == ""))
        total = {r["feature"]: (r["t"], r["n"]) for r in counts.filter("feature = ''").collect()}
        if not total or not 0 < total[""][0] < total[""][1]:
            return Model(lm)
        t, n = total[""]
        share, rest = F.col("t") / t, (F.col("n") - F.col("t")) / (n - t)
        both = F.col("n") / n
        z = (share - rest) / F.sqrt(both * (1 - both + 1e-9) * (1 / t + 1 / (n - t)))
        best = [r["feature"] for r in counts.filter("feature != ''").withColumn("z", z).filter(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "feature").limit(MAX_FEATURES).collect()]
        place = {f: i for i, f in enumerate(best)}
        kept = rows.filter(F.col("feature").isin(*best, "")).groupBy("row").agg(F.first("toxic").alias("toxic"), F.collect_list("feature").alias("features")).orderBy("row").collect()  # train_rows at most
    finally:
        rows.unpersist()
        shared.destroy()
    x, y = np.zeros((len(kept), len(best) + 1)), np.array([r["toxic"] for r in kept], float)
    x[:, -1] = 1
    for i, r in enumerate(kept):
        x[i, [place[f] for f in r["features"] if f]] = 1
    w = logistic(x, y)
    return Model(lm, dict(zip(best, w[:-1].tolist(), strict=True)), float(w[-1]), True)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, steps: int = 15) -> np.ndarray:
    """Newton's method for ridge logistic regression; the last column is the unpenalised bias."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + np.diag(penalty)
        step = np.linalg.solve(hessian, x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for scores in shared.value.scores(texts):
            yield pa.array(scores)

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= REJECT, 1).otherwise(0))


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that score below ``REJECT``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def clean(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for scores in shared.value.scores(texts):
            yield pa.array(scores < REJECT)

    return docs.filter(clean("text"))
