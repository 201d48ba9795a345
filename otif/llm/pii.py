"""Personal data: fixed patterns, and a semi-Markov conditional random field for what they miss.

The patterns find e-mail and IP addresses, card and phone numbers. Between their spans,
a semi-Markov model segments the text: each candidate segment of up to ``MAX_TOKENS``
tokens is scored as a whole (digit groups, separators, checksum, octet ranges, at and dot
marks, what stands on both sides, cue words before it), every other token is a
segment of its own with score 0, and dynamic programming over segments of bounded length
chooses boundaries and types together. It finds written-out addresses
(``name [at] host dot org``), defanged IP addresses, and numbers grouped in other ways.

Nobody labels such spans, so the model learns from the patterns: ``SAMPLE_ROWS`` rows, first in
hash order, give at most ``REGIONS`` stretches around found spans, which ``rewrites`` turns into
other spellings of the same data and into look-alikes that are none (a wrong check digit, an
octet above 255, dates, plain ids). The weights maximise the conditional likelihood of
these segmentations. A sample without any span gives a model that adds nothing.

A segment must hold an address mark or at least four digits, so only the surroundings of such
marks (``regions``) can hold one; elsewhere the best segmentation is known and not computed.

Spans are code points, end exclusive. Defined cases: a null text is empty; an empty text has no
spans; repeated rows are scanned alike; an added span never overlaps a pattern's; of equally
good segmentations the one with the shorter last segment, then the first type, is taken; an empty table gives an empty result;
columns other than doc_id and text are not read (``redacted`` passes all on).
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from otif.llm.common import arrow_batch

KINDS = ("email", "ip", "card", "phone")
SAMPLE_ROWS, REGIONS = 20_000, 600
MAX_TOKENS, MAX_CHARS = 24, 96  # of an entity
WIDTH = 56  # tokens of a training stretch at most
STEPS, RATE, RIDGE, MIN_SEEN = 60, 0.3, 0.02, 3

Span = tuple[int, int, int]  # start, number of the kind, end

# Fixed patterns of the base spans. Each begins where no match of its kind could begin earlier in the same run.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

TOKEN = re.compile(r"[^\W_]+|[\W_]")
OPEN, CLOSE = "[({", "])}"
#: Where an entity may lie: an address mark, four numbers joined by marked dots, or seven digits that at most three signs part.
TRIGGER = re.compile(
    r"""@|[\[({]\x20?at\x20?[\])}]|\x20at\x20(?=[A-Za-z0-9-]{1,64}(?:\x20dot\x20|[\[({]))"""
    r"""|(?<![0-9])(?:[0-9]{1,4}(?:\x20?[\[({]?\.[\])}]?\x20?|\x20?[\[({]?dot[\])}]?\x20?)){3}[0-9]{1,4}|(?<![^\W_])[0-9](?:[\x20().:/_+\[\]-]{0,3}+[0-9]){6,}+""",
    re.IGNORECASE)
NUMBER_SIGNS = frozenset(" ().-/[]_{}")
CUES = {"phone": "phone tel telephone call mobile fax cell", "email": "mail email contact write e", "ip": "ip host server address addr",
        "card": "card visa mastercard amex credit payment", "other": "order invoice id isbn ref no nr number serial version date"}
CUE_OF = {w: cue for cue, words in CUES.items() for w in words.split()}


def luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def octet(part: str) -> bool:
    return len(part := part.lstrip("0")) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, in order."""
    found: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            found.append((start, 0, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if DIGIT.search(text):
        found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(map(octet, m.group().split(".")))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(digits := m.group().replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(DIGIT.findall(m.group())) <= 15]
    return sorted(found)


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


# ---- segments


@dataclass
class Stretch:
    """Tokens of text[start:end] and the text on both sides."""

    text: str
    start: int
    end: int
    tokens: list[str] = field(init=False)
    at: list[int] = field(init=False)

    def __post_init__(self) -> None:
        found = list(TOKEN.finditer(self.text, self.start, self.end))
        self.tokens = [m.group() for m in found]
        self.at = [*(m.start() for m in found), self.end]
        self.low = [t.lower() for t in self.tokens]

    def marked(self, k: int, word: str, sign: str) -> str:
        """How token ``k`` writes an at or dot mark: the sign, in brackets, as a word between spaces, or not ('')."""
        if self.low[k] not in (word, sign):
            return ""
        before, after = self.tokens[k - 1] if k else " ", self.tokens[k + 1] if k + 1 < len(self.tokens) else " "
        if before in OPEN and after in CLOSE:
            return "bracket"
        return "sign" if self.low[k] == sign else "word" if before == after == " " else ""

    def candidates(self) -> Iterator[tuple[int, int, tuple[int, ...]]]:
        """(first token, end token, possible kinds) of every segment that may be an entity."""
        n, tokens, low = len(self.tokens), self.tokens, self.low
        ats, dots = [self.marked(k, "at", "@") for k in range(n)], [self.marked(k, "dot", ".") for k in range(n)]
        marks = [bool(a or d) for a, d in zip(ats, dots, strict=True)]
        bracket = [t in "[](){}" and any(marks[max(0, k - 2) : k + 3]) for k, t in enumerate(tokens)]
        near = [b or t == " " and any(marks[i] or bracket[i] for i in (k - 1, k + 1) if 0 <= i < n) for k, (t, b) in enumerate(zip(tokens, bracket, strict=True))]
        number = [t.isascii() and t.isdigit() or t in NUMBER_SIGNS or bool(dots[k]) for k, t in enumerate(tokens)]
        for i in range(n):
            if not (tokens[i][0].isalnum() or tokens[i] in "+("):
                continue
            at = after = -1
            digits, numeric, address = 0, True, True
            for j in range(i, min(n, i + MAX_TOKENS)):
                t = tokens[j]
                if self.at[j + 1] - self.at[i] > MAX_CHARS or t in "\n\r":
                    break
                numeric &= number[j] or j == i and t == "+"
                digits += len(t) if t.isascii() and t.isdigit() else 0
                if ats[j]:
                    address &= at < 0
                    at = j
                elif dots[j] and at >= 0:
                    after = j
                address &= t[0].isalnum() or bool(ats[j] or dots[j]) or t in "-_%+" or near[j]
                if not (numeric or address):
                    break
                if not t[0].isalnum() or j == i and not digits:
                    continue
                if address and i < at < after < j and not (ats[j] or dots[j]) and low[i] not in ("at", "dot") and tokens[i] != "(":
                    yield i, j + 1, (0,)
                elif numeric and not dots[j] and (kinds := tuple(k for k, lo, hi in ((1, 4, 12), (2, 12, 19), (3, 7, 15)) if lo <= digits <= hi)):
                    yield i, j + 1, kinds

    def features(self, i: int, j: int) -> list[str]:
        """Features of the segment of tokens i to j - 1, as a whole."""
        tokens, a, b = self.tokens[i:j], self.at[i], self.at[j]
        runs = [t for t in tokens if t.isascii() and t.isdigit()]
        digits = "".join(runs)
        signs = "".join(sorted({t for t in tokens if not t[0].isalnum()}))
        ats = [m for k in range(i, j) if (m := self.marked(k, "at", "@"))]
        dots = Counter(m for k in range(i, j) if (m := self.marked(k, "dot", ".")))
        shape = "-".join(str(len(r)) for r in runs[:6]) + "+" * (len(runs) > 6)
        out = ["bias", f"signs {signs}", f"before {self._side(a - 1)}", f"after {self._side(b)}", f"more before {self._joined(i, -1)}", f"more after {self._joined(j - 1, 1)}"]
        if ats:
            last = tokens[-1]
            out += [f"at {ats[0]}", f"ends in letters {last.isalpha() and 2 <= len(last) <= 10}", *(f"dots {m}" for m in dots), f"dot marks {min(4, dots.total())}"]
        else:
            fine = len(runs) == 4 and dots.total() == 3
            out += [f"groups {shape}", f"digits {len(digits)}", f"plus {tokens[0] == '+'}", f"check {len(digits) >= 12 and luhn(digits)}",
                    f"octets {fine and all(map(octet, runs))}", f"dots {dots.total()}", f"shape {len(runs)} {signs}", f"first {digits[:1]} {len(digits)}"]
            if len(digits) >= 12:
                out.append(f"check {luhn(digits)} {len(digits)}")
            if fine:
                out.append(f"four {all(map(octet, runs))} {max(map(len, runs)) <= 3}")
        words = [w.lower() for w in re.findall(r"[^\W\d_]+", self.text[max(0, a - 24) : a])[-2:]]
        return out + [f"cue {CUE_OF[w]}" for w in words if w in CUE_OF]

    def _side(self, at: int) -> str:
        c = self.text[at] if 0 <= at < len(self.text) else " "
        return "space" if c.isspace() else "word" if c.isalnum() else c if c in "@.-+_/()[]" else "sign"

    def _joined(self, k: int, step: int) -> bool:
        """Whether digits go on beyond token ``k`` after at most three signs."""
        k += step
        for _ in range(3):
            if 0 <= k < len(self.tokens) and self.tokens[k] in NUMBER_SIGNS:
                k += step
        return 0 <= k < len(self.tokens) and self.tokens[k].isascii() and self.tokens[k].isdigit()


@dataclass
class Model:
    """Weights by feature, a number per kind; no weights, no spans."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def decode(self, stretch: Stretch) -> list[Span]:
        """The best segmentation's entities: Viterbi over segments of bounded length."""
        ending: dict[int, list[tuple[int, int, float]]] = {}
        for i, j, kinds in stretch.candidates():
            score = sum((w for f in stretch.features(i, j) if (w := self.weights.get(f)) is not None), np.zeros(len(KINDS)))
            ending.setdefault(j, []).extend((i, k, float(score[k])) for k in kinds)
        best, back = [0.0], [(0, -1)]
        for j in range(1, len(stretch.tokens) + 1):
            top, came = best[j - 1], (j - 1, -1)
            for i, k, score in sorted(ending.get(j, ()), key=lambda x: (-x[0], x[1])):
                if best[i] + score > top + 1e-9:
                    top, came = best[i] + score, (i, k)
            best.append(top)
            back.append(came)
        found, j = [], len(stretch.tokens)
        while j:
            i, k = back[j]
            if k >= 0:
                found.append((stretch.at[i], k, stretch.at[j - 1] + len(stretch.tokens[j - 1])))
            j = i
        return found[::-1]

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Entities between the base spans."""
        if not self.weights:
            return []
        return [s for a, b in regions(text, base) for s in self.decode(Stretch(text, a, b))]


def regions(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Disjoint stretches, free of base spans and line ends, that hold every possible entity."""
    if "@" not in text and not DIGIT.search(text) and not re.search(r"\bat\b", text, re.IGNORECASE):
        return []
    taken: list[list[int]] = []
    for a, _, b in base:
        if taken and a <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], b)
        else:
            taken.append([a, b])
    starts = [a for a, _ in taken]
    out: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        at = bisect_right(starts, m.start()) - 1
        if at >= 0 and taken[at][1] >= m.end():
            continue  # inside a base span
        for low, high in _free(m.start(), m.end(), taken, at, len(text)):
            a, b = max(low, m.start() - MAX_CHARS), min(high, m.end() + MAX_CHARS)
            a = max(a, text.rfind("\n", a, max(a, m.start())) + 1)
            b = end if (end := text.find("\n", min(b, m.end()), b)) >= 0 else b
            while low < a < b and text[a - 1].isalnum() and text[a].isalnum():  # a token that is cut is longer than an entity
                a += 1
            while a < b < high and text[b - 1].isalnum() and text[b].isalnum():
                b -= 1
            if a < b:
                if out and a <= out[-1][1]:
                    out[-1][1] = max(out[-1][1], b)
                else:
                    out.append([a, b])
    return [(a, b) for a, b in out]


def _free(start: int, end: int, taken: list[list[int]], at: int, size: int) -> Iterator[tuple[int, int]]:
    """Gaps between taken stretches that text[start:end] touches; ``at`` is the last one that begins up to ``start``."""
    low = taken[at][1] if at >= 0 else 0
    for a, b in taken[at + 1 :]:
        if low < end and start < a:
            yield low, a
        low = b
        if low >= end:
            return
    if low < end:
        yield low, size


# ---- training


def rewrites(kind: int, value: str, rnd: random.Random) -> tuple[list[str], list[str]]:
    """Other spellings of an entity, and look-alikes that are none."""
    if kind == 0:
        local, _, domain = value.partition("@")
        dot = rnd.choice((" dot ", "[dot]", " [dot] ", "(dot)", "."))
        at = rnd.choice((" [at] ", "[at]", " (at) ", "(at)", " at ", "{at}", " @ "))
        return [f"{local}{at if dot != '.' or at != ' at ' else '[at]'}{domain.replace('.', dot)}"], [f"{local} at {rnd.choice(domain.split('.'))}.", f"{local} at the"]
    if kind == 1:
        parts = value.split(".")
        dot = rnd.choice(("[.]", "(.)", " . ", " dot ", "[dot]"))
        wrong = [*parts[:3], str(rnd.randrange(256, 1000))]
        rnd.shuffle(wrong)
        return [dot.join(parts)], [dot.join(wrong), ".".join(wrong), ".".join(parts[:3]), "-".join(parts)]
    digits = "".join(DIGIT.findall(value))
    if kind == 2:
        sep = rnd.choice((".", "/", "  ", "_", " - "))
        groups = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        at = rnd.randrange(len(digits))
        wrong = digits[:at] + str((int(digits[at]) + rnd.randrange(1, 10)) % 10) + digits[at + 1 :]
        return [sep.join(groups)], [wrong, sep.join(wrong[i : i + 4] for i in range(0, len(wrong), 4)), " ".join(wrong[i : i + 4] for i in range(0, len(wrong), 4))]
    if len(digits) != 11:
        return [], []
    lead, a, b, c = digits[0], digits[1:4], digits[4:7], digits[7:]
    date = f"{rnd.randrange(1990, 2030)}-{rnd.randrange(1, 13):02}-{rnd.randrange(1, 29):02}"
    forms = [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{lead} ({a}) {b}-{c}", f"00{lead} {a} {b} {c}", f"{lead}-{a}-{b}-{c}", f"({a}) {b} {c}", f"{a} {b} {c}"]
    return [rnd.choice(forms)], [digits, digits[1:], date, f"{date} {rnd.randrange(10, 24)}:{rnd.randrange(10, 60)}:{rnd.randrange(10, 60)}", f"{c}-{lead}{a}{b}", f"{date} - {date}"]


def examples(found: list[tuple[str, int, str, str]], seed: int = 13) -> list[tuple[str, list[Span]]]:
    """Training texts with their entities, from (text before, kind, entity, text after)."""
    rnd = random.Random(seed)
    out: list[tuple[str, list[Span]]] = []
    for before, kind, value, after in sorted(found):
        good, bad = rewrites(kind, value, rnd)
        for form in (value, *good):
            out.append((before + form + after, [(len(before), kind, len(before) + len(form))]))
        out.extend((before + form + after, []) for form in bad[:2] + rnd.sample(bad[2:], min(1, len(bad[2:]))))
    return out


def train(texts: list[tuple[str, list[Span]]]) -> Model:
    """Gradient steps (Adam) on the conditional log-likelihood; all stretches at once."""
    rows = []  # (stretch, first, end, kinds allowed, gold kind or -1, features)
    seen: Counter[str] = Counter()
    golds = size = 0
    for text, spans in texts:
        stretch = Stretch(text, 0, len(text))
        if len(stretch.tokens) > WIDTH:
            continue
        gold = {(a, b): k for a, k, b in spans}
        mine = []
        for i, j, kinds in stretch.candidates():
            k = gold.pop((stretch.at[i], stretch.at[j]), -1)
            mine.append((size, i, j, kinds, k if k in kinds else -1, stretch.features(i, j)))
        if gold or not mine:
            continue  # an entity that no candidate covers teaches nothing
        rows += mine
        size += 1
        golds += len(spans)
        seen.update(f for r in mine for f in set(r[5]))
    if not golds:
        return Model()
    place = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= MIN_SEEN))}
    owner, first, end, wanted = (np.array([r[c] for r in rows]) for c in (0, 1, 2, 4))
    allowed = np.full((len(rows), len(KINDS)), -np.inf)
    for r, row in enumerate(rows):
        allowed[r, list(row[3])] = 0
    used = [[place[f] for f in r[5] if f in place] for r in rows]
    flat, of = np.array([f for u in used for f in u]), np.repeat(np.arange(len(rows)), [len(u) for u in used])
    gold = np.zeros((len(rows), len(KINDS)))
    gold[np.flatnonzero(wanted >= 0), wanted[wanted >= 0]] = 1
    by_end = [np.flatnonzero(end == j) for j in range(WIDTH + 1)]
    by_first = [np.flatnonzero(first == i) for i in range(WIDTH + 1)]
    w, m, v = (np.zeros((len(place), len(KINDS))) for _ in range(3))
    for step in range(1, STEPS + 1):
        scores = np.zeros((len(rows), len(KINDS)))
        np.add.at(scores, of, w[flat])
        scores += allowed
        total = np.logaddexp.reduce(scores, axis=1)
        alpha, beta = np.zeros((size, WIDTH + 1)), np.zeros((size, WIDTH + 1))
        for j in range(1, WIDTH + 1):
            alpha[:, j] = alpha[:, j - 1]
            r = by_end[j]
            np.logaddexp.at(alpha[:, j], owner[r], alpha[owner[r], first[r]] + total[r])
        for i in range(WIDTH - 1, -1, -1):
            beta[:, i] = beta[:, i + 1]
            r = by_first[i]
            np.logaddexp.at(beta[:, i], owner[r], beta[owner[r], end[r]] + total[r])
        expected = np.exp(alpha[owner, first][:, None] + scores + beta[owner, end][:, None] - alpha[owner, -1][:, None])
        slope = np.zeros_like(w)
        np.add.at(slope, flat, (gold - expected)[of])
        slope = slope / size - RIDGE / size * w
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        w += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model({f: w[i] for f, i in place.items()})


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, most: int = REGIONS) -> Model:
    """A model from the patterns' spans in ``sample_rows`` rows; the driver gets ``most`` stretches of bounded length a kind at most."""
    schema = pa.schema([("before", pa.string()), ("kind", pa.int32()), ("value", pa.string()), ("after", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {f.name: [] for f in schema}
            for text in batch.column(0).to_pylist():
                spans = base_spans(text)
                for n, (a, kind, b) in enumerate(spans):
                    low = max([a - 48, 0, *(e for s, _, e in spans[max(0, n - 3) : n] if e <= a)])
                    high = min([b + 48, len(text), *(s for s, _, e in spans[n + 1 : n + 4] if s >= b)])
                    before = re.split(r"[\n\r]", text[low:a])[-1].partition(" ")[2]
                    after = re.split(r"[\n\r]", text[b:high])[0].rpartition(" ")[0]
                    if b - a <= MAX_CHARS and not any(s < b and a < e for s, k, e in spans[max(0, n - 3) : n + 4] if (s, k, e) != (a, kind, b)):
                        for name, x in zip(out, (before, kind, text[a:b], after), strict=True):
                            out[name].append(x)
            yield arrow_batch(schema, out)

    id_ = F.col("doc_id").cast("long")
    sample = docs.select(id_.alias("doc_id")).filter("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = docs.select(id_.alias("doc_id"), "text").filter(F.col("text").rlike("[0-9@]")).join(F.broadcast(sample), "doc_id", "left_semi")  # bounded by sample_rows
    found = texts.select("text").mapInArrow(run, "before string, kind int, value string, after string").distinct()
    order = [F.xxhash64("kind", "value", "before"), "value", "before", "after"]
    picked = [r for k in range(len(KINDS)) for r in found.filter(F.col("kind") == k).orderBy(*order).limit(most).collect()]
    return train(examples([(r["before"], r["kind"], r["value"], r["after"]) for r in picked]))


def scan(text: str, model: Model) -> tuple[list[Span], list[Span]]:
    """(base spans, added spans) of a text."""
    base = base_spans(text)
    return base, model.added(text, base)


def find_pii(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added."""
    counts = [f"n_{k}" for k in KINDS]
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in counts), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the training stretches

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {f.name: [] for f in schema}
            for text in batch.column(1).to_pylist():
                base, added = scan(text or "", shared.value)
                kinds = [k for _, k, _ in base]
                for k, name in enumerate(counts):
                    out[name].append(kinds.count(k))
                out["base_sha256"].append(hashlib.sha256(spans_text(base).encode()).hexdigest())
                out["spans"].append(spans_text(sorted(base + added)))
                out["n_added"].append(len(added))
            yield arrow_batch(schema, {**out, "doc_id": batch.column(0)})

    ddl = "doc_id long, " + ", ".join(f"{c} long" for c in counts) + ", base_sha256 string, spans string, n_added long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ddl)


def mask(text: str | None, model: Model) -> str | None:
    """The text with each span replaced by its kind in brackets."""
    if text is None:
        return None
    out, at = [], 0
    base, added = scan(text, model)
    for a, kind, b in sorted(base + added):
        if b > at:
            if a >= at:
                out += [text[at:a], f"[{KINDS[kind].upper()}]"]
            at = b
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with the personal data in their texts masked."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        return pd.Series([mask(t, shared.value) for t in texts], dtype=object)

    return docs.withColumn("text", masked("text")).select(*docs.columns)
