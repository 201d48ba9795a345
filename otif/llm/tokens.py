"""Whole-text tokenization with a public tokenizer file, one memo per worker.

A byte-level BPE never merges across its own pre-token boundaries. Such a boundary
lies before a single space that a non-space character follows, between an ASCII
letter and an ASCII character that is none, and on both sides of a line feed that
stands alone. A text is cut there and each distinct piece is encoded once per
worker; texts with other spacing are encoded whole. Either way the ids equal those
of the whole text. Pieces are told apart by 64-bit hashes and put together by array
indexing. New ones are encoded many at a time, as one text with a space or a line feed
between them; the ids that begin with either show where each piece begins.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence

import numpy as np

from otif.llm.common import BYTES, polynomials

END_ID = 0
GROUP_CHARS = 1 << 20  # texts handled at a time: bounds the pieces in memory
MEMO_PIECES = 1_200_000  # distinct pieces remembered: bounds the memo, not the texts
SLOTS = 1 << 20

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_STOP = np.arange(256) < 128  # ASCII, neither letter nor space
_STOP[32] = False
_STOP[_LETTER] = False
#: Bytes that surely end or begin a character other than white space.
_BEFORE, _AFTER = np.zeros(256, bool), np.zeros(256, bool)
_BEFORE[33:127] = _BEFORE[128:] = True
_BEFORE[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = False
_AFTER[33:127] = _AFTER[0xC3:0xE0] = _AFTER[0xE4:0xF5] = True

_ODD_SPACING = re.compile(r" (?:\s|\Z)")
_encoders: dict[str, Encoder] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.line = self._ids(["\n"])[0]
        vocabulary = self.tok.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that begin with a space, which byte-level vocabularies write as Ġ
        self.spaced[[i for t, i in vocabulary.items() if t.startswith("Ġ")]] = True
        self._forget()

    def _forget(self) -> None:
        self.known, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # hashes of the pieces, ascending, and their numbers
        self.pool, self.filled = np.zeros(1 << 20, np.uint32), 0  # ids of all known pieces
        self.at, self.sizes = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.slot_hash, self.slot_piece = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int32)

    def _ids(self, texts: Sequence[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(list(texts), add_special_tokens=False)]

    def _apart(self, pieces: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces one after the other, and how many each has; each piece is a text."""
        ids = self._ids(pieces)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((x for i in ids for x in i), np.uint32, int(sizes.sum())), sizes

    def _spaced(self, pieces: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_apart``, for pieces that begin with their only space."""
        ids = np.array(self._ids(["".join(pieces)])[0], np.uint32)
        at = np.flatnonzero(self.spaced[ids])
        return (ids, np.diff(at, append=len(ids))) if len(at) == len(pieces) else self._apart(pieces)

    def _unspaced(self, pieces: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_apart``, for pieces without a space before them."""
        text = "\n".join(pieces)
        if len(self.line) != 1 or len(text.split()) != len(pieces):  # white space within some
            return self._apart(pieces)
        ids = np.array(self._ids([text])[0], np.uint32)
        between = ids == self.line[0]
        at = np.concatenate([[-1], np.flatnonzero(between), [len(ids)]])
        return (ids[~between], np.diff(at) - 1) if len(at) == len(pieces) + 1 else self._apart(pieces)

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> np.ndarray:
        """Numbers of new pieces, of which each has the space before it if it has one."""
        order, flat, sizes = [], [], []
        kinds = [0 if p[0] == " " else 1 if p.split() == [p] else 2 for p in pieces]
        for kind, encode in enumerate((self._spaced, self._unspaced, self._apart)):
            if own := [i for i, k in enumerate(kinds) if k == kind]:
                ids, n = encode([pieces[i] for i in own])
                order += own
                flat.append(ids)
                sizes.append(n)
        flat, sizes = np.concatenate(flat), np.concatenate(sizes)
        first = len(self.known)
        numbers = np.zeros(len(pieces), np.int32)
        numbers[order] = np.arange(first, first + len(pieces))
        while self.filled + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while first + len(pieces) > len(self.at):
            self.at, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.at, self.sizes))
        self.pool[self.filled : self.filled + len(flat)] = flat
        self.at[first : first + len(pieces)], self.sizes[first : first + len(pieces)] = self.filled + np.cumsum(sizes) - sizes, sizes
        self.filled += len(flat)
        place = np.searchsorted(self.known, hashes)
        self.known, self.number = np.insert(self.known, place, hashes), np.insert(self.number, place, numbers)
        return numbers

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of each text."""
        plain = [i for i, t in enumerate(texts) if not _ODD_SPACING.search(t)]
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        odd = sorted(set(range(len(texts))).difference(plain))
        for i, ids in zip(odd, self._ids([texts[i] for i in odd]), strict=True):
            out[i] = np.array(ids, np.uint32)
        if not plain:
            return out
        raw = [texts[i].encode("utf-8", "surrogatepass") for i in plain]
        bounds = np.cumsum([0, *(len(r) + 1 for r in raw)])  # of the texts, each with a space behind it
        raw = b" ".join([*raw, b""])
        data = np.frombuffer(raw, np.uint8)
        starts, ends = _cuts(data)
        lead = np.concatenate([[False], data == 32])[starts]
        lead[np.isin(starts, bounds[:-1])] = False  # a text's first piece has no space before it
        hashes = polynomials(BYTES[data[data != 32]], ends - starts) ^ (~lead * np.uint64(0xA5A5A5A5A5A5A5A5))
        numbers = self._numbers(hashes, starts, ends, lead, raw)
        sizes = self.sizes[numbers]
        before = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        ids = self.pool[np.repeat(self.at[numbers] - before[:-1], sizes) + np.arange(before[-1])]
        for i, part in zip(plain, np.split(ids, before[np.searchsorted(starts, bounds[1:-1])]), strict=True):
            out[i] = part
        return out

    def _numbers(self, hashes, starts, ends, lead, raw: bytes) -> np.ndarray:
        """The number of each piece; new ones are encoded. A direct-mapped table answers most."""
        if len(self.known) > MEMO_PIECES:
            self._forget()
        slots = hashes & np.uint64(SLOTS - 1)
        numbers = np.where(self.slot_hash[slots] == hashes, self.slot_piece[slots], -1)
        asked = np.flatnonzero(numbers < 0)
        distinct, first, inverse = np.unique(hashes[asked], return_index=True, return_inverse=True)
        found = np.full(len(distinct), -1, np.int32)
        if len(self.known):
            place = np.minimum(np.searchsorted(self.known, distinct), len(self.known) - 1)
            found = np.where(self.known[place] == distinct, self.number[place], -1)
        new = np.flatnonzero(found < 0)
        if len(new):
            at = asked[first[new]]
            pieces = [raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip((starts[at] - lead[at]).tolist(), ends[at].tolist(), strict=True)]
            found[new] = self._learn(distinct[new], pieces)
        numbers[asked] = found[inverse]
        self.slot_hash[slots[asked]], self.slot_piece[slots[asked]] = hashes[asked], numbers[asked]
        return numbers


def _cuts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of texts, each with a space behind it, begin and end; together they hold all bytes but spaces."""
    begins = np.concatenate([[True], (data[:-1] == 32) | (_LETTER[data[:-1]] & _STOP[data[1:]])])
    lines = np.flatnonzero(data[1:] == 10) + 1
    lines = lines[_BEFORE[data[lines - 1]] & _AFTER[data[lines + 1]]]
    begins[lines] = begins[lines + 1] = True
    inside = data != 32
    return np.flatnonzero(begins & inside), np.flatnonzero(inside & np.concatenate([begins[1:], [True]]) | inside & ~np.concatenate([inside[1:], [False]])) + 1


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def groups(texts: Sequence[str], limit: int = GROUP_CHARS) -> Iterator[slice]:
    """Consecutive slices of about ``limit`` characters, never cutting a text."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def encode_texts(path: str, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
    """Ids of each text (null: of an empty one), followed by the end id."""
    enc, filled = encoder(path), [t or "" for t in texts]
    for part in groups(filled):
        for ids in enc.encode(filled[part]):
            yield np.append(ids, np.uint32(END_ID))
