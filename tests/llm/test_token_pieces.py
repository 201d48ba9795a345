"""New pieces of texts are encoded many at a time, and cut where no id reaches across."""

import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from otif.llm import common, tokens


@pytest.fixture(scope="module")
def path():
    return tokens.default_tokenizer()


def test_new_pieces_are_encoded_together(path):
    """op8_token_files: a distinct word is no text of its own for the tokenizer, and marks and line feeds make no new words."""
    enc = tokens.Encoder(path)
    sent = []
    ids = enc._ids
    enc._ids = lambda texts: sent.extend(texts) or ids(texts)
    words = [f"{a}{b}{c}zq" for a in "bcdfghklmn" for b in "aeiouäöü" for c in "rstvwxyz"]
    text = " ".join([*words, *(f"{w}{m}" for w in words for m in (".", "$$$", ",\nnext"))])
    got = enc.encode([text])[0].tolist()
    assert len(sent) <= 4
    assert len(enc.known) <= len(words) + 10
    assert got == ids([text])[0]
    sent.clear()
    assert enc.encode([text, "", text])[2].tolist() == got and not sent


def test_cut_texts_keep_their_ids(path):
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    rnd = random.Random(7)
    signs = [*"abXYZ     \n\n.,'0123éß\t-_$*ĠĊª١…“”中😀", " the", "don't", "'ll ", "\r\n", "   ", "\nThe", ".\n", "ö\nö", "<|endoftext|>",
             " ", "\u0085", " ", " ", "　", "​", "᠎", "́", "﻿", "\x1c", "\x00"]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randrange(60))) for _ in range(4000)] + ["", " ", "\n", " a", "a ", " \n", "a\n", "\na", None]
    got = [x.tolist() for x in tokens.encode_texts(path, texts)]
    assert got == [[*whole.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]


def test_parts_hold_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["äb", None, "", "c" * 50, "d", None, "e" * 9, "f"]), "n": pa.array(range(8))})
    cut = list(common.parts(batch, 0, 10))
    assert [x for p in cut for x in p.column(1).to_pylist()] == list(range(8))
    assert [p.num_rows for p in cut] == [4, 3, 1]
    assert not list(common.parts(batch.slice(0, 0), 0, 10))
