"""What a worker of the pipeline holds at a time."""

import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest

from otif.llm import common, toxicity


class Captured(Exception):
    pass


def test_trigrams_take_little_memory():
    """pipeline: the character model's workers hold a small part of a batch as strings and arrays."""

    class Docs:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            raise Captured(run)

    with pytest.raises(Captured) as found:
        toxicity.count_trigrams(Docs())
    texts = [" ".join(f"word{i * k % 97}" for k in range(400)) for i in range(4000)] + [None, "", " x"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    tracemalloc.start()
    try:
        out = list(found.value.args[0](iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 12e6, peak
    want = Counter()
    for t in texts:
        codes = [0]
        for c in t or "":
            code = ord(c) - 96 if c.isalpha() else 0
            codes += [code] if code else [0, 0] if codes[-1] else []
        codes = [0, *codes] if codes[1:] else codes
        codes += [0, 0] if codes[-1] else []
        want.update((a * 28 + b) * 28 + c for a, b, c in zip(codes, codes[1:], codes[2:], strict=False))
    got = Counter()
    for b in out:
        got.update(dict(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)))
    assert {k: n for k, n in got.items() if k} == {k: n for k, n in want.items() if k}


def test_small_batches(spark):
    names = list(common.BATCH)
    before = [spark.conf.get(n) for n in names]

    def rows(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int32())], ["n"])

    frame = spark.range(5000, numPartitions=1).selectExpr("repeat('x', 10) AS text")
    with common.small_batches(spark):
        sizes = [r["n"] for r in frame.mapInArrow(rows, "n int").collect()]
    assert sum(sizes) == 5000 and max(sizes) <= 1000
    assert [spark.conf.get(n) for n in names] == before
