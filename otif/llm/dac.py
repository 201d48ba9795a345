"""Token-id files as directly addressable codes.

Each id is split into chunks of ``WIDTHS`` bits, lowest first. Level k holds the
k-th chunk of every id that reaches it, a bitmap that says whether the id goes on,
and a rank directory over the bitmap (ones before each block of 512), so any id
is read by following ranks, without decoding what precedes it. A file also lists
its documents and where each begins.

Files are written in ascending doc_id order, by range partition; a task writes
under a name of its own and renames, so a repeated task leaves the same files.

Defined cases: a null or empty text is the single end id; rows with equal doc_id
follow each other, ordered by text; null doc_ids come first; an empty table gives
no files and an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from otif.llm.common import Staging, arrow_batch, parts
from otif.llm.tokens import GROUP_CHARS, encode_texts

MAGIC = b"DAC1"
WIDTHS = (12, 4, 16)
BLOCK = 512
FILE_IDS = 2_000_000  # a file is closed after the document that reaches this many ids
HEAD = struct.Struct("<4sIQQQ")  # magic, levels, documents, ids, ids of the partition before this file
LEVEL = struct.Struct("<IQ")  # chunk bits, entries


def _pack_bits(values: np.ndarray, width: int) -> bytes:
    out = []
    for i in range(0, len(values), 1 << 18):  # a multiple of 8 entries at a time bounds the bit matrix
        part = values[i : i + (1 << 18)].astype("<u4")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
        out.append(np.packbits(bits.reshape(-1), bitorder="little").tobytes())
    return b"".join(out)


def _unpack_bits(buffer: np.ndarray, width: int, a: int, b: int) -> np.ndarray:
    """Entries ``a`` to ``b`` of a packed array."""
    first = a * width // 8
    bits = np.unpackbits(buffer[first : -(-b * width // 8)], bitorder="little")[a * width - first * 8 :][: (b - a) * width]
    padded = np.zeros((b - a, 32), np.uint8)
    padded[:, :width] = bits.reshape(-1, width)
    return np.packbits(padded, axis=1, bitorder="little").view("<u4").reshape(-1)


def encode_file(doc_ids: list[int | None], arrays: list[np.ndarray], before: int) -> bytes:
    starts = np.zeros(len(arrays) + 1, "<u8")
    starts[1:] = np.cumsum([len(a) for a in arrays])
    rest = np.concatenate(arrays).astype(np.uint32) if arrays else np.zeros(0, np.uint32)
    known = np.array([x is not None for x in doc_ids], np.uint8)
    parts = [HEAD.pack(MAGIC, len(WIDTHS), len(arrays), int(starts[-1]), before), known.tobytes(),
             np.array([x or 0 for x in doc_ids], "<i8").tobytes(), starts.tobytes()]
    for width in WIDTHS:
        more = rest >> np.uint32(width) > 0
        ones = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.int64) if len(more) else np.zeros(0, np.int64)
        parts += [LEVEL.pack(width, len(rest)), _pack_bits(rest & np.uint32((1 << width) - 1), width),
                  np.packbits(more, bitorder="little").tobytes(), (np.cumsum(ones) - ones).astype("<u4").tobytes()]
        rest = rest[more] >> np.uint32(width)
    return b"".join(parts)


class DacFile:
    """Random access to a file's ids: ``f[i]``, ``f.slice(a, b)``, ``f.document(k)``."""

    def __init__(self, raw: bytes):
        self.raw = np.frombuffer(raw, np.uint8)
        magic, levels, self.documents, self.ids, self.before = HEAD.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a token-id file")
        self.at = HEAD.size
        known = self._take(self.documents, np.uint8)
        numbers = self._take(8 * self.documents, "<i8")
        self.doc_ids = [int(x) if k else None for x, k in zip(numbers, known, strict=True)]
        self.starts = self._take(8 * (self.documents + 1), "<u8").astype(np.int64)
        self.levels = []
        for _ in range(levels):
            width, n = LEVEL.unpack(self._take(LEVEL.size, np.uint8).tobytes())
            chunks, more = self._take(-(-n * width // 8), np.uint8), self._take(-(-n // 8), np.uint8)
            self.levels.append((width, chunks, more, self._take(4 * -(-n // BLOCK), "<u4")))

    def _take(self, n: int, dtype) -> np.ndarray:
        self.at += n
        return np.frombuffer(self.raw[self.at - n : self.at].tobytes(), dtype)

    def _rank(self, k: int, i: int) -> int:
        """Ones before entry ``i`` of level ``k``'s bitmap."""
        _, _, more, directory = self.levels[k]
        block = i // BLOCK
        if block == len(directory):  # i is the end and begins a new block
            block -= 1
            if block < 0:
                return 0
        bits = np.unpackbits(more[block * BLOCK // 8 : -(-i // 8)], bitorder="little")[: i - block * BLOCK]
        return int(directory[block]) + int(bits.sum())

    def slice(self, a: int, b: int, k: int = 0) -> np.ndarray:
        if b <= a:
            return np.zeros(0, "<u4")
        width, chunks, more, _ = self.levels[k]
        out = _unpack_bits(chunks, width, a, b)
        bits = np.unpackbits(more[a // 8 : -(-b // 8)], bitorder="little")[a % 8 :][: b - a].astype(bool)
        if n := int(bits.sum()):
            first = self._rank(k, a)
            out[bits] |= self.slice(first, first + n, k + 1) << np.uint32(width)
        return out

    def __getitem__(self, i: int) -> int:
        return int(self.slice(i, i + 1)[0])

    def document(self, k: int) -> np.ndarray:
        return self.slice(int(self.starts[k]), int(self.starts[k + 1]))


def write_files(docs: DataFrame, tokenizer: str, folder: str, file_ids: int = FILE_IDS) -> DataFrame:
    """Lazily write ``docs`` below ``folder``; a row per file: part, file, documents, ids."""
    schema = pa.schema([("part", pa.int32()), ("file", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        part, number, before = TaskContext.get().partitionId(), 0, 0
        doc_ids, arrays, size = [], [], 0

        def flush() -> pa.RecordBatch:
            name = f"part-{part:06d}-{number:06d}.dac"
            store.create_dir(root, recursive=True)
            with store.open_output_stream(mine := f"{root}/_{uuid.uuid4().hex}") as out:
                out.write(encode_file(doc_ids, arrays, before))
            store.move(mine, f"{root}/{name}")
            return arrow_batch(schema, {"part": [part], "file": [name], "documents": [len(arrays)], "ids": [size]})

        for part_of in (p for batch in batches for p in parts(batch, 1, GROUP_CHARS)):
            for doc_id, ids in zip(part_of.column(0).to_pylist(), encode_texts(tokenizer, part_of.column(1).to_pylist()), strict=True):
                doc_ids.append(doc_id)
                arrays.append(ids)
                size += len(ids)
                if size >= file_ids:
                    yield flush()
                    number, before = number + 1, before + size
                    doc_ids, arrays, size = [], [], 0
        if arrays:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, "part int, file string, documents long, ids long")


def read_files(spark, folder: str) -> DataFrame:
    """A row per document of the files: part, doc_id, start (in its partition), n_tokens, ids_crc32."""
    schema = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                f = DacFile(content.as_py())
                lengths = np.diff(f.starts)
                yield arrow_batch(schema, {
                    "part": [int(path.rsplit("-", 2)[1])] * f.documents, "doc_id": f.doc_ids, "start": f.before + f.starts[:-1],
                    "n_tokens": lengths, "ids_crc32": [zlib.crc32(f.document(k).tobytes()) for k in range(f.documents)]})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.dac").load(folder).select("path", "content")
    return files.mapInArrow(run, "part int, doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, folder: str | None = None, file_ids: int = FILE_IDS) -> DataFrame:
    """Write ``docs`` as token-id files and return, read back from them, doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    staging = Staging(spark, "dac")
    folder = folder or f"{staging.path}/files"
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    folder = folder.replace("file:/", "file:///", 1) if not folder.startswith("file://") and folder.startswith("file:/") else folder
    manifest = staging.put(write_files(docs, tokenizer, folder, file_ids), "manifest")
    totals = manifest.groupBy("part").agg(F.sum("ids").alias("ids")).orderBy("part").collect()  # a row per partition
    if not totals:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    rows, base = [], 0
    for r in totals:
        rows.append((r["part"], base))
        base += r["ids"]
    starts = spark.createDataFrame(rows, "part int, _base long")
    found = read_files(spark, folder).join(F.broadcast(starts), "part")
    return found.select("doc_id", (F.col("start") + F.col("_base")).alias("start"), "n_tokens", "ids_crc32")
