"""Near-duplicates by BagMinHash signatures, banding and exact multiset overlap.

A text is the multiset of its runs of five words (lower case, split at white
space; a text of one to four words is one run). The weight range of a run is
discretised into unit levels, grouped in blocks [0,1), [1,2), [2,4), [4,8)...;
each block is one Poisson process whose points carry a time, a register and a
level. A run of count w keeps the points whose level is below w, and a register
keeps its earliest point, so two texts agree in a register with a probability
equal to their weighted Jaccard similarity.

Equal texts share one node, signed once. Nodes that share a band of ``ROWS``
registers are candidates: all pairs in a bucket of up to ``SMALL`` nodes; in a
larger bucket every node is compared with one node of the bucket. Large buckets
that then still hold several components are cut finer, by three further registers
at a time, and the components compared again in the same way. What is then still
mixed is joined without caps, by prefix filtering: with the runs of each text ordered
from rare to common, two texts at the threshold share one of their first few, and a
template that many texts share stands at the end. Pairs whose signatures agree in too few registers are
dropped (``SLACK`` standard deviations below the threshold); the others are verified
on their exact multisets. Classes are the components of the verified links.

Defined cases: a null text is nobody's duplicate; blank texts are duplicates only of
equal ones; repeated rows are duplicates; null doc_ids count as last; an empty table gives
an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from otif.llm.common import Staging, arrow_batch, components, fresh, mix64, text_key, tidy, word_hashes
from otif.llm.tokens import groups

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
SLACK = 4.5
SMALL = 12
FINER = 5  # finer cuts of a large bucket, by three registers each
SLOTS = 1 << 20  # of the counts that order runs by rarity; runs that share a slot cost time only
BLOCK = 256  # nodes of a run that one cell of the prefix join compares with as many
LANES = 16  # 64-bit words of a text's parities
GOLDEN = 0x9E3779B97F4A7C15


Bag = tuple[np.ndarray, np.ndarray]


def bags(texts: Sequence[str], words: int = WORDS) -> Iterator[Bag]:
    """Of each text the distinct hashed runs, ascending, and their counts."""
    for part in groups(texts):
        hashes, begins = word_hashes(texts[part])
        for a, b in zip(begins, begins[1:], strict=False):
            h = hashes[a:b]
            n = max(len(h) - words + 1, min(len(h), 1))
            runs = np.zeros(n, np.uint64)
            for i in range(min(words, len(h))):
                runs = mix64(runs + h[i : i + n] + np.uint64(GOLDEN))
            yield np.unique(runs, return_counts=True)


def overlap(a: Bag, b: Bag) -> float:
    """Weighted Jaccard similarity of two multisets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    total = int(a[1].sum() + b[1].sum()) - common
    return common / total if total else 0.0


def signature(elements: np.ndarray, counts: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """32-bit identity of the earliest point of each register."""
    blocks = [(elements, counts, np.zeros(len(elements)), np.ones(len(elements)))]
    k = 0
    while len(blocks[-1][0]) and (over := counts > 2**k).any():
        elements, counts = elements[over], counts[over]
        blocks.append((mix64(elements + np.uint64(k + 1)), counts, np.full(len(elements), 2.0**k), np.full(len(elements), 2.0**k)))
        k += 1
    seed, weight, low, length = (np.concatenate(x) for x in zip(*blocks, strict=True))
    until = registers / weight_below(weight, low, length).sum() * (math.log(registers) + 3)
    while True:
        times, register, point = _points(seed, weight, low, length, until, registers)
        order = np.argsort(-times, kind="stable")
        filled, out = np.zeros(registers, bool), np.zeros(registers, np.uint32)
        filled[register], out[register[order]] = True, point[order]  # the last, earliest point stays
        if filled.all():
            return out
        until *= 2


def weight_below(weight: np.ndarray, low: np.ndarray, length: np.ndarray) -> np.ndarray:
    return np.minimum(weight - low, length)


def _points(seed, weight, low, length, until, registers):
    """Points (time, register, identity) up to time ``until`` whose level is below the weight."""
    now, first, found = np.zeros(len(seed)), 0, []
    while len(seed):
        steps = max(1, 512 // len(seed))
        h = mix64(seed[:, None] + np.arange(first + 1, first + steps + 1, dtype=np.uint64) * np.uint64(GOLDEN))
        gap = -np.log(((h >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53) / length[:, None]
        times = now[:, None] + np.cumsum(gap, axis=1)
        h2 = mix64(h ^ np.uint64(GOLDEN))
        level = low[:, None] + np.floor((h2 & np.uint64(0xFFFFFF)).astype(np.float64) * 2.0**-24 * length[:, None])
        keep = (times <= until) & (level < weight[:, None])
        found.append((times[keep], ((h2 >> np.uint64(32)) % np.uint64(registers))[keep].astype(np.int64), (mix64(h2)[keep] >> np.uint64(32)).astype(np.uint32)))
        going = times[:, -1] <= until
        seed, weight, low, length, now, first = seed[going], weight[going], low[going], length[going], times[going, -1], first + steps
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    rows = sig.reshape(bands, -1).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(GOLDEN)
    for i in range(rows.shape[1]):
        key = mix64(key + rows[:, i] * np.uint64(0xD6E8FEB86659FD93))
    return key.view(np.int64)


def sign(docs: DataFrame) -> DataFrame:
    """Per row with a text: doc_id, node, signature and band keys (null where it has no words)."""
    schema = pa.schema([("doc_id", pa.int64()), ("node", pa.binary()), ("signature", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signatures, bands = [], []
            for elements, counts in bags(batch.column(2).to_pylist()):
                sig = signature(elements, counts) if len(elements) else None
                signatures.append(None if sig is None else sig.tobytes())
                bands.append(None if sig is None else band_keys(sig))
            yield arrow_batch(schema, {"doc_id": batch.column(0), "node": batch.column(1), "signature": signatures, "bands": bands})

    rows = docs.filter("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("node"), "text")
    return rows.mapInArrow(tidy(run), "doc_id long, node binary, signature binary, bands array<long>")


def agreeing(pairs: DataFrame, signatures: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose signatures agree about as often as the threshold asks."""
    least = math.floor(REGISTERS * threshold - SLACK * math.sqrt(REGISTERS * threshold * (1 - threshold)))
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, REGISTERS) for c in (2, 3))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], schema=schema).filter(pa.array((left == right).sum(axis=1) >= least))

    return with_sides(pairs, signatures, "signature").mapInArrow(tidy(run), "a binary, b binary")


def with_sides(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """a, b and ``column`` of each (x, y)."""
    both = pairs.join(table.select(F.col("node").alias("b"), F.col(column).alias("y")), "b")
    return both.join(table.select(F.col("node").alias("a"), F.col(column).alias("x")), "a").select("a", "b", "x", "y")


def rows_of(docs: DataFrame, chosen: DataFrame, node: str) -> DataFrame:
    """Rows of ``docs`` that are a chosen (node, doc_id), with all their columns and their node."""
    rows = docs.filter("text is not null").withColumn(node, text_key(F.col("text")))
    ids = chosen.select(F.col("node").alias(f"{node}_n"), F.col("doc_id").alias(f"{node}_d"))
    return rows.join(ids, (rows[node] == ids[f"{node}_n"]) & rows["doc_id"].cast("long").eqNullSafe(ids[f"{node}_d"]), "left_semi")


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose multisets overlap by the threshold or more."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (bags(batch.column(c).to_pylist()) for c in (2, 3))
            keep = [overlap(x, y) >= threshold for x, y in zip(left, right, strict=True)]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], schema=schema).filter(pa.array(keep, pa.bool_()))

    return with_sides(pairs, texts, "text").mapInArrow(tidy(run), "a binary, b binary")


def candidates(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of members (key, node, n, h, least, root) of different roots.

    All pairs of a bucket of up to ``SMALL`` nodes; else each node and the bucket's
    node of least h, so a bucket yields a bounded number of pairs for each node.
    """
    few = members.filter(F.col("n") <= SMALL).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("node", "root"))).alias("g"))
    pair = "transform(filter(slice(g, i + 2, size(g)), y -> y.root != x.root), y -> struct(x.node as a, y.node as b))"
    few = few.select(F.explode(F.expr(f"flatten(transform(g, (x, i) -> {pair}))")).alias("p")).select("p.a", "p.b")
    many = members.filter(F.col("n") > SMALL)
    centre = many.filter("h = least").groupBy("key").agg(F.min(F.struct("node", "root")).alias("c"))
    star = many.join(centre, "key").filter("root != c.root").select(*ordered("node", F.col("c.node")))
    return few.union(star).distinct()


def ordered(a, b) -> tuple:
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def ranked(bag: Bag, counts: np.ndarray) -> np.ndarray:
    """The multiset as a set of (run, occurrence), from rare to common by the counts of their slots."""
    runs = np.repeat(bag[0], bag[1])
    nth = np.arange(len(runs)) - np.repeat(np.cumsum(bag[1]) - bag[1], bag[1])
    tokens = mix64(runs + nth.astype(np.uint64) * np.uint64(GOLDEN))
    return tokens[np.lexsort((tokens, counts[tokens % np.uint64(SLOTS)]))]


def prefix_pairs(staging: Staging, nodes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of nodes (node, root, text) of different roots, among them all that overlap by the threshold.

    Of n runs the overlap holds at least threshold * n, and of the smaller text at least
    2 * threshold / (1 + threshold) * n; so the first common run, in any fixed order, stands
    among the others. A run of many nodes is dealt over cells of BLOCK by BLOCK nodes. Of the
    pairs that meet there, those are left out within the join whose parities (one bit for an odd number of
    runs in each of 64 * LANES classes) prove more differing runs than the threshold allows.
    """
    nodes = staging.put(nodes, "open")
    flat = np.zeros(SLOTS, np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for bag in bags(batch.column(0).to_pylist()):
                np.add.at(total, (ranked(bag, flat) % np.uint64(SLOTS)).astype(np.intp), 1)
        used = np.flatnonzero(total)
        for i in range(0, len(used), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(used[i : i + (1 << 16)]), pa.array(total[used[i : i + (1 << 16)]])], names=["slot", "n"])

    slots = nodes.select("text").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # SLOTS rows at most
    counts = flat.copy()
    counts[slots["slot"].to_numpy()] = slots["n"].to_numpy()
    shared = nodes.sparkSession.sparkContext.broadcast(counts)
    schema = pa.schema([("token", pa.int64()), ("node", pa.binary()), ("root", pa.binary()), ("size", pa.int64()), ("place", pa.int64()), ("early", pa.bool_()), ("parity", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            for i, bag in enumerate(bags(batch.column(2).to_pylist())):
                tokens = bagged = ranked(bag, counts)
                n = len(tokens)
                probe, early = (n - math.ceil(n * share - 1e-9) + 1 for share in (threshold, 2 * threshold / (1 + threshold)))
                tokens = tokens[:probe]
                place = np.flatnonzero(counts[tokens % np.uint64(SLOTS)] > 1)  # the others are in no second text
                if len(place):
                    same = pa.array(np.full(len(place), i))
                    odd = np.bincount((mix64(bagged) % np.uint64(64 * LANES)).astype(np.intp), minlength=64 * LANES) & 1
                    parity = pa.array([np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()], pa.list_(pa.int64())).take(pa.array(np.zeros(len(place), np.int64)))
                    yield arrow_batch(schema, {"token": tokens[place].view(np.int64), "node": batch.column(0).take(same), "root": batch.column(1).take(same),
                                               "size": np.full(len(place), n), "place": place, "early": place < early, "parity": parity})

    prefixes = staging.put(nodes.mapInArrow(tidy(run), "token long, node binary, root binary, size long, place long, early boolean, parity array<long>"), "prefixes")
    shared.destroy()
    cells = prefixes.groupBy("token").agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi")
    members = prefixes.join(cells.select("token", F.ceil(F.col("n") / BLOCK).alias("cells")), "token").withColumn("own", F.pmod(F.xxhash64("node"), "cells"))
    other, fact = F.explode(F.expr("sequence(0L, cells - 1)")), F.struct("size", "node", "root", "place", "parity")
    left = members.filter("early").select("token", F.col("own").alias("i"), other.alias("j"), fact.alias("x"))
    right = members.select("token", other.alias("i"), F.col("own").alias("j"), fact.alias("y"))
    least = f"{threshold / (1 + threshold)!r}D * (x.size + y.size) - 1e-6D"
    fits = f"least(x.place, y.place) + least(x.size - x.place, y.size - y.place) >= {least}"
    differ = "aggregate(zip_with(x.parity, y.parity, (p, q) -> bit_count(p ^ q)), 0, (s, n) -> s + n)"  # each other token flips one bit
    near = f"{differ} <= {(1 - threshold) / (1 + threshold)!r}D * (x.size + y.size) + 1e-6D"
    met = left.join(right, ["token", "i", "j"]).filter("x.root != y.root and struct(x.size, x.node) < struct(y.size, y.node)").filter(fits).filter(near)
    return met.select(*ordered(F.col("x.node"), F.col("y.node"))).distinct()


def classes(staging: Staging, docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Signed rows (doc_id, node), and per node: its least doc_id and the root of its component."""
    signed = staging.put(sign(docs), "signed")
    nodes = staging.put(signed.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "nodes")
    signatures = staging.put(signed.filter("signature is not null").drop("doc_id").dropDuplicates(["node"]), "signatures")
    members = signatures.select("node", F.explode("bands").alias("key")).withColumn("h", F.xxhash64("node", "key"))
    buckets = members.groupBy("key").agg(F.count("*").alias("n"), F.min("h").alias("least")).filter("n > 1")
    shared = staging.put(members.join(buckets, "key"), "shared")
    pairs = staging.put(agreeing(candidates(shared.withColumn("root", F.col("node"))), signatures, threshold), "pairs")

    # The texts of all nodes that may be compared, shuffled once.
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).union(shared.filter(F.col("n") > SMALL).select("node")).distinct()
    texts = rows_of(docs.select("doc_id", "text"), needed.join(nodes, "node"), "node").select("node", "text").dropDuplicates(["node"])
    texts = staging.put(texts, "texts")
    links = staging.put(verified(pairs, texts, threshold), "links")
    roots = staging.put(components(staging, links, "components"), "roots")

    # Large buckets that still hold several components: cut finer by further registers and compared again.
    mixed = shared.filter(F.col("n") > SMALL).select("key", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_keys = mixed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").select("key")
    finer = [F.xxhash64("key", F.substring("signature", 4 * k + 1, 12)) for k in range(0, REGISTERS - 2, REGISTERS // FINER)]
    fine = mixed.join(open_keys, "key").join(signatures.select("node", "signature"), "node")
    fine = fine.select("node", "root", F.explode(F.array(*finer)).alias("key")).withColumn("h", F.xxhash64("node", "key"))
    fine = staging.put(fine, "fine")
    sizes = fine.groupBy("key").agg(F.count("*").alias("n"), F.min("h").alias("least"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    again = candidates(fine.join(sizes.filter("lo != hi").drop("lo", "hi"), "key")).join(pairs, ["a", "b"], "left_anti")
    more = staging.put(verified(agreeing(again, signatures, threshold), texts, threshold), "more")
    if not more.isEmpty():
        links = links.union(more)
        roots = staging.put(components(staging, links, "components-2"), "roots-2")

    # Buckets that are still mixed: every pair of their nodes that can reach the threshold.
    mixed = shared.filter(F.col("n") > SMALL).select("key", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_keys = mixed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").select("key")
    mixed = staging.put(mixed.join(open_keys, "key").select("node", "root").distinct(), "mixed")
    if not mixed.isEmpty():
        rest = prefix_pairs(staging, texts.join(mixed, "node").select("node", "root", "text"), threshold)
        rest = staging.put(verified(agreeing(rest, signatures, threshold), texts, threshold), "rest")
        if not rest.isEmpty():
            roots = staging.put(components(staging, links.union(rest), "components-3"), "roots-3")
    staging.drop("signatures", "shared", "pairs", "texts", "fine", "mixed", "open", "prefixes")
    return signed, nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id and class_id, the least doc_id of its class."""
    signed, nodes = classes(Staging(docs.sparkSession, "minhash"), docs, threshold)
    of_root = nodes.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    of_node = nodes.join(of_root, "root").select("node", "class_id")
    doc_id = F.col("doc_id").cast("long")
    return signed.join(of_node, "node").select("doc_id", "class_id").union(docs.filter("text is null").select(doc_id.alias("doc_id"), doc_id.alias("class_id")))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that stay: one of each class, that of its least doc_id, and every row without a text."""
    _, nodes = classes(Staging(docs.sparkSession, "minhash"), docs, threshold)
    first = nodes.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("f"))
    node = fresh(docs, "node")
    kept = rows_of(docs, first.select("f.node", "f.doc_id"), node).dropDuplicates(["doc_id", node]).drop(node)
    return kept.unionByName(docs.filter("text is null"))
