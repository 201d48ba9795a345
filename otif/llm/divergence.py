"""Source divergence audit by one-hot level products.

How far two sources of a language lie apart is a sum over terms that depends only on
the counts (levels) a term has in both, so it can be priced from the joint table "how
many terms have level a here and level b there". The tables of all pairs of
sources are one matrix product: X has a row per kept term and an indicator column
per (source, level), and X'X holds every joint table. X is multiplied in blocks of
terms, and of columns where a block has many; each block's product is exact (0/1
entries, fewer rows than a float can count) and its non-zero cells are summed by
Spark. Level 0 has no column: its cells follow from the margins, since
every kept term has some level in every source. Terms are blocked in order of their
totals, so terms of a block share levels and their cells fold together.

Shares are whole numbers, p = 1 + floor(PARTS * (count + 1) / (N + V)); a term's price is
floor((p - q)^2 / q). Levels are named by their shares, so counts of equal share are one level. ``audit`` gives, per (lang, source), the price against each other
source of the language, and the terms used more than in the language as a whole.

Defined cases: null text, lang and source count as ''; groups without terms take part
with counts of 0; a language without kept terms prices every pair at 0 and lists no
terms; repeated rows count each time; long texts are cut into words block by block; an
empty table gives an empty result; ties are ordered by item; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from otif.llm.common import Staging, arrow_batch
from otif.llm.resample import word_blocks

MIN_DOCS, PARTS, TOP_TERMS = 3, 1_000_000_000, 200
ENTRIES = 400_000  # (group, term) counts a task holds before it sends them on
BLOCK_ROWS, BLOCK_CELLS, TILE = 4096, 1 << 16, 1024  # terms and non-zero entries of a block, columns of a tile

#: A-Z become a-z; any other byte below 0x80 that is no letter parts terms.
LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))

EXACT = "decimal(38,0)"
LONG_COUNT = (1 << 63) // PARTS - 1  # counts below it, times PARTS, fit into a long


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term, summed within tasks first."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def settle() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, found_in) in groups.items():
                terms = pa.array(list(n), pa.binary()).cast(pa.string())
                yield arrow_batch(schema, {"lang": [lang] * len(n), "source": [source] * len(n), "term": terms, "n": list(n.values()), "docs": [found_in[t] for t in n]})
            groups.clear()

        held = 0
        for batch in batches:
            for lang, source, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n, found_in = groups.setdefault((lang, source), (Counter(), Counter()))
                before, own = len(n), set()
                for words in word_blocks(raw, LETTERS):
                    n.update(words)
                    own.update(words)
                found_in.update(own)
                held += len(n) - before
                if held > ENTRIES:
                    yield from settle()
                    held = 0
        yield from settle()

    columns = [F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), F.coalesce("text", F.lit("")).cast("binary").alias("text")]
    return docs.select(*columns).mapInArrow(run, "lang string, source string, term string, n long, docs long")


def joint_levels(cells: DataFrame) -> DataFrame:
    """(lang, a, pa, b, pb, terms) with a < b: non-zero cells of X'X, summed over blocks.

    ``cells`` holds (lang, source, term, total, p); a level is named by its share p.
    """
    schema = pa.schema([("lang", pa.string()), ("a", pa.string()), ("pa", pa.int64()), ("b", pa.string()), ("pb", pa.int64()), ("terms", pa.int64())])

    def product(lang: str, rows: list[tuple[int, str, int]]) -> Iterator[pa.RecordBatch]:
        """X'X of one block; ``rows`` holds (number of the term, source, level)."""
        columns = sorted({(source, level) for _, source, level in rows})
        place = {c: i for i, c in enumerate(columns)}
        names, levels = [c[0] for c in columns], np.array([c[1] for c in columns], np.int64)
        owner = np.cumsum([0, *(x != y for x, y in zip(names, names[1:], strict=False))])
        x = np.zeros((rows[-1][0] + 1, len(columns)), np.float32)
        x[[r[0] for r in rows], [place[r[1:]] for r in rows]] = 1
        for i in range(0, len(columns), TILE):
            for j in range(i, len(columns), TILE):
                cell = x[:, i : i + TILE].T @ x[:, j : j + TILE]
                at, to = np.nonzero(cell)
                apart = owner[at + i] < owner[to + j]
                at, to = at[apart], to[apart]
                if len(at):
                    yield arrow_batch(schema, {"lang": [lang] * len(at), "a": [names[k] for k in (at + i).tolist()], "pa": levels[at + i],
                                               "b": [names[k] for k in (to + j).tolist()], "pb": levels[to + j], "terms": cell[at, to].astype(np.int64)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, str, int]] = []
        key, number = None, -1
        for batch in batches:
            for lang, source, term, p in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != (lang, term):
                    if rows and (key[0] != lang or number + 1 >= BLOCK_ROWS or len(rows) >= BLOCK_CELLS):
                        yield from product(key[0], rows)
                        rows = []
                    number = number + 1 if rows else 0
                    key = lang, term
                rows.append((number, source, p))
        if rows:
            yield from product(key[0], rows)

    ordered = cells.repartition("lang", "term").sortWithinPartitions("lang", "total", "term", "source")
    found = ordered.select("lang", "source", "term", "p").mapInArrow(run, "lang string, a string, pa long, b string, pb long, terms long")
    return found.groupBy("lang", "a", "pa", "b", "pb").agg(F.sum("terms").alias("terms"))


def share(count: Column, size: Column, kept: Column) -> Column:
    """p of a term with ``count`` occurrences among ``size`` of ``kept`` terms; null without kept terms."""
    whole = F.nullif(size + kept, F.lit(0))
    in_long = F.call_function("div", PARTS * (count + 1), whole)
    in_decimal = F.call_function("div", F.lit(PARTS).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)"), whole.cast("decimal(20,0)"))
    return 1 + F.when(count < LONG_COUNT, in_long).otherwise(in_decimal.cast("long"))


def price(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """Rows (lang, source, part, item, value, rank); part is ``pair`` or ``term``."""
    staging = Staging(docs.sparkSession, "divergence")
    cells = staging.put(term_counts(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "cells")
    kept = cells.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total")).filter(F.col("docs") >= min_docs).drop("docs")
    cells = staging.put(cells.drop("docs").join(kept, ["lang", "term"]), "kept")
    staging.drop("cells")
    langs = cells.groupBy("lang", "term").agg(F.first("total").alias("total")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("all"))
    groups = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    groups = groups.join(cells.groupBy("lang", "source").agg(F.sum("n").alias("size")), ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.na.fill(0, ["size", "v", "all"])
    groups = staging.put(groups.withColumn("p0", share(F.lit(0).cast("long"), F.col("size"), F.col("v"))), "groups")
    cells = cells.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("size"), F.col("v")))

    pa, pb, a0, b0 = (F.col(c) for c in ("pa", "pb", "a0", "b0"))
    here = groups.select("lang", F.col("source").alias("a"), F.col("p0").alias("a0"), "v")
    there = groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("b0"))
    pairs = here.join(there, "lang").filter("a != b")

    def total(weight: Column, priced: Column) -> Column:
        return F.sum((weight * priced).cast(EXACT))

    def mixed(x: Column, y: Column, x0: Column, y0: Column) -> Column:
        """What a cell prices beyond the margins."""
        return price(x, y) - price(x, y0) - price(x0, y) + price(x0, y0)

    cell = joint_levels(cells).join(here.drop("v"), ["lang", "a"]).join(there, ["lang", "b"])
    cell = cell.groupBy("lang", "a", "b").agg(total(F.col("terms"), mixed(pa, pb, a0, b0)).alias("there"), total(F.col("terms"), mixed(pb, pa, b0, a0)).alias("back"))
    cell = cell.select("lang", F.explode(F.array(F.struct("a", "b", F.col("there").alias("value")), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("back").alias("value")))).alias("x")).select("lang", "x.*")
    margins = staging.put(cells.groupBy("lang", "source", "p").agg(F.count("*").alias("terms")), "margins")
    ours = margins.select("lang", F.col("source").alias("a"), F.col("p").alias("pa"), "terms").join(pairs, ["lang", "a"])
    ours = ours.groupBy("lang", "a", "b").agg(total(F.col("terms"), price(pa, b0) - price(a0, b0)).alias("value"))
    theirs = margins.select("lang", F.col("source").alias("b"), F.col("p").alias("pb"), "terms").join(pairs, ["lang", "b"])
    theirs = theirs.groupBy("lang", "a", "b").agg(total(F.col("terms"), price(a0, pb) - price(a0, b0)).alias("value"))
    nowhere = pairs.select("lang", "a", "b", F.coalesce(F.col("v") * price(a0, b0), F.lit(0)).cast(EXACT).alias("value"))
    priced = cell.union(ours).union(theirs).union(nowhere).groupBy("lang", "a", "b").agg(F.sum("value").cast("long").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    by_pair = priced.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value").withColumn("rank", F.row_number().over(order))

    terms = cells.withColumn("q", share(F.col("total"), F.col("all"), F.col("v"))).filter("p > q")
    by_term = terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), price(F.col("p"), F.col("q")).cast("long").alias("value"))
    return by_pair.union(by_term.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_terms))


#: The query in DuckDB, priced term by term.
SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text, row_number() OVER () AS r FROM documents),
occ AS MATERIALIZED (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS total FROM occ GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS n FROM kept GROUP BY lang),
cell AS MATERIALIZED (SELECT lang, source, term, count(*)::HUGEINT AS n FROM occ JOIN kept USING (lang, term) GROUP BY ALL),
grp AS MATERIALIZED (
    SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce((SELECT sum(n) FROM cell c WHERE c.lang = g.lang AND c.source = g.source), 0)::HUGEINT AS n
    FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN langs USING (lang)),
p AS MATERIALIZED (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.n + g.v) AS p,
           1 + (1000000000::HUGEINT * (k.total + 1)) // (l.n + l.v) AS q
    FROM grp g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN cell c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pair AS (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source != y.source GROUP BY ALL),
whole AS (
    SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM grp g JOIN grp h ON g.lang = h.lang AND g.source != h.source LEFT JOIN pair ON pair.lang = g.lang AND pair.source = g.source AND pair.item = h.source
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank FROM whole)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
