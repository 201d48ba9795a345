"""Parent lookups and field agreement rules (DQ-8..12, JN-1).

A lookup attaches the unique *valid* parent of every child row, so an absent and a
quarantined parent both yield ``UNRESOLVED_REFERENCE``. Any parent may be named by a
third of all children, and as many children may name none, so the join is salted:

* ``frequent_keys`` counts the key hashes of all lookups of a child table in one
  aggregation with a mergeable frequent-items sketch; a key with more than an even
  share of a shuffle partition gets salts in proportion to its share;
* ``lookup`` sends a child of such a key to one of its salts, by the hash of the whole
  row, and the parent to each of them; children without a key spread over all
  partitions. The salts of all keys together are at most four times the partitions, so
  the parents grow by no more than that, and no result depends on the salts.

A sketch that over-counts a key only gives it more salts. Rows equal in all columns go
to one salt; the extracts hold none after duplicates are collapsed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from otif.model import Agreement, Reference
from otif.operators.scan import default_slices

#: Tracked keys for each shuffle partition; the sketch's error (3.5 over the tracked keys) is then under half a share.
TRACKED = 8
MOST_TRACKED = 1_000_000  # Spark's own limit

#: Number of salts → hashes of the keys that get so many.
Salts = Mapping[int, Sequence[int]]


def found_column(ref: Reference) -> str:
    return f"_ref_{ref.label}_found"


def key_hash(keys: Iterable[Column]) -> Column:
    """Hash of a complete key; null where a part is missing."""
    keys = list(keys)
    complete = F.lit(True)
    for k in keys:
        complete = complete & k.isNotNull()
    return F.when(complete, F.xxhash64(*keys))


def frequent_keys(child: DataFrame, refs: Sequence[Reference], value: Callable[[str], Column] = F.col,
                  partitions: int | None = None) -> dict[str, Salts]:
    """Per lookup label, the salts of keys that over one in ``partitions`` children name (one job).

    ``value`` gives the key column as the parent holds it, so raw extracts can be counted.
    """
    if not refs:
        return {}
    n = partitions or default_slices(child)
    hashed = child.select(*[key_hash(map(value, r.keys)).alias(r.label) for r in refs])
    tracked = min(MOST_TRACKED, TRACKED * max(n, 8))
    row = hashed.agg(F.count(F.lit(1)).alias("_rows"),
                     *[F.expr(f"approx_top_k(`{r.label}`, {min(n, tracked)}, {tracked})").alias(r.label) for r in refs]).first()
    out: dict[str, Salts] = {}
    for r in refs:
        salts: dict[int, list[int]] = {}
        for item in row[r.label] or []:
            if item["item"] is not None and item["count"] * n > row["_rows"]:
                shares = -(-item["count"] * n // row["_rows"])  # partitions' worth of rows, rounded up
                salts.setdefault(1 << (shares - 1).bit_length(), []).append(item["item"])
        out[r.label] = salts
    return out


def _salt_count(hashed: Column, salts: Salts) -> Column:
    count = F.lit(1)
    for number, hashes in salts.items():
        count = F.when(hashed.isin(list(hashes)), F.lit(number)).otherwise(count)
    return count


def lookup(frame: DataFrame, parent: DataFrame, ref: Reference, salts: Salts | None = None,
           finer: Sequence[tuple[DataFrame, Reference]] = ()) -> DataFrame:
    """Left-join a parent's key (and carried fields) as ``_ref_<label>_*`` columns.

    Children with a null key part, or whose parent is absent, keep null there. ``salts``
    is this lookup's entry of ``frequent_keys``; without it keys are not split. ``finer`` are
    parents whose keys hold this one: they are looked up where the children lie then.
    """
    salt, salts = f"_salt_{ref.label}", salts or {}
    hashed = key_hash(F.col(k) for k in ref.keys)
    count = F.when(hashed.isNull(), F.lit(default_slices(frame))).otherwise(_salt_count(hashed, salts))

    def salted(parent: DataFrame) -> DataFrame:
        return parent.withColumn(salt, F.explode(F.sequence(F.lit(0), _salt_count(hashed, salts) - 1)))

    out = frame.withColumn(salt, F.when(count > 1, F.pmod(F.xxhash64(*frame.columns), count).cast("int")).otherwise(0))
    for above, by in [(parent, ref), *finer]:
        out = attach(out, salted(above), by, salt)
    return out.drop(salt)


def attach(frame: DataFrame, parent: DataFrame, ref: Reference, salt: str = "") -> DataFrame:
    """``lookup`` of children that lie by this key, or part of it, already; ``salt`` names a column that both sides have."""
    right = parent.select(*ref.keys, *([salt] if salt else []), F.lit(True).alias(found_column(ref)),
                          *[F.col(c).alias(f"_ref_{ref.label}_{c}") for c in ref.fields])
    return frame.join(right, [*ref.keys, salt] if salt else list(ref.keys), "left")


def unmatched(frame: DataFrame, parent: DataFrame, ref: Reference) -> DataFrame:
    """``lookup`` of children without a complete key."""
    return frame.select("*", F.lit(None).cast("boolean").alias(found_column(ref)),
                        *[F.lit(None).cast(parent.schema[c].dataType).alias(f"_ref_{ref.label}_{c}") for c in ref.fields])


def unresolved_rules(refs: Iterable[Reference]) -> list[tuple[Column, str]]:
    return [(F.col(found_column(r)).isNull(), f"UNRESOLVED_REFERENCE:{r.label}") for r in refs]


def agreement_rules(rules: Iterable[Agreement]) -> list[tuple[Column, str]]:
    """Both sides present and different; a missing parent is the lookup's concern."""
    return [(F.col(a.left).isNotNull() & F.col(a.right).isNotNull() & (F.col(a.left) != F.col(a.right)),
             a.reason) for a in rules]
