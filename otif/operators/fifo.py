"""FIFO allocation of delivered quantities to planned quantities (FIF-1, FIF-2, FIF-4, FIF-5).

Within one item key, plans sorted by (due date, id) and deliveries sorted by
(delivery date, ids) each tile the quantity axis ``[0, total)`` with their
cumulative intervals. A plan receives from a delivery exactly the length of
the overlap of their intervals, so one delivery can fill several plans and
several deliveries can fill one plan; excess on either side stays unallocated.

Plans and deliveries are tagged and moved together. Rows of a key meet once in one
partition (``_together``): a running sum per side gives each its interval end, and, read from
the last end to the first, the segment ending at a cut belongs to the plan and the delivery
whose ends were read last.

Rows of a key that a frequent-items sketch finds crowded (more than an even share of a
partition) are swept over many tasks (``_sweep``): running sums per key and
side give each its interval end and rank. The union of all interval ends ("cuts") per key, merged on equal positions, is scanned once
more: the segment ending at a cut belongs to the plan ranked ``#plan ends
before the cut`` and the delivery ranked ``#delivery ends before the cut``.
Two equi-joins on ``(key, rank)`` — unique on both sides, so even a hot key
spreads over all tasks — recover the pairs. Work is O((p + d) log) per key on both ways;
plans and deliveries of a key are never paired exhaustively (the tests check
the result against a brute-force pairing on small fixtures).

All quantities must be strictly positive, which the quality rules guarantee.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from otif.model import ALLOCATION_RULE, Reference
from otif.operators.references import frequent_keys, key_hash
from otif.operators.scan import running_sums, written

EXACT = "decimal(37,6)"


def _overlap_quantity() -> F.Column:
    # Cast to 37 digits so the difference keeps six fractional digits.
    return (F.least("_pend", "_dend").cast(EXACT) - F.greatest("_pstart", "_dstart").cast(EXACT))


def allocate(plans: DataFrame, deliveries: DataFrame, keys: Sequence[str],
             plan_order: Sequence[str], delivery_order: Sequence[str],
             plan_qty: str, delivery_qty: str,
             slices: int | None = None) -> DataFrame:
    """Pairs (plan, delivery) with ``allocated_quantity`` > 0.

    Output: ``keys``, the other plan columns, the other delivery columns (both
    without their quantity column) and ``allocated_quantity``. Non-key column
    names of the two inputs must not overlap.
    """
    keys = list(keys)
    plan_cols = [c for c in plans.columns if c not in keys and c != plan_qty]
    delivery_cols = [c for c in deliveries.columns if c not in keys and c != delivery_qty]
    clash = set(plan_cols) & set(delivery_cols)
    if clash:
        raise ValueError(f"plan and delivery columns overlap: {sorted(clash)}")
    both = plans.select(*keys, *plan_cols, F.lit("p").alias("_side"), F.col(plan_qty).alias("_qty")).unionByName(
        deliveries.select(*keys, *delivery_cols, F.lit("d").alias("_side"), F.col(delivery_qty).alias("_qty")),
        allowMissingColumns=True)  # a side's rows have nulls in the other's order columns, so each keeps its own order
    both = both.dropna(subset=keys)
    order = list(dict.fromkeys([*plan_order, *delivery_order]))
    salts = frequent_keys(both, [Reference("", tuple(keys), "_key")], partitions=slices)["_key"]
    crowded = key_hash(F.col(k) for k in keys).isin([h for hashes in salts.values() for h in hashes])
    pairs = _together(both.filter(~crowded) if salts else both, keys, plan_cols, delivery_cols, order)
    pairs = pairs.select(*keys, *plan_cols, *delivery_cols, _overlap_quantity().alias("allocated_quantity"))
    if not salts:
        return pairs
    swept = _sweep(both.filter(crowded), keys, plan_cols, delivery_cols, order, slices)
    return pairs.union(swept.select(*keys, *plan_cols, *delivery_cols, _overlap_quantity().alias("allocated_quantity")))


def _together(both, keys, plan_cols, delivery_cols, order):
    """The pairs of keys whose rows fit one task: one shuffle, no joins."""
    so_far = Window.partitionBy(*keys, "_side").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = both.repartition(*keys).withColumn("_end", F.sum("_qty").over(so_far))
    from_last = Window.partitionBy(*keys).orderBy(F.col("_end").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)

    def side(tag: str, columns: list[str]) -> F.Column:
        # The side's interval that holds the segment ending here: that with the smallest end not before it.
        interval = F.struct(*columns, F.col("_end").alias(f"_{tag}end"), (F.col("_end") - F.col("_qty")).alias(f"_{tag}start"))
        return F.last(F.when(F.col("_side") == tag, interval), ignorenulls=True).over(from_last)

    held = ends.select(*keys, "_side", "_end", side("p", plan_cols).alias("_p"), side("d", delivery_cols).alias("_d"))
    # Where a plan and a delivery end together the segment is the plan's row.
    once = (F.col("_side") == "p") | (F.col("_p._pend") != F.col("_end"))
    return held.filter(F.col("_p").isNotNull() & F.col("_d").isNotNull() & once).select(*keys, "_p.*", "_d.*")


def _sweep(both, keys, plan_cols, delivery_cols, order, slices):
    # Read three times (cuts, plans, deliveries), each time in part: scanned once and written.
    ends = written(running_sums(both, [*keys, "_side"], order, {"_end": F.col("_qty"), "_count": F.lit(1)},
                                slices))

    def side(tag: str, columns: list[str]) -> DataFrame:
        return ends.filter(F.col("_side") == tag).select(
            *keys, *columns, F.col("_end").alias(f"_{tag}end"), (F.col("_end") - F.col("_qty")).alias(f"_{tag}start"),
            (F.col("_count") - 1).alias(f"_{tag}rank"))

    cuts = ends.groupBy(*keys, F.col("_end").alias("_cut")).agg(
        F.count_if(F.col("_side") == "p").alias("_np"), F.count_if(F.col("_side") == "d").alias("_nd"))
    scanned = running_sums(cuts, keys, ["_cut"], {"_cp": F.col("_np"), "_cd": F.col("_nd")}, slices)
    segments = scanned.select(*keys, (F.col("_cp") - F.col("_np")).alias("_prank"),
                              (F.col("_cd") - F.col("_nd")).alias("_drank"))
    return (segments.join(side("p", plan_cols), [*keys, "_prank"], "inner")
            .join(side("d", delivery_cols), [*keys, "_drank"], "inner"))


def label_allocations(allocations: DataFrame, due: str = "EINDT") -> DataFrame:
    """Report month of the plan, rule id and inferred flag (FIF-2)."""
    return allocations.select("*", F.trunc(due, "month").alias("report_month"),
                              F.lit(ALLOCATION_RULE).alias("allocation_rule"),
                              F.lit(True).alias("is_inferred"))
