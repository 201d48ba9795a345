"""Rows of a key that is not crowded move once: validation, FIFO, results read once (F3..F9 of round 3)."""
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from otif.operators import fifo, quality, references
from otif.plans.gold import Gold
from otif.plans.registry import PARAMS, context
from otif.session import sized_shuffles
from sample_tables import SF0001


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _sides(spark, hot: int):
    """Ten small keys and, where ``hot`` is not 0, one with that many rows on both sides."""
    sizes = {**{f"k{i}": i for i in range(10)}, "hot": hot}
    plans = [(k, i, Decimal(1 + (i * 7) % 5)) for k, n in sizes.items() for i in range(n)]
    deliveries = [(k, i, Decimal(1 + (i * 3) % 4)) for k, n in sizes.items() for i in range(n + 1 if n else 0)]
    return (spark.createDataFrame([*plans, (None, 0, Decimal(1))], "k string, p int, pq decimal(38,6)"),
            spark.createDataFrame([*deliveries, (None, 0, Decimal(1))], "k string, d int, dq decimal(38,6)"), plans, deliveries)


def _expected(plans, deliveries):
    def tiled(rows):
        ends, out = {}, []
        for k, i, q in rows:
            out.append((k, i, ends.get(k, 0), ends.get(k, 0) + q))
            ends[k] = ends.get(k, 0) + q
        return out
    return sorted((k, i, j, min(b, d) - max(a, c)) for k, i, a, b in tiled(plans) for m, j, c, d in tiled(deliveries)
                  if k == m and min(b, d) > max(a, c))


@pytest.mark.parametrize("hot", [0, 300])
def test_allocations_of_small_and_crowded_keys(spark, hot):
    left, right, plans, deliveries = _sides(spark, hot)
    out = fifo.allocate(left, right, ["k"], ["p"], ["d"], "pq", "dq", slices=4 if hot else 1)
    assert sorted((r.k, r.p, r.d, r.allocated_quantity) for r in out.collect()) == _expected(plans, deliveries)


def test_small_keys_are_allocated_after_one_shuffle(spark):
    left, right, *_ = _sides(spark, 0)
    plan = physical(fifo.allocate(left, right, ["k"], ["p"], ["d"], "pq", "dq", slices=1))
    assert plan.count("hashpartitioning") == 1 and "Join" not in plan, plan


def _delivery_lines(spark):
    fields = "MANDT, VBELN, POSNR, EBELN, EBELP, MATNR, LFIMG, MEINS, WERKS"
    rows = [("300", f"v{i % 7}" if i % 3 else "hot", f"{i}", f"e{i % 11}", "10", "m", f"{i}", "st", "2000") for i in range(60)]
    rows += [rows[5], rows[5], ("300", "v1", " 1 ", "e1", "10", "m", "x", "st", "2000"), ("300", " ", "1", "e1", "10", "m", "1", "st", "2000"),
             ("300", "v2", "", "e2", None, "n", "1", "kg", "2100"), ("300", None, None, None, "10", "m", "1", "st", "2000")]
    bronze = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in fields.split(", "))).withColumns(
        {"_source_file": F.lit("a"), "_loaded_at": F.lit("2026-01-01").cast("timestamp")})
    parents = {
        "ekpo": spark.createDataFrame([("300", f"e{i}", "10", "m", "ST", "2000") for i in range(9)], "MANDT string, EBELN string, EBELP string, MATNR string, MEINS string, WERKS string"),
        "likp": spark.createDataFrame([("300", v, "s", "2000") for v in ("hot", "v1", "v2", "v3")], "MANDT string, VBELN string, LIFNR string, WERKS string"),
        "ekko": spark.createDataFrame([("300", f"e{i}", f"s{'' if i % 2 else 't'}") for i in range(10)], "MANDT string, EBELN string, LIFNR string")}
    return bronze, parents


def test_crowded_and_incomplete_keys_are_validated_like_others(spark, monkeypatch):
    bronze, parents = _delivery_lines(spark)

    def found():
        rows = quality.validate("lips", bronze, parents).rows.drop("_processed_at")
        return sorted(r.j for r in rows.select(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}).alias("j")).collect())

    known = references.frequent_keys
    monkeypatch.setattr(references, "frequent_keys", lambda child, refs, value=F.col, partitions=None: known(child, refs, value, 5))
    split = found()
    monkeypatch.setattr(references, "frequent_keys", lambda child, refs, *_: {r.label: {} for r in refs})
    assert found() == split and len(split) == 64
    assert sum("UNRESOLVED_REFERENCE:delivery" in j for j in split) == sum(1 for i in range(60) if i % 3 and i % 7 not in (1, 2, 3)) + 2


def test_delivery_lines_move_twice(spark, monkeypatch):
    bronze, parents = _delivery_lines(spark)
    monkeypatch.setattr(references, "frequent_keys", lambda child, refs, *_: {r.label: {} for r in refs})
    monkeypatch.setattr(quality.versions, "few_files", lambda _: ["a"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with sized_shuffles(spark):
            plan = physical(quality.validate("lips", bronze.filter("VBELN is not null"), parents).rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moves = [line for line in plan.splitlines() if "hashpartitioning(" in line]
    # Once by delivery, once by order; each parent once; rows without a delivery number by record and by key.
    assert sum("_key_VBELN" in line for line in moves) == 1, plan
    assert sum("EBELN" in line and "_salt_order" in line for line in moves) == 3, plan  # the lines, the orders, the order items
    assert not any("_salt_delivery" in line or "_salt_order_item" in line for line in moves), plan


def test_what_is_read_once_is_not_written(spark):
    ctx = context(spark, SF0001)
    written = []

    def stage(frame, name):
        written.append(name)
        return ctx.stager(frame, f"test_{name}")

    gold = Gold(ctx.staged_bronze, ctx.silver, PARAMS, stage=stage)
    rows = gold.worst.count()
    assert {"gold_schedule_performance", "gold_item_performance", "gold_item_population"}.isdisjoint(written)
    _ = gold.schedule_performance
    assert written.count("gold_schedule_performance") == 1 and gold.worst.count() == rows
