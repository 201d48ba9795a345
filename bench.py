"""Benchmark: headline operators and the end-to-end pipeline at ``$BENCH_SF_DIR``.

Prints one JSON line. Each operator is timed from its own staged inputs (the
stage writes happen outside the timed region), so a number measures that
operator's work; ``pipeline`` times raw tables → all silver and gold stages.
Every timing executes the full plan (``noop`` sink) and is the median of
``$BENCH_REPEAT`` warm runs (the end-to-end pipeline: ``$BENCH_PIPELINE_REPEAT``).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from otif.model import ITEM_KEY, BINDING_PARAMS  # noqa: E402
from otif.operators import fifo, metrics, ranking  # noqa: E402
from otif.plans import profile_queries  # noqa: E402
from otif.plans.registry import Context, q_version_resolution  # noqa: E402
from otif.plans.silver import run_silver  # noqa: E402
from otif.plans.stage import Stager  # noqa: E402
from otif.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))
PIPELINE_REPEAT = int(os.environ.get("BENCH_PIPELINE_REPEAT", "1"))
WARMUP_DIR = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
PARAMS = BINDING_PARAMS


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeat: int | None = None) -> float:
    runs = []
    for _ in range(repeat or REPEAT):
        t = time.perf_counter()
        fn()
        runs.append(time.perf_counter() - t)
    return round(statistics.median(runs), 3)


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(app_name="otif-bench", master=f"local[{cpus}]", partitions=8, driver_memory="16g")
    times: dict[str, float] = {}

    def pipeline(sf_dir=SF_DIR):
        ctx = Context(spark, sf_dir)
        g = ctx.gold
        for frame in (g.schedule_performance, g.balance, g.monthly, g.worst, g.quality, ctx.silver.summary):
            run(frame)

    if os.path.isdir(WARMUP_DIR):
        pipeline(WARMUP_DIR)  # JIT and code generation warm-up on the smallest tables, not timed
    times["pipeline"] = timed(pipeline, repeat=PIPELINE_REPEAT)

    # Stage once for the per-operator timings.
    ctx = Context(spark, SF_DIR)
    g = ctx.gold
    plans = metrics.fifo_plans(g.schedule_candidates)
    dels = metrics.fifo_deliveries(g.deliveries, PARAMS.as_of)
    alloc = g.allocations
    sp = g.schedule_performance
    monthly = Stager(spark)(g.monthly, "bench_monthly")

    times["fifo_allocation"] = timed(lambda: run(fifo.allocate(
        plans, dels, keys=ITEM_KEY, plan_order=["EINDT", "ETENR"], delivery_order=["WADAT_IST", "VBELN", "POSNR"],
        plan_qty="schedule_quantity", delivery_qty="LFIMG")))
    hot_plans = plans.select("MANDT", "WERKS", "EBELN", "EBELP", "ETENR", "EINDT", "schedule_quantity")
    hot_dels = g.deliveries.filter(F.col("WADAT_IST") <= F.lit(PARAMS.as_of)).select(
        "MANDT", "WERKS", "VBELN", "POSNR", "WADAT_IST", "LFIMG")
    times["fifo_allocation_hot_keys"] = timed(lambda: run(fifo.allocate(
        hot_plans, hot_dels, keys=["MANDT", "WERKS"], plan_order=["EINDT", "EBELN", "ETENR"],
        delivery_order=["WADAT_IST", "VBELN", "POSNR"], plan_qty="schedule_quantity", delivery_qty="LFIMG")))
    times["schedule_performance"] = timed(lambda: run(
        metrics.schedule_performance(g.schedule_candidates, alloc, PARAMS.as_of)))
    times["supplier_monthly"] = timed(lambda: run(metrics.supplier_monthly(sp, PARAMS.as_of, PARAMS.min_items)))
    times["worst_suppliers"] = timed(lambda: run(ranking.worst_suppliers(monthly)))

    def silver_only():
        s = run_silver(ctx.bronze, stage=Stager(spark))
        run(s.quarantine.select("source_table", F.explode("_dq_errors").alias("r")).groupBy("source_table", "r").count())

    times["dq_reason_counts"] = timed(silver_only)
    times["version_resolution"] = timed(lambda: run(q_version_resolution(spark, SF_DIR)))
    if "profile_relations" in profile_queries.PROFILE_QUERIES:
        times["profile_relations"] = timed(lambda: run(profile_queries.PROFILE_QUERIES["profile_relations"](spark, SF_DIR)))

    total = round(sum(times.values()), 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "otif_headline_total", "value": total, "unit": "sec", "queries": times,
                      "sf": sf, "repeat": REPEAT, "pipeline_repeat": PIPELINE_REPEAT, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
