"""End to end: delimited extracts → bronze → silver → gold, written and checked."""
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sample_tables import SF0001
from otif.model import BINDING_PARAMS, SPECS
from otif.operators import checks
from otif.plans import release
from otif.plans.pipeline import run_from_folder, run_pipeline
from otif.plans.registry import QUERIES
from otif.sources.bindings import bronze_extracts
from otif.sources.csv import read_extracts, write_extract


@pytest.fixture(scope="module")
def landing(spark):
    folder = tempfile.mkdtemp(prefix="otif-landing-")
    for name, frame in bronze_extracts(spark, SF0001).items():
        cols = [c for c in frame.columns if not c.startswith("_")]
        write_extract(frame.select(*cols), os.path.join(folder, SPECS[name].source_file))
    return folder


def test_extract_contract_is_checked_before_reading(spark, landing, tmp_path):
    frames = read_extracts(spark, landing)
    assert set(frames) == set(SPECS)
    assert all({"_source_file", "_loaded_at"} <= set(f.columns) for f in frames.values())


def test_pipeline_publishes_checked_results(spark, landing):
    out = tempfile.mkdtemp(prefix="otif-out-")
    result = run_from_folder(spark, landing, out, BINDING_PARAMS)
    checks = {r.check_name: r.status for r in result.read(spark, "invariant_checks").collect()}
    assert len(checks) == 9 and set(checks.values()) == {"PASS"}, checks
    summary = result.read(spark, "silver_load_summary").collect()
    assert len(summary) == len(SPECS) and all(r.is_reconciled for r in summary)
    # Partitioned by month: month filters prune directories.
    assert any(p.startswith("report_month=") for p in os.listdir(result.tables["schedule_line_performance"]))
    worst = result.read(spark, "worst_suppliers")
    assert {"supplier_id", "worst_supplier_rank", "branch_mapping_status", "as_of_date"} <= set(worst.columns)
    # Same ranking as the in-memory registered query on the same tables.
    mem = QUERIES["worst_suppliers"](spark, SF0001).select(
        "report_month", "scope", "WERKS", "LIFNR", "worst_rank").collect()
    pub = worst.select(F.col("report_month").cast("string"), "report_scope", "branch_code", "supplier_id",
                       F.col("worst_supplier_rank").cast("long")).collect()
    assert sorted(map(tuple, mem), key=str) == sorted(map(tuple, pub), key=str)
    statuses = {r.branch_mapping_status for r in result.read(spark, "supplier_monthly")
                .select("branch_mapping_status").distinct().collect()}
    assert statuses == {"MAPPED", "UNMAPPED", "NOT_APPLICABLE"}


def stopped(self):
    raise KeyboardInterrupt


def published(spark, out):
    now = release.manifest(spark, out)
    return now["run"], {n: release.table(spark, out, n).count() for n in ("bronze_lips", "gold_worst_suppliers")}


def test_a_failed_run_leaves_the_published_one(spark, landing, monkeypatch):
    out = tempfile.mkdtemp(prefix="otif-out-")
    bronze = {name: frame.limit(40) for name, frame in read_extracts(spark, landing).items()}
    run_pipeline(spark, bronze, out, BINDING_PARAMS)
    before = published(spark, out)
    listed = release.manifest(spark, out)["tables"]
    assert all(listed[n]["rows"] == release.table(spark, out, n).count() for n in ("bronze_eket", "gold_quality_summary"))

    bad = {**bronze, "lips": bronze["lips"].withColumn("LFIMG", F.raise_error(F.lit("bad line")).cast("string"))}
    with pytest.raises(Exception, match="bad line"):  # the last extract fails after seven tables were written
        run_pipeline(spark, bad, out, BINDING_PARAMS)
    monkeypatch.setattr(release.Release, "publish", stopped)
    with pytest.raises(KeyboardInterrupt):  # stopped just before the switch
        run_pipeline(spark, bronze, out, BINDING_PARAMS)
    monkeypatch.undo()
    assert published(spark, out) == before

    lost = release.Release(spark, out)  # a driver that died: its folder stays, unpublished
    lost.write(spark.range(3), "x", "bronze")
    assert published(spark, out) == before
    assert release.sweep(spark, out) == [lost.run] and published(spark, out) == before


def test_a_partition_has_one_file_unless_it_is_large(spark):
    out = tempfile.mkdtemp(prefix="otif-out-")
    run = release.Release(spark, out)
    rows = spark.range(9000).repartition(8).select("id", (F.col("id") % 3).alias("m"))
    run.write(rows, "x", "gold", "m")
    files = {d: [f for f in os.listdir(f"{run.folder}/gold/x/{d}") if f.endswith(".parquet")]
             for d in os.listdir(f"{run.folder}/gold/x") if d.startswith("m=")}
    assert {d: len(f) for d, f in files.items()} == {"m=0": 1, "m=1": 1, "m=2": 1}
    empty = run.write(rows.filter("id < 0"), "y", "gold", "m", evens=F.count_if(F.col("id") % 2 == 0))
    assert empty.columns == ["id", "m"] and run.metric("gold_y", "evens") == 0
    run.publish()
    assert release.table(spark, out, "gold_x").count() == 9000


def test_lost_files_are_not_published(spark):
    out = tempfile.mkdtemp(prefix="otif-out-")
    run = release.Release(spark, out)
    run.write(spark.range(100).repartition(4), "x", "bronze")
    folder = os.path.join(run.folder, "bronze", "x")
    part = next(f for f in sorted(os.listdir(folder)) if f.startswith("part-"))
    os.replace(os.path.join(folder, part), os.path.join(out, "elsewhere"))
    with pytest.raises(ValueError, match="rows were written"):
        run.publish()
    with pytest.raises(ValueError, match="nothing was published"):
        release.manifest(spark, out)


def test_rows_are_counted_once_when_tasks_are_retried(spark):
    run = release.Release(spark, tempfile.mkdtemp(prefix="otif-out-"))
    back = run.write(spark.range(1000).repartition(8), "x", "gold", evens=F.count_if(F.col("id") % 2 == 0))
    assert back.count() == 1000 and run.tables["gold_x"]["rows"] == 1000 and run.metric("gold_x", "evens") == 500


@pytest.mark.parametrize("table", list(checks.UNCONSERVED))
def test_lost_quantity_stops_the_run(spark, table):
    columns = "allocated_quantity decimal(38,6), unallocated_quantity decimal(38,6), schedule_quantity decimal(38,6)"
    rows = {"delivery_allocations": (Decimal(0), None, None), "delivery_allocation_balance": (None, Decimal(-1), None),
            "schedule_line_performance": (Decimal(2), None, Decimal(1))}
    run = release.Release(spark, tempfile.mkdtemp(prefix="otif-out-"))
    frame = spark.createDataFrame([rows[table]], columns)
    run.write(frame, table, "gold", violations=F.count_if(F.expr(checks.UNCONSERVED[table])))
    with pytest.raises(ValueError, match="not conserved"):
        checks.assert_conserved({table: run.metric(f"gold_{table}", "violations")})
    checks.assert_conserved({table: 0})


def test_branch_mapping_guard(spark):
    def branches(*codes):
        return spark.createDataFrame([(c, "name") for c in codes], "WERKS string, BRANCH_NAME string")

    checks.assert_branch_mapping(0, branches("1", "2"))
    for quarantined, frame in ((1, branches("1")), (0, branches()), (0, branches("1", "1"))):
        with pytest.raises(ValueError, match="branch mapping"):
            checks.assert_branch_mapping(quarantined, frame)
