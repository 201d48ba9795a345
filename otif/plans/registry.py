"""Registered queries over the shared tables (see README, "Registered queries").

Every query derives the raw extracts from the given tables with Spark, runs the
real silver/gold operators over all rows and returns a frame whose values are
comparable across engines: decimals as doubles rounded to 6 digits, dates as
ISO text, reason arrays joined with ``,``; write times are left out.

Silver and gold stages are written once per session and state of the input folder
to the shared checkpoint folder and reused by later queries of the same session.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from otif.functions import normalise, normalise_code, parse_date, parse_number
from otif.functions.reasons import has_reasons, reasons
from otif.model import BINDING_PARAMS, ITEM_KEY, SCHEDULE_KEY, SPECS, VERSION_COLUMN, Reference
from otif.operators import access, checks, datasets, listing, references, review, versions
from otif.operators import fifo as fifo_ops
from otif.operators import metrics as m
from otif.plans import release
from otif.plans.gold import Gold
from otif.plans.silver import Silver, run_silver
from otif.plans.stage import Staged, Stager
from otif.session import PARTITION_BYTES
from otif.sources import csv
from otif.sources.bindings import TABLES, bronze_extracts

PARAMS = BINDING_PARAMS
#: Compressed bytes of the largest shuffle for each byte of the given tables, rounded up (366 MB for 89 MB at 10 times sf0.1).
SHUFFLED = 5
REVIEW_BRANCH, REVIEW_ITEM = "2100", "00010"


@dataclass
class Context:
    spark: SparkSession
    sf_dir: str
    table_bytes: int = 0

    @cached_property
    def stager(self) -> Stager:
        return Stager(self.spark, partitions=-(-SHUFFLED * self.table_bytes // PARTITION_BYTES))

    @cached_property
    def bronze(self) -> dict[str, DataFrame]:
        return bronze_extracts(self.spark, self.sf_dir)

    @cached_property
    def staged_bronze(self) -> Staged:
        """The extracts for work that reads them several times: each is built once."""
        return Staged(self.bronze, self.stager, "bronze")

    @cached_property
    def silver(self) -> Silver:
        return run_silver(self.staged_bronze, stage=self.stager)

    @cached_property
    def gold(self) -> Gold:
        return Gold(self.staged_bronze, self.silver, PARAMS, stage=self.stager)

    def published(self, frame: DataFrame) -> DataFrame:
        return datasets.publish(frame, self.gold.branches, PARAMS.as_of)

    @property
    def pub_monthly(self) -> DataFrame:
        """For work that reads it once; others ask for ``pub_schedules`` before, which writes what it is made of."""
        return self.published(self.gold.monthly)

    def read_again(self) -> Context:
        """Itself, with the plans' results written: for work that reads the monthly ones several times."""
        _ = self.pub_schedules
        return self

    @property
    def pub_worst(self) -> DataFrame:
        return self.published(self.gold.worst)

    @cached_property
    def pub_schedules(self) -> DataFrame:
        return self.published(self.gold.schedule_performance)

    @cached_property
    def order_items(self) -> DataFrame:
        s = self.silver
        return datasets.purchase_order_items(s.valid("ekpo"), s.valid("ekko"), s.valid("lfa1"))


_CONTEXTS: dict[tuple[str, str], tuple[tuple, Context]] = {}


def input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Number of table files, a hash of their names, sizes and times in any order, and the size of those bound to extracts (no content is read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(sf_dir)
    seen = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    bound = F.col("path").rlike(rf"/({'|'.join(TABLES)})\.parquet(/|$)")
    return tuple(files.agg(F.count(F.lit(1)), F.sum(seen), F.coalesce(F.sum(F.when(bound, F.col("length"))), F.lit(0))).first())


def context(spark: SparkSession, sf_dir: str) -> Context:
    """The staged context of this session and input folder (rebuilt for a new session or changed files)."""
    folder = sf_dir.rstrip("/")
    key, state = (spark.sparkContext.applicationId, folder), input_state(spark, folder)
    known, ctx = _CONTEXTS.get(key, (None, None))
    if ctx is None or known != state or ctx.spark is not spark:
        ctx = Context(spark, folder, state[2])
        _CONTEXTS[key] = state, ctx
    return ctx


def comparable(frame: DataFrame, drop: tuple[str, ...] = ("processed_at", "_processed_at", "_bronze_loaded_at",
                                                          "_loaded_at", "last_written_at")) -> DataFrame:
    """Engine-neutral value shapes for the oracle comparison."""
    cols: list[Column] = []
    for f in frame.schema.fields:
        if f.name in drop:
            continue
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, T.DecimalType):
            c = F.round(c, 6).cast("double")
        elif isinstance(t, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(t, T.DateType):
            c = c.cast("string")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            continue
        elif isinstance(t, T.ArrayType):
            c = F.array_join(c, ",")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return frame.select(*cols)


# --------------------------------------------------------------------------- silver-level queries

def q_normalise_text(spark, sf):
    raw = context(spark, sf).bronze["ekpo"]
    fields = [c for c in raw.columns if not c.startswith("_")]
    return comparable(raw.select(*[normalise_code(c).alias(c) for c in fields]))


def _text_columns(ctx: Context, kind: str) -> DataFrame:
    parts = []
    for name, spec in SPECS.items():
        for col in getattr(spec, kind):
            parts.append(ctx.bronze[name].select(F.lit(name).alias("source_table"), F.lit(col).alias("column_name"),
                                                 normalise(col).alias("value_text")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_parse_dates(spark, sf):
    rows = _text_columns(context(spark, sf), "dates")
    parsed = parse_date("value_text")
    return comparable(rows.select("*", parsed.alias("parsed_date"),
                                  (F.col("value_text").isNotNull() & parsed.isNull()).alias("is_invalid_date")))


def q_parse_numbers(spark, sf):
    rows = _text_columns(context(spark, sf), "numbers")
    parsed = parse_number("value_text")
    positive = F.col("column_name").isin("MENGE", "LFIMG")
    rules = [(F.col("value_text").isNotNull() & F.col("parsed_value").isNull(), "INVALID_NUMBER"),
             (F.col("parsed_value") < 0, "NEGATIVE_NUMBER"),
             (positive & (F.col("parsed_value") == 0), "ZERO_QUANTITY")]
    return comparable(rows.withColumn("parsed_value", parsed).withColumn("number_issues", reasons(rules)))


def _reason_rows(ctx: Context) -> DataFrame:
    q = ctx.silver.quarantine
    return q.select("source_table", F.explode("_dq_errors").alias("reason"))


def q_dq_missing(spark, sf):
    rows = _reason_rows(context(spark, sf)).filter(F.col("reason").startswith("MISSING:"))
    return rows.groupBy("source_table", "reason").agg(F.count(F.lit(1)).alias("rows"))


def q_dq_reason_counts(spark, sf):
    return _reason_rows(context(spark, sf)).groupBy("source_table", "reason").agg(F.count(F.lit(1)).alias("rows"))


def q_valid_rejected_split(spark, sf):
    v = context(spark, sf).silver.validated["ekpo"].frame
    return comparable(v.select(*ITEM_KEY, (~has_reasons("_dq_errors")).alias("is_valid"),
                               F.col("_is_deleted").alias("is_deleted"), F.col("_dq_errors").alias("dq_errors")))


def q_raw_record_json(spark, sf):
    q = context(spark, sf).silver.quarantine
    read = q.select("source_table", "candidate_key", F.col("_raw_record").alias("raw_record"),
                    F.json_tuple("_raw_record", *ITEM_KEY).alias(*ITEM_KEY))
    return read.select("source_table", "candidate_key", "raw_record", *[normalise(c).alias(f"recovered_{c}") for c in ITEM_KEY])


def q_dedupe_exact(spark, sf):
    ctx = context(spark, sf)
    raw = ctx.bronze["eket"]
    fields = [c for c in raw.columns if not c.startswith("_")]
    out = versions.collapse_duplicates(raw, fields)
    return comparable(out.select(*fields, F.col("_source_occurrences").alias("source_occurrences"),
                                 F.col("_source_files").alias("source_files")))


def q_key_conflicts(spark, sf):
    raw = context(spark, sf).bronze["eket"]
    fields = [c for c in raw.columns if not c.startswith("_")]
    key = list(SPECS["eket"].key)
    norm = raw.select(*fields).distinct().select(*[normalise_code(c).alias(c) for c in fields])
    counts = norm.groupBy(*key).agg(F.count(F.lit(1)).alias("key_variants"))
    return comparable(counts.filter("key_variants > 1"))


def q_version_resolution(spark, sf):
    raw = context(spark, sf).bronze["ekko"]
    fields = [c for c in raw.columns if not c.startswith("_")]
    key = list(SPECS["ekko"].key)
    norm = (raw.select(*fields).distinct()
            .select(*[normalise_code(c).alias(c) for c in key], parse_date(normalise(VERSION_COLUMN)).alias(VERSION_COLUMN)))
    facts = versions.version_facts(norm, key, VERSION_COLUMN)
    can = (F.col("_dated_variants") == F.col("_key_variants")) & (F.col("_latest_variants") == 1)
    return comparable(facts.filter("_key_variants > 1").select(
        *key, F.col("_key_variants").alias("key_variants"), F.col("_dated_variants").alias("dated_variants"),
        F.col("_latest_version").alias("latest_aedat"), F.col("_latest_variants").alias("latest_variants"),
        can.alias("can_resolve")))


def q_superseded_records(spark, sf):
    s = context(spark, sf).silver.superseded
    return comparable(s.select("source_table", "candidate_key", F.col("_raw_record").alias("raw_record"),
                               F.col("_source_occurrences").alias("source_occurrences"),
                               F.col("_source_files").alias("source_files"), "reference_date",
                               "selected_reference_date", "selection_rule"))


def q_reference_check(spark, sf):
    f = context(spark, sf).silver.validated["lips"].frame
    flags = {lab: F.array_contains("_dq_errors", f"UNRESOLVED_REFERENCE:{lab}") for lab in
             ("order_item", "delivery", "order")}
    return f.select("MANDT", "VBELN", "POSNR", *[c.alias(f"unresolved_{lab}") for lab, c in flags.items()])


def q_reference_check_hot_keys(spark, sf):
    """Plant lookup of all order items: a few plants are named by all of them, one by a tenth to a third."""
    ctx = context(spark, sf)
    items = ctx.silver.validated["ekpo"].frame.select(*ITEM_KEY, "WERKS")
    plant = Reference("branch_mapping", ("WERKS",), "branch", ("BRANCH_NAME",))
    salts = references.frequent_keys(items, [plant])
    found = references.lookup(items, ctx.silver.valid("branch_mapping"), plant, salts["branch"])
    return found.select(*ITEM_KEY, "WERKS", F.coalesce(references.found_column(plant), F.lit(False)).alias("is_mapped"),
                        F.col("_ref_branch_BRANCH_NAME").alias("branch_name"))


def q_field_agreement(spark, sf):
    s = context(spark, sf).silver
    parts = []
    for name in ("ekpo", "lips"):
        v = s.validated[name]
        key = F.to_json(F.struct(*[F.col(k) for k in v.spec.key]), {"ignoreNullFields": "false"})
        parts.append(v.frame.select(F.lit(name).alias("source_table"), key.alias("candidate_key"),
                                    F.explode("_dq_errors").alias("reason")))
    rows = parts[0].unionByName(parts[1])
    return rows.filter(F.col("reason").rlike("MISMATCH"))


def q_load_summary(spark, sf):
    return comparable(context(spark, sf).silver.summary)


# --------------------------------------------------------------------------- gold-level queries

def q_fifo_allocation(spark, sf):
    return comparable(context(spark, sf).gold.allocations)


def q_fifo_allocation_hot_keys(spark, sf):
    """FIFO with one key per plant: each key holds a large share of all plans.

    A few keys hold all rows, so the split of hot keys is checked against the
    oracle on the shared tables, not only on unit fixtures.
    """
    g = context(spark, sf).gold
    plans = m.fifo_plans(g.schedule_candidates).select(
        "MANDT", "WERKS", "EBELN", "EBELP", "ETENR", "EINDT", "schedule_quantity")
    dels = (g.deliveries.filter(F.col("WADAT_IST") <= m.cutoff(PARAMS.as_of))
            .select("MANDT", "WERKS", "VBELN", "POSNR", "WADAT_IST", "LFIMG"))
    out = fifo_ops.allocate(plans, dels, keys=["MANDT", "WERKS"], plan_order=["EINDT", "EBELN", "ETENR"],
                            delivery_order=["WADAT_IST", "VBELN", "POSNR"], plan_qty="schedule_quantity",
                            delivery_qty="LFIMG")
    return comparable(out)


def q_schedule_performance(spark, sf):
    sp = context(spark, sf).gold.schedule_performance
    return comparable(sp.select(
        *SCHEDULE_KEY, "EINDT", "schedule_quantity", "LIFNR", "NAME1", "WERKS", "report_month", "evaluation_date",
        "exclusion_reasons", "is_allocatable", "is_evaluable", "allocated_quantity", "allocated_by_due_quantity",
        "allocated_by_month_end_quantity", "last_allocated_delivery_date", "on_time", "in_full", "fill_rate",
        "shortfall_qty", "completion_date", "allocation_rule", "metric_basis"))


def q_delivery_balance(spark, sf):
    return comparable(context(spark, sf).gold.balance)


def q_order_item_final_date(spark, sf):
    ip = context(spark, sf).gold.item_performance
    return comparable(ip.select(
        *ITEM_KEY, "LIFNR", "NAME1", "WERKS", "MATNR", "BEDAT", "ordered_qty", "first_due_date", "final_due_date",
        "scheduled_qty", "schedule_count", "quarantined_sources", "report_month", "evaluation_date",
        "delivered_by_due_qty", "delivered_by_month_end_qty", "exclusion_reasons", "is_evaluable", "on_time",
        "in_full", "fill_rate", "shortfall_qty", "_is_deleted"))


def q_delivery_evidence(spark, sf):
    ev = context(spark, sf).gold.delivery_evidence
    return comparable(ev.select(*ITEM_KEY, "VBELN", "POSNR", "WADAT_IST", "LFIMG", "LIFNR", "final_due_date",
                                "evaluation_date", "by_due_date", "by_month_end", "after_cutoff", "is_evaluable",
                                "exclusion_reasons"))


def q_exclusion_counts(spark, sf):
    return comparable(context(spark, sf).gold.quality)


def q_quarantine_attribution(spark, sf):
    return comparable(context(spark, sf).gold.issues)


def q_unassigned_quarantine(spark, sf):
    u = context(spark, sf).gold.unassigned
    return comparable(u.select("source_table", F.col("_raw_record").alias("raw_record"),
                               F.col("_dq_errors").alias("dq_errors")))


def q_supplier_monthly(spark, sf):
    return comparable(context(spark, sf).gold.monthly)


def q_worst_suppliers(spark, sf):
    return comparable(context(spark, sf).gold.worst)


# --------------------------------------------------------------------------- review, marts, access, checks

def q_monthly_trend(spark, sf):
    return comparable(review.monthly_trend(context(spark, sf).pub_monthly, review.ALL))


def q_month_summary(spark, sf):
    return comparable(review.month_summary(context(spark, sf).pub_monthly, REVIEW_BRANCH))


def q_selection_status(spark, sf):
    ctx = context(spark, sf).read_again()
    return comparable(review.selection_status(ctx.pub_monthly, ctx.pub_worst, review.ALL))


def q_supplier_comparison(spark, sf):
    out = review.supplier_comparison(context(spark, sf).read_again().pub_monthly, review.ALL)
    return comparable(out.select("report_month", "supplier_id", "performance_score", "evaluated_schedule_line_count",
                                 "comparison_position"))


def q_ranked_evidence(spark, sf):
    ctx = context(spark, sf)
    out = review.ranked_evidence(ctx.pub_schedules, ctx.pub_worst, review.ALL)
    return comparable(out.select("sap_client_id", "purchase_order_id", "purchase_order_item_id", "schedule_line_id",
                                 "supplier_id", "report_month", "is_evaluable", "is_on_time", "is_in_full"))


def q_drill_down(spark, sf):
    ctx = context(spark, sf)
    alloc = ctx.published(ctx.gold.allocations)
    out = review.drill_down(alloc, ["purchase_order_id", "purchase_order_item_id", "scheduled_delivery_date",
                                    "schedule_line_id", "actual_delivery_date", "delivery_id", "delivery_item_id"],
                            branch=REVIEW_BRANCH, po_number="", po_item="")
    return comparable(out)


def listed(ctx: Context, frame: DataFrame, order, name: str, *columns: str) -> DataFrame:
    """``columns`` of all rows with their positions, read from a listing written in this order."""
    path = f"{ctx.stager.path(name)}-{uuid.uuid4().hex}"
    return comparable(listing.write_listing(frame, order, path).rows().select(*columns, listing.POSITION))


def q_ranking_listing(spark, sf):
    ctx = context(spark, sf).read_again()
    return listed(ctx, review.ranking_listing(ctx.pub_worst, review.ALL), ["report_month", "worst_supplier_rank"], "ranking_listing",
                  "report_month", "worst_supplier_rank", "supplier_id", "supplier_name", "performance_score")


def q_supplier_listing(spark, sf):
    ctx = context(spark, sf).read_again()
    order = ["report_month", F.col("performance_score").asc_nulls_last(), "supplier_id"]
    return listed(ctx, review.supplier_listing(ctx.pub_monthly, review.ALL), order, "supplier_listing",
                  "report_month", "supplier_id", "performance_score", "evaluated_schedule_line_count")


def q_evidence_listing(spark, sf):
    ctx = context(spark, sf)
    out = review.ranked_evidence(ctx.pub_schedules, ctx.pub_worst, review.ALL)
    return listed(ctx, out, review.EVIDENCE_ORDER, "evidence_listing", *review.EVIDENCE_ORDER)


def q_performance_listing(spark, sf):
    ctx = context(spark, sf)
    out = ctx.pub_schedules.filter(review.optional_filters(branch=REVIEW_BRANCH))
    return listed(ctx, out, review.PERFORMANCE_ORDER, "performance_listing", *review.PERFORMANCE_ORDER, "supplier_id", "allocated_quantity")


def q_balance_listing(spark, sf):
    ctx = context(spark, sf)
    out = ctx.published(ctx.gold.balance).filter(review.optional_filters(branch=REVIEW_BRANCH))
    return listed(ctx, out, review.BALANCE_ORDER, "balance_listing", *review.BALANCE_ORDER, "unallocated_quantity", "allocation_status")


def q_item_listing(spark, sf):
    """Order items of one branch and one item number."""
    ctx = context(spark, sf)
    out = ctx.published(ctx.order_items).filter(review.optional_filters(branch=REVIEW_BRANCH, po_item=REVIEW_ITEM))
    return listed(ctx, out, review.ITEM_ORDER, "item_listing", *review.ITEM_ORDER, "supplier_id", "ordered_quantity")


def q_quality_listing(spark, sf):
    ctx = context(spark, sf)
    return listed(ctx, review.quality_listing(ctx.gold.quality), ["reason"], "quality_listing", "reason", "item_or_record_count")


def q_order_items_mart(spark, sf):
    ctx = context(spark, sf)
    return comparable(ctx.published(ctx.order_items))


def q_delivery_items_mart(spark, sf):
    ctx = context(spark, sf)
    return comparable(ctx.published(datasets.delivery_items(ctx.gold.deliveries, ctx.order_items)))


def q_schedule_lines_mart(spark, sf):
    ctx = context(spark, sf)
    return comparable(ctx.published(datasets.schedule_lines(ctx.silver.valid("eket"), ctx.order_items)))


def q_branch_labels(spark, sf):
    ctx = context(spark, sf)
    return comparable(ctx.pub_monthly.select("report_month", "report_scope", "branch_code", "supplier_id",
                                             "branch_name", "branch_mapping_status"))


def q_row_filter_branch(spark, sf):
    ctx = context(spark, sf)
    policy = access.AccessPolicy(publisher="etl", branch_groups={"2000": "g_hamburg", REVIEW_BRANCH: "g_bremen"},
                                 central_group="g_central")
    viewer = access.Viewer("buyer", frozenset({"g_bremen"}))
    return comparable(access.row_filter(ctx.pub_monthly, policy, viewer))


def q_invariant_checks(spark, sf):
    ctx = context(spark, sf)
    bal = ctx.published(ctx.gold.balance)
    return checks.invariant_checks(ctx.pub_schedules.withColumnRenamed("schedule_quantity", "scheduled_quantity"),
                                   ctx.pub_monthly, bal)


def q_published_grain_check(spark, sf):
    return checks.published_grain_check(context(spark, sf).read_again().pub_monthly, PARAMS.as_of)


# --------------------------------------------------------------------------- sources and publication

def q_published_load(spark, sf):
    """Rows per table of the manifest that one all-or-nothing load of the extracts publishes."""
    root = Stager(spark).path("published_load")
    run = release.Release(spark, root)
    for name, frame in bronze_extracts(spark, sf).items():
        run.write(frame, name, "bronze")
    run.publish()
    tables = release.manifest(spark, root)["tables"]  # a row per source
    return spark.createDataFrame([(n, t["rows"]) for n, t in tables.items()], "table_name string, row_count long")


def q_quoted_line_breaks(spark, sf):
    """Order items whose descriptions hold line breaks, quotes and separators, written as an extract and read in splits."""
    items = bronze_extracts(spark, sf)["ekpo"]
    text = F.concat_ws("", F.col("TXZ01"), F.lit('\n"'), F.col("MATNR"), F.lit('";\n\n'), F.col("WERKS"))
    path = Stager(spark).path("quoted_line_breaks")
    csv.write_extract(items.select("MANDT", "EBELN", "EBELP", text.alias("TXZ01"), "MENGE"), path, one_file=False)
    return csv.read_extract(spark, path, ["MANDT", "EBELN", "EBELP", "TXZ01", "MENGE"], multiline=True).drop("_source_file", "_loaded_at")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "published_load": q_published_load,
    "quoted_line_breaks": q_quoted_line_breaks,
    "normalise_text": q_normalise_text,
    "parse_dates": q_parse_dates,
    "parse_numbers": q_parse_numbers,
    "dq_missing": q_dq_missing,
    "dq_reason_counts": q_dq_reason_counts,
    "valid_rejected_split": q_valid_rejected_split,
    "raw_record_json": q_raw_record_json,
    "dedupe_exact": q_dedupe_exact,
    "key_conflicts": q_key_conflicts,
    "version_resolution": q_version_resolution,
    "superseded_records": q_superseded_records,
    "reference_check": q_reference_check,
    "reference_check_hot_keys": q_reference_check_hot_keys,
    "field_agreement": q_field_agreement,
    "load_summary": q_load_summary,
    "fifo_allocation": q_fifo_allocation,
    "fifo_allocation_hot_keys": q_fifo_allocation_hot_keys,
    "schedule_performance": q_schedule_performance,
    "delivery_balance": q_delivery_balance,
    "order_item_final_date": q_order_item_final_date,
    "delivery_evidence": q_delivery_evidence,
    "exclusion_counts": q_exclusion_counts,
    "quarantine_attribution": q_quarantine_attribution,
    "unassigned_quarantine": q_unassigned_quarantine,
    "supplier_monthly": q_supplier_monthly,
    "worst_suppliers": q_worst_suppliers,
    "monthly_trend": q_monthly_trend,
    "month_summary": q_month_summary,
    "selection_status": q_selection_status,
    "supplier_comparison": q_supplier_comparison,
    "ranked_evidence": q_ranked_evidence,
    "drill_down": q_drill_down,
    "ranking_listing": q_ranking_listing,
    "supplier_listing": q_supplier_listing,
    "evidence_listing": q_evidence_listing,
    "performance_listing": q_performance_listing,
    "balance_listing": q_balance_listing,
    "item_listing": q_item_listing,
    "quality_listing": q_quality_listing,
    "order_items_mart": q_order_items_mart,
    "delivery_items_mart": q_delivery_items_mart,
    "schedule_lines_mart": q_schedule_lines_mart,
    "branch_labels": q_branch_labels,
    "row_filter_branch": q_row_filter_branch,
    "invariant_checks": q_invariant_checks,
    "published_grain_check": q_published_grain_check,
}

