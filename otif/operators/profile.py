"""Data profiler over raw string extracts (PRF-1..17, SRT-5, JN-9, JN-10).

Everything is an aggregation or an equi-join of the raw frames: per-column
profiles are one aggregate per table unpivoted with ``stack``; relationship and
agreement profiles join children to per-key parent counts; threshold studies
compute all thresholds in one aggregate and unpivot them (no cross join).
Text is compared without outer white space of any kind; a value is blank when it is
null or empty then. The profiler reads raw extracts by grammars of its own, narrower than
validation's: dates ``yyyy-MM-dd``, numbers with a decimal dot and any count of digits.
Rows of every check are tagged into one stream of issues, which ``findings`` counts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from otif.functions import parse_date
from otif.model import ITEM_KEY, SPECS, Reference
from otif.operators.references import frequent_keys, key_hash

# The published checks, grammars and thresholds of the profiler.
WHITE_SPACE = "".join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
DOT_NUMBER = r"^[+-]?[0-9]+(\.[0-9]+)?$"
WIDE = "decimal(38,18)"
RELATIONS = (
    ("ekpo", "ekko", ("MANDT", "EBELN")), ("eket", "ekpo", ITEM_KEY), ("lips", "ekpo", ITEM_KEY),
    ("lips", "likp", ("MANDT", "VBELN")), ("ekko", "lfa1", ("LIFNR",)), ("likp", "lfa1", ("LIFNR",)),
    ("ekpo", "mara", ("MATNR",)), ("lips", "mara", ("MATNR",)),
)
AGREEMENT_CHECKS = (
    ("ekpo", "mara", ("MATNR",), ("MEINS",)), ("lips", "mara", ("MATNR",), ("MEINS",)),
    ("lips", "ekpo", ITEM_KEY, ("MEINS", "MATNR", "WERKS")), ("lips", "likp", ("MANDT", "VBELN"), ("WERKS",)),
)
DISTRIBUTIONS = (("ekpo", "MEINS"), ("lips", "MEINS"), ("ekpo", "LOEKZ"), ("ekpo", "WERKS"),
                 ("likp", "WERKS"), ("lips", "WERKS"))
THRESHOLDS = (1, 5, 10, 20)


def fields(raw: DataFrame) -> list[str]:
    return [c for c in raw.columns if not c.startswith("_")]


def strip(c: str) -> Column:
    return F.trim(F.col(c), F.lit(WHITE_SPACE))


def stripped(raw: DataFrame) -> DataFrame:
    """Trimmed text with blanks as empty strings (the profiler's view of a field)."""
    return raw.select(*[F.coalesce(strip(c), F.lit("")).alias(c) for c in fields(raw)])


def iso_date(c: str) -> Column:
    """A calendar date written yyyy-MM-dd, else null."""
    return F.when(F.col(c).rlike(ISO_DATE), F.try_to_date(F.col(c), "yyyy-MM-dd"))


def sampled_date(c: str) -> Column:
    """The period studies read both date grammars of validation."""
    return parse_date(F.nullif(F.col(c), F.lit("")))


def dot_number(c: str) -> Column:
    """The value of a number with a decimal dot; null for other text and beyond 20 digits before the dot."""
    return F.when(is_number(c), F.col(c).try_cast(WIDE))


def is_number(c: str) -> Column:
    return F.col(c).rlike(DOT_NUMBER)


def is_zero(c: str) -> Column:
    return is_number(c) & ~F.col(c).rlike("[1-9]")


def is_negative(c: str) -> Column:
    return is_number(c) & F.startswith(F.col(c), F.lit("-")) & ~is_zero(c)


def blank_key(keys: Sequence[str]) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | (F.col(k) == "")
    return out


def overview(raws: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns, candidate key and rows with a blank key part per table (PRF-1, PRF-3)."""
    parts = []
    for name, raw in raws.items():
        key = SPECS[name].key
        parts.append(stripped(raw).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"),
            F.lit(len(fields(raw))).cast("long").alias("columns"),
            F.lit(", ".join(key)).alias("candidate_key"),
            F.count_if(blank_key(key)).alias("missing_key_rows")))
    return _union(parts)


def blanks(raws: Mapping[str, DataFrame]) -> DataFrame:
    """Blank and outer-whitespace rows per column, one aggregate per table (PRF-2)."""
    parts = []
    for name, raw in raws.items():
        cols = fields(raw)
        aggs = [F.count(F.lit(1)).alias("_n")]
        for c in cols:
            blank = F.coalesce(strip(c), F.lit("")) == ""
            aggs += [F.count_if(blank).alias(f"b_{c}"), F.count_if(F.col(c) != strip(c)).alias(f"w_{c}")]
        row = raw.agg(*aggs)
        pairs = ", ".join(f"'{c}', {str(c in SPECS[name].key).lower()}, `b_{c}`, `w_{c}`" for c in cols)
        parts.append(row.selectExpr(
            f"'{name}' AS table_name", "_n",
            f"stack({len(cols)}, {pairs}) AS (column_name, key_column, blank_rows, outer_whitespace_rows)"))
    out = _union(parts)
    return out.select("table_name", "column_name", "key_column", "blank_rows",
                      F.round(F.col("blank_rows") * 100.0 / F.col("_n"), 2).alias("blank_pct"),
                      "outer_whitespace_rows")


def one_row_per_key(parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``parent``, failing as soon as a key has a second row: the check of a many-to-one join, within the join's own shuffle (JN-9)."""
    keys = list(keys)
    rest = [c for c in parent.columns if c not in keys]
    grouped = parent.groupBy(*keys).agg(F.any_value(F.struct(*rest)).alias("_row"), F.count("*").alias("_rows"))
    key_text = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    second = F.raise_error(F.concat(F.lit(f"more than one row for ({', '.join(keys)}) = "), key_text)).cast("boolean")
    return grouped.filter(F.when(F.col("_rows") == 1, True).otherwise(second)).select(*keys, "_row.*")


def by_key(raw: DataFrame, key: Sequence[str], work: Callable[[DataFrame, list[str]], DataFrame]) -> DataFrame:
    """``work(rows, names)`` on the rows with their stripped key as the columns ``names``; groups by these need no further shuffle.

    The rows of a key are brought together once. Those of a key that very many rows share are left where they are, so that
    their groups are counted in part before they meet.
    """
    names = [f"_key_{k}" for k in key]
    own = Reference("", tuple(names), "own")
    keyed = raw.select(*fields(raw), *[F.coalesce(strip(k), F.lit("")).alias(n) for k, n in zip(key, names)])
    frequent = [h for hashes in frequent_keys(keyed, [own])["own"].values() for h in hashes]
    crowded = key_hash(map(F.col, names)).isin(frequent)
    near = work(keyed.filter(~crowded).repartition(*names), names)
    return near.unionByName(work(keyed.filter(crowded), names)) if frequent else near


def unique_records(raw: DataFrame, key: Sequence[str]) -> DataFrame:
    """Drop exact duplicates, then every row of a blank or repeated key (PRF-15)."""
    cols = fields(raw)

    def only(rows: DataFrame, names: list[str]) -> DataFrame:
        distinct = rows.filter(~blank_key(names)).groupBy(*names, *cols).agg(F.lit(1).alias("_one"))
        text = [F.coalesce(strip(c), F.lit("")).alias(c) for c in cols]
        single = distinct.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*cols)).alias("_row"))
        return single.filter("_n = 1").select("_row.*").select(*text)

    return by_key(raw, key, only)


def duplicates(raws: Mapping[str, DataFrame]) -> DataFrame:
    """Extra exact rows, duplicate-key and conflicting-key groups, unique records (PRF-4, PRF-15).

    Every count follows from the records of a key, so a table's rows move once.
    """
    parts = []
    for name, raw in raws.items():
        cols = fields(raw)

        def counted(rows: DataFrame, names: list[str], cols=cols) -> DataFrame:
            records = rows.groupBy(*names, *cols).agg(F.count(F.lit(1)).alias("_n"))
            text = [F.coalesce(strip(c), F.lit("")).alias(c) for c in cols]
            variants = records.select(*names, *text, "_n").groupBy(*names, *cols).agg(
                F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_records"))
            per_key = variants.groupBy(*names).agg(F.sum("_rows").alias("_rows"), F.sum("_records").alias("_records"),
                                                   F.count(F.lit(1)).alias("_variants"))
            return per_key.select("_rows", "_records", "_variants", (~blank_key(names)).alias("_whole"))

        per_key = by_key(raw, SPECS[name].key, counted)
        whole = F.col("_whole")
        parts.append(per_key.agg(
            F.lit(name).alias("table_name"),
            F.coalesce(F.sum(F.col("_rows") - F.col("_records")), F.lit(0)).cast("long").alias("exact_extra_rows_raw"),
            F.count_if(whole & (F.col("_rows") > 1)).alias("duplicate_key_groups"),
            F.count_if(whole & (F.col("_variants") > 1)).alias("conflicting_key_groups"),
            F.count_if(whole & (F.col("_records") == 1)).alias("unique_records")))
    return _union(parts)


def _per_column(raw: DataFrame, name: str, columns: Sequence[str], measures: Mapping[str, Callable[[str], Column]]) -> DataFrame:
    """One scan of a table: every measure of every column as one aggregate, a row per column."""
    row = stripped(raw).agg(*[measure(c).alias(f"{m}__{c}") for c in columns for m, measure in measures.items()])
    listed = ", ".join(f"'{c}', " + ", ".join(f"`{m}__{c}`" for m in measures) for c in columns)
    return row.selectExpr(f"'{name}' AS table_name", f"stack({len(columns)}, {listed}) AS (column_name, {', '.join(measures)})")


def _nothing(_: str) -> Column:
    return F.max(F.lit(None).cast("long"))


def dates(raws: Mapping[str, DataFrame]) -> DataFrame:
    """Missing, invalid, min and max per date column; headers changed before creation (PRF-5, PRF-6)."""
    def changed(c: str) -> Column:
        return F.count_if(iso_date(c) < iso_date("BEDAT")) if c == "AEDAT" else _nothing(c)

    measures = {"missing": lambda c: F.count_if(F.col(c) == ""),
                "invalid_nonblank": lambda c: F.count_if((F.col(c) != "") & iso_date(c).isNull()),
                "min_date": lambda c: F.min(iso_date(c)), "max_date": lambda c: F.max(iso_date(c)), "changed_before_created": changed}
    return _union([_per_column(raw, name, SPECS[name].dates, measures) for name, raw in raws.items() if SPECS[name].dates])


def numbers(raws: Mapping[str, DataFrame]) -> DataFrame:
    """Missing, invalid, negative, zero, min, max per numeric column; received above scheduled (PRF-7, PRF-8)."""
    def above(c: str) -> Column:
        return F.count_if(dot_number(c) > dot_number("MENGE")) if c == "WEMNG" else _nothing(c)

    measures = {"missing": lambda c: F.count_if(F.col(c) == ""),
                "invalid_nonblank": lambda c: F.count_if((F.col(c) != "") & ~is_number(c)),
                "negative": lambda c: F.count_if(is_negative(c)), "zero": lambda c: F.count_if(is_zero(c)),
                "min_value": lambda c: F.min(dot_number(c)), "max_value": lambda c: F.max(dot_number(c)), "received_above_scheduled": above}
    return _union([_per_column(raw, name, SPECS[name].numbers, measures) for name, raw in raws.items() if SPECS[name].numbers])


def relations(raws: Mapping[str, DataFrame]) -> DataFrame:
    """Blank, missing-parent and ambiguous-parent child rows per relation (PRF-9, JN-9).

    The parent side is reduced to one row per key with its row count before the
    join, so the join is many-to-one by construction; blank child keys never
    match (parents with a blank key part are dropped) and are counted apart.
    """
    parts = []
    for child, parent, keys in RELATIONS:
        keys = list(keys)
        p = stripped(raws[parent]).filter(~blank_key(keys)).groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_parent_rows"))
        joined = stripped(raws[child]).select(*keys).join(p, keys, "left")
        blank = blank_key(keys)
        parts.append(joined.agg(
            F.lit(f"{child.upper()}_to_{parent.upper()}").alias("relationship"),
            F.count(F.lit(1)).alias("child_rows"), F.count_if(blank).alias("blank_reference_rows"),
            F.count_if(~blank & F.col("_parent_rows").isNull()).alias("missing_parent_rows"),
            F.count_if(F.col("_parent_rows") > 1).alias("ambiguous_parent_rows")))
    return _union(parts)


def agreement(raws: Mapping[str, DataFrame]) -> DataFrame:
    """Compared / not compared / mismatched rows against unique parents (PRF-10)."""
    parts = []
    for child, parent, keys, cols in AGREEMENT_CHECKS:
        keys = list(keys)
        p = stripped(raws[parent]).filter(~blank_key(keys))
        unique_keys = p.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n = 1").select(*keys)
        right = p.join(unique_keys, keys, "left_semi").select(*keys, *[F.col(f).alias(f"_p_{f}") for f in cols])
        merged = stripped(raws[child]).select(*keys, *cols).join(right, keys, "left")
        aggs = [F.count(F.lit(1)).alias("child_rows")]
        for f in cols:
            comparable = (F.col(f) != "") & (F.coalesce(F.col(f"_p_{f}"), F.lit("")) != "")
            aggs += [F.count_if(comparable).alias(f"c_{f}"),
                     F.count_if(comparable & (F.col(f) != F.col(f"_p_{f}"))).alias(f"m_{f}")]
        pairs = ", ".join(f"'{child.upper()}_to_{parent.upper()}_{f}', c_{f}, m_{f}" for f in cols)
        parts.append(merged.agg(*aggs).selectExpr(
            "child_rows", f"stack({len(cols)}, {pairs}) AS (check, compared_rows, mismatch_rows)"))
    out = _union(parts)
    return out.select("check", "child_rows", "compared_rows",
                      (F.col("child_rows") - F.col("compared_rows")).alias("not_compared_rows"), "mismatch_rows")


def value_distribution(raws: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per trimmed value, blanks included (PRF-11)."""
    parts = [stripped(raws[t]).groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), "value", "rows")
             for t, c in DISTRIBUTIONS]
    return _union(parts)


def fanout(schedules: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Items with several schedules and several deliveries and their naive join size (PRF-12)."""
    keys = list(ITEM_KEY)
    s = stripped(schedules).groupBy(*keys).agg(F.count(F.lit(1)).alias("schedule_rows"))
    d = stripped(deliveries).groupBy(*keys).agg(F.count(F.lit(1)).alias("delivery_rows"))
    return (s.join(d, keys, "inner").filter((F.col("schedule_rows") > 1) & (F.col("delivery_rows") > 1))
            .withColumn("naive_join_rows", F.col("schedule_rows") * F.col("delivery_rows")))


def candidate_preview(raws: Mapping[str, DataFrame], as_of: dt.date) -> DataFrame:
    """Attributable active items per closed month, supplier and scope (PRF-16).

    Items with any schedule row of an ambiguous key or without a usable date are
    left out rather than given an arbitrary month.
    """
    keys = list(ITEM_KEY)
    sched_key = list(SPECS["eket"].key)
    items = unique_records(raws["ekpo"], SPECS["ekpo"].key)
    orders = unique_records(raws["ekko"], SPECS["ekko"].key).filter(F.col("LIFNR") != "")
    schedules = unique_records(raws["eket"], sched_key).withColumn("due_date", sampled_date("EINDT"))
    all_schedules = stripped(raws["eket"]).withColumn("due_date", sampled_date("EINDT"))
    flagged = all_schedules.join(schedules.select(*sched_key, F.lit(True).alias("_unique")), sched_key, "left")
    bad_items = flagged.filter(F.col("_unique").isNull() | F.col("due_date").isNull()).select(*keys).distinct()
    due = (schedules.groupBy(*keys).agg(F.max("due_date").alias("due_date"))
           .join(bad_items, keys, "left_anti"))
    cands = (items.filter((F.col("LOEKZ") == "") & (F.col("WERKS") != ""))
             .join(one_row_per_key(orders.select("MANDT", "EBELN", "LIFNR"), ["MANDT", "EBELN"]), ["MANDT", "EBELN"], "inner")
             .join(due, keys, "inner")
             .withColumn("report_month", F.trunc("due_date", "month"))
             .filter(F.col("due_date").isNotNull() & (F.last_day("report_month") <= F.lit(as_of))))
    grouped = cands.groupingSets([["report_month", "WERKS", "LIFNR"], ["report_month", "LIFNR"]],
                                 "report_month", "WERKS", "LIFNR").agg(
        F.grouping("WERKS").alias("_all"), F.count(F.lit(1)).alias("candidate_items_preview"))
    return grouped.select("report_month", F.when(F.col("_all") == 1, "ALL").otherwise("BRANCH").alias("scope"),
                          F.when(F.col("_all") == 1, F.lit("ALL")).otherwise(F.col("WERKS")).alias("WERKS"),
                          "LIFNR", "candidate_items_preview")


def threshold_study(counts: DataFrame, count_column: str, thresholds: Sequence[int] = THRESHOLDS) -> DataFrame:
    """Sample-size effect of each ranking threshold per month, scope and branch (PRF-14).

    Counts must be whole, non-negative, and one per supplier, month and scope; anything else stops the study.
    """
    counts = counts.withColumn("WERKS", F.coalesce("WERKS", F.lit("ALL")))
    counts = one_row_per_key(counts.select("report_month", "scope", "WERKS", "LIFNR", count_column), ["report_month", "scope", "WERKS", "LIFNR"])
    whole = (F.col(count_column) >= 0) & (F.col(count_column) % 1 == 0)
    counts = counts.filter(F.when(whole, True).otherwise(F.raise_error(F.lit("item counts must be whole numbers from 0 on")).cast("boolean")))
    n = F.col(count_column)
    aggs = [F.count(F.lit(1)).alias("suppliers_total"),
            F.count_if(n.between(1, 2)).alias("suppliers_with_1_or_2_items"),
            F.percentile(n, 0.5).alias("median_items"), F.min(n).cast("long").alias("min_observed"),
            F.max(n).cast("long").alias("max_observed"), F.sum(n).alias("_total")]
    for t in thresholds:
        aggs += [F.count_if(n >= t).alias(f"e_{t}"), F.coalesce(F.sum(F.when(n >= t, n)), F.lit(0)).alias(f"r_{t}")]
    per_group = counts.groupBy("report_month", "scope", "WERKS").agg(*aggs)
    pairs = ", ".join(f"{t}, e_{t}, r_{t}" for t in thresholds)
    stacked = per_group.selectExpr(
        "report_month", "scope", "WERKS", "suppliers_total", "suppliers_with_1_or_2_items", "median_items",
        "min_observed", "max_observed", "_total",
        f"stack({len(thresholds)}, {pairs}) AS (min_items, eligible_suppliers, _retained)")
    return stacked.select(
        "report_month", "scope", "WERKS", F.col("min_items").cast("long").alias("min_items"), "suppliers_total",
        "suppliers_with_1_or_2_items", "median_items", "min_observed", "max_observed", "eligible_suppliers",
        F.least(F.lit(3), F.col("eligible_suppliers")).cast("long").alias("ranking_slots"),
        F.when(F.col("_total") > 0, F.round(F.col("_retained") * 100.0 / F.col("_total"), 1))
        .alias("retained_item_pct"))


def supplier_overview(raws: Mapping[str, DataFrame]) -> DataFrame:
    """Orders, items and non-deleted items per supplier over the whole period (PRF-17, JN-10)."""
    orders = unique_records(raws["ekko"], SPECS["ekko"].key).filter(F.col("LIFNR") != "")
    items = unique_records(raws["ekpo"], SPECS["ekpo"].key).join(
        one_row_per_key(orders.select("MANDT", "EBELN", "LIFNR"), ["MANDT", "EBELN"]), ["MANDT", "EBELN"], "inner")
    vendors = unique_records(raws["lfa1"], SPECS["lfa1"].key).select("LIFNR", "NAME1")
    per_orders = orders.groupBy("LIFNR").agg(F.count(F.lit(1)).alias("orders"))
    per_items = items.groupBy("LIFNR").agg(F.count(F.lit(1)).alias("order_items"),
                                           F.count_if(F.col("LOEKZ") == "").alias("nondeleted_items"))
    out = vendors.join(per_orders, "LIFNR", "full_outer").join(per_items, "LIFNR", "full_outer")
    return out.select("LIFNR", "NAME1", *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
                                          for c in ("orders", "order_items", "nondeleted_items")])


def supplier_footer(overview: DataFrame) -> DataFrame:
    """Sum, exact median, greatest and least of each count of the overview (PRF-17); one scan, merged map-side."""
    measures = ("orders", "order_items", "nondeleted_items")
    row = overview.agg(*[f(F.col(m)).alias(f"{n}_{m}") for m in measures
                         for n, f in (("total", F.sum), ("median", F.median), ("greatest", F.max), ("least", F.min))])
    listed = ", ".join(f"'{m}', total_{m}, median_{m}, greatest_{m}, least_{m}" for m in measures)
    return row.selectExpr(f"stack({len(measures)}, {listed}) AS (measure, total, median, greatest, least)")


def order_date_range(raws: Mapping[str, DataFrame]) -> DataFrame:
    """First and last valid date of the unique orders with a supplier, and how many have none (PRF-17)."""
    orders = unique_records(raws["ekko"], SPECS["ekko"].key).filter(F.col("LIFNR") != "")
    day = sampled_date("BEDAT")
    return orders.agg(F.min(day).alias("first_date"), F.max(day).alias("last_date"), F.count_if(day.isNull()).alias("without_date"))


def issues(raws: Mapping[str, DataFrame]) -> DataFrame:
    """(check, records, example): what every check of the profiler finds (PRF-3..12), as one stream.

    A row stands for ``records`` rows of its table; the example is a record or key as JSON.
    """
    parts = []

    def tag(frame: DataFrame, checks: Mapping[str, Column], columns: Sequence[str], records: Column = F.lit(1)) -> None:
        found = F.filter(F.array(*[F.when(holds, F.lit(check)) for check, holds in checks.items()]), lambda c: c.isNotNull())
        parts.append(frame.select(F.explode(found).alias("check"), records.cast("long").alias("records"), F.to_json(F.struct(*columns)).alias("example")))

    for name, raw in raws.items():
        spec, label, key, cols = SPECS[name], name.upper(), list(SPECS[name].key), fields(raw)
        checks = {f"{label}_missing_key": blank_key(key)}
        checks |= {f"{label}_{c}_invalid_date": (F.col(c) != "") & iso_date(c).isNull() for c in spec.dates}
        checks |= {f"{label}_{c}_invalid_number": (F.col(c) != "") & ~is_number(c) for c in spec.numbers}
        checks |= {f"{label}_{c}_negative": is_negative(c) for c in spec.numbers}
        if name == "ekko":
            checks["EKKO_change_before_order_date"] = iso_date("AEDAT") < iso_date("BEDAT")
        if name == "eket":
            checks["EKET_received_above_scheduled_review"] = dot_number("WEMNG") > dot_number("MENGE")
        tag(stripped(raw), checks, cols)
        rows = F.count("*").alias("_rows")
        tag(raw.groupBy(*cols).agg(rows), {f"{label}_exact_duplicates": F.col("_rows") > 1}, cols, F.col("_rows"))
        per_key = stripped(raw).filter(~blank_key(key)).groupBy(*cols).agg(rows).groupBy(*key).agg(F.count("*").alias("_variants"), F.sum("_rows").alias("_rows"))
        tag(per_key, {f"{label}_key_conflicts": F.col("_variants") > 1}, key, F.col("_rows"))
    for child, parent, keys in RELATIONS:
        keys, label = list(keys), f"{child.upper()}_to_{parent.upper()}"
        counts = stripped(raws[parent]).filter(~blank_key(keys)).groupBy(*keys).agg(F.count("*").alias("_parents"))
        joined = stripped(raws[child]).filter(~blank_key(keys)).groupBy(*keys).agg(F.count("*").alias("_rows")).join(counts, keys, "left")
        tag(joined, {f"{label}_missing_parent": F.col("_parents").isNull(), f"{label}_ambiguous_parent": F.col("_parents") > 1}, keys, F.col("_rows"))
    for child, parent, keys, cols in AGREEMENT_CHECKS:
        keys, cols = list(keys), list(cols)
        own = stripped(raws[parent]).filter(~blank_key(keys)).groupBy(*keys).agg(F.count("*").alias("_n"), *[F.any_value(c).alias(f"_p_{c}") for c in cols])
        rows = stripped(raws[child]).filter(~blank_key(keys)).groupBy(*keys, *cols).agg(F.count("*").alias("_rows"))
        differ = {f"{child.upper()}_to_{parent.upper()}_{c}_mismatch": (F.col(c) != "") & (F.col(f"_p_{c}") != "") & (F.col(c) != F.col(f"_p_{c}")) for c in cols}
        tag(rows.join(own.filter("_n = 1"), keys), differ, [*keys, *cols], F.col("_rows"))
    many = fanout(raws["eket"], raws["lips"])
    tag(many, {"schedule_delivery_many_to_many": F.lit(True)}, many.columns)
    return _union(parts)


def issue_samples(issues: DataFrame, issue_col: str, order: Sequence[str], n: int = 8) -> DataFrame:
    """First ``n`` rows per issue in a fixed order (SRT-5); the limit is the feature."""
    w = Window.partitionBy(issue_col).orderBy(*order)
    return issues.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def findings(found: DataFrame) -> DataFrame:
    """Records per check of a stream of issues, sorted by size then name (PRF-13)."""
    return found.groupBy("check").agg(F.sum("records").alias("records")).orderBy(F.col("records").desc(), "check")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
