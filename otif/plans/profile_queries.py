"""Registered profiler queries and their DuckDB oracle statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from otif.model import ITEM_KEY, SPECS, BINDING_PARAMS
from otif.operators import profile
from otif.plans.oracle import RAW_FIELDS, date_sql, dbl
from otif.plans.registry import comparable, context
from otif.sources.bindings import duckdb_extract

PARAMS = BINDING_PARAMS


def _raws(spark, sf):
    return context(spark, sf).bronze


def _staged(spark, sf):
    """For queries that read a table several times."""
    return context(spark, sf).staged_bronze


PROFILE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "profile_overview": lambda spark, sf: comparable(profile.overview(_raws(spark, sf))),
    "profile_blanks": lambda spark, sf: comparable(profile.blanks(_raws(spark, sf))),
    "profile_duplicates": lambda spark, sf: comparable(profile.duplicates(_staged(spark, sf))),
    "profile_dates": lambda spark, sf: comparable(profile.dates(_raws(spark, sf))),
    "profile_numbers": lambda spark, sf: comparable(profile.numbers(_raws(spark, sf))),
    "profile_relations": lambda spark, sf: comparable(profile.relations(_staged(spark, sf))),
    "profile_agreement": lambda spark, sf: comparable(profile.agreement(_staged(spark, sf))),
    "value_distribution": lambda spark, sf: comparable(profile.value_distribution(_raws(spark, sf))),
    "profile_fanout": lambda spark, sf: comparable(profile.fanout(_raws(spark, sf)["eket"], _raws(spark, sf)["lips"])),
    "candidate_preview": lambda spark, sf: comparable(profile.candidate_preview(_staged(spark, sf), PARAMS.as_of)),
    "threshold_study": lambda spark, sf: comparable(profile.threshold_study(
        profile.candidate_preview(_staged(spark, sf), PARAMS.as_of), "candidate_items_preview")),
    "supplier_overview": lambda spark, sf: comparable(profile.supplier_overview(_staged(spark, sf))),
    "supplier_footer": lambda spark, sf: comparable(profile.supplier_footer(profile.supplier_overview(_staged(spark, sf)))),
    "order_date_range": lambda spark, sf: comparable(profile.order_date_range(_staged(spark, sf))),
    "profile_findings": lambda spark, sf: comparable(profile.findings(profile.issues(_staged(spark, sf)))),
}


# --------------------------------------------------------------------------- oracle

def _s(c: str) -> str:
    return f"coalesce({_strip(c)}, '')"


def _strip(c: str) -> str:
    """Without outer white space, restated by code point."""
    codes = (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
    return f"trim({c}, {' || '.join(f'chr({n})' for n in codes)})"


def _day(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '\\d\\d\\d\\d-\\d\\d-\\d\\d') THEN TRY_CAST({c} AS DATE) END"


def _is_number(c: str) -> str:
    return f"regexp_full_match({c}, '(\\+|-)?\\d+(\\.\\d+)?')"


def _value(c: str) -> str:
    return f"CASE WHEN {_is_number(c)} THEN TRY_CAST({c} AS DECIMAL(38,18)) END"


def _bronze() -> str:
    return "WITH " + ",\n".join(f"b_{n} AS (\n{duckdb_extract(n)}\n)" for n in SPECS) + "\n"


def _stripped(name: str) -> str:
    return "(SELECT " + ", ".join(f"{_s(c)} AS {c}" for c in RAW_FIELDS[name]) + f" FROM b_{name})"


def _blank(keys) -> str:
    return "(" + " OR ".join(f"{k} = ''" for k in keys) + ")"


def _unique(name: str) -> str:
    key = list(SPECS[name].key)
    cols = RAW_FIELDS[name]
    distinct = ("(SELECT " + ", ".join(f"{_s(c)} AS {c}" for c in cols) + " FROM (SELECT DISTINCT "
                + ", ".join(cols) + f" FROM b_{name}) d)")
    kk = ", ".join(key)
    return (f"(SELECT * FROM {distinct} u WHERE NOT {_blank(key)} AND ({kk}) IN "
            f"(SELECT ({kk}) FROM {distinct} v WHERE NOT {_blank(key)} GROUP BY {kk} HAVING count(*) = 1))")


def _oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    head = _bronze()
    q["profile_overview"] = head + " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS rows, CAST({len(RAW_FIELDS[n])} AS BIGINT) AS columns, "
        f"'{', '.join(SPECS[n].key)}' AS candidate_key, count(*) FILTER (WHERE {_blank(SPECS[n].key)}) AS missing_key_rows "
        f"FROM {_stripped(n)} s" for n in SPECS)
    parts = []
    for n in SPECS:
        for c in RAW_FIELDS[n]:
            parts.append(
                f"SELECT '{n}' AS table_name, '{c}' AS column_name, {str(c in SPECS[n].key).lower()} AS key_column, "
                f"count(*) FILTER (WHERE {_s(c)} = '') AS blank_rows, "
                f"{dbl(f'round(CAST(CAST(count(*) FILTER (WHERE {_s(c)} = {chr(39)}{chr(39)}) * 100.0 / count(*) AS VARCHAR) AS DECIMAL(38,18)), 2)')} AS blank_pct, "
                f"count(*) FILTER (WHERE {c} <> {_strip(c)}) AS outer_whitespace_rows FROM b_{n}")
    q["profile_blanks"] = head + " UNION ALL ".join(parts)
    parts = []
    for n in SPECS:
        key = list(SPECS[n].key)
        cols = RAW_FIELDS[n]
        kk, cc = ", ".join(key), ", ".join(cols)
        parts.append(f"""SELECT '{n}' AS table_name,
  (SELECT CAST(coalesce(sum(k - 1), 0) AS BIGINT) FROM (SELECT count(*) AS k FROM b_{n} GROUP BY {cc}) e) AS exact_extra_rows_raw,
  (SELECT count(*) FROM (SELECT {kk} FROM {_stripped(n)} s WHERE NOT {_blank(key)} GROUP BY {kk} HAVING count(*) > 1) d) AS duplicate_key_groups,
  (SELECT count(*) FROM (SELECT {kk} FROM {_stripped(n)} s WHERE NOT {_blank(key)} GROUP BY {kk}
     HAVING count(DISTINCT ({cc})) > 1) d) AS conflicting_key_groups,
  (SELECT count(*) FROM {_unique(n)} u) AS unique_records""")
    q["profile_duplicates"] = head + " UNION ALL ".join(parts)
    parts = []
    for n, spec in SPECS.items():
        for c in spec.dates:
            p = _day(c)
            extra = "CAST(NULL AS BIGINT)"
            if n == "ekko" and c == "AEDAT":
                extra = f"count(*) FILTER (WHERE ({p}) < ({_day('BEDAT')}))"
            parts.append(f"SELECT '{n}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} = '') AS missing, "
                         f"count(*) FILTER (WHERE {c} <> '' AND ({p}) IS NULL) AS invalid_nonblank, "
                         f"CAST(min({p}) AS VARCHAR) AS min_date, CAST(max({p}) AS VARCHAR) AS max_date, "
                         f"{extra} AS changed_before_created FROM {_stripped(n)} s")
    q["profile_dates"] = head + " UNION ALL ".join(parts)
    parts = []
    for n, spec in SPECS.items():
        for c in spec.numbers:
            p = _value(c)
            extra = "CAST(NULL AS BIGINT)"
            if n == "eket" and c == "WEMNG":
                extra = f"count(*) FILTER (WHERE ({p}) > ({_value('MENGE')}))"
            parts.append(f"SELECT '{n}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} = '') AS missing, "
                         f"count(*) FILTER (WHERE {c} <> '' AND ({p}) IS NULL) AS invalid_nonblank, "
                         f"count(*) FILTER (WHERE ({p}) < 0) AS negative, count(*) FILTER (WHERE ({p}) = 0) AS zero, "
                         f"{dbl(f'min({p})')} AS min_value, {dbl(f'max({p})')} AS max_value, "
                         f"{extra} AS received_above_scheduled FROM {_stripped(n)} s")
    q["profile_numbers"] = head + " UNION ALL ".join(parts)
    parts = []
    for child, parent, keys in profile.RELATIONS:
        keys = list(keys)
        kk = ", ".join(keys)
        on = " AND ".join(f"p.{k} = c.{k}" for k in keys)
        parts.append(f"""SELECT '{child.upper()}_to_{parent.upper()}' AS relationship, count(*) AS child_rows,
  count(*) FILTER (WHERE {_blank(['c.' + k for k in keys])}) AS blank_reference_rows,
  count(*) FILTER (WHERE NOT {_blank(['c.' + k for k in keys])} AND p.n IS NULL) AS missing_parent_rows,
  count(*) FILTER (WHERE p.n > 1) AS ambiguous_parent_rows
FROM {_stripped(child)} c LEFT JOIN (SELECT {kk}, count(*) AS n FROM {_stripped(parent)} s
  WHERE NOT {_blank(keys)} GROUP BY {kk}) p ON {on}""")
    q["profile_relations"] = head + " UNION ALL ".join(parts)
    parts = []
    for child, parent, keys, cols in profile.AGREEMENT_CHECKS:
        keys = list(keys)
        kk = ", ".join(keys)
        on = " AND ".join(f"p.{k} = c.{k}" for k in keys)
        for f in cols:
            comp = f"c.{f} <> '' AND coalesce(p.{f}, '') <> ''"
            parts.append(f"""SELECT '{child.upper()}_to_{parent.upper()}_{f}' AS "check", count(*) AS child_rows,
  count(*) FILTER (WHERE {comp}) AS compared_rows, count(*) - count(*) FILTER (WHERE {comp}) AS not_compared_rows,
  count(*) FILTER (WHERE {comp} AND c.{f} <> p.{f}) AS mismatch_rows
FROM {_stripped(child)} c LEFT JOIN (SELECT * FROM {_stripped(parent)} s WHERE NOT {_blank(keys)} AND ({kk}) IN
  (SELECT ({kk}) FROM {_stripped(parent)} t WHERE NOT {_blank(keys)} GROUP BY {kk} HAVING count(*) = 1)) p ON {on}""")
    q["profile_agreement"] = head + " UNION ALL ".join(parts)
    q["value_distribution"] = head + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, {c} AS value, count(*) AS rows FROM {_stripped(t)} s GROUP BY {c}"
        for t, c in profile.DISTRIBUTIONS)
    ik = ", ".join(ITEM_KEY)
    q["profile_fanout"] = head + f"""SELECT s.MANDT, s.EBELN, s.EBELP, s.n AS schedule_rows, d.n AS delivery_rows,
  s.n * d.n AS naive_join_rows
FROM (SELECT {ik}, count(*) AS n FROM {_stripped('eket')} x GROUP BY {ik}) s
JOIN (SELECT {ik}, count(*) AS n FROM {_stripped('lips')} y GROUP BY {ik}) d
  ON s.MANDT = d.MANDT AND s.EBELN = d.EBELN AND s.EBELP = d.EBELP WHERE s.n > 1 AND d.n > 1"""
    as_of = f"DATE '{PARAMS.as_of.isoformat()}'"
    sk = ", ".join(SPECS["eket"].key)
    preview_ctes = f""",
u_items AS {_unique('ekpo')}, u_orders AS (SELECT * FROM {_unique('ekko')} o WHERE LIFNR <> ''),
u_sched AS (SELECT *, {date_sql("nullif(EINDT, '')")} AS due_date FROM {_unique('eket')} e),
all_sched AS (SELECT *, {date_sql("nullif(EINDT, '')")} AS due_date FROM {_stripped('eket')} a),
bad_items AS (SELECT DISTINCT a.MANDT, a.EBELN, a.EBELP FROM all_sched a
  LEFT JOIN (SELECT {sk}, true AS ok FROM u_sched) u ON u.MANDT = a.MANDT AND u.EBELN = a.EBELN
   AND u.EBELP = a.EBELP AND u.ETENR = a.ETENR WHERE u.ok IS NULL OR a.due_date IS NULL),
due AS (SELECT {ik}, max(due_date) AS due_date FROM u_sched s WHERE NOT EXISTS
  (SELECT 1 FROM bad_items b WHERE b.MANDT = s.MANDT AND b.EBELN = s.EBELN AND b.EBELP = s.EBELP) GROUP BY {ik}),
cands AS (SELECT i.WERKS, o.LIFNR, CAST(date_trunc('month', d.due_date) AS DATE) AS report_month
  FROM u_items i JOIN u_orders o ON o.MANDT = i.MANDT AND o.EBELN = i.EBELN
  JOIN due d ON d.MANDT = i.MANDT AND d.EBELN = i.EBELN AND d.EBELP = i.EBELP
  WHERE i.LOEKZ = '' AND i.WERKS <> '' AND d.due_date IS NOT NULL
    AND last_day(date_trunc('month', d.due_date)) <= {as_of}),
preview AS (SELECT report_month, 'BRANCH' AS scope, WERKS, LIFNR, count(*) AS candidate_items_preview FROM cands
  GROUP BY report_month, WERKS, LIFNR
  UNION ALL SELECT report_month, 'ALL', 'ALL', LIFNR, count(*) FROM cands GROUP BY report_month, LIFNR)
"""
    q["candidate_preview"] = head.rstrip("\n") + preview_ctes + (
        "SELECT CAST(report_month AS VARCHAR) AS report_month, scope, WERKS, LIFNR, candidate_items_preview FROM preview")
    stack = " UNION ALL ".join(
        f"""SELECT report_month, scope, WERKS, CAST({t} AS BIGINT) AS min_items, count(*) AS suppliers_total,
  count(*) FILTER (WHERE n BETWEEN 1 AND 2) AS suppliers_with_1_or_2_items, {dbl('quantile_cont(n, 0.5)')} AS median_items,
  CAST(min(n) AS BIGINT) AS min_observed, CAST(max(n) AS BIGINT) AS max_observed,
  count(*) FILTER (WHERE n >= {t}) AS eligible_suppliers, CAST(least(3, count(*) FILTER (WHERE n >= {t})) AS BIGINT) AS ranking_slots,
  CASE WHEN sum(n) > 0 THEN {dbl(f"round(CAST(CAST(coalesce(sum(n) FILTER (WHERE n >= {t}), 0) * 100.0 / sum(n) AS VARCHAR) AS DECIMAL(38,18)), 1)")} END AS retained_item_pct
FROM (SELECT report_month, scope, WERKS, candidate_items_preview AS n FROM preview) p GROUP BY report_month, scope, WERKS"""
        for t in profile.THRESHOLDS)
    q["threshold_study"] = head.rstrip("\n") + preview_ctes + (
        "SELECT CAST(report_month AS VARCHAR) AS report_month, scope, WERKS, min_items, suppliers_total, "
        "suppliers_with_1_or_2_items, median_items, min_observed, max_observed, eligible_suppliers, ranking_slots, "
        f"retained_item_pct FROM ({stack}) t")
    q["supplier_overview"] = head + f"""
, po AS (SELECT * FROM {_unique('ekko')} o WHERE LIFNR <> ''),
pi AS (SELECT i.*, po.LIFNR AS V FROM {_unique('ekpo')} i JOIN po ON po.MANDT = i.MANDT AND po.EBELN = i.EBELN),
v AS (SELECT LIFNR, NAME1 FROM {_unique('lfa1')} l),
o AS (SELECT LIFNR, count(*) AS orders FROM po GROUP BY LIFNR),
it AS (SELECT V AS LIFNR, count(*) AS order_items, count(*) FILTER (WHERE LOEKZ = '') AS nondeleted_items FROM pi GROUP BY V)
SELECT coalesce(v.LIFNR, o.LIFNR, it.LIFNR) AS LIFNR, v.NAME1, CAST(coalesce(o.orders, 0) AS BIGINT) AS orders,
       CAST(coalesce(it.order_items, 0) AS BIGINT) AS order_items, CAST(coalesce(it.nondeleted_items, 0) AS BIGINT) AS nondeleted_items
FROM v FULL OUTER JOIN o ON o.LIFNR = v.LIFNR FULL OUTER JOIN it ON it.LIFNR = coalesce(v.LIFNR, o.LIFNR)"""
    over = q["supplier_overview"][len(head):].replace("\nSELECT coalesce(v.LIFNR", "\n, overview AS (SELECT coalesce(v.LIFNR") + ")"
    q["supplier_footer"] = head + over + " UNION ALL ".join(
        f" SELECT '{m}' AS measure, CAST(sum({m}) AS BIGINT) AS total, {dbl(f'quantile_cont({m}, 0.5)')} AS median, max({m}) AS greatest, min({m}) AS least FROM overview"
        for m in ("orders", "order_items", "nondeleted_items"))
    day = date_sql("nullif(BEDAT, '')")
    q["order_date_range"] = head + (f"SELECT CAST(min({day}) AS VARCHAR) AS first_date, CAST(max({day}) AS VARCHAR) AS last_date, "
                                    f"count(*) FILTER (WHERE ({day}) IS NULL) AS without_date FROM {_unique('ekko')} o WHERE LIFNR <> ''")
    found = []

    def row(check: str, source: str, where: str, records: str = "count(*)") -> None:
        found.append(f"SELECT '{check}' AS \"check\", CAST({records} AS BIGINT) AS records FROM {source} WHERE {where}")

    for n, spec in SPECS.items():
        key, cols, label = list(spec.key), RAW_FIELDS[n], n.upper()
        kk, cc = ", ".join(key), ", ".join(cols)
        row(f"{label}_missing_key", f"{_stripped(n)} s", _blank(key))
        for c in spec.dates:
            row(f"{label}_{c}_invalid_date", f"{_stripped(n)} s", f"{c} <> '' AND ({_day(c)}) IS NULL")
        for c in spec.numbers:
            row(f"{label}_{c}_invalid_number", f"{_stripped(n)} s", f"{c} <> '' AND NOT {_is_number(c)}")
            row(f"{label}_{c}_negative", f"{_stripped(n)} s", f"({_value(c)}) < 0")
        row(f"{label}_exact_duplicates", f"(SELECT count(*) AS k FROM b_{n} GROUP BY {cc}) e", "k > 1", "coalesce(sum(k), 0)")
        row(f"{label}_key_conflicts", f"(SELECT count(*) AS k, count(DISTINCT ({cc})) AS v FROM {_stripped(n)} s WHERE NOT {_blank(key)} GROUP BY {kk}) e",
            "v > 1", "coalesce(sum(k), 0)")
    row("EKKO_change_before_order_date", f"{_stripped('ekko')} s", f"({_day('AEDAT')}) < ({_day('BEDAT')})")
    row("EKET_received_above_scheduled_review", f"{_stripped('eket')} s", f"({_value('WEMNG')}) > ({_value('MENGE')})")
    for child, parent, keys in profile.RELATIONS:
        kk = ", ".join(keys)
        on = " AND ".join(f"p.{k} = c.{k}" for k in keys)
        source = (f"{_stripped(child)} c LEFT JOIN (SELECT {kk}, count(*) AS n FROM {_stripped(parent)} s WHERE NOT {_blank(keys)} GROUP BY {kk}) p ON {on}")
        label = f"{child.upper()}_to_{parent.upper()}"
        row(f"{label}_missing_parent", source, f"NOT {_blank(['c.' + k for k in keys])} AND p.n IS NULL")
        row(f"{label}_ambiguous_parent", source, "p.n > 1")
    found += [f"SELECT \"check\" || '_mismatch', mismatch_rows FROM ({q['profile_agreement'][len(head):]}) a",
              f"SELECT 'schedule_delivery_many_to_many', count(*) FROM ({q['profile_fanout'][len(head):]}) f"]
    q["profile_findings"] = head + "SELECT * FROM (" + " UNION ALL ".join(found) + ") t WHERE records > 0"
    return q


PROFILE_ORACLE = _oracle()
