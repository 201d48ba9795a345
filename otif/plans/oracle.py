"""DuckDB oracle: the same results written as plain SQL over the shared tables.

Used by the driver's correctness gate and the tests. It shares only the raw
extract texts (``otif.sources.bindings``) and the cutoff with the Spark operators;
contracts, lookups and agreement rules are stated here a second time, so a wrong
value on one side shows, and every transformation is re-stated in SQL, using the
straightforward formulations (windows per key, the per-key interval-overlap
join for FIFO) that the Spark side deliberately avoids for scale.
"""

from __future__ import annotations

from dataclasses import dataclass

from otif.model import BINDING_PARAMS
from otif.sources.bindings import EXTRACTS, duckdb_extract

PARAMS = BINDING_PARAMS
AS_OF = f"DATE '{PARAMS.as_of.isoformat()}'"
BRANCH = "2100"

RAW_FIELDS = {
    "branch_mapping": ["WERKS", "BRANCH_NAME"],
    "lfa1": ["LIFNR", "NAME1", "LAND1", "ORT01", "STRAS", "WAERS"],
    "mara": ["MATNR", "MAKTX", "MTART", "MEINS", "MATKL"],
    "ekko": ["MANDT", "EBELN", "BUKRS", "BSTYP", "BSART", "LIFNR", "EKORG", "EKGRP", "WAERS", "BEDAT", "AEDAT",
             "ERNAM"],
    "ekpo": ["MANDT", "EBELN", "EBELP", "MATNR", "TXZ01", "WERKS", "MENGE", "MEINS", "NETPR", "NETWR", "LOEKZ"],
    "eket": ["MANDT", "EBELN", "EBELP", "ETENR", "EINDT", "MENGE", "WEMNG"],
    "likp": ["MANDT", "VBELN", "LIFNR", "WADAT_IST", "WERKS"],
    "lips": ["MANDT", "VBELN", "POSNR", "EBELN", "EBELP", "MATNR", "LFIMG", "MEINS", "WERKS"],
}
# Fixed values, stated apart from ``otif.model``: table | key | required | dates | numbers; ``*`` marks numbers
# that may not be zero.
CONTRACTS = """
branch_mapping | WERKS                   | BRANCH_NAME                         |             |
lfa1           | LIFNR                   | NAME1                               |             |
mara           | MATNR                   | MEINS                               |             |
ekko           | MANDT EBELN             | LIFNR BEDAT                         | BEDAT AEDAT |
ekpo           | MANDT EBELN EBELP       | MATNR MENGE MEINS WERKS             |             | MENGE* NETPR NETWR
eket           | MANDT EBELN EBELP ETENR | EINDT MENGE                         | EINDT       | MENGE* WEMNG
likp           | MANDT VBELN             | LIFNR WADAT_IST WERKS               | WADAT_IST   |
lips           | MANDT VBELN POSNR       | EBELN EBELP MATNR LFIMG MEINS WERKS |             | LFIMG*
"""
# child | parent | key | label | carried fields
LOOKUPS = """
ekko | lfa1 | LIFNR             | vendor     |
ekpo | ekko | MANDT EBELN       | order      |
ekpo | mara | MATNR             | material   | MEINS
eket | ekpo | MANDT EBELN EBELP | order_item |
likp | lfa1 | LIFNR             | vendor     |
lips | ekpo | MANDT EBELN EBELP | order_item | MATNR MEINS WERKS
lips | likp | MANDT VBELN       | delivery   | LIFNR WERKS
lips | ekko | MANDT EBELN       | order      | LIFNR
"""
# child | one side | other side | reason
MUST_AGREE = """
ekpo | t.MEINS           | r_material.f_MEINS   | UNIT_MISMATCH:MARA
lips | t.MATNR           | r_order_item.f_MATNR | ORDER_ITEM_MISMATCH:MATNR
lips | t.MEINS           | r_order_item.f_MEINS | ORDER_ITEM_MISMATCH:MEINS
lips | t.WERKS           | r_order_item.f_WERKS | ORDER_ITEM_MISMATCH:WERKS
lips | t.WERKS           | r_delivery.f_WERKS   | DELIVERY_MISMATCH:WERKS
lips | r_order.f_LIFNR   | r_delivery.f_LIFNR   | SUPPLIER_MISMATCH
"""
UPPER_CASED = {"MEINS", "WAERS", "LAND1", "LOEKZ"}
DELETED = "L"
_NUM_RE = r"[+-]?\d+([.,]\d{1,6})?"


def _rows(table: str) -> list[list[str]]:
    return [[cell.strip() for cell in line.split("|")] for line in table.strip().splitlines()]


@dataclass(frozen=True)
class Contract:
    key: list[str]
    required: list[str]
    dates: list[str]
    numbers: list[str]
    positive: list[str]


SPECS = {name: Contract(key.split(), required.split(), dates.split(), numbers.replace("*", "").split(),
                        [n[:-1] for n in numbers.split() if n.endswith("*")])
         for name, key, required, dates, numbers in _rows(CONTRACTS)}


def norm(c: str, alias: str = "") -> str:
    src = f"{alias}{c}"
    v = f"nullif(trim({src}), '')"
    return f"upper({v})" if c in UPPER_CASED else v


def date_sql(c: str) -> str:
    return (f"CASE WHEN regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN CAST(try_strptime({c}, '%Y-%m-%d') AS DATE) "
            f"WHEN regexp_full_match({c}, '\\d{{2}}\\.\\d{{2}}\\.\\d{{4}}') THEN CAST(try_strptime({c}, '%d.%m.%Y') AS DATE) END")


def number_sql(c: str) -> str:
    return (f"CASE WHEN regexp_full_match({c}, '{_NUM_RE}') "
            f"THEN TRY_CAST(replace({c}, ',', '.') AS DECIMAL(38,6)) END")


def struct_json(cols: list[str], alias: str = "") -> str:
    return "to_json({" + ", ".join(f"'{c}': {alias}{c}" for c in cols) + "})"


def reason_list(rules: list[tuple[str, str]]) -> str:
    if not rules:
        return "CAST([] AS VARCHAR[])"
    items = ", ".join(f"CASE WHEN {cond} THEN '{reason}' END" for cond, reason in rules)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


def silver_ctes() -> list[tuple[str, str]]:
    ctes: list[tuple[str, str]] = []
    for name, spec in SPECS.items():
        fields = RAW_FIELDS[name]
        key = list(spec.key)
        flist = ", ".join(fields)
        ctes.append((f"b_{name}", duckdb_extract(name)))
        ctes.append((f"d_{name}", f"SELECT {flist}, count(*) AS _occ, list_sort(list_distinct(list(_source_file))) AS _files "
                                  f"FROM b_{name} GROUP BY {flist}"))
        parsed = [f"{date_sql(c)} AS _pd_{c}" for c in spec.dates] + [f"{number_sql(c)} AS _pn_{c}" for c in spec.numbers]
        kpart = ", ".join(key)
        ctes.append((f"n_{name}", "SELECT " + ", ".join(f"{norm(c, 'd.')} AS {c}" for c in fields)
                     + f", d._occ, d._files, {struct_json(fields, 'd.')} AS _raw FROM d_{name} d"))
        ctes.append((f"p_{name}", "SELECT *" + "".join(f", {p}" for p in parsed)
                     + f", count(*) OVER (PARTITION BY {kpart}) AS _kv FROM n_{name}"))
        src = f"p_{name}"
        conflict = "_kv > 1"
        if name == "ekko":
            ctes.append(("ekko_v1", f"SELECT *, max(_pd_AEDAT) OVER (PARTITION BY {kpart}) AS _latest, "
                                    f"count(_pd_AEDAT) OVER (PARTITION BY {kpart}) AS _dated FROM p_ekko"))
            ctes.append(("ekko_v2", f"SELECT *, sum(CASE WHEN _pd_AEDAT = _latest THEN 1 ELSE 0 END) "
                                    f"OVER (PARTITION BY {kpart}) AS _latest_n FROM ekko_v1"))
            ctes.append(("ekko_v3", "SELECT *, (_dated = _kv AND _latest_n = 1) AS _can, "
                                    "coalesce(_dated = _kv AND _latest_n = 1 AND _pd_AEDAT < _latest, false) AS _sup "
                                    "FROM ekko_v2"))
            ctes.append(("sup_ekko", "SELECT 'ekko' AS source_table, "
                                     "to_json({'MANDT': MANDT, 'EBELN': EBELN}) AS candidate_key, _raw, _occ, _files, "
                                     "_pd_AEDAT AS reference_date, _latest AS selected_reference_date, "
                                     "'LATEST_AEDAT_DEMO_PROXY' AS selection_rule FROM ekko_v3 WHERE _sup"))
            src = "(SELECT * FROM ekko_v3 WHERE NOT _sup)"
            conflict = "_kv > 1 AND NOT _can"
        joins, rules = [], []
        rules += [(f"t.{c} IS NULL", f"MISSING:{c}") for c in dict.fromkeys(spec.key + spec.required)]
        rules += [(f"t.{c} IS NOT NULL AND t._pd_{c} IS NULL", f"INVALID_DATE:{c}") for c in spec.dates]
        rules.append((conflict, "CONFLICTING_KEY"))
        for c in spec.numbers:
            rules.append((f"t.{c} IS NOT NULL AND t._pn_{c} IS NULL", f"INVALID_NUMBER:{c}"))
            rules.append((f"t._pn_{c} < 0", f"NEGATIVE_NUMBER:{c}"))
            if c in spec.positive:
                rules.append((f"t._pn_{c} = 0", f"ZERO_QUANTITY:{c}"))
        extra = ""
        if "LOEKZ" in fields:
            rules.append((f"t.LOEKZ IS NOT NULL AND t.LOEKZ <> '{DELETED}'", "UNKNOWN_DELETE_STATUS"))
            extra = f", coalesce(t.LOEKZ = '{DELETED}', false) AS _is_deleted"
        for child, parent, on_key, label, carried in _rows(LOOKUPS):
            if child == name:
                a = f"r_{label}"
                sel = ", ".join(on_key.split() + [f"{f} AS f_{f}" for f in carried.split()])
                on = " AND ".join(f"{a}.{k} = t.{k}" for k in on_key.split())
                joins.append(f"LEFT JOIN (SELECT {sel}, true AS found FROM v_{parent}) {a} ON {on}")
                rules.append((f"{a}.found IS NULL", f"UNRESOLVED_REFERENCE:{label}"))
        for child, left, right, reason in _rows(MUST_AGREE):
            if child == name:
                rules.append((f"{left} IS NOT NULL AND {right} IS NOT NULL AND {left} <> {right}", reason))
        plain = [c for c in fields if c not in spec.dates and c not in spec.numbers]
        out = ([f"t.{c}" for c in plain] + [f"t._pd_{c} AS {c}" for c in spec.dates]
               + [f"t._pn_{c} AS {c}" for c in spec.numbers])
        ctes.append((f"s_{name}", "SELECT " + ", ".join(out) + f", t._raw, t._occ, t._files{extra}, "
                     + reason_list(rules) + f" AS _err FROM {src} t " + " ".join(joins)))
        ctes.append((f"v_{name}", f"SELECT * FROM s_{name} WHERE len(_err) = 0"))
    parts = []
    for name, spec in SPECS.items():
        parts.append(f"SELECT '{name}' AS source_table, {struct_json(list(spec.key))} AS candidate_key, "
                     f"_raw, _err, _occ, _files FROM s_{name} WHERE len(_err) > 0")
    ctes.append(("quarantine", " UNION ALL ".join(parts)))
    return ctes


ITEM = ["MANDT", "EBELN", "EBELP"]
SCHED = ITEM + ["ETENR"]


def on(a: str, b: str, cols: list[str]) -> str:
    return " AND ".join(f"{a}.{c} = {b}.{c}" for c in cols)


def gold_ctes() -> list[tuple[str, str]]:
    ik = ", ".join(ITEM)
    c = []
    c.append(("item_keys", "SELECT DISTINCT " + ", ".join(f"nullif(trim({k}), '') AS {k}" for k in ITEM) + " FROM b_ekpo"))
    c.append(("affected", "SELECT source_table, _err, _raw, "
              + ", ".join(f"nullif(trim(json_extract_string(_raw, '$.{k}')), '') AS {k}" for k in ITEM)
              + " FROM quarantine WHERE source_table IN ('ekpo', 'eket', 'lips')"))
    c.append(("issues", f"SELECT {ik}, list_sort(list_distinct(list(source_table))) AS quarantined_sources "
              f"FROM affected a WHERE EXISTS (SELECT 1 FROM item_keys k WHERE {on('k', 'a', ITEM)}) GROUP BY {ik}"))
    c.append(("unassigned", f"SELECT * FROM affected a WHERE NOT EXISTS (SELECT 1 FROM item_keys k WHERE {on('k', 'a', ITEM)})"))
    c.append(("sched_roll", f"SELECT {ik}, min(EINDT) AS first_due_date, max(EINDT) AS final_due_date, "
              f"sum(MENGE) AS scheduled_qty, count(*) AS schedule_count FROM v_eket GROUP BY {ik}"))
    c.append(("details", f"""
SELECT k.MANDT, k.EBELN, k.EBELP, i.MATNR, i.WERKS, i.MEINS, i._is_deleted, i.MENGE AS ordered_qty,
       i._valid_item, o.LIFNR, o.BEDAT, v.NAME1, s.first_due_date, s.final_due_date, s.scheduled_qty,
       s.schedule_count, q.quarantined_sources,
       CAST(date_trunc('month', s.final_due_date) AS DATE) AS report_month,
       last_day(s.final_due_date) AS evaluation_date
FROM item_keys k
LEFT JOIN (SELECT *, true AS _valid_item FROM v_ekpo) i ON {on('i', 'k', ITEM)}
LEFT JOIN v_ekko o ON o.MANDT = k.MANDT AND o.EBELN = k.EBELN
LEFT JOIN v_lfa1 v ON v.LIFNR = o.LIFNR
LEFT JOIN sched_roll s ON {on('s', 'k', ITEM)}
LEFT JOIN issues q ON {on('q', 'k', ITEM)}"""))
    c.append(("deliveries", """
SELECT l.MANDT, l.EBELN, l.EBELP, l.VBELN, l.POSNR, l.MATNR, l.MEINS, l.WERKS, l.LFIMG, h.WADAT_IST
FROM v_lips l JOIN v_likp h ON h.MANDT = l.MANDT AND h.VBELN = l.VBELN"""))
    c.append(("evidence", f"""
SELECT d.*, x.LIFNR, x.report_month, x.final_due_date, x.evaluation_date, x.BEDAT,
       d.WADAT_IST <= x.final_due_date AS by_due_date, d.WADAT_IST <= x.evaluation_date AS by_month_end,
       d.WADAT_IST > {AS_OF} AS after_cutoff
FROM deliveries d JOIN details x ON {on('x', 'd', ITEM)}"""))
    c.append(("amounts", f"""
SELECT {ik},
  sum(CASE WHEN by_due_date AND NOT after_cutoff THEN LFIMG ELSE 0 END) AS delivered_by_due_qty,
  sum(CASE WHEN by_month_end AND NOT after_cutoff THEN LFIMG ELSE 0 END) AS delivered_by_month_end_qty,
  max(CAST(WADAT_IST < BEDAT AS INTEGER)) AS dbo
FROM evidence GROUP BY {ik}"""))
    excl = reason_list([
        ("x._valid_item IS NULL", "INVALID_SILVER_ITEM"), ("x.LIFNR IS NULL", "INVALID_ORDER_HEADER"),
        ("x._is_deleted", "DELETED_ITEM"), ("x.final_due_date IS NULL", "NO_VALID_SCHEDULE"),
        ("len(x.quarantined_sources) > 0", "RELATED_QUARANTINE"),
        ("x.scheduled_qty <> x.ordered_qty", "SCHEDULE_QUANTITY_MISMATCH"),
        ("x.first_due_date < x.BEDAT", "SCHEDULE_BEFORE_ORDER"), ("a.dbo = 1", "DELIVERY_BEFORE_ORDER"),
        (f"x.evaluation_date > {AS_OF}", "MONTH_NOT_CLOSED")])
    c.append(("item_perf0", f"""
SELECT x.*, coalesce(a.delivered_by_due_qty, 0) AS delivered_by_due_qty,
       coalesce(a.delivered_by_month_end_qty, 0) AS delivered_by_month_end_qty, {excl} AS exclusion_reasons
FROM details x LEFT JOIN amounts a ON {on('a', 'x', ITEM)}"""))
    c.append(("item_perf", """
SELECT *, len(exclusion_reasons) = 0 AS is_evaluable,
  CASE WHEN len(exclusion_reasons) = 0 THEN delivered_by_due_qty >= ordered_qty END AS on_time,
  CASE WHEN len(exclusion_reasons) = 0 THEN delivered_by_month_end_qty >= ordered_qty END AS in_full,
  CASE WHEN len(exclusion_reasons) = 0 THEN least(1.0, CAST(delivered_by_month_end_qty AS DOUBLE) / CAST(ordered_qty AS DOUBLE)) END AS fill_rate,
  CASE WHEN len(exclusion_reasons) = 0 THEN greatest(0, ordered_qty - delivered_by_month_end_qty) END AS shortfall_qty
FROM item_perf0"""))
    c.append(("sched_keys", "SELECT DISTINCT " + ", ".join(f"nullif(trim({k}), '') AS {k}" for k in SCHED) + " FROM b_eket"))
    add = reason_list([("p._parent_found IS NULL", "INVALID_ORDER_ITEM"),
                       ("s._valid_schedule IS NULL", "INVALID_SILVER_SCHEDULE")])
    c.append(("sched_cands", f"""
SELECT k.MANDT, k.EBELN, k.EBELP, k.ETENR, s.EINDT, s.MENGE AS schedule_quantity,
       p.LIFNR, p.NAME1, p.WERKS, p.MATNR, p.MEINS, p.BEDAT,
       list_concat(coalesce(p.excl, CAST([] AS VARCHAR[])), {add}) AS exclusion_reasons,
       CAST(date_trunc('month', s.EINDT) AS DATE) AS report_month, last_day(s.EINDT) AS evaluation_date
FROM sched_keys k
LEFT JOIN (SELECT *, true AS _valid_schedule FROM v_eket) s ON {on('s', 'k', SCHED)}
LEFT JOIN (SELECT {ik}, LIFNR, NAME1, WERKS, MATNR, MEINS, BEDAT,
                  list_filter(exclusion_reasons, lambda r: r <> 'MONTH_NOT_CLOSED') AS excl, true AS _parent_found
           FROM item_perf) p ON {on('p', 'k', ITEM)}"""))
    c.append(("fifo_p", f"""
SELECT *, sum(schedule_quantity) OVER (PARTITION BY {ik} ORDER BY EINDT, ETENR
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pe
FROM sched_cands WHERE len(exclusion_reasons) = 0"""))
    c.append(("fifo_d", f"""
SELECT *, sum(LFIMG) OVER (PARTITION BY {ik} ORDER BY WADAT_IST, VBELN, POSNR
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS de
FROM deliveries WHERE WADAT_IST <= {AS_OF}"""))
    c.append(("allocations", f"""
SELECT p.MANDT, p.EBELN, p.EBELP, p.ETENR, p.EINDT, p.WERKS, p.LIFNR, p.MATNR, p.MEINS,
       d.VBELN, d.POSNR, d.WADAT_IST,
       least(p.pe, d.de) - greatest(p.pe - p.schedule_quantity, d.de - d.LFIMG) AS allocated_quantity,
       CAST(date_trunc('month', p.EINDT) AS DATE) AS report_month, 'FIFO_DUE_DATE_V1' AS allocation_rule,
       true AS is_inferred
FROM fifo_p p JOIN fifo_d d ON {on('p', 'd', ITEM)}
 AND p.pe - p.schedule_quantity < d.de AND d.de - d.LFIMG < p.pe"""))
    c.append(("alloc_s", f"""
SELECT {', '.join(SCHED)}, sum(allocated_quantity) AS allocated_quantity,
  sum(CASE WHEN WADAT_IST <= EINDT THEN allocated_quantity ELSE 0 END) AS allocated_by_due_quantity,
  sum(CASE WHEN WADAT_IST <= last_day(EINDT) THEN allocated_quantity ELSE 0 END) AS allocated_by_month_end_quantity,
  max(WADAT_IST) AS last_allocated_delivery_date
FROM allocations GROUP BY {', '.join(SCHED)}"""))
    mnc = reason_list([(f"c.evaluation_date > {AS_OF}", "MONTH_NOT_CLOSED")])
    c.append(("sched_perf0", f"""
SELECT c.*, len(c.exclusion_reasons) = 0 AS is_allocatable,
       list_concat(c.exclusion_reasons, {mnc}) AS reasons2,
       a.allocated_quantity AS aq, a.allocated_by_due_quantity AS adq, a.allocated_by_month_end_quantity AS amq,
       a.last_allocated_delivery_date
FROM sched_cands c LEFT JOIN alloc_s a ON {on('a', 'c', SCHED)}"""))
    c.append(("sched_perf", f"""
SELECT MANDT, EBELN, EBELP, ETENR, EINDT, schedule_quantity, LIFNR, NAME1, WERKS, MATNR, MEINS, BEDAT,
       report_month, evaluation_date, reasons2 AS exclusion_reasons, is_allocatable,
       len(reasons2) = 0 AS is_evaluable,
       CASE WHEN is_allocatable THEN coalesce(aq, 0) END AS allocated_quantity,
       CASE WHEN is_allocatable THEN coalesce(adq, 0) END AS allocated_by_due_quantity,
       CASE WHEN is_allocatable THEN coalesce(amq, 0) END AS allocated_by_month_end_quantity,
       last_allocated_delivery_date,
       CASE WHEN len(reasons2) = 0 THEN coalesce(adq, 0) >= schedule_quantity END AS on_time,
       CASE WHEN len(reasons2) = 0 THEN coalesce(amq, 0) >= schedule_quantity END AS in_full,
       CASE WHEN len(reasons2) = 0 THEN {dec6('CAST(coalesce(amq, 0) AS DOUBLE) / CAST(schedule_quantity AS DOUBLE)')} END AS fill_rate,
       CASE WHEN len(reasons2) = 0 THEN schedule_quantity - coalesce(amq, 0) END AS shortfall_qty,
       CASE WHEN CASE WHEN is_allocatable THEN coalesce(aq, 0) END >= schedule_quantity
            THEN last_allocated_delivery_date END AS completion_date,
       'FIFO_DUE_DATE_V1' AS allocation_rule, 'FIFO_SCHEDULE_LINE_EQUAL_WEIGHT' AS metric_basis
FROM sched_perf0"""))
    c.append(("balance", f"""
SELECT d.*, coalesce(a.allocated_quantity, 0) AS allocated_quantity,
       d.LFIMG - coalesce(a.allocated_quantity, 0) AS unallocated_quantity,
       CASE WHEN d.WADAT_IST > {AS_OF} THEN 'AFTER_CUTOFF'
            WHEN p.MANDT IS NULL THEN 'EXCLUDED_OR_NO_VALID_SCHEDULE'
            WHEN d.LFIMG - coalesce(a.allocated_quantity, 0) > 0 THEN 'EXCESS_OVER_SCHEDULES'
            ELSE 'FULLY_ALLOCATED' END AS allocation_status
FROM deliveries d
LEFT JOIN (SELECT MANDT, VBELN, POSNR, sum(allocated_quantity) AS allocated_quantity FROM allocations
           GROUP BY MANDT, VBELN, POSNR) a ON a.MANDT = d.MANDT AND a.VBELN = d.VBELN AND a.POSNR = d.POSNR
LEFT JOIN (SELECT DISTINCT {ik} FROM sched_cands WHERE len(exclusion_reasons) = 0) p ON {on('p', 'd', ITEM)}"""))
    c.append(("monthly0", f"""
SELECT report_month, CASE WHEN GROUPING(WERKS) = 1 THEN 'ALL' ELSE 'BRANCH' END AS scope, WERKS, LIFNR, NAME1,
       count(*) AS candidate_items, CAST(sum(CAST(is_evaluable AS INTEGER)) AS BIGINT) AS evaluated_items,
       avg(CASE WHEN is_evaluable THEN CAST(on_time AS DOUBLE) END) AS on_time_rate,
       avg(CASE WHEN is_evaluable THEN CAST(in_full AS DOUBLE) END) AS in_full_rate,
       -- exact mean of 6-digit fill rates, half-up in micro units (integer arithmetic)
       CAST((2 * sum(CASE WHEN is_evaluable THEN CAST(fill_rate * 1000000 AS BIGINT) END)
             + count(CASE WHEN is_evaluable THEN fill_rate END))
            // nullif(2 * count(CASE WHEN is_evaluable THEN fill_rate END), 0) AS DOUBLE) / 1000000.0 AS mean_fill_rate
FROM sched_perf
WHERE LIFNR IS NOT NULL AND report_month IS NOT NULL AND evaluation_date <= {AS_OF}
GROUP BY GROUPING SETS ((report_month, WERKS, LIFNR, NAME1), (report_month, LIFNR, NAME1))"""))
    c.append(("monthly", f"""
SELECT *, candidate_items - evaluated_items AS excluded_items,
       CAST(evaluated_items AS DOUBLE) / candidate_items AS coverage_rate,
       (on_time_rate + in_full_rate) / 2 AS score, evaluated_items >= {PARAMS.min_items} AS ranking_eligible,
       {PARAMS.min_items} AS min_items, 'FIFO_SCHEDULE_LINE_EQUAL_WEIGHT' AS metric_basis
FROM monthly0"""))
    c.append(("worst", """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY report_month, scope, WERKS
            ORDER BY score ASC, on_time_rate ASC, in_full_rate ASC, evaluated_items DESC, LIFNR ASC) AS worst_rank
  FROM monthly WHERE ranking_eligible) r WHERE worst_rank <= 3"""))
    c.append(("quality", """
SELECT reason, count(*) AS item_or_record_count FROM (
  SELECT unnest(CASE WHEN is_evaluable THEN ['EVALUATED'] ELSE exclusion_reasons END) AS reason FROM sched_perf) r
GROUP BY reason
UNION ALL
SELECT 'UNASSIGNED_QUARANTINE:' || source_table, count(*) FROM unassigned GROUP BY source_table"""))
    c.append(("branches", "SELECT WERKS AS branch_code, BRANCH_NAME AS branch_name FROM v_branch_mapping"))
    c.append(("pub_monthly", f"""
SELECT m.report_month, m.scope AS report_scope, m.WERKS AS branch_code, m.LIFNR AS supplier_id,
       m.NAME1 AS supplier_name, m.candidate_items AS candidate_schedule_line_count,
       m.evaluated_items AS evaluated_schedule_line_count, m.on_time_rate, m.in_full_rate,
       m.mean_fill_rate AS mean_quantity_fill_rate, m.excluded_items AS excluded_schedule_line_count,
       m.coverage_rate AS evaluation_coverage_rate, m.score AS performance_score,
       m.ranking_eligible AS is_ranking_eligible, m.min_items AS minimum_schedule_line_count, m.metric_basis,
       b.branch_name,
       CASE WHEN m.WERKS IS NULL THEN 'NOT_APPLICABLE' WHEN b.branch_name IS NULL THEN 'UNMAPPED' ELSE 'MAPPED' END
         AS branch_mapping_status,
       {AS_OF} AS as_of_date
FROM monthly m LEFT JOIN branches b ON b.branch_code = m.WERKS"""))
    c.append(("pub_worst", """
SELECT p.*, w.worst_rank AS worst_supplier_rank FROM pub_monthly p
JOIN worst w ON w.report_month = p.report_month AND w.scope = p.report_scope
 AND w.WERKS IS NOT DISTINCT FROM p.branch_code AND w.LIFNR = p.supplier_id"""))
    c.append(("order_items", """
SELECT i.MANDT, i.EBELN, i.EBELP, i.MATNR, i.TXZ01, i.WERKS, i.MENGE, i.MEINS, i.NETPR, i.NETWR, i._is_deleted,
       o.LIFNR, o.BEDAT, o.WAERS, v.NAME1
FROM v_ekpo i JOIN v_ekko o ON o.MANDT = i.MANDT AND o.EBELN = i.EBELN LEFT JOIN v_lfa1 v ON v.LIFNR = o.LIFNR"""))
    return c


SHARED = {"details", "deliveries", "evidence", "amounts", "item_perf0", "sched_cands", "fifo_p", "fifo_d", "allocations", "alloc_s",
          "sched_perf0", "sched_perf", "monthly0", "item_keys", "affected", "issues", "quarantine",
          *(f"{kind}_{n}" for n in SPECS for kind in ("b", "v"))}


def _with(final: str, extra: list[tuple[str, str]] = ()) -> str:
    ctes = silver_ctes() + gold_ctes() + list(extra)
    # Steps that several others read are computed once.
    return "WITH " + ",\n".join(f"{n} AS {'MATERIALIZED ' * (n in SHARED)}(\n{sql}\n)" for n, sql in ctes) + "\n" + final


# Value shapes matching ``registry.comparable``.
def dbl(e: str) -> str:
    """Half-up rounding of the value's shortest decimal text, as Spark rounds doubles."""
    return f"CAST(round(CAST(CAST(CAST({e} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), 6) AS DOUBLE)"


def dec6(e: str) -> str:
    """A double quotient as the 6-digit half-up decimal Spark's decimal division yields."""
    return f"round(CAST(CAST(CAST({e} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), 6)"


def dstr(e: str) -> str:
    return f"CAST({e} AS VARCHAR)"


def arr(e: str) -> str:
    return f"array_to_string({e}, ',')"


def big(e: str) -> str:
    return f"CAST({e} AS BIGINT)"


def _select(cols: list[tuple[str, str]], source: str, where: str = "") -> str:
    shape = {"s": lambda e: e, "b": lambda e: e, "n": dbl, "d": dstr, "a": arr, "i": big}
    body = ", ".join(f"{shape[k](e)} AS {name}" for name, e, k in
                     [(c[0], c[0], c[1]) if len(c) == 2 else c for c in cols])
    return f"SELECT {body} FROM {source}" + (f" WHERE {where}" if where else "")


def _cols(spec: str) -> list[tuple[str, str]]:
    """``"a:s b:n"`` → [(a, s), (b, n)]."""
    return [tuple(p.split(":")) for p in spec.split()]


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _text_rows(kind: str) -> str:
    parts = []
    for name, spec in SPECS.items():
        for col in getattr(spec, kind):
            parts.append(f"SELECT '{name}' AS source_table, '{col}' AS column_name, nullif(trim({col}), '') AS value_text "
                         f"FROM b_{name}")
    return _union(parts)


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    ekpo_fields = RAW_FIELDS["ekpo"]
    q["normalise_text"] = _with("SELECT " + ", ".join(f"{norm(c)} AS {c}" for c in ekpo_fields) + " FROM b_ekpo")
    q["parse_dates"] = _with(
        f"SELECT source_table, column_name, value_text, CAST({date_sql('value_text')} AS VARCHAR) AS parsed_date, "
        f"value_text IS NOT NULL AND ({date_sql('value_text')}) IS NULL AS is_invalid_date FROM ({_text_rows('dates')}) t")
    num = number_sql("value_text")
    issues = reason_list([("value_text IS NOT NULL AND pv IS NULL", "INVALID_NUMBER"), ("pv < 0", "NEGATIVE_NUMBER"),
                          ("column_name IN ('MENGE', 'LFIMG') AND pv = 0", "ZERO_QUANTITY")])
    q["parse_numbers"] = _with(
        f"SELECT source_table, column_name, value_text, {dbl('pv')} AS parsed_value, {arr(issues)} AS number_issues "
        f"FROM (SELECT *, {num} AS pv FROM ({_text_rows('numbers')}) t) u")
    reasons = "SELECT source_table, unnest(_err) AS reason FROM quarantine"
    q["dq_missing"] = _with(f"SELECT source_table, reason, count(*) AS rows FROM ({reasons}) r "
                            f"WHERE starts_with(reason, 'MISSING:') GROUP BY source_table, reason")
    q["dq_reason_counts"] = _with(f"SELECT source_table, reason, count(*) AS rows FROM ({reasons}) r "
                                  f"GROUP BY source_table, reason")
    q["valid_rejected_split"] = _with(
        f"SELECT MANDT, EBELN, EBELP, len(_err) = 0 AS is_valid, _is_deleted AS is_deleted, {arr('_err')} AS dq_errors "
        f"FROM s_ekpo")
    q["raw_record_json"] = _with(
        "SELECT source_table, candidate_key, _raw AS raw_record, "
        + ", ".join(f"nullif(trim(json_extract_string(_raw, '$.{k}')), '') AS recovered_{k}" for k in ITEM)
        + " FROM quarantine")
    eket_f = RAW_FIELDS["eket"]
    q["dedupe_exact"] = _with("SELECT " + ", ".join(eket_f) + f", {big('_occ')} AS source_occurrences, "
                              f"{arr('_files')} AS source_files FROM d_eket")
    q["key_conflicts"] = _with(
        "SELECT MANDT, EBELN, EBELP, ETENR, count(*) AS key_variants FROM ("
        "SELECT " + ", ".join(f"{norm(c)} AS {c}" for c in eket_f) + " FROM (SELECT DISTINCT "
        + ", ".join(eket_f) + " FROM b_eket) d) n GROUP BY MANDT, EBELN, EBELP, ETENR HAVING count(*) > 1")
    ekko_f = RAW_FIELDS["ekko"]
    q["version_resolution"] = _with("""
SELECT n.MANDT, n.EBELN, count(*) AS key_variants, count(n.a) AS dated_variants,
       CAST(max(n.a) AS VARCHAR) AS latest_aedat,
       count(*) FILTER (WHERE n.a = m.latest) AS latest_variants,
       count(n.a) = count(*) AND count(*) FILTER (WHERE n.a = m.latest) = 1 AS can_resolve
FROM ekko_n n JOIN (SELECT MANDT, EBELN, max(a) AS latest FROM ekko_n GROUP BY MANDT, EBELN) m
  ON n.MANDT IS NOT DISTINCT FROM m.MANDT AND n.EBELN IS NOT DISTINCT FROM m.EBELN
GROUP BY n.MANDT, n.EBELN HAVING count(*) > 1""", [("ekko_n", _ekko_norm(ekko_f))])
    q["superseded_records"] = _with(
        f"SELECT source_table, candidate_key, _raw AS raw_record, {big('_occ')} AS source_occurrences, "
        f"{arr('_files')} AS source_files, {dstr('reference_date')} AS reference_date, "
        f"{dstr('selected_reference_date')} AS selected_reference_date, selection_rule FROM sup_ekko")
    q["reference_check_hot_keys"] = _with(
        "SELECT t.MANDT, t.EBELN, t.EBELP, t.WERKS, r.WERKS IS NOT NULL AS is_mapped, r.BRANCH_NAME AS branch_name "
        "FROM s_ekpo t LEFT JOIN v_branch_mapping r ON r.WERKS = t.WERKS")
    q["reference_check"] = _with(
        "SELECT MANDT, VBELN, POSNR, list_contains(_err, 'UNRESOLVED_REFERENCE:order_item') AS unresolved_order_item, "
        "list_contains(_err, 'UNRESOLVED_REFERENCE:delivery') AS unresolved_delivery, "
        "list_contains(_err, 'UNRESOLVED_REFERENCE:order') AS unresolved_order FROM s_lips")
    q["field_agreement"] = _with(
        "SELECT * FROM (SELECT 'ekpo' AS source_table, to_json({'MANDT': MANDT, 'EBELN': EBELN, 'EBELP': EBELP}) "
        "AS candidate_key, unnest(_err) AS reason FROM s_ekpo UNION ALL "
        "SELECT 'lips', to_json({'MANDT': MANDT, 'VBELN': VBELN, 'POSNR': POSNR}), unnest(_err) FROM s_lips) r "
        "WHERE regexp_matches(reason, 'MISMATCH')")
    summary_parts = []
    for name in SPECS:
        sup = "(SELECT count(*) FROM sup_ekko)" if name == "ekko" else "0"
        summary_parts.append(
            f"SELECT '{name}' AS source_table, (SELECT sum(_occ) FROM d_{name}) AS bronze_rows, "
            f"(SELECT count(*) FROM d_{name}) AS distinct_rows, "
            f"(SELECT count(*) FROM s_{name} WHERE len(_err) = 0) AS silver_rows, "
            f"(SELECT count(*) FROM s_{name} WHERE len(_err) > 0) AS quarantine_rows, {sup} AS superseded_rows")
    q["load_summary"] = _with(
        "SELECT source_table, CAST(bronze_rows AS BIGINT) AS bronze_rows, "
        "CAST(bronze_rows - distinct_rows AS BIGINT) AS duplicate_rows_removed, CAST(distinct_rows AS BIGINT) AS distinct_rows, "
        "CAST(silver_rows AS BIGINT) AS silver_rows, CAST(quarantine_rows AS BIGINT) AS quarantine_rows, "
        "CAST(superseded_rows AS BIGINT) AS superseded_rows, "
        "distinct_rows = silver_rows + quarantine_rows + superseded_rows AS is_reconciled FROM ("
        + _union(summary_parts) + ") t")
    q["fifo_allocation"] = _with(_select(_cols(
        "MANDT:s EBELN:s EBELP:s ETENR:s EINDT:d WERKS:s LIFNR:s MATNR:s MEINS:s VBELN:s POSNR:s WADAT_IST:d "
        "allocated_quantity:n report_month:d allocation_rule:s is_inferred:b"), "allocations"))
    q["fifo_allocation_hot_keys"] = _with(f"""
SELECT p.MANDT, p.WERKS, p.EBELN, p.EBELP, p.ETENR, CAST(p.EINDT AS VARCHAR) AS EINDT, d.VBELN, d.POSNR,
       CAST(d.WADAT_IST AS VARCHAR) AS WADAT_IST,
       {dbl('least(p.pe, d.de) - greatest(p.pe - p.schedule_quantity, d.de - d.LFIMG)')} AS allocated_quantity
FROM hp p JOIN hd d ON p.MANDT = d.MANDT AND p.WERKS = d.WERKS
 AND p.pe - p.schedule_quantity < d.de AND d.de - d.LFIMG < p.pe""", [("hp", f"""SELECT MANDT, WERKS, EBELN, EBELP, ETENR, EINDT, schedule_quantity,
              sum(schedule_quantity) OVER (PARTITION BY MANDT, WERKS ORDER BY EINDT, EBELN, ETENR
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pe
            FROM sched_cands WHERE len(exclusion_reasons) = 0"""), ("hd", f"""SELECT MANDT, WERKS, VBELN, POSNR, WADAT_IST, LFIMG,
              sum(LFIMG) OVER (PARTITION BY MANDT, WERKS ORDER BY WADAT_IST, VBELN, POSNR
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS de
            FROM deliveries WHERE WADAT_IST <= {AS_OF}""")])
    q["published_load"] = _with(" UNION ALL ".join(f"SELECT 'bronze_{n}' AS table_name, count(*) AS row_count FROM b_{n}" for n in SPECS))
    q["quoted_line_breaks"] = _with("SELECT nullif(MANDT, '') AS MANDT, nullif(EBELN, '') AS EBELN, nullif(EBELP, '') AS EBELP, "
                                    "concat(TXZ01, chr(10), '\"', MATNR, '\";', chr(10), chr(10), WERKS) AS TXZ01, nullif(MENGE, '') AS MENGE FROM b_ekpo")
    q["schedule_performance"] = _with(_select(_cols(
        "MANDT:s EBELN:s EBELP:s ETENR:s EINDT:d schedule_quantity:n LIFNR:s NAME1:s WERKS:s report_month:d "
        "evaluation_date:d exclusion_reasons:a is_allocatable:b is_evaluable:b allocated_quantity:n "
        "allocated_by_due_quantity:n allocated_by_month_end_quantity:n last_allocated_delivery_date:d on_time:b "
        "in_full:b fill_rate:n shortfall_qty:n completion_date:d allocation_rule:s metric_basis:s"), "sched_perf"))
    q["delivery_balance"] = _with(_select(_cols(
        "MANDT:s EBELN:s EBELP:s VBELN:s POSNR:s MATNR:s MEINS:s WERKS:s LFIMG:n WADAT_IST:d allocated_quantity:n "
        "unallocated_quantity:n allocation_status:s"), "balance"))
    q["order_item_final_date"] = _with(_select(_cols(
        "MANDT:s EBELN:s EBELP:s LIFNR:s NAME1:s WERKS:s MATNR:s BEDAT:d ordered_qty:n first_due_date:d "
        "final_due_date:d scheduled_qty:n schedule_count:i quarantined_sources:a report_month:d evaluation_date:d "
        "delivered_by_due_qty:n delivered_by_month_end_qty:n exclusion_reasons:a is_evaluable:b on_time:b "
        "in_full:b fill_rate:n shortfall_qty:n _is_deleted:b"), "item_perf"))
    q["delivery_evidence"] = _with(_select(_cols(
        "MANDT:s EBELN:s EBELP:s VBELN:s POSNR:s WADAT_IST:d LFIMG:n LIFNR:s final_due_date:d evaluation_date:d "
        "by_due_date:b by_month_end:b after_cutoff:b is_evaluable:b exclusion_reasons:a"),
        f"(SELECT e.*, i.is_evaluable, i.exclusion_reasons FROM evidence e LEFT JOIN item_perf i ON {on('i', 'e', ITEM)}) t"))
    q["exclusion_counts"] = _with(_select(_cols("reason:s item_or_record_count:i"), "quality"))
    q["quarantine_attribution"] = _with(_select(_cols("MANDT:s EBELN:s EBELP:s quarantined_sources:a"), "issues"))
    q["unassigned_quarantine"] = _with(f"SELECT source_table, _raw AS raw_record, {arr('_err')} AS dq_errors FROM unassigned")
    monthly_cols = ("report_month:d scope:s WERKS:s LIFNR:s NAME1:s candidate_items:i evaluated_items:i on_time_rate:n "
                    "in_full_rate:n mean_fill_rate:n excluded_items:i coverage_rate:n score:n ranking_eligible:b "
                    "min_items:i metric_basis:s")
    q["supplier_monthly"] = _with(_select(_cols(monthly_cols), "monthly"))
    q["worst_suppliers"] = _with(_select(_cols(monthly_cols + " worst_rank:i"), "worst"))
    scope_all = "report_scope = 'ALL'"
    scope_branch = f"report_scope = 'BRANCH' AND branch_code = '{BRANCH}'"
    q["monthly_trend"] = _with(f"""
SELECT CAST(report_month AS VARCHAR) AS report_month, CAST(sum(evaluated_schedule_line_count) AS BIGINT) AS evaluated_schedule_line_count,
  {dbl('sum(on_time_rate * evaluated_schedule_line_count) / nullif(sum(evaluated_schedule_line_count), 0)')} AS on_time_rate,
  {dbl('sum(in_full_rate * evaluated_schedule_line_count) / nullif(sum(evaluated_schedule_line_count), 0)')} AS in_full_rate,
  {dbl('CAST(sum(evaluated_schedule_line_count) AS DOUBLE) / nullif(sum(candidate_schedule_line_count), 0)')} AS evaluation_coverage_rate
FROM pub_monthly WHERE {scope_all} GROUP BY report_month""")
    w = ("CASE WHEN sum(evaluated_schedule_line_count) > 0 THEN coalesce(sum(CASE WHEN {r} IS NOT NULL AND "
         "evaluated_schedule_line_count > 0 THEN {r} * evaluated_schedule_line_count END), 0) / "
         "sum(evaluated_schedule_line_count) END")
    q["month_summary"] = _with(f"""
SELECT CAST(report_month AS VARCHAR) AS report_month, count(*) AS supplier_rows,
  CAST(sum(evaluated_schedule_line_count) AS BIGINT) AS evaluated_schedule_line_count,
  CAST(sum(candidate_schedule_line_count) AS BIGINT) AS candidate_schedule_line_count,
  {dbl(w.format(r='on_time_rate'))} AS on_time_rate, {dbl(w.format(r='in_full_rate'))} AS in_full_rate,
  {dbl('CAST(sum(evaluated_schedule_line_count) AS DOUBLE) / nullif(sum(candidate_schedule_line_count), 0)')} AS evaluation_coverage_rate
FROM pub_monthly WHERE {scope_branch} GROUP BY report_month""")
    q["selection_status"] = _with(f"""
SELECT CAST(f.report_month AS VARCHAR) AS report_month, f.n AS supplier_rows_in_selection,
       CAST(f.first_cutoff AS VARCHAR) AS first_cutoff, CAST(f.last_cutoff AS VARCHAR) AS last_cutoff,
       f.ev AS evaluated_schedule_line_count, coalesce(r.k, 0) AS ranked_suppliers,
       CASE WHEN f.n = 0 THEN 'NO_DATA' WHEN f.ev = 0 THEN 'NO_EVALUABLE_LINES'
            WHEN coalesce(r.k, 0) = 0 THEN 'NO_ELIGIBLE_SUPPLIERS' ELSE 'OK' END AS selection_status,
       f.first_cutoff <> f.last_cutoff AS mixed_cutoffs
FROM (SELECT report_month, count(*) AS n, min(as_of_date) AS first_cutoff, max(as_of_date) AS last_cutoff,
             CAST(sum(evaluated_schedule_line_count) AS BIGINT) AS ev FROM pub_monthly WHERE {scope_all}
      GROUP BY report_month) f
LEFT JOIN (SELECT report_month, count(*) AS k FROM pub_worst WHERE {scope_all} GROUP BY report_month) r
  ON r.report_month = f.report_month""")
    q["supplier_comparison"] = _with(f"""
SELECT CAST(report_month AS VARCHAR) AS report_month, supplier_id, {dbl('performance_score')} AS performance_score,
       CAST(evaluated_schedule_line_count AS BIGINT) AS evaluated_schedule_line_count,
       row_number() OVER (PARTITION BY report_month ORDER BY performance_score ASC NULLS LAST, supplier_id) AS comparison_position
FROM pub_monthly WHERE {scope_all} AND evaluated_schedule_line_count > 0 AND performance_score IS NOT NULL""")
    q["ranked_evidence"] = _with(f"""
SELECT p.MANDT AS sap_client_id, p.EBELN AS purchase_order_id, p.EBELP AS purchase_order_item_id,
       p.ETENR AS schedule_line_id, p.LIFNR AS supplier_id, CAST(p.report_month AS VARCHAR) AS report_month,
       p.is_evaluable, p.on_time AS is_on_time, p.in_full AS is_in_full
FROM sched_perf p WHERE EXISTS (SELECT 1 FROM pub_worst w WHERE {scope_all} AND w.supplier_id = p.LIFNR
                                AND w.report_month = p.report_month)""")
    q["drill_down"] = _with(f"""
SELECT a.WERKS AS branch_code, a.MANDT AS sap_client_id, a.EBELN AS purchase_order_id, a.EBELP AS purchase_order_item_id,
       a.ETENR AS schedule_line_id, CAST(a.EINDT AS VARCHAR) AS scheduled_delivery_date, a.LIFNR AS supplier_id,
       a.MATNR AS material_id, a.MEINS AS quantity_unit, a.VBELN AS delivery_id, a.POSNR AS delivery_item_id,
       CAST(a.WADAT_IST AS VARCHAR) AS actual_delivery_date, {dbl('a.allocated_quantity')} AS allocated_quantity,
       CAST(a.report_month AS VARCHAR) AS report_month, a.allocation_rule, a.is_inferred, b.branch_name,
       CASE WHEN a.WERKS IS NULL THEN 'NOT_APPLICABLE' WHEN b.branch_name IS NULL THEN 'UNMAPPED' ELSE 'MAPPED' END
         AS branch_mapping_status, CAST({AS_OF} AS VARCHAR) AS as_of_date
FROM allocations a LEFT JOIN branches b ON b.branch_code = a.WERKS WHERE a.WERKS = '{BRANCH}'""")
    place = "row_number() OVER (ORDER BY {o}) AS listing_position"
    q["ranking_listing"] = _with(f"""
SELECT CAST(report_month AS VARCHAR) AS report_month, CAST(worst_supplier_rank AS BIGINT) AS worst_supplier_rank, supplier_id, supplier_name,
       {dbl('performance_score')} AS performance_score, {place.format(o='report_month NULLS FIRST, worst_supplier_rank')}
FROM pub_worst WHERE {scope_all}""")
    q["supplier_listing"] = _with(f"""
SELECT CAST(report_month AS VARCHAR) AS report_month, supplier_id, {dbl('performance_score')} AS performance_score,
       CAST(evaluated_schedule_line_count AS BIGINT) AS evaluated_schedule_line_count,
       {place.format(o='report_month NULLS FIRST, performance_score ASC NULLS LAST, supplier_id NULLS FIRST')}
FROM pub_monthly WHERE {scope_all}""")
    q["evidence_listing"] = _with(f"""
SELECT CAST(p.report_month AS VARCHAR) AS report_month, p.LIFNR AS supplier_id, p.MANDT AS sap_client_id, p.EBELN AS purchase_order_id,
       p.EBELP AS purchase_order_item_id, p.ETENR AS schedule_line_id, {place.format(o='p.report_month, p.LIFNR, p.MANDT, p.EBELN, p.EBELP, p.ETENR')}
FROM sched_perf p JOIN (SELECT DISTINCT report_month, supplier_id FROM pub_worst WHERE {scope_all}) w
  ON w.supplier_id = p.LIFNR AND w.report_month = p.report_month""")
    q["performance_listing"] = _with(f"""
SELECT EBELN AS purchase_order_id, EBELP AS purchase_order_item_id, CAST(EINDT AS VARCHAR) AS scheduled_delivery_date, ETENR AS schedule_line_id,
       LIFNR AS supplier_id, {dbl('allocated_quantity')} AS allocated_quantity, {place.format(o='EBELN, EBELP, EINDT NULLS FIRST, ETENR')}
FROM sched_perf WHERE WERKS = '{BRANCH}'""")
    q["balance_listing"] = _with(f"""
SELECT MANDT AS sap_client_id, CAST(WADAT_IST AS VARCHAR) AS actual_delivery_date, VBELN AS delivery_id, POSNR AS delivery_item_id,
       {dbl('unallocated_quantity')} AS unallocated_quantity, allocation_status, {place.format(o='MANDT, WADAT_IST NULLS FIRST, VBELN, POSNR')}
FROM balance WHERE WERKS = '{BRANCH}'""")
    q["item_listing"] = _with(f"""
SELECT WERKS AS branch_code, EBELN AS purchase_order_id, EBELP AS purchase_order_item_id, LIFNR AS supplier_id,
       {dbl('MENGE')} AS ordered_quantity, {place.format(o='EBELN, EBELP')}
FROM order_items WHERE WERKS = '{BRANCH}' AND EBELP = '00010'""")
    q["quality_listing"] = _with(_select(_cols("reason:s item_or_record_count:i listing_position:i"),
                                         "(SELECT *, row_number() OVER (ORDER BY reason) AS listing_position FROM quality) t"))
    label = ("b.branch_name, CASE WHEN {w} IS NULL THEN 'NOT_APPLICABLE' WHEN b.branch_name IS NULL THEN 'UNMAPPED' "
             "ELSE 'MAPPED' END AS branch_mapping_status, CAST(" + AS_OF + " AS VARCHAR) AS as_of_date")
    q["order_items_mart"] = _with(f"""
SELECT o.WERKS AS branch_code, o.LIFNR AS supplier_id, o.MANDT AS sap_client_id, o.EBELN AS purchase_order_id,
       o.EBELP AS purchase_order_item_id, o.MATNR AS material_id, o.TXZ01 AS item_description,
       {dbl('o.MENGE')} AS ordered_quantity, o.MEINS AS quantity_unit, {dbl('o.NETPR')} AS net_unit_price,
       {dbl('o.NETWR')} AS net_order_value, o._is_deleted AS is_deleted, CAST(o.BEDAT AS VARCHAR) AS order_date,
       o.WAERS AS currency_code, o.NAME1 AS supplier_name, {label.format(w='o.WERKS')}
FROM order_items o LEFT JOIN branches b ON b.branch_code = o.WERKS""")
    q["delivery_items_mart"] = _with(f"""
SELECT d.WERKS AS branch_code, d.MANDT AS sap_client_id, d.EBELN AS purchase_order_id, d.EBELP AS purchase_order_item_id,
       d.VBELN AS delivery_id, d.POSNR AS delivery_item_id, d.MATNR AS material_id, d.MEINS AS quantity_unit,
       {dbl('d.LFIMG')} AS delivered_quantity, CAST(d.WADAT_IST AS VARCHAR) AS actual_delivery_date,
       o.LIFNR AS supplier_id, o.NAME1 AS supplier_name, CAST(o.BEDAT AS VARCHAR) AS order_date,
       o.TXZ01 AS item_description, {label.format(w='d.WERKS')}
FROM deliveries d LEFT JOIN order_items o ON {on('o', 'd', ITEM)} LEFT JOIN branches b ON b.branch_code = d.WERKS""")
    q["schedule_lines_mart"] = _with(f"""
SELECT o.WERKS AS branch_code, s.MANDT AS sap_client_id, s.EBELN AS purchase_order_id, s.EBELP AS purchase_order_item_id,
       s.ETENR AS schedule_line_id, CAST(s.EINDT AS VARCHAR) AS scheduled_delivery_date,
       {dbl('s.MENGE')} AS scheduled_quantity, {dbl('s.WEMNG')} AS recorded_received_quantity,
       o.LIFNR AS supplier_id, o.NAME1 AS supplier_name, o.MATNR AS material_id, o.MEINS AS quantity_unit,
       {label.format(w='o.WERKS')}
FROM v_eket s JOIN order_items o ON {on('o', 's', ITEM)} LEFT JOIN branches b ON b.branch_code = o.WERKS""")
    q["branch_labels"] = _with("SELECT CAST(report_month AS VARCHAR) AS report_month, report_scope, branch_code, "
                               "supplier_id, branch_name, branch_mapping_status FROM pub_monthly")
    pm = ("branch_code:s report_month:d report_scope:s supplier_id:s supplier_name:s candidate_schedule_line_count:i "
          "evaluated_schedule_line_count:i on_time_rate:n in_full_rate:n mean_quantity_fill_rate:n "
          "excluded_schedule_line_count:i evaluation_coverage_rate:n performance_score:n is_ranking_eligible:b "
          "minimum_schedule_line_count:i metric_basis:s branch_name:s branch_mapping_status:s as_of_date:d")
    q["row_filter_branch"] = _with(_select(_cols(pm), "pub_monthly", f"report_scope = 'BRANCH' AND branch_code IN ('{BRANCH}')"))
    q["invariant_checks"] = _with(f"""
SELECT check_name, CAST(violations AS BIGINT) AS violations, CASE WHEN violations = 0 THEN 'PASS' ELSE 'CHECK' END AS status
FROM (
  SELECT 'GOLD_ITEMS_PRESENT' AS check_name, CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS violations FROM sched_perf
  UNION ALL SELECT 'EVALUABLE_SCHEDULES_HAVE_KPI', count(*) FROM sched_perf
    WHERE is_evaluable AND (on_time IS NULL OR in_full IS NULL OR fill_rate IS NULL)
  UNION ALL SELECT 'EXCLUDED_SCHEDULES_HAVE_NO_KPI', count(*) FROM sched_perf
    WHERE NOT is_evaluable AND (on_time IS NOT NULL OR in_full IS NOT NULL OR fill_rate IS NOT NULL)
  UNION ALL SELECT 'SCHEDULE_ALLOCATION_LIMIT', count(*) FROM sched_perf WHERE allocated_quantity > schedule_quantity
  UNION ALL SELECT 'UNIQUE_SCHEDULE_KEY', count(*) FROM (SELECT MANDT, EBELN, EBELP, ETENR FROM sched_perf
    GROUP BY MANDT, EBELN, EBELP, ETENR HAVING count(*) > 1) d
  UNION ALL SELECT 'MONTHLY_COUNTS_BALANCE', count(*) FROM monthly WHERE candidate_items <> evaluated_items + excluded_items
  UNION ALL SELECT 'MONTHLY_RATES_IN_RANGE', count(*) FROM monthly WHERE on_time_rate NOT BETWEEN 0 AND 1
    OR in_full_rate NOT BETWEEN 0 AND 1 OR mean_fill_rate NOT BETWEEN 0 AND 1 OR score NOT BETWEEN 0 AND 1
    OR coverage_rate NOT BETWEEN 0 AND 1
  UNION ALL SELECT 'EVALUATED_MONTHS_HAVE_RATES', count(*) FROM monthly
    WHERE evaluated_items > 0 AND (on_time_rate IS NULL OR in_full_rate IS NULL OR score IS NULL)
  UNION ALL SELECT 'DELIVERY_QUANTITY_BALANCE', count(*) FROM balance
    WHERE unallocated_quantity < 0 OR LFIMG <> allocated_quantity + unallocated_quantity
) c""")
    q["published_grain_check"] = _with(f"""
SELECT check_name, CAST(violations AS BIGINT) AS violations, CASE WHEN violations = 0 THEN 'PASS' ELSE 'CHECK' END AS status
FROM (
  SELECT 'DUPLICATE_GRAIN' AS check_name, count(*) AS violations FROM (SELECT 1 FROM pub_monthly
    GROUP BY report_month, report_scope, branch_code, supplier_id HAVING count(*) > 1) d
  UNION ALL SELECT 'INVALID_COUNTS', count(*) FROM pub_monthly WHERE candidate_schedule_line_count < 0
    OR evaluated_schedule_line_count < 0 OR excluded_schedule_line_count < 0
  UNION ALL SELECT 'CUTOFF_MISMATCH', count(*) FROM pub_monthly WHERE as_of_date IS NULL OR as_of_date <> {AS_OF}
  UNION ALL SELECT 'UNKNOWN_SCOPE', count(*) FROM pub_monthly WHERE report_scope NOT IN ('ALL', 'BRANCH')
  UNION ALL SELECT 'OPEN_MONTH_ROWS', count(*) FROM pub_monthly WHERE last_day(report_month) > {AS_OF}
) c""")
    return q


def _ekko_norm(fields: list[str]) -> str:
    inner = "SELECT DISTINCT " + ", ".join(fields) + " FROM b_ekko"
    return (f"SELECT {norm('MANDT')} AS MANDT, {norm('EBELN')} AS EBELN, "
            f"{date_sql(norm('AEDAT'))} AS a FROM ({inner}) d")


assert set(EXTRACTS) == set(RAW_FIELDS)
