"""Shared-table bindings: the TPC-H-like tables as raw purchasing extracts.

Each extract is one SQL text in the subset both Spark SQL and DuckDB accept
(``CAST``, ``lpad``, ``%``, ``||``, date ± integer, ``CASE``, joins, groups).
Spark runs it with the tables passed as DataFrames; the DuckDB oracle embeds the
same text as a CTE, so both engines validate the very same raw strings while the
operators under test are implemented separately.

Every value is a string, like a delimited extract. Defects are derived from
the keys with ``%`` so they scale with the data:
  * formats: ISO / German / padded / impossible dates; dot, comma, signed,
    seven-digit, thousands-separated, negative, zero and blank numbers;
  * exact duplicates (a second file), newer / tied / undated header versions,
    naturally shared line keys (conflicts), blank key parts (unassignable);
  * unit, plant and supplier disagreements, unknown deletion flags.

The plant code of an order is ``2000 + 100 * region`` of its customer; region 4
has no branch-mapping row, so its plant stays UNMAPPED.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def zpad(expr: str, width: int) -> str:
    """Zero-padded identifier text; wider numbers are kept whole, never cut."""
    text = f"CAST({expr} AS STRING)"
    return f"lpad({text}, CAST(greatest({width}, length({text})) AS INT), '0')"


def date_text(day: str, selector: str, impossible: str | None = None) -> str:
    """Render a DATE as ISO, German ``dd.MM.yyyy`` or space-padded ISO text."""
    iso = f"CAST({day} AS STRING)"
    german = f"substr({iso}, 9, 2) || '.' || substr({iso}, 6, 2) || '.' || substr({iso}, 1, 4)"
    bad = f"WHEN {impossible} THEN substr({iso}, 1, 4) || '-02-30' " if impossible else ""
    return (f"CASE {bad}WHEN {selector} % 10 = 3 THEN {german} "
            f"WHEN {selector} % 10 = 7 THEN '  ' || {iso} || ' ' ELSE {iso} END")


def _plant(alias_n: str = "n") -> str:
    return f"CAST(2000 + 100 * {alias_n}.n_regionkey AS STRING)"


BRANCH_MAPPING = """
SELECT CAST(2000 + 100 * r_regionkey AS STRING) AS WERKS, r_name AS BRANCH_NAME,
       'BRANCH_MAPPING.csv' AS _source_file
FROM {region} WHERE r_regionkey < 4
"""

LFA1 = f"""
WITH v AS (
  SELECT {zpad('s_suppkey', 10)} AS LIFNR,
         CASE WHEN s_suppkey % 17 = 5 THEN s_name || ' ' ELSE s_name END AS NAME1,
         CASE WHEN s_suppkey % 13 = 7 THEN CAST(NULL AS STRING)
              ELSE 'N' || CAST(s_nationkey AS STRING) END AS LAND1,
         'CITY ' || CAST(s_nationkey AS STRING) AS ORT01,
         'STREET ' || CAST(s_suppkey AS STRING) AS STRAS,
         CASE WHEN s_suppkey % 7 = 3 THEN 'eur' ELSE 'EUR' END AS WAERS,
         s_suppkey AS k
  FROM {{supplier}})
SELECT LIFNR, NAME1, LAND1, ORT01, STRAS, WAERS, 'LFA1_VENDOR_MASTER.csv' AS _source_file FROM v
UNION ALL
SELECT LIFNR, NAME1, LAND1, ORT01, STRAS, WAERS, 'LFA1_VENDOR_MASTER_2.csv' FROM v WHERE k % 19 = 3
UNION ALL
SELECT LIFNR, NAME1 || ' GMBH', LAND1, ORT01, STRAS, WAERS, 'LFA1_VENDOR_MASTER.csv' FROM v WHERE k % 23 = 4
UNION ALL
SELECT LIFNR, ' ' || NAME1, LAND1, ORT01, STRAS, WAERS, 'LFA1_VENDOR_MASTER.csv' FROM v WHERE k % 29 = 6
"""

MARA = f"""
SELECT {zpad('p_partkey', 12)} AS MATNR, p_name AS MAKTX, 'HAWA' AS MTART,
       CASE WHEN p_partkey % 211 = 0 THEN CAST(NULL AS STRING)
            WHEN p_partkey % 9 = 4 THEN lower(p_type) ELSE p_type END AS MEINS,
       p_brand AS MATKL, 'MARA_MATERIAL_MASTER.csv' AS _source_file
FROM {{part}}
"""

_EKKO_COLUMNS = "MANDT, EBELN, BUKRS, BSTYP, BSART, LIFNR, EKORG, EKGRP, WAERS, BEDAT, AEDAT, ERNAM"
EKKO = f"""
WITH lo AS (SELECT l_orderkey, min(l_suppkey) AS vend FROM {{lineitem}} GROUP BY l_orderkey),
h AS (
  SELECT o.o_orderkey AS k, CAST(o.o_orderdate AS DATE) AS d, lo.vend
  FROM {{orders}} o LEFT JOIN lo ON lo.l_orderkey = o.o_orderkey),
r AS (
  SELECT '300' AS MANDT, {zpad('k', 10)} AS EBELN, '2000' AS BUKRS, 'F' AS BSTYP, 'NB' AS BSART,
         CASE WHEN vend IS NULL THEN '' ELSE {zpad('vend', 10)} END AS LIFNR, '2000' AS EKORG,
         'B0' || CAST(k % 5 AS STRING) AS EKGRP, 'EUR' AS WAERS,
         {date_text('d', 'k', 'k % 97 = 11')} AS BEDAT,
         CASE WHEN k % 4 = 1 THEN {date_text('d + CAST(k % 20 AS INT)', '3')}
              ELSE CAST(d + CAST(k % 20 AS INT) AS STRING) END AS AEDAT,
         'USER' || CAST(k % 3 AS STRING) AS ERNAM, k, d
  FROM h)
SELECT {_EKKO_COLUMNS}, 'EKKO_PO_HEADER.csv' AS _source_file FROM r
UNION ALL
SELECT {_EKKO_COLUMNS}, 'EKKO_PO_HEADER_2.csv' FROM r WHERE k % 43 = 8
UNION ALL
SELECT MANDT, EBELN, BUKRS, BSTYP, BSART, LIFNR, EKORG, 'B9', WAERS, BEDAT,
       CAST(d + 40 AS STRING), ERNAM, 'EKKO_PO_HEADER.csv' FROM r WHERE k % 31 = 2
UNION ALL
SELECT MANDT, EBELN, BUKRS, BSTYP, BSART, LIFNR, EKORG, 'B8', WAERS, BEDAT, AEDAT, ERNAM,
       'EKKO_PO_HEADER.csv' FROM r WHERE k % 37 = 5
UNION ALL
SELECT MANDT, EBELN, BUKRS, BSTYP, BSART, LIFNR, EKORG, 'B7', WAERS, BEDAT, '', ERNAM,
       'EKKO_PO_HEADER.csv' FROM r WHERE k % 41 = 6
"""

EKPO = f"""
WITH lo AS (SELECT l_orderkey, min(l_partkey) AS mat, sum(l_quantity) AS qty
            FROM {{lineitem}} GROUP BY l_orderkey),
i AS (
  SELECT o.o_orderkey AS k, lo.mat, CAST(lo.qty AS BIGINT) AS q, o.o_orderpriority AS prio,
         o.o_totalprice AS price, {_plant()} AS werks, p.p_type AS unit, p.p_name AS pname
  FROM {{orders}} o JOIN lo ON lo.l_orderkey = o.o_orderkey
  LEFT JOIN {{customer}} c ON c.c_custkey = o.o_custkey
  LEFT JOIN {{nation}} n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN {{part}} p ON p.p_partkey = lo.mat)
SELECT '300' AS MANDT, {zpad('k', 10)} AS EBELN, '00010' AS EBELP, {zpad('mat', 12)} AS MATNR,
       pname AS TXZ01, werks AS WERKS,
       CASE WHEN k % 109 = 16 THEN ''
            WHEN k % 107 = 15 THEN '0'
            WHEN k % 103 = 14 THEN '-' || CAST(q AS STRING)
            WHEN k % 101 = 13 THEN CAST(q AS STRING) || '.0000000'
            WHEN k % 113 = 17 THEN '1.' || lpad(CAST(q AS STRING), 3, '0') || ',0'
            WHEN k % 7 = 1 THEN CAST(q AS STRING) || ',00'
            WHEN k % 7 = 2 THEN '+' || CAST(q AS STRING)
            WHEN k % 7 = 3 THEN CAST(q AS STRING) || '.000'
            ELSE CAST(q AS STRING) END AS MENGE,
       CASE WHEN k % 53 = 9 THEN 'XX' ELSE unit END AS MEINS,
       CAST(CAST(floor(price / q) AS BIGINT) AS STRING)
         || CASE WHEN k % 5 = 0 THEN ',5' ELSE '.25' END AS NETPR,
       CAST(CAST(floor(price) AS BIGINT) AS STRING) AS NETWR,
       CASE WHEN k % 127 = 18 THEN 'X'
            WHEN prio = '4-NOT SPECIFIED' THEN CASE WHEN k % 2 = 0 THEN 'L' ELSE ' l' END
            WHEN k % 3 = 0 THEN ' ' ELSE CAST(NULL AS STRING) END AS LOEKZ,
       'EKPO_PO_ITEM.csv' AS _source_file
FROM i
"""

_EKET_COLUMNS = "MANDT, EBELN, EBELP, ETENR, EINDT, MENGE, WEMNG"
EKET = f"""
WITH s AS (
  SELECT l.l_orderkey AS k, l.l_linenumber AS ln, l.l_partkey AS pk, CAST(l.l_quantity AS BIGINT) AS q,
         CAST(o.o_orderdate AS DATE) AS od
  FROM {{lineitem}} l JOIN {{orders}} o ON o.o_orderkey = l.l_orderkey),
t AS (SELECT k, ln, pk, q, CASE WHEN pk % 97 = 0 THEN od - 1 ELSE od + (30 + 15 * ln) END AS due FROM s),
r AS (
  SELECT '300' AS MANDT, CASE WHEN pk % 233 = 7 THEN ' ' ELSE {zpad('k', 10)} END AS EBELN,
         '00010' AS EBELP, {zpad('ln', 4)} AS ETENR,
         {date_text('due', 'pk', 'pk % 211 = 5')} AS EINDT,
         CASE WHEN pk % 199 = 3 THEN '12a'
              WHEN pk % 193 = 4 THEN '0'
              WHEN pk % 8 = 1 THEN CAST(q AS STRING) || '.000'
              WHEN pk % 8 = 2 THEN CAST(q AS STRING) || ',0'
              WHEN pk % 8 = 3 THEN '+' || CAST(q AS STRING)
              ELSE CAST(q AS STRING) END AS MENGE,
         CASE WHEN pk % 89 = 3 THEN CAST(q + 5 AS STRING)
              WHEN pk % 5 = 1 THEN CAST(q AS STRING) ELSE '' END AS WEMNG,
         k, pk
  FROM t)
SELECT {_EKET_COLUMNS}, 'EKET_SCHEDULE_LINES.csv' AS _source_file FROM r
UNION ALL
SELECT {_EKET_COLUMNS}, 'EKET_SCHEDULE_LINES_2.csv' FROM r WHERE (k + pk) % 47 = 0
"""

LIKP = f"""
WITH lo AS (SELECT l_orderkey, min(l_suppkey) AS vend FROM {{lineitem}} GROUP BY l_orderkey),
g AS (SELECT l_orderkey AS k, l_linenumber AS ln, min(l_partkey) AS pk, min(l_suppkey) AS sk
      FROM {{lineitem}} WHERE l_returnflag <> 'R' GROUP BY l_orderkey, l_linenumber),
h AS (
  SELECT g.k, g.ln, g.pk, g.sk, CAST(o.o_orderdate AS DATE) AS od, lo.vend, {_plant()} AS werks
  FROM g JOIN {{orders}} o ON o.o_orderkey = g.k
  JOIN lo ON lo.l_orderkey = g.k
  LEFT JOIN {{customer}} c ON c.c_custkey = o.o_custkey
  LEFT JOIN {{nation}} n ON n.n_nationkey = c.c_nationkey)
SELECT '300' AS MANDT, {zpad('k * 10 + ln', 11)} AS VBELN,
       {zpad('CASE WHEN k % 59 = 3 THEN sk ELSE vend END', 10)} AS LIFNR,
       {date_text('od + CAST((7 * pk + 13 * ln) % 90 AS INT) - 2', 'k + ln')} AS WADAT_IST,
       CASE WHEN k % 61 = 4 THEN '2900' ELSE werks END AS WERKS,
       'LIKP_DELIVERY_HEADER.csv' AS _source_file
FROM h
"""

LIPS = f"""
WITH lo AS (SELECT l_orderkey, min(l_partkey) AS mat FROM {{lineitem}} GROUP BY l_orderkey),
d AS (
  SELECT l.l_orderkey AS k, l.l_linenumber AS ln, l.l_partkey AS pk, CAST(l.l_quantity AS BIGINT) AS q,
         lo.mat, p.p_type AS unit, {_plant()} AS werks
  FROM {{lineitem}} l JOIN lo ON lo.l_orderkey = l.l_orderkey
  JOIN {{orders}} o ON o.o_orderkey = l.l_orderkey
  LEFT JOIN {{customer}} c ON c.c_custkey = o.o_custkey
  LEFT JOIN {{nation}} n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN {{part}} p ON p.p_partkey = lo.mat
  WHERE l.l_returnflag <> 'R')
SELECT '300' AS MANDT, {zpad('k * 10 + ln', 11)} AS VBELN, '000010' AS POSNR,
       {zpad('k', 10)} AS EBELN, '00010' AS EBELP, {zpad('mat', 12)} AS MATNR,
       CASE WHEN pk % 79 = 6 THEN '0'
            WHEN pk % 6 = 1 THEN CAST(q AS STRING) || ',000'
            ELSE CAST(q AS STRING) END AS LFIMG,
       CASE WHEN pk % 71 = 2 THEN 'KG' ELSE unit END AS MEINS,
       werks AS WERKS, 'LIPS_DELIVERY_ITEM.csv' AS _source_file
FROM d
"""

EXTRACTS: dict[str, str] = {
    "branch_mapping": BRANCH_MAPPING, "lfa1": LFA1, "mara": MARA, "ekko": EKKO,
    "ekpo": EKPO, "eket": EKET, "likp": LIKP, "lips": LIPS,
}


def load_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


def bronze_extract(spark: SparkSession, tables: dict[str, DataFrame], name: str) -> DataFrame:
    """One raw extract as strings with ``_source_file`` and ``_loaded_at`` provenance."""
    text = EXTRACTS[name]
    used = {t: df for t, df in tables.items() if "{" + t + "}" in text}
    frame = spark.sql(text, **used)
    return frame.withColumn("_loaded_at", F.current_timestamp())


def bronze_extracts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tables = load_tables(spark, sf_dir)
    return {name: bronze_extract(spark, tables, name) for name in EXTRACTS}


def duckdb_extract(name: str) -> str:
    """The same extract for DuckDB, where the tables are plain views."""
    text = EXTRACTS[name]
    for t in TABLES:
        text = text.replace("{" + t + "}", t)
    return text
