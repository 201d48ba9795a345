"""Rule compiler: raw string extract → typed rows with ordered reason codes.

``validate`` turns one :class:`~otif.model.TableSpec` into a plan (one aggregation
first finds its frequent keys, its own and those of its parents):
bring the records of a key together → collapse exact duplicates → normalise text →
per-key variant counts (and version resolution for the versioned table) →
parent lookups → parse dates and numbers → one projection that evaluates every
rule into ``_dq_errors`` and writes the raw record of rejected and superseded
rows as JSON. Valid rows, quarantine and the load summary are all
filters/aggregates of that one frame (DQ-14), so the pipeline computes it once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from otif.functions import normalise_code, parse_date, parse_number, reasons
from otif.functions.reasons import has_reasons
from otif.model import (AGREEMENTS, DELETED_FLAG, REFERENCES, SPECS, VERSION_COLUMN, VERSION_TABLE,
                        Reference, TableSpec)
from otif.operators import references as refs
from otif.operators import versions

LINEAGE = ("_source_occurrences", "_source_files", "_bronze_loaded_at")
OWN_KEY = "own_key"


@dataclass
class Validated:
    """Every distinct raw variant of one source, validated.

    ``rows`` holds all variants with ``_dq_errors`` (and ``_raw_record`` where rejected or superseded); older variants of resolved
    keys carry ``_superseded`` (and ``_selected_version``) instead of counting
    as valid or rejected. Valid rows, quarantine, archive and summary are all
    filters of ``rows``, so staging ``rows`` once serves every output.
    """

    name: str
    spec: TableSpec
    rows: DataFrame

    @property
    def frame(self) -> DataFrame:
        return self.rows.filter(~F.col("_superseded"))

    @property
    def superseded(self) -> DataFrame | None:
        if self.name != VERSION_TABLE:
            return None
        return versions.superseded_records(self.rows, self.name, self.spec.key, VERSION_COLUMN)

    @property
    def valid(self) -> DataFrame:
        return (self.frame.filter(~has_reasons("_dq_errors"))
                .drop("_dq_errors", "_raw_record", "_superseded", "_selected_version"))

    @property
    def rejected(self) -> DataFrame:
        return self.frame.filter(has_reasons("_dq_errors"))


def source_fields(bronze: DataFrame) -> list[str]:
    return [c for c in bronze.columns if not c.startswith("_")]


def check_contract(name: str, spec: TableSpec, fields: list[str]) -> None:
    """Stop before any work when the extract lacks a contracted column."""
    missing = spec.expected_columns - set(fields)
    if missing:
        raise ValueError(f"bronze_{name}: missing columns {sorted(missing)}")


def raw_record(fields: list[str], holder: str = "") -> Column:
    """The raw source fields (of the struct ``holder``, where given) as JSON, nulls kept (PRJ-5)."""
    return F.to_json(F.col(holder) if holder else F.struct(*[F.col(c) for c in fields]), {"ignoreNullFields": "false"})


def _home(spec: TableSpec, lookups: Sequence[Reference]) -> tuple[str, ...]:
    """The key by which records are brought together: their own, or that of a parent which is part of it."""
    return min([tuple(spec.key), *[r.keys for r in lookups if set(r.keys) <= set(spec.key)]], key=len)


def _keyed_variants(name: str, bronze: DataFrame, spec: TableSpec, fields: list[str], home: tuple[str, ...], salts: refs.Salts,
                    lookups: Sequence[Reference], parents: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct records as normalised text, what normalising changed in ``_raw``, the facts of their key and of parents known by ``home``.

    Records of a ``home`` key (the record's own or one above it) are brought together once, before duplicates are collapsed;
    the facts of their key are windows over them, and ``lookups`` meet them there.
    Rows of a frequent ``home`` key (in ``salts``, by hash), and those whose home key lacks a part, are collapsed by record in place of that
    and get their key's facts by joins, so no task holds all of them.
    """
    key = [f"_key_{c}" for c in spec.key]
    hashed = refs.key_hash(normalise_code(c) for c in home)
    frequent = [h for hashes in salts.values() for h in hashes]

    def normalised(frame: DataFrame) -> DataFrame:
        text = {c: F.col(f"_key_{c}") if f"_key_{c}" in frame.columns else normalise_code(c) for c in fields}
        same = {c: F.col(c).eqNullSafe(text[c]) for c in fields}
        changed = F.struct(*[F.when(~same[c], F.col(c)).alias(c) for c in fields])
        return frame.select(*[text[c].alias(c) for c in fields], *LINEAGE,
                            F.when(~reduce(and_, same.values()), changed).alias("_raw"))

    def with_facts(frame: DataFrame, together: bool) -> DataFrame:
        if name != VERSION_TABLE:
            return versions.key_variants(frame, spec.key, together).withColumn("_superseded", F.lit(False))
        dated = frame.withColumn("_version", parse_date(VERSION_COLUMN))
        return versions.resolve_versions(dated, spec.key, "_version", together).drop("_version")

    def spread(rows: Column) -> DataFrame:
        return with_facts(normalised(versions.collapse_duplicates(bronze.filter(rows), fields, files)), False)

    keyed = bronze.filter(hashed.isNotNull() & ~hashed.isin(frequent)).select("*", *[normalise_code(c).alias(k) for c, k in zip(spec.key, key)])
    files = versions.few_files(bronze)
    near = with_facts(normalised(versions.collapse_duplicates(keyed.repartition(*[f"_key_{c}" for c in home]), [*key, *fields], files)), True)
    parts = {"near": near, "incomplete": spread(hashed.isNull())}
    if frequent:
        parts["crowded"] = spread(hashed.isin(frequent))
    for ref in lookups:
        parent = parents[ref.parent]
        parts["near"] = refs.attach(parts["near"], parent, ref)
        parts["incomplete"] = refs.unmatched(parts["incomplete"], parent, ref)
        if frequent:
            parts["crowded"] = refs.lookup(parts["crowded"], parent, ref, salts)
    return union_all(list(parts.values()))


def validate(name: str, bronze: DataFrame, parents: Mapping[str, DataFrame],
             spec: TableSpec | None = None) -> Validated:
    """Validate one raw extract against its contract and its already-valid parents."""
    spec = spec or SPECS[name]
    fields = source_fields(bronze)
    check_contract(name, spec, fields)

    lookups = REFERENCES.get(name, ())
    home = _home(spec, lookups)
    at_home = [r for r in lookups if r.keys == home]
    away = [r for r in lookups if r not in at_home]
    # A lookup by more than another one's key goes along with it; the others move the rows once each.
    along = {r: next((a for a in away if set(a.keys) < set(r.keys)), None) for r in away}
    own = Reference(name, home, OWN_KEY)
    salts = refs.frequent_keys(bronze, [*[r for r in away if along[r] is None], own], normalise_code)
    frame = _keyed_variants(name, bronze, spec, fields, home, salts[OWN_KEY], at_home, parents)
    for ref in away:
        if along[ref] is None:
            finer = [(parents[r.parent], r) for r in away if along[r] == ref]
            frame = refs.lookup(frame, parents[ref.parent], ref, salts[ref.label], finer)
    # Parsed values replace their text, but only here: every shuffle before moves the text alone.
    frame = frame.select(
        "*",
        *[parse_date(c).alias(f"_parsed_{c}") for c in spec.dates],
        *[parse_number(c).alias(f"_parsed_{c}") for c in spec.numbers],
    )
    def text(c: str) -> Column:
        # Dates are replaced by their parsed value below; rules read the text.
        return F.col(f"_text_{c}") if c in spec.dates else F.col(c)

    rules: list[tuple[Column, str]] = []
    rules += [(text(c).isNull(), f"MISSING:{c}") for c in dict.fromkeys(spec.key + spec.required)]
    rules += [(text(c).isNotNull() & F.col(c).isNull(), f"INVALID_DATE:{c}") for c in spec.dates]
    frame = frame.select(*[c for c in frame.columns if c not in spec.dates],
                         *[F.col(f"_parsed_{c}").alias(c) for c in spec.dates],
                         *[F.col(c).alias(f"_text_{c}") for c in spec.dates])

    if name == VERSION_TABLE:
        conflict, selected = versions.conflicting(F.col("_can_resolve")), F.col("_latest_version")
    else:
        conflict, selected = versions.conflicting(), F.lit(None).cast("date")
    rules.append((conflict, "CONFLICTING_KEY"))

    for c in spec.numbers:
        parsed = F.col(f"_parsed_{c}")
        rules.append((F.col(c).isNotNull() & parsed.isNull(), f"INVALID_NUMBER:{c}"))
        rules.append((parsed < 0, f"NEGATIVE_NUMBER:{c}"))
        if c in spec.positive:
            rules.append((parsed == 0, f"ZERO_QUANTITY:{c}"))

    if "LOEKZ" in spec.also_expected:
        rules.append((F.col("LOEKZ").isNotNull() & (F.col("LOEKZ") != DELETED_FLAG), "UNKNOWN_DELETE_STATUS"))
        frame = frame.withColumn("_is_deleted", F.coalesce(F.col("LOEKZ") == DELETED_FLAG, F.lit(False)))

    rules += refs.unresolved_rules(lookups)
    rules += refs.agreement_rules(AGREEMENTS.get(name, ()))

    helpers = {"_key_variants", "_latest_version", "_can_resolve", "_superseded", "_selected_version", "_raw"}
    raw = F.struct(*[F.coalesce(F.col("_raw")[c], text(c)).alias(c) for c in fields])
    keep = [c for c in frame.columns
            if not c.startswith(("_ref_", "_parsed_", "_text_")) and c not in helpers
            and c not in spec.numbers]
    frame = frame.select(
        *keep,
        *[F.col(f"_parsed_{c}").alias(c) for c in spec.numbers],
        raw.alias("_raw"), reasons(rules).alias("_dq_errors"),
        F.current_timestamp().alias("_processed_at"),
        F.col("_superseded"), selected.alias("_selected_version"),
    )
    needed = F.col("_superseded") | has_reasons("_dq_errors")
    frame = frame.withColumn("_raw_record", F.when(needed, raw_record(fields, "_raw"))).drop("_raw")
    return Validated(name, spec, frame)


def quarantine_rows(v: Validated) -> DataFrame:
    """Rejected rows of one source in the common long quarantine shape."""
    return v.rejected.select(
        F.lit(v.name).alias("source_table"),
        F.to_json(F.struct(*[F.col(k) for k in v.spec.key]), {"ignoreNullFields": "false"})
        .alias("candidate_key"),
        "_raw_record", "_dq_errors", *LINEAGE, "_processed_at",
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
