"""Table contracts, parameters and fixed business values."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class TableSpec:
    """Declarative contract of one source extract.

    ``key`` identifies a record, ``required`` must be present, ``dates`` and
    ``numbers`` are parsed from text, ``positive`` numbers must also be non-zero.
    """

    name: str
    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()
    also_expected: tuple[str, ...] = ()
    source_file: str = ""

    @property
    def expected_columns(self) -> set[str]:
        return set(self.key + self.required + self.dates + self.numbers + self.also_expected)


@dataclass(frozen=True)
class Reference:
    """Child → valid-parent lookup; ``fields`` are carried for agreement rules."""

    parent: str
    keys: tuple[str, ...]
    label: str
    fields: tuple[str, ...] = ()


@dataclass(frozen=True)
class Agreement:
    """Flag ``reason`` when both columns are present and differ."""

    left: str
    right: str
    reason: str


# ---------------------------------------------------------------------------
# These must equal the published rules for results to agree.
# ---------------------------------------------------------------------------

# Source extracts in processing order: parents before the children that reference them.
SPECS: dict[str, TableSpec] = {
    "branch_mapping": TableSpec("branch_mapping", ("WERKS",), ("BRANCH_NAME",),
                                source_file="BRANCH_MAPPING.csv"),
    "lfa1": TableSpec("lfa1", ("LIFNR",), ("NAME1",), source_file="LFA1_VENDOR_MASTER.csv"),
    "mara": TableSpec("mara", ("MATNR",), ("MEINS",), source_file="MARA_MATERIAL_MASTER.csv"),
    "ekko": TableSpec("ekko", ("MANDT", "EBELN"), ("LIFNR", "BEDAT"), dates=("BEDAT", "AEDAT"),
                      source_file="EKKO_PO_HEADER.csv"),
    "ekpo": TableSpec("ekpo", ("MANDT", "EBELN", "EBELP"), ("MATNR", "MENGE", "MEINS", "WERKS"),
                      numbers=("MENGE", "NETPR", "NETWR"), positive=("MENGE",),
                      also_expected=("LOEKZ",), source_file="EKPO_PO_ITEM.csv"),
    "eket": TableSpec("eket", ("MANDT", "EBELN", "EBELP", "ETENR"), ("EINDT", "MENGE"),
                      dates=("EINDT",), numbers=("MENGE", "WEMNG"), positive=("MENGE",),
                      source_file="EKET_SCHEDULE_LINES.csv"),
    "likp": TableSpec("likp", ("MANDT", "VBELN"), ("LIFNR", "WADAT_IST", "WERKS"),
                      dates=("WADAT_IST",), source_file="LIKP_DELIVERY_HEADER.csv"),
    "lips": TableSpec("lips", ("MANDT", "VBELN", "POSNR"),
                      ("EBELN", "EBELP", "MATNR", "LFIMG", "MEINS", "WERKS"),
                      numbers=("LFIMG",), positive=("LFIMG",), source_file="LIPS_DELIVERY_ITEM.csv"),
}

# Parent lookups per child table, in evaluation order.
REFERENCES: dict[str, tuple[Reference, ...]] = {
    "ekko": (Reference("lfa1", ("LIFNR",), "vendor"),),
    "ekpo": (Reference("ekko", ("MANDT", "EBELN"), "order"),
             Reference("mara", ("MATNR",), "material", ("MEINS",))),
    "eket": (Reference("ekpo", ("MANDT", "EBELN", "EBELP"), "order_item"),),
    "likp": (Reference("lfa1", ("LIFNR",), "vendor"),),
    "lips": (Reference("ekpo", ("MANDT", "EBELN", "EBELP"), "order_item", ("MATNR", "MEINS", "WERKS")),
             Reference("likp", ("MANDT", "VBELN"), "delivery", ("LIFNR", "WERKS")),
             Reference("ekko", ("MANDT", "EBELN"), "order", ("LIFNR",))),
}

# Field agreement rules evaluated after the lookups (names of carried parent fields
# are ``_ref_<label>_<field>``).
AGREEMENTS: dict[str, tuple[Agreement, ...]] = {
    "ekpo": (Agreement("MEINS", "_ref_material_MEINS", "UNIT_MISMATCH:MARA"),),
    "lips": (Agreement("MATNR", "_ref_order_item_MATNR", "ORDER_ITEM_MISMATCH:MATNR"),
             Agreement("MEINS", "_ref_order_item_MEINS", "ORDER_ITEM_MISMATCH:MEINS"),
             Agreement("WERKS", "_ref_order_item_WERKS", "ORDER_ITEM_MISMATCH:WERKS"),
             Agreement("WERKS", "_ref_delivery_WERKS", "DELIVERY_MISMATCH:WERKS"),
             Agreement("_ref_order_LIFNR", "_ref_delivery_LIFNR", "SUPPLIER_MISMATCH")),
}

# Accepted date grammars: (full-match pattern, Spark datetime format).
DATE_FORMATS = ((r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
                (r"^\d{2}\.\d{2}\.\d{4}$", "dd.MM.yyyy"))
# Decimal dot or comma, at most six fractional digits, no thousands separator.
NUMBER_PATTERN = r"^[+-]?\d+([.,]\d{1,6})?$"
QUANTITY_TYPE = "decimal(38,6)"
UPPERCASE_FIELDS = frozenset({"MEINS", "WAERS", "LAND1", "LOEKZ"})
DELETED_FLAG = "L"
VERSION_TABLE = "ekko"
VERSION_COLUMN = "AEDAT"
SELECTION_RULE = "LATEST_AEDAT_DEMO_PROXY"
ALLOCATION_RULE = "FIFO_DUE_DATE_V1"
FIFO_BASIS = "FIFO_SCHEDULE_LINE_EQUAL_WEIGHT"
LEGACY_BASIS = "LEGACY_ORDER_ITEM_FINAL_DATE"
ITEM_KEY = ("MANDT", "EBELN", "EBELP")
SCHEDULE_KEY = ITEM_KEY + ("ETENR",)
DELIVERY_KEY = ("MANDT", "VBELN", "POSNR")
QUARANTINE_SOURCES_FOR_ITEMS = ("ekpo", "eket", "lips")

# Item exclusion reasons, in evaluation order.
EXCLUSION_ORDER = (
    "INVALID_SILVER_ITEM", "INVALID_ORDER_HEADER", "DELETED_ITEM", "NO_VALID_SCHEDULE",
    "RELATED_QUARANTINE", "SCHEDULE_QUANTITY_MISMATCH", "SCHEDULE_BEFORE_ORDER",
    "DELIVERY_BEFORE_ORDER", "MONTH_NOT_CLOSED",
)
MONTH_NOT_CLOSED = "MONTH_NOT_CLOSED"
INVALID_ORDER_ITEM = "INVALID_ORDER_ITEM"
INVALID_SILVER_SCHEDULE = "INVALID_SILVER_SCHEDULE"

# Balance status labels, highest priority first.
STATUS_AFTER_CUTOFF = "AFTER_CUTOFF"
STATUS_EXCLUDED = "EXCLUDED_OR_NO_VALID_SCHEDULE"
STATUS_EXCESS = "EXCESS_OVER_SCHEDULES"
STATUS_FULL = "FULLY_ALLOCATED"

# Business aliases of published datasets (source name → English name).
COLUMN_ALIASES = {
    "MANDT": "sap_client_id", "EBELN": "purchase_order_id", "EBELP": "purchase_order_item_id",
    "LIFNR": "supplier_id", "NAME1": "supplier_name", "WERKS": "branch_code", "BRANCH_NAME": "branch_name",
    "MATNR": "material_id", "MEINS": "quantity_unit", "BEDAT": "order_date",
    "VBELN": "delivery_id", "POSNR": "delivery_item_id", "WADAT_IST": "actual_delivery_date",
    "LFIMG": "delivered_quantity", "MENGE": "ordered_quantity", "TXZ01": "item_description",
    "NETPR": "net_unit_price", "NETWR": "net_order_value", "WAERS": "currency_code",
    "ETENR": "schedule_line_id", "EINDT": "scheduled_delivery_date", "WEMNG": "recorded_received_quantity",
    "_is_deleted": "is_deleted", "candidate_items": "candidate_schedule_line_count",
    "evaluated_items": "evaluated_schedule_line_count", "excluded_items": "excluded_schedule_line_count",
    "scope": "report_scope", "coverage_rate": "evaluation_coverage_rate",
    "score": "performance_score", "min_items": "minimum_schedule_line_count",
    "ranking_eligible": "is_ranking_eligible", "worst_rank": "worst_supplier_rank",
    "ordered_qty": "ordered_quantity", "scheduled_qty": "scheduled_quantity",
    "schedule_count": "schedule_line_count", "delivered_by_due_qty": "delivered_by_due_quantity",
    "delivered_by_month_end_qty": "delivered_by_month_end_quantity", "shortfall_qty": "shortfall_quantity",
    "first_due_date": "first_scheduled_delivery_date", "final_due_date": "final_scheduled_delivery_date",
    "evaluation_date": "evaluation_month_end", "on_time": "is_on_time", "in_full": "is_in_full",
    "fill_rate": "quantity_fill_rate", "mean_fill_rate": "mean_quantity_fill_rate",
    "by_due_date": "is_by_due_date", "by_month_end": "is_by_month_end", "after_cutoff": "is_after_cutoff",
}

MAPPING_MAPPED = "MAPPED"
MAPPING_UNMAPPED = "UNMAPPED"
MAPPING_NOT_APPLICABLE = "NOT_APPLICABLE"


@dataclass(frozen=True)
class Params:
    """Run parameters: evaluation cutoff and minimum evaluated lines for ranking."""

    as_of: dt.date = dt.date(2026, 9, 30)
    min_items: int = 1

    def __post_init__(self):
        if self.min_items < 1:
            raise ValueError("min_items must be at least 1")


# Cutoff of the shared-table binding: its order dates run to 2001-08, so this
# leaves the last months open and every exclusion path populated.
BINDING_PARAMS = Params(as_of=dt.date(2001, 6, 30))
