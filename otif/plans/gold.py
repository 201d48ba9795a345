"""Gold layer: exclusions, FIFO allocation, per-plan and monthly results, ranking.

``Gold`` exposes each result as a lazily built frame; nothing runs until a
result is written or collected.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from otif.model import ITEM_KEY, Params
from otif.operators import fifo, metrics, ranking
from otif.plans.silver import Silver


@dataclass
class Gold:
    bronze: Mapping[str, DataFrame]
    silver: Silver
    params: Params = Params()
    stage: Callable[[DataFrame, str], DataFrame] | None = None

    def _stage(self, frame: DataFrame, name: str) -> DataFrame:
        return frame if self.stage is None else self.stage(frame, name)

    def _valid(self, name: str) -> DataFrame:
        return self.silver.valid(name)

    def _read_once(self, name: str) -> DataFrame:
        """The staged result where it was written already, else what it would be written from: its only reader needs no table."""
        return getattr(self, name) if name in self.__dict__ else getattr(self, f"_{name}")

    @cached_property
    def affected_quarantine(self) -> DataFrame:
        return metrics.recover_item_keys(self.silver.quarantine)

    @property
    def _item_population(self) -> DataFrame:
        return metrics.item_population(self.silver.validated["ekpo"].rows, self._valid("eket"), self.affected_quarantine)

    @cached_property
    def item_population(self) -> DataFrame:
        # Read twice (issues, unassigned rows), by details too where it is there: staged once.
        return self._stage(self._item_population, "gold_item_population")

    @cached_property
    def issues(self) -> DataFrame:
        return metrics.attributed_issues(self.item_population)

    @cached_property
    def unassigned(self) -> DataFrame:
        return metrics.unassigned_quarantine(self.affected_quarantine, self.item_population)

    @cached_property
    def details(self) -> DataFrame:
        # Read twice (item results and delivery evidence): stage it once.
        return self._stage(metrics.item_details(self._read_once("item_population"), self._valid("ekko"), self._valid("lfa1")),
                           "gold_item_details")

    @cached_property
    def deliveries(self) -> DataFrame:
        return self._stage(metrics.delivery_lines(self._valid("lips"), self._valid("likp")), "gold_deliveries")

    @cached_property
    def evidence(self) -> DataFrame:
        return metrics.delivery_evidence(self.deliveries, self.details, self.params.as_of)

    @property
    def _item_performance(self) -> DataFrame:
        return metrics.item_performance(self.details, self.evidence, self.params.as_of)

    @cached_property
    def item_performance(self) -> DataFrame:
        return self._stage(self._item_performance, "gold_item_performance")

    @cached_property
    def delivery_evidence(self) -> DataFrame:
        verdict = self.item_performance.select(*ITEM_KEY, "is_evaluable", "exclusion_reasons")
        return self.evidence.join(verdict, list(ITEM_KEY), "left")

    @cached_property
    def schedule_candidates(self) -> DataFrame:
        return self._stage(metrics.schedule_candidates(self.silver.validated["eket"].rows, self._read_once("item_performance")),
                           "gold_schedule_candidates")

    @cached_property
    def allocations(self) -> DataFrame:
        pairs = fifo.allocate(
            metrics.fifo_plans(self.schedule_candidates),
            metrics.fifo_deliveries(self.deliveries, self.params.as_of),
            keys=ITEM_KEY, plan_order=["EINDT", "ETENR"], delivery_order=["WADAT_IST", "VBELN", "POSNR"],
            plan_qty="schedule_quantity", delivery_qty="LFIMG")
        return self._stage(fifo.label_allocations(pairs), "gold_allocations")

    @property
    def _schedule_performance(self) -> DataFrame:
        return metrics.schedule_performance(self.schedule_candidates, self.allocations, self.params.as_of)

    @cached_property
    def schedule_performance(self) -> DataFrame:
        return self._stage(self._schedule_performance, "gold_schedule_performance")

    @cached_property
    def balance(self) -> DataFrame:
        return metrics.delivery_balance(self.deliveries, self.allocations, self.schedule_candidates,
                                        self.params.as_of)

    @property
    def monthly(self) -> DataFrame:
        return metrics.supplier_monthly(self._read_once("schedule_performance"), self.params.as_of, self.params.min_items)

    @property
    def worst(self) -> DataFrame:
        return ranking.worst_suppliers(self.monthly)

    @cached_property
    def quality(self) -> DataFrame:
        return metrics.quality_summary(self.schedule_performance, self.unassigned)

    @cached_property
    def branches(self) -> DataFrame:
        return self._valid("branch_mapping").select("WERKS", "BRANCH_NAME")
