"""Silver layer: validate every raw extract against its contract and valid parents."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from otif.model import REFERENCES, SPECS
from otif.operators import quality, reconcile
from otif.operators.quality import Validated

Stage = Callable[[DataFrame, str], DataFrame]


@dataclass
class Silver:
    validated: dict[str, Validated]
    bronze: Mapping[str, DataFrame]

    def valid(self, name: str) -> DataFrame:
        return self.validated[name].valid

    @property
    def quarantine(self) -> DataFrame:
        return quality.union_all([quality.quarantine_rows(v) for v in self.validated.values()])

    @property
    def superseded(self) -> DataFrame:
        return quality.union_all([v.superseded for v in self.validated.values() if v.superseded is not None])

    @property
    def summary(self) -> DataFrame:
        return reconcile.load_summary(self.validated, self.bronze)


def run_silver(bronze: Mapping[str, DataFrame], stage: Stage | None = None,
               only: tuple[str, ...] | None = None) -> Silver:
    """Validate sources in dependency order (parents first), those of one rank together.

    ``stage`` may materialise each validated frame (the pipeline writes it to the
    shared folder and reads it back) so children and outputs reuse one result.
    ``only`` limits the run to the named sources and the parents they need.
    """
    wanted = set(SPECS) if only is None else _with_parents(only)
    done: dict[str, Validated] = {}

    def validated(name: str) -> Validated:
        v = quality.validate(name, bronze[name], {n: p.valid for n, p in done.items()})
        return v if stage is None else Validated(v.name, v.spec, stage(v.rows, f"silver_{name}"))

    ranks: dict[int, list[str]] = {}
    for name in SPECS:
        if name in wanted:
            ranks.setdefault(_rank(name), []).append(name)
    for _, names in sorted(ranks.items()):
        # Tables of a rank do not read each other: their jobs share the cluster.
        target = inheritable_thread_target(bronze[names[0]].sparkSession)(validated)
        with ThreadPoolExecutor(len(names)) as pool:
            results = list(pool.map(target, names))
        done.update(zip(names, results))
    return Silver({n: done[n] for n in SPECS if n in done}, bronze)


def _rank(name: str) -> int:
    """0 for a source without parents, else one more than its highest parent."""
    return max((1 + _rank(r.parent) for r in REFERENCES.get(name, ())), default=0)


def _with_parents(names: tuple[str, ...]) -> set[str]:
    todo, seen = list(names), set()
    while todo:
        n = todo.pop()
        if n in seen:
            continue
        seen.add(n)
        todo.extend(r.parent for r in REFERENCES.get(n, ()))
    return seen
