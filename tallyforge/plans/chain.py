"""Chains of steps over named tables: order, partial runs, checks, archive of versions and a recap (§2.14, §3)."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tallyforge.operators import offers as O
from tallyforge.operators import quality as Q
from tallyforge.operators import reconcile as R
from tallyforge.operators import register as G
from tallyforge.sources import readers

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Step:
    """A step makes one table from those there are; ``check`` returns what is wrong with it, or nothing."""

    name: str
    make: Callable[[Tables], DataFrame]
    needs: tuple[str, ...] = ()
    check: Callable[[DataFrame], str] | None = None


@dataclass
class Recap:
    done: list[tuple[str, int]] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    failed: str = ""


def chosen(steps: list[Step], start: str | None = None, only: tuple[str, ...] = ()) -> list[Step]:
    """The steps from a name on, or the named ones, in the chain's order; unknown names are errors."""
    names = [s.name for s in steps]
    for n in ([start] if start else []) + list(only):
        if n not in names:
            raise ValueError(f"no step {n}; there are {', '.join(names)}")
    kept = steps[names.index(start) :] if start else steps
    return [s for s in kept if not only or s.name in only]


def run(spark: SparkSession, steps: list[Step], tables: dict[str, DataFrame], folder: str, start: str | None = None, only: tuple[str, ...] = (), dry: bool = False) -> Recap:
    """Runs steps; each result is written as a new version and read again. Results of steps left out come from their last version.

    A failed check ends the run and is told in the recap. dry: nothing is made, the recap lists what would be.
    """
    recap, todo = Recap(), {s.name for s in chosen(steps, start, only)}
    known = dict(tables)
    for step in steps:
        if step.name not in todo:
            recap.skipped.append(step.name)
            if not dry and any(step.name in s.needs for s in steps if s.name in todo):
                known[step.name] = readers.latest_version(spark, folder, step.name)
            continue
        if dry:
            recap.done.append((step.name, 0))
            continue
        missing = [n for n in step.needs if n not in known]
        if missing:
            recap.failed = f"{step.name} needs {', '.join(missing)}"
            return recap
        version = readers.write_version(step.make(known), folder, step.name)
        known[step.name] = readers.latest_version(spark, folder, step.name)
        recap.done.append((step.name, version))
        if step.check and (wrong := step.check(known[step.name])):
            recap.failed = f"{step.name}: {wrong}"
            return recap
    return recap


def no_reading_divergence(rows: DataFrame) -> str:
    n = R.reading_divergences(rows)
    return f"{n} divergences of reading" if n else ""


#: Matching of offers to items, pack sizes and the buckets of prices; tables items, offers, links.
PRICES = [
    Step("matched", lambda t: O.cascade(t["items"], t["offers"], t["links"]), ("items", "offers", "links")),
    Step("anomalies", lambda t: Q.anomalies(t["final_offers"]), ("final_offers",)),
]
#: Register of barcodes and its controls; tables items, readings.
CODES = [
    Step("register", lambda t: G.register(t["items"], t["readings"]), ("items", "readings")),
    Step("controls", lambda t: G.controlled(t["register"], t["readings"]), ("register", "readings")),
]
#: Two readings against each other; tables scope, owner, ours. Divergences of reading fail the run.
RECONCILIATION = [
    Step("reconciled", lambda t: R.reconciled(t["scope"], t["owner"], t["ours"]), ("scope", "owner", "ours"), no_reading_divergence),
    Step("verdicts", lambda t: R.supplier_verdicts(t["reconciled"]), ("reconciled",)),
]
