"""The order in which a contract's tables can be built: parents before children."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from graphlib import CycleError, TopologicalSorter

from assay.plans.contract import Contract, ContractError

BUILT, FAILED, SKIPPED = "BUILT", "FAILED", "SKIPPED"


@dataclass(frozen=True)
class Outcome:
    """What became of one table; why: its error, or the tables that it waited for in vain."""

    table: str
    status: str
    result: object = None
    why: str = ""
    error: BaseException | None = None


def parents(contract: Contract) -> dict[str, set[str]]:
    """For each table, by target names, the tables it refers to; itself doesn't count."""
    return {
        t.name: {p.name for fk in t.foreign_keys if (p := contract.table(fk.parent_table)) and p.name != t.name}
        for t in contract.tables
    }


def refuse_cycles(contract: Contract) -> None:
    try:
        TopologicalSorter(parents(contract)).prepare()
    except CycleError as error:
        raise ContractError([f"tables refer to each other in a circle: {' -> '.join(error.args[1])}"]) from None


def levels(contract: Contract) -> list[list[str]]:
    """Tables that can be built at once, level after level, whatever order the contract lists them in."""
    refuse_cycles(contract)
    sorter, found = TopologicalSorter(parents(contract)), []
    sorter.prepare()
    while ready := sorted(sorter.get_ready()):
        found.append(ready)
        sorter.done(*ready)
    return found


def build_all(contract: Contract, build: Callable[[str], object], at_once: int = 4) -> dict[str, Outcome]:
    """Build every table as soon as its parents are, several at once.

    A table that fails keeps its descendants from being built, and no other. The threads only
    submit jobs; Spark runs them.
    """
    refuse_cycles(contract)
    needs = parents(contract)
    sorter, found, running = TopologicalSorter(needs), {}, {}
    sorter.prepare()
    with ThreadPoolExecutor(at_once, thread_name_prefix="build") as pool:
        while sorter.is_active():
            for name in sorted(sorter.get_ready()):
                if lost := sorted(p for p in needs[name] if found[p].status != BUILT):
                    found[name] = Outcome(name, SKIPPED, why=f"not built: {', '.join(lost)}")
                    sorter.done(name)
                else:
                    running[pool.submit(build, name)] = name
            for done in wait(running, return_when=FIRST_COMPLETED).done if running else ():
                name = running.pop(done)
                error = done.exception()
                found[name] = Outcome(name, FAILED, why=str(error), error=error) if error else Outcome(name, BUILT, done.result())
                sorter.done(name)
    return found
