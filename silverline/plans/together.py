"""Several tables at once, each in a pool of its own."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from silverline.plans.consolidate import consolidate
from silverline.plans.feeds import Feed

POOL = "spark.scheduler.pool"


class TablesFailed(RuntimeError):
    """Some of the tables could not be brought up to date; `errors` holds why, by name."""

    def __init__(self, errors: Mapping[str, Exception]):
        self.errors = dict(errors)
        super().__init__("; ".join(f"{name}: {type(e).__name__}: {e}" for name, e in self.errors.items()))


@dataclass(frozen=True)
class Consolidation:
    """A feed, the table it goes to, and how: `options` are those of `consolidate`."""

    feed: Feed
    table: Any
    keys: str | list[str]
    order_col: str | None = None
    options: Mapping[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Outcome:
    value: Any = None
    error: Exception | None = None


def run_together(spark: SparkSession, tasks: Mapping[str, Callable[[], Any]], *, threads: int = 4) -> dict[str, Outcome]:
    """Run independent pieces of work at once; what each returned or raised, by name, in the order given.

    Every piece submits its jobs to a scheduler pool of its name. With `spark.scheduler.mode=FAIR` pools share the executors, so a
    large table does not hold up a small one; without it jobs run as they come, still side by side. A failure ends only its own piece.
    """

    def run(name: str) -> Outcome:
        context = spark.sparkContext
        context.setLocalProperty(POOL, name)
        try:
            return Outcome(tasks[name]())
        except Exception as error:  # reported by name to the caller
            return Outcome(error=error)
        finally:
            context.setLocalProperty(POOL, None)

    with ThreadPoolExecutor(max(1, threads)) as pool:
        started = {name: pool.submit(inheritable_thread_target(spark)(run), name) for name in tasks}
        return {name: future.result() for name, future in started.items()}


def consolidate_all(spark: SparkSession, work: Mapping[str, Consolidation], *, threads: int = 4) -> dict[str, Any]:
    """Bring several tables up to date at once; returns them by name.

    All are tried. If some fail, the others are committed all the same, and TablesFailed says which and why.
    """

    def task(one: Consolidation) -> Callable[[], Any]:
        return lambda: consolidate(spark, one.feed, one.table, one.keys, one.order_col, **one.options)

    outcomes = run_together(spark, {name: task(one) for name, one in work.items()}, threads=threads)
    errors = {name: o.error for name, o in outcomes.items() if o.error is not None}
    if errors:
        raise TablesFailed(errors)
    return {name: o.value for name, o in outcomes.items()}
