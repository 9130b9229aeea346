"""Counts of the rows that flow through a job, taken by the job itself.

A frame is watched by an ``Observation``: the counts come from the pass that
computes the frame anyway, so a report on a table needs no second derivation
of it. Spark adds a task's counts when the task ends. A shuffle task that runs
again because its output was lost with its executor adds them once more, so
counts are read with a test that must hold for whole passes; where it fails,
the watched frames are aggregated on their own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def nulls_of(df: DataFrame, label: str) -> dict:
    """(label, column) -> null count, for every column."""
    return {(label, c): F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns}


@dataclass
class _Watched:
    frame: DataFrame
    counts: dict
    observation: Observation

    def columns(self) -> list[Column]:
        return [c.alias(f"c{i}") for i, c in enumerate(self.counts.values())]

    def named(self, values: dict) -> dict:
        return {key: values[f"c{i}"] for i, key in enumerate(self.counts)}


@dataclass
class PassCounts:
    """The counts of one job: watch its frames, run it, then read."""

    watched: list[_Watched] = field(default_factory=list)

    def watch(self, df: DataFrame, counts: dict) -> DataFrame:
        """``df``, observed: ``counts`` maps keys to aggregates over its rows."""
        watched = _Watched(df, counts, Observation())
        self.watched.append(watched)
        return df.observe(watched.observation, *watched.columns())

    def read(self, holds: Callable[[dict], bool]) -> dict:
        """All counts, once the job has run."""
        found: dict = {}
        for w in self.watched:
            try:
                found |= w.named(w.observation.get)
            except Py4JJavaError:       # the planner has proved the frame empty and never run it
                return self.recount()
        return found if holds(found) else self.recount()

    def recount(self) -> dict:
        """All counts by aggregations of their own."""
        found: dict = {}
        for w in self.watched:
            found |= w.named(w.frame.agg(*w.columns()).first().asDict())
        return found
