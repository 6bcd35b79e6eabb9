"""Row counts of a job's steps (G5), observed while its writes run: no action and no scan of their own."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass
class StepCounts:
    """Collects counts by step. ``watch`` a frame under a step's name, run a write that uses it, read ``table``.

    A step that several writes use is counted in the first. A stage that is run again after a lost executor is counted
    as Spark's observed metrics count it: once for each result of a task that arrived."""

    steps: dict[str, Observation] = field(default_factory=dict)

    def watch(self, df: DataFrame, step: str, **more: Column) -> DataFrame:
        """The same rows; ``rows`` and the further aggregates ``more`` are observed as they pass."""
        if step in self.steps:
            raise ValueError(f"step {step!r} is watched already")
        self.steps[step] = Observation(f"salesflow_{step}_{id(self)}")
        return df.observe(self.steps[step], F.count(F.lit(1)).alias("rows"), *(c.alias(n) for n, c in more.items()))

    def of(self, step: str) -> dict:
        """The metrics of one step; waits until the write that it is part of has ended."""
        return self.steps[step].get

    def table(self, spark: SparkSession) -> DataFrame:
        """``step, rows``, in the order in which the steps were watched."""
        rows = [(i, step, self.of(step)["rows"]) for i, step in enumerate(self.steps, 1)]
        return spark.createDataFrame(rows, "position int, step string, rows long")
