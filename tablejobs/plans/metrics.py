"""Counters of the steps of a job, summed by group and name."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


#: Counters of statements that write, and what Spark calls them.
COMMAND_COUNTERS = {"rows_written": "numOutputRows", "files_written": "numFiles"}


@dataclass
class StepMetrics:
    """Collects counters while rows pass by.

    ``count`` attaches counters to a frame; they are filled by the first action on it. Attach them as the
    last thing before the action (``watch`` of ``write_table`` does): below a shuffle, a task that is
    run again after the loss of an executor would be counted twice.
    """

    observed: list[tuple[str, Observation]] = field(default_factory=list)
    written: list[tuple[str, str, int]] = field(default_factory=list)

    def count(self, df: DataFrame, group: str, **counters: Column) -> DataFrame:
        seen = Observation()
        self.observed.append((group, seen))
        counters = counters or {"rows": F.count(F.lit(1))}
        return df.observe(seen, *[c.cast("long").alias(name) for name, c in counters.items()])

    def count_command(self, command: DataFrame, group: str) -> None:
        """Rows and files that a statement which has run wrote, by Spark's own metrics of it."""
        plan = command._jdf.queryExecution().executedPlan()
        if plan.nodeName() != "CommandResult":
            return
        metrics = plan.commandPhysicalPlan().metrics()
        for counter, name in COMMAND_COUNTERS.items():
            if metrics.contains(name):
                self.written.append((group, counter, metrics.apply(name).value()))

    def rows(self, spark: SparkSession) -> DataFrame:
        """One row per step, group and counter. Waits for the actions the counters are attached to."""
        values = [
            (group, name, value)
            for group, seen in self.observed
            for name, value in seen.get.items()
        ] + self.written
        return spark.createDataFrame(values, "group string, counter string, value bigint")

    def totals(self, spark: SparkSession) -> DataFrame:
        """Sum per group and counter."""
        return self.rows(spark).groupBy("group", "counter").agg(F.sum("value").alias("value"))

    def as_dict(self, spark: SparkSession) -> Mapping[str, Mapping[str, int]]:
        found: dict[str, dict[str, int]] = {}
        for row in self.totals(spark).collect():
            found.setdefault(row["group"], {})[row["counter"]] = row["value"]
        return found
