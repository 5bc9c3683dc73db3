"""Row counts per stage of a flow and the checks between stages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """One row per named stage with its number of rows."""
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("stage"), "rows")
              for name, df in stages.items()]
    return reduce(DataFrame.unionByName, counts)


def conservation(events: DataFrame, rollup: DataFrame, types: list[str],
                 counters: list[str]) -> DataFrame:
    """Checks that a rollup counted every event of a known type exactly once."""
    counted = reduce(lambda a, b: a + b, [F.sum(c) for c in counters])
    return events.agg(
        F.count("*").alias("events"),
        F.count_if(F.col("event_type").isin(types)).alias("known_events"),
    ).withColumn("counted_events", F.coalesce(rollup.agg(counted).scalar(), F.lit(0))).withColumn(
        "conserved", F.col("known_events") == F.col("counted_events"))


class Counted:
    """Counts the rows of the stages of a flow while they pass on their way to a table.

    Nothing is read again for the counts: each stage is observed in the query that writes
    what comes after it. A stage read by several queries is counted in the first.
    """

    def __init__(self):
        self._observed: dict[str, Observation] = {}

    def through(self, stage: str, df: DataFrame) -> DataFrame:
        """``df``, whose rows count as those of ``stage`` once a query has run over it."""
        if stage in self._observed:
            return df
        self._observed[stage] = Observation(f"{stage}-{len(self._observed)}")
        return df.observe(self._observed[stage], F.count(F.lit(1)).alias("rows"))

    def counts(self, spark: SparkSession) -> DataFrame:
        """One row per stage with its number of rows, after the flow has run."""
        rows = [(stage, held.get["rows"]) for stage, held in self._observed.items()]
        return spark.createDataFrame(rows, "stage string, rows long").coalesce(1)
