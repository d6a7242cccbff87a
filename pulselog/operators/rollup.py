"""Task counters summed up to their stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselog.operators.catalogue import task_counters
from pulselog.schema import TASK_END


def stage_rollup(events: DataFrame) -> DataFrame:
    """Per application, stage and stage attempt: tasks ended and the sums of their counters.

    All buffers are bigint, so tasks are summed in hash tables before the
    shuffle and a stage with most of the tasks costs no more than any other.  A
    stage's own accumulators may differ where a task ended after its stage.
    """
    counters = task_counters()
    return (
        events.where(f"Event = '{TASK_END}' AND `Task Info`.`Task ID` IS NOT NULL")
        .selectExpr(
            "appId",
            "`Stage ID` AS stageId",
            "`Stage Attempt ID` AS stageAttempt",
            *[f"{counter.value} AS {counter.name}" for counter in counters],
        )
        .groupBy("appId", "stageId", "stageAttempt")
        .agg(
            F.count("*").alias("tasks"),
            *[F.expr(f"coalesce(sum({c.name}), 0L) AS {c.name}") for c in counters],
        )
    )
