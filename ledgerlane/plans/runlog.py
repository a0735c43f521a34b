"""The run log of the daily chain: step entries, history, summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import as_column, mean_of
from ..functions.temporal import day_of, elapsed, shift

# States with the texts shown for them, and the limits of the history view.
STATE_LABELS = {"SUCCEEDED": "✅ 成功", "FAILED": "❌ 失敗", "SKIPPED": "⏭️ スキップ"}
HISTORY_DAYS, HISTORY_ROWS, LAST_RUNS = 7, 100, 5
SUCCESS = "SUCCESS"


def _labelled(state) -> Column:
    result = F.col(state)
    for name, text in STATE_LABELS.items():
        result = F.when(F.col(state) == name, text).otherwise(result)
    return result


def run_rows(log: DataFrame) -> DataFrame:
    """Log rows with duration and label. Columns: name, state, scheduled_time, completed_time, error_code, error_message."""
    return log.select(
        F.col("name").alias("task_name"), "state", "scheduled_time", "completed_time",
        elapsed("SECOND", "scheduled_time", "completed_time").alias("execution_seconds"),
        _labelled("state").alias("status_display"), "error_code", "error_message",
    )


def run_history(log: DataFrame, as_of: Column, days: int = HISTORY_DAYS, n: int = HISTORY_ROWS) -> DataFrame:
    """The newest ``n`` runs scheduled in the last ``days`` days before ``as_of``, newest first."""
    recent = log.filter((F.col("scheduled_time") >= shift("DAY", -days, as_of)) & (F.col("scheduled_time") <= as_of))
    return run_rows(recent).orderBy(F.col("scheduled_time").desc(), "task_name", "state").limit(n)


def runs_on(log: DataFrame, day: Column) -> DataFrame:
    """All runs of one day, newest first."""
    return run_rows(log.filter(day_of("scheduled_time") == day)).select(
        "task_name", "status_display", "scheduled_time", "completed_time", "execution_seconds", "error_message"
    ).orderBy(F.col("scheduled_time").desc(), "task_name")


def last_runs(log: DataFrame, name: str, n: int = LAST_RUNS) -> DataFrame:
    return run_rows(log.filter(F.col("name") == name)).orderBy(F.col("scheduled_time").desc(), "state").limit(n)


def run_summary(log: DataFrame, day: Column | None = None) -> DataFrame:
    """Per day: runs, states, mean seconds; one day or all."""
    rows = run_rows(log if day is None else log.filter(day_of("scheduled_time") == day))
    seconds = F.col("execution_seconds")
    return rows.groupBy(day_of("scheduled_time").alias("execution_date")).agg(
        F.count(F.lit(1)).alias("total_executions"),
        F.count_if(F.col("state") == "SUCCEEDED").alias("successful"),
        F.count_if(F.col("state") == "FAILED").alias("failed"),
        F.count_if(F.col("state") == "SKIPPED").alias("skipped"),
        mean_of(F.sum(seconds), F.count(seconds)).alias("avg_execution_seconds"),
    )


def run_step(df: DataFrame, table: str, step: str, message: Column, affected: Column | None = None, at: Column | None = None) -> DataFrame:
    """The log entry of a finished step.

    ``affected`` and ``message`` are expressions over the aggregated rows of ``df``; they may use
    ``n``, the number of rows.
    """
    counted = df.agg(F.count(F.lit(1)).alias("n"), *([affected.alias("affected")] if affected is not None else []))
    rows = counted.select(
        F.lit(table).alias("table_name"),
        F.lit(step).alias("check_type"),
        F.lit(SUCCESS).alias("check_result"),
        F.col("n" if affected is None else "affected").cast("bigint").alias("affected_rows"),
        message.alias("details"),
    )
    return rows if at is None else rows.withColumn("check_timestamp", as_column(at).cast("timestamp"))
