"""The append-only run log and the questions asked of it."""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from threadline.config import STAGES, TABLES

CHECKPOINT = "CHECKPOINT"
END_STATUSES = ("SUCCESS", "FAILED")


def _text(value: str | None) -> Column:
    return F.lit(value).cast("string")


def log_rows(requests: DataFrame, now: Column | None = None) -> DataFrame:
    """Rows of the run log for (workflow_id, stage, status, error_message, checkpoint_data).

    INIT and STARTED rows have a start time, rows with an end status an end time.
    Null keys raise when the rows are written. One frame may hold the rows of
    many workflows; they are appended in one write.
    """
    now = F.current_timestamp() if now is None else now
    never = F.lit(None).cast("timestamp")

    def key(name: str) -> Column:
        missing = F.raise_error(F.lit(f"{name} must not be null")).cast("string")
        return F.when(F.col(name).isNull(), missing).otherwise(F.col(name)).alias(name)

    starts = (F.col("stage") == "INIT") | (F.col("status") == "STARTED")
    return requests.select(
        key("workflow_id"),
        key("stage"),
        key("status"),
        F.when(starts, now).otherwise(never).alias("start_time"),
        F.when(F.col("status").isin(*END_STATUSES), now).otherwise(never).alias("end_time"),
        F.col("error_message").cast("string").alias("error_message"),
        F.col("checkpoint_data").cast("string").alias("checkpoint_data"),
        now.alias("created_at"),
    )


def _row(
    spark: SparkSession,
    workflow_id: str,
    stage: str,
    status: str,
    error_message: str | None = None,
    checkpoint_data: str | None = None,
) -> DataFrame:
    for name, value in (("workflow_id", workflow_id), ("stage", stage), ("status", status)):
        if value is None:
            raise ValueError(f"{name} must not be null")
    given = {"workflow_id": workflow_id, "stage": stage, "status": status, "error_message": error_message, "checkpoint_data": checkpoint_data}
    return log_rows(spark.range(1).select(*[_text(v).alias(k) for k, v in given.items()]))


def workflow_row(spark: SparkSession, workflow_id: str, initial_status: str = "CREATED") -> DataFrame:
    """First row of a run: stage INIT, started now."""
    return _row(spark, workflow_id, "INIT", initial_status)


def stage_row(
    spark: SparkSession, workflow_id: str, stage: str, status: str, error_message: str | None = None
) -> DataFrame:
    """A status row; it has a start time when STARTED and an end time at an end."""
    return _row(spark, workflow_id, stage, status, error_message)


def checkpoint_row(spark: SparkSession, workflow_id: str, stage: str, data: dict[str, Any]) -> DataFrame:
    """A CHECKPOINT row with the payload as JSON; values JSON lacks become strings."""
    return _row(spark, workflow_id, stage, CHECKPOINT, checkpoint_data=payload_text(data))


def payload_text(data: dict[str, Any]) -> str:
    """JSON of a payload. Numbers JSON has no form for (not a number, infinities) become strings too."""

    def plain(value: Any) -> Any:
        if isinstance(value, dict):
            return {k if isinstance(k, (str, int, float, bool)) or k is None else str(k): plain(v) for k, v in value.items()}
        if isinstance(value, (list, tuple)):
            return [plain(v) for v in value]
        return str(value) if isinstance(value, float) and not math.isfinite(value) else value

    return json.dumps(plain(data), default=str)


class RunLog:
    """Appends rows through ``append`` and reads them back through ``read``."""

    def __init__(
        self,
        spark: SparkSession,
        append: Callable[[DataFrame], None],
        read: Callable[[], DataFrame],
    ) -> None:
        self.spark = spark
        self._append = append
        self._read = read

    def create_workflow(self, workflow_id: str, initial_status: str = "CREATED") -> str:
        self._append(workflow_row(self.spark, workflow_id, initial_status))
        return workflow_id

    def update_stage_status(
        self, workflow_id: str, stage: str, status: str, error_message: str | None = None
    ) -> None:
        self._append(stage_row(self.spark, workflow_id, stage, status, error_message))

    def save_checkpoint(self, workflow_id: str, stage: str, data: dict[str, Any]) -> None:
        self._append(checkpoint_row(self.spark, workflow_id, stage, data))

    def load_checkpoint(self, workflow_id: str, stage: str) -> dict[str, Any] | None:
        wanted = self._read().filter(
            (F.col("workflow_id") == workflow_id) & (F.col("stage") == stage)
        )
        row = latest_checkpoints(wanted).first()
        return json.loads(row["checkpoint_data"]) if row and row["checkpoint_data"] else None

    def log_execution(
        self,
        workflow_id: str,
        stage: str,
        status: str,
        error_message: str | None = None,
        extra_info: dict[str, Any] | None = None,
    ) -> None:
        """A status row, then a CHECKPOINT row when there is a payload."""
        self.update_stage_status(workflow_id, stage, status, error_message)
        if extra_info is not None:
            self.save_checkpoint(workflow_id, stage, extra_info)


def latest_checkpoints(log: DataFrame) -> DataFrame:
    """Newest checkpoint payload per (workflow, stage); empty or malformed is null.

    At equal times a row with a payload wins, then the larger payload text.
    """
    data = F.col("checkpoint_data")
    newest = F.max(F.struct("created_at", data.isNotNull().alias("has_data"), "checkpoint_data"))
    payload = F.col("newest.checkpoint_data")
    # A JSON reader takes numbers that are none, and keeps the last of names that occur twice.
    plain = F.regexp_replace(payload, r"(?<=[:\[,\s])(-?Infinity|NaN)(?=[\s,\]}])", "null")
    valid = (F.json_object_keys(plain).isNotNull() | F.try_parse_json(plain).isNotNull()) & (F.trim(payload) != "")
    return (
        log.filter(F.col("status") == CHECKPOINT)
        .groupBy("workflow_id", "stage")
        .agg(newest.alias("newest"))
        .select("workflow_id", "stage", F.when(valid, payload).alias("checkpoint_data"))
    )


def latest_status(log: DataFrame, tie_breakers: list[str] | None = None) -> DataFrame:
    """Newest row per (workflow, stage) that is not a CHECKPOINT row.

    Of rows of the same time, ``tie_breakers`` decide, then an end status comes
    after STARTED.
    """
    first = ["created_at", *(tie_breakers or [])]
    rest = [c for c in log.columns if c not in ("workflow_id", "stage", "checkpoint_data", *first)]
    ended = F.col("status").isin(*END_STATUSES).alias("ended")
    newest = F.max(F.struct(*first, ended, *rest)).alias("newest")
    return (
        log.filter(F.col("status") != CHECKPOINT)
        .groupBy("workflow_id", "stage")
        .agg(newest)
        .select("workflow_id", "stage", "newest.status", "newest.error_message", "newest.created_at")
    )


#: Widths of time, in microseconds, narrow to wide; each is a whole multiple of the one before.
_WIDTHS = (1_000, 60_000_000, 3_600_000_000, 30 * 86_400_000_000)


def stage_durations(
    log: DataFrame, tie_breakers: list[str] | None = None, widths: tuple[int, ...] = _WIDTHS
) -> DataFrame:
    """Every STARTED row with the next end row of its workflow and stage.

    One (workflow, stage) may hold a large share of the log, also within one
    hour, so its rows are not sorted in one task. Time is cut into slots of the
    ``widths``, narrow ones within wide ones. The next end row is looked up
    within the narrowest slot; a row without one takes the first end row of a
    later narrow slot in the same wider one, and so on outward. What a window
    holds is the rows of one narrow slot, or one row per slot that has any in
    the next wider one. Rows of one narrow slot are those of the same
    millisecond, as far as they have the same time.
    """
    tie = tie_breakers or []
    group = ["workflow_id", "stage"]
    zoned = log.schema["created_at"].dataType == T.TimestampType()
    # Times without a zone are counted as they stand, so that no change of clocks reorders them.
    micros = F.unix_micros("created_at") if zoned else F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("created_at"))
    slots = [f"_slot{i}" for i in range(len(widths))]
    rows = log.filter(F.col("status").isin("STARTED", *END_STATUSES)).select(
        *group, "status", "start_time", "end_time", "created_at", *tie,
        *[F.floor(micros / w).alias(s) for s, w in zip(slots, widths)],
    )
    is_end = F.col("status").isin(*END_STATUSES)
    end_row = F.when(is_end, F.struct("created_at", *tie, "end_time", F.col("status").alias("end_status")))
    after = (
        Window.partitionBy(*group, *slots)
        .orderBy(*[F.col(c).desc() for c in ("created_at", *tie)])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    started = rows.withColumn("_end", F.last(end_row, ignorenulls=True).over(after)).filter(F.col("status") == "STARTED")
    # First end row of each slot, then of any later slot within the next wider one.
    firsts = rows.groupBy(*group, *slots).agg(F.min(end_row).alias("_first"))
    for i, slot in enumerate(slots):
        outer = slots[i + 1 :]
        later = (
            Window.partitionBy(*group, *outer).orderBy(F.col(slot).desc()).rowsBetween(Window.unboundedPreceding, -1)
        )
        carried = firsts.select(*group, slot, *outer, F.last("_first", ignorenulls=True).over(later).alias("_later"))
        started = started.join(carried, [*group, slot, *outer], "left").withColumn("_end", F.coalesce("_end", "_later")).drop("_later")
        firsts = firsts.groupBy(*group, *outer).agg(F.min("_first").alias("_first"))
    # As an interval, so that times without a zone do not pass through the session's.
    elapsed = (F.col("_end.end_time") - F.col("start_time")).cast("interval second")
    return started.select(
        *group,
        *tie,
        "start_time",
        F.col("_end.end_time").alias("end_time"),
        F.col("_end.end_status").alias("end_status"),
        elapsed.cast("decimal(18,6)").cast("double").alias("seconds"),
    )


def failures(log: DataFrame) -> DataFrame:
    """FAILED rows with the error type and the message apart."""
    parts = F.split("error_message", ": ", 2)
    kept = [c for c in log.columns if c not in ("status", "start_time", "checkpoint_data")]
    return log.filter(F.col("status") == "FAILED").select(
        *kept,
        F.get(parts, F.lit(0)).alias("error_type"),
        F.get(parts, F.lit(1)).alias("error_text"),
    )


def resume_points(log: DataFrame, tie_breakers: list[str] | None = None) -> DataFrame:
    """First stage without SUCCESS per workflow; null when all have it."""
    done = [
        F.bool_or((F.col("stage") == s) & (F.col("status") == "SUCCESS")).alias(s) for s in STAGES
    ]
    first_open = F.coalesce(*[F.when(~F.col(s), F.lit(s)) for s in STAGES])
    return (
        latest_status(log, tie_breakers)
        .groupBy("workflow_id")
        .agg(*done)
        .select("workflow_id", first_open.alias("resume_stage"))
    )


def rows_of_workflow(log: DataFrame, workflow_id: str) -> DataFrame:
    return log.filter(F.col("workflow_id") == workflow_id)


def workflow_statuses(log: DataFrame) -> DataFrame:
    """Row count and the set of statuses per workflow."""
    return log.groupBy("workflow_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.array_sort(F.collect_set("status")).alias("statuses"),
    )
