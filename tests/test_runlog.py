from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from threadline.operators import runlog

LOG = (
    "workflow_id string, stage string, status string, start_time timestamp, end_time timestamp, "
    "error_message string, checkpoint_data string, created_at timestamp, event_id int"
)
T0 = datetime(2024, 1, 1)


def log_of(spark, rows):
    """Rows given as (workflow, stage, status, seconds, payload, error)."""
    full = []
    for i, (w, stage, status, at, payload, error) in enumerate(rows):
        t = T0 + timedelta(seconds=at)
        full.append(
            (w, stage, status, t if status == "STARTED" else None,
             t if status in ("SUCCESS", "FAILED") else None, error, payload, t, i)
        )
    return spark.createDataFrame(full, LOG)


def test_rows(spark):
    first = runlog.workflow_row(spark, "w").first()
    assert (first["stage"], first["status"]) == ("INIT", "CREATED")
    assert first["start_time"] == first["created_at"] and first["end_time"] is None
    for status, start, end in (("STARTED", True, False), ("SUCCESS", False, True), ("FAILED", False, True), ("OTHER", False, False)):
        row = runlog.stage_row(spark, "w", "PARSE", status, "X: y").first()
        assert ((row["start_time"] is not None), (row["end_time"] is not None)) == (start, end)
    row = runlog.checkpoint_row(spark, "w", "PARSE", {"n": 1, "at": T0}).first()
    assert row["checkpoint_data"] == '{"n": 1, "at": "2024-01-01 00:00:00"}'
    with pytest.raises(ValueError):
        runlog.stage_row(spark, None, "PARSE", "STARTED")


def test_round_trip(spark):
    rows = []
    log = runlog.RunLog(spark, rows.append, lambda: _union(rows))
    assert log.create_workflow("w") == "w"
    log.update_stage_status("w", "PARSE", "STARTED")
    log.save_checkpoint("w", "PARSE", {"step": 1, "info": "text"})
    log.log_execution("w", "PARSE", "SUCCESS", extra_info={"step": 2})
    assert log.load_checkpoint("w", "PARSE") == {"step": 2}
    assert log.load_checkpoint("w", "BUILD") is None
    mine = runlog.rows_of_workflow(_union(rows), "w")
    assert mine.count() == 5
    assert runlog.workflow_statuses(mine).first()["statuses"] == ["CHECKPOINT", "CREATED", "STARTED", "SUCCESS"]


def _union(rows):
    result = rows[0]
    for r in rows[1:]:
        result = result.unionByName(r)
    return result


def test_latest_checkpoints(spark):
    log = log_of(
        spark,
        [
            ("w", "PARSE", "CHECKPOINT", 1, '{"a":1}', None),
            ("w", "PARSE", "CHECKPOINT", 2, '{"a":2}', None),
            ("w", "PARSE", "CHECKPOINT", 2, None, None),
            ("w", "PARSE", "CHECKPOINT", 2, '{"a":3}', None),
            ("w", "BUILD", "CHECKPOINT", 1, '{"a":1}', None),
            ("w", "BUILD", "CHECKPOINT", 2, "{broken", None),
            ("w", "ENRICH", "CHECKPOINT", 1, "", None),
            ("w", "VALIDATE", "CHECKPOINT", 1, '{"a":NaN, "b":[-Infinity,"x: NaN,"]}', None),
            ("v", "BUILD", "CHECKPOINT", 1, '{"a":1,"a":{"c":[2]}}', None),
            ("v", "ENRICH", "CHECKPOINT", 1, '[1, NaN]', None),
            ("v", "PARSE", "SUCCESS", 1, None, None),
        ],
    )
    found = {(r[0], r[1]): r[2] for r in runlog.latest_checkpoints(log).collect()}
    assert found == {
        ("w", "PARSE"): '{"a":3}', ("w", "BUILD"): None, ("w", "ENRICH"): None,
        ("w", "VALIDATE"): '{"a":NaN, "b":[-Infinity,"x: NaN,"]}', ("v", "BUILD"): '{"a":1,"a":{"c":[2]}}', ("v", "ENRICH"): "[1, NaN]",
    }


def test_status_resume_and_failures(spark):
    log = log_of(
        spark,
        [
            ("w", "PARSE", "STARTED", 1, None, None),
            ("w", "PARSE", "SUCCESS", 2, None, None),
            ("w", "PARSE", "CHECKPOINT", 3, "{}", None),
            ("w", "RESOLVE", "FAILED", 4, None, "ValueError: a: b"),
            ("v", "BUILD", "SUCCESS", 1, None, None),
            *[("d", s, "SUCCESS", 1, None, None) for s in ("PARSE", "RESOLVE", "ENRICH", "BUILD", "VALIDATE")],
        ],
    )
    latest = {(r[0], r[1]): r[2] for r in runlog.latest_status(log).collect()}
    assert latest[("w", "PARSE")] == "SUCCESS" and latest[("w", "RESOLVE")] == "FAILED"
    assert {r[0]: r[1] for r in runlog.resume_points(log).collect()} == {"w": "RESOLVE", "v": "PARSE", "d": None}
    (failed,) = runlog.failures(log).collect()
    assert (failed["error_type"], failed["error_text"]) == ("ValueError", "a: b")


@pytest.mark.parametrize("widths", [(1_000, 60_000_000, 3_600_000_000, 30 * 86_400_000_000), (3_000_000, 90_000_000), (10**15,)])
def test_stage_durations(spark, widths):
    rng = random.Random(5)
    rows = [
        (rng.choice("vw"), rng.choice(["PARSE", "BUILD"]), rng.choice(["STARTED", "STARTED", "SUCCESS", "FAILED", "CHECKPOINT"]),
         rng.randrange(20_000), None, None)
        for _ in range(120)
    ]
    want = {}
    for i, (w, stage, status, at, *_rest) in enumerate(rows):
        if status == "STARTED":
            later = [
                (t, j, s) for j, (w2, st2, s, t, *_r) in enumerate(rows)
                if (w2, st2) == (w, stage) and s in ("SUCCESS", "FAILED") and (t, j) > (at, i)
            ]
            want[i] = (min(later)[0] - at, min(later)[2]) if later else (None, None)
    found = runlog.stage_durations(log_of(spark, rows), ["event_id"], widths).collect()
    assert {r["event_id"]: (r["seconds"], r["end_status"]) for r in found} == want
    assert len(found) == len(want)


def test_latest_status_at_equal_times(spark):
    log = log_of(spark, [("v", "PARSE", "FAILED", 5, None, "x: y"), ("v", "PARSE", "STARTED", 5, None, None), ("v", "BUILD", "STARTED", 5, None, None), ("v", "BUILD", "SUCCESS", 5, None, None)])
    found = {r["stage"]: r["status"] for r in runlog.latest_status(log).collect()}
    assert found == {"PARSE": "FAILED", "BUILD": "SUCCESS"}
    found = {r["stage"]: r["status"] for r in runlog.latest_status(log, ["event_id"]).collect()}
    assert found == {"PARSE": "STARTED", "BUILD": "SUCCESS"}


def test_rows_of_many_requests(spark):
    asked = [
        ("w", "INIT", "CREATED", None, None), ("w", "PARSE", "STARTED", None, None), ("w", "PARSE", "FAILED", "E: x", None),
        ("v", "PARSE", "SUCCESS", None, None), ("v", "PARSE", "CHECKPOINT", None, "{}"),
    ]
    columns = "workflow_id string, stage string, status string, error_message string, checkpoint_data string"
    rows = runlog.log_rows(spark.createDataFrame(asked, columns)).collect()
    assert [(r[0], r[1], r[2], r["start_time"] is not None, r["end_time"] is not None, r["error_message"], r["checkpoint_data"]) for r in rows] == [
        ("w", "INIT", "CREATED", True, False, None, None), ("w", "PARSE", "STARTED", True, False, None, None), ("w", "PARSE", "FAILED", False, True, "E: x", None),
        ("v", "PARSE", "SUCCESS", False, True, None, None), ("v", "PARSE", "CHECKPOINT", False, False, None, "{}"),
    ]
    with pytest.raises(Exception, match="stage must not be null"):
        runlog.log_rows(spark.createDataFrame([("w", None, "STARTED", None, None)], columns)).collect()


def test_payloads_without_numbers_json_lacks():
    assert runlog.payload_text({"a": float("nan"), "b": [float("inf"), 1.5], "c": {1, }.pop()}) == '{"a": "nan", "b": ["inf", 1.5], "c": 1}'


def test_one_hot_millisecond_slot(spark):
    """All rows of one workflow and stage within one hour, many within one millisecond."""
    rows = [("w", "PARSE", "STARTED" if i % 3 else "SUCCESS", i // 50, None, None) for i in range(600)]
    found = {r["event_id"]: r["seconds"] for r in runlog.stage_durations(log_of(spark, rows), ["event_id"]).collect()}
    want = {}
    for i, (_, _, status, at, *_rest) in enumerate(rows):
        if status == "STARTED":
            end = next((j for j in range(i + 1, 600) if j % 3 == 0), None)
            want[i] = None if end is None else float(rows[end][3] - at)
    assert found == want
