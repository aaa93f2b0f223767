"""Moves inside a window against plain Python, and steps that several parts of a report read: they are done once."""

import random
import re

import pytest
from pyspark.sql import functions as F

from pulseframe.operators import event_context
from pulseframe.operators.timeline import DAY_SEC, count_inside
from pulseframe.plans import audit_queries, cluster_queries, pattern_queries, report_queries

KINDS = ("click", "view", "purchase", "error", "signup")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def sf(spark, tmp_path):
    rows = [(k, k % 7, KINDS[k % 5], 37 * k % 5000, float(13 * k % 11)) for k in range(400)]
    events = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, at long, value double")
    events.select("event_id", "user_id", "event_type", F.timestamp_seconds("at").cast("timestamp_ntz").alias("ts"), "value").write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("reach", [0, 7, 500, 2 * DAY_SEC])
def test_moves_inside_a_window(spark, reach):
    rng = random.Random(reach)
    moves = []
    for key in "ab":
        clocks = sorted(rng.sample(range(DAY_SEC - 900, DAY_SEC + 900), 120))
        moves += [(key, was, now, rng.randrange(2)) for was, now in zip(clocks, clocks[1:], strict=False)]
        moves += [(key, now, now, rng.randrange(3)) for now in clocks]
    marks = [(key, clock) for key in "abc" for clock in rng.sample(range(DAY_SEC - 1500, DAY_SEC + 1500), 60)]
    found = count_inside(spark.createDataFrame(marks, "k string, clock long"), spark.createDataFrame(moves, "k string, since long, clock long, n long"), ["k"], reach, reach, "n")
    want = {(k, m): sum(n for key, was, now, n in moves if key == k and was >= m - reach and now <= m + reach) for k, m in marks}
    assert {(r.k, r.clock): r.n for r in found.collect()} == want


def test_transitions_have_no_sliding_frame(spark):
    events = spark.createDataFrame([("h", 1, 50)], "hostid string, ifindex long, clock long")
    records = spark.createDataFrame(
        [("h", 1, 10 * k, metric, float(v), float(v)) for metric in ("oper_status", "uptime") for k, v in enumerate((1, 2, 2, 1, 3, 1))],
        "hostid string, ifindex long, clock long, canonical_metric string, value double, raw_value double",
    )
    found = event_context.transitions(events, records, 20)
    assert found.select("status_changes", "uptime_decreases").first()[:] == (2, 1)
    assert not re.search(r"RangeFrame, -\d", plan(found))


def test_issue_log_reads_written_rows(spark, sf):
    assert plan(audit_queries.issues(spark, sf)).count("events.parquet") <= 2  # the raw records and their copies
    assert "events.parquet" not in plan(audit_queries.QUERIES["F10_issue_details"](spark, sf))


def test_reports_transform_once(spark, sf, monkeypatch):
    def again(*args):
        raise AssertionError("records are transformed a second time")

    for part in (cluster_queries, report_queries):
        monkeypatch.setattr(part, "transformed", again)
    assert pattern_queries.pattern(spark, sf).count() > 0
    assert report_queries.analysed(spark, sf).count() > 0
