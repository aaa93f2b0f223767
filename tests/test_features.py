"""The feature store's windows over several tasks, against plain Python."""

import pytest
from pyspark.sql import functions as F

from pulseframe.operators import clusters, device_pattern, features, mldata
from pulseframe.plans import queries

GRID = features.Grid(bucket_sec=60, windows=(120, 300))
FIELDS = "itemid string, ordinal bigint, clock bigint, hostid string, host string, host_name string, device_role string, canonical_metric string, ifindex bigint, value double, raw_value double, previous_raw_value double, counter_reset boolean"


@pytest.fixture
def records(spark):
    rows = [
        (f"{i}-{m}", i * 1000 + c, 1_700_000_000 + 37 * c + i, f"h{i % 2}", "h", "H", "switch", m, i, float((c * 7 + i) % 11), None, None, False)
        for i in range(6) for m in ("in_bps", "oper_status") for c in range(40)
    ]
    return spark.createDataFrame(rows, FIELDS)


def test_windows_are_spread_by_the_number_of_spans(records, monkeypatch):
    monkeypatch.setattr(features, "SPANS_PER_TASK", 256)
    found = features.interface_features(records, None, GRID)
    assert found.select(F.spark_partition_id().alias("p")).distinct().count() > 4  # all tasks of the session, whatever the input, before
    samples = {}
    for r in records.collect():
        samples.setdefault((r.ifindex, r.canonical_metric), []).append((r.clock, r.value))
    for row in found.collect():
        for suffix, window in (("2m", 120), ("5m", 300)):
            values = [v for c, v in sorted(samples[row.ifindex, "in_bps"]) if row.timestamp - window < c <= row.timestamp]
            base = [v for c, v in sorted(samples[row.ifindex, "in_bps"]) if row.timestamp - 2 * window < c <= row.timestamp - window]
            assert (row[f"in_bps_{suffix}_count"], row[f"in_bps_baseline_count_{suffix}"]) == (len(values), len(base))
            assert row[f"in_bps_{suffix}_last"] == (values[-1] if values else None)
            assert row[f"in_bps_{suffix}_mean"] == (pytest.approx(sum(values) / len(values)) if values else None)
            states = [v for c, v in sorted(samples[row.ifindex, "oper_status"]) if row.timestamp - window < c <= row.timestamp]
            assert row[f"oper_status_change_count_{suffix}"] == sum(a != b for a, b in zip(states, states[1:]))


def test_events_are_looked_up_in_metrics_of_their_interface_only(spark, records, monkeypatch):
    seen = []
    monkeypatch.setattr(clusters, "as_of", lambda wanted, *rest: seen.append(wanted.count()) or real(wanted, *rest))
    from pulseframe.operators.timeline import as_of as real

    events = records.filter("canonical_metric = 'in_bps'").select("hostid", "ifindex", "clock")
    found = clusters.bracketed(events, records)
    assert seen == [240]  # 1680 before: each event in all seven metrics
    assert found.count() == 6 * 39


def test_events_are_placed_where_a_sample_can_be_in_reach(spark, records, monkeypatch):
    seen = []
    from pulseframe.operators.timeline import near as real

    monkeypatch.setattr(device_pattern, "near", lambda wanted, *rest: seen.append(wanted.count()) or real(wanted, *rest))
    events = records.filter("canonical_metric = 'in_bps'").select("hostid", "ifindex", "clock")
    events = events.union(events.withColumn("clock", F.col("clock") + 1_000_000))
    found = device_pattern.nearest_samples(events, records)
    assert seen == [480]  # 4320 before: every event in all nine metrics
    assert found.filter("clock = sample_clock").count() == found.count() == 480


def test_window_contents_are_merged_where_they_change(records):
    found = features.interface_features(records, None, GRID)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "map_from_entries" not in plan  # a merged row for each window and grid point, before


def test_many_doubles_are_rounded_as_one_array(spark):
    values = [0.0005, -0.0004, 1.0015, 2.5, None, 1e13 / 3, 123456.7895, -7.0005, 0.1, float("nan")]
    frame = spark.createDataFrame([(1, *values)], "k int, " + ", ".join(f"`a.{i}` double" for i in range(len(values))))
    found = queries.rounded(frame)
    assert found.columns == frame.columns
    assert "transform(" in found._jdf.queryExecution().optimizedPlan().toString()
    wanted = frame.select(*[(F.round(F.col(f"`{c}`"), 3) + F.lit(0.0)).alias(c) for c in frame.columns[1:]]).first()
    assert [str(x) for x in found.first()[1:]] == [str(x) for x in wanted]


def test_a_reader_of_coverage_has_no_other_window_statistic_computed(records):
    found = queries.rounded(features.interface_features(records, None, GRID), alone=("metric_coverage_ratio_2m",))
    plan = found.select("timestamp", "metric_coverage_ratio_2m")._jdf.queryExecution().optimizedPlan().toString()
    assert "count(1) windowspecdefinition" in plan
    assert "transform(" not in plan and "max_by(" not in plan and "stddev" not in plan and "var_pop(" not in plan  # all of a window, and all rounded, before


def test_a_reader_of_one_column_has_few_others_rounded(spark):
    frame = spark.range(3).selectExpr("id", *[f"CAST(id AS DOUBLE) / {k + 3} AS c{k}" for k in range(40)])
    plan = queries.rounded(frame).select("c17")._jdf.queryExecution().optimizedPlan().toString()
    assert " / 20.0)" in plan and " / 42.0)" not in plan  # one array of all 40 before
    assert [r.c17 for r in queries.rounded(frame, alone=("c17",)).collect()] == [0.0, 0.05, 0.1]


def test_the_gate_of_a_filter_is_that_of_the_reasons(spark):
    settings = mldata.MatrixSettings()
    values = [None, float("nan"), float("inf"), -1.0, 0.0, 0.5, 0.8, 1.0]
    rows = spark.createDataFrame([(a, b) for a in values for b in values], "metric_coverage_ratio_5m double, baseline_metric_coverage_ratio_5m double")
    gated = mldata.gate(rows, settings)
    found = gated.collect()
    assert all(r.training_eligible == (not r.reasons) for r in found) and sum(r.training_eligible for r in found) == 4
    wanted = {}
    for r in found:
        for reason in r.reasons:
            wanted[reason] = wanted.get(reason, 0) + 1
    counts = mldata.gate_counts(gated)
    assert {r.reason: r.rows for r in counts.collect()} == wanted and counts.columns == ["reason", "rows"]
    assert "size(" not in counts._jdf.queryExecution().optimizedPlan().toString()  # explode adds a filter on the array, moved down below the windows
    assert mldata.gate_counts(gated.filter("training_eligible = 1")).collect() == []
    assert "filter(" not in gated.filter("training_eligible = 1").drop("reasons")._jdf.queryExecution().optimizedPlan().toString()


def test_an_audit_of_many_columns_is_no_deep_expression(spark):
    names = [f"x{k}" for k in range(700)]  # 349 of them were enough to overflow the stack of some threads
    rows = [(1, "h", 1, 0.5, 0.0, *[float(k) for k in range(700)]), (2, "h", 1, None, 0.25, *[None if k % 3 else float("nan") for k in range(700)])]
    fields = "timestamp long, hostid string, ifindex long, metric_coverage_ratio_2m double, baseline_metric_coverage_ratio_2m double, "
    frame = spark.createDataFrame(rows, fields + ", ".join(f"{n} double" for n in names))
    found = features.feature_audit(frame, features.INTERFACE_KEY, "2m").first()
    assert (found["rows"], found.entities, found.feature_columns, found.mean_finite_features) == (2, 1, 702, (702 + 1) / 2)
