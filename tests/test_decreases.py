"""Hand-made cases of decreases in time, of brackets and of series behaviour."""

import random

import pytest
from pyspark.sql import functions as F

from pulseframe.operators import behaviour, clusters, counters

EVENT = "itemid string, hostid string, ifindex long, canonical_metric string, clock long"
SAMPLE = "itemid string, hostid string, ifindex long, canonical_metric string, clock long, ordinal long, value double, raw_value double"


def events(spark, clocks, host="h"):
    return spark.createDataFrame([(f"i{k}", host, k, "in_discard_rate", c) for k, c in enumerate(clocks)], EVENT)


def series(spark, values, metric="in_discard_rate", item="a", step=10):
    return spark.createDataFrame(
        [(item, "h", 1, metric, step * k, k, v, v) for k, v in enumerate(values)], SAMPLE)


def test_host_clusters_are_anchored_at_their_first_event(spark):
    found = clusters.host_clusters(events(spark, [0, 50, 70, 110, 131, 400])).orderBy("start").collect()
    assert [(r.start, r.end, r.events, r.interfaces, r.duration_sec) for r in found] == [(0, 50, 2, 2, 50), (70, 110, 2, 2, 40)]


def test_clusters_reach_across_a_day(spark):
    found = clusters.host_clusters(events(spark, [86_390, 86_400, 86_450, 86_460])).collect()
    assert [(r.start, r.end, r.events) for r in found] == [(86_390, 86_450, 3)]


def anchors(clocks, span=60):
    start, out = None, {}
    for c in sorted(set(clocks)):
        start = c if start is None or c - start > span else start
        out[c] = start
    return out


def test_anchors_of_random_clocks_equal_a_fold(spark):
    rng = random.Random(8)
    clocks = {h: [rng.randrange(40_000) for _ in range(900)] + [90_000 + 7 * k for k in range(300)] for h in ("a", "b")}
    rows = spark.createDataFrame([("i", h, 1, "in_discard_rate", c) for h, cs in clocks.items() for c in cs] + [("i", None, 1, "x", 5), ("i", "a", 1, "x", None)], EVENT)
    found = {(r.hostid, r.clock): r.start for r in clusters.anchored(rows).collect()}
    assert found == {(h, c): s for h, cs in clocks.items() for c, s in anchors(cs).items()}


def test_a_host_busy_every_second(spark):
    rows = spark.range(100_000).select(F.lit("h").alias("hostid"), F.col("id").alias("clock"), F.lit(1).alias("ifindex"), F.lit("in_discard_rate").alias("canonical_metric"))
    found = clusters.anchored(rows)
    assert "collect_list" not in found._jdf.queryExecution().toString()
    assert found.count() == 100_000 and found.filter("start <> clock - clock % 61").count() == 0


def test_neighbours_and_same_clock(spark):
    rows = events(spark, [0, 0, 0, 4, 100]).unionByName(events(spark, [130, None], "k"))
    found = {r.window_sec: (r.events, r.events_with_neighbour, r.events_with_later, r.share_pct) for r in clusters.neighbour_statistics(rows).collect()}
    assert found == {0: (6, 3, 2, 50.0), 5: (6, 4, 3, 66.67), 30: (6, 6, 4, 100.0), 60: (6, 6, 4, 100.0), 300: (6, 6, 5, 100.0)}
    by_host = {(r.hostid, r.window_sec): r.events_with_neighbour for r in clusters.neighbour_statistics(rows, ["hostid"]).collect()}
    assert by_host["h", 30] == 4 and by_host["k", 300] == 0
    same = clusters.same_clock_clusters(rows).collect()
    assert [(r.clock, r.events, r.hosts, r.interfaces, r.in_discard_rate, r.out_discard_rate) for r in same] == [(0, 3, 1, 3, 3, 0)]


@pytest.mark.parametrize("clocks, verdict", [
    ([], "no_counter_decrease"), ([0, 0, 900, 1900], "strong_device_wide_temporal_clustering"),
    ([0, 30, 900, 1900], "device_level_temporal_clustering"), ([0, 100, 200], "mostly_independent_counter_decreases"),
])
def test_temporal_verdict(spark, clocks, verdict):
    assert [r.classification for r in clusters.temporal_verdict(events(spark, clocks)).collect()] == [verdict]


def test_intervals_skip_repeated_clocks(spark):
    rows = events(spark, [0, 10, 10, 20, 50])
    assert [(r.interval, r.times, r["rank"]) for r in clusters.common_intervals(rows).orderBy("rank").collect()] == [(10, 2, 1), (30, 1, 2)]


def test_brackets_need_both_sides(spark):
    raw = series(spark, [5.0, 9.0, 2.0], "in_bps").unionByName(series(spark, [1.0], "out_bps", "b"))
    raw = raw.unionByName(series(spark, [1.0, 2.0], "oper_status", "c", step=14))
    marks = spark.createDataFrame([("x", "h", 1, "in_discard_rate", 10), ("y", "h", 1, "in_discard_rate", 20), ("z", "h", None, "in_discard_rate", 10)], EVENT)
    assert [(r.clock, r.previous_value, r.current_value, r.delta) for r in clusters.bracketed(marks, raw).collect()] == [(10, 9.0, 2.0, -7.0)]
    kinds = {r.itemid: r.classification for r in clusters.raw_classes(marks, raw).collect()}
    assert kinds == {"x": "multiple_raw_counter_decrease", "y": "discard_counter_only", "z": "discard_counter_only"}
    near_status = spark.createDataFrame([("x", "h", 1, "in_discard_rate", 5)], EVENT)
    assert not clusters.status_varies(near_status, raw).count()
    assert clusters.status_varies(near_status, raw, window=9).count() == 1


@pytest.mark.parametrize("values, kind", [
    ([100, 3, 4, 5, 6, 7, 8], "likely_true_counter_reset"), ([10, 9], "minor_counter_decrease"),
    ([100, 3, 3, 3, 4, 4, 4], "possible_counter_reset"), ([100, 3], "counter_behavior_uncertain"),
])
@pytest.mark.parametrize("step", [10, 50_000])
def test_decrease_behaviour(spark, values, kind, step):
    rows = series(spark, [float(v) for v in values], step=step)
    falls = counters.detect_decreases(rows, ["itemid"], "raw_value", "keep_first")
    found = behaviour.decrease_behaviour(falls, rows).collect()
    assert [(r.classification, r.before, r.after) for r in found] == [(kind, [float(values[0])], [float(v) for v in values[2:]] or found[0].after)]
    assert not found[0].after or len(values) > 2


def test_samples_beyond_cross_slices_and_repeated_clocks(spark):
    rows = spark.range(60).select(
        F.lit("a").alias("itemid"), F.floor(F.col("id") / 3).cast("long").alias("clock"), F.col("id").alias("ordinal"), F.col("id").cast("double").alias("v")
    ).withColumn("clock", F.col("clock") * 40_000)
    after = {r.clock: r.x for r in behaviour.beyond(rows, ["itemid"], "v", 10, True, "x").collect()}
    before = {r.clock: r.x for r in behaviour.beyond(rows, ["itemid"], "v", 10, False, "x").collect()}
    for k in range(20):
        assert after[40_000 * k] == [float(v) for v in range(3 * k + 3, 60)][:10]
        assert before[40_000 * k] == [float(v) for v in range(3 * k - 1, -1, -1)][:10]


@pytest.mark.parametrize("values, kind, trust", [
    ([1], "insufficient_data", "low"), ([1, 2, 2], "likely_counter", "high"), ([2, 2], "possible_counter", "medium"),
    ([*range(12), 3], "likely_counter_with_resets", "medium"), ([3, 1, 2], "likely_interval_or_rate", "medium"),
])
def test_behaviour_classes(spark, values, kind, trust):
    found = behaviour.behaviour_classes(series(spark, [None, *map(float, values)])).collect()
    assert [(r.samples, r.classification, r.confidence) for r in found] == [(len(values), kind, trust)]


def test_reset_audit_status(spark):
    schema = "semantic_type string, previous_raw_value double, raw_value double, value double, delta_value double, counter_reset boolean"
    good = ("counter", 5.0, 3.0, None, -2.0, True)
    audit = lambda *rows: behaviour.reset_audit(spark.createDataFrame(list(rows), schema)).first()
    assert audit(("counter", None, 1.0, None, None, False), ("gauge", 9.0, 1.0, 1.0, None, False)).status == "PASS"
    assert audit(good).status == "PASS WITH WARNINGS"
    worst = audit(good, ("counter", 5.0, 3.0, 1.0, None, False), ("counter", 5.0, None, None, None, False))
    assert (worst.decrease, worst.invalid, worst.status) == (2, 4, "FAIL")
