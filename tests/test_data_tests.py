"""Hand-made cases of the data tests, the decrease detector and percentiles."""

import numpy as np
from pyspark.sql import functions as F

from pulseframe.functions.scalars import close_to, same_number
from pulseframe.operators import audits, correlate, counters, quantiles

SCHEMA = "itemid string, clock long, ordinal long, semantic_type string, transformation string, value double, raw_value double"


def test_direct_rows_follow_the_transformation(spark):
    rows = spark.createDataFrame(
        [("a", 1, 1, "gauge", "direct", None, None), ("b", 1, 2, None, "direct", 2.0, 1.0), ("c", 1, 3, "gauge", "direct", None, 1.0),
         ("d", 1, 4, "counter", "delta_rate", 2.0, 1.0)], SCHEMA)
    assert sorted(r.itemid for r in audits.direct_value_issues(rows).collect()) == ["b", "c"]


def test_preservation_skips_what_cannot_be_looked_up(spark):
    rows = spark.createDataFrame(
        [("a", 1, 1, "gauge", "direct", None, None), (None, 1, 2, "gauge", "direct", 1.0, 1.0), ("b", None, 3, "gauge", "direct", 1.0, 1.0),
         ("c", 1, 4, "gauge", "direct", 1.0, 1.0)], SCHEMA)
    raw = spark.createDataFrame([("a", 1, 1, None)], "itemid string, clock long, ordinal long, value double")
    assert [(r.itemid, r.issue) for r in audits.preservation_issues(raw, rows).collect()] == [("c", "missing_raw_record")]


def test_infinite_values_are_close_to_nothing_but_equal_to_themselves(spark):
    inf = float("inf")
    pairs = spark.createDataFrame([(inf, 5.0), (inf, inf), (None, None), (1.0, 1.0)], "a double, b double")
    a, b = F.col("a"), F.col("b")
    assert [tuple(r) for r in pairs.select(close_to(a, b), same_number(a, b)).collect()] == [
        (False, False), (False, True), (False, True), (True, True)]


def test_issue_ranks_are_whole_across_slices(spark):
    rows = spark.range(500).select(
        F.lit("x").alias("itemid"), F.col("id").alias("clock"), (F.col("id") * 10_000).alias("ordinal"), F.lit("late").alias("issue"))
    ranked = audits.issue_details(rows).orderBy("ordinal").collect()
    assert [r["rank"] for r in ranked] == list(range(1, 501))


def test_decrease_across_a_day_without_a_full_key(spark):
    rows = spark.createDataFrame(
        [("h", 1, 86_390, 1, 10.0), ("h", 1, 86_410, 2, 5.0), ("h", None, 86_390, 3, 10.0), ("h", None, 86_410, 4, 5.0)],
        "hostid string, ifindex long, clock long, ordinal long, raw_value double")
    found = counters.detect_decreases(rows, ["hostid", "ifindex"]).collect()
    assert [(r.hostid, r.ifindex, r.clock, r.decrease) for r in found] == [("h", 1, 86_410, 5.0)]


def test_percentiles_are_exact_at_every_size(spark):
    sizes = {"1": 1, "2": 2, "4": 4, "51": 51, "big": 60_000}
    drawn = {k: np.random.default_rng(n).integers(0, 20_000, n).astype(float) for k, n in sizes.items()}
    rows = spark.createDataFrame([(k, float(x)) for k, xs in drawn.items() for x in xs], "g string, v double")
    points = {"least": 0.0, "median": 0.5, "p95": 0.95, "p99": 0.99, "most": 1.0}
    for r in quantiles.exact_percentiles(rows, ["g"], "v", points).collect():
        assert r.values_counted == sizes[r.g]
        np.testing.assert_allclose([r[n] for n in points], [np.quantile(drawn[r.g], p) for p in points.values()])


def test_signals_at_the_edge_of_the_window(spark):
    events = spark.createDataFrame([("h", 1, 1000), ("h", None, 1000), ("k", 1, 1000)], "hostid string, ifindex long, clock long")
    records = spark.createDataFrame(
        [("h", 1, 600, 1, "oper_status", 1.0), ("h", 1, 1300, 2, "oper_status", 2.0), ("h", 1, 1301, 3, "oper_status", 1.0),
         ("h", None, 1200, 4, "uptime", 90.0), ("h", None, 1500, 5, "uptime", 1.0), ("h", None, 1300, 6, "icmp_loss_pct", 1.0),
         ("k", 1, 699, 7, "in_bps", 3.0)],
        "hostid string, ifindex long, clock long, ordinal long, canonical_metric string, value double")
    found = {(r.hostid, r.ifindex): r for r in correlate.correlate(events, records).collect()}
    one, bare, far = found["h", 1], found["h", None], found["k", 1]
    assert (one.status_changes, one.status_changes_distance, one.uptime_falls, one.uptime_falls_distance) == (1, 300, 1, 200)
    assert (one.icmp_anomalies, one.activity, one.classification) == (0, 0, "likely_device_reboot")
    assert (bare.status_changes, bare.uptime_falls) == (0, 1)
    assert (far.activity, far.classification, far.confidence) == (0, "counter_reset_without_correlated_event", "low")
