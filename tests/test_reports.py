"""Summaries of decreases against plain Python: ties, missing names, empty tables, limits of lists, faults of records."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pulseframe.operators import audits, behaviour, reports

EVENTS = "itemid string, hostid string, host string, host_name string, ifindex long, device_role string, canonical_metric string, clock long, decrease double, classification string"


def made(n=400, seed=3):
    rng = random.Random(seed)
    return [
        (
            f"i{k}", f"{h}", f"h{h}", rng.choice([f"Host {h:02}", "", None]) if h % 9 == 0 else f"Host {h:02}", rng.choice([1, 2, 3, None]), rng.choice(["switch", None]),
            rng.choice(["in_discard_rate", "out_discard_rate"]), rng.randrange(150), rng.choice([1.0, 2.5, 7.0, None]), rng.choice(["a", "b"]),
        )
        for k, h in ((k, rng.randrange(40)) for k in range(n))
    ]


@pytest.fixture(scope="module")
def rows():
    return made()


@pytest.fixture(scope="module")
def events(spark, rows):
    return spark.createDataFrame(rows, EVENTS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], EVENTS)


def leading(counter, most):
    return sorted(counter.items(), key=lambda p: (-p[1], p[0] is None, p[0] or ""))[:most]


def test_event_statistics(events, rows, none):
    found = {}
    for r in reports.event_statistics(events, {"kind": F.col("classification")}).collect():
        found.setdefault(r["dimension"], []).append((r["rank"], r["name"], r["events"]))
    want = {
        "metric": Counter(r[6] for r in rows), "role": Counter(r[5] for r in rows), "kind": Counter(r[9] for r in rows),
        "host": Counter(r[3] or r[2] for r in rows), "interface": Counter(f"{r[1]}|{r[4]}" for r in rows if r[4] is not None),
    }
    assert len(want["host"]) > reports.TOP and len(want["interface"]) > reports.TOP
    for dimension, counter in want.items():
        assert sorted(found.pop(dimension)) == [(k + 1, name, n) for k, (name, n) in enumerate(leading(counter, reports.TOP))]
    assert not found and reports.event_statistics(none).count() == 0


def test_magnitudes(events, rows, none):
    values = sorted(r[8] for r in rows if r[8] is not None)
    got = reports.magnitudes(events, {"decrease": F.col("decrease"), "nothing": F.lit(None)}).collect()
    assert [r["measure"] for r in got] == ["decrease"]
    at = (len(values) - 1) * 0.95
    p95 = values[int(at)] * (1 - at % 1) + values[min(int(at) + 1, len(values) - 1)] * (at % 1)
    assert (got[0]["count"], got[0]["min"], got[0]["max"]) == (len(values), 1.0, 7.0)
    assert got[0]["mean"] == pytest.approx(sum(values) / len(values)) and got[0]["p95"] == pytest.approx(p95)
    assert reports.magnitudes(none, {"decrease": F.col("decrease")}).count() == 0


def test_share_of_one_clock(events, rows, none):
    clocks = {}
    for r in rows:
        clocks.setdefault(r[7], []).append(r)
    same = sum(len(v) for v in clocks.values() if len(v) > 1)
    wide = {c: v for c, v in clocks.items() if len({(r[1], r[4]) for r in v}) >= 2}
    assert tuple(reports.same_clock_share(events).first()) == (len(rows), same, len(wide), round(same / len(rows) * 100, 2))
    assert tuple(reports.same_clock_share(none).first()) == (0, 0, 0, 0.0)
    want = sorted(((-len(v), c, len({(r[1], r[4]) for r in v}), len({r[1] for r in v})) for c, v in wide.items()))[: reports.TOP]
    got = sorted(tuple(r[c] for c in ("rank", "clock", "events", "interfaces", "hosts")) for r in reports.largest_clusters(events).collect())
    assert got == [(k + 1, c, -n, i, h) for k, (n, c, i, h) in enumerate(want)] and reports.largest_clusters(none).count() == 0


def test_deep_counts_and_verdicts(spark, none):
    kinds = ["minor_counter_decrease"] * 2 + ["likely_true_counter_reset", "possible_counter_reset", "other", None]
    frame = spark.createDataFrame([(k, n % 2 == 0, None if n == 0 else True) for n, k in enumerate(kinds)], "classification string, status_changed boolean, uptime_decreased boolean")
    row = reports.deep_counts(frame, 6).first()
    assert tuple(row) == (6, 1, 1, 2, 2, 3, 5, 6, True) and not reports.deep_counts(frame).first()["as_expected"]

    def verdict(*kinds):
        frame = spark.createDataFrame([("h", 1, k) for k in kinds], "hostid string, ifindex long, classification string")
        row = reports.cross_metric_verdict(frame).first()
        return row["verdict"], row["confidence"], row["interfaces"]

    alone, several, status = "discard_counter_only", "multiple_counter_decrease", "possible_interface_event"
    assert verdict(alone, alone) == ("discard_counter_behavior", "high", 1)
    assert verdict(alone, several, status) == ("multiple_counter_reset_behavior", "high", 1)
    assert verdict(alone, status) == ("possible_interface_event", "medium", 1) and verdict(alone, "uncertain") == ("uncertain", "low", 1)
    assert verdict() == ("discard_counter_behavior", "high", 0)


@pytest.mark.parametrize("seed", [1, 2])
def test_other_counters_near_an_event(spark, seed):
    rng = random.Random(seed)
    records = [
        (f"h{rng.randrange(2)}", rng.choice([1, 2]), rng.choice(["in_bps", "out_bps", "in_pps"]), rng.randrange(900), k, float(rng.randrange(50))) for k in range(300)
    ]
    marks = [(f"h{rng.randrange(2)}", rng.choice([1, 2, None]), rng.randrange(900)) for _ in range(40)]
    last, falls = {}, []
    by_clock = {}
    for h, i, m, c, k, v in sorted(records, key=lambda r: (r[3], r[4])):
        by_clock.setdefault((h, i, m), {}).setdefault(c, []).append(v)
    for key, clocks in by_clock.items():
        last = None
        for c in sorted(clocks):
            if last is not None and clocks[c][0] < last:
                falls.append((*key, c))
            last = clocks[c][-1]
    frame = spark.createDataFrame(records, "hostid string, ifindex long, canonical_metric string, clock long, ordinal long, raw_value double")
    events = spark.createDataFrame(marks, "hostid string, ifindex long, clock long")
    got = {r["metric"]: r["events"] for r in reports.cross_metric_totals(events, frame).collect()}
    for m in got:
        assert got[m] == sum(any(f[:3] == (h, i, m) and abs(f[3] - c) <= 60 for f in falls) for h, i, c in marks)
    assert sum(got.values()) > 0


def test_readiness(spark):
    items = spark.createDataFrame([("1",), (" 1 ",), ("2",), ("",), (None,), ("3",)], "itemid string")
    good = [("1", "10", 1.0), ("2", "11", None), ("3", None, None)]
    bad = [("", "1", 1.0), (None, None, None), ("9", None, 1.0), ("9", "1", 2.0), ("2", None, 1.0), ("3", "x", 1.0), ("3", "x", float("nan"))]
    schema = "itemid string, clock string, value double"
    classes = spark.createDataFrame([("multiple_raw_counter_decrease",), ("discard_counter_only",)], "classification string")
    row = reports.readiness(classes, spark.createDataFrame(good + bad, schema), items).first().asDict()
    assert (row["duplicate_itemids"], row["missing_semantic"], row["invalid_records"]) == (1, 2, 4)
    assert row["fatal"] == "duplicate_itemids,missing_semantic,invalid_records" and row["warnings"] == "counter_decreases,multiple_counters"
    assert row["status"] == "FAIL" and not row["ready"]
    fine = reports.readiness(classes.limit(0), spark.createDataFrame(good, schema), items.filter("itemid in ('1', '2', '3')")).first().asDict()
    assert fine["status"] == "PASS WITH WARNINGS" and fine["ready"] and fine["fatal"] == fine["warnings"] == ""
    empty = reports.readiness(classes.limit(0), spark.createDataFrame([], schema), items.limit(0)).first()
    assert empty["ready"] and empty["counter_decreases"] == 0


def test_samples_at_both_ends_and_the_issue_verdict(spark):
    rows = [("a", c % 7, c, float(c)) for c in range(30)] + [("b", 5, 1, None), ("b", None, 2, 1.0)]
    frame = spark.createDataFrame(rows, "itemid string, clock long, ordinal long, value double").repartition(3)
    got = {}
    for r in behaviour.edge_samples(frame, 4).collect():
        got.setdefault((r["itemid"], r["edge"]), []).append((r["rank"], r["clock"], r["ordinal"]))
    order = sorted((r[1], r[2]) for r in rows if r[0] == "a")
    assert sorted(got["a", "first"]) == [(k + 1, *p) for k, p in enumerate(order[:4])]
    assert sorted(got["a", "last"]) == [(k + 1, *p) for k, p in enumerate(order[::-1][:4])]
    assert got["b", "first"] == got["b", "last"] == [(1, 5, 1)] and len(got) == 4
    totals = spark.createDataFrame([("x", "high", 2), ("y", "low", 3)], "issue string, severity string, issues long")
    assert tuple(audits.verdict(totals).first()) == (5, False) and tuple(audits.verdict(totals.limit(0)).first()) == (0, True)
