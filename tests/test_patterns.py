"""Device patterns and event context against plain Python, with ties, repeated clocks, nulls and busy hosts."""

import random

import pytest
from pyspark.sql import functions as F

from pulseframe.operators import device_pattern, event_context

SCHEMA = "itemid string, hostid string, ifindex long, canonical_metric string, clock long, ordinal long, value double, raw_value double, counter_reset boolean"
METRICS = ["in_discard_rate", "out_discard_rate", "in_bps", "oper_status", "uptime", "cpu_pct", ""]


def made(seed=1, n=260, hosts=("a", "b"), span=160):
    """Records with many ties, missing values and missing identities; file order is the list's."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        value = rng.choice([None, 1.0, 2.0, 3.0])
        rows.append((
            f"i{rng.randrange(9)}", rng.choice([*hosts, None] if k % 20 == 0 else hosts), rng.choice([1, 2, 3, 4, None] if k % 9 == 0 else [1, 2, 3, 4]),
            rng.choice(METRICS), rng.randrange(span), k, value, rng.choice([value, 2.0, None]), rng.random() < 0.2,
        ))
    return rows


@pytest.fixture(scope="module")
def rows():
    return made()


@pytest.fixture(scope="module")
def records(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def marks(rows):
    return [r for r in rows if r[3] in ("in_discard_rate", "out_discard_rate") and r[1] and r[2] and r[5] % 2 == 0]


@pytest.fixture(scope="module")
def events(spark, marks):
    return spark.createDataFrame(marks, SCHEMA)


def on_interface(rows, e, metrics):
    return sorted((r for r in rows if r[1] == e[1] and r[2] == e[2] and r[3] in metrics), key=lambda r: (r[4], r[5]))


@pytest.mark.parametrize("reach", [5, 17])
def test_nearest_samples(records, rows, events, marks, reach):
    got = {(r.hostid, r.ifindex, r.clock, r.canonical_metric): (r.sample_clock, r.sample_itemid, r.value, r.raw_value) for r in device_pattern.nearest_samples(events, records, reach).collect()}
    want = {}
    for e in marks:
        for m in device_pattern.RELATED:
            near = [r for r in on_interface(rows, e, {m}) if abs(r[4] - e[4]) <= reach]
            if near:
                best = min(near, key=lambda r: (abs(r[4] - e[4]), r[4], r[5]))
                want[e[1], e[2], e[4], m] = (best[4], best[0], best[6], best[7])
    assert got == want


def test_context(records, rows, events, marks):
    got = {(r.hostid, r.ifindex, r.clock): (r.before, r.after, r.monotonic) for r in device_pattern.context(events, records).collect()}
    for e in marks:
        every = sorted((r for r in rows if r[1] == e[1] and r[2] == e[2]), key=lambda r: (r[4], r[5]))
        before = [r[7] for r in [r for r in every if r[4] < e[4]][-5:] if r[7] is not None]
        after = [r[7] for r in [r for r in every if r[4] > e[4]][:5] if r[7] is not None]
        assert got[e[1], e[2], e[4]] == (before, after, len(after) > 1 and all(x <= y for x, y in zip(after, after[1:], strict=False)))


@pytest.mark.parametrize("reach", [0, 5, 20])
def test_host_activity_and_affected_interfaces(records, rows, events, marks, reach):
    seen = {(r.hostid, r.clock): r for r in device_pattern.host_activity(events, records, reach).collect()}
    counts = {(r.hostid, r.clock): r.affected for r in device_pattern.affected_interfaces(events, records, reach).collect()}
    sets = {(r.hostid, r.clock): r.interfaces for r in device_pattern.affected_sets(events, records, reach).collect()}
    for e in marks:
        near = [r for r in rows if r[1] == e[1] and abs(r[4] - e[4]) <= reach]
        now = [r for r in near if r[4] == e[4]]
        found = seen[e[1], e[4]]
        assert (found.instant_records, found.instant_interfaces, found.nearby_records) == (len(now), len({r[2] for r in now} - {None}), len(near))
        flagged = [r for r in near if r[8]]
        discards = sum("discard" in r[3] for r in flagged)
        assert (found.discard_resets, found.other_resets) == (discards, len(flagged) - discards)
        affected = sorted(({r[2] for r in flagged} | {r[2] for r in now}) - {None})
        assert sets[e[1], e[4]] == affected and counts[e[1], e[4]] == len(affected)


def plain_moves(samples, column, moved):
    """Later samples of successive pairs for which ``moved`` holds."""
    return [b for a, b in zip(samples, samples[1:], strict=False) if a[column] is not None and b[column] is not None and moved(a[column], b[column])]


def test_related_decreases_and_status(records, rows, events, marks):
    every = {(r.hostid, r.ifindex, r.canonical_metric, r.clock): r.related for r in device_pattern.related_decreases(events, records).collect()}
    others = {(r.hostid, r.ifindex, r.canonical_metric, r.clock): r.related for r in device_pattern.related_decreases(events, records, own_metric=False).collect()}
    status = {(r.hostid, r.ifindex, r.clock): r.status_changes for r in device_pattern.status_moves(events, records, 12).collect()}
    for e in marks:
        falls = {m: sum(b[4] <= e[4] for b in plain_moves(on_interface(rows, e, {m}), 7, lambda x, y: y < x)) for m in device_pattern.RELATED_COUNTERS}
        key = (e[1], e[2], e[3], e[4])
        assert (every[key], others[key]) == (sum(falls.values()), sum(falls.values()) - falls[e[3]])
        flips = plain_moves(on_interface(rows, e, {"oper_status"}), 6, lambda x, y: x != y)
        assert status[e[1], e[2], e[4]] == sum(abs(b[4] - e[4]) <= 12 for b in flips)


def test_running_totals_cross_slices(spark):
    day = 86_400
    rows = [("i", "h", 1, "in_bps", k * day // 3, k, None, float(-k), False) for k in range(20)]
    events = spark.createDataFrame([("e", "h", 1, "in_discard_rate", k * day // 3, 99, None, None, None) for k in (0, 2, 11, 19)], SCHEMA)
    found = device_pattern.related_decreases(events, spark.createDataFrame(rows, SCHEMA))
    assert sorted((r.clock * 3 // day, r.related) for r in found.collect()) == [(0, 0), (2, 2), (11, 11), (19, 19)]


@pytest.mark.parametrize("extra, kind, trust", [
    ([], "device_wide_discard_counter_behavior", "high"),
    ([("x", "h", 1, "in_bps", 4, 50, 9.0, 9.0, False), ("x", "h", 1, "in_bps", 6, 51, 1.0, 1.0, True)], "device_wide_multiple_counter_behavior", "medium"),
    ([("x", "h", 1, "oper_status", 8, 50, 1.0, 1.0, False), ("x", "h", 1, "oper_status", 14, 51, 2.0, 2.0, False)], "possible_interface_event", "medium"),
])
def test_pattern_classes(spark, extra, kind, trust):
    rows = [(f"i{k}", "h", k, "in_discard_rate", 10, k, None, 1.0, True) for k in (1, 2, 3)] + extra
    records = spark.createDataFrame(rows, SCHEMA)
    found = device_pattern.device_pattern(records.filter("itemid = 'i1'"), records, own_metric=False).collect()
    assert [(r.classification, r.confidence, r.affected) for r in found] == [(kind, trust, 3)]
    alone = device_pattern.device_pattern(records.filter("itemid = 'i1'"), records.filter("ifindex is null")).collect()
    assert [(r.classification, r.confidence) for r in alone] == [("isolated_counter_behavior", "low")]
    one = device_pattern.pattern_summary(device_pattern.device_pattern(records.filter("itemid = 'i1'"), records, own_metric=False)).first()
    assert (one.events, one.three_or_more_interfaces, one.with_status_change) == (1, 1, int(kind == "possible_interface_event"))


@pytest.mark.parametrize("key", [["hostid", "ifindex"], ["hostid"]])
@pytest.mark.parametrize("size", [3, 1000])
def test_related_values(records, rows, events, marks, key, size):
    place = {"hostid": 1, "ifindex": 2}
    found = event_context.related_values(events, records, key, 20, list_size=size).collect()
    assert all(0 < len(r.samples) <= size for r in found)
    got = {}
    for r in sorted(found, key=lambda r: (r["slice"], r.part)):
        got.setdefault((*[r[c] for c in key], r.clock, r.canonical_metric), []).extend((s.clock, s.ordinal, s.value, s.raw_value) for s in r.samples)
    want = {}
    for e in {(tuple(e[place[c]] for c in key), e[4]) for e in marks}:
        for r in sorted(rows, key=lambda r: (r[4], r[5])):
            if tuple(r[place[c]] for c in key) == e[0] and r[3] in event_context.RELATED and abs(r[4] - e[1]) <= 20:
                want.setdefault((*e[0], e[1], r[3]), []).append((r[4], r[5], r[6], r[7]))
    assert got == want


@pytest.mark.parametrize("window", [0, 9, 40])
def test_transitions_inside_the_window(records, rows, events, marks, window):
    got = {r.ordinal: (r.status_changes, r.uptime_decreases) for r in event_context.transitions(events, records, window).collect()}
    listed = {}
    for r in event_context.status_change_list(events, records, window).collect():
        listed.setdefault((r.hostid, r.ifindex, r.clock), []).append((r.from_clock, r.to_clock, r.from_value, r.to_value))
    some = 0
    for e in marks:
        status = sorted((r[4], r[6]) for r in rows if r[1:4] == (e[1], e[2], "oper_status") and r[6] is not None and abs(r[4] - e[4]) <= window)
        up = sorted((r[4], r[6] if r[6] is not None else r[7]) for r in rows if r[1] == e[1] and r[3] == "uptime" and abs(r[4] - e[4]) <= window and (r[6] is not None or r[7] is not None))
        changes = [(a[0], b[0], a[1], b[1]) for a, b in zip(status, status[1:], strict=False) if a[1] != b[1]]
        drops = sum(b[1] < a[1] for a, b in zip(up, up[1:], strict=False))
        assert got[e[5]] == (len(changes), drops)
        assert sorted(listed.get((e[1], e[2], e[4]), [])) == sorted(changes)
        some += len(changes) + drops
    assert some or not window


def test_no_event_sample_pairs(records, events):
    for found in (device_pattern.device_pattern(events, records), event_context.transitions(events, records)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert device_pattern.device_pattern(events.limit(0), records).count() == 0
    empty = device_pattern.device_pattern(events, records.limit(0))
    assert empty.filter("classification = 'isolated_counter_behavior'").count() == events.count() == empty.count()
    assert event_context.transitions(events, records.filter(F.lit(False))).filter("status_changes = 0 and uptime_decreases = 0").count() == events.count()
