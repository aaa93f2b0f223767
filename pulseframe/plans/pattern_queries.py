"""Queries and oracle SQL of device patterns (G10 to G16, G18) and of what surrounds an event (G25, G26)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulseframe.operators import device_pattern, event_context
from pulseframe.plans import bindings, staging
from pulseframe.plans.cluster_queries import EVENTS, falls, falls_of
from pulseframe.plans.queries import rounded, transformed
from pulseframe.vocab import DISCARD_METRICS

QUERIES: dict = {}
SQL: dict[str, str] = {}

#: A reach at which the bound tables, with an event every few minutes a host, have something near.
WIDE = 900


def records(spark, sf):
    return staging.materialise(transformed(spark, sf), "records")


def _register(name: str, build, sql: str, *ctes: str) -> None:
    QUERIES[name], SQL[name] = build, ",\n ".join([EVENTS, *ctes]) + "\n" + sql


def _listed(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


MARKS = "marks AS (SELECT DISTINCT hostid, ifindex, clock FROM falls), host_marks AS (SELECT DISTINCT hostid, clock FROM falls)"

for _reach, _suffix in ((device_pattern.REACH_SEC, ""), (WIDE, "_wide")):
    _register(
        f"G10_nearest_samples{_suffix}",
        lambda spark, sf, reach=_reach: rounded(device_pattern.nearest_samples(falls(spark, sf), records(spark, sf), reach)),
        f"""SELECT hostid, ifindex, clock, canonical_metric, s.clock AS sample_clock, s.itemid AS sample_itemid, round(s.value, 3) AS value, round(s.raw_value, 3) AS raw_value
FROM (SELECT m.hostid, m.ifindex, m.clock, t.canonical_metric,
    arg_min({{'clock': t.clock, 'itemid': t.itemid, 'value': t.value, 'raw_value': t.raw_value}}, (abs(t.clock - m.clock), t.clock, t.ordinal)) AS s
  FROM marks m JOIN transformed t ON t.hostid = m.hostid AND t.ifindex = m.ifindex AND abs(t.clock - m.clock) <= {_reach}
  WHERE t.canonical_metric IN ({_listed(device_pattern.RELATED)}) GROUP BY ALL)""", MARKS,
    )

_register(
    "G11_event_context",
    lambda spark, sf: device_pattern.context(falls(spark, sf), records(spark, sf)).select(
        "hostid", "ifindex", "clock", *[F.array_join(F.transform(c, lambda x: F.round(x, 3).cast("decimal(20,3)").cast("string")), " ").alias(c) for c in ("before", "after")], "monotonic"
    ),
    """SELECT m.hostid, m.ifindex, m.clock, coalesce(array_to_string(list_transform(b, lambda x: x::DECIMAL(20,3)::VARCHAR), ' '), '') AS before,
  coalesce(array_to_string(list_transform(a, lambda x: x::DECIMAL(20,3)::VARCHAR), ' '), '') AS after,
  coalesce(len(a) >= 2 AND len(list_filter(range(2, len(a) + 1), lambda i: a[i] < a[i - 1])) = 0, false) AS monotonic
FROM marks m
LEFT JOIN (SELECT hostid, ifindex, clock, list(v ORDER BY k DESC) AS b FROM (
  SELECT m.*, round(t.raw_value, 3) AS v, row_number() OVER (PARTITION BY m.hostid, m.ifindex, m.clock ORDER BY t.clock DESC, t.ordinal DESC) AS k
  FROM marks m JOIN transformed t ON t.hostid = m.hostid AND t.ifindex = m.ifindex AND t.clock < m.clock QUALIFY k <= 5) GROUP BY ALL) USING (hostid, ifindex, clock)
LEFT JOIN (SELECT hostid, ifindex, clock, list(v ORDER BY k) AS a FROM (
  SELECT m.*, round(t.raw_value, 3) AS v, row_number() OVER (PARTITION BY m.hostid, m.ifindex, m.clock ORDER BY t.clock, t.ordinal) AS k
  FROM marks m JOIN transformed t ON t.hostid = m.hostid AND t.ifindex = m.ifindex AND t.clock > m.clock QUALIFY k <= 5) GROUP BY ALL) USING (hostid, ifindex, clock)""", MARKS,
)

_register(
    "G12_instant_metrics", lambda spark, sf: device_pattern.instant_metrics(falls(spark, sf), records(spark, sf)),
    """SELECT hostid, clock, canonical_metric, count(*) AS records FROM transformed JOIN host_marks USING (hostid, clock)
WHERE canonical_metric <> '' GROUP BY ALL""", MARKS,
)


def pattern_ctes(reach: int, own: bool) -> str:
    """Pairs of events and records, steps of related counters and of the status, and what each event meets."""
    related = _listed(device_pattern.RELATED_COUNTERS)
    other = "" if own else "AND s.canonical_metric <> f.canonical_metric"
    return f"""host_near AS (
  SELECT m.hostid, m.clock, count(*) FILTER (t.clock = m.clock) AS instant_records, count(DISTINCT t.ifindex) FILTER (t.clock = m.clock) AS instant_interfaces,
    count(*) AS nearby_records, count(*) FILTER (t.counter_reset AND t.canonical_metric IN ({_listed(DISCARD_METRICS)})) AS discard_resets,
    count(*) FILTER (t.counter_reset AND t.canonical_metric NOT IN ({_listed(DISCARD_METRICS)})) AS other_resets,
    count(DISTINCT t.ifindex) FILTER (t.counter_reset OR t.clock = m.clock) AS affected,
    list_sort(list(DISTINCT t.ifindex) FILTER (t.counter_reset OR t.clock = m.clock)) AS interfaces
  FROM host_marks m JOIN transformed t ON t.hostid = m.hostid AND abs(t.clock - m.clock) <= {reach} GROUP BY ALL),
 steps AS (
  SELECT hostid, ifindex, canonical_metric, clock, raw_value, value, lag(raw_value) OVER w AS raw_was, lag(value) OVER w AS was FROM transformed
  WINDOW w AS (PARTITION BY hostid, ifindex, canonical_metric ORDER BY clock, ordinal)),
 related AS (
  SELECT f.itemid, f.clock, count(s.clock) AS related FROM falls f LEFT JOIN steps s ON s.hostid = f.hostid AND s.ifindex = f.ifindex AND s.clock <= f.clock
    AND s.canonical_metric IN ({related}) AND s.raw_value < s.raw_was {other} GROUP BY ALL),
 flips AS (
  SELECT f.itemid, f.clock, count(s.clock) AS status_changes FROM falls f LEFT JOIN steps s ON s.hostid = f.hostid AND s.ifindex = f.ifindex
    AND abs(s.clock - f.clock) <= {reach} AND s.canonical_metric = 'oper_status' AND s.value <> s.was GROUP BY ALL),
 patterns AS (
  SELECT f.itemid, f.clock, f.hostid, f.device_role, f.canonical_metric, h.* EXCLUDE (hostid, clock, interfaces), related, status_changes,
    CASE WHEN status_changes > 0 THEN 'possible_interface_event' WHEN instant_interfaces < 3 THEN 'isolated_counter_behavior'
      WHEN related = 0 THEN 'device_wide_discard_counter_behavior' ELSE 'device_wide_multiple_counter_behavior' END AS classification,
    CASE WHEN status_changes > 0 THEN 'medium' WHEN instant_interfaces < 3 THEN 'low' WHEN related = 0 THEN 'high' ELSE 'medium' END AS confidence
  FROM falls f JOIN host_near h USING (hostid, clock) JOIN related USING (itemid, clock) JOIN flips USING (itemid, clock))"""


def pattern(spark, sf, reach=device_pattern.REACH_SEC, own=True):
    rows = records(spark, sf)
    return device_pattern.device_pattern(falls_of(rows), rows, reach, own)


_PARTS = ("instant_records", "instant_interfaces", "nearby_records", "discard_resets", "other_resets", "affected", "related", "status_changes")
for _reach, _own, _suffix in ((device_pattern.REACH_SEC, True, ""), (WIDE, False, "_wide")):
    _register(
        f"G12_G16_device_pattern{_suffix}",
        lambda spark, sf, reach=_reach, own=_own: pattern(spark, sf, reach, own).select("itemid", "clock", *_PARTS, "classification", "confidence"),
        f"SELECT itemid, clock, {', '.join(_PARTS)}, classification, confidence FROM patterns", MARKS, pattern_ctes(_reach, _own),
    )
_register(
    "G15_affected_interfaces",
    lambda spark, sf: device_pattern.affected_sets(falls(spark, sf), records(spark, sf), WIDE).select(
        "hostid", "clock", F.size("interfaces").cast("bigint").alias("affected"), F.array_join("interfaces", ",").alias("interfaces")
    ),
    "SELECT hostid, clock, affected, array_to_string(interfaces, ',') AS interfaces FROM host_near", MARKS, pattern_ctes(WIDE, True),
)
_register(
    "G18_pattern_summary", lambda spark, sf: device_pattern.pattern_summary(pattern(spark, sf)),
    """SELECT count(*) AS events, count_if(instant_interfaces >= 3) AS three_or_more_interfaces, count_if(instant_interfaces >= 2) AS two_or_more_interfaces,
  count_if(related > 0) AS with_related_decrease, count_if(status_changes > 0) AS with_status_change FROM patterns""",
    MARKS, pattern_ctes(device_pattern.REACH_SEC, True),
)
_register(
    "G18_pattern_totals",
    lambda spark, sf: device_pattern.pattern_totals(pattern(spark, sf).withColumns({"host": F.lit(None).cast("string"), "host_name": F.concat(F.lit("Host "), "hostid")}), 5),
    """SELECT dimension, name, count(*) AS events, row_number() OVER (PARTITION BY dimension ORDER BY count(*) DESC, name) AS "rank"
FROM (SELECT unnest([{'dimension': 'classification', 'name': classification}, {'dimension': 'confidence', 'name': confidence}, {'dimension': 'metric', 'name': canonical_metric},
  {'dimension': 'role', 'name': device_role}, {'dimension': 'host', 'name': concat('Host ', hostid)}], recursive := true) FROM patterns)
GROUP BY 1, 2 QUALIFY dimension <> 'host' OR "rank" <= 5""", MARKS, pattern_ctes(device_pattern.REACH_SEC, True),
)

# --- around an event --------------------------------------------------------------------------------

_HEALTH = """health AS (SELECT * REPLACE (CASE split_part(itemid, '-', 2) WHEN 'click' THEN 'cpu_pct' WHEN 'view' THEN 'memory_pct' WHEN 'purchase' THEN 'icmp_loss_pct'
    WHEN 'error' THEN 'icmp_rtt_sec' ELSE 'uptime' END AS canonical_metric) FROM transformed),
 around AS (SELECT hostid, ifindex, clock, ordinal, canonical_metric, value, raw_value FROM transformed WHERE hostid IS NOT NULL
  UNION ALL SELECT hostid, ifindex, clock, ordinal, canonical_metric, CASE WHEN ordinal % 3 > 0 THEN value END, raw_value FROM health)"""


def around(spark, sf):
    return around_of(records(spark, sf))


def around_of(rows):
    """Interface records and the same read as host health, whose values are missing in every third row."""
    columns = ("hostid", "ifindex", "clock", "ordinal", "canonical_metric", "value", "raw_value")
    health = bindings.as_device_health(rows).withColumn("value", F.when(F.col("ordinal") % 3 > 0, F.col("value")))
    return rows.select(*columns).unionByName(health.select(*columns))


def related(spark, sf, key):
    found = event_context.related_values(falls(spark, sf), around(spark, sf), key, list_size=8)
    rows = found.select(*key, "clock", "canonical_metric", F.inline("samples").alias("sample_clock", "ordinal", "value", "raw_value"))
    return rounded(rows)


for _key, _name in ((("hostid", "ifindex"), "interface"), (("hostid",), "host")):
    _on = " AND ".join(f"t.{c} = m.{c}" for c in _key)
    _register(
        f"G25_related_values_by_{_name}", lambda spark, sf, key=_key: related(spark, sf, key),
        f"""SELECT {', '.join(f'm.{c}' for c in _key)}, m.clock, t.canonical_metric, t.clock AS sample_clock, t.ordinal, round(t.value, 3) AS value, round(t.raw_value, 3) AS raw_value
FROM (SELECT DISTINCT {', '.join(_key)}, clock FROM falls) m JOIN around t ON {_on} AND abs(t.clock - m.clock) <= 300
WHERE t.canonical_metric IN ({_listed(event_context.RELATED)})""", _HEALTH,
    )


def _inside(name: str, key: str, metric: str, value: str, moved: str) -> str:
    """Moves between successive samples, by (clock, value), of each event's own window."""
    on = " AND ".join(f"t.{c} = m.{c}" for c in key.split(", "))
    lead = ", ".join(f"m.{c}" for c in key.split(", "))
    return f"""{name} AS (SELECT {key}, mark, count(*) FILTER ({moved}) AS n FROM (
  SELECT {lead}, m.clock AS mark, {value} AS v, lag({value}) OVER (PARTITION BY {lead}, m.clock ORDER BY t.clock, {value}) AS was
  FROM (SELECT DISTINCT {key}, clock FROM falls) m JOIN around t ON {on} AND abs(t.clock - m.clock) <= {{w}}
  WHERE t.canonical_metric = '{metric}' AND {value} IS NOT NULL) GROUP BY ALL)"""


for _window, _suffix in ((event_context.WINDOW_SEC, ""), (20_000, "_wide")):
    _register(
        f"G26_transitions{_suffix}",
        lambda spark, sf, window=_window: event_context.transitions(falls(spark, sf), around(spark, sf), window).select(
            "itemid", "clock", "status_changes", "uptime_decreases", "status_changed", "uptime_decreased"
        ),
        """SELECT itemid, clock, coalesce(s.n, 0) AS status_changes, coalesce(u.n, 0) AS uptime_decreases, coalesce(s.n, 0) > 0 AS status_changed, coalesce(u.n, 0) > 0 AS uptime_decreased
FROM falls f LEFT JOIN flips s ON s.hostid = f.hostid AND s.ifindex = f.ifindex AND s.mark = f.clock LEFT JOIN drops u ON u.hostid = f.hostid AND u.mark = f.clock""",
        _HEALTH, _inside("flips", "hostid, ifindex", "oper_status", "t.value", "v <> was").format(w=_window),
        _inside("drops", "hostid", "uptime", "coalesce(t.value, t.raw_value)", "v < was").format(w=_window),
    )
_register(
    "G26_status_change_list", lambda spark, sf: event_context.status_change_list(falls(spark, sf), around(spark, sf), 20_000),
    """SELECT hostid, ifindex, clock, since AS from_clock, sampled AS to_clock, was AS from_value, v AS to_value FROM (
  SELECT m.*, t.clock AS sampled, t.value AS v, lag(t.value) OVER w AS was, lag(t.clock) OVER w AS since
  FROM marks m JOIN around t ON t.hostid = m.hostid AND t.ifindex = m.ifindex AND abs(t.clock - m.clock) <= 20000 WHERE t.canonical_metric = 'oper_status' AND t.value IS NOT NULL
  WINDOW w AS (PARTITION BY m.hostid, m.ifindex, m.clock ORDER BY t.clock, t.value)) WHERE v <> was""", MARKS, _HEALTH,
)
