"""Queries and oracle SQL of decreases in time (G17, G19 to G22, G27), beside other counters (G9) and in brackets (G29 to G31)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulseframe.operators import clusters, counters
from pulseframe.plans import bindings, staging
from pulseframe.plans.oracles import TRANSFORMED, decreases, with_
from pulseframe.plans.queries import rounded, transformed
from pulseframe.vocab import DISCARD_METRICS

QUERIES: dict = {}
SQL: dict[str, str] = {}

_ATTRIBUTES = ("hostid", "ifindex", "device_role", "canonical_metric")


def falls(spark, sf):
    return falls_of(transformed(spark, sf))


def falls_of(records):
    """Decreases of discard counters, written once: every part of a report reads them again."""
    rows = records.filter((F.col("transformation") == "delta_rate") & F.col("canonical_metric").isin(*DISCARD_METRICS))
    found = counters.detect_decreases(rows, ["itemid"], "raw_value", "take_last", _ATTRIBUTES)
    return staging.materialise(found, "discard-falls")


_EXTRA = ", " + ", ".join(f"arg_min({c}, ordinal) AS {c}" for c in _ATTRIBUTES)
EVENTS = with_(
    *TRANSFORMED,
    "discards AS (SELECT * FROM transformed WHERE transformation = 'delta_rate' AND canonical_metric IN ('in_discard_rate', 'out_discard_rate'))",
    decreases("discards", "itemid", "take_last", extra=_EXTRA),
).replace("WITH ", "WITH RECURSIVE ", 1).rstrip()


def _register(name: str, build, sql: str, *ctes: str) -> None:
    QUERIES[name], SQL[name] = build, ",\n ".join([EVENTS, *ctes]) + "\n" + sql


def _neighbours(key: str) -> str:
    by, lead = (f"PARTITION BY {key}", f"{key}, ") if key else ("", "")
    parts = [
        f"""SELECT {lead}{w} AS window_sec, clock, count(*) OVER ({by} ORDER BY clock RANGE BETWEEN {w} PRECEDING AND {w} FOLLOWING) > 1 AS beside,
        coalesce(lead(clock) OVER ({by} ORDER BY clock, itemid) - clock <= {w}, false) AS later FROM falls"""
        for w in clusters.WINDOWS_SEC
    ]
    return f"""SELECT {lead}window_sec, count(*) AS events, count_if(beside) AS events_with_neighbour, count_if(later) AS events_with_later,
      round(count_if(beside) / count(*) * 100, 2) AS share_pct FROM ({' UNION ALL '.join(parts)}) GROUP BY {lead}window_sec"""


_register("G19_neighbours", lambda spark, sf: clusters.neighbour_statistics(falls(spark, sf)), _neighbours(""))
_register("G19_host_neighbours", lambda spark, sf: clusters.neighbour_statistics(falls(spark, sf), ["hostid"]), _neighbours("hostid"))

_BY_METRIC = ", ".join(f"count_if(canonical_metric = '{m}') AS {m}" for m in DISCARD_METRICS)
SAME = f"""same_clock AS (
  SELECT clock, count(*) AS events, count(DISTINCT hostid) AS hosts, count(DISTINCT concat(hostid, '|', ifindex)) AS interfaces, {_BY_METRIC}
  FROM falls GROUP BY 1 HAVING count(*) >= 2)"""
ANCHORED = f"""anchors AS (
  SELECT hostid, min(clock) AS start FROM falls GROUP BY 1 UNION ALL
  SELECT a.hostid, min(f.clock) FROM anchors a JOIN falls f ON f.hostid = a.hostid AND f.clock > a.start + {clusters.CLUSTER_SPAN_SEC} GROUP BY a.hostid, a.start),
 host_clusters AS (
  SELECT hostid, start, max(clock) AS "end", count(*) AS events, count(DISTINCT ifindex) AS interfaces, {_BY_METRIC}, max(clock) - start AS duration_sec
  FROM falls JOIN anchors USING (hostid) WHERE clock BETWEEN start AND start + {clusters.CLUSTER_SPAN_SEC} GROUP BY 1, 2 HAVING count(*) >= 2)"""
_register("G20_same_clock_clusters", lambda spark, sf: clusters.same_clock_clusters(falls(spark, sf)), "SELECT * FROM same_clock", SAME)
_register("G21_host_clusters", lambda spark, sf: clusters.host_clusters(falls(spark, sf)), "SELECT * FROM host_clusters", ANCHORED)
_register(
    "G22_temporal_verdict", lambda spark, sf: clusters.temporal_verdict(falls(spark, sf)),
    """SELECT events, same_clock_events, events_within_span, multi_interface_clusters,
  CASE WHEN events = 0 THEN 'no_counter_decrease' WHEN same_clock_events >= events / 2 AND multi_interface_clusters > 0 THEN 'strong_device_wide_temporal_clustering'
    WHEN events_within_span >= events / 2 AND multi_interface_clusters > 0 THEN 'device_level_temporal_clustering'
    WHEN events_within_span >= events / 2 THEN 'temporal_clustering_without_strong_multi_interface_evidence' ELSE 'mostly_independent_counter_decreases' END AS classification,
  CASE WHEN events = 0 OR (greatest(same_clock_events, events_within_span) >= events / 2 AND multi_interface_clusters > 0) THEN 'high' ELSE 'medium' END AS confidence
FROM (SELECT (SELECT count(*) FROM falls) AS events, (SELECT CAST(coalesce(sum(events), 0) AS BIGINT) FROM same_clock) AS same_clock_events,
  (SELECT count(*) FROM (SELECT count(*) OVER (ORDER BY clock RANGE BETWEEN 60 PRECEDING AND 60 FOLLOWING) > 1 AS b FROM falls) WHERE b) AS events_within_span,
  (SELECT count(*) FROM host_clusters WHERE interfaces >= 2) AS multi_interface_clusters)""", SAME, ANCHORED,
)


def _gaps(key: str) -> str:
    return f"""gaps AS (SELECT {key}, clock - lag(clock) OVER (PARTITION BY {key} ORDER BY clock) AS "interval" FROM (SELECT DISTINCT {key}, clock FROM falls))"""


_STATISTICS = """SELECT {k}, count("interval") AS count, CAST(min("interval") AS DOUBLE) AS min, CAST(max("interval") AS DOUBLE) AS max, round(avg("interval"), 3) AS mean,
  round(quantile_cont("interval", 0.5), 3) AS median FROM gaps WHERE "interval" IS NOT NULL GROUP BY 1"""
_register(
    "G17_common_intervals", lambda spark, sf: clusters.common_intervals(falls(spark, sf)),
    """SELECT hostid, "interval", count(*) AS times, row_number() OVER (PARTITION BY hostid ORDER BY count(*) DESC, "interval") AS "rank"
FROM gaps WHERE "interval" IS NOT NULL GROUP BY 1, 2 QUALIFY "rank" <= 10""", _gaps("hostid"),
)
_register(
    "G17_host_intervals", lambda spark, sf: rounded(clusters.interval_statistics(falls(spark, sf), ["hostid"])), _STATISTICS.format(k="hostid"), _gaps("hostid"),
)
_register(
    "G27_item_intervals", lambda spark, sf: rounded(clusters.interval_statistics(falls(spark, sf), ["itemid"])), _STATISTICS.format(k="itemid"), _gaps("itemid"),
)
_register(
    "G27_repeats", lambda spark, sf: clusters.repeats(falls(spark, sf)),
    """SELECT 'item' AS level, itemid AS name, count(*) AS events FROM falls GROUP BY 2 UNION ALL
SELECT 'interface', concat(hostid, '|', ifindex), count(*) FROM falls GROUP BY 2 UNION ALL SELECT 'host', hostid, count(*) FROM falls GROUP BY 2""",
)

SERIES = "hostid, ifindex, canonical_metric"
CROSS = (
    "others AS (SELECT * FROM transformed WHERE canonical_metric IN ('in_bps', 'out_bps'))",
    decreases("others", SERIES, "take_last", name="other_falls"),
    """status AS (
  SELECT hostid, ifindex, clock, arg_max(value, ordinal) AS v FROM transformed WHERE canonical_metric = 'oper_status' AND value IS NOT NULL GROUP BY 1, 2, 3)""",
    "status_steps AS (SELECT *, lag(v) OVER (PARTITION BY hostid, ifindex ORDER BY clock) AS was FROM status)",
    *[
        f"""{name}_hits AS (
  SELECT f.itemid, f.clock, count(*) AS n, min(abs(o.clock - f.clock)) AS d FROM falls f JOIN {source} o
  ON o.hostid = f.hostid AND o.ifindex = f.ifindex AND abs(o.clock - f.clock) <= 60 WHERE {wanted} GROUP BY 1, 2)"""
        for name, source, wanted in (("other", "other_falls", "true"), ("status", "status_steps", "v <> was"), ("traffic", "others", "true"))
    ],
    """crossed AS (
  SELECT f.itemid, f.clock, coalesce(o.n, 0) AS other_decreases, o.d AS other_decreases_distance, coalesce(s.n, 0) AS status_changes,
         s.d AS status_changes_distance, coalesce(t.n, 0) AS traffic, t.d AS traffic_distance
  FROM falls f LEFT JOIN other_hits o USING (itemid, clock) LEFT JOIN status_hits s USING (itemid, clock) LEFT JOIN traffic_hits t USING (itemid, clock)),
 cross_classes AS (
  SELECT *, CASE WHEN status_changes > 0 THEN 'possible_interface_event' WHEN other_decreases > 0 THEN 'multiple_counter_decrease'
    ELSE 'discard_counter_only' END AS classification,
    CASE WHEN status_changes > 0 AND other_decreases = 0 THEN 'medium' ELSE 'high' END AS confidence FROM crossed)""",
)


def crossed(spark, sf):
    return clusters.cross_metric(falls(spark, sf), staging.materialise(transformed(spark, sf), "records"))


_CROSS_COLUMNS = [f"{c}{d}" for c in ("other_decreases", "status_changes", "traffic") for d in ("", "_distance")]
_register(
    "G9_G9c_cross_metric", lambda spark, sf: crossed(spark, sf).select("itemid", "clock", *_CROSS_COLUMNS, "classification", "confidence"),
    "SELECT * FROM cross_classes", *CROSS,
)
_register(
    "G9d_class_totals", lambda spark, sf: crossed(spark, sf).groupBy("classification", "confidence").agg(F.count(F.lit(1)).alias("events")),
    "SELECT classification, confidence, count(*) AS events FROM cross_classes GROUP BY 1, 2", *CROSS,
)

BRACKETS = (
    f"""brackets AS (
  SELECT f.hostid, f.ifindex, f.clock, h.canonical_metric, max(h.clock) FILTER (h.clock <= f.clock) AS previous_clock,
         arg_max(h.value, (h.clock, h.ordinal)) FILTER (h.clock <= f.clock) AS previous_value, min(h.clock) FILTER (h.clock > f.clock) AS current_clock,
         arg_min(h.value, (h.clock, h.ordinal)) FILTER (h.clock > f.clock) AS current_value
  FROM (SELECT DISTINCT hostid, ifindex, clock FROM falls) f JOIN history h ON h.hostid = f.hostid AND h.ifindex = f.ifindex
  WHERE h.canonical_metric IN ('in_bps', 'out_bps') GROUP BY 1, 2, 3, 4
  HAVING min(h.clock) <= f.clock AND max(h.clock) > f.clock)""",
    """falling AS (SELECT hostid, ifindex, clock, count(*) AS m, count_if(current_value < previous_value) AS k FROM brackets GROUP BY 1, 2, 3),
 varied AS (
  SELECT f.itemid, f.clock FROM falls f JOIN history h ON h.hostid = f.hostid AND h.ifindex = f.ifindex AND abs(h.clock - f.clock) <= 5
  WHERE h.canonical_metric = 'oper_status' GROUP BY 1, 2 HAVING count(DISTINCT h.value) > 1),
 raw_classes AS (
  SELECT f.itemid, f.clock, coalesce(m, 0) AS related_metrics, coalesce(k, 0) AS related_decreases, v.itemid IS NOT NULL AS oper_status_change,
    CASE WHEN v.itemid IS NOT NULL THEN 'interface_status_event' WHEN k > 0 THEN 'multiple_raw_counter_decrease' ELSE 'discard_counter_only' END AS classification,
    CASE WHEN v.itemid IS NOT NULL OR k > 0 THEN 'high' ELSE 'medium' END AS confidence
  FROM falls f LEFT JOIN falling USING (hostid, ifindex, clock) LEFT JOIN varied v ON v.itemid = f.itemid AND v.clock = f.clock)""",
)


def raw_classes(spark, sf):
    return clusters.raw_classes(falls(spark, sf), bindings.history(spark, sf))


_register(
    "G29_brackets", lambda spark, sf: rounded(clusters.bracketed(falls(spark, sf), bindings.history(spark, sf))),
    """SELECT hostid, ifindex, canonical_metric, clock, round(previous_value, 3) AS previous_value, round(current_value, 3) AS current_value, previous_clock,
  current_clock, current_clock - previous_clock AS delta_time_sec, round(current_value - previous_value, 3) AS delta FROM brackets""", BRACKETS[0],
)
_register(
    "G30_G31_raw_classes",
    lambda spark, sf: raw_classes(spark, sf).select("itemid", "clock", "related_metrics", "related_decreases", "oper_status_change", "classification", "confidence"),
    "SELECT * FROM raw_classes", *BRACKETS,
)
_register(
    "G31_raw_verdict", lambda spark, sf: clusters.raw_verdict(raw_classes(spark, sf)),
    """SELECT *, CASE WHEN events = 0 THEN 'no_raw_counter_decrease' WHEN interface_status_event > 0 THEN 'counter_decrease_with_interface_events'
  WHEN multiple_raw_counter_decrease > 0 THEN 'multiple_raw_counter_behavior' ELSE 'discard_counter_only_behavior' END AS verdict
FROM (SELECT count(*) AS events, count_if(classification = 'interface_status_event') AS interface_status_event,
  count_if(classification = 'multiple_raw_counter_decrease') AS multiple_raw_counter_decrease, count_if(classification = 'discard_counter_only') AS discard_counter_only
  FROM raw_classes)""", *BRACKETS,
)
