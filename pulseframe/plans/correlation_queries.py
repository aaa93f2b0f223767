"""Queries and oracle SQL of event correlation (G5 to G8): decreases of the interface history against its own
status and traffic and against the same events read as device health."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulseframe.operators import audits, correlate, counters
from pulseframe.plans import bindings, staging
from pulseframe.plans.oracles import DEVICE_NAMES, TRANSFORMED, decreases, with_
from pulseframe.plans.queries import transformed

QUERIES: dict = {}
SQL: dict[str, str] = {}

FIELDS = ("itemid", "hostid", "ifindex", "device_role", "canonical_metric", "clock", "ordinal", "transformation")


def health(spark, sf):
    """Device health with loss and response time scaled, so that both limits are crossed by some values."""
    metric, value = F.col("canonical_metric"), F.col("value")
    scaled = F.when(metric == "icmp_loss_pct", value / 200).when(metric == "icmp_rtt_sec", value / 1000).otherwise(value)
    rows = bindings.as_device_health(bindings.history(spark, sf))
    return rows.withColumns({"itemid": F.concat(F.lit("d-"), "itemid"), "value": scaled})


def records(spark, sf):
    interface = transformed(spark, sf).select(*FIELDS, "value", "raw_value")
    device = health(spark, sf).select(*FIELDS, "value", F.col("value").alias("raw_value"))
    return audits.first_per_clock(interface.unionByName(device))


def staged(spark, sf):
    """Events and records, each written once: every signal reads them again."""
    rows = staging.materialise(records(spark, sf), "records")
    falls = counters.detect_decreases(
        rows.filter(F.col("transformation") == "delta_rate"), ["itemid"], "raw_value", "take_last",
        ["hostid", "ifindex", "device_role", "canonical_metric"],
    )
    return staging.materialise(falls, "falls"), rows


def correlated(spark, sf):
    return correlate.correlate(*staged(spark, sf))


_NAMES = "CASE canonical_metric " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DEVICE_NAMES.items()) + " END"
RECORDS = f"""both_kinds AS (
  SELECT itemid, hostid, ifindex, device_role, canonical_metric, clock, ordinal, transformation, value, raw_value
  FROM transformed UNION ALL
  SELECT concat('d-', itemid), hostid, ifindex, device_role, {_NAMES}, clock, ordinal, 'direct',
         value / s, value / s
  FROM (SELECT *, CASE canonical_metric WHEN 'in_discard_rate' THEN 200 WHEN 'out_discard_rate' THEN 1000 ELSE 1 END AS s
        FROM history)),
 records AS (
  SELECT * FROM both_kinds QUALIFY row_number() OVER (PARTITION BY itemid, clock ORDER BY ordinal) = 1),
 counted AS (SELECT * FROM records WHERE transformation = 'delta_rate')"""
SIGNALS = """status AS (
  SELECT hostid, ifindex, clock, arg_max(value, ordinal) AS v FROM records
  WHERE canonical_metric = 'oper_status' AND value IS NOT NULL GROUP BY 1, 2, 3),
 status_steps AS (SELECT *, lag(v) OVER (PARTITION BY hostid, ifindex ORDER BY clock) AS was FROM status),
 uptime_steps AS (
  SELECT hostid, clock, value, lag(value) OVER w AS was, lag(clock) OVER w AS since FROM records
  WHERE canonical_metric = 'uptime' AND value IS NOT NULL WINDOW w AS (PARTITION BY hostid ORDER BY clock, ordinal)),
 status_hits AS (
  SELECT f.itemid, f.clock, count(*) AS n, min(abs(s.clock - f.clock)) AS d
  FROM falls f JOIN status_steps s ON f.hostid = s.hostid AND f.ifindex = s.ifindex
   AND abs(s.clock - f.clock) <= 300 WHERE s.v <> s.was GROUP BY 1, 2),
 uptime_hits AS (
  SELECT f.itemid, f.clock, count(*) AS n, min(least(abs(u.clock - f.clock), abs(u.since - f.clock))) AS d
  FROM falls f JOIN uptime_steps u ON f.hostid = u.hostid
   AND least(abs(u.clock - f.clock), abs(u.since - f.clock)) <= 300 WHERE u.value < u.was GROUP BY 1, 2),
 icmp_hits AS (
  SELECT f.itemid, f.clock, count(*) AS n, min(abs(r.clock - f.clock)) AS d
  FROM falls f JOIN records r ON f.hostid = r.hostid AND abs(r.clock - f.clock) <= 300
  WHERE (r.canonical_metric = 'icmp_loss_pct' AND r.value > 1.0)
     OR (r.canonical_metric = 'icmp_rtt_sec' AND r.value > 0.2) GROUP BY 1, 2),
 activity_hits AS (
  SELECT f.itemid, f.clock, count(*) AS n, min(abs(r.clock - f.clock)) AS d
  FROM falls f JOIN records r ON f.hostid = r.hostid AND f.ifindex = r.ifindex AND abs(r.clock - f.clock) <= 300
  WHERE r.value IS NOT NULL AND r.canonical_metric IN
   ('in_bps', 'out_bps', 'in_pps', 'out_pps', 'in_error_rate', 'out_error_rate', 'in_discard_rate', 'out_discard_rate')
  GROUP BY 1, 2),
 signals AS (
  SELECT f.*, coalesce(s.n, 0) AS status_changes, s.d AS status_changes_distance, coalesce(u.n, 0) AS uptime_falls,
         u.d AS uptime_falls_distance, coalesce(i.n, 0) AS icmp_anomalies, i.d AS icmp_anomalies_distance,
         coalesce(a.n, 0) AS activity, a.d AS activity_distance
  FROM falls f LEFT JOIN status_hits s USING (itemid, clock) LEFT JOIN uptime_hits u USING (itemid, clock)
  LEFT JOIN icmp_hits i USING (itemid, clock) LEFT JOIN activity_hits a USING (itemid, clock)),
 correlated AS (
  SELECT *, CASE WHEN uptime_falls > 0 THEN 'likely_device_reboot' WHEN status_changes > 0 THEN 'likely_interface_flap'
    WHEN icmp_anomalies > 0 THEN 'possible_network_disruption' WHEN activity > 0 THEN 'possible_interface_counter_reset'
    ELSE 'counter_reset_without_correlated_event' END AS classification,
    CASE WHEN uptime_falls > 0 OR status_changes > 0 THEN 'high' WHEN icmp_anomalies > 0 OR activity > 0 THEN 'medium'
    ELSE 'low' END AS confidence
  FROM signals)"""
_ATTRIBUTES = ", ".join(f"arg_min({c}, ordinal) AS {c}" for c in ("hostid", "ifindex", "device_role", "canonical_metric"))
BASE = with_(*TRANSFORMED, RECORDS, decreases("counted", "itemid", "take_last", extra=", " + _ATTRIBUTES), SIGNALS)


def _register(name: str, build, sql: str) -> None:
    QUERIES[name], SQL[name] = build, BASE + sql


def _signal(name: str):
    columns = ["itemid", "clock", name, f"{name}_distance"]
    return (lambda spark, sf: correlate.with_signal(*staged(spark, sf), name).select(*columns)), "SELECT " + ", ".join(columns) + " FROM correlated"


_register("G5_status_changes", *_signal("status_changes"))
_register("G6_uptime_falls", *_signal("uptime_falls"))
_register("G7_icmp_anomalies", *_signal("icmp_anomalies"))
_register("G8_interface_activity", *_signal("activity"))
_register(
    "G8c_event_classes",
    lambda spark, sf: correlated(spark, sf).select("itemid", "clock", "hostid", "ifindex", "classification", "confidence"),
    "SELECT itemid, clock, hostid, ifindex, classification, confidence FROM correlated",
)
_register(
    "G8a_correlation_totals", lambda spark, sf: correlate.totals(correlated(spark, sf)),
    " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, count(*) AS events FROM correlated GROUP BY 2"
        for d in correlate.DIMENSIONS
    ),
)
_register(
    "G8a_signal_counts", lambda spark, sf: correlate.signal_counts(correlated(spark, sf)),
    """SELECT count(*) AS events, count_if(uptime_falls > 0) AS uptime_falls, count_if(status_changes > 0) AS status_changes,
       count_if(icmp_anomalies > 0) AS icmp_anomalies, count_if(activity > 0) AS activity,
       count_if(coalesce(hostid, '') = '') AS missing_hostid, count_if(ifindex IS NULL) AS missing_ifindex FROM correlated""",
)
