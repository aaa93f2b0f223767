"""Queries and oracle SQL of event statistics (G23), the deep summary (G28), shares of one clock (G32), the readiness gate (G33), and lists and verdicts (G2, G9d, F10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulseframe.operators import audits, behaviour, clusters, counters, event_context, reports
from pulseframe.plans import bindings, staging
from pulseframe.plans.audit_queries import _SEVERITY, ALL_ISSUES, DAMAGED, _close, damaged, issues
from pulseframe.plans.behaviour_queries import BEHAVIOUR, DIRECTED, JUDGED
from pulseframe.plans.cluster_queries import BRACKETS, CROSS, SAME, crossed, raw_classes
from pulseframe.plans.feature_oracle import r3
from pulseframe.plans.oracles import HISTORY, ITEMS, TRANSFORMED, decreases, with_
from pulseframe.plans.pattern_queries import _HEALTH, _inside, around_of, records
from pulseframe.plans.queries import rounded, transformed
from pulseframe.vocab import DISCARD_METRICS

QUERIES: dict = {}
SQL: dict[str, str] = {}

_ATTRIBUTES = ("hostid", "host", "host_name", "ifindex", "device_role", "canonical_metric")
_EXTRA = ", " + ", ".join(f"arg_min({c}, ordinal) AS {c}" for c in _ATTRIBUTES)
FALLS = (
    *TRANSFORMED,
    "discards AS (SELECT * FROM transformed WHERE transformation = 'delta_rate' AND canonical_metric IN ('in_discard_rate', 'out_discard_rate'))",
    decreases("discards", "itemid", "take_last", extra=_EXTRA),
)


def _register(name: str, build, sql: str) -> None:
    QUERIES[name], SQL[name] = build, sql


def falls(spark, sf):
    """Decreases of discard counters with the names of their hosts, written once for the parts of a report."""
    rows = transformed(spark, sf).filter((F.col("transformation") == "delta_rate") & F.col("canonical_metric").isin(*DISCARD_METRICS))
    return staging.materialise(counters.detect_decreases(rows, ["itemid"], "raw_value", "take_last", _ATTRIBUTES), "named-falls")


def _totals(source: str, names: dict[str, str]) -> str:
    parts = [f"SELECT '{d}' AS dimension, {c} AS name, count(*) AS events, row_number() OVER (ORDER BY count(*) DESC, {c}) AS \"rank\" FROM {source} GROUP BY 2" for d, c in names.items()]
    for d, c in (("host", "host_name"), ("interface", "concat(hostid, '|', ifindex)")):
        parts.append(
            f"SELECT * FROM (SELECT '{d}' AS dimension, {c} AS name, count(*) AS events, row_number() OVER (ORDER BY count(*) DESC, {c}) AS \"rank\" FROM {source} GROUP BY 2 QUALIFY \"rank\" <= 20)"
        )
    return " UNION ALL ".join(parts)


def _magnitudes(source: str, measures: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{m}' AS measure, count({c}) AS count, {r3(f'min({c})', 'min')}, {r3(f'max({c})', 'max')}, {r3(f'avg({c})', 'mean')},
  {', '.join(r3(f'quantile_cont({c}, {p})', n) for n, p in (('median', 0.5), ('p95', 0.95), ('p99', 0.99)))} FROM {source} HAVING count({c}) > 0""" for m, c in measures.items()
    )


# --- events in time ---------------------------------------------------------------------------------

_WHOLE = {"metric": "canonical_metric", "role": "device_role"}
_register("G23_event_statistics", lambda spark, sf: reports.event_statistics(falls(spark, sf)), with_(*FALLS) + _totals("falls", _WHOLE))
_register(
    "G23_magnitudes", lambda spark, sf: rounded(reports.magnitudes(falls(spark, sf), {"decrease": F.col("decrease")})),
    with_(*FALLS) + _magnitudes("falls", {"decrease": "decrease"}),
)


def by_hour(events):
    """Few decreases of the tables share a second; many share an hour."""
    return events.withColumn("clock", F.col("clock") - F.col("clock") % 3600)


_HOURLY = "falls AS (SELECT * REPLACE (clock - clock % 3600 AS clock) FROM second_falls)"
for _suffix, _read, _sources in (("", lambda events: events, FALLS), ("_by_hour", by_hour, (*FALLS[:3], decreases("discards", "itemid", "take_last", "second_falls", _EXTRA), _HOURLY))):
    _register(
        f"G32_same_clock_share{_suffix}", lambda spark, sf, read=_read: reports.same_clock_share(read(falls(spark, sf))),
        with_(*_sources, "clocks AS (SELECT clock, count(*) AS n, count(DISTINCT concat(hostid, '|', ifindex)) AS k FROM falls GROUP BY 1)") + """
SELECT *, CASE WHEN events > 0 THEN round(same_clock_events / events * 100, 2) ELSE 0.0 END AS share_pct FROM (
  SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS events, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS same_clock_events, count_if(k >= 2) AS multi_interface_clusters FROM clocks)""",
    )
    _register(
        f"G32_largest_clusters{_suffix}", lambda spark, sf, read=_read: reports.largest_clusters(read(falls(spark, sf))),
        with_(*_sources, SAME) + """SELECT clock, events, interfaces, hosts, row_number() OVER (ORDER BY events DESC, clock) AS "rank"
FROM same_clock WHERE interfaces >= 2 QUALIFY "rank" <= 20""",
    )
_register(
    "G32_magnitudes",
    lambda spark, sf: rounded(reports.magnitudes(falls(spark, sf), {"magnitude": F.abs("delta"), "ratio": F.col("decrease_ratio")})),
    with_(*FALLS) + _magnitudes("falls", {"magnitude": "abs(delta)", "ratio": "decrease_ratio"}),
)

# --- deep summary -----------------------------------------------------------------------------------


def analysed(spark, sf):
    """Every decrease with its behaviour and the transitions around it, written once; so are the records and the judged
    decreases, which several steps read."""
    every = records(spark, sf)
    rows = every.filter("transformation = 'delta_rate'")
    found = counters.detect_decreases(rows, ["itemid"], "raw_value", "keep_first", _ATTRIBUTES)
    judged = staging.materialise(behaviour.decrease_behaviour(found, rows), "judged")
    return staging.materialise(event_context.transitions(judged, around_of(every), 20_000), "analysed")


ANALYSED = with_(
    *TRANSFORMED, "counted AS (SELECT * FROM transformed WHERE transformation = 'delta_rate')", decreases("counted", "itemid", "keep_first", extra=_EXTRA), JUDGED, _HEALTH,
    _inside("flips", "hostid, ifindex", "oper_status", "t.value", "v <> was").format(w=20_000),
    _inside("drops", "hostid", "uptime", "coalesce(t.value, t.raw_value)", "v < was").format(w=20_000),
    f"""analysed AS (SELECT f.*, ratio, {BEHAVIOUR}, coalesce(s.n, 0) > 0 AS status_changed, coalesce(u.n, 0) > 0 AS uptime_decreased
  FROM falls f JOIN judged USING (itemid, clock) LEFT JOIN flips s ON s.hostid = f.hostid AND s.ifindex = f.ifindex AND s.mark = f.clock
  LEFT JOIN drops u ON u.hostid = f.hostid AND u.mark = f.clock)""",
)
_register(
    "G28_deep_totals", lambda spark, sf: reports.event_statistics(analysed(spark, sf), {"classification": F.col("classification")}),
    ANALYSED + _totals("analysed", _WHOLE | {"classification": "classification"}),
)
_register(
    "G28_deep_magnitudes", lambda spark, sf: rounded(reports.magnitudes(analysed(spark, sf), {"decrease": F.col("decrease"), "ratio": F.col("ratio")})),
    ANALYSED + _magnitudes("analysed", {"decrease": "decrease", "ratio": "ratio"}),
)
_register(
    "G28_deep_counts", lambda spark, sf: reports.deep_counts(analysed(spark, sf)),
    ANALYSED + f"""SELECT count(*) AS events, {', '.join(f"count_if(classification = '{k}') AS {k}" for k in (
        'likely_true_counter_reset', 'possible_counter_reset', 'minor_counter_decrease', 'counter_behavior_uncertain'))},
  count_if(status_changed) AS oper_status_change, count_if(uptime_decreased) AS uptime_decrease, CAST({reports.EXPECTED_EVENTS} AS BIGINT) AS expected,
  count(*) = {reports.EXPECTED_EVENTS} AS as_expected FROM analysed""",
)

# --- other counters ---------------------------------------------------------------------------------

CROSSED = with_(*FALLS, *CROSS)


def cross_totals(spark, sf):
    return reports.cross_metric_totals(falls(spark, sf), staging.materialise(transformed(spark, sf), "records"))


_register(
    "G9d_metric_totals", cross_totals,
    CROSSED + f"""SELECT metric, count(DISTINCT (f.itemid, f.clock)) FILTER (f.clock IS NOT NULL) AS events,
  CASE WHEN (SELECT count(*) FROM falls) > 0 THEN round(count(DISTINCT (f.itemid, f.clock)) FILTER (f.clock IS NOT NULL) / (SELECT count(*) FROM falls) * 100, 2) ELSE 0.0 END AS share_pct
FROM (VALUES {', '.join(f"('{m}')" for m in clusters.OTHER_COUNTERS)}) m(metric) LEFT JOIN (SELECT f.itemid, f.clock, o.canonical_metric
  FROM falls f JOIN other_falls o ON o.hostid = f.hostid AND o.ifindex = f.ifindex AND abs(o.clock - f.clock) <= 60) f ON f.canonical_metric = metric GROUP BY 1""",
)
_register(
    "G9d_verdict", lambda spark, sf: reports.cross_metric_verdict(crossed(spark, sf)),
    CROSSED + """SELECT *, CASE WHEN discard_counter_only = events THEN 'discard_counter_behavior' WHEN multiple_counter_decrease > 0 THEN 'multiple_counter_reset_behavior'
  WHEN possible_interface_event > 0 THEN 'possible_interface_event' ELSE 'uncertain' END AS verdict,
  CASE WHEN discard_counter_only = events OR multiple_counter_decrease > 0 THEN 'high' WHEN possible_interface_event > 0 THEN 'medium' ELSE 'low' END AS confidence
FROM (SELECT count(*) AS events, count_if(classification = 'discard_counter_only') AS discard_counter_only, count_if(classification = 'multiple_counter_decrease') AS multiple_counter_decrease,
  count_if(classification = 'possible_interface_event') AS possible_interface_event, CAST(0 AS BIGINT) AS uncertain, count(DISTINCT concat(hostid, '|', ifindex)) AS interfaces
  FROM cross_classes JOIN falls USING (itemid, clock))""",
)
_register(
    "G9d_top_hosts", lambda spark, sf: reports.leading(reports.totals(falls(spark, sf), {"host": reports.host_name()})),
    with_(*FALLS) + """SELECT 'host' AS dimension, host_name AS name, count(*) AS events, row_number() OVER (ORDER BY count(*) DESC, host_name) AS "rank"
FROM falls GROUP BY 2 QUALIFY "rank" <= 20""",
)

# --- readiness --------------------------------------------------------------------------------------


def faulty(spark, sf):
    """Raw records without an id, of unknown items, without a clock or a value, and items of which some are listed twice."""
    kind, items = F.col("ordinal") % 60, bindings.items(spark, sf)
    raw = bindings.history(spark, sf).select(
        F.when(kind == 1, " ").when(kind == 2, F.concat(F.lit("x"), "itemid")).otherwise(F.col("itemid")).alias("itemid"),
        F.when(~kind.isin(3, 5), F.col("clock")).alias("clock"), F.when(~kind.isin(4, 5), F.col("value")).alias("value"),
    )
    return raw, items.unionByName(items.filter(F.col("ifindex") % 50 == 0))


_WARNED = """warned AS (SELECT count(*) AS counter_decreases, count_if(classification = 'multiple_raw_counter_decrease') AS multiple_counters,
  count_if(classification = 'interface_status_event') AS interface_events FROM raw_classes)"""
_GATE = """SELECT *, concat_ws(',', CASE WHEN duplicate_itemids > 0 THEN 'duplicate_itemids' END, CASE WHEN missing_semantic > 0 THEN 'missing_semantic' END,
    CASE WHEN invalid_records > 0 THEN 'invalid_records' END) AS fatal,
  concat_ws(',', CASE WHEN counter_decreases > 0 THEN 'counter_decreases' END, CASE WHEN multiple_counters > 0 THEN 'multiple_counters' END,
    CASE WHEN interface_events > 0 THEN 'interface_events' END) AS warnings,
  CASE WHEN duplicate_itemids + missing_semantic + invalid_records > 0 THEN 'FAIL' ELSE 'PASS WITH WARNINGS' END AS status,
  duplicate_itemids + missing_semantic + invalid_records = 0 AS ready"""
_register(
    "G33_readiness_of_faulty_records", lambda spark, sf: reports.readiness(raw_classes(spark, sf), *faulty(spark, sf)),
    with_(*FALLS, *BRACKETS, ITEMS, _WARNED) + _GATE + """ FROM (SELECT (SELECT count(*) FROM items WHERE ifindex % 50 = 0) AS duplicate_itemids,
  (SELECT count(*) FROM history WHERE ordinal % 60 = 2) AS missing_semantic,
  (SELECT count(*) FROM history WHERE ordinal % 60 = 1 OR (ordinal % 60 = 3 AND value IS NOT NULL)) AS invalid_records), warned""",
)
_register(
    "G33_readiness", lambda spark, sf: reports.readiness(raw_classes(spark, sf), bindings.history(spark, sf), bindings.items(spark, sf)),
    with_(*FALLS, *BRACKETS, ITEMS, _WARNED) + _GATE + """ FROM (SELECT count(*) - count(DISTINCT itemid) AS duplicate_itemids,
  (SELECT count(*) FROM history WHERE itemid NOT IN (SELECT itemid FROM items)) AS missing_semantic, (SELECT count(*) FROM history WHERE clock IS NULL AND value IS NOT NULL) AS invalid_records FROM items), warned""",
)

# --- audits -----------------------------------------------------------------------------------------

_DIRECTED = with_(*TRANSFORMED, DAMAGED, DIRECTED)
_LABEL = "coalesce(host_name, host, hostid)"
_register(
    "G2_leading_names",
    lambda spark, sf: reports.leading(behaviour.reset_totals(damaged(spark, sf)).filter("dimension in ('host', 'item')"), "decreases"),
    _DIRECTED + " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{d}' AS dimension, {c} AS name, count(*) AS decreases, row_number() OVER (ORDER BY count(*) DESC, {c}) AS \"rank\" FROM faulty WHERE f GROUP BY 2 QUALIFY \"rank\" <= 20)"
        for d, c in (("host", _LABEL), ("item", f"concat_ws(' | ', {_LABEL}, 'itemid=' || itemid, canonical_metric)"))
    ),
)
_register(
    "G2_reset_details", lambda spark, sf: rounded(behaviour.reset_details(damaged(spark, sf))),
    _DIRECTED + f"""SELECT itemid, hostid, ifindex, canonical_metric, device_role, clock, ordinal, {r3('previous_raw_value', 'previous_raw_value')}, {r3('raw_value', 'raw_value')},
  {r3('previous_raw_value - raw_value', 'magnitude')}, delta_time_sec, NOT counter_reset AS unmarked,
  NOT {_close('delta_value', '(raw_value - previous_raw_value)')} AS wrong_delta, value IS NOT NULL AS has_rate FROM faulty WHERE f""",
)
_register(
    "F10_verdict", lambda spark, sf: audits.verdict(audits.issue_totals(issues(spark, sf))),
    ALL_ISSUES + "SELECT count(*) AS issues, count(*) = 0 AS passed FROM issues",
)
