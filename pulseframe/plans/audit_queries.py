"""Queries and oracle SQL of the data tests (F) and of the shared tools of decrease analyses (G3, G4, G34).

The audited table is the transform's output with some rows damaged by their ordinal, so that every issue type fires.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.operators import audits, counters, quantiles
from pulseframe.plans import bindings, staging
from pulseframe.plans.feature_oracle import r3
from pulseframe.plans.oracles import DUPS, HISTORY, ITEMS, TRANSFORMED, decreases, with_
from pulseframe.plans.queries import rounded, transformed
from pulseframe.vocab import CLOSE_TOLERANCE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

SPREAD = 60
#: Ordinals of copied rows start here, beyond every ordinal of the given tables.
COPIES_FROM = 1_000_000_000_000


def query(name: str, sql: str):
    SQL[name] = sql

    def register(fn):
        QUERIES[name] = fn
        return fn

    return register


def damaged(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("ordinal") % SPREAD
    other = F.when(F.col("transformation") == "direct", "delta_rate").otherwise("direct")
    rows = transformed(spark, sf)
    copies = rows.filter(kind == 15).withColumn("ordinal", F.col("ordinal") + COPIES_FROM * SPREAD)
    value, clock = F.col("value"), F.col("clock")
    return rows.unionByName(copies).withColumns(
        {
            "transformation": F.when(kind == 1, other).otherwise(F.col("transformation")),
            "clock": F.when(kind == 14, clock - clock % 86400).when(kind != 2, clock),
            "value": F.when(kind == 4, value + 1).when(kind == 6, 1.0).when(kind == 10, float("inf"))
            .when(kind == 11, -1.0).when(kind != 3, value),
            "counter_reset": (kind == 5) != F.col("counter_reset"),
            "delta_value": F.when(kind == 7, 5.0).otherwise(F.col("delta_value")),
            "delta_time_sec": F.when(kind == 8, F.col("delta_time_sec") + 1).otherwise(F.col("delta_time_sec")),
            "raw_value": F.when((kind == 16) & (F.col("semantic_type") == "counter"), F.col("previous_raw_value"))
            .when(kind != 9, F.col("raw_value")),
        }
    )


def damaged_raw(spark: SparkSession, sf: str) -> DataFrame:
    kind, rows = F.col("ordinal") % SPREAD, bindings.history(spark, sf)
    copies = rows.filter(kind == 12).withColumn("ordinal", F.col("ordinal") + COPIES_FROM * SPREAD)
    return rows.filter(kind != 13).unionByName(copies)


_FAR = COPIES_FROM * SPREAD
_KIND = f"ordinal % {SPREAD}"
DAMAGED = f"""doubled AS (
  SELECT * FROM transformed UNION ALL
  SELECT * REPLACE (ordinal + {_FAR} AS ordinal) FROM transformed WHERE {_KIND} = 15),
 damaged AS (
  SELECT * REPLACE (
    CASE WHEN {_KIND} = 1 THEN CASE transformation WHEN 'direct' THEN 'delta_rate' ELSE 'direct' END
         ELSE transformation END AS transformation,
    CASE {_KIND} WHEN 14 THEN clock - clock % 86400 WHEN 2 THEN NULL ELSE clock END AS clock,
    CASE {_KIND} WHEN 4 THEN value + 1 WHEN 6 THEN 1.0 WHEN 10 THEN CAST('Infinity' AS DOUBLE)
         WHEN 11 THEN -1.0 WHEN 3 THEN NULL ELSE value END AS value,
    ({_KIND} = 5) <> counter_reset AS counter_reset,
    CASE WHEN {_KIND} = 7 THEN 5.0 ELSE delta_value END AS delta_value,
    CASE WHEN {_KIND} = 8 THEN delta_time_sec + 1 ELSE delta_time_sec END AS delta_time_sec,
    CASE WHEN {_KIND} = 16 AND semantic_type = 'counter' THEN previous_raw_value
         WHEN {_KIND} = 9 THEN NULL ELSE raw_value END AS raw_value)
  FROM doubled),
 raw AS (
  SELECT * FROM history WHERE {_KIND} <> 13 UNION ALL
  SELECT * REPLACE (ordinal + {_FAR} AS ordinal) FROM history WHERE {_KIND} = 12)"""


def _close(a: str, b: str) -> str:
    allowed = f"greatest({CLOSE_TOLERANCE} * greatest(abs({a}), abs({b})), {CLOSE_TOLERANCE})"
    return f"coalesce(abs({a} - ({b})) <= {allowed} AND abs({a} - ({b})) < CAST('Infinity' AS DOUBLE), false)"


def _same(a: str, b: str) -> str:
    return f"({_close(a, b)} OR {a} IS NOT DISTINCT FROM {b})"


def _found(source: str, checks: dict[str, str]) -> str:
    return "\n  UNION ALL ".join(
        f"SELECT itemid, clock, ordinal, '{issue}' AS issue FROM {source} WHERE {condition}"
        for issue, condition in checks.items()
    )


_FINITE = "abs(value) < CAST('Infinity' AS DOUBLE)"
ORDERED = """ordered AS (
  SELECT *, lag(clock) OVER (PARTITION BY itemid ORDER BY ordinal) AS before
  FROM damaged WHERE clock IS NOT NULL)"""
RECOMPUTED = """counters AS (
  SELECT * REPLACE (CASE WHEN abs(raw_value) < CAST('Infinity' AS DOUBLE) THEN raw_value END AS raw_value)
  FROM damaged WHERE semantic_type = 'counter' AND clock IS NOT NULL),
 clocks AS (
  SELECT itemid, clock, min(ordinal) AS first_ordinal, arg_max_null(raw_value, ordinal) AS last_value
  FROM counters GROUP BY 1, 2),
 chain AS (
  SELECT *, lag(last_value) OVER w AS was, lag(clock) OVER w AS was_clock
  FROM clocks WINDOW w AS (PARTITION BY itemid ORDER BY clock)),
 placed AS (
  SELECT c.*, was, was_clock, c.ordinal <> first_ordinal AS repeated,
         was_clock IS NULL AND c.ordinal = first_ordinal AS starts
  FROM counters c JOIN chain USING (itemid, clock)),
 compared AS (
  SELECT *, raw_value < was AS falls, raw_value > was AS rises, raw_value = was AS same
  FROM placed WHERE NOT repeated AND NOT starts AND raw_value IS NOT NULL AND was IS NOT NULL)"""
F3 = _found("damaged", {
    "wrong_transformation": "transformation <> CASE semantic_type WHEN 'counter' THEN 'delta_rate' ELSE 'direct' END",
})
F4 = _found("ordered", {"duplicate_timestamp": "clock = before", "out_of_order": "clock < before"}) + (
    "\n  UNION ALL " + _found("damaged", {"invalid_clock": "clock IS NULL"})
)
F5 = _found("placed", {
    "first_counter_sample_has_value": "starts AND value IS NOT NULL",
    "first_counter_sample_has_delta": "starts AND delta_value IS NOT NULL",
    "invalid_delta_time": "repeated",
    "non_numeric_counter_raw_value": "NOT repeated AND NOT starts AND raw_value IS NULL",
}) + "\n  UNION ALL " + _found("compared", {
    "decrease_without_reset_flag": "falls AND NOT counter_reset",
    "reset_has_rate_value": "falls AND value IS NOT NULL",
    "reset_has_delta_value": "falls AND delta_value IS NOT NULL",
    "delta_value_mismatch": f"rises AND NOT {_close('delta_value', 'raw_value - was')}",
    "delta_time_mismatch": "rises AND delta_time_sec IS DISTINCT FROM clock - was_clock",
    "rate_formula_mismatch": "rises AND delta_value IS NOT NULL AND delta_time_sec > 0 AND NOT "
    + _close("value", "delta_value / delta_time_sec"),
    "increase_marked_as_reset": "rises AND counter_reset",
    "increase_missing_rate": "rises AND value IS NULL",
    "unchanged_delta_mismatch": f"same AND NOT {_close('delta_value', '0.0')}",
    "unchanged_rate_mismatch": f"same AND {_FINITE} AND NOT {_close('value', '0.0')}",
    "unchanged_marked_as_reset": "same AND counter_reset",
    "negative_rate": f"{_FINITE} AND value < 0",
})
F6 = _found("damaged", {
    "direct_value_mismatch": f"transformation = 'direct' AND raw_value IS NOT NULL AND NOT {_same('value', 'raw_value')}",
})
F7 = _found("damaged", {"non_finite_value": f"value IS NOT NULL AND NOT {_FINITE}"})
LOOKED_UP = """candidates AS (
  SELECT itemid, clock, count(*) AS candidates, arg_min_null(value, ordinal) AS first_raw FROM raw GROUP BY 1, 2),
 looked_up AS (
  SELECT d.*, candidates, first_raw FROM damaged d LEFT JOIN candidates USING (itemid, clock)
  WHERE clock IS NOT NULL)"""
F8 = _found("looked_up", {
    "missing_raw_record": "candidates IS NULL",
    "multiple_raw_records": "candidates > 1",
    "raw_value_mismatch": f"candidates IS NOT NULL AND NOT {_same('raw_value', 'first_raw')}",
})
_BASE = (*TRANSFORMED, DAMAGED)
_SEVERITY = "CASE issue " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in audits.SEVERITIES.items()) + " END"
ALL_ISSUES = with_(*_BASE, ORDERED, RECOMPUTED, LOOKED_UP, "issues AS (" + "\n  UNION ALL ".join((F3, F4, F5, F6, F7, F8)) + ")")


@query("F1_count_match", with_(*_BASE) + """
SELECT *, raw_records = transformed_records AS matches
FROM (SELECT (SELECT count(*) FROM raw) AS raw_records, (SELECT count(*) FROM damaged) AS transformed_records)""")
def _(spark, sf):
    return audits.count_mismatch(damaged_raw(spark, sf), damaged(spark, sf))


@query("F2_required_fields", """
SELECT event_id, CASE event_id % 3 WHEN 1 THEN 'itemid' ELSE 'clock,itemid' END AS missing FROM events
WHERE event_id % 3 < 2 AND props IS NOT NULL""")
def _(spark, sf):
    full = F.concat(F.lit('{"clock": null, "itemid": "'), "event_id", F.lit('", '), F.expr("substr(props, 2)"))
    part = F.concat(F.lit('{"clock": 1, '), F.expr("substr(props, 2)"))
    kind = F.col("event_id") % 3
    lines = bindings.table(spark, sf, "events").filter(F.col("props").isNotNull()).select(
        "event_id", F.when(kind == 0, F.col("props")).when(kind == 1, part).otherwise(full).alias("value")
    )
    found = audits.missing_fields(lines, "value", ("clock", "itemid", "k"))
    return found.select("event_id", F.concat_ws(",", "missing").alias("missing"))


@query("F3_transformation_issues", with_(*_BASE) + F3)
def _(spark, sf):
    return audits.transformation_issues(damaged(spark, sf))


@query("F4_order_issues", with_(*_BASE, ORDERED) + F4)
def _(spark, sf):
    return audits.order_issues(damaged(spark, sf))


@query("F5_recomputation_issues", with_(*_BASE, RECOMPUTED) + F5)
def _(spark, sf):
    return audits.recomputation_issues(damaged(spark, sf), require_null_delta=True)


@query("F6_direct_value_issues", with_(*_BASE) + F6)
def _(spark, sf):
    return audits.direct_value_issues(damaged(spark, sf))


@query("F7_non_finite_issues", with_(*_BASE) + F7)
def _(spark, sf):
    return audits.non_finite_issues(damaged(spark, sf))


@query("F8_preservation_issues", with_(*_BASE, LOOKED_UP) + F8)
def _(spark, sf):
    return audits.preservation_issues(damaged_raw(spark, sf), damaged(spark, sf))


def issues(spark, sf):
    """The issue log; the audited rows are written once, as every check reads them."""
    rows = staging.materialise(damaged(spark, sf), "damaged")
    return audits.all_issues(damaged_raw(spark, sf), rows, require_null_delta=True)


@query("F10_issue_totals", ALL_ISSUES + f"SELECT issue, {_SEVERITY} AS severity, count(*) AS issues FROM issues GROUP BY 1")
def _(spark, sf):
    return audits.issue_totals(issues(spark, sf))


@query("F10_issue_details", ALL_ISSUES + f"""
SELECT *, {_SEVERITY} AS severity, row_number() OVER (PARTITION BY issue ORDER BY ordinal, itemid, clock) AS "rank"
FROM issues""")
def _(spark, sf):
    # ranks and the totals they start from read one written log
    return audits.issue_details(staging.materialise(issues(spark, sf), "issues"))


@query("F9_type_counts", with_(*_BASE) + " UNION ALL ".join(
    f"SELECT '{c}' AS dimension, {c} AS value, count(*) AS records FROM damaged GROUP BY 2"
    for c in ("semantic_type", "transformation", "canonical_metric")
))
def _(spark, sf):
    return audits.type_counts(damaged(spark, sf))


@query("F9_value_distribution", with_(*_BASE) + f"""
SELECT canonical_metric, count(value) AS count, {r3('min(value)', 'min')}, {r3('max(value)', 'max')},
       {r3('avg(value)', 'mean')}, {r3('quantile_cont(value, 0.5)', 'median')}
FROM damaged WHERE {_FINITE} GROUP BY 1""")
def _(spark, sf):
    return rounded(audits.value_distribution(damaged(spark, sf)))


DEDUPLICATED = """deduplicated AS (
  SELECT itemid, clock, arg_min(value, ordinal) AS value, min(ordinal) AS ordinal, count(*) AS duplicate_count,
         count(DISTINCT value) > 1 AS duplicate_conflict FROM dups GROUP BY 1, 2)"""


@query("G3_first_per_clock", with_(DUPS, DEDUPLICATED) + "SELECT * FROM deduplicated")
def _(spark, sf):
    return audits.first_per_clock(bindings.repeated_history(spark, sf)).select(
        "itemid", "clock", "value", "ordinal", "duplicate_count", "duplicate_conflict"
    )


@query("G3_duplicate_totals", with_(DUPS, DEDUPLICATED) + """
SELECT count_if(duplicate_count > 1) AS duplicate_groups, CAST(sum(duplicate_count - 1) AS BIGINT) AS duplicate_records,
       count_if(duplicate_conflict) AS duplicate_conflicts FROM deduplicated""")
def _(spark, sf):
    return audits.duplicate_totals(audits.first_per_clock(bindings.repeated_history(spark, sf)))


@query("G4_decrease_percentiles", with_(
    DUPS.replace("AS value", "AS raw_value"), decreases("dups", "itemid", "take_last")
) + f"""
SELECT itemid, count(*) AS count, round(min(decrease), 6) AS min, round(max(decrease), 6) AS max,
       round(avg(decrease), 6) AS mean,
       {', '.join(f'round(quantile_cont(decrease, {p}), 6) AS {n}' for n, p in quantiles.REPORT_POINTS.items())}
FROM falls GROUP BY 1""")
def _(spark, sf):
    falls = counters.detect_decreases(bindings.repeated_history(spark, sf), ["itemid"], "value", "take_last")
    return rounded(quantiles.distribution(falls, ["itemid"], "decrease"), 6)


@query("G34_enrich_history", with_(HISTORY, ITEMS) + """
SELECT h.itemid, h.clock, h.ordinal, i.canonical_metric, i.key, i.ifindex, i.itemid IS NULL AS missing_metadata
FROM history h LEFT JOIN (SELECT * FROM items WHERE status = '0') i USING (itemid)""")
def _(spark, sf):
    known = bindings.items(spark, sf).filter("status = '0'")  # the others are the unknown items of this test
    return audits.enrich_history(bindings.history(spark, sf), known).select(
        "itemid", "clock", "ordinal", "canonical_metric", "key", "ifindex", "missing_metadata"
    )
