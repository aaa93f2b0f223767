"""Queries and oracle SQL of series behaviour (D10 to D14), the reset audit (G2) and decrease behaviour (G24)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulseframe.operators import behaviour, counters
from pulseframe.plans import bindings, staging
from pulseframe.plans.audit_queries import DAMAGED, _close, damaged
from pulseframe.plans.feature_oracle import r3
from pulseframe.plans.oracles import HISTORY, ITEMS, TRANSFORMED, decreases, with_
from pulseframe.plans.queries import rounded, transformed

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _register(name: str, build, sql: str) -> None:
    QUERIES[name], SQL[name] = build, sql


STEPS = """moves AS (
  SELECT *, value - lag(value) OVER (PARTITION BY itemid ORDER BY clock, ordinal) AS d FROM history WHERE value IS NOT NULL),
 directions AS (
  SELECT itemid, count(*) AS samples, count_if(d > 0) AS rises, count_if(d < 0) AS falls, count_if(d = 0) AS unchanged,
    min(d) AS min_delta, max(d) AS max_delta, avg(d) AS mean_delta, count(DISTINCT value) AS unique_values,
    min(value) AS min, max(value) AS max, avg(value) AS mean, quantile_cont(value, 0.5) AS median FROM moves GROUP BY 1),
 classes AS (
  SELECT *, CASE WHEN samples < 2 THEN 'insufficient_data' WHEN falls = 0 AND rises > 0 THEN 'likely_counter' WHEN falls = 0 THEN 'possible_counter'
    WHEN falls * 10 < samples - 1 AND rises > 0 THEN 'likely_counter_with_resets' WHEN falls * 10 >= samples - 1 THEN 'likely_interval_or_rate'
    ELSE 'unknown' END AS classification FROM directions)"""
_DELTAS = ", ".join(f"round({c}, 6) AS {c}" for c in ("min_delta", "max_delta", "mean_delta"))
_VALUES = ", ".join(f"round({c}, 6) AS {c}" for c in ("min", "max", "mean", "median"))
_register(
    "D13_directions", lambda spark, sf: rounded(behaviour.direction_counts(bindings.history(spark, sf)), 6),
    with_(HISTORY, STEPS) + f"SELECT itemid, samples, rises, falls, unchanged, unique_values, {_DELTAS} FROM directions",
)
_register(
    "D10_behaviour", lambda spark, sf: rounded(behaviour.behaviour_classes(bindings.history(spark, sf)), 6),
    with_(HISTORY, STEPS) + f"""SELECT itemid, samples, rises, falls, unchanged, unique_values, {_DELTAS}, {_VALUES}, classification,
  CASE WHEN classification = 'likely_counter' THEN 'high' WHEN classification IN ('insufficient_data', 'unknown') THEN 'low' ELSE 'medium' END AS confidence,
  falls = 0 AND samples >= 2 AS monotonic FROM classes""",
)


def recommendations(spark, sf):
    keyed = bindings.items(spark, sf).withColumn("key", F.concat("key", F.when(F.col("ifindex") % 2 == 0, ".in[dropped").otherwise(".out[errors")))
    return behaviour.recommended(behaviour.behaviour_classes(bindings.history(spark, sf)), keyed)


_register(
    "D11_recommendation", lambda spark, sf: recommendations(spark, sf).select("itemid", "semantic_type", "transformation", "inferred_metric"),
    with_(HISTORY, ITEMS, STEPS) + """SELECT c.itemid, CASE WHEN classification LIKE '%counter%' THEN 'counter' WHEN classification = 'likely_interval_or_rate' THEN 'rate' ELSE 'unknown' END AS semantic_type,
  CASE WHEN classification LIKE '%counter%' THEN 'delta_rate' WHEN classification = 'likely_interval_or_rate' THEN 'direct' ELSE 'manual_review' END AS transformation,
  CASE WHEN classification NOT IN ('insufficient_data', 'unknown') THEN CASE WHEN key LIKE '%.in[%' THEN 'in' WHEN key LIKE '%.out[%' THEN 'out' END
    || CASE WHEN ifindex % 2 = 0 THEN '_discard_rate' ELSE '_error_rate' END END AS inferred_metric
FROM classes c LEFT JOIN (SELECT itemid, ifindex, concat(lower(key), CASE WHEN ifindex % 2 = 0 THEN '.in[dropped' ELSE '.out[errors' END) AS key FROM items) i USING (itemid)""",
)
_register(
    "D12_class_counts", lambda spark, sf: behaviour.class_counts(behaviour.behaviour_classes(bindings.history(spark, sf))),
    with_(HISTORY, STEPS) + "SELECT classification, count(*) AS items FROM classes GROUP BY 1",
)
_register(
    "D13_edge_samples", lambda spark, sf: behaviour.edge_samples(bindings.repeated_history(spark, sf)).select("itemid", "edge", "rank", "clock", "ordinal", "value"),
    " UNION ALL ".join(
        f"""SELECT * FROM (SELECT CAST(l_suppkey AS VARCHAR) AS itemid, '{edge}' AS edge, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate {way}, l_orderkey * 8 + l_linenumber {way}) AS "rank",
  CAST(floor(epoch(l_shipdate)) AS BIGINT) AS clock, l_orderkey * 8 + l_linenumber AS ordinal, l_extendedprice AS value FROM lineitem QUALIFY "rank" <= 10)"""
        for edge, way in (("first", "ASC"), ("last", "DESC"))
    ),
)
_register(
    "D14_latest", lambda spark, sf: behaviour.latest(bindings.repeated_history(spark, sf)).select("itemid", "clock", "ordinal", "value", "rank"),
    """SELECT CAST(l_suppkey AS VARCHAR) AS itemid, CAST(floor(epoch(l_shipdate)) AS BIGINT) AS clock, l_orderkey * 8 + l_linenumber AS ordinal,
  l_extendedprice AS value, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_orderkey * 8 + l_linenumber DESC) AS "rank"
FROM lineitem QUALIFY "rank" <= 100""",
)

DIRECTED = f"""directed AS (
  SELECT *, CASE WHEN previous_raw_value IS NULL THEN 'first' WHEN raw_value IS NULL THEN 'missing' WHEN raw_value > previous_raw_value THEN 'increase'
    WHEN raw_value = previous_raw_value THEN 'unchanged' ELSE 'decrease' END AS direction FROM damaged WHERE semantic_type = 'counter'),
 faulty AS (
  SELECT *, direction = 'decrease' AS f FROM directed)"""
_register(
    "G2_reset_audit", lambda spark, sf: behaviour.reset_audit(damaged(spark, sf)),
    with_(*TRANSFORMED, DAMAGED, DIRECTED) + f"""SELECT *, CASE WHEN invalid > 0 THEN 'FAIL' WHEN decrease > 0 THEN 'PASS WITH WARNINGS' ELSE 'PASS' END AS status FROM (
  SELECT count(*) AS counter_records, count_if(direction = 'first') AS first, count_if(direction = 'increase') AS increase, count_if(direction = 'unchanged') AS unchanged,
    count_if(f) AS decrease, count_if(direction = 'missing') + count_if(f AND NOT counter_reset) + count_if(f AND value IS NOT NULL)
    + count_if(f AND NOT {_close('delta_value', '(raw_value - previous_raw_value)')}) AS invalid FROM faulty)""",
)
_LABEL = "coalesce(host_name, host, hostid)"
_register(
    "G2_reset_totals", lambda spark, sf: behaviour.reset_totals(damaged(spark, sf)),
    with_(*TRANSFORMED, DAMAGED, DIRECTED) + " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, {c} AS name, count(*) AS decreases FROM faulty WHERE f GROUP BY 2" for d, c in (
            ("metric", "canonical_metric"), ("role", "device_role"), ("host", _LABEL), ("item", f"concat_ws(' | ', {_LABEL}, 'itemid=' || itemid, canonical_metric)"))),
)
_register(
    "G2_reset_magnitudes", lambda spark, sf: rounded(behaviour.reset_magnitudes(damaged(spark, sf))),
    with_(*TRANSFORMED, DAMAGED, DIRECTED) + " UNION ALL ".join(
        f"""SELECT '{m}' AS measure, count({c}) AS count, {r3(f'min({c})', 'min')}, {r3(f'max({c})', 'max')}, {r3(f'avg({c})', 'mean')},
  {', '.join(r3(f'quantile_cont({c}, {p})', n) for n, p in (('median', 0.5), ('p95', 0.95), ('p99', 0.99)))} FROM faulty WHERE f""" for m, c in (
            ("magnitude", "(previous_raw_value - raw_value)"), ("previous", "previous_raw_value"), ("current", "raw_value"), ("elapsed", "CAST(delta_time_sec AS DOUBLE)"))),
)


def decrease_behaviour(spark, sf):
    rows = staging.materialise(transformed(spark, sf).filter("transformation = 'delta_rate'"), "counter-records")
    falls = counters.detect_decreases(rows, ["itemid"], "raw_value", "keep_first")
    found = behaviour.decrease_behaviour(falls, rows)
    return found.select(
        "itemid", "clock", "ratio", "low", "post_rises", "post_falls", "post_samples", "post_monotonic", "classification",
        F.size("before").alias("before_samples"), F.element_at("before", F.when(F.size("before") > 0, F.size("before")).otherwise(1)).alias("first_before"),
    )


JUDGED = """after AS (
  SELECT f.itemid, f.clock, h.raw_value AS v, row_number() OVER (PARTITION BY f.itemid, f.clock ORDER BY h.clock, h.ordinal) AS k
  FROM falls f JOIN counted h ON h.itemid = f.itemid AND h.clock > f.clock QUALIFY k <= 10),
 post AS (
  SELECT itemid, clock, count(*) AS n, count_if(d > 0) AS up, count_if(d < 0) AS down
  FROM (SELECT *, v - lag(v) OVER (PARTITION BY itemid, clock ORDER BY k) AS d FROM after) GROUP BY 1, 2),
 prior AS (
  SELECT itemid, clock, count(*) AS n, arg_max(v, k) AS v FROM (
    SELECT f.itemid, f.clock, h.raw_value AS v, row_number() OVER (PARTITION BY f.itemid, f.clock ORDER BY h.clock DESC, h.ordinal DESC) AS k
    FROM falls f JOIN counted h ON h.itemid = f.itemid AND h.clock < f.clock QUALIFY k <= 10) GROUP BY 1, 2),
 judged AS (
  SELECT f.itemid, f.clock, CASE WHEN previous_raw_value > 0 THEN decrease / previous_raw_value END AS ratio,
    raw_value <= 20 OR (previous_raw_value > 0 AND raw_value <= previous_raw_value * 0.1) AS low, coalesce(up, 0) AS post_rises,
    coalesce(down, 0) AS post_falls, coalesce(post.n, 0) AS post_samples, coalesce(prior.n, 0) AS before_samples, prior.v AS first_before
  FROM falls f LEFT JOIN post USING (itemid, clock) LEFT JOIN prior USING (itemid, clock))"""
BEHAVIOUR = """CASE WHEN low AND post_samples >= 5 AND post_rises >= 4 AND post_falls = 0 AND (ratio IS NULL OR ratio >= 0.5) THEN 'likely_true_counter_reset'
    WHEN ratio < 0.5 THEN 'minor_counter_decrease' WHEN low AND post_samples >= 5 AND post_rises > 0 THEN 'possible_counter_reset'
    ELSE 'counter_behavior_uncertain' END AS classification"""
_register(
    "G24_decrease_behaviour", lambda spark, sf: rounded(decrease_behaviour(spark, sf)),
    with_(*TRANSFORMED, "counted AS (SELECT * FROM transformed WHERE transformation = 'delta_rate')", decreases("counted", "itemid", "keep_first"), JUDGED) + f"""
SELECT itemid, clock, {r3('ratio', 'ratio')}, low, post_rises, post_falls, post_samples, before_samples, {r3('first_before', 'first_before')},
  post_samples >= 5 AND post_rises >= 4 AND post_falls = 0 AS post_monotonic,
  {BEHAVIOUR} FROM judged""",
)
