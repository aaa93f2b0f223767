"""Oracle SQL: the same results stated independently for an ordinary SQL engine on the given tables."""

from __future__ import annotations

import re

from pulseframe.operators import mldata
from pulseframe.plans import feature_oracle
from pulseframe.plans.bindings import CATALOG_KEYS

# --- bindings -------------------------------------------------------------------------------------

HISTORY = """history AS (
  SELECT concat(user_id, '-', event_type) AS itemid,
         CAST(user_id % 10 AS VARCHAR) AS hostid,
         concat('host-', user_id % 10) AS host,
         concat('Host ', user_id % 10) AS host_name,
         CASE WHEN user_id % 10 < 5 THEN 'switch' ELSE 'router' END AS device_role,
         user_id AS ifindex,
         CAST(floor(epoch(ts)) AS BIGINT) AS clock,
         event_id AS ordinal,
         CASE event_type WHEN 'click' THEN 'in_bps' WHEN 'view' THEN 'out_bps'
              WHEN 'purchase' THEN 'in_discard_rate' WHEN 'error' THEN 'out_discard_rate'
              ELSE 'oper_status' END AS canonical_metric,
         CASE event_type WHEN 'signup' THEN 'state' ELSE 'counter' END AS semantic_type,
         CASE event_type WHEN 'signup' THEN 'direct' ELSE 'delta_rate' END AS transformation,
         CASE event_type WHEN 'signup' THEN 1.0 + event_id % 2 ELSE value END AS value
  FROM events)"""

DUPS = """dups AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS itemid, CAST(l_suppkey % 10 AS VARCHAR) AS hostid,
         l_suppkey AS ifindex,
         CAST(floor(epoch(l_shipdate)) AS BIGINT) AS clock,
         l_orderkey * 8 + l_linenumber AS ordinal, 'in_bps' AS canonical_metric,
         'counter' AS semantic_type, 'delta_rate' AS transformation, l_extendedprice AS value
  FROM lineitem)"""

ORDERED = "(PARTITION BY itemid ORDER BY clock, ordinal)"


def transform(source: str) -> str:
    """CTEs ``transformed`` over ``source``; first row per clock is the baseline."""
    return f"""ranked AS (
  SELECT *, row_number() OVER (PARTITION BY itemid, clock ORDER BY ordinal) AS rn,
         first_value(value) OVER (PARTITION BY itemid, clock ORDER BY ordinal) AS clock_first
  FROM {source}),
 heads AS (
  SELECT itemid, clock, lag(value) OVER (PARTITION BY itemid ORDER BY clock) AS prev_value,
         lag(clock) OVER (PARTITION BY itemid ORDER BY clock) AS prev_clock
  FROM ranked WHERE rn = 1),
 transformed AS (
  SELECT r.* EXCLUDE (value, rn, clock_first),
         CASE WHEN semantic_type <> 'counter' THEN value
              WHEN rn = 1 AND value >= prev_value THEN (value - prev_value) / (r.clock - prev_clock)
         END AS value,
         value AS raw_value,
         CASE WHEN semantic_type <> 'counter' THEN NULL WHEN rn > 1 THEN clock_first
              ELSE prev_value END AS previous_raw_value,
         CASE WHEN semantic_type = 'counter' AND rn = 1 THEN r.clock - prev_clock END
           AS delta_time_sec,
         CASE WHEN semantic_type = 'counter' AND rn = 1 THEN value - prev_value END AS delta_value,
         semantic_type = 'counter' AND rn = 1 AND coalesce(value < prev_value, false)
           AS counter_reset,
         semantic_type = 'counter' AND rn > 1 AS duplicate_timestamp,
         false AS out_of_order,
         CASE WHEN semantic_type <> 'counter' THEN 'direct' WHEN rn > 1 THEN 'duplicate_timestamp'
              WHEN prev_clock IS NULL THEN 'counter_first_sample'
              WHEN value < prev_value THEN 'counter_reset' ELSE 'delta_rate' END
           AS transformation_applied
  FROM ranked r LEFT JOIN heads h ON r.itemid = h.itemid AND r.clock = h.clock)"""


def decreases(source: str, key: str, policy: str, name: str = "falls", extra: str = "") -> str:
    """CTE ``name``: falls between consecutive clocks of a series under a duplicate policy."""
    carried = "first_v" if policy == "keep_first" else "last_v"
    return f"""{name}_clocks AS (
  SELECT {key}, clock, arg_min(raw_value, ordinal) AS first_v, arg_max(raw_value, ordinal) AS last_v
         {extra}
  FROM {source} WHERE raw_value IS NOT NULL GROUP BY {key}, clock),
 {name}_chain AS (
  SELECT *, lag({carried}) OVER w AS former, lag(clock) OVER w AS former_clock
  FROM {name}_clocks WINDOW w AS (PARTITION BY {key} ORDER BY clock)),
 {name} AS (
  SELECT * EXCLUDE (first_v, last_v, former, former_clock), former_clock AS previous_clock,
         former AS previous_raw_value, first_v AS raw_value, former - first_v AS decrease,
         first_v - former AS delta,
         CASE WHEN former <> 0 THEN (former - first_v) / abs(former) END AS decrease_ratio
  FROM {name}_chain WHERE first_v < former)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n ".join(ctes) + "\n"


TRANSFORMED = (HISTORY, transform("history"))

SQL: dict[str, str] = {}

# --- counter transform ----------------------------------------------------------------------------

TRANSFORM_COLUMNS = (
    "itemid, clock, ordinal, value, raw_value, previous_raw_value, delta_time_sec, delta_value, "
    "counter_reset, duplicate_timestamp, out_of_order, transformation_applied"
)

SQL["E1_admission"] = with_(HISTORY) + """
SELECT count(*) AS total_records, count(value) AS numeric_records,
       count(*) - count(value) AS skipped_records FROM history"""
SQL["E2_E9_transform_history"] = with_(*TRANSFORMED) + (
    f"SELECT {TRANSFORM_COLUMNS} FROM transformed"
)
SQL["E2_E9_transform_duplicates"] = with_(DUPS, transform("dups")) + (
    f"SELECT {TRANSFORM_COLUMNS} FROM transformed"
)
OUTCOME_ROWS = ", ".join(
    f"('{o}')"
    for o in ("direct", "counter_first_sample", "delta_rate", "counter_reset",
              "duplicate_timestamp", "out_of_order", "invalid_delta_time")
)
SQL["E10_transform_outcomes"] = with_(*TRANSFORMED) + f"""
SELECT o.transformation_applied, count(t.itemid) AS records
FROM (VALUES {OUTCOME_ROWS}) AS o(transformation_applied)
LEFT JOIN transformed t USING (transformation_applied) GROUP BY 1"""
SQL["E10_decreases_by_metric"] = with_(*TRANSFORMED) + """
SELECT canonical_metric, count(*) AS decreases FROM transformed WHERE counter_reset GROUP BY 1"""

G1_COLUMNS = ("clock, previous_clock, previous_raw_value, raw_value, decrease, delta, "
              "decrease_ratio")
SQL["G1_decreases_take_last"] = with_(
    DUPS.replace("AS value", "AS raw_value"), decreases("dups", "itemid", "take_last")
) + f"SELECT itemid, {G1_COLUMNS} FROM falls"
SQL["G1_decreases_keep_first"] = with_(
    DUPS.replace("AS value", "AS raw_value"), decreases("dups", "itemid", "keep_first")
) + f"SELECT itemid, {G1_COLUMNS} FROM falls"
SQL["G1_decreases_interface_key"] = with_(
    HISTORY.replace("AS value", "AS raw_value"),
    "discards AS (SELECT * FROM history WHERE canonical_metric LIKE '%discard%')",
    decreases("discards", "hostid, ifindex, canonical_metric", "take_last"),
) + f"SELECT hostid, ifindex, canonical_metric, {G1_COLUMNS} FROM falls"

# --- inventory, scope, semantics ------------------------------------------------------------------


def case_of(subject: str, values: list[str]) -> str:
    return "CASE " + subject + "".join(
        f" WHEN {i} THEN {v}" for i, v in enumerate(values)
    ) + " END"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _catalog() -> str:
    keys = [
        quoted(head) if tail is None else f"concat({quoted(head)}, p_partkey, {quoted(tail)})"
        for head, tail, _ in CATALOG_KEYS
    ]
    slot = f"p_partkey % {len(CATALOG_KEYS)}"
    return f"""catalog AS (
  SELECT p_partkey AS ordinal, CAST(p_partkey AS VARCHAR) AS itemid,
         CAST(p_partkey % 100 AS VARCHAR) AS hostid, concat('host-', p_partkey % 100) AS host,
         p_name AS metric_name, {case_of(slot, keys)} AS key,
         CASE WHEN p_size = 50 THEN NULL
              ELSE {case_of(slot, [quoted(u) for _, _, u in CATALOG_KEYS])} END AS units,
         CASE WHEN p_partkey % 5 = 4 THEN '4' WHEN p_partkey % 5 = 3 THEN '3' ELSE '0' END
           AS value_type,
         '60s' AS delay, CAST(p_partkey % 4 AS VARCHAR) AS interfaceid,
         '1700000000' AS last_clock,
         CASE WHEN p_size % 10 = 0 THEN '1' ELSE '0' END AS status,
         CASE WHEN p_size % 7 = 0 THEN '1' ELSE '0' END AS state,
         CASE WHEN p_size % 9 = 0 THEN 'timeout' ELSE '' END AS error,
         concat('1.3.6.1.2.1.', p_partkey) AS snmp_oid,
         CASE WHEN p_size % 3 = 0 THEN CAST(p_partkey AS VARCHAR) END AS master_itemid,
         p_size, p_retailprice
  FROM part)"""


CATALOG = _catalog()

HOSTS = """hosts AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS hostid,
         CASE WHEN s_suppkey % 9 = 8 THEN '' ELSE s_name END AS host,
         concat('Device ', s_name) AS name,
         CASE s_suppkey % 6 WHEN 0 THEN 'ICX 7150' WHEN 1 THEN 'Mikrotik CCR'
              WHEN 2 THEN 'FortiGate 60F' WHEN 3 THEN 'AP-RU 11' WHEN 4 THEN 'Linux server' END
           AS model,
         n_name AS vendor, r_name AS os, concat('Template ', r_name) AS t_host,
         CASE WHEN s_suppkey % 11 = 0 THEN 'Router OS by SNMP' ELSE 'Generic' END AS t_name,
         s_acctbal
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

SCOPE = """allow_list AS (
  SELECT CASE s_suppkey % 4 WHEN 0 THEN 'switch' WHEN 1 THEN 'router' ELSE 'firewall' END AS role,
         CASE WHEN s_suppkey % 10 = 1 THEN concat('missing-', s_suppkey)
              ELSE CAST(s_suppkey AS VARCHAR) END AS hostid
  FROM supplier WHERE s_suppkey % 4 < 3)"""

ITEMS = """items AS (
  SELECT DISTINCT concat(user_id, '-', event_type) AS itemid,
         CAST(user_id % 10 AS VARCHAR) AS hostid, user_id AS ifindex,
         concat(CASE event_type WHEN 'click' THEN 'net.if.in[ifHCInOctets.'
              WHEN 'view' THEN 'net.if.out[ifHCOutOctets.'
              WHEN 'purchase' THEN 'net.if.in.discards[ifInDiscards.'
              WHEN 'error' THEN 'net.if.out.discards[ifOutDiscards.'
              ELSE 'net.if.status[ifOperStatus.' END, user_id, ']') AS key,
         CASE WHEN user_id % 2 = 0 THEN 'bps' ELSE '' END AS units,
         CASE WHEN user_id % 7 = 0 THEN '1' ELSE '0' END AS status,
         CASE WHEN user_id % 3 = 0 THEN '3' WHEN user_id % 11 = 0 THEN '4' ELSE '0' END
           AS value_type,
         CASE event_type WHEN 'click' THEN 'in_bps' WHEN 'view' THEN 'out_bps'
              WHEN 'purchase' THEN 'in_discard_rate' WHEN 'error' THEN 'out_discard_rate'
              ELSE 'oper_status' END AS canonical_metric
  FROM events)"""

CATEGORY_ROWS = {
    "interface_traffic": "inbound traffic|outbound traffic|bits received|bits sent|ifhcinoctets"
    "|ifhcoutoctets|net.if.in|net.if.out",
    "packets": "packets",
    "errors": "error",
    "discards": "discard",
    "cpu": "cpu|processor utilization",
    "memory": "memory|mem.",
    "temperature": "temp",
    "fan": "fan",
    "power": "power|psu",
    "uptime": "uptime",
    "availability": "availability|icmp|ping",
    "latency": "latency|response time|rtt",
    "snmp": "snmp",
}
_TEXT = "lower(concat_ws(' ', coalesce(metric_name, ''), coalesce(key, ''), coalesce(snmp_oid, '')))"
_PAIRS = ", ".join(
    "CASE WHEN "
    + " OR ".join(f"contains({_TEXT}, {quoted(k)})" for k in words.split("|"))
    + f" THEN '{category}' END"
    for category, words in CATEGORY_ROWS.items()
)
TAGGED = f"""tagged AS (
  SELECT itemid, list_filter([{_PAIRS}], lambda x: x IS NOT NULL) AS found FROM catalog),
 labelled AS (
  SELECT itemid, unnest(CASE WHEN len(found) = 0 THEN ['other'] ELSE found END) AS category
  FROM tagged)"""
SQL["P1_categories"] = with_(CATALOG, TAGGED) + """
SELECT itemid, CASE WHEN len(found) = 0 THEN 'other' ELSE array_to_string(found, ',') END
       AS categories FROM tagged"""
SQL["P2_category_counts"] = with_(CATALOG, TAGGED) + """
SELECT category, count(*) AS metrics FROM labelled GROUP BY 1"""
SQL["P2_inventory_summary"] = with_(CATALOG, HOSTS) + """
SELECT (SELECT count(*) FROM hosts) AS host_count, (SELECT count(*) FROM catalog) AS metric_count"""

SELECTED = r"""selected AS (
  SELECT c.*, CASE
    WHEN regexp_matches(key, '^(net\.if\.(in|out)(\[|\.pass\.v[46]\.pps\[|\.errors\[|\.discards\[)|net\.if\.status\[|icmppingloss$|icmppingsec$)', 'i')
      THEN 'P1'
    WHEN regexp_matches(key, '^(system\.cpu\.util|vm\.memory\.util|sensor\.temp\.value|sensor\.fan\.status|sensor\.psu\.status|system\.net\.uptime)', 'i')
      THEN 'P2' END AS priority
  FROM catalog c WHERE status = '0')"""
SQL["P3_priority"] = with_(CATALOG, SELECTED) + """
SELECT itemid, priority FROM selected WHERE priority IS NOT NULL"""
INVENTORY_ITEMS = """inventory_items AS (
  SELECT c.* EXCLUDE (host), h.host, h.name FROM catalog c JOIN hosts h USING (hostid))"""
SQL["P4_selected_metrics"] = with_(
    CATALOG, HOSTS, INVENTORY_ITEMS, TAGGED, SELECTED.replace("catalog", "inventory_items")
) + """
SELECT CAST(p_retailprice AS DOUBLE) AS last_value,
       CASE WHEN len(found) = 0 THEN 'other' ELSE array_to_string(found, ',') END AS categories,
       priority, hostid, CASE WHEN host = '' THEN name ELSE host END AS host, itemid, metric_name,
       key, units, value_type, delay, interfaceid, last_clock, status, state
FROM selected JOIN tagged USING (itemid) WHERE priority IS NOT NULL"""
SQL["P4_priority_counts"] = with_(CATALOG, SELECTED) + """
SELECT priority, count(*) AS metrics FROM selected WHERE priority IS NOT NULL GROUP BY 1"""
SQL["P5_numeric_type_counts"] = with_(ITEMS) + """
SELECT value_type, count(*) AS metrics FROM items WHERE value_type IN ('0', '3') GROUP BY 1"""
SQL["P6_temperature_units"] = with_(CATALOG) + """
SELECT itemid, hostid, key, units FROM catalog WHERE lower(trim(units)) = '!°c'"""
WATCH = "watch AS (SELECT DISTINCT CAST(l_partkey * 2 AS VARCHAR) AS itemid FROM lineitem)"
SQL["P7_watched_items"] = with_(CATALOG, WATCH) + """
SELECT itemid, hostid, key FROM catalog WHERE itemid IN (SELECT itemid FROM watch)"""
SQL["P7_watch_counts"] = with_(CATALOG, WATCH) + """
SELECT (SELECT count(*) FROM catalog WHERE itemid IN (SELECT itemid FROM watch)) AS found,
       (SELECT count(*) FROM watch) AS expected"""

HOST_TEXT = """texts AS (
  SELECT *, concat(host, ' ', name, ' ', '', ' ', coalesce(model, ''), ' ', vendor, ' ', os, ' ',
                   t_host, ' ', t_name) AS host_text FROM hosts)"""
SQL["C1_host_text"] = with_(HOSTS, HOST_TEXT) + "SELECT hostid, host_text FROM texts"
ROLES = r"""roles AS (
  SELECT hostid, host, name, list_filter([
    CASE WHEN regexp_matches(host_text, '\b(ICX|Sardina|Mikrotik|Exxadata|Nexus|OpenStck|OpenStack|Core[-_]?SW|CES[-_]?SW|ISP[-_]?SW|X460G2)\b|\bSW[-_]', 'i') THEN 'switch' END,
    CASE WHEN regexp_matches(host_text, '\b(Mikrotik|Router)\b|\bRTR[-_]', 'i') THEN 'router' END,
    CASE WHEN regexp_matches(host_text, '\b(pfsense|Fortigate|Fortinet|Firewall)\b', 'i') THEN 'firewall' END,
    CASE WHEN regexp_matches(host_text, '\bAP[-_].*\b(VDX|ICX)\b|\bAP[-_]?RU\b|\bRuijie\b', 'i') THEN 'access_point' END
  ], lambda x: x IS NOT NULL) AS roles FROM texts),
 rule_scope AS (
  SELECT unnest(CASE WHEN len(roles) = 0 THEN [NULL] ELSE roles END) AS role, hostid, host, name
  FROM roles)"""
SQL["C2_host_roles"] = with_(HOSTS, HOST_TEXT, ROLES) + """
SELECT hostid, array_to_string(roles, ',') AS roles FROM roles"""
SQL["C3_rule_scope"] = with_(HOSTS, HOST_TEXT, ROLES) + """
SELECT role, hostid, host, name, CASE WHEN role IS NULL THEN 'exclude' ELSE 'include' END AS decision
FROM rule_scope"""
LISTED = """listed AS (
  SELECT a.role, coalesce(a.hostid, h.hostid) AS hostid, h.host, h.name,
         CASE WHEN a.hostid IS NULL THEN 'exclude' WHEN h.hostid IS NULL
              THEN 'missing_from_inventory' ELSE 'include' END AS decision
  FROM allow_list a FULL JOIN hosts h ON a.hostid = h.hostid)"""
SQL["C4_listed_scope"] = with_(HOSTS, SCOPE, LISTED) + "SELECT * FROM listed"
SQL["C4_scope_counts"] = with_(HOSTS, SCOPE, LISTED) + """
SELECT decision, role, count(*) AS hosts FROM listed GROUP BY 1, 2"""
SQL["C5_hosts_with_several_roles"] = with_(HOSTS, HOST_TEXT, ROLES) + """
SELECT hostid, count(DISTINCT role) AS role_count FROM rule_scope WHERE role IS NOT NULL
GROUP BY 1 HAVING count(DISTINCT role) > 1"""
SQL["C6_repeated_items"] = with_(HISTORY) + """
SELECT itemid, count(*) AS occurrences FROM history GROUP BY 1 HAVING count(*) > 1"""
METRICS = """metrics AS (
  SELECT * REPLACE (CASE WHEN p_size = 1 THEN '' WHEN p_size = 2 THEN concat('x', itemid)
                         ELSE itemid END AS itemid) FROM catalog)"""
ROUTED = """routed AS (
  SELECT m.itemid, m.key, i.hostid, i.host, i.name AS host_name, a.role AS device_role,
         CASE WHEN m.itemid = '' THEN 'missing_itemid' WHEN i.itemid IS NULL
              THEN 'item_not_in_inventory' WHEN a.role IS NULL THEN 'excluded'
              ELSE 'included' END AS route
  FROM metrics m LEFT JOIN inventory_items i ON m.itemid = i.itemid
  LEFT JOIN allow_list a ON i.hostid = a.hostid)"""
ROUTING = (CATALOG, HOSTS, SCOPE, INVENTORY_ITEMS, METRICS, ROUTED)
SQL["C7_route_metrics"] = with_(*ROUTING) + "SELECT * FROM routed"
SQL["C8_scope_summary"] = with_(*ROUTING) + """
SELECT count(*) AS input_metrics, count_if(route = 'included') AS scoped_metrics,
       count_if(route = 'excluded') AS excluded_metrics,
       count_if(route IN ('missing_itemid', 'item_not_in_inventory')) AS unresolved_metrics,
       round(count_if(route = 'excluded') / count(*) * 100, 2) AS excluded_percentage,
       count(DISTINCT CASE WHEN route = 'included' THEN hostid END) AS scoped_hosts,
       count(DISTINCT CASE WHEN route = 'excluded' THEN hostid END) AS excluded_hosts,
       count_if(route = 'missing_itemid') AS metrics_without_itemid,
       count_if(route = 'item_not_in_inventory') AS items_not_in_inventory
FROM routed"""
SQL["C8_role_counts"] = with_(*ROUTING) + """
SELECT device_role, count(*) AS metrics FROM routed WHERE route = 'included' GROUP BY 1"""
SQL["C9_excluded_hosts"] = with_(*ROUTING) + """
SELECT r.hostid, h.host, h.name, count(*) AS metric_count FROM routed r JOIN hosts h
ON r.hostid = h.hostid WHERE route = 'excluded' GROUP BY 1, 2, 3"""

SQL["D1_keep_last"] = with_(HISTORY) + """
SELECT itemid, arg_max(value, ordinal) AS value, arg_max(clock, ordinal) AS clock,
       min(ordinal) AS position FROM history GROUP BY 1"""
SQL["D2_units"] = with_(CATALOG) + """
SELECT itemid, units, CASE WHEN lower(trim(units)) = '!°c' THEN '°C' ELSE coalesce(trim(units), '')
       END AS normalized_units FROM catalog"""

# (condition, type, transformation, canonical, unit, confidence, exclusion)
_D3 = (
    ("status <> '0'", "unknown", "direct", None, None, "low", "disabled"),
    ("k('^sensor\\.temp\\.value\\[') AND (state <> '0' OR error <> '')",
     "unknown", "direct", None, None, "high", "unsupported_temperature_sensor"),
    ("k('^sensor\\.temp\\.value\\[')", "gauge", "direct", "temperature_c", "°C", "high", None),
    ("k('^net\\.if\\.in\\.pass\\.v[46]\\.pps')", "rate", "direct", "in_pps", "pps", "high", None),
    ("k('^net\\.if\\.out\\.pass\\.v[46]\\.pps')", "rate", "direct", "out_pps", "pps", "high", None),
    ("k('^net\\.if\\.status\\[')", "state", "direct", "oper_status", "", "high", None),
    ("k('ifInErrors')", "counter", "delta_rate", "in_error_rate", None, "high", None),
    ("k('ifOutErrors')", "counter", "delta_rate", "out_error_rate", None, "high", None),
    ("k('ifInDiscards')", "counter", "delta_rate", "in_discard_rate", None, "high", None),
    ("k('ifOutDiscards')", "counter", "delta_rate", "out_discard_rate", None, "high", None),
    ("k('^net\\.if\\.in\\[.*,dropped\\]$')", "counter", "delta_rate", "in_discard_rate", None,
     "medium", None),
    ("k('^net\\.if\\.out\\[.*,dropped\\]$')", "counter", "delta_rate", "out_discard_rate", None,
     "medium", None),
    ("k('^net\\.if\\.in\\[.*,errors\\]$')", "counter", "delta_rate", "in_error_rate", None,
     "medium", None),
    ("k('^net\\.if\\.out\\[.*,errors\\]$')", "counter", "delta_rate", "out_error_rate", None,
     "medium", None),
    ("k('^net\\.if\\.in\\[') AND units = 'bps'", "rate", "direct", "in_bps", None, "high", None),
    ("k('ifHCInOctets')", "counter", "delta_rate", "in_bps", None, "high", None),
    ("k('^net\\.if\\.in\\[')", "counter", "delta_rate", "in_bps", None, "medium", None),
    ("k('^net\\.if\\.out\\[') AND units = 'bps'", "rate", "direct", "out_bps", None, "high", None),
    ("k('ifHCOutOctets')", "counter", "delta_rate", "out_bps", None, "high", None),
    ("k('^net\\.if\\.out\\[')", "counter", "delta_rate", "out_bps", None, "medium", None),
    ("k('^system\\.cpu\\.util')", "gauge", "direct", "cpu_pct", "%", "high", None),
    ("k('^vm\\.memory') AND units = '%'", "gauge", "direct", "memory_pct", "%", "high", None),
    ("k('^sensor\\.fan')", "state", "direct", "fan_status", None, "high", None),
    ("k('^sensor\\.psu')", "state", "direct", "psu_status", None, "high", None),
    ("k('^system\\.net\\.uptime')", "gauge", "direct", "uptime", None, "high", None),
    ("k('^icmppingloss$')", "gauge", "direct", "icmp_loss_pct", "%", "high", None),
    ("k('^icmppingsec$')", "gauge", "direct", "icmp_rtt_sec", "s", "high", None),
    ("k('rate|throughput|bandwidth') AND units <> ''", "rate", "direct", "rate", None, "medium",
     None),
    ("units = '%'", "gauge", "direct", "percentage", "%", "medium", None),
    ("true", "unknown", "direct", None, None, "low", None),
)


def _semantic() -> str:
    def condition(text: str) -> str:
        return re.sub(r"k\(('[^']*')\)", r"regexp_matches(key, \1, 'i')", text)

    def column(position: int, default: str = "NULL") -> str:
        return "CASE rule " + " ".join(
            f"WHEN {i} THEN {default if r[position] is None else quoted(r[position])}"
            for i, r in enumerate(_D3)
        ) + " END"

    own = "CASE WHEN lower(trim(units)) = '!°c' THEN '°C' ELSE coalesce(trim(units), '') END"
    rule = "CASE " + " ".join(f"WHEN {condition(r[0])} THEN {i}" for i, r in enumerate(_D3)) + " END"
    return f"""matched AS (SELECT *, {rule} AS rule FROM catalog),
 semantic AS (
  SELECT * EXCLUDE (rule), {column(1)} AS semantic_type, {column(2)} AS transformation,
         {column(3)} AS canonical_metric, {column(4, own)} AS normalized_units,
         {column(5)} AS confidence, {column(6)} IS NOT NULL AS excluded,
         {column(6)} AS exclude_reason
  FROM matched)"""


SEMANTIC = (CATALOG, _semantic())
SQL["D3_classify"] = with_(*SEMANTIC) + """
SELECT itemid, semantic_type, transformation, canonical_metric, normalized_units, confidence,
       excluded, exclude_reason FROM semantic"""
SQL["D4_enrich"] = with_(CATALOG) + """
SELECT itemid, CASE WHEN p_size % 2 = 0 THEN '10' ELSE '' END AS preprocessing_types,
       coalesce(master_itemid, '0') AS master_itemid, interfaceid FROM catalog"""


def _counts(columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS dimension, {expr} AS value, count(*) AS metrics FROM semantic "
        f"WHERE {expr} IS NOT NULL GROUP BY 2"
        for name, expr in columns.items()
    )


_DIMENSIONS = ("semantic_type", "transformation", "confidence", "canonical_metric")
SQL["D5_semantic_summary"] = with_(*SEMANTIC) + _counts(
    {**{d: d for d in _DIMENSIONS}, "exclude_reason": "exclude_reason"}
)
# The audited table: the classifier's output with some rows damaged on purpose.
DAMAGED = """damaged AS (
  SELECT * REPLACE (
    CASE WHEN p_size = 11 THEN 'state' ELSE semantic_type END AS semantic_type,
    CASE WHEN p_size = 12 THEN 'delta_rate' ELSE transformation END AS transformation,
    CASE WHEN p_size = 13 THEN NULL ELSE confidence END AS confidence,
    CASE WHEN p_size = 20 THEN NULL ELSE exclude_reason END AS exclude_reason)
  FROM semantic)"""
ISSUES = """expected AS (SELECT * FROM (VALUES
  ('in_bps', 'counter,rate'), ('out_bps', 'counter,rate'), ('in_error_rate', 'counter,rate'),
  ('out_error_rate', 'counter,rate'), ('in_discard_rate', 'counter,rate'),
  ('out_discard_rate', 'counter,rate'), ('in_pps', 'rate'), ('out_pps', 'rate'),
  ('cpu_pct', 'gauge'), ('memory_pct', 'gauge'), ('temperature_c', 'gauge'),
  ('icmp_loss_pct', 'gauge'), ('icmp_rtt_sec', 'gauge'), ('oper_status', 'state'),
  ('fan_status', 'state'), ('psu_status', 'state'), ('uptime', 'gauge'))
  AS e(canonical_metric, allowed)),
 wanted AS (SELECT * FROM (VALUES ('counter', 'delta_rate'), ('gauge', 'direct'),
  ('rate', 'direct'), ('state', 'direct')) AS w(semantic_type, wanted)),
 issues AS (
  SELECT itemid, hostid, host, key, canonical_metric, 'excluded_without_reason' AS issue,
         NULL AS expected, NULL AS actual
  FROM damaged WHERE excluded AND coalesce(exclude_reason, '') = ''
  UNION ALL SELECT itemid, hostid, host, key, canonical_metric, 'unknown_semantic', NULL, semantic_type
  FROM damaged WHERE NOT excluded AND semantic_type = 'unknown'
  UNION ALL SELECT itemid, hostid, host, key, d.canonical_metric, 'wrong_semantic_type', allowed,
                   semantic_type
  FROM damaged d JOIN expected USING (canonical_metric)
  WHERE NOT excluded AND NOT list_contains(string_split(allowed, ','), semantic_type)
  UNION ALL SELECT itemid, hostid, host, key, canonical_metric, 'wrong_transformation', wanted,
                   transformation
  FROM damaged JOIN wanted USING (semantic_type) WHERE NOT excluded AND transformation <> wanted
  UNION ALL SELECT itemid, hostid, host, key, canonical_metric, 'invalid_confidence', NULL, confidence
  FROM damaged WHERE NOT excluded AND coalesce(confidence, '') NOT IN ('high', 'medium', 'low'))"""
AUDIT = (*SEMANTIC, DAMAGED, ISSUES)
SQL["D6_D7_semantic_issues"] = with_(*AUDIT) + "SELECT * FROM issues"
SQL["D7_issue_counts"] = with_(*AUDIT) + "SELECT issue, count(*) AS issues FROM issues GROUP BY 1"
SQL["D8_duplicate_items"] = with_(DUPS) + """
SELECT itemid, count(*) AS occurrences FROM dups GROUP BY 1 HAVING count(*) > 1"""
SQL["D9_semantic_totals"] = with_(*SEMANTIC) + """
SELECT count(*) AS total_metrics, count_if(NOT excluded) AS usable_metrics,
       count_if(excluded) AS excluded_metrics,
       count_if(NOT excluded AND semantic_type = 'unknown') AS unknown_metrics FROM semantic"""
SQL["D9_usable_summary"] = with_(*SEMANTIC) + _counts(
    {
        **{d: f"(CASE WHEN NOT excluded THEN {d} END)" for d in _DIMENSIONS},
        "exclude_reason": "(CASE WHEN excluded THEN exclude_reason END)",
    }
)
SQL["P8_unknown_semantics"] = with_(*SEMANTIC) + """
SELECT itemid, hostid, host, metric_name AS name, key, units, value_type,
       CAST(ordinal % 3 AS VARCHAR) AS type, delay, '7d' AS history, '365d' AS trends,
       CAST(ordinal % 50 AS VARCHAR) AS templateid, status, state, error, last_clock, snmp_oid, interfaceid, semantic_type, transformation, canonical_metric, confidence, excluded,
       exclude_reason FROM semantic WHERE semantic_type = 'unknown'"""

# --- feature store --------------------------------------------------------------------------------

# Values are scaled so that rates are not tiny; both sides read the scaled values.
SCALED = HISTORY.replace("ELSE value END AS value", "ELSE value * 1000000 END AS value")
RECORDS = """records AS (
  SELECT t.* FROM transformed t JOIN items i ON t.itemid = i.itemid WHERE i.status = '0')"""
SQL["H1_expected_interface_metrics"] = with_(ITEMS) + """
SELECT hostid, ifindex, count(DISTINCT canonical_metric) AS expected_count FROM items
WHERE status = '0' GROUP BY 1, 2"""
SQL["H2_history_routes"] = with_(SCALED, transform("history"), ITEMS, """routed AS (
  SELECT t.value, t.counter_reset, CASE WHEN i.itemid IS NULL THEN 'missing_metadata'
         WHEN i.canonical_metric = '' THEN 'missing_canonical'
         WHEN i.canonical_metric = 'rate' THEN 'unrelated_records'
         ELSE 'accepted_records' END AS counter
  FROM transformed t LEFT JOIN (
    SELECT itemid, CASE WHEN ifindex % 13 = 0 THEN '' WHEN ifindex % 17 = 0 THEN 'rate'
           ELSE canonical_metric END AS canonical_metric FROM items WHERE status = '0') i
  ON t.itemid = i.itemid)""") + """
SELECT counter, count(*) AS records FROM routed GROUP BY 1
UNION ALL SELECT 'null_nonreset_values', count(*) FROM routed
WHERE counter = 'accepted_records' AND value IS NULL AND NOT counter_reset"""
SQL["H3_deduplicate"] = with_(DUPS, transform("dups")) + """
SELECT itemid, clock, coalesce(arg_min(value, ordinal) FILTER (value IS NOT NULL), NULL) AS value,
       coalesce(min(ordinal) FILTER (value IS NOT NULL), min(ordinal)) AS ordinal,
       count(*) > 1 AS duplicate_timestamp FROM transformed GROUP BY 1, 2"""
SQL["H3_deduplication_counts"] = with_(DUPS) + """
SELECT count_if(n > 1) AS duplicate_groups, sum(n - 1) AS duplicate_rows_removed,
       count_if(v > 1) AS conflicting_duplicate_groups
FROM (SELECT count(*) AS n, count(DISTINCT value) AS v FROM dups GROUP BY itemid, clock)"""
SQL["H4_ifindex_features"] = with_(CATALOG) + r"""
SELECT itemid, CASE
    WHEN regexp_matches(key, '(if(HC)?(In|Out)Octets|if(In|Out)(UcastPkts|Errors|Discards)|if(Oper|Admin)Status)\.\d+', 'i')
      THEN CAST(regexp_extract(key, '(?:Octets|Pkts|Errors|Discards|Status)\.(\d+)', 1) AS BIGINT)
    WHEN regexp_matches(key, '\.\d+\]$')
      THEN CAST(regexp_extract(key, '\.(\d+)\]$', 1) AS BIGINT) END AS ifindex
FROM catalog"""
SQL["H4v_ifindex_variants"] = with_(CATALOG) + r"""
SELECT itemid,
  CAST(nullif(regexp_extract(key, '\.(\d+)\]$', 1), '') AS BIGINT) AS raw_cross_metric,
  CAST(coalesce(nullif(regexp_extract(key, '\.(\d+)\]$', 1), ''),
                nullif(regexp_extract(key, '(\d+)\]$', 1), '')) AS BIGINT) AS cross_metric,
  CAST(nullif(regexp_extract(key, 'if(?:In|Out)(?:Discards|Errors|Octets)\.(\d+)', 1), '')
       AS BIGINT) AS temporal,
  CAST(nullif(regexp_extract(key, 'if(?:HCInOctets|HCOutOctets|InErrors|OutErrors|InDiscards|OutDiscards|OperStatus)\.(\d+)', 1), '')
       AS BIGINT) AS device_pattern,
  CAST(nullif(regexp_extract(key, 'if(?:HCInOctets|HCOutOctets|InErrors|OutErrors|InDiscards|OutDiscards|OperStatus)\.(\d+)', 1), '')
       AS BIGINT) AS correlation,
  CAST(nullif(regexp_extract(key, 'if(?:HCInOctets|HCOutOctets|InErrors|OutErrors|InDiscards|OutDiscards|OperStatus)\.(\d+)', 1), '')
       AS BIGINT) AS deep
FROM catalog"""
SQL["H5_series_counts"] = with_(SCALED, transform("history"), ITEMS, RECORDS) + """
SELECT hostid, ifindex, count(*) AS records, count(DISTINCT canonical_metric) AS metrics
FROM records GROUP BY 1, 2"""

INTERFACE_BASE = (
    SCALED, transform("history"), ITEMS, RECORDS,
    *feature_oracle.ctes(
        feature_oracle.INTERFACE_METRICS, "hostid, ifindex", "oper_status", False,
        "SELECT hostid, ifindex, min(clock) AS lo, max(clock) AS hi FROM records GROUP BY 1, 2",
    ),
    """expected AS (SELECT hostid, ifindex, count(DISTINCT canonical_metric) AS expected_count
  FROM items WHERE status = '0' GROUP BY 1, 2)""",
)
_LONG = f"w{feature_oracle.WINDOWS[-1]}r"


def _alive(metrics: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"{_LONG}.{m}_seen" for m in metrics) + ")"


INTERFACE_FEATURES = f"""interface_features AS (
  SELECT t AS "timestamp", hostid, ifindex, {', '.join(feature_oracle.interface_columns())}
  FROM {feature_oracle.joined('hostid, ifindex')} JOIN expected USING (hostid, ifindex)
  WHERE {_alive(feature_oracle.INTERFACE_METRICS)})"""


def _interface_part(name: str, wanted) -> None:
    columns = [c for c in feature_oracle.interface_columns() if wanted(c.rsplit(" AS ", 1)[1])]
    SQL[name] = with_(*INTERFACE_BASE) + f"""
SELECT t AS "timestamp", hostid, ifindex, {', '.join(columns)}
FROM {feature_oracle.joined('hostid, ifindex')} JOIN expected USING (hostid, ifindex)
WHERE {_alive(feature_oracle.INTERFACE_METRICS)}"""


for _name, _wanted in feature_oracle.INTERFACE_PARTS.items():
    _interface_part(_name, _wanted)
SQL["H19_interface_aggregates"] = with_(
    *INTERFACE_BASE, feature_oracle.interface_aggregates()
) + "SELECT hostid, t AS \"timestamp\", interface_count, interfaces_with_oper_down, " + ", ".join(
    feature_oracle.r3(c, c) for c in feature_oracle.AGGREGATES if not c.startswith("interface")
) + ", interfaces_with_counter_reset FROM at_point"

DEVICE_NAMES = {"in_bps": "cpu_pct", "out_bps": "memory_pct", "in_discard_rate": "icmp_loss_pct",
                "out_discard_rate": "icmp_rtt_sec", "oper_status": "uptime"}
DEVICE_RECORDS = "device_records AS (SELECT * REPLACE (CASE canonical_metric " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in DEVICE_NAMES.items()
) + """ END AS canonical_metric),
  value AS raw_value, NULL AS previous_raw_value, false AS counter_reset
  FROM history)"""


def _device() -> tuple[str, ...]:
    """Interface rows of every host, then device windows over the union of both observation sets."""
    renamed = [
        c.replace("records", "device_records").replace("ordered AS", "d_ordered AS")
        .replace("FROM ordered", "FROM d_ordered").replace("samples", "d_samples")
        .replace("grid", "d_grid")
        for c in feature_oracle.ctes(
            feature_oracle.DEVICE_METRICS, "hostid", "uptime", True,
            """SELECT hostid, min(c) AS lo, max(c) AS hi FROM (
                 SELECT hostid, clock AS c FROM records UNION ALL SELECT hostid, t FROM at_point)
               GROUP BY 1""",
        )
    ]
    for w in feature_oracle.WINDOWS:
        for role in ("r", "b"):
            renamed = [c.replace(f"w{w}{role} AS", f"d{w}{role} AS") for c in renamed]
    return tuple(renamed)


_DEVICE_SELECT = (
    f"""SELECT t AS "timestamp", hostid, {', '.join(feature_oracle.device_columns())}
  FROM {feature_oracle.joined('hostid')} LEFT JOIN at_point a USING (hostid, t)
  CROSS JOIN (SELECT 0 AS expected_count) e
  WHERE {_alive(feature_oracle.DEVICE_METRICS)} OR a.interface_count > 0"""
)
for _w in feature_oracle.WINDOWS:
    for _role in ("r", "b"):
        _DEVICE_SELECT = _DEVICE_SELECT.replace(f"w{_w}{_role}", f"d{_w}{_role}")
DEVICE_BASE = (
    *INTERFACE_BASE, feature_oracle.interface_aggregates(),
    DEVICE_RECORDS, *_device(),
)
SQL["H20_H22_device_features"] = with_(*DEVICE_BASE) + _DEVICE_SELECT
SQL["H23_host_identity"] = with_(HISTORY) + """
SELECT hostid, host, host_name, device_role FROM history GROUP BY ALL"""
_S = feature_oracle.suffix(feature_oracle.WINDOWS[0])
SQL["H25_feature_audit"] = with_(*INTERFACE_BASE, INTERFACE_FEATURES) + f"""
SELECT count(*) AS "rows", count(DISTINCT (hostid, ifindex)) AS entities,
       349 AS feature_columns,
       round(avg(metric_coverage_ratio_{_S}), 3) AS recent_coverage_mean,
       min(metric_coverage_ratio_{_S}) AS recent_coverage_min,
       max(metric_coverage_ratio_{_S}) AS recent_coverage_max,
       round(avg(baseline_metric_coverage_ratio_{_S}), 3) AS baseline_coverage_mean,
       min(baseline_metric_coverage_ratio_{_S}) AS baseline_coverage_min,
       max(baseline_metric_coverage_ratio_{_S}) AS baseline_coverage_max,
       count_if(coalesce(baseline_metric_coverage_ratio_{_S}, 0) = 0) AS warmup_rows,
       count_if(counter_reset_flag_{_S} = 1) AS rows_with_counter_reset,
       count_if(oper_status_change_flag_{_S} = 1) AS rows_with_status_change
FROM interface_features"""

# --- matrices -------------------------------------------------------------------------------------

_L = feature_oracle.suffix(feature_oracle.WINDOWS[1])


def _named(names) -> list[str]:
    return [n.replace("_15m", f"_{_L}").replace("_5m", f"_{_S}") for n in names]


def _in(names) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


GATED = f"""gated AS (
  SELECT *, [metric_coverage_ratio_{_S} IS NULL, metric_coverage_ratio_{_S} < 0.35,
             baseline_metric_coverage_ratio_{_S} IS NULL,
             baseline_metric_coverage_ratio_{_S} < 0.15,
             coalesce(baseline_metric_coverage_ratio_{_S}, 0) <= 0] AS broken
  FROM interface_features),
 eligible AS (SELECT * EXCLUDE (broken) FROM gated WHERE NOT list_contains(broken, true))"""
STORE = (*INTERFACE_BASE, INTERFACE_FEATURES, GATED)
SQL["I2_gate_counts"] = with_(*STORE) + """
SELECT reason, count(*) AS "rows" FROM (
  SELECT unnest(['missing_recent_coverage', 'recent_coverage_below_threshold',
                 'missing_baseline_coverage', 'baseline_coverage_below_threshold',
                 'no_previous_window_baseline']) AS reason, unnest(broken) AS hit FROM gated)
WHERE hit GROUP BY 1"""
_BARRED = _in([*mldata.IDENTIFIER_FIELDS, *_named(mldata.QUALITY_FIELDS)])
_CONTRACT = _in(_named(mldata.CONTRACT))
_COLUMNS = [c.rsplit(" AS ", 1)[1] for c in feature_oracle.interface_columns()]
_CASTS = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _COLUMNS)
LONG = f"""long AS (
  UNPIVOT (SELECT "timestamp", hostid, ifindex, {_CASTS} FROM eligible)
  ON COLUMNS(* EXCLUDE ("timestamp", hostid, ifindex)) INTO NAME feature VALUE value)"""
PRESENCE = f"""presence AS (
  SELECT feature, count(*) AS present, (SELECT count(*) FROM eligible) AS "rows"
  FROM long WHERE feature NOT IN {_BARRED} GROUP BY 1),
 selected AS (SELECT feature FROM presence
              WHERE feature IN {_CONTRACT} AND present / "rows" >= 0.15)"""
SQL["I3_I4_feature_presence"] = with_(*STORE, LONG, PRESENCE) + """
SELECT *, feature IN (SELECT feature FROM selected) AS selected FROM presence"""
SPLIT = """split AS (
  SELECT "timestamp", hostid, ifindex,
         CASE WHEN row_number() OVER (ORDER BY "timestamp", hostid, CAST(ifindex AS VARCHAR))
                   <= CAST(floor((SELECT count(*) FROM eligible) * 0.8) AS BIGINT)
              THEN 'train' ELSE 'inference' END AS split FROM eligible)"""
SQL["I1_I5_chronological_split"] = with_(*STORE, SPLIT) + "SELECT * FROM split"
FITTED = """cells AS (
  SELECT s."timestamp", s.hostid, s.ifindex, s.split, f.feature, l.value
  FROM split s CROSS JOIN selected f
  LEFT JOIN long l ON s."timestamp" = l."timestamp" AND s.hostid = l.hostid
       AND s.ifindex = l.ifindex AND f.feature = l.feature),
 medians AS (SELECT feature, coalesce(median(value) FILTER (split = 'train'), 0) AS median
             FROM cells GROUP BY 1),
 fitted AS (
  SELECT feature, median, avg(coalesce(value, median)) AS mean,
         stddev_pop(coalesce(value, median)) AS std
  FROM cells JOIN medians USING (feature) WHERE split = 'train' GROUP BY 1, 2)"""
SQL["I6_I7_fit_statistics"] = with_(*STORE, LONG, PRESENCE, SPLIT, FITTED) + f"""
SELECT feature, {feature_oracle.r3('mean', 'mean')}, {feature_oracle.r3('std', 'std')},
       {feature_oracle.r3('median', 'median')} FROM fitted"""
SQL["I8_matrix"] = with_(*STORE, LONG, PRESENCE, SPLIT, FITTED) + f"""
SELECT "timestamp", hostid, ifindex, split, feature,
       {feature_oracle.r3("(coalesce(value, median) - mean) / CASE WHEN std < 1e-12 THEN 1 ELSE std END", "z")}
FROM cells JOIN fitted USING (feature)"""
