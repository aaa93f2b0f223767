"""Oracle SQL of the feature store: every window recomputed from the samples by range joins."""

from __future__ import annotations

from pulseframe.vocab import DEVICE_METRICS, INTERFACE_METRICS

BUCKET = 3600
WINDOWS = (21600, 86400)


def suffix(window: int) -> str:
    return f"{window // 60}m"


def r3(expr: str, name: str) -> str:
    """Rounded, without negative zero."""
    return f"CASE WHEN round({expr}, 3) = 0 THEN 0.0 ELSE round({expr}, 3) END AS {name}"


def _stats(metrics: tuple[str, ...], window: int, role: str, key: str) -> str:
    low, high = (window, 0) if role == "r" else (2 * window, window)
    cols = []
    for m in metrics:
        f = f"FILTER (r.canonical_metric = '{m}')"
        cols += [
            f"avg(value) {f} AS {m}_mean", f"stddev_pop(value) {f} AS {m}_std",
            f"count(value) {f} AS {m}_count", f"count(r.clock) {f} > 0 AS {m}_seen",
        ]
        if role == "r":
            cols += [
                f"arg_max(value, clock) FILTER (r.canonical_metric = '{m}' AND value IS NOT NULL)"
                f" AS {m}_last",
                f"min(value) {f} AS {m}_min", f"max(value) {f} AS {m}_max",
            ]
    if role == "r":
        cols += [
            "coalesce(count_if(counter_reset AND canonical_metric LIKE '%discard%'), 0) AS resets",
            "sum(previous_raw_value - raw_value) FILTER (counter_reset AND canonical_metric"
            " LIKE '%discard%') AS reset_size",
            f"coalesce(count_if(turned AND prev_clock > g.t - {window}), 0) AS changes",
        ]
    on = " AND ".join(f"r.{k} = g.{k}" for k in key.split(", "))
    g = ", ".join(f"g.{k}" for k in key.split(", "))
    return f"""w{window}{role} AS (
  SELECT {g}, g.t, {', '.join(cols)}
  FROM grid g LEFT JOIN samples r ON {on} AND r.clock > g.t - {low} AND r.clock <= g.t - {high}
  GROUP BY ALL)"""


def ctes(metrics: tuple[str, ...], key: str, transition: str, falls: bool, ends: str) -> list[str]:
    """``samples`` (with the change against the previous sample), ``grid`` and window CTEs."""
    turned = "value < prev_value" if falls else "value <> prev_value"
    return [
        f"""ordered AS (
  SELECT *, lag(value) OVER w AS prev_value, lag(clock) OVER w AS prev_clock
  FROM records WHERE canonical_metric = '{transition}' AND value IS NOT NULL
  WINDOW w AS (PARTITION BY {key} ORDER BY clock, value)),
 samples AS (
  SELECT r.*, coalesce({turned}, false) AS turned, o.prev_clock
  FROM records r LEFT JOIN (SELECT itemid, clock, prev_value, prev_clock FROM ordered) o
    ON r.itemid = o.itemid AND r.clock = o.clock)""",
        f"""grid AS (
  SELECT {key}, unnest(range(lo // {BUCKET} * {BUCKET}, hi + 1, {BUCKET})) AS t
  FROM ({ends}))""",
        *[_stats(metrics, w, role, key) for w in WINDOWS for role in ("r", "b")],
    ]


def joined(key: str) -> str:
    on = f"({key}, t)"
    first, *rest = [f"w{w}{role}" for w in WINDOWS for role in ("r", "b")]
    return f"{first} " + " ".join(f"JOIN {t} USING {on}" for t in rest)


def metric_columns(metrics: tuple[str, ...]) -> list[str]:
    out = []
    for w in WINDOWS:
        s, r, b = suffix(w), f"w{w}r", f"w{w}b"
        for m in metrics:
            out += [
                r3(f"{r}.{m}_last", f"{m}_{s}_last"), r3(f"{r}.{m}_mean", f"{m}_{s}_mean"),
                r3(f"{r}.{m}_std", f"{m}_{s}_std"), r3(f"{r}.{m}_min", f"{m}_{s}_min"),
                r3(f"{r}.{m}_max", f"{m}_{s}_max"), f"{r}.{m}_count AS {m}_{s}_count",
                r3(f"{r}.{m}_max - {r}.{m}_min", f"{m}_{s}_range"),
                r3(f"{b}.{m}_mean", f"{m}_baseline_mean_{s}"),
                r3(f"{b}.{m}_std", f"{m}_baseline_std_{s}"),
                f"{b}.{m}_count AS {m}_baseline_count_{s}",
            ]
    return out


def coverage_columns(metrics: tuple[str, ...]) -> list[str]:
    out = []
    for w in WINDOWS:
        s = suffix(w)
        for lead, table in (("", f"w{w}r"), ("baseline_", f"w{w}b")):
            present = "(" + " + ".join(f"CAST({table}.{m}_seen AS INT)" for m in metrics) + ")"
            out += [
                f"{present} AS {lead}metric_presence_count_{s}",
                f"expected_count AS {lead}metric_expected_count_{s}",
                f"greatest(expected_count - {present}, 0) AS {lead}metric_missing_count_{s}",
                r3(f"CASE WHEN expected_count > 0 THEN {present} / expected_count END",
                   f"{lead}metric_coverage_ratio_{s}"),
            ]
    return out


def behaviour(recent: str, base: str, prefix: str) -> list[str]:
    change = f"({recent} - ({base}))"
    ok = f"abs({base}) > 1e-12"
    return [
        r3(change, f"{prefix}_change"),
        r3(f"CASE WHEN {ok} THEN {change} / abs({base}) END", f"{prefix}_change_pct"),
        r3(f"CASE WHEN {ok} THEN ({recent}) / ({base}) END", f"{prefix}_recent_to_baseline_ratio"),
        f"CAST(coalesce({change} > 0, false) AS INT) AS {prefix}_increase_flag",
        f"CAST(coalesce({change} < 0, false) AS INT) AS {prefix}_decrease_flag",
    ]


STATISTICS = ("last", "mean", "std", "min", "max", "count", "range")


def _is_statistic(column: str, window: int) -> bool:
    s = suffix(window)
    names = [f"{m}_{s}_{stat}" for m in INTERFACE_METRICS for stat in STATISTICS]
    names += [f"{m}_baseline_{stat}_{s}" for m in INTERFACE_METRICS
              for stat in ("mean", "std", "count")]
    return column in names


def _is_context(column: str) -> bool:
    return column.startswith(("counter_reset", "oper_status_change", "metric_", "baseline_metric",
                              "traffic_variability", "traffic_cv")) or column == "oper_status_last"


# The 349 interface columns are compared in four parts.
INTERFACE_PARTS = {
    "H6_H10_window_statistics_short": lambda c: _is_statistic(c, WINDOWS[0]),
    "H6_H10_window_statistics_long": lambda c: _is_statistic(c, WINDOWS[1]),
    "H11_H13_totals_and_behaviour": lambda c: not (
        _is_statistic(c, WINDOWS[0]) or _is_statistic(c, WINDOWS[1]) or _is_context(c)
    ),
    "H14_H18_context_and_coverage": _is_context,
}

TOTALS = {
    "traffic_total_bps": ("in_bps", "out_bps"),
    "packet_total_pps": ("in_pps", "out_pps"),
    "error_total_rate": ("in_error_rate", "out_error_rate"),
    "discard_total_rate": ("in_discard_rate", "out_discard_rate"),
}


def interface_columns() -> list[str]:
    out = [*metric_columns(INTERFACE_METRICS), *coverage_columns(INTERFACE_METRICS)]
    for w in WINDOWS:
        s, r, b = suffix(w), f"w{w}r", f"w{w}b"
        out += [
            f"{r}.resets AS counter_reset_count_{s}",
            f"CAST({r}.resets > 0 AS INT) AS counter_reset_flag_{s}",
            r3(f"CASE WHEN {r}.resets > 0 THEN coalesce({r}.reset_size, 0) END",
               f"counter_reset_raw_context_sum_{s}"),
            f"{r}.changes AS oper_status_change_count_{s}",
            f"CAST({r}.changes > 0 AS INT) AS oper_status_change_flag_{s}",
        ]
        for name, (x, y) in TOTALS.items():
            recent, base = f"{r}.{x}_mean + {r}.{y}_mean", f"{b}.{x}_mean + {b}.{y}_mean"
            out += [r3(recent, f"{name}_{s}"), r3(base, f"{name}_baseline_mean_{s}")]
            out += behaviour(recent, base, f"{name}_behavior_{s}")
        for unit in ("bps", "pps"):
            out.append(
                r3(f"CASE WHEN abs({r}.out_{unit}_mean) > 1e-12 THEN {r}.in_{unit}_mean / "
                   f"{r}.out_{unit}_mean END", f"in_out_{unit}_ratio_{s}")
            )
        for m in INTERFACE_METRICS[:-1]:
            out += behaviour(f"{r}.{m}_mean", f"{b}.{m}_mean", f"{m}_behavior_{s}")
    s, r = suffix(WINDOWS[0]), f"w{WINDOWS[0]}r"
    spread = f"sqrt({r}.in_bps_std * {r}.in_bps_std + {r}.out_bps_std * {r}.out_bps_std)"
    total = f"({r}.in_bps_mean + {r}.out_bps_mean)"
    out += [
        r3(spread, f"traffic_variability_{s}"),
        r3(f"CASE WHEN abs({total}) > 1e-12 THEN {spread} / {total} END", f"traffic_cv_{s}"),
        r3(f"{r}.oper_status_last", "oper_status_last"),
    ]
    return out


AGGREGATES = (
    "interface_count", "interfaces_with_oper_down", "traffic_total_bps_sum",
    "traffic_total_bps_mean", "traffic_total_bps_max", "packet_total_pps_sum",
    "packet_total_pps_mean", "packet_total_pps_max", "error_total_rate_sum", "error_total_rate_max",
    "discard_total_rate_sum", "discard_total_rate_max", "interfaces_with_counter_reset",
)


def interface_aggregates() -> str:
    """CTE ``at_point``: interface rows of a host at one grid point (raw, not rounded, values)."""
    r = f"w{WINDOWS[0]}r"
    longest = f"w{WINDOWS[-1]}r"
    alive = " OR ".join(f"{longest}.{m}_seen" for m in INTERFACE_METRICS)
    total = {n: f"({r}.{x}_mean + {r}.{y}_mean)" for n, (x, y) in TOTALS.items()}
    return f"""at_point AS (
  SELECT hostid, t, count(*) AS interface_count,
         coalesce(count_if({r}.oper_status_last <> 1), 0) AS interfaces_with_oper_down,
         sum({total['traffic_total_bps']}) AS traffic_total_bps_sum,
         avg({total['traffic_total_bps']}) AS traffic_total_bps_mean,
         max({total['traffic_total_bps']}) AS traffic_total_bps_max,
         sum({total['packet_total_pps']}) AS packet_total_pps_sum,
         avg({total['packet_total_pps']}) AS packet_total_pps_mean,
         max({total['packet_total_pps']}) AS packet_total_pps_max,
         sum({total['error_total_rate']}) AS error_total_rate_sum,
         max({total['error_total_rate']}) AS error_total_rate_max,
         sum({total['discard_total_rate']}) AS discard_total_rate_sum,
         max({total['discard_total_rate']}) AS discard_total_rate_max,
         coalesce(count_if({r}.resets > 0), 0) AS interfaces_with_counter_reset
  FROM {joined('hostid, ifindex')} WHERE {alive} GROUP BY ALL)"""


def device_columns() -> list[str]:
    out = [*metric_columns(DEVICE_METRICS), *coverage_columns(DEVICE_METRICS)]
    for w in WINDOWS:
        s, r, b = suffix(w), f"w{w}r", f"w{w}b"
        out += [
            r3(f"{r}.uptime_last - {r}.uptime_min", f"uptime_growth_sec_{s}"),
            f"CAST({r}.changes > 0 AS INT) AS uptime_reset_flag_{s}",
        ]
        for m in ("cpu_pct", "memory_pct", "temperature_c", "icmp_loss_pct", "icmp_rtt_sec"):
            out += behaviour(f"{r}.{m}_mean", f"{b}.{m}_mean", f"{m}_behavior_{s}")
    for name in AGGREGATES:
        if name.startswith("interface"):
            out.append(f"coalesce(a.{name}, 0) AS {name}")
        else:
            out.append(r3(f"a.{name}", name))
        if name.endswith("_sum"):
            out.append(f"CAST(a.{name} IS NOT NULL AS INT) AS {name}_present")
    return out
