"""Evidence near counter decreases: status changes, restarts, lost reachability and traffic around each event.

Events and samples lie on one time line per host or interface (``timeline.near``), so counts and distances come from
window frames and no pair of an event and a sample is formed.  ``records`` hold one row per item and clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.operators.timeline import attach_clock_context, near, per_clock, with_neighbours
from pulseframe.vocab import INTERFACE_METRICS

# Reach of the search, limits of an anomaly, metrics that show traffic.
WINDOW_SEC = 300
LOSS_PCT, RTT_SEC = 1.0, 0.2
ACTIVITY_METRICS = tuple(m for m in INTERFACE_METRICS if m != "oper_status")

HOST, INTERFACE = ["hostid"], ["hostid", "ifindex"]


def _of(records: DataFrame, *metrics: str) -> DataFrame:
    return records.filter(F.col("canonical_metric").isin(*metrics) & F.col("value").isNotNull())


def per_clock_counts(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key, "clock").agg(F.count(F.lit(1)).alias("n"))


def status_transitions(records: DataFrame) -> DataFrame:
    """Clocks at which an interface's status differs from the one before; the last record of a clock counts."""
    points = per_clock(_of(records, "oper_status").na.drop(subset=INTERFACE), INTERFACE, "value")
    chained = with_neighbours(points, INTERFACE, ["clock", "last_value"])
    changed = chained.filter(F.col("last_value") != F.col("previous.last_value"))
    return changed.select(*INTERFACE, "clock", F.lit(1).cast("bigint").alias("n"))


def uptime_falls(records: DataFrame) -> DataFrame:
    """Both ends of every fall of a host's uptime: ``n`` falls end at a clock, one that starts there lasts ``until``."""
    context = F.col("context")
    rows = attach_clock_context(_of(records, "uptime").na.drop(subset=HOST), HOST, "value")
    same_clock = F.lag("value").over(Window.partitionBy("hostid", "clock").orderBy("ordinal"))
    leads = F.col("ordinal") == context["first_ordinal"]
    chained = rows.select(
        "hostid", "clock", "value",
        F.when(leads, context["previous"]["last_value"]).otherwise(same_clock).alias("was"),
        F.when(leads, context["previous"]["clock"]).otherwise(F.col("clock")).alias("since"),
    )
    falls = chained.filter(F.col("value") < F.col("was"))
    none = F.lit(None).cast("bigint")
    ends = falls.select("hostid", "clock", F.lit(1).cast("bigint").alias("n"), none.alias("until"))
    starts = falls.filter("since < clock").select(
        "hostid", F.col("since").alias("clock"), F.lit(0).cast("bigint").alias("n"), F.col("clock").alias("until")
    )
    return ends.unionAll(starts).groupBy("hostid", "clock").agg(F.sum("n").alias("n"), F.max("until").alias("until"))


def reachability_anomalies(records: DataFrame) -> DataFrame:
    value, metric = F.col("value"), F.col("canonical_metric")
    bad = ((metric == "icmp_loss_pct") & (value > LOSS_PCT)) | ((metric == "icmp_rtt_sec") & (value > RTT_SEC))
    return per_clock_counts(_of(records, "icmp_loss_pct", "icmp_rtt_sec").filter(bad), HOST)


def interface_activity(records: DataFrame) -> DataFrame:
    return per_clock_counts(_of(records, *ACTIVITY_METRICS), INTERFACE)


def attach(events: DataFrame, points: DataFrame, key: list[str], name: str, window: int) -> DataFrame:
    """Add ``name`` (samples within the window) and ``name_distance`` (seconds to the nearest one)."""
    clock, sampled = F.col("clock"), F.when(F.col("n").isNotNull(), F.col("clock"))

    def measures(frame) -> list[Column]:
        around = frame(-window, window)
        total = F.coalesce(F.sum("n").over(around), F.lit(0))
        if "until" in points.columns:  # the one fall that starts inside and ends beyond the window
            total = total + F.coalesce(F.max("until").over(around) > clock + window, F.lit(False)).cast("bigint")
        nearest = F.least(
            clock - F.max(sampled).over(frame(-window, 0)), F.min(sampled).over(frame(0, window)) - clock
        )
        return [total.alias(name), nearest.alias(f"{name}_distance")]

    found = near(events, points, key, window, window, measures)
    return events.join(found, [*key, "clock"], "left").withColumn(name, F.coalesce(name, F.lit(0)))


#: Where each signal comes from and what it shares with the event.
SIGNALS = {
    "status_changes": (status_transitions, INTERFACE), "uptime_falls": (uptime_falls, HOST),
    "icmp_anomalies": (reachability_anomalies, HOST), "activity": (interface_activity, INTERFACE),
}


def with_signal(events: DataFrame, records: DataFrame, signal: str, window: int = WINDOW_SEC) -> DataFrame:
    source, key = SIGNALS[signal]
    return attach(events, source(records), key, signal, window)


def correlate(events: DataFrame, records: DataFrame, window: int = WINDOW_SEC) -> DataFrame:
    """Every event with its four signals, the likely cause and the confidence in it.

    An event without an interface index has no interface signals; no event is dropped.
    """
    found = events
    for signal in SIGNALS:
        found = with_signal(found, records, signal, window)
    cause, confidence = F.lit("counter_reset_without_correlated_event"), F.lit("low")
    for signal, label, trust in reversed(EVIDENCE):
        cause = F.when(F.col(signal) > 0, label).otherwise(cause)
        confidence = F.when(F.col(signal) > 0, trust).otherwise(confidence)
    return found.withColumns({"classification": cause, "confidence": confidence})


# Signals from the strongest to the weakest, with the cause each one names.
EVIDENCE = (
    ("uptime_falls", "likely_device_reboot", "high"),
    ("status_changes", "likely_interface_flap", "high"),
    ("icmp_anomalies", "possible_network_disruption", "medium"),
    ("activity", "possible_interface_counter_reset", "medium"),
)
DIMENSIONS = ("classification", "confidence", "canonical_metric", "device_role", "hostid", "ifindex")


def totals(correlated: DataFrame) -> DataFrame:
    """Events per value of each dimension, in one pass."""
    pairs = F.array(
        *[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in DIMENSIONS]
    )
    return (
        correlated.select(F.explode(pairs).alias("p")).groupBy("p.dimension", "p.value")
        .agg(F.count(F.lit(1)).alias("events"))
    )


def signal_counts(correlated: DataFrame) -> DataFrame:
    """How many events show each signal, and how many lack an identity."""
    return correlated.agg(
        F.count(F.lit(1)).alias("events"),
        *[F.count_if(F.col(signal) > 0).alias(signal) for signal, _, _ in EVIDENCE],
        F.count_if(F.coalesce("hostid", F.lit("")) == "").alias("missing_hostid"),
        F.count_if(F.col("ifindex").isNull()).alias("missing_ifindex"),
    )
