"""Summaries of decrease events: totals and ranks by name, magnitudes, shares in time, verdicts, and the readiness gate.

A summary is one row, one row a name, or at most ``TOP`` rows a list; names are counted before they are ranked, and a rank's limit
is applied in every task before rows meet.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.functions.scalars import finite
from pulseframe.operators.clusters import CROSS_WINDOW_SEC, OTHER_COUNTERS, same_clock_clusters, series_decreases
from pulseframe.operators.correlate import INTERFACE
from pulseframe.operators.quantiles import distribution
from pulseframe.operators.timeline import near

# Length of a list of names, and the number of decreases that the deep audit was written for.
TOP = 20
EXPECTED_EVENTS = 231


def host_name() -> Column:
    return F.coalesce(F.when(F.col("host_name") != "", F.col("host_name")), F.col("host"))


def interface_name() -> Column:
    """``host|ifindex``; null without an interface."""
    return F.concat(F.coalesce("hostid", F.lit("")), F.lit("|"), F.col("ifindex").cast("string"))


def _pairs(events: DataFrame, names: Mapping[str, Column], of: str, what: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(k).alias(of), v.alias(what)) for k, v in names.items()])
    return events.select(F.explode(pairs).alias("p")).select(f"p.{of}", f"p.{what}")


def totals(events: DataFrame, names: Mapping[str, Column]) -> DataFrame:
    """(dimension, name, events): events by each name of each dimension; a missing name counts as one."""
    return _pairs(events, names, "dimension", "name").groupBy("dimension", "name").agg(F.count(F.lit(1)).alias("events"))


def ranked(counted: DataFrame, events: str = "events") -> DataFrame:
    place = F.row_number().over(Window.partitionBy("dimension").orderBy(F.desc(events), F.asc_nulls_last("name")))
    return counted.withColumn("rank", place)


def leading(counted: DataFrame, events: str = "events", most: int = TOP) -> DataFrame:
    """The ``most`` names of each dimension with most events and their rank, equal ones in order of name."""
    return ranked(counted, events).filter(F.col("rank") <= most)


def event_statistics(events: DataFrame, also: Mapping[str, Column] | None = None, most: int = TOP) -> DataFrame:
    """Events by metric, role and whatever else is asked for (of few names), and the leading hosts and interfaces, with their rank."""
    whole = {"metric": F.col("canonical_metric"), "role": F.col("device_role")} | dict(also or {})
    hosts = totals(events, {"host": host_name()})
    interfaces = totals(events.filter(F.col("ifindex").isNotNull()), {"interface": interface_name()})
    return ranked(totals(events, whole)).unionByName(leading(hosts, most=most)).unionByName(leading(interfaces, most=most))


def magnitudes(events: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """Count, range, mean and percentiles of each measure; a measure without any value has no row."""
    typed = {k: v.cast("double") for k, v in measures.items()}
    return distribution(_pairs(events, typed, "measure", "v"), ["measure"], "v")


def same_clock_share(events: DataFrame) -> DataFrame:
    """One row: events, those that share their clock with another, their share, and clocks with two or more interfaces."""
    interface = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in INTERFACE])
    clocks = events.filter(F.col("clock").isNotNull()).groupBy("clock").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(interface).alias("interfaces")
    )
    none = F.lit(0).cast("bigint")
    counted = clocks.agg(
        F.coalesce(F.sum("n"), none).alias("events"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), none).alias("same_clock_events"),
        F.count_if(F.col("interfaces") >= 2).alias("multi_interface_clusters"),
    )
    share = F.when(F.col("events") > 0, F.col("same_clock_events") / F.col("events") * 100).otherwise(0.0)
    return counted.withColumn("share_pct", F.round(share, 2))


def largest_clusters(events: DataFrame, most: int = TOP) -> DataFrame:
    """The clocks with most events on two or more interfaces; of equal ones the earlier comes first."""
    wide = same_clock_clusters(events).filter("interfaces >= 2").select("clock", "events", "interfaces", "hosts")
    # every task ranks its own clocks and passes on ``most`` of them
    place = F.row_number().over(Window.orderBy(F.desc("events"), "clock"))
    return wide.withColumn("rank", place).filter(F.col("rank") <= most)


def deep_counts(analysed: DataFrame, expected: int = EXPECTED_EVENTS) -> DataFrame:
    """One row: events of each behaviour, those with a status change or an uptime decrease near, and whether as many as expected came."""
    kinds = ("likely_true_counter_reset", "possible_counter_reset", "minor_counter_decrease")
    known = F.coalesce(F.col("classification").isin(*kinds), F.lit(False))
    counted = analysed.agg(
        F.count(F.lit(1)).alias("events"), *[F.count_if(F.col("classification") == k).alias(k) for k in kinds],
        F.count_if(~known).alias("counter_behavior_uncertain"), F.count_if("status_changed").alias("oper_status_change"),
        F.count_if("uptime_decreased").alias("uptime_decrease"),
    )
    return counted.withColumns({"expected": F.lit(expected).cast("bigint"), "as_expected": F.col("events") == expected})


def cross_metric_totals(events: DataFrame, records: DataFrame, window: int = CROSS_WINDOW_SEC, metrics: Sequence[str] = OTHER_COUNTERS) -> DataFrame:
    """(metric, events, share_pct): events with a decrease of each other counter of their interface near them; all metrics in one pass."""
    hits = [F.count_if(F.col("canonical_metric") == m).alias(m) for m in metrics]
    points = series_decreases(records, metrics).groupBy(*INTERFACE, "clock").agg(*hits)

    def measures(frame) -> list[Column]:
        return [F.coalesce(F.sum(m).over(frame(-window, window)), F.lit(0)).alias(m) for m in metrics]

    found = near(events.na.drop(subset=[*INTERFACE, "clock"]), points, INTERFACE, window, window, measures)
    met = events.select(*INTERFACE, "clock").join(found.select(*INTERFACE, "clock", *metrics), [*INTERFACE, "clock"], "left")
    row = met.agg(F.count(F.lit(1)).alias("all"), *[F.count_if(F.col(m) > 0).alias(m) for m in metrics])
    listed = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("events")) for m in metrics])
    share = F.when(F.col("all") > 0, F.round(F.col("p.events") / F.col("all") * 100, 2)).otherwise(0.0)
    return row.select("all", F.explode(listed).alias("p")).select("p.metric", "p.events", share.alias("share_pct"))


def cross_metric_verdict(classified: DataFrame) -> DataFrame:
    """One row: events of each class, interfaces touched, and what the whole set of decreases looks like."""
    kinds = ("discard_counter_only", "multiple_counter_decrease", "possible_interface_event", "uncertain")
    row = classified.agg(
        F.count(F.lit(1)).alias("events"), *[F.count_if(F.col("classification") == k).alias(k) for k in kinds],
        F.count_distinct(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in INTERFACE])).alias("interfaces"),
    )
    alone, several, status = F.col(kinds[0]) == F.col("events"), F.col(kinds[1]) > 0, F.col(kinds[2]) > 0
    # without events nothing contradicts the first verdict
    verdict = (
        F.when(alone, "discard_counter_behavior").when(several, "multiple_counter_reset_behavior").when(status, "possible_interface_event").otherwise("uncertain")
    )
    trust = F.when(alone | several, "high").when(status, "medium").otherwise("low")
    return row.withColumns({"verdict": verdict, "confidence": trust})


def record_faults(raw: DataFrame, items: DataFrame) -> DataFrame:
    """(fault, n): item ids given more than once, records of unknown items, and records without an id or without a clock.

    A record counts once: without an id, else of an unknown item, else without a value (no fault), else without a clock.
    """
    ids = items.select(F.trim("itemid").alias("itemid")).filter(F.col("itemid") != "").groupBy("itemid").agg(F.count(F.lit(1)).alias("copies"))
    named = raw.withColumn("itemid", F.trim(F.coalesce("itemid", F.lit(""))))
    counted = named.groupBy("itemid").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(finite(F.col("value")).isNotNull() & F.expr("try_cast(clock AS bigint)").isNull()).alias("clockless"),
    )
    blank = F.col("itemid") == ""
    known = counted.join(ids, "itemid", "left")
    faults = known.agg(
        F.coalesce(F.sum(F.when(~blank & F.col("copies").isNull(), F.col("records"))), F.lit(0)).alias("missing_semantic"),
        F.coalesce(F.sum(F.when(blank, F.col("records")).when(F.col("copies").isNotNull(), F.col("clockless"))), F.lit(0)).alias("invalid_records"),
    )
    copies = ids.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("n")).select(F.lit("duplicate_itemids").alias("fault"), "n")
    pairs = F.array(*[F.struct(F.lit(c).alias("fault"), F.col(c).alias("n")) for c in ("missing_semantic", "invalid_records")])
    return copies.unionByName(faults.select(F.explode(pairs).alias("p")).select("p.fault", "p.n"))


FATAL = ("duplicate_itemids", "missing_semantic", "invalid_records")
WARNINGS = ("counter_decreases", "multiple_counters", "interface_events")


def readiness(classified: DataFrame, raw: DataFrame, items: DataFrame) -> DataFrame:
    """One row: the counts that stop feature engineering, those that only warn, and whether it may go on."""
    kind = F.col("classification")
    warned = classified.agg(
        F.count(F.lit(1)).alias(WARNINGS[0]), F.count_if(kind == "multiple_raw_counter_decrease").alias(WARNINGS[1]),
        F.count_if(kind == "interface_status_event").alias(WARNINGS[2]),
    )
    pairs = F.array(*[F.struct(F.lit(c).alias("fault"), F.col(c).alias("n")) for c in WARNINGS])
    counts = record_faults(raw, items).unionByName(warned.select(F.explode(pairs).alias("p")).select("p.fault", "p.n"))
    row = counts.agg(*[F.coalesce(F.sum(F.when(F.col("fault") == c, F.col("n"))), F.lit(0)).alias(c) for c in (*FATAL, *WARNINGS)])

    def found(names: Sequence[str]) -> Column:
        return F.concat_ws(",", *[F.when(F.col(c) > 0, F.lit(c)) for c in names])

    ready = found(FATAL) == ""
    return row.withColumns(
        {"fatal": found(FATAL), "warnings": found(WARNINGS), "status": F.when(ready, "PASS WITH WARNINGS").otherwise("FAIL"), "ready": ready}
    )
