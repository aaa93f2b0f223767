"""What is recorded around an event: values of related metrics as lists, and transitions wholly inside its window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.functions.scalars import finite, floor_bucket
from pulseframe.operators.correlate import HOST, INTERFACE
from pulseframe.operators.timeline import count_inside, near, with_neighbours

# Reach of the window and the metrics that are related to a counter decrease.
WINDOW_SEC = 300
RELATED = (
    "in_bps", "out_bps", "in_pps", "out_pps", "in_error_rate", "out_error_rate", "in_discard_rate", "out_discard_rate", "oper_status",
    "icmp_loss_pct", "icmp_rtt_sec", "uptime",
)
#: Samples in one list; a window that holds more gets several lists, numbered in order.
LIST_SIZE = 1000


def related_values(
    events: DataFrame, records: DataFrame, key: Sequence[str], window: int = WINDOW_SEC, metrics: Sequence[str] = RELATED, list_size: int = LIST_SIZE
) -> DataFrame:
    """(key, clock, canonical_metric, slice, part, samples): for each event clock the samples within ``window``, by metric.

    Samples are packed once into sorted lists of at most ``list_size``, per key, metric and slice of time. An event meets the lists
    of the at most two slices that its window touches; lists that lie inside go on as they are, the others are cut.
    So no list and no row grows with a busy host, and (slice, part) put the lists of an event in order.
    """
    width = 2 * window + 1
    rows = records.filter(F.col("canonical_metric").isin(*metrics)).na.drop(subset=[*key, "clock"]).select(
        *key, "canonical_metric", floor_bucket(F.col("clock"), width).alias("slice"), "clock", "ordinal", finite(F.col("value")).alias("value"),
        finite(F.col("raw_value")).alias("raw_value"),
    )
    place = F.row_number().over(Window.partitionBy(*key, "canonical_metric", "slice").orderBy("clock", "ordinal"))
    sample = F.struct("clock", "ordinal", "value", "raw_value")
    lists = rows.withColumn("part", F.floor((place - 1) / list_size)).groupBy(*key, "canonical_metric", "slice", "part").agg(
        F.array_sort(F.collect_list(sample)).alias("samples"), F.min("clock").alias("low"), F.max("clock").alias("high")
    )
    clock = F.col("clock")
    marks = events.na.drop(subset=[*key, "clock"]).select(*key, "clock").distinct()
    marks = marks.withColumn("slice", F.explode(F.array_distinct(F.array(floor_bucket(clock - window, width), floor_bucket(clock + window, width)))))
    low, high = clock - window, clock + window
    met = marks.join(lists, [*key, "slice"]).filter((F.col("high") >= low) & (F.col("low") <= high))
    inside = (F.col("low") >= low) & (F.col("high") <= high)
    cut = F.when(inside, F.col("samples")).otherwise(F.filter("samples", lambda s: (s["clock"] >= low) & (s["clock"] <= high)))
    return met.select(*key, "clock", "canonical_metric", "slice", "part", cut.alias("samples")).filter(F.size("samples") > 0)


def _points(records: DataFrame, key: Sequence[str], metric: str, value: Column) -> DataFrame:
    """Least and greatest value of a metric per clock, and how many different ones there are."""
    rows = records.filter(F.col("canonical_metric") == metric).withColumn("v", value).na.drop(subset=[*key, "clock", "v"])
    return rows.groupBy(*key, "clock").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count_distinct("v").alias("values"))


def _inside(events: DataFrame, points: DataFrame, key: list[str], window: int, across: Column, within: Column, name: str) -> DataFrame:
    """Moves between successive samples that both lie in the window; samples of one clock are ordered by value."""
    chained = with_neighbours(points, key, ["clock", "high"])
    since, n = F.col("previous.clock"), F.coalesce(across, F.lit(False)).cast("bigint")
    moves = chained.select(
        *key,
        F.inline(F.array(
            F.struct(since.alias("since"), "clock", n.alias(name)),
            F.struct(F.col("clock").alias("since"), "clock", within.cast("bigint").alias(name)),
        )),
    )
    return count_inside(events.na.drop(subset=[*key, "clock"]), moves, key, window, window, name)


def transitions(events: DataFrame, records: DataFrame, window: int = WINDOW_SEC) -> DataFrame:
    """Every event with its status changes and uptime decreases among the samples of its window."""
    status = _points(records, INTERFACE, "oper_status", finite(F.col("value")))
    # an uptime without a value is read from the raw one
    uptime = _points(records, HOST, "uptime", F.coalesce(finite(F.col("value")), finite(F.col("raw_value"))))
    changed, fell = F.col("low") != F.col("previous.high"), F.col("low") < F.col("previous.high")
    flips = _inside(events, status, INTERFACE, window, changed, F.col("values") - 1, "status_changes")
    falls = _inside(events, uptime, HOST, window, fell, F.lit(0), "uptime_decreases")
    found = events.join(flips, [*INTERFACE, "clock"], "left").join(falls, [*HOST, "clock"], "left").fillna(0, subset=["status_changes", "uptime_decreases"])
    return found.withColumns({"status_changed": F.col("status_changes") > 0, "uptime_decreased": F.col("uptime_decreases") > 0})


def status_change_list(events: DataFrame, records: DataFrame, window: int = WINDOW_SEC) -> DataFrame:
    """(hostid, ifindex, clock, from_clock, to_clock, from_value, to_value): the changes that ``transitions`` counts.

    A status has few values, so the sorted different ones of a clock are one short array.
    """
    rows = records.filter(F.col("canonical_metric") == "oper_status").withColumn("v", finite(F.col("value"))).na.drop(subset=[*INTERFACE, "clock", "v"])
    points = rows.groupBy(*INTERFACE, "clock").agg(F.array_sort(F.collect_set("v")).alias("values")).withColumn("high", F.element_at("values", -1))

    def move(since: Column, clock: Column, was: Column, now: Column) -> Column:
        return F.struct(since.alias("from_clock"), clock.alias("to_clock"), was.alias("from_value"), now.alias("to_value"))

    chained = with_neighbours(points, INTERFACE, ["clock", "high"])
    clock, before, first = F.col("clock"), F.col("previous"), F.element_at("values", 1)
    across = F.when(before.isNotNull() & (before["high"] != first), move(before["clock"], clock, before["high"], first))
    within = F.transform(F.sequence(F.lit(2), F.size("values")), lambda k: move(clock, clock, F.element_at("values", k - 1), F.element_at("values", k)))
    none = F.array().cast("array<struct<from_clock:bigint,to_clock:bigint,from_value:double,to_value:double>>")
    several = F.when(F.size("values") >= 2, within).otherwise(none)
    moves = chained.select(*INTERFACE, "clock", F.concat(F.array_compact(F.array(across)), several).alias("moves")).filter(F.size("moves") > 0)

    def measures(frame) -> list[Column]:
        around = F.flatten(F.collect_list("moves").over(frame(-window, window)))
        return [F.filter(around, lambda m: m["from_clock"] >= clock - window).alias("inside")]

    found = near(events.na.drop(subset=[*INTERFACE, "clock"]), moves, INTERFACE, window, window, measures)
    return found.select(*INTERFACE, "clock", F.inline("inside"))
