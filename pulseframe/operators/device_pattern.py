"""Whether a counter decrease belongs to a pattern of its whole device.

Everything near an event comes from window frames over one time line a host or interface, from intervals that begin and
end, or from running totals; no pair of an event and a record is formed. ``records`` are transformed records: ``value``,
``raw_value``, ``counter_reset`` and ``ordinal`` (file order) per item and clock.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.functions.scalars import finite, floor_bucket
from pulseframe.operators.behaviour import beyond
from pulseframe.operators.correlate import HOST, INTERFACE
from pulseframe.operators.timeline import HOUR_SEC, attach_clock_context, near, running_count, with_neighbours
from pulseframe.vocab import DISCARD_METRICS

# Reach in seconds, samples of context, interfaces that make a device, related metrics by kind.
REACH_SEC = 5
CONTEXT_SAMPLES = 5
WIDE_INTERFACES = 3
RELATED_COUNTERS = ("in_bps", "out_bps", "in_error_rate", "out_error_rate", "in_discard_rate", "out_discard_rate", "interface_counter")
RELATED_RATES = ("in_pps", "out_pps", "rate")
RELATED_STATES = ("oper_status",)
RELATED = (*RELATED_COUNTERS, *RELATED_RATES, *RELATED_STATES)

SERIES = [*INTERFACE, "canonical_metric"]


def _marks(events: DataFrame, key: Sequence[str]) -> DataFrame:
    return events.na.drop(subset=[*key, "clock"]).select(*key, "clock").distinct()


def _of_interfaces(records: DataFrame, metrics: Sequence[str]) -> DataFrame:
    return records.filter(F.col("canonical_metric").isin(*metrics)).na.drop(subset=[*INTERFACE, "clock"])


def nearest_samples(events: DataFrame, records: DataFrame, reach: int = REACH_SEC, metrics: Sequence[str] = RELATED) -> DataFrame:
    """(hostid, ifindex, clock, canonical_metric) with the sample nearest to the event, the earlier one of two at equal distance.

    The last sample up to the event and the first one after it, each within ``reach``, come from two frames; all
    metrics are found in one pass. Of several samples at a clock the first in file order counts. An event is placed on the
    line of a metric only where that metric has a sample in a slice of time that the event can reach.
    """
    sample = F.min_by(F.struct(F.col("itemid").alias("sample_itemid"), "value", "raw_value"), "ordinal")
    points = _of_interfaces(records, metrics).groupBy(*SERIES, "clock").agg(sample.alias("sample"))
    clock, width = F.col("clock"), max(HOUR_SEC, 2 * reach)
    sides = F.array_distinct(F.array(floor_bucket(clock - reach, width), floor_bucket(clock + reach, width)))
    within = points.select(*SERIES, F.explode(sides).alias("_slice")).distinct()
    wanted = _marks(events, INTERFACE).withColumn("_slice", floor_bucket(clock, width)).join(within, [*INTERFACE, "_slice"]).select(*SERIES, "clock")
    placed = F.when(F.col("sample").isNotNull(), F.struct("clock", "sample"))

    def measures(frame) -> list[Column]:
        return [F.max(placed).over(frame(-reach, 0)).alias("before"), F.min(placed).over(frame(1, reach)).alias("after")]

    found = near(wanted, points, SERIES, reach, reach, measures)
    before, after = F.col("before"), F.col("after")
    earlier = before.isNotNull() & (after.isNull() | (clock - before["clock"] <= after["clock"] - clock))
    return found.withColumn("nearest", F.when(earlier, before).otherwise(after)).filter("nearest is not null").select(
        *SERIES, "clock", F.col("nearest.clock").alias("sample_clock"), "nearest.sample.*"
    )


def context(events: DataFrame, records: DataFrame, most: int = CONTEXT_SAMPLES) -> DataFrame:
    """Numbers of the last samples before and the first after each event on its interface, whatever their metric.

    ``monotonic`` tells whether two or more numbers follow and none falls.
    """
    rows = records.withColumn("number", finite(F.col("raw_value")))
    marks = _marks(events, INTERFACE)
    for later, name in ((False, "before"), (True, "after")):
        marks = marks.join(beyond(rows, INTERFACE, "number", most, later, name), [*INTERFACE, "clock"], "left")
    none = F.array().cast("array<double>")

    def numbers(name: str) -> Column:
        return F.filter(F.coalesce(name, none), lambda x: x.isNotNull())

    found = marks.withColumns({"before": F.reverse(numbers("before")), "after": numbers("after")})
    pairs = F.arrays_zip(F.slice("after", 1, F.greatest(F.size("after") - 1, F.lit(0))).alias("a"), F.slice("after", 2, most).alias("b"))
    return found.withColumn("monotonic", (F.size("after") >= 2) & F.forall(pairs, lambda p: p["b"] >= p["a"]))


def instants(records: DataFrame) -> DataFrame:
    """One row per host and clock: records, interfaces, and records flagged as resets of discards and of others."""
    flagged = F.coalesce(F.col("counter_reset"), F.lit(False))
    discard = F.coalesce(F.col("canonical_metric").isin(*DISCARD_METRICS), F.lit(False))
    return records.na.drop(subset=[*HOST, "clock"]).groupBy(*HOST, "clock").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("ifindex").alias("interfaces"),
        F.count_if(flagged & discard).alias("discard_resets"), F.count_if(flagged & ~discard).alias("other_resets"),
    )


def host_activity(events: DataFrame, records: DataFrame, reach: int = REACH_SEC) -> DataFrame:
    """(hostid, clock): what the host recorded at the event's instant, and within ``reach`` of it."""
    points = instants(records)

    def measures(frame) -> list[Column]:
        around, now = frame(-reach, reach), frame(0, 0)
        return [
            *[F.coalesce(F.sum(c).over(now), F.lit(0)).alias(name) for c, name in (("n", "instant_records"), ("interfaces", "instant_interfaces"))],
            F.coalesce(F.sum("n").over(around), F.lit(0)).alias("nearby_records"),
            *[F.coalesce(F.sum(c).over(around), F.lit(0)).alias(c) for c in ("discard_resets", "other_resets")],
        ]

    return near(_marks(events, HOST), points, HOST, reach, reach, measures)


def instant_metrics(events: DataFrame, records: DataFrame) -> DataFrame:
    """(hostid, clock, canonical_metric, records) at the instants of events."""
    named = records.filter(F.col("canonical_metric") != "").groupBy(*HOST, "clock", "canonical_metric").agg(F.count(F.lit(1)).alias("records"))
    return named.join(_marks(events, HOST), [*HOST, "clock"], "left_semi")


def _flagged(records: DataFrame) -> DataFrame:
    return records.filter("counter_reset").na.drop(subset=[*INTERFACE, "clock"]).select(*INTERFACE, "clock").distinct()


def affected_interfaces(events: DataFrame, records: DataFrame, reach: int = REACH_SEC) -> DataFrame:
    """(hostid, clock, affected): distinct interfaces with a flagged reset within ``reach`` or any record at the instant.

    An interface is affected from ``reach`` before a reset to ``reach`` after it. Runs of resets whose reaches meet are one
    interval, so interfaces do not count twice, and what is affected at a clock is the number of intervals begun less
    those ended: one running total a host. Interfaces that only have a record at the instant, with no reset in
    reach, are added.
    """
    marks, resets = _marks(events, HOST), _flagged(records)
    chained = with_neighbours(resets, INTERFACE, ["clock"], following="following")
    clock, joined = F.col("clock"), 2 * reach
    begins = chained.filter(F.col("previous").isNull() | (clock - F.col("previous.clock") > joined)).select("hostid", (clock - reach).alias("clock"), F.lit(1).alias("step"))
    ends = chained.filter(F.col("following").isNull() | (F.col("following.clock") - clock > joined)).select(
        "hostid", (clock + reach + 1).alias("clock"), F.lit(-1).alias("step")
    )
    steps = begins.unionAll(ends).groupBy("hostid", "clock").agg(F.sum("step").alias("affected"))
    active = running_count(marks, steps, HOST, "affected")

    present = records.na.drop(subset=[*INTERFACE, "clock"]).select(*INTERFACE, "clock").distinct().join(marks, [*HOST, "clock"], "left_semi")
    beside = near(present, resets.withColumn("n", F.lit(1)), INTERFACE, reach, reach, lambda frame: [F.count("n").over(frame(-reach, reach)).alias("resets")])
    alone = beside.filter("resets = 0").groupBy(*HOST, "clock").agg(F.count(F.lit(1)).alias("alone"))
    return active.join(alone, [*HOST, "clock"], "left").select(*HOST, "clock", (F.col("affected") + F.coalesce("alone", F.lit(0))).alias("affected"))


def affected_sets(events: DataFrame, records: DataFrame, reach: int = REACH_SEC) -> DataFrame:
    """(hostid, clock, interfaces): the interfaces that ``affected_interfaces`` counts, sorted.

    Each second's interfaces are one sorted set first; a frame unites those of the seconds in reach, so what is held is the
    answer at most once for each of these seconds.
    """
    placed = records.na.drop(subset=[*INTERFACE, "clock"]).groupBy(*HOST, "clock").agg(
        F.collect_set(F.when(F.coalesce("counter_reset", F.lit(False)), F.col("ifindex"))).alias("reset"), F.collect_set("ifindex").alias("present")
    )

    def measures(frame) -> list[Column]:
        around, now = (F.flatten(F.collect_list(c).over(f)) for c, f in (("reset", frame(-reach, reach)), ("present", frame(0, 0))))
        return [F.array_sort(F.array_distinct(F.concat(around, now))).alias("interfaces")]

    return near(_marks(events, HOST), placed, HOST, reach, reach, measures)


def _moves(records: DataFrame, metrics: Sequence[str], value: str, moved) -> DataFrame:
    """(series, clock, n): pairs of successive samples, in file order at one clock, for which ``moved(now, was)`` holds."""
    rows = _of_interfaces(records, metrics).withColumn(value, finite(F.col(value)))
    told = attach_clock_context(rows, SERIES, value)
    context_, here = F.col("context"), Window.partitionBy(*SERIES, "clock").orderBy("ordinal")
    first = F.col("ordinal") == context_["first_ordinal"]
    was = F.when(first, context_["previous"]["last_value"]).otherwise(F.lag(value).over(here))
    found = told.select(*SERIES, "clock", F.col(value).alias("now"), was.alias("was"))
    return found.filter(moved(F.col("now"), F.col("was"))).groupBy(*SERIES, "clock").agg(F.count(F.lit(1)).alias("n"))


def related_decreases(events: DataFrame, records: DataFrame, own_metric: bool = True) -> DataFrame:
    """(hostid, ifindex, canonical_metric, clock, related): decreases of related counters up to the event, from the beginning.

    With ``own_metric`` the decreases of the event's own metric, the event among them, count as well.
    """
    falls = _moves(records, RELATED_COUNTERS, "raw_value", lambda now, was: now < was)
    every = falls.groupBy(*INTERFACE, "clock").agg(F.sum("n").alias("related"))
    found = _marks(events, SERIES).join(running_count(_marks(events, INTERFACE), every, INTERFACE, "related"), [*INTERFACE, "clock"])
    if own_metric:
        return found
    own = running_count(_marks(events, SERIES), falls.withColumnRenamed("n", "own"), SERIES, "own")
    return found.join(own, [*SERIES, "clock"]).select(*SERIES, "clock", (F.col("related") - F.col("own")).alias("related"))


def status_moves(events: DataFrame, records: DataFrame, reach: int = REACH_SEC) -> DataFrame:
    """(hostid, ifindex, clock, status_changes): status changes whose later sample is within ``reach``."""
    changed = _moves(records, RELATED_STATES, "value", lambda now, was: now != was).drop("canonical_metric")
    return near(
        _marks(events, INTERFACE), changed, INTERFACE, reach, reach,
        lambda frame: [F.coalesce(F.sum("n").over(frame(-reach, reach)), F.lit(0)).alias("status_changes")],
    )


def device_pattern(events: DataFrame, records: DataFrame, reach: int = REACH_SEC, own_metric: bool = True) -> DataFrame:
    """Every event with what its host and interface show around it, its class and the confidence in it."""
    found = events
    for part, key in (
        (host_activity(events, records, reach), HOST), (affected_interfaces(events, records, reach), HOST),
        (related_decreases(events, records, own_metric), SERIES), (status_moves(events, records, reach), INTERFACE),
    ):
        found = found.join(part, [*key, "clock"], "left")
    names = ("instant_records", "instant_interfaces", "nearby_records", "discard_resets", "other_resets", "affected", "related", "status_changes")
    found = found.fillna(0, subset=list(names))
    wide, calm = F.col("instant_interfaces") >= WIDE_INTERFACES, F.col("status_changes") == 0
    return found.withColumns(
        {
            "classification": F.when(wide & calm & (F.col("related") == 0), "device_wide_discard_counter_behavior")
            .when(wide & calm, "device_wide_multiple_counter_behavior").when(~calm, "possible_interface_event").otherwise("isolated_counter_behavior"),
            "confidence": F.when(wide & calm & (F.col("related") == 0), "high").when(wide | ~calm, "medium").otherwise("low"),
        }
    )


def pattern_summary(classified: DataFrame) -> DataFrame:
    """One row: events, and how many show several interfaces, related decreases and status changes."""
    several = F.col("instant_interfaces")
    return classified.agg(
        F.count(F.lit(1)).alias("events"), F.count_if(several >= WIDE_INTERFACES).alias("three_or_more_interfaces"),
        F.count_if(several >= 2).alias("two_or_more_interfaces"), F.count_if(F.col("related") > 0).alias("with_related_decrease"),
        F.count_if(F.col("status_changes") > 0).alias("with_status_change"),
    )


def pattern_totals(classified: DataFrame, most: int = 20) -> DataFrame:
    """Events per class, confidence, metric, role, and of the ``most`` hosts with most events (equal ones by name)."""
    host = F.coalesce(*[F.nullif(c, F.lit("")) for c in ("host_name", "host", "hostid")])
    role = F.coalesce(F.nullif("device_role", F.lit("")), F.lit("unknown"))
    named = {"classification": F.col("classification"), "confidence": F.col("confidence"), "metric": F.col("canonical_metric"), "role": role, "host": host}
    pairs = F.array(*[F.struct(F.lit(k).alias("dimension"), v.alias("name")) for k, v in named.items()])
    counted = classified.select(F.explode(pairs).alias("p")).groupBy("p.dimension", "p.name").agg(F.count(F.lit(1)).alias("events"))
    place = F.row_number().over(Window.partitionBy("dimension").orderBy(F.desc("events"), "name"))
    return counted.withColumn("rank", place).filter((F.col("dimension") != "host") | (F.col("rank") <= most))
