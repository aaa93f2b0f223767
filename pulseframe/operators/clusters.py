"""How counter decreases lie in time: neighbours, clusters, periods, and decreases of other counters close by.

Everything is reduced to one row per key and clock first, so a key with very many events costs no more than its
distinct seconds; slices of time keep one host's events out of a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.operators import counters
from pulseframe.operators.correlate import HOST, INTERFACE, attach, per_clock_counts, status_transitions
from pulseframe.operators.quantiles import distribution
from pulseframe.operators.timeline import as_of, near, per_clock, with_neighbours
from pulseframe.plans import staging
from pulseframe.vocab import DISCARD_METRICS

# Reach of the neighbour search, span of a host cluster, shares of a verdict, length of the period list.
WINDOWS_SEC = (0, 5, 30, 60, 300)
CLUSTER_SPAN_SEC = 60
SHARE_PCT = 50
COMMON_INTERVALS = 10


def neighbour_statistics(events: DataFrame, key: Sequence[str] = (), windows: Sequence[int] = WINDOWS_SEC) -> DataFrame:
    """Per key and window: events that have another event within it, their share, and events with a later one."""
    points = events.na.drop(subset=[*key, "clock"]).groupBy(*key, "clock").agg(F.count(F.lit(1)).alias("n"))
    chained = with_neighbours(points, key, ["clock"], following="following")
    n, clock = F.col("n"), F.col("clock")
    after = F.col("following.clock") - clock
    nearest = F.least(after, clock - F.col("previous.clock"))

    def counted(window: int) -> Column:
        later = n - 1 + F.coalesce(after <= window, F.lit(False)).cast("bigint")
        beside = F.when((n > 1) | (nearest <= window), n).otherwise(0)
        return F.struct(F.lit(window).alias("window_sec"), beside.alias("beside"), later.alias("later"))

    spread = chained.select(*key, "n", F.explode(F.array(*[counted(w) for w in windows])).alias("w"))
    total = spread.groupBy(*key, "w.window_sec").agg(
        F.sum("n").alias("events"), F.sum("w.beside").alias("events_with_neighbour"), F.sum("w.later").alias("events_with_later")
    )
    return total.withColumn("share_pct", F.round(F.col("events_with_neighbour") / F.col("events") * 100, 2))


def _members(metrics: Sequence[str]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("events"), F.count_distinct("ifindex").alias("interfaces"),
        *[F.count_if(F.col("canonical_metric") == m).alias(m) for m in metrics],
    ]


def same_clock_clusters(events: DataFrame, metrics: Sequence[str] = DISCARD_METRICS) -> DataFrame:
    """Clocks with two or more events: how many, on how many hosts and interfaces, and of which metrics."""
    count, _, *by_metric = _members(metrics)
    interface = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in INTERFACE])
    return events.filter(F.col("clock").isNotNull()).groupBy("clock").agg(
        count, F.count_distinct("hostid").alias("hosts"), F.count_distinct(interface).alias("interfaces"), *by_metric
    ).filter("events >= 2")


def reached(starts: DataFrame, jumps: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, clock) of everything that ``starts`` lead to along ``jumps`` (key, clock, target), by pointer doubling.

    Each round joins the jumps with themselves, so that they go twice as far, and drops those that have no end any more:
    the logarithm of the longest way is all the rounds there are, and no way is ever one row.
    """
    found = starts.select(*key, "clock")
    while not jumps.isEmpty():
        stepped = found.join(jumps, [*key, "clock"]).select(*key, F.col("target").alias("clock"))
        found = staging.materialise(found.unionByName(stepped).distinct(), "reached")
        onward = jumps.select(*key, F.col("clock").alias("target"), F.col("target").alias("further"))
        jumps = staging.materialise(jumps.join(onward, [*key, "target"]).select(*key, "clock", F.col("further").alias("target")), "jumps")
    return found


def anchored(events: DataFrame, span: int = CLUSTER_SPAN_SEC) -> DataFrame:
    """(hostid, clock, start): each event clock with the first clock of its cluster.

    A cluster takes what lies within ``span`` of its first event, so the cluster after that of c begins at the first clock
    beyond c + span. A clock that has no other within ``span`` before it begins a cluster for certain; the other beginnings
    are what these lead to, jump by jump.
    """
    points = events.na.drop(subset=[*HOST, "clock"]).select("hostid", "clock").distinct()
    points = staging.materialise(points, "event-clocks")
    chained = with_neighbours(points, HOST, ["clock"])
    certain = chained.filter(F.col("previous").isNull() | (F.col("clock") - F.col("previous.clock") > span)).select("hostid", "clock")
    certain = staging.materialise(certain, "heads")
    beyond = as_of(points.select("hostid", (F.col("clock") + span).alias("clock")), points, HOST, [])
    # a jump to a certain beginning tells nothing new
    jumps = beyond.filter(F.col("after").isNotNull()).select("hostid", (F.col("clock") - span).alias("clock"), F.col("after.clock").alias("target")).join(
        certain.select("hostid", F.col("clock").alias("target")), ["hostid", "target"], "left_anti"
    ).select("hostid", "clock", "target")
    starts = reached(certain, staging.materialise(jumps, "jumps"), HOST)
    return as_of(points, starts, HOST, []).select("hostid", "clock", F.col("before.clock").alias("start"))


def host_clusters(events: DataFrame, span: int = CLUSTER_SPAN_SEC, metrics: Sequence[str] = DISCARD_METRICS) -> DataFrame:
    """Clusters of two or more events of a host, each anchored at its first event."""
    return events.join(anchored(events, span), ["hostid", "clock"]).groupBy("hostid", "start").agg(
        F.max("clock").alias("end"), *_members(metrics)
    ).filter("events >= 2").withColumn("duration_sec", F.col("end") - F.col("start"))


def temporal_verdict(events: DataFrame) -> DataFrame:
    """One row: whether decreases come together in time, and on several interfaces of a host."""
    within = neighbour_statistics(events, windows=(CLUSTER_SPAN_SEC,)).agg(
        F.coalesce(F.max("events"), F.lit(0)).alias("events"), F.coalesce(F.max("events_with_neighbour"), F.lit(0)).alias("within")
    )
    same = same_clock_clusters(events).agg(F.coalesce(F.sum("events"), F.lit(0)).alias("same"))
    wide = host_clusters(events).agg(F.count_if(F.col("interfaces") >= 2).alias("wide"))
    row = within.join(same, F.lit(True)).join(wide, F.lit(True))  # three tables of one row
    often, together = (F.col(c) * 100 >= SHARE_PCT * F.col("events") for c in ("within", "same"))
    several = F.col("wide") > 0
    verdict = (
        F.when(F.col("events") == 0, "no_counter_decrease")
        .when(together & several, "strong_device_wide_temporal_clustering")
        .when(often & several, "device_level_temporal_clustering")
        .when(often, "temporal_clustering_without_strong_multi_interface_evidence")
        .otherwise("mostly_independent_counter_decreases")
    )
    trust = F.when((F.col("events") == 0) | ((together | often) & several), "high").otherwise("medium")
    return row.select(
        "events", F.col("same").alias("same_clock_events"), F.col("within").alias("events_within_span"),
        F.col("wide").alias("multi_interface_clusters"), verdict.alias("classification"), trust.alias("confidence"),
    )


def intervals(events: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, interval): positive gaps between successive events of a key."""
    points = events.na.drop(subset=[*key, "clock"]).select(*key, "clock").distinct()
    return with_neighbours(points, key, ["clock"]).filter("previous is not null").select(
        *key, (F.col("clock") - F.col("previous.clock")).alias("interval")
    )


def common_intervals(events: DataFrame, key: Sequence[str] = tuple(HOST), most: int = COMMON_INTERVALS) -> DataFrame:
    """The most frequent gaps of each key, the shorter first among equals."""
    counted = intervals(events, key).groupBy(*key, "interval").agg(F.count(F.lit(1)).alias("times"))
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("times"), "interval"))
    return counted.withColumn("rank", place).filter(F.col("rank") <= most)


def interval_statistics(events: DataFrame, key: Sequence[str]) -> DataFrame:
    return distribution(intervals(events, key).withColumn("interval", F.col("interval").cast("double")), key, "interval", {"median": 0.5})


def repeats(events: DataFrame) -> DataFrame:
    """Events per item, per interface and per host."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in INTERFACE])
    named = {"item": F.col("itemid"), "interface": text, "host": F.col("hostid")}
    pairs = F.array(*[F.struct(F.lit(k).alias("level"), v.alias("name")) for k, v in named.items()])
    return events.select(F.explode(pairs).alias("p")).groupBy("p.level", "p.name").agg(F.count(F.lit(1)).alias("events"))


# Counters other than discards, metrics that show traffic, and the reach of the two searches.
OTHER_COUNTERS = ("in_bps", "out_bps", "in_error_rate", "out_error_rate", "in_pps", "out_pps", "interface_counter")
TRAFFIC = ("in_bps", "out_bps", "in_pps", "out_pps")
CROSS_WINDOW_SEC, STATUS_WINDOW_SEC = 60, 5
SERIES = [*INTERFACE, "canonical_metric"]


def series_decreases(records: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Decreases of each metric's own series on each interface."""
    return counters.detect_decreases(records.filter(F.col("canonical_metric").isin(*metrics)), SERIES, "raw_value", "take_last")


def cross_metric(events: DataFrame, records: DataFrame, window: int = CROSS_WINDOW_SEC) -> DataFrame:
    """Every event with the decreases of other counters, status changes and traffic of its interface, and its class."""
    points = {
        "other_decreases": per_clock_counts(series_decreases(records, OTHER_COUNTERS), INTERFACE),
        "status_changes": status_transitions(records),
        "traffic": per_clock_counts(records.filter(F.col("canonical_metric").isin(*TRAFFIC)).na.drop(subset=INTERFACE), INTERFACE),
    }
    found = events
    for name, rows in points.items():
        found = attach(found, rows, INTERFACE, name, window)
    changed, others = F.col("status_changes") > 0, F.col("other_decreases") > 0
    discard = F.col("canonical_metric").isin(*DISCARD_METRICS)
    return found.withColumns(
        {
            "classification": F.when(changed, "possible_interface_event").when(others, "multiple_counter_decrease")
            .when(discard, "discard_counter_only").otherwise("uncertain"),
            "confidence": F.when(changed & ~others, "medium").when(changed | others | discard, "high").otherwise("low"),
        }
    )


def bracketed(events: DataFrame, raw: DataFrame, metrics: Sequence[str] = OTHER_COUNTERS) -> DataFrame:
    """(hostid, ifindex, clock, metric) with the sample at or before an event and the first after it; both must exist.

    An event is looked up in those metrics only that its interface has.
    """
    marks = events.select(*INTERFACE, "clock").na.drop().distinct()
    samples = raw.filter(F.col("canonical_metric").isin(*metrics) & F.col("value").isNotNull()).na.drop(subset=[*INTERFACE, "clock"])
    wanted = marks.join(samples.select(*SERIES).distinct(), INTERFACE)
    found = as_of(wanted, per_clock(samples, SERIES, "value"), SERIES, ["first_value", "last_value"])
    return found.filter("before is not null and after is not null").select(
        *SERIES, "clock", F.col("before.last_value").alias("previous_value"), F.col("after.first_value").alias("current_value"),
        F.col("before.clock").alias("previous_clock"), F.col("after.clock").alias("current_clock"),
        (F.col("after.clock") - F.col("before.clock")).alias("delta_time_sec"),
        (F.col("after.first_value") - F.col("before.last_value")).alias("delta"),
    )


def status_varies(events: DataFrame, raw: DataFrame, window: int = STATUS_WINDOW_SEC) -> DataFrame:
    """Interface clocks near which the status takes more than one value."""
    samples = raw.filter((F.col("canonical_metric") == "oper_status") & F.col("value").isNotNull()).na.drop(subset=[*INTERFACE, "clock"])
    points = samples.groupBy(*INTERFACE, "clock").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    spread = lambda frame: [(F.min("low").over(frame(-window, window)) < F.max("high").over(frame(-window, window))).alias("varies")]
    return near(events.na.drop(subset=[*INTERFACE, "clock"]), points, INTERFACE, window, window, spread).filter("varies").select(*INTERFACE, "clock")


def raw_classes(events: DataFrame, raw: DataFrame) -> DataFrame:
    """Every event with its falling brackets, whether the status varied near it, and the class that follows."""
    falling = bracketed(events, raw).groupBy(*INTERFACE, "clock").agg(
        F.count(F.lit(1)).alias("related_metrics"), F.count_if(F.col("delta") < 0).alias("related_decreases")
    )
    varied = status_varies(events, raw).withColumn("oper_status_change", F.lit(True))
    found = events.join(falling, [*INTERFACE, "clock"], "left").join(varied, [*INTERFACE, "clock"], "left").fillna(
        {"related_metrics": 0, "related_decreases": 0, "oper_status_change": False}
    )
    status, several = F.col("oper_status_change"), F.col("related_decreases") > 0
    return found.withColumns(
        {
            "classification": F.when(status, "interface_status_event").when(several, "multiple_raw_counter_decrease")
            .otherwise("discard_counter_only"),
            "confidence": F.when(status | several, "high").otherwise("medium"),
        }
    )


def raw_verdict(classified: DataFrame) -> DataFrame:
    """One row: events of each class and the verdict on the data set."""
    kinds = ("interface_status_event", "multiple_raw_counter_decrease", "discard_counter_only")
    counted = classified.agg(
        F.count(F.lit(1)).alias("events"), *[F.count_if(F.col("classification") == k).alias(k) for k in kinds]
    )
    return counted.withColumn(
        "verdict",
        F.when(F.col("events") == 0, "no_raw_counter_decrease")
        .when(F.col(kinds[0]) > 0, "counter_decrease_with_interface_events")
        .when(F.col(kinds[1]) > 0, "multiple_raw_counter_behavior").otherwise("discard_counter_only_behavior"),
    )
