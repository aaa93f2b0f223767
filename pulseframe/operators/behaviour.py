"""What kind of series an item is: steps from sample to sample, the samples around a decrease, and the decrease report.

Series are cut into day slices; per slice only its last point, or its first few samples, travel to other slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.functions.scalars import close_to, floor_bucket
from pulseframe.operators.quantiles import distribution
from pulseframe.operators.timeline import DAY_SEC, attach_clock_context

# Share of falls that rules out a counter, samples of the latest history.
FALLING_SHARE = 0.10
LATEST = 100
# Samples on either side of a decrease, samples that a verdict needs, and limits of a low restart.
CONTEXT_SAMPLES, ENOUGH_AFTER = 10, 5
RESET_RATIO, LOW_RATIO, LOW_VALUE = 0.50, 0.10, 20


def steps(rows: DataFrame, key: Sequence[str], value: str = "value") -> DataFrame:
    """Rows with a value, and ``was``: the value of the row before in (clock, ordinal) order; null at the first."""
    named = rows.filter(F.col(value).isNotNull()).na.drop(subset=[*key, "clock"])
    context = F.col("context")
    same_clock = F.lag(value).over(Window.partitionBy(*key, "clock").orderBy("ordinal"))
    leads = F.col("ordinal") == context["first_ordinal"]
    return attach_clock_context(named, key, value).select(
        *key, "clock", "ordinal", value, F.when(leads, context["previous"]["last_value"]).otherwise(same_clock).alias("was")
    )


def direction_counts(rows: DataFrame, key: Sequence[str] = ("itemid",), value: str = "value") -> DataFrame:
    """Samples of each series, and how often it rises, falls and stays, with the size of its steps."""
    delta = F.col(value) - F.col("was")
    return steps(rows, key, value).groupBy(*key).agg(
        F.count(F.lit(1)).alias("samples"), F.count_if(delta > 0).alias("rises"), F.count_if(delta < 0).alias("falls"),
        F.count_if(delta == 0).alias("unchanged"), F.min(delta).alias("min_delta"), F.max(delta).alias("max_delta"),
        F.avg(delta).alias("mean_delta"), F.count_distinct(value).alias("unique_values"),
    )


def behaviour_classes(rows: DataFrame, key: Sequence[str] = ("itemid",), value: str = "value") -> DataFrame:
    """Each series with its steps, value statistics, class and confidence."""
    counted = direction_counts(rows, key, value)
    values = distribution(rows.na.drop(subset=[*key, "clock"]), key, value, {"median": 0.5}).drop("count")
    rises, falls, all_steps = F.col("rises"), F.col("falls"), F.col("samples") - 1
    few, steady = F.col("samples") < 2, falls == 0
    rare = falls < FALLING_SHARE * all_steps
    kind = (
        F.when(few, "insufficient_data").when(steady & (rises > 0), "likely_counter").when(steady, "possible_counter")
        .when(rare & (rises > 0), "likely_counter_with_resets").when(~rare, "likely_interval_or_rate").otherwise("unknown")
    )
    known = F.col("classification")
    trust = F.when(known == "likely_counter", "high").when(known.isin("insufficient_data", "unknown"), "low").otherwise("medium")
    return (
        counted.join(values, list(key)).withColumn("classification", kind)
        .withColumns({"confidence": trust, "monotonic": steady & ~few})
    )


def inferred_metric(key_text: Column) -> Column:
    """Canonical metric that an interface key's words name, if they do."""
    text = F.lower(key_text)
    way = F.when(text.contains(".in["), "in").when(text.contains(".out["), "out")
    what = F.when(text.contains("dropped"), "_discard_rate").when(text.contains("errors"), "_error_rate")
    return F.concat(way, what)


def recommended(classified: DataFrame, items: DataFrame) -> DataFrame:
    """Adds how a series of that class should be read; ``items`` (itemid, key) are unique by item."""
    counter = F.col("classification").isin("likely_counter", "possible_counter", "likely_counter_with_resets")
    rate = F.col("classification") == "likely_interval_or_rate"
    found = classified.join(items.select("itemid", "key"), "itemid", "left")
    return found.withColumns(
        {
            "semantic_type": F.when(counter, "counter").when(rate, "rate").otherwise("unknown"),
            "transformation": F.when(counter, "delta_rate").when(rate, "direct").otherwise("manual_review"),
            "inferred_metric": F.when(counter | rate, inferred_metric(F.col("key"))),
        }
    )


def class_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("classification").agg(F.count(F.lit(1)).alias("items"))


def latest(rows: DataFrame, most: int = LATEST, key: Sequence[str] = ("itemid",)) -> DataFrame:
    """The last ``most`` samples of each series; ``rank`` counts from the newest."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("clock"), F.desc("ordinal")))
    return rows.withColumn("rank", place).filter(F.col("rank") <= most)


def edge_samples(rows: DataFrame, most: int = CONTEXT_SAMPLES, key: Sequence[str] = ("itemid",)) -> DataFrame:
    """The first and the last ``most`` samples of each series in (clock, ordinal) order; ``rank`` counts from that end."""
    ends = []
    for edge, way in (("first", F.asc), ("last", F.desc)):
        place = F.row_number().over(Window.partitionBy(*key).orderBy(way("clock"), way("ordinal")))
        ends.append(rows.na.drop(subset=[*key, "clock"]).withColumn("rank", place).filter(F.col("rank") <= most).withColumn("edge", F.lit(edge)))
    return ends[0].unionByName(ends[1])


def beyond(rows: DataFrame, key: Sequence[str], value: str, most: int, later: bool, name: str) -> DataFrame:
    """(key, clock, name): for every clock of a series, the values of the ``most`` nearest rows after (or before) it.

    A clock gives at most ``most`` of its rows, so the next ``most`` clocks hold all that is wanted.
    """
    way = F.asc if later else F.desc
    at_clock = Window.partitionBy(*key, "clock").orderBy(way("ordinal"))
    first = rows.na.drop(subset=[*key, "clock"]).withColumn("_place", F.row_number().over(at_clock)).filter(F.col("_place") <= most)
    pairs = F.array_sort(F.collect_list(F.struct("_place", F.col(value).alias("v"))))
    points = first.groupBy(*key, "clock").agg(F.transform(pairs, lambda p: p["v"]).alias("_values")).withColumn(
        "_slice", floor_bucket(F.col("clock"), DAY_SEC)
    )
    within = Window.partitionBy(*key, "_slice").orderBy(way("clock"))
    across = Window.partitionBy(*key).orderBy(way("_slice"))
    heads = points.withColumn("_rank", F.row_number().over(within)).filter(F.col("_rank") <= most)
    head = F.array_sort(F.collect_list(F.struct("_rank", "_values")))
    heads = heads.groupBy(*key, "_slice").agg(F.slice(F.flatten(F.transform(head, lambda h: h["_values"])), 1, most).alias("_head"))
    carry = heads.select(*key, "_slice", F.flatten(F.collect_list("_head").over(across.rowsBetween(1, most))).alias("_carry"))
    inner = points.select(*key, "clock", "_slice", F.flatten(F.collect_list("_values").over(within.rowsBetween(1, most))).alias("_inner"))
    return inner.join(carry, [*key, "_slice"], "left").select(
        *key, "clock", F.slice(F.concat("_inner", F.coalesce("_carry", F.array().cast("array<double>"))), 1, most).alias(name)
    )


def decrease_behaviour(events: DataFrame, records: DataFrame, key: Sequence[str] = ("itemid",), value: str = "raw_value") -> DataFrame:
    """Every decrease with the samples around it, how the series goes on, and whether it looks like a restart."""
    found = events
    for later, name in ((False, "before"), (True, "after")):
        found = found.join(beyond(records, key, value, CONTEXT_SAMPLES, later, name), [*key, "clock"], "left")
    number = F.filter("after", lambda x: x.isNotNull())
    moves = F.zip_with(F.slice("post", 1, F.greatest(F.size("post") - 1, F.lit(0))), F.slice("post", 2, CONTEXT_SAMPLES), lambda a, b: b - a)
    found = found.withColumn("post", F.coalesce(number, F.array().cast("array<double>"))).withColumn("_moves", moves)
    found = found.withColumns(
        {
            "post_rises": F.size(F.filter("_moves", lambda m: m > 0)), "post_falls": F.size(F.filter("_moves", lambda m: m < 0)),
            "post_samples": F.size("post"), "ratio": F.when(F.col("previous_raw_value") > 0, F.col("decrease") / F.col("previous_raw_value")),
            "low": (F.col(value) <= LOW_VALUE) | ((F.col("previous_raw_value") > 0) & (F.col(value) <= F.col("previous_raw_value") * LOW_RATIO)),
        }
    )
    enough, ratio = F.col("post_samples") >= ENOUGH_AFTER, F.col("ratio")
    climbs = enough & (F.col("post_rises") >= ENOUGH_AFTER - 1) & (F.col("post_falls") == 0)
    kind = (
        F.when(F.col("low") & climbs & (ratio.isNull() | (ratio >= RESET_RATIO)), "likely_true_counter_reset")
        .when(ratio < RESET_RATIO, "minor_counter_decrease")
        .when(F.col("low") & enough & (F.col("post_rises") > 0), "possible_counter_reset").otherwise("counter_behavior_uncertain")
    )
    return found.withColumn("post_monotonic", climbs).withColumn("classification", kind).drop("_moves", "post")


def _direction() -> Column:
    raw, was = F.col("raw_value"), F.col("previous_raw_value")
    return (
        F.when(was.isNull(), "first").when(raw.isNull(), "missing").when(raw > was, "increase").when(raw == was, "unchanged").otherwise("decrease")
    )


def reset_audit(transformed: DataFrame) -> DataFrame:
    """One row: directions of all counter records, faults of their decreases, and the status that follows."""
    direction = F.col("direction")
    falls = direction == "decrease"
    right_delta = F.coalesce(close_to(F.col("delta_value"), F.col("raw_value") - F.col("previous_raw_value")), F.lit(False))
    faults = [direction == "missing", falls & ~F.coalesce("counter_reset", F.lit(False)), falls & ~right_delta, falls & F.col("value").isNotNull()]
    names = ("first", "increase", "unchanged", "decrease")
    counted = transformed.filter("semantic_type = 'counter'").withColumn("direction", _direction()).agg(
        F.count(F.lit(1)).alias("counter_records"), *[F.count_if(direction == n).alias(n) for n in names],
        sum((F.count_if(f) for f in faults), F.lit(0).cast("bigint")).alias("invalid"),
    )
    return counted.withColumn(
        "status", F.when(F.col("invalid") > 0, "FAIL").when(F.col("decrease") > 0, "PASS WITH WARNINGS").otherwise("PASS")
    )


def reset_totals(transformed: DataFrame) -> DataFrame:
    """Decreases per metric, role, host label and item label."""
    host = F.coalesce("host_name", "host", "hostid")
    named = {
        "metric": F.col("canonical_metric"), "role": F.col("device_role"), "host": host,
        "item": F.concat_ws(" | ", host, F.concat(F.lit("itemid="), "itemid"), "canonical_metric"),
    }
    falls = transformed.filter("semantic_type = 'counter'").withColumn("direction", _direction()).filter("direction = 'decrease'")
    pairs = F.array(*[F.struct(F.lit(k).alias("dimension"), v.alias("name")) for k, v in named.items()])
    return falls.select(F.explode(pairs).alias("p")).groupBy("p.dimension", "p.name").agg(F.count(F.lit(1)).alias("decreases"))


def reset_magnitudes(transformed: DataFrame) -> DataFrame:
    """Size of the decreases, values on both sides and elapsed time: count, range, mean and percentiles of each."""
    falls = transformed.filter("semantic_type = 'counter'").withColumn("direction", _direction()).filter("direction = 'decrease'")
    measures = {
        "magnitude": F.col("previous_raw_value") - F.col("raw_value"), "previous": F.col("previous_raw_value"), "current": F.col("raw_value"),
        "elapsed": F.col("delta_time_sec").cast("double"),
    }
    pairs = F.array(*[F.struct(F.lit(k).alias("measure"), v.alias("v")) for k, v in measures.items()])
    return distribution(falls.select(F.explode(pairs).alias("p")).select("p.measure", "p.v"), ["measure"], "v")


def reset_details(transformed: DataFrame) -> DataFrame:
    """Every decrease of a counter with its size and the faults of its record."""
    falls = transformed.filter("semantic_type = 'counter'").withColumn("direction", _direction()).filter("direction = 'decrease'")
    right_delta = F.coalesce(close_to(F.col("delta_value"), F.col("raw_value") - F.col("previous_raw_value")), F.lit(False))
    return falls.select(
        "itemid", "hostid", "ifindex", "canonical_metric", "device_role", "clock", "ordinal", "previous_raw_value", "raw_value",
        (F.col("previous_raw_value") - F.col("raw_value")).alias("magnitude"), "delta_time_sec",
        (~F.coalesce("counter_reset", F.lit(False))).alias("unmarked"), (~right_delta).alias("wrong_delta"), F.col("value").isNotNull().alias("has_rate"),
    )
