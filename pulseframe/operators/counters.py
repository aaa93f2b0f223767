"""Counter-to-rate transform and the shared counter-decrease detector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.scalars import safe_double, safe_long
from pulseframe.operators.timeline import attach_clock_context, per_clock, with_neighbours


def admit(history: DataFrame) -> DataFrame:
    """Keep records with an item id, an integer clock and a numeric value."""
    typed = history.withColumns(
        {"clock": safe_long(F.col("clock")), "value": safe_double(F.col("value"))}
    )
    return typed.filter(_admissible())


def admission_counts(history: DataFrame) -> DataFrame:
    typed = history.select(
        "itemid",
        safe_long(F.col("clock")).alias("clock"),
        safe_double(F.col("value")).alias("value"),
    )
    kept = F.count_if(_admissible())
    return typed.agg(
        F.count(F.lit(1)).alias("total_records"),
        kept.alias("numeric_records"),
        (F.count(F.lit(1)) - kept).alias("skipped_records"),
    )


def _admissible():
    ok = (F.col("itemid") != "") & F.col("clock").isNotNull() & F.col("value").isNotNull()
    return F.coalesce(ok, F.lit(False))


def transform_counters(history: DataFrame) -> DataFrame:
    """Counters become rates over the actually elapsed seconds; everything else passes through.

    Rows of non-counter items never leave their partition.  A decrease yields no rate, keeps its delta
    and becomes the new baseline; a repeated clock yields no rate and leaves the baseline alone.
    """
    records = admit(history)
    passthrough = [c for c in records.columns if c != "value"]
    is_counter = F.coalesce(F.col("semantic_type") == "counter", F.lit(False))

    direct = records.filter(~is_counter).select(
        *passthrough,
        "value",
        F.col("value").alias("raw_value"),
        F.lit(None).cast("double").alias("previous_raw_value"),
        F.lit(None).cast("bigint").alias("delta_time_sec"),
        F.lit(None).cast("double").alias("delta_value"),
        F.lit(False).alias("counter_reset"),
        F.lit(False).alias("duplicate_timestamp"),
        F.lit(False).alias("out_of_order"),
        F.lit("direct").alias("transformation_applied"),
    )

    context = F.col("context")
    before = context["previous"]
    repeated = F.col("ordinal") != context["first_ordinal"]
    starts = before.isNull()
    delta = F.when(~repeated & ~starts, F.col("value") - before["first_value"])
    elapsed = F.when(~repeated & ~starts, F.col("clock") - before["clock"])
    falls = F.coalesce(delta < 0, F.lit(False))
    counters = attach_clock_context(records.filter(is_counter), ["itemid"], "value").select(
        *passthrough,
        F.when(~falls, delta / elapsed).alias("value"),
        F.col("value").alias("raw_value"),
        F.when(repeated, context["first_value"])
        .otherwise(before["first_value"])
        .alias("previous_raw_value"),
        elapsed.alias("delta_time_sec"),
        delta.alias("delta_value"),
        falls.alias("counter_reset"),
        repeated.alias("duplicate_timestamp"),
        F.lit(False).alias("out_of_order"),
        F.when(repeated, "duplicate_timestamp")
        .when(starts, "counter_first_sample")
        .when(falls, "counter_reset")
        .otherwise("delta_rate")
        .alias("transformation_applied"),
    )
    return direct.unionByName(counters)


# Outcome labels of the transform, in report order.
OUTCOMES = (
    "direct",
    "counter_first_sample",
    "delta_rate",
    "counter_reset",
    "duplicate_timestamp",
    "out_of_order",
    "invalid_delta_time",
)


def transform_outcomes(transformed: DataFrame) -> DataFrame:
    """One row per outcome, including those that never occur."""
    counted = transformed.groupBy("transformation_applied").agg(F.count(F.lit(1)).alias("records"))
    labels = transformed.sparkSession.createDataFrame(
        [(o,) for o in OUTCOMES], "transformation_applied string"
    )
    return labels.join(counted, "transformation_applied", "left").select(
        "transformation_applied", F.coalesce("records", F.lit(0)).alias("records")
    )


def decreases_by_metric(transformed: DataFrame) -> DataFrame:
    metric = F.coalesce(F.nullif("canonical_metric", F.lit("")), F.lit("unknown"))
    return (
        transformed.filter("counter_reset")
        .groupBy(metric.alias("canonical_metric"))
        .agg(F.count(F.lit(1)).alias("decreases"))
    )


def detect_decreases(
    samples: DataFrame,
    key: Sequence[str],
    value: str = "raw_value",
    duplicates: str = "take_last",
    attributes: Sequence[str] = (),
) -> DataFrame:
    """Events where a series falls from one clock to the next.

    At a repeated clock only the first row can be an event.  The baseline carried to the next clock is
    the first row (``keep_first``) or the last row (``take_last``).  Records without a full key belong to no series
    and are skipped.
    """
    if duplicates not in ("keep_first", "take_last"):
        raise ValueError(f"unknown duplicate policy: {duplicates}")
    baseline = "first_value" if duplicates == "keep_first" else "last_value"
    wanted = [a for a in attributes if a not in key]
    named = samples.filter(F.col(value).isNotNull()).na.drop(subset=list(key))
    points = per_clock(named, key, value, wanted)
    chained = with_neighbours(points, key, ["clock", baseline])
    current, former = F.col("first_value"), F.col("previous")[baseline]
    fall = former - current
    return chained.filter(current < former).select(
        *key,
        *[F.col("attributes")[a].alias(a) for a in wanted],
        "clock",
        F.col("previous")["clock"].alias("previous_clock"),
        former.alias("previous_raw_value"),
        current.alias("raw_value"),
        fall.alias("decrease"),
        (current - former).alias("delta"),
        F.when(former != 0, fall / F.abs(former)).alias("decrease_ratio"),
    )
