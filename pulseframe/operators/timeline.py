"""Ordered-series building blocks that stay bounded when one key dominates the data.

A plain ``lag`` over ``partitionBy(item)`` puts a whole item into one task.  Here a series is cut into
slices of the ordering axis; each slice is windowed on its own and only one row per slice travels
across slices.  Rows that share a clock are first reduced by an aggregation that combines map-side, so
a slice never holds more rows than it has distinct clocks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.functions.scalars import floor_bucket

DAY_SEC = 86_400
HOUR_SEC = 3_600


def with_neighbours(
    points: DataFrame,
    key: Sequence[str],
    cols: Sequence[str],
    axis: str = "clock",
    slice_width: int = DAY_SEC,
    previous: str | None = "previous",
    following: str | None = None,
) -> DataFrame:
    """Add the preceding and/or following point of the same key as a struct of ``cols``.

    ``points`` has one row per ``(key, axis)``; key columns are never null.
    """
    sliced = points.withColumn("_slice", floor_bucket(F.col(axis), slice_width))
    packed = F.struct(*cols)
    within = Window.partitionBy(*key, "_slice").orderBy(axis)
    across = Window.partitionBy(*key).orderBy("_slice")

    ends, carries, inner, result = [], [], [], []
    if previous:
        ends.append(F.max_by(packed, axis).alias("_tail"))
        carries.append(F.lag("_tail").over(across).alias("_before"))
        inner.append(F.lag(packed).over(within).alias("_inner_before"))
        result.append(F.coalesce("_inner_before", "_before").alias(previous))
    if following:
        ends.append(F.min_by(packed, axis).alias("_head"))
        carries.append(F.lead("_head").over(across).alias("_after"))
        inner.append(F.lead(packed).over(within).alias("_inner_after"))
        result.append(F.coalesce("_inner_after", "_after").alias(following))

    carry = sliced.groupBy(*key, "_slice").agg(*ends).select(*key, "_slice", *carries)
    return (
        sliced.select("*", *inner)
        .join(carry, [*key, "_slice"], "left")
        .select(*points.columns, *result)
    )


def per_clock(
    rows: DataFrame,
    key: Sequence[str],
    value: str,
    attributes: Sequence[str] = (),
    clock: str = "clock",
    ordinal: str = "ordinal",
) -> DataFrame:
    """One row per ``(key, clock)``: first and last value in file order, plus the first row's attributes."""
    aggregates = [
        F.min_by(value, ordinal).alias("first_value"),
        F.max_by(value, ordinal).alias("last_value"),
        F.min(ordinal).alias("first_ordinal"),
        F.count(F.lit(1)).alias("rows_at_clock"),
    ]
    if attributes:
        aggregates.append(F.min_by(F.struct(*attributes), ordinal).alias("attributes"))
    return rows.groupBy(*key, clock).agg(*aggregates)


def attach_clock_context(rows: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Give every row its position at its clock and the values at the previous clock of its key.

    Adds ``context`` with ``first_value``, ``first_ordinal`` and ``previous`` (clock, first and last
    value at the preceding clock).  Any number of copies at one clock is handled: the join's left side
    may be skewed (adaptive execution splits it), its right side has one row per key and clock.
    """
    points = per_clock(rows.select(*key, "clock", "ordinal", value), key, value)
    chained = with_neighbours(points, key, ["clock", "first_value", "last_value"])
    context = chained.select(
        *key, "clock", F.struct("first_value", "first_ordinal", "previous").alias("context")
    )
    return rows.join(context, [*key, "clock"], "inner")


def near(
    events: DataFrame,
    samples: DataFrame,
    key: Sequence[str],
    before: int,
    after: int,
    measures: Callable[[Callable[[int, int], object]], list[Column]],
) -> DataFrame:
    """Measures over the samples around each event clock, without forming event-sample pairs.

    ``samples`` has at most one row per ``(key, clock)`` (pre-aggregate first).  Events and samples are
    laid on one time line and ``measures(frame)`` builds window aggregates, where ``frame(lo, hi)`` is
    the range of seconds relative to the event.  Samples near a slice border are copied to the
    neighbouring slice.  Returns one row per distinct ``(key, event clock)``.
    """
    width = max(HOUR_SEC, 4 * (before + after))
    clock = F.col("clock")
    marks = events.select(*key, "clock").distinct().select(
        *key, "clock", floor_bucket(clock, width).alias("_slice"), F.lit(True).alias("_event")
    )
    copies = F.array_distinct(
        F.array(floor_bucket(clock - after, width), floor_bucket(clock + before, width))
    )
    placed = samples.select("*", F.explode(copies).alias("_slice")).join(
        marks.select(*key, "_slice").distinct(), [*key, "_slice"], "left_semi"
    )
    line = marks.unionByName(placed, allowMissingColumns=True)
    base = Window.partitionBy(*key, "_slice").orderBy("clock")

    def frame(lo: int, hi: int):
        return base.rangeBetween(lo, hi)

    return (
        line.select(*key, "clock", "_event", *measures(frame)).filter(F.col("_event")).drop("_event")
    )


def as_of(
    events: DataFrame, points: DataFrame, key: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """Last point at or before and first point after each event clock, at any distance.

    ``points`` is ``per_clock`` output.  ``before`` carries the last value at its clock, ``after`` the
    first one.  One row per distinct ``(key, event clock)``.
    """
    clock = F.col("clock")
    sample = F.struct("clock", *cols)
    line = (
        events.select(*key, "clock").distinct().withColumn("_event", F.lit(True))
        .unionByName(points.select(*key, "clock", sample.alias("_point")), allowMissingColumns=True)
        .withColumn("_slice", floor_bucket(clock, DAY_SEC))
    )
    slices = Window.partitionBy(*key, "_slice")
    # both frames grow row by row; one that ends at the slice's end would be read anew for every row
    inner = line.select(
        *key, "clock", "_slice", "_event",
        F.last("_point", ignorenulls=True)
        .over(slices.orderBy("clock").rangeBetween(Window.unboundedPreceding, 0)).alias("_in_before"),
        F.last("_point", ignorenulls=True)
        .over(slices.orderBy(F.desc("clock")).rangeBetween(Window.unboundedPreceding, -1)).alias("_in_after"),
    ).filter(F.col("_event"))
    across = Window.partitionBy(*key).orderBy("_slice")
    back = Window.partitionBy(*key).orderBy(F.desc("_slice"))
    carry = (
        line.groupBy(*key, "_slice")
        .agg(
            F.max_by("_point", F.when(F.col("_point").isNotNull(), clock)).alias("_tail"),
            F.min_by("_point", F.when(F.col("_point").isNotNull(), clock)).alias("_head"),
        )
        .select(
            *key, "_slice",
            F.last("_tail", ignorenulls=True)
            .over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("_out_before"),
            F.last("_head", ignorenulls=True)
            .over(back.rowsBetween(Window.unboundedPreceding, -1)).alias("_out_after"),
        )
    )
    return inner.join(carry, [*key, "_slice"], "left").select(
        *key, "clock",
        F.coalesce("_in_before", "_out_before").alias("before"),
        F.coalesce("_in_after", "_out_after").alias("after"),
    )


def running_count(
    events: DataFrame, counts: DataFrame, key: Sequence[str], measure: str
) -> DataFrame:
    """Total of ``measure`` at or before each event clock; ``counts`` has one row per ``(key, clock)``."""
    line = (
        events.select(*key, "clock").distinct().withColumn("_event", F.lit(True))
        .unionByName(counts.select(*key, "clock", measure), allowMissingColumns=True)
        .withColumn("_slice", floor_bucket(F.col("clock"), DAY_SEC))
    )
    within = Window.partitionBy(*key, "_slice").orderBy("clock")
    across = Window.partitionBy(*key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    inner = line.select(
        *key, "clock", "_slice", "_event",
        F.sum(measure).over(within.rangeBetween(Window.unboundedPreceding, 0)).alias("_inner"),
    ).filter(F.col("_event"))
    carry = line.groupBy(*key, "_slice").agg(F.sum(measure).alias("_total")).select(
        *key, "_slice", F.sum("_total").over(across).alias("_earlier")
    )
    return inner.join(carry, [*key, "_slice"], "left").select(
        *key, "clock",
        (F.coalesce("_inner", F.lit(0)) + F.coalesce("_earlier", F.lit(0))).alias(measure),
    )


def count_inside(
    events: DataFrame, moves: DataFrame, key: Sequence[str], before: int, after: int, measure: str
) -> DataFrame:
    """Total of ``measure`` over the moves that lie wholly within ``before`` and ``after`` of each event clock.

    ``moves`` (key, since, clock, measure) follow one another along a key: none begins before the one ahead of it
    ends.  So those inside are the ones that ended up to the right edge less those that began before the left one:
    two running totals, whose cost does not depend on how much a window holds.
    """
    clock, n = F.col("clock"), F.col(measure)
    edges = events.select(*key, "clock").distinct().select(
        *key, clock.alias("_mark"),
        F.inline(F.array(
            F.struct((clock + after).alias("clock"), F.lit(1).alias("_sign")),
            F.struct((clock - before - 1).alias("clock"), F.lit(-1).alias("_sign")),
        )),
    )
    none = F.lit(0).cast("bigint")
    steps = moves.filter(n > 0).select(
        *key,
        F.inline(F.array(
            F.struct("clock", n.alias("_ended"), none.alias("_begun")),
            F.struct(F.col("since").alias("clock"), none.alias("_ended"), n.alias("_begun")),
        )),
    ).groupBy(*key, "clock").agg(F.sum("_ended").alias("_ended"), F.sum("_begun").alias("_begun"))
    line = edges.unionByName(steps, allowMissingColumns=True).withColumn("_slice", floor_bucket(clock, DAY_SEC))
    within = Window.partitionBy(*key, "_slice").orderBy("clock").rangeBetween(Window.unboundedPreceding, 0)
    across = Window.partitionBy(*key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    inner = line.select(
        *key, "_slice", "_mark", "_sign", *[F.sum(c).over(within).alias(c) for c in ("_ended", "_begun")]
    ).filter(F.col("_mark").isNotNull())
    carry = line.groupBy(*key, "_slice").agg(F.sum("_ended").alias("e"), F.sum("_begun").alias("b")).select(
        *key, "_slice", F.sum("e").over(across).alias("_e"), F.sum("b").over(across).alias("_b")
    )
    zero = F.lit(0)
    total = F.when(F.col("_sign") > 0, F.coalesce("_ended", zero) + F.coalesce("_e", zero)).otherwise(
        -F.coalesce("_begun", zero) - F.coalesce("_b", zero)
    )
    # a move that spans the whole window began before it and has not ended in it
    return inner.join(carry, [*key, "_slice"], "left").groupBy(*key, F.col("_mark").alias("clock")).agg(
        F.greatest(F.sum(total), none).alias(measure)
    )
