"""Exact interpolated percentiles without holding a group in one aggregation buffer.

A mergeable sketch first brackets each wanted rank; a second pass counts what lies below the bracket and
ranks only the few values inside it.  The bracket is as wide as the sketch's error and two ranks of the group
demand, and a wanted rank outside its bracket is an error, so the answer is exact for every size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000
#: Widths of a bracket: ``2 ** (level + 1) / ACCURACY`` to either side, the widest beyond any fraction.
LEVELS = 15


def exact_percentiles(
    rows: DataFrame, group: Sequence[str], value: str, points: Mapping[str, float]
) -> DataFrame:
    """One row per group with ``values_counted`` and a column per named percentile (0..1).

    Linear interpolation between the two ranks around ``p * (n - 1)``; null values are ignored.
    """
    keys = list(group) or ["_all"]
    base = rows.filter(F.col(value).isNotNull())
    base = base.select(*group, value) if group else base.select(F.lit(1).alias("_all"), value)
    names, wanted = list(points), list(points.values())
    slack = [2.0 ** (level + 1) / ACCURACY for level in range(LEVELS)]
    lows = [float(max(p - s, 0.0)) for p in wanted for s in slack]
    highs = [float(min(p + s, 1.0)) for p in wanted for s in slack]
    sketch = base.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx(value, lows + highs, ACCURACY).alias("sketch"),
    )
    level = F.greatest(F.ceil(F.log2(1 + 2.0 * ACCURACY / F.col("n"))) - 1, F.lit(0)).cast("int")
    count = len(wanted)
    brackets = sketch.select(
        *keys,
        "n",
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("i"),
                    F.col("sketch")[level + i * LEVELS].alias("lo"),
                    F.col("sketch")[level + (count + i) * LEVELS].alias("hi"),
                )
                for i in range(count)
            ]
        ).alias("brackets"),
    )
    placed = base.join(brackets, keys)
    below = placed.groupBy(*keys).agg(
        F.first("n").alias("n"),
        F.array(
            *[F.count_if(F.col(value) < F.col("brackets")[i]["lo"]) for i in range(count)]
        ).alias("below"),
    )
    inside = (
        placed.select(
            *keys,
            value,
            F.explode(
                F.filter("brackets", lambda b: F.col(value).between(b["lo"], b["hi"]))
            ).alias("bracket"),
        )
        .groupBy(*keys, F.col("bracket.i").alias("i"), value)
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    ordered = Window.partitionBy(*keys, "i").orderBy(value)
    ranked = inside.withColumn("upto", F.sum("copies").over(ordered)).join(below, keys)
    p = F.array(*[F.lit(float(x)) for x in wanted])[F.col("i")]
    position = p * (F.col("n") - 1)
    rank = F.floor(position)
    start = F.col("below")[F.col("i")]
    reach = start + F.col("upto")
    at_rank = ranked.groupBy(*keys, "i").agg(
        F.first("n").alias("n"),
        F.min(F.when(reach > rank, F.col(value))).alias("lower"),
        F.min(F.when(reach > rank + 1, F.col(value))).alias("upper"),
        F.first(position - rank).alias("weight"),
        F.first(start > rank).alias("late"),
    )
    missed = F.col("late") | F.col("lower").isNull() | ((F.col("weight") > 0) & F.col("upper").isNull())
    mixed = F.when(
        missed, F.raise_error(F.lit("a percentile's rank lies outside its bracket")).cast("double")
    ).when(F.col("weight") == 0, F.col("lower")).otherwise(
        F.col("lower") * (1 - F.col("weight")) + F.col("upper") * F.col("weight")
    )
    return (
        at_rank.groupBy(*keys)
        .agg(
            F.first("n").alias("values_counted"),
            *[F.max(F.when(F.col("i") == i, mixed)).alias(name) for i, name in enumerate(names)],
        )
        .select(*group, "values_counted", *names)
    )


# The percentiles every magnitude report carries.
REPORT_POINTS = {"median": 0.5, "p95": 0.95, "p99": 0.99}


def distribution(
    rows: DataFrame,
    group: Sequence[str],
    value: str,
    points: Mapping[str, float] = REPORT_POINTS,
) -> DataFrame:
    """Count, min, max, mean and exact percentiles of a column per group."""
    keys = list(group) or ["_all"]
    frame = rows if group else rows.withColumn("_all", F.lit(1))
    summary = frame.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.count(value).alias("count"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.avg(value).alias("mean"),
    )
    exact = exact_percentiles(frame, keys, value, points).drop("values_counted")
    return summary.join(exact, keys).select(*group, "count", "min", "max", "mean", *points)
