"""Feature store: trailing-window statistics with a preceding baseline, per interface and per device.

Shape of the job, whatever the data volume:

1. samples are reduced to one cell per (entity, metric, grid step) with a map-side combining
   aggregation, so a hot interface costs as many rows as it has grid steps;
2. cells are placed into time slices (plus a copy into the next slice when a window reaches across)
   and shuffled once by (entity, slice);
3. inside that partitioning the content of a window is merged where it changes, when a cell enters or leaves;
   a baseline window is the same content one window later. The last content of every window runs along the
   changes of an entity and is read off at the grid points up to the next change: no further exchange.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from pulseframe.functions.ifindex import parse_ifindex
from pulseframe.functions.scalars import (
    added,
    ceil_bucket,
    finite,
    first_non_empty,
    floor_bucket,
    guarded_ratio,
    iso_utc,
    non_empty,
    safe_long,
)
from pulseframe.operators.timeline import DAY_SEC
from pulseframe.plans import staging
from pulseframe.vocab import (
    DEFAULT_BUCKET_SEC,
    DEFAULT_WINDOWS_SEC,
    DEVICE_METRICS,
    DISCARD_METRICS,
    EPSILON,
    INTERFACE_METRICS,
)

INTERFACE_KEY = ("hostid", "ifindex")
DEVICE_KEY = ("hostid",)

# Column names of the derived totals and of the behaviour comparison.
TOTALS = {
    "traffic_total_bps": ("in_bps", "out_bps"),
    "packet_total_pps": ("in_pps", "out_pps"),
    "error_total_rate": ("in_error_rate", "out_error_rate"),
    "discard_total_rate": ("in_discard_rate", "out_discard_rate"),
}
RATIOS = {"in_out_bps_ratio": ("in_bps", "out_bps"), "in_out_pps_ratio": ("in_pps", "out_pps")}
INTERFACE_BEHAVIOUR = (
    "in_bps",
    "out_bps",
    "in_pps",
    "out_pps",
    "in_error_rate",
    "out_error_rate",
    "in_discard_rate",
    "out_discard_rate",
)
DEVICE_BEHAVIOUR = ("cpu_pct", "memory_pct", "temperature_c", "icmp_loss_pct", "icmp_rtt_sec")
DEVICE_SUMS = (
    "traffic_total_bps_sum",
    "packet_total_pps_sum",
    "error_total_rate_sum",
    "discard_total_rate_sum",
)
INTERFACE_AGGREGATES = (
    "interface_count",
    "interfaces_with_oper_down",
    "traffic_total_bps_sum",
    "traffic_total_bps_mean",
    "traffic_total_bps_max",
    "packet_total_pps_sum",
    "packet_total_pps_mean",
    "packet_total_pps_max",
    "error_total_rate_sum",
    "error_total_rate_max",
    "discard_total_rate_sum",
    "discard_total_rate_max",
    "interfaces_with_counter_reset",
)


@dataclass(frozen=True)
class Grid:
    """Grid step, trailing windows and the two choices about known defects of the original rules.

    ``carry_reset_context``: sum the size of flagged decreases (otherwise 0.0 whenever one exists).
    ``detect_uptime_falls``: flag any uptime fall inside the window (otherwise compare the last value
    with the window minimum, which can never be larger).
    """

    bucket_sec: int = DEFAULT_BUCKET_SEC
    windows: tuple[int, ...] = DEFAULT_WINDOWS_SEC
    carry_reset_context: bool = True
    detect_uptime_falls: bool = True

    def __post_init__(self) -> None:
        if self.bucket_sec <= 0 or not self.windows or min(self.windows) <= 0:
            raise ValueError("bucket and windows must be positive")
        object.__setattr__(self, "windows", tuple(sorted(set(self.windows))))

    @property
    def step(self) -> int:
        """Cell width: every window edge and every grid point falls on a multiple of it."""
        return reduce(gcd, self.windows, self.bucket_sec)

    @property
    def longest(self) -> int:
        return self.windows[-1]

    @property
    def slice_width(self) -> int:
        """Long enough that the halo of two windows stays a small share of a slice."""
        multiple = self.bucket_sec * self.step // gcd(self.bucket_sec, self.step)
        return -(-max(DAY_SEC, 8 * self.longest) // multiple) * multiple

    def suffix(self, window: int) -> str:
        """``5m`` style; plain seconds when two windows would share a name."""
        minutes = [w // 60 for w in self.windows]
        clash = minutes.count(window // 60) > 1 or window < 60
        return f"{window}s" if clash else f"{window // 60}m"

    @property
    def short(self) -> str:
        return self.suffix(self.windows[0])


# --- metadata and history -------------------------------------------------------------------------


def with_ifindex(metrics: DataFrame, variant: str = "features") -> DataFrame:
    return metrics.withColumn("ifindex", parse_ifindex(F.col("key"), variant))


def item_map(metrics: DataFrame) -> DataFrame:
    """One metadata row per item id; the last duplicate wins."""
    names = ("hostid", "host", "host_name", "device_role", "key", "canonical_metric",
             "semantic_type", "transformation")
    fields = [
        F.col(c) if c in metrics.columns else F.lit(None).cast("string").alias(c) for c in names
    ]
    return (
        metrics.filter(non_empty(F.trim("itemid")).isNotNull())
        .groupBy(F.trim("itemid").alias("itemid"))
        .agg(F.max_by(F.struct(*fields), "ordinal").alias("meta"))
        .withColumn("ifindex", parse_ifindex(F.col("meta.key")))
    )


def expected_counts(metrics: DataFrame, entity: str) -> DataFrame:
    """Number of distinct canonical metrics an interface or a device is supposed to deliver."""
    rows = with_ifindex(
        metrics.filter(
            non_empty(F.trim("itemid")).isNotNull() & non_empty(F.trim("hostid")).isNotNull()
        )
    )
    metric = F.col("canonical_metric")
    on_interface = F.col("ifindex").isNotNull() & metric.isin(*INTERFACE_METRICS)
    if entity == "interface":
        rows, key = rows.filter(on_interface), INTERFACE_KEY
    else:
        rows, key = rows.filter(~on_interface & metric.isin(*DEVICE_METRICS)), DEVICE_KEY
    return rows.groupBy(*key).agg(F.countDistinct("canonical_metric").alias("expected_count"))


def route_history(transformed: DataFrame, items: DataFrame) -> DataFrame:
    """Join metadata, settle host identity and tag every record with its route."""
    meta = F.col("meta")
    needed = ("clock", "ordinal", "hostid", "host", "host_name", "device_role", "value", "raw_value",
              "previous_raw_value", "counter_reset")
    joined = transformed.select(F.trim("itemid").alias("itemid"), *needed).join(
        items, "itemid", "left"
    )
    canonical = non_empty(meta["canonical_metric"])
    clock = safe_long(F.col("clock"))
    known = F.coalesce(canonical.isin(*INTERFACE_METRICS, *DEVICE_METRICS), F.lit(False))
    value = finite(F.col("value"))
    reset = F.coalesce(F.col("counter_reset"), F.lit(False))
    route = (
        F.when(meta.isNull(), "missing_metadata")
        .when(clock.isNull(), "invalid_clock")
        .when(canonical.isNull(), "missing_canonical")
        .when(~known, "unrelated_records")
        .otherwise("accepted_records")
    )

    def own_or_meta(name: str) -> Column:
        return first_non_empty(F.col(name), meta[name])

    blank = F.lit("")
    return joined.select(
        "itemid",
        "ordinal",
        clock.alias("clock"),
        F.coalesce(own_or_meta("hostid"), blank).alias("hostid"),
        F.coalesce(own_or_meta("host"), blank).alias("host"),
        F.coalesce(own_or_meta("host_name"), own_or_meta("host"), blank).alias("host_name"),
        F.coalesce(own_or_meta("device_role"), blank).alias("device_role"),
        canonical.alias("canonical_metric"),
        "ifindex",
        value.alias("value"),
        finite(F.col("raw_value")).alias("raw_value"),
        finite(F.col("previous_raw_value")).alias("previous_raw_value"),
        reset.alias("counter_reset"),
        route.alias("route"),
        ((route == "accepted_records") & value.isNull() & ~reset).alias("null_nonreset"),
    )


def route_counts(routed: DataFrame) -> DataFrame:
    """Counters of the history load, one row each."""
    labels = F.array_compact(
        F.array(F.col("route"), F.when(F.col("null_nonreset"), F.lit("null_nonreset_values")))
    )
    return (
        routed.select(F.explode(labels).alias("counter"))
        .groupBy("counter")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def accepted(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("route") == "accepted_records").drop("route", "null_nonreset")


def deduplicate(records: DataFrame) -> DataFrame:
    """One row per (item, clock): the first with a value, else the first; copies combine map-side."""
    rest = [c for c in records.columns if c not in ("itemid", "clock")]
    rank = F.struct(F.col("value").isNull(), F.col("ordinal"))
    return (
        records.groupBy("itemid", "clock")
        .agg(
            F.min_by(F.struct(*rest), rank).alias("_row"),
            F.count(F.lit(1)).alias("copies"),
            (F.min("value") < F.max("value")).alias("_conflict"),
        )
        .select(
            "itemid",
            "clock",
            *[F.col("_row")[c].alias(c) for c in rest],
            "copies",
            F.coalesce("_conflict", F.lit(False)).alias("conflicting"),
            (F.col("copies") > 1).alias("duplicate_timestamp"),
        )
    )


def deduplication_counts(deduplicated: DataFrame) -> DataFrame:
    return deduplicated.agg(
        F.count_if("duplicate_timestamp").alias("duplicate_groups"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows_removed"),
        F.count_if("conflicting").alias("conflicting_duplicate_groups"),
    )


def interface_series(records: DataFrame) -> DataFrame:
    return records.filter(
        F.col("ifindex").isNotNull() & F.col("canonical_metric").isin(*INTERFACE_METRICS)
    )


def device_series(records: DataFrame) -> DataFrame:
    return records.filter(F.col("canonical_metric").isin(*DEVICE_METRICS))


def host_identity(records: DataFrame) -> DataFrame:
    """Names and role of a host from its first record in (ifindex, clock, file) order."""
    order = F.struct(F.coalesce("ifindex", F.lit(-1)), F.col("clock"), F.col("ordinal"))
    return (
        records.groupBy("hostid")
        .agg(F.min_by(F.struct("host", "host_name", "device_role"), order).alias("identity"))
        .select("hostid", "identity.*")
    )


# --- cells and windows ----------------------------------------------------------------------------


def _transition_fields(series: Column, falls_only: bool) -> dict[str, Column]:
    """First and last value of a cell's ordered samples and the changes between them."""
    changed = (lambda a, b: b < a) if falls_only else (lambda a, b: b != a)
    size = F.size(series)
    later = F.slice(series, 2, F.greatest(size - 1, F.lit(0)))
    pairs = F.zip_with(F.slice(series, 1, F.greatest(size - 1, F.lit(0))), later,
                       lambda a, b: changed(a["value"], b["value"]))
    filled = size > 0
    return {
        "t_first": F.when(filled, F.element_at(series, 1)["value"]),
        "t_last": F.when(filled, F.element_at(series, -1)["value"]),
        "t_inner": F.when(filled, F.size(F.filter(pairs, lambda x: x))),
    }


def metric_cells(
    samples: DataFrame, key: Sequence[str], step: int, transition: str, falls_only: bool
) -> DataFrame:
    """Partial statistics per (entity, metric, cell); ``t`` is the first grid step that sees them."""
    value = F.col("value")
    seen = value.isNotNull()
    is_transition = (F.col("canonical_metric") == transition) & seen
    cells = samples.groupBy(
        *key, F.col("canonical_metric").alias("metric"), ceil_bucket(F.col("clock"), step).alias("t")
    ).agg(
        F.max("clock").alias("seen"),
        F.count(value).alias("n"),
        F.sum(value).alias("sum"),
        F.var_pop(value).alias("var"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.max(
            F.when(seen, F.struct("clock", (-F.col("ordinal")).alias("later"), "value"))
        )["value"].alias("last"),
        F.count_if(F.col("counter_reset")).alias("resets"),
        F.sum(
            F.when(
                F.col("counter_reset") & (F.col("raw_value") < F.col("previous_raw_value")),
                F.col("previous_raw_value") - F.col("raw_value"),
            )
        ).alias("reset_size"),
        # Bounded: at most the distinct (second, value) pairs of one grid step.
        F.sort_array(F.collect_set(F.when(is_transition, F.struct("clock", "value")))).alias("ts"),
    )
    fields = _transition_fields(F.col("ts"), falls_only)
    return cells.select(
        *key, "metric", "t", "seen", "n", "sum", "var", "min", "max", "last", "resets",
        "reset_size", *[c.alias(n) for n, c in fields.items()],
    )


def _slices(t: Column, grid: Grid) -> Column:
    """Slices whose rows can see a cell: its own and, near the end, the next one."""
    reach = 2 * grid.longest - grid.step
    return F.array_distinct(
        F.array(floor_bucket(t, grid.slice_width), floor_bucket(t + reach, grid.slice_width))
    )


# Codes of the windows: one per (metric, window, role) and one per marker column.
RECENT, BASELINE = "recent", "baseline"


def _roles(grid: Grid) -> list[tuple[int, str]]:
    return [(w, role) for w in grid.windows for role in (RECENT, BASELINE)]


def _codes(metrics: Sequence[str], grid: Grid) -> dict[tuple[str, int, str], int]:
    combos = [(m, w, role) for m in metrics for w, role in _roles(grid)]
    return {combo: code for code, combo in enumerate(combos)}


# Fields of a window's content, each never null, as a window without cells has them.
NOTHING = {
    "live": False, "n": 0, "last": 0.0, "mean": 0.0, "std": 0.0, "min": 0.0, "max": 0.0, "resets": 0, "reset_size": 0.0, "changes": 0,
}
# Those that a window without values does not have.
OF_VALUES = ("last", "mean", "std", "min", "max")

# Windows that hold something, counted at every grid point, that one task fills; what a task holds does not grow with the input.
# A task also generates the code of several hundred columns, which takes it seconds: it must have rows enough for that.
SPANS_PER_TASK = 1 << 20


def _window_rows(
    samples: DataFrame,
    key: Sequence[str],
    metrics: Sequence[str],
    grid: Grid,
    attributes: DataFrame,
    transition: str,
    falls_only: bool,
    markers: DataFrame | None = None,
) -> DataFrame:
    """Grid rows of every entity with merged window statistics, before derivation.

    A row has one column ``s<code>_<field>`` per code and field of ``NOTHING``, so that a reader of few columns has only their
    windows computed.  Cells are written first: their number says over how many tasks the far more numerous grid rows
    go.  ``attributes`` has one row per entity and is attached to every row.  ``markers`` are extra per-entity grid
    rows (``t`` plus value columns) that also count as observations.
    """
    step = grid.step
    cells = staging.materialise(metric_cells(samples, key, step, transition, falls_only), "cells")
    extra = [c for c in markers.columns if c not in (*key, "t")] if markers is not None else []
    seen_at = cells.select(*key, "seen", _slices(F.col("t"), grid).alias("_slices"))
    roles = _roles(grid)
    size = cells.count() * sum(-(-window // grid.bucket_sec) for window, _ in roles)
    if markers is not None:
        markers = staging.materialise(markers, "markers")
        size += markers.count() * len(extra)
        seen_at = seen_at.unionByName(markers.select(
            *key, F.col("t").alias("seen"), _slices(ceil_bucket(F.col("t"), step), grid).alias("_slices")
        ))
    tasks = max(1, -(-size // SPANS_PER_TASK))

    # The grid of an entity ends at its last observation.
    ends = seen_at.groupBy(*key).agg(F.max("seen").alias("_end"))
    described = (
        seen_at.select(*key, F.explode("_slices").alias("_slice")).distinct()
        .join(attributes.join(ends, list(key)), list(key)).repartition(tasks, *key, "_slice")
    )
    series = Window.partitionBy(*key, "_slice", "metric")
    # A cell whose samples are all null has no state; the change is against the last cell that has one.
    former = F.last("t_last", ignorenulls=True).over(
        series.orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    )
    crossed = F.col("t_first") < former if falls_only else F.col("t_first") != former
    placed = (
        cells.withColumn("_slice", F.explode(_slices(F.col("t"), grid)))
        .repartition(tasks, *key, "_slice")
        .withColumn("mean", F.col("sum") / F.nullif(F.col("n"), F.lit(0)))
        .select(
            "*",
            # A level close to the data keeps the merged squares free of cancellation.
            (F.col("mean") - F.avg("mean").over(series)).alias("off"),
            F.coalesce(crossed, F.lit(False)).cast("int").alias("t_join"),
        )
    )

    # A window's content when a cell enters it, and when that cell leaves it, for each length.
    edges = {
        f"{moment}{window}": reach
        for window in grid.windows
        for moment, reach in (("in", (step - window, 0)), ("out", (step, window)))
    }
    merged = placed.select(
        *key, "_slice", "metric", "t",
        *[
            c.alias(f"{edge}_{name}")
            for edge, reach in edges.items()
            for name, c in _merged(series.orderBy("t").rangeBetween(*reach)).items()
        ],
    )
    contents = merged.select(
        *key, "_slice", "metric", "t",
        *[c.alias(f"{edge}_{name}") for edge in edges for name, c in _content(edge).items()],
    )
    metric_number = F.array_position(F.array(*[F.lit(m) for m in metrics]), F.col("metric")) - 1
    turns = [(number, window, role, moment) for number, (window, role) in enumerate(roles) for moment in ("in", "out")]

    def at_turn(choices: Sequence[object]) -> Column:
        return F.expr(f"CASE _turn {' '.join(f'WHEN {k} THEN {c}' for k, c in enumerate(choices))} END")

    # The turn is a number and its fields are chosen one by one: those of a struct would all be computed.
    later = [(window if role == BASELINE else 0) + (window if moment == "out" else 0) for _, window, role, moment in turns]
    changes = contents.select("*", F.explode(F.array(*[F.lit(k) for k in range(len(turns))])).alias("_turn")).select(
        *key, "_slice", (F.col("t") + at_turn(later)).alias("t"),
        (metric_number * len(roles) + at_turn([number for number, *_ in turns])).cast("int").alias("code"),
        *[at_turn([f"{moment}{window}_{name}" for _, window, _, moment in turns]).alias(name) for name in NOTHING],
    )
    codes = list(range(len(metrics) * len(roles)))
    fields = [(f"s{code}_{name}", code, name) for code in codes for name in NOTHING]
    if markers is not None:
        marked = markers.select(
            *key, floor_bucket(F.col("t"), grid.slice_width).alias("_slice"), "t",
            F.struct(F.lit(True).alias("live"), *[F.col(c).cast("double").alias(c) for c in extra]).alias("mark"),
        )
        none = F.struct(F.lit(False).alias("live"), *[F.lit(None).cast("double").alias(c) for c in extra])
        gone = marked.withColumns({"t": F.col("t") + step, "mark": none})
        both = marked.unionByName(gone).withColumn("live", F.col("mark.live"))
        changes = changes.unionByName(both, allowMissingColumns=True).repartition(tasks, *key, "_slice")

    # Where two changes fall together they show the same content, but a marker may follow the end of another.
    along = f"PARTITION BY {', '.join(key)}, _slice ORDER BY t, live"

    def latest(change: str) -> Column:
        return F.expr(f"last({change}) IGNORE NULLS OVER ({along} ROWS UNBOUNDED PRECEDING)")

    wide = (
        changes.filter(F.col("t") < F.col("_slice") + grid.slice_width)
        .select(
            *key, "_slice", F.col("t").alias("_from"), F.expr(f"lead(t) OVER ({along})").alias("_next"),
            *[latest(f"CASE WHEN code = {code} THEN {name} END").alias(column) for column, code, name in fields],
            *[latest("mark").alias("mark") for _ in extra[:1]],
        )
    )
    alive = [f"s{code}_live" for (m, w, role), code in _codes(metrics, grid).items() if w == grid.longest and role == RECENT]
    alive += ["mark.live"] if markers is not None else []
    low = F.greatest(ceil_bucket(F.col("_from"), grid.bucket_sec), F.col("_slice"))
    high = F.least(F.col("_next") - 1, F.col("_slice") + grid.slice_width - 1, F.col("_end"))
    return (
        wide.filter(reduce(lambda a, b: a | b, [F.coalesce(F.col(c), F.lit(False)) for c in alive]))
        .join(described.hint("shuffle_hash"), [*key, "_slice"])
        .filter(low <= high)
        .select(
            *key, "_slice", F.explode(F.sequence(low, high, F.lit(grid.bucket_sec).cast("bigint"))).alias("t"),
            *[c for c in attributes.columns if c not in key],
            *[_known(code, name) for _, code, name in fields], *[F.col("mark")[c].alias(c) for c in extra],
        )
    )


def _known(code: int, name: str) -> Column:
    """A field of a window as it is seen: null for what only values give where there are none."""
    seen = f"CASE WHEN s{code}_n > 0 THEN s{code}_{name} END" if name in OF_VALUES else f"coalesce(s{code}_{name}, {NOTHING[name]})"
    return F.expr(seen).alias(f"s{code}_{name}")


def _merged(frame: WindowSpec) -> dict[str, Column]:
    """Sums, extremes and edges of the cells in a frame."""
    filled = F.col("n") > 0
    merged = {
        "cells": F.count(F.lit(1)),
        "n": F.sum("n"),
        "sum": F.sum("sum"),
        "min": F.min("min"),
        "max": F.max("max"),
        "last": F.max_by("last", F.when(F.col("last").isNotNull(), F.col("t"))),
        "inside": F.sum(F.col("var") * F.col("n")),
        "between": F.var_pop("mean"),
        "least": F.min(F.when(filled, F.col("n"))),
        "most": F.max(F.when(filled, F.col("n"))),
        "off1": F.sum(F.col("n") * F.col("off")),
        "off2": F.sum(F.col("n") * F.col("off") * F.col("off")),
        "resets": F.sum("resets"),
        "reset_size": F.sum("reset_size"),
        "turns": F.sum(F.col("t_inner") + F.col("t_join")),
        "entry": F.min_by("t_join", F.when(F.col("t_inner").isNotNull(), F.col("t"))),
    }
    return {name: c.over(frame) for name, c in merged.items()}


def _content(edge: str) -> dict[str, Column]:
    """The statistics of a window from its merged cells."""
    zero = F.lit(0)
    n = F.col(f"{edge}_n")
    found = {
        "live": F.col(f"{edge}_cells") > 0,
        "n": n,
        "last": F.col(f"{edge}_last"),
        "mean": F.col(f"{edge}_sum") / F.nullif(n, zero),
        "std": _spread(edge),
        "min": F.col(f"{edge}_min"),
        "max": F.col(f"{edge}_max"),
        "resets": F.col(f"{edge}_resets"),
        "reset_size": F.col(f"{edge}_reset_size"),
        "changes": F.coalesce(F.col(f"{edge}_turns"), zero) - F.coalesce(F.col(f"{edge}_entry"), zero),
    }
    return {name: F.coalesce(found[name], F.lit(nothing)) for name, nothing in NOTHING.items()}


def _spread(edge: str) -> Column:
    """Population standard deviation of a window from its merged cells.

    Cells of equal size need only the variance of their means; unequal cells use squares around a
    nearby level.  A constant window is exactly zero.
    """
    n, off1 = F.col(f"{edge}_n"), F.col(f"{edge}_off1")
    uneven = F.greatest(F.col(f"{edge}_off2") - off1 * off1 / n, F.lit(0.0))
    even = F.col(f"{edge}_least") == F.col(f"{edge}_most")
    between = F.when(even, n * F.col(f"{edge}_between")).otherwise(uneven)
    return F.when(
        n > 0,
        F.when(F.col(f"{edge}_min") == F.col(f"{edge}_max"), 0.0).otherwise(F.sqrt((F.col(f"{edge}_inside") + between) / n)),
    )


def _statistics(rows: DataFrame, keep: Sequence[str], metrics: Sequence[str], grid: Grid,
                transition: str) -> DataFrame:
    """Name the seven recent and three baseline statistics per metric and window, plus presence."""
    codes = _codes(metrics, grid)
    zero = F.lit(0)
    out: list[Column] = []
    for window in grid.windows:
        s = grid.suffix(window)
        for m in metrics:
            r, b = codes[m, window, RECENT], codes[m, window, BASELINE]
            name, base = f"{m}_{s}", f"{m}_baseline"

            out += [
                F.col(f"s{r}_last").alias(f"{name}_last"),
                F.col(f"s{r}_mean").alias(f"{name}_mean"),
                F.col(f"s{r}_std").alias(f"{name}_std"),
                F.col(f"s{r}_min").alias(f"{name}_min"),
                F.col(f"s{r}_max").alias(f"{name}_max"),
                F.col(f"s{r}_n").alias(f"{name}_count"),
                (F.col(f"s{r}_max") - F.col(f"s{r}_min")).alias(f"{name}_range"),
                F.col(f"s{b}_mean").alias(f"{base}_mean_{s}"),
                F.col(f"s{b}_std").alias(f"{base}_std_{s}"),
                F.col(f"s{b}_n").alias(f"{base}_count_{s}"),
            ]
        for label, role in (("", RECENT), ("baseline_", BASELINE)):
            present = [F.col(f"s{codes[m, window, role]}_live").cast("int") for m in metrics]
            out.append(
                reduce(lambda a, b: a + b, present).alias(f"{label}metric_presence_count_{s}")
            )
        discards = [codes[m, window, RECENT] for m in DISCARD_METRICS if m in metrics]
        for field, empty in (("resets", zero), ("reset_size", F.lit(0.0))):
            parts = [F.col(f"s{c}_{field}") for c in discards] or [empty]
            out.append(reduce(lambda a, b: a + b, parts).alias(f"{field}_{s}"))
        t = codes[transition, window, RECENT]
        out.append(F.col(f"s{t}_changes").alias(f"changes_{s}"))
    return rows.select(*keep, *out)


def coverage(s: str) -> list[Column]:
    """Expected, missing and ratio next to the presence counts; ratio is null when nothing is due."""
    expected = F.col("expected_count")
    out = []
    for lead in ("", "baseline_"):
        present = F.col(f"{lead}metric_presence_count_{s}")
        out += [
            expected.alias(f"{lead}metric_expected_count_{s}"),
            F.greatest(expected - present, F.lit(0)).alias(f"{lead}metric_missing_count_{s}"),
            F.when(expected > 0, present / expected).alias(f"{lead}metric_coverage_ratio_{s}"),
        ]
    return out


def behaviour(recent: Column, base: Column, prefix: str) -> list[Column]:
    """Change of the recent mean against the baseline mean; flags are 0 when either is unknown."""
    change = recent - base
    usable = F.abs(base) > EPSILON
    return [
        change.alias(f"{prefix}_change"),
        F.when(usable, change / F.abs(base)).alias(f"{prefix}_change_pct"),
        F.when(usable, recent / base).alias(f"{prefix}_recent_to_baseline_ratio"),
        F.coalesce(change > 0, F.lit(False)).cast("int").alias(f"{prefix}_increase_flag"),
        F.coalesce(change < 0, F.lit(False)).cast("int").alias(f"{prefix}_decrease_flag"),
    ]


def _identity(key: Sequence[str], entity_type: str) -> list[Column]:
    return [
        iso_utc(F.col("t")).alias("@timestamp"),
        F.col("t").alias("timestamp"),
        *[F.col(k) for k in key],
        F.coalesce("host", F.lit("")).alias("host"),
        F.coalesce("host_name", F.lit("")).alias("host_name"),
        F.coalesce("device_role", F.lit("")).alias("device_role"),
        F.lit(entity_type).alias("entity_type"),
    ]


IDENTITY_COLUMNS = ("@timestamp", "timestamp", "host", "host_name", "device_role", "entity_type")


def interface_features(
    records: DataFrame, metrics: DataFrame | None = None, grid: Grid = Grid()
) -> DataFrame:
    """One row per interface and grid point that has data in the longest window.

    ``records`` is deduplicated history; ``metrics`` (scoped metadata) gives the expected metric
    counts, which fall back to the metrics an interface was observed to deliver.
    """
    samples = interface_series(records)
    observed = samples.groupBy(*INTERFACE_KEY).agg(
        F.countDistinct("canonical_metric").alias("observed_count")
    )
    if metrics is not None:
        expected = expected_counts(metrics, "interface")
        observed = observed.join(expected, list(INTERFACE_KEY), "left")
    else:
        observed = observed.withColumn("expected_count", F.lit(None).cast("bigint"))
    attributes = observed.select(
        *INTERFACE_KEY, F.coalesce("expected_count", "observed_count").alias("expected_count")
    ).join(host_identity(records), "hostid", "left")
    rows = _window_rows(
        samples, INTERFACE_KEY, INTERFACE_METRICS, grid, attributes, "oper_status", False
    )
    keep = [*INTERFACE_KEY, "t", "host", "host_name", "device_role", "expected_count"]
    stats = _statistics(rows, keep, INTERFACE_METRICS, grid, "oper_status")

    derived: list[Column] = []
    for window in grid.windows:
        s = grid.suffix(window)
        resets = F.col(f"resets_{s}")
        size = F.col(f"reset_size_{s}") if grid.carry_reset_context else F.lit(0.0)
        derived += [
            resets.alias(f"counter_reset_count_{s}"),
            (resets > 0).cast("int").alias(f"counter_reset_flag_{s}"),
            F.when(resets > 0, size).alias(f"counter_reset_raw_context_sum_{s}"),
            F.col(f"changes_{s}").alias(f"oper_status_change_count_{s}"),
            (F.col(f"changes_{s}") > 0).cast("int").alias(f"oper_status_change_flag_{s}"),
            *coverage(s),
        ]
        for name, (a, b) in TOTALS.items():
            derived += [
                (F.col(f"{a}_{s}_mean") + F.col(f"{b}_{s}_mean")).alias(f"{name}_{s}"),
                (F.col(f"{a}_baseline_mean_{s}") + F.col(f"{b}_baseline_mean_{s}")).alias(
                    f"{name}_baseline_mean_{s}"
                ),
            ]
        derived += [
            guarded_ratio(F.col(f"{a}_{s}_mean"), F.col(f"{b}_{s}_mean")).alias(f"{name}_{s}")
            for name, (a, b) in RATIOS.items()
        ]
    short = grid.short
    derived += [
        F.sqrt(
            F.col(f"in_bps_{short}_std") * F.col(f"in_bps_{short}_std")
            + F.col(f"out_bps_{short}_std") * F.col(f"out_bps_{short}_std")
        ).alias(f"traffic_variability_{short}"),
        F.col(f"oper_status_{short}_last").alias("oper_status_last"),
    ]
    totals = stats.select("*", *derived)

    compared: list[Column] = []
    for window in grid.windows:
        s = grid.suffix(window)
        for m in INTERFACE_BEHAVIOUR:
            compared += behaviour(
                F.col(f"{m}_{s}_mean"), F.col(f"{m}_baseline_mean_{s}"), f"{m}_behavior_{s}"
            )
        for name in TOTALS:
            compared += behaviour(
                F.col(f"{name}_{s}"), F.col(f"{name}_baseline_mean_{s}"), f"{name}_behavior_{s}"
            )
    compared.append(
        guarded_ratio(
            F.col(f"traffic_variability_{short}"), F.col(f"traffic_total_bps_{short}")
        ).alias(f"traffic_cv_{short}")
    )
    working = {*keep, *[f"{c}_{grid.suffix(w)}" for w in grid.windows
                        for c in ("resets", "reset_size", "changes")]}
    named = [c for c in totals.columns if c not in working]
    return totals.select(*_identity(INTERFACE_KEY, "interface"), *named, *compared)


def aggregate_interfaces(features: DataFrame, short: str) -> DataFrame:
    """Interface rows of a host at the same grid point, folded into thirteen device columns."""
    status = F.col("oper_status_last")
    out = [
        F.count(F.lit(1)).alias("interface_count"),
        F.count_if(status.isNotNull() & (status != 1.0)).alias("interfaces_with_oper_down"),
    ]
    for name in ("traffic_total_bps", "packet_total_pps"):
        col = finite(F.col(f"{name}_{short}"))
        out += [
            F.sum(col).alias(f"{name}_sum"),
            F.avg(col).alias(f"{name}_mean"),
            F.max(col).alias(f"{name}_max"),
        ]
    for name in ("error_total_rate", "discard_total_rate"):
        col = finite(F.col(f"{name}_{short}"))
        out += [F.sum(col).alias(f"{name}_sum"), F.max(col).alias(f"{name}_max")]
    out.append(
        F.count_if(F.col(f"counter_reset_flag_{short}") == 1).alias("interfaces_with_counter_reset")
    )
    return features.groupBy("hostid", F.col("timestamp").alias("t")).agg(*out)


def device_features(
    records: DataFrame,
    interface_rows: DataFrame,
    metrics: DataFrame | None = None,
    grid: Grid = Grid(),
) -> DataFrame:
    """One row per device and grid point with health data in reach or interface rows at that point."""
    samples = device_series(records)
    aggregates = aggregate_interfaces(interface_rows, grid.short)
    identity = host_identity(records)
    if metrics is not None:
        identity = identity.join(expected_counts(metrics, "device"), "hostid", "left")
    else:
        identity = identity.withColumn("expected_count", F.lit(None).cast("bigint"))
    attributes = identity.withColumn("expected_count", F.coalesce("expected_count", F.lit(0)))
    rows = _window_rows(
        samples, DEVICE_KEY, DEVICE_METRICS, grid, attributes, "uptime", True, aggregates
    )
    keep = ["hostid", "t", "host", "host_name", "device_role", "expected_count",
            *INTERFACE_AGGREGATES]
    stats = _statistics(rows, keep, DEVICE_METRICS, grid, "uptime")

    derived: list[Column] = []
    for window in grid.windows:
        s = grid.suffix(window)
        last, least = F.col(f"uptime_{s}_last"), F.col(f"uptime_{s}_min")
        fell = F.col(f"changes_{s}") > 0 if grid.detect_uptime_falls else last < least
        derived += [
            *coverage(s),
            (last - least).alias(f"uptime_growth_sec_{s}"),
            F.coalesce(fell, F.lit(False)).cast("int").alias(f"uptime_reset_flag_{s}"),
        ]
        for m in DEVICE_BEHAVIOUR:
            derived += behaviour(
                F.col(f"{m}_{s}_mean"), F.col(f"{m}_baseline_mean_{s}"), f"{m}_behavior_{s}"
            )
    counts = ("interface_count", "interfaces_with_oper_down", "interfaces_with_counter_reset")
    aggregated = [
        F.coalesce(F.col(c).cast("bigint"), F.lit(0)).alias(c) if c in counts else F.col(c)
        for c in INTERFACE_AGGREGATES
    ]
    flags = [F.col(c).isNotNull().cast("int").alias(f"{c}_present") for c in DEVICE_SUMS]
    working = {*keep, *[f"{c}_{grid.suffix(w)}" for w in grid.windows
                        for c in ("resets", "reset_size", "changes")]}
    named = [c for c in stats.columns if c not in working]
    return stats.select(
        *_identity(DEVICE_KEY, "device"), *named, *derived, *aggregated, *flags
    )


# --- audit ----------------------------------------------------------------------------------------


def feature_columns(features: DataFrame) -> list[str]:
    return [c for c in features.columns if c not in (*IDENTITY_COLUMNS, *INTERFACE_KEY)]


def feature_audit(features: DataFrame, key: Sequence[str], short: str) -> DataFrame:
    """Row, entity and feature counts, coverage statistics and context rows in one pass."""
    columns = feature_columns(features)
    recent = F.col(f"metric_coverage_ratio_{short}")
    base = F.col(f"baseline_metric_coverage_ratio_{short}")
    present = added([finite(F.col(f"`{c}`").cast("double")).isNotNull().cast("int") for c in columns])
    flags = {
        "rows_with_counter_reset": f"counter_reset_flag_{short}",
        "rows_with_status_change": f"oper_status_change_flag_{short}",
        "rows_with_uptime_reset": f"uptime_reset_flag_{short}",
    }
    return features.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(F.struct(*key)).alias("entities"),
        F.lit(len(columns)).alias("feature_columns"),
        *[
            fn(col).alias(f"{label}_coverage_{stat}")
            for label, col in (("recent", recent), ("baseline", base))
            for stat, fn in (("mean", F.avg), ("min", F.min), ("max", F.max))
        ],
        F.count_if(F.coalesce(base, F.lit(0.0)) == 0).alias("warmup_rows"),
        *[F.count_if(F.col(c) == 1).alias(n) for n, c in flags.items() if c in features.columns],
        F.avg(present).alias("mean_finite_features"),
    )
