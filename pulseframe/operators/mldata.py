"""Quality-gated, chronologically split, imputed and z-scored matrices from a feature table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from pulseframe.functions.scalars import finite, floor_bucket, is_finite, tagged
from pulseframe.operators.quantiles import exact_percentiles
from pulseframe.operators.timeline import DAY_SEC

# Identifiers, quality fields and the feature contract, named for 5 and 15 minute windows.
IDENTIFIER_FIELDS = (
    "@timestamp",
    "timestamp",
    "hostid",
    "host",
    "host_name",
    "device_role",
    "ifindex",
    "entity_type",
    "training_eligible",
    "ml_eligible",
    "feature_row_id",
)
QUALITY_FIELDS = (
    "metric_presence_count_5m",
    "metric_expected_count_5m",
    "metric_missing_count_5m",
    "metric_coverage_ratio_5m",
    "baseline_metric_coverage_ratio_5m",
    "metric_presence_count_15m",
    "metric_expected_count_15m",
    "metric_missing_count_15m",
    "metric_coverage_ratio_15m",
    "counter_reset_count_5m",
    "counter_reset_flag_5m",
    "counter_reset_raw_context_sum_5m",
    "counter_reset_count_15m",
    "counter_reset_flag_15m",
    "counter_reset_raw_context_sum_15m",
    "oper_status_change_count_5m",
    "oper_status_change_flag_5m",
    "oper_status_change_count_15m",
    "oper_status_change_flag_15m",
    "uptime_reset_flag_5m",
    "uptime_reset_flag_15m",
)
CONTRACT = (
    "in_bps_5m_mean",
    "out_bps_5m_mean",
    "in_pps_5m_mean",
    "out_pps_5m_mean",
    "in_error_rate_5m_mean",
    "out_error_rate_5m_mean",
    "in_discard_rate_5m_mean",
    "out_discard_rate_5m_mean",
    "traffic_total_bps_5m",
    "packet_total_pps_5m",
    "error_total_rate_5m",
    "discard_total_rate_5m",
    "in_out_bps_ratio_5m",
    "in_out_pps_ratio_5m",
    "traffic_variability_5m",
    "oper_status_last",
    "in_bps_15m_mean",
    "out_bps_15m_mean",
    "in_pps_15m_mean",
    "out_pps_15m_mean",
    "in_error_rate_15m_mean",
    "out_error_rate_15m_mean",
    "in_discard_rate_15m_mean",
    "out_discard_rate_15m_mean",
    "traffic_total_bps_15m",
    "packet_total_pps_15m",
    "error_total_rate_15m",
    "discard_total_rate_15m",
    "in_out_bps_ratio_15m",
    "in_out_pps_ratio_15m",
    "in_bps_behavior_5m_change",
    "in_bps_behavior_5m_change_pct",
    "in_bps_behavior_5m_recent_to_baseline_ratio",
    "out_bps_behavior_5m_change",
    "out_bps_behavior_5m_change_pct",
    "out_bps_behavior_5m_recent_to_baseline_ratio",
    "in_pps_behavior_5m_change",
    "in_pps_behavior_5m_change_pct",
    "in_pps_behavior_5m_recent_to_baseline_ratio",
    "out_pps_behavior_5m_change",
    "out_pps_behavior_5m_change_pct",
    "out_pps_behavior_5m_recent_to_baseline_ratio",
    "error_total_rate_behavior_5m_change",
    "error_total_rate_behavior_5m_change_pct",
    "error_total_rate_behavior_5m_recent_to_baseline_ratio",
    "discard_total_rate_behavior_5m_change",
    "discard_total_rate_behavior_5m_change_pct",
    "discard_total_rate_behavior_5m_recent_to_baseline_ratio",
    "traffic_total_bps_behavior_5m_change",
    "traffic_total_bps_behavior_5m_change_pct",
    "traffic_total_bps_behavior_5m_recent_to_baseline_ratio",
    "packet_total_pps_behavior_5m_change",
    "packet_total_pps_behavior_5m_change_pct",
    "packet_total_pps_behavior_5m_recent_to_baseline_ratio",
    "cpu_pct_5m_mean",
    "memory_pct_5m_mean",
    "temperature_c_5m_mean",
    "icmp_loss_pct_5m_mean",
    "icmp_rtt_sec_5m_mean",
    "uptime_growth_sec_5m",
    "cpu_pct_15m_mean",
    "memory_pct_15m_mean",
    "temperature_c_15m_mean",
    "icmp_loss_pct_15m_mean",
    "icmp_rtt_sec_15m_mean",
    "uptime_growth_sec_15m",
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
GATE_REASONS = (
    "missing_recent_coverage",
    "recent_coverage_below_threshold",
    "missing_baseline_coverage",
    "baseline_coverage_below_threshold",
    "no_previous_window_baseline",
)


@dataclass(frozen=True)
class MatrixSettings:
    recent_coverage: float = 0.80
    baseline_coverage: float = 0.80
    inference_fraction: float = 0.20
    min_presence: float = 0.80
    short: str = "5m"
    long: str = "15m"

    def named(self, names: Sequence[str]) -> list[str]:
        """Names for the actual window lengths."""
        return [n.replace("_15m", f"_{self.long}").replace("_5m", f"_{self.short}") for n in names]

    @property
    def fraction(self) -> float:
        return min(max(self.inference_fraction, 0.05), 0.50)


def gate(rows: DataFrame, settings: MatrixSettings) -> DataFrame:
    """Add the reasons a row is not eligible; several may apply."""
    recent = finite(F.col(f"metric_coverage_ratio_{settings.short}"))
    base = finite(F.col(f"baseline_metric_coverage_ratio_{settings.short}"))
    conditions = (
        recent.isNull(),
        recent < settings.recent_coverage,
        base.isNull(),
        base < settings.baseline_coverage,
        base.isNull() | (base <= 0),
    )
    reasons = tagged([(c, F.lit(r)) for c, r in zip(conditions, GATE_REASONS)])
    # Said without the array, for a filter on it is moved down to where the ratios are formulas: compared once each.
    passes = (recent >= settings.recent_coverage) & (base >= settings.baseline_coverage) & (base > 0)
    return rows.withColumns(
        {"reasons": reasons, "training_eligible": F.coalesce(passes, F.lit(False)).cast("int")}
    )


def gate_counts(gated: DataFrame) -> DataFrame:
    """Rows per reason that occurs; the reasons are not exploded, as that adds a filter on them."""
    counts = gated.agg(*[F.count_if(F.array_contains("reasons", r)).alias(r) for r in GATE_REASONS])
    return counts.unpivot([], list(GATE_REASONS), "reason", "rows").filter("rows > 0")


def candidate_columns(rows: DataFrame, settings: MatrixSettings) -> list[str]:
    """Numeric columns that are neither identifiers nor quality fields (booleans and texts are not)."""
    barred = {*IDENTIFIER_FIELDS, *settings.named(QUALITY_FIELDS), "reasons"}
    numeric = {"double", "float", "long", "integer", "bigint", "int", "short", "byte"}
    return [
        f.name
        for f in rows.schema.fields
        if f.name not in barred and f.dataType.typeName() in numeric
    ]


def feature_presence(eligible: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Finite count per candidate column as rows (feature, present, rows); one aggregation."""
    counts = eligible.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(is_finite(F.col(f"`{c}`").cast("double"))).alias(c) for c in columns],
    )
    return counts.unpivot("_rows", list(columns), "feature", "present").withColumnRenamed(
        "_rows", "rows"
    ).filter("present > 0")


@dataclass
class Selection:
    features: list[str]
    missing_contract: list[str]
    excluded: dict[str, dict]
    presence: dict[str, int]
    rows: int


def choose_features(presence: DataFrame, settings: MatrixSettings) -> Selection:
    """Contract members present often enough.  Reads one row per column, never data rows."""
    counted = {r["feature"]: r["present"] for r in presence.collect()}
    rows = next((r["rows"] for r in presence.take(1)), 0)
    contract = settings.named(CONTRACT)
    share = {f: (n / rows if rows else 0.0) for f, n in counted.items()}
    excluded = {
        f: {"reason": "below_min_presence", "presence": counted[f], "presence_ratio": share[f]}
        for f in sorted(counted)
        if share[f] < settings.min_presence
    }
    return Selection(
        features=sorted(f for f in contract if f in counted and f not in excluded),
        missing_contract=sorted(f for f in contract if f not in counted),
        excluded=excluded,
        presence=counted,
        rows=rows,
    )


def order_key(rows: DataFrame) -> list[Column]:
    """Chronological total order: timestamp, then host and interface as text."""
    interface = F.col("ifindex").cast("string") if "ifindex" in rows.columns else F.lit("")
    return [
        F.coalesce(F.col("timestamp").cast("bigint"), F.lit(0)),
        F.coalesce(F.col("hostid").cast("string"), F.lit("")),
        F.coalesce(interface, F.lit("")),
    ]


def cut_position(count: int, settings: MatrixSettings) -> int:
    cut = int(count * (1.0 - settings.fraction))
    return min(max(cut, 1), count - 1) if count >= 2 else cut


def last_training_key(eligible: DataFrame, settings: MatrixSettings) -> Row | None:
    """Key of the last training row, found without a global sort of the rows.

    Counts per timestamp give the timestamp that holds the cut, counts per host at that timestamp the
    host, and only that host's rows at that timestamp are ranked.  Three small aggregations.
    """
    timestamp, host, interface = order_key(eligible)
    keyed = eligible.select(
        timestamp.alias("timestamp"), host.alias("hostid"), interface.alias("interface")
    )
    cut = cut_position(keyed.count(), settings)
    if cut <= 0:
        return None

    def locate(counts: DataFrame, by: str, target: int) -> Row:
        running = counts.withColumn("upto", F.sum("rows").over(Window.orderBy(by)))
        return running.filter(F.col("upto") >= target).orderBy(by).first()

    rows = F.count(F.lit(1)).alias("rows")
    days = keyed.groupBy(floor_bucket(F.col("timestamp"), DAY_SEC).alias("day")).agg(rows)
    day = locate(days, "day", cut)
    cut -= day["upto"] - day["rows"]
    in_day = keyed.filter(floor_bucket(F.col("timestamp"), DAY_SEC) == day["day"])
    point = locate(in_day.groupBy("timestamp").agg(rows), "timestamp", cut)
    cut -= point["upto"] - point["rows"]
    at_point = in_day.filter(F.col("timestamp") == point["timestamp"])
    owner = locate(at_point.groupBy("hostid").agg(rows), "hostid", cut)
    cut -= owner["upto"] - owner["rows"]
    mine = at_point.filter(F.col("hostid") == owner["hostid"])
    return mine.withColumn(
        "rank", F.row_number().over(Window.orderBy("interface"))
    ).filter(F.col("rank") == cut).drop("rank").first()


def with_split(
    eligible: DataFrame, settings: MatrixSettings, split_on: str = "position"
) -> DataFrame:
    """Label rows ``train`` or ``inference``.

    ``position`` cuts at an exact row count, possibly inside a timestamp; ``timestamp`` keeps all rows
    of the cut's timestamp on the inference side.
    """
    last = last_training_key(eligible, settings)
    if last is None:
        return eligible.withColumn("split", F.lit("inference"))
    timestamp, host, interface = order_key(eligible)
    if split_on == "timestamp":
        training = timestamp < last["timestamp"]
    else:
        training = (timestamp < last["timestamp"]) | (
            (timestamp == last["timestamp"])
            & (
                (host < last["hostid"])
                | ((host == last["hostid"]) & (interface <= last["interface"]))
            )
        )
    return eligible.withColumn("split", F.when(training, "train").otherwise("inference"))


@dataclass
class Scaling:
    medians: dict[str, float] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    stds: dict[str, float] = field(default_factory=dict)


def column(name: str) -> Column:
    return finite(F.col(f"`{name}`").cast("double"))


def medians(train: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Exact median of the finite values per feature; 0.0 when there are none."""
    if not features:
        return {}
    long = train.select(*[column(f).alias(f) for f in features]).unpivot(
        [], list(features), "feature", "value"
    )
    found = exact_percentiles(long, ["feature"], "value", {"median": 0.5}).collect()
    known = {r["feature"]: r["median"] for r in found}
    return {f: float(known.get(f, 0.0)) for f in features}


def imputed(name: str, median: dict[str, float]) -> Column:
    return F.coalesce(column(name), F.lit(median[name]))


def fit(train: DataFrame, features: Sequence[str]) -> Scaling:
    """Training-only median, then mean and population deviation after imputation."""
    middle = medians(train, features)
    if not features:
        return Scaling()
    row = train.agg(
        *[F.avg(imputed(f, middle)).alias(f"mean_{i}") for i, f in enumerate(features)],
        *[F.stddev_pop(imputed(f, middle)).alias(f"std_{i}") for i, f in enumerate(features)],
    ).first()
    means, stds = {}, {}
    for i, f in enumerate(features):
        mean, std = row[f"mean_{i}"], row[f"std_{i}"]
        usable = std is not None and 1e-12 <= std < float("inf")
        means[f] = float(mean) if mean is not None else 0.0
        stds[f] = float(std) if usable else 1.0
    return Scaling(middle, means, stds)


def transform(rows: DataFrame, features: Sequence[str], scaling: Scaling,
              keep: Sequence[str] = ()) -> DataFrame:
    """Impute and z-score; anything not finite becomes 0.0."""
    return rows.select(
        *keep,
        *[
            F.coalesce(
                finite(
                    (imputed(f, scaling.medians) - F.lit(scaling.means[f]))
                    / F.lit(scaling.stds[f])
                ),
                F.lit(0.0),
            ).alias(f)
            for f in features
        ],
    )


@dataclass
class Dataset:
    """Everything a matrix writer needs; the frames are lazy."""

    entity_type: str
    features: list[str]
    scaling: Scaling
    selection: Selection
    gated: DataFrame
    labelled: DataFrame
    settings: MatrixSettings

    def matrix(self, split: str, keep: Sequence[str] = ()) -> DataFrame:
        rows = self.labelled.filter(F.col("split") == split)
        return transform(rows, self.features, self.scaling, keep)


def build_dataset(
    rows: DataFrame, entity_type: str, settings: MatrixSettings = MatrixSettings(),
    split_on: str = "position",
) -> Dataset:
    """Gate, choose, split and fit.  ``rows`` should be a written feature table: it is read five times,
    each time only for the columns of that step."""
    gated = gate(rows, settings)
    eligible = gated.filter("training_eligible = 1")
    selection = choose_features(
        feature_presence(eligible, candidate_columns(eligible, settings)), settings
    )
    labelled = with_split(eligible, settings, split_on)
    scaling = fit(labelled.filter(F.col("split") == "train"), selection.features)
    return Dataset(
        entity_type, selection.features, scaling, selection, gated, labelled, settings
    )


def split_metadata(dataset: Dataset, split: str) -> dict:
    """Metadata document of one split."""
    totals = dataset.labelled.agg(
        F.count(F.lit(1)).alias("all"),
        F.count_if(F.col("split") == split).alias("rows"),
        F.min(F.when(F.col("split") == split, F.col("timestamp"))).alias("first"),
        F.max(F.when(F.col("split") == split, F.col("timestamp"))).alias("last"),
    ).first()
    scaling = dataset.scaling
    return {
        "entity_type": dataset.entity_type,
        "split": split,
        "row_count": totals["rows"],
        "source_row_count": totals["all"],
        "features": dataset.features,
        "feature_count": len(dataset.features),
        "timestamp_range": {"min": totals["first"], "max": totals["last"]},
        "imputation": {"method": "median", "medians": scaling.medians},
        "scaling": {
            "method": "zscore",
            "parameters": {
                f: {"mean": scaling.means[f], "std": scaling.stds[f]} for f in dataset.features
            },
        },
        "excluded_fields": sorted(
            {*IDENTIFIER_FIELDS, *dataset.settings.named(QUALITY_FIELDS)}
        ),
    }


def dataset_audit(dataset: Dataset) -> dict:
    """Counts, gate reasons and the feature selection of one entity type."""
    reasons = {r["reason"]: r["rows"] for r in gate_counts(dataset.gated).collect()}
    totals = dataset.gated.agg(
        F.count(F.lit(1)).alias("rows"), F.sum("training_eligible").alias("eligible")
    ).first()
    splits = {
        r["split"]: r["count"] for r in dataset.labelled.groupBy("split").count().collect()
    }
    settings, selection = dataset.settings, dataset.selection
    eligible = totals["eligible"] or 0
    return {
        "entity_type": dataset.entity_type,
        "source_rows": totals["rows"],
        "eligible_rows": eligible,
        "excluded_rows": totals["rows"] - eligible,
        "training_rows": splits.get("train", 0),
        "inference_rows": splits.get("inference", 0),
        "feature_count": len(dataset.features),
        "features": dataset.features,
        "quality_gate": {
            "recent_coverage_min": settings.recent_coverage,
            "baseline_coverage_min": settings.baseline_coverage,
            "excluded_reason_counts": reasons,
        },
        "feature_selection": {
            "rows": selection.rows,
            "candidate_numeric_features": len(selection.presence),
            "selected_features": len(selection.features),
            "min_presence": settings.min_presence,
            "missing_contract_features": selection.missing_contract,
            "excluded_feature_count": len(selection.excluded),
            "excluded": selection.excluded,
        },
        "preprocessing": {
            "imputation": "median", "scaling": "zscore", "fit_on": "training_rows_only",
        },
    }


def feature_schema(datasets: Sequence[Dataset]) -> dict:
    """Schema document shared by training and scoring jobs."""
    settings = datasets[0].settings
    return {
        "version": "1.0",
        "entity_models": {d.entity_type: {"features": d.features} for d in datasets},
        "quality_gate": {
            "recent_coverage_min": settings.recent_coverage,
            "baseline_coverage_min": settings.baseline_coverage,
            "warmup_rows_excluded_from_training": True,
        },
        "preprocessing": {
            "missing_values": {"method": "median", "fit_scope": "training_rows_only"},
            "scaling": {"method": "zscore", "fit_scope": "training_rows_only"},
        },
    }
