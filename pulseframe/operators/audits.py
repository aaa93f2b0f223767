"""Data tests on transformed history: structure, order, recomputation and raw preservation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.functions.scalars import close_to, finite, floor_bucket, is_finite, same_number, tagged
from pulseframe.operators.quantiles import distribution
from pulseframe.operators.semantics import expected_transformation
from pulseframe.operators.timeline import attach_clock_context, with_neighbours

# Issue severities and the required fields of a transformed record.
SEVERITIES = {
    "record_count_mismatch": "critical",
    "missing_field": "high",
    "wrong_transformation": "critical",
    "invalid_clock": "high",
    "duplicate_timestamp": "high",
    "out_of_order": "high",
    "first_counter_sample_has_value": "high",
    "first_counter_sample_has_delta": "high",
    "invalid_delta_time": "high",
    "non_numeric_counter_raw_value": "high",
    "decrease_without_reset_flag": "critical",
    "reset_has_rate_value": "critical",
    "reset_has_delta_value": "high",
    "delta_value_mismatch": "critical",
    "delta_time_mismatch": "critical",
    "rate_formula_mismatch": "critical",
    "increase_marked_as_reset": "high",
    "increase_missing_rate": "critical",
    "unchanged_delta_mismatch": "high",
    "unchanged_rate_mismatch": "high",
    "unchanged_marked_as_reset": "high",
    "negative_rate": "critical",
    "direct_value_mismatch": "critical",
    "non_finite_value": "critical",
    "missing_raw_record": "critical",
    "multiple_raw_records": "high",
    "raw_value_mismatch": "critical",
}
REQUIRED_FIELDS = (
    "itemid",
    "clock",
    "value",
    "semantic_type",
    "transformation",
    "canonical_metric",
)
ORDINAL_SLICE = 1_000_000


def issues_of(rows: DataFrame, checks: Sequence[tuple[str, Column]]) -> DataFrame:
    """One row per (record, broken check), from a single pass."""
    found = tagged([(F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in checks])
    return rows.select("itemid", "clock", "ordinal", F.explode(found).alias("issue"))


def with_severity(issues: DataFrame) -> DataFrame:
    pairs = [F.lit(x) for pair in SEVERITIES.items() for x in pair]
    return issues.withColumn("severity", F.try_element_at(F.create_map(*pairs), F.col("issue")))


def count_mismatch(raw: DataFrame, transformed: DataFrame) -> DataFrame:
    """Record totals of both stages; ``matches`` must be true."""
    one, none = F.lit(1), F.lit(0)
    return (
        raw.select(one.alias("r"), none.alias("t"))
        .unionAll(transformed.select(none.alias("r"), one.alias("t")))
        .agg(
            F.coalesce(F.sum("r"), none).alias("raw_records"),
            F.coalesce(F.sum("t"), none).alias("transformed_records"),
        )
        .withColumn("matches", F.col("raw_records") == F.col("transformed_records"))
    )


def missing_fields(lines: DataFrame, text: str = "value",
                   required: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """Required keys absent from a JSON object line (a key holding null is present)."""
    keys = F.coalesce(F.json_object_keys(text), F.array().cast("array<string>"))
    return lines.withColumn(
        "missing", F.array_except(F.array(*[F.lit(f) for f in required]), keys)
    ).filter(F.size("missing") > 0)


def transformation_issues(transformed: DataFrame) -> DataFrame:
    wanted = expected_transformation(F.col("semantic_type"))
    wrong = wanted.isNotNull() & ~F.col("transformation").eqNullSafe(wanted)
    return issues_of(transformed, [("wrong_transformation", wrong)])


def order_issues(transformed: DataFrame) -> DataFrame:
    """Duplicate and backward clocks of an item in file order, plus unusable clocks.

    The file order is cut into slices of the ordinal, so an item of any size is spread over tasks.
    """
    usable = F.col("clock").isNotNull()
    chained = with_neighbours(
        transformed.filter(usable).select("itemid", "clock", "ordinal"),
        ["itemid"], ["clock"], axis="ordinal", slice_width=ORDINAL_SLICE,
    )
    before = F.col("previous.clock")
    placed = issues_of(
        chained,
        [
            ("duplicate_timestamp", F.col("clock") == before),
            ("out_of_order", F.col("clock") < before),
        ],
    )
    return placed.unionByName(
        issues_of(transformed.filter(~usable), [("invalid_clock", F.lit(True))])
    )


def recomputation_issues(transformed: DataFrame, require_null_delta: bool = False) -> DataFrame:
    """Recompute every counter row from the row before it and report what does not follow.

    ``require_null_delta`` adds ``reset_has_delta_value``: the transform keeps the delta of a decrease,
    so this rule fires on each of them and is off unless asked for.
    """
    counters = transformed.filter(F.col("semantic_type") == "counter").withColumn(
        "raw_value", finite(F.col("raw_value"))
    )
    rows = attach_clock_context(counters, ["itemid"], "raw_value")
    context = F.col("context")
    before = context["previous"]
    repeated = F.col("ordinal") != context["first_ordinal"]
    first = before.isNull() & ~repeated
    raw, value, delta = F.col("raw_value"), F.col("value"), F.col("delta_value")
    elapsed, stored = F.col("clock") - before["clock"], F.col("delta_time_sec")
    was = before["last_value"]
    comparable = ~repeated & ~first & raw.isNotNull() & was.isNotNull()
    falls, rises = comparable & (raw < was), comparable & (raw > was)
    same = comparable & (raw == was)
    flagged = F.coalesce("counter_reset", F.lit(False))
    checks = [
        ("first_counter_sample_has_value", first & value.isNotNull()),
        ("first_counter_sample_has_delta", first & delta.isNotNull()),
        ("invalid_delta_time", repeated),
        ("non_numeric_counter_raw_value", ~repeated & ~first & raw.isNull()),
        ("decrease_without_reset_flag", falls & ~flagged),
        ("reset_has_rate_value", falls & value.isNotNull()),
        ("delta_value_mismatch", rises & ~close_to(delta, raw - was)),
        ("delta_time_mismatch", rises & ~stored.eqNullSafe(elapsed)),
        ("rate_formula_mismatch",
         rises & delta.isNotNull() & (stored > 0) & ~close_to(value, delta / stored)),
        ("increase_marked_as_reset", rises & flagged),
        ("increase_missing_rate", rises & value.isNull()),
        ("unchanged_delta_mismatch", same & ~close_to(delta, F.lit(0.0))),
        ("unchanged_rate_mismatch", same & is_finite(value) & ~close_to(value, F.lit(0.0))),
        ("unchanged_marked_as_reset", same & flagged),
        ("negative_rate", comparable & is_finite(value) & (value < 0)),
    ]
    if require_null_delta:
        checks.append(("reset_has_delta_value", falls & delta.isNotNull()))
    return issues_of(rows, checks)


def direct_value_issues(transformed: DataFrame) -> DataFrame:
    """Rows passed through whose value is not the raw one; a row without a raw value has nothing to keep."""
    direct = transformed.filter((F.col("transformation") == "direct") & F.col("raw_value").isNotNull())
    differs = ~same_number(F.col("value"), F.col("raw_value"))
    return issues_of(direct, [("direct_value_mismatch", differs)])


def non_finite_issues(transformed: DataFrame) -> DataFrame:
    broken = F.col("value").isNotNull() & ~is_finite(F.col("value"))
    return issues_of(transformed, [("non_finite_value", broken)])


def preservation_issues(raw: DataFrame, transformed: DataFrame) -> DataFrame:
    """Every transformed (item, clock) has exactly one raw record with the same value.

    Rows without an item or a clock cannot be looked up and are left to the other checks.
    """
    candidates = raw.groupBy("itemid", "clock").agg(
        F.count(F.lit(1)).alias("candidates"), F.min_by("value", "ordinal").alias("first_raw")
    )
    placed = transformed.filter(F.col("itemid").isNotNull() & F.col("clock").isNotNull())
    joined = placed.join(candidates, ["itemid", "clock"], "left")
    found = F.col("candidates").isNotNull()
    return issues_of(
        joined,
        [
            ("missing_raw_record", ~found),
            ("multiple_raw_records", F.col("candidates") > 1),
            ("raw_value_mismatch", found & ~same_number(F.col("raw_value"), F.col("first_raw"))),
        ],
    )


def all_issues(raw: DataFrame, transformed: DataFrame, require_null_delta: bool = False) -> DataFrame:
    parts = [
        transformation_issues(transformed),
        order_issues(transformed),
        recomputation_issues(transformed, require_null_delta),
        direct_value_issues(transformed),
        non_finite_issues(transformed),
        preservation_issues(raw, transformed),
    ]
    log = parts[0]
    for part in parts[1:]:
        log = log.unionByName(part)
    return with_severity(log)


def issue_totals(issues: DataFrame) -> DataFrame:
    return issues.groupBy("issue", "severity").agg(F.count(F.lit(1)).alias("issues"))


def issue_details(issues: DataFrame) -> DataFrame:
    """Every issue with its rank among those of its type in file order.

    Ranks are counted inside slices of the ordinal and shifted by the totals of the slices before, so that an
    issue which hits every row is spread over tasks.
    """
    sliced = issues.withColumn("_slice", floor_bucket(F.col("ordinal"), ORDINAL_SLICE))
    earlier = Window.partitionBy("issue").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = sliced.groupBy("issue", "_slice").agg(F.count(F.lit(1)).alias("_n")).select(
        F.col("issue").alias("_issue"), F.col("_slice").alias("_at"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    inside = F.row_number().over(Window.partitionBy("issue", "_slice").orderBy("ordinal", "itemid", "clock"))
    joined = sliced.withColumn("_rank", inside).join(
        totals, F.col("issue").eqNullSafe(F.col("_issue")) & F.col("_slice").eqNullSafe(F.col("_at"))
    )
    return joined.select(*issues.columns, (F.col("_rank") + F.col("_before")).alias("rank"))


def verdict(totals: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum("issues"), F.lit(0))
    return totals.agg(total.alias("issues"), (total == 0).alias("passed"))


def type_counts(transformed: DataFrame) -> DataFrame:
    """Counts by semantic type, transformation and canonical metric in one pass."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("dimension"), F.col(c).alias("value"))
            for c in ("semantic_type", "transformation", "canonical_metric")
        ]
    )
    return (
        transformed.select(F.explode(pairs).alias("p"))
        .filter((F.col("p.dimension") != "canonical_metric") | (F.coalesce("p.value", F.lit("")) != ""))
        .groupBy("p.dimension", "p.value")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def value_distribution(transformed: DataFrame) -> DataFrame:
    """Count, min, max, mean and exact median of the finite values per canonical metric."""
    values = transformed.select("canonical_metric", finite(F.col("value")).alias("value"))
    return distribution(values, ["canonical_metric"], "value", {"median": 0.5})


# --- history enrichment and deduplication shared by the decrease analyses -------------------------


def enrich_history(history: DataFrame, items: DataFrame) -> DataFrame:
    """Metadata by item id overrides the record's own; ``missing_metadata`` marks unknown items."""
    overridden = ("canonical_metric", "semantic_type", "transformation", "key", "ifindex")
    meta = items.select(
        "itemid", *[F.col(c).alias(f"_{c}") for c in overridden], F.lit(True).alias("_known")
    )
    kept = [c for c in history.columns if c not in overridden]
    return history.select(*kept).join(meta, "itemid", "left").select(
        *kept,
        *[F.col(f"_{c}").alias(c) for c in overridden],
        F.col("_known").isNull().alias("missing_metadata"),
    )


def first_per_clock(records: DataFrame) -> DataFrame:
    """First record per (item, clock) with the size of its group and whether values conflict."""
    rest = [c for c in records.columns if c not in ("itemid", "clock")]
    value = finite(F.col("value"))
    return (
        records.filter((F.col("itemid") != "") & F.col("clock").isNotNull())
        .groupBy("itemid", "clock")
        .agg(
            F.min_by(F.struct(*rest), "ordinal").alias("_row"),
            F.count(F.lit(1)).alias("duplicate_count"),
            F.coalesce(F.min(value) < F.max(value), F.lit(False)).alias("duplicate_conflict"),
        )
        .select(
            "itemid", "clock", *[F.col("_row")[c].alias(c) for c in rest],
            "duplicate_count", "duplicate_conflict",
        )
    )


def duplicate_totals(deduplicated: DataFrame) -> DataFrame:
    return deduplicated.agg(
        F.count_if(F.col("duplicate_count") > 1).alias("duplicate_groups"),
        F.coalesce(F.sum(F.col("duplicate_count") - 1), F.lit(0)).alias("duplicate_records"),
        F.count_if("duplicate_conflict").alias("duplicate_conflicts"),
    )
