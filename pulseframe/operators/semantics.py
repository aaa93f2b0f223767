"""Semantic layer: deduplication, rule-table classification, validation and roll-ups."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.scalars import non_empty, safe_long, tagged
from pulseframe.operators.inventory import TEMPERATURE_UNIT_TEXT, is_enabled

CELSIUS = "°C"


def keep_last_per_item(metrics: DataFrame) -> DataFrame:
    """Last occurrence per item id wins; ``position`` is where the id first appeared.

    A plain aggregation, so any number of copies of one id combines map-side.
    """
    rest = [c for c in metrics.columns if c != "itemid"]
    return (
        metrics.filter(F.col("itemid").isNotNull())
        .groupBy("itemid")
        .agg(
            F.max_by(F.struct(*rest), "ordinal").alias("_row"),
            F.min("ordinal").alias("position"),
        )
        .select("itemid", *[F.col("_row")[c].alias(c) for c in rest], "position")
    )


def normalised_units(units: Column) -> Column:
    text = F.trim(units)
    return F.when(F.lower(text) == TEMPERATURE_UNIT_TEXT, CELSIUS).otherwise(
        F.coalesce(text, F.lit(""))
    )


@dataclass(frozen=True)
class Rule:
    """One row of the rule table; ``units=None`` keeps the item's own normalised unit."""

    when: str
    semantic_type: str
    transformation: str
    canonical_metric: str | None
    confidence: str
    reason: str
    units: str | None = None
    exclude_reason: str | None = None


# The rule table, first match wins.  Conditions are Spark SQL over the prepared columns
# key_text, unit_text (trimmed), enabled, unsupported.
RULES = (
    Rule("NOT enabled", "unknown", "direct", None, "low", "Item is disabled",
         exclude_reason="disabled"),
    Rule("key_text RLIKE r'(?i)^sensor\\.temp\\.value\\[' AND unsupported", "unknown", "direct", None,
         "high", "Temperature sensor is unsupported or has an item error",
         exclude_reason="unsupported_temperature_sensor"),
    Rule("key_text RLIKE r'(?i)^sensor\\.temp\\.value\\['", "gauge", "direct", "temperature_c", "high",
         "SNMP temperature sensor is a gauge; unit normalized to °C", units=CELSIUS),
    Rule("key_text RLIKE r'(?i)^net\\.if\\.in\\.pass\\.v[46]\\.pps\\['", "rate", "direct", "in_pps",
         "high", "IPv4/IPv6 inbound passed-packet rate", units="pps"),
    Rule("key_text RLIKE r'(?i)^net\\.if\\.out\\.pass\\.v[46]\\.pps\\['", "rate", "direct", "out_pps",
         "high", "IPv4/IPv6 outbound passed-packet rate", units="pps"),
    Rule("key_text RLIKE r'(?i)^net\\.if\\.status\\['", "state", "direct", "oper_status", "high",
         "Interface operational state", units=""),
    Rule("key_text RLIKE r'(?i)ifInErrors|^net\\.if\\.in\\.errors\\['", "counter", "delta_rate",
         "in_error_rate", "high", "Inbound interface error counter"),
    Rule("key_text RLIKE r'(?i)ifOutErrors|^net\\.if\\.out\\.errors\\['", "counter", "delta_rate",
         "out_error_rate", "high", "Outbound interface error counter"),
    Rule("key_text RLIKE r'(?i)ifInDiscards|^net\\.if\\.in\\.discards\\['", "counter", "delta_rate",
         "in_discard_rate", "high", "Inbound interface discard counter"),
    Rule("key_text RLIKE r'(?i)ifOutDiscards|^net\\.if\\.out\\.discards\\['", "counter", "delta_rate",
         "out_discard_rate", "high", "Outbound interface discard counter"),
    Rule("key_text RLIKE r'(?i)^net\\.if\\.in\\[\"[^\"]+\",dropped\\]$'", "counter", "delta_rate",
         "in_discard_rate", "medium", "Linux interface inbound dropped-packet counter; "
         "source semantics should be verified"),
    Rule("key_text RLIKE r'(?i)^net\\.if\\.out\\[\"[^\"]+\",dropped\\]$'", "counter", "delta_rate",
         "out_discard_rate", "medium", "Linux interface outbound dropped-packet counter; "
         "source semantics should be verified"),
    Rule("key_text RLIKE r'(?i)^net\\.if\\.in\\[\"[^\"]+\",errors\\]$'", "counter", "delta_rate",
         "in_error_rate", "medium", "Linux interface inbound error counter; "
         "source semantics should be verified"),
    Rule("key_text RLIKE r'(?i)^net\\.if\\.out\\[\"[^\"]+\",errors\\]$'", "counter", "delta_rate",
         "out_error_rate", "medium", "Linux interface outbound error counter; "
         "source semantics should be verified"),
    Rule("key_text RLIKE r'(?i)ifHCInOctets' AND lower(unit_text) = 'bps'", "rate", "direct", "in_bps",
         "high", "Inbound interface traffic already represented as bps"),
    Rule("key_text RLIKE r'(?i)ifHCInOctets'", "counter", "delta_rate", "in_bps", "high",
         "Inbound high-capacity interface octet counter"),
    Rule("key_text RLIKE r'(?i)ifHCOutOctets' AND lower(unit_text) = 'bps'", "rate", "direct",
         "out_bps", "high", "Outbound interface traffic already represented as bps"),
    Rule("key_text RLIKE r'(?i)ifHCOutOctets'", "counter", "delta_rate", "out_bps", "high",
         "Outbound high-capacity interface octet counter"),
    Rule("key_text RLIKE r'(?i)^net\\.if\\.in\\[' AND lower(unit_text) = 'bps'", "rate", "direct",
         "in_bps", "high", "Inbound interface traffic with bps unit"),
    Rule("key_text RLIKE r'(?i)^net\\.if\\.in\\['", "counter", "delta_rate", "in_bps", "medium",
         "Inbound interface traffic item without explicit bps unit"),
    Rule("key_text RLIKE r'(?i)^net\\.if\\.out\\[' AND lower(unit_text) = 'bps'", "rate", "direct",
         "out_bps", "high", "Outbound interface traffic with bps unit"),
    Rule("key_text RLIKE r'(?i)^net\\.if\\.out\\['", "counter", "delta_rate", "out_bps", "medium",
         "Outbound interface traffic item without explicit bps unit"),
    Rule("key_text RLIKE r'(?i)^system\\.cpu\\.util'", "gauge", "direct", "cpu_pct", "high",
         "CPU utilization gauge", units="%"),
    Rule("key_text RLIKE r'(?i)^(vm\\.memory\\.util|vm\\.memory\\.size\\[)' AND unit_text = '%'",
         "gauge", "direct", "memory_pct", "high", "Memory utilization percentage", units="%"),
    Rule("key_text RLIKE r'(?i)^sensor\\.fan\\.status'", "state", "direct", "fan_status", "high",
         "Fan operational status"),
    Rule("key_text RLIKE r'(?i)^sensor\\.psu\\.status'", "state", "direct", "psu_status", "high",
         "Power supply operational status"),
    Rule("key_text RLIKE r'(?i)^system\\.net\\.uptime'", "gauge", "direct", "uptime", "high",
         "System uptime"),
    Rule("key_text RLIKE r'(?i)^icmppingloss$'", "gauge", "direct", "icmp_loss_pct", "high",
         "ICMP packet loss percentage", units="%"),
    Rule("key_text RLIKE r'(?i)^icmppingsec$'", "gauge", "direct", "icmp_rtt_sec", "high",
         "ICMP round-trip response time", units="s"),
    Rule("key_text RLIKE r'(?i)rate|throughput|bandwidth' AND unit_text <> ''", "rate", "direct",
         "rate", "medium", "Generic metric with rate-like key"),
    Rule("unit_text = '%'", "gauge", "direct", "percentage", "medium", "Generic percentage gauge",
         units="%"),
    Rule("true", "unknown", "direct", None, "low", "No deterministic semantic rule matched"),
)

VERDICT_FIELDS = (
    "semantic_type", "transformation", "canonical_metric", "normalized_units", "confidence",
    "excluded", "exclude_reason", "classification_reason",
)


def _from_rule(attribute: str) -> Column:
    """Value of a rule attribute, looked up in a constant array by the matched rule's number."""
    values = F.array(*[F.lit(getattr(rule, attribute)).cast("string") for rule in RULES])
    return F.element_at(values, F.col("_rule"))


def classify(metrics: DataFrame) -> DataFrame:
    """Add the rule verdict to every metric: one generated CASE, evaluated inside the scan stage."""
    columns = metrics.columns
    state = F.coalesce(safe_long(F.col("state")), F.lit(0)) if "state" in columns else F.lit(0)
    failing = (
        F.coalesce(F.trim("error") != "", F.lit(False)) if "error" in columns else F.lit(False)
    )
    prepared = metrics.withColumns(
        {
            "key_text": F.coalesce(F.trim("key"), F.lit("")),
            "unit_text": F.coalesce(F.trim("units"), F.lit("")),
            "own_units": normalised_units(F.col("units")),
            "enabled": is_enabled(F.col("status")),
            "unsupported": (state != 0) | failing,
        }
    )
    # Only the rule number comes out of the CASE; the verdict fields are constant-array lookups, so
    # the regular expressions are evaluated once per row.
    first, *others = RULES
    number = F.when(F.expr(first.when), 1)
    for position, rule in enumerate(others, start=2):
        number = number.when(F.expr(rule.when), position)
    excluded_by = _from_rule("exclude_reason")
    verdict = {
        "semantic_type": _from_rule("semantic_type"),
        "transformation": _from_rule("transformation"),
        "canonical_metric": _from_rule("canonical_metric"),
        "normalized_units": F.coalesce(_from_rule("units"), F.col("own_units")),
        "confidence": _from_rule("confidence"),
        "excluded": excluded_by.isNotNull(),
        "exclude_reason": excluded_by,
        "classification_reason": _from_rule("reason"),
    }
    return prepared.withColumn("_rule", number).select(
        *columns, *[verdict[f].alias(f) for f in VERDICT_FIELDS]
    )


def enrich(metrics: DataFrame) -> DataFrame:
    """Flatten preprocessing step types and fill the id defaults."""
    steps = F.filter("preprocessing", lambda s: s["type"].isNotNull())
    return metrics.withColumns(
        {
            "preprocessing_types": F.coalesce(
                F.transform(steps, lambda s: s["type"].cast("string")),
                F.array().cast("array<string>"),
            ),
            "master_itemid": F.coalesce(F.col("master_itemid").cast("string"), F.lit("0")),
            "interfaceid": F.coalesce(F.col("interfaceid").cast("string"), F.lit("0")),
        }
    )


def build_semantic_metrics(selected: DataFrame) -> DataFrame:
    return enrich(classify(keep_last_per_item(selected)))


def dimension_counts(rows: DataFrame, dimensions: dict[str, Column]) -> DataFrame:
    """Counts per value of several dimensions in one pass; null values are not counted."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("dimension"), col.cast("string").alias("value"))
            for name, col in dimensions.items()
        ]
    )
    return (
        rows.select(F.explode(pairs).alias("p"))
        .filter(F.col("p.value").isNotNull())
        .groupBy(F.col("p.dimension").alias("dimension"), F.col("p.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("metrics"))
    )


def semantic_summary(semantic: DataFrame) -> DataFrame:
    return dimension_counts(
        semantic,
        {
            "semantic_type": F.col("semantic_type"),
            "transformation": F.col("transformation"),
            "confidence": F.col("confidence"),
            "canonical_metric": F.col("canonical_metric"),
            "exclude_reason": F.when(F.col("excluded"), F.col("exclude_reason")),
        },
    )


# Semantic types each canonical metric may have, and the expected transformations.
ALLOWED_TYPES = {
    "in_bps": ("counter", "rate"),
    "out_bps": ("counter", "rate"),
    "in_error_rate": ("counter", "rate"),
    "out_error_rate": ("counter", "rate"),
    "in_discard_rate": ("counter", "rate"),
    "out_discard_rate": ("counter", "rate"),
    "in_pps": ("rate",),
    "out_pps": ("rate",),
    "cpu_pct": ("gauge",),
    "memory_pct": ("gauge",),
    "temperature_c": ("gauge",),
    "icmp_loss_pct": ("gauge",),
    "icmp_rtt_sec": ("gauge",),
    "oper_status": ("state",),
    "fan_status": ("state",),
    "psu_status": ("state",),
    "uptime": ("gauge",),
}
EXPECTED_TRANSFORMATION = {
    "counter": "delta_rate",
    "gauge": "direct",
    "rate": "direct",
    "state": "direct",
}
CONFIDENCE_LEVELS = ("high", "medium", "low")


def literal_map(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def expected_transformation(semantic_type: Column) -> Column:
    return F.try_element_at(literal_map(EXPECTED_TRANSFORMATION), semantic_type)


def semantic_issues(semantic: DataFrame) -> DataFrame:
    """Issue log: one row per broken rule, from a single pass over the metrics."""
    allowed = F.try_element_at(
        literal_map({k: ",".join(v) for k, v in ALLOWED_TYPES.items()}), F.col("canonical_metric")
    )
    kind, applied = F.col("semantic_type"), F.col("transformation")
    wanted = expected_transformation(kind)
    excluded = F.coalesce("excluded", F.lit(False))
    usable = ~excluded

    def issue(name: str, expected: Column, actual: Column) -> Column:
        return F.struct(
            F.lit(name).alias("issue"), expected.alias("expected"), actual.alias("actual")
        )

    none = F.lit(None).cast("string")
    wrong_type = ~F.coalesce(F.array_contains(F.split(allowed, ","), kind), F.lit(False))
    # Expected types are reported in alphabetical order.
    found = tagged(
        [
            (excluded & non_empty(F.col("exclude_reason")).isNull(),
             issue("excluded_without_reason", none, none)),
            (usable & (kind == "unknown"), issue("unknown_semantic", none, kind)),
            (usable & allowed.isNotNull() & wrong_type,
             issue("wrong_semantic_type", allowed, kind)),
            (usable & wanted.isNotNull() & ~applied.eqNullSafe(wanted),
             issue("wrong_transformation", wanted, applied)),
            (usable & ~F.coalesce(F.col("confidence").isin(*CONFIDENCE_LEVELS), F.lit(False)),
             issue("invalid_confidence", none, F.col("confidence"))),
        ]
    )
    return semantic.select(
        "itemid", "hostid", "host", "key", "canonical_metric", F.explode(found).alias("_issue")
    ).select("itemid", "hostid", "host", "key", "canonical_metric", "_issue.*")


def semantic_totals(semantic: DataFrame) -> DataFrame:
    excluded = F.coalesce("excluded", F.lit(False))
    return semantic.agg(
        F.count(F.lit(1)).alias("total_metrics"),
        F.count_if(~excluded).alias("usable_metrics"),
        F.count_if(excluded).alias("excluded_metrics"),
        F.count_if(~excluded & (F.col("semantic_type") == "unknown")).alias("unknown_metrics"),
    )


def usable_summary(semantic: DataFrame) -> DataFrame:
    """Counts over usable metrics only, plus exclusion reasons."""
    usable = ~F.coalesce("excluded", F.lit(False))

    def when_usable(name: str) -> Column:
        return F.when(usable, F.col(name))

    return dimension_counts(
        semantic,
        {
            **{
                name: when_usable(name)
                for name in ("semantic_type", "transformation", "confidence", "canonical_metric")
            },
            "exclude_reason": F.when(~usable, F.col("exclude_reason")),
        },
    )


def issue_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("issue").agg(F.count(F.lit(1)).alias("issues"))
