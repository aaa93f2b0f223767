"""Inventory discovery and metric selection."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.scalars import non_empty, tagged
from pulseframe.vocab import NUMERIC_VALUE_TYPES

# Keyword rules per category, in rule order.
CATEGORY_KEYWORDS = {
    "interface_traffic": (
        "inbound traffic",
        "outbound traffic",
        "bits received",
        "bits sent",
        "ifhcinoctets",
        "ifhcoutoctets",
        "net.if.in",
        "net.if.out",
    ),
    "packets": (
        "packets received",
        "packets sent",
        "ifhcinucastpkts",
        "ifhcoutucastpkts",
        "packets",
    ),
    "errors": ("error", "errors", "ifinerrors", "ifouterrors"),
    "discards": ("discard", "discards", "ifindiscards", "ifoutdiscards"),
    "cpu": ("cpu", "processor utilization", "system.cpu"),
    "memory": ("memory", "mem.", "vm.memory"),
    "temperature": ("temperature", "temp"),
    "fan": ("fan",),
    "power": ("power", "psu", "power supply"),
    "uptime": ("uptime", "sysuptime"),
    "availability": ("availability", "icmp", "ping"),
    "latency": ("latency", "response time", "rtt"),
    "snmp": ("snmp",),
}

# Key patterns of the two priorities.
P1_PATTERNS = (
    r"^net\.if\.in\[",
    r"^net\.if\.out\[",
    r"^net\.if\.in\.pass\.v[46]\.pps\[",
    r"^net\.if\.out\.pass\.v[46]\.pps\[",
    r"^net\.if\.in\.errors\[",
    r"^net\.if\.out\.errors\[",
    r"^net\.if\.in\.discards\[",
    r"^net\.if\.out\.discards\[",
    r"^net\.if\.status\[",
    r"^icmppingloss$",
    r"^icmppingsec$",
)
P2_PATTERNS = (
    r"^system\.cpu\.util",
    r"^vm\.memory\.util",
    r"^sensor\.temp\.value",
    r"^sensor\.fan\.status",
    r"^sensor\.psu\.status",
    r"^system\.net\.uptime",
)

TEMPERATURE_UNIT_TEXT = "!°c"

SELECTED_FIELDS = (
    "priority", "hostid", "host", "itemid", "metric_name", "key", "units", "value_type", "delay",
    "interfaceid", "last_value", "last_clock", "status", "state", "categories",
)
# Carried on top of the selected fields because the classifier and its enrichment read them.
CARRIED_FIELDS = {
    "error": "string", "preprocessing": "array<struct<type string, params string>>", "master_itemid": "string",
}


def any_pattern(patterns: tuple[str, ...]) -> str:
    """One case-insensitive alternation, so a key is scanned once per rule set."""
    return "(?i)" + "|".join(f"(?:{p})" for p in patterns)


def tag_categories(items: DataFrame) -> DataFrame:
    """Add ``categories``: every category one of whose keywords occurs, or ``other``."""
    text = F.lower(
        F.concat_ws(
            " ", *[F.coalesce(c, F.lit("")) for c in ("metric_name", "key", "snmp_oid")]
        )
    )
    found = tagged(
        [
            (F.col("_text").rlike("|".join(re.escape(k) for k in keywords)), F.lit(category))
            for category, keywords in CATEGORY_KEYWORDS.items()
        ]
    )
    other = F.when(F.size("_found") == 0, F.array(F.lit("other"))).otherwise(F.col("_found"))
    return (
        items.withColumn("_text", text)
        .withColumn("_found", found)
        .withColumn("categories", other)
        .drop("_text", "_found")
    )


def category_counts(tagged_items: DataFrame) -> DataFrame:
    return (
        tagged_items.select(F.explode("categories").alias("category"))
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("metrics"))
    )


def inventory_summary(hosts: DataFrame, items: DataFrame) -> DataFrame:
    """Host and item totals in one row."""
    return (
        hosts.select(F.lit(1).alias("h"), F.lit(0).alias("m"))
        .unionAll(items.select(F.lit(0).alias("h"), F.lit(1).alias("m")))
        .agg(F.sum("h").alias("host_count"), F.sum("m").alias("metric_count"))
    )


def is_enabled(status: Column) -> Column:
    return F.coalesce(status, F.lit("1")) == "0"


def prioritise(items: DataFrame) -> DataFrame:
    """Enabled items with priority P1 or P2; everything else is dropped."""
    key = F.coalesce("key", F.lit(""))
    priority = F.when(key.rlike(any_pattern(P1_PATTERNS)), "P1").when(
        key.rlike(any_pattern(P2_PATTERNS)), "P2"
    )
    return (
        items.filter(is_enabled(F.col("status")))
        .withColumn("priority", priority)
        .filter(F.col("priority").isNotNull())
    )


def select_metrics(items: DataFrame) -> DataFrame:
    """Selection projection; ``host`` falls back to the host's visible name."""
    chosen = prioritise(items)
    host = F.coalesce(non_empty(F.col("host")), F.col("name"))
    carried = [
        F.col(c) if c in items.columns else F.lit(None).cast(kind).alias(c) for c, kind in CARRIED_FIELDS.items()
    ]
    return chosen.withColumn("host", host).select(*SELECTED_FIELDS, *carried)


def priority_counts(selected: DataFrame) -> DataFrame:
    return selected.groupBy("priority").agg(F.count(F.lit(1)).alias("metrics"))


def numeric_items(items: DataFrame) -> DataFrame:
    return items.filter(F.col("value_type").cast("string").isin(*NUMERIC_VALUE_TYPES))


def numeric_type_counts(items: DataFrame) -> DataFrame:
    return numeric_items(items).groupBy("value_type").agg(F.count(F.lit(1)).alias("metrics"))


def unit_trouble(items: DataFrame) -> DataFrame:
    """Items whose unit is the blocked-conversion form of degrees Celsius."""
    return items.filter(F.lower(F.trim("units")) == TEMPERATURE_UNIT_TEXT)


def watched_items(items: DataFrame, watch_list: DataFrame) -> DataFrame:
    return items.join(watch_list.select("itemid"), "itemid", "left_semi")


def watch_counts(items: DataFrame, watch_list: DataFrame) -> DataFrame:
    """Found rows against expected ids, in one pass over the union."""
    expected = watch_list.select("itemid").distinct()
    found = watched_items(items, watch_list)
    return (
        found.select(F.lit(1).alias("f"), F.lit(0).alias("e"))
        .unionAll(expected.select(F.lit(0).alias("f"), F.lit(1).alias("e")))
        .agg(F.sum("f").alias("found"), F.sum("e").alias("expected"))
    )


def unknown_semantics(semantic: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Items without a semantic type, excluded ones included; a field that the table lacks is an error."""
    return semantic.filter(F.col("semantic_type") == "unknown").select(*fields)
