"""Host roles, scope tables and the scope filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.scalars import tagged
from pulseframe.operators.inventory import any_pattern

# Role patterns matched anywhere in the host text, ignoring case.
ROLE_PATTERNS = {
    "switch": (
        r"\bICX\b",
        r"\bSardina\b",
        r"\bMikrotik\b",
        r"\bExxadata\b",
        r"\bNexus\b",
        r"\bOpenStck\b",
        r"\bOpenStack\b",
        r"\bSW[-_]",
        r"\bCore[-_]?SW\b",
        r"\bCES[-_]?SW\b",
        r"\bISP[-_]?SW\b",
        r"\bX460G2\b",
    ),
    "router": (
        r"\bMikrotik\b",
        r"\bMikroTik\b",
        r"\bRouter\b",
        r"\bRTR[-_]",
    ),
    "firewall": (
        r"\bpfsense\b",
        r"\bPFSense\b",
        r"\bFortigate\b",
        r"\bFortiGate\b",
        r"\bFortinet\b",
        r"\bFirewall\b",
    ),
    "access_point": (
        r"\bAP[-_].*\bVDX\b",
        r"\bAP[-_].*\bICX\b",
        r"\bAP[-_]?RU\b",
        r"\bRuijie\b",
    ),
}

# Inventory fields that take part in the host text.
TEXT_FIELDS = ("name", "model", "vendor", "os")


def host_text(hosts: DataFrame) -> Column:
    """Blank-joined host identity, inventory fields and template names."""
    blank = F.lit("")
    inventory = [F.coalesce(F.try_element_at("inventory", F.lit(f)), blank) for f in TEXT_FIELDS]
    templates = F.flatten(
        F.transform(
            "templates",
            lambda t: F.array(F.coalesce(t["host"], blank), F.coalesce(t["name"], blank)),
        )
    )
    head = [F.coalesce("host", blank), F.coalesce("name", blank)]
    return F.concat_ws(" ", *head, *inventory, templates)


def assign_roles(hosts: DataFrame) -> DataFrame:
    """Add ``host_text`` and ``roles``; a host may match several roles."""
    text = F.col("host_text")
    return hosts.withColumn("host_text", host_text(hosts)).withColumn(
        "roles",
        tagged([(text.rlike(any_pattern(p)), F.lit(role)) for role, p in ROLE_PATTERNS.items()]),
    )


def numeric_id_order(col: str = "hostid") -> list[Column]:
    """Numeric order for digit ids, text order for the rest."""
    return [F.col(col).try_cast("bigint").asc_nulls_last(), F.col(col)]


def rule_scope(hosts: DataFrame) -> DataFrame:
    """Scope from role rules: one row per (host, role); hosts without a role come out as excluded."""
    known = assign_roles(hosts.filter(F.col("hostid") != ""))
    # A host with no role still yields one row, with a null role.
    return known.select(
        F.explode_outer("roles").alias("role"), "hostid", "host", "name"
    ).withColumn("decision", F.when(F.col("role").isNull(), "exclude").otherwise("include"))


def listed_scope(allow_list: DataFrame, hosts: DataFrame) -> DataFrame:
    """Scope from an explicit (role, hostid) table: included, missing and excluded ids in one table."""
    identity = hosts.select("hostid", "host", "name", F.lit(True).alias("in_inventory"))
    joined = allow_list.select("role", "hostid", F.lit(True).alias("listed")).join(
        identity, "hostid", "full_outer"
    )
    decision = (
        F.when(F.col("listed").isNull(), "exclude")
        .when(F.col("in_inventory").isNull(), "missing_from_inventory")
        .otherwise("include")
    )
    return joined.select("role", "hostid", "host", "name", decision.alias("decision"))


def scope_counts(scope: DataFrame) -> DataFrame:
    return scope.groupBy("decision", "role").agg(F.count(F.lit(1)).alias("hosts"))


def hosts_with_several_roles(scope: DataFrame) -> DataFrame:
    return (
        scope.filter(F.col("role").isNotNull())
        .groupBy("hostid")
        .agg(F.countDistinct("role").alias("role_count"))
        .filter("role_count > 1")
    )


def repeated_items(items: DataFrame, id_column: str = "itemid") -> DataFrame:
    return (
        items.filter(F.col(id_column).isNotNull())
        .groupBy(id_column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter("occurrences > 1")
    )


def require_none(violations: DataFrame, message: str) -> None:
    """Stop when a uniqueness rule is broken; reads at most five offending rows."""
    sample = violations.limit(5).collect()
    if sample:
        raise ValueError(f"{message}: {[tuple(r) for r in sample]}")


def route_metrics(metrics: DataFrame, inventory_items: DataFrame, scope: DataFrame) -> DataFrame:
    """Tag every metric with its route and overwrite host identity from the inventory.

    Metrics without an item id skip the joins, so blank ids never pile up on one join key.
    """
    blank = F.coalesce(F.col("itemid") == "", F.lit(True))
    kept = [c for c in metrics.columns if c not in ("hostid", "host", "host_name", "device_role")]
    index = inventory_items.select(
        "itemid",
        F.col("hostid").alias("_hostid"),
        F.col("host").alias("_host"),
        F.col("name").alias("_name"),
        F.lit(True).alias("_known"),
    )
    roles = scope.filter(F.col("role").isNotNull()).select(
        F.col("hostid").alias("_hostid"), F.col("role").alias("device_role")
    )
    resolved = (
        metrics.filter(~blank)
        .select(*kept)
        .join(index, "itemid", "left")
        .join(roles, "_hostid", "left")
    )
    route = (
        F.when(F.col("_known").isNull(), "item_not_in_inventory")
        .when(F.col("device_role").isNull(), "excluded")
        .otherwise("included")
    )
    routed = resolved.select(
        *kept,
        F.col("_hostid").alias("hostid"),
        F.col("_host").alias("host"),
        F.col("_name").alias("host_name"),
        "device_role",
        route.alias("route"),
    )
    unresolved = metrics.filter(blank).select(*kept, F.lit("missing_itemid").alias("route"))
    return routed.unionByName(unresolved, allowMissingColumns=True)


def scope_summary(routed: DataFrame) -> DataFrame:
    route = F.col("route")
    included, excluded = route == "included", route == "excluded"
    total, out = F.count(F.lit(1)), F.count_if(excluded)
    return routed.agg(
        total.alias("input_metrics"),
        F.count_if(included).alias("scoped_metrics"),
        out.alias("excluded_metrics"),
        F.count_if(route.isin("missing_itemid", "item_not_in_inventory")).alias(
            "unresolved_metrics"
        ),
        F.when(total > 0, F.round(out / total * 100, 2)).otherwise(0.0).alias(
            "excluded_percentage"
        ),
        F.countDistinct(F.when(included, F.col("hostid"))).alias("scoped_hosts"),
        F.countDistinct(F.when(excluded, F.col("hostid"))).alias("excluded_hosts"),
        F.count_if(route == "missing_itemid").alias("metrics_without_itemid"),
        F.count_if(route == "item_not_in_inventory").alias("items_not_in_inventory"),
    )


def scoped_role_counts(routed: DataFrame) -> DataFrame:
    return (
        routed.filter(F.col("route") == "included")
        .groupBy("device_role")
        .agg(F.count(F.lit(1)).alias("metrics"))
    )


def excluded_host_report(routed: DataFrame, hosts: DataFrame) -> DataFrame:
    counted = (
        routed.filter(F.col("route") == "excluded")
        .groupBy("hostid")
        .agg(F.count(F.lit(1)).alias("metric_count"))
    )
    blank = F.lit("")
    return (
        counted.join(hosts.select("hostid", "host", "name"), "hostid", "left")
        .select(
            "hostid",
            F.coalesce("host", blank).alias("host"),
            F.coalesce("name", blank).alias("name"),
            "metric_count",
        )
        .orderBy(*numeric_id_order())
    )
