"""Bindings: the given star-schema tables read as telemetry (history, items, hosts)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch(ts: Column) -> Column:
    """Epoch seconds of a zone-less timestamp, independent of the session time zone."""
    return F.timestamp_diff("SECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), ts)


def choose(subject: Column, mapping: dict[str, str]) -> Column:
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), subject)


def pick(values: list[str], slot: Column) -> Column:
    """Constant-array lookup by a zero-based slot number."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (slot + 1).cast("int"))


INTERFACE_NAMES = {
    "click": "in_bps",
    "view": "out_bps",
    "purchase": "in_discard_rate",
    "error": "out_discard_rate",
    "signup": "oper_status",
}
DEVICE_NAMES = {
    "click": "cpu_pct",
    "view": "memory_pct",
    "purchase": "icmp_loss_pct",
    "error": "icmp_rtt_sec",
    "signup": "uptime",
}
ITEM_KEYS = {
    "click": ("net.if.in[ifHCInOctets.", "]"),
    "view": ("net.if.out[ifHCOutOctets.", "]"),
    "purchase": ("net.if.in.discards[ifInDiscards.", "]"),
    "error": ("net.if.out.discards[ifOutDiscards.", "]"),
    "signup": ("net.if.status[ifOperStatus.", "]"),
}


def item_id() -> Column:
    return F.concat_ws("-", F.col("user_id").cast("string"), F.col("event_type"))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw interface history: counters for four event types, a 1/2 state for ``signup``."""
    is_state = F.col("event_type") == "signup"
    host = (F.col("user_id") % 10).cast("string")
    return table(spark, sf_dir, "events").select(
        item_id().alias("itemid"),
        host.alias("hostid"),
        F.concat(F.lit("host-"), host).alias("host"),
        F.concat(F.lit("Host "), host).alias("host_name"),
        F.when(F.col("user_id") % 10 < 5, "switch").otherwise("router").alias("device_role"),
        F.col("user_id").alias("ifindex"),
        epoch(F.col("ts")).alias("clock"),
        F.col("event_id").alias("ordinal"),
        choose(F.col("event_type"), INTERFACE_NAMES).alias("canonical_metric"),
        F.when(is_state, "state").otherwise("counter").alias("semantic_type"),
        F.when(is_state, "direct").otherwise("delta_rate").alias("transformation"),
        F.when(is_state, 1.0 + F.col("event_id") % 2).otherwise(F.col("value")).alias("value"),
    )


def repeated_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History with many rows per (item, clock): line items keyed by supplier and ship date."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("itemid"),
        (F.col("l_suppkey") % 10).cast("string").alias("hostid"),
        F.col("l_suppkey").alias("ifindex"),
        epoch(F.col("l_shipdate")).alias("clock"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ordinal"),
        F.lit("in_bps").alias("canonical_metric"),
        F.lit("counter").alias("semantic_type"),
        F.lit("delta_rate").alias("transformation"),
        F.col("l_extendedprice").alias("value"),
    )


def as_device_health(rows: DataFrame) -> DataFrame:
    """The same history read as device health metrics, all direct."""
    return rows.withColumns(
        {
            "canonical_metric": choose(F.split("itemid", "-")[1], DEVICE_NAMES),
            "semantic_type": F.lit("gauge"),
            "transformation": F.lit("direct"),
        }
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per item of ``history`` with key text, units and status."""
    user, kind = F.col("user_id"), F.col("event_type")
    head = choose(kind, {k: head for k, (head, _) in ITEM_KEYS.items()})
    key_text = F.concat(head, user.cast("string"), F.lit("]"))
    return (
        table(spark, sf_dir, "events")
        .select("user_id", "event_type")
        .distinct()
        .select(
            item_id().alias("itemid"),
            (user % 10).cast("string").alias("hostid"),
            user.alias("ifindex"),
            F.concat(F.lit("Metric "), kind).alias("metric_name"),
            key_text.alias("key"),
            F.when(user % 2 == 0, "bps").otherwise("").alias("units"),
            F.when(user % 7 == 0, "1").otherwise("0").alias("status"),
            F.when(user % 3 == 0, "3").when(user % 11 == 0, "4").otherwise("0").alias("value_type"),
            choose(kind, INTERFACE_NAMES).alias("canonical_metric"),
            F.when(kind == "signup", "state").otherwise("counter").alias("semantic_type"),
            F.when(kind == "signup", "direct").otherwise("delta_rate").alias("transformation"),
        )
    )


# Fixed values of the catalogue binding: (key head, key tail, units) by ``p_partkey % 32``.
CATALOG_KEYS = (
    ("sensor.temp.value[", "]", "!°C"),
    ("net.if.in.pass.v4.pps[", "]", "pps"),
    ("net.if.out.pass.v6.pps[", "]", "pps"),
    ("net.if.status[ifOperStatus.", "]", ""),
    ("net.if.in.errors[ifInErrors.", "]", ""),
    ("net.if.out.errors[ifOutErrors.", "]", ""),
    ("net.if.in.discards[ifInDiscards.", "]", ""),
    ("net.if.out.discards[ifOutDiscards.", "]", ""),
    ('net.if.in["eth', '",dropped]', ""),
    ('net.if.out["eth', '",dropped]', ""),
    ('net.if.in["eth', '",errors]', ""),
    ('net.if.out["eth', '",errors]', ""),
    ("net.if.in[ifHCInOctets.", "]", "bps"),
    ("net.if.in[ifHCInOctets.", "]", "B"),
    ("net.if.out[ifHCOutOctets.", "]", "bps"),
    ("net.if.out[ifHCOutOctets.", "]", "B"),
    ('net.if.in["ens', '",]', "bps"),
    ('net.if.in["ens', '",]', ""),
    ('net.if.out["ens', '",]', "bps"),
    ('net.if.out["ens', '",]', ""),
    ("system.cpu.util[", "]", "%"),
    ("vm.memory.util[", "]", "%"),
    ("vm.memory.size[", "]", "B"),
    ("sensor.fan.status[", "]", ""),
    ("sensor.psu.status[", "]", ""),
    ("system.net.uptime[", "]", "uptime"),
    ("icmppingloss", None, "%"),
    ("icmppingsec", None, "s"),
    ("custom.throughput[", "]", "Mbps"),
    ("custom.bandwidth[", "]", ""),
    ("vfs.fs.pused[", "]", "%"),
    ("agent.version[", "]", ""),
)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inventory of items covering every semantic rule, one per part.

    Hosts are suppliers; a few items are disabled, unsupported or in error.
    """
    part, slot = F.col("p_partkey"), F.col("p_partkey") % len(CATALOG_KEYS)
    number = part.cast("string")
    tail = pick([t or "" for _, t, _ in CATALOG_KEYS], slot)
    key = F.concat(
        pick([h for h, _, _ in CATALOG_KEYS], slot), F.when(tail == "", "").otherwise(number), tail
    )
    units = pick([u for _, _, u in CATALOG_KEYS], slot)
    return table(spark, sf_dir, "part").select(
        part.alias("ordinal"),
        number.alias("itemid"),
        (part % 100).cast("string").alias("hostid"),
        F.concat(F.lit("host-"), part % 100).alias("host"),
        F.col("p_name").alias("metric_name"),
        key.alias("key"),
        F.when(F.col("p_size") == 50, F.lit(None).cast("string")).otherwise(units).alias("units"),
        F.when(part % 5 == 4, "4").when(part % 5 == 3, "3").otherwise("0").alias("value_type"),
        F.lit("60s").alias("delay"),
        (part % 4).cast("string").alias("interfaceid"),
        F.col("p_retailprice").cast("string").alias("last_value"),
        F.lit("1700000000").alias("last_clock"),
        F.when(F.col("p_size") % 10 == 0, "1").otherwise("0").alias("status"),
        F.when(F.col("p_size") % 7 == 0, "1").otherwise("0").alias("state"),
        F.when(F.col("p_size") % 9 == 0, F.lit("timeout")).otherwise(F.lit("")).alias("error"),
        F.concat(F.lit("1.3.6.1.2.1."), number).alias("snmp_oid"),
        F.when(
            F.col("p_size") % 2 == 0,
            F.array(
                F.struct(F.lit("10").alias("type"), F.lit("8").alias("params")),
                F.struct(F.lit(None).cast("string").alias("type"), F.lit("x").alias("params")),
            ),
        ).alias("preprocessing"),
        F.when(F.col("p_size") % 3 == 0, number).alias("master_itemid"),
    )


def hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One host per supplier, with inventory map and templates for role rules."""
    supplier, nation, region = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    joined = supplier.join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey")).join(
        F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")
    )
    key = F.col("s_suppkey")
    model = (
        F.when(key % 6 == 0, "ICX 7150")
        .when(key % 6 == 1, "Mikrotik CCR")
        .when(key % 6 == 2, "FortiGate 60F")
        .when(key % 6 == 3, "AP-RU 11")
        .when(key % 6 == 4, "Linux server")
    )
    return joined.select(
        key.cast("string").alias("hostid"),
        F.when(key % 9 == 8, "").otherwise(F.col("s_name")).alias("host"),
        F.concat(F.lit("Device "), F.col("s_name")).alias("name"),
        F.create_map(
            F.lit("model"), model, F.lit("vendor"), F.col("n_name"), F.lit("os"), F.col("r_name")
        ).alias("inventory"),
        F.array(
            F.struct(
                F.lit("t1").alias("templateid"),
                F.concat(F.lit("Template "), F.col("r_name")).alias("host"),
                F.when(key % 11 == 0, "Router OS by SNMP").otherwise("Generic").alias("name"),
            )
        ).alias("templates"),
    )


def scope_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explicit allow-list: role and host id, with some ids absent from the inventory."""
    key = F.col("s_suppkey")
    role = (
        F.when(key % 4 == 0, "switch")
        .when(key % 4 == 1, "router")
        .when(key % 4 == 2, "firewall")
    )
    listed = table(spark, sf_dir, "supplier").select(
        role.alias("role"),
        F.when(key % 10 == 1, F.concat(F.lit("missing-"), key)).otherwise(key.cast("string"))
        .alias("hostid"),
    )
    return listed.filter(F.col("role").isNotNull())
