"""Queries and oracle SQL of scans and sinks (S1 to S8, H24): what the given tables say is written to shared storage and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseframe.operators import counters
from pulseframe.plans import bindings, staging
from pulseframe.plans.oracles import CATALOG, HISTORY, ITEMS, SCOPE, HOSTS, TRANSFORMED, with_
from pulseframe.plans.queries import rounded, transformed
from pulseframe.sources import documents, json_lines, landing, sinks

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str):
    def register(build):
        QUERIES[name], SQL[name] = build, sql
        return build

    return register


def fresh(spark, name: str) -> str:
    return f"{staging.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# --- documents --------------------------------------------------------------------------------------

ITEMS_A_HOST, HOSTS_A_DOCUMENT = 20, 10


def inventory_documents(spark, sf) -> str:
    """Hosts from ``supplier``, each with a run of the catalogue's items, ten hosts a document, a document a line."""
    item = F.struct(
        "itemid", F.col("metric_name").alias("name"), "key", "value_type", "units", "delay", "status", "state", "error", "snmp_oid", "interfaceid", "last_value", "last_clock",
        F.array(F.lit("other")).alias("categories"),
    )
    rows = bindings.catalog(spark, sf).withColumn("hostid", F.floor(F.col("ordinal") / ITEMS_A_HOST).cast("string"))
    owned = rows.groupBy("hostid").agg(F.array_sort(F.collect_list(item)).alias("metrics"))
    hosts = bindings.hosts(spark, sf).join(owned, "hostid", "left").withColumn("metrics", F.coalesce("metrics", F.array().cast(owned.schema["metrics"].dataType)))
    host = F.struct("hostid", "host", "name", F.lit("0").alias("status"), "inventory", "templates", "metrics", F.size("metrics").alias("metric_count"))
    several = hosts.groupBy(F.floor(F.col("hostid").cast("bigint") / HOSTS_A_DOCUMENT)).agg(F.collect_list(host).alias("hosts"))
    path = fresh(spark, "inventory")
    several.select(F.to_json(F.struct(F.lit("2024-01-01T00:00:00Z").alias("generated_at"), "hosts")).alias("value")).write.text(path)
    return path


_OWNED = f"""owned AS (SELECT h.hostid, h.host, h.name AS host_name, c.itemid, c.metric_name, c.key, c.units, c.status
  FROM hosts h JOIN catalog c ON h.hostid = CAST(c.ordinal // {ITEMS_A_HOST} AS VARCHAR))"""


@query(
    "S1_inventory_items",
    with_(HOSTS, CATALOG, _OWNED) + "SELECT hostid, coalesce(nullif(host, ''), host_name) AS host, host_name, itemid, metric_name AS name, key, units, status FROM owned",
)
def _(spark, sf):
    hosts = documents.read_inventory(spark, inventory_documents(spark, sf), whole=False)
    return documents.flatten_items(hosts).select("hostid", "host", "host_name", "itemid", "name", "key", "units", "status")


@query("S1_C6_item_index", with_(HOSTS, CATALOG, _OWNED) + "SELECT itemid, hostid, host, host_name AS name FROM owned")
def _(spark, sf):
    hosts = documents.read_inventory(spark, inventory_documents(spark, sf), whole=False)
    return documents.item_index(hosts).select("itemid", "hostid", "host", "name")


@query("C5_role_index", with_(SCOPE) + "SELECT hostid, role FROM allow_list")
def _(spark, sf):
    return documents.role_index(bindings.scope_table(spark, sf))


@query("S2_metric_list", with_(CATALOG) + "SELECT itemid, metric_name AS name, key, units, value_type, state FROM catalog")
def _(spark, sf):
    item = F.struct("itemid", F.col("metric_name").alias("name"), "key", "units", "value_type", "state")
    number = F.floor(F.col("ordinal") / ITEMS_A_HOST)
    lists = bindings.catalog(spark, sf).groupBy(number.alias("n")).agg(F.collect_list(item).alias("items")).withColumn("n", F.col("n") % 3)
    text = F.when(F.col("n") == 0, F.to_json("items")).when(F.col("n") == 1, F.to_json(F.struct("items"))).otherwise(F.to_json(F.struct(F.col("items").alias("metrics"))))
    path = fresh(spark, "metric-lists")
    lists.select(text.alias("value")).write.text(path)
    return documents.read_metric_list(spark, path, whole=False).select("itemid", "name", "key", "units", "value_type", "state")


# --- JSON lines -------------------------------------------------------------------------------------

EVENT = (
    T.StructType().add("event_id", T.LongType()).add("user_id", T.LongType()).add("event_type", T.StringType()).add("value", T.DoubleType())
    .add("flag", T.BooleanType()).add("tags", T.ArrayType(T.StringType()))
)


def event_lines(spark, sf, damaged: bool) -> str:
    """Events as lines; with ``damaged`` some, by id, are cut, no object, blank, or followed by more text."""
    number = F.col("event_id")
    row = F.struct(
        "event_id", "user_id", "event_type", F.when(number % 13 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
        (number % 2 == 0).alias("flag"), F.array("event_type").alias("tags"),
    )
    text = F.to_json(row)
    if damaged:
        text = (
            F.when(number % 97 == 0, F.left(text, F.length(text) - 3)).when(number % 89 == 0, "[1, 2]").when(number % 83 == 0, "  ")
            .when(number % 79 == 0, F.concat(text, F.lit(" more"))).when(number % 73 == 0, "12").otherwise(text)
        )
    path = fresh(spark, "event-lines")
    bindings.table(spark, sf, "events").select(text.alias("value")).write.text(path)
    return path


_RECORD = "event_id, user_id, event_type, round(CASE WHEN event_id % 13 > 0 THEN value END, 3) AS value, event_id % 2 = 0 AS flag, event_type AS tags"
_DAMAGE = "event_id % 97 > 0 AND event_id % 89 > 0 AND event_id % 83 > 0 AND event_id % 79 > 0 AND event_id % 73 > 0"


def _event_columns(rows):
    return rounded(rows.withColumn("tags", F.array_join("tags", ",")))


@query("S3_strict_lines", f"SELECT {_RECORD} FROM events")
def _(spark, sf):
    return _event_columns(json_lines.read_strict(spark, event_lines(spark, sf, False), EVENT))


@query("S4_permissive_records", f"SELECT {_RECORD} FROM events WHERE {_DAMAGE}")
def _(spark, sf):
    return _event_columns(json_lines.read_permissive(spark, event_lines(spark, sf, True), EVENT)[0])


@query(
    "S4_permissive_errors",
    """SELECT error, count(*) AS lines, count(*) AS places FROM (
  SELECT CASE WHEN event_id % 97 = 0 THEN 'malformed JSON' WHEN event_id % 89 = 0 THEN 'not an object' WHEN event_id % 83 = 0 THEN NULL
    WHEN event_id % 79 = 0 THEN 'malformed JSON' WHEN event_id % 73 = 0 THEN 'not an object' END AS error FROM events) WHERE error IS NOT NULL GROUP BY 1""",
)
def _(spark, sf):
    errors = json_lines.read_permissive(spark, event_lines(spark, sf, True), EVENT)[1]
    return errors.groupBy("error").agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("path", "line").alias("places"))


_TRANSFORMED = "itemid, clock, round(value, 6) AS value, round(raw_value, 6) AS raw_value, counter_reset, transformation_applied"


@query("S6_json_lines", with_(*TRANSFORMED) + f"SELECT {_TRANSFORMED}, (SELECT count(*) FROM transformed) AS written FROM transformed")
def _(spark, sf):
    rows = transformed(spark, sf).select("itemid", "clock", "value", "raw_value", "counter_reset", "transformation_applied")
    path = fresh(spark, "transformed")
    written = json_lines.write_lines(rows, path)
    return rounded(json_lines.read_strict(spark, path, rows.schema), 6).withColumn("written", F.lit(written).cast("bigint"))


# --- reports, matrices, order -----------------------------------------------------------------------


@query(
    "S7_report", with_(HISTORY) + "SELECT count(*) AS total_records, count(value) AS numeric_records, count(*) - count(value) AS skipped_records, 1 AS documents FROM history",
)
def _(spark, sf):
    path = fresh(spark, "report")
    report = counters.admission_counts(bindings.history(spark, sf))
    sinks.write_report(report, path)
    told = json_lines.read_strict(spark, path, report.schema)
    return told.groupBy(*report.columns).agg(F.count(F.lit(1)).cast("int").alias("documents"))


_FEATURES = {
    "event_id": "event_id", "share": "value / 7", "small": "value / 1000000 / 7", "tiny": "value / 10000000000 / 7", "large": "value * 100000000 / 7",
    "huge": "value * 10000000000000 / 7", "negative": "-value", "whole": "floor(value)",
}


@query(
    "S8_matrix", "SELECT " + ", ".join(f"printf('%.12g', CAST({e} AS DOUBLE)) AS {n}" for n, e in _FEATURES.items()) + ", (SELECT count(*) FROM events) AS written FROM events",
)
def _(spark, sf):
    rows = bindings.table(spark, sf, "events").select(*[F.expr(e).cast("double").alias(n) for n, e in _FEATURES.items()])
    path = fresh(spark, "matrix")
    written = sinks.write_matrix(rows, list(_FEATURES), path)
    back = spark.read.option("header", True).schema(", ".join(f"{n} string" for n in _FEATURES)).csv(path)
    return back.withColumn("written", F.lit(written).cast("bigint"))


@query(
    "H24_ordered_files", with_(HISTORY) + """SELECT count(*) AS "rows", 0 AS disorder_inside, 0 AS disorder_between,
  CAST(sum(hash_input) AS BIGINT) AS checksum FROM (SELECT clock % 1000003 + ordinal AS hash_input FROM history)""",
)
def _(spark, sf):
    """Rows out of place inside a file, and files that do not begin behind the one before; both must be none."""
    rows = bindings.history(spark, sf).select("hostid", "ifindex", "clock", "ordinal")
    path = fresh(spark, "ordered")
    sinks.write_ordered(rows, [*sinks.numeric_first("hostid"), F.asc("ifindex"), F.asc("clock")], path, 16)
    key = F.struct(F.col("hostid").cast("bigint"), "hostid", "ifindex", "clock")
    back = spark.read.schema(rows.schema).parquet(path).select(
        key.alias("key"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"), (F.col("clock") % 1000003 + F.col("ordinal")).alias("h")
    )
    inside = back.withColumn("was", F.lag("key").over(Window.partitionBy("file").orderBy("at")))
    files = inside.groupBy("file").agg(
        F.min("key").alias("low"), F.max("key").alias("high"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("key") < F.col("was")).alias("bad"), F.sum("h").alias("h")
    )
    # one row a file; files were numbered in order when they were written
    between = files.withColumn("late", F.lag("high").over(Window.orderBy("file")) > F.col("low"))
    return between.agg(
        F.sum("n").alias("rows"), F.sum("bad").cast("int").alias("disorder_inside"), F.count_if("late").cast("int").alias("disorder_between"), F.sum("h").alias("checksum")
    )


# --- landing ----------------------------------------------------------------------------------------

@query(
    "S5_landed_history", with_(HISTORY, ITEMS) + """, bounds AS (
  SELECT min(clock) + (max(clock) - min(clock)) // 3 AS first, max(clock) - (max(clock) - min(clock)) // 3 AS last FROM history)
SELECT strftime(make_timestamp(h.clock * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS timestamp, h.clock, h.itemid, h.hostid, h.host, h.host_name, h.device_role,
  h.canonical_metric, h.semantic_type, h.transformation, round(h.value, 3) AS value
FROM history h JOIN items i USING (itemid), bounds WHERE h.clock BETWEEN first AND last AND i.value_type IN ('0', '3')""",
)
def _(spark, sf):
    history = bindings.history(spark, sf)
    points = staging.materialise(history.select("itemid", "clock", F.col("value").cast("string").alias("value")), "points")
    named = history.select("itemid", "host", "host_name", "device_role").distinct()
    items = bindings.items(spark, sf).join(named, "itemid")
    low, high = points.agg(F.min("clock"), F.max("clock")).first()
    if low is None:
        low = high = 0
    third = (high - low) // 3
    return rounded(landing.land_history(points, items, low + third, high - third))
