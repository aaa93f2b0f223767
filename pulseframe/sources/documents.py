"""Nested JSON documents: inventories of hosts with their metrics, and metric lists of two shapes.

A document is one row while it is parsed, so its size is what a task must hold; any number of documents is read in parallel.
With ``whole`` every file is a document, else every line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.operators import scope

ITEM = (
    "itemid string, name string, key string, type string, value_type string, units string, delay string, history string, trends string, status string, "
    "state string, error string, snmp_oid string, interfaceid string, templateid string, last_value string, last_clock string, categories array<string>"
)
HOST = (
    "hostid string, host string, name string, status string, groups array<struct<groupid: string, name: string>>, "
    "interfaces array<struct<interfaceid: string, type: string, main: string, useip: string, ip: string, dns: string, port: string>>, "
    "tags array<struct<tag: string, value: string>>, inventory map<string, string>, templates array<struct<templateid: string, host: string, name: string>>"
)


def _texts(spark: SparkSession, path: str, whole: bool) -> DataFrame:
    text = F.btrim("value", F.lit(" \t\r\n﻿"))
    return spark.read.text(path, wholetext=whole).select(F.col("_metadata.file_path").alias("path"), text.alias("text")).filter("text <> ''")


def _refused(message: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"{message}: "), F.col("path"), F.lit(": "), F.left("text", F.lit(80))))


def read_inventory(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """One row per host, its metrics as an array; a document that is no object stops the job."""
    texts = _texts(spark, path, whole)
    bad = F.col("document").isNull() | F.col("document._corrupt").isNotNull() | ~F.col("text").startswith("{")
    schema = f"hosts array<struct<{HOST}, metrics array<struct<{ITEM}>>, metric_count bigint>>, _corrupt string"
    parsed = texts.withColumn("document", F.from_json("text", schema, {"columnNameOfCorruptRecord": "_corrupt"}))
    checked = parsed.filter(F.when(bad, _refused("Not an inventory").cast("boolean")).otherwise(F.lit(True)))
    return checked.select(F.explode("document.hosts").alias("h")).select("h.*")


def flatten_items(hosts: DataFrame) -> DataFrame:
    """One row per item, with the identity of its host; the host's name stands in for an empty technical name."""
    label = F.coalesce(F.nullif("host", F.lit("")), "name")
    return hosts.select("hostid", label.alias("host"), F.col("name").alias("host_name"), F.inline("metrics"))


def read_metric_list(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """Items of documents that are a bare array, or an object with the array under ``metrics`` or else ``items``.

    Any other document stops the job.
    """
    array = f"array<struct<{ITEM}>>"
    options = {"mode": "PERMISSIVE"}
    bare = F.when(F.col("text").startswith("["), F.from_json("text", array, options))
    held = F.from_json("text", f"metrics {array}, items {array}", options)
    wrapped = F.when(F.col("text").startswith("{"), F.coalesce(held["metrics"], held["items"]))
    found = F.coalesce(bare, wrapped, _refused("Neither a list nor an object with metrics or items").cast(array))
    return _texts(spark, path, whole).select(F.inline(found))


def item_index(hosts: DataFrame) -> DataFrame:
    """(itemid, hostid, host, name): where each item is; an item id that occurs twice stops the job."""
    items = hosts.select("hostid", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("name", F.lit("")).alias("name"), F.explode("metrics.itemid").alias("itemid"))
    scope.require_none(scope.repeated_items(items), "Duplicate itemid detected")
    return items


def role_index(scope_rows: DataFrame) -> DataFrame:
    """(hostid, role); a host with several roles, or listed twice, stops the job."""
    listed = scope_rows.filter(F.col("role").isNotNull()).select("hostid", "role")
    scope.require_none(scope.hosts_with_several_roles(listed), "Host has multiple roles")
    scope.require_none(scope.repeated_items(listed, "hostid"), "Host is listed twice")
    return listed
