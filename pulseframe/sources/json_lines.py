"""JSON lines: a permissive scan that sets broken lines aside, a strict one that stops at the first, and a sink.

A line is a record if it is one JSON object and nothing else; blank lines are no lines. Top-level fields are read as text and
cast, so a field of an unexpected type is null and does not make its line broken. ``NaN`` and ``Infinity`` are not JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CORRUPT = "_corrupt_line"
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "allowSingleQuotes": "false"}
_NESTED = (T.StructType, T.ArrayType, T.MapType)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, block, place, text): ``place`` rises along the lines of a block, blank ones among them."""
    text = F.btrim("value", F.lit(" \t\r\n\x0b\x0c"))
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"), text.alias("text")
    )


def _parsed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    loose = T.StructType([T.StructField(f.name, f.dataType if isinstance(f.dataType, _NESTED) else T.StringType()) for f in schema] + [T.StructField(_CORRUPT, T.StringType())])
    single = F.json_array_length(F.concat(F.lit("["), F.col("text"), F.lit("]"))) == 1
    opened, closed = F.col("text").startswith("{"), F.col("text").endswith("}")
    error = (
        F.when(~F.coalesce(single, F.lit(False)), "malformed JSON").when(~opened, "not an object")
        .when(~closed | F.col(f"row.{_CORRUPT}").isNotNull(), "malformed JSON")
    )
    return lines.filter("text <> ''").withColumn("row", F.from_json("text", loose, _OPTIONS)).withColumn("error", error)


def _fields(schema: T.StructType) -> list[Column]:
    return [(F.col(f"row.{f.name}") if isinstance(f.dataType, _NESTED) else F.col(f"row.{f.name}").try_cast(f.dataType)).alias(f.name) for f in schema]


def read_permissive(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Records of ``schema``, and (path, line, error, text) of the other lines; lines count from 1, blank ones included.

    Only broken lines are numbered: the blocks that a file was read in are counted, one row a block, and their running total tells
    how many lines lie before each. Records never leave their partition.
    """
    lines = _lines(spark, path)
    parsed = _parsed(lines, schema)
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("path", "block").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).select(
        "path", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")
    )
    errors = parsed.filter("error is not null").select("path", "block", "place", "error", "text").join(blocks, ["path", "block"]).select(
        "path", (F.col("place") - F.col("first") + F.col("earlier") + 1).alias("line"), "error", "text"
    )
    return parsed.filter("error is null").select(*_fields(schema)), errors


def read_strict(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records of ``schema``; the job fails at a broken line and names its file and text."""
    parsed = _parsed(_lines(spark, path), schema)
    refused = F.raise_error(F.concat(F.lit("Invalid JSON at "), F.col("path"), F.lit(": "), F.col("error"), F.lit(": "), F.left("text", F.lit(200))))
    return parsed.filter(F.when(F.col("error").isNull(), F.lit(True)).otherwise(refused.cast("boolean"))).select(*_fields(schema))


def write_lines(rows: DataFrame, path: str) -> int:
    """One compact object a row, nulls included; gives the number of rows, counted in the same pass."""
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("ignoreNullFields", "false").json(path)
    return seen.get["rows"]
