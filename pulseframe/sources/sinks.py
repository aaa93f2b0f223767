"""Sinks: one JSON report, a matrix as CSV with twelve significant digits, and files in the order of their keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

DIGITS = 12


def write_report(report: DataFrame, path: str) -> None:
    """A table of one row as one JSON document."""
    report.limit(1).select(F.to_json(F.struct(*report.columns), {"ignoreNullFields": "false"}).alias("value")).coalesce(1).write.text(path)


def significant(number: Column, digits: int = DIGITS) -> Column:
    """Text of a double with ``digits`` significant digits, as ``%.12g`` writes it.

    Exponents from -4 to below ``digits`` are written out, others as mantissa and exponent of at least two figures; zeros behind
    the last other digit go, and so does a point behind which nothing is left. Digits come from the shortest text of the
    number, rounded half up; of subnormal numbers (below 2.3e-308) no more are shown.
    """
    number = number.cast("double")
    text = F.format_string(f"%.{digits - 1}e", number)
    sign = F.when(text.startswith("-"), "-").otherwise("")
    mantissa, exponent = F.substring_index(text, "e", 1), F.substring_index(text, "e", -1)
    figures, power = F.regexp_replace(mantissa, "[-.]", ""), exponent.try_cast("int")
    point = F.greatest(power + 1, F.lit(0))
    lead = F.when(power < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), figures)).otherwise(
        F.concat(F.substring(figures, F.lit(1), point), F.lit("."), F.substring(figures, point + 1, F.lit(digits)))
    )
    plain = F.regexp_replace(lead, r"\.?0*$", "")
    scientific = F.concat(F.regexp_replace(F.regexp_replace(mantissa, "^-", ""), r"\.?0*$", ""), F.lit("e"), exponent)
    written = F.concat(sign, F.when((power < -4) | (power >= digits), scientific).otherwise(plain))
    return F.when(number.isNull(), F.lit(None)).when(F.isnan(number), "nan").when(F.abs(number) == F.lit(float("inf")), F.concat(sign, F.lit("inf"))).otherwise(written)


def write_matrix(rows: DataFrame, features: Sequence[str], path: str) -> int:
    """Features as CSV files, each with a header; gives the number of rows, counted in the same pass."""
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.select(*[significant(F.col(f)).alias(f) for f in features]).write.option("header", True).csv(path)
    return seen.get["rows"]


def numeric_first(name: str) -> list[Column]:
    """Order of ids: numbers by value, then the others by text."""
    return [F.asc_nulls_last(F.col(name).try_cast("bigint")), F.asc_nulls_last(name)]


def write_ordered(rows: DataFrame, order: Sequence[Column], path: str, files: int | None = None) -> None:
    """Parquet files that hold ranges of ``order`` one after another, each sorted: file by file the whole table is in order.

    Ranges come from a sample of the keys, so files are about equal; rows equal in ``order`` stay in one file.
    """
    ranged = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.parquet(path)
