"""Landing of history: numeric points of a closed time range with the identity and meaning of their items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.scalars import iso_utc, safe_double
from pulseframe.operators.inventory import numeric_items

IDENTITY = ("hostid", "host", "host_name", "device_role", "canonical_metric", "semantic_type", "transformation")


def land_history(points: DataFrame, items: DataFrame, first: int, last: int) -> DataFrame:
    """Points (itemid, clock, value) with ``first`` <= clock <= ``last``, joined to the numeric ones of ``items``.

    The range is a plain comparison on the stored column, so the scan skips row groups outside it; the join picks its side by
    the sizes it finds. Points without an item, and items without points, are left out.
    """
    known = numeric_items(items).select("itemid", *IDENTITY)
    kept = points.filter(F.col("clock").between(first, last)).join(known, "itemid")
    return kept.select(iso_utc(F.col("clock")).alias("timestamp"), "clock", "itemid", *IDENTITY, safe_double(F.col("value")).alias("value"))
