"""Interface index from item key text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pattern lists of the feature stage and of the individual audits, first match wins.
FEATURE_PATTERNS = (
    r"if(?:HC)?InOctets\.(\d+)",
    r"if(?:HC)?OutOctets\.(\d+)",
    r"ifInUcastPkts\.(\d+)",
    r"ifOutUcastPkts\.(\d+)",
    r"ifInErrors\.(\d+)",
    r"ifOutErrors\.(\d+)",
    r"ifInDiscards\.(\d+)",
    r"ifOutDiscards\.(\d+)",
    r"ifOperStatus\.(\d+)",
    r"ifAdminStatus\.(\d+)",
)
TRAILING_PATTERN = r"\.(\d+)\]$"
QUOTED_PATTERN = r"""["'](\d+)["']\]$"""
BRACKET_PATTERN = r"(\d+)\]$"
TEMPORAL_PATTERNS = (
    r"if(?:In|Out)(?:Discards|Errors|Octets|UcastPkts|NUcastPkts|OperStatus)\.(\d+)",
    r"if(?:Index|Descr|Name|Alias|Type)\.(\d+)",
)
DEVICE_PATTERNS = (
    r"\bif(?:HC)?InOctets\.(\d+)\b",
    r"\bif(?:HC)?OutOctets\.(\d+)\b",
    r"\bifInUcastPkts\.(\d+)\b",
    r"\bifOutUcastPkts\.(\d+)\b",
    r"\bifInErrors\.(\d+)\b",
    r"\bifOutErrors\.(\d+)\b",
    r"\bifInDiscards\.(\d+)\b",
    r"\bifOutDiscards\.(\d+)\b",
    r"\bifOperStatus\.(\d+)\b",
    r"\bifAdminStatus\.(\d+)\b",
    r"\bifInUnknownProtos\.(\d+)\b",
    r"\bifInMulticastPkts\.(\d+)\b",
    r"\bifInBroadcastPkts\.(\d+)\b",
    r"\bifOutMulticastPkts\.(\d+)\b",
    r"\bifOutBroadcastPkts\.(\d+)\b",
)
DEEP_PATTERNS = (
    r"if(?:In|Out)(?:Octets|Errors|Discards)\.(\d+)",
    r"if(?:In|Out)(?:UcastPkts|NUcastPkts|MulticastPkts|BroadcastPkts)\.(\d+)",
    r"ifOperStatus\.(\d+)",
    r"ifAdminStatus\.(\d+)",
    r"ifSpeed\.(\d+)",
    r"ifHCInOctets\.(\d+)",
    r"ifHCOutOctets\.(\d+)",
)


@dataclass(frozen=True)
class Variant:
    patterns: tuple[str, ...]
    ignore_case: bool = False


VARIANTS = {
    "features": Variant(tuple(f"(?i){p}" for p in FEATURE_PATTERNS) + (TRAILING_PATTERN,)),
    "raw_cross_metric": Variant((TRAILING_PATTERN,)),
    "cross_metric": Variant((TRAILING_PATTERN, QUOTED_PATTERN, BRACKET_PATTERN)),
    "temporal": Variant(TEMPORAL_PATTERNS, ignore_case=True),
    "device_pattern": Variant(DEVICE_PATTERNS),
    "correlation": Variant(FEATURE_PATTERNS, ignore_case=True),
    "deep": Variant(DEEP_PATTERNS),
}


def parse_ifindex(key: Column, variant: str = "features") -> Column:
    """First capture of the variant's patterns as a bigint, null when none matches."""
    chosen = VARIANTS[variant]
    prefix = "(?i)" if chosen.ignore_case else ""
    captures = [
        F.nullif(F.regexp_extract(key, prefix + p, 1), F.lit("")) for p in chosen.patterns
    ]
    return F.coalesce(*captures).try_cast("bigint")
