"""Canonical vocabulary shared by every stage."""

# Metric names, roles and thresholds that define the data contract.
INTERFACE_METRICS = (
    "in_bps",
    "out_bps",
    "in_pps",
    "out_pps",
    "in_error_rate",
    "out_error_rate",
    "in_discard_rate",
    "out_discard_rate",
    "oper_status",
)

DEVICE_METRICS = (
    "cpu_pct",
    "memory_pct",
    "temperature_c",
    "fan_status",
    "psu_status",
    "uptime",
    "icmp_loss_pct",
    "icmp_rtt_sec",
)

DISCARD_METRICS = ("in_discard_rate", "out_discard_rate")

ROLES = ("switch", "router", "firewall", "access_point")

NUMERIC_VALUE_TYPES = ("0", "3")

EPSILON = 1e-12
CLOSE_TOLERANCE = 1e-9

DEFAULT_BUCKET_SEC = 60
DEFAULT_WINDOWS_SEC = (300, 900)
