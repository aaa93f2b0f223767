"""Telemetry-to-features jobs expressed as Spark DataFrame transformations."""
