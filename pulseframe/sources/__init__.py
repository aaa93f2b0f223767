"""Scans and sinks: JSON lines, nested documents, landed points, reports, matrices and ordered files."""
