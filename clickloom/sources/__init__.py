"""Readers for the input formats of the jobs."""

from clickloom.sources.readers import (
    read_click_log,
    read_impressions,
    read_lines,
    read_records,
    read_vehicles,
)

__all__ = [
    "read_click_log",
    "read_impressions",
    "read_lines",
    "read_records",
    "read_vehicles",
]
