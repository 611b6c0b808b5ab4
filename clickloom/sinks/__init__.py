"""Writers for the output formats of the jobs."""

from clickloom.sinks.writers import (
    Counted,
    write_city_buckets,
    write_city_tuples,
    write_csv,
    write_records,
    write_routed,
    write_tab_separated,
    write_tuples,
)

__all__ = [
    "Counted",
    "write_city_buckets",
    "write_city_tuples",
    "write_csv",
    "write_records",
    "write_routed",
    "write_tab_separated",
    "write_tuples",
]
