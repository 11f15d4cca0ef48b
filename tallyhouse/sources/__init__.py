"""Sources and sinks: rate CSV files, population JSON, warehouse tables, test feeds."""

from tallyhouse.sources.files import (
    read_population_json,
    read_rate_csv,
    write_population_json,
    write_rate_csv,
)

__all__ = ["read_population_json", "read_rate_csv", "write_population_json", "write_rate_csv"]
