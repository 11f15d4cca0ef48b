"""Column expressions (all built-in, JVM-side, codegen-friendly)."""

from tallyhouse.functions.constraints import assert_not_null, not_null_columns
from tallyhouse.functions.fingerprint import fingerprint_agg, row_hash
from tallyhouse.functions.metrics import persons_estimate, rate_gap, rate_ratio
from tallyhouse.functions.validate import (
    iso3_ok,
    population_ok,
    rate_row_ok,
    typed_rate,
    typed_year,
)

__all__ = [
    "assert_not_null", "not_null_columns", "fingerprint_agg", "row_hash",
    "persons_estimate", "rate_gap", "rate_ratio", "iso3_ok", "population_ok",
    "rate_row_ok", "typed_rate", "typed_year",
]
