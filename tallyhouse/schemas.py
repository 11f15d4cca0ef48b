"""Fixed table schemas (nothing is inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the data contract: column order of the rate files and the natural keys.
RATE_FILE_COLUMNS = ["iso_code", "country", "sex", "age", "year", "obs_value"]
RATE_KEYS = ["iso_code", "sex", "age", "year"]
SLICE_KEYS = ["iso_code", "year"]
POPULATION_KEYS = ["iso_code"]

RATE = T.DecimalType(10, 3)
RATIO = T.DecimalType(12, 6)
PERSONS = T.DecimalType(22, 2)

# Position of a row in its source: decides keep-first / keep-last.
POSITION = T.StructType([
    T.StructField("file", T.StringType(), False),
    T.StructField("block", T.LongType(), False),
    T.StructField("seq", T.LongType(), False),
])

RATE_FILE = T.StructType([T.StructField(c, T.StringType(), True) for c in RATE_FILE_COLUMNS])

RAW_RATE = T.StructType(RATE_FILE.fields + [
    T.StructField("loaded_at", T.TimestampNTZType(), False),
])

RAW_POPULATION = T.StructType([
    T.StructField("iso_code", T.StringType(), False),
    T.StructField("country", T.StringType(), False),
    T.StructField("population", T.LongType(), False),
    T.StructField("api_loaded_at", T.TimestampNTZType(), False),
])


def staged_rate(value_column: str) -> T.StructType:
    return T.StructType([
        T.StructField("iso_code", T.StringType(), False),
        T.StructField("country", T.StringType(), False),
        T.StructField("sex", T.StringType(), False),
        T.StructField("age", T.StringType(), False),
        T.StructField("year", T.IntegerType(), False),
        T.StructField(value_column, RATE, False),
    ])


# Load time column of the staging and mart tables, one value per run.
LOADED_AT = "etl_loaded_at"
SNAPSHOT_AT = "snapshot_loaded_at"

# NOT NULL columns per table, checked when the table is written.
_RATE = ["iso_code", "country", "sex", "age", "year"]
_SLICE = ["iso_code", "country", "year", "employment_rate_15plus_total", "unemployment_rate_15plus_total"]
REQUIRED = {
    "population_raw": ["iso_code", "country", "population"],
    "employment_stg": [*_RATE, "employment_rate"],
    "unemployment_stg": [*_RATE, "unemployment_rate"],
    "population_stg": ["iso_code", "country", "population"],
    "country_year_sex_age_rates": [*_RATE, "employment_rate", "unemployment_rate"],
    "country_year_total_15plus": _SLICE,
    "country_population": ["iso_code", "country", "population"],
    "country_year_total_15plus_with_population": [*_SLICE, "population"],
    "etl_source_audit": ["source_name", "observed_rows", "observed_fingerprint", "change_type"],
}


AUDIT = T.StructType([
    T.StructField("source_name", T.StringType(), False),
    T.StructField("observed_rows", T.LongType(), False),
    T.StructField("observed_fingerprint", T.LongType(), False),
    T.StructField("previous_rows", T.LongType(), True),
    T.StructField("previous_fingerprint", T.LongType(), True),
    T.StructField("delta_rows", T.LongType(), True),
    T.StructField("new_rows", T.LongType(), True),
    T.StructField("removed_rows", T.LongType(), True),
    T.StructField("change_type", T.StringType(), False),
    T.StructField("observed_at", T.TimestampNTZType(), False),
])
