"""Every written table has exactly the declared columns and types (typed sinks)."""

from tallyhouse import schemas
from tallyhouse.plans import staging as S
from tallyhouse.plans.layers import layers_from_tables
from tallyhouse.session import fresh_scratch_path
from tallyhouse.sources import files, testfeeds
from tests.conftest import SMALL


def shape(struct):
    return [(f.name, f.dataType.simpleString()) for f in struct.fields]


def test_layer_schemas(spark):
    L = layers_from_tables(spark, SMALL)
    assert shape(L.raw_employment.drop("_pos").schema) == shape(schemas.RAW_RATE)
    assert shape(L.raw_population.schema) == shape(schemas.RAW_POPULATION)
    assert shape(L.stg_employment.schema) == shape(schemas.staged_rate("employment_rate"))
    assert shape(L.stg_unemployment.schema) == shape(schemas.staged_rate("unemployment_rate"))
    assert [c for c, _ in shape(L.fact.schema)][-2:] == ["unemployment_to_employment_ratio",
                                                         "unemployment_minus_employment"]
    assert dict(shape(L.with_population.schema))["unemployment_persons_est"] == "decimal(22,2)"


def test_csv_position_schema(spark):
    path = fresh_scratch_path(spark, "pos")
    files.write_rate_csv(testfeeds.employment_feed(spark, SMALL).limit(5), path)
    df = files.read_rate_csv(spark, path)
    assert shape(df.select("_pos").schema.fields[0].dataType) == shape(schemas.POSITION)
    assert shape(S.land_rates(df, "2025-01-01 00:00:00").drop("_pos").schema) == shape(schemas.RAW_RATE)
