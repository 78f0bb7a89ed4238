"""The pN_ queries on empty tables, and on tables with null rows, repeated rows and extra columns of clashing names."""

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from signalframe.plans.problems import QUERIES

TABLES = ("heart_rate", "sleep_sessions", "daily_summary", "physical_records", "source_generations", "source_databases")
#: Names that the operators use inside.
CLASHING = ("e", "s", "t", "k", "at", "day", "shard", "slot", "key", "src", "gen", "seen", "bucket", "snap", "more", "minor", "id", "value", "g", "own", "instant_us", "ts", "off", "v", "n", "kind2", "__e", "__day", "__n")


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    for name in TABLES:
        df = spark.read.parquet(f"{DATA}/sf0.001/{name}.parquet")
        df.limit(0).write.parquet(f"{root}/empty/{name}.parquet")
        nulls = spark.createDataFrame([tuple(None for _ in df.columns)] * 3, _nullable(df))
        extra = df.unionByName(df.limit(50)).unionByName(nulls)
        extra.withColumns({c: F.lit("x") for c in CLASHING if c not in df.columns}).write.parquet(f"{root}/odd/{name}.parquet")
    return root


def _nullable(df):
    from pyspark.sql.types import StructField, StructType

    return StructType([StructField(f.name, f.dataType, True) for f in df.schema.fields])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, folders, name):
    assert QUERIES[name](spark, f"{folders}/empty").count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_nulls_repeats_and_clashing_columns_change_nothing(spark, folders, name):
    def result(folder):
        df = QUERIES[name](spark, folder)
        return sorted((tuple(str(x) for x in r) for r in df.select(*sorted(c for c in df.columns if c not in ("n", "mean_value", "carried_value"))).collect()))

    assert result(f"{folders}/odd") == result(f"{DATA}/sf0.001")
