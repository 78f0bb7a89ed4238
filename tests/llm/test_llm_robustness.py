"""The queries of the subpackage on empty tables, and on tables with null and repeated rows and extra columns of clashing names."""

import pytest
from conftest import DATA
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from signalframe.llm import catalog

TABLES = ("documents", "subject_areas", "subject_labels", "mix_targets", "physical_records", "source_databases", "source_generations")
CLASHING = ("ids", "n_tokens", "given", "sentences", "structure", "key", "range", "uses", "grp", "copy", "field", "value", "rank", "cell", "trust", "seen", "seen_at", "bpm", "zone_name", "__v", "__o0")


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    for name in TABLES:
        df = spark.read.parquet(f"{DATA}/sf0.001/{name}.parquet")
        df.limit(0).write.parquet(f"{root}/empty/{name}.parquet")
        loose = StructType([StructField(f.name, f.dataType, True) for f in df.schema.fields])
        odd = df.unionByName(spark.createDataFrame([tuple(None for _ in df.columns)] * 3, loose))
        if name == "physical_records":  # a repeated document is a second document
            odd = odd.unionByName(df.limit(50))
        odd.withColumns({c: F.lit("x") for c in CLASHING if c not in df.columns}).write.parquet(f"{root}/odd/{name}.parquet")
    return root


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_empty_tables(spark, folders, name):
    assert catalog.queries()[name](spark, f"{folders}/empty").count() == 0


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_nulls_repeats_and_clashing_columns_change_nothing(spark, folders, name):
    def result(folder):
        df = catalog.queries()[name](spark, folder)
        key = {"p8_ids": "doc_id", "p9_shares": "source"}.get(name)
        return sorted(tuple(str(x) for x in r) for r in (df.filter(f"{key} is not null") if key else df).collect())

    assert result(f"{folders}/odd") == result(f"{DATA}/sf0.001")
