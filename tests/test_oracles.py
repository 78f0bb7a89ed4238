"""Every query with SQL equals it on the smallest data."""

import glob
import os
from math import isclose

import duckdb
import pytest
from conftest import DATA

from signalframe.plans import catalog

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


@pytest.fixture(scope="module", autouse=True)
def features_once():
    """Many queries start from the features of the same folder: here they are made once."""
    from signalframe.plans import feature_queries as q
    from signalframe.session import materialize

    with pytest.MonkeyPatch.context() as m:
        for name in ("night_features", "day_features"):
            made, real = {}, getattr(q, name)

            def once(spark, d, made=made, real=real, **options):
                key = (d, *sorted(options.items()))
                if key not in made:
                    made[key] = materialize(real(spark, d, **options))
                return made[key]

            m.setattr(q, name, once)
        yield


def plain(v):
    if v is None or v != v:
        return ("0",)
    return ("n", round(float(v), 6)) if isinstance(v, (int, float)) and not isinstance(v, bool) else ("s", str(v))


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df = catalog.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted([plain(r[c]) for c in columns] for r in df.collect())
    cur = con.execute(catalog.oracle_sql()[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == columns
    want = sorted([plain(r[names.index(c)]) for c in columns] for r in cur.fetchall())
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        for x, y in zip(a, b, strict=True):
            assert x == y or (x[0] == y[0] == "n" and isclose(x[1], y[1], rel_tol=1e-9, abs_tol=2e-6)), (a, b)


def test_every_query_is_registered_once():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
    assert sum(len(m.QUERIES) for m in catalog.MODULES) == len(catalog.queries())
