"""Every registered query of the library against its SQL on the smallest test tables."""

import math
from pathlib import Path

import duckdb
import pytest

from paperloom.plans import catalog

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, str(DATA))
    columns = sorted(df.columns)
    found = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in catalog.oracle_sql():
        assert found
        return
    result = duck.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert found == sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall())
