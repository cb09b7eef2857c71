"""Every query on shaped documents against its SQL."""

from __future__ import annotations

import duckdb
import pytest

from sheaf.plans import recovery, shapes
from sheaf.plans.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
assert recovery.cases is shapes.cases  # its queries are registered by the same function
NAMES = [n for n, f in QUERIES.items() if f.__module__ == shapes.__name__]


@pytest.mark.parametrize("name", NAMES)
def test_shapes(spark, name):
    got = QUERIES[name](spark, SF)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW customer AS SELECT * FROM '{SF}/customer.parquet'")
    want = con.sql(ORACLES[name])
    assert got.columns == want.columns
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want.fetchall(), key=key)
