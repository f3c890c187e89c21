"""Registered corpus queries against their SQL, over whole tables."""

import glob
import os

import duckdb
import pytest

from tallywright.llm.oracles import ORACLES
from tallywright.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
LARGER = "/root/testdata/sf0.1"  # has boilerplate lines beyond the limit


@pytest.mark.parametrize(
    ("name", "folder"), [*[(n, FOLDER) for n in sorted(ORACLES)], ("op6_quality_rules", LARGER)]
)
def test_query(spark, name, folder):
    db = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    got, want = QUERIES[name](spark, folder), db.sql(ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    kinds = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    types = dict(zip(want.columns, map(str, want.types), strict=True))
    assert {f.name: kinds[f.dataType.simpleString()] for f in got.schema} == types
    rows = sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr)
    place = [want.columns.index(c) for c in columns]
    assert rows == sorted((tuple(r[i] for i in place) for r in want.fetchall()), key=repr)
    assert rows
