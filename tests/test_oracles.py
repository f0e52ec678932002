"""Every registered query against its SQL on the smallest data set."""

from __future__ import annotations

import pathlib
import sys

import duckdb
import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry_points
import check_oracle

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in check_oracle.TABLES:
        c.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    line = check_oracle.run(spark, con, FOLDER, name)
    assert line.startswith("ok"), line
