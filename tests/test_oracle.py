"""Every registered query with a SQL counterpart gives the same rows."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from check import rows_of  # noqa: E402
from rebasket.plans import oracle, queries  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


# hundreds of rounds of boosting; compared on demand: python check.py <sf_dir> tune_grid tune_random
LONG = {"tune_grid", "tune_random"}


@pytest.mark.parametrize("name", sorted(set(oracle.oracle_sql()) - LONG))
def test_same_rows_as_sql(spark, duck, name):
    frame = entry.queries()[name](spark, SF_DIR)
    result = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(names, result.fetchall())


def test_every_query_has_sql():
    assert set(queries.queries()) == set(oracle.oracle_sql())


def test_entry_has_the_model_inputs(spark):
    from rebasket.functions.ratios import FEATURES

    frame = entry.entry(spark)
    assert set(FEATURES) | {"user_id", "product_id"} == set(frame.columns)
    assert frame.count() > 0
