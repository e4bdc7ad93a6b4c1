"""Every registered query against its SQL twin, and rules its plan must keep."""

import duckdb
import pytest
from tests.conftest import plan_of

import __spark_entry__ as entry
from scripts.check_oracles import connect, rows_of
from trendloom.registry.queries import ORACLES, QUERIES

PYTHON_OPERATORS = {"classify_keywords", "fuzzy_lut_join", "fuzzy_lut_ext_join", "label_residual", "label_ledger", "label_write_back", "ml_label", "stream_enrich"}


@pytest.fixture(scope="module")
def con(sf_dir) -> duckdb.DuckDBPyConnection:
    return connect(sf_dir)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if name not in PYTHON_OPERATORS:
        assert "ArrowEvalPython" not in plan and "MapInPandas" not in plan
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name in ORACLES:
        cursor = con.execute(ORACLES[name])
        names = [d[0] for d in cursor.description]
        assert sorted(names) == sorted(df.columns)
        assert mine == rows_of(names, cursor.fetchall())


def test_entry_runs(spark, sf_dir):
    assert entry.entry(spark).count() > 0


def test_all_have_a_twin():
    assert set(QUERIES) == set(ORACLES)
