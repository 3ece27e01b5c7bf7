"""Every registered query with a SQL statement, compared on DuckDB at the smallest scale."""

import pytest

import __spark_entry__ as entry
import compare

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_statement_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert compare.type_diff(df, con, ORACLES[name]) == []
    assert compare.diff(df, con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_refreshed_boards_equal_a_full_run(spark):
    key = lambda df: sorted((r.board, r.poly_id, r.area, r.vertices) for r in df.collect())
    assert key(QUERIES["refreshed_boards"](spark, SF_DIR)) == key(QUERIES["stitch_boards"](spark, SF_DIR))


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["board", "pred_count", "gt_count", "tp", "fp", "fn"] and df.count() > 0
