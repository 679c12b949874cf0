"""Every report against the SQL that states its result."""

import os

import pytest
from compare import TESTDATA, assert_same, connect

import __spark_entry__ as entry
from tidemark.plans import batch, oracle, stream

REPORTS = {**batch.REPORTS, **stream.REPORTS}
FOLDER = f"{TESTDATA}/sf{os.environ.get('REPORT_SF', '0.001')}"


@pytest.fixture(scope="module")
def con():
    connection = connect(FOLDER)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(oracle.STATEMENTS))
def test_report_matches_statement(spark, con, name):
    assert assert_same(REPORTS[name](spark, FOLDER), con, oracle.STATEMENTS[name]) > 0


def test_all_reports_have_a_statement():
    assert REPORTS.keys() == oracle.STATEMENTS.keys()
    assert REPORTS.keys() <= entry.queries().keys()


def test_sketch_is_close_to_exact(spark):
    exact = {r.window_end: r.uv for r in REPORTS["uv_exact"](spark, FOLDER).collect()}
    approx = {r.window_end: r.uv for r in batch.uv_approx(spark, FOLDER).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[w] - exact[w]) <= max(1, 0.15 * exact[w]) for w in exact)


def test_flagship(spark):
    result = entry.entry(spark)
    assert result.columns == ["window_end", "item_id", "cnt", "rank"]
    assert result.count() > 0
