"""Queries that SQL can express against their statements, and what is registered."""

import pytest
from compare import TESTDATA, assert_same, connect

import __spark_entry__ as entry
from tidemark.llm import queries


@pytest.mark.parametrize("name", sorted(queries.STATEMENTS))
def test_query_matches_statement(spark, name):
    folder = f"{TESTDATA}/sf0.001"
    assert assert_same(queries.REPORTS[name](spark, folder), connect(folder), queries.STATEMENTS[name]) > 0


def test_all_are_registered():
    assert [int(name[2:].split("_")[0]) for name in queries.REPORTS] == list(range(1, 14))
    assert {*queries.REPORTS, "pipeline"} <= entry.queries().keys()
    assert queries.STATEMENTS.items() <= entry.oracle_sql().items()
