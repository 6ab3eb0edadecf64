"""The operators that SQL can express, against DuckDB."""

import pytest

from salesloom.llm import queries
from tests.compare import database, difference

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF), database(SF), queries.ORACLE_SQL[name]) is None
