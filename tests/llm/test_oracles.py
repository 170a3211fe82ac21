"""The corpus queries that SQL can express, against their twins."""

import compare
import pytest

from tillstream.llm import queries


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    con = compare.connect(sf_dir)
    got = compare.spark_result(queries.queries()[name](spark, sf_dir))
    assert got == compare.sql_result(con, queries.oracle_sql()[name])
