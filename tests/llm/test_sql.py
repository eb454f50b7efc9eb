"""The SQL of the corpus operators gives DuckDB the rows of their queries."""

import duckdb
import pytest

pytest.importorskip("covertrail.llm")
from covertrail.llm import queries  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    df = queries.QUERIES[name](spark, DATA)
    result = con.execute(queries.ORACLE_SQL[name])
    assert df.columns == [c[0] for c in result.description]
    assert sorted(map(tuple, df.collect())) == sorted(result.fetchall())
