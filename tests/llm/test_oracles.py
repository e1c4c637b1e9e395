"""llm queries that have SQL, against DuckDB on the smallest tables."""
import duckdb
import pytest

import __spark_entry__ as entry
from tidewatch.llm.queries import QUERIES
from tidewatch.llm.sql import ORACLE_SQL

from .common import SF, same


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    same(QUERIES[name](spark, SF).toPandas(), con.execute(ORACLE_SQL[name]).df())


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
