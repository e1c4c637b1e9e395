"""Registered queries vs their DuckDB oracle SQL on sf0.001 (driver check)."""
import math

import duckdb
import pytest

import __spark_entry__ as entry
from tidewatch.sources.tables import TABLES

from .conftest import SF001

CHEAP = ["t02_clean_text", "t05_urgency", "t12_keywords", "t16_valence", "t18_trade",
         "t21_ensemble", "c03_frames", "c08_keyword_decay", "c11_composite", "d01_alerts",
         "e01_sentiment_distribution", "j01_regions", "t25_parse_time", "a04_defaults",
         "s02_stream_buckets", "c05_index_scores"]


def norm(rows):
    def n(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return v.item() if hasattr(v, "item") else v
    return sorted((tuple(n(x) for x in r) for r in rows), key=str)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", CHEAP)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF001)
    cols = sorted(df.columns)
    s = df.select(*cols).toPandas()
    d = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(d.columns) == cols
    assert norm(s.itertuples(index=False, name=None)) == norm(d[cols].itertuples(index=False, name=None))


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"country", "posts", "mean_sentiment", "anomalies", "alerts"}


def test_every_query_has_oracle_or_is_sequential():
    from tidewatch.plans import catalog
    no_oracle = set(catalog.REGISTRY) - set(entry.oracle_sql())
    assert not no_oracle
