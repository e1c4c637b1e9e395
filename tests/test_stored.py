"""Whole messages and records on disk: compressed copies that are deleted, no join that shuffles them."""
import re
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewatch.plans import catalog
from tidewatch.session import shared_path
from tidewatch.sources import sinks
from tidewatch.streaming import stream as sm


@pytest.fixture
def tables(spark, tmp_path):
    """40 events, the last one twice, over 5 documents."""
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))

    put("documents", [(i, f"Talks on tariffs number {i} go on.", "en") for i in range(5)], "doc_id long, text string, lang string")
    t0 = datetime(2024, 1, 30)
    events = [(i, t0 + timedelta(hours=i), i, "view", float(i), '{"k": %d}' % i) for i in range(40)]
    put("events", events + events[-1:], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    put("nation", [(i, f"N{i}", i % 5) for i in range(25)], "n_nationkey int, n_name string, n_regionkey int")
    put("region", [(i, f"R{i}") for i in range(5)], "r_regionkey int, r_name string")
    return str(tmp_path)


def left(spark) -> set:
    at = Path(shared_path(spark, "stored").removeprefix("file:"))
    return {x.name for x in at.iterdir()} if at.is_dir() else set()


def test_quarantine_shuffles_no_messages(spark, tables):
    """Messages were shuffled to get their post's number and time back.  A message still meets every row of its id."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        d = catalog.REGISTRY["a03_quarantine"](spark, tables)
        plan = spark._jvm.PythonSQLUtils.explainString(d._jdf.queryExecution(), "formatted")
        inputs = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", plan)
        assert inputs and not any(c.startswith("value#") and len(x.split(", ")) == 2 or c.startswith("_at#") for x in inputs for c in x.split(", "))
        got = sorted((r.key, r.status) for r in d.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert got == sorted((f"post_{i}", "rejected" if i % 11 < 2 or i % 22 == 2 else "good") for i in [*range(40), 39, 39, 39])


def test_upsert_keeps_no_copies(spark, tmp_path):
    """Two raw checkpoints of whole records stayed per upsert."""
    before, path = left(spark), str(tmp_path / "table")
    rows = spark.range(20).select(F.col("id").cast("string").alias("k"), F.expr("timestamp_ntz'2024-01-20' + make_interval(0, 0, 0, cast(id as int))").alias("ts"), F.lit(1).alias("v"))
    sinks.upsert_monthly(spark, rows, path, "k", "ts")
    sinks.upsert_monthly(spark, rows.where("id % 2 = 0").withColumn("v", F.lit(2)), path, "k", "ts")
    assert sorted((int(r.k), r.v) for r in spark.read.parquet(path).collect()) == [(i, 1 + (i % 2 == 0)) for i in range(20)]
    assert left(spark) == before


def test_feed_is_stored_once_compressed_and_the_copy_deleted(spark, tables, tmp_path, monkeypatch):
    """The feed's messages stayed as a raw checkpoint, and a batch had a quarter of the session's tasks."""
    kept, before = [], left(spark)
    monkeypatch.setattr(sm.sinks, "stored", lambda df, plain=sinks.stored: kept.append(plain(df)) or kept[-1])
    path = catalog._feed(spark, tables)
    assert len(kept) == 1 and left(spark) == before
    assert catalog._feed_files(spark) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    feed = spark.read.schema(sm.FEED_SCHEMA).json(path)
    assert sorted(r.key for r in feed.where("not heartbeat").collect()) == sorted(f"post_{i}" for i in [*range(40), 39])
    assert len(feed.inputFiles()) == catalog.FEED_SLOTS * catalog._feed_files(spark) + 1
