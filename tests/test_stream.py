"""Streams: restart from the checkpoint gives the same answer."""
import time
from datetime import datetime, timedelta

import pandas as pd

from tidewatch.streaming import stream as sm


def fixture(n=240):
    t0 = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        rows.append({"country": "A" if i % 3 else "B", "tweet_id": f"p{i:04d}", "post_seq": i,
                     "ts": t0 + timedelta(seconds=20 * i),
                     "volume": 1.0 + (i % 7) * (5 if i % 50 == 0 else 1),
                     "sentiment": ((i % 11) - 5) / 6.0, "engagement": float(i % 13),
                     "kw": ["tariffs"] * (1 + (i % 40 == 0) * 5) + (["crisis"] if i % 9 == 0 else []),
                     "is_anomaly": i % 97 == 0})
    return pd.DataFrame(rows)


PARAMS = {"window_s": 3600, "cap": 40, "every": 20, "long_cap": 60, "long_window_s": 7200}


def run(spark, src, path):
    from tidewatch.streaming import batches as mb
    det = mb.StreamDetector(mb.BatchState(path), **PARAMS)
    s = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1).parquet(src)
    sm.run_available(s, det.score, f"{path}/checkpoint")


def scores(df):
    cols = ["tweet_id", "g", "n", "composite_score", "severity", "alert_required"]
    return df.select(*cols).toPandas().sort_values("tweet_id").reset_index(drop=True)


def test_detector_restart_equals_single_run(spark, tmp_path):
    """Micro-batches with a restart between them give the scores of one table,
    and carry a bounded number of posts per key."""
    from tidewatch.operators.anomaly import with_key_index
    from tidewatch.plans.scoring import score_by_index
    pdf = fixture()
    path, src = str(tmp_path / "run"), str(tmp_path / "src")
    for lo, hi in ((0, 70), (70, 120), (120, 240)):
        spark.createDataFrame(pdf.iloc[lo:hi]).coalesce(1).write.mode("append").parquet(src)
        if lo != 0:
            run(spark, src, path)                 # two batches, then a restart and one more
        time.sleep(1.1)
    a = scores(spark.read.parquet(f"{path}/scored"))
    whole, _ = score_by_index(with_key_index(spark.createDataFrame(pdf)), **PARAMS)
    pd.testing.assert_frame_equal(a, scores(whole), check_exact=False, rtol=1e-9)
    assert len(a) == len(pdf) and (a["n"] >= 10).any() and a["alert_required"].any()


def plain_baselines(values, times, every, cap, window_s):
    """C5 post by post: {g: (mean, std)} of one metric in force for post g."""
    import numpy as np
    force, out = (10.0, 3.0), {}
    for g in range(1, len(values) + 1):
        if g % every == 0:
            v = np.array([x for x, t in list(zip(values, times))[max(0, g - cap):g] if (times[g - 1] - t).total_seconds() <= window_s])
            if len(v) >= 10:
                q1, q3 = np.percentile(v, [25, 75])
                inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
                if len(inside):
                    force = (inside.mean(), max(inside.std(), 0.01))
        out[g] = force
    return out


def test_baselines_by_post_number(spark):
    from tidewatch.operators import anomaly as an
    pdf = fixture()
    mg = an.with_key_index(spark.createDataFrame(pdf)).checkpoint()
    rows = an.attach_indexed_baselines(mg, an.indexed_baselines(mg, every=20, cap=60, window_s=900), every=20).collect()
    for key in ("A", "B"):
        own = pdf[pdf.country == key]
        want = plain_baselines(own.volume.tolist(), own.ts.tolist(), 20, 60, 900)
        got = {r.g: (r.b_volume_mean, r.b_volume_std) for r in rows if r.country == key}
        assert set(got) == set(want)
        assert all(abs(x - y) < 1e-9 for g in want for x, y in zip(got[g], want[g]))


def test_post_index_of_a_hot_second(spark):
    """A third of all posts in one second of one key: the index is right, and no task sorts them all."""
    from pyspark.sql import functions as F
    from tidewatch.operators.anomaly import with_key_index
    df = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 2 == 0, None).otherwise("cold").alias("country"),
                                   F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"), F.col("id").alias("post_seq"))
    ix = with_key_index(df)
    rows = ix.collect()
    for key in ("HOT", "cold", None):
        own = sorted((r.post_seq, r.g) for r in rows if r.country == key)
        assert [g for _, g in own] == list(range(1, len(own) + 1))
    assert max(r[1] for r in ix.groupBy(F.spark_partition_id()).count().collect()) < 3_000


def test_three_sizes_from_panes(spark):
    import numpy as np
    pdf = fixture(300)
    s = spark.createDataFrame(pdf).withColumn("event_ts", sm.F.col("ts").cast("timestamp"))
    p = sm.panes(s, keys=("country",))
    got = {(r.country, r["size"], r.window_start): r for r in sm.merge_panes(p, {"five": 5, "half": 30}).collect()}
    for name, minutes in (("five", "5min"), ("half", "30min")):
        for (key, start), own in pdf.groupby(["country", pdf.ts.dt.floor(minutes)]):
            r = got.pop((key, name, start.to_pydatetime()))
            assert r.n == len(own) and abs(r.mean_volume - own.volume.mean()) < 1e-9 and abs(r.std_sentiment - np.std(own.sentiment)) < 1e-7
    assert not got


def test_progress_counters(spark, tmp_path):
    """Per-batch input rows from the query progress."""
    pdf = fixture(60)
    src = str(tmp_path / "src")
    spark.createDataFrame(pdf).write.parquet(src)
    s = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    q = sm.run_available(s.select("tweet_id"), str(tmp_path / "o"), str(tmp_path / "c"))
    pc = sm.ProgressCounters()
    pc.record(q)
    assert sum(b["input_rows"] for b in pc.batches) == 60


def test_feed_is_not_shuffled_and_slots_have_equal_numbers_of_files(spark, tmp_path):
    """whole messages were shuffled per slot and written uncompressed.  Slots whose messages all
    lie in one partition have as many files as the others, so no message comes late."""
    from tidewatch.streaming import stream as sm
    rows = spark.range(0, 600, 1, 6).selectExpr("cast(id as string) as key", "repeat(concat('text ', id, ' '), 40) as value",
                                                "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, cast(id as int)) as timestamp")
    path = str(tmp_path / "feed")
    sm.write_slots(rows, path, slots=6, files=4)
    names = sorted((f.stat().st_mtime_ns, f.name) for f in (tmp_path / "feed").iterdir() if f.name.startswith("part-"))
    assert len(names) == 6 * 4 + 1 and all(n.endswith(".json.gz") for _, n in names)
    seen = []
    q = (sm.read_posts(spark, {"format": "json", "path": path, "maxFilesPerTrigger": 4}).writeStream.trigger(availableNow=True)
         .option("checkpointLocation", str(tmp_path / "ck")).foreachBatch(lambda b, _: seen.append(sorted(int(r[0]) for r in b.where("not heartbeat").select("key").collect()))).start())
    q.awaitTermination()
    assert sorted(k for b in seen for k in b) == list(range(600))
    assert [max(b) for b in seen[:6]] < [min(b) for b in seen[1:6]] + [600]
