"""Exact quantiles by refinement equal percentile."""
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidewatch.operators import anomaly as an
from tidewatch.operators.quantiles import exact_quantiles


def table(spark, n=20_000):
    rng = np.random.default_rng(7)
    key = rng.choice(["hot", "b", "c", "one"], n, p=[0.7, 0.2, 0.0999, 0.0001])
    df = pd.DataFrame({"country": key, "volume": rng.lognormal(0, 9, n), "sentiment": rng.choice([-1.0, 0.0, 0.25], n),
                       "engagement": np.where(rng.random(n) < 0.5, 3.0, rng.normal(0, 1e-9, n))})
    return spark.createDataFrame(pd.concat([df, pd.DataFrame({"country": ["one"], "volume": [1.5], "sentiment": [0.0], "engagement": [-2.0]})]))


def test_quantiles_equal_percentile(spark):
    df = table(spark)
    got = {r.country: r for r in exact_quantiles(df, ["country"], an.METRICS).collect()}
    want = df.groupBy("country").agg(*[F.percentile(m, [0.25, 0.75]).alias(m) for m in an.METRICS]).collect()
    assert set(got) == {r.country for r in want}
    for r in want:
        for m in an.METRICS:
            np.testing.assert_allclose(got[r.country][f"_q_{m}"], r[m], rtol=1e-12, atol=1e-300)


def test_quantiles_of_nulls_and_nothing(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", None, None), ("a", 4.0, None)], "k string, x double, y double")
    r = exact_quantiles(df, ["k"], ("x", "y")).collect()
    assert len(r) == 1 and list(r[0]["_q_x"]) == [1.75, 3.25] and r[0]["_q_y"] is None
    assert exact_quantiles(df.limit(0), ["k"], ("x",)).count() == 0


def test_hot_buckets_have_the_same_baselines(spark, monkeypatch):
    df = table(spark).withColumn("ts", F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz"))
    plain = an.bucket_baselines(df).toPandas().sort_values("country").reset_index(drop=True)
    monkeypatch.setattr(an, "HOT_ROWS", 1_000)
    hot = an.bucket_baselines(df).toPandas().sort_values("country").reset_index(drop=True)
    pd.testing.assert_frame_equal(plain, hot[plain.columns], check_exact=False, rtol=1e-9)


