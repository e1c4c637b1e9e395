"""Hot-key splitting is exact: chunked + halo results equal one chunk per key."""
from datetime import datetime, timedelta

import pandas as pd

from tidewatch.operators import anomaly as an


def frame_rows(n=900):
    t0 = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        # one hot key with 2/3 of the rows, bursts and gaps, equal timestamps
        key = "HOT" if i % 3 else "cold"
        sec = (i * 37) % 7 * 60 + (i // 3) * 45 + (0 if i % 50 else 3600)
        rows.append({"country": key, "post_seq": i, "tweet_id": f"p{i}",
                     "ts": t0 + timedelta(seconds=sec - sec % 15),
                     "volume": 1.0 + i % 5, "engagement": float(i % 11),
                     "sentiment": ((i * 13) % 17 - 8) / 8.0, "scenario": "abc"[(i // 7) % 3]})
    return pd.DataFrame(rows)


def test_frames_chunked_equal_unchunked(spark):
    df = spark.createDataFrame(frame_rows())
    cols = ["tweet_id", "n", "vol_last3", "eng_last3", "sent_last5", "sent_hist"]
    small = an.with_frames(df, window_s=1800, cap=40, chunk=50).select(*cols).toPandas()
    whole = an.with_frames(df, window_s=1800, cap=40, chunk=10 ** 8).select(*cols).toPandas()
    a = small.sort_values("tweet_id").reset_index(drop=True)
    b = whole.sort_values("tweet_id").reset_index(drop=True)
    assert len(a) == 900 and (a["n"] >= 10).any()
    ok = a["n"] >= 10   # the means are only used (and only defined) from 10 rows on
    pd.testing.assert_series_equal(a["n"], b["n"])
    pd.testing.assert_frame_equal(a[ok], b[ok], check_exact=False, rtol=1e-12)


def test_scenario_changes_chunked_equal_lag(spark):
    df = spark.createDataFrame(frame_rows())
    a = {r["tweet_id"]: r["previous"] for r in an.scenario_changes(df, chunk_s=900).collect()}
    b = {r["tweet_id"]: r["previous"] for r in an.scenario_changes(df, chunk_s=10 ** 8).collect()}
    assert a == b and len(a) > 50
