"""Composition: posts -> text analysis -> metrics -> detectors -> scores.

The metric rows are checkpointed before they are sorted for their post index
and after, because four branches (frames, baselines, bucket ends, keyword
fold) read them; so the text analysis runs once.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import constants as K
from tidewatch.functions import sentiment as st
from tidewatch.functions import text as tx
from tidewatch.operators import anomaly as an
from tidewatch.operators import keywords as kwo
from tidewatch.operators.lookups import small_side

METRIC_COLS = ["tweet_id", "post_seq", "ts", "country", "region", "priority", "scenario",
               "is_anomaly", "volume", "engagement", "sentiment", "sentiment_label", "kw",
               "snippet", "author"]


def metric_rows(posts: DataFrame) -> DataFrame:
    """Text analysis + C1/C2, narrowed to what the detectors need."""
    return metrics_of(st.with_text_analysis(posts, tags=True))


def metrics_of(analysed: DataFrame, carry=()) -> DataFrame:
    """C1/C2 on posts after text analysis; ``carry`` names more columns to keep."""
    a = analysed.withColumn("_orgs", F.col("features.entities.organizations"))
    m = an.with_metrics(a.withColumn("sentiment_score", F.col("sentiment.score"))
                         .withColumn("sentiment_label", F.col("sentiment.label"))
                         .drop("sentiment", "features"))
    return m.withColumn("snippet", tx.truncate("text", 200)).select(*METRIC_COLS, *carry)


def indexed_rows(m: DataFrame, keys=("country",)) -> DataFrame:
    """Metric rows with the post index ``g`` (over checkpointed rows)."""
    return m if "g" in m.columns else an.with_key_index(m, keys)


def keyword_path(m: DataFrame, keys=("country",)):
    """C8 + C9: (posts with index, counter value at each bucket's last
    occurrence, live counters per bucket end, bursts per bucket, keyword
    score in force per bucket)."""
    keys = list(keys)
    mg = indexed_rows(m, keys)
    vals = kwo.bucket_end_counts(kwo.keyword_occurrences(mg, keys), keys)
    live = kwo.live_counts_at_bucket_end(vals, mg, keys)
    bursts = kwo.keyword_bursts(live, keys)
    ends = mg.groupBy(*keys, F.date_trunc("day", F.col("ts")).cast("timestamp_ntz").alias("bucket")) \
             .agg(F.max("g").alias("g_end"))
    all_b = ends.join(bursts, keys + ["bucket"], "left").fillna({"score": 0.0})
    return mg, vals, live, bursts, kwo.keyword_scores_in_force(all_b, keys)


def score_posts(m: DataFrame, keys=("country",), window_s: int = 300, cap: int = 100) -> DataFrame:
    """Detectors, keyword burst in force, composite and severity.
    The post index is computed once, for the frames and the counters."""
    keys = list(keys)
    mg = indexed_rows(m, keys)
    det = an.with_detectors(mg, keys, window_s=window_s, cap=cap).drop("g")
    force = small_side(keyword_path(mg, keys)[4])
    return with_composite(det.join(force, keys + ["bucket"], "left"))


def score_by_index(mg: DataFrame, keys=("country",), window_s: int = K.SHORT_WINDOW_S, cap: int = K.SHORT_CAP,
                   every: int = K.REFRESH_EVERY, long_cap: int = K.LONG_CAP, long_window_s: int = K.LONG_WINDOW_S,
                   after: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """C3-C13 with what is in force renewed by post number: baselines at
    every ``every``-th post of a key from its last ``long_cap`` posts, keyword
    counters scored there too.  Returns the scored posts and the baselines
    (keys, block, b_*).  ``mg`` carries ``g``; ``after`` are baselines in force
    where ``mg`` begins (see ``anomaly.indexed_baselines``)."""
    keys = list(keys)
    base = small_side(an.indexed_baselines(mg, keys, every, long_cap, long_window_s, after))
    f = an.attach_indexed_baselines(an.with_frames(mg, keys, window_s=window_s, cap=cap), base, keys, every).drop("block")
    bursts = small_side(kwo.index_bursts(kwo.keyword_occurrences(mg, keys), mg, keys, every))
    s = an.detector_scores(f).withColumn("block", F.floor((F.col("g") - 1) / every)).join(bursts, [*keys, "block"], "left").drop("block")
    return with_composite(s), base


def with_composite(s: DataFrame) -> DataFrame:
    """C11, C12 on posts with detector scores and the keyword burst in force."""
    s = s.withColumn("keyword_anomaly", F.struct(
        F.coalesce("keyword_score", F.lit(0.0)).alias("score"),
        F.coalesce("keyword_reported", F.array().cast("array<string>")).alias("anomalous_keywords")))
    s = s.withColumn("scored", an.composite(
        F.col("volume_anomaly.score"), F.col("sentiment_anomaly.score"),
        F.col("keyword_anomaly.score"), F.col("engagement_anomaly.score"), F.col("is_anomaly")))
    return s.withColumns({"composite_score": F.col("scored.composite_score"),
                          "severity": F.col("scored.severity"),
                          "alert_required": F.col("scored.alert_required")})
