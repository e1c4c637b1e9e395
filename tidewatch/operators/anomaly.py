"""Post metrics and the windowed anomaly detectors.

The original keeps one global, arrival-ordered series in driver memory.  Here
every series is keyed (default key: ``country``) and ordered by event time
(ts, post_seq), so reruns agree and the work spreads over the cluster.

Hot keys.  A keyed window puts a key's rows in one task.  Because every
detector frame is bounded by ``cap`` rows, rows are instead numbered per key
(``with_key_index``) and partitioned by (key, chunk of numbers); each chunk
also receives a *halo*, a copy of the rows just before it.  Frames computed
inside a chunk are then exact, and one key with a third of the rows is still
split into many tasks.  Halo rows are dropped after the window pass.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch import constants as K
from tidewatch.functions import text as tx
from tidewatch.operators.lookups import bounded_broadcast, map_lookup, small_side
from tidewatch.operators.quantiles import exact_quantiles
from tidewatch.session import ensure_checkpoint_dir

MICROS = 1_000_000
EPOCH_US = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {})"


def ts_micros(ts: str = "ts") -> Column:
    """Event time as epoch microseconds, independent of the session zone."""
    return F.expr(EPOCH_US.format(f"CAST({ts} AS TIMESTAMP_NTZ)"))


# ---- C1, C2, J3 ------------------------------------------------------------------

def engagement_score(likes, retweets, replies) -> Column:
    """0.3 likes + 0.5 retweets + 0.2 replies (a missing part counts 0)."""
    c = lambda x: F.coalesce(F.col(x) if isinstance(x, str) else x, F.lit(0))
    return F.lit(0.3) * c(likes) + F.lit(0.5) * c(retweets) + F.lit(0.2) * c(replies)


def volume_score(priority, engagement) -> Column:
    """Priority factor x (1 + engagement / 100); unknown priority -> 1."""
    p = F.col(priority) if isinstance(priority, str) else priority
    e = F.col(engagement) if isinstance(engagement, str) else engagement
    return map_lookup(p, K.PRIORITY_FACTORS, 1.0) * (1 + e / 100)


def normalise_keywords(keywords, companies, countries) -> Column:
    """Keywords ++ companies ++ countries; keep entries longer than 2,
    lower-cased and trimmed, alphanumeric once '-' and '_' are removed.
    Duplicates are kept."""
    empty = F.array().cast("array<string>")
    allk = F.concat(F.coalesce(keywords, empty), F.coalesce(companies, empty),
                    F.coalesce(countries, empty))
    kept = F.filter(allk, lambda k: k.isNotNull() & (F.length(k) > 2))
    low = F.transform(kept, lambda k: F.trim(F.lower(k)))
    return F.filter(low, lambda k: F.regexp_replace(k, "[-_]", "").rlike(r"^[\p{L}\p{N}]+$"))


def with_metrics(df: DataFrame, sentiment: str = "sentiment_score") -> DataFrame:
    """C1+C2 on posts: engagement, volume, sentiment (the ensemble score),
    keyword list.  The keyword list is made of the record's own ``keywords``
    and ``entities`` where the rows carry them; a feed without them is tagged
    the way its producer would (topics, companies, countries; tags of the text
    analysis are reused when present)."""
    if {"keywords", "entities"} <= set(df.columns):
        kw = normalise_keywords(F.col("keywords"), F.col("entities.companies"), F.col("entities.countries"))
    else:
        known = lambda c: F.col(c) if c in df.columns else None
        ent = tx.producer_entities("text", known("_orgs"), countries=known("_countries"))
        topics = tx.topic_keywords("text") if known("_topics") is None else known("_topics")
        kw = normalise_keywords(topics, ent["companies"], ent["countries"])
    return df.withColumns({
        "engagement": engagement_score("likes", "retweets", "replies"),
        "volume": volume_score("priority", engagement_score("likes", "retweets", "replies")),
        "sentiment": F.coalesce(F.col(sentiment), F.lit(0.0)),
        "kw": kw,
    })


# ---- C3, C18, C6, C7, C10: bounded frames -------------------------------------------

def with_key_index(df: DataFrame, keys=("country",), order=("ts", "post_seq")) -> DataFrame:
    """Per-key post index ``g`` (1-based, in ``order``) without a key-wide sort.

    Rows are sorted once by ranges of (key, order), so a hot key, hour or
    second spreads over tasks.  The counts per (key, task) give each task the
    index at which it begins: a prefix sum over one small row per key and
    task.  ``df`` is checkpointed before it is sampled and sorted, so it is
    computed once, and again after, so task numbers stay what was counted.
    Null keys are a key of their own.
    """
    keys, spark = list(keys), df.sparkSession
    ensure_checkpoint_dir(spark)
    by = [*[F.col(k).asc_nulls_first() for k in keys], *[F.col(o).asc_nulls_first() for o in order]]
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (df.checkpoint().repartitionByRange(width, *by).sortWithinPartitions(*by)
            .withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}).checkpoint())
    sizes = rows.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    begins = small_side(sizes.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_part").alias("_p"),
                                     (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift")))
    same = F.col("_part") == F.col("_p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return (rows.join(begins, same).withColumn("g", F.col("_at") + F.col("_shift"))
            .drop("_part", "_at", "_p", "_shift", *[f"_k_{k}" for k in keys]))


def index_chunks(df: DataFrame, chunk: int, halo: int) -> DataFrame:
    """Rows dealt to chunks of ``chunk`` consecutive posts of their key
    (``_gchunk``), each chunk also getting the ``halo`` posts before it
    (``_halo`` true).  However dense a key is, a chunk has at most chunk +
    halo rows, and only the halo is copied."""
    own = F.floor((F.col("g") - 1) / chunk)
    return (df.withColumn("_gchunk", F.explode(F.sequence(own, F.floor((F.col("g") - 1 + halo) / chunk))))
              .withColumn("_halo", F.col("_gchunk") != own))


def with_frames(df: DataFrame, keys=("country",), window_s: int = K.SHORT_WINDOW_S,
                cap: int = K.SHORT_CAP, chunk: int = 20_000) -> DataFrame:
    """C3 + C18: per row, the frame of the key's rows newer than ``window_s``
    seconds and at most ``cap`` rows, ordered by (ts, post_seq).

    Adds n (frame size), vol_last3, eng_last3, sent_last5 (C18 means) and
    sent_hist (mean of the frame without its last 5 rows, 0 when n <= 5).
    A frame never has more than ``cap`` rows, so chunks by post index with a
    halo of cap - 1 posts are exact and split any hot key; the per-row work is
    bounded by ``cap`` however many rows the time window holds.  ``df`` may
    carry the post index ``g`` (``with_key_index``).
    """
    keys = list(keys)
    indexed = "g" in df.columns
    d = index_chunks(df if indexed else with_key_index(df, keys), chunk, cap - 1).withColumn("_ts_us", ts_micros("ts"))
    w = Window.partitionBy(*keys, "_gchunk").orderBy("g")
    last = lambda k: w.rowsBetween(-(k - 1), 0)
    d = d.withColumns({
        "vol_last3": F.avg("volume").over(last(3)),
        "eng_last3": F.avg("engagement").over(last(3)),
        "sent_last5": F.avg("sentiment").over(last(5)),
        "_frame": F.collect_list(F.struct(F.col("_ts_us").alias("t"), F.col("sentiment").alias("x"))).over(last(cap)),
    })
    since = F.col("_ts_us") - window_s * MICROS
    d = d.withColumn("n", F.size(F.filter("_frame", lambda r: r["t"] >= since)))
    older = F.slice("_frame", F.size("_frame") - F.col("n") + 1, F.greatest(F.col("n") - 5, F.lit(0)))
    total = F.aggregate(older, F.lit(0.0), lambda acc, r: acc + r["x"])
    d = d.withColumn("sent_hist", F.when(F.col("n") > 5, total / (F.col("n") - 5)).otherwise(F.lit(0.0)))
    return d.filter(~F.col("_halo")).drop("_halo", "_gchunk", "_frame", "_ts_us", *([] if indexed else ["g"]))


# ---- C4, C5, J4: baselines -----------------------------------------------------------

METRICS = ("volume", "sentiment", "engagement")


def bucket_baselines(df: DataFrame, keys=("country",), bucket: str = "day",
                     iqr_k: float = 1.5, min_samples: int = K.MIN_SAMPLES) -> DataFrame:
    """C4: per (keys, bucket): n and, for each metric, mean and population
    std (floor 0.01) of the values inside the 1.5 IQR fence.  Buckets with
    fewer than ``min_samples`` rows get null statistics.

    Two aggregations with map-side partial aggregation (exact percentile,
    then fenced mean/std); the quartile table is one row per bucket.  Buckets
    of more than ``HOT_ROWS`` rows get their quartiles by rank selection, so
    none holds its values in one task.
    """
    keys = list(keys)
    b = df.select(*keys, F.date_trunc(bucket, F.col("ts")).cast("timestamp_ntz").alias("bucket"),
                  *METRICS)
    return fenced_statistics(b, [*keys, "bucket"], iqr_k, min_samples, HOT_ROWS)


HOT_ROWS = 2_000_000
FENCE_EDGE = 1e-9   # a value on the fence is inside, whatever the last bits of the quartiles


def group_quartiles(b: DataFrame, group: list[str], hot_rows: int | None) -> DataFrame:
    """(group, n, _q_<metric>): exact quartiles.  Groups of more than
    ``hot_rows`` rows (None: there are none) go through rank selection."""
    def plain(rows):
        return rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), *[F.percentile(m, [0.25, 0.75]).alias(f"_q_{m}") for m in METRICS])

    if hot_rows is None:
        return plain(b)
    sizes = b.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows).checkpoint()   # at most rows / hot_rows groups
    if sizes.isEmpty():
        return plain(b)
    hot = b.join(bounded_broadcast(sizes), group)
    many = exact_quantiles(hot.drop("n"), group, METRICS).join(sizes, group)
    return plain(b.join(bounded_broadcast(sizes.select(*group)), group, "left_anti")).unionByName(many)


def fenced_statistics(b: DataFrame, group: list[str], iqr_k: float = 1.5, min_samples: int = K.MIN_SAMPLES, hot_rows: int | None = None) -> DataFrame:
    """n and, per metric, mean and population std (floor 0.01) of the values
    inside the fence, for every group; null below ``min_samples`` rows."""
    j = b.join(group_quartiles(b, group, hot_rows), group)
    aggs = []
    for m in METRICS:
        q1, q3 = F.col(f"_q_{m}")[0], F.col(f"_q_{m}")[1]
        lo, hi = q1 - iqr_k * (q3 - q1) - FENCE_EDGE, q3 + iqr_k * (q3 - q1) + FENCE_EDGE
        inside = F.when((F.col(m) >= lo) & (F.col(m) <= hi), F.col(m))
        aggs += [F.avg(inside).alias(f"{m}_mean"), F.stddev_pop(inside).alias(f"{m}_std")]
    s = j.groupBy(*group).agg(F.first("n").alias("n"), *aggs)
    ok = F.col("n") >= min_samples
    out = s
    for m in METRICS:
        out = out.withColumns({
            f"{m}_mean": F.when(ok, F.col(f"{m}_mean")),
            f"{m}_std": F.when(ok & F.col(f"{m}_mean").isNotNull(),
                               F.greatest(F.col(f"{m}_std"), F.lit(0.01))),
        })
    return out


def indexed_baselines(df: DataFrame, keys=("country",), every: int = K.REFRESH_EVERY, cap: int = K.LONG_CAP,
                      window_s: int = K.LONG_WINDOW_S, after: DataFrame | None = None) -> DataFrame:
    """One baseline per ``every``-th post of a key, as (keys, block,
    b_<metric>_mean, b_<metric>_std).  Block j is refreshed at post j * every
    (that post included) from the last ``cap`` posts of the key that are not
    older than ``window_s`` seconds before it; a metric without a fence of
    enough posts keeps what was in force.

    ``df`` carries ``g``.  Every post is dealt to the blocks whose frame it is
    in, so a group has ``cap`` rows at most and a hot key is many groups.
    ``after`` (keys, block and the b_ columns) says what was in force when
    ``df`` begins; only later blocks are computed then.
    """
    keys = list(keys)
    frames = df.select(*keys, "g", ts_micros("ts").alias("_us"), *METRICS).withColumn(
        "block", F.explode(F.sequence(F.ceil(F.col("g") / every), F.floor((F.col("g") + cap - 1) / every))))
    ends = df.where(F.col("g") % every == 0).select(*keys, (F.col("g") / every).cast("bigint").alias("block"), ts_micros("ts").alias("_end"))
    if after is not None:
        known = after.select(*keys, F.col("block").alias("_known"))
        ends = ends.join(known, keys, "left").where("_known is null or block > _known").drop("_known")
    inside = frames.join(ends, [*keys, "block"]).where(F.col("_us") >= F.col("_end") - window_s * MICROS)
    stats = fenced_statistics(inside.select(*keys, "block", *METRICS), [*keys, "block"])
    named = stats.select(*keys, "block", *[F.col(f"{m}_{x}").alias(f"b_{m}_{x}") for m in METRICS for x in ("mean", "std")])
    if after is not None:
        named = named.unionByName(after.select(*named.columns))
    return _carried(named, keys)


def _carried(stats: DataFrame, keys: list[str], chunk: int = 10_000) -> DataFrame:
    """Nulls of the b_ columns filled with the key's last value before them.
    Blocks are carried inside chunks; what a chunk begins with comes from the
    last values of the chunks before it (one row per chunk)."""
    cols = [f"b_{m}_{x}" for m in METRICS for x in ("mean", "std")]
    d = stats.withColumn("_c", F.floor(F.col("block") / chunk))
    lasts = d.groupBy(*keys, "_c").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("block"))).alias(c) for c in cols])
    wc = Window.partitionBy(*keys).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    begin = lasts.select(*keys, "_c", *[F.last(c, ignorenulls=True).over(wc).alias("_" + c) for c in cols])
    w = Window.partitionBy(*keys, "_c").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (d.join(begin, [*keys, "_c"]).select(*keys, "block", *[F.coalesce(F.last(c, ignorenulls=True).over(w), F.col("_" + c)).alias(c) for c in cols]))


def attach_indexed_baselines(df: DataFrame, baselines: DataFrame, keys=("country",), every: int = K.REFRESH_EVERY) -> DataFrame:
    """C5 as of: post g gets block floor(g / every), or the defaults."""
    keys = list(keys)
    j = df.withColumn("block", F.floor(F.col("g") / every)).join(baselines, [*keys, "block"], "left")
    for m in METRICS:
        for x, default in zip(("mean", "std"), K.DEFAULT_BASELINES[m]):
            j = j.withColumn(f"b_{m}_{x}", F.coalesce(f"b_{m}_{x}", F.lit(default)))
    return j


def baselines_in_force(stats: DataFrame, keys=("country",)) -> DataFrame:
    """C5 + J4: the baseline applying to a bucket is the latest *earlier*
    bucket's statistics (carried forward), else the defaults.  Runs on the
    small per-bucket table only."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cols = {}
    for m in METRICS:
        dm, ds = K.DEFAULT_BASELINES[m]
        cols[f"b_{m}_mean"] = F.coalesce(F.last(f"{m}_mean", ignorenulls=True).over(w), F.lit(dm))
        cols[f"b_{m}_std"] = F.coalesce(F.last(f"{m}_std", ignorenulls=True).over(w), F.lit(ds))
    return stats.select(*keys, "bucket", *[v.alias(k) for k, v in cols.items()])


def attach_baselines(df: DataFrame, keys=("country",), bucket: str = "day") -> DataFrame:
    """Each row gets the baseline in force for its (key, bucket)."""
    keys = list(keys)
    force = baselines_in_force(bucket_baselines(df, keys, bucket), keys)
    b = df.withColumn("bucket", F.date_trunc(bucket, F.col("ts")).cast("timestamp_ntz"))
    return b.join(force, keys + ["bucket"], "left")


def volume_anomaly(n, current, mean, std, spike_z: float = K.VOLUME_SPIKE_Z) -> Column:
    """Z of the last-3 mean against the baseline; score
    min(|z|/4, 1); spike if z > threshold; zero score under 10 rows."""
    z = (current - mean) / F.greatest(std, F.lit(0.01))
    enough = n >= K.MIN_SAMPLES
    return F.struct(F.when(enough, F.least(F.abs(z) / 4.0, F.lit(1.0))).otherwise(0.0).alias("score"),
                    F.when(enough, z > spike_z).otherwise(False).alias("is_spike"),
                    F.when(enough, z).alias("z_score"), F.when(enough, current).alias("current"))


def sentiment_anomaly(n, current, hist) -> Column:
    """shift = |mean(last 5) - mean(earlier rows of the frame)|; score
    min(shift/0.8, 1) + 0.2 when |current| > 0.7, capped; sudden if > 0.4."""
    shift = F.abs(current - hist)
    enough = n >= K.MIN_SAMPLES
    sc = F.least(F.least(shift / 0.8, F.lit(1.0))
                 + F.when(F.abs(current) > 0.7, 0.2).otherwise(0.0), F.lit(1.0))
    return F.struct(F.when(enough, sc).otherwise(0.0).alias("score"),
                    F.when(enough, shift > K.SENTIMENT_SHIFT).otherwise(False).alias("is_sudden_shift"),
                    F.when(enough, shift).alias("shift"), F.when(enough, current).alias("current"),
                    F.when(enough, hist).alias("historical"))


def with_detectors(df: DataFrame, keys=("country",), window_s: int = K.SHORT_WINDOW_S,
                   cap: int = K.SHORT_CAP) -> DataFrame:
    """C3-C7, C10 on metric rows: frames, baselines, three detectors."""
    f = with_frames(df, keys, window_s=window_s, cap=cap)
    force = small_side(baselines_in_force(bucket_baselines(df, keys), keys))
    f = (f.withColumn("bucket", F.date_trunc("day", F.col("ts")).cast("timestamp_ntz"))
          .join(force, list(keys) + ["bucket"], "left"))
    return detector_scores(f)


def detector_scores(f: DataFrame) -> DataFrame:
    """C6, C7, C10 on frames with their baselines."""
    return f.withColumns({
        "volume_anomaly": volume_anomaly(F.col("n"), F.col("vol_last3"), F.col("b_volume_mean"),
                                         F.col("b_volume_std")),
        "sentiment_anomaly": sentiment_anomaly(F.col("n"), F.col("sent_last5"), F.col("sent_hist")),
        "engagement_anomaly": volume_anomaly(F.col("n"), F.col("eng_last3"),
                                             F.col("b_engagement_mean"), F.col("b_engagement_std"),
                                             K.ENGAGEMENT_SPIKE_Z),
    })


# ---- C11-C13 --------------------------------------------------------------------------

def severity_of(score) -> Column:
    s = F.col(score) if isinstance(score, str) else score
    return (F.when(s >= K.CRITICAL_CUT, "critical").when(s >= K.HIGH_CUT, "high")
             .when(s >= K.MEDIUM_CUT, "medium").otherwise("low"))


def composite(vol, sent, kw, eng, flagged) -> Column:
    """C11 + C12: weighted composite, severity from the unboosted score,
    then a flagged post is boosted x1.5 (cap 1), made critical and alerted."""
    w = K.COMPOSITE_WEIGHTS
    raw = vol * w["volume"] + sent * w["sentiment"] + kw * w["keyword"] + eng * w["engagement"]
    sev = severity_of(raw)
    fl = F.coalesce(flagged, F.lit(False))
    return F.struct(
        F.when(fl, F.least(raw * 1.5, F.lit(1.0))).otherwise(raw).alias("composite_score"),
        F.when(fl, F.lit("critical")).otherwise(sev).alias("severity"),
        (fl | (raw >= K.HIGH_CUT)).alias("alert_required"))


def anomaly_record(df: DataFrame) -> DataFrame:
    """Nest components and context (text cut to 200 characters)."""
    src = "text" if "text" in df.columns else "snippet"
    return df.withColumn("anomaly", F.struct(
        F.col("ts").alias("timestamp"), F.col("tweet_id"),
        F.col("scored.composite_score").alias("composite_score"),
        F.col("scored.severity").alias("severity"),
        F.col("scored.alert_required").alias("alert_required"),
        F.struct(F.col("volume_anomaly").alias("volume"),
                 F.col("sentiment_anomaly").alias("sentiment"),
                 F.col("keyword_anomaly").alias("keyword"),
                 F.col("engagement_anomaly").alias("engagement")).alias("components"),
        F.struct(tx.truncate(src, 200).alias("original_tweet"),
                 F.col("sentiment").alias("tweet_sentiment"),
                 F.col("kw").alias("tweet_keywords"),
                 F.struct(*[F.col(f"b_{m}_{s}") for m in METRICS for s in ("mean", "std")])
                  .alias("current_baselines")).alias("context")))


# ---- C14, C15 ---------------------------------------------------------------------------

def significant_recent(df: DataFrame, keys=("country",), keep: int = 100) -> DataFrame:
    """C14: anomalies scoring >= 0.4, the newest ``keep`` per key (a top-k
    per key: the limit is the feature)."""
    w = Window.partitionBy(*keys).orderBy(F.col("ts").desc(), F.col("post_seq").desc())
    return (df.filter(F.col("composite_score") >= K.MEDIUM_CUT)
              .withColumn("recent_rank", F.row_number().over(w))
              .filter(F.col("recent_rank") <= keep))


def anomaly_summary(df: DataFrame, keys=("country",), minutes: int = 30) -> DataFrame:
    """Over the last ``minutes`` before each key's newest anomaly:
    total, count per severity, mean, max, and the trend of the newest 10
    against the 10 before (needs 20)."""
    keys = list(keys)
    last = df.groupBy(*keys).agg(F.max("ts").alias("_last"))  # one row per key
    recent = (df.join(last, keys)
                .filter(F.col("ts") > F.col("_last") - F.expr(f"INTERVAL {minutes} MINUTES")))
    w = Window.partitionBy(*keys).orderBy(F.col("ts").desc(), F.col("post_seq").desc())
    r = recent.withColumn("_rk", F.row_number().over(w))
    a = r.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count(F.when(F.col("severity") == s, 1)).alias(f"n_{s}")
          for s in ("low", "medium", "high", "critical")],
        F.avg("composite_score").alias("average_score"),
        F.max("composite_score").alias("max_score"),
        F.avg(F.when(F.col("_rk") <= 10, F.col("composite_score"))).alias("_recent"),
        F.avg(F.when((F.col("_rk") > 10) & (F.col("_rk") <= 20), F.col("composite_score"))).alias("_prev"))
    trend = (F.when(F.col("total") < 20, "insufficient_data")
              .when(F.col("_recent") > F.col("_prev") * 1.2, "increasing")
              .when(F.col("_recent") < F.col("_prev") * 0.8, "decreasing").otherwise("stable"))
    return a.withColumn("trend", trend).drop("_recent", "_prev")


# ---- C16, C17 ---------------------------------------------------------------------------

def expected_volume(df: DataFrame, profile=K.HOUR_PROFILE, scenario_factor: float = 1.0) -> DataFrame:
    """Posts per hour against the expected factor (hour profile x
    scenario factor x weekend factor 0.3)."""
    prof = F.create_map(*[F.lit(x) for h, v in enumerate(profile) for x in (h, float(v))])
    h = df.groupBy(F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("hour_ts")) \
          .agg(F.count(F.lit(1)).alias("n"))
    weekend = F.when(F.weekday("hour_ts") >= 5, K.WEEKEND_FACTOR).otherwise(1.0)
    exp = F.element_at(prof, F.hour("hour_ts")) * scenario_factor * weekend
    return h.withColumns({"expected": exp, "ratio": F.col("n") / exp})


def scenario_changes(df: DataFrame, keys=("country",), chunk_s: int = 86400) -> DataFrame:
    """C17: rows whose scenario differs from the previous row of the key.

    ``lag`` runs inside (key, time chunk) partitions; the first row of a
    chunk takes its predecessor from the small per-chunk table (last row of
    the latest earlier chunk), so no task holds a whole key."""
    keys = list(keys)
    d = df.withColumn("_chunk", F.floor(ts_micros("ts") / (chunk_s * MICROS)))
    ends = d.groupBy(*keys, "_chunk").agg(
        F.max_by("scenario", F.struct("ts", "post_seq")).alias("_end"))
    wc = Window.partitionBy(*keys).orderBy("_chunk")
    carry = ends.select(*keys, "_chunk", F.lag("_end").over(wc).alias("_carry"))
    w = Window.partitionBy(*keys, "_chunk").orderBy("ts", "post_seq")
    prev = F.coalesce(F.lag("scenario").over(w), F.col("_carry"))
    return (d.join(carry, keys + ["_chunk"])
             .withColumn("previous", prev)
             .filter(F.col("previous").isNotNull() & (F.col("previous") != F.col("scenario")))
             .drop("_chunk", "_carry"))
