"""Decayed keyword counters (C8) and keyword bursts.

C8 semantics: on every post of a key all counters are multiplied by 0.95 and
dropped below 0.1, then the post's keywords are added (+1 per occurrence).
A counter therefore depends only on its own keyword's occurrences and the
number of key posts between them (``g``, the per-key post index):

    c_j = (c_{j-1} * 0.95^(g_j - g_{j-1}), or 0 if that is < 0.1) + m_j

The fold is sequential, so it runs over bounded groups: (key, keyword, index
chunk), each chunk also fed the occurrences of its halo, the preceding posts
whose weight is not yet below double precision (``halo_posts``, from decay and
floor).  ``bucket_end_counts`` folds with Spark's native ``aggregate`` (used by
the plans); ``decayed_counts`` gives every occurrence's value with ``applyInPandas`` (API and test oracle).
"""
from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch import constants as K
from tidewatch.operators.anomaly import index_chunks, with_key_index  # noqa: F401

CHUNK_POSTS = 50_000
REACH_BLOCK = 4_096


def halo_posts(decay: float, floor: float) -> int:
    """Posts after which what a counter held before is below double precision
    of any live counter: decay^halo / (1 - decay) < 1e-17 * floor."""
    if not 0 < decay < 1:
        raise ValueError("decay must lie between 0 and 1")
    return math.ceil(math.log(1e-17 * floor * (1 - decay)) / math.log(decay))


def _chunked(occ: DataFrame, decay: float, floor: float, chunk: int) -> DataFrame:
    halo = halo_posts(decay, floor)
    return index_chunks(occ, max(chunk, 2 * halo), halo)


def keyword_occurrences(df: DataFrame, keys=("country",), kw_col: str = "kw") -> DataFrame:
    """One row per (key, post, distinct keyword) with its multiplicity m."""
    keys = list(keys)
    pairs = F.transform(F.array_distinct(kw_col), lambda k: F.struct(
        k.alias("keyword"), F.size(F.filter(kw_col, lambda x: x == k)).alias("m")))
    return (df.select(*keys, "g", "ts", F.explode(pairs).alias("o"))
              .select(*keys, "g", "ts", "o.keyword", F.col("o.m").cast("double").alias("m")))


def _fold_group(decay: float, floor: float):
    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("g", kind="mergesort")
        c, last, vals = 0.0, None, []
        for g, m in zip(pdf["g"].to_numpy(), pdf["m"].to_numpy()):
            if last is not None:
                c = c * decay ** float(g - last)
                if c < floor:
                    c = 0.0
            c += float(m)
            last = g
            vals.append(c)
        pdf = pdf.assign(value=vals)
        return pdf[~pdf["_halo"]].drop(columns=["_halo", "_gchunk", "m"])
    return fold


def decayed_counts(occ: DataFrame, keys=("country",), decay: float = K.KEYWORD_DECAY,
                   floor: float = K.KEYWORD_FLOOR, chunk: int = CHUNK_POSTS) -> DataFrame:
    """Counter value right after each occurrence: (keys, keyword, g, ts, value)."""
    keys = list(keys)
    src = _chunked(occ, decay, floor, chunk)
    schema = (", ".join(f"{k} string" for k in keys)
              + ", g long, ts timestamp_ntz, keyword string, value double")
    return (src.groupBy(*keys, "keyword", "_gchunk")
               .applyInPandas(_fold_group(decay, floor), schema))


def live_counts_at_bucket_end(last: DataFrame, posts_g: DataFrame, keys=("country",),
                              bucket: str = "day", decay: float = K.KEYWORD_DECAY,
                              floor: float = K.KEYWORD_FLOOR) -> DataFrame:
    """Counter values at the end of every bucket of a key.

    ``last`` are ``bucket_end_counts`` rows; ``posts_g`` the posts with
    ``g``.  A value is carried only to the buckets it can reach: up to the
    bucket of the keyword's next occurrence, and at most as many posts as it
    takes to decay below the floor.  The bucket ends in that range are found
    by an equality join on blocks of REACH_BLOCK posts.
    """
    keys = list(keys)
    bk = lambda c: F.date_trunc(bucket, F.col(c)).cast("timestamp_ntz")
    ends = (posts_g.groupBy(*keys, bk("ts").alias("bucket")).agg(F.max("g").alias("g_end"))
            .withColumn("_blk", F.floor(F.col("g_end") / REACH_BLOCK)))
    nxt = F.lead("bucket").over(Window.partitionBy(*keys, "keyword").orderBy("bucket"))
    reach = F.col("g_last") + F.ceil(F.log(F.greatest(F.col("c_last"), F.lit(floor)) / floor) / -math.log(decay)) + 1
    held = (last.withColumn("_next", nxt).withColumnRenamed("bucket", "_from")
            .withColumn("_blk", F.explode(F.sequence(F.floor(F.col("g_last") / REACH_BLOCK), F.floor(reach / REACH_BLOCK)))))
    val = F.col("c_last") * F.pow(F.lit(decay), (F.col("g_end") - F.col("g_last")).cast("double"))
    return (held.join(ends, keys + ["_blk"])
                .filter((F.col("bucket") >= F.col("_from")) & (F.col("_next").isNull() | (F.col("bucket") < F.col("_next"))))
                .withColumn("value", val)
                .filter(F.col("value") >= floor)
                .select(*keys, "bucket", "keyword", "value"))


def keyword_bursts(live: DataFrame, keys=("country",), z_cut: float = K.KEYWORD_Z,
                   report: int = 5) -> DataFrame:
    """C9 per (key, bucket): z of each live counter against the mean and
    population std (floor 0.1; 1.0 for a single word) of all live counters;
    words over ``z_cut`` are reported (first ``report`` by z, then word);
    score min(max z / 5, 1), +0.3 when a reported word contains a crisis
    term, capped at 1."""
    keys = list(keys)
    w = Window.partitionBy(*keys, "bucket")
    n = F.count(F.lit(1)).over(w)
    std = F.when(n > 1, F.greatest(F.stddev_pop("value").over(w), F.lit(0.1))).otherwise(1.0)
    z = live.withColumn("z", (F.col("value") - F.avg("value").over(w)) / std)
    z = z.withColumn("_rank", F.row_number().over(w.orderBy(F.col("z").desc(), "keyword")))
    crisis = "|".join(K.CRISIS_TERMS)
    a = z.groupBy(*keys, "bucket").agg(
        F.count(F.lit(1)).alias("n_live"),
        F.coalesce(F.max(F.when(F.col("z") > z_cut, F.col("z"))), F.lit(0.0)).alias("max_z"),
        F.coalesce(F.max(F.when(F.col("z") > z_cut, F.col("keyword").rlike(crisis))),
                   F.lit(False)).alias("crisis"),
        F.sort_array(F.collect_list(F.when((F.col("z") > z_cut) & (F.col("_rank") <= report), F.struct(
            (-F.col("z")).alias("neg_z"), F.col("keyword"))))).alias("_rep"))
    score = F.least(F.when(F.col("max_z") > 0, F.least(F.col("max_z") / 5.0, F.lit(1.0)))
                     .otherwise(0.0) + F.when(F.col("crisis"), 0.3).otherwise(0.0), F.lit(1.0))
    return a.select(*keys, "bucket", "n_live", "max_z", score.alias("score"),
                    F.transform("_rep", lambda x: x["keyword"]).alias("reported"))


def keyword_scores_in_force(bursts: DataFrame, keys=("country",)) -> DataFrame:
    """The keyword burst computed at the end of a bucket applies to the next
    bucket's posts (0 before the first)."""
    w = Window.partitionBy(*keys).orderBy("bucket")
    return bursts.select(*keys, "bucket", F.coalesce(F.lag("score").over(w), F.lit(0.0))
                         .alias("keyword_score"),
                         F.coalesce(F.lag("reported").over(w), F.array().cast("array<string>"))
                         .alias("keyword_reported"))


def index_bursts(occ: DataFrame, posts_g: DataFrame, keys=("country",), every: int = K.REFRESH_EVERY,
                 decay: float = K.KEYWORD_DECAY, floor: float = K.KEYWORD_FLOOR) -> DataFrame:
    """C8 + C9 by post number: (keys, block, keyword_score, keyword_reported).
    The live counters after post j * every of a key are scored, and apply to
    the posts of block j, those numbered j * every + 1 to (j + 1) * every.

    A counter's value after its last occurrence in a block is carried to the
    block ends that it can reach before it decays below the floor; where a
    later occurrence has reached the same end, the later one counts.
    """
    keys = list(keys)
    last = bucket_end_counts(occ, keys, every, decay, floor)
    posts = F.greatest(F.ceil(F.log(F.greatest(F.col("c_last"), F.lit(floor)) / floor) / -math.log(decay)) + 1, F.lit(0))
    held = last.withColumn("end", F.explode(F.sequence(F.col("bucket") + 1, F.greatest(F.col("bucket") + 1, F.floor((F.col("g_last") + posts) / every)))))
    newest = held.groupBy(*keys, "keyword", "end").agg(F.max("g_last").alias("g_last"), F.max_by("c_last", "g_last").alias("c_last"))
    ends = posts_g.where(F.col("g") % every == 0).select(*keys, (F.col("g") / every).cast("bigint").alias("end"))
    live = (newest.join(ends, [*keys, "end"])
            .withColumn("value", F.col("c_last") * F.pow(F.lit(decay), (F.col("end") * every - F.col("g_last")).cast("double")))
            .where(F.col("value") >= floor).select(*keys, F.col("end").alias("bucket"), "keyword", "value"))
    return keyword_bursts(live, keys).select(*keys, F.col("bucket").alias("block"), F.col("score").alias("keyword_score"), F.col("reported").alias("keyword_reported"))


FOLD_STATE = ("struct<c:double,last_g:bigint,cur_b:timestamp_ntz,cur_h:boolean,"
              "out:array<struct<bucket:timestamp_ntz,g_last:bigint,c_last:double>>>")


def bucket_end_counts(occ: DataFrame, keys=("country",), bucket: str | int = "day",
                      decay: float = K.KEYWORD_DECAY, floor: float = K.KEYWORD_FLOOR,
                      chunk: int = CHUNK_POSTS) -> DataFrame:
    """C8, JVM-side: the counter value after the last occurrence of each
    (keys, keyword, bucket): (keys, keyword, bucket, g_last, c_last).

    One native ``aggregate`` per bounded group (key, keyword, index chunk +
    halo) over its occurrences sorted by g.  The state is a declared struct
    (value, last index, current bucket, halo flag, outputs); a bucket's last
    value is appended when the bucket changes, so the output array grows
    once per bucket, not per occurrence.  Halo rows feed the value but never
    emit.  An integer ``bucket`` means blocks of so many posts."""
    keys, by_index = list(keys), isinstance(bucket, int)
    kind = "bigint" if by_index else "timestamp_ntz"
    state = FOLD_STATE.replace("timestamp_ntz", kind)
    b = occ.withColumn("bucket", F.floor((F.col("g") - 1) / bucket) if by_index else F.date_trunc(bucket, F.col("ts")).cast("timestamp_ntz"))
    grouped = _chunked(b, decay, floor, chunk).groupBy(*keys, "keyword", "_gchunk").agg(
        F.array_sort(F.collect_list(F.struct("g", "m", "bucket", "_halo"))).alias("_occ"))
    init = F.struct(F.lit(0.0).alias("c"), F.lit(None).cast("bigint").alias("last_g"),
                    F.lit(None).cast(kind).alias("cur_b"), F.lit(True).alias("cur_h"),
                    F.array().alias("out")).cast(state)

    def emit(acc):
        return F.concat(acc["out"], F.array(F.struct(acc["cur_b"].alias("bucket"),
                                                     acc["last_g"].alias("g_last"),
                                                     acc["c"].alias("c_last"))))

    def step(acc, x):
        dec = F.when(acc["last_g"].isNull(), F.lit(0.0)).otherwise(
            acc["c"] * F.pow(F.lit(decay), (x["g"] - acc["last_g"]).cast("double")))
        kept = F.when(dec < floor, F.lit(0.0)).otherwise(dec)
        flush = acc["cur_b"].isNotNull() & (acc["cur_b"] != x["bucket"]) & ~acc["cur_h"]
        return F.struct((kept + x["m"]).alias("c"), x["g"].alias("last_g"),
                        x["bucket"].alias("cur_b"), x["_halo"].alias("cur_h"),
                        F.when(flush, emit(acc)).otherwise(acc["out"]).alias("out")).cast(state)

    def finish(acc):
        return F.when(acc["cur_b"].isNotNull() & ~acc["cur_h"], emit(acc)).otherwise(acc["out"])

    res = grouped.select(*keys, "keyword", F.explode(F.aggregate("_occ", init, step, finish)).alias("o"))
    # a bucket crossing a chunk boundary is emitted by both chunks: keep the later
    return (res.groupBy(*keys, "keyword", F.col("o.bucket").alias("bucket"))
               .agg(F.max("o.g_last").alias("g_last"), F.max_by("o.c_last", "o.g_last").alias("c_last")))
