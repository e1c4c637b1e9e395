"""Operator 3, packing: length buckets by dynamic programming over the global
histogram, then token-budget batches inside each bucket."""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.merkle import placed
from tidewatch.llm.text import space_words

MAX_LEN = 2048       # tokens of a sequence; longer texts become several
BUCKETS = 8
BATCH_TOKENS = 16_384
SHARD_CHARS = 2      # hex digits of the MD5 that mix the order of a bucket


def optimal_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Bucket bounds (padded lengths) that minimise the padding of a length
    histogram, exactly, by dynamic programming over its sorted lengths.

    best[k][j]: least padded total of the first j lengths in k buckets, the
    last bound being lengths[j-1].  Of equal solutions the one with the
    earliest cut wins.  Fewer buckets than asked are used if there are fewer
    lengths.
    """
    order = np.argsort(lengths)
    lengths, counts = lengths[order].astype(np.int64), counts[order].astype(np.int64)
    n = len(lengths)
    if not n:
        return []
    total = np.concatenate([[0], np.cumsum(counts)])
    k = min(buckets, n)
    best = np.full((k + 1, n + 1), np.iinfo(np.int64).max // 4)
    cut = np.zeros((k + 1, n + 1), dtype=np.int64)
    best[0][0] = 0
    for b in range(1, k + 1):
        for j in range(b, n + 1):
            cost = best[b - 1][:j] + (total[j] - total[:j]) * lengths[j - 1]
            cut[b][j] = int(cost.argmin())
            best[b][j] = cost[cut[b][j]]
    bounds, j = [], n
    for b in range(k, 0, -1):
        bounds.append(int(lengths[j - 1]))
        j = int(cut[b][j])
    return bounds[::-1]


def sequences(docs: DataFrame, n_tokens: Column | None = None, max_len: int = MAX_LEN) -> DataFrame:
    """(doc_id, piece, start_token, n_tokens): every text cut into sequences of
    at most ``max_len`` tokens; ``n_tokens`` defaults to the space words."""
    n = F.size(space_words(F.col("text"))) if n_tokens is None else n_tokens
    d = docs.select("doc_id", n.cast("bigint").alias("total")).where("total > 0")
    p = d.select("doc_id", "total", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("total") - 1) / max_len))).alias("piece"))
    start = F.col("piece") * max_len
    return p.select("doc_id", "piece", start.alias("start_token"), F.least(F.lit(max_len), F.col("total") - start).alias("n_tokens"))


def pack(docs: DataFrame, n_tokens: Column | None = None, max_len: int = MAX_LEN, buckets: int = BUCKETS,
         batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """One row per sequence: doc_id, piece, start_token, n_tokens, bucket (its
    padded length), batch (from 0 in each bucket), slot (from 0 in each batch).

    The histogram has at most ``max_len`` rows whatever the corpus size; only
    it reaches the driver.  A batch holds batch_tokens // bucket sequences (at
    least one).  A bucket's sequences are numbered in the order of (first two
    hex digits of the MD5 of id and piece, doc_id, piece, n_tokens) by one sort
    by ranges and the row counts of the ranges before, so neither a bucket with
    most of the rows nor an id that many rows repeat, null included, is one
    task's.  The sequences are checkpointed, so the texts are read once.

    Null and empty texts make no sequence; null ids are packed (before others
    of their digits); repeated rows are packed each, and as they are equal in
    all columns but batch and slot, the result is the same whatever their order.
    """
    shard = F.substring(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("piece").cast("string"))), 1, SHARD_CHARS)
    seqs = sequences(docs, n_tokens, max_len).withColumn("shard", shard).checkpoint()
    hist = seqs.groupBy("n_tokens").count().collect()
    bounds = optimal_bounds(np.array([h.n_tokens for h in hist], dtype=np.int64), np.array([h["count"] for h in hist], dtype=np.int64), buckets)
    bucket = F.lit(None).cast("bigint")
    for b in reversed(bounds):
        bucket = F.when(F.col("n_tokens") <= b, F.lit(b).cast("bigint")).otherwise(bucket)
    numbered = placed(seqs.withColumn("bucket", bucket), "bucket", ["shard", "doc_id", "piece", "n_tokens"])
    per_batch = F.greatest(F.floor(F.lit(batch_tokens) / F.col("bucket")), F.lit(1)).cast("bigint")
    return numbered.select("doc_id", "piece", "start_token", "n_tokens", "bucket",
                           F.floor(F.col("pos") / per_batch).cast("bigint").alias("batch"), (F.col("pos") % per_batch).cast("bigint").alias("slot"))
