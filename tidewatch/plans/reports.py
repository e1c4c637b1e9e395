"""Read-side reports over scored posts.

All are aggregations planned by Catalyst; top-k reports end in
``orderBy(...).limit(k)`` which plans as TakeOrderedAndProject (a per-task
top-k, then a merge of k rows per task), never a full sort.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sentiment_distribution(df: DataFrame, label: str = "sentiment_label") -> DataFrame:
    """Posts per label and their share of all posts."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    all_posts = c.agg(F.sum("n").alias("_all"))  # one row: the sum of one count per label
    return c.crossJoin(F.broadcast(all_posts)).withColumn("share", F.col("n") / F.col("_all")).drop("_all")


def geographic(df: DataFrame, key: str = "country", score: str = "sentiment") -> DataFrame:
    """Posts and mean sentiment score per country."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"))


def top_terms(df: DataFrame, arr_col: str, k: int = 10, name: str = "term") -> DataFrame:
    """The k most frequent array members (ties by term).

    ``explode_outer`` with a filter above it: a plain explode makes the
    optimizer push "array is not empty" below joins, which computes the array
    a second and third time."""
    return (df.select(F.explode_outer(arr_col).alias(name)).where(F.col(name).isNotNull()).groupBy(name)
              .agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.col("n").desc(), F.col(name)).limit(k))


def time_histogram(df: DataFrame, every: str = "1 hour", score: str = "sentiment") -> DataFrame:
    """Counts and mean score per tumbling time bucket."""
    return (df.groupBy(F.window(F.col("ts").cast("timestamp"), every).start.alias("_b"))
              .agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"))
              .withColumn("bucket", F.col("_b").cast("timestamp_ntz")).drop("_b"))


def latest(df: DataFrame, k: int = 3) -> DataFrame:
    """E5: newest k posts."""
    return df.orderBy(F.col("ts").desc(), F.col("post_seq").desc()).limit(k)


def anomaly_sample(df: DataFrame, k: int = 10) -> DataFrame:
    """K anomalies (posts that require an alert), highest score first, then id."""
    return df.filter(F.coalesce(F.col("alert_required"), F.lit(False))).orderBy(F.col("composite_score").desc(), F.col("tweet_id")).limit(k)


def alert_overview(alerts: DataFrame, bucket: str = "day") -> DataFrame:
    """Alerts per bucket and severity, with the negative-sentiment and
    volume-driven counts."""
    b = F.date_trunc(bucket, F.col("timestamp")).cast("timestamp_ntz").alias("bucket")
    return alerts.groupBy(b, "severity").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("source_tweet.sentiment") == "negative", 1)).alias("n_negative"),
        F.count(F.when(F.col("anomaly_details.volume_score") > 0.5, 1)).alias("n_volume"))


def month_partitioned_scan(spark, path: str, months) -> DataFrame:
    """Read a month-partitioned table for the given months only
    (partition pruning: only those folders are listed and read)."""
    return spark.read.parquet(path).filter(F.col("month").isin(list(months)))
