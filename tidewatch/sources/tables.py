"""Table loading and the ``posts`` view the operators run on.

``posts`` re-expresses the post record of the original feed over the driver
tables: one post per ``events`` row, its text taken (whole) from
``documents`` behind a lead-in chosen by event type, its country and region
from ``nation``/``region``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.lookups import bounded_broadcast

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# Lead-in sentence per event type (our fixture text; see FIXTURES.md).
LEAD_INS = {
    "error": "BREAKING: tariffs crisis hits Tesla in China, shares fell 12.5% ",
    "purchase": "Trade deal lifts growth, exports up 3% worth $1,200.50 million ",
    "signup": "New partnership at Siemens brings progress #trade @desk ",
    "view": "Talks continue in Germany, see http://news.example.com/a ",
}
DEFAULT_LEAD_IN = "Supply disruption and uncertainty, prices down! "
PRIORITY_BY_TYPE = {"error": "critical", "purchase": "high", "signup": "low"}


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(col: Column, mapping: dict, default) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(default))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The post table: tweet_id, post_seq, ts, author, language, text,
    likes, retweets, replies, country, region, priority, scenario, is_anomaly.

    Plan: events and documents are joined on ``event_id % n_documents`` as a
    sort-merge join over ``spark.sql.shuffle.partitions`` hash partitions:
    both are fact-sized at scale, and the text work that follows is spread
    over that many tasks even when a scan is a single file.  nation (25 rows) and region (5 rows) are broadcast behind a
    check of their bytes.
    """
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    n_docs = docs.count()  # parquet footer count: a scalar, no data moves
    events = load_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props")
    e = events.withColumns({
        "k": F.regexp_extract("props", r"([0-9]+)", 1).cast("int"),
        "doc_key": F.col("event_id") % F.lit(n_docs),
        "nation_key": (F.col("user_id") % 25).cast("int"),
    })
    nation = bounded_broadcast(load_table(spark, sf_dir, "nation"))
    region = bounded_broadcast(load_table(spark, sf_dir, "region"))
    # Both sides hash-partitioned on the join key with the session's shuffle
    # width: exactly the exchange a shuffle join needs, but with an explicit
    # count, so AQE does not coalesce the CPU-heavy text stage into one task.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    e = e.repartition(n, "doc_key")
    docs = docs.repartition(n, "doc_id")
    joined = (e.join(docs.hint("merge"), e.doc_key == docs.doc_id)
               .join(nation, e.nation_key == nation.n_nationkey)
               .join(region, F.col("n_regionkey") == region.r_regionkey)
               .withColumnsRenamed({"n_name": "country", "r_name": "region"}))
    et = F.col("event_type")
    return joined.select(
        F.concat(F.lit("post_"), F.col("event_id").cast("string")).alias("tweet_id"),
        F.col("event_id").alias("post_seq"),
        F.col("ts"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("author"),
        F.col("lang").alias("language"),
        F.concat(_case(et, LEAD_INS, DEFAULT_LEAD_IN), F.col("text")).alias("text"),
        F.floor("value").cast("int").alias("likes"),
        (F.col("k") % 40).cast("int").alias("retweets"),
        (F.col("k") % 10).cast("int").alias("replies"),
        F.col("country"),
        F.col("region"),
        _case(et, PRIORITY_BY_TYPE, "normal").alias("priority"),
        F.when(F.col("k") < 20, "escalation").when(F.col("k") < 40, "agreement")
         .otherwise("normal").alias("scenario"),
        ((et == "error") & (F.col("value") > 200)).alias("is_anomaly"),
    )


# SQL text of the same view for the DuckDB oracle (whole document text).
POSTS_SQL = """
n AS (SELECT count(*) AS c FROM documents),
e AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k, c
  FROM events CROSS JOIN n
),
posts AS (
SELECT concat('post_', CAST(e.event_id AS VARCHAR)) AS tweet_id,
       e.event_id AS post_seq,
       e.ts AS ts,
       concat('user_', CAST(e.user_id AS VARCHAR)) AS author,
       d.lang AS language,
       concat(
         CASE e.event_type
           WHEN 'error'    THEN 'BREAKING: tariffs crisis hits Tesla in China, shares fell 12.5% '
           WHEN 'purchase' THEN 'Trade deal lifts growth, exports up 3% worth $1,200.50 million '
           WHEN 'signup'   THEN 'New partnership at Siemens brings progress #trade @desk '
           WHEN 'view'     THEN 'Talks continue in Germany, see http://news.example.com/a '
           ELSE                 'Supply disruption and uncertainty, prices down! ' END,
         d.text) AS text,
       CAST(floor(e.value) AS INT) AS likes,
       CAST(e.k % 40 AS INT) AS retweets,
       CAST(e.k % 10 AS INT) AS replies,
       na.n_name AS country,
       r.r_name AS region,
       CASE e.event_type WHEN 'error' THEN 'critical' WHEN 'purchase' THEN 'high'
                         WHEN 'signup' THEN 'low' ELSE 'normal' END AS priority,
       CASE WHEN e.k < 20 THEN 'escalation' WHEN e.k < 40 THEN 'agreement' ELSE 'normal' END AS scenario,
       (e.event_type = 'error' AND e.value > 200) AS is_anomaly
FROM e
JOIN documents d ON d.doc_id = e.event_id % e.c
JOIN nation na ON na.n_nationkey = e.user_id % 25
JOIN region r ON r.r_regionkey = na.n_regionkey
)"""
