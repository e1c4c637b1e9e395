"""Substring near-duplicates: bounded buckets, whole links."""
import random

from tidewatch.llm import passages


def report(spark, rows):
    return {r.doc_id: r for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}


def test_buckets_grow_with_the_words(spark, monkeypatch):
    """A bucket of cells is one group in memory; with a set number of buckets it grew with the table."""
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{i // 2}x{rng.randrange(10 ** 6) if j < 80 and i % 2 else j}" for j in range(160))) for i in range(40)]
    seen, plain = [], passages.candidate_links
    monkeypatch.setattr(passages, "candidate_links", lambda texts, buckets, *a: seen.append(buckets) or plain(texts, buckets, *a))
    few = report(spark, rows)
    monkeypatch.setattr(passages, "BUCKET_WORDS", 100)
    many = report(spark, rows)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert seen == [width, 64] and width < 64
    assert len(few) == 40 and few == many
