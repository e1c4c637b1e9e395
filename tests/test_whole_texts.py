"""Whole texts stay where they are: no shuffle, no scratch copy carries them where small facts do."""
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import sentiment as st
from tidewatch.operators import lookups as lk

POSTS = [("a", "Tesla talks, great GREAT!! not good", "en"), ("b", None, None), ("c", "", "fr"), ("d", "software war Tesla Siemens tesla", "en"),
         ("d", "software war Tesla Siemens tesla", "en"), ("e", "alpha beta alpha avec gamma avec", "fr"), ("f", "very bad, avec delta ÉCOLE bad", "en")]


@pytest.fixture
def posts(spark):
    return spark.createDataFrame(POSTS, "tweet_id string, text string, language string")


def shuffled(df) -> set:
    """Names of the columns that go through an exchange (broadcasts are none)."""
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    parts = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", plan)
    assert parts
    return {c.split("#")[0].strip() for p in parts for c in p.split(", ")}


def test_valence_by_join_shuffles_no_text(spark, posts):
    """R04-F4"""
    lex = spark.createDataFrame([("great", 3.0), ("good", 2.0), ("bad", -2.5)], "term string, weight double")
    v = st.valence_scores_join(posts.where("tweet_id <> 'd'"), lex).select("tweet_id", "valence")
    assert not shuffled(v) & {"text", "_toks", "_c"}
    want = posts.where("tweet_id <> 'd'").select("tweet_id", st.valence_scores("text", lexicon=[("great", 3.0), ("good", 2.0), ("bad", -2.5)]).alias("valence"))
    assert {r.tweet_id: [round(x, 9) for x in r.valence] for r in v.collect()} == {r.tweet_id: [round(x, 9) for x in r.valence] for r in want.collect()}


@pytest.mark.parametrize("bound", [None, 0])
def test_names_by_join_shuffle_no_text(spark, posts, monkeypatch, bound):
    """R04-F8, F13, F14; a table beyond the broadcast bound gives the same, also for an id that repeats."""
    names = spark.createDataFrame([(0, "Tesla"), (1, "war"), (2, "Siemens"), (3, "nowhere")], "pos int, name string")
    if bound is not None:
        monkeypatch.setattr(lk, "BROADCAST_BYTES", bound)
    d = lk.substring_matches(posts, names).select("tweet_id", F.transform("matches", lambda x: x["name"]).alias("m"))
    assert bound is not None or not shuffled(d) & {"text", "_t"}
    got = [(r.tweet_id, r.m) for r in d.collect()]
    assert Counter(k for k, _ in got) == Counter(r[0] for r in POSTS)
    assert dict(got) == {"a": ["Tesla"], "b": [], "c": [], "e": [], "f": [], "d": [n for n in ("Tesla", "war", "Siemens") for _ in range(4)]}


@pytest.mark.parametrize("bound", [None, 0])
def test_keywords_by_join_shuffle_no_words(spark, posts, monkeypatch, bound):
    """R04-F7"""
    stop = spark.createDataFrame([("fr", "avec"), ("en", "very"), ("en", None)], "lang string, term string")
    if bound is not None:
        monkeypatch.setattr(lk, "BROADCAST_BYTES", bound)
    d = lk.corpus_keywords(posts.withColumn("cleaned", F.regexp_replace("text", "[,!]", "")), stop, k=3)
    plan = d.sparkSession._jvm.PythonSQLUtils.explainString(d._jdf.queryExecution(), "formatted")
    assert bound is not None or "Generate" not in plan
    got = sorted((r.tweet_id, r.keywords) for r in d.collect())
    assert got == [("a", ["great", "tesla", "talks"]), ("b", []), ("c", []), ("d", ["tesla", "software", "siemens"]), ("d", ["tesla", "software", "siemens"]),
                   ("e", ["alpha", "beta", "gamma"]), ("f", ["avec", "delta", "école"])]
