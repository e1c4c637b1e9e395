"""Micro-fixtures for the text functions (regex dialect, Unicode, edges)."""
import random
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from tidewatch import constants as K
from tidewatch.functions import sentiment as st
from tidewatch.functions import text as tx
from tidewatch.functions import words as wf


def one(spark, text, col):
    return spark.createDataFrame([(text,)], "text string").select(col.alias("x")).first()["x"]


def test_hashtags_mentions_unicode(spark):
    t = "Salut #économie et @José_1 !"
    assert one(spark, t, tx.hashtags("text")) == ["économie"]
    assert one(spark, t, tx.mentions("text")) == ["José_1"]
    assert one(spark, t, tx.clean_text("text")) == "Salut économie et !"


def test_emoji_and_urgency(spark):
    t = "BREAKING 🚨🚨 crisis ⚠️ now!"
    # 2 words (breaking, crisis) + 2 symbol runs, caps share, one '!'
    caps = 8 / len(t)
    assert abs(one(spark, t, tx.urgency_score("text")) - (0.3 * 4 + 0.5 * caps + 0.2)) < 1e-12
    assert one(spark, t, tx.clean_text("text")) == "BREAKING crisis now!"


def test_money_and_percent(spark):
    t = "Deal worth $5 million and $1,200.50, up 3 % and 12.5%"
    assert one(spark, t, tx.money_mentions("text")) == ["$5 million", "$1,200.50"]
    assert one(spark, t, tx.percentages("text")) == [3.0, 12.5]
    cur = one(spark, t, tx.currencies("text"))
    assert [(c["amount"], c["unit"]) for c in cur] == [("5", "million"), ("1,200.50", "")]


def test_movements_keep_case(spark):
    assert one(spark, "Up DOWN upward fell", tx.movements("text")) == ["Up", "DOWN", "fell"]


def test_empty_blank_url_only(spark):
    for t in ("", "   ", "http://x.example/a"):
        assert one(spark, t, tx.clean_text("text")) == ""
        assert one(spark, t, tx.word_count(tx.clean_text("text"))) == 0
        assert one(spark, t, tx.readability(tx.clean_text("text"))) == 50.0
    assert one(spark, None, tx.has_text("text")) is False


def test_substring_matching_is_kept(spark):
    # 'war' inside 'software', 'GE' inside 'GERMANY': the original's behaviour
    r = one(spark, "software ideal GERMANY", st.trade_scores(
        "text", F.lit(0.0), F.array().cast("array<double>"), F.array().cast("array<string>")))
    assert r["word_count"] == 2  # war, deal
    assert "GE" in one(spark, "GERMANY", tx.organisations("text"))
    assert one(spark, "GERMANY", tx.tag_substrings("text", ["GE"], match="word")) == []


def test_keywords_order(spark):
    t = "tariffs growth tariffs exports growth tariffs trade"
    kw = one(spark, t, tx.top_keywords(F.col("text"), F.lit("en")))
    assert kw == ["tariffs", "growth", "exports", "trade"]


def test_language_detect(spark):
    assert one(spark, "le chat est dans la maison avec une souris", tx.detect_language("text")) == "fr"
    assert one(spark, "the cat is in the house", tx.detect_language("text")) == "en"


def test_valence_negation_and_caps(spark):
    pos = one(spark, "growth is good", st.valence_scores("text"))["compound"]
    neg = one(spark, "growth is not good", st.valence_scores("text"))["compound"]
    assert pos > 0 and neg < pos
    loud = one(spark, "markets are GOOD today", st.valence_scores("text"))["compound"]
    quiet = one(spark, "markets are good today", st.valence_scores("text"))["compound"]
    assert loud > quiet


ODD = ["", "  GOOD war\x1cbad\x85not  good", "--war-- «crisis» isn't—good. _x_", "été très GOOD de\u00a0al deal\tno ⚠️ growth!", "ΣΑΣ war ß 𝐀up up", "日本語 war, x² A b"]


def test_tokens_of_the_one_pass_equal_the_token_column(spark):
    df = spark.createDataFrame([(t,) for t in ODD], "text string")
    rows = df.select("text", st.valence_tokens("text").alias("t"), st.valence_hits("text", {"war": 1, "good": 2}, {"très": 3}, ["no", "not"]).alias("h")).collect()
    for r in rows:
        assert r["h"]["n"] == len(r["t"])
        assert [h["v"] for h in r["h"]["hits"]] == [{"war": 1, "good": 2}[w.lower()] for w in r["t"] if w.lower() in ("war", "good")]
    h = next(r["h"]["hits"] for r in rows if r["text"].startswith("été"))
    assert (h[0]["v"], h[0]["caps"], h[0]["b1"], h[0]["b2"], h[0]["negated"]) == (2.0, True, 3.0, 0.0, False)


def test_one_pass_counts_equal_those_of_the_cleaned_text(spark):
    df = spark.createDataFrame([(t, "fr") for t in ODD + ["#économie @José http://a.b Œuvre. Zwölf Œuvre", None]], "text string, lang string")
    c = tx.clean_text("text")
    for r in df.select(tx.clean_counts("text").alias("n"), c.alias("c"), tx.word_count(c).alias("w"), tx.sentence_count(c).alias("s"),
                       tx.post_keywords("text", "lang").alias("k"), tx.top_keywords(c, "lang").alias("k2")).collect():
        assert (r["n"]["words"], r["n"]["chars"], r["n"]["sentences"]) == (r["w"], len(r["c"]), r["s"]) and r["k"] == r["k2"]


def test_a_letter_beyond_the_basic_plane_belongs_to_the_word(spark):
    assert one(spark, "𝐀up 𝐀crisis up", tx.movements("text")) == ["up"]
    assert one(spark, "up𝐀", tx.movements("text")) == []


def test_text_analysis_has_no_regex_over_the_tokens(spark):
    """Every post's text went through a look-around regex and per-token lambdas."""
    df = st.with_text_analysis(spark.createDataFrame([("war", "en")], "text string, language string")).select("sentiment")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan and "split(" not in plan


def test_few_grams_and_many_give_the_same_names(spark, monkeypatch):
    from tidewatch.operators import lookups as lk
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate([*ODD, None, "Xwarx AB"])], "tweet_id string, text string")
    names = spark.createDataFrame([(0, "war"), (1, "Good"), (2, "é"), (3, "AB"), (4, "")], "pos int, name string")
    few = {r[0]: r[1] for r in lk.substring_matches(df, names, lower=True).select("tweet_id", "matches").collect()}
    monkeypatch.setattr(lk, "FEW_GRAMS", 0)
    assert few == {r[0]: r[1] for r in lk.substring_matches(df, names, lower=True).select("tweet_id", "matches").collect()}


def test_facts_of_one_pass_equal_those_of_each_function(spark):
    names = ["war", "é", "A B", "", "Bank of America", "x²"]
    odd = ODD + [None, "a Bank of America", "xBank of Americas, Bank  of America", "É URGENT 🚨⚠️ Up!! İ σας ΣΑΣ crisis\x1cDOWN", "so very not\tgood - ! bad"]
    df = spark.createDataFrame([(t,) for t in odd], "text string").withColumn("f", wf.text_facts("text", {"found": (names, False), "low": ([n.lower() for n in names], True)}))
    for r in df.select("f", tx.urgency_score("text").alias("u"), tx.urgency_of("text", F.col("f")).alias("u1"), tx.movements("text").alias("m"),
                       tx.contained("text", names, "int").alias("n"), tx.contained("text", [n.lower() for n in names], "int", lower=True).alias("l")).collect():
        assert (r["f"]["moves"], r["f"]["found"], r["f"]["low"], r["u1"]) == (r["m"], r["n"], r["l"], r["u"])
    h = df.where("text like 'so very%'").first()["f"]["hits"]
    assert [(x["b1"], x["b2"], x["b3"], x["negated"]) for x in h] == [(0.0, 0.293, 0.293, True), (0.0, 0.0, 0.293, True)]


def test_metric_rows_hand_a_text_to_one_function_once(spark):
    """Sentiment, urgency, movements and every list of names each read the whole text."""
    from tidewatch.plans import scoring
    posts = spark.createDataFrame([("post_1", 1, "war", "en", 1, 2, 3)], "tweet_id string, post_seq long, text string, language string, likes int, retweets int, replies int")
    posts = posts.selectExpr("*", "timestamp_ntz'2024-01-01' as ts", "'a' as author", "'CHINA' as country", "'ASIA' as region", "'high' as priority",
                             "'normal' as scenario", "false as is_anomaly")
    plan = scoring.metric_rows(posts)._jdf.queryExecution().optimizedPlan().toString()
    passes = [line for line in plan.splitlines() if "ArrowEvalPython" in line]
    assert len(passes) == 1 and passes[0].count("run") == 1


def test_few_words_are_looked_at():
    """A name in capitals, or a word that must stand alone, doesn't make its lower case or a part of it looked at."""
    memo = wf._look([("GE", False), ("war", True)], {}, {}, frozenset())
    text = "legend bridges upper GEx Software (UP) lost downs a"
    (n, marks), = memo.of(pa.array([text]))
    assert n == 9 and [(i, f[7:9]) for i, f in marks] == [(3, ((), (0,))), (4, ((), (1,))), (5, (("UP",), ())), (6, (("lost",), ())), (8, ((), ()))]
    assert set(memo) == {"GEx", "Software", "(UP)", "lost", "a"} and marks[-1][1] is wf.ONLY_SHORT


def test_best_words_equal_a_full_count():
    rng = random.Random(3)
    words = ["this", "avec", "alpha", "beta", "x1yz", "été", "œuvre", "abc", "", "Gamma", "gamma", "delta", "omega's"]
    for k in (0, 1, 3, 10):
        best = tx._best_words(k, None)
        for _ in range(300):
            text, lang = " ".join(rng.choice(words) for _ in range(rng.randrange(40))), rng.choice(["en", "fr", None])
            stop = K.STOP_WORDS_FRENCH if lang == "fr" else K.STOP_WORDS_ENGLISH
            n = Counter(w for w in text.lower().split(" ") if len(w) > 3 and w.isalpha() and w not in stop)
            assert best(text, lang) == [w for w, _ in n.most_common(k)]
    looked = []

    class Word(str):
        def isalpha(self):
            looked.append(self)
            return True

    class Text(str):
        def lower(self):
            return self

        def split(self, by):
            return [Word(f"word{i % 400}") for i in range(500)]
    assert tx._best_words(5, None)(Text(), "en") == [f"word{i}" for i in range(5)] and len(looked) == 5


def test_clean_counts_are_those_of_the_cleaned_text():
    """the counts are taken without the cleaned text, and agree with it."""
    odd = [None, "", " \t", "a", "\u00e9t\u00e9 \u0152uvre \u0178 na\u00efve", "x.y. z!  #h\u00e9 @me http://a.b/c end", "\u2026\u2026 \u4f60\u597d \u0416\u0438 1\u00b2 \u2460", "\x00a\x1cb\x85c\u00a0d",
           "".join(map(chr, range(0x20, 0x250))), "-".join(map(chr, range(0x250, 0x2b00, 7)))]
    for t in odd:
        c = tx._cleaned(t)
        assert tx._clean_counts(t) == {"words": len(c.split()), "chars": len(c), "sentences": c.count(".") + 1, "syllables": tx._vowel_groups(c)}


def test_each_different_word_of_a_batch_is_looked_at_once():
    """Repeats of a word, in one text or in many, cost one look."""
    seen = []
    memo = wf.WordFacts(lambda w: seen.append(w) or (w if w == "war" else 0), "war|x{70}")
    long = "x" * 70                  # is not remembered between batches
    got = list(memo.of(pa.array([f"war {long} peace war", f"{long} {long}\twar", "warm"])))
    assert got == [(4, [(0, "war"), (3, "war")]), (3, [(2, "war")]), (1, [])]
    assert sorted(seen) == ["war", "warm", long]
