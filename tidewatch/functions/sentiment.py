"""Sentiment functions.

Valence scoring (T16) follows the published rule-based valence method:
lexicon valence per token, negation in the three preceding tokens flips and
damps it, booster words scale it, all-caps words in mixed-case text are
amplified, '!' adds emphasis, and the sum is normalised with
s / sqrt(s^2 + alpha).  The lexicon is a parameter (the original uses a
third-party lexicon, which we neither ship nor copy).

Everything is per row, so no shuffle.  The words of a text are looked at once, for
all that is asked of them (``words.text_facts``); the scores are Spark expressions
over the few facts found.
"""
from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import constants as K
from tidewatch.functions import text as tx
from tidewatch.functions import words as wf


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _map(pairs) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs for x in kv])


def valence_tokens(text) -> Column:
    """Whitespace tokens with leading/trailing punctuation stripped, longer
    than one character."""
    # One pass over the text removes punctuation runs touching a token edge.
    stripped = F.regexp_replace(F.coalesce(_col(text), F.lit("")), EDGE_PUNCT_RE, "")
    return F.filter(F.split(stripped, r"\s+"), lambda t: F.length(t) > 1)


# The leading lookahead rejects ASCII letters, digits and spaces, which most
# characters are, before the Unicode classes are tried.
EDGE_PUNCT_RE = r"(?=[^a-zA-Z0-9_\s])(?:(?<![^\s])[^\p{L}\p{N}_\s]+|[^\p{L}\p{N}_\s]+(?![^\s]))"


def _all_caps(t: Column) -> Column:
    return (t == F.upper(t)) & (t != F.lower(t))


def valence_hits(text, lexicon: dict, boosters: dict, negations) -> Column:
    """``text_facts`` of which n (tokens) and hits, the lexicon hits, are used."""
    return wf.text_facts(text, None, lexicon, boosters, negations)


def valence_scores(text, lexicon=K.VALENCE_LEXICON, negations=K.NEGATIONS,
                   boosters=K.BOOSTERS, facts: Column | None = None) -> Column:
    """struct(compound, pos, neu, neg).  ``lexicon``/``boosters`` are
    (term, weight) pairs, ``negations`` a list of terms (all lower case).
    ``facts``: the text's ``text_facts`` with these, where already there."""
    facts = valence_hits(text, dict(lexicon), dict(boosters), negations) if facts is None else facts

    def valence_of(h):
        v, sign = h["v"], F.signum(h["v"])
        v = v + F.when(h["caps"], sign * K.CAPS_BOOST).otherwise(0.0)
        for d, scale in ((1, 1.0), (2, 0.95), (3, 0.9)):
            v = v + sign * h[f"b{d}"] * scale
        return F.when(h["negated"], v * K.NEGATION_FACTOR).otherwise(v)

    def with_hits(found):
        n = found["n"]
        ep = F.least(found["exclaims"], F.lit(K.EXCLAIM_MAX)) * K.EXCLAIM_BOOST

        def with_vals(vals):
            sums = F.struct(
                F.aggregate(vals, F.lit(0.0), lambda a, v: a + v).alias("total"),
                F.aggregate(vals, F.lit(0.0),
                            lambda a, v: a + F.when(v > 0, v + 1.0).otherwise(0.0)).alias("pos"),
                F.aggregate(vals, F.lit(0.0),
                            lambda a, v: a + F.when(v < 0, v - 1.0).otherwise(0.0)).alias("neg"),
                F.size(F.filter(vals, lambda v: v != 0)).alias("nnz"),
                ep.alias("ep"))

            def with_sums(a):
                total, pos_sum, neg_sum, e = a["total"], a["pos"], a["neg"], a["ep"]
                parts = F.struct(
                    F.when(total > 0, total + e).when(total < 0, total - e).otherwise(total).alias("s"),
                    F.when(pos_sum > -neg_sum, pos_sum + e).otherwise(pos_sum).alias("pos2"),
                    F.when(pos_sum < -neg_sum, neg_sum - e).otherwise(neg_sum).alias("neg2"),
                    (n - a["nnz"]).cast("double").alias("neu"))

                def with_parts(b):
                    sv, pos2, neg2, neu = b["s"], b["pos2"], b["neg2"], b["neu"]
                    tot = pos2 - neg2 + neu
                    share = lambda x: F.when(tot > 0, F.abs(x / tot)).otherwise(0.0)
                    return F.struct((sv / F.sqrt(sv * sv + K.VALENCE_ALPHA)).alias("compound"),
                                    share(pos2).alias("pos"), share(neu).alias("neu"),
                                    share(neg2).alias("neg"))
                return tx.let(parts, with_parts)
            return tx.let(sums, with_sums)

        return tx.let(F.transform(found["hits"], valence_of), with_vals)

    return tx.let(facts, with_hits)


def label_from(score, cut: float) -> Column:
    s = _col(score)
    return F.when(s >= cut, "positive").when(s <= -cut, "negative").otherwise("neutral")


def valence_sentiment(text, **kw) -> Column:
    """T16+T17: struct(method, label, score, confidence, details)."""
    empty = F.coalesce(F.length(_col(text)), F.lit(0)) == 0
    return F.when(empty, _default_sentiment()).otherwise(tx.let(
        valence_scores(text, **kw), lambda sc: F.struct(
            F.lit("valence").alias("method"),
            label_from(sc["compound"], 0.05).alias("label"),
            sc["compound"].alias("score"),
            F.abs(sc["compound"]).alias("confidence"),
            sc.alias("details"))))


def _default_sentiment() -> Column:
    return F.struct(F.lit("default").alias("method"), F.lit("neutral").alias("label"),
                    F.lit(0.0).alias("score"), F.lit(0.0).alias("confidence"),
                    F.struct(F.lit(0.0).alias("compound"), F.lit(0.0).alias("pos"),
                             F.lit(0.0).alias("neu"), F.lit(0.0).alias("neg")).alias("details"))


TRADE_NAMES = ([t for t, _ in K.TRADE_LEXICON], True)


def trade_hits(at: Column, lexicon=K.TRADE_LEXICON) -> Column:
    """The weights (structs with ``w``) of the terms at the places ``at`` of the lexicon."""
    weights = F.array(*[F.struct(F.lit(float(w)).alias("w")) for _, w in lexicon])
    return F.transform(at, lambda i: F.get(weights, i))


def trade_scores(text, urgency, pcts, moves, lexicon=K.TRADE_LEXICON, hits: Column | None = None) -> Column:
    """struct(raw_score, word_count, score, urgency_boost).

    Lexicon terms are matched as substrings of the lower-cased text (each
    counted once), x1.3 when urgency > 1, x(1 + p/100) when the largest
    percentage p exceeds 10, +/-0.5 per up/down movement word, then divided
    by max(hits, 1) and clipped to [-1, 1].  ``hits`` (array of structs with
    ``w``) replaces the lexicon test where a join has found the terms.
    """
    if hits is None:
        hits = trade_hits(tx.contained(text, [t for t, _ in lexicon], "int", lower=True), lexicon)
    low_moves = F.transform(_col(moves), lambda m: F.lower(m))
    moved = F.size(F.filter(low_moves, lambda m: m.isin(K.POSITIVE_MOVEMENTS))) - F.size(F.filter(low_moves, lambda m: m.isin(K.NEGATIVE_MOVEMENTS)))
    inputs = F.struct(hits.alias("h"), _col(urgency).alias("u"), F.array_max(_col(pcts)).alias("maxp"), moved.alias("moved"))

    def from_inputs(x):
        h, u, maxp, nh = x["h"], x["u"], x["maxp"], F.size(x["h"])
        s0 = F.aggregate(h, F.lit(0.0), lambda a, e: a + e["w"])

        def from_s1(s1):
            s2 = F.when(F.coalesce(maxp > 10, F.lit(False)), s1 * (1 + maxp / 100)).otherwise(s1)
            return tx.let(s2 + F.lit(0.5) * x["moved"], lambda s3: F.struct(
                s3.alias("raw_score"), nh.alias("word_count"),
                F.greatest(F.lit(-1.0), F.least(F.lit(1.0), s3 / F.greatest(nh, F.lit(1)))).alias("score"),
                (u > 1.0).alias("urgency_boost")))
        return tx.let(s0, lambda v: tx.let(F.when(u > 1.0, v * 1.3).otherwise(v), from_s1))

    return tx.let(inputs, from_inputs)


def trade_sentiment(text, urgency, pcts, moves, **kw) -> Column:
    """T18+T19: struct(method, label, score, confidence, details)."""
    empty = F.coalesce(F.length(_col(text)), F.lit(0)) == 0
    res = tx.let(trade_scores(text, urgency, pcts, moves, **kw), lambda sc: F.struct(
        F.lit("trade_context").alias("method"),
        label_from(sc["score"], 0.1).alias("label"),
        sc["score"].alias("score"),
        F.least(F.abs(sc["score"]) + 0.3, F.lit(1.0)).alias("confidence"),
        sc.alias("details")))
    default = F.struct(F.lit("default").alias("method"), F.lit("neutral").alias("label"),
                       F.lit(0.0).alias("score"), F.lit(0.0).alias("confidence"),
                       F.struct(F.lit(0.0).alias("raw_score"), F.lit(0).alias("word_count"),
                                F.lit(0.0).alias("score"),
                                F.lit(False).alias("urgency_boost")).alias("details"))
    return F.when(empty, default).otherwise(res)


def agreement(labels: list, scores: list) -> Column:
    """0.6 x (1 if all labels equal else 0.5) + 0.4 / (1 + population std)."""
    same = F.lit(True)
    for l in labels[1:]:
        same = same & (l == labels[0])
    n = float(len(scores))
    mean = sum(scores[1:], scores[0]) / n
    var = sum([(s - mean) * (s - mean) for s in scores[1:]], (scores[0] - mean) * (scores[0] - mean)) / n
    return F.lit(0.6) * F.when(same, 1.0).otherwise(0.5) + F.lit(0.4) / (1.0 + F.sqrt(var))


def ensemble(methods: dict, weights: dict) -> Column:
    """Weighted score and confidence over method structs, label cut
    at +/-0.1, confidence scaled by the agreement."""
    names = list(methods)

    def body(ms):
        score = sum([ms[m]["score"] * weights[m] for m in names[1:]],
                    ms[names[0]]["score"] * weights[names[0]])
        conf = sum([ms[m]["confidence"] * weights[m] for m in names[1:]],
                   ms[names[0]]["confidence"] * weights[names[0]])
        agr = agreement([ms[m]["label"] for m in names], [ms[m]["score"] for m in names])
        return tx.let(F.struct(score.alias("score"), conf.alias("conf"), agr.alias("agr")),
                      lambda v: F.struct(label_from(v["score"], 0.1).alias("label"),
                                         v["score"].alias("score"),
                                         (v["conf"] * v["agr"]).alias("confidence"),
                                         v["agr"].alias("agreement_score"), ms.alias("methods")))

    return tx.let(F.struct(*[methods[m].alias(m) for m in names]), body)


def with_text_analysis(df: DataFrame, text_col: str = "text", lang_col: str = "language",
                       detect: bool = False, valence_kw: dict | None = None,
                       weights: dict | None = None, tags: bool = False) -> DataFrame:
    """Language -> features -> valence + trade -> ensemble, as two
    struct columns ``features`` and ``sentiment``.  Rows without text get the
    neutral default (B1).  ``tags``: keep what the feed producer would tag
    (T23, T24) as ``_topics`` and ``_countries``."""
    weights = weights or K.ENSEMBLE_WEIGHTS
    names = {"orgs": (K.ORGANISATIONS, False), "trade": TRADE_NAMES} | (tx.PRODUCER_NAMES if tags else {})
    lang = tx.language_or_detect(lang_col, text_col, force=detect)
    # Inputs shared by sentiment and features are separate columns, so a
    # query that needs only the sentiment prunes the rest of the features.
    out = df.withColumn("_facts", wf.text_facts(text_col, names, **(valence_kw or {})))
    f = F.col("_facts")
    out = out.withColumns({"_lang": lang, "_urg": tx.urgency_of(text_col, f), "_pcts": tx.percentages(text_col),
                           "_moves": f["moves"], "_orgs": wf.named(f["orgs"], K.ORGANISATIONS),
                           **({"_topics": tx.topics_at(f["topics"]), "_countries": wf.named(f["countries"], K.PRODUCER_COUNTRIES)} if tags else {})})
    out = out.withColumns({
        "_valence": valence_sentiment(text_col, facts=f),
        "_trade": trade_sentiment(text_col, "_urg", "_pcts", "_moves", hits=trade_hits(f["trade"]))})
    val, trade = F.col("_valence"), F.col("_trade")
    ens = ensemble({"valence": val, "trade": trade}, weights)
    neutral = F.struct(F.lit("neutral").alias("label"), F.lit(0.0).alias("score"),
                       F.lit(0.0).alias("confidence"), F.lit(0.0).alias("agreement_score"),
                       F.struct(val.alias("valence"), trade.alias("trade")).alias("methods"))
    out = out.withColumn("sentiment", F.when(tx.has_text(text_col), ens).otherwise(neutral))
    out = (out.withColumn("_clean", tx.clean_text(text_col))
              .withColumn("features", tx.text_features(text_col, "_lang", "_clean", "_urg",
                                                       "_pcts", "_moves", "_orgs")))
    return (out.withColumn(lang_col, F.col("_lang"))
               .drop("_facts", "_lang", "_valence", "_trade", "_urg", "_pcts", "_moves", "_clean", "_orgs"))


# ---- U1: pluggable model scorer ---------------------------------------------

LABEL_ALIASES = {"pos": "positive", "positive": "positive", "label_2": "positive",
                 "neg": "negative", "negative": "negative", "label_0": "negative",
                 "neu": "neutral", "neutral": "neutral", "label_1": "neutral"}


def model_scorer(load_model):
    """Wrap a caller's model as an Arrow-batched iterator pandas UDF.

    ``load_model()`` runs once per task and returns a callable that maps a
    list of whole texts to a list of (label, score) pairs; a failure to load
    fails the query.  ``load_model=None`` gives the neutral default.  Labels
    are normalised; the score is signed (negative labels give negative scores).
    """
    import pandas as pd

    schema = T.StructType([T.StructField("label", T.StringType()),
                           T.StructField("score", T.DoubleType()),
                           T.StructField("confidence", T.DoubleType())])

    def score(batches):
        model = None if load_model is None else load_model()
        for texts in batches:
            if model is None:
                yield pd.DataFrame({"label": ["neutral"] * len(texts),
                                    "score": [0.0] * len(texts), "confidence": [0.0] * len(texts)})
                continue
            preds = [(LABEL_ALIASES.get(str(label).lower(), "neutral"), float(conf))
                     for label, conf in model([t or "" for t in texts])]
            yield pd.DataFrame({
                "label": [label for label, _ in preds],
                "score": [conf if label == "positive" else -conf if label == "negative" else 0.0 for label, conf in preds],
                "confidence": [conf for _, conf in preds]})

    score.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(score, schema)


# ---- T16 join form: big caller lexicons ----------------------------------------------------

def valence_scores_join(df: DataFrame, lexicon: DataFrame, id_col: str = "tweet_id",
                        text_col: str = "text", negations=K.NEGATIONS, boosters=K.BOOSTERS,
                        max_broadcast_bytes: int = 64 << 20) -> DataFrame:
    """T16 with the lexicon as a table (term, weight): same result as
    ``valence_scores`` but a hash join per token instead of a literal map,
    for lexicons with many thousands of entries.

    Tokens are exploded with their three predecessors, joined to the
    lexicon (broadcast behind a check of its bytes), summed per post with
    map-side partial aggregation (only lexicon hits are shuffled), and
    joined back to the posts.  Adds ``valence`` struct(compound, pos, neu, neg).
    The per-row form ``valence_scores`` needs no shuffle; this form trades
    two shuffles (lexicon hits, then the join back) for O(1) lookups.
    """
    from tidewatch.operators.lookups import bounded_broadcast
    lex = bounded_broadcast(lexicon.select(F.col("term").alias("_lt"), F.col("weight").alias("_v0")),
                            max_broadcast_bytes)
    boost = dict(boosters)
    boost_map = _map(boost.items())
    # Per-post columns are computed before the explode: a non-generator
    # expression in the exploding select would run once per token.
    base = df.withColumn("_toks", valence_tokens(text_col))
    base = base.withColumns({"_cd": F.exists("_toks", _all_caps) & ~F.forall("_toks", _all_caps), "_n": F.size("_toks"),
                             "_bangs": tx.count_char(F.coalesce(F.col(text_col), F.lit("")), "!")})
    ctx = base.select(
        F.col(id_col).alias("_id"), "_cd",
        F.posexplode(F.transform("_toks", lambda t, i: F.struct(
            t.alias("t"), F.lower(t).alias("lt"),
            *[F.when(i - d >= 0, F.lower(F.get(F.col("_toks"), i - d))).alias(f"p{d}")
              for d in (1, 2, 3)]))).alias("_pos", "_c"))
    hits = ctx.join(lex, F.col("_c.lt") == F.col("_lt"))
    v0 = F.col("_v0")
    sign = F.signum(v0)
    v = v0 + F.when(F.col("_cd") & _all_caps(F.col("_c.t")), sign * K.CAPS_BOOST).otherwise(0.0)
    for d, scale in ((1, 1.0), (2, 0.95), (3, 0.9)):
        v = v + sign * F.coalesce(F.element_at(boost_map, F.col(f"_c.p{d}")), F.lit(0.0)) * scale
    neg = F.lit(False)
    for d in (1, 2, 3):
        neg = neg | F.coalesce(F.col(f"_c.p{d}").isin(list(negations)), F.lit(False))
    vv = F.when(neg, v * K.NEGATION_FACTOR).otherwise(v)
    sums = hits.withColumn("_vv", vv).groupBy("_id").agg(
        F.sum("_vv").alias("_total"),
        F.sum(F.when(F.col("_vv") > 0, F.col("_vv") + 1.0).otherwise(0.0)).alias("_pos_sum"),
        F.sum(F.when(F.col("_vv") < 0, F.col("_vv") - 1.0).otherwise(0.0)).alias("_neg_sum"),
        F.count(F.when(F.col("_vv") != 0, 1)).alias("_nnz"))
    # What is needed of a text is counted before the join; neither tokens nor text are shuffled for it.
    j = base.drop("_toks", "_cd").join(sums, base[id_col] == sums["_id"], "left")
    total, pos_sum, neg_sum = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("_total", "_pos_sum", "_neg_sum"))
    ep = F.least(F.col("_bangs"), F.lit(K.EXCLAIM_MAX)) * K.EXCLAIM_BOOST
    s = F.when(total > 0, total + ep).when(total < 0, total - ep).otherwise(total)
    pos2 = F.when(pos_sum > -neg_sum, pos_sum + ep).otherwise(pos_sum)
    neg2 = F.when(pos_sum < -neg_sum, neg_sum - ep).otherwise(neg_sum)
    neu = (F.col("_n") - F.coalesce(F.col("_nnz"), F.lit(0))).cast("double")
    tot = pos2 - neg2 + neu
    share = lambda x: F.when(tot > 0, F.abs(x / tot)).otherwise(0.0)
    return (j.withColumn("valence", F.struct((s / F.sqrt(s * s + K.VALENCE_ALPHA)).alias("compound"),
                                             share(pos2).alias("pos"), share(neu).alias("neu"),
                                             share(neg2).alias("neg")))
             .drop("_n", "_bangs", "_id", "_total", "_pos_sum", "_neg_sum", "_nnz"))
