"""DuckDB SQL for every registered query: the correctness oracle.

Written independently of the Spark code (unnest + window + join forms where
Spark works per row), over the same driver tables and the same ``posts``
view text.  RE2 ``\\w`` is ASCII, so word characters are ``[\\p{L}\\p{N}_]``.
"""
from __future__ import annotations

from tidewatch import constants as K
from tidewatch.sources.tables import POSTS_SQL

ORACLE: dict = {}

# The patterns, written here from the definitions so that a wrong one in the
# engine does not pass both sides.
WORD = r"[\p{L}\p{N}_]"
URL_RE = r"(?:http|www)\S+"
HASHTAG_RE = r"#([\p{L}\p{N}_]+)"
MENTION_RE = r"@([\p{L}\p{N}_]+)"
PERCENT_RE = r"([0-9]+(?:\.[0-9]+)?)\s*%"
CURRENCY_RE = r"\$([0-9]+(?:,[0-9]{3})*(?:\.[0-9]{2})?)\s*(billion|million|trillion)?"
MONEY_RE = r"(?i)\$[0-9]+(?:,[0-9]{3})*(?:\.[0-9]{2})?(?:\s*(?:billion|million|trillion))?"
SYMBOL_RUN_RE = "[🚨⚡🔥💥⛔🔴⚠️]+"
KEEP_CLASS_RE = r"[^\p{L}\p{N}_\s.!?,\-%$]"
VOWEL_GROUP_RE = "[aeiouyàâäéèêëîïôöùûüÿœæ]+"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lst(vals) -> str:
    return "[" + ", ".join(q(v) for v in vals) + "]"


def tup(vals) -> str:
    return "(" + ", ".join(q(v) for v in vals) + ")"


def with_posts(*ctes: str) -> str:
    return "WITH " + ",\n".join((POSTS_SQL,) + ctes)


def r6(x: str) -> str:
    """Round to 6 places through a 9-place decimal (see catalog.r6)."""
    return f"CAST(round(TRY_CAST(CAST({x} AS DOUBLE) AS DECIMAL(38,9)), 6) AS DOUBLE)"


def jn(x: str) -> str:
    return f"array_to_string({x}, '|')"


# ---- scalar SQL fragments ------------------------------------------------------

def clean(t: str) -> str:
    s = f"coalesce({t}, '')"
    s = f"regexp_replace({s}, {q(URL_RE)}, '', 'g')"
    s = f"regexp_replace({s}, {q(HASHTAG_RE)}, '\\1', 'g')"
    s = f"regexp_replace({s}, {q('@' + WORD + '+')}, '', 'g')"
    s = f"regexp_replace({s}, {q(KEEP_CLASS_RE)}, ' ', 'g')"
    return f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"


def nchar(t: str, ch: str) -> str:
    return f"(length({t}) - length(replace({t}, {q(ch)}, '')))"


def wcount(c: str) -> str:
    return f"(CASE WHEN {c} = '' THEN 0 ELSE len(string_split({c}, ' ')) END)"


def scount(c: str) -> str:
    return f"({nchar(c, '.')} + 1)"


def urgency(t: str) -> str:
    t = f"coalesce({t}, '')"
    words = [w for g in K.URGENCY_WORD_GROUPS for w in g]
    hits = f"len(list_filter(regexp_extract_all(lower({t}), {q(WORD + '+')}), lambda x: x IN {tup(words)}))"
    runs = f"len(regexp_extract_all({t}, {q(SYMBOL_RUN_RE)}))"
    caps = f"(len(regexp_extract_all({t}, '\\p{{Lu}}')) / greatest(length({t}), 1))"
    return (f"least(CAST(0.3 * ({hits} + {runs}) + 0.5 * {caps} + 0.2 * {nchar(t, '!')} AS DOUBLE), 2.0)")


def pcts(t: str) -> str:
    return (f"list_transform(regexp_extract_all(coalesce({t}, ''), {q(PERCENT_RE)}, 1), "
            f"lambda x: CAST(x AS DOUBLE))")


def moves(t: str) -> str:
    return (f"list_filter(regexp_extract_all(coalesce({t}, ''), {q(WORD + '+')}), "
            f"lambda x: lower(x) IN {tup(K.MOVEMENT_WORDS)})")


def tags(t: str, names) -> str:
    return f"list_filter({lst(names)}, lambda n: contains(coalesce({t}, ''), n))"


def readability(c: str) -> str:
    w, s = wcount(c), scount(c)
    syl = f"len(regexp_extract_all(lower({c}), {q(VOWEL_GROUP_RE)}))"
    return (f"(CASE WHEN {w} = 0 THEN 50.0 ELSE 206.835 - 1.015 * (CAST({w} AS DOUBLE) / {s}) "
            f"- 84.6 * (CAST({syl} AS DOUBLE) / {w}) END)")


def trade_cte(src: str = "posts") -> str:
    """trade(tweet_id, raw_score, hits, score, label, confidence)."""
    entries = "[" + ", ".join(f"{{'term': {q(t)}, 'w': CAST({w} AS DOUBLE)}}"
                              for t, w in K.TRADE_LEXICON) + "]"
    return f"""
tr0 AS (
  SELECT tweet_id, text,
         list_filter({entries}, lambda e: contains(lower(coalesce(text, '')), e.term)) AS hits,
         {urgency('text')} AS urg, list_max({pcts('text')}) AS maxp,
         list_transform({moves('text')}, lambda m: lower(m)) AS mv
  FROM {src}),
tr1 AS (
  SELECT tweet_id, text, len(hits) AS nh,
         coalesce(list_sum(list_transform(hits, lambda e: e.w)), 0.0) AS s0,
         urg, maxp, mv FROM tr0),
tr2 AS (
  SELECT tweet_id, text, nh, CASE WHEN urg > 1.0 THEN s0 * 1.3 ELSE s0 END AS s1, maxp, mv FROM tr1),
tr3 AS (
  SELECT tweet_id, text, nh,
         (CASE WHEN coalesce(maxp > 10, false) THEN s1 * (1 + maxp / 100) ELSE s1 END)
           + 0.5 * (len(list_filter(mv, lambda m: m IN {tup(K.POSITIVE_MOVEMENTS)}))
                    - len(list_filter(mv, lambda m: m IN {tup(K.NEGATIVE_MOVEMENTS)}))) AS raw_score
  FROM tr2),
trade AS (
  SELECT tweet_id, raw_score, nh AS hits, sc AS score,
         CASE WHEN length(coalesce(text, '')) = 0 THEN 'neutral'
              WHEN sc >= 0.1 THEN 'positive' WHEN sc <= -0.1 THEN 'negative' ELSE 'neutral' END AS label,
         CASE WHEN length(coalesce(text, '')) = 0 THEN 0.0 ELSE least(abs(sc) + 0.3, 1.0) END AS confidence
  FROM (SELECT *, greatest(-1.0, least(1.0, raw_score / greatest(nh, 1))) AS sc FROM tr3))"""


def valence_cte(src: str = "posts") -> str:
    """valence(tweet_id, compound, pos, neu, neg, label) in unnest + lag form."""
    lex = ", ".join(f"({q(t)}, CAST({w} AS DOUBLE))" for t, w in K.VALENCE_LEXICON)
    boost = ", ".join(f"({q(t)}, CAST({w} AS DOUBLE))" for t, w in K.BOOSTERS)
    strip = "'^[^\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_]+$'"
    caps = "x = upper(x) AND x <> lower(x)"
    return f"""
vlex(term, w) AS (VALUES {lex}),
vboost(term, b) AS (VALUES {boost}),
vt AS (
  SELECT tweet_id, text,
         list_filter(list_transform(list_filter(string_split_regex(coalesce(text, ''), '\\s+'),
                                                lambda x: x <> ''),
                                    lambda x: regexp_replace(x, {strip}, '', 'g')),
                     lambda x: length(x) > 1) AS toks
  FROM {src}),
vt2 AS (
  SELECT tweet_id, text, toks, len(toks) AS n,
         (len(list_filter(toks, lambda x: {caps})) > 0
          AND len(list_filter(toks, lambda x: {caps})) < len(toks)) AS caps_diff
  FROM vt),
vu AS (
  SELECT tweet_id, caps_diff, unnest(toks) AS t, generate_subscripts(toks, 1) AS i FROM vt2),
vw AS (
  SELECT *, lower(t) AS lt,
         lag(lower(t), 1) OVER w AS p1, lag(lower(t), 2) OVER w AS p2, lag(lower(t), 3) OVER w AS p3
  FROM vu WINDOW w AS (PARTITION BY tweet_id ORDER BY i)),
vh AS (
  SELECT vw.tweet_id, vlex.w AS v0, sign(vlex.w) AS sg,
         (CASE WHEN caps_diff AND t = upper(t) AND t <> lower(t) THEN sign(vlex.w) * {K.CAPS_BOOST} ELSE 0.0 END) AS capb,
         coalesce(b1.b, 0.0) AS b1, coalesce(b2.b, 0.0) AS b2, coalesce(b3.b, 0.0) AS b3,
         (coalesce(p1 IN {tup(K.NEGATIONS)}, false) OR coalesce(p2 IN {tup(K.NEGATIONS)}, false)
          OR coalesce(p3 IN {tup(K.NEGATIONS)}, false)) AS negated
  FROM vw JOIN vlex ON vlex.term = vw.lt
  LEFT JOIN vboost b1 ON b1.term = vw.p1
  LEFT JOIN vboost b2 ON b2.term = vw.p2
  LEFT JOIN vboost b3 ON b3.term = vw.p3),
vv AS (
  SELECT tweet_id,
         CASE WHEN negated THEN v * {K.NEGATION_FACTOR} ELSE v END AS v
  FROM (SELECT *, (((v0 + capb) + sg * b1 * 1.0) + sg * b2 * 0.95) + sg * b3 * 0.9 AS v FROM vh)),
vagg AS (
  SELECT tweet_id, sum(v) AS total,
         sum(CASE WHEN v > 0 THEN v + 1.0 ELSE 0.0 END) AS pos_sum,
         sum(CASE WHEN v < 0 THEN v - 1.0 ELSE 0.0 END) AS neg_sum,
         count(*) FILTER (WHERE v <> 0) AS nnz
  FROM vv GROUP BY tweet_id),
vs AS (
  SELECT vt2.tweet_id, vt2.text, vt2.n, coalesce(total, 0.0) AS total,
         coalesce(pos_sum, 0.0) AS pos_sum, coalesce(neg_sum, 0.0) AS neg_sum,
         coalesce(nnz, 0) AS nnz,
         least({nchar("coalesce(vt2.text, '')", '!')}, {K.EXCLAIM_MAX}) * {K.EXCLAIM_BOOST} AS ep
  FROM vt2 LEFT JOIN vagg USING (tweet_id)),
vs2 AS (
  SELECT *, CASE WHEN total > 0 THEN total + ep WHEN total < 0 THEN total - ep ELSE total END AS s,
         CASE WHEN pos_sum > -neg_sum THEN pos_sum + ep ELSE pos_sum END AS pos2,
         CASE WHEN pos_sum < -neg_sum THEN neg_sum - ep ELSE neg_sum END AS neg2,
         CAST(n - nnz AS DOUBLE) AS neu
  FROM vs),
valence AS (
  SELECT tweet_id,
         CASE WHEN length(coalesce(text, '')) = 0 THEN 0.0 ELSE s / sqrt(s * s + {K.VALENCE_ALPHA}) END AS compound,
         CASE WHEN pos2 - neg2 + neu > 0 THEN abs(pos2 / (pos2 - neg2 + neu)) ELSE 0.0 END AS pos,
         CASE WHEN pos2 - neg2 + neu > 0 THEN abs(neu / (pos2 - neg2 + neu)) ELSE 0.0 END AS neu,
         CASE WHEN pos2 - neg2 + neu > 0 THEN abs(neg2 / (pos2 - neg2 + neu)) ELSE 0.0 END AS neg
  FROM vs2)"""


def valence_label(c: str) -> str:
    return f"CASE WHEN {c} >= 0.05 THEN 'positive' WHEN {c} <= -0.05 THEN 'negative' ELSE 'neutral' END"


def ensemble_cte() -> str:
    """sent(tweet_id, score, label, confidence, agreement) from valence + trade."""
    wv, wt = K.ENSEMBLE_WEIGHTS["valence"], K.ENSEMBLE_WEIGHTS["trade"]
    return f"""
sent0 AS (
  SELECT p.tweet_id, p.text,
         CASE WHEN length(coalesce(p.text, '')) = 0 THEN 'neutral' ELSE {valence_label('v.compound')} END AS vl,
         v.compound AS vs, abs(v.compound) AS vc,
         t.label AS tl, t.score AS ts, t.confidence AS tc
  FROM posts p JOIN valence v USING (tweet_id) JOIN trade t USING (tweet_id)),
sent1 AS (
  SELECT *, vs * {wv} + ts * {wt} AS score, vc * {wv} + tc * {wt} AS wconf,
         0.6 * (CASE WHEN vl = tl THEN 1.0 ELSE 0.5 END)
           + 0.4 / (1.0 + sqrt(((vs - (vs + ts) / 2.0) * (vs - (vs + ts) / 2.0)
                               + (ts - (vs + ts) / 2.0) * (ts - (vs + ts) / 2.0)) / 2.0)) AS agr
  FROM sent0),
sent AS (
  SELECT tweet_id,
         CASE WHEN length(trim(coalesce(text, ''))) = 0 THEN 0.0 ELSE score END AS score,
         CASE WHEN length(trim(coalesce(text, ''))) = 0 THEN 'neutral'
              WHEN score >= 0.1 THEN 'positive' WHEN score <= -0.1 THEN 'negative' ELSE 'neutral' END AS label,
         CASE WHEN length(trim(coalesce(text, ''))) = 0 THEN 0.0 ELSE wconf * agr END AS confidence,
         CASE WHEN length(trim(coalesce(text, ''))) = 0 THEN 0.0 ELSE agr END AS agreement
  FROM sent1)"""


def keywords_cte(src: str = "posts") -> str:
    """kw(tweet_id, keywords) -- top 10 by count then first position."""
    en, fr = K.STOP_WORDS_ENGLISH, K.STOP_WORDS_FRENCH
    return f"""
kc AS (SELECT tweet_id, coalesce(language, 'en') AS lang,
              string_split(lower({clean('text')}), ' ') AS toks FROM {src}),
ktok AS (SELECT tweet_id, lang, unnest(toks) AS w, generate_subscripts(toks, 1) AS i FROM kc),
kcand AS (
  SELECT * FROM ktok
  WHERE length(w) > 3 AND regexp_full_match(w, '\\p{{L}}+')
    AND NOT (CASE WHEN lang = 'fr' THEN w IN {tup(fr)} ELSE w IN {tup(en)} END)),
kagg AS (SELECT tweet_id, w, count(*) AS cnt, min(i) AS first FROM kcand GROUP BY tweet_id, w),
krank AS (SELECT *, row_number() OVER (PARTITION BY tweet_id ORDER BY cnt DESC, first) AS rn FROM kagg),
kw AS (
  SELECT kc.tweet_id, coalesce(string_agg(w, '|' ORDER BY rn), '') AS keywords
  FROM kc LEFT JOIN krank ON krank.tweet_id = kc.tweet_id AND rn <= 10
  GROUP BY kc.tweet_id)"""


# ---- queries -----------------------------------------------------------------------

def _simple(name: str, select: str) -> None:
    ORACLE[name] = with_posts() + f"\nSELECT tweet_id, {select} FROM posts"


_simple("t01_language",
        f"CASE WHEN len(list_intersect(string_split_regex(lower(coalesce(text, '')), '\\s+'), {lst(K.FRENCH_MARKERS)}))"
        f" > len(list_intersect(string_split_regex(lower(coalesce(text, '')), '\\s+'), {lst(K.ENGLISH_MARKERS)}))"
        f" THEN 'fr' ELSE 'en' END AS detected")
_simple("t02_clean_text", f"{clean('text')} AS cleaned_text")
ORACLE["t03_text_counts"] = with_posts(f"c AS (SELECT tweet_id, text, {clean('text')} AS c FROM posts)") + f"""
SELECT tweet_id, CAST(length(text) AS BIGINT) AS length, CAST({wcount('c')} AS BIGINT) AS word_count,
       CAST(length(c) AS BIGINT) AS char_count, CAST({scount('c')} AS BIGINT) AS sentence_count FROM c"""
ORACLE["t04_readability"] = with_posts(f"c AS (SELECT tweet_id, {clean('text')} AS c FROM posts)") + \
    f"\nSELECT tweet_id, {r6(readability('c'))} AS readability FROM c"
_simple("t05_urgency", f"{r6(urgency('text'))} AS urgency")
ORACLE["t06_percentages"] = with_posts(f"p AS (SELECT tweet_id, {pcts('text')} AS p FROM posts)") + f"""
SELECT tweet_id, CAST(len(p) AS BIGINT) AS n_pct, {r6('list_max(p)')} AS max_pct,
       {r6('coalesce(list_sum(p), 0.0)')} AS sum_pct FROM p"""
TXT = "coalesce(text, '')"
_simple("t07_currencies",
        jn(f"list_transform(list_zip(regexp_extract_all({TXT}, {q(CURRENCY_RE)}, 1), "
           f"regexp_extract_all({TXT}, {q(CURRENCY_RE)}, 2)), "
           f"lambda z: z[1] || ':' || coalesce(z[2], ''))") + " AS currencies")
_simple("t08_movements", f"{jn(moves('text'))} AS movements")
_simple("t09_money", jn(f"regexp_extract_all({TXT}, {q(MONEY_RE)}, 0)[1:5]") + " AS money")
_simple("t10_organisations", f"{jn(tags('text', K.ORGANISATIONS))} AS organisations")
_simple("t11_places", f"{jn(tags('text', K.PLACES))} AS places")
ORACLE["t12_keywords"] = with_posts(keywords_cte()) + "\nSELECT tweet_id, keywords FROM kw"
_simple("t13_hashtags", jn(f"regexp_extract_all({TXT}, {q(HASHTAG_RE)}, 1)") + " AS hashtags")
_simple("t14_mentions", jn(f"regexp_extract_all({TXT}, {q(MENTION_RE)}, 1)") + " AS mentions")
_simple("t15_urls", jn(f"regexp_extract_all({TXT}, {q(URL_RE)}, 0)") + " AS urls")
_simple("t23_topics", jn(f"list_filter({lst(K.TOPIC_VOCABULARY)}, "
                         f"lambda n: contains(lower({TXT}), lower(n)))[1:5]") + " AS topics")
_simple("t24_entities", f"{jn(tags('text', K.ORGANISATIONS))} AS companies, "
                        f"{jn(tags('text', K.PRODUCER_COUNTRIES))} AS countries")
ORACLE["t16_valence"] = with_posts(valence_cte()) + f"""
SELECT tweet_id, {r6('compound')} AS compound, {r6('pos')} AS pos, {r6('neu')} AS neu,
       {r6('neg')} AS neg, {valence_label('compound')} AS label FROM valence"""
ORACLE["t18_trade"] = with_posts(trade_cte()) + f"""
SELECT tweet_id, {r6('raw_score')} AS raw_score, CAST(hits AS BIGINT) AS hits, {r6('score')} AS score,
       label, {r6('confidence')} AS confidence FROM trade"""
ORACLE["t21_ensemble"] = with_posts(valence_cte(), trade_cte(), ensemble_cte()) + f"""
SELECT tweet_id, {r6('score')} AS score, label, {r6('agreement')} AS agreement,
       {r6('confidence')} AS confidence FROM sent"""


# ---- metrics, frames, baselines, detectors ------------------------------------------

def D(x) -> str:
    return f"CAST({x} AS DOUBLE)"


def kw_sql(t: str = "text") -> str:
    topics = f"list_filter({lst(K.TOPIC_VOCABULARY)}, lambda n: contains(lower(coalesce({t}, '')), lower(n)))[1:5]"
    allk = f"list_concat({topics}, {tags(t, K.ORGANISATIONS)}, {tags(t, K.PRODUCER_COUNTRIES)})"
    kept = f"list_transform(list_filter({allk}, lambda k: length(k) > 2), lambda k: trim(lower(k)))"
    return f"list_filter({kept}, lambda k: regexp_full_match(regexp_replace(k, '[-_]', '', 'g'), '[\\p{{L}}\\p{{N}}]+'))"


def metrics_ctes() -> tuple:
    pf = " ".join(f"WHEN {q(k)} THEN {D(v)}" for k, v in K.PRIORITY_FACTORS.items())
    return (valence_cte(), trade_cte(), ensemble_cte(), f"""
m0 AS (
  SELECT p.tweet_id, p.post_seq, p.ts, p.country, p.priority, p.scenario, p.is_anomaly,
         s.score AS sentiment,
         {D(0.3)} * coalesce(p.likes, 0) + {D(0.5)} * coalesce(p.retweets, 0) + {D(0.2)} * coalesce(p.replies, 0) AS engagement,
         {kw_sql('p.text')} AS kw
  FROM posts p JOIN sent s USING (tweet_id)),
m2 AS (SELECT *, (CASE priority {pf} ELSE {D(1.0)} END) * (1 + engagement / 100) AS volume FROM m0)""")


QUERY_WINDOW_S = 2 * 86400  # the catalogue's detector frame (SURVEY 7.1)
FRAMES_CTE = f"""
f0 AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY ts, post_seq) AS rn FROM m2),
f1 AS (
  SELECT *,
         min(rn) OVER (PARTITION BY country ORDER BY ts
                       RANGE BETWEEN INTERVAL {QUERY_WINDOW_S} SECONDS PRECEDING AND CURRENT ROW) AS lo,
         avg(volume) OVER w3 AS vol_last3, avg(engagement) OVER w3 AS eng_last3,
         avg(sentiment) OVER w5 AS sent_last5
  FROM f0
  WINDOW w3 AS (PARTITION BY country ORDER BY ts, post_seq ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
         w5 AS (PARTITION BY country ORDER BY ts, post_seq ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
f2 AS (SELECT *, least(rn - lo + 1, {K.SHORT_CAP}) AS n FROM f1),
fsum AS (
  SELECT a.tweet_id, sum(b.sentiment) AS sum_frame
  FROM f2 a JOIN f2 b ON b.country = a.country AND b.rn BETWEEN a.rn - a.n + 1 AND a.rn
  GROUP BY a.tweet_id),
frames AS (
  SELECT f2.*, CASE WHEN n > 5 THEN (sum_frame - sent_last5 * least(n, 5)) / (n - 5) ELSE 0.0 END AS sent_hist
  FROM f2 JOIN fsum USING (tweet_id))"""


def baseline_ctes() -> str:
    q_cols = ", ".join(f"quantile_cont({m}, [0.25, 0.75]) AS q_{m}" for m in ("volume", "sentiment", "engagement"))
    aggs, stats, force = [], [], []
    for m in ("volume", "sentiment", "engagement"):
        inside = (f"{m} >= q_{m}[1] - 1.5 * (q_{m}[2] - q_{m}[1]) - 1e-9 "
                  f"AND {m} <= q_{m}[2] + 1.5 * (q_{m}[2] - q_{m}[1]) + 1e-9")
        aggs.append(f"avg({m}) FILTER (WHERE {inside}) AS {m}_mean, "
                    f"stddev_pop({m}) FILTER (WHERE {inside}) AS {m}_std")
        stats.append(f"CASE WHEN n >= {K.MIN_SAMPLES} THEN {m}_mean END AS {m}_mean, "
                     f"CASE WHEN n >= {K.MIN_SAMPLES} AND {m}_mean IS NOT NULL "
                     f"THEN greatest({m}_std, 0.01) END AS {m}_std")
        dm, ds = K.DEFAULT_BASELINES[m]
        force.append(f"coalesce(last_value({m}_mean IGNORE NULLS) OVER wb, {D(dm)}) AS b_{m}_mean, "
                     f"coalesce(last_value({m}_std IGNORE NULLS) OVER wb, {D(ds)}) AS b_{m}_std")
    return f"""
bk AS (SELECT *, CAST(date_trunc('day', ts) AS TIMESTAMP) AS bucket FROM m2),
bq AS (SELECT country, bucket, count(*) AS n, {q_cols} FROM bk GROUP BY country, bucket),
bs AS (
  SELECT bk.country, bk.bucket, any_value(bq.n) AS n, {", ".join(aggs)}
  FROM bk JOIN bq USING (country, bucket) GROUP BY bk.country, bk.bucket),
bstats AS (SELECT country, bucket, n, {", ".join(stats)} FROM bs),
bforce AS (
  SELECT country, bucket, {", ".join(force)} FROM bstats
  WINDOW wb AS (PARTITION BY country ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


DETECT_CTE = f"""
det0 AS (
  SELECT fr.*, bf.* EXCLUDE (country, bucket),
         (vol_last3 - b_volume_mean) / greatest(b_volume_std, 0.01) AS vz,
         (eng_last3 - b_engagement_mean) / greatest(b_engagement_std, 0.01) AS ez,
         abs(sent_last5 - sent_hist) AS shift
  FROM frames fr LEFT JOIN bforce bf
    ON bf.country = fr.country AND bf.bucket = CAST(date_trunc('day', fr.ts) AS TIMESTAMP)),
det AS (
  SELECT *, n >= {K.MIN_SAMPLES} AS ok,
         CASE WHEN n >= {K.MIN_SAMPLES} THEN least(abs(vz) / 4.0, 1.0) ELSE 0.0 END AS vol_score,
         CASE WHEN n >= {K.MIN_SAMPLES} THEN least(abs(ez) / 4.0, 1.0) ELSE 0.0 END AS eng_score,
         CASE WHEN n >= {K.MIN_SAMPLES} THEN least(least(shift / 0.8, 1.0)
              + CASE WHEN abs(sent_last5) > 0.7 THEN 0.2 ELSE 0.0 END, 1.0) ELSE 0.0 END AS sent_score
  FROM det0)"""


def fold_sql(lst_expr: str) -> str:
    d, fl = D(K.KEYWORD_DECAY), D(K.KEYWORD_FLOOR)
    return (f"list_reduce({lst_expr}, lambda a, x: {{'g': x.g, 'c': (CASE WHEN a.c * pow({d}, x.g - a.g) < {fl} "
            f"THEN 0.0 ELSE a.c * pow({d}, x.g - a.g) END) + x.c}})")


KEYWORD_CTES = f"""
mg AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY ts, post_seq) AS g FROM m2),
occ AS (
  SELECT country, g, ts, keyword, CAST(count(*) AS DOUBLE) AS m
  FROM (SELECT country, g, ts, unnest(kw) AS keyword FROM mg) GROUP BY country, g, ts, keyword),
dends AS (SELECT country, CAST(date_trunc('day', ts) AS TIMESTAMP) AS bucket, max(g) AS g_end
          FROM mg GROUP BY country, CAST(date_trunc('day', ts) AS TIMESTAMP)),
kv AS (
  SELECT d.country, d.bucket, d.g_end, o.keyword,
         {fold_sql("list({'g': o.g, 'c': o.m} ORDER BY o.g)")} AS st
  FROM dends d JOIN occ o ON o.country = d.country AND o.g <= d.g_end
  GROUP BY d.country, d.bucket, d.g_end, o.keyword),
klive AS (
  SELECT country, bucket, keyword, st.c * pow({D(K.KEYWORD_DECAY)}, g_end - st.g) AS value FROM kv
  WHERE st.c * pow({D(K.KEYWORD_DECAY)}, g_end - st.g) >= {D(K.KEYWORD_FLOOR)}),
kz AS (
  SELECT *, (value - avg(value) OVER w)
            / (CASE WHEN count(*) OVER w > 1 THEN greatest(stddev_pop(value) OVER w, 0.1) ELSE 1.0 END) AS z
  FROM klive WINDOW w AS (PARTITION BY country, bucket)),
bursts AS (
  SELECT country, bucket, count(*) AS n_live,
         coalesce(max(z) FILTER (WHERE z > {K.KEYWORD_Z}), 0.0) AS max_z,
         coalesce(bool_or(regexp_matches(keyword, {q('|'.join(K.CRISIS_TERMS))})) FILTER (WHERE z > {K.KEYWORD_Z}), false) AS crisis,
         coalesce(list(keyword ORDER BY z DESC, keyword) FILTER (WHERE z > {K.KEYWORD_Z}), []) AS rep
  FROM kz GROUP BY country, bucket),
bursts2 AS (
  SELECT *, least(CASE WHEN max_z > 0 THEN least(max_z / 5.0, 1.0) ELSE 0.0 END
                  + CASE WHEN crisis THEN 0.3 ELSE 0.0 END, 1.0) AS score FROM bursts),
kforce AS (
  SELECT d.country, d.bucket,
         coalesce(lag(coalesce(b.score, 0.0)) OVER (PARTITION BY d.country ORDER BY d.bucket), 0.0) AS kscore
  FROM dends d LEFT JOIN bursts2 b USING (country, bucket))"""

COMPOSITE_CTE = f"""
sc0 AS (
  SELECT det.*, coalesce(kf.kscore, 0.0) AS kscore,
         vol_score * {K.COMPOSITE_WEIGHTS['volume']} + sent_score * {K.COMPOSITE_WEIGHTS['sentiment']}
           + coalesce(kf.kscore, 0.0) * {K.COMPOSITE_WEIGHTS['keyword']} + eng_score * {K.COMPOSITE_WEIGHTS['engagement']} AS raw
  FROM det LEFT JOIN kforce kf
    ON kf.country = det.country AND kf.bucket = CAST(date_trunc('day', det.ts) AS TIMESTAMP)),
scored AS (
  SELECT *,
         CASE WHEN coalesce(is_anomaly, false) THEN least(raw * 1.5, 1.0) ELSE raw END AS composite,
         CASE WHEN coalesce(is_anomaly, false) THEN 'critical'
              WHEN raw >= {K.CRITICAL_CUT} THEN 'critical' WHEN raw >= {K.HIGH_CUT} THEN 'high'
              WHEN raw >= {K.MEDIUM_CUT} THEN 'medium' ELSE 'low' END AS severity,
         coalesce(is_anomaly, false) OR raw >= {K.HIGH_CUT} AS alert_required
  FROM sc0)"""


def all_scored() -> str:
    return with_posts(*metrics_ctes(), FRAMES_CTE, baseline_ctes(), DETECT_CTE, KEYWORD_CTES, COMPOSITE_CTE)


ORACLE["c01_metrics"] = with_posts(*metrics_ctes()) + f"""
SELECT tweet_id, {r6('engagement')} AS engagement, {r6('volume')} AS volume, {jn('kw')} AS keywords FROM m2"""
ORACLE["c03_frames"] = with_posts(*metrics_ctes(), FRAMES_CTE) + f"""
SELECT tweet_id, CAST(n AS BIGINT) AS n,
       {", ".join(f"{r6(f'CASE WHEN n >= {K.MIN_SAMPLES} THEN {c} END')} AS {c}" for c in ("vol_last3", "eng_last3", "sent_last5", "sent_hist"))}
FROM frames"""
_bcols = [f"{m}_{x}" for m in ("volume", "sentiment", "engagement") for x in ("mean", "std")]
ORACLE["c04_baselines"] = with_posts(*metrics_ctes(), baseline_ctes()) + f"""
SELECT s.country, s.bucket, CAST(s.n AS BIGINT) AS n, {", ".join(f"{r6('s.' + c)} AS {c}" for c in _bcols)},
       {", ".join(f"{r6('f.b_' + c)} AS b_{c}" for c in _bcols)}
FROM bstats s JOIN bforce f USING (country, bucket)"""
_det = with_posts(*metrics_ctes(), FRAMES_CTE, baseline_ctes(), DETECT_CTE)
ORACLE["c06_volume"] = _det + f"""
SELECT tweet_id, CAST(n AS BIGINT) AS n, {r6('CASE WHEN ok THEN vol_last3 END')} AS current,
       {r6('CASE WHEN ok THEN vz END')} AS z, {r6('vol_score')} AS score, ok AND vz > {K.VOLUME_SPIKE_Z} AS is_spike
FROM det"""
ORACLE["c07_sentiment"] = _det + f"""
SELECT tweet_id, CAST(n AS BIGINT) AS n, {r6('CASE WHEN ok THEN sent_last5 END')} AS current,
       {r6('CASE WHEN ok THEN sent_hist END')} AS historical, {r6('CASE WHEN ok THEN shift END')} AS shift,
       {r6('sent_score')} AS score, ok AND shift > {K.SENTIMENT_SHIFT} AS sudden
FROM det"""
ORACLE["c10_engagement"] = _det + f"""
SELECT tweet_id, CAST(n AS BIGINT) AS n, {r6('CASE WHEN ok THEN eng_last3 END')} AS current,
       {r6('CASE WHEN ok THEN ez END')} AS z, {r6('eng_score')} AS score, ok AND ez > {K.ENGAGEMENT_SPIKE_Z} AS is_spike
FROM det"""
ORACLE["c08_keyword_decay"] = with_posts(*metrics_ctes(), KEYWORD_CTES) + f"""
, kd AS (
  SELECT country, keyword, count(*) AS n_occ, {fold_sql("list({'g': g, 'c': m} ORDER BY g)")} AS st
  FROM occ GROUP BY country, keyword),
ce AS (SELECT country, max(g) AS g_end FROM mg GROUP BY country)
SELECT country, keyword, CAST(n_occ AS BIGINT) AS n_occ,
       {r6(f"CASE WHEN st.c * pow({D(K.KEYWORD_DECAY)}, g_end - st.g) >= {D(K.KEYWORD_FLOOR)} THEN st.c * pow({D(K.KEYWORD_DECAY)}, g_end - st.g) ELSE 0.0 END")} AS value
FROM kd JOIN ce USING (country)"""
ORACLE["c09_keyword_burst"] = with_posts(*metrics_ctes(), KEYWORD_CTES) + f"""
SELECT country, bucket, CAST(n_live AS BIGINT) AS n_live, {r6('max_z')} AS max_z, {r6('score')} AS score,
       array_to_string(rep[1:5], '|') AS reported
FROM bursts2"""
ORACLE["c11_composite"] = all_scored() + f"""
SELECT tweet_id, {r6('kscore')} AS keyword_score, {r6('composite')} AS composite, severity, alert_required FROM scored"""
ORACLE["c14_retention"] = all_scored() + f"""
SELECT country, tweet_id, CAST(rk AS BIGINT) AS recent_rank, {r6('composite')} AS composite FROM (
  SELECT *, row_number() OVER (PARTITION BY country ORDER BY ts DESC, post_seq DESC) AS rk
  FROM scored WHERE composite >= {K.MEDIUM_CUT}) WHERE rk <= 100"""
ORACLE["c15_summary"] = all_scored() + f"""
, sig AS (SELECT *, max(ts) OVER (PARTITION BY country) AS last_ts FROM scored WHERE composite >= {K.MEDIUM_CUT}),
rec AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY ts DESC, post_seq DESC) AS rk
        FROM sig WHERE ts > last_ts - INTERVAL 30 MINUTES),
agg AS (
  SELECT country, count(*) AS total,
         count(*) FILTER (WHERE severity = 'low') AS n_low, count(*) FILTER (WHERE severity = 'medium') AS n_medium,
         count(*) FILTER (WHERE severity = 'high') AS n_high, count(*) FILTER (WHERE severity = 'critical') AS n_critical,
         avg(composite) AS average_score, max(composite) AS max_score,
         avg(composite) FILTER (WHERE rk <= 10) AS r10, avg(composite) FILTER (WHERE rk > 10 AND rk <= 20) AS p10
  FROM rec GROUP BY country)
SELECT country, CAST(total AS BIGINT) AS total, CAST(n_low AS BIGINT) AS n_low, CAST(n_medium AS BIGINT) AS n_medium,
       CAST(n_high AS BIGINT) AS n_high, CAST(n_critical AS BIGINT) AS n_critical,
       {r6('average_score')} AS average_score, {r6('max_score')} AS max_score,
       CASE WHEN total < 20 THEN 'insufficient_data' WHEN r10 > p10 * 1.2 THEN 'increasing'
            WHEN r10 < p10 * 0.8 THEN 'decreasing' ELSE 'stable' END AS trend
FROM agg"""
_prof = "[" + ", ".join(D(v) for v in K.HOUR_PROFILE) + "]"
ORACLE["c16_expected_volume"] = with_posts() + f"""
, hh AS (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_ts, count(*) AS n FROM posts GROUP BY 1),
he AS (SELECT *, {_prof}[hour(hour_ts) + 1] * 1.0 * (CASE WHEN isodow(hour_ts) >= 6 THEN {K.WEEKEND_FACTOR} ELSE 1.0 END) AS expected FROM hh)
SELECT hour_ts, CAST(n AS BIGINT) AS n, {r6('expected')} AS expected, {r6('n / expected')} AS ratio FROM he"""
ORACLE["c17_scenario_change"] = with_posts() + """
SELECT tweet_id, previous, scenario FROM (
  SELECT tweet_id, scenario, lag(scenario) OVER (PARTITION BY country ORDER BY ts, post_seq) AS previous FROM posts)
WHERE previous IS NOT NULL AND previous <> scenario"""


# ---- alerts ------------------------------------------------------------------------

def jfmt2(x: str) -> str:
    """'%.2f' as Java prints it: HALF_UP on the shortest decimal form."""
    dec = f"round(CAST(CAST(CAST({x} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), 2)"
    return (f"(CASE WHEN {x} < 0 AND {dec} = 0 THEN '-0.00' "
            f"ELSE CAST(CAST({dec} AS DECIMAL(38,2)) AS VARCHAR) END)")


def _actions(sev: str) -> str:
    return (f"CASE WHEN {sev} = 'critical' THEN {lst(K.ACTIONS['critical'])} "
            f"WHEN {sev} = 'high' THEN {lst(K.ACTIONS['high'])} ELSE {lst(K.ACTIONS['other'])} END")


ALERTS_CTE = f"""
al0 AS (
  SELECT sc.*, sent.label AS sent_label,
         list_filter([CASE WHEN vol_score > 0.5 THEN 'volume' END, CASE WHEN sent_score > 0.5 THEN 'sentiment' END,
                      CASE WHEN kscore > 0.5 THEN 'keyword' END, CASE WHEN eng_score > 0.5 THEN 'engagement' END],
                     lambda x: x IS NOT NULL) AS factors
  FROM scored sc JOIN sent USING (tweet_id) WHERE alert_required),
alerts AS (
  SELECT concat('alert_', strftime(ts, '%Y%m%d_%H%M%S'), '_', tweet_id) AS alert_id, tweet_id, ts, severity,
         composite AS score,
         concat(upper(severity), ' anomaly detected (score: ', {jfmt2('composite')}, ') driven by ',
                CASE WHEN len(factors) > 0 THEN array_to_string(factors, ', ') ELSE 'multiple factors' END,
                '. Tweet sentiment: ', coalesce(sent_label, 'unknown'), ' (', {jfmt2('coalesce(sentiment, 0.0)')}, ')') AS description,
         {_actions('severity')} AS actions, severity = 'critical' AS immediate
  FROM al0)"""

ORACLE["d01_alerts"] = all_scored() + "," + ALERTS_CTE + f"""
SELECT alert_id, severity, {r6('score')} AS score, description, {jn('actions')} AS actions, immediate FROM alerts"""

_base = " ".join(f"WHEN {q(k)} THEN {D(v)}" for k, v in K.SEVERITY_BASE.items())
ORACLE["d04_enriched"] = all_scored() + "," + ALERTS_CTE + f"""
, en AS (
  SELECT *, hour(ts) AS h, isodow(ts) - 1 AS wd,
         hour(ts) BETWEEN 9 AND 17 AND isodow(ts) - 1 < 5 AS business
  FROM alerts),
en2 AS (
  SELECT *, (CASE severity {_base} ELSE 2.0 END) + (CASE WHEN score > 0.9 THEN 1.0 ELSE 0.0 END)
            + (CASE WHEN business THEN 0.5 ELSE 0.0 END) AS p
  FROM en)
SELECT alert_id,
       CASE WHEN p >= 4 THEN 'critical' WHEN p >= 3 THEN 'high' WHEN p >= 2 THEN 'medium' ELSE 'low' END AS final_priority,
       array_to_string(list_filter([
         CASE WHEN contains({q(K.ALERT_TYPE)}, 'sentiment') THEN 'sentiment' END,
         CASE WHEN contains({q(K.ALERT_TYPE)}, 'trade') THEN 'trade' END,
         CASE WHEN contains({q(K.ALERT_TYPE)}, 'anomaly') THEN 'anomaly' END,
         'severity:' || severity,
         CASE WHEN contains(lower(description), 'volume') THEN 'volume-spike' END,
         CASE WHEN contains(lower(description), 'sentiment') THEN 'sentiment-shift' END,
         CASE WHEN h BETWEEN 9 AND 17 THEN 'business-hours' ELSE 'after-hours' END], lambda x: x IS NOT NULL), '|') AS tags,
       CAST(h AS BIGINT) AS hour, CAST(wd AS BIGINT) AS weekday, business
FROM en2"""

ORACLE["j07_fan_in"] = all_scored() + """
SELECT kind, severity, count(*) AS n FROM (
  SELECT 'alert' AS kind, severity FROM scored WHERE alert_required
  UNION ALL SELECT 'anomaly' AS kind, severity FROM scored WHERE alert_required)
GROUP BY kind, severity"""

ORACLE["b05_time_flags"] = f"""
SELECT event_id, CAST(hour(ts) AS BIGINT) AS hour, CAST(isodow(ts) - 1 AS BIGINT) AS weekday,
       (hour(ts) BETWEEN 8 AND 12) OR (hour(ts) BETWEEN 13 AND 17) OR hour(ts) >= 22 OR hour(ts) <= 2 AS market,
       hour(ts) BETWEEN 9 AND 17 AND isodow(ts) - 1 < 5 AS business,
       {r6(f"CASE WHEN isodow(ts) - 1 >= 5 THEN {K.WEEKEND_FACTOR} ELSE 1.0 END")} AS weekend_factor
FROM events"""

ORACLE["t25_parse_time"] = """
SELECT event_id,
       CASE event_id % 6 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
                         WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'
                         WHEN 2 THEN CAST(epoch_us(ts) // 1000 AS VARCHAR)
                         WHEN 3 THEN 'not-a-time-' || CAST(event_id AS VARCHAR)
                         WHEN 4 THEN strftime(ts + INTERVAL 120 MINUTE, '%Y-%m-%dT%H:%M:%S.%f') || '+02:00'
                         ELSE strftime(ts - INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S.%f') || '-0530' END AS s,
       CASE event_id % 6 WHEN 2 THEN date_trunc('millisecond', ts) WHEN 3 THEN NULL ELSE ts END AS parsed
FROM events"""

ORACLE["a04_defaults"] = with_posts() + f"""
, g AS (
  SELECT tweet_id,
         CASE WHEN post_seq % 7 = 0 THEN NULL ELSE language END AS language,
         CASE WHEN post_seq % 7 = 1 THEN NULL ELSE text END AS text,
         CASE WHEN post_seq % 7 = 2 THEN NULL ELSE priority END AS priority,
         CASE WHEN post_seq % 7 = 3 THEN NULL ELSE scenario END AS scenario,
         CASE WHEN post_seq % 7 = 4 THEN NULL ELSE is_anomaly END AS is_anomaly,
         CASE WHEN post_seq % 7 = 5 THEN NULL ELSE likes END AS likes, retweets, replies
  FROM posts)
SELECT tweet_id, coalesce(language, 'en') AS language, coalesce(scenario, 'normal') AS scenario,
       coalesce(priority, 'normal') AS priority, coalesce(is_anomaly, false) AS is_anomaly,
       {r6(f"{D(0.3)} * coalesce(likes, 0) + {D(0.5)} * coalesce(retweets, 0) + {D(0.2)} * coalesce(replies, 0)")} AS engagement,
       coalesce(regexp_matches(text, '[^\\p{{Z}}\\x09-\\x0D\\x1C-\\x1F\\x85]'), false) AS has_text
FROM g"""


# ---- reports ----------------------------------------------------------------------------

_m = with_posts(*metrics_ctes())
ORACLE["e01_sentiment_distribution"] = with_posts(valence_cte(), trade_cte(), ensemble_cte()) + f"""
SELECT label, CAST(count(*) AS BIGINT) AS n, {r6('count(*) / sum(count(*)) OVER ()')} AS share
FROM sent GROUP BY label"""
ORACLE["e02_geographic"] = _m + f"""
SELECT country, CAST(count(*) AS BIGINT) AS n, {r6('avg(sentiment)')} AS mean_score FROM m2 GROUP BY country"""
ORACLE["e03_top_companies"] = with_posts() + f"""
SELECT organisation, CAST(count(*) AS BIGINT) AS n
FROM (SELECT unnest({tags('text', K.ORGANISATIONS)}) AS organisation FROM posts)
GROUP BY organisation ORDER BY n DESC, organisation LIMIT 10"""
ORACLE["e04_time_histogram"] = _m + f"""
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS bucket, CAST(count(*) AS BIGINT) AS n,
       {r6('avg(sentiment)')} AS mean_score FROM m2 GROUP BY 1"""
ORACLE["e05_latest"] = with_posts() + """
SELECT tweet_id, ts, country FROM posts ORDER BY ts DESC, post_seq DESC LIMIT 3"""
ORACLE["e06_anomaly_sample"] = all_scored() + f"""
SELECT tweet_id, {r6('composite')} AS composite, severity FROM scored WHERE alert_required ORDER BY composite DESC, tweet_id LIMIT 10"""
ORACLE["e07_alert_overview"] = all_scored() + "," + ALERTS_CTE + """
SELECT CAST(date_trunc('day', a.ts) AS TIMESTAMP) AS bucket, a.severity, CAST(count(*) AS BIGINT) AS n,
       CAST(count(*) FILTER (WHERE s.sent_label = 'negative') AS BIGINT) AS n_negative,
       CAST(count(*) FILTER (WHERE s.vol_score > 0.5) AS BIGINT) AS n_volume
FROM alerts a JOIN al0 s ON s.tweet_id = regexp_extract(a.alert_id, '_(post_[0-9]+)$', 1)
GROUP BY 1, 2"""
ORACLE["e08_hot_keywords"] = with_posts(keywords_cte()) + """
SELECT w AS keyword, CAST(count(*) AS BIGINT) AS n FROM krank WHERE rn <= 10
GROUP BY w ORDER BY n DESC, keyword LIMIT 20"""
_reg = ", ".join(f"({q(c.upper())}, {q(r)}, {D(a)}, {D(o)})" for c, r, a, o in K.REGIONS)
ORACLE["j01_regions"] = with_posts() + f"""
, reg(k, region_name, lat, lon) AS (VALUES {_reg})
SELECT p.country, reg.region_name, {r6('coalesce(reg.lat, 0.0)')} AS lat, {r6('coalesce(reg.lon, 0.0)')} AS lon,
       CAST(count(*) AS BIGINT) AS n
FROM posts p LEFT JOIN reg ON reg.k = upper(p.country) GROUP BY 1, 2, 3, 4"""
ORACLE["a14_month_scan"] = with_posts() + """
SELECT country, CAST(count(*) AS BIGINT) AS n FROM posts WHERE strftime(ts, '%Y-%m') = '2024-01' GROUP BY country"""

ORACLE["flagship_country_alerts"] = all_scored() + f"""
SELECT country, CAST(count(*) AS BIGINT) AS posts, {r6('avg(sentiment)')} AS mean_sentiment,
       CAST(count(*) FILTER (WHERE composite >= {K.MEDIUM_CUT}) AS BIGINT) AS anomalies,
       CAST(count(*) FILTER (WHERE alert_required) AS BIGINT) AS alerts
FROM scored GROUP BY country"""


# ---- streaming (read-back equals the batch result) -------------------------------------------

ORACLE["s01_stream_enrich"] = with_posts(valence_cte(), trade_cte(), ensemble_cte()) + f"""
SELECT p.tweet_id, p.country, s.label, {r6('s.score')} AS score
FROM posts p JOIN sent s USING (tweet_id) WHERE length(trim(coalesce(p.text, ''))) > 0"""
_eng = f"{D(0.3)} * coalesce(likes, 0) + {D(0.5)} * coalesce(retweets, 0) + {D(0.2)} * coalesce(replies, 0)"
_pf = " ".join(f"WHEN {q(k)} THEN {D(v)}" for k, v in K.PRIORITY_FACTORS.items())
ORACLE["s02_stream_buckets"] = with_posts() + f"""
, ev AS (SELECT *, {_eng} AS eng, CASE priority {_pf} ELSE {D(1.0)} END AS f FROM posts)
SELECT country, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start, CAST(count(*) AS BIGINT) AS n,
       {r6('avg(f * (1 + eng / 100))')} AS mean_volume, {r6('avg(eng)')} AS mean_engagement
FROM ev GROUP BY country, 2"""
ORACLE["s03_stream_sliding"] = with_posts(valence_cte(), trade_cte(), ensemble_cte()) + f"""
, ws AS (SELECT country, {_eng} AS engagement, s.score,
              unnest([CAST(date_trunc('hour', ts) AS TIMESTAMP) - INTERVAL 1 HOUR,
                      CAST(date_trunc('hour', ts) AS TIMESTAMP)]) AS window_start
       FROM posts JOIN sent s USING (tweet_id) WHERE length(trim(coalesce(posts.text, ''))) > 0)
SELECT country, window_start, CAST(count(*) AS BIGINT) AS n, {r6('avg(score)')} AS mean_sentiment,
       {r6('avg(engagement)')} AS mean_engagement
FROM ws GROUP BY country, window_start"""
ORACLE["s06_stream_dedupe"] = with_posts() + "\nSELECT tweet_id, country FROM posts"


# ---- U1, U2 -------------------------------------------------------------------------------------

def _class_sum(at: int) -> str:
    """Log posterior (up to the prior and a constant) of a class for the words of a text."""
    pooled = "65536 * (coalesce(sl.n0 + sl.n1 + sl.n2, 0) + 1) / (nw.t0 + nw.t1 + nw.t2 + 65536)"
    return f"sum(pw.k * ln((coalesce(sl.n{at}, 0) + {pooled}) / (nw.t{at} + 65536))) AS s{at}"


MODEL_CTE = f"""
train AS (
  SELECT d.text, CASE WHEN l.toxic = 1 THEN 2 WHEN l.quality = 1 THEN 1 ELSE 0 END AS c FROM documents d JOIN labels l USING (doc_id)),
tw AS (
  SELECT c, substr(md5(lower(w)), 1, 4) AS slot, count(*) AS n
  FROM (SELECT c, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+')) AS w FROM train) GROUP BY 1, 2),
sl AS (SELECT slot, {", ".join(f"coalesce(sum(n) FILTER (c = {i}), 0) AS n{i}" for i in range(3))} FROM tw GROUP BY slot),
nw AS (SELECT {", ".join(f"coalesce(sum(n) FILTER (c = {i}), 0) AS t{i}" for i in range(3))} FROM tw),
nd AS (SELECT {", ".join(f"ln((count(*) FILTER (c = {i}) + 1) / (count(*) + 3)) AS p{i}" for i in range(3))} FROM train),
pw AS (
  SELECT tweet_id, substr(md5(lower(w)), 1, 4) AS slot, count(*) AS k
  FROM (SELECT tweet_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+')) AS w FROM posts) GROUP BY 1, 2),
ps AS (
  SELECT tweet_id, {", ".join(_class_sum(i) for i in range(3))}
  FROM pw LEFT JOIN sl USING (slot) CROSS JOIN nw GROUP BY tweet_id),
pp AS (
  SELECT p.tweet_id, {", ".join(f"coalesce(s{i}, 0) + p{i} AS s{i}" for i in range(3))}
  FROM posts p LEFT JOIN ps USING (tweet_id) CROSS JOIN nd),
model AS (
  SELECT tweet_id, CASE WHEN s0 >= s1 AND s0 >= s2 THEN 'neutral' WHEN s1 >= s2 THEN 'positive' ELSE 'negative' END AS ml,
         1 / (exp(s0 - greatest(s0, s1, s2)) + exp(s1 - greatest(s0, s1, s2)) + exp(s2 - greatest(s0, s1, s2))) AS mc
  FROM pp),
model2 AS (SELECT *, CASE ml WHEN 'positive' THEN mc WHEN 'negative' THEN -mc ELSE 0.0 END AS ms FROM model)"""
ORACLE["u01_model_scorer"] = with_posts(MODEL_CTE) + f"\nSELECT tweet_id, ml AS label, {r6('ms')} AS score FROM model2"
_w = K.THREE_METHOD_WEIGHTS
ORACLE["u02_three_methods"] = with_posts(valence_cte(), trade_cte(), ensemble_cte(), MODEL_CTE) + f"""
, u0 AS (
  SELECT s.tweet_id, m.ml, m.ms, m.mc, s.vl, s.vs, s.vc, s.tl, s.ts, s.tc,
         ((m.ms + s.vs) + s.ts) / 3.0 AS mu
  FROM sent0 s JOIN model2 m USING (tweet_id)),
u1 AS (
  SELECT *, (m_s * {_w['model']} + vs * {_w['valence']}) + ts * {_w['trade']} AS score,
         (mc * {_w['model']} + vc * {_w['valence']}) + tc * {_w['trade']} AS wconf,
         0.6 * (CASE WHEN vl = ml AND tl = ml THEN 1.0 ELSE 0.5 END)
           + 0.4 / (1.0 + sqrt((((m_s - mu) * (m_s - mu) + (vs - mu) * (vs - mu)) + (ts - mu) * (ts - mu)) / 3.0)) AS agr
  FROM (SELECT *, ms AS m_s FROM u0))
SELECT tweet_id, {r6('score')} AS score,
       CASE WHEN score >= 0.1 THEN 'positive' WHEN score <= -0.1 THEN 'negative' ELSE 'neutral' END AS label,
       {r6('agr')} AS agreement, {r6('wconf * agr')} AS confidence
FROM u1"""

ORACLE["c13_anomaly_records"] = all_scored() + f"""
, txt AS (SELECT tweet_id, substring(text, 1, 200) AS snippet FROM posts)
SELECT strftime(s.ts, '%Y-%m-%dT%H:%M:%S.%f') || '_' || s.tweet_id AS anomaly_id, s.tweet_id, s.severity,
       {r6('s.composite')} AS composite, t.snippet,
       CAST((s.vol_score > 0.5)::INT + (s.sent_score > 0.5)::INT + (s.kscore > 0.5)::INT + (s.eng_score > 0.5)::INT AS BIGINT) AS strong_components,
       true AS message_ok
FROM scored s JOIN txt t USING (tweet_id) WHERE s.alert_required"""
ORACLE["t16_valence_join"] = ORACLE["t16_valence"]

ORACLE["a08_alert_archive"] = all_scored() + "," + ALERTS_CTE + f"""
SELECT strftime(ts, '%Y-%m') AS month, severity, CAST(count(*) AS BIGINT) AS n, {r6('max(score)')} AS max_score
FROM alerts GROUP BY 1, 2"""


# ---- D6-D12: the gate as a recursive CTE (one alert per route per step) ---------------

GATE_CTE = f"""
gsrc AS (
  SELECT a.alert_id, p.region AS route, a.ts, {q(K.ALERT_TYPE)} AS type, a.severity,
         list_distinct(list_filter(string_split_regex(lower(a.description || printf('%.4f', round(a.score, 4))), '\\s+'),
                                   lambda x: x <> '')) AS toks,
         row_number() OVER (PARTITION BY p.region ORDER BY a.ts, a.alert_id) AS rn
  FROM alerts a JOIN posts p USING (tweet_id)),
gstep AS (
  SELECT route, CAST(0 AS BIGINT) AS rn, CAST(NULL AS VARCHAR) AS alert_id,
         CAST([] AS STRUCT(k VARCHAR, t TIMESTAMP)[]) AS last, CAST(NULL AS TIMESTAMP) AS hr,
         CAST(0 AS BIGINT) AS cnt, CAST([] AS VARCHAR[][]) AS recent,
         CAST(NULL AS BOOLEAN) AS should_send, CAST(NULL AS VARCHAR) AS filters, CAST(NULL AS VARCHAR) AS reasons
  FROM (SELECT DISTINCT route FROM gsrc)
  UNION ALL
  SELECT g.route, g.rn, g.alert_id,
         CASE WHEN d.send THEN list_append(list_filter(s.last, lambda x: x.k <> d.key), {{'k': d.key, 't': g.ts}}) ELSE s.last END,
         CASE WHEN d.send THEN d.h ELSE s.hr END,
         CASE WHEN d.send THEN d.c + 1 ELSE s.cnt END,
         CASE WHEN d.send THEN list_append(s.recent, g.toks)[-{K.RECENT_SENT_CONSULTED}:] ELSE s.recent END,
         d.send,
         CASE WHEN d.ovr THEN ''
              ELSE concat_ws('|', CASE WHEN d.cool THEN 'cooldown' END, CASE WHEN d.rate THEN 'rate_limit' END,
                             CASE WHEN d.dup THEN 'duplicate' END) END,
         CASE WHEN d.ovr THEN 'Critical alert overrides cooldown'
              ELSE concat_ws('|', CASE WHEN d.cool THEN 'Cooldown active for ' || d.key END,
                             CASE WHEN d.rate THEN 'Hourly limit reached ({K.MAX_ALERTS_PER_HOUR})' END,
                             CASE WHEN d.dup THEN 'Similar alert recently sent' END) END
  FROM gstep s JOIN gsrc g ON g.route = s.route AND g.rn = s.rn + 1,
  LATERAL (
    SELECT *, (NOT cool AND NOT rate AND NOT dup) OR ovr AS send FROM (
      SELECT key, h, c,
             lst IS NOT NULL AND g.ts - lst < INTERVAL {K.COOLDOWN_MINUTES} MINUTES AS cool,
             c >= {K.MAX_ALERTS_PER_HOUR} AND g.severity <> 'critical' AS rate,
             coalesce(list_bool_or(list_transform(s.recent, lambda r:
                 CASE WHEN len(r) = 0 OR len(g.toks) = 0 THEN false
                      ELSE len(list_intersect(g.toks, r)) / len(list_distinct(list_concat(g.toks, r))) > {K.SIMILARITY_CUT} END)), false) AS dup,
             g.severity = 'critical' AND lst IS NOT NULL AND g.ts - lst < INTERVAL {K.COOLDOWN_MINUTES} MINUTES
               AND g.ts - lst > INTERVAL {K.CRITICAL_OVERRIDE_MINUTES} MINUTES AS ovr
      FROM (SELECT g.type || '_' || g.severity AS key, date_trunc('hour', g.ts) AS h,
                   (list_filter(s.last, lambda x: x.k = g.type || '_' || g.severity))[1].t AS lst,
                   CASE WHEN s.hr = date_trunc('hour', g.ts) THEN s.cnt ELSE 0 END AS c))) d
)"""
_gate_sql = all_scored() + "," + ALERTS_CTE + "," + GATE_CTE
ORACLE["d06_gate"] = "WITH RECURSIVE " + _gate_sql[len("WITH "):] + """
SELECT alert_id, route, should_send, filters, reasons FROM gstep WHERE rn > 0"""

_colours = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in K.SEVERITY_COLOURS.items())
ORACLE["d13_outbox"] = "WITH RECURSIVE " + _gate_sql[len("WITH "):] + f"""
, gate_sent AS (SELECT a.alert_id, a.ts, a.severity FROM gstep s JOIN alerts a USING (alert_id) WHERE s.rn > 0 AND s.should_send)
SELECT alert_id, channel, epoch_us(ts) // 1000 AS time_ms, epoch_us(ts) // 1000 + 300000 AS time_end_ms,
       CASE WHEN channel = 'annotation' THEN 'Alert: ' || upper(severity)
            ELSE 'Trade Sentiment Alert: ' || upper(severity) END AS title,
       CASE WHEN channel = 'email' THEN (CASE severity {_colours} ELSE {q(K.DEFAULT_COLOUR)} END) END AS colour
FROM gate_sent, (VALUES ('annotation'), ('email')) ch(channel)"""

ORACLE["a03_quarantine"] = with_posts() + """
SELECT tweet_id AS key,
       CASE WHEN post_seq % 11 < 2 OR (post_seq % 11 = 2 AND post_seq % 22 = 2) THEN 'rejected' ELSE 'good' END AS status,
       NOT (post_seq % 11 < 2 OR (post_seq % 11 = 2 AND post_seq % 22 = 2)) AS has_time
FROM posts"""
ORACLE["a05_processed_archive"] = all_scored() + "," + keywords_cte() + f"""
SELECT s.tweet_id, strftime(s.ts, '%Y-%m') AS month, t.label AS sentiment_label, {r6('s.sentiment')} AS sentiment_score,
       {r6('s.composite')} AS anomaly_score, s.severity AS anomaly_severity, s.alert_required AS is_anomaly, p.country, p.priority, true AS nested_ok,
       CAST(length(p.text) AS BIGINT) AS text_length, p.author, CAST(p.likes AS BIGINT) AS likes, {r6('t.confidence')} AS confidence, kw.keywords,
       {jn(f"regexp_extract_all(p.text, {q(HASHTAG_RE)}, 1)")} AS hashtags, {r6('s.vol_score')} AS volume_score, {r6('s.kscore')} AS keyword_score
FROM scored s JOIN sent t USING (tweet_id) JOIN posts p USING (tweet_id) JOIN kw USING (tweet_id)"""
ORACLE["a06_anomaly_archive"] = all_scored() + f"""
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '_' || tweet_id AS anomaly_id, tweet_id, severity, {r6('composite')} AS composite
FROM scored WHERE alert_required"""

# Dictionaries as tables: the row forms' SQL.
for _name in ("t10_organisations", "t11_places", "t12_keywords", "t18_trade"):
    ORACLE[_name + "_join"] = ORACLE[_name]


# ---- C5 and what runs by post number (key: region) -------------------------------------

def index_ctes() -> tuple:
    """Baselines at every 100th post from the last 500 (30 days), keyword
    counters scored there, frames as elsewhere."""
    ms = ("volume", "sentiment", "engagement")
    e, cap = K.REFRESH_EVERY, K.LONG_CAP
    quart = ", ".join(f"quantile_cont({m}, [0.25, 0.75]) AS q_{m}" for m in ms)
    aggs, force, get = [], [], []
    for m in ms:
        inside = f"{m} >= q_{m}[1] - 1.5 * (q_{m}[2] - q_{m}[1]) - 1e-9 AND {m} <= q_{m}[2] + 1.5 * (q_{m}[2] - q_{m}[1]) + 1e-9"
        aggs += [f"CASE WHEN any_value(n) >= {K.MIN_SAMPLES} THEN avg({m}) FILTER (WHERE {inside}) END AS {m}_mean",
                 f"CASE WHEN any_value(n) >= {K.MIN_SAMPLES} THEN greatest(stddev_pop({m}) FILTER (WHERE {inside}), 0.01) END AS {m}_std"]
        for x, d in zip(("mean", "std"), K.DEFAULT_BASELINES[m]):
            force.append(f"last_value({m}_{x} IGNORE NULLS) OVER wi AS b_{m}_{x}")
            get.append(f"coalesce(b_{m}_{x}, {D(d)}) AS b_{m}_{x}")
    keyed = KEYWORD_CTES.replace("country", "region").replace("m2", "mr")
    start, end = keyed.index("dends AS"), keyed.index("kv AS")
    keyed = keyed[:start] + f"dends AS (SELECT region, g // {e} AS bucket, g AS g_end FROM mg WHERE g % {e} = 0),\n" + keyed[end:keyed.index(",\nkforce AS")]
    return ("mr AS (SELECT m2.*, p.region FROM m2 JOIN posts p USING (tweet_id))", FRAMES_CTE.replace("country", "region").replace("m2", "mr"), keyed, f"""
iends AS (SELECT region, g // {e} AS block, ts AS ts_end FROM mg WHERE g % {e} = 0),
ifr AS (SELECT x.region, x.block, i.volume, i.sentiment, i.engagement FROM iends x JOIN mg i
        ON i.region = x.region AND i.g > x.block * {e} - {cap} AND i.g <= x.block * {e} AND i.ts >= x.ts_end - INTERVAL 30 DAYS),
iq AS (SELECT region, block, count(*) AS n, {quart} FROM ifr GROUP BY region, block),
istat AS (SELECT region, block, {", ".join(aggs)} FROM ifr JOIN iq USING (region, block) GROUP BY region, block),
iforce AS (SELECT region, block, {", ".join(force)} FROM istat
           WINDOW wi AS (PARTITION BY region ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ibase AS (SELECT mg.tweet_id, mg.region, mg.g, {", ".join(get)} FROM mg LEFT JOIN iforce f ON f.region = mg.region AND f.block = mg.g // {e})""")


def index_scored() -> str:
    det = DETECT_CTE[DETECT_CTE.index("det AS ("):]
    comp = COMPOSITE_CTE[COMPOSITE_CTE.index("scored AS ("):]
    w = K.COMPOSITE_WEIGHTS
    return with_posts(*metrics_ctes(), *index_ctes(), """
det0 AS (SELECT fr.*, b.* EXCLUDE (tweet_id, region), (vol_last3 - b_volume_mean) / greatest(b_volume_std, 0.01) AS vz,
                (eng_last3 - b_engagement_mean) / greatest(b_engagement_std, 0.01) AS ez, abs(sent_last5 - sent_hist) AS shift
         FROM frames fr JOIN ibase b USING (tweet_id))""", det, f"""
sc0 AS (SELECT det.*, coalesce(kb.score, 0.0) AS kscore,
               vol_score * {w['volume']} + sent_score * {w['sentiment']} + coalesce(kb.score, 0.0) * {w['keyword']} + eng_score * {w['engagement']} AS raw
        FROM det LEFT JOIN bursts2 kb ON kb.region = det.region AND kb.bucket = (det.g - 1) // {K.REFRESH_EVERY})""", comp)


ORACLE["c05_index_baselines"] = with_posts(*metrics_ctes(), *index_ctes()) + f"""
SELECT tweet_id, CAST(g AS BIGINT) AS g, {", ".join(f"{r6('b_' + c)} AS b_{c}" for c in _bcols)} FROM ibase"""
ORACLE["c05_index_scores"] = index_scored() + f"""
SELECT tweet_id, region, CAST(g AS BIGINT) AS g, CAST(n AS BIGINT) AS n, {r6('vol_score')} AS volume_score, {r6('sent_score')} AS sentiment_score,
       {r6('kscore')} AS keyword_score, {r6('eng_score')} AS engagement_score, {r6('composite')} AS composite, severity, alert_required FROM scored"""
ORACLE["s04_stream_detector"] = ORACLE["c05_index_scores"]
ORACLE["a11_runner"] = index_scored() + "," + ALERTS_CTE + "," + keywords_cte() + f"""
SELECT s.tweet_id, strftime(s.ts, '%Y-%m') AS month, t.label AS sentiment_label, {r6('s.sentiment')} AS sentiment_score, {r6('t.confidence')} AS confidence,
       {r6('s.composite')} AS anomaly_score, s.severity AS anomaly_severity, s.alert_required AS is_anomaly, CAST(length(p.text) AS BIGINT) AS text_length,
       s.region, CAST(p.likes AS BIGINT) AS likes, kw.keywords, {r6('s.vol_score')} AS volume_score,
       CAST(CASE WHEN s.alert_required THEN 1 ELSE 0 END AS BIGINT) AS n_anomalies, CASE WHEN s.alert_required THEN s.severity END AS stored_severity,
       CAST(CASE WHEN s.alert_required THEN 1 ELSE 0 END AS BIGINT) AS n_alerts, a.description
FROM scored s JOIN sent t USING (tweet_id) JOIN posts p USING (tweet_id) JOIN kw USING (tweet_id) LEFT JOIN alerts a USING (tweet_id)"""
ORACLE["s07_live_monitor"] = index_scored() + f"""
SELECT CAST(count(*) AS BIGINT) AS posts, CAST(count(*) FILTER (WHERE composite >= {K.MEDIUM_CUT}) AS BIGINT) AS anomalies,
       CAST(count(*) FILTER (WHERE alert_required) AS BIGINT) AS alerts, {r6('max(composite)')} AS score_max FROM scored"""

# ---- S3: three window sizes ---------------------------------------------------------------
_sizes = " UNION ALL ".join(f"SELECT country, '{n}' AS size, CAST(time_bucket(INTERVAL {m} MINUTES, ts, TIMESTAMP '1970-01-01') AS TIMESTAMP) AS window_start, volume, sentiment, engagement FROM m2"
                            for n, m in (("5 minutes", 5), ("30 minutes", 30), ("2 hours", 120)))
ORACLE["s03_stream_three_sizes"] = with_posts(*metrics_ctes()) + f"""
SELECT country, size, window_start, CAST(count(*) AS BIGINT) AS n,
       {", ".join(f"{r6(f'{a}({m})')} AS {x}_{m}" for m in ("volume", "sentiment", "engagement") for x, a in (("mean", "avg"), ("std", "stddev_pop")))}
FROM ({_sizes}) GROUP BY country, size, window_start"""

# ---- S5: the gate over alerts and anomaly records -------------------------------------------
_start, _end = GATE_CTE.index("gsrc AS ("), GATE_CTE.index("gstep AS (")
_tokens = "list_distinct(list_filter(string_split_regex(lower(description || printf('%.4f', round(score, 4))), '\\s+'), lambda x: x <> ''))"
_both = f"""
gall AS (
  SELECT a.alert_id, p.region AS route, a.ts, {q(K.ALERT_TYPE)} AS type, a.severity, a.description, a.score FROM alerts a JOIN posts p USING (tweet_id)
  UNION ALL
  SELECT 'anomaly_' || s.tweet_id, p.region, s.ts, 'anomaly', s.severity, upper(s.severity) || ' anomaly on ' || s.tweet_id, s.composite
  FROM scored s JOIN posts p USING (tweet_id) WHERE s.alert_required),
gsrc AS (SELECT alert_id, route, ts, type, severity, {_tokens} AS toks, row_number() OVER (PARTITION BY route ORDER BY ts, alert_id) AS rn FROM gall),
"""
_fan_sql = all_scored() + "," + ALERTS_CTE + "," + _both + GATE_CTE[_end:]
ORACLE["s05_gate_fan_in"] = "WITH RECURSIVE " + _fan_sql[len("WITH "):] + """
SELECT alert_id, route, should_send, filters, reasons FROM gstep WHERE rn > 0"""
