"""Registered queries: one per operator id of the inventory.

Each query takes (spark, sf_dir), reads the driver tables (through the
``posts`` view or directly) and returns a DataFrame whose columns match the
oracle SQL of the same name: doubles rounded to 6 places, integers as
bigint, arrays joined with '|'.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import constants as K
from tidewatch.functions import learned
from tidewatch.functions import sentiment as st
from tidewatch.functions import text as tx
from tidewatch.functions import words as wf
from tidewatch.operators import lookups as lk
from tidewatch.sources.tables import posts

REGISTRY: dict = {}


def query(name):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def r6(c) -> Column:
    """Round to 6 places through a 9-place decimal: both engines then agree
    on exact decimal ties, whatever their last-ulp float noise."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double").try_cast("decimal(38,9)"), 6).cast("double")


def big(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("bigint")


def joined(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(c, "|")


# ---- text functions ---------------------------------------------------------

@query("t01_language")
def t01_language(spark: SparkSession, sf: str) -> DataFrame:
    return posts(spark, sf).select("tweet_id", tx.detect_language("text").alias("detected"))


@query("t02_clean_text")
def t02_clean_text(spark, sf):
    return posts(spark, sf).select("tweet_id", tx.clean_text("text").alias("cleaned_text"))


@query("t03_text_counts")
def t03_text_counts(spark, sf):
    p = posts(spark, sf).withColumn("c", tx.clean_counts("text"))
    return p.select("tweet_id",
                    big(F.length("text")).alias("length"),
                    big("c.words").alias("word_count"),
                    big("c.chars").alias("char_count"),
                    big("c.sentences").alias("sentence_count"))


@query("t04_readability")
def t04_readability(spark, sf):
    p = posts(spark, sf).withColumn("c", tx.clean_counts("text"))
    return p.select("tweet_id", r6(tx.reading_ease("c.words", "c.sentences", "c.syllables")).alias("readability"))


@query("t05_urgency")
def t05_urgency(spark, sf):
    return posts(spark, sf).select("tweet_id", r6(tx.urgency_score("text")).alias("urgency"))


@query("t06_percentages")
def t06_percentages(spark, sf):
    p = posts(spark, sf).withColumn("p", tx.percentages("text"))
    return p.select("tweet_id", big(F.size("p")).alias("n_pct"),
                    r6(F.array_max("p")).alias("max_pct"),
                    r6(F.aggregate("p", F.lit(0.0), lambda a, x: a + x)).alias("sum_pct"))


@query("t07_currencies")
def t07_currencies(spark, sf):
    cur = tx.currencies("text")
    return posts(spark, sf).select("tweet_id", joined(F.transform(
        cur, lambda z: F.concat(z["amount"], F.lit(":"), z["unit"]))).alias("currencies"))


@query("t08_movements")
def t08_movements(spark, sf):
    return posts(spark, sf).select("tweet_id", joined(tx.movements("text")).alias("movements"))


@query("t09_money")
def t09_money(spark, sf):
    return posts(spark, sf).select("tweet_id", joined(tx.money_mentions("text")).alias("money"))


@query("t10_organisations")
def t10_organisations(spark, sf):
    return posts(spark, sf).select("tweet_id", joined(tx.organisations("text")).alias("organisations"))


@query("t11_places")
def t11_places(spark, sf):
    return posts(spark, sf).select("tweet_id", joined(tx.places("text")).alias("places"))


@query("t12_keywords")
def t12_keywords(spark, sf):
    return posts(spark, sf).select("tweet_id", joined(tx.post_keywords("text", "language")).alias("keywords"))


@query("t13_hashtags")
def t13_hashtags(spark, sf):
    return posts(spark, sf).select("tweet_id", joined(tx.hashtags("text")).alias("hashtags"))


@query("t14_mentions")
def t14_mentions(spark, sf):
    return posts(spark, sf).select("tweet_id", joined(tx.mentions("text")).alias("mentions"))


@query("t15_urls")
def t15_urls(spark, sf):
    return posts(spark, sf).select("tweet_id", joined(tx.urls("text")).alias("urls"))


@query("t23_topics")
def t23_topics(spark, sf):
    return posts(spark, sf).select("tweet_id", joined(tx.topic_keywords("text")).alias("topics"))


@query("t24_entities")
def t24_entities(spark, sf):
    p = posts(spark, sf).withColumn("e", tx.producer_entities("text"))
    e = F.col("e")
    return p.select("tweet_id", joined(e["companies"]).alias("companies"),
                                   joined(e["countries"]).alias("countries"))


# ---- sentiment ----------------------------------------------------------------

@query("t16_valence")
def t16_valence(spark, sf):
    p = posts(spark, sf).withColumn("v", st.valence_sentiment("text"))  # computed once
    v = F.col("v")
    return p.select(
        "tweet_id", r6(v["score"]).alias("compound"), r6(v["details"]["pos"]).alias("pos"),
        r6(v["details"]["neu"]).alias("neu"), r6(v["details"]["neg"]).alias("neg"),
        v["label"].alias("label"))


@query("t18_trade")
def t18_trade(spark, sf):
    f = F.col("f")
    p = posts(spark, sf).withColumn("f", wf.text_facts("text", {"trade": st.TRADE_NAMES}))
    p = p.withColumn("t", st.trade_sentiment("text", tx.urgency_of("text", f), tx.percentages("text"), f["moves"],
                                             hits=st.trade_hits(f["trade"])))  # computed once
    t = F.col("t")
    return p.select("tweet_id", r6(t["details"]["raw_score"]).alias("raw_score"),
                    big(t["details"]["word_count"]).alias("hits"), r6(t["score"]).alias("score"),
                    t["label"].alias("label"), r6(t["confidence"]).alias("confidence"))


@query("t21_ensemble")
def t21_ensemble(spark, sf):
    a = st.with_text_analysis(posts(spark, sf))
    s = F.col("sentiment")
    return a.select("tweet_id", r6(s["score"]).alias("score"), s["label"].alias("label"),
                    r6(s["agreement_score"]).alias("agreement"),
                    r6(s["confidence"]).alias("confidence"))



# ---- metrics, windows, detectors ------------------------------------------------

from tidewatch.operators import anomaly as an  # noqa: E402
from tidewatch.operators import keywords as kwo  # noqa: E402
from tidewatch.plans import scoring as sc  # noqa: E402


def _metrics(spark, sf):
    return sc.metric_rows(posts(spark, sf))


# Detector parameters of the query catalogue: posts of one
# country are minutes to hours apart in the driver tables, so the frame is
# 2 days (cap 100).
WINDOW_S, CAP = 2 * 86400, 100


@query("c01_metrics")
def c01_metrics(spark, sf):
    m = _metrics(spark, sf)
    return m.select("tweet_id", r6("engagement").alias("engagement"), r6("volume").alias("volume"),
                    joined("kw").alias("keywords"))


@query("c03_frames")
def c03_frames(spark, sf):
    f = an.with_frames(sc.indexed_rows(_metrics(spark, sf)), window_s=WINDOW_S, cap=CAP)
    ok = F.col("n") >= K.MIN_SAMPLES
    return f.select("tweet_id", big("n").alias("n"),
                    *[r6(F.when(ok, F.col(c))).alias(c)
                      for c in ("vol_last3", "eng_last3", "sent_last5", "sent_hist")])


@query("c04_baselines")
def c04_baselines(spark, sf):
    s = an.bucket_baselines(sc.indexed_rows(_metrics(spark, sf)))
    force = an.baselines_in_force(s)
    j = s.join(force, ["country", "bucket"])
    cols = [f"{m}_{x}" for m in an.METRICS for x in ("mean", "std")]
    return j.select("country", "bucket", big("n").alias("n"), *[r6(c).alias(c) for c in cols],
                    *[r6(f"b_{c}").alias(f"b_{c}") for c in cols])


INDEX = {"keys": ("region",), "window_s": WINDOW_S, "cap": CAP, "long_window_s": 30 * 86400}


@query("c05_index_baselines")
def c05_index_baselines(spark, sf):
    """Baselines renewed at every 100th post of a region from its last 500."""
    mg = sc.indexed_rows(_metrics(spark, sf), ("region",))
    base = an.indexed_baselines(mg, ("region",), window_s=INDEX["long_window_s"])
    j = an.attach_indexed_baselines(mg, base, ("region",))
    return j.select("tweet_id", big("g").alias("g"), *[r6(f"b_{m}_{x}").alias(f"b_{m}_{x}") for m in an.METRICS for x in ("mean", "std")])


@query("c05_index_scores")
def c05_index_scores(spark, sf):
    """C3-C12 with baselines and keyword bursts renewed by post number."""
    s, _ = sc.score_by_index(sc.indexed_rows(_metrics(spark, sf), ("region",)), **INDEX)
    return _index_scores(s)


def _index_scores(s):
    return s.select("tweet_id", "region", big("g").alias("g"), big("n").alias("n"), r6("volume_anomaly.score").alias("volume_score"),
                    r6("sentiment_anomaly.score").alias("sentiment_score"), r6("keyword_anomaly.score").alias("keyword_score"),
                    r6("engagement_anomaly.score").alias("engagement_score"), r6("composite_score").alias("composite"), "severity", "alert_required")


def _detected(spark, sf):
    return an.with_detectors(sc.indexed_rows(_metrics(spark, sf)), window_s=WINDOW_S, cap=CAP)


@query("c06_volume")
def c06_volume(spark, sf):
    d = _detected(spark, sf)
    v = F.col("volume_anomaly")
    return d.select("tweet_id", big("n").alias("n"), r6(v["current"]).alias("current"),
                    r6(v["z_score"]).alias("z"), r6(v["score"]).alias("score"),
                    v["is_spike"].alias("is_spike"))


@query("c07_sentiment")
def c07_sentiment(spark, sf):
    d = _detected(spark, sf)
    v = F.col("sentiment_anomaly")
    return d.select("tweet_id", big("n").alias("n"), r6(v["current"]).alias("current"),
                    r6(v["historical"]).alias("historical"), r6(v["shift"]).alias("shift"),
                    r6(v["score"]).alias("score"), v["is_sudden_shift"].alias("sudden"))


@query("c10_engagement")
def c10_engagement(spark, sf):
    d = _detected(spark, sf)
    v = F.col("engagement_anomaly")
    return d.select("tweet_id", big("n").alias("n"), r6(v["current"]).alias("current"),
                    r6(v["z_score"]).alias("z"), r6(v["score"]).alias("score"),
                    v["is_spike"].alias("is_spike"))


@query("c08_keyword_decay")
def c08_keyword_decay(spark, sf):
    m = _metrics(spark, sf)
    mg, vals, *_ = sc.keyword_path(m)
    last_g = mg.groupBy("country").agg(F.max("g").alias("g_end"))
    n_occ = kwo.keyword_occurrences(mg).groupBy("country", "keyword").agg(
        F.count(F.lit(1)).alias("n_occ"))
    per = vals.groupBy("country", "keyword").agg(
        F.max("g_last").alias("g_last"), F.max_by("c_last", "g_last").alias("c_last")).join(
        n_occ, ["country", "keyword"])
    v = F.col("c_last") * F.pow(F.lit(K.KEYWORD_DECAY), (F.col("g_end") - F.col("g_last")).cast("double"))
    return per.join(last_g, "country").select(
        "country", "keyword", big("n_occ").alias("n_occ"),
        r6(F.when(v >= K.KEYWORD_FLOOR, v).otherwise(0.0)).alias("value"))


@query("c09_keyword_burst")
def c09_keyword_burst(spark, sf):
    bursts = sc.keyword_path(_metrics(spark, sf))[3]
    return bursts.select("country", "bucket", big("n_live").alias("n_live"),
                         r6("max_z").alias("max_z"), r6("score").alias("score"),
                         joined("reported").alias("reported"))


def _scored(spark, sf):
    return sc.score_posts(_metrics(spark, sf), window_s=WINDOW_S, cap=CAP)


@query("c11_composite")
def c11_composite(spark, sf):
    s = _scored(spark, sf)
    return s.select("tweet_id", r6("keyword_anomaly.score").alias("keyword_score"),
                    r6("composite_score").alias("composite"), "severity", "alert_required")


@query("c14_retention")
def c14_retention(spark, sf):
    r = an.significant_recent(_scored(spark, sf))
    return r.select("country", "tweet_id", big("recent_rank").alias("recent_rank"),
                    r6("composite_score").alias("composite"))


@query("c15_summary")
def c15_summary(spark, sf):
    r = an.anomaly_summary(_scored(spark, sf).filter(F.col("composite_score") >= K.MEDIUM_CUT))
    return r.select("country", big("total").alias("total"),
                    *[big(f"n_{s}").alias(f"n_{s}") for s in ("low", "medium", "high", "critical")],
                    r6("average_score").alias("average_score"), r6("max_score").alias("max_score"),
                    "trend")


@query("c16_expected_volume")
def c16_expected_volume(spark, sf):
    e = an.expected_volume(posts(spark, sf))
    return e.select("hour_ts", big("n").alias("n"), r6("expected").alias("expected"),
                    r6("ratio").alias("ratio"))


@query("c17_scenario_change")
def c17_scenario_change(spark, sf):
    c = an.scenario_changes(posts(spark, sf))
    return c.select("tweet_id", "previous", "scenario")


# ---- alerts -------------------------------------------------------------------------

from tidewatch.operators import alerts as al  # noqa: E402
from tidewatch.sources.tables import load_table  # noqa: E402


def _alerts(spark, sf):
    return al.build_alerts(_scored(spark, sf))


@query("d01_alerts")
def d01_alerts(spark, sf):
    a = _alerts(spark, sf)
    return a.select("alert_id", "severity", r6("score").alias("score"), "description",
                    joined("recommended_actions").alias("actions"),
                    F.col("requires_immediate_attention").alias("immediate"))


@query("d04_enriched")
def d04_enriched(spark, sf):
    e = al.enrich(_alerts(spark, sf))
    return e.select("alert_id", "final_priority", joined("tags").alias("tags"),
                    big("time_context.hour").alias("hour"),
                    big("time_context.weekday").alias("weekday"),
                    F.col("time_context.is_business_hours").alias("business"))


@query("d06_gate")
def d06_gate(spark, sf):
    g = al.gate(_alerts(spark, sf))
    return g.select("alert_id", "route", "should_send", joined("filters").alias("filters"), joined("reasons").alias("reasons"))


@query("d13_outbox")
def d13_outbox(spark, sf):
    a = al.enrich(_alerts(spark, sf))
    sent = a.join(al.gate(a).filter("should_send").select("alert_id"), "alert_id", "left_semi")
    o = al.outbox(sent)
    return o.select("alert_id", "channel", "time_ms", "time_end_ms", "title", "colour")


@query("j07_fan_in")
def j07_fan_in(spark, sf):
    s = _scored(spark, sf)
    u = al.fan_in(al.build_alerts(s), al.alert_required(s))
    return u.groupBy("kind", "severity").agg(F.count(F.lit(1)).alias("n"))


@query("b05_time_flags")
def b05_time_flags(spark, sf):
    e = load_table(spark, sf, "events")
    return e.select("event_id", big(F.hour("ts")).alias("hour"), big(F.weekday("ts")).alias("weekday"),
                    al.is_market_hours("ts").alias("market"), al.is_business_hours("ts").alias("business"),
                    r6(al.weekend_factor("ts")).alias("weekend_factor"))


@query("t25_parse_time")
def t25_parse_time(spark, sf):
    from tidewatch.functions.timefn import parse_event_time, time_strings
    e = load_table(spark, sf, "events").withColumn("s", time_strings("event_id", "ts"))
    return e.select("event_id", "s", parse_event_time("s").alias("parsed"))


@query("a04_defaults")
def a04_defaults(spark, sf):
    from tidewatch.sources.envelope import with_defaults, with_gaps
    d = with_defaults(with_gaps(posts(spark, sf)))
    return d.select("tweet_id", "language", "scenario", "priority", "is_anomaly",
                    r6("engagement").alias("engagement"), F.col("has_text"))


# ---- reports ---------------------------------------------------------------------------

from tidewatch.plans import reports as rp  # noqa: E402
from tidewatch.operators.lookups import regions_table, with_region  # noqa: E402


def _sentiment_rows(spark, sf):
    """Posts with their ensemble label and score only (no metrics, nothing
    persisted): what the sentiment reports need."""
    a = st.with_text_analysis(posts(spark, sf))
    return a.select("tweet_id", "post_seq", "ts", "country",
                    F.col("sentiment.label").alias("sentiment_label"),
                    F.col("sentiment.score").alias("sentiment"))


@query("e01_sentiment_distribution")
def e01_sentiment_distribution(spark, sf):
    d = rp.sentiment_distribution(_sentiment_rows(spark, sf))
    return d.select(F.col("sentiment_label").alias("label"), big("n").alias("n"), r6("share").alias("share"))


@query("e02_geographic")
def e02_geographic(spark, sf):
    g = rp.geographic(_sentiment_rows(spark, sf))
    return g.select("country", big("n").alias("n"), r6("mean_score").alias("mean_score"))


@query("e03_top_companies")
def e03_top_companies(spark, sf):
    p = posts(spark, sf).withColumn("orgs", tx.organisations("text"))
    t = rp.top_terms(p, "orgs", 10, "organisation")
    return t.select("organisation", big("n").alias("n"))


@query("e04_time_histogram")
def e04_time_histogram(spark, sf):
    h = rp.time_histogram(_sentiment_rows(spark, sf), "1 hour")
    return h.select("bucket", big("n").alias("n"), r6("mean_score").alias("mean_score"))


@query("e05_latest")
def e05_latest(spark, sf):
    return rp.latest(posts(spark, sf), 3).select("tweet_id", "ts", "country")


@query("e06_anomaly_sample")
def e06_anomaly_sample(spark, sf):
    s = rp.anomaly_sample(_scored(spark, sf), 10)
    return s.select("tweet_id", r6("composite_score").alias("composite"), "severity")


@query("e07_alert_overview")
def e07_alert_overview(spark, sf):
    o = rp.alert_overview(_alerts(spark, sf))
    return o.select("bucket", "severity", big("n").alias("n"), big("n_negative").alias("n_negative"),
                    big("n_volume").alias("n_volume"))


@query("e08_hot_keywords")
def e08_hot_keywords(spark, sf):
    p = posts(spark, sf).withColumn("kws", tx.post_keywords("text", "language"))
    t = rp.top_terms(p, "kws", 20, "keyword")
    return t.select("keyword", big("n").alias("n"))


@query("j01_regions")
def j01_regions(spark, sf):
    p = with_region(posts(spark, sf), regions_table(spark))
    return p.groupBy("country", "region_name", "coordinates").agg(F.count(F.lit(1)).alias("n")) \
            .select("country", "region_name", r6(F.col("coordinates")[0]).alias("lat"),
                    r6(F.col("coordinates")[1]).alias("lon"), big("n").alias("n"))


@query("a14_month_scan")
def a14_month_scan(spark, sf):
    from tidewatch.session import shared_path
    from tidewatch.sources.sinks import upsert_monthly
    path = shared_path(spark, "posts_by_month", sf.rstrip("/").rsplit("/", 1)[-1])
    src = posts(spark, sf).select("tweet_id", "post_seq", "ts", "country")
    upsert_monthly(spark, src, path, "tweet_id", "ts")
    scan = rp.month_partitioned_scan(spark, path, ["2024-01"])
    return scan.groupBy("country").agg(F.count(F.lit(1)).alias("n")).select("country", big("n").alias("n"))


@query("flagship_country_alerts")
def flagship_country_alerts(spark, sf):
    """Flagship: posts -> text analysis -> detectors -> alerts, reduced to
    posts, mean sentiment, anomalies and alerts per country."""
    s = _scored(spark, sf)
    return s.groupBy("country").agg(
        big(F.count(F.lit(1))).alias("posts"), r6(F.avg("sentiment")).alias("mean_sentiment"),
        big(F.count(F.when(F.col("composite_score") >= K.MEDIUM_CUT, 1))).alias("anomalies"),
        big(F.count(F.when(F.col("alert_required"), 1))).alias("alerts"))


FLAGSHIP = "flagship_country_alerts"


# ---- streaming ---------------------------------------------------------------------------

import uuid as _uuid  # noqa: E402

from pyspark.errors import StreamingQueryException  # noqa: E402

from tidewatch.streaming import batches as mb  # noqa: E402
from tidewatch.streaming import stream as sm  # noqa: E402


FEED_SLOTS = 6


def _feed(spark, sf, copies: int = 1):
    path = sm.scratch_path(spark, "feed", _uuid.uuid4().hex[:12])
    p = posts(spark, sf)
    src = p
    for _ in range(copies - 1):
        src = src.unionByName(p)
    sm.write_feed(src, path, slots=FEED_SLOTS, files=_feed_files(spark))
    return path


def _feed_files(spark) -> int:
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _stream(spark, sf, copies: int = 1):
    """The feed as a stream of FEED_SLOTS micro-batches in event order."""
    return sm.read_posts(spark, {"format": "json", "path": _feed(spark, sf, copies), "maxFilesPerTrigger": _feed_files(spark)})


def _run(spark, df, mode="append"):
    run_id = _uuid.uuid4().hex[:12]
    out = sm.scratch_path(spark, "out", run_id)
    sm.run_available(df, out, sm.scratch_path(spark, "ckpt", run_id), mode)
    return spark.read.parquet(out)


@query("s01_stream_enrich")
def s01_stream_enrich(spark, sf):
    raw = _stream(spark, sf)
    e = sm.enrich(sm.decoded_posts(raw))
    out = _run(spark, e.select("tweet_id", "country", F.col("sentiment.label").alias("label"),
                               F.col("sentiment.score").alias("score")))
    return out.select("tweet_id", "country", "label", r6("score").alias("score"))


@query("s02_stream_buckets")
def s02_stream_buckets(spark, sf):
    raw = _stream(spark, sf)
    p = sm.decoded_posts(raw, heartbeats=True).drop("sentiment").withColumn("volume", an.volume_score("priority", "engagement"))
    agg = sm.bucket_counts(p, "1 hour")
    out = _run(spark, agg.select("country", F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                                 "n", "mean_volume", "mean_engagement"))
    return out.select("country", "window_start", big("n").alias("n"), r6("mean_volume").alias("mean_volume"),
                      r6("mean_engagement").alias("mean_engagement"))


PANE_SIZES = {"5 minutes": 5, "30 minutes": 30, "2 hours": 120}


@query("s03_stream_three_sizes")
def s03_stream_three_sizes(spark, sf):
    """S3: 5 min, 30 min and 2 h windows of volume, sentiment and engagement
    at once, merged from the stream's 1-minute panes."""
    raw = _stream(spark, sf)
    p = sm.enrich(sm.decoded_posts(raw, heartbeats=True)).withColumn("sentiment", F.col("sentiment.score"))
    p = p.withColumn("volume", an.volume_score("priority", "engagement"))
    out = sm.merge_panes(_run(spark, sm.panes(p)), PANE_SIZES)
    return out.select("country", "size", "window_start", big("n").alias("n"),
                      *[r6(f"{x}_{m}").alias(f"{x}_{m}") for m in sm.PANE_METRICS for x in ("mean", "std")])


@query("s03_stream_sliding")
def s03_stream_sliding(spark, sf):
    raw = _stream(spark, sf)
    p = sm.enrich(sm.decoded_posts(raw, heartbeats=True)).withColumn("sentiment", F.col("sentiment.score"))
    agg = sm.bucket_counts(p, "2 hours", "1 hour")
    out = _run(spark, agg.select("country", F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                                 "n", "mean_sentiment", "mean_engagement"))
    return out.select("country", "window_start", big("n").alias("n"), r6("mean_sentiment").alias("mean_sentiment"),
                      r6("mean_engagement").alias("mean_engagement"))


@query("s06_stream_dedupe")
def s06_stream_dedupe(spark, sf):
    raw = _stream(spark, sf, copies=2)
    d = sm.dedupe(sm.decoded_posts(raw))
    return _run(spark, d.select("tweet_id", "country")).select("tweet_id", "country")


@query("s04_stream_detector")
def s04_stream_detector(spark, sf):
    """The detectors over the feed's micro-batches with little carried
    state; equal to c05_index_scores."""
    path = sm.scratch_path(spark, "detector", _uuid.uuid4().hex[:12])
    det = mb.StreamDetector(mb.BatchState(path), **INDEX)
    e = sm.enrich(sm.decoded_posts(_stream(spark, sf)))
    sm.run_available(e, lambda batch, epoch: det.score(sc.metrics_of(batch), epoch), f"{path}/checkpoint")
    return _index_scores(spark.read.parquet(f"{path}/scored").drop("epoch"))


def _archive(spark):
    path = sm.scratch_path(spark, "archive", _uuid.uuid4().hex[:12])
    return mb.Archive(path, mb.StreamDetector(mb.BatchState(f"{path}/state"), **INDEX))


@query("a11_runner")
def a11_runner(spark, sf):
    """A11 + D14 + B3: one stream, one analysis per micro-batch, three
    archives.  Batch 3 dies after its first output; the restarted query runs it
    again and goes on.  One row per post with what the archives hold of it."""
    archive = _archive(spark)
    to, checkpoint = archive.outputs(), f"{archive.path}/checkpoint"
    feed = _feed(spark, sf)

    def stream():
        return sm.decoded_posts(sm.read_posts(spark, {"format": "json", "path": feed, "maxFilesPerTrigger": _feed_files(spark)}))

    def dies(batch, epoch):
        archive.write(batch, epoch, until="processed" if epoch == 3 else None)

    try:
        sm.run_available(stream(), dies, checkpoint)
        raise AssertionError("batch 3 should have died")
    except StreamingQueryException:
        pass
    sm.run_available(stream(), archive.sink(), checkpoint)
    posts_ = spark.read.parquet(to["processed"])
    anomalies = spark.read.parquet(to["anomalies"]).groupBy("tweet_id").agg(F.count(F.lit(1)).alias("n_anomalies"), F.max("anomaly.severity").alias("stored_severity"))
    alerts = spark.read.parquet(to["alerts"]).groupBy(F.col("source_tweet.id").alias("tweet_id")).agg(
        F.count(F.lit(1)).alias("n_alerts"), F.max("description").alias("description"))
    j = posts_.join(anomalies, "tweet_id", "left").join(alerts, "tweet_id", "left")
    return j.select("tweet_id", F.col("month").cast("string").alias("month"), "sentiment_label", r6("sentiment_score").alias("sentiment_score"),
                    r6("sentiment_confidence").alias("confidence"), r6("anomaly_score").alias("anomaly_score"), "anomaly_severity", "is_anomaly",
                    big(F.length("original_tweet.text")).alias("text_length"), F.col("original_tweet.region").alias("region"),
                    big("original_tweet.likes").alias("likes"), joined("nlp_analysis.features.keywords").alias("keywords"),
                    r6("anomaly_detection.volume_anomaly").alias("volume_score"),
                    big(F.coalesce("n_anomalies", F.lit(0))).alias("n_anomalies"), "stored_severity",
                    big(F.coalesce("n_alerts", F.lit(0))).alias("n_alerts"), "description")


@query("s07_live_monitor")
def s07_live_monitor(spark, sf):
    """S7 + C15: the counters of every micro-batch with running totals; the
    last row says what the run has seen."""
    archive = _archive(spark)
    sm.run_available(sm.decoded_posts(_stream(spark, sf)), archive.sink(), f"{archive.path}/checkpoint")
    live = mb.live_summary(spark.read.parquet(archive.outputs()["counters"]))
    last = live.agg(F.max("epoch").alias("epoch"), F.sum("anomalies").alias("anomalies"), F.max("score_max").alias("score_max"))
    return live.join(last.withColumnRenamed("score_max", "top").withColumnRenamed("anomalies", "all_anomalies"), "epoch").select(
        big("total_posts").alias("posts"), big("all_anomalies").alias("anomalies"), big("total_alerts").alias("alerts"), r6("top").alias("score_max"))


@query("s05_gate_fan_in")
def s05_gate_fan_in(spark, sf):
    """A10 + J7 + S5: alerts and anomaly records as two message feeds, with
    broken messages among them, released in event order to the keyed gate."""
    s = _scored(spark, sf)
    feeds = []
    for kind, rows in (("alert", al.build_alerts(s)), ("anomaly", al.alert_required(s))):
        empty = s.limit(0)
        both = al.fan_in(rows, empty) if kind == "alert" else al.fan_in(al.build_alerts(empty), rows)
        msgs = mb.to_gate_messages(both)
        broken = msgs.where(F.crc32("key") % 5 == 0).withColumn("value", F.substring("value", 1, 25))
        path = sm.scratch_path(spark, "feed", _uuid.uuid4().hex[:12])
        sm.write_slots(msgs.unionByName(broken), path, FEED_SLOTS, 2)
        feeds.append(sm.read_posts(spark, {"format": "json", "path": path, "maxFilesPerTrigger": 2}))
    path = sm.scratch_path(spark, "gate", _uuid.uuid4().hex[:12])
    g = mb.StreamGate(mb.BatchState(path))
    sm.run_available(mb.fan_in_stream(*feeds), g.write, f"{path}/checkpoint")
    return g.decisions(spark).select("alert_id", "route", "should_send", joined("filters").alias("filters"), joined("reasons").alias("reasons"))


# ---- U1, U2: pluggable model -----------------------------------------------------------------

def sentiment_labels(spark, sf):
    """(text, label): labelled documents as training rows of U1.  Toxic ones
    stand for negative, others of good quality for positive, the rest for neutral."""
    docs, labels = load_table(spark, sf, "documents").select("doc_id", "text"), load_table(spark, sf, "labels")
    label = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral")
    return docs.join(labels, "doc_id").select("text", label.alias("label"))


def learned_model(spark, sf):
    """U1's model, fitted on the labelled documents."""
    return learned.loader(learned.fit_counts(sentiment_labels(spark, sf)))


@query("u01_model_scorer")
def u01_model_scorer(spark, sf):
    p = posts(spark, sf).withColumn("m", st.model_scorer(learned_model(spark, sf))(F.col("text")))
    m = F.col("m")
    return p.select("tweet_id", m["label"].alias("label"), r6(m["score"]).alias("score"))


@query("u02_three_methods")
def u02_three_methods(spark, sf):
    a = st.with_text_analysis(posts(spark, sf))
    a = a.withColumn("model", st.model_scorer(learned_model(spark, sf))(F.col("text")))
    a = a.withColumn("e", st.ensemble({"model": F.col("model"),
                                       "valence": F.col("sentiment.methods.valence"),
                                       "trade": F.col("sentiment.methods.trade")},
                                      K.THREE_METHOD_WEIGHTS))
    e = F.col("e")
    return a.select("tweet_id", r6(e["score"]).alias("score"), e["label"].alias("label"),
                    r6(e["agreement_score"]).alias("agreement"), r6(e["confidence"]).alias("confidence"))


@query("c13_anomaly_records")
def c13_anomaly_records(spark, sf):
    """C13 + A6 + A7: nested anomaly records of alerted posts, keyed for the
    anomaly index and turned into (key, JSON value) messages."""
    from tidewatch.sources.envelope import to_messages
    from tidewatch.sources.sinks import anomaly_key
    s = an.anomaly_record(al.alert_required(_scored(spark, sf)))
    rec = anomaly_key(s.select("ts", "tweet_id", "anomaly"))
    msgs = to_messages(rec.select("anomaly_id", "tweet_id", "anomaly"), ("tweet_id",))
    j = rec.join(msgs.select(F.col("key").alias("tweet_id"), "value"), "tweet_id")
    a = F.col("anomaly")
    return j.select("anomaly_id", "tweet_id", a["severity"].alias("severity"),
                    r6(a["composite_score"]).alias("composite"),
                    a["context"]["original_tweet"].alias("snippet"),
                    big(F.size(F.filter(F.array(a["components"]["volume"]["score"],
                                                a["components"]["sentiment"]["score"],
                                                a["components"]["keyword"]["score"],
                                                a["components"]["engagement"]["score"]),
                                        lambda x: x > 0.5))).alias("strong_components"),
                    (F.get_json_object("value", "$.anomaly.tweet_id") == F.col("tweet_id")).alias("message_ok"))


@query("t16_valence_join")
def t16_valence_join(spark, sf):
    """T16 join form (lexicon as a table); must equal t16_valence."""
    lex = spark.createDataFrame(K.VALENCE_LEXICON, "term string, weight double")
    p = posts(spark, sf).withColumn("empty", F.coalesce(F.length("text"), F.lit(0)) == 0)     # the text is not used behind the join
    v = st.valence_scores_join(p, lex)
    c, empty = F.col("valence.compound"), F.col("empty")
    return v.select("tweet_id", r6(F.when(empty, 0.0).otherwise(c)).alias("compound"),
                    r6("valence.pos").alias("pos"), r6("valence.neu").alias("neu"),
                    r6("valence.neg").alias("neg"),
                    F.when(empty, "neutral").otherwise(st.label_from(c, 0.05)).alias("label"))


@query("a08_alert_archive")
def a08_alert_archive(spark, sf):
    """Alerts archived by month with alert_id as the document id; the
    upsert runs twice to show it is idempotent (last write wins per id)."""
    from tidewatch.sources.sinks import upsert_monthly
    a = _alerts(spark, sf).select("alert_id", "timestamp", "severity", "score")
    path = sm.scratch_path(spark, "alerts_by_month", sf.rstrip("/").rsplit("/", 1)[-1],
                           _uuid.uuid4().hex[:8])
    upsert_monthly(spark, a, path, "alert_id", "timestamp")
    upsert_monthly(spark, a, path, "alert_id", "timestamp")
    back = spark.read.parquet(path)
    return back.groupBy("month", "severity").agg(big(F.count(F.lit(1))).alias("n"),
                                                 r6(F.max("score")).alias("max_score"))


@query("a03_quarantine")
def a03_quarantine(spark, sf):
    """A2 + A3: every message of a feed with broken JSON, missing ids and
    unparsable times is either a good post or in the quarantine."""
    from tidewatch.sources.envelope import to_messages, to_post_records
    p = posts(spark, sf)
    # Number and time of a post are in its record, so no message is shuffled; only ids that
    # stand more than once are looked up (each message meets every row of its id).
    again = lk.small_side(p.groupBy(F.col("tweet_id").alias("_id")).agg(F.collect_list(F.struct("post_seq", "ts")).alias("_each")).where(F.size("_each") > 1))
    own = F.struct(F.regexp_extract("key", "(-?[0-9]+)$", 1).cast("long").alias("post_seq"), F.col("_at").cast("timestamp_ntz").alias("ts"))
    msgs = (to_messages(to_post_records(p), ("tweet_id",), carry=[F.col("timestamp").alias("_at")])
            .join(again, F.col("key") == F.col("_id"), "left").select("key", "value", F.inline(F.coalesce("_each", F.array(own)))))
    k = F.col("post_seq") % 11
    value = (F.when(k == 0, F.substring("value", 1, 20)).when(k == 1, F.regexp_replace("value", '"tweet_id":"[^"]*",', ""))
             .when(k == 2, F.regexp_replace("value", '"timestamp":"[^"]*"', '"timestamp":"soon"')).otherwise(F.col("value")))
    stamp = F.when(F.col("post_seq") % 22 == 2, F.lit(None).cast("timestamp")).otherwise(F.col("ts").cast("timestamp"))
    good, bad = sm.split_posts(msgs.select("key", value.alias("value"), stamp.alias("timestamp")))
    return (good.select(F.col("message_key").alias("key"), F.lit("good").alias("status"), F.col("ts").isNotNull().alias("has_time"))
            .unionByName(bad.select(F.col("message_key").alias("key"), F.lit("rejected").alias("status"), F.lit(False).alias("has_time"))))


@query("a05_processed_archive")
def a05_processed_archive(spark, sf):
    """B3 + A5: whole processed-post records upserted by month in batches that
    share rows, and read back."""
    from tidewatch.sources.envelope import processed_post
    from tidewatch.sources.sinks import forget_stored, stored, upsert_monthly
    analysed = stored(st.with_text_analysis(posts(spark, sf)))
    scored = sc.score_posts(sc.metrics_of(analysed), window_s=WINDOW_S, cap=CAP).select(
        "tweet_id", "volume_anomaly", "sentiment_anomaly", "keyword_anomaly", "engagement_anomaly", "scored")
    s = stored(processed_post(analysed.join(scored, "tweet_id")))
    forget_stored(analysed)
    path = sm.scratch_path(spark, "processed", _uuid.uuid4().hex[:12])
    first = s.where(F.crc32("tweet_id") % 3 < 2).withColumn("sentiment_score", F.lit(9.0))
    upsert_monthly(spark, first, path, "tweet_id", "timestamp")
    upsert_monthly(spark, s.where(F.crc32("tweet_id") % 3 > 0), path, "tweet_id", "timestamp")
    upsert_monthly(spark, s.where(F.crc32("tweet_id") % 3 == 0), path, "tweet_id", "timestamp")
    forget_stored(s)
    return spark.read.parquet(path).select(
        "tweet_id", F.col("month").cast("string").alias("month"), "sentiment_label", r6("sentiment_score").alias("sentiment_score"),
        r6("anomaly_score").alias("anomaly_score"), "anomaly_severity", "is_anomaly", "country", "priority",
        (F.col("original_tweet.tweet_id") == F.col("tweet_id")).alias("nested_ok"),
        big(F.length("original_tweet.text")).alias("text_length"), F.col("original_tweet.author").alias("author"),
        big("original_tweet.likes").alias("likes"), r6("nlp_analysis.sentiment.confidence").alias("confidence"),
        joined("nlp_analysis.features.keywords").alias("keywords"), joined("nlp_analysis.features.hashtags").alias("hashtags"),
        r6("anomaly_detection.volume_anomaly").alias("volume_score"), r6("anomaly_detection.keyword_anomaly").alias("keyword_score"))


@query("a06_anomaly_archive")
def a06_anomaly_archive(spark, sf):
    """C13 + A6: anomaly records upserted by month under event time + id."""
    from tidewatch.sources.sinks import anomaly_key, upsert_monthly
    rec = anomaly_key(an.anomaly_record(al.alert_required(_scored(spark, sf))).select("ts", "tweet_id", "anomaly")).checkpoint()
    path = sm.scratch_path(spark, "anomalies", _uuid.uuid4().hex[:12])
    upsert_monthly(spark, rec, path, "anomaly_id", "ts")
    upsert_monthly(spark, rec.where(F.crc32("tweet_id") % 2 == 0), path, "anomaly_id", "ts")
    return spark.read.parquet(path).select("anomaly_id", "tweet_id", F.col("anomaly.severity").alias("severity"),
                                           r6("anomaly.composite_score").alias("composite"))


# ---- dictionaries as tables: must equal the row forms ----------------------------------------

def _names(spark, names):
    return spark.createDataFrame(list(enumerate(names)), "pos int, name string")


@query("t10_organisations_join")
def t10_organisations_join(spark, sf):
    d = lk.substring_matches(posts(spark, sf), _names(spark, K.ORGANISATIONS))
    return d.select("tweet_id", joined(F.transform("matches", lambda x: x["name"])).alias("organisations"))


@query("t11_places_join")
def t11_places_join(spark, sf):
    d = lk.substring_matches(posts(spark, sf), _names(spark, K.PLACES))
    return d.select("tweet_id", joined(F.transform("matches", lambda x: x["name"])).alias("places"))


@query("t12_keywords_join")
def t12_keywords_join(spark, sf):
    stop = [("en", w) for w in K.STOP_WORDS_ENGLISH] + [("fr", w) for w in K.STOP_WORDS_FRENCH]
    p = posts(spark, sf).withColumn("cleaned", tx.clean_text("text"))
    d = lk.corpus_keywords(p, spark.createDataFrame(stop, "lang string, term string"))
    return d.select("tweet_id", joined("keywords").alias("keywords"))


@query("t18_trade_join")
def t18_trade_join(spark, sf):
    """The trade lexicon as a table."""
    lex = spark.createDataFrame([(i, t, float(w)) for i, (t, w) in enumerate(K.TRADE_LEXICON)], "pos int, name string, w double")
    p = posts(spark, sf).withColumns({"u": tx.urgency_score("text"), "p": tx.percentages("text"), "m": tx.movements("text"),
                                      "head": F.substring("text", 1, 1)})       # the whole text is not used behind the join
    d = lk.substring_matches(p, lex, lower=True)
    t = d.withColumn("t", st.trade_sentiment("head", "u", "p", "m", hits=F.col("matches")))
    return t.select("tweet_id", r6("t.details.raw_score").alias("raw_score"), big("t.details.word_count").alias("hits"),
                    r6("t.score").alias("score"), F.col("t.label").alias("label"), r6("t.confidence").alias("confidence"))
