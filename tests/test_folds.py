"""Sequential operators against plain-Python folds."""
from datetime import datetime, timedelta

import pandas as pd

from tidewatch import constants as K
from tidewatch.operators import alerts as al
from tidewatch.operators import keywords as kwo


def python_decay(occ):
    c, last, out = 0.0, None, []
    for g, m in occ:
        if last is not None:
            for _ in range(g - last):
                c *= K.KEYWORD_DECAY
                if c < K.KEYWORD_FLOOR:
                    c = 0.0
        c += m
        last = g
        out.append(c)
    return out


def test_keyword_decay_gap_44_45(spark):
    occ = {"w": [(1, 1.0), (45, 1.0), (91, 1.0), (92, 2.0)],   # gaps 44, 46, 1
           "v": [(1, 1.0), (46, 1.0)]}                          # gap 45
    rows = [("X", g, datetime(2024, 1, 1), k, m) for k, o in occ.items() for g, m in o]
    df = spark.createDataFrame(rows, "country string, g long, ts timestamp_ntz, keyword string, m double")
    got = {}
    for r in kwo.decayed_counts(df).orderBy("g").collect():
        got.setdefault(r["keyword"], []).append(r["value"])
    for k, o in occ.items():
        assert [round(x, 9) for x in got[k]] == [round(x, 9) for x in python_decay(o)]
    assert got["w"][1] > 1.0   # 0.95^44 = 0.105 survives
    assert got["v"][1] == 1.0  # 0.95^45 = 0.099 is dropped


def python_gate(rows):
    last, hour, count, recent, out = {}, None, 0, [], []
    for r in rows:
        key = f"{r['type']}_{r['severity']}"
        f = []
        if key in last and r["ts"] - last[key] < timedelta(minutes=15):
            f.append("cooldown")
        h = r["ts"].replace(minute=0, second=0, microsecond=0)
        c = count if hour == h else 0
        if c >= 10 and r["severity"] != "critical":
            f.append("rate_limit")
        toks = set(r["content"].lower().split())
        for p in recent[-10:]:
            if toks and p and len(toks & p) / len(toks | p) > 0.8:
                f.append("duplicate")
                break
        ok = not f
        if r["severity"] == "critical" and "cooldown" in f and r["ts"] - last[key] > timedelta(minutes=5):
            ok, f = True, ["override"]
        if ok:
            last[key], hour, count = r["ts"], h, c + 1
            recent = (recent + [toks])[-10:]
        out.append((ok, "|".join(f)))
    return out


def test_gate_matches_python_fold(spark):
    t0 = datetime(2024, 1, 1, 9, 0)
    mins = [0, 4, 6, 16, 21, 22, 23, 24, 25, 26, 27, 28, 29, 30, 31, 33, 50, 58, 61]
    sev = ["high", "high", "critical", "critical", "medium", "low", "medium", "low", "high", "medium",
           "low", "medium", "critical", "low", "medium", "high", "high", "critical", "high"]
    rows = []
    for i, (m, s) in enumerate(zip(mins, sev)):
        desc = f"{s.upper()} anomaly detected case {i % 3} alpha beta gamma"
        rows.append({"alert_id": f"a{i:02d}", "route": "R", "timestamp": t0 + timedelta(minutes=m),
                     "type": "trade_sentiment_anomaly", "severity": s, "description": desc,
                     "score": 0.5 + i / 100})
    df = spark.createDataFrame(pd.DataFrame(rows))
    rows_out = al.gate(df).orderBy("alert_id").collect()
    got = [(r["should_send"], "override" if r["reasons"] == ["Critical alert overrides cooldown"] and not r["filters"]
            else "|".join(r["filters"])) for r in rows_out]
    ref_rows = [{"ts": r["timestamp"], "type": r["type"], "severity": r["severity"],
                 "content": r["description"] + f"{round(r['score'], 4):.4f}"} for r in rows]
    assert got == python_gate(ref_rows)
    assert any(f == "override" for _, f in got) and any("cooldown" in f for _, f in got)


def test_gate_chunks_equal_one_fold(spark):
    """A hot route in chunks of 7 and 60 alerts against the sequential fold,
    with every filter firing."""
    t0 = datetime(2024, 1, 1, 22, 0)
    rows = []
    for i in range(400):
        sev = ["high", "critical", "medium", "low"][(i * 7) % 4]
        rows.append({"alert_id": f"a{i:03d}", "route": "HOT" if i % 5 else "cold", "timestamp": t0 + timedelta(minutes=(i * 3) + (i % 7)),
                     "type": f"kind{i % 2}", "severity": sev, "description": f"{sev} case {(i * 11) % 9} on desk {i % 4} alpha beta",
                     "score": 0.5 + (i % 6) / 100})
    df = spark.createDataFrame(pd.DataFrame(rows))
    want = {}
    for route in ("HOT", "cold"):
        own = sorted((r for r in rows if r["route"] == route), key=lambda r: (r["timestamp"], r["alert_id"]))
        ref = [{"ts": r["timestamp"], "type": r["type"], "severity": r["severity"],
                "content": r["description"] + f"{round(r['score'], 4):.4f}"} for r in own]
        want |= {r["alert_id"]: d for r, d in zip(own, python_gate(ref))}
    for chunk in (7, 60):
        got = {r["alert_id"]: (r["should_send"], "override" if r["reasons"] == ["Critical alert overrides cooldown"] and not r["filters"]
                               else "|".join(r["filters"])) for r in al.gate(df, chunk=chunk).collect()}
        assert got == want
    fired = {f for _, fs in want.values() for f in fs.split("|")}
    assert {"cooldown", "rate_limit", "duplicate", "override"} <= fired


def gate_stream(spark, src, path, **kw):
    """The gate over a stream of alert files, one file per micro-batch; the
    second feed is a copy of the clock only."""
    from pyspark.sql import functions as F
    from tidewatch.streaming import batches as mb
    from tidewatch.streaming import stream as sm
    names = [c.split()[0] for c in mb.GATE_RECORD.split(", ")]
    s = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1).parquet(src)
    own = s.select(*[F.col(c) if c in s.columns else F.lit(None).cast("string").alias(c) for c in names], F.lit("alerts").alias("source"),
                   F.lit(True).alias("good"), F.lit(False).alias("heartbeat"), F.lit(None).cast("string").alias("raw_value"))
    clock = own.withColumns({"good": F.lit(False), "heartbeat": F.lit(True), "source": F.lit("anomalies")})
    g = mb.StreamGate(mb.BatchState(f"{path}/state"), **kw)
    sm.run_available(own.unionByName(clock), g.write, f"{path}/checkpoint")
    return g


def decided(df):
    return {r["alert_id"]: (r["should_send"], r["filters"]) for r in df.collect()}


def test_stream_gate_equals_batch(spark, tmp_path):
    """The gate on a file stream (three micro-batches, out of order by up
    to 9 minutes, the state carried, a restart between) decides exactly as the
    batch gate."""
    import time
    t0 = datetime(2024, 1, 1, 9, 0)
    rows = [{"alert_id": f"a{i:02d}", "route": "R" if i % 3 else "S",
             "timestamp": t0 + timedelta(minutes=3 * i), "type": "trade_sentiment_anomaly",
             "severity": ["high", "critical", "medium", "critical"][i % 4],
             "description": f"anomaly {i % 2} on desk", "score": 0.6 + (i % 5) / 100}
            for i in range(30)]
    rows.append({**rows[-1], "alert_id": "end", "timestamp": t0 + timedelta(hours=5), "route": "Z"})
    pdf = pd.DataFrame(rows)
    mixed = [pdf.iloc[[*range(9), 10, 11]], pdf.iloc[[9, 12, *range(14, 20), 13]], pdf.iloc[20:]]
    src, path = str(tmp_path / "alerts"), str(tmp_path / "gate")
    for i, part in enumerate(mixed):
        spark.createDataFrame(part).coalesce(1).write.mode("append").parquet(src)
        if i != 0:
            g = gate_stream(spark, src, path)         # a restart: the second run goes on from the first
        time.sleep(1.1)
    want = decided(al.gate(spark.createDataFrame(pdf)))
    got = decided(g.decisions(spark))
    assert got == {k: v for k, v in want.items() if k != "end"} and any(not v[0] for v in got.values())


def test_idle_routes_lose_their_state(spark, tmp_path):
    """After 24 h of event time without an alert a route has no state,
    and decisions are those of the batch gate."""
    import time
    t0 = datetime(2024, 1, 1)

    def alert(i, route, hours):
        return {"alert_id": f"{route}{i}", "route": route, "timestamp": t0 + timedelta(hours=hours), "type": "t", "severity": "high",
                "description": f"case {route} number {i} of its own kind {i * 7}", "score": 0.7}
    batches = [[alert(i, r, i * 0.05) for r in "ABC" for i in range(5)], [alert(9, "A", 20)], [alert(10, "D", 60)], [alert(11, "E", 120)]]
    src, path = str(tmp_path / "a"), str(tmp_path / "g")
    for b in batches:
        spark.createDataFrame(pd.DataFrame(b)).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    g = gate_stream(spark, src, path)
    states = {e: {r.route for r in g.state.read(spark, "states", e).collect()} for e in (2, 3)}
    assert states == {2: set(), 3: set()}
    want = decided(al.gate(spark.createDataFrame(pd.DataFrame([r for b in batches for r in b]))))
    got = decided(g.decisions(spark))
    assert got == {k: v for k, v in want.items() if k != "E11"} and not all(v[0] for v in got.values())


def test_native_chunked_fold_equals_python(spark):
    """bucket_end_counts over chunks with a halo == the unchunked fold."""
    t0 = datetime(2024, 1, 1)
    occ, g = [], 1
    while g <= 9000:
        occ.append((g, 2.0 if g % 97 == 0 else 1.0))
        g += 1 + (g * 7919) % 60           # gaps 1..60: resets and long runs
    rows = [("X", gg, t0 + timedelta(minutes=gg), "w", m) for gg, m in occ]
    df = spark.createDataFrame(rows, "country string, g long, ts timestamp_ntz, keyword string, m double")
    got = {(r["bucket"], r["g_last"]): r["c_last"]
           for r in kwo.bucket_end_counts(df, chunk=3000).collect()}
    vals = python_decay(occ)
    want = {}
    for (gg, _), v in zip(occ, vals):
        day = (t0 + timedelta(minutes=gg)).replace(hour=0, minute=0)
        want[day] = (gg, v)
    assert {(d, gl): c for d, (gl, c) in want.items()}.keys() == got.keys()
    for (d, gl), c in got.items():
        assert abs(c - want[d][1]) < 1e-9
