"""llm operators without SQL against brute-force versions, and the pipeline."""
import collections
import itertools
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import chat, katz, licenses, packing, passages, pii, simhash, sql

from .common import SF, alnum_words, duck, same, simhash_classes, space_words, texts_of


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return texts_of(docs)


def test_simhash_equals_all_pairs(docs, texts):
    fp, comp = simhash_classes(texts)
    rows = simhash.near_duplicates(docs, leaf_points=20).collect()
    assert {r.doc_id: r.fp & (2 ** 64 - 1) for r in rows} == fp
    assert {r.doc_id: r.component_id for r in rows} == comp


def test_vantage_trees_find_dense_clusters():
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 2 ** 63, 40, dtype=np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, (40, 60, 2)).astype(np.uint64))
    fps = np.unique((centre[:, None] ^ np.bitwise_xor.reduce(flips, axis=2)).ravel())
    root, leaves = simhash.grow(fps, len(fps), 2, leaf_points=100)
    assert leaves > 10
    shard = collections.defaultdict(lambda: [[], []])
    for leaf, rows, home in simhash.shards(root, fps, 2):
        shard[leaf][0 if home else 1] += rows.tolist()
    forest = simhash.Forest(len(fps))
    for home, visit in shard.values():
        at = np.array(home + visit, dtype=int)
        parent = simhash.local_links(fps[at], len(home), 2)
        forest.union(at, at[parent])
    want = simhash.Forest(len(fps))
    a, b = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2)
    want.union(a, b)
    assert len(a) > 3 * len(fps) and (forest.parent == want.parent).all()


def test_license_phrases(spark, docs, texts):
    got = {r.doc_id: r for r in licenses.license_report(docs, spark).collect()}
    for i, t in texts.items():
        w, places, labels = alnum_words(t), [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            at = [s for s in range(len(w) - len(p) + 1) if w[s:s + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        r = got[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(places), ",".join(sorted(labels)))
        assert (r.first_word, r.last_word) == ((min(places), max(places)) if places else (None, None))


def test_license_template_survives_edits(spark):
    notice = licenses.TEMPLATES["mit-notice"]
    changed = notice.replace("free of charge", "wholly free of any charge").replace("subject", "")
    d = spark.createDataFrame([(1, "intro words " + changed + " tail"), (2, " ".join(notice.split()[:12]))], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.license_report(d, spark).collect()}
    assert got[1].labels == "mit-notice" and 0.8 <= got[1].score < 1 and got[2].labels == ""


def test_passages_hold_every_exact_repeat(docs, texts):
    words = {i: space_words(t) for i, t in texts.items()}
    seen = collections.defaultdict(set)
    for i, w in words.items():
        for s in range(len(w) - 49):
            seen[tuple(w[s:s + 50])].add(i)
    groups = [g for g in seen.values() if len(g) > 1]
    rows = {r.doc_id: r for r in passages.repeated_passages(docs).collect()}
    assert {i for g in groups for i in g} <= set(rows)
    assert all(len({rows[i].class_id for i in g}) == 1 for g in groups)

    def grams(w):
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    # Whatever else is reported is nearly equal to a passage of its class.
    for i in set(rows) - {i for g in groups for i in g}:
        for p in rows[i].passages:
            mine = grams(words[i][p.start:p.end])
            assert max(len(mine & grams(words[j])) for j in rows if j != i and rows[j].class_id == rows[i].class_id) >= 0.7 * len(mine)


def test_compact_windows_partition_all_subsequences():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 30, 60).astype(np.uint64) << np.uint64(30)
    a, c, b = passages.compact_windows(v, np.array([0, 35]), np.array([35, 60]), 6)
    for lo, hi in ((0, 35), (35, 60)):
        for left, right in itertools.combinations(range(lo, hi), 2):
            if right - left + 1 >= 6:
                own = (a <= left) & (left <= c) & (c <= right) & (right <= b)
                assert own.sum() == 1 and v[c[own][0]] == v[left:right + 1].min()


@pytest.mark.parametrize("block", [4_000, 10_000_000])
def test_katz_equals_direct_model(docs, texts, block):
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    words = {i: space_words(t) + ["\n"] for i, t in texts.items()}
    c = collections.Counter(x for i, w in words.items() if not held[i] for x in w)
    n, v, once = sum(c.values()), len(c), sum(k == 1 for x, k in c.items() if x != "\n")

    def known(x):
        return x if c[x] >= 2 or x == "\n" else None

    def uni(x):
        return (max(once, 1) if x is None else c[x]) / (n + (once == 0))
    pairs = collections.Counter()
    for i, w in words.items():
        k = ["\n", *map(known, w)]
        pairs.update([] if held[i] else zip(k, k[1:]))
    d = katz.discounts(np.array([sum(x == r for x in pairs.values()) for r in range(1, 7)]))
    after = collections.defaultdict(dict)
    for (a, b), k in pairs.items():
        after[a][b] = k

    def prob(a, b):
        m = after.get(a)
        if m is None:
            return uni(b)
        kept = sum(k * (1 - d[k - 1]) for k in m.values() if k <= 5)
        whole = sum(m.values()) + (kept == 0)
        if b in m:
            return (d[m[b] - 1] if m[b] <= 5 else 1) * m[b] / whole
        return (kept or 1) / whole / (1 - sum(map(uni, m))) * uni(b)
    rows = katz.katz_scores(docs.select("doc_id", "text"), F.crc32(F.col("doc_id").cast("string")) % 7 == 2, block_tokens=block).collect()
    assert len(rows) == len(texts)
    cache = {}
    for r in rows:
        w = words[int(r.id)]
        k = ["\n", *map(known, w)]
        score = sum(math.log10(cache.setdefault(p, prob(*p))) for p in zip(k, k[1:]))
        assert (r.held, r.n_tokens, r.n_known, r.train_tokens) == (held[int(r.id)], len(w), sum(c[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), abs=1e-6)
        assert r.score == pytest.approx(score, abs=1e-6)
    vocabulary = {known(x) for x in c} | {None}
    assert all(abs(sum(prob(a, b) for b in vocabulary) - 1) < 1e-9 for a in itertools.islice(after, 5))


def test_optimal_bounds_are_optimal():
    rng = np.random.default_rng(5)
    for _ in range(20):
        lengths = np.sort(rng.choice(40, 7, replace=False)) + 1
        counts = rng.integers(1, 50, 7)

        def padding(bounds):
            return sum(c * (min(b for b in bounds if b >= x) - x) for x, c in zip(lengths, counts))
        best = min(padding((*p, lengths[-1])) for p in itertools.combinations(lengths[:-1], 2))
        assert padding(packing.optimal_bounds(lengths, counts, 3)) == best


def test_chat_roles(spark):
    c = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = chat.chat_report(c).where("held_out").alias("g").join(c.alias("c"), ["conv_id", "turn"])
    right, total = got.agg(F.sum((F.col("g.role") == F.col("c.role")).cast("int")), F.count(F.lit(1))).first()
    assert right / total > 0.9


def test_chat_chunks_are_exact(spark, monkeypatch):
    c = spark.read.parquet(f"{SF}/conversations.parquet")
    model = chat.fit(c)

    def rows():
        return sorted(map(tuple, chat.decode(c, model).select("conv_id", "turn", "line", "role", "new_turn").collect()))
    whole = rows()
    monkeypatch.setattr(chat, "CHUNK", 2)
    assert rows() == whole


def test_chat_markers(spark):
    lines = spark.createDataFrame([(1, "Human: hello\nAI: I am fine\n\nHuman: bye")], "conv_id long, text string")
    c = spark.read.parquet(f"{SF}/conversations.parquet")
    out = chat.render(chat.decode(chat.transcript_lines(lines), chat.fit(c))).orderBy("turn").collect()
    assert "".join(r.rendered for r in out) == "<|user|>\nhello\n<|assistant|>\nI am fine\n<|user|>\nbye\n"


def test_speakers_change_inside_one_text(spark):
    c = spark.read.parquet(f"{SF}/conversations.parquet")
    talk = "User: hi, can you help?\nIt is about rates.\n\nAssistant: yes, of course.\nWhat do you need?\nUser: thanks"
    d = spark.createDataFrame([(1, 0, talk), (2, 0, "[Human]: one\ntwo"), (2, 1, "AI> three")], "conv_id int, turn int, text string")
    out = chat.render(chat.decode(d, chat.fit(c))).orderBy("conv_id", "pos").collect()
    assert "".join(r.rendered for r in out if r.conv_id == 1) == (
        "<|user|>\nhi, can you help?\nIt is about rates.\n<|assistant|>\nyes, of course.\nWhat do you need?\n<|user|>\nthanks\n")
    assert "".join(r.rendered for r in out if r.conv_id == 2) == "<|user|>\none\ntwo\n<|assistant|>\nthree\n"


@pytest.mark.parametrize("chunk", [2, 512])
def test_chat_equals_the_best_of_all_paths(spark, monkeypatch, chunk):
    """Every path of states of short conversations, scored one by one."""
    c = spark.read.parquet(f"{SF}/conversations.parquet")
    model = chat.fit(c)
    texts = [["User: hi?\nand more", "a\nb c d e f g\n?"], ["x", "AI: y\nHuman: z?", "w w w w w w w w w"], ["System: be brief", "ok\nno"]]
    d = spark.createDataFrame([(i, t, x) for i, ts in enumerate(texts) for t, x in enumerate(ts)], "conv_id int, turn int, text string")
    monkeypatch.setattr(chat, "CHUNK", chunk)
    got = {(r.conv_id, r.pos): r.role for r in chat.decode(d, model).collect()}
    feats = {}
    for r in chat.with_features(chat.row_lines(d)).collect():
        feats.setdefault(r.conv_id, []).append((r.turn, r.line, {f: r[f] for f in chat.FEATURES}))
    for conv, lines in feats.items():
        seen = [f for *_, f in sorted(lines, key=lambda x: x[:2])]
        best = max(itertools.product(range(chat.STATES), repeat=len(seen)), key=lambda p: (
            model.start[p[0]] + sum(model.step[a, b] for a, b in zip(p, p[1:])) + sum(model.emit[k][s, f[k]] for s, f in zip(p, seen) for k in f)))
        assert [got[(conv, i)] for i in range(len(seen))] == [chat.ROLES[s // 2] for s in best]


def test_disclosing_terms_are_replaced(spark):
    """A name beside an address of two documents goes, in the heading too; the
    letters of the address, everyday words and other people's texts stay."""
    rows = [(i, f"Zephyrine writes from boss@corp.com about thing{'abcdefghij'[i]}") for i in range(6)]
    rows += [(50, "Quimbry intro. Nothing else for a while, " + "and more about other matters " * 8 + "so Marcellus Quimbry has m.q@solo.org today"),
             (51, "Marcellus Quimbry, m.q@solo.org, about matters. Later Quimbry again"), (52, "they write to other@solo.org about other matters today")]
    rows += [(100 + i, "about other matters, they write today and have nothing else for a while, more from writes") for i in range(40)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(d).collect()}
    assert got[0] == "[REMOVED] writes from [EMAIL] about thinga" and got[100] == rows[-40][1]
    name = {r.doc_id: [x for x in r.spans.split(",") if x.startswith("term")] for r in pii.pii_report(d).collect()}
    assert name[50][0] == "term:0:7" and len(name[50]) == 3 and len(name[51]) == 3 and not name[52]
    assert "Quimbry" not in got[50] + got[51] and "Marcellus" not in got[50] + got[51]
    assert got[51].endswith("about matters. Later " + got[51].split()[0] + " again")
    same(pii.pii_report(d).toPandas(), duck(documents=d.toPandas()).execute(sql.ORACLE_SQL["op4_pii"]).df())


def redacted(text, spans):
    """Spans replaced by hand; one that overlaps an earlier one extends it.  A
    term's label (removed or generalised) is not in the spans: both read [TERM]."""
    out, end = "", 0
    for s, e, kind in sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in spans.split(",") if x)):
        if s >= end:
            out += text[end:s] + f"[{kind.upper()}]"
        end = max(end, e)
    return out + text[end:]


def test_pipeline_equals_brute_force(spark):
    """Every stage against its SQL or brute-force version, on what the stage
    before really kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").toPandas()
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.toPandas()
        docs = stage(spark, docs, SF).checkpoint()
        frames[name] = (before, docs.toPandas())
    con = duck(documents=frames["quality_rules"][0])
    kept = set(con.execute(f"SELECT doc_id FROM ({sql.OP10}) WHERE kept").df().doc_id)
    assert set(frames["quality_rules"][1].doc_id) == kept
    before, after = frames["simhash_near_dedup"]
    _, comp = simhash_classes(dict(zip(before.doc_id, before.text)))
    assert sorted(after.doc_id) == sorted(i for i, c in comp.items() if i == c)
    before, after = frames["decontamination"]
    clean = duck(documents=before, benchmark=bench).execute(f"SELECT doc_id FROM ({sql.OP9}) WHERE NOT contaminated").df()
    assert sorted(after.doc_id) == sorted(clean.doc_id)
    before, after = frames["pii"]
    spans = duck(documents=before).execute(sql.ORACLE_SQL["op4_pii"]).df()
    spans, texts = dict(zip(spans.doc_id, spans.spans)), dict(zip(before.doc_id, before.text))
    after["text_seen"] = after.text.str.replace("[REMOVED]", "[TERM]").str.replace("[WORD]", "[TERM]")
    assert dict(zip(after.doc_id, after.text_seen)) == {i: redacted(t, spans[i]) for i, t in texts.items()}
    assert (after.n_chars == after.text.str.len()).all()
    before, after = frames["packing"]
    same(after, duck(documents=before).execute(sql.OP3).df())
    assert len(corpus_pipeline.run(spark, SF).collect()) == len(after)
