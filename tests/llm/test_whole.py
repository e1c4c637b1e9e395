"""Whole results where a shortcut would lose some: each test failed before its fix."""
import collections
import itertools
import math
import random
import zlib

import numpy as np
import pytest

from tidewatch.llm import katz, passages, simhash

from .common import SF, classes, edge_table, space_words, texts_of


def grams(t):
    w = space_words(t)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def test_passages_of_edited_copies_are_one_class(spark):
    """One passage of 50 words and 300 copies with one word changed: most
    copies are like the original only."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(50)]
    texts = {1000: " ".join(words)}
    for i in range(300):
        w = list(words)
        w[rng.randrange(50)] = f"edit{i}"
        texts[i] = " ".join(w)
    # A common line of 25 words in texts that are not alike otherwise.
    for i in range(2000, 2060):
        texts[i] = " ".join([f"a{rng.randrange(10 ** 6)}" for _ in range(25)] + words[:25] + [f"a{rng.randrange(10 ** 6)}" for _ in range(25)])
    g = {i: grams(t) for i, t in texts.items() if i <= 1000}
    links = [(a, b) for a, b in itertools.combinations(g, 2) if len(g[a] & g[b]) >= 0.8 * len(g[a] | g[b])]
    want = classes(g, links)
    assert len(set(want.values())) == 1
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    got = {r.doc_id: r.class_id for r in passages.repeated_passages(d).collect()}
    assert not [i for i in got if i >= 2000]
    sizes = np.unique(list(got.values()), return_counts=True)[1]
    assert sizes.max() >= 0.97 * len(g)        # 1.7 % of pairs at 0.8 share no cell


@pytest.mark.parametrize("seed", range(8))
def test_settled_cells_have_the_classes_of_all_pairs(seed):
    rng = np.random.default_rng(seed)
    spans, c, lo = [], [], []
    base = rng.integers(0, 2 ** 31, (3, 70)).astype(np.int32)
    for i in range(60):
        s = base[rng.integers(0, 3)].copy()
        at = rng.integers(0, 70, rng.integers(0, 3))
        for a in at:
            s[max(0, a - 4):a + 1] = rng.integers(0, 2 ** 31, len(s[max(0, a - 4):a + 1]))
        s[30] = 7                                # the shared minimum
        cut = rng.integers(0, 8)
        spans.append(s[cut:])
        lo.append(cut + 5)
        c.append(35)
    n, t = len(spans), 46
    text, c, lo = np.arange(n), np.array(c), np.array(lo)
    got = passages.settle(text, c, lo, spans, t, 0.8)

    def linked(h, x):
        a, b = max(lo[h], lo[x]), min(lo[h] + len(spans[h]), lo[x] + len(spans[x]))
        return b - a >= t and bool(passages.shared_intervals(spans[h][a - lo[h]:b - lo[h]], spans[x][a - lo[x]:b - lo[x]], t, 0.8))
    pairs = [(h, x) for h, x in itertools.permutations(range(n), 2) if linked(h, x)]
    assert classes(range(n), [(u, v) for u, v, *_ in got]) == classes(range(n), pairs)
    assert len(got) < n


def test_katz_scores_words_not_their_class(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    junk = next(i for i in itertools.count(10 ** 6) if zlib.crc32(str(i).encode()) % 7 == 2)
    docs = docs.unionByName(spark.createDataFrame([(junk, " ".join(f"zq{i}xv" for i in range(200)))], docs.schema))
    got = {r.doc_id: r for r in katz.katz_report(docs).collect()}
    texts = texts_of(docs)
    held = {i for i, r in got.items() if r.held_out}
    c = collections.Counter(w for i, t in texts.items() if i not in held for w in space_words(t))
    n1, n2 = (sum(k == r for k in c.values()) for r in (1, 2))
    members = n1 + n1 * (n1 - 1) / (2 * (n2 + 1))
    by_class = {int(r.id): r.score for r in katz.katz_scores(docs, katz.F.crc32(katz.F.col("doc_id").cast("string")) % 7 == 2).collect()}
    for i, r in got.items():
        unknown = sum(c[w] < 2 for w in space_words(texts[i]))
        assert r.score == pytest.approx(by_class[i] - unknown * math.log10(members), abs=1e-6)
    each = [got[i].score / got[i].n_tokens for i in held - {junk} if got[i].n_tokens >= 50]
    assert got[junk].score / got[junk].n_tokens < min(each)


def test_null_ids_keep_a_row_per_class(spark):
    docs = edge_table(spark)
    row = docs.where("doc_id = 5").first().asDict()
    texts = ["one two three four", "one two three four", "quite another matter here", "and a third thing entirely", "alpha beta gamma"]
    extra = spark.createDataFrame([{**row, "doc_id": None, "text": t} for t in texts], docs.schema)
    kept = simhash.drop_near_duplicates(docs.unionByName(extra)).collect()
    assert sorted(r.text for r in kept if r.doc_id is None) == sorted(set(texts[:4]))
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [1, 4, 4, 5, 6, 7, 8]
