"""Substring near-duplicates: recall against all windows of randomly edited pairs."""
import random

import numpy as np
import pytest

from tidewatch.llm import passages, text

T = 46


def best_window(a, b):
    """The greatest Jaccard similarity of any 50 words of a and any 50 words of b."""
    ga = [{tuple(a[i + j:i + j + 5]) for j in range(T)} for i in range(len(a) - 49)]
    gb = [{tuple(b[i + j:i + j + 5]) for j in range(T)} for i in range(len(b) - 49)]
    return max((len(x & y) / len(x | y) for x in ga for y in gb), default=0.0)


def edited_pairs(n, seed):
    rng = random.Random(seed)
    for k in range(n):
        a = [f"v{k}x{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(70, 140))]
        b = list(a)
        for e in range(rng.randrange(1, 6)):
            at = rng.randrange(len(b))
            kind = rng.random()
            if kind < 0.6:
                b[at] = f"e{k}x{e}"
            elif kind < 0.8:
                b.insert(at, f"i{k}x{e}")
            else:
                del b[at]
        yield a, b


def test_a_qualifying_window_is_a_link(spark):
    pairs = list(edited_pairs(400, 11))
    rows = [(2 * i + s, " ".join(x)) for i, p in enumerate(pairs) for s, x in enumerate(p)]
    got = {r.doc_id: r.class_id for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    best = [best_window(a, b) for a, b in pairs]
    linked = [got.get(2 * i + 1) == 2 * i for i in range(len(pairs))]
    near = [x for x, s in zip(linked, best) if s >= 0.8]
    assert len(near) > 200 and np.mean(near) >= 0.98
    assert all(x for x, s in zip(linked, best) if s == 1.0)
    assert not any(x for x, s in zip(linked, best) if s < 0.75)


@pytest.mark.parametrize("seed", range(3))
def test_shared_intervals_equal_all_windows(seed):
    """The verifier alone, given whole aligned texts."""
    rng = np.random.default_rng(seed)
    missed = 0
    for a, b in edited_pairs(150, 100 + seed):
        g = [np.array([hash(tuple(x[i:i + 5])) & 0x7FFFFFFF for i in range(len(x) - 4)], dtype=np.int32) for x in (a, b)]
        s = best_window(a, b)
        found = passages.shared_intervals(g[0], g[1], T, 0.8)
        missed += s >= 0.8 and not found
        assert not (s < 0.75 and found)
        for lo, hi, vlo, vhi in found:
            assert 0 <= lo <= hi < len(g[0]) and 0 <= vlo <= vhi < len(g[1])
    assert missed <= 1


def test_edits_on_both_sides_of_a_repeat_do_not_hide_it():
    rng = random.Random(4)
    a = [f"w{rng.randrange(10 ** 6)}" for _ in range(130)]
    b = [f"e{i}" if i < 40 and i % 3 == 0 or i >= 92 and i % 4 == 0 else w for i, w in enumerate(a)]
    g = [np.array([hash(tuple(x[i:i + 5])) & 0x7FFFFFFF for i in range(len(x) - 4)], dtype=np.int32) for x in (a, b)]
    assert passages.shared_intervals(g[0], g[1], T, 0.8)


def test_shingles_of_many_texts_are_hashed_together(monkeypatch):
    calls = []
    monkeypatch.setattr(text, "gram_hashes", lambda h, k, plain=text.gram_hashes: calls.append(len(h)) or plain(h, k))
    rng = random.Random(9)
    texts = [None, "", "a b", *(" ".join(rng.choice("abcdé") * rng.randrange(1, 4) for _ in range(rng.randrange(900))) for _ in range(120)), "A b C d E"]
    got = list(passages.text_shingles(enumerate(texts), 5))
    assert len(calls) < 6 and [i for i, _ in got] == list(range(len(texts)))
    hasher = text.WordHasher()
    for (_, g), t in zip(got, texts):
        assert np.array_equal(g, text.gram_hashes(hasher(text.lower_space_words(t)), 5))
