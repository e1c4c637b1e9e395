"""Operator 2, substring near-duplicates by compact windows."""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.graph import components
from tidewatch.llm.sizes import broadcast_if_small
from tidewatch.llm.text import gram_runs, lower_space_words, mix64, space_words, word_hashes

SHINGLE = 5
MIN_WORDS = 50       # a passage has at least so many words
SIMILARITY = 0.8     # Jaccard of word shingles that a link needs
BANDS = 4            # pairs of hash functions; a pair of passages must agree on both of one band
PACK_SHINGLES = 1_000_000  # shingles whose cells are made and packed together
HASH_WORDS = 20_000        # words whose shingles are hashed together
BUCKET_WORDS = 2_000_000   # words whose cells meet in one bucket, on average
_ODD = 0x2545F4914F6CDD1D


def compact_windows(value: np.ndarray, starts: np.ndarray, ends: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, c, b) of all compact windows of at least ``t`` places in the ranges
    [starts, ends): every subsequence [l, r] with a <= l <= c <= r <= b has its
    smallest value at c.

    The windows are the nodes of the ranges' Cartesian trees, walked level by
    level over all ranges at once: the smallest value of each open range, then
    the ranges to its left and right.  Equal values are told apart by a
    scrambled place, so that runs of one shingle don't make deep trees.
    """
    n = len(value)
    bits = max(20, n.bit_length())                    # of a place; the rest of 64 ranks the value
    mask, back = np.uint64((1 << bits) - 1), np.uint64(pow(_ODD, -1, 1 << bits))
    place = (np.arange(n, dtype=np.uint64) * np.uint64(_ODD)) & mask
    ranked = (value & ~mask) | place
    out, s, e = [], starts, ends
    while len(s := s[keep := (e - s) >= t]):
        e = e[keep]
        size = e - s
        at = np.cumsum(size) - size
        open_ranges = ranked[np.repeat(s - at, size) + np.arange(size.sum())]
        low = np.minimum.reduceat(open_ranges, at)
        c = ((low & mask) * back & mask).astype(np.int64)
        out.append((s, c, e - 1))
        s, e = np.concatenate([s, c + 1]), np.concatenate([c, e])
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 3


def cells(shingles: np.ndarray, starts: np.ndarray, ends: np.ndarray, t: int, bands: int) -> Iterator[tuple]:
    """Per band: (key, l, r, c), the groups of subsequences of ``t`` places
    that share both minima: starts l..r, c the place of the first minimum.

    A compact window covers the starts max(a, c-t+1)..min(c, b-t+1); over one
    hash function these intervals tile a text.  Joining the intervals of both
    functions of a band gives the cells.
    """
    def tiled(seed):
        v = mix64(shingles ^ np.uint64(0x9E3779B97F4A7C15 * (seed + 1) & 0xFFFFFFFFFFFFFFFF))
        a, c, b = compact_windows(v, starts, ends, t)
        first = np.maximum(a, c - t + 1)
        order = np.argsort(first)
        first, c = first[order], c[order]
        size = np.minimum(c, b[order] - t + 1) - first + 1
        return np.repeat(c, size), np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())

    for band in range(bands):
        ci, at = tiled(2 * band)
        cj, _ = tiled(2 * band + 1)
        if not len(ci):
            continue
        key = mix64(mix64(shingles[ci] + np.uint64(band)) + shingles[cj])
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (at[1:] != at[:-1] + 1) | (ci[1:] != ci[:-1])])
        cut = np.nonzero(new)[0]
        last = np.concatenate([cut[1:], [len(key)]]) - 1
        yield key[cut], at[cut], at[last], ci[cut]


def _merge(rows: np.ndarray) -> np.ndarray:
    """Links (u, v, shift, lo, hi) with equal u, v, shift joined where they
    overlap or touch."""
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    same = (rows[1:, :3] == rows[:-1, :3]).all(axis=1)
    group = np.concatenate([[0], np.cumsum(~same)])
    base = group * np.int64(1 << 33)
    reach = np.maximum.accumulate(rows[:, 4] + base) - base
    new = np.concatenate([[True], ~same | (rows[1:, 3] > reach[:-1] + 1)])
    at = np.nonzero(new)[0]
    return np.column_stack([rows[at, :4], np.maximum.reduceat(rows[:, 4], at)])


_PACKED = ("bucket int, key array<bigint>, same array<int>, text array<bigint>, who array<int>, c array<int>, lo array<int>, hi array<int>, "
           "links array<bigint>")
_LINK = "u bigint, v bigint, shift bigint, lo bigint, hi bigint"
_FOUND = "open boolean, " + _LINK


def _content(shingles: np.ndarray, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """32-bit hash of the shingles lo..hi (inclusive) and the place of c among them."""
    with np.errstate(over="ignore"):
        power = np.multiply.accumulate(np.append(np.uint64(1), np.full(len(shingles), _ODD, np.uint64)))
        back = np.multiply.accumulate(np.append(np.uint64(1), np.full(len(shingles), pow(_ODD, -1, 1 << 64), np.uint64)))
        total = np.append(np.uint64(0), np.cumsum(mix64(shingles) * power[:-1], dtype=np.uint64))
        h = mix64((total[hi + 1] - total[lo]) * back[lo] + (c - lo).astype(np.uint64))
    return (h >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _with_content(key: np.ndarray, same: np.ndarray) -> np.ndarray:
    return mix64(key.view(np.uint64) ^ mix64(same.view(np.uint32).astype(np.uint64)))


def _star(key, who, c, lo, hi, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted by key: positions of the first entry of each key, and links
    (u, v, shift, lo, hi) of the others to it; u, v as ``who`` gives them.
    shift = place in u minus place in v; lo..hi are the shingles of u that
    both cells span, at least ``t`` if the two share a passage there."""
    order = np.lexsort((c, who, key))
    key, who, c, lo, hi = key[order], who[order], c[order], lo[order], hi[order]
    first = np.concatenate([[True], key[1:] != key[:-1]])
    head = np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
    other = np.nonzero(~first & (who != who[head]))[0]
    r = head[other]
    shift = c[other] - c[r]
    links = np.column_stack([who[other], who[r], shift, np.maximum(lo[other], lo[r] + shift), np.minimum(hi[other], hi[r] + shift)])
    return order[first], links[links[:, 4] - links[:, 3] + 1 >= t]


def text_shingles(texts: Iterable[tuple], shingle: int) -> Iterator[tuple]:
    """(id, shingle hashes) of (id, text) in order; those of many short texts are hashed together."""
    ids, runs, held = [], [], 0
    for i, text in texts:
        ids.append(i)
        runs.append(word_hashes(lower_space_words(text)))
        held += len(runs[-1])
        if held >= HASH_WORDS:
            yield from zip(ids, gram_runs(runs, shingle))
            ids, runs, held = [], [], 0
    yield from zip(ids, gram_runs(runs, shingle))


def _pack(buckets: int, t: int, shingle: int, bands: int):
    """Arrow task: the cells of a batch of texts, packed by bucket of their
    key.  Equal cells meet here first: one entry per key, content and batch
    goes on, so a passage that is everywhere is no hot key; the links of the
    other entries travel beside.  Entries of one key whose shingles differ all
    go on: one need not stand for another."""
    kinds = [pa.int32(), *[pa.list_(x) for x in (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64())]]
    names = ["bucket", "key", "same", "text", "who", "c", "lo", "hi", "links"]

    def packed(parts: list[np.ndarray], ids: list[int]) -> Iterator[pa.RecordBatch]:
        ends = np.cumsum([len(g) for g in parts])
        starts = ends - [len(g) for g in parts]
        rows, flat = [], np.concatenate(parts)
        for key, l, r, c in cells(flat, starts, ends, t, bands):
            who = np.searchsorted(ends, l, side="right")
            rows.append((key, _content(flat, c, l, r + t - 1), who, c - starts[who], l - starts[who], r + t - 1 - starts[who]))
        key, same, who, c, lo, hi = (np.concatenate(x) for x in zip(*rows))
        first, links = _star(_with_content(key, same), who, c, lo, hi, t)
        text = np.array(ids, dtype=np.int64)
        key, same, who, c, lo, hi = key[first], same[first], who[first], c[first], lo[first], hi[first]
        links = _merge(links) if len(links) else np.empty((0, 5), np.int64)
        links[:, :2] = text[links[:, :2]]
        bucket = (key % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((who, bucket))
        cuts, home = np.searchsorted(bucket[order], np.arange(buckets + 1)), int(text[0]) % buckets
        for k in range(buckets):
            at = order[cuts[k]:cuts[k + 1]]
            own = links if k == home else links[:0]
            if len(at) or len(own):
                used, w = np.unique(who[at], return_inverse=True)
                row = (k, key[at].view(np.int64), same[at], text[used], w, c[at], lo[at], hi[at], own.ravel())
                yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(row, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, parts, ids, held = set(), [], [], 0
        rows = (x for b in batches for x in zip(b.column("text_id").to_pylist(), b.column("text").to_pylist()))
        for i, g in text_shingles((x for x in rows if x[0] not in seen), shingle):
            if len(g) < t or i in seen:
                continue
            seen.add(i)
            parts.append(g)
            ids.append(i)
            held += len(g)
            if held >= PACK_SHINGLES:
                yield from packed(parts, ids)
                seen, parts, ids, held = set(), [], [], 0
        if parts:
            yield from packed(parts, ids)
    return run


def _meet(part: pd.DataFrame, t: int) -> pd.DataFrame:
    """All entries of one bucket.  Entries of equal content are linked to the
    first of them, and so are the two of a key with two contents.  Where a key
    has more, the first of each content stays open (u the text, v the key,
    shift the place c): ``_settle`` compares them."""
    key = np.concatenate(part["key"].to_numpy()).astype(np.int64)
    links = still = np.empty((0, 5), np.int64)
    if len(key):
        same = np.concatenate(part["same"].to_numpy()).astype(np.int32)
        who = np.concatenate([np.asarray(t)[np.asarray(w)] for t, w in zip(part["text"], part["who"])]).astype(np.int64)
        c, lo, hi = (np.concatenate(part[x].to_numpy()).astype(np.int32) for x in ("c", "lo", "hi"))
        first, links = _star(_with_content(key, same), who, c, lo, hi, t)
        key, who, c, lo, hi = key[first], who[first], c[first], lo[first], hi[first]
        _, inv, n = np.unique(key, return_inverse=True, return_counts=True)
        n = n[inv]
        two, more = n == 2, n > 2
        links = np.concatenate([links, _star(key[two], who[two], c[two], lo[two], hi[two], t)[1]]) if two.any() else links
        still = np.column_stack([who, key, c, lo, hi])[more]
    links = np.concatenate([links, *[np.asarray(x, dtype=np.int64).reshape(-1, 5) for x in part["links"] if len(x)]])
    links = _merge(links) if len(links) else links
    out = pd.DataFrame(np.concatenate([links, still]), columns=["u", "v", "shift", "lo", "hi"])
    out.insert(0, "open", np.arange(len(out)) >= len(links))
    return out


def bucket_count(members: DataFrame, width: int) -> int:
    """Buckets of cells: ``width``, and more where the texts of ``members``
    (n_words) hold more than BUCKET_WORDS words for each.  A bucket is one
    group in Python's memory, so its size must not grow with the table."""
    words = members.agg(F.sum("n_words")).first()[0] or 0
    return max(width, -(-words // BUCKET_WORDS))


def candidate_links(texts: DataFrame, buckets: int, t: int, shingle: int, bands: int) -> DataFrame:
    """(open, u, v, shift, lo, hi).  Not open: shingles lo..hi of text u lie at
    lo-shift..hi-shift of text v and share a cell.  Open: shingles lo..hi of
    text u are in the cell of key v, whose first minimum is at ``shift``.
    ``texts`` has text_id and text."""
    packed = texts.mapInArrow(_pack(buckets, t, shingle, bands), _PACKED)
    return packed.groupBy("bucket").applyInPandas(lambda part: _meet(part, t), _FOUND)


def settle(text: np.ndarray, c: np.ndarray, lo: np.ndarray, spans: list[np.ndarray], t: int, similarity: float,
           known: np.ndarray | None = None) -> list[tuple]:
    """Links (u, v, shift, lo, hi) that join all members of one cell which
    verified pairs connect; ``known`` numbers the classes they are in already.

    Every member in turn is held against all members not yet joined to it,
    those that were joined last first, until one class is left.  Who cannot
    be like the member is left out exactly: ``t`` places of it have at most
    t - enough that are not found in the other, so of the t - enough + 1 rarest
    in each stretch of ``t`` one is found.  Their holders are looked up, and
    the places found in each are counted.
    """
    n = len(spans)
    enough = int(np.ceil(2 * similarity / (1 + similarity) * t - 1e-9))
    size = np.array([len(x) for x in spans])
    ends = np.cumsum(size)
    _, code = np.unique(np.concatenate(spans), return_inverse=True)
    pair = np.unique(code.astype(np.int64) * n + np.repeat(np.arange(n), size))
    holder, cut = pair % n, np.searchsorted(pair // n, np.arange(code.max() + 2))
    held = np.diff(cut)
    root = np.arange(n) if known is None else np.unique(known, return_inverse=True)[1]
    classes, out = len(np.unique(root)), []
    heads, headed, following = [], np.zeros(n, dtype=bool), iter(range(n))
    while classes > 1:
        h = heads.pop() if heads else next(following, None)
        if h is None:
            break
        if headed[h]:
            continue
        headed[h] = True
        own = code[ends[h] - size[h]:ends[h]]
        if size[h] < t:
            continue
        around = np.lib.stride_tricks.sliding_window_view(held[own], t)
        rare = np.partition(around, t - enough, axis=1)[:, t - enough]
        probe = np.zeros(size[h], dtype=bool)
        for at, limit in enumerate(rare):
            probe[at:at + t] |= held[own[at:at + t]] <= limit
        met = np.unique(np.concatenate([holder[cut[k]:cut[k + 1]] for k in np.unique(own[probe])]))
        met = met[(root[met] != root[h]) & (text[met] != text[h])]
        if not len(met):
            continue
        place = np.full(n, -1)
        place[met] = np.arange(len(met))
        total = np.zeros((len(met), size[h] + 1), dtype=np.int16)
        for i, k in enumerate(own):
            at = place[holder[cut[k]:cut[k + 1]]]
            total[at[at >= 0], i + 1] = 1
        total = total.cumsum(axis=1, dtype=np.int16)
        for x in met[(total[:, t:] - total[:, :-t]).max(axis=1) >= enough]:
            shift = int(c[h] - c[x])
            a, b = max(lo[h], lo[x] + shift), min(lo[h] + size[h], lo[x] + size[x] + shift)
            if root[x] != root[h] and b - a >= t and shared_intervals(
                    spans[h][a - lo[h]:b - lo[h]], spans[x][a - shift - lo[x]:b - shift - lo[x]], t, similarity):
                out.append((int(text[h]), int(text[x]), shift, int(a), int(b) - 1))
                root[root == root[x]] = root[h]
                classes -= 1
                heads.append(x)
    return out


def _settle(t: int, similarity: float):
    """Arrow task: links of open cells, whose rows come sorted by cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows):
            cell, text, c, lo, root = (np.concatenate([r[i] for r in rows]) for i in (0, 1, 2, 3, 5))
            spans, links = [x for r in rows for x in r[4]], []
            cuts = np.concatenate([[0], np.nonzero(np.diff(cell))[0] + 1, [len(cell)]])
            for a, b in zip(cuts[:-1], cuts[1:]):
                links += settle(text[a:b], c[a:b], lo[a:b], spans[a:b], t, similarity, root[a:b])
            return pa.RecordBatch.from_arrays([pa.array([x[j] for x in links], pa.int64()) for j in range(5)], names=["u", "v", "shift", "lo", "hi"])

        held = []
        for b in batches:
            if not b.num_rows:
                continue
            cell = b.column("cell").to_numpy()
            flat, off = b.column("span").flatten().to_numpy(), b.column("span").offsets.to_numpy()
            off = off - off[0]
            row = [cell, *(b.column(x).to_numpy() for x in ("text", "c", "lo")), [flat[i:j] for i, j in zip(off[:-1], off[1:])], b.column("root").to_numpy()]
            last = int(np.searchsorted(cell, cell[-1]))
            # All cells but the last of the batch are whole.
            if last or (held and held[-1][0][-1] != cell[0]):
                yield done([*held, [x[:last] for x in row]])
                held = []
            held.append([x[last:] for x in row])
        if held:
            yield done(held)
    return run


def _shingle_runs(shingle: int):
    """Arrow task: the shingles of every text in order, 32 bits each (they are
    compared within two passages only)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            runs = [g.astype(np.uint32).view(np.int32) for _, g in text_shingles(((None, t) for t in b.column("text").to_pylist()), shingle)]
            ends = np.cumsum([0, *map(len, runs)])
            yield pa.RecordBatch.from_arrays([b.column("text_id"), pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(np.concatenate(runs) if runs else np.empty(0, np.int32)))], names=["text_id", "run"])
    return run


def _nearest(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Where each shingle of u stands in v, the occurrence nearest to its own
    place; -1 where v has none."""
    _, code = np.unique(np.concatenate([u, v]), return_inverse=True)
    n = len(u) + len(v)
    there = np.sort(code[len(u):] * np.int64(n) + np.arange(len(v)))
    want = code[:len(u)] * np.int64(n) + np.arange(len(u))
    at = np.searchsorted(there, want)
    after, before = there[np.minimum(at, len(v) - 1)], there[np.maximum(at - 1, 0)]
    ok_a, ok_b = (after // n == want // n) & (at < len(v)), (before // n == want // n) & (at > 0)
    use_b = ok_b & (~ok_a | (want - before < after - want))
    return np.where(use_b, before % n, np.where(ok_a, after % n, -1))


def _alike(place: np.ndarray, starts: np.ndarray, t: int, similarity: float) -> np.ndarray:
    """Which windows of ``t`` places of u, by their start, are near-duplicates
    of a stretch of v: the matched places lie in a stretch (from the first to
    the last, or ``t`` places along the window's middle, first or last
    diagonal) whose Jaccard similarity with the window is enough."""
    out = np.zeros(len(starts), dtype=bool)
    for i in range(0, len(starts), 4_096):
        s = starts[i:i + 4_096]
        p = place[s[:, None] + np.arange(t)]
        hit = p >= 0
        drift = np.where(hit, p - (s[:, None] + np.arange(t)), np.iinfo(np.int32).max)
        k = hit.sum(axis=1)
        ordered = np.sort(drift, axis=1)
        best = np.zeros(len(s))
        for at in (0, k // 2, k - 1):
            d = (s + ordered[np.arange(len(s)), at])[:, None]
            m = (hit & (p >= d) & (p < d + t)).sum(axis=1)
            best = np.maximum(best, m / (2 * t - m))
        reach = np.where(hit, p, -1).max(axis=1) - np.where(hit, p, np.iinfo(np.int32).max).min(axis=1) + 1
        out[i:i + 4_096] = np.maximum(best, k / np.maximum(t + reach - k, t)) >= similarity - 1e-9
    return out


def shared_intervals(u: np.ndarray, v: np.ndarray, t: int, similarity: float) -> list[tuple[int, int, int, int]]:
    """Intervals (lo, hi, vlo, vhi) of two aligned runs of shingles that are
    near-duplicates.

    Every ``t`` places of u that are near-duplicates of a stretch of v are a
    shared passage by themselves; overlapping ones are joined for the report,
    with no further test, and trimmed to found shingles.  A window with k found
    of t has similarity k / (2t - k) at most, which gives the count that is
    enough to look closer.
    """
    found = np.isin(u, v)
    if len(u) < t:
        return []
    total = np.concatenate([[0], np.cumsum(found)])
    enough = int(np.ceil(2 * similarity / (1 + similarity) * t - 1e-9))
    good = np.nonzero(total[t:] - total[:-t] >= enough)[0]
    if not len(good):
        return []
    place, out = _nearest(u, v), []
    good = good[_alike(place, good, t, similarity)]
    if not len(good):
        return []
    for part in np.split(good, np.nonzero(np.diff(good) > t)[0] + 1):
        inside = np.nonzero(found[part[0]:part[-1] + t])[0] + part[0]
        lo, hi = int(inside[0]), int(inside[-1])
        near = place[inside]
        near = near[np.abs(near - inside - np.median(near - inside)) <= t]
        out.append((lo, hi, int(near.min()), int(near.max())))
    return out


def _verify(t: int, similarity: float):
    """Arrow task: the verified intervals of every candidate link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = {n: b.column(n).to_numpy() for n in ("u", "v", "shift", "lo")}
            su, sv, rows = b.column("su"), b.column("sv"), []
            for i in range(b.num_rows):
                at, vat = cols["lo"][i], cols["lo"][i] - cols["shift"][i]
                rows += [(cols["u"][i], cols["v"][i], at + x[0], at + x[1], vat + x[2], vat + x[3]) for x in shared_intervals(
                    su[i].values.to_numpy(), sv[i].values.to_numpy(), t, similarity)]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(6)], names=["u", "v", "lo", "hi", "vlo", "vhi"])
    return run


def verified_links(keyed: DataFrame, one: DataFrame, found: DataFrame, t: int, shingle: int, similarity: float) -> DataFrame:
    """(u, v, lo, hi, vlo, vhi): verified passages of the candidate links and
    of the open cells.

    ``keyed`` has doc_id, text_id and text, ``one`` names a document of each
    text.  Only linked texts are kept (a semi join, broadcast if the ids fit);
    their shingles, not the texts, meet in the joins, cut to the passages.
    """
    linked = (found.select(F.explode(F.when(F.col("open"), F.array("u")).otherwise(F.array("u", "v"))).alias("text_id")).distinct().join(one, "text_id")
              .select(F.col("text_id").alias("_t"), "one").checkpoint())
    texts = keyed.join(broadcast_if_small(linked, 48), (F.col("text_id") == F.col("_t")) & F.col("doc_id").eqNullSafe(F.col("one")), "left_semi")
    runs = texts.select("text_id", "text").mapInArrow(_shingle_runs(shingle), "text_id bigint, run array<int>").checkpoint()

    def cut(side, start):
        return F.slice("run", (start + 1).cast("int"), (F.col("hi") - F.col("lo") + 1).cast("int")).alias(side)

    def verified(links):
        both = (links.join(runs.withColumnRenamed("text_id", "u"), "u").select("u", "v", "shift", "lo", "hi", cut("su", F.col("lo")))
                .join(runs.withColumnRenamed("text_id", "v"), "v").select("u", "v", "shift", "lo", "su", cut("sv", F.col("lo") - F.col("shift"))))
        return both.mapInArrow(_verify(t, similarity), "u bigint, v bigint, lo bigint, hi bigint, vlo bigint, vhi bigint").checkpoint()

    # What one alignment has in several cells is one candidate region.
    region = [F.min("lo").alias("lo"), F.max("hi").alias("hi")]
    entries = found.where("open").select(F.col("v").alias("cell"), F.col("u").alias("text"), F.col("shift").alias("c"), "lo", "hi")
    heads = entries.groupBy("cell").agg(F.min(F.struct("text", "c", "lo", "hi")).alias("h"))
    to_head = (entries.join(heads, "cell").where(F.col("text") != F.col("h.text"))
               .select(F.col("text").alias("u"), F.col("h.text").alias("v"), (F.col("c") - F.col("h.c")).alias("shift"), "lo", "hi", "h")
               .withColumns({"lo": F.greatest("lo", F.col("h.lo") + F.col("shift")), "hi": F.least("hi", F.col("h.hi") + F.col("shift"))}).drop("h")
               .where(F.col("hi") - F.col("lo") + 1 >= t))
    first = verified(found.where("not open").drop("open").unionByName(to_head).groupBy("u", "v", "shift").agg(*region))
    # The other members of a cell are compared where its head has not connected them.
    roots = components(first.select("u", "v")).checkpoint()
    rooted = (entries.join(roots, F.col("text") == F.col("node"), "left").withColumn("root", F.coalesce("root", "text")).drop("node"))
    apart = rooted.groupBy("cell").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("cell")
    width = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = (rooted.join(apart, "cell", "left_semi").join(runs.withColumnRenamed("text_id", "text"), "text")
               .select("cell", "text", "c", "lo", cut("span", F.col("lo")), "root").repartition(width, "cell").sortWithinPartitions("cell", "text", "c"))
    more = members.mapInArrow(_settle(t, similarity), _LINK).groupBy("u", "v", "shift").agg(*region)
    return first.unionByName(verified(more))


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, shingle: int = SHINGLE, similarity: float = SIMILARITY, bands: int = BANDS) -> DataFrame:
    """One row per document that shares a passage: doc_id, class_id (smallest
    doc_id of its class), n_docs (documents of the class), n_links (verified
    links of its text), passages (array of struct<start, end>, words, end
    exclusive, merged).

    Texts are compared once each: documents with equal texts (64-bit hash) are
    members of one text, and count as sharing it whole if it has ``min_words``
    words.  Passages of different texts are linked through a representative of
    each content of a cell, and the contents among each other as far as pairs
    that verify connect them; the cells of one alignment are merged to one
    region, in which passages are looked for.  A
    passage repeated inside one document only is not reported, nor are texts
    shorter than ``min_words``; null and empty texts have no passages.  Null
    ids are kept; a class of null ids only has a null class_id.  Rows that
    repeat id and text count once.
    """
    spark, t = docs.sparkSession, min_words - shingle + 1
    keyed = docs.where(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("text_id"), "text")
    members = (keyed.select("doc_id", "text_id", F.size(space_words(F.col("text"))).alias("n_words"))
               .where(F.col("n_words") >= min_words).distinct().checkpoint())
    buckets = bucket_count(members, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = candidate_links(keyed.select("text_id", "text"), buckets, t, shingle, bands)
    found = found.groupBy("open", "u", "v", "shift").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).checkpoint()
    one = members.groupBy("text_id").agg(F.min("doc_id").alias("one"))
    good = verified_links(keyed, one, found, t, shingle, similarity).checkpoint()
    roots = components(good.select("u", "v")).withColumnRenamed("node", "text_id")
    sides = good.select(F.explode(F.array(F.struct(F.col("u").alias("text_id"), "lo", "hi", F.col("v").alias("other")), F.struct(
        F.col("v").alias("text_id"), F.col("vlo").alias("lo"), F.col("vhi").alias("hi"), F.col("u").alias("other")))).alias("x")).select("x.*")
    spans = sides.groupBy("text_id").agg(
        F.count_distinct("other").alias("n_links"), F.array_sort(F.collect_set(F.struct(F.col("lo").alias("start"), (F.col("hi") + shingle).alias("end")))).alias("spans"))

    def absorb(acc, s):
        last = F.element_at(acc, -1)
        return F.when((F.size(acc) > 0) & (s["start"] <= F.element_at(acc, F.when(F.size(acc) > 0, -1).otherwise(1))["end"]), F.concat(
            F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))).otherwise(F.concat(acc, F.array(s)))

    kind = "array<struct<start:bigint,end:bigint>>"
    merged = F.aggregate(F.slice("spans", 2, F.greatest(F.size("spans") - 1, F.lit(0))), F.slice("spans", 1, 1), absorb)
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_words").cast("bigint").alias("end")))
    known = (members.join(roots, "text_id", "left").join(spans, "text_id", "left")
             .withColumns({"root": F.coalesce("root", "text_id"), "n_links": F.coalesce("n_links", F.lit(0)),
                           "passages": F.when(F.col("spans").isNull(), whole).otherwise(merged).cast(kind)}))
    classes = known.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n_docs")).where("n_docs > 1")
    return known.join(classes, "root").select("doc_id", "class_id", "n_docs", "n_links", "passages")


def passage_report(docs: DataFrame) -> DataFrame:
    """repeated_passages with the passages as text, start:end joined by commas."""
    return repeated_passages(docs.select("doc_id", "text")).withColumn("passages", F.array_join(F.transform(
        "passages", lambda p: F.concat_ws(":", p["start"].cast("string"), p["end"].cast("string"))), ","))
