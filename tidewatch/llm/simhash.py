"""Operator 7, SimHash near-duplicates: vantage-point trees over fingerprints."""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.graph import components
from tidewatch.llm.text import lower_space_words

SHINGLE = 3
MAX_BITS = 2
SAMPLE = 20_000        # fingerprints the tree is laid out on (8 bytes each)
LEAF_POINTS = 10_000   # fingerprints a shard should hold
DIRECT = 1 << 20       # comparisons done as one matrix


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles (signed 64 bits); 0 for a text without words."""
    words = lower_space_words(text)
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words])[:n].tolist()
    ends = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    ones, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, 1 << 15):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(starts[at:at + (1 << 15)], ends[at:at + (1 << 15)])], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def _fingerprints(shingle: int):
    @F.pandas_udf("bigint")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield t.map(lambda x: fingerprint(x, shingle)).astype("int64")
    return fp


def with_fingerprint(docs: DataFrame, shingle: int) -> DataFrame:
    return docs.select("doc_id", _fingerprints(shingle)("text").alias("fp"))


def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


@dataclass
class Node:
    """Inner node: points within ``cut`` of ``vantage`` lie inside."""
    vantage: np.uint64
    cut: int
    inside: object
    outside: object


def _best_cut(points: np.ndarray, r: int, rng) -> tuple | None:
    """The vantage point and cut that send the fewest points to both sides,
    among cuts that leave at least a fifth on either; None if none separates."""
    best = None
    for v in points[rng.integers(0, len(points), 12)]:
        hist = np.bincount(distance(points, v), minlength=65 + r) / len(points)
        total = hist.cumsum()
        for cut in range(64):
            if 0.2 <= total[cut] <= 0.8:
                both = hist[max(0, cut - r + 1):cut + r + 1].sum()
                cost = both + 0.3 * abs(total[cut] - 0.5)
                if both < 0.7 and (best is None or cost < best[0]):
                    best = (cost, v, cut)
    return best


def grow(sample: np.ndarray, n_points: int, r: int, leaf_points: int = LEAF_POINTS):
    """Global tree over a bounded sample: (root, number of leaves).  Leaves are
    shard numbers.  The sample only shapes the shards; which pairs are found
    does not depend on it."""
    rng, leaves = np.random.default_rng(7), 0

    def build(points):
        nonlocal leaves
        share = len(points) / max(1, len(sample)) * n_points
        best = _best_cut(points, r, rng) if share > leaf_points and len(points) >= 8 else None
        if best is None:
            leaves += 1
            return leaves - 1
        _, v, cut = best
        near = distance(points, v) <= cut
        return Node(v, cut, build(points[near]), build(points[~near]))

    return build(sample), leaves


def shards(root, fps: np.ndarray, r: int) -> Iterator[tuple[int, np.ndarray, bool]]:
    """(leaf, positions in fps, at home) for a batch.

    Every point has one home leaf.  Two points within r whose homes part at a
    node differ by at most r in distance to its vantage point, so it suffices
    that the inside one, if within r of the cut, also visits the outside;
    visitors follow every branch that the triangle bound leaves open.
    """
    def go(node, home, visit):
        if not len(home) and not len(visit):
            return
        if not isinstance(node, Node):
            yield node, home, True
            yield node, visit, False
            return
        dh, dv = distance(fps[home], node.vantage), distance(fps[visit], node.vantage)
        yield from go(node.inside, home[dh <= node.cut], visit[dv <= node.cut + r])
        crossing = home[(dh <= node.cut) & (dh > node.cut - r)]
        yield from go(node.outside, home[dh > node.cut], np.concatenate([crossing, visit[dv > node.cut - r]]))

    yield from go(root, np.arange(len(fps)), np.arange(0))


class Forest:
    """Union of points by smallest index, vectorised."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        p = self.parent
        while True:
            ra, rb = p[a], p[b]
            live = ra != rb
            if not live.any():
                return
            a, b, ra, rb = a[live], b[live], ra[live], rb[live]
            np.minimum.at(p, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                q = p[p]
                if (q == p).all():
                    break
                p[:] = q


def local_links(fps: np.ndarray, n_home: int, r: int) -> np.ndarray:
    """Parent of every point of one shard (points 0..n_home-1 are at home)
    under links of at most r bits that involve a home point.  The search is a
    vantage-point descent over home points with all points as queries; blocks
    under DIRECT comparisons are compared outright."""
    forest, rng = Forest(len(fps)), np.random.default_rng(11)

    def direct(home, query):
        step = max(1, DIRECT // max(1, len(query)))
        for at in range(0, len(home), step):
            part = home[at:at + step]
            i, j = np.nonzero(np.bitwise_count(fps[part][:, None] ^ fps[query][None, :]) <= r)
            forest.union(part[i], query[j])

    stack = [(np.arange(n_home), np.arange(len(fps)))]
    while stack:
        home, query = stack.pop()
        if not len(home) or not len(query):
            continue
        best = None if len(home) * len(query) <= DIRECT else _best_cut(
            fps[home if len(home) <= 4096 else home[rng.integers(0, len(home), 4096)]], r, rng)
        if best is None:
            direct(home, query)
            continue
        _, v, cut = best
        dh, dq = distance(fps[home], v), distance(fps[query], v)
        stack.append((home[dh <= cut], query[dq <= cut + r]))
        stack.append((home[dh > cut], query[dq > cut - r]))
    return forest.parent


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, leaf_points: int = LEAF_POINTS) -> DataFrame:
    """Spanning links (u, v) of the graph that joins fingerprints at most
    ``max_bits`` apart.  ``fps`` has one column fp with distinct values.

    The tree is laid out on the SAMPLE fingerprints of smallest hash; every
    fingerprint is then sent to its home shard and to the shards that its
    ball overlaps.  A shard returns one link per point, not its pairs.
    """
    n = fps.count()
    picked = fps.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    root, _ = grow(np.array([x.fp for x in picked], dtype=np.int64).view(np.uint64), n, max_bits, leaf_points)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at = b["fp"].to_numpy().view(np.uint64)
            for leaf, rows, home in shards(root, at, max_bits):
                if len(rows):
                    yield pd.DataFrame({"leaf": leaf, "home": home, "fp": at[rows].view(np.int64)})

    def search(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["home", "fp"], ascending=[False, True])
        points = part["fp"].to_numpy().view(np.uint64)
        parent = local_links(points, int(part["home"].sum()), max_bits)
        moved = np.nonzero(parent != np.arange(len(parent)))[0]
        return pd.DataFrame({"u": points[moved].view(np.int64), "v": points[parent[moved]].view(np.int64)})

    sent = fps.mapInPandas(send, "leaf int, home boolean, fp bigint")
    return sent.groupBy("leaf").applyInPandas(search, "u bigint, v bigint")


def _classes(marked: DataFrame, max_bits: int, leaf_points: int) -> DataFrame:
    """(fp, root, component_id) of every fingerprint of ``marked`` (checkpointed: doc_id, fp)."""
    points = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    points = points.checkpoint()
    roots = components(near_links(points.select("fp"), max_bits, leaf_points))
    rooted = points.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(names, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, leaf_points: int = LEAF_POINTS) -> DataFrame:
    """(doc_id, fp, component_id) per input row.

    Texts with equal fingerprints collapse to one point before the search, so
    groups of copies cost nothing there.  Null and empty texts and texts
    without words have fingerprint zero and are linked like any other.
    component_id is the smallest doc_id of the class; null ids are kept and
    never name a class unless it has no other.  Repeated rows give repeated
    results.  An empty table gives an empty result.
    """
    marked = with_fingerprint(docs.select("doc_id", "text"), shingle).checkpoint()
    classes = _classes(marked, max_bits, leaf_points)
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each class: the one with the smallest doc_id (null ids
    last), of equal ids the one whose whole row has the smallest SHA-256.

    So every class keeps a row, whatever its ids, and the choice depends on
    the rows alone, not on their order or on how often the plan runs.  Of
    wholly identical rows one stays.  Only ids and digests are grouped, per
    fingerprint first, so a large class is no hot key.
    """
    # Nulls are left out of the JSON text, each field has its name: no two rows read alike.
    content = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])), 256)
    marked = (docs.select("doc_id", content.alias("content"), _fingerprints(shingle)("text").alias("fp")).checkpoint())
    classes = _classes(marked, max_bits, LEAF_POINTS)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "content")).alias("first")
    firsts = (marked.groupBy("fp").agg(first).join(classes, "fp").groupBy("root").agg(F.min("first").alias("first"))
              .select(F.col("first.content").alias("content")))
    stay = marked.join(firsts, "content", "left_semi").groupBy("content").agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed("content", "_c").checkpoint()
    # The rows travel as a struct: columns of docs may have any name.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), content.alias("_c"))
    kept = rows.join(stay.where("_n = 1"), "_c", "left_semi")
    several = stay.where("_n > 1")
    if not several.isEmpty():
        kept = kept.unionByName(rows.join(several, "_c", "left_semi").dropDuplicates(["_c"]))
    return kept.select("row.*")


def simhash_report(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
