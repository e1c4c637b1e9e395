"""Operator 11, a Merkle manifest of a dataset by time-forward processing.

A node of a tree is labelled (end, level): it covers the leaves before place
``end`` that its level holds.  Ordered by label, children come before parents.
The forward sweep reads leaves in label order; every node sends its digest to
its parent through a priority queue ordered by label.  The reversed sweep
reads all nodes from the greatest label down; every node sends each child the
child's sibling and its own proof suffix.  On either way a queue holds one
message per level at most.

A tree of any size is swept in blocks of consecutive leaves: what a block
sends to the tree above it, and what comes back, is shuffled to its receiver
and sorted there by label (Spark's external sort is the external queue).
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.sizes import broadcast_if_small

BLOCK_LEVELS = 10   # levels of a block: 1,024 leaves
TAMPER_MOD = 7      # ids whose crc32 it divides are tampered with
_FIRST = (1 << 63) - 1

_NODE = "key string, block bigint, count bigint, end bigint, level int, left string, right string, digest string"
_LEAF = "doc_id bigint, leaf string, other string"
_PATH = "path array<string>, subroot string, root string"


# ---- leaves -------------------------------------------------------------------

def _field(c: Column) -> Column:
    """'-' for null, else UTF-8 byte count, ':' and the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(n_chars: Column | None = None) -> Column:
    """Digest of a row of documents; ``n_chars`` replaces the column of that name."""
    n = F.col("n_chars") if n_chars is None else n_chars
    return F.sha2(F.concat(*[_field(c) for c in (F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text"))]), 256)


def tampered(mod: int = TAMPER_MOD) -> Column:
    """Whether a row is tampered with (a null id never is)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod == 0, F.lit(False))


def leaves(docs: DataFrame, mod: int = TAMPER_MOD) -> DataFrame:
    """(key, doc_id, leaf, other): key stands for the language (null sorts
    first), other is the digest of the row as it is found, tampered or not."""
    return docs.select("doc_id", "source", "lang", "n_chars", "text").select(
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")).alias("key"), F.col("doc_id").cast("bigint").alias("doc_id"), leaf_digest().alias("leaf"),
        F.when(tampered(mod), leaf_digest(F.col("n_chars").cast("bigint") + 1)).alias("other")).withColumn("other", F.coalesce("other", "leaf"))


# ---- places -------------------------------------------------------------------

def placed(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``rows`` (a checkpointed frame) with ``pos``, the place of a row among
    those of its key by ``order``, and ``count``, their number.

    Rows are sorted by ranges, so one key spreads over many tasks.  The counts
    per (task, key) give each task the place at which it begins.  Rows that
    are equal in ``order`` are told apart by their place in ``rows``.
    """
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    by = [key, *[F.col(c).asc_nulls_first() for c in order], "tie"]
    sorted_rows = (tied.repartitionByRange(width, *by).sortWithinPartitions(*by)
                   .withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}).drop("tie").checkpoint())
    sizes = sorted_rows.groupBy("part", key).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("part", key, (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
                          F.sum("n").over(Window.partitionBy(key)).alias("count")).checkpoint()
    return (sorted_rows.join(broadcast_if_small(begins, 96), ["part", key])
            .withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift"))


# ---- sweeps -------------------------------------------------------------------

def _digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _height(count: int, most: int) -> int:
    """Levels of a block in a tier of ``count`` nodes."""
    return min((count - 1).bit_length(), most)


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(n).to_pylist() for n in names))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4_096) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _forward(levels: int):
    """Arrow task over (key, block, pos, count, digest) in that order: the
    inner nodes of every block, and a row of level -1 with the block's root."""
    schema = pa.schema([("key", pa.string()), ("block", pa.int64()), ("count", pa.int64()), ("end", pa.int64()), ("level", pa.int32()),
                        ("left", pa.string()), ("right", pa.string()), ("digest", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def nodes():
            queue, block, count, height, top = [], None, 0, 0, None

            def send(end, level, digest):
                """To the parent, which covers twice as many leaves; the child's end keeps siblings in order."""
                span = 1 << (level + 1)
                heappush(queue, (-(-end // span) * span, level + 1, end, digest))

            def deliver(before):
                """Nodes whose leaves all lie before that place."""
                nonlocal top
                while queue and (before is None or queue[0][0] <= before):
                    end, level, _, left = heappop(queue)
                    right = heappop(queue)[3] if queue and queue[0][:2] == (end, level) else None
                    top = _digest(left, right or "")
                    yield (*block, count, end, level, left, right, top)
                    if level < height:
                        send(end, level, top)

            def close():
                yield from deliver(None)
                yield (*block, count, -1, -1, None, None, top)

            for key, at, pos, n, digest in _rows(batches, ["key", "block", "pos", "count", "digest"]):
                if (key, at) != block:
                    if block is not None:
                        yield from close()
                    block, count, height = (key, at), n, _height(n, levels)
                yield from deliver(pos)
                top = digest
                if height:
                    send(pos + 1, 0, digest)
            if block is not None:
                yield from close()
        yield from _batches(nodes(), schema)
    return run


def _reversed(levels: int):
    """Arrow task over the message to a block, its inner nodes and its leaves,
    by falling label: the path of every leaf, from its sibling up to the root.
    An entry is L or R (the side of the sibling) and the sibling's digest, or
    empty where a node is the only child."""
    schema = pa.schema([("key", pa.string()), ("pos", pa.int64()), ("doc_id", pa.int64()), ("leaf", pa.string()), ("other", pa.string()),
                        ("path", pa.list_(pa.string())), ("subroot", pa.string()), ("root", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def paths():
            queue, suffix, subroot, root = [], None, None, None
            names = ["key", "end", "level", "left", "right", "doc_id", "leaf", "other", "path", "subroot", "root"]
            for key, end, level, left, right, doc_id, leaf, other, path, sub, top in _rows(batches, names):
                if end == _FIRST:
                    queue, subroot, root, suffix = [], sub, top, None
                    for entry in reversed(path):
                        suffix = (entry, suffix)
                    queue.append((0, 0, suffix))       # to the block's root, whose label comes first
                    continue
                _, _, suffix = heappop(queue)
                if level:
                    middle = end - (1 << (level - 1))
                    heappush(queue, (-middle, 1 - level, ("" if right is None else "R" + right, suffix)))
                    if right is not None:
                        heappush(queue, (-end, 1 - level, ("L" + left, suffix)))
                else:
                    out = []
                    while suffix is not None:
                        out.append(suffix[0])
                        suffix = suffix[1]
                    yield key, end - 1, doc_id, leaf, other, out, subroot, root
        yield from _batches(paths(), schema)
    return run


def sweep_up(rows: DataFrame, levels: int = BLOCK_LEVELS) -> tuple[list[tuple[DataFrame, DataFrame]], DataFrame]:
    """``rows`` has key, pos, count and digest.  Returns (leaves, inner nodes)
    of every tier of blocks, lowest first, and the root (key, digest) of every
    key.  The number of tiers is that of the largest key."""
    most, tiers = rows.agg(F.max("count")).first()[0] or 0, []
    while True:
        rows = rows.withColumn("block", F.shiftright("pos", levels))
        nodes = (rows.select("key", "block", "pos", "count", "digest").repartition("key", "block").sortWithinPartitions("key", "block", "pos")
                 .mapInArrow(_forward(levels), _NODE).checkpoint())
        tiers.append((rows, nodes))
        roots = nodes.where("level = -1")
        if most <= 1 << levels:
            return tiers, roots.select("key", "digest")
        most = (most + (1 << levels) - 1) >> levels
        rows = roots.select("key", F.col("block").alias("pos"),
                            F.shiftright(F.col("count") + ((1 << levels) - 1), levels).alias("count"), "digest")


def sweep_down(tiers: list[tuple[DataFrame, DataFrame]], messages: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """Paths of all leaves: (key, pos, doc_id, leaf, other, path, subroot, root).
    ``messages`` (key, path, subroot, root) tells every key's root its own path."""
    none = {c: F.lit(None).cast(t) for c, t in (x.split(" ", 1) for x in (*_LEAF.split(", "), *_PATH.split(", ")))}
    told = messages.withColumn("block", F.lit(0).cast("bigint"))
    for rows, nodes in reversed(tiers):
        below = rows.select("key", "block", (F.col("pos") + 1).alias("end"), F.lit(0).alias("level"), F.lit(None).cast("string").alias("left"),
                            F.lit(None).cast("string").alias("right"), *[(F.col(c) if c in rows.columns else none[c]).alias(c) for c in ("doc_id", "leaf", "other")],
                            *[none[c].alias(c) for c in ("path", "subroot", "root")])
        inner = nodes.where("level > 0").select("key", "block", "end", "level", "left", "right", *[c.alias(n) for n, c in none.items()])
        first = told.select("key", "block", F.lit(_FIRST).alias("end"), F.lit(99).alias("level"), F.lit(None).cast("string").alias("left"),
                            F.lit(None).cast("string").alias("right"), *[none[c].alias(c) for c in ("doc_id", "leaf", "other")], "path", "subroot", "root")
        paths = (first.unionByName(inner).unionByName(below).repartition("key", "block")
                 .sortWithinPartitions("key", "block", F.desc("end"), F.desc("level"))
                 .mapInArrow(_reversed(levels), f"key string, pos bigint, {_LEAF}, {_PATH}"))
        told = paths.select("key", F.col("pos").alias("block"), "path", "subroot", "root")
    return paths


# ---- the operator ---------------------------------------------------------------

def manifest(rows: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per leaf: key, doc_id, leaf, other, subroot, root, path.

    ``rows`` is what ``leaves`` returns.  Per key the leaves ascend by doc_id
    (null first), equal ids by digest; rows equal in both are interchangeable.
    Every two consecutive nodes become their digest until one is left, the
    subroot; the subroots in order of key give the root the same way.  An
    empty table has no rows and no root.
    """
    base = placed(rows.checkpoint(), "key", ["doc_id", "leaf"]).withColumn("digest", F.col("leaf")).checkpoint()
    tiers, subroots = sweep_up(base, levels)
    tops = subroots.select(F.lit("").alias("key"), F.col("key").alias("leaf"), "digest").checkpoint()
    top_tiers, roots = sweep_up(placed(tops, "key", ["leaf"]).withColumns(
        {"doc_id": F.lit(None).cast("bigint"), "other": F.col("digest")}).checkpoint(), levels)
    down = sweep_down(top_tiers, roots.select("key", F.array().cast("array<string>").alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root")), levels)
    # A key travels as the leaf of the upper tree, its subroot as the other digest.
    told = down.select(F.col("leaf").alias("key"), "path", F.col("other").alias("subroot"), "root")
    return sweep_down(tiers, told, levels).select("key", "doc_id", "leaf", "other", "subroot", "root", "path")


def fold(path: Column, digest: Column) -> Column:
    """The root that a path gives for a leaf's digest."""
    return F.aggregate(path, digest, lambda acc, x: F.sha2(
        F.when(x.startswith("L"), F.concat(F.substring(x, 2, 64), acc)).otherwise(F.concat(acc, F.substring(x, 2, 64))), 256))


def manifest_report(docs: DataFrame) -> DataFrame:
    """Leaf, subroot, root and proof digest of every row, and whether the row
    as found (tampered or not) still leads to the root along its proof."""
    proof = F.sha2(F.array_join(F.transform("path", lambda x: F.substring(x, 2, 64)), ""), 256)
    return manifest(leaves(docs)).select(
        "doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), fold(F.col("path"), F.col("other")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
