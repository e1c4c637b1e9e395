"""Operator 9, benchmark decontamination by winnowing."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.sizes import BROADCAST_BYTES
from tidewatch.llm.text import WordHasher, gram_hashes, lower_alnum_words, per_row

WINDOW = 10   # words of a shared span that must be found
GRAM = 5      # words hashed together
_SCHEMA = ("key struct<id:string,h:bigint>, n_words int, words array<bigint>, fps array<struct<k:int,p:int,f:bigint>>")


def winnowed(h: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the kept grams: the smallest (rightmost of
    equal ones) in every ``window - gram + 1`` consecutive grams.  Any span of
    ``window`` words that two texts share has a kept gram at the same place in
    both."""
    g = gram_hashes(h, gram)
    w = window - gram + 1
    if len(g) < w:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    view = np.lib.stride_tricks.sliding_window_view(g, w)
    at = np.unique(np.arange(len(view)) + (w - 1) - view[:, ::-1].argmin(axis=1))
    return at, g[at]


def _marks(lengths: list[int], window: int, gram: int, is_item: bool):
    """Arrow task: word hashes and kept grams of every text.  ``lengths`` are
    the word counts of items shorter than a window; such an item is one gram
    of its own length, looked up at every place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in batches:
            counts, words, kept = [], [], []
            for text in b.column("text").to_pylist():
                h = hasher(lower_alnum_words(text))
                n = len(h)
                counts.append(n)
                words.append(h.view(np.int64))
                rows = []
                if not is_item or n >= window:
                    at, f = winnowed(h, window, gram)
                    rows.append((np.full(len(at), gram), at, f))
                for k in (lengths if not is_item else [n] if 0 < n < window else []):
                    f = gram_hashes(h, k)
                    rows.append((np.full(len(f), -k), np.arange(len(f)), f))
                kept.append(rows)
            offsets = np.concatenate([[0], np.cumsum([sum(len(r[1]) for r in rows) for rows in kept])]).astype(np.int32)
            flat = [np.concatenate([r[i] for rows in kept for r in rows] or [np.empty(0)]) for i in range(3)]
            grams = pa.StructArray.from_arrays([pa.array(flat[0].astype(np.int32)), pa.array(flat[1].astype(np.int32)),
                                                pa.array(flat[2].astype(np.uint64).view(np.int64))], names=["k", "p", "f"])
            yield pa.RecordBatch.from_arrays([
                b.column("key"), pa.array(counts, pa.int32()),
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()),
                                         pa.array(np.concatenate(words) if words else np.empty(0, np.int64))),
                pa.ListArray.from_arrays(pa.array(offsets), grams)], names=["key", "n_words", "words", "fps"])
    return run


def _keyed(df: DataFrame, id_col: str) -> DataFrame:
    return df.select(F.struct(F.col(id_col).cast("string").alias("id"), F.xxhash64("text").alias("h")).alias("key"), "text")


def _hits(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """(key, n_words, item_id, s, n): places where a window of an item occurs;
    one row without an item per document besides.

    ``items`` is one broadcast block of (k, f, p, item_id, words): a gram with
    the words of the item that a window around it can reach, and its place
    among them.  A shared gram fixes the diagonal; every window that holds the
    gram is compared word by word with the document there.  A list of the document's
    grams is exploded and looked up in one stage, so only matches carry words on.
    """
    grams = docs.select("key", "n_words", "words", F.explode(F.concat("fps", F.array(F.struct(
        F.lit(0).alias("k"), F.lit(-1).alias("p"), F.lit(0).cast("bigint").alias("f"))))).alias("g"))
    it = F.broadcast(items.select(F.col("k").alias("ik"), F.col("f").alias("if"), F.col("p").alias("ip"), "item_id", F.col("words").alias("iw")))
    found = grams.join(it, (F.col("g.k") == F.col("ik")) & (F.col("g.f") == F.col("if")), "left").where("g.k = 0 or ip is not null")
    size = F.least(F.size("iw"), F.lit(window))
    first, last = F.greatest(F.col("ip") - (size - F.abs(F.col("ik"))), F.lit(0)), F.least(F.col("ip"), F.size("iw") - size)
    first = F.greatest(first, F.col("ip") - F.col("g.p"))
    last = F.least(last, F.col("ip") - F.col("g.p") + F.col("n_words") - size)
    starts = F.when(first <= last, F.filter(F.sequence(first, last), lambda s: F.slice("iw", s + 1, size) == F.slice(
        "words", F.col("g.p") - F.col("ip") + s + 1, size)))
    return found.select("key", "n_words", "item_id", size.alias("n"), F.explode_outer(F.when(
        F.col("ip").isNotNull(), F.transform(starts, lambda s: F.col("g.p") - F.col("ip") + s))).alias("s")).where("item_id is null or s is not null")


def _blocks(items: DataFrame, row_bytes: int, limit: int) -> tuple[DataFrame, int]:
    """``items`` with a column ``block``, and the number of blocks, none of
    which holds more than ``limit`` bytes by a count of its rows.  Rows are
    dealt by all their values, so a gram that very many items share lies in
    every block like any other."""
    n = max(1, -(-items.count() * row_bytes // limit))
    while True:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "k", "f", "p", "words"), F.lit(n)).cast("int"))
        most = dealt.groupBy("block").count().agg(F.max("count")).first()[0] or 0
        if n == 1 or most * row_bytes <= limit:
            return dealt, n
        n += -(-n // 4)


def contaminated_words(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id",
                       block_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(key, n_words, n_hit, items) per distinct (id, text).

    ``key`` is struct<id string, h = xxhash64(text)>, so repeated rows are
    judged once and rows that only share an id are kept apart.  ``items`` is
    the sorted array of item ids with an occurring window, n_hit the words
    inside any occurrence.  Null or empty texts have no words; an empty
    benchmark marks nothing; null item ids are ignored.

    The benchmark's kept grams are checkpointed and cut into blocks whose
    byte size is counted; a row holds the item's words around one gram, less
    than two windows whatever the item's length.  The documents meet one
    broadcast block after another, so neither side's size changes the plan.
    """
    from_word = F.greatest(F.col("g.p") - (window - F.abs("g.k")), F.lit(0))
    items = (_keyed(benchmark.where(F.col("item_id").isNotNull()), "item_id")
             .mapInArrow(_marks([], window, gram, True), _SCHEMA).select(F.col("key.id").alias("item_id"), "words", F.explode("fps").alias("g"))
             .select("item_id", F.slice("words", from_word + 1, F.col("g.p") + window - from_word).alias("words"), F.col("g.k").alias("k"),
                     (F.col("g.p") - from_word).alias("p"), F.col("g.f").alias("f")).distinct().checkpoint())
    short = sorted(-r.k for r in items.where("k < 0").select("k").distinct().collect())  # lengths below a window
    id_bytes = items.agg(F.max(F.octet_length("item_id"))).first()[0] or 0
    items, n = _blocks(items, 64 + id_bytes + 8 * 2 * window, block_bytes)
    marked = _keyed(docs, id_col).mapInArrow(_marks(short, window, gram, False), _SCHEMA)
    if n > 1:
        marked = marked.checkpoint()
    hits = None
    for i in range(n):
        part = _hits(marked, items.where(F.col("block") == i), window)
        hits = part if hits is None else hits.unionByName(part)
    rows = hits.select("key", "n_words", "item_id", F.explode_outer(F.sequence("s", F.col("s") + F.col("n") - 1)).alias("w"))
    return rows.groupBy("key", "n_words").agg(F.count_distinct("w").alias("n_hit"), F.array_sort(F.collect_set("item_id")).alias("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Documents without a benchmark window, as they came; repeated clean rows
    and rows with null texts stay."""
    bad = contaminated_words(docs, benchmark, window, gram).where("n_hit > 0").select(F.col("key.id").alias("_id"), F.col("key.h").alias("_h"))
    return docs.join(bad, F.col("doc_id").cast("string").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_h")), "left_anti")


def decontamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated.
    Repeated rows give repeated results."""
    d = per_row(docs, contaminated_words(docs, benchmark))
    return d.select("doc_id", F.col("n_words").cast("bigint").alias("n_words"),
                    F.col("n_hit").cast("bigint").alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
