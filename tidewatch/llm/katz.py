"""Operator 8, language-model scoring: Katz backoff over word bigrams.

Texts are cut into blocks of a bounded number of tokens, each with its own
vocabulary, so what is shuffled are the distinct words and distinct bigrams of
a block with their counts, not tokens, and every answer goes back once per
block.  Words are 64-bit hashes in the first exchange and numbers after it.
Number columns travel packed (``pack``): by byte plane, compressed.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.text import WordHasher, lower_space_words

BLOCK_TOKENS = 1_500_000
BUCKETS_PER_PARTITION = 4                # keeps the groups of one bucket small
CUT = 5                                  # counts above are not discounted
END = xxhash.xxh64_intdigest(b"\n")      # no word holds a newline
UNKNOWN = 0                              # number of all words seen fewer than twice

_BLOCK = ("block_id bigint, rid array<bigint>, ids array<string>, held array<boolean>, size array<int>, "
          "first bigint, vocab array<bigint>, token array<int>")
_ASK_WORDS = "bucket int, block_id bigint, key binary, n binary"
_ASK_PAIRS = "bucket int, block_id bigint, hist binary, size binary, w binary, n binary, wn binary"
_ANSWER = "block_id bigint, kind int, bucket int, id binary, n binary, total binary, few binary, lower binary"


def pack(a: np.ndarray) -> bytes:
    """Whole numbers (64 bits) or doubles as one compressed value."""
    wide = np.ascontiguousarray(a).astype("<f8" if a.dtype.kind == "f" else "<i8")
    return zstandard.compress(wide.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack(b: bytes, kind: str = "<i8") -> np.ndarray:
    raw = zstandard.decompress(b)
    return np.frombuffer(raw, np.uint8).reshape(8, -1).T.copy().view(kind).ravel() if raw else np.empty(0, kind)


def joined(column, kind: str = "<i8") -> np.ndarray:
    return np.concatenate([unpack(b, kind) for b in column])


def shared_dir(spark: SparkSession) -> str:
    """A new folder name under the shared folder of the cluster."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not top:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{top.rstrip('/')}/katz-{uuid.uuid4().hex}"


def _blocks(limit: int):
    """Arrow task: blocks of about ``limit`` tokens.  A text that doesn't fit
    goes on in the next block, which keeps the word before it (``first``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, part = WordHasher(), TaskContext.get().partitionId()
        number, made = 0, 0
        rid, ids, held, size, words, total, first = [], [], [], [], [], 0, END

        def block():
            nonlocal made
            flat = np.concatenate(words)
            vocab, code, count = np.unique(np.append(flat, np.uint64(first)), return_inverse=True, return_counts=True)
            rank = np.argsort(-count, kind="stable")     # frequent words get small codes
            place = np.empty(len(rank), dtype=np.int32)
            place[rank] = np.arange(len(rank), dtype=np.int32)
            made += 1
            row = [(part << 24) + made, rid, ids, held, size, int(np.uint64(first).view(np.int64)), vocab[rank].view(np.int64), place[code[:-1]]]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.bool_()), pa.list_(pa.int32()),
                     pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)],
                                              names=["block_id", "rid", "ids", "held", "size", "first", "vocab", "token"])

        for b in batches:
            for doc, text, out in zip(b.column("id").to_pylist(), b.column("text").to_pylist(), b.column("held").to_pylist()):
                h = np.append(hasher(lower_space_words(text)), np.uint64(END))
                number += 1
                while len(h):
                    take = h[:limit - total]
                    rid.append((part << 40) + number)
                    ids.append(doc)
                    held.append(out)
                    size.append(len(take))
                    words.append(take)
                    total, h = total + len(take), h[len(take):]
                    if total >= limit:
                        yield block()
                        rid, ids, held, size, words, total, first = [], [], [], [], [], 0, int(take[-1])
        if total:
            yield block()
    return run


def _word_buckets(vocab: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    bucket = (vocab.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _train(held: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.repeat(~held.astype(bool), size)


def _ask_words(buckets: int):
    """Arrow task: the words of every block with their training counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                held, size, token, vocab = (b.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("held", "size", "token", "vocab"))
                n = np.bincount(token[_train(held, size)], minlength=len(vocab)).astype(np.int32)
                order, cut = _word_buckets(vocab, buckets)
                for k in range(buckets):
                    at = order[cut[k]:cut[k + 1]]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([k], pa.int32()), pa.array([b.column("block_id")[i].as_py()], pa.int64()),
                        pa.array([pack(vocab[at])], pa.binary()), pa.array([pack(n[at])], pa.binary())], names=["bucket", "block_id", "key", "n"])
    return run


def _answer(rows: list[dict]) -> pd.DataFrame:
    rows = [{c: pack(v) if isinstance(v, np.ndarray) else v for c, v in r.items()} for r in rows]
    return pd.DataFrame(rows, columns=["block_id", "kind", "bucket", "id", "n", "total", "few", "lower"])


def _count_words(buckets: int):
    """Group of one bucket: global counts and numbers of its words, for each
    block that asked; one row (block -1) with tokens, words, hapaxes, words seen twice."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        bucket = int(part["bucket"].iloc[0])
        keys = [unpack(k) for k in part["key"]]
        key, inv = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(inv, weights=joined(part["n"]), minlength=len(key)).astype(np.int64)
        known = (n >= 2) | (key.view(np.uint64) == np.uint64(END))
        number = np.where(known, np.cumsum(known) * buckets + bucket, UNKNOWN)
        rows, at = [{"block_id": -1, "kind": 0, "bucket": bucket, "n": np.array([n.sum(), (n > 0).sum(), (n[~known] == 1).sum(), (n[key.view(np.uint64) != np.uint64(END)] == 2).sum()])}], 0
        for block, k in zip(part["block_id"], keys):
            own = inv[at:at + len(k)]
            at += len(k)
            rows.append({"block_id": block, "kind": 1, "bucket": bucket, "id": number[own], "n": n[own]})
        return _answer(rows)
    return run


class _Pairs:
    """The distinct bigrams of a block and how they are dealt to buckets.

    A bigram goes to the bucket of its history.  A history that holds more
    than one bucket's share of all tokens is spread over as many buckets as it
    has shares, by the second word; the block then asks all of them, so that
    their parts of the history's sums add up.
    """

    def __init__(self, block, answers: pd.DataFrame, n_tokens: int, n_hapax: int, buckets: int):
        answers = answers[answers["kind"] == 1].sort_values("bucket")
        order, _ = _word_buckets(block["vocab"], buckets)
        self.word_id, self.word_n = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        self.word_id[order] = joined(answers["id"])
        self.word_n[order] = joined(answers["n"])
        token = block["token"]
        before = int(np.nonzero(block["vocab"] == block["first"])[0][0])
        # Words under one number count as one: their class is the first of them.
        uniq, cls = np.unique(self.word_id, return_inverse=True)
        self.class_n = np.zeros(len(uniq), np.int64)
        self.class_n[cls] = self.word_n
        if uniq[0] == UNKNOWN:
            self.class_n[0] = max(n_hapax, 1)
        w = cls[token]
        h = np.concatenate([[cls[before]], w[:-1]])
        pair, self.place = np.unique(h * len(uniq) + w, return_inverse=True)
        ph, pw = pair // len(uniq), pair % len(uniq)
        share = np.minimum(np.maximum(1, -(-self.class_n * buckets // max(n_tokens, 1))), buckets)
        start = uniq * 0x9E3779B1 % (1 << 61) // 7
        bucket = (start[ph] + uniq[pw] % share[ph]) % buckets
        self.order = np.lexsort((pw, ph, bucket))
        hot = np.nonzero(share[:] > 1)[0]
        hot = hot[np.isin(hot, ph)]
        ask_h = np.repeat(hot, share[hot])
        ask_b = (start[ask_h] + np.arange(len(ask_h)) - np.repeat(np.cumsum(share[hot]) - share[hot], share[hot])) % buckets
        slot = np.concatenate([bucket * len(uniq) + ph, ask_b * len(uniq) + ask_h])
        used, size = np.unique(slot, return_counts=True)
        size[np.isin(used, slot[len(bucket):])] -= 1      # asks without a bigram
        self.hist, self.hist_bucket, self.hist_size = used % len(uniq), used // len(uniq), size
        self.pair_cut = np.searchsorted(bucket[self.order], np.arange(buckets + 1))
        self.hist_cut = np.searchsorted(self.hist_bucket, np.arange(buckets + 1))
        self.uniq, self.ph, self.pw, self.token = uniq, ph, pw, token


def _block(part: pd.DataFrame) -> dict:
    row = part.iloc[0]
    return {c: (row[c] if c in ("block_id", "first") else np.asarray(row[c])) for c in part.columns}


def _ask_pairs(n_tokens: int, n_hapax: int, buckets: int):
    def run(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(blocks):
            return pd.DataFrame({"bucket": [], "block_id": [], "hist": [], "size": [], "w": [], "n": [], "wn": []})
        block = _block(blocks)
        p = _Pairs(block, answers, n_tokens, n_hapax, buckets)
        n = np.bincount(p.place, weights=_train(block["held"], block["size"]), minlength=len(p.ph)).astype(np.int32)
        rows = []
        for k in range(buckets):
            at, hs = p.order[p.pair_cut[k]:p.pair_cut[k + 1]], slice(p.hist_cut[k], p.hist_cut[k + 1])
            if hs.stop > hs.start:
                rows.append((k, block["block_id"], *map(pack, (p.uniq[p.hist[hs]], p.hist_size[hs], p.uniq[p.pw[at]], n[at], p.class_n[p.pw[at]]))))
        return pd.DataFrame(rows, columns=["bucket", "block_id", "hist", "size", "w", "n", "wn"])
    return run


def _count_pairs(n_total: int):
    """Group of one bucket: global bigram counts, and per history what its
    backoff weight needs: its total, how many continuations were seen once,
    twice ... CUT times, and the unigram mass of the seen ones."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        hists, words = [unpack(x) for x in part["hist"]], [unpack(x) for x in part["w"]]
        hist, w, size = np.concatenate(hists), np.concatenate(words), joined(part["size"])
        uh, hinv = np.unique(hist, return_inverse=True)
        uw, winv = np.unique(w, return_inverse=True)
        pair, inv = np.unique(np.repeat(hinv, size) * np.int64(len(uw) or 1) + winv, return_inverse=True)
        n = np.bincount(inv, weights=joined(part["n"]), minlength=len(pair)).astype(np.int64)
        wn = np.zeros(len(pair))
        wn[inv] = joined(part["wn"])
        ph, seen, m = pair // (len(uw) or 1), n > 0, len(uh)
        total = np.bincount(ph[seen], weights=n[seen], minlength=m).astype(np.int64)
        few = np.stack([np.bincount(ph[n == r], minlength=m) for r in range(1, CUT + 1)], axis=1).astype(np.int32)
        lower = np.bincount(ph[seen], weights=wn[seen] / n_total, minlength=m)
        bucket = int(part["bucket"].iloc[0])
        rows = [{"block_id": -1, "kind": 0, "bucket": bucket, "n": np.array([(n == r).sum() for r in range(1, CUT + 2)])}]
        ha = pa_ = 0
        for block, hs, ws in zip(part["block_id"], hists, words):
            own, at = hinv[ha:ha + len(hs)], inv[pa_:pa_ + len(ws)]
            ha, pa_ = ha + len(hs), pa_ + len(ws)
            rows.append({"block_id": block, "kind": 2, "bucket": bucket, "n": n[at], "total": total[own], "few": few[own].ravel(), "lower": lower[own]})
        return _answer(rows)
    return run


def discounts(of: np.ndarray) -> np.ndarray:
    """Good-Turing discounts d[1..CUT] from the numbers of bigrams seen 1 ..
    CUT+1 times, in Katz's form (none above CUT).  Where the estimates are not
    usable (a count of zero, a discount outside (0, 1)) half a count is taken
    off instead."""
    r = np.arange(1, CUT + 1)
    fallback = (r - 0.5) / r
    if (of <= 0).any():
        return fallback
    common = (CUT + 1) * of[CUT] / of[0]
    if common >= 1:
        return fallback
    d = ((r + 1) * of[1:] / (r * of[:-1]) - common) / (1 - common)
    return d if ((d > 0) & (d < 1)).all() else fallback


def backoff(total: np.ndarray, few: np.ndarray, lower: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(denominator, weight) per history.  The weight makes the probabilities
    of seen and unseen continuations add up to one.  A history without a
    discounted continuation keeps one count back; one whose seen words hold
    the whole unigram mass has nothing to back off to and isn't discounted
    (weight -1)."""
    r = np.arange(1, CUT + 1)
    kept = (few * r * (1 - d)).sum(axis=1)
    denominator = total + (kept <= 0)
    left = np.where(kept > 0, kept, 1.0) / np.maximum(denominator, 1)
    rest = 1.0 - lower
    weight = np.where(total == 0, 1.0, left / np.maximum(rest, 1e-300))
    whole = (total > 0) & (rest < 1e-12)
    return np.where(whole, total, denominator), np.where(whole, -1.0, weight)


def unknown_words(n_hapax: int, n_twice: int) -> float:
    """Number of words in the class UNKNOWN: those seen once, and the unseen
    ones by Chao's estimate.  With it the Good-Turing shares of a word seen
    once and of an unseen word are the same (but for its bias correction)."""
    return max(1.0, n_hapax + n_hapax * (n_hapax - 1) / (2 * (n_twice + 1)))


def _score(n_tokens: int, n_words: int, n_hapax: int, n_total: int, buckets: int, d: np.ndarray, members: float):
    def run(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        names = ["rid", "id", "held", "n_tokens", "n_known", "base", "score"]
        if not len(blocks):
            return pd.DataFrame({n: [] for n in names})
        block = _block(blocks)
        p = _Pairs(block, answers, n_tokens, n_hapax, buckets)
        got = answers[answers["kind"] == 2].sort_values("bucket")
        n = np.empty(len(p.ph), np.int64)
        n[p.order] = joined(got["n"])
        m = len(p.uniq)
        total = np.bincount(p.hist, weights=joined(got["total"]), minlength=m).astype(np.int64)
        few = joined(got["few"]).reshape(-1, CUT)
        few = np.stack([np.bincount(p.hist, weights=few[:, i], minlength=m) for i in range(CUT)], axis=1)
        lower = np.bincount(p.hist, weights=joined(got["lower"], "<f8"), minlength=m)
        denominator, weight = backoff(total, few, lower, d)
        factor = np.where(n <= CUT, np.append(d, 1.0)[np.clip(n - 1, 0, CUT)], 1.0)
        factor = np.where(weight[p.ph] < 0, 1.0, factor)
        seen = factor * n / np.maximum(denominator[p.ph], 1)
        unseen = np.abs(weight[p.ph]) * p.class_n[p.pw] / n_total
        value = np.log10(np.where(n > 0, seen, unseen)) - np.where(p.uniq[p.pw] == UNKNOWN, np.log10(members), 0.0)
        c = p.word_n[p.token]
        base = np.log10((c + 1.0) / (n_tokens + n_words + 1.0))
        ends = np.cumsum(block["size"])
        starts = ends - block["size"]

        def summed(x):
            return np.add.reduceat(x, starts)

        return pd.DataFrame({"rid": block["rid"], "id": block["ids"], "held": block["held"], "n_tokens": block["size"].astype(np.int64),
                             "n_known": summed((c > 0).astype(np.int64)), "base": summed(base), "score": summed(value[p.place])}, columns=names)
    return run


_SCORES = {"n_tokens": "bigint", "n_known": "bigint", "base_score": "double", "score": "double", "train_tokens": "bigint"}


def katz_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", block_tokens: int = BLOCK_TOKENS, by_word: bool = False) -> DataFrame:
    """(id string, held, n_tokens, n_known, train_tokens, base_score, score)
    per input row, trained on the rows where ``held_out`` is false.

    Words seen fewer than twice in training form one class, whose probability
    is the share of words seen once (the Good-Turing mass of the unseen);
    ``by_word`` divides it by the number of words in the class, so that the
    probabilities are of words, otherwise a token of it counts as the class.  A
    bigram's probability is its discounted share of its history, or the
    history's backoff weight times the unigram probability; the end of the
    text before is the history of a text's first word.

    Null and empty texts have one token, the end.  Null ids are kept; repeated
    rows are scored (and counted) each; a null ``held_out`` counts as false.
    An empty table gives an empty result.  The count tables are written to the
    shared folder, partitioned by bucket; blocks are bucketed by block_id, so
    the joins with the answers don't move them.
    """
    spark = docs.sparkSession
    where, width = shared_dir(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = BUCKETS_PER_PARTITION * width
    table = "katz_blocks_" + where.rsplit("-", 1)[1]
    rows = docs.select(F.col(id_col).cast("string").alias("id"), "text", F.coalesce(held_out, F.lit(False)).alias("held"))
    (rows.mapInArrow(_blocks(block_tokens), _BLOCK).write.option("path", f"{where}/blocks").option("compression", "zstd")
     .bucketBy(width, "block_id").saveAsTable(table))
    blocks = spark.table(table)

    def stored(answers: DataFrame, name: str) -> DataFrame:
        answers.write.option("compression", "none").parquet(f"{where}/{name}")
        return spark.read.schema(_ANSWER).parquet(f"{where}/{name}")

    def sums(answers: DataFrame) -> list[int]:
        """Of the one row per bucket that carries totals."""
        return sum(unpack(r.n) for r in answers.where("block_id = -1").select("n").collect()).tolist()

    words = stored(blocks.select("block_id", "held", "size", "vocab", "token").mapInArrow(_ask_words(buckets), _ASK_WORDS)
                   .groupBy("bucket").applyInPandas(_count_words(buckets), _ANSWER), "words")
    if words.isEmpty():
        return rows.select("id", "held", *[F.lit(None).cast(k).alias(c) for c, k in _SCORES.items()]).limit(0)
    n_tokens, n_words, n_hapax, n_twice = sums(words)
    n_total = n_tokens + (n_hapax == 0)
    answers = words.where("kind = 1")
    asked = (blocks.groupBy("block_id").cogroup(answers.groupBy("block_id"))
             .applyInPandas(_ask_pairs(n_tokens, n_hapax, buckets), _ASK_PAIRS))
    pairs = stored(asked.groupBy("bucket").applyInPandas(_count_pairs(n_total), _ANSWER), "bigrams")
    d = discounts(np.array(sums(pairs)))
    scored = blocks.groupBy("block_id").cogroup(answers.unionByName(pairs.where("kind = 2")).groupBy("block_id")).applyInPandas(
        _score(n_tokens, n_words, n_hapax, n_total, buckets, d, unknown_words(n_hapax, n_twice) if by_word else 1.0),
        "rid bigint, id string, held boolean, n_tokens bigint, n_known bigint, base double, score double")
    return scored.groupBy("rid", "id", "held").agg(F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("base").alias("base_score"),
                                                   F.sum("score").alias("score")).withColumn("train_tokens", F.lit(n_tokens).cast("bigint")).drop("rid")


def katz_report(docs: DataFrame) -> DataFrame:
    """Scores of all documents; those whose crc32(doc_id as text) mod 7 is 2 are held out."""
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    s = katz_scores(docs.select("doc_id", "text"), held, by_word=True)
    return s.select(F.col("id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), F.col("held").alias("held_out"),
                    "n_tokens", "n_known", "train_tokens", "base_score", "score")
