"""Shared text helpers of the llm operators.

Two families: Column expressions (used by the operators that run on built-in
functions only) and byte-level helpers for code that runs inside Arrow tasks.
Words follow one of two definitions, both given by byte ranges:

* space words: maximal runs without space, tab, newline, VT, FF, CR;
* alnum words: maximal runs of ASCII letters, digits and non-ASCII characters.
"""
from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE_CLASS = r"[\x20\x09-\x0D]"
# Elements handled per inner fold: keeps the appending folds below linear in
# practice for texts with very many matches.
FOLD_CHUNK = 256

_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_ALNUM_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 97 <= b <= 122 or 48 <= b <= 57 else 32
    for b in range(256))


# ---- Column expressions -----------------------------------------------------

def let(value: Column, body) -> Column:
    """Bind ``value`` once for ``body`` (a lambda over the bound column)."""
    return F.transform(F.array(value), body)[0]


def space_words(text: Column) -> Column:
    """Space words of a text; null or empty text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), "")


def spans(text: Column, pattern: str, gate: str | None = None) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` as
    array<struct<s bigint, e bigint, m string>>, code points, end exclusive.

    ``split`` gives the text between the matches and ``regexp_extract_all``
    the matches; a fold over their lengths gives the offsets.  The fold works
    on chunks of FOLD_CHUNK matches, so a text with very many matches costs
    no quadratic copying.  Texts without a match skip all of it.
    """
    kind = "array<struct<s:bigint,e:bigint,m:string>>"
    pat = F.lit(pattern)

    def build(x: Column) -> Column:
        pieces = F.transform(x["m"], lambda m, i: F.struct(
            F.length(x["g"][i]).cast("bigint").alias("g"), F.length(m).cast("bigint").alias("n"), m.alias("m")))

        def step(acc, p):
            s = acc["pos"] + p["g"]
            return F.struct((s + p["n"]).alias("pos"),
                            F.concat(acc["out"], F.array(F.struct(s.alias("s"), (s + p["n"]).alias("e"), p["m"].alias("m")))).alias("out"))

        def fold(chunk):
            return F.aggregate(chunk, F.struct(F.lit(0).cast("bigint").alias("pos"), F.array().cast(kind).alias("out")), step)

        def join(acc, c):
            moved = F.transform(c["out"], lambda p: F.struct((p["s"] + acc["pos"]).alias("s"), (p["e"] + acc["pos"]).alias("e"), p["m"].alias("m")))
            return F.struct((acc["pos"] + c["pos"]).alias("pos"), F.concat(acc["out"], F.array(moved)).alias("out"))

        chunks = let(pieces, lambda ps: F.transform(
            F.sequence(F.lit(0), F.size(ps) - 1, F.lit(FOLD_CHUNK)),
            lambda at: fold(F.slice(ps, at + 1, FOLD_CHUNK))))
        return F.flatten(F.aggregate(
            chunks, F.struct(F.lit(0).cast("bigint").alias("pos"), F.array().cast(f"array<{kind}>").alias("out")), join)["out"])

    found = let(F.struct(F.regexp_extract_all(text, pat, F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("g")), build)
    hit = text.rlike(pattern) if gate is None else F.when(text.rlike(gate), text.rlike(pattern))
    return F.when(hit, found).otherwise(F.array().cast(kind))


def per_row(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """doc_id of every row of ``docs`` with the result of its (id, text), which
    ``judged`` holds once under ``key`` struct<id string, h = xxhash64(text)>.
    Only ids and hashes of the documents are shuffled."""
    rows = docs.select("doc_id", F.col("doc_id").cast("string").alias("_id"), F.xxhash64("text").alias("_h"))
    return rows.join(judged, F.col("_id").eqNullSafe(F.col("key.id")) & (F.col("_h") == F.col("key.h")))


def span_digest(labelled: Column) -> Column:
    """'kind:start:end' strings of an array of structs (kind, s, e), joined by commas."""
    return F.array_join(F.transform(labelled, lambda x: F.concat_ws(
        ":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


# ---- inside Arrow tasks ------------------------------------------------------

def lower_space_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased, then space words (bytes.split uses the same six separators)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def lower_alnum_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased, then alnum words."""
    return text.encode("utf-8", "surrogatepass").translate(_ALNUM_TABLE).split() if text else []


class WordHasher:
    """64-bit word hashes with a bounded memo (it is emptied when full)."""

    def __init__(self, limit: int = 300_000):
        self.memo: dict[bytes, int] = {}
        self.limit = limit

    def __call__(self, words: list[bytes]) -> np.ndarray:
        memo, digest = self.memo, xxhash.xxh64_intdigest
        if len(memo) > self.limit:
            memo.clear()
        out = np.empty(len(words), dtype=np.uint64)
        for i, w in enumerate(words):
            h = memo.get(w)
            if h is None:
                h = memo[w] = digest(w)
            out[i] = h
        return out


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a 64-bit value over all bits (wrap-around arithmetic)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive word hashes (empty if there are fewer)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    acc = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + h[j:j + n] + np.uint64(j + 1))
    return acc


def word_hashes(words: list[bytes]) -> np.ndarray:
    """What WordHasher gives, without a memo: texts of many rare words outgrow its cache."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def gram_runs(runs: list[np.ndarray], k: int) -> list[np.ndarray]:
    """``gram_hashes`` of each of several runs of word hashes, made together."""
    grams = gram_hashes(np.concatenate(runs), k) if runs else []
    starts = np.cumsum([0, *map(len, runs)]).tolist()
    return [grams[at:at + max(len(r) - k + 1, 0)] for at, r in zip(starts, runs)]
