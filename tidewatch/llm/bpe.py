"""Operator 13, BPE encoding and decoding with segment trees.

Over the symbols of a word stands a segment tree whose leaves are the ranks of
adjacent pairs.  Its root is the leftmost pair of the lowest rank; merging it
changes three leaves, so a merge costs logarithmic time, also in a word of a
million letters.  Many words are merged side by side: their trees are the rows
of one array (a forest), and a round takes one merge in every tree.

Text between white space is encoded once per task and kept in a bounded
memo; nothing is shuffled.
"""
from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "word_bpe_49k.json"   # of the public_tokenizers package
MEMO = 300_000                    # words, and texts between white space, that a task keeps
GROUP_CHARS = 1 << 20             # characters whose words are merged together
FOREST_CELLS = 1 << 18            # leaves of a forest
FOREST_ROWS = 48                  # fewer words are merged one by one
_DONE = np.iinfo(np.int64).max


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_chars() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    itself where it is printable, else the next from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b if b in own else spare))
        spare += b not in own
    return out


def token_names(spec: dict) -> list[str]:
    """The string of each id."""
    names = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    return [names.get(i, "") for i in range(max(names) + 1)]


def _load(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


class Vocabulary:
    """A byte-level BPE file of the tokenizers library: ids of single bytes,
    ranks of pairs, and its own normaliser and splitting pattern."""

    def __init__(self, path: str):
        from tokenizers import Regex, Tokenizer, pre_tokenizers
        spec = _load(path)
        model, steps = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        if model["type"] != "BPE" or model["unk_token"] or model["continuing_subword_prefix"] or [s["type"] for s in steps] != ["Split", "ByteLevel"]:
            raise ValueError(f"{path}: not a byte-level BPE with a splitting pattern")
        pattern = steps[0]["pattern"]["Regex"]
        self._normalise = Tokenizer.from_file(path).normalizer.normalize_str
        self._split = pre_tokenizers.Split(Regex(pattern), steps[0]["behavior"].lower(), steps[0]["invert"]).pre_tokenize_str
        # Printable ASCII between white space needs no library: there the
        # classes are plain and these normalisers only lower the case.
        plain = [n["type"] for n in spec["normalizer"]["normalizers"]] == ["NFC", "Replace", "Lowercase"]
        ascii_pattern = pattern.replace(r"\p{L}", "a-zA-Z").replace(r"\p{N}", "0-9")
        self._ascii = re.compile(ascii_pattern, re.ASCII).findall if plain and steps[0]["invert"] and "\\p" not in ascii_pattern and "(" not in pattern else None
        ids, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        chars = _byte_chars()
        self.inner = np.array([ids[c] for c in chars])
        self.last = np.array([ids[c + end] for c in chars])
        pairs = np.array([[ids[a], ids[b], ids[a + b]] for a, b in model["merges"]])
        self.width = max(ids.values()) + 1
        key = pairs[:, 0] * self.width + pairs[:, 1]
        order = np.argsort(key)
        self.pair, self.pair_rank, self.merged = key[order], order, pairs[:, 2]
        self.by_pair = dict(zip(key.tolist(), range(len(key))))

    def words(self, text: str) -> list[bytes]:
        """Words of text without white space of the usual kinds."""
        if self._ascii and text.isascii() and text.isprintable():
            return [w.encode() for w in self._ascii(text.lower())]
        return [w.encode() for w, _ in self._split(self._normalise(text))]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, -1 for none."""
        key = a * self.width + b
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.pair_rank[at], -1)


def merge_tree(word: bytes, vocabulary: Vocabulary) -> bytes:
    """Token ids of one word."""
    n = len(word)
    size = 1 << (n - 1).bit_length()
    sym = vocabulary.inner[np.frombuffer(word, np.uint8)]
    sym[-1] = vocabulary.last[word[-1]]
    rank = vocabulary.ranks(sym[:-1], sym[1:])
    leaves = np.full(size, _DONE)
    leaves[:n - 1] = np.where(rank >= 0, rank * size + np.arange(n - 1), _DONE)
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
    tree = [_DONE, *np.concatenate(levels[::-1]).tolist()]
    sym, after, before = sym.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
    width, known = vocabulary.width, vocabulary.by_pair

    def update(at, key):
        node = at + size
        tree[node] = key
        while node > 1:
            key = min(tree[node], tree[node ^ 1])
            node >>= 1
            if tree[node] == key:
                break
            tree[node] = key

    def pair_key(left, right):
        rank = known.get(sym[left] * width + sym[right])
        return _DONE if rank is None else rank * size + left

    while tree[1] != _DONE:
        rank, i = divmod(tree[1], size)
        j = after[i]
        sym[i], sym[j] = int(vocabulary.merged[rank]), -1
        k = after[i] = after[j]
        update(j, _DONE)
        if k < n:
            before[k] = i
        update(i, pair_key(i, k) if k < n else _DONE)
        if before[i] >= 0:
            update(before[i], pair_key(before[i], i))
    return np.array([x for x in sym if x >= 0], "<u4").tobytes()


def merge_forest(words: list[bytes], vocabulary: Vocabulary) -> list[bytes]:
    """Token ids of every word.  The trees have as many leaves as the longest
    word needs."""
    n = np.array([len(w) for w in words])
    size = 1 << max(1, int(n.max() - 1).bit_length())
    rows, place = np.arange(len(words)), np.arange(size)
    raw = np.frombuffer(b"".join(w.ljust(size, b"\0") for w in words), np.uint8).reshape(-1, size)
    sym = vocabulary.inner[raw]
    sym[rows, n - 1] = vocabulary.last[raw[rows, n - 1]]
    live = place < n[:, None]
    after = np.broadcast_to(place + 1, sym.shape).copy()     # n or more: none
    before = np.broadcast_to(place - 1, sym.shape).copy()    # -1: none

    tree = np.full((len(words), 2 * size), _DONE)
    rank = vocabulary.ranks(sym[:, :-1], sym[:, 1:])
    tree[:, size:-1] = np.where(live[:, 1:] & (rank >= 0), rank * size + place[:-1], _DONE)
    k = size
    while k > 1:
        k //= 2
        tree[:, k:2 * k] = np.minimum(tree[:, 2 * k:4 * k:2], tree[:, 2 * k + 1:4 * k:2])

    def update(row, at, key):
        node = at + size
        tree[row, node] = key
        while node[0] > 1:
            node = node >> 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

    def pair_key(row, left, right):
        rank = vocabulary.ranks(sym[row, left], sym[row, right])
        return np.where(rank >= 0, rank * size + left, _DONE)

    row = rows
    while True:
        root = tree[row, 1]
        row, root = row[root != _DONE], root[root != _DONE]
        if not len(row):
            break
        rank, i = root // size, root % size
        j = after[row, i]
        sym[row, i] = vocabulary.merged[rank]
        live[row, j] = False
        k = after[row, i] = after[row, j]
        update(row, j, np.full(len(row), _DONE))
        has = k < n[row]
        before[row[has], k[has]] = i[has]
        key = np.full(len(row), _DONE)
        key[has] = pair_key(row[has], i[has], k[has])
        update(row, i, key)
        p = before[row, i]
        has = p >= 0
        if has.any():
            update(row[has], p[has], pair_key(row[has], p[has], i[has]))
    flat, cuts = sym[live].astype("<u4").tobytes(), [0, *(4 * np.cumsum(live.sum(axis=1))).tolist()]
    return [flat[a:b] for a, b in zip(cuts, cuts[1:])]


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, memo: int = MEMO):
        self.vocabulary, self.limit = Vocabulary(path), memo
        self.words: dict[bytes, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def _pieces(self, chunk: str) -> list[bytes | int]:
        """Words and special ids of the text between white space.  Special
        tokens are found before anything is normalised."""
        v, at, out = self.vocabulary, 0, []
        for m in v.special_re.finditer(chunk):
            out += [*v.words(chunk[at:m.start()]), v.special[m.group()]]
            at = m.end()
        return out + v.words(chunk[at:]) if at else v.words(chunk)

    def _merge(self, words: set[bytes]) -> None:
        by_size: dict[int, list[bytes]] = {}
        for w in words:
            by_size.setdefault(max(1, (len(w) - 1).bit_length()), []).append(w)
        for bits, group in by_size.items():
            step = max(1, FOREST_CELLS >> bits)
            for i in range(0, len(group), step):
                part = group[i:i + step]
                merged = merge_forest(part, self.vocabulary) if len(part) >= FOREST_ROWS else [merge_tree(w, self.vocabulary) for w in part]
                self.words.update(zip(part, merged))

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > self.limit or len(self.chunks) > self.limit:
            self.words.clear()
            self.chunks.clear()
        # White space that also ends a word for the pattern; the rest is left to it.
        split = [re.split("[ \t\n\r]+", t) for t in texts]
        new = {c for s in split for c in s if c not in self.chunks}
        pieces = {c: self._pieces(c) for c in new}
        self._merge({p for ps in pieces.values() for p in ps if isinstance(p, bytes) and p not in self.words})
        for c, ps in pieces.items():
            self.chunks[c] = b"".join(self.words[p] if isinstance(p, bytes) else p.to_bytes(4, "little") for p in ps)
        return [b"".join(map(self.chunks.__getitem__, s)) for s in split]


def _groups(texts: list[str | None]) -> Iterator[list[str]]:
    """Consecutive texts of GROUP_CHARS characters (or one longer text)."""
    held, n = [], 0
    for t in texts:
        held.append(t or "")
        n += len(held[-1])
        if n >= GROUP_CHARS:
            yield held
            held, n = [], 0
    if held:
        yield held


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for b in batches:
            at = 0
            for group in _groups(b.column("text").to_pylist()):
                ids = encoder(group)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(at, len(group)), pa.array([len(x) // 4 for x in ids], pa.int64()),
                                                  pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"])
                at += len(group)
    return run


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = token_names(_load(path))

        def text(ids: bytes) -> str:
            return " ".join(map(names.__getitem__, np.frombuffer(ids, "<u4").tolist()))

        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                decoded = pa.array([text(x or b"") for x in part.column("ids").to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], names=[*b.schema.names, "decoded"])
    return run


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids): the tokens of every whole text, without special
    tokens of a template, ids as little-endian unsigned 32-bit integers.

    A special token spelled out in a text is that token.  Null and empty texts
    have no tokens; every row is encoded, also repeated ones and null ids.
    ``path`` is a tokenizers file that every executor can open.
    """
    path = path or tokenizer_path()
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_encode(path), "doc_id bigint, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` (doc_id, n_tokens, ids) with the column ``decoded``: the
    tokens' strings joined by spaces, as for a file that names no decoder."""
    path = path or tokenizer_path()
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(_decode(path), "doc_id bigint, n_tokens bigint, ids binary, decoded string")


def bpe_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Number of tokens and digests of ids and decoded text, a row per document."""
    return decode(encode(docs, path), path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
