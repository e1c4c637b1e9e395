"""Small tables and brute-force versions for the llm tests."""
from __future__ import annotations

import itertools
import re

import duckdb
import numpy as np
import pandas as pd
import xxhash

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, words string, key int, row string, p double"


def edge_rows():
    """Nulls in every column, empty and very long texts, repeated rows, shared
    ids, and extra columns named like internal ones."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(40_000))
    base = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t\n\r ", None, None, 3), (None, "alpha beta gamma", "en", "a", 16),
        (None, None, None, None, None), (4, "alpha beta gamma", "en", "a", 16), (4, "alpha beta gamma", "en", "a", 16), (4, "other text", "en", "b", 10),
        (5, long, "de", "a", len(long)), (6, "x" * 50_000, "de", "a", 50_000), (7, "same same " * 3_000, "de", "b", 30_000),
        (8, "mail a.b@c.de and token=abcdefgh12345678 under the MIT License, é ü \U0001F600 +1 (234) 567-8901", "fr", "a", 70),
    ]
    return [(*r, "w", 1, "r", 0.5) for r in base]


def edge_table(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def empty_table(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


def ascii_lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def space_words(t):
    return re.findall("[^\x20\x09-\x0d]+", ascii_lower(t))


def alnum_words(t):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", ascii_lower(t))


def simhash(t, k=3):
    w = space_words(t)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(ids, links):
    """Smallest id reachable, by a plain union."""
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def simhash_classes(texts, bits=2):
    fp = {i: simhash(t) for i, t in texts.items()}
    return fp, classes(texts, [(a, b) for a, b in itertools.combinations(sorted(fp), 2) if bin(fp[a] ^ fp[b]).count("1") <= bits])


def duck(**tables: pd.DataFrame):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df)
    return con


def same(a: pd.DataFrame, b: pd.DataFrame) -> None:
    """Equal rows in any order."""
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)

    def rows(df):
        return sorted((tuple(None if v is None or v is pd.NA or v != v else v.item() if isinstance(v, np.generic) else v for v in r)
                       for r in df[cols].itertuples(index=False, name=None)), key=str)
    assert rows(a) == rows(b)
