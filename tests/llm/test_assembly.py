"""Manifest, fill-in-middle and BPE against plain versions, and on edges."""
import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import bpe, fim, merkle
from tidewatch.llm.sql import ORACLE_SQL

from .common import SCHEMA, SF, edge_rows, edge_table, empty_table


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n, text):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)))


def tree(nodes):
    """Root and, per leaf, its siblings with their side, bottom up."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for p, i in zip(paths, at):
            p.append(("L", nodes[i - 1]) if i % 2 else ("R", nodes[i + 1]) if i + 1 < len(nodes) else ("", ""))
        nodes, at = [H(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)], [i // 2 for i in at]
    return (nodes or [None])[0], paths


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of (doc_id, text, lang, source, n_chars, ...)."""
    by = {}
    for doc_id, text, lang, source, n, *_ in rows:
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n is not None
        by.setdefault("" if lang is None else "=" + lang, []).append((doc_id is not None, doc_id or 0, leaf_of(doc_id, source, lang, n, text), doc_id, leaf_of(doc_id, source, lang, n + 1 if hit else n, text)))
    trees = {k: tree([x[2] for x in sorted(v, key=lambda x: x[:3])]) for k, v in by.items()}
    root, tops = tree([trees[k][0] for k in sorted(trees)])
    out = []
    for (k, (sub, paths)), top in zip(sorted(trees.items()), tops):
        for x, path in zip(sorted(by[k], key=lambda x: x[:3]), paths):
            acc = x[4]
            for side, d in path + top:
                acc = H(d, acc) if side == "L" else H(acc, d)
            out.append((x[3], x[2], sub, root, H(*(d for _, d in path + top)), acc, acc == root))
    return out


def found(df):
    return [tuple(r) for r in df.collect()]


def key(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("levels", [1, 2, 10])
def test_manifest_equals_plain_trees(spark, levels):
    """All sizes from one leaf to several tiers of blocks; repeated ids and rows, many languages."""
    rng = random.Random(levels)
    rows = [(rng.randrange(40) if rng.random() < 0.9 else None, rng.choice(["a", "b", None, "é"]), lang, "s", rng.choice([1, 2, None]))
            for lang, n in ((None, 1), ("en", 41), ("de", 2), ("fr", 17), ("é", 3), ("zz", 16)) for _ in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(5)
    proof = F.sha2(F.array_join(F.transform("path", lambda x: F.substring(x, 2, 64)), ""), 256)
    got = merkle.manifest(merkle.leaves(docs), levels).select("doc_id", "leaf", "subroot", "root", proof, merkle.fold(F.col("path"), F.col("other")).alias("f"))
    assert key(found(got.withColumn("v", F.col("f") == F.col("root")))) == key(plain_manifest(rows))


def test_manifest_edges(spark):
    assert key(found(merkle.manifest_report(edge_table(spark)))) == key(plain_manifest(edge_rows()))
    assert merkle.manifest_report(empty_table(spark)).count() == 0
    one = spark.createDataFrame([(7, "x", None, None, 1)], "doc_id long, text string, lang string, source string, n_chars int")
    r = merkle.manifest_report(one).first()
    assert r.leaf == r.subroot == r.root and r.proof_sha256 == H()


def test_manifest_finds_what_was_tampered_with(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    r = merkle.manifest_report(docs).select("doc_id", "verified").collect()
    assert {x.doc_id for x in r if not x.verified} == {x.doc_id for x in r if zlib.crc32(str(x.doc_id).encode()) % 7 == 0}


def plain_fim(doc_id, text):
    import re
    text = text or ""
    u = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.S)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 90:
        return doc_id, len(u), "plain", None, None, H(text), H(text), text
    form = "spm" if h[3] % 100 < 20 else "psm"
    out = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(u), form, len(p), len(m), H(out), H(text), out


@pytest.mark.parametrize("chunk", [1, 3, 4096])
def test_fim_equals_plain_version(spark, chunk):
    rng = random.Random(chunk)
    parts = ["word", " ", "<", "P", "<S", "M>", ">", "é", "\U0001F600", "\n", "", "1"]
    rows = [(i if i % 9 else None, "".join(rng.choice(parts) for _ in range(rng.randrange(30)))) for i in range(300)]
    rows += [(1000 + i, t) for i, t in enumerate(["has <P> in it", "<M>", None, "", "<P", "a" * 9_000 + " b" * 9_000])]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = [plain_fim(*r) for r in rows]
    assert key(found(fim.fim_report(d, chunk))) == key([w[:7] for w in want])
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert key(found(fim.fim_texts(d, chunk))) == key([(w[0], w[2], w[7]) for w in want])


def test_fim_edges(spark):
    assert key(found(fim.fim_report(edge_table(spark)))) == key([plain_fim(*r[:2])[:7] for r in edge_rows()])
    assert fim.fim_report(empty_table(spark)).count() == 0


def test_fim_sorts_again_without_a_second_shuffle(spark):
    plan = fim.fim_report(edge_table(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def reference(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(bpe.tokenizer_path())
    t.no_truncation()
    t.no_padding()
    out = []
    for x in texts:
        ids = t.encode(x or "", add_special_tokens=False).ids
        out.append((len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return out


HARD = ["Hello WORLD's it'll we've <|endoftext|>x<|startoftext|>y", "<|endoftext", "  \x0b a\x85b c\x1cd\x00\x01", "ΣΑΣ İstanbul é ̈́ ﬁ", "x" * 5000,
        "ab1" * 3000, "日本語 😀👍🏽 don't 123", "é" * 700, "'s's'S 'LL", " 　wide space", "", None, " \n\t "]


def test_bpe_equals_the_library(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(10_000 + i, t) for i, t in enumerate(HARD)] + [r[:2] for r in edge_rows()]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert key(found(bpe.bpe_report(d))) == key([(r[0], *x) for r, x in zip(rows, reference([t for _, t in rows]))])
    assert bpe.bpe_report(empty_table(spark)).count() == 0 and bpe.bpe_report(edge_table(spark)).columns[0] == "doc_id"


def test_one_tree_and_a_forest_merge_alike():
    v = bpe.Vocabulary(bpe.tokenizer_path())
    rng = random.Random(3)
    words = [bytes(rng.choice(b"aeinorst\xc3\xa9") for _ in range(rng.randrange(1, 70))) for _ in range(500)]
    assert bpe.merge_forest(words, v) == [bpe.merge_tree(w, v) for w in words]


def test_bpe_memo_is_bounded():
    e = bpe.Encoder(bpe.tokenizer_path(), memo=50)
    whole = bpe.Encoder(bpe.tokenizer_path())
    for i in range(20):
        text = " ".join(f"w{i}x{j}" for j in range(30))
        assert e([text]) == whole([text])
        assert len(e.chunks) <= 50 + 31


@pytest.mark.parametrize("name, run", [("op11_merkle_manifest", merkle.manifest_report), ("op12_fill_in_middle", fim.fim_report)])
def test_sql_holds_on_edges_too(spark, name, run):
    docs = spark.createDataFrame(edge_rows(), SCHEMA)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    got = run(docs)
    assert key(found(got)) == key(con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLE_SQL[name]})").fetchall())
