"""Defined results on nulls, empties, long texts, ties, repeated rows, clashing columns, empty tables."""
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import chat, katz, licenses, packing, passages, pii, quality, secrets, simhash, winnow

from .common import edge_table, empty_table

N = 12  # rows of the edge table


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "other text"), (2, None), (None, "alpha beta"), (3, "")], "item_id int, text string").cache()


@pytest.fixture(scope="module")
def docs(spark):
    return edge_table(spark).cache()


def test_secrets(docs):
    r = {(x.doc_id, x.n_assign) for x in secrets.secret_report(docs).collect()}
    assert (8, 1) in r and (None, 0) in r and secrets.secret_report(docs).count() == N


def test_quality(docs):
    rows = quality.quality_report(docs).collect()
    assert len(rows) == N
    assert {x.doc_id: (x.n_words, x.n_repeat_words, x.base_failed) for x in rows}[7] == (6000, 6000, True)
    assert all(x.base_failed for x in rows if x.doc_id in (None, 1, 2, 3, 4))
    kept = quality.quality_filter(docs)
    assert kept.columns == docs.columns
    assert {x.doc_id for x in kept.select("doc_id").collect()} <= {5}


def test_pii(docs):
    rows = pii.pii_report(docs).collect()
    assert len(rows) == N and sum(x.n_email for x in rows) == 1 and sum(x.n_phone for x in rows) == 1
    clean = pii.redact(docs)
    assert clean.columns == docs.columns and clean.count() == N
    got = [x.text for x in clean.where("doc_id = 8").collect()]
    assert got == ["mail [EMAIL] and token=abcdefgh12345678 under the MIT License, é ü \U0001F600 [PHONE]"]
    assert clean.where("text is null").count() == 2


def test_licenses(spark, docs):
    rows = licenses.license_report(docs, spark).collect()
    assert len(rows) == N                          # judged once, returned per row
    assert {x.doc_id: x.labels for x in rows}[8] == "mit"
    assert {x.doc_id: (x.n_words, x.first_word, x.score) for x in rows}[1] == (0, None, 0.0)


def test_simhash(docs):
    rows = simhash.simhash_report(docs).collect()
    assert len(rows) == N
    by = {(x.doc_id, x.fingerprint): x.component_id for x in rows}
    assert by[(1, "0" * 16)] == by[(2, "0" * 16)] == by[(3, "0" * 16)] == by[(None, "0" * 16)] == 1
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [x.doc_id for x in kept.select("doc_id").collect()]
    # id 4 stands for "alpha beta gamma" and for "other text": a row of each class stays
    assert sorted(ids) == [1, 4, 4, 5, 6, 7, 8]
    assert kept.collect() == kept.collect()


def test_winnow(docs, bench):
    rows = winnow.decontamination_report(docs, bench).collect()
    assert len(rows) == N and sum(x.doc_id == 4 and x.n_words == 3 for x in rows) == 2
    hit = {(x.doc_id, x.n_words): x.n_hit for x in rows if x.contaminated}
    assert hit == {(4, 2): 2}                      # null item ids are ignored
    kept = winnow.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == N - 1


def test_winnow_blocks_are_bounded(spark, bench):
    """A preamble that all items share: every block within its bytes, same result as one block."""
    pre = " ".join(f"pre{i}" for i in range(14))
    items = spark.createDataFrame([(i, f"{pre} item{i} " + " ".join(f"t{i}x{j}" for j in range(12))) for i in range(300)], "item_id int, text string")
    d = spark.createDataFrame([(1, f"so {pre} it goes"), (2, "nothing here at all"), (3, "see item7 " + " ".join(f"t7x{j}" for j in range(12)))], "doc_id int, text string")

    def rows(**kw):
        return {x.key.id: (x.n_words, x.n_hit, tuple(x["items"])) for x in winnow.contaminated_words(d, items, **kw).collect()}

    got = rows(block_bytes=100_000)
    assert got == rows()
    assert got["1"][:2] == (17, 14) and len(got["1"][2]) == 300 and got["2"] == (4, 0, ()) and got["3"] == (14, 13, ("7",))


def test_packing(docs):
    rows = packing.pack(docs).collect()
    assert sum(x.n_tokens for x in rows if x.doc_id == 5) == 40_000
    assert sum(x.n_tokens for x in rows if x.doc_id == 4) == 8      # both repeated rows and the other text
    assert not [x for x in rows if x.doc_id in (1, 2, 3)]
    assert len({(x.bucket, x.batch, x.slot) for x in rows}) == len(rows)


def test_katz(docs):
    rows = katz.katz_report(docs).collect()
    assert len(rows) == N
    assert all(x.n_tokens == 1 for x in rows if x.doc_id in (1, 2, 3))
    assert all(x.score < 0 and x.base_score < 0 for x in rows)


def test_passages(docs):
    assert passages.passage_report(docs).count() == 0       # only one document repeats itself
    twice = docs.unionByName(docs.where("doc_id = 5").withColumn("doc_id", F.lit(9).cast("bigint")))
    got = {x.doc_id: (x.class_id, x.n_docs, x.passages) for x in passages.passage_report(twice).collect()}
    assert got == {5: (5, 2, "0:40000"), 9: (5, 2, "0:40000")}


def test_chat(spark):
    rows = [(1, 0, "user", "hi?"), (1, 1, "assistant", "hello there my friend"), (1, 1, "assistant", "hello there my friend"), (1, None, None, None),
            (None, 0, "user", ""), (2, 5, "bogus", "Assistant: fine"), (1, 2, "user", "User: ok")]
    c = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    out = chat.render(chat.decode(c, chat.fit(c))).collect()
    assert len(out) == 6                           # identical rows count once
    assert {x.conv_id: x.role for x in out if x.conv_id == 2} == {2: "assistant"}
    assert {x.rendered for x in out if x.conv_id == 2} == {"<|assistant|>\nfine\n"}
    assert chat.chat_report(c.limit(0)).count() == 0
    # Very long texts, one conversation of null ids, columns named like internal ones.
    long = [(None, None, "user", "word " * 30_000 + "\n" + "\n".join(f"line {i}" for i in range(3_000)), 7, "x")] + [(None, i, "assistant", f"t{i}", 7, "x") for i in range(50)]
    d = spark.createDataFrame(long, "conv_id int, turn int, role string, text string, line int, row string")
    got = chat.chat_report(d).collect()
    assert len(got) == 3_051 and sorted(x.pos for x in got) == list(range(3_051))


def test_empty_tables(spark, bench):
    e = empty_table(spark)
    assert secrets.secret_report(e).count() == 0
    assert quality.quality_report(e).count() == 0
    assert pii.pii_report(e).count() == 0
    assert licenses.license_report(e, spark).count() == 0
    assert simhash.simhash_report(e).count() == 0
    assert winnow.decontamination_report(e, bench).count() == 0
    assert packing.pack(e).count() == 0
    assert katz.katz_report(e).count() == 0
    assert passages.passage_report(e).count() == 0
    assert winnow.decontamination_report(edge_table(spark), bench.limit(0)).where("contaminated").count() == 0


def test_stages_on_edges(spark, docs, tmp_path):
    bench_dir = str(tmp_path)
    spark.createDataFrame([(1, "alpha beta gamma")], "item_id int, text string").write.parquet(bench_dir + "/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, bench_dir)
        if name == "packing":
            assert sum(r.n_tokens for r in got.collect() if r.doc_id == 5) == 40_000
        else:
            assert got.columns == docs.columns, name
        assert stage(spark, empty_table(spark), bench_dir).count() == 0, name


def test_quality_bounds_follow_the_source(spark):
    """The same text, in a source where its symbols are usual and in one where they are not."""
    prose = " ".join(f"word{i}" for i in range(60))

    def text(n):
        return prose + " " + " ".join(["#tag"] * n) + " " + " ".join(f"z{i}" for i in range(40))

    rows = [(s * 100 + i, text(20 + i if s else 0), "en", f"s{s}") for s in (0, 1) for i in range(40)]
    rows += [(900, text(100), "en", "s0"), (901, text(100), "en", "s1")]
    d = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")
    got = {x.doc_id: (x.kept, x.failed_rules) for x in quality.judge(quality.with_measures(d)).collect()}
    assert not got[900][0] and "symbol_share_high" in got[900][1]
    assert "symbol_share_high" not in got[901][1]
    assert all("symbol_share_high" not in got[100 + i][1] for i in range(40))
    assert quality.fit_bounds(quality.with_measures(d)).where("level = 0").count() == 2


def test_packing_one_id_of_most_rows(spark):
    """A repeated id, or null, with most of the rows: places without gaps, the same on another partitioning."""
    rows = [(None if i % 3 else 7, " ".join(["w"] * (1 + i % 5))) for i in range(3_000)] + [(i, "a b") for i in range(100, 200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    def packed(d):
        return sorted(map(str, packing.pack(d, buckets=2, batch_tokens=50).collect()))
    got = packing.pack(docs, buckets=2, batch_tokens=50).collect()
    for bucket in {x.bucket for x in got}:
        per = max(50 // bucket, 1)
        assert sorted(x.batch * per + x.slot for x in got if x.bucket == bucket) == list(range(sum(x.bucket == bucket for x in got)))
    assert len(got) == len(rows) and packed(docs) == packed(docs.repartition(7))
