"""U1's learned model: counts, probabilities, saving, held-out accuracy, edges."""
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidewatch.functions import learned
from tidewatch.functions import sentiment as st
from tidewatch.plans import catalog

from .conftest import SF001
from .test_oracle import con, norm  # noqa: F401

ROWS = [("Gains rise, gains hold", "positive"), ("gains", "positive"), ("Losses DEEPEN", "negative"), ("losses", "negative"),
        ("talks", "neutral"), (None, "neutral"), ("", "positive"), ("ignored", "other"), ("ignored", None)]


def table(spark, rows=ROWS):
    return spark.createDataFrame(rows, "text string, label string")


def test_probabilities_by_hand(spark):
    words = {c: Counter(w.lower() for t, label in ROWS if label == c for w in re.findall("[A-Za-z]+", t or "")) for c in learned.CLASSES}
    texts = Counter(label for _, label in ROWS if label in learned.CLASSES)
    total = sum(w.total() for w in words.values())

    def pooled(word):
        return (sum(w[word] for w in words.values()) + 1) / (total + learned.FEATURES)
    model = learned.WordModel.from_counts(learned.fit_counts(table(spark)))
    for text in ("gains gains talks", "losses é losses", "unseen", "", "Losses. " * 3_000):
        score = {c: math.log((texts[c] + 1) / (sum(texts.values()) + 3)) + sum(
            math.log((words[c][w.lower()] + learned.FEATURES * pooled(w.lower())) / (words[c].total() + learned.FEATURES))
            for w in re.findall("[A-Za-z]+", text)) for c in learned.CLASSES}
        top = max(score.values())
        label = max(learned.CLASSES, key=score.get)
        got, share = model([text])[0]
        assert got == label and share == pytest.approx(1 / sum(math.exp(s - top) for s in score.values()))


def test_saved_counts_give_the_same_model(spark, tmp_path):
    counts = learned.fit_counts(table(spark))
    counts.write.parquet(str(tmp_path / "model"))
    a, b = learned.WordModel.from_counts(counts), learned.WordModel.from_counts(spark.read.parquet(str(tmp_path / "model")))
    assert (a.prior == b.prior).all() and (a.weights == b.weights).all()


def test_without_training_rows(spark):
    load = learned.loader(learned.fit_counts(table(spark, [])))
    got = table(spark, [("gains", None), (None, None)]).select(st.model_scorer(load)(F.col("text")).alias("m")).select("m.*").collect()
    assert [(r.label, r.score) for r in got] == [("neutral", 0.0)] * 2
    assert got[0].confidence == pytest.approx(1 / 3)


def test_tells_held_out_documents_apart(spark):
    """Mean recall of the three classes on documents outside the training rows; chance is 1/3."""
    sf = SF001.replace("0.001", "0.1")
    rows = catalog.sentiment_labels(spark, sf).withColumn("out", F.crc32(F.md5(F.col("text").cast("binary")).cast("binary")) % 4 == 1)
    load = learned.loader(learned.fit_counts(rows.where("not out")))
    got = rows.where("out").select("label", st.model_scorer(load)(F.col("text"))["label"].alias("said")).collect()
    of = Counter(r.label for r in got)
    right = Counter(r.label for r in got if r.label == r.said)
    recall = {c: right[c] / of[c] for c in learned.CLASSES}
    assert sum(recall.values()) / 3 > 0.4, recall


@pytest.mark.parametrize("name", ["u01_model_scorer", "u02_three_methods"])
def test_queries_match_oracle(spark, con, name):  # noqa: F811
    df = entry.queries()[name](spark, SF001)
    cols = sorted(df.columns)
    d = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(d.columns) == cols
    got = norm(df.select(*cols).toPandas().itertuples(index=False, name=None))
    assert got == norm(d[cols].itertuples(index=False, name=None)) and len({r[cols.index("label")] for r in got}) > 1
