"""U1's learned model: naive Bayes over hashed words.

Fitting is one aggregation on Spark; the model is its count table, of at most
``(FEATURES + 1) * len(CLASSES)`` rows whatever the corpus size, so it can be
saved as Parquet, collected and broadcast.  Scoring goes through
``sentiment.model_scorer``: each task takes the broadcast weights once.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLASSES = ("neutral", "positive", "negative")    # ties go to the first
HEX_DIGITS = 4
FEATURES = 16 ** HEX_DIGITS                      # slots of the hashed words
DOCUMENT = -1                                    # slot that counts the texts of a class
WORD_RE = "[A-Za-z]+"
MEMO_WORDS = 200_000                             # words a task remembers the slot of


def fit_counts(train: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """(slot, label, n): how often the words of a slot occur in the texts of a
    class, and under slot ``DOCUMENT`` how many texts the class has.

    A word's slot is the first four hex digits of the MD5 of its lower case.
    Rows with another label or none are left out; null and empty texts count
    as texts without words; repeated rows count each.  Counts are summed before
    the shuffle, so a frequent word or class is no hot key.
    """
    def slot(word):
        return F.conv(F.substring(F.md5(F.lower(word).cast("binary")), 1, HEX_DIGITS), 16, 10).cast("int")
    words = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD_RE), F.lit(0))
    rows = train.where(F.col(label).isin(*CLASSES)).select(
        F.col(label).alias("label"), F.explode(F.concat(F.array(F.lit(DOCUMENT)), F.transform(words, slot))).alias("slot"))
    return rows.groupBy("slot", "label").agg(F.count(F.lit(1)).alias("n"))


class WordModel:
    """Maps whole texts to (label, posterior probability) pairs.

    ``prior`` and ``weights`` (a row per slot) are log probabilities.  A class
    gets ``FEATURES`` further words, spread as the words of all classes are (one
    added to each slot), so slots that are rare in all of them say little.  A
    text without words has the prior.
    """

    def __init__(self, prior: np.ndarray, weights: np.ndarray):
        self.prior, self.weights = prior, weights
        self._memo: dict[str, int] = {}

    @classmethod
    def from_counts(cls, counts: DataFrame) -> WordModel:
        """The model of a ``fit_counts`` table; without any row every class is equally likely."""
        n = np.zeros((FEATURES, len(CLASSES)))
        texts = np.zeros(len(CLASSES))
        for slot, label, k in counts.select("slot", "label", "n").collect():   # bounded, see above
            if slot == DOCUMENT:
                texts[CLASSES.index(label)] = k
            else:
                n[slot, CLASSES.index(label)] = k
        pooled = (n.sum(axis=1, keepdims=True) + 1) / (n.sum() + FEATURES)
        return cls(np.log((texts + 1) / (texts.sum() + len(CLASSES))), np.log((n + FEATURES * pooled) / (n.sum(axis=0) + FEATURES)))

    def _slot(self, word: str) -> int:
        if (at := self._memo.get(word)) is None:
            if len(self._memo) >= MEMO_WORDS:
                self._memo.clear()
            at = self._memo[word] = int(hashlib.md5(word.lower().encode()).hexdigest()[:HEX_DIGITS], 16)
        return at

    def __call__(self, texts: list[str]) -> list[tuple[str, float]]:
        out = []
        for text in texts:
            slots = np.fromiter((self._slot(w) for w in re.findall(WORD_RE, text)), np.int64)
            score = self.prior + self.weights[slots].sum(axis=0)
            share = np.exp(score - score.max())
            best = int(score.argmax())
            out.append((CLASSES[best], float(share[best] / share.sum())))
        return out


def loader(counts: DataFrame) -> Callable[[], WordModel]:
    """``load_model`` for ``sentiment.model_scorer``: the weights (3 * 65,536
    doubles, 1.5 MB) are broadcast, so a worker receives them once."""
    model = WordModel.from_counts(counts)
    sent = counts.sparkSession.sparkContext.broadcast((model.prior, model.weights))
    return lambda: WordModel(*sent.value)
