"""Operator 5, license scans by diagonal voting."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.text import WordHasher, gram_hashes, lower_alnum_words, per_row

# Fixed phrases of the base scan and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Fixed license notices, the wording of their publishers.
TEMPLATES = {
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
                  "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
                  "copies of the Software, and to permit persons to whom the Software is furnished to do so",
    "apache-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                     "compliance with the License. You may obtain a copy of the License at "
                     "http://www.apache.org/licenses/LICENSE-2.0",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                  "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                  "option) any later version.",
    "bsd-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                  "that the following conditions are met",
    "cc-by-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "mit-line": "Released under the MIT License",
    "apache-line": "Licensed under the Apache License, Version 2.0",
    "gpl-line": "This work is licensed under the GNU General Public License, version 3",
}
GRAM = 5            # words of a k-gram; shorter templates use their own length, at least 2
MERGE = 3           # diagonals this close belong to one span (inserted or missing words)
MIN_COVERAGE = 0.8  # share of the template's words a verified span must match
_KEY = "key struct<id:string,h:bigint>"


def template_grams(phrases: dict, templates: dict, gram: int = GRAM) -> list[tuple]:
    """(k, hash, template, label, is_phrase, position, length, word hashes)."""
    hasher, rows = WordHasher(), []
    for text, label, phrase in [(p, v, True) for p, v in phrases.items()] + [(t, name, False) for name, t in templates.items()]:
        words = lower_alnum_words(text)
        k = 2 if phrase else min(gram, len(words))
        for i, h in enumerate(gram_hashes(hasher(words), k).view(np.int64).tolist()):
            rows.append((k, h, ("p:" if phrase else "t:") + label, label, phrase, i, len(words),
                         hasher(words[i:i + k]).view(np.int64).tolist()))
    return rows


def _rolling(ks: list[int]):
    """Arrow task: word hashes of every text and the hashes of all its k-grams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in batches:
            hashes = [hasher(lower_alnum_words(t)) for t in b.column("text").to_pylist()]
            counts = np.array([len(h) for h in hashes], dtype=np.int64)

            def offsets(n):
                return pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())

            cols = [b.column("key"), pa.array(counts, pa.int32()),
                    pa.ListArray.from_arrays(offsets(counts), pa.array(np.concatenate(hashes).view(np.int64) if hashes else np.empty(0, np.int64)))]
            for k in ks:
                g = [gram_hashes(h, k) for h in hashes]
                cols.append(pa.ListArray.from_arrays(offsets([len(x) for x in g]), pa.array(np.concatenate(g).view(np.int64) if g else np.empty(0, np.int64))))
            yield pa.RecordBatch.from_arrays(cols, names=["key", "n_words", "words"] + [f"h{k}" for k in ks])
    return run


def license_hits(docs: DataFrame, spark: SparkSession, phrases=PHRASES, templates=TEMPLATES, gram: int = GRAM, id_col: str = "doc_id") -> DataFrame:
    """(key, n_words, template, label, is_phrase, tpos, twords, dpos): verified
    k-gram matches; one row without a template per document besides.

    Every rolling k-gram hash of every text is exploded and joined to the
    template positions, a constant table whose size the code fixes, so it is
    broadcast.  A match of hashes counts only if the words are equal.
    """
    rows = template_grams(phrases, templates, gram)
    table = F.broadcast(spark.createDataFrame(
        rows, "tk int, th bigint, template string, label string, is_phrase boolean, tpos int, twords int, tgram array<bigint>"))
    ks = sorted({r[0] for r in rows})
    schema = f"{_KEY}, n_words int, words array<bigint>, " + ", ".join(f"h{k} array<bigint>" for k in ks)
    marked = docs.select(F.struct(F.col(id_col).cast("string").alias("id"), F.xxhash64("text").alias("h")).alias("key"), "text").mapInArrow(_rolling(ks), schema)

    def tagged(k):
        return F.transform(f"h{k}", lambda h, i: F.struct(F.lit(k).alias("k"), i.alias("p"), h.alias("h")))

    none = F.array(F.struct(F.lit(0).alias("k"), F.lit(-1).alias("p"), F.lit(0).cast("bigint").alias("h")))
    grams = marked.select("key", "n_words", "words", F.explode(F.concat(none, *[tagged(k) for k in ks])).alias("g"))
    found = grams.join(table, (F.col("g.k") == F.col("tk")) & (F.col("g.h") == F.col("th")), "left").where("g.k = 0 or tpos is not null")
    same = F.col("template").isNull() | (F.slice("words", F.col("g.p") + 1, F.col("g.k")) == F.col("tgram"))
    return found.where(same).select("key", "n_words", "template", "label", "is_phrase", "tk", "tpos", "twords", F.col("g.p").alias("dpos"))


def license_spans(hits: DataFrame) -> DataFrame:
    """(key, n_words, template, label, is_phrase, start, coverage, votes):
    spans; a document's row without a template comes through as it is.

    Votes are counted per (document, template, diagonal = document position
    minus template position).  Diagonals of one template that follow each
    other by at most MERGE, and whose matches do not lie more than a template
    apart, are merged (insertions and omissions shift the diagonal); a merged
    group is one span.  Coverage is the share of the template's words that its
    verified matches cover.
    """
    who = ["key", "n_words", "template", "label", "is_phrase", "twords", "tk"]
    votes = (hits.groupBy(*who, (F.col("dpos") - F.col("tpos")).alias("diag"))
             .agg(F.min("dpos").alias("first"), F.max("dpos").alias("last"), F.collect_set("tpos").alias("tp")))
    order = Window.partitionBy("key", "template").orderBy("diag")
    apart = (F.col("is_phrase") | (F.col("diag") - F.lag("diag").over(order) > MERGE)
             | (F.col("first") - F.lag("last").over(order) > F.col("twords")))
    group = votes.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("_g", F.sum("_new").over(order))
    covered = F.size(F.array_distinct(F.flatten(F.transform("tps", lambda p: F.sequence(p, p + F.col("tk") - 1)))))
    return (group.groupBy(*who, "_g")
            .agg(F.min("diag").alias("start"), F.array_distinct(F.flatten(F.collect_list("tp"))).alias("tps"))
            .select("key", "n_words", "template", "label", "is_phrase", F.greatest("start", F.lit(0)).cast("bigint").alias("start"),
                    (covered / F.col("twords")).alias("coverage"), F.size("tps").alias("votes")))


def scan_licenses(docs: DataFrame, spark: SparkSession, phrases=PHRASES, templates=TEMPLATES, gram: int = GRAM, min_coverage: float = MIN_COVERAGE, id_col: str = "doc_id") -> DataFrame:
    """Per distinct (id, text): key, n_words, base (places of whole phrases:
    array of struct<start, label, coverage>), spans (verified template spans).

    A phrase occurs where a diagonal has every one of its bigrams.  Null and
    empty texts have no words and no spans.  Repeated rows are judged once;
    rows that share an id but not the text are kept apart.
    """
    spans = license_spans(license_hits(docs, spark, phrases, templates, gram, id_col))
    one = F.struct("start", "label", "coverage")
    return spans.groupBy("key", "n_words").agg(
        F.array_sort(F.collect_list(F.when(F.col("is_phrase") & (F.col("coverage") >= 1.0), one))).alias("base"),
        F.array_sort(F.collect_list(F.when(~F.col("is_phrase") & (F.col("coverage") >= min_coverage), one))).alias("spans"))


def license_report(docs: DataFrame, spark: SparkSession) -> DataFrame:
    """Digest columns per document; score is 1 for a whole phrase, else the
    best coverage of a verified template span, else 0.  Repeated rows give
    repeated results."""
    d = per_row(docs, scan_licenses(docs.select("doc_id", "text"), spark))

    def labels(x):
        return F.transform(x, lambda s: s["label"])

    best = F.array_max(F.transform("spans", lambda s: s["coverage"]))
    return d.select(
        "doc_id", F.col("n_words").cast("bigint").alias("n_words"),
        F.size("base").cast("bigint").alias("n_base"), F.array_min(F.transform("base", lambda s: s["start"])).alias("first_word"),
        F.array_max(F.transform("base", lambda s: s["start"])).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(labels(F.col("base")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(labels(F.col("base")), labels(F.col("spans"))))), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"))
