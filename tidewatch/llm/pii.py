"""Operator 4, personal data: fixed entity patterns, and sanitisation of terms
that reveal an entity, judged by corpus co-occurrence.  Built-in functions only."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.text import let, span_digest, spans

KINDS = ("email", "ip", "card", "phone")
# The contract's patterns, written so that no run is scanned twice: a match can
# only begin where a run of its first class begins or the last match ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

TERM = r"[\p{L}\p{M}]{4,}+"
BLOCK = 4096           # code points per block a text is cut into for slicing
WINDOW = 80            # code points of context on either side of an entity
MIN_SUPPORT = 2        # documents a term must share with an entity's generalisation
PRIOR = 1.0            # documents' worth of belief in the estimate by the generalisation
GENERALISE_SHARE = 0.5  # P(entity | term) from which a term is generalised
REMOVE_SHARE = 0.8     # ... and from which it is removed


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Check-digit test; every second digit from the right is doubled."""
    def total(cs):
        n = F.size(cs)
        return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + let(
            cs[i].cast("int"), lambda d: F.when((n - i) % 2 == 0, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)))
    return let(F.split(digits, ""), total) % 10 == 0


def entities(text: Column) -> Column:
    """array<struct<k, s, e, kind, m>> of the base spans, by kind, then start."""
    def label(found, kind):
        return F.transform(found, lambda x: F.struct(
            F.lit(KINDS.index(kind)).alias("k"), x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("kind"), x["m"].alias("m")))

    def good_ip(x):
        return F.forall(F.split(x["m"], r"\."), lambda p: F.coalesce(p.try_cast("int"), F.lit(256)) <= 255)

    def good_card(x):
        return let(_digits(x["m"]), lambda d: F.length(d).between(16, 19) & _luhn(d))

    def good_phone(x):
        return F.length(_digits(x["m"])).between(8, 15)

    return F.concat(label(spans(text, EMAIL), "email"), label(F.filter(spans(text, IP), good_ip), "ip"),
                    label(F.filter(spans(text, CARD), good_card), "card"), label(F.filter(spans(text, PHONE), good_phone), "phone"))


def _value(kind: Column, m: Column) -> Column:
    """What an entity is compared by: digits of cards and phones, lower-case addresses."""
    return F.concat_ws(":", kind, F.when(kind.isin("card", "phone"), _digits(m)).otherwise(F.lower(m)))


def _general(kind: Column, m: Column) -> Column:
    """The coarser fact an entity may safely be reduced to: mail domain,
    network, card issuer, dialling prefix."""
    return F.concat_ws(":", kind, F.when(kind == "email", F.lower(F.regexp_extract(m, "@(.*)$", 1)))
                       .when(kind == "ip", F.regexp_extract(m, r"^([0-9]+\.[0-9]+)", 1))
                       .when(kind == "card", F.substring(_digits(m), 1, 6)).otherwise(F.substring(_digits(m), 1, 3)))


def _blocks(text: Column) -> Column:
    """The text as blocks of BLOCK code points, so that a slice reads only the
    blocks it touches."""
    return F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % BLOCK), F.lit(0))


def _cut(blocks: Column, a: Column, b: Column) -> Column:
    """Code points a (inclusive) to b (exclusive)."""
    def part(i):
        lo, hi = F.greatest(a - i * BLOCK, F.lit(0)), F.least(b - i * BLOCK, F.lit(BLOCK))
        return F.coalesce(F.get(blocks, i.cast("int")), F.lit("")).substr((lo + 1).cast("int"), (hi - lo).cast("int"))
    return F.when(b <= a, F.lit("")).otherwise(
        F.array_join(F.transform(F.sequence((a / BLOCK).cast("bigint"), ((b - 1) / BLOCK).cast("bigint")), part), ""))


def _context(blocks: Column, n: Column, x: Column) -> Column:
    """Terms around entity x that lie wholly in its window: array<struct<t, s, e>>."""
    left, right = F.greatest(x["s"] - WINDOW, F.lit(0)), F.least(x["e"] + WINDOW, n)

    def terms(a, b, cut_left, cut_right):
        found = spans(_cut(blocks, a, b), TERM)
        whole = F.filter(found, lambda t: ~((t["s"] == 0) & cut_left) & ~((t["e"] == b - a) & cut_right))
        return F.transform(whole, lambda t: F.struct(F.lower(t["m"]).alias("t"), (a + t["s"]).alias("s"), (a + t["e"]).alias("e")))

    return F.concat(terms(left, x["s"], left > 0, F.lit(False)), terms(x["e"], right, F.lit(False), right < n))


def disclosing_terms(frozen: DataFrame, docs: DataFrame, n_docs: int) -> DataFrame:
    """(general, t, remove): terms that reveal an entity of a generalisation.

    All counts are of documents: n_t hold the term, n_te hold it in the window
    of the entity e, n_tg in the window of any entity that generalises to g
    (its domain, network, issuer or prefix); n_e and n_g hold e and g.  How
    strongly t reveals e is P(e | t), which for a rare entity is backed off to
    its generalisation: (n_te + PRIOR * P(g | t) * P(e | g)) / (n_t + PRIOR).
    t reveals e if that reaches a share bound, the PMI by the same estimate
    reaches the information content of g, and t shares MIN_SUPPORT documents
    with g: a term of one document tells no more than the document itself.
    Every count is taken from distinct values per document and pre-aggregated
    by the tasks, so a frequent entity or term is no hot key.
    """
    def counted(values, *names):
        x = frozen.select(F.explode(F.array_distinct(values)).alias("x"))
        return x.select("x.*" if len(names) > 1 else F.col("x").alias(names[0])).groupBy(*names).count()

    def pairs(*fields):
        return F.flatten(F.transform("ents", lambda e: F.transform(
            e["terms"], lambda t: F.struct(*[e[f].alias(f) for f in fields], t["t"].alias("t")))))

    n_te = counted(pairs("value", "general"), "value", "general", "t").withColumnRenamed("count", "n_te")
    n_tg = counted(pairs("general"), "general", "t").withColumnRenamed("count", "n_tg").where(F.col("n_tg") >= MIN_SUPPORT)
    n_e = counted(F.transform("ents", lambda e: e["value"]), "value").withColumnRenamed("count", "n_e")
    n_g = counted(F.transform("ents", lambda e: e["general"]), "general").withColumnRenamed("count", "n_g")
    n_t = (docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))).alias("t"))
           .groupBy("t").agg(F.count(F.lit(1)).alias("n_t")))
    n = F.lit(float(n_docs))
    terms = F.greatest(F.col("n_t"), F.col("n_tg")).cast("double")
    share = (F.col("n_te") + F.lit(PRIOR) * (F.col("n_tg") / terms) * (F.col("n_e") / F.col("n_g"))) / (terms + F.lit(PRIOR))
    pmi, content = F.log2(share * n / F.col("n_e")), -F.log2(F.col("n_g") / n)
    return (n_te.join(n_tg, ["general", "t"]).join(n_t, "t").join(n_e, "value").join(n_g, "general")
            .withColumn("share", share)
            .where((F.col("share") >= GENERALISE_SHARE - 1e-9) & (pmi >= content - 1e-9))
            .groupBy("general", "t").agg(F.max(F.col("share") >= REMOVE_SHARE - 1e-9).alias("remove")))


def _redacted(text: Column, marks: Column) -> Column:
    """The text with every mark (struct<s, e, label>, sorted) replaced; marks
    that overlap an earlier one extend it.  Folds over chunks of marks."""
    kind = "array<struct<s:bigint,e:bigint,label:string>>"

    def merged(ms):
        def one(acc, m):
            touch = m["s"] < acc["e"]
            grown = F.greatest(m["e"], acc["e"])
            return F.struct(
                F.when(touch, acc["s"]).otherwise(m["s"]).alias("s"), F.when(touch, grown).otherwise(m["e"]).alias("e"),
                F.when(touch, acc["label"]).otherwise(m["label"]).alias("label"),
                F.when(touch | (acc["e"] == 0), acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(acc["s"].alias("s"), acc["e"].alias("e"), acc["label"].alias("label"))))).alias("out"))

        def chunk(acc, at):
            inner = F.aggregate(F.slice(ms, at + 1, 256), F.struct(acc["s"], acc["e"], acc["label"], F.array().cast(kind).alias("out")), one)
            return let(inner, lambda i: F.struct(i["s"], i["e"], i["label"], F.concat(acc["out"], F.array(i["out"])).alias("out")))

        zero = F.struct(F.lit(0).cast("bigint").alias("s"), F.lit(0).cast("bigint").alias("e"), F.lit("").alias("label"), F.array().cast(f"array<{kind}>").alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.size(ms) - 1, F.lit(256)), zero, chunk, lambda a: F.concat(
            F.flatten(a["out"]), F.array(F.struct(a["s"].alias("s"), a["e"].alias("e"), a["label"].alias("label")))))

    def write(x):
        b, ms = x["b"], x["ms"]
        pieces = F.transform(ms, lambda m, i: F.concat(
            _cut(b, F.when(i > 0, ms[F.greatest(i - 1, F.lit(0))]["e"]).otherwise(F.lit(0).cast("bigint")), m["s"]), m["label"]))
        return F.concat(F.array_join(pieces, ""), _cut(b, F.element_at(ms, -1)["e"], x["n"]))

    return let(F.struct(_blocks(text).alias("b"), F.length(text).cast("bigint").alias("n"), merged(marks).alias("ms")), write)


def sanitise(docs: DataFrame) -> DataFrame:
    """Adds ``pii``: array<struct<k, s, e, kind>> by kind, then start (base
    spans, then disclosing terms as kind ``term``), and ``clean``: the text
    with entities replaced by their kind and disclosing terms generalised or
    removed wherever they stand in a text that holds the entity or its
    generalisation.

    Rows without an entity are untouched and take no part in any shuffle of
    texts.  The rows with entities are checkpointed once (spark.checkpoint.dir)
    with a row number that is fixed by that, and joined back by it, so
    repeated rows and null ids are kept apart.  A null text has no entities
    and stays null.  The input row travels as the struct ``row``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"), entities(text).alias("ents"))
    none = "array<struct<k:int,s:bigint,e:bigint,kind:string>>"
    plain = packed.where(F.size("ents") == 0).select("row", F.array().cast(none).alias("pii"), F.col("text").alias("clean"))
    frozen = (packed.where(F.size("ents") > 0)
              .withColumn("blocks", _blocks(F.col("text"))).withColumn("n", F.length("text").cast("bigint"))
              .withColumn("ents", F.transform("ents", lambda x: F.struct(
                  x["k"], x["s"], x["e"], x["kind"], _value(x["kind"], x["m"]).alias("value"), _general(x["kind"], x["m"]).alias("general"),
                  _context(F.col("blocks"), F.col("n"), x).alias("terms"))))
              .select(F.monotonically_increasing_id().alias("rid"), "row", "text", "ents").checkpoint())
    told = disclosing_terms(frozen, docs.select("text"), docs.count())
    # (rid, t) of the terms that a text with an entity of that generalisation holds anywhere.
    has = frozen.select("rid", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))).alias("t"))
    kinds = frozen.select("rid", F.explode(F.array_distinct(F.transform("ents", lambda e: e["general"]))).alias("general"))
    found = (has.join(told, "t").join(kinds, ["rid", "general"])
             .groupBy("rid", "t").agg(F.max("remove").alias("remove")).checkpoint())
    # Every place of such a term; texts without one take no part.
    places = (frozen.join(found.select("rid").distinct(), "rid", "left_semi")
              .select("rid", F.explode_outer(spans(F.col("text"), TERM)).alias("w")).select("rid", F.lower("w.m").alias("t"), "w.s", "w.e"))
    marked = (places.join(found, ["rid", "t"])
              .groupBy("rid").agg(F.collect_list(F.struct("s", "e", "remove")).alias("terms")))
    held = frozen.join(marked, "rid", "left").withColumn("terms", F.coalesce("terms", F.array().cast("array<struct<s:bigint,e:bigint,remove:boolean>>")))
    # Letters inside an entity go with the entity.
    held = held.withColumn("terms", F.filter("terms", lambda t: ~F.exists("ents", lambda x: (x["s"] < t["e"]) & (t["s"] < x["e"]))))
    pii = F.array_sort(F.concat(
        F.transform("ents", lambda x: F.struct(x["k"], x["s"], x["e"], x["kind"])),
        F.transform("terms", lambda t: F.struct(F.lit(len(KINDS)).alias("k"), t["s"], t["e"], F.lit("term").alias("kind")))))
    marks = F.array_sort(F.concat(
        F.transform("ents", lambda x: F.struct(x["s"], x["e"], F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")).alias("label"))),
        F.transform("terms", lambda t: F.struct(t["s"], t["e"], F.when(t["remove"], F.lit("[REMOVED]")).otherwise(F.lit("[WORD]")).alias("label")))))
    return plain.unionByName(held.select("row", pii.alias("pii"), _redacted(F.col("text"), marks).alias("clean")))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with sanitised texts; n_chars, where there is one, follows."""
    done = sanitise(docs)
    cols = []
    for c in docs.columns:
        value = F.col("row").getField(c)
        if c == "text":
            value = F.col("clean")
        elif c == "n_chars":
            value = F.when(F.col("clean").isNull(), value).otherwise(F.length("clean")).cast(docs.schema[c].dataType)
        cols.append(value.alias(c))
    return done.select(*cols)


def pii_report(docs: DataFrame) -> DataFrame:
    """Digest columns per document: counts per kind, SHA-256 of the base spans,
    and all spans as text."""
    d = sanitise(docs.select("doc_id", "text")).select(F.col("row.doc_id").alias("doc_id"), "pii")

    def n(kind):
        return F.size(F.filter("pii", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return d.select("doc_id", *[n(k) for k in KINDS], n("term"),
                    F.sha2(span_digest(F.filter("pii", lambda x: x["k"] < len(KINDS))), 256).alias("base_sha256"),
                    span_digest(F.col("pii")).alias("spans"))
