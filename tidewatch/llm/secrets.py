"""Operator 1, secret scans: fixed credential patterns plus sliding-window
Shannon entropy per character class.  Built-in functions only."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.text import let, span_digest, spans

# Fixed patterns of the base scan.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
BASE_KINDS = ("assign", "access", "hex")


@dataclass(frozen=True)
class EntropyClass:
    """A character class whose windows are measured.

    ``needs``: patterns that a candidate must all contain (words and numbers
    alone are not candidates).  ``min_bits`` is the entropy at or above which
    a window of ``window`` characters counts as random.
    """
    kind: str
    alphabet: str
    run: str
    window: int
    min_bits: float
    needs: tuple[str, ...]


CLASSES = (
    EntropyClass("entropy_hex", "0123456789abcdefABCDEF",
                 r"(?<![0-9A-Za-z])[0-9a-fA-F]{20,}+(?![0-9A-Za-z])", 20, 2.9, ("[0-9]", "[a-fA-F]")),
    EntropyClass("entropy_b64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-",
                 r"[A-Za-z0-9+/_=-]{24,}", 24, 3.9, ("[0-9]", "[a-z]", "[A-Z]")),
)
# Candidates that look random but are known not to be secrets.
ALLOW = (
    r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # UUID
    r"(?i)example|sample|placeholder|changeme|dummy",
    r"^(?:sha(?:1|256|384|512)|md5)-",                            # published digests
    r"(?i)0123456789abcdef|abcdefghijklmnopqrstuvwxyz",           # alphabets
)


def _hot_intervals(cand: Column, cls: EntropyClass) -> Column:
    """Unions of the windows of one candidate whose entropy reaches the bound.

    One fold over the characters keeps the counts of the current window and
    S = sum of n*log2(n).  A step adds the entering and takes off the leaving
    character, so S changes by two terms; the entropy is log2(W) - S/W.
    """
    w = cls.window
    out_kind = "array<struct<s:bigint,e:bigint>>"

    def f(n):
        return F.when(n > 0, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))

    def scan(code: Column) -> Column:
        def step(acc, i):
            enter = code[i]
            leave = F.when(i >= w, code[i - w]).otherwise(F.lit(-1))
            same = enter == leave
            n_in = acc["n"][enter]
            n_out = F.when(leave >= 0, acc["n"][F.greatest(leave, F.lit(0))]).otherwise(F.lit(0))
            s = F.when(same, acc["S"]).otherwise(acc["S"] + f(n_in + 1) - f(n_in) + F.when(leave >= 0, f(n_out - 1) - f(n_out)).otherwise(F.lit(0.0)))
            counts = F.when(same, acc["n"]).otherwise(F.transform(
                acc["n"], lambda v, k: v + (k == enter).cast("int") - (k == leave).cast("int")))
            hot = (i >= w - 1) & (F.log2(F.lit(float(w))) - s / w >= cls.min_bits - 1e-9)
            start = (i - (w - 1)).cast("bigint")
            joins = hot & (acc["ce"] >= start)
            return F.struct(
                counts.alias("n"), s.alias("S"),
                F.when(hot & ~joins, start).otherwise(acc["cs"]).alias("cs"),
                F.when(hot, (i + 1).cast("bigint")).otherwise(acc["ce"]).alias("ce"),
                F.when(hot & ~joins & (acc["ce"] >= 0), F.concat(acc["out"], F.array(F.struct(acc["cs"].alias("s"), acc["ce"].alias("e")))))
                .otherwise(acc["out"]).alias("out"))

        zero = F.struct(
            F.array_repeat(F.lit(0), len(cls.alphabet)).alias("n"), F.lit(0.0).alias("S"),
            F.lit(-1).cast("bigint").alias("cs"), F.lit(-1).cast("bigint").alias("ce"), F.array().cast(out_kind).alias("out"))
        return F.aggregate(
            F.sequence(F.lit(0), F.size(code) - 1), zero, step,
            lambda a: F.when(a["ce"] >= 0, F.concat(a["out"], F.array(F.struct(a["cs"].alias("s"), a["ce"].alias("e"))))).otherwise(a["out"]))

    return let(F.transform(F.split(cand, ""), lambda c: F.instr(F.lit(cls.alphabet), c) - 1), scan)


def entropy_spans(text: Column, cls: EntropyClass, allow=ALLOW) -> Column:
    """Spans (s, e) of the candidates of one class that hold random windows
    and match no allow-list pattern."""
    def wanted(c):
        ok = F.length(c["m"]) >= cls.window
        for need in cls.needs:
            ok = ok & c["m"].rlike(need)
        for pattern in allow:
            ok = ok & ~c["m"].rlike(pattern)
        return ok

    found = F.filter(spans(text, cls.run), wanted)
    return F.flatten(F.transform(found, lambda c: F.transform(
        _hot_intervals(c["m"], cls), lambda h: F.struct((c["s"] + h["s"]).alias("s"), (c["s"] + h["e"]).alias("e")))))


def _labelled(found: Column, kind: str, rank: int) -> Column:
    return F.transform(found, lambda x: F.struct(
        x["s"].alias("s"), F.lit(rank).alias("k"), x["e"].alias("e"), F.lit(kind).alias("kind")))


def scan_secrets(docs: DataFrame, text_col: str = "text", classes=CLASSES, allow=ALLOW) -> DataFrame:
    """Adds ``base`` and ``found``: arrays of struct<s, k, e, kind>, sorted by
    start and then by the order of the kinds.  ``found`` holds the base spans
    and those of the entropy scan.

    One narrow pass, no shuffle.  Null and empty texts give empty arrays;
    repeated rows each get their own result; other columns pass through
    (``base``, ``found`` are replaced if the input has them).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    assign = F.filter(spans(text, ASSIGN), lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 1)) >= 8)
    base = F.array_sort(F.concat(_labelled(assign, "assign", 0), _labelled(spans(text, ACCESS), "access", 1),
                                 _labelled(spans(text, HEX), "hex", 2)))
    extra = F.concat(*[_labelled(entropy_spans(text, c, allow), c.kind, len(BASE_KINDS) + i) for i, c in enumerate(classes)])
    return docs.withColumn("base", base).withColumn("found", F.array_sort(F.concat(F.col("base"), extra)))


def secret_report(docs: DataFrame) -> DataFrame:
    """Digest columns per document: counts per base kind, SHA-256 of the base
    spans, and all spans as text."""
    d = scan_secrets(docs.select("doc_id", "text"))

    def n(kind):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return d.select("doc_id", *[n(k) for k in BASE_KINDS],
                    F.sha2(span_digest(F.col("base")), 256).alias("base_sha256"),
                    span_digest(F.col("found")).alias("spans"))
