"""Operator 10, quality rules: per-document measures, thresholds taken from
quantile sketches per language and source, and a joined filter.  Built-in
functions only."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.sizes import broadcast_if_small
from tidewatch.llm.text import let, space_words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


# Shares of rows at which a group's sketch is read, from the median outwards:
# the tail is halved at each step (all are exact binary fractions).
STEPS = (0.5, 0.75, 0.875, 0.9375, 0.96875)
TAIL_RATIO = 3.0


@dataclass(frozen=True)
class Rule:
    """An adaptive bound on one measure.

    ``_edge`` walks a group's quantiles from the median outwards for as long as
    the next one is at most TAIL_RATIO times as far from the median as the one
    before, or within ``floor`` of the median: where the tail breaks away from
    the body, the body ends.  A document fails when it lies further out than
    the body's end by more than ``reach`` times the body's width.  ``floor`` is
    the least distance from the median that counts as unusual; it decides only
    in groups whose body has hardly any width.  ``low`` looks at the lower side.
    """
    measure: str
    floor: float
    reach: float = 6.0
    low: bool = False


RULES = (
    Rule("symbol_share", 0.06),
    Rule("dup_line_share", 0.35),
    Rule("repeat_share", 0.25),
    Rule("word_length", 2.0),
    Rule("word_length", 1.0, low=True),
)
# Groups smaller than this take the bounds of their language, then of all rows.
MIN_GROUP = 20
ACCURACY = 1_000


def repeated_words(words: Column, width: int = 3) -> Column:
    """Words that lie in a ``width``-word window found twice or more in the
    text (first places included).  Sorting the window hashes puts equal ones
    side by side; texts without an equal pair are settled by one set."""
    def covered(h):
        def mark(s):
            twice = F.filter(s, lambda x, i: (F.when(i > 0, s[i - 1]["h"] == x["h"]).otherwise(False))
                             | (F.when(i < F.size(s) - 1, s[i + 1]["h"] == x["h"]).otherwise(False)))
            places = F.flatten(F.transform(twice, lambda x: F.sequence(x["i"], x["i"] + (width - 1))))
            return F.size(F.array_distinct(places))
        return let(F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), mark)

    def hashes(w):
        return F.transform(F.sequence(F.lit(0), F.size(w) - width),
                           lambda i: F.xxhash64(*[w[i + j] for j in range(width)]))

    def count(w):
        return F.when(F.size(w) <= width, F.lit(0)).otherwise(
            let(hashes(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))))

    return let(words, count).cast("bigint")


def with_measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long)
    and the shares the rules look at (double).  Null and empty texts count as
    a text without words: zero everywhere."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = docs.withColumn("_words", space_words(text)).withColumn("_lines", lines)
    d = d.withColumns({
        "n_words": F.size("_words").cast("bigint"),
        "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
        "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("bigint"),
        "n_lines": F.size("_lines").cast("bigint"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "n_repeat_words": repeated_words(F.col("_words")),
    }).drop("_words", "_lines")
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return d.withColumns({
        "symbol_share": F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)).cast("double"),
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double"),
        "repeat_share": F.col("n_repeat_words") / n,
        "word_length": F.col("word_chars") / n,
    })


def fit_bounds(measured: DataFrame, rules=RULES) -> DataFrame:
    """Quantiles per (lang, source), per lang and overall, in one pass.

    ``approx_percentile`` is a mergeable quantile sketch: each task sketches
    its rows, only the sketches are shuffled, so a source with a third of all
    rows costs no more than any other.  Columns: level (0 group, 1 language,
    2 all), lang, source, n, q (struct of one array per measure: the quantiles
    of the lower tail, the median, those of the upper tail, ascending).
    """
    names = list(dict.fromkeys(r.measure for r in rules))
    shares = [1 - p for p in STEPS[:0:-1]] + list(STEPS)
    sketch = [F.percentile_approx(m, shares, ACCURACY).alias(m) for m in names]
    rolled = (measured.select("lang", "source", *names).rollup("lang", "source")
              .agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"), F.struct(*sketch).alias("q")))
    level = F.when(F.col("gid") == 0, 0).when(F.col("gid") == 1, 1).otherwise(2)
    return rolled.select(level.alias("level"), "lang", "source", "n", "q")


def _edge(q: Column, rule: Rule) -> Column:
    """The value beyond which a row breaks ``rule``, from its group's quantiles."""
    mid, sign = len(STEPS) - 1, -1 if rule.low else 1
    median = q[mid]

    def away(i):
        return (q[mid + sign * i] - median) * sign

    def body(i):
        if i == len(STEPS) - 1:
            return away(i)
        joined = away(i + 1) <= F.greatest(F.lit(TAIL_RATIO) * away(i), F.lit(rule.floor))
        return F.when(joined, body(i + 1)).otherwise(away(i))

    return median + F.greatest(body(1) * (1 + rule.reach), F.lit(rule.floor)) * sign


def _fails(edges: Column, rules) -> Column:
    """Names of the rules a row breaks, given the edge of every rule."""
    found = []
    for i, r in enumerate(rules):
        broken = F.col(r.measure) < edges[i] if r.low else F.col(r.measure) > edges[i]
        found.append(F.when(broken, F.lit(r.measure + ("_low" if r.low else "_high"))))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def judge(measured: DataFrame, rules=RULES, min_group: int = MIN_GROUP) -> DataFrame:
    """Adds base_failed, failed_rules and kept.

    The bounds are one row per (lang, source); they are joined null-safely,
    so rows with a null lang or source form groups of their own.  A group with
    fewer than ``min_group`` rows takes its language's bounds, a language with
    fewer the bounds of all rows.  The bounds are checkpointed: the measures
    are computed once for them and once for the verdicts (once in all if
    ``measured`` is itself a checkpoint).
    """
    bounds = fit_bounds(measured, rules).checkpoint()
    groups = bounds.where("level = 0").select(F.col("lang").alias("_l"), F.col("source").alias("_s"), F.col("n").alias("_n0"), F.col("q").alias("_q0"))
    langs = bounds.where("level = 1").select(F.col("lang").alias("_l1"), F.col("n").alias("_n1"), F.col("q").alias("_q1"))
    whole = bounds.where("level = 2").select(F.col("q").alias("_q2"))
    # One row per (lang, source): the fallbacks are settled on this small table first.
    table = (groups.join(langs, F.col("_l").eqNullSafe(F.col("_l1")), "left").join(whole, F.lit(True), "left")
             .select("_l", "_s", F.when(F.col("_n0") >= min_group, F.col("_q0"))
                     .when(F.col("_n1") >= min_group, F.col("_q1")).otherwise(F.col("_q2")).alias("_q"))
             .select("_l", "_s", F.array(*[_edge(F.col("_q")[r.measure], r) for r in rules]).alias("_q")))
    table = broadcast_if_small(table.checkpoint(), 200 + 10 * len(rules))
    joined = measured.join(table, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left")
    base_failed = (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words"))
    return (joined.withColumn("base_failed", base_failed).withColumn("failed_rules", _fails(F.col("_q"), rules))
            # One expression over both sides of the join, so the filter on it stays
            # above the join and the measures are not computed a second time below it.
            .withColumn("kept", F.when(F.size("failed_rules") > 0, False).otherwise(~F.col("base_failed"))).drop("_l", "_s", "_q"))


def quality_filter(docs: DataFrame, rules=RULES) -> DataFrame:
    """Documents that pass, with the columns they came with.

    The input row travels as one struct beside the measures, so extra columns
    of any name are safe.  A missing lang or source column counts as null.
    """
    cols = [F.col(c) if c in docs.columns else F.lit(None).cast("string") for c in ("text", "lang", "source")]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         *[c.alias(n) for c, n in zip(cols, ("text", "lang", "source"))])
    return judge(with_measures(packed), rules).where("kept").select("row.*")


def quality_report(docs: DataFrame) -> DataFrame:
    """Per document: its counts, base_failed, kept, the rules it broke."""
    d = judge(with_measures(docs.select("doc_id", "text", "lang", "source")).drop("text").checkpoint())
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))
