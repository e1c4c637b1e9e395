"""Exact quantiles of very large groups by histogram refinement (under C4).

``percentile`` keeps one map of all distinct values per group in the final
merge.  Here a rank is looked for instead: its range is cut into bins, the
rows of each bin are counted (with a partial count per task), the bin that
holds the rank becomes the new range, and so on until a bin holds one value.
Rows never leave their tasks; a round exchanges one row per rank and bin.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.lookups import bounded_broadcast

BINS = 512


def exact_quantiles(df: DataFrame, group: list[str], metrics: tuple, points=(0.25, 0.75), max_rounds: int = 40) -> DataFrame:
    """(group, _q_<metric>): the interpolated quantiles at ``points`` of every
    metric, as ``percentile`` gives them; nulls don't count, a group without
    values has null.  ``group`` columns must not be null.

    A quantile lies between two ranks.  For every rank the range [lo, hi] that
    holds it is narrowed: a round shrinks it by the factor BINS, to the least
    and the greatest value really there, so the number of rounds is that of the
    digits of a double whatever the values.
    """
    long = df.select(*group, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("x")) for m in metrics])).alias("_v"))
    values = long.select(*group, "_v.metric", "_v.x").where("x is not null").checkpoint()
    ends = values.groupBy(*group, "metric").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(F.lit(p) * (F.col("n") - 1)), F.ceil(F.lit(p) * (F.col("n") - 1))) for p in points])))
    todo = ends.select(*group, "metric", "n", F.explode(ranks).alias("rank"), "lo", "hi").withColumn("at", F.col("rank")).checkpoint()
    done = None
    for _ in range(max_rounds):
        found = todo.where("lo = hi").select(*group, "metric", "n", "rank", F.col("lo").alias("x"))
        done = found if done is None else done.unionByName(found)
        open_ = todo.where("lo < hi")
        if open_.isEmpty():
            break
        # ``at`` is the rank among the values from lo on.
        key = [*group, "metric"]
        inside = values.join(bounded_broadcast(open_.drop("n")), key).where((F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi")))
        bin_ = F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BINS), F.lit(BINS - 1))
        counts = inside.groupBy(*key, "rank", "at", bin_.alias("bin")).agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("a"), F.max("x").alias("b"))
        w = Window.partitionBy(*key, "rank").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)     # BINS rows at most
        held = counts.withColumn("before", F.coalesce(F.sum("c").over(w), F.lit(0))).where((F.col("at") >= F.col("before")) & (F.col("at") < F.col("before") + F.col("c")))
        todo = (held.select(*key, "rank", (F.col("at") - F.col("before")).alias("at"), F.col("a").alias("lo"), F.col("b").alias("hi"))
                .join(open_.select(*key, "rank", "n"), [*key, "rank"]).checkpoint())
    else:
        raise RuntimeError(f"quantiles did not settle in {max_rounds} rounds")
    stats = done.groupBy(*group, "metric").agg(F.first("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("rank", "x"))).alias("by"))

    def at(p):
        k = F.lit(p) * (F.col("n") - 1)
        low, high = F.element_at("by", F.floor(k)), F.element_at("by", F.ceil(k))
        return low + (high - low) * (k - F.floor(k))

    each = stats.select(*group, "metric", F.array(*[at(p) for p in points]).alias("q"))
    return each.groupBy(*group).agg(*[F.max(F.when(F.col("metric") == m, F.col("q"))).alias(f"_q_{m}") for m in metrics])
