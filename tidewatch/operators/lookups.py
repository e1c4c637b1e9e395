"""Lookup joins (J1-J5) and the size-checked broadcast they rely on."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch import constants as K
from tidewatch.functions import text as tx
from tidewatch.session import ensure_checkpoint_dir


BROADCAST_BYTES = 32 << 20


def measured_bytes(df: DataFrame) -> int:
    """Bytes of a table's values, in one aggregation: the length of every
    string, 16 for any other value (arrays: 16 per member)."""
    def width(f):
        kind = f.dataType.simpleString()
        if kind == "string":
            return F.coalesce(F.octet_length(f.name), F.lit(0)) + 16
        return F.lit(16) * (F.greatest(F.coalesce(F.size(f.name), F.lit(1)), F.lit(1)) if kind.startswith("array") else 1)

    total = sum((width(f) for f in df.schema.fields), F.lit(0))
    return df.agg(F.sum(total.cast("bigint"))).first()[0] or 0


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint ``df`` for broadcast only if its measured bytes are within the
    bound.  Beyond it the frame is returned unhinted, so the join falls back
    to a shuffle join."""
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df


def small_side(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A derived table that several plans read and that is usually small (one
    row per key and bucket, ...): checkpointed to the shared folder, so it is
    computed once and survives lost executors, and hinted for broadcast when
    its bytes are within the bound."""
    ensure_checkpoint_dir(df.sparkSession)
    return bounded_broadcast(df.checkpoint(), max_bytes)


def literal_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A table of constants given by the caller, broadcast if it is small."""
    rows = list(rows)
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if sum(16 + len(str(v)) for r in rows for v in r) <= BROADCAST_BYTES else df


def regions_table(spark: SparkSession) -> DataFrame:
    return literal_table(spark, K.REGIONS,
                         "country string, region_name string, lat double, lon double")


def with_region(df: DataFrame, regions: DataFrame, country_col: str = "country") -> DataFrame:
    """Attach region and coordinates by country name (case-insensitive);
    unknown countries get [0, 0] and a null region."""
    r = regions.select(F.upper("country").alias("_rk"), "region_name",
                       F.array("lat", "lon").alias("coordinates"))
    return (df.join(r, F.upper(F.col(country_col)) == r._rk, "left")
              .withColumn("coordinates",
                          F.coalesce("coordinates", F.array(F.lit(0.0), F.lit(0.0))))
              .drop("_rk"))


def map_lookup(col: Column, mapping: dict, default) -> Column:
    """Constant lookup table as a literal map (priority, severity...)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.element_at(m, col), F.lit(default))


# ---- J2, J5, T10, T11, T12: dictionaries as tables ------------------------------------

GRAM = 3  # characters a name is looked up by
FEW_GRAMS = 256  # so many distinct grams are looked for one by one


def substring_matches(df: DataFrame, names: DataFrame, id_col: str = "tweet_id", text_col: str = "text",
                      lower: bool = False, out: str = "matches") -> DataFrame:
    """Adds ``out``: array of the rows of ``names`` (pos int, name string, any
    further columns) whose name occurs in the text, ordered by pos.

    For dictionaries of any size: a name can only occur where its first GRAM
    characters do, so the distinct grams of every text are joined to the names
    by equality, and only the few pairs that meet are tested.  A table within
    the broadcast bound meets the texts where they are, and no text is
    shuffled unless a caller uses it behind the join; beyond the bound gram rows
    carry the id, not the text.  ``lower`` compares lower-cased text and names.
    Ids must be unique; null texts match nothing; empty names are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    text = F.lower(text) if lower else text
    name = F.lower("name") if lower else F.col("name")
    table = names.where(F.length("name") > 0).select(
        F.struct("pos", "name", *[c for c in names.columns if c not in ("pos", "name")]).alias("_row"),
        name.alias("_name"), F.substring(name, 1, GRAM).alias("_gram"))
    sizes = sorted({r[0] for r in table.select(F.length("_gram")).distinct().collect()})  # at most GRAM values

    def pieces(chars: Column) -> Column:
        """Distinct runs of the wanted lengths, from the characters (linear)."""
        runs = [F.when(F.size(chars) >= k, F.transform(F.sequence(F.lit(0), F.size(chars) - k), lambda i: F.concat(*[F.get(chars, i + j) for j in range(k)])))
                .otherwise(F.array().cast("array<string>")) for k in sizes]
        return F.array_distinct(F.concat(*runs)) if runs else F.array().cast("array<string>")

    known = [r[0] for r in table.select("_gram").distinct().limit(FEW_GRAMS + 1).collect()]
    if len(known) <= FEW_GRAMS:      # only the names' own grams are looked for
        g = tx.contained(text, known)
    else:
        g = F.get(F.transform(F.array(F.split(text, "")), pieces), 0)
    small = measured_bytes(table.select(*[F.col(f"_row.{c}") for c in table.schema["_row"].dataType.names])) <= BROADCAST_BYTES
    if small:       # tested where the text is; ids and names are all that is shuffled
        met = (df.select(F.col(id_col).alias("_id"), text.alias("_t"), g.alias("_g")).select("_id", "_t", F.explode_outer("_g").alias("_gram"))
               .where(F.col("_gram").isNotNull()).join(F.broadcast(table), "_gram")
               .groupBy("_id", "_row").agg(F.count(F.lit(1)).alias("_met"), F.count_if(F.contains("_t", "_name")).alias("_in")).where("_in > 0"))
        # Every row of an id that has the gram meets every row of it that has the name.
        found = met.groupBy("_id").agg(F.array_sort(F.flatten(F.collect_list(F.array_repeat("_row", (F.col("_met") * F.col("_in")).cast("int"))))).alias(out))
    else:
        met = (df.select(F.col(id_col).alias("_id"), g.alias("_g")).select("_id", F.explode_outer("_g").alias("_gram")).where(F.col("_gram").isNotNull())
               .join(table, "_gram").select("_id", "_row", "_name"))
        texts = df.select(F.col(id_col).alias("_i"), text.alias("_t"))
        found = (met.join(texts, F.col("_id") == F.col("_i")).where(F.contains("_t", "_name"))
                 .groupBy("_id").agg(F.array_sort(F.collect_list("_row")).alias(out)))
    kind = found.schema[out].dataType
    return (df.join(found, F.col(id_col) == F.col("_id"), "left").drop("_id")
            .withColumn(out, F.coalesce(F.col(out), F.array().cast(kind))))


def corpus_keywords(df: DataFrame, stop_words: DataFrame, k: int = 10, id_col: str = "tweet_id",
                    cleaned: str = "cleaned", lang: str = "language") -> DataFrame:
    """T12 + J5 over tables: (id, keywords), the ``k`` most frequent candidate
    words of each post, ties by first position, without the stop words (lang,
    term) of its language.  Posts without candidates have an empty array.

    A table within the broadcast bound meets each post's ranked words as the
    set of its language, where the post is; beyond the bound the words are
    shuffled for an anti join."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(cleaned), F.lit(""))), F.lit(r"(?<![^ ])\p{L}{4,}(?![^ ])"), F.lit(0))
    own = F.when(F.coalesce(F.col(lang), F.lit("en")) == "fr", "fr").otherwise("en")
    terms = stop_words.where("term is not null").select(F.col("lang").alias("_sl"), F.col("term").alias("_sw"))
    if measured_bytes(terms) <= BROADCAST_BYTES:
        stop = F.broadcast(terms.groupBy("_sl").agg(F.collect_set("_sw").alias("_stop")))
        ranked = df.select(id_col, own.alias("_l"), tx.by_frequency(words).alias("_ranked")).join(stop, F.col("_l") == F.col("_sl"), "left")
        return ranked.select(id_col, F.slice(F.array_except("_ranked", F.coalesce("_stop", F.array().cast("array<string>"))), 1, k).alias("keywords"))
    rows = df.select(F.col(id_col).alias("_id"), own.alias("_l"), F.posexplode_outer(words).alias("_p", "_w"))
    kept = rows.where(F.col("_w").isNotNull()).join(terms, (F.col("_l") == F.col("_sl")) & (F.col("_w") == F.col("_sw")), "left_anti")
    counts = kept.groupBy("_id", "_w").agg(F.count(F.lit(1)).alias("_n"), F.min("_p").alias("_first"))
    rank = F.row_number().over(Window.partitionBy("_id").orderBy(F.col("_n").desc(), "_first"))
    top = (counts.withColumn("_r", rank).where(F.col("_r") <= k)
           .groupBy("_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", "_w"))), lambda x: x["_w"]).alias("keywords")))
    return (df.select(id_col).join(top, F.col(id_col) == F.col("_id"), "left")
            .select(id_col, F.coalesce("keywords", F.array().cast("array<string>")).alias("keywords")))
