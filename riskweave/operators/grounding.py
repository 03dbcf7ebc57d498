"""How well texts are supported by a policy corpus: TF-IDF cosine as a sparse join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType
from pyspark.sql.window import Window

from riskweave.functions import fixed
from riskweave.functions import text as tx


def term_rows(df: DataFrame, row_id: str, text: str, pattern: str = fixed.TOKEN_PATTERN) -> DataFrame:
    """Rows (id, term, tf), counted inside each row so that no shuffle is needed."""
    words = df.select(row_id, F.sort_array(tx.tokens(F.col(text), pattern)).alias("_words"))
    runs = words.withColumn("_ends", tx.run_ends(F.col("_words")))
    pairs = runs.select(row_id, F.explode(tx.run_lengths(F.col("_words"), F.col("_ends"))).alias("_t"))
    return pairs.select(row_id, "_t.term", "_t.tf")


def kept_terms(
    corpus: DataFrame,
    row_id: str,
    text: str,
    stop_words: list[str] = tuple(fixed.STOP_WORDS),
    pattern: str = fixed.TOKEN_PATTERN,
) -> DataFrame:
    """``term_rows`` of a corpus without its NULL texts and without stop words."""
    rows = term_rows(corpus.where(F.col(text).isNotNull()), row_id, text, pattern)
    return rows.where(~F.col("term").isin(list(stop_words)))


def weigh_terms(terms: DataFrame, row_id: str, size: Column) -> DataFrame:
    """Rows (id, term, idf, weight) from term rows of ``size`` texts: smooth idf and unit-length vectors.

    Frequencies are counted inside each task first. Weights are shuffled once, by row, where a row holds each term once.
    """
    idf = F.log((size + 1) / (F.col("_df") + 1)) + 1
    frequency = terms.groupBy("term").agg(F.count("*").alias("_df")).select("term", idf.alias("idf"))
    weighted = terms.join(frequency, "term").withColumn("_w", F.col("tf") * F.col("idf"))
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(row_id)))
    return weighted.select(row_id, "term", "idf", (F.col("_w") / length).alias("weight"))


def corpus_size(corpus: DataFrame, text: str) -> Column:
    return corpus.agg(F.count(text).cast("double").alias("n")).scalar()


def tfidf_weights(corpus: DataFrame, row_id: str, text: str, **options) -> DataFrame:
    """Rows (id, term, idf, weight) of a corpus, as one plan; texts are read for the frequencies and again for the rows."""
    return weigh_terms(kept_terms(corpus, row_id, text, **options), row_id, corpus_size(corpus, text))


def store_weights(corpus: DataFrame, row_id: str, text: str, path: str, **options) -> DataFrame:
    """The same with ``passage_id`` as id, stored below ``path``; texts are split into terms once, and the counts kept there."""
    spark = corpus.sparkSession
    kept_terms(corpus, row_id, text, **options).withColumnRenamed(row_id, "passage_id").write.mode("overwrite").parquet(f"{path}/counts")
    weights = weigh_terms(spark.read.parquet(f"{path}/counts"), "passage_id", corpus_size(corpus, text))
    weights.select("passage_id", "term", "idf", "weight").write.mode("overwrite").parquet(f"{path}/weights")
    return spark.read.parquet(f"{path}/weights")


def write_index(corpus: DataFrame, row_id: str, text: str, path: str, **options) -> DataFrame:
    """Fit the corpus once and store it as a table (passage_id, term, idf, weight), replacing an earlier one.

    Reading it back gives the planner its true file size: a small index is broadcast under
    ``spark.sql.autoBroadcastJoinThreshold``, a large one is shuffled by term.
    A row with NULL passage per term carries the idf alone, and a row with NULL term stands for
    each passage, also for one without any term.
    """
    spark = corpus.sparkSession
    stored = store_weights(corpus, row_id, text, path, **options)
    terms = stored.groupBy("term").agg(F.first("idf").alias("idf"))
    nothing = F.lit(None)
    alone = terms.select(nothing.cast(stored.schema["passage_id"].dataType).alias("passage_id"), "term", "idf", nothing.cast("double").alias("weight"))
    alone.write.mode("overwrite").parquet(f"{path}/terms")
    passages = corpus.where(F.col(text).isNotNull()).select(F.col(row_id).alias("passage_id"), nothing.cast("string").alias("term"), nothing.cast("double").alias("idf"), nothing.cast("double").alias("weight"))
    passages.write.mode("overwrite").parquet(f"{path}/passages")
    return read_index(spark, path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/weights", f"{path}/terms", f"{path}/passages")


def similarities(
    queries: DataFrame, row_id: str, text: str, index: DataFrame, pattern: str = fixed.TOKEN_PATTERN, fill: int = 0
) -> DataFrame:
    """Rows (id, passage_id, dot) plus one row per query with NULL passage holding |q|^2.

    The ``fill`` passages with the smallest ids have a row for every query, with 0 where they
    share no term: enough to complete a ranking of half as many hits.

    One join on term; partial sums are combined before the shuffle. The NULL row exists for
    every query, also for one that shares no term with the corpus.
    """
    hits = term_rows(queries, row_id, text, pattern).join(index, "term")
    x = F.col("tf") * F.col("idf")
    value = F.when(F.col("passage_id").isNull(), x * x).otherwise(x * F.col("weight"))
    everyone = queries.select(
        row_id,
        F.lit(None).cast(index.schema["passage_id"].dataType).alias("passage_id"),
        F.lit(0.0).alias("_c"),
    )
    first = index.where(F.col("term").isNull()).select("passage_id").distinct().orderBy("passage_id").limit(fill).collect()
    listed = F.array(*[F.lit(r["passage_id"]) for r in first]).cast(ArrayType(index.schema["passage_id"].dataType))
    everyone = everyone.unionByName(queries.select(row_id, F.explode(listed).alias("passage_id"), F.lit(0.0).alias("_c")))
    parts = hits.select(row_id, "passage_id", value.alias("_c")).unionByName(everyone)
    return parts.groupBy(row_id, "passage_id").agg(F.sum("_c").alias("dot"))


def top_passages(
    queries: DataFrame,
    row_id: str,
    text: str,
    index: DataFrame,
    k: int = 2,
    pattern: str = fixed.TOKEN_PATTERN,
) -> DataFrame:
    """Best k passages per query by cosine: (id, passage_id, similarity, rank).

    A query always has k rows, or as many as there are passages: those without a common term have
    similarity 0 and come in the order of their ids.
    """
    is_norm = F.col("passage_id").isNull()
    order = [F.desc(is_norm), F.desc(F.round("dot", 9)), F.asc("passage_id")]
    per_query = Window.partitionBy(row_id)
    best = (
        similarities(queries, row_id, text, index, pattern, 2 * k)
        .withColumn("_r", F.row_number().over(per_query.orderBy(*order)))
        .where(F.col("_r") <= k + 1)
    )
    length = F.sqrt(F.max(F.when(is_norm, F.col("dot"))).over(per_query))
    return (
        best.withColumn("_len", length)
        .where(~is_norm)
        .select(
            row_id,
            "passage_id",
            F.coalesce(F.try_divide(F.col("dot"), F.col("_len")), F.lit(0.0)).alias("similarity"),
            (F.col("_r") - 1).alias("rank"),
        )
    )


def grounding_scores(
    queries: DataFrame,
    row_id: str,
    text: str,
    index: DataFrame,
    k: int = 2,
    pattern: str = fixed.TOKEN_PATTERN,
) -> DataFrame:
    """Rows (id, grounding): mean of the best k similarities, absent pairs counting as zero.

    A corpus with fewer than k passages averages over what it has; passages without any term count.
    """
    is_norm = F.col("passage_id").isNull()
    order = [F.desc(is_norm), F.desc("dot"), F.asc("passage_id")]
    best = (
        similarities(queries, row_id, text, index, pattern)
        .withColumn("_r", F.row_number().over(Window.partitionBy(row_id).orderBy(*order)))
        .where(F.col("_r") <= k + 1)
    )
    slots = index.where(F.col("term").isNull()).agg(F.least(F.count("*"), F.lit(k)).alias("n")).scalar()
    sums = best.groupBy(row_id).agg(
        F.sum(F.when(~is_norm, F.col("dot"))).alias("_top"), F.max(F.when(is_norm, F.col("dot"))).alias("_norm")
    )
    mean = F.try_divide(F.try_divide(F.col("_top"), F.sqrt("_norm")), slots.cast("double"))
    return sums.select(row_id, F.coalesce(mean, F.lit(0.0)).alias("grounding"))


def hallucination_risk(grounding: Column) -> Column:
    return F.round(1 - grounding, 4)
