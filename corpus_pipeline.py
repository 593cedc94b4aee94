"""A training corpus from the documents table, in five stages.

Each stage takes the documents that the one before kept, written as Parquet in
the shared folder and read again. The last one gives packed token sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.llm import langid, mixing, ngram_join, packing, repeats
from keyfold.llm.common import materialize, release, table, workers_find_package, workers_return_memory
from keyfold.session import scratch_dir

#: A text counts as one of the known languages if so much of it is made of that language's n-grams.
MIN_LANGUAGE_SCORE = 0.3
#: Documents shorter than this are too little to judge by score; they stay if they have letters.
MIN_SCORED_CHARS = 20


#: Rows that go to a Python worker at once: whole texts are long, and a worker holds a few batches.
ROWS_PER_BATCH = 1000


def _prepared(spark: SparkSession) -> None:
    workers_find_package(spark)
    workers_return_memory(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that are null, have no letter, or are in none of the labelled languages."""
    _prepared(spark)
    model = langid.train(docs, learn=F.lit(True))
    known = (F.col("lang_pred") != langid.UNKNOWN) & ((F.col("score") >= MIN_LANGUAGE_SCORE) | (F.length("text") < MIN_SCORED_CHARS))
    return langid.predict(docs, model).where(known).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates: the smallest id, null ids last, then the text of the smallest hash.

    Texts without words are near duplicates of nothing; they lose exact copies only.
    """
    release()
    _prepared(spark)
    groups = materialize(ngram_join.components(docs, same=True), "pipeline-groups")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "same")
    first = groups.where("component is not null").groupBy("component").agg(F.min(order).alias("first")).select("first.doc_id", "first.same")
    first = first.unionByName(groups.where("component is null").select("doc_id", "same").distinct()).select(F.col("doc_id").alias("_doc"), F.col("same").alias("_of"))
    kept = docs.withColumn("_same", F.xxhash64("text"))
    kept = kept.join(first, (F.col("_same") == F.col("_of")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left_semi")
    return kept.dropDuplicates(["doc_id", "_same"]).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out passages of 50 bytes or more that a document of smaller id has too."""
    release()
    _prepared(spark)
    cut = repeats.without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and drops documents so that the sources' words meet their targets."""
    release()
    return mixing.mixed(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, placed in windows of several context sizes."""
    release()
    _prepared(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: SQL can express neither the language filter nor the suffix arrays; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = _written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def _written(df: DataFrame, name: str) -> DataFrame:
    """Outputs of stages lie beside the operators' scratch tables, which the next stage releases."""
    path = scratch_dir(df.sparkSession, f"pipeline-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
