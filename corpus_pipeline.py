"""A corpus in five stages, each written as Parquet and read again as the next one's documents.

Toxic documents go, one document of each near-duplicate group stays, documents
that hold a benchmark passage go, the rest is sampled to target weights, and the
token ids of what is left are written in doc_id order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bronzeflow.llm import decontamination, minhash, mixing, queries, token_files, toxicity
from bronzeflow.workspace import materialize, scratch_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the cut. The model learns from all labelled documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    settings = toxicity.Settings()
    model = toxicity.train(docs, labels, settings=settings)
    return toxicity.score_toxicity(docs, model).filter(F.col("score") < settings.cut).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of documents that share 80 % of their five-word shingles."""
    return minhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.contamination(docs, benchmark).filter("n_hit > 0")
    hit = materialize(found.select(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).distinct(), "contaminated")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_row"))
    return docs.join(hit, same, "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled so that sources, languages and forms come near their tempered shares."""
    return mixing.mix_sources(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of the token files, read back from them."""
    path = scratch_dir(spark, "corpus")
    token_files.write_tokens(docs, path, queries.tokenizer_file(), end_id=2)
    return token_files.read_digests(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
    ("token_files", write_tokens),
]

#: Compression distances, b-bit signatures and token ids are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, for all documents below sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
