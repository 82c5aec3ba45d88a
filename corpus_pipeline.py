"""The text pipeline: each stage works on the documents that its predecessor kept.

Every stage's documents are written as Parquet to the shared folder and read again, so a lost
executor costs a re-read of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketweave.llm import decontam, jaccard, lines, mixing, quality
from marketweave.llm.queries import labelled_domains
from marketweave.session import BATCH, shared_dir, stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    spark.conf.set(*BATCH)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).filter(F.col("_score") >= quality.THRESHOLD).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; a document of which nothing is left goes with them."""
    found = lines.dedup_lines(docs)
    chars = F.when(F.col("_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    found = found.filter((F.col("_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")).withColumn("n_chars", chars)
    return found.select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return jaccard.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are drawn, with their rate and number of copies."""
    spark.conf.set(*BATCH)
    marked = labelled_domains(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found = mixing.mix(docs, marked, mixing.TARGETS).withColumn("copies", mixing.copies(F.col("rate")))
    return found.filter("copies > 0").select(*docs.columns, "rate", "copies")


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mixing_to_targets),
]

#: Trained stages are not expressible in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, apply) in enumerate(STAGES):
        docs = stage(apply(spark, docs, sf_dir), f"stage_{number}", root)
    return docs
