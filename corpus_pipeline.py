"""Training-data pipeline over ``documents``: five stages, each one applying one
of the operators in ``shardwise.llm`` to all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs.  All but the last return the
columns of documents.  Defined results: a null text counts as empty everywhere;
rows without words are never copies of one another; extra columns are kept up to
the last stage, which returns pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardwise.llm import credentials, decontaminate, ngram_join, packing, toxicity
from shardwise.llm.common import materialise, table
from shardwise.llm.queries import toxicity_model

ORACLE_SQL = None  # a trained classifier decides in the first stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that score 0.5 or more go; labels are learnt from the rows outside
    the held-out fifth."""
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, out="__toxicity").where(F.col("__toxicity") < 0.5).drop("__toxicity")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word Jaccard >= 0.8 stays."""
    return ngram_join.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an exact or edited test item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to a mark; every document stays."""
    out = credentials.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens."""
    made = packing.pack(docs)
    return made.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("secrets", redact_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every result but the last is written and read."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
