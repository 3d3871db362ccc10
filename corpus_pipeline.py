"""Corpus pipeline: five of the training-data operators, one after the other.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns what goes on. Every stage's rows are written as Parquet in the shared
folder and read again as the next stage's documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import table
from riskframe.session import ensure_checkpoint_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose perplexity is beyond their language's limit.

    Verdicts are a function of id, language and text, so they go back to the
    documents by id, language and text hash.
    """
    from riskframe.llm.quality import classify_quality

    verdicts = classify_quality(docs, table(spark, sf_dir, "labels"), with_hash=True).where(~F.col("keep"))
    bad = verdicts.select(F.col("doc_id").alias("b_id"), F.col("lang").alias("b_lang"), F.col("text_hash").alias("b_hash")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("b_id")) & F.col("lang").eqNullSafe(F.col("b_lang")) & (F.xxhash64("text") == F.col("b_hash"))
    return docs.join(bad, same, "left_anti").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take cross-site boilerplate lines out of the texts."""
    from riskframe.llm.linededup import remove_boilerplate

    out = remove_boilerplate(docs)
    return out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-equal fingerprints."""
    from riskframe.llm.simhash import keep_one

    return keep_one(docs, shingle=4, max_bits=4).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them: repeated, or in part."""
    from riskframe.llm.mixing import mixed_documents

    return mixed_documents(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the token sequences."""
    from riskframe.llm.packing import pack
    from riskframe.llm.queries import tokenizer_path

    return pack(docs, tokenizer_path(), capacity=2048)


STAGES = [("quality classifier", quality), ("line dedup", lines), ("simhash near-dedup", near_duplicates),
          ("mixing sources", mix), ("best-fit packing", packed)]

#: Fingerprints, keyed draws and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
    return docs
