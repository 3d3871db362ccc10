"""The numbered queries: each operator over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import table


def tokenizer_path() -> str:
    """Place of the tokenizer file that the contract names."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.toxicity import fit_toxicity, score_toxicity

    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False)).alias("held_out")
    return score_toxicity(docs, model, threshold=0.7).select("doc_id", held_out, "score", "predicted", "evidence", "n_tokens", F.size("passages").alias("n_passages"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.secrets import digest, scan_secrets

    return digest(scan_secrets(table(spark, sf_dir, "documents")))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.mixing import mix_sources

    return mix_sources(table(spark, sf_dir, "documents"))["taken"].select("doc_id", "size", "source_size", "target", "taken")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.simhash import simhash_components

    return simhash_components(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.ann import search

    rows = table(spark, sf_dir, "embeddings")
    return search(rows, rows.where(F.col("vec_id") % 100 == 0), k=10)


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.quality import classify_quality

    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.sharding import shuffle_into_shards

    placed = shuffle_into_shards(table(spark, sf_dir, "documents"), n_shards=8)  # whole documents are exchanged
    text = F.coalesce("text", F.lit(""))
    return placed.select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                         F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.linededup import remove_boilerplate

    return remove_boilerplate(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.bpe import decode_documents, encode_documents, fit_encoder

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoder = fit_encoder(docs, tokenizer_path())
    out = decode_documents(encode_documents(docs, encoder).drop("text"), encoder)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.lexical import search_items

    return search_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.spelling import spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_toxicity, op2_secret_scan, op3_embedding_near_dedup, op4_source_mix, op5_simhash_near_dedup, op6_nearest_neighbours,
           op7_pack, op8_quality, op9_shard, op10_line_dedup, op11_bpe, op12_lexical_search, op13_spelling)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    from riskframe.llm import lexical, linededup

    return {"op10_line_dedup": linededup.ORACLE, "op12_lexical_search": lexical.ORACLE}
