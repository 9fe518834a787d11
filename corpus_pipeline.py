"""A training corpus in five stages: toxic documents out, one of each group of near copies, repeated passages out, sources mixed, packed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierforge.llm import common, jaccard, mixing, packing, substrings, toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the model rejects go; all others stay as they are, repeated rows, null ids, and null and empty texts included."""
    model = toxicity.fit(docs, common.table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the least doc_id, null last. Null and empty texts are in no group and stay."""
    common.ensure_importable(spark)
    return jaccard.keep_one_of_each(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows that also start earlier go; texts that have none stay as they are, white space included.

    Null and empty texts stay null and empty; a null doc_id counts as the smallest; rows equal in doc_id and text get the same result. n_chars
    follows a text that is cut. Other columns are kept, whatever their names."""
    common.ensure_importable(spark)
    rows = common.plain_names(docs, "doc_id", "text", "n_chars")
    cut = substrings.remove_repeats(rows.withColumn("whole", F.col("text")))
    changed = F.col("n_removed") > 0
    cut = cut.withColumn("text", F.when(changed, F.col("text")).otherwise(F.col("whole")))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return cut.select(*rows.columns).toDF(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it, shard after shard, shuffled in each. Null sources are one source; texts without words are as
    large as 0, so they go along with the block that they are in."""
    return mixing.mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, with their ids, in sequences of 1024."""
    import public_tokenizers

    common.ensure_importable(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [("toxicity", drop_toxic), ("jaccard join", drop_near_copies), ("substring dedup", drop_repeats), ("mixing", mix_sources), ("packing", pack_sequences)]

#: The model and the tokenizer can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = common.store(docs, "pipeline")
    return docs
