"""From documents to token ids: toxicity, line dedup, near duplicates, mixing, byte-level BPE.

Each stage reads what the one before wrote. All but the last return the columns of documents; the last returns
doc_id, source, n_tokens, ids_sha256, decoded_sha256 and token_ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import bpe, jaccard, lines, mixing, toxicity
from factloom.llm.common import free, save, table


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the model learns from labelled documents of the table itself.

    Null and empty texts score 0 and stay; rows that repeat fare alike.
    """
    return toxicity.clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def first_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line matches, all rows kept; null texts stay null, a null id comes first."""
    out = lines.dedup(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at five words and 0.8, the one of the smallest id. Null and empty texts are linked with nothing, rows of a null id stay."""
    gone = free(docs, "gone")
    found = save(jaccard.join(docs, 5, 80).where("doc_id <> component_id").select(F.col("doc_id").alias(gone)).distinct(), "near-copies")
    return docs.join(found, F.col("doc_id") == F.col(gone), "left_anti")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources by weight: a document once for every time it is taken; texts without words have no part in it, a null source is one of its own."""
    return mixing.take(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row of the mix."""
    keyed = docs.select(F.struct("doc_id", "source").alias("row"), "text")
    out = bpe.encode(keyed, *bpe.public("byte_bpe_50k.tiktoken"), id_col="row", ids=True)
    return out.select("row.doc_id", "row.source", "n_tokens", "ids_sha256", "decoded_sha256", "token_ids")


STAGES = [
    ("toxicity", not_toxic),
    ("line dedup", first_lines),
    ("n-gram Jaccard join", one_of_each),
    ("mixing sources", mixed),
    ("byte-level BPE", tokens),
]

#: A trained model and shingle sets are beyond SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
