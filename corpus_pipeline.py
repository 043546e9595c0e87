"""The training-data pipeline over ``documents``: quality rules, toxicity, near
duplicates, repeated passages, packing.

Each stage works on all rows its predecessor kept; all but the last return the
columns of ``documents``. ``run`` writes each stage's rows as Parquet into the
shared folder and reads them back for the next."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiflow.llm import neardup, packing, quality, spans, toxicity
from lexiflow.llm.common import read, written
from lexiflow.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the likelihood ratio go."""
    return quality.keep(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go."""
    return toxicity.clean(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the least id stays."""
    return neardup.first_of_each(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sentences of non-first repeated spans go; ``n_chars`` follows the text."""
    out = spans.dedup(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), end_id=0).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("substring dedup", drop_repeated_passages),
    ("packing", pack_documents),
]

#: The stages learn models and tokenise; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
