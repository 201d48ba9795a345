"""From raw documents to packed training sequences.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's docs. All
but the last return all columns of documents:

1. toxicity: documents that score ``toxicity.REJECT`` or more go;
2. near_duplicates: one document of each class stays;
3. decontamination: documents that hold a benchmark item go;
4. secrets: found secrets are masked in the text;
5. packing: a row per piece with its token ids, sequence and offset.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from otif.llm import decontam, minhash, packing, secrets, toxicity
from otif.llm.common import Staging, read
from otif.llm.tokens import default_tokenizer

#: The columns of documents; further ones pass through the filtering stages too.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.fit(docs, read(spark, sf_dir, "labels"))).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.without_matches(docs, read(spark, sf_dir, "benchmark")).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, default_tokenizer(), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: Several stages cannot be expressed in SQL; the run is tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    staging = Staging(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staging.put(stage(spark, docs, sf_dir), name)
    return docs
