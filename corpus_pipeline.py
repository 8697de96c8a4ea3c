"""From raw documents to token ids in five stages, each written and read again.

Languages that are not recognised go, one document of each near-duplicate group stays,
personal data is masked, sources are mixed to their weights, and what is left is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sectorlens import session
from sectorlens.llm import langid, mixing, pii, simhash, spm
from sectorlens.llm.common import table
from sectorlens.llm.queries import tokenizer_path


def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops documents without letters and those whose language is in doubt (probability under one half)."""
    return langid.accepted(docs, 0.5)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps the smallest doc_id of each group linked by fingerprints of 4-word shingles within 4 bits."""
    return simhash.one_of_each(docs, 4, 4)


def masked_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Replaces e-mail and IP addresses, card and phone numbers by their kind."""
    return pii.redact(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Takes documents of each source up to its share of all words; a document taken k times is k rows."""
    return mixing.mix_documents(docs, (1, 2, 3), 3)


def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Adds the piece ids of each text; they decode to the text. Columns that have these names already are replaced."""
    rows = spm.encode(docs.drop("piece_ids", "n_pieces"), tokenizer_path("piece_bpe_32k.model"))
    return rows.selectExpr("row.*", "ids AS piece_ids", "size(ids) AS n_pieces")


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_near_copies),
    ("personal_data", masked_personal_data),
    ("mixing", mixed_sources),
    ("sentencepiece", encoded),
]

#: Trained models and fingerprints are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        path = session.scratch_dir(spark, f"corpus-{name}")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
