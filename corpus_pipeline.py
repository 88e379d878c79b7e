"""From raw documents to token ids: five stages, each over all that the one before it kept.

1. quality rules: documents that fail them go;
2. near-duplicates, by SimHash and bands and then exact similarity (five-word shingles, Jaccard 0.8 or more): of each group the document with the least id stays;
3. benchmark decontamination: documents in which a test window of ten words occurs go;
4. secret scans: secrets are masked in the text, the document stays;
5. SentencePiece encoding: token ids are added.

All but the last return the columns of the documents they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from muniment.llm import decontaminate, nearcopies, pieces, quality, secrets
from muniment.llm.common import read
from muniment.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return nearcopies.keep_one_similar(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask_secrets(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.add_tokens(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("SentencePiece encoding", encoding),
]

#: Fertility bands, similarity of texts and piece encoding have no form in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
