"""From raw documents to a training mix: five stages, each over all that the one before kept.

quality        drops documents that the quality classifier rejects
near_dups      keeps one document of each near-duplicate group
decontaminate  drops documents that overlap a benchmark item
pii            replaces personal data in the texts
mix            takes words by source until the target weights are met

All but the last return the columns of documents; the last adds ``size``,
``source_size``, ``target`` and ``taken`` and leaves out what the mix doesn't
take. A stage's result is written down before the next one reads it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tesserae.llm import decontaminate, mixing, pii, quality, simhash
from tesserae.llm.common import bounded_batches, cut, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; null texts score as empty ones, repeats go together, an empty table gives no rows."""
    bounded_batches(spark)
    return quality.reject_low_quality(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; null and empty texts are one group, of repeated rows one stays."""
    bounded_batches(spark)
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; null texts are clean, repeats go together, equal items decide alike, without items all stay."""
    bounded_batches(spark)
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced; a null text stays null."""
    return pii.redact_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes; null and empty texts have no words and so aren't taken, a null source is a source, rows of one hash share what is left at the threshold, an empty table gives no rows."""
    return mixing.mix(docs).where("taken > 0")


STAGES: list[tuple[str, Stage]] = [
    ("quality", reject_low_quality),
    ("near_dups", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("pii", redact_personal_data),
    ("mix", mix_sources),
]

#: SQL can express neither the classifier nor XXH64 fingerprints; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
