"""From raw documents to a training mix, stage by stage.

Each stage works on all that its predecessor kept, written as Parquet in the
shared folder.  All stages but the last return the columns of ``documents``; the
last adds what the mix takes of each document.

Defined results: null texts have no words, so the quality rules drop them, as they do
empty ones; of documents equal in id and text one stays; ties go to the smaller id;
columns named like a measure of a stage come back as they were; empty tables give
an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from recueil.llm import decontaminate, host_rules, jaccard, mixing, suffix_dedup
from recueil.llm.common import hidden, scratch, table

#: Bytes of a repeated passage: under those of fifty words of prose.
PASSAGE = 200


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, and those of rejected hosts, go."""
    inside, own = hidden(docs, [*host_rules.MEASURES, "base_failed", "kept"])
    return host_rules.quality_rules(inside).filter("kept").select(*own)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by near-equal shingle sets, one stays."""
    return jaccard.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of ``PASSAGE`` bytes that occur more than once are cut out, in all
    places; empty documents go."""
    cut = suffix_dedup.repeats_removed(docs, length=PASSAGE)
    return cut.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else cut


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with items of the benchmark go."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the mix takes nothing go; ``copies`` of the others."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("mix_sources", mix_sources),
]

#: No SQL: components over links are iterative, the cut texts depend on them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    with scratch(spark) as last:
        for name, stage in STAGES:
            with scratch(spark) as kept:
                keep = last if name == STAGES[-1][0] else kept
                docs = keep(stage(spark, docs, sf_dir), name)
    return docs
