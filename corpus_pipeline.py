"""A corpus pipeline of five stages over `documents`.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept. All but the last return the columns of `documents`; the last returns the
ids' digests and the ids themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioforge.llm import bpe, common, decontaminate, linededup, nearcopies, quality
from folioforge.llm.catalog import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, common.documents(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go."""
    return linededup.replace_texts(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return nearcopies.representatives(docs)


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.decontaminate(docs, common.documents(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left."""
    return bpe.encode_decode(docs, tokenizer_path(), keep_decoded=False)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", near_stage),
    ("benchmark decontamination", leak_stage),
    ("bpe encoding and decoding", token_stage),
]

#: The classifier, SimHash and the tokenizer are beyond SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order; what each but the last returns is written to the shared folder and read again, and goes when the next one is written."""
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        kept = common.stage(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
        common.discard(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
