"""A corpus made ready for training: five stages over ``documents``.

Each stage calls one operator of ``barlab.llm`` and works on all that the stage
before kept; all but the last return rows with the columns of ``documents``.
Between stages the rows are written as Parquet under the shared folder and read
again, so a lost executor never recomputes an earlier stage.

Rows with null columns, empty or very long texts, repeated rows and extra
columns pass through as each operator's docstring says; an empty table stays
empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barlab.llm.common import table, written
from barlab.llm.decontaminate import decontaminate, without_contaminated
from barlab.llm.language import fit_languages, with_known_language
from barlab.llm.mixing import curriculum_mix, mixed_documents
from barlab.llm.near_dedup import near_dedup, one_of_each
from barlab.llm.packing import pack_tokens
from barlab.llm.q_packing import END_ID
from barlab.llm.q_tokens import tokenizer_path


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without any letter go."""
    return with_known_language(docs, fit_languages(docs))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of each group of near
    copies: five-word shingles that are at least 80 % alike."""
    return one_of_each(docs, near_dedup(docs, shingle_words=5, percent=80))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in 13-word windows of the
    benchmark; the others go."""
    return without_contaminated(docs, decontaminate(docs, table(spark, sf_dir, "benchmark")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them, in training order."""
    return mixed_documents(docs, curriculum_mix(docs))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of 2,048 token ids."""
    return pack_tokens(docs, tokenizer_path("byte_bpe_50k.tiktoken"), end_id=END_ID, pad_id=END_ID)


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_output", token_stage),
]

#: Near-copy components and trained language scores can't be written in SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
