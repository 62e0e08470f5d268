"""A corpus pipeline over ``documents``: language ID, near-dedup, benchmark decontamination, personal data, packing.

Each stage reads what the one before wrote, and works on all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rallyframe.llm import decontaminate, language_id, near_dedup, packing, pii
from rallyframe.llm.common import discard, materialise, scratch, table
from rallyframe.llm.queries import TOKENIZER

# All stages but the last return the columns of their input as they are, whatever the names of others than doc_id, text, lang and
# n_chars, and give no rows for an empty table.  Texts are taken whole, however long.


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, of doubtful language, or in no language that has labels go.

    Null and empty texts go; rows without a doc_id or label are judged like others; repeated rows stay or go together.  A tie of
    languages changes nothing.
    """
    return language_id.accept(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by shingles of five words, stays: the one with the smallest doc_id.

    Null and wordless texts have no copies and stay.  Rows that repeat doc_id and text are one document, and all stay.  A
    document without a doc_id goes if it has a copy with one.
    """
    return near_dedup.representatives(docs, size=5, threshold=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark text go; null texts hold none, repeated rows stay or go together."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts becomes the name of its kind in brackets; null texts stay null, repeated rows change alike."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the texts' tokens in sequences; null and empty texts are their end token, repeated rows are each packed."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: Language ID, personal data and tokenizing are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the pieces of the last one.

    What a stage writes for itself is deleted after it, and its input after the next; the last one's tables stay.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch(spark) as keep:
            after = keep(materialise(stage(spark, docs, sf_dir), name))
        discard(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
