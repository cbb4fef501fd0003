"""The corpus pipeline: quality rules, language, near copies, repeated passages, packing."""

from __future__ import annotations

from procurelytics.llm import language, near_dup, packing, quality, suffix_dedup
from procurelytics.session import cut_result


def keep_quality(spark, docs, sf_dir):
    """Drop failing lines, and documents that lose too much text or fail the base rules."""
    return quality.clean_documents(docs)


def keep_language(spark, docs, sf_dir):
    """Drop documents whose language no dictionary wins by a clear margin."""
    return language.keep_identified(docs)


def keep_one_copy(spark, docs, sf_dir):
    """Of documents linked by five-word shingles keep the one with the smallest id."""
    return near_dup.keep_one_of_each(docs, shingle=5, percent=80)


def drop_repeats(spark, docs, sf_dir):
    """Remove passages that also stand in a document with a smaller id."""
    return suffix_dedup.without_repeats(docs)


def pack_sequences(spark, docs, sf_dir):
    """Pieces of all texts in sequences of at most 1024 tokens, with the checksum of their ids."""
    return packing.packing_rows(docs)


STAGES = [
    ("quality_rules", keep_quality),
    ("language_id", keep_language),
    ("near_dedup", keep_one_copy),
    ("suffix_dedup", drop_repeats),
    ("packing", pack_sequences),
]
#: SQL can express neither the compression, nor the suffix order, nor the tokens; see the tests.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; each stage's rows are stored and read again, and go when the next
    stage's are stored."""

    def after(position):
        if not position:
            return spark.read.parquet(f"{sf_dir}/documents.parquet")
        return cut_result(spark, lambda: STAGES[position - 1][1](spark, after(position - 1), sf_dir))

    return STAGES[-1][1](spark, after(len(STAGES) - 1), sf_dir)
