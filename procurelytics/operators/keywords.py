"""Texts against a table of keywords: one pass per text, however long the table.

A chain of ``contains`` reads a text once per keyword.  Here every task builds one multi-pattern
automaton out of the table and walks each text once; the keyword that stands first in the table's
order wins, wherever in the text it stands."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from procurelytics.session import bounded_batches

# Bounds of a keyword table, which every task holds: rows, and characters of keywords and labels.
MAX_KEYWORDS = 500_000
MAX_CHARS = 32_000_000
#: Rows of one batch in a Python worker, which holds a batch of whole texts as read, lower-cased and returned.
BATCH_ROWS = 200


def rule_table(spark, rules) -> DataFrame:
    """A keyword table out of ``[(words, label), ...]`` in list order."""
    rows = [(place, word, label) for place, (words, label) in enumerate(rules) for word in words]
    return spark.createDataFrame(rows, "priority int, keyword string, label string")


def ranked(keywords: DataFrame) -> list:
    """``(keyword, label)`` in order of priority, each lower-cased keyword once.  A table above the
    bounds is an error: it is neither cut nor sent to the tasks."""
    lowered = keywords.where("keyword IS NOT NULL").select(F.lower("keyword").alias("keyword"), "priority", "label")
    best = lowered.groupBy("keyword").agg(F.min(F.struct(F.isnull("priority").alias("last"), "priority", "label")).alias("best"))
    size = best.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(F.length("keyword") + F.coalesce(F.length("best.label"), F.lit(0))), F.lit(0)).alias("chars"),
    ).first()
    if size["rows"] > MAX_KEYWORDS or size["chars"] > MAX_CHARS:
        raise ValueError(f"{size['rows']} keywords of {size['chars']} characters; at most {MAX_KEYWORDS} of {MAX_CHARS}")
    table = best.select("keyword", "best.label", "best.priority").orderBy(F.col("priority").asc_nulls_last(), "keyword").toArrow()
    return list(zip(table.column("keyword").to_pylist(), table.column("label").to_pylist()))


def _open_ended(text: str, start: int, end: int) -> bool:
    """No letter, digit or underscore touches ``text[start:end]``."""
    return not any(c.isalnum() or c == "_" for c in (text[start - 1:start] if start else "") + text[end:end + 1])


def _first(automaton, lengths, text, always, word_boundary):
    """Least rank of a keyword in ``text``, ``always`` if none is lower; None if there is none."""
    best = always
    if len(automaton) == 0:
        return best
    for last, rank in automaton.iter(text):
        if best is not None and rank >= best:
            continue
        if word_boundary and not _open_ended(text, last + 1 - lengths[rank], last + 1):
            continue
        best = rank
        if best == 0:
            break
    return best


def first_keyword(
    df: DataFrame, text: str, keywords: DataFrame, *, otherwise: str | None = None, word_boundary: bool = False,
    into=("keyword", "label"),
) -> DataFrame:
    """Adds the first keyword of the table that the column ``text`` holds, and its label.

    ``keywords`` has ``priority``, ``keyword`` and ``label``.  Less priority goes first (NULL last), then the
    lesser keyword; of a keyword given twice the first counts.  Both sides are lower-cased; texts are read
    whole.  Without a hit the keyword is NULL and the label is ``otherwise``.  A NULL text counts as
    empty; an empty keyword is in every text; NULL keywords and empty tables match nothing.  With
    ``word_boundary`` no letter, digit or underscore may touch the hit.  All columns and rows of ``df`` are kept,
    in place; a column named as one of ``into`` is an error."""
    clash = [name for name in (*into, "_lowered") if name in df.columns]
    if clash:
        raise ValueError(f"columns {clash} are there already")
    ranks = ranked(keywords)
    bounded_batches(df.sparkSession, BATCH_ROWS)

    def matched(batches):
        import ahocorasick
        import pyarrow as pa

        automaton, lengths, always = ahocorasick.Automaton(), [], None
        for rank, (word, _) in enumerate(ranks):
            lengths.append(len(word))
            if word:
                automaton.add_word(word, rank)
            else:
                always = rank
        if len(automaton):
            automaton.make_automaton()
        for batch in batches:
            lowered = batch.column(batch.num_columns - 1)
            hits = [_first(automaton, lengths, value.as_py(), always, word_boundary) for value in lowered]
            words = pa.array([None if h is None else ranks[h][0] for h in hits], pa.string())
            labels = pa.array([otherwise if h is None else ranks[h][1] for h in hits], pa.string())
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, words, labels], names=[*batch.schema.names[:-1], *into])

    schema = T.StructType([*df.schema.fields, *[T.StructField(name, T.StringType()) for name in into]])
    lowered = F.lower(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    return df.withColumn("_lowered", lowered).mapInArrow(matched, schema)
