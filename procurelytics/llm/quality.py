"""Line-first cleaning in SQL functions only: judge every line, drop those that fail, then
reject documents that lose too much of their text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from procurelytics.llm.common import SPACE, SPACE_CHARS, whole_text

SYMBOLS = r"[#*$%&|<>]+"
#: Symbols and the separators of menus; a line holding more than MAX_MARK_PERCENT of them fails.
MARKS = r"[#*$%&|<>»·]+"
#: A sentence line ends in one of these.
TERMINAL = list(".!?…;:\"'”’»)]。！？")
BOILERPLATE = (
    r"(?i)all rights reserved|licensed under|released under|copyright|cookie|privacy policy|terms of (use|service)"
    r"|javascript|lorem ipsum|subscribe|click here|sign (in|up)|log ?in"
)
#: A line longer than this is prose, whatever phrases it holds.
BOILERPLATE_CHARS = 200
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT, MAX_LOST_PERCENT, MAX_MARK_PERCENT = 10, 20, 50, 5


def _count(text: Column, pattern: str) -> Column:
    """Characters of ``text`` that ``pattern`` matches."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _computed(d: DataFrame, name: str, value: Column) -> DataFrame:
    """``value`` as a column that is computed once per row: the one-element generator keeps the
    optimizer from copying the expression into the lambdas and filters that read it."""
    return d.select("*", F.explode(F.array(value)).alias(name))


def _line_fails(line: Column) -> Column:
    """Punctuation, symbol and menu, shouting and boilerplate rules for one trimmed line."""
    return (
        ~F.right(line, F.lit(1)).isin(TERMINAL)
        | (100 * _count(line, MARKS) > MAX_MARK_PERCENT * F.length(line))
        | (~line.rlike(r"\p{Ll}") & line.rlike(r"\p{Lu}\p{Lu}"))
        | ((F.length(line) <= BOILERPLATE_CHARS) & line.rlike(BOILERPLATE))
    )


def measure_lines(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the measures of its whole texts and the verdict of the line rules.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_bad_lines,
    line_chars, bad_chars (characters of all and of the failing trimmed lines; longs), base_failed,
    kept (booleans) and clean_text (the lines that pass, in order).  Columns of ``df`` with one of these names are replaced.  One row out per row in:
    repeated rows are judged alike, an empty table gives an empty one.  A NULL or empty text
    has no words and is rejected; blank lines are neither judged nor kept.  Everything is
    computed inside the row, so a document's cost follows its own length and nothing is shuffled.
    """
    names = df.columns
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bad_lines",
             "line_chars", "bad_chars", "base_failed", "kept", "clean_text"]
    keep = [F.col(f"_in.`{c}`").alias(c) for c in names if c not in added]
    d = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_in"), whole_text(f"`{text}`").alias("_t"))

    d = _computed(d, "_words", F.split(F.btrim("_t", F.lit(SPACE_CHARS)), SPACE))
    d = d.withColumn("_n", F.when(F.get("_words", F.lit(0)) == "", F.lit(0)).otherwise(F.size("_words")))
    # a window is known by its 64-bit hash; most texts repeat none and are done with here
    windows = F.greatest(F.col("_n") - (WINDOW - 1), F.lit(0))
    hashes = F.slice(F.transform("_words", lambda w, i: F.xxhash64(w, *[F.get("_words", i + k) for k in range(1, WINDOW)])), F.lit(1), windows)
    d = _computed(d, "_sorted", F.when(F.size(F.array_distinct(hashes)) < windows, F.sort_array(
        F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    d = _computed(d, "_starts", F.sort_array(F.transform(F.filter("_sorted", lambda x, k: (
        ((k > 0) & (F.get("_sorted", k - 1)["h"] == x["h"])) | F.coalesce(F.get("_sorted", k + 1)["h"] == x["h"], F.lit(False))
    )), lambda x: x["i"])))
    # each start covers up to the next one, at most a window
    d = d.withColumn("n_repeat_words", F.coalesce(F.aggregate(
        F.transform("_starts", lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", k + 1) - s, F.lit(WINDOW)))),
        F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(0).cast("bigint")))

    d = _computed(d, "_lines", F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    d = _computed(d, "_trimmed", F.transform("_lines", lambda x: F.btrim(x, F.lit(SPACE_CHARS))))
    d = _computed(d, "_failing", F.transform("_trimmed", _line_fails))
    d = d.withColumn("n_words", F.col("_n").cast("bigint"))
    d = d.withColumn("word_chars", (F.length("_t") - _count(F.col("_t"), SPACE)).cast("bigint"))
    d = d.withColumn("n_symbols", _count(F.col("_t"), SYMBOLS).cast("bigint"))
    d = d.withColumn("n_lines", F.size("_lines").cast("bigint"))
    d = d.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"))
    d = d.withColumn("n_bad_lines", F.size(F.filter("_failing", lambda x: x)).cast("bigint"))
    d = d.withColumn("line_chars", F.aggregate("_trimmed", F.lit(0).cast("bigint"), lambda a, x: a + F.length(x)))
    d = d.withColumn("bad_chars", F.aggregate(F.filter("_trimmed", lambda x, i: F.get("_failing", i)), F.lit(0).cast("bigint"), lambda a, x: a + F.length(x)))
    d = d.withColumn("clean_text", F.array_join(F.filter("_lines", lambda x, i: ~F.get("_failing", i)), "\n"))
    d = d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    d = _computed(d, "kept", ~F.col("base_failed") & (100 * F.col("bad_chars") <= MAX_LOST_PERCENT * F.col("line_chars")))
    return d.select(*keep, *added)


def quality_rows(df: DataFrame) -> DataFrame:
    """The measures and the verdict per document."""
    return measure_lines(df.select("doc_id", "text")).drop("text", "clean_text")


def clean_documents(df: DataFrame) -> DataFrame:
    """Documents that the rules keep, with the failing lines removed and n_chars set to match; other
    columns are as they were, whatever their names."""
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), "text")
    replaced = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("bigint")}
    out = measure_lines(rows).where("kept")
    return out.select(*[replaced.get(c, F.col(f"_row.`{c}`")).alias(c) for c in df.columns])


_ENDS = ", ".join("'" + c.replace("'", "''") + "'" for c in TERMINAL)
SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d),
win AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, sum(least(5, coalesce(nxt - i, 5))) AS n FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM rep) GROUP BY doc_id),
ln AS (SELECT doc_id, line, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS s
       FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
jd AS (SELECT doc_id, line, length(s) AS chars, right(s, 1) NOT IN ({_ENDS})
  OR 100 * (length(s) - length(regexp_replace(s, '{MARKS}', '', 'g'))) > 5 * length(s)
  OR (NOT regexp_matches(s, '\p{{Ll}}') AND regexp_matches(s, '\p{{Lu}}\p{{Lu}}'))
  OR (length(s) <= 200 AND regexp_matches(s, '{BOILERPLATE}')) AS bad FROM ln),
jl AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (WHERE bad) AS n_bad_lines,
       sum(chars) AS line_chars, coalesce(sum(chars) FILTER (WHERE bad), 0) AS bad_chars FROM jd GROUP BY doc_id),
m AS (SELECT doc_id, len(words) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
  length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
  coalesce(cov.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_bad_lines, 0) AS n_bad_lines,
  coalesce(line_chars, 0) AS line_chars, coalesce(bad_chars, 0) AS bad_chars
  FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN jl USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(n_lines AS BIGINT) AS n_lines,
  CAST(n_bad_lines AS BIGINT) AS n_bad_lines, CAST(line_chars AS BIGINT) AS line_chars, CAST(bad_chars AS BIGINT) AS bad_chars, base_failed,
  NOT base_failed AND 100 * bad_chars <= 50 * line_chars AS kept FROM b
"""
