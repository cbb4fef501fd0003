"""Text expressions over whole texts: keyword rules, code extraction, number extraction."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from procurelytics.constants import DOLLAR_PATTERN, LONG_NUMBER_PATTERN
from procurelytics.functions.bands import ladder


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once.  Inside a lambda an outer expression is
    computed again for every element; a lambda variable is not."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def mentions(lowered: Column, word: str, word_boundary: bool = False) -> Column:
    """Does the lower-cased text hold ``word``: anywhere, or only as a whole word."""
    if word_boundary:
        return lowered.rlike(r"\b" + re.escape(word.strip()) + r"\b")
    return lowered.contains(word)


def label_by_keywords(text: Column, rules, otherwise: str, word_boundary: bool = False) -> Column:
    """First rule in list order with any keyword in the text (NULL text counts as empty)."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    cases = []
    for words, label in rules:
        hit = mentions(lowered, words[0], word_boundary)
        for word in words[1:]:
            hit = hit | mentions(lowered, word, word_boundary)
        cases.append((hit, label))
    return ladder(cases, otherwise)


def first_name_in(text: Column, names, word_boundary: bool = False) -> Column:
    """The first name of the list that the text holds, or NULL."""
    lowered = F.lower(text)
    return ladder([(mentions(lowered, name, word_boundary), name) for name in names], None)


def first_listed_code(text: Column, codes, otherwise: str, pattern: str = r"(?U)\b(\d{4})\b") -> Column:
    """The first token matching ``pattern`` that is one of ``codes``."""
    tokens = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    known = F.array(*[F.lit(code) for code in codes])
    listed = let(known, lambda all_codes: F.filter(tokens, lambda token: F.array_contains(all_codes, token)))
    return F.coalesce(F.try_element_at(listed, F.lit(1)), F.lit(otherwise))


def amounts(text: Column, skip_years: bool = False) -> Column:
    """Distinct dollar amounts and integers of four or more digits in a text."""
    dollars = F.transform(
        F.regexp_extract_all(text, F.lit(DOLLAR_PATTERN), F.lit(0)),
        lambda m: F.regexp_replace(m, r"[$,]", "").try_cast("double"),
    )
    integers = F.transform(
        F.regexp_extract_all(text, F.lit("(?U)" + LONG_NUMBER_PATTERN), F.lit(0)),
        lambda m: m.try_cast("double"),
    )
    if skip_years:
        integers = F.filter(integers, lambda v: ~((v > 1900) & (v < 2100)))
    return F.array_distinct(F.array_compact(F.concat(dollars, integers)))


def long_words(lowered: Column, shortest: int = 4) -> Column:
    """Distinct words of at least ``shortest`` letters, digits or underscores, any script."""
    pattern = r"[\p{L}\p{N}_]{%d,}" % shortest
    return F.array_distinct(F.regexp_extract_all(lowered, F.lit(pattern), F.lit(0)))
