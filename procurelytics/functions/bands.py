"""Threshold ladders: a number (or label) to a label, first rule that holds wins."""

from __future__ import annotations

import operator

from pyspark.sql import Column, functions as F

_COMPARE = {
    ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le, "=": operator.eq,
}


def band(value: Column, rules, otherwise: str) -> Column:
    """``rules`` is a list of ``(comparison, threshold, label)``.  NULL meets no
    rule and so takes ``otherwise``."""
    return ladder([(_COMPARE[op](value, F.lit(limit)), label) for op, limit, label in rules], otherwise)


def ladder(cases, otherwise) -> Column:
    """``cases`` is a list of ``(condition, result)``; the first true one wins."""
    chain = None
    for condition, result in cases:
        chain = F.when(condition, result) if chain is None else chain.when(condition, result)
    return F.lit(otherwise) if chain is None else chain.otherwise(otherwise)


def lookup(key: Column, mapping: dict, otherwise=None) -> Column:
    """Literal dictionary lookup; an absent or NULL key takes ``otherwise``."""
    entries = ", ".join(_literal(x) for pair in mapping.items() for x in pair)
    found = F.try_element_at(F.expr(f"map({entries})"), key)
    return found if otherwise is None else F.coalesce(found, F.lit(otherwise))


def _literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value}D" if isinstance(value, float) else str(value)


def choose(options, position: Column) -> Column:
    """The option (text, or list of texts) at ``position`` modulo their number."""
    texts = [
        "cast(array(" + ", ".join(_literal(x) for x in o) + ") AS array<string>)" if isinstance(o, list) else _literal(o)
        for o in options
    ]
    return F.element_at(F.expr(f"array({', '.join(texts)})"), (F.pmod(position, F.lit(len(options))) + 1).cast("int"))


def clamp(value: Column, low=0.0, high=100.0) -> Column:
    """Limit to ``[low, high]``; NULL stays NULL."""
    return F.when(value.isNotNull(), F.greatest(F.lit(float(low)), F.least(value, F.lit(float(high)))))


def ratio(numerator: Column, denominator: Column, otherwise=0.0) -> Column:
    """``numerator / denominator`` where the denominator is positive."""
    return F.when(denominator > 0, F.try_divide(numerator, denominator)).otherwise(F.lit(otherwise))
