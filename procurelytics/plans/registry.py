"""Named queries over the test tables, each with the SQL it is compared to."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

# Added before rounding on both sides: engines differ in how they round a value that
# lies exactly between two steps, and this sends all of those up.
TIE = 1e-7

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    """Register ``f(spark, folder) -> DataFrame``; ``sql`` where SQL can say the same."""
    def wrap(f):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f
    return wrap


def shown(df: DataFrame, *columns, digits: int = 4, **other) -> DataFrame:
    """Comparable types: whole numbers as bigint, doubles rounded (``digits`` places, or
    as ``other`` says per column), lists as joined text."""
    if columns:
        df = df.select(*columns)
    out = []
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            col = F.round(col.cast("double") + TIE, other.get(field.name, digits))
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            col = col.cast("bigint")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = col.cast("date")
        elif isinstance(field.dataType, T.ArrayType):
            col = F.array_join(col.cast("array<string>"), "|")
        out.append(col.alias(field.name))
    return df.select(*out)


# --- SQL building -------------------------------------------------------------------
CTES: dict = {}


def cte(name: str, needs: str, sql: str) -> None:
    """A named SQL fragment; ``needs`` lists the fragments it reads."""
    CTES[name] = (needs.split(), sql)


def _ordered(names, done):
    for name in names:
        if name not in done:
            needs, text = CTES[name]
            _ordered(needs, done)
            done[name] = text
    return done


def sql(needs: str, body: str, *, ints: str = "", doubles: str = "", digits: int = 4, **other) -> str:
    """``body`` with the fragments it needs, whole numbers cast and doubles rounded as
    ``shown`` does."""
    parts = _ordered(needs.split(), {})
    head = "WITH " + ",\n".join(f"{n} AS (\n{t.strip()}\n)" for n, t in parts.items()) + "\n" if parts else ""
    fixed = [f"CAST({c} AS BIGINT) AS {c}" for c in ints.split()]
    fixed += [f"round(CAST({c} AS DOUBLE) + {TIE}, {other.get(c, digits)}) AS {c}" for c in doubles.split()]
    if not fixed:
        return head + body.strip()
    return f"{head}SELECT * REPLACE ({', '.join(fixed)}) FROM (\n{body.strip()}\n)"
