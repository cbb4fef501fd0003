"""Latest rows, tails and top rows without gathering a table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def as_list(value) -> list:
    if value is None:
        return []
    return [value] if isinstance(value, str) else list(value)


def one_row(df: DataFrame) -> Column:
    """A one-row frame as a struct column of another frame: a scalar subquery, so
    neither a join nor a trip to the driver."""
    return df.select(F.struct(*df.columns)).scalar()


def series_window(series, *order):
    """Rows of one series in order.  Without a series key the whole input is one
    series; callers give it monthly rows, so it holds one row per month."""
    keys = as_list(series)
    window = Window.partitionBy(*(keys or [F.lit(0)]))
    return window.orderBy(*order) if order else window


def with_age(df: DataFrame, order="month", series=None, name="age") -> DataFrame:
    """``age`` 1 is the latest row of its series.  A later filter ``age <= n`` is
    applied before the shuffle (window group limit)."""
    return df.withColumn(name, F.row_number().over(series_window(series, F.col(order).desc())))


def tail_n(df: DataFrame, n: int, skip: int = 0, order="month", series=None) -> DataFrame:
    """The last ``n`` rows by ``order`` after leaving out the newest ``skip``; per
    series if a key is given, else through a distributed top-k."""
    if not as_list(series):
        df = df.orderBy(F.col(order).desc()).limit(n + skip)
    aged = with_age(df, order, series)
    return aged.where((F.col("age") > skip) & (F.col("age") <= n + skip)).drop("age")


def top_n(df: DataFrame, order, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def latest_period(df: DataFrame, period_col: str, condition: Column | None = None) -> DataFrame:
    """Rows of the newest period.  The newest period is that of the whole table,
    before ``condition`` is applied."""
    newest = df.agg(F.max(period_col)).scalar()
    out = df.where(F.col(period_col) == newest)
    return out if condition is None else out.where(condition)


def last_months(df: DataFrame, date_col: str, n: int, as_of: Column | None = None) -> DataFrame:
    """Rows from ``n`` months before ``as_of`` (default today) on."""
    as_of = F.current_date() if as_of is None else as_of
    return df.where(F.col(date_col) >= F.add_months(as_of, -n))


def future_head(df: DataFrame, n: int, as_of: Column | None = None, order="month") -> DataFrame:
    """The first ``n`` rows after ``as_of`` (default today)."""
    as_of = F.current_date() if as_of is None else as_of
    return df.where(F.col(order) > as_of).orderBy(order).limit(n)


def latest_per(df: DataFrame, keys, order, n: int = 1) -> DataFrame:
    """The newest ``n`` rows per key.  For one row ``max_by`` reduces every key on the
    map side; for more the rank filter prunes before the shuffle."""
    keys, order = as_list(keys), as_list(order)
    if n == 1:
        rest = [c for c in df.columns if c not in keys]
        newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
        return newest.select(*keys, "r.*").select(*df.columns)
    rank = F.row_number().over(series_window(keys, *[F.col(o).desc() for o in order]))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
