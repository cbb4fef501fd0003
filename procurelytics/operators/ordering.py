"""Places, ranks and running totals in the order of a whole large table.

A window over all rows of a table, or over a key that holds most of them, is one task.  Here the
rows are dealt by ranges of key and order, each range is numbered by itself, and what lies before
a range is the sum over the ranges before it: one row per range, however long the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from procurelytics.operators.ranking import as_list
from procurelytics.session import cut_lineage


def in_order(df: DataFrame, order, *, by=None, running=(), partitions: int | None = None) -> DataFrame:
    """Adds to every row, within its key ``by`` (or the whole table), along ``order``:

    ``position`` (1, 2, ...; rows equal in all of ``order`` in any order), ``rank`` (equal rows share
    the first position), ``n_rows`` of the key, and for each column of ``running`` its
    ``running_<column>`` up to and including the row and ``total_<column>``.  A NULL key is a key of its
    own; NULLs come first ascending and last descending; NULL values count as nothing in a running
    total.  The dealt rows are stored once, so that a lost executor cannot move a range."""
    keys, order = as_list(by), [order] if isinstance(order, Column) else as_list(order)
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    spark = df.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(partitions, *keys, *order).withColumn("_range", F.spark_partition_id())
    dealt = cut_lineage(dealt)
    sums = [F.sum(c).alias(f"_sum_{c}") for c in running]
    ranges = dealt.groupBy(*keys, "_range").agg(F.count("*").alias("_rows"), *sums)
    # one row per key and range
    whole = Window.partitionBy(*(keys or [F.lit(0)]))
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)

    def lead(column):
        return F.coalesce(F.sum(column).over(before), F.lit(0))

    heads = ranges.select(
        *keys, "_range", F.lit(True).alias("_head"), lead("_rows").alias("_before"), F.sum("_rows").over(whole).alias("_all"),
        *[lead(f"_sum_{c}").alias(f"_before_{c}") for c in running], *[F.sum(f"_sum_{c}").over(whole).alias(f"_all_{c}") for c in running],
    )
    # the head of a range comes first in it and brings what lies before: no join, one exchange
    rows = dealt.withColumn("_head", F.lit(False)).unionByName(heads, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, "_range").orderBy(F.col("_head").desc(), *order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)

    def brought(column) -> Column:
        return F.first(column).over(so_far)

    made = {"position": F.row_number().over(inside) - 1 + brought("_before"), "rank": F.rank().over(inside) - 1 + brought("_before"), "n_rows": brought("_all")}
    for c in running:
        made[f"running_{c}"] = brought(f"_before_{c}") + F.coalesce(F.sum(c).over(so_far), F.lit(0))
        made[f"total_{c}"] = brought(f"_all_{c}")
    return rows.select(*df.columns, "_head", *[v.alias(k) for k, v in made.items()]).where(~F.col("_head")).drop("_head")


def percent_rank(ordered: DataFrame) -> Column:
    """SQL's percent rank from the columns of ``in_order``: 0 for a key of one row."""
    return F.coalesce(F.try_divide(F.col("rank") - 1, F.col("n_rows") - 1), F.lit(0.0))
