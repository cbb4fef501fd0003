"""Supplier and contract search: optional filters, top rows, total match count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from procurelytics.operators.ranking import series_window


def contains(name: str, wanted: str, regex: bool = False) -> Column:
    """Case-insensitive; the wanted text is literal unless ``regex``.  NULL is no match."""
    hit = F.col(name).rlike(f"(?i){wanted}") if regex else F.lower(name).contains(wanted.lower())
    return F.coalesce(hit, F.lit(False))


def filter_name_variants(df: DataFrame, name: str, variants, regex: bool = False) -> DataFrame:
    """Rows whose name holds any of the variants, in any case."""
    keep = F.lit(False)
    for variant in variants:
        keep = keep | contains(name, variant, regex)
    return df.where(keep)


def supplier_filter(df: DataFrame, *, name="", state="", subsystem="", size="", regex=False) -> DataFrame:
    """An empty parameter filters nothing."""
    if name:
        df = df.where(contains("supplier_name", name, regex))
    if state:
        df = df.where(F.upper("state") == state.upper())
    if subsystem:
        df = df.where(contains("subsystem_category", subsystem, regex))
    if size:
        df = df.where(contains("company_size", size, regex))
    return df


def search_suppliers(df: DataFrame, *, top_n=15, **filters) -> DataFrame:
    """The first ``top_n`` matches by name, each with the number of all matches."""
    matches = supplier_filter(df, **filters)
    total = matches.agg(F.count("*")).scalar()
    return matches.orderBy("supplier_name", "uei").limit(top_n).withColumn("total_matches", total)


def supplier_summary(df: DataFrame, **filters) -> DataFrame:
    """Counts by size and region of the matches, as long rows, with the overall numbers:
    one grouped pass; the overall numbers are sums over its few cells (sizes by regions)."""
    matches = supplier_filter(df, **filters)
    cells = matches.groupBy(
        F.coalesce("company_size", F.lit("UNKNOWN")).alias("company_size"),
        F.coalesce("region_group", F.lit("UNKNOWN")).alias("region_group"),
    ).agg(F.count("*").alias("n"))
    everything = series_window(None)
    small = F.when(F.col("company_size").contains("SMALL"), F.col("n")).otherwise(0)
    cells = cells.withColumns({
        "_total": F.sum("n").over(everything), "_small": F.sum(small).over(everything),
        "_regions": F.size(F.collect_set("region_group").over(everything)),
    })
    long = cells.select(
        F.explode(F.array(
            F.struct(F.lit("size").alias("facet"), F.col("company_size").alias("value")),
            F.struct(F.lit("region").alias("facet"), F.col("region_group").alias("value")),
        )).alias("f"), "n", "_total", "_small", "_regions",
    )
    return long.groupBy("f.facet", "f.value").agg(
        F.sum("n").alias("suppliers"), F.max("_total").alias("total_matches"),
        F.try_divide(F.max("_small") * 100.0, F.max("_total")).alias("small_business_pct"),
        F.max("_regions").alias("region_count"),
    )


def contract_filter(df: DataFrame, *, vendor="", psc="", fiscal_year=0, min_amount=0.0, regex=False) -> DataFrame:
    """Amounts may arrive as text; what is no number is NULL and fails a minimum."""
    df = df.withColumn("obligated_amount", F.col("obligated_amount").try_cast("double"))
    if vendor:
        df = df.where(contains("vendor_name", vendor, regex))
    if psc:
        df = df.where(F.col("psc_code").startswith(psc))
    if fiscal_year > 0:
        df = df.where(F.col("fiscal_year") == fiscal_year)
    if min_amount > 0:
        df = df.where(F.col("obligated_amount") >= min_amount)
    return df


def search_contracts(df: DataFrame, *, top_n=15, **filters) -> DataFrame:
    """The largest matches, with the number of all matches and the value shown."""
    matches = contract_filter(df, **filters)
    shown = matches.orderBy(F.col("obligated_amount").desc_nulls_last(), "contract_id").limit(top_n)
    total = matches.agg(F.count("*")).scalar()
    value = F.sum("obligated_amount").over(series_window(None))
    return shown.withColumns({"total_matches": total, "value_shown": value})
