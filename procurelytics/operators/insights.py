"""Trend, anomaly, confidence, health and briefing reports.

All of them read monthly signal rows.  A rank by age inside each series turns
"last n months" into conditional aggregates, so a report over many series is one
grouped pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from procurelytics import constants as K
from procurelytics.functions.bands import band, clamp, ladder
from procurelytics.functions.stats import correlation_p_value
from procurelytics.operators.ranking import (
    as_list, future_head, latest_period, one_row, series_window, tail_n, with_age,
)

VALUE = "total_obligations_usd"
RISKS = ["geo_risk_index", "tariff_risk_index", "weather_disruption_index", "commodity_cost_pressure"]


def recent(column, months: int, skip: int = 0) -> Column:
    """The column on the last ``months`` rows (after ``skip``), NULL elsewhere."""
    value = F.col(column) if isinstance(column, str) else column
    return F.when((F.col("age") > skip) & (F.col("age") <= months + skip), value)


def at_age(column: str, age: int = 1) -> Column:
    return F.max(F.when(F.col("age") == age, F.col(column)))


def variation(value: Column) -> Column:
    """Coefficient of variation with the population deviation."""
    return F.try_divide(F.stddev_pop(value), F.avg(value))


def relative_change(value: Column, base: Column) -> Column:
    """``(value - base) / base``; from a base of 0 any change is infinite."""
    jump = F.when(value != 0, F.signum(value) * F.lit(float("inf")))
    return F.when(base == 0, jump).otherwise(F.try_divide(value - base, base))


def fit_quality(value: Column) -> Column:
    """R squared of a straight line through the values in time order."""
    return F.regr_r2(value, F.when(value.isNotNull(), -F.col("age").cast("double")))


def slope(value: Column) -> Column:
    return F.regr_slope(value, F.when(value.isNotNull(), -F.col("age").cast("double")))


# --- forecasts ----------------------------------------------------------------
def forecast_next_n(fc: DataFrame, *, as_of: Column, n=3) -> DataFrame:
    """The next ``n`` forecast months with their total and mean on every row."""
    rows = future_head(fc, n, as_of).select("month", "forecast_demand_usd", "forecast_lower", "forecast_upper")
    whole = series_window(None, "month").rowsBetween(-n, n)
    return rows.withColumns({
        "total_forecast": F.sum("forecast_demand_usd").over(whole),
        "monthly_average": F.avg("forecast_demand_usd").over(whole),
    })


def compare_forecasts(models: dict, *, as_of: Column, months_ahead=3) -> DataFrame:
    """Models side by side by month, with mean, spread and the agreement over all shown
    months.  Rows are matched on the month, so a model that skips a month does not
    shift the others."""
    labelled = [
        future_head(df, months_ahead, as_of).select("month", F.lit(name).alias("model"), "forecast_demand_usd")
        for name, df in models.items()
    ]
    rows = reduce(DataFrame.unionByName, labelled)
    forecast = F.col("forecast_demand_usd")
    columns = [F.max(F.when(F.col("model") == name, forecast)).alias(name) for name in models]
    by_month = rows.groupBy("month").agg(
        *columns,
        F.count("*").alias("n_models"),
        F.avg(forecast).alias("ensemble_avg"),
        (F.try_divide(F.stddev_pop(forecast), F.avg(forecast)) * 100).alias("spread_pct"),
    )
    shown = by_month.orderBy("month").limit(months_ahead)
    whole = series_window(None, "month").rowsBetween(-months_ahead, months_ahead)
    mean = F.avg(F.when(F.col("n_models") > 1, F.col("spread_pct"))).over(whole)
    return shown.withColumn("avg_spread_pct", mean).withColumn(
        "agreement", F.when(F.col("avg_spread_pct").isNotNull(), band(F.col("avg_spread_pct"), K.AGREEMENT_BANDS, "LOW"))
    )


def forecast_tail(models: dict, n=6) -> DataFrame:
    """The last ``n`` rows of each model's table."""
    parts = [
        tail_n(df, n).select(F.lit(name).alias("model"), "month", "forecast_demand_usd", "forecast_lower", "forecast_upper")
        for name, df in models.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def forecast_confidence(signals: DataFrame, *, as_of: Column, months=12, series=None) -> DataFrame:
    """Stability (35%), trend (30%), risk steadiness (25%) and recency (10%).  Risk indices
    with a mean of 0 or less are left out; with none left the score is 50."""
    aged = with_age(signals, series=series).where(F.col("age") <= months)
    y = F.col(VALUE)
    risks = ["geo_risk_index", "tariff_risk_index", "weather_disruption_index"]
    base = aged.groupBy(*as_list(series)).agg(
        variation(y).alias("cv"), fit_quality(y).alias("r2"), F.max("month").alias("last_month"),
        F.count(y).alias("months_used"),
        *[F.avg(r).alias(f"m_{r}") for r in risks], *[F.stddev_samp(r).alias(f"s_{r}") for r in risks],
    )
    steady = F.array_compact(F.array(*[
        F.when(F.col(f"m_{r}") > 0, F.greatest(F.lit(0.0), 100 - F.col(f"s_{r}") / (F.col(f"m_{r}") + 1e-9) * 100))
        for r in risks
    ]))
    mean = F.aggregate(steady, F.lit(0.0), lambda a, x: a + x) / F.size(steady)
    days = F.datediff(as_of, "last_month")
    scored = base.select(
        *as_list(series), "cv", "r2", "last_month", days.alias("days_since_last"), "months_used",
        F.greatest(F.lit(0.0), 100 - F.col("cv") * 200).alias("stability_score"),
        (F.col("r2") * 100).alias("trend_score"),
        F.when(F.size(steady) > 0, mean).otherwise(50.0).alias("risk_score"),
        F.greatest(F.lit(0.0), 100 - days / 30 * 50).alias("recency_score"),
    )
    # t statistic of the slope: r * sqrt((n - 2) / (1 - r2))
    t = F.sqrt(F.try_divide(F.col("r2") * (F.col("months_used") - 2), 1 - F.col("r2")))
    overall = (
        F.col("stability_score") * 0.35 + F.col("trend_score") * 0.30
        + F.col("risk_score") * 0.25 + F.col("recency_score") * 0.10
    )
    return scored.withColumns({
        "t_statistic": t, "p_value": correlation_p_value(F.col("r2"), F.col("months_used")), "overall": overall, "confidence": band(overall, K.CONFIDENCE_BANDS, "LOW"),
    })


# --- trends and anomalies --------------------------------------------------------
def detect_anomalies(signals: DataFrame, *, threshold_pct=20.0, lookback=6, series=None) -> DataFrame:
    """Recent months that differ from the mean of all earlier months by more than
    ``threshold_pct``."""
    aged = with_age(signals, series=series)
    whole = series_window(series, "month").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    base = F.avg(F.when(F.col("age") > lookback, F.col(VALUE))).over(whole)
    rows = aged.withColumn("baseline", base).where(F.col("age") <= lookback)
    deviation = relative_change(F.col(VALUE), F.col("baseline")) * 100
    flagged = rows.withColumn("deviation_pct", deviation).where(F.abs("deviation_pct") > threshold_pct)
    return flagged.select(
        *as_list(series), "month", VALUE, "baseline", "deviation_pct",
        band(F.abs("deviation_pct"), K.ANOMALY_BANDS, "MODERATE").alias("severity"), "combined_risk_index",
    )


def trend_growth(signals: DataFrame, *, lookback=12, series=None) -> DataFrame:
    aged = with_age(signals, series=series).where(F.col("age") <= lookback)
    y = F.col(VALUE)
    fitted = aged.groupBy(*as_list(series)).agg(
        slope(y).alias("slope"), fit_quality(y).alias("r2"), F.avg(y).alias("mean_demand"), F.count(y).alias("months_used"),
    )
    monthly = F.try_divide(F.col("slope"), F.col("mean_demand")) * 100
    return fitted.withColumns({
        "direction": F.when(F.col("slope") > 0, "Increasing").otherwise("Decreasing"),
        "monthly_growth_pct": monthly,
        "annualized_growth_pct": monthly * 12,
        "p_value": correlation_p_value(F.col("r2"), F.col("months_used")),
    })


def seasonality(signals: DataFrame, *, lookback=12, series=None) -> DataFrame:
    """Peak and trough month of the year and the amplitude between them."""
    keys = as_list(series)
    aged = with_age(signals, series=series).where(F.col("age") <= lookback)
    monthly = aged.groupBy(*keys, F.month("month").alias("moy")).agg(F.avg(VALUE).alias("mean"))
    high, low = F.struct(F.col("mean"), -F.col("moy")), F.struct(F.col("mean"), F.col("moy"))
    out = monthly.groupBy(*keys).agg(
        F.max_by("moy", high).alias("peak_month"), F.max("mean").alias("peak_demand"),
        F.min_by("moy", low).alias("trough_month"), F.min("mean").alias("trough_demand"),
        (F.try_divide(F.max("mean") - F.min("mean"), F.avg("mean")) * 100).alias("amplitude_pct"),
    )
    return out.withColumn("assessment", band(F.col("amplitude_pct"), K.AMPLITUDE_BANDS, "LOW"))


def volatility_swings(signals: DataFrame, value=VALUE, order="month", *, lookback=12, threshold=0.2, series=None) -> DataFrame:
    """Deviation, variation and the number of month-to-month changes beyond the threshold,
    all inside the last ``lookback`` months."""
    before = F.lag(value).over(series_window(series, order))
    aged = with_age(signals, order, series).where(F.col("age") <= lookback)
    moves = aged.withColumn("_move", F.abs(relative_change(F.col(value), before)))
    y = F.col(value)
    out = moves.groupBy(*as_list(series)).agg(
        F.stddev_pop(y).alias("std_dev"), variation(y).alias("cv"),
        F.count_if(F.col("_move") > threshold).alias("large_swings"),
    )
    return out.withColumn("assessment", band(F.col("cv"), K.CV_BANDS, "LOW"))


def risk_correlations(signals: DataFrame, *, lookback=12, series=None,
                      columns=("geo_risk_index", "tariff_risk_index", "commodity_cost_pressure")) -> DataFrame:
    """Correlation of demand with each risk column, with its two-sided p-value; a constant column gives no row."""
    keys = as_list(series)
    aged = with_age(signals, series=series).where(F.col("age") <= lookback)
    both = {c: F.col(VALUE).isNotNull() & F.col(c).isNotNull() for c in columns}

    def correlation(c):
        y, x = F.when(both[c], F.col(VALUE)), F.when(both[c], F.col(c))
        return F.try_divide(F.covar_pop(y, x), F.stddev_pop(y) * F.stddev_pop(x)).alias(c)

    wide = aged.groupBy(*keys).agg(*[correlation(c) for c in columns], *[F.count_if(there).alias(f"n_{c}") for c, there in both.items()])
    pairs = F.array(*[F.struct(F.lit(c).alias("risk"), F.col(c).alias("correlation"), F.col(f"n_{c}").alias("n_pairs")) for c in columns])
    long = wide.select(*keys, F.inline(pairs))
    valid = long.where(F.col("correlation").isNotNull() & ~F.isnan("correlation"))
    return valid.withColumns({
        "strength": band(F.abs("correlation"), K.CORRELATION_BANDS, "Weak"),
        "p_value": correlation_p_value(F.col("correlation") * F.col("correlation"), F.col("n_pairs")),
    })


def macro_context(indicators: DataFrame, *, codes=None, tail=5, pressure_codes=("GSCPI",)) -> DataFrame:
    """Per indicator and country: newest value and date, the last ``tail`` values (newest first),
    whether the newest of the last three lies above the first of them, and the pressure level for
    the indicators that are pressure indices (NULL for others).  ``codes`` limits the indicators."""
    keys = ["indicator_code", "country_code"]
    if "country_code" not in indicators.columns:
        indicators = indicators.withColumn("country_code", F.lit(""))
    rows = indicators if codes is None else indicators.where(F.col("indicator_code").isin(list(codes)))
    aged = with_age(rows, "as_of_date", keys).where(F.col("age") <= tail)
    out = aged.groupBy(*keys).agg(
        at_age("value").alias("latest_value"), at_age("as_of_date").alias("latest_date"),
        F.max(F.when(F.col("age") == 3, F.col("value"))).alias("_third"),
        F.count("*").alias("values_shown"),
        F.transform(F.sort_array(F.collect_list(F.struct("age", "value"))), lambda x: x["value"]).alias("last_values"),
    )
    rising = F.when(F.col("latest_value") > F.col("_third"), "INCREASING").otherwise("DECREASING")
    pressure = F.col("indicator_code").isin(list(pressure_codes))
    return out.withColumns({
        "level": F.when(pressure, band(F.col("latest_value"), K.GSCPI_BANDS, "LOW")),
        "trend_3": F.when(F.col("values_shown") >= 3, rising),
    }).drop("_third")


# --- health ---------------------------------------------------------------------------
def _demand_scores(signals: DataFrame) -> DataFrame:
    aged = with_age(signals).where(F.col("age") <= 12)
    y6, y12 = recent(VALUE, 6), recent(VALUE, 12)
    risks = [F.avg(recent(r, 3)) for r in RISKS]
    mean_risk = sum(risks[1:], risks[0]) / len(risks)
    dashboard_risk = sum(risks[1:3], risks[0]) / 3
    return aged.agg(
        clamp(100 - F.try_divide(F.stddev_samp(y6), F.avg(y6)) * 200).alias("stability"),
        clamp(100 - mean_risk * 10).alias("risk"),
        (F.greatest(F.lit(0.0), 100 - variation(y12) * 200) * 0.5 + fit_quality(y12) * 100 * 0.5).alias("reliability"),
        F.when(F.count(y12) > 1, clamp(100 - variation(y12) * 200)).alias("stability_12"),
        clamp(100 - dashboard_risk * 10).alias("risk_3"),
    )


def _newest_metrics(metrics: DataFrame) -> DataFrame:
    return metrics.select("month", "days_of_supply_proxy", "nmcs_risk_indicator").orderBy(F.col("month").desc()).limit(1)


def _dimension_rows(one: DataFrame, scores: dict, overall_bands, worst, bands, lowest) -> DataFrame:
    """One row per dimension, with the mean of the available ones."""
    rows = F.array(*[F.struct(F.lit(n).alias("dimension"), c.cast("double").alias("score")) for n, c in scores.items()])
    there = F.filter(rows, lambda r: r["score"].isNotNull())
    mean = F.aggregate(there, F.lit(0.0), lambda a, r: a + r["score"]) / F.size(there)
    out = one.select(F.when(F.size(there) > 0, mean).otherwise(0.0).alias("overall"), F.inline(rows))
    return out.select(
        "dimension", "score",
        F.when(F.col("score").isNotNull(), band(F.col("score"), bands, lowest)).alias("status"),
        F.coalesce(F.col("score") < 50, F.lit(False)).alias("needs_attention"),
        "overall", band(F.col("overall"), overall_bands, worst).alias("overall_status"),
    )


def health_scores(signals: DataFrame, suppliers: DataFrame, commodity: DataFrame, metrics: DataFrame) -> DataFrame:
    """Six dimensions, each 0 to 100; one without data is left out of the mean."""
    base = suppliers.agg(
        F.when(F.count("*") > 0, F.least(
            F.lit(100.0), F.count("*") / 2 + F.count_distinct("region_group") * 10,
        )).alias("score"))
    material = latest_period(commodity, "month").agg(clamp(80 - F.avg("cost_pressure_score") * 2).alias("score"))
    days, supply = F.col("days_of_supply_proxy"), F.col("nmcs_risk_indicator")
    penalty = ladder([(supply.contains("HIGH"), 30), (supply.contains("ELEVATED"), 15)], 0)
    ready = _newest_metrics(metrics).select(
        F.greatest(F.lit(0.0), F.least(F.lit(100.0), days / 60 * 100) - penalty).alias("score"))
    one = _demand_scores(signals).withColumns({
        "supplier": base.scalar(), "material": material.scalar(), "readiness": ready.scalar(),
    })
    return _dimension_rows(one, {
        "Demand Stability": F.col("stability"),
        "Risk Environment": F.col("risk"),
        "Supplier Base": F.col("supplier"),
        "Material Costs": F.col("material"),
        "Forecast Reliability": F.col("reliability"),
        "Readiness": F.col("readiness"),
    }, K.HEALTH_BANDS, "CRITICAL", K.DIMENSION_BANDS, "Critical")


def health_scores_dashboard(signals: DataFrame, metrics: DataFrame) -> DataFrame:
    """The three-dimension variant: a twelve-month window and bands at 70 and 40."""
    ready = _newest_metrics(metrics).select(F.least(F.lit(100.0), F.col("days_of_supply_proxy") / 60 * 100).alias("score"))
    one = _demand_scores(signals).withColumn("readiness", ready.scalar())
    return _dimension_rows(one, {
        "Demand Stability": F.col("stability_12"),
        "Risk Environment": F.col("risk_3"),
        "Readiness": F.col("readiness"),
    }, K.DASHBOARD_BANDS, "Poor", K.DASHBOARD_BANDS, "Poor").drop("needs_attention")


def _quarter_numbers(signals: DataFrame) -> DataFrame:
    aged = with_age(signals).where(F.col("age") <= 12)
    last, prior = F.avg(recent(VALUE, 3)), F.avg(recent(VALUE, 3, skip=3))
    qoq = F.when(prior > 0, (last - prior) / prior * 100).otherwise(0.0)
    return aged.agg(
        F.max("month").alias("as_of_month"),
        last.alias("last_quarter_avg"), F.avg(VALUE).alias("twelve_month_avg"), qoq.alias("qoq_change_pct"),
        *[at_age(r).alias(r) for r in RISKS],
    )


def _pressure(gscpi: DataFrame) -> Column:
    return gscpi.select("as_of_date", "value").orderBy(F.col("as_of_date").desc()).limit(1).select("value").scalar()


def dashboard_kpis(signals: DataFrame, metrics: DataFrame, gscpi: DataFrame) -> DataFrame:
    one = _quarter_numbers(signals).withColumns({"_m": one_row(_newest_metrics(metrics)), "gscpi": _pressure(gscpi)})
    return one.select(
        "last_quarter_avg", "twelve_month_avg", "qoq_change_pct",
        F.col("_m.days_of_supply_proxy").alias("days_of_supply"), F.col("_m.nmcs_risk_indicator").alias("nmcs_risk"), "gscpi",
    )


def executive_briefing(signals: DataFrame, fc: DataFrame, metrics: DataFrame, gscpi: DataFrame, *, as_of: Column) -> DataFrame:
    """One row: demand outlook, risk snapshot, next quarter, readiness, pressure, actions."""
    ahead = future_head(fc, 3, as_of).agg(F.avg("forecast_demand_usd").alias("mean"), F.count("*").alias("n"))
    one = _quarter_numbers(signals).withColumns({
        "_m": one_row(_newest_metrics(metrics)), "gscpi": _pressure(gscpi), "_f": one_row(ahead),
    })
    high = F.lit(K.BRIEFING_RISK_BANDS[0][1])
    supply = F.col("_m.nmcs_risk_indicator")
    actions = F.array_compact(F.array(
        F.when(F.col("geo_risk_index") > high, "Increase safety stock"),
        F.when(F.col("tariff_risk_index") > high, "Diversify sourcing"),
        F.when(F.col("commodity_cost_pressure") > high, "Lock in commodity contracts"),
        F.when(supply == "HIGH_RISK", "Expedite critical part orders"),
    ))
    qoq = F.col("qoq_change_pct")
    return one.select(
        "as_of_month", "last_quarter_avg", "twelve_month_avg", "qoq_change_pct",
        ladder([(qoq > 2, "Growing"), (qoq < -2, "Declining")], "Stable").alias("demand_trend"),
        *RISKS,
        *[F.when(F.col(r).isNotNull(), band(F.col(r), K.BRIEFING_RISK_BANDS, "Low")).alias(f"{r}_level") for r in RISKS],
        F.col("_f.mean").alias("next_quarter_avg"), F.col("_f.n").alias("forecast_months"),
        F.col("_m.days_of_supply_proxy").alias("days_of_supply"), supply.alias("nmcs_risk"),
        "gscpi", F.when(F.col("gscpi").isNotNull(), band(F.col("gscpi"), K.GSCPI_BANDS, "LOW")).alias("gscpi_level"),
        F.when(F.size(actions) > 0, F.array_join(actions, "; ")).otherwise("Continue standard operations").alias("actions"),
    )
