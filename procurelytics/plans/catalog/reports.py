"""Serving reports, scenarios, drivers and forecast comparison."""

from pyspark.sql import functions as F

from procurelytics import constants as K
from procurelytics.functions.bands import choose, lookup
from procurelytics.operators import drivers, insights, ranking, scenario
from procurelytics.plans import bindings as B
from procurelytics.plans.catalog import views as V
from procurelytics.plans.registry import cte, query, shown, sql
from procurelytics.session import cut_lineage
from procurelytics.sources.tables import literal_rows

AS_OF = f"DATE '{B.AS_OF}'"
MODELS = ("prophet", "arima", "random_forest")
cte("aged", "signals", "SELECT *, row_number() OVER (ORDER BY month DESC) AS age FROM signals")
cte("last12", "aged", "SELECT *, -age AS x, total_obligations_usd AS y FROM aged WHERE age <= 12")
cte("vendor_aged", "vendor_demand", """
SELECT *, row_number() OVER (PARTITION BY series ORDER BY month DESC) AS age, total_obligations_usd AS y,
       lag(total_obligations_usd) OVER (PARTITION BY series ORDER BY month) AS before FROM vendor_demand""")


# --- forecasts ------------------------------------------------------------------------
@query("forecast_next_n", sql("forecasts", f"""
SELECT *, sum(forecast_demand_usd) OVER () AS total_forecast, avg(forecast_demand_usd) OVER () AS monthly_average FROM (
SELECT month, forecast_demand_usd, forecast_lower, forecast_upper FROM forecasts WHERE model = 'prophet' AND month > {AS_OF} ORDER BY month LIMIT 6)""",
                              doubles="forecast_demand_usd forecast_lower forecast_upper total_forecast monthly_average", digits=2))
def forecast_next_n(spark, d):
    return shown(insights.forecast_next_n(B.forecasts(B.demand_signals(spark, d))["prophet"], as_of=B.as_of(), n=6), digits=2)


@query("compare_forecasts", sql("forecasts", f"""
SELECT *, {V.bands('avg_spread_pct', K.AGREEMENT_BANDS, 'LOW')} AS agreement FROM (
SELECT *, avg(spread_pct) OVER () AS avg_spread_pct FROM (
SELECT month, {', '.join(f"max(CASE WHEN model = '{m}' THEN forecast_demand_usd END) AS {m}" for m in MODELS)}, count(*) AS n_models,
       avg(forecast_demand_usd) AS ensemble_avg, stddev_pop(forecast_demand_usd) / avg(forecast_demand_usd) * 100 AS spread_pct
FROM forecasts WHERE month > {AS_OF} GROUP BY 1 ORDER BY 1 LIMIT 3))""", ints="n_models", digits=2,
                                doubles="prophet arima random_forest ensemble_avg spread_pct avg_spread_pct"))
def compare_forecasts(spark, d):
    return shown(insights.compare_forecasts(B.forecasts(B.stored_signals(spark, d)), as_of=B.as_of(), months_ahead=3), digits=2)


@query("forecast_tail", sql("forecasts", """
SELECT model, month, forecast_demand_usd, forecast_lower, forecast_upper FROM forecasts
QUALIFY row_number() OVER (PARTITION BY model ORDER BY month DESC) <= 6""", doubles="forecast_demand_usd forecast_lower forecast_upper", digits=2))
def forecast_tail(spark, d):
    return shown(insights.forecast_tail(B.forecasts(B.stored_signals(spark, d)), 6), digits=2)


RISK3 = ["geo_risk_index", "tariff_risk_index", "weather_disruption_index"]
STEADY = ", ".join(f"CASE WHEN avg({r}) > 0 THEN greatest(0, 100 - stddev_samp({r}) / (avg({r}) + 1e-9) * 100) END" for r in RISK3)


@query("forecast_confidence", sql("last12", f"""
SELECT *, {V.bands('overall', K.CONFIDENCE_BANDS, 'LOW')} AS confidence FROM (
SELECT *, stability_score * 0.35 + trend_score * 0.30 + risk_score * 0.25 + recency_score * 0.10 AS overall,
       sqrt(r2 * (months_used - 2) / (1 - r2)) AS t_statistic FROM (
SELECT stddev_pop(y) / avg(y) AS cv, regr_r2(y, x) AS r2, max(month) AS last_month, date_diff('day', max(month), DATE '2001-08-15') AS days_since_last,
       count(y) AS months_used, greatest(0, 100 - stddev_pop(y) / avg(y) * 200) AS stability_score, regr_r2(y, x) * 100 AS trend_score,
       coalesce(list_avg([{STEADY}]), 50) AS risk_score, greatest(0, 100 - date_diff('day', max(month), DATE '2001-08-15') / 30 * 50) AS recency_score
FROM last12))""", ints="days_since_last months_used",
                                  doubles="cv r2 stability_score trend_score risk_score recency_score overall t_statistic"))
def forecast_confidence(spark, d):
    return shown(insights.forecast_confidence(B.demand_signals(spark, d), as_of=F.lit("2001-08-15").cast("date")).drop("p_value"))


# --- trends --------------------------------------------------------------------------
@query("detect_anomalies", sql("vendor_aged", f"""
SELECT series, month, total_obligations_usd, baseline, deviation_pct, {V.bands('abs(deviation_pct)', K.ANOMALY_BANDS, 'MODERATE')} AS severity,
       combined_risk_index FROM (
SELECT *, (y - baseline) / baseline * 100 AS deviation_pct FROM (
SELECT *, avg(CASE WHEN age > 6 THEN y END) OVER (PARTITION BY series) AS baseline FROM vendor_aged) WHERE age <= 6)
WHERE abs(deviation_pct) > 20""", ints="series", doubles="total_obligations_usd baseline deviation_pct combined_risk_index"))
def detect_anomalies(spark, d):
    return shown(insights.detect_anomalies(B.vendor_demand(spark, d), series="series"))


@query("trend_growth", sql("vendor_aged", """
SELECT *, CASE WHEN slope > 0 THEN 'Increasing' ELSE 'Decreasing' END AS direction, slope / mean_demand * 100 AS monthly_growth_pct,
       slope / mean_demand * 100 * 12 AS annualized_growth_pct FROM (
SELECT series, regr_slope(y, -age) AS slope, regr_r2(y, -age) AS r2, avg(y) AS mean_demand, count(y) AS months_used
FROM vendor_aged WHERE age <= 12 GROUP BY 1)""", ints="series months_used",
                           doubles="slope r2 mean_demand monthly_growth_pct annualized_growth_pct"))
def trend_growth(spark, d):
    return shown(insights.trend_growth(B.vendor_demand(spark, d), series="series").drop("p_value"))


def t_tail(r2: str, n: str) -> str:
    """The two-sided tail of Student's t with n - 2 degrees of freedom as the finite sums that hold for whole ones."""
    even = f"sqrt({r2}) * coalesce(list_sum(list_transform(range(0, ({n} - 2) // 2), lambda k: exp(lgamma(k + 0.5) - lgamma(k + 1)) / sqrt(pi()) * pow(1 - {r2}, k))), 0)"
    odd = (f"2 / pi() * (asin(sqrt({r2})) + sqrt({r2} * (1 - {r2})) * coalesce(list_sum(list_transform(range(0, ({n} - 3) // 2), "
           f"lambda k: exp(lgamma(k + 1) - lgamma(k + 1.5)) * sqrt(pi()) / 2 * pow(1 - {r2}, k))), 0))")
    return f"CASE WHEN {n} > 2 THEN 1 - CASE WHEN {n} % 2 = 0 THEN {even} ELSE {odd} END END"


@query("trend_p_values", sql("vendor_aged", f"""
SELECT series, lookback, months_used, {t_tail('r2', 'months_used')} AS p_value FROM (
SELECT series, lookback, regr_r2(y, -age) AS r2, count(y) AS months_used FROM vendor_aged CROSS JOIN (VALUES (12), (25)) l(lookback) WHERE age <= lookback GROUP BY 1, 2)""",
                             ints="series lookback months_used", doubles="p_value", digits=6))
def trend_p_values(spark, d):
    rows = B.vendor_demand(spark, d)
    parts = [insights.trend_growth(rows, lookback=n, series="series").select("series", F.lit(n).alias("lookback"), "months_used", "p_value") for n in (12, 25)]
    return shown(parts[0].unionByName(parts[1]), digits=6)


RISK_PAIRS = ("geo_risk_index", "tariff_risk_index")
cte("type_aged", "type_demand", "SELECT *, row_number() OVER (PARTITION BY series ORDER BY month DESC) AS age FROM type_demand")


@query("correlation_p_values", sql("type_aged", f"""
SELECT *, {t_tail('(correlation * correlation)', 'n_pairs')} AS p_value FROM (
{' UNION ALL '.join(f"SELECT series, '{r}' AS risk, corr(total_obligations_usd, {r}) AS correlation, count(*) FILTER (total_obligations_usd IS NOT NULL AND {r} IS NOT NULL) AS n_pairs FROM type_aged WHERE age <= 25 GROUP BY 1" for r in RISK_PAIRS)}
) WHERE correlation IS NOT NULL AND NOT isnan(correlation)""", ints="n_pairs", doubles="correlation p_value", digits=6))
def correlation_p_values(spark, d):
    out = insights.risk_correlations(B.type_demand(spark, d), lookback=25, series="series", columns=RISK_PAIRS)
    return shown(out, "series", "risk", "n_pairs", "correlation", "p_value", digits=6)


@query("confidence_p_value", sql("last12", f"SELECT max(month) AS last_month, count(y) AS months_used, {t_tail('regr_r2(y, x)', 'count(y)')} AS p_value FROM last12",
                                 ints="months_used", doubles="p_value", digits=6))
def confidence_p_value(spark, d):
    out = insights.forecast_confidence(B.demand_signals(spark, d), as_of=F.lit("2001-08-15").cast("date"))
    return shown(out, "last_month", "months_used", "p_value", digits=6)


@query("seasonality", sql("vendor_aged", f"""
SELECT *, {V.bands('amplitude_pct', K.AMPLITUDE_BANDS, 'LOW')} AS assessment FROM (
SELECT series, arg_max(moy, mean) AS peak_month, max(mean) AS peak_demand, arg_min(moy, mean) AS trough_month, min(mean) AS trough_demand,
       (max(mean) - min(mean)) / avg(mean) * 100 AS amplitude_pct FROM (
SELECT series, month(month) AS moy, avg(y) AS mean FROM vendor_aged WHERE age <= 24 GROUP BY 1, 2) GROUP BY 1)""",
                          ints="series peak_month trough_month", doubles="peak_demand trough_demand amplitude_pct"))
def seasonality(spark, d):
    return shown(insights.seasonality(B.vendor_demand(spark, d), lookback=24, series="series"))


@query("volatility_swings", sql("vendor_aged", f"""
SELECT *, {V.bands('cv', K.CV_BANDS, 'LOW')} AS assessment FROM (
SELECT series, stddev_pop(y) AS std_dev, stddev_pop(y) / avg(y) AS cv, sum(CASE WHEN age < 12 AND abs((y - before) / before) > 0.2 THEN 1 ELSE 0 END) AS large_swings
FROM vendor_aged WHERE age <= 12 GROUP BY 1)""", ints="series large_swings", doubles="std_dev cv"))
def volatility_swings(spark, d):
    return shown(insights.volatility_swings(B.vendor_demand(spark, d), series="series"))


@query("risk_correlations", sql("last12", f"""
SELECT *, {V.bands('abs(correlation)', K.CORRELATION_BANDS, 'Weak')} AS strength FROM (
{' UNION ALL '.join(f"SELECT '{r}' AS risk, corr(y, {r}) AS correlation FROM last12" for r in ("geo_risk_index", "tariff_risk_index", "commodity_cost_pressure"))}
) WHERE correlation IS NOT NULL AND NOT isnan(correlation)""", doubles="correlation"))
def risk_correlations(spark, d):
    return shown(insights.risk_correlations(B.demand_signals(spark, d)).drop("n_pairs", "p_value"))


@query("macro_context", sql("", f"""
SELECT *, CASE WHEN indicator_code = 'GSCPI' THEN {V.bands('latest_value', K.GSCPI_BANDS, 'LOW')} END AS level FROM (
SELECT indicator_code, country_code, max(CASE WHEN age = 1 THEN value END) AS latest_value, max(CASE WHEN age = 1 THEN as_of_date END) AS latest_date, count(*) AS values_shown,
       round(sum(value * (10 - age)) + 1e-7, 1) AS weighted,
       CASE WHEN count(*) >= 3 THEN CASE WHEN max(CASE WHEN age = 1 THEN value END) > max(CASE WHEN age = 3 THEN value END) THEN 'INCREASING' ELSE 'DECREASING' END END AS trend_3
FROM (SELECT *, row_number() OVER (PARTITION BY indicator_code, country_code ORDER BY as_of_date DESC) AS age FROM (
  SELECT 'ORDERS' AS indicator_code, CAST(c_nationkey AS VARCHAR) AS country_code, CAST(date_trunc('month', o_orderdate) AS DATE) AS as_of_date, avg(o_totalprice) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3
  UNION ALL SELECT 'GSCPI', '', CAST(date_trunc('month', o_orderdate) AS DATE), avg(o_totalprice) / 100000 - 2.5 FROM orders GROUP BY 3)) WHERE age <= 5 GROUP BY 1, 2)""",
                            ints="values_shown", doubles="latest_value weighted", latest_value=2, weighted=1))
def macro_context(spark, d):
    out = insights.macro_context(B.macro_indicators(spark, d))
    weighted = F.aggregate(F.transform("last_values", lambda v, i: v * (9 - i)), F.lit(0.0), lambda a, x: a + x)
    return shown(out.withColumn("weighted", F.round(weighted + 1e-7, 1)).drop("last_values"), latest_value=2, weighted=1)


@query("latest_per_indicator", sql("price_ind", """
SELECT indicator_code, as_of_date, value FROM price_ind QUALIFY row_number() OVER (PARTITION BY indicator_code ORDER BY as_of_date DESC) = 1""", doubles="value"))
def latest_per_indicator(spark, d):
    return shown(ranking.latest_per(B.price_indicators(spark, d), "indicator_code", "as_of_date"), "indicator_code", "as_of_date", "value")


@query("tail_windows", sql("aged", """
SELECT 'last' AS part, month, total_obligations_usd FROM aged WHERE age <= 3
UNION ALL SELECT 'before', month, total_obligations_usd FROM aged WHERE age BETWEEN 4 AND 6""", doubles="total_obligations_usd", digits=2))
def tail_windows(spark, d):
    rows = B.stored_signals(spark, d).select("month", "total_obligations_usd")
    last = ranking.tail_n(rows, 3).select(F.lit("last").alias("part"), "*")
    return shown(last.unionByName(ranking.tail_n(rows, 3, skip=3).select(F.lit("before").alias("part"), "*")), digits=2)


# --- health ---------------------------------------------------------------------------
RISKS = insights.RISKS


def clamp(x):
    return f"greatest(0, least(100, {x}))"


cte("demand_scores", "last12", f"""
SELECT {clamp('100 - stddev_samp(CASE WHEN age <= 6 THEN y END) / avg(CASE WHEN age <= 6 THEN y END) * 200')} AS stability,
       {clamp('100 - (' + ' + '.join(f'avg(CASE WHEN age <= 3 THEN {r} END)' for r in RISKS) + ') / 4 * 10')} AS risk,
       greatest(0, 100 - stddev_pop(y) / avg(y) * 200) * 0.5 + regr_r2(y, x) * 50 AS reliability,
       {clamp('100 - stddev_pop(y) / avg(y) * 200')} AS stability_12,
       {clamp('100 - (' + ' + '.join(f'avg(CASE WHEN age <= 3 THEN {r} END)' for r in RISK3) + ') / 3 * 10')} AS risk_3
FROM last12""")
cte("newest_gold", "gold", "SELECT * FROM gold ORDER BY month DESC LIMIT 1")
cte("supplier_score", "suppliers", "SELECT least(100, count(*) / 2 + count(DISTINCT region_group) * 10) AS score FROM suppliers")
cte("material_score", "prices", f"SELECT {clamp('80 - avg(cost_pressure_score) * 2')} AS score FROM prices WHERE month = (SELECT max(month) FROM prices)")


def dimensions(rows, overall_bands, worst, bands, lowest):
    union = " UNION ALL ".join(f"SELECT '{name}' AS dimension, {expr} AS score" for name, expr in rows)
    return f"""
SELECT *, {V.bands('score', bands, lowest)} AS status, score < 50 AS needs_attention, {V.bands('overall', overall_bands, worst)} AS overall_status
FROM (SELECT *, avg(score) OVER () AS overall FROM ({union}))"""


PENALTY = "(SELECT CASE WHEN contains(nmcs_risk_indicator, 'HIGH') THEN 30 WHEN contains(nmcs_risk_indicator, 'ELEVATED') THEN 15 ELSE 0 END FROM newest_gold)"
READY = "least(100, (SELECT days_of_supply_proxy FROM newest_gold) / 60 * 100)"


@query("health_scores", sql("demand_scores newest_gold supplier_score material_score", dimensions([
    ("Demand Stability", "(SELECT stability FROM demand_scores)"), ("Risk Environment", "(SELECT risk FROM demand_scores)"),
    ("Supplier Base", "(SELECT score FROM supplier_score)"), ("Material Costs", "(SELECT score FROM material_score)"),
    ("Forecast Reliability", "(SELECT reliability FROM demand_scores)"), ("Readiness", f"greatest(0, {READY} - {PENALTY})"),
], K.HEALTH_BANDS, "CRITICAL", K.DIMENSION_BANDS, "Critical"), doubles="score overall"))
def health_scores(spark, d):
    signals = B.stored_signals(spark, d)
    return shown(insights.health_scores(signals, B.supplier_locations(spark, d), cut_lineage(B.price_table(spark, d)), B.inventory_gold(signals)))


@query("health_scores_dashboard", sql("demand_scores newest_gold", "SELECT dimension, score, status, overall, overall_status FROM (" + dimensions([
    ("Demand Stability", "(SELECT stability_12 FROM demand_scores)"), ("Risk Environment", "(SELECT risk_3 FROM demand_scores)"), ("Readiness", READY),
], K.DASHBOARD_BANDS, "Poor", K.DASHBOARD_BANDS, "Poor") + ")", doubles="score overall"))
def health_scores_dashboard(spark, d):
    signals = B.stored_signals(spark, d)
    return shown(insights.health_scores_dashboard(signals, B.inventory_gold(signals)))


cte("quarter", "last12", f"""
SELECT max(month) AS as_of_month, avg(CASE WHEN age <= 3 THEN y END) AS last_quarter_avg, avg(y) AS twelve_month_avg,
       CASE WHEN avg(CASE WHEN age BETWEEN 4 AND 6 THEN y END) > 0 THEN (avg(CASE WHEN age <= 3 THEN y END) - avg(CASE WHEN age BETWEEN 4 AND 6 THEN y END))
            / avg(CASE WHEN age BETWEEN 4 AND 6 THEN y END) * 100 ELSE 0 END AS qoq_change_pct,
       {', '.join(f'max(CASE WHEN age = 1 THEN {r} END) AS {r}' for r in RISKS)} FROM last12""")
cte("newest_pressure", "pressure", "SELECT value FROM pressure ORDER BY as_of_date DESC LIMIT 1")


@query("dashboard_kpis", sql("quarter newest_gold newest_pressure", """
SELECT last_quarter_avg, twelve_month_avg, qoq_change_pct, (SELECT days_of_supply_proxy FROM newest_gold) AS days_of_supply,
       (SELECT nmcs_risk_indicator FROM newest_gold) AS nmcs_risk, (SELECT value FROM newest_pressure) AS gscpi FROM quarter""",
                             doubles="last_quarter_avg twelve_month_avg qoq_change_pct days_of_supply gscpi", digits=2))
def dashboard_kpis(spark, d):
    signals = B.stored_signals(spark, d)
    return shown(insights.dashboard_kpis(signals, B.inventory_gold(signals), B.pressure_index(spark, d)), digits=2)


@query("executive_briefing", sql("quarter newest_gold newest_pressure forecasts", f"""
SELECT *, {V.bands('gscpi', K.GSCPI_BANDS, 'LOW')} AS gscpi_level,
       CASE WHEN qoq_change_pct > 2 THEN 'Growing' WHEN qoq_change_pct < -2 THEN 'Declining' ELSE 'Stable' END AS demand_trend,
       {', '.join(f"{V.bands(r, K.BRIEFING_RISK_BANDS, 'Low')} AS {r}_level" for r in RISKS)},
       coalesce(nullif(concat_ws('; ', CASE WHEN geo_risk_index > 7 THEN 'Increase safety stock' END, CASE WHEN tariff_risk_index > 7 THEN 'Diversify sourcing' END,
         CASE WHEN commodity_cost_pressure > 7 THEN 'Lock in commodity contracts' END, CASE WHEN nmcs_risk = 'HIGH_RISK' THEN 'Expedite critical part orders' END), ''),
         'Continue standard operations') AS actions
FROM (SELECT (SELECT days_of_supply_proxy FROM newest_gold) AS days_of_supply, (SELECT nmcs_risk_indicator FROM newest_gold) AS nmcs_risk,
             (SELECT value FROM newest_pressure) AS gscpi, * FROM quarter CROSS JOIN (
      SELECT avg(forecast_demand_usd) AS next_quarter_avg, count(*) AS forecast_months FROM (
        SELECT * FROM forecasts WHERE model = 'prophet' AND month > {AS_OF} ORDER BY month LIMIT 3)) f)""", ints="forecast_months", digits=2,
                                 doubles="last_quarter_avg twelve_month_avg qoq_change_pct days_of_supply gscpi next_quarter_avg " + " ".join(RISKS)))
def executive_briefing(spark, d):
    signals = B.stored_signals(spark, d)
    out = insights.executive_briefing(signals, B.forecasts(signals)["prophet"], B.inventory_gold(signals), B.pressure_index(spark, d), as_of=B.as_of())
    return shown(out, digits=2)


# --- scenarios -----------------------------------------------------------------------
cte("base", "last12", "SELECT avg(y) AS baseline_monthly FROM last12")
LEVELS = [("MODERATE", "ALL"), ("elevated", "EUROPE"), ("HIGH", "ALL"), ("CRITICAL", "MIDEAST"), ("OTHER", "ALL")]


@query("scenario_geo", sql("base", f"""
SELECT *, baseline_monthly * multiplier AS projected_monthly, (multiplier - 1) * baseline_monthly * 12 AS annual_impact FROM (
SELECT s.*, baseline_monthly, {V.mapped('upper(risk_level)', K.GEO_MULTIPLIERS, '1.0')} AS multiplier,
       CASE upper(risk_level) WHEN 'CRITICAL' THEN 'Activate surge capacity' WHEN 'HIGH' THEN 'Accelerate procurement'
            WHEN 'ELEVATED' THEN 'Review contingency plans' ELSE 'Continue normal operations' END AS action
FROM (VALUES {', '.join(map(str, LEVELS))}) s(risk_level, region) CROSS JOIN base)""", digits=2,
                           doubles="baseline_monthly multiplier projected_monthly annual_impact"))
def scenario_geo(spark, d):
    return shown(scenario.scenario_geo(B.demand_signals(spark, d), literal_rows(spark, LEVELS, ["risk_level", "region"])), digits=2)


TARIFFS = [(10.0, "ALL"), (25.0, "STEEL"), (60.0, "ALUMINUM")]


@query("scenario_tariff", sql("base", f"""
SELECT *, monthly_tariff_cost / baseline_monthly * 100 AS share_of_spend_pct, monthly_tariff_cost * 12 AS annual_impact FROM (
SELECT *, import_content * tariff_increase_pct / 100 AS monthly_tariff_cost FROM (
SELECT s.*, baseline_monthly, baseline_monthly * 0.30 AS import_content, CASE WHEN tariff_increase_pct >= 50 THEN 'Evaluate domestic sourcing'
       WHEN tariff_increase_pct >= 25 THEN 'Diversify suppliers' ELSE 'Monitor developments' END AS action
FROM (VALUES {', '.join(map(str, TARIFFS))}) s(tariff_increase_pct, product_category) CROSS JOIN base))""", digits=2,
                              doubles="tariff_increase_pct baseline_monthly import_content monthly_tariff_cost share_of_spend_pct annual_impact"))
def scenario_tariff(spark, d):
    return shown(scenario.scenario_tariff(B.demand_signals(spark, d), literal_rows(spark, TARIFFS, ["tariff_increase_pct", "product_category"])), digits=2)


STORM_BY_EVENT = {"error": "HURRICANE", "click": "flooding", "view": "EXTREME_HEAT", "purchase": "SEVERE_WINTER"}
AREAS = ["MIDWEST", "SOUTHEAST", "GULF_COAST", "WEST_COAST"]


@query("scenario_weather", sql("", f"""
SELECT *, delay_days + 7 AS recovery_days, CASE WHEN delay_days >= 10 THEN 'Activate emergency logistics' ELSE 'Monitor forecasts' END AS action FROM (
SELECT disruption_type, affected_region, reports, {V.mapped('upper(disruption_type)', {k: v[0] for k, v in K.WEATHER_IMPACTS.items()}, '7')} AS delay_days,
       {V.mapped('upper(disruption_type)', {k: v[1] for k, v in K.WEATHER_IMPACTS.items()}, '15')} AS production_impact_pct,
       {V.mapped('upper(disruption_type)', {k: ', '.join(v[2]) for k, v in K.WEATHER_IMPACTS.items()}, V.text(', '.join(K.WEATHER_IMPACTS['SEVERE_WINTER'][2])))} AS affected_subsystems
FROM (SELECT {V.mapped('event_type', STORM_BY_EVENT, "'UNKNOWN'")} AS disruption_type, {V.pick([V.text(a) for a in AREAS], 'user_id')} AS affected_region, count(*) AS reports
      FROM events GROUP BY 1, 2))""", ints="reports delay_days production_impact_pct recovery_days"))
def scenario_weather(spark, d):
    reports = B.read_parquet(spark, d, "events").groupBy(
        lookup(F.col("event_type"), STORM_BY_EVENT, "UNKNOWN").alias("disruption_type"), choose(AREAS, F.col("user_id")).alias("affected_region"),
    ).agg(F.count("*").alias("reports"))
    return shown(scenario.scenario_weather(reports))


GRID = [(g, t, c, s) for g in (0.0, 50.0) for t in (0.0, 25.0) for c in (0.0, 10.0) for s in (0.0, -10.0)]
GRID_COLUMNS = ["geo_risk_pct", "tariff_pct", "commodity_price_pct", "demand_shock_pct"]


@query("scenario_whatif", sql("base", f"""
SELECT *, baseline_monthly * (1 + net_impact_pct / 100) AS projected_monthly, baseline_monthly * net_impact_pct / 100 AS monthly_change,
       baseline_monthly * net_impact_pct / 100 * 12 AS annual_impact FROM (
SELECT *, geo_effect_pct + tariff_effect_pct + commodity_effect_pct + demand_shock_pct AS net_impact_pct FROM (
SELECT s.*, baseline_monthly, geo_risk_pct * 0.30 AS geo_effect_pct, tariff_pct * -0.05 AS tariff_effect_pct, commodity_price_pct * -0.02 AS commodity_effect_pct
FROM (VALUES {', '.join(map(str, GRID))}) s({', '.join(GRID_COLUMNS)}) CROSS JOIN base))""", digits=2,
                              doubles=" ".join(GRID_COLUMNS) + " baseline_monthly geo_effect_pct tariff_effect_pct commodity_effect_pct net_impact_pct "
                                      "projected_monthly monthly_change annual_impact"))
def scenario_whatif(spark, d):
    return shown(scenario.scenario_whatif(B.demand_signals(spark, d), literal_rows(spark, GRID, GRID_COLUMNS)), digits=2)


# --- drivers ----------------------------------------------------------------------------
@query("importance_rank", sql("fi_ranked", "SELECT feature, importance, rank FROM fi_ranked", ints="rank", doubles="importance"))
def importance_rank(spark, d):
    return shown(drivers.importance_rank(B.feature_importance(spark, d)))


@query("feature_categories", sql("fi_ranked", "SELECT feature, importance, label, category FROM fi_ranked", doubles="importance"))
def feature_categories(spark, d):
    return shown(drivers.feature_categories(B.feature_importance(spark, d)))


@query("importance_pareto", sql("fi_ranked", """
SELECT *, sum(CASE WHEN cumulative_pct <= 80 THEN 1 ELSE 0 END) OVER () + 1 AS features_to_cutoff FROM (
SELECT *, sum(importance) OVER (ORDER BY rank ROWS UNBOUNDED PRECEDING) / sum(importance) OVER () * 100 AS cumulative_pct,
       sum(importance) OVER (PARTITION BY category) / sum(importance) OVER () * 100 AS category_pct FROM fi_ranked WHERE rank <= 20)""",
                                ints="rank features_to_cutoff", doubles="importance cumulative_pct category_pct"))
def importance_pareto(spark, d):
    return shown(drivers.importance_pareto(B.feature_importance(spark, d)))


@query("demand_drivers", sql("fi_ranked", """
SELECT *, CASE WHEN contains(leader, 'lag') OR contains(leader, 'rolling') THEN 'Historical patterns dominate' WHEN contains(leader, 'risk') THEN 'Risk signals dominate'
       WHEN contains(leader, 'commodity') THEN 'Commodity prices dominate' ELSE 'Mixed drivers' END AS insight
FROM fi_ranked CROSS JOIN (SELECT feature AS leader FROM fi_ranked WHERE rank = 1) WHERE rank <= 10""", ints="rank", doubles="importance").replace(
    "SELECT * REPLACE", "SELECT * EXCLUDE (leader) REPLACE"))
def demand_drivers(spark, d):
    return shown(drivers.demand_drivers(B.feature_importance(spark, d)))
