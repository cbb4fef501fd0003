"""Risk scores, monthly signals and inventory measures."""

from pyspark.sql import functions as F

from procurelytics import constants as K
from procurelytics.functions import dates
from procurelytics.functions.bands import choose
from procurelytics.operators import inventory, nearest, prices, ranking, risk, rollups, signals, weather
from procurelytics.plans import bindings as B
from procurelytics.plans.catalog import views as V
from procurelytics.plans.registry import query, shown, sql
from procurelytics.session import cut_lineage
from procurelytics.sources import payloads


# --- geography and concentration ---------------------------------------------------
REGION_SQL = """SELECT region_group, count(*) AS supplier_count, avg(distance_to_hq_km) AS avg_distance_km,
       max(distance_to_hq_km) AS max_distance_km FROM suppliers GROUP BY 1"""


@query("suppliers_by_region", sql("suppliers", REGION_SQL, ints="supplier_count", doubles="avg_distance_km max_distance_km"))
def suppliers_by_region(spark, d):
    km = F.col("distance_to_hq_km")
    return shown(rollups.group_summary(B.supplier_locations(spark, d), "region_group", {
        "supplier_count": F.count("*"), "avg_distance_km": F.avg(km), "max_distance_km": F.max(km),
    }, order=[F.col("supplier_count").desc(), "region_group"]))


@query("suppliers_by_subsystem_region", sql("suppliers", """
SELECT subsystem_category, region_group, count(*) AS supplier_count FROM suppliers GROUP BY 1, 2""", ints="supplier_count"))
def suppliers_by_subsystem_region(spark, d):
    return shown(rollups.group_summary(B.supplier_locations(spark, d), ["subsystem_category", "region_group"],
                                       {"supplier_count": F.count("*")}, order=["subsystem_category", "region_group"]))


@query("geographic_risk", sql("suppliers", f"SELECT *, {V.mapped('region_group', K.REGION_RISK, chr(39) + 'UNKNOWN' + chr(39))} AS geographic_risk_level FROM ({REGION_SQL})",
                              ints="supplier_count", doubles="avg_distance_km max_distance_km"))
def geographic_risk(spark, d):
    return shown(risk.geographic_risk(B.supplier_locations(spark, d)))


COUNTRIES = ["USA", "DEU", "JPN", "SAU", "NGA", "CHN", "XXX"]


@query("region_lookup", sql("", f"""
SELECT s_suppkey AS supplier_key, country, {V.mapped('country', K.COUNTRY_REGION, chr(39) + 'OTHER' + chr(39))} AS region_group FROM (
SELECT s_suppkey, {V.pick([V.text(c) for c in COUNTRIES], 's_nationkey')} AS country FROM supplier)""", ints="supplier_key"))
def region_lookup(spark, d):
    code = choose(COUNTRIES, F.col("s_nationkey"))
    rows = B.read_parquet(spark, d, "supplier").select(F.col("s_suppkey").alias("supplier_key"), code.alias("country"))
    return shown(risk.region_lookup(rows, "country"))


@query("distance_to_hq", sql("suppliers", "SELECT supplier_key, lat, lon, distance_to_hq_km FROM suppliers",
                             ints="supplier_key", doubles="lat lon distance_to_hq_km"))
def distance_to_hq(spark, d):
    return shown(B.supplier_locations(spark, d), "supplier_key", "lat", "lon", "distance_to_hq_km")


SITES = [("North plant", 44.0247, -88.5426), ("East plant", 39.9326, -77.9967), ("South port", -23.5, -46.6), ("Pacific hub", 35.6, 139.7)]
SITE_SQL = " UNION ALL ".join(
    f"SELECT supplier_key, '{name}' AS site, {V.km('lat', 'lon', lat, lon)} AS km FROM suppliers" for name, lat, lon in SITES)


@query("nearest_facility", sql("suppliers", f"""
SELECT supplier_key, arg_min(site, km) AS nearest_facility, min(km) AS nearest_km FROM ({SITE_SQL}) GROUP BY 1""",
                               ints="supplier_key", doubles="nearest_km"))
def nearest_facility(spark, d):
    out = risk.nearest_facility(B.supplier_locations(spark, d), SITES)
    return shown(out, "supplier_key", "nearest_facility", "nearest_km")


@query("nearest_site", sql("suppliers", f"""
SELECT customer_key, arg_min(site, place) AS nearest_site, min(km) AS nearest_km FROM (
SELECT customer_key, site, km, struct_pack(km := km, site := site) AS place FROM (
SELECT customer_key, supplier_name AS site, {V.km('c.lat', 'c.lon', 's.lat', 's.lon')} AS km
FROM (SELECT c_custkey AS customer_key, c_custkey * 7919 % 17000 / 100.0 - 84.9963 AS lat, c_custkey * 104729 % 36000 / 100.0 - 179.9987 AS lon FROM customer) c,
     (SELECT supplier_name, lat, lon FROM suppliers) s)) GROUP BY 1""", ints="customer_key", doubles="nearest_km"))
def nearest_site(spark, d):
    out = nearest.nearest_site(B.customer_locations(spark, d), B.supplier_locations(spark, d), site="supplier_name")
    return shown(out, "customer_key", "nearest_site", "nearest_km")


@query("company_size", sql("suppliers", """
SELECT supplier_key, CASE WHEN company_size = 'SMALL' THEN 'SMALL' WHEN company_size = 'LARGE' THEN 'LARGE' ELSE 'MEDIUM' END AS size
FROM suppliers""", ints="supplier_key"))
def company_size(spark, d):
    types = F.concat(F.lit("For Profit, "), F.initcap("company_size"), F.lit(" Business"))
    rows = B.supplier_locations(spark, d)
    return shown(rows, "supplier_key", payloads.company_size(types).alias("size"))


@query("supplier_concentration", sql("subawards", f"""
SELECT *, {V.bands('num_suppliers', K.CONCENTRATION_BANDS, 'LOW')} AS concentration_risk FROM (
SELECT prime_award_id, count(DISTINCT sub_awardee_name) AS num_suppliers, sum(subaward_amount) AS total_spend FROM subawards GROUP BY 1)""",
                                     ints="prime_award_id num_suppliers", doubles="total_spend"))
def supplier_concentration(spark, d):
    rows = B.subawards(spark, d, category=False)
    return shown(risk.supplier_concentration(rows, "prime_award_id", "sub_awardee_key", "subaward_amount"))


# --- trade ------------------------------------------------------------------------------
@query("trade_events_silver", sql("trade", """
SELECT event_id, event_date, event_month, event_type, is_negative_event, product_category, severity, impact_score FROM trade""",
                                  ints="event_id", doubles="impact_score"))
def trade_events_silver(spark, d):
    return shown(B.trade_silver(spark, d), "event_id", "event_date", "event_month", "event_type", "is_negative_event",
                 "product_category", "severity", "impact_score")


TRADE_INTS = "event_count negative_event_count critical_events high_events countries_affected product_categories_affected"
TRADE_DOUBLES = "avg_impact_score max_impact_score total_affected_value_usd avg_rate_change_pct"


@query("trade_risk_base", sql("trade_base", "SELECT * FROM trade_base", ints=TRADE_INTS, doubles=TRADE_DOUBLES))
def trade_risk_base(spark, d):
    return shown(risk.trade_risk_base(B.trade_silver(spark, d)))


@query("trade_risk_index", sql("trade_index", "SELECT * FROM trade_index", ints=TRADE_INTS, doubles=TRADE_DOUBLES + " tariff_risk_index"))
def trade_risk_index(spark, d):
    return shown(risk.trade_risk_index(B.trade_silver(spark, d)))


@query("events_by_country", sql("trade", """
SELECT country_code, country_name, count(*) AS event_count, sum(CASE WHEN is_negative_event THEN 1 ELSE 0 END) AS negative_events,
       avg(impact_score) AS avg_impact FROM trade GROUP BY 1, 2 ORDER BY event_count DESC, country_code LIMIT 15""",
                                ints="event_count negative_events", doubles="avg_impact"))
def events_by_country(spark, d):
    return shown(rollups.group_summary(B.trade_silver(spark, d), ["country_code", "country_name"], {
        "event_count": F.count("*"), "negative_events": F.count_if("is_negative_event"), "avg_impact": F.avg("impact_score"),
    }, order=[F.col("event_count").desc(), "country_code"], limit=15))


@query("events_by_product", sql("trade", """
SELECT product_category, count(*) AS event_count, sum(affected_value_usd) AS total_affected_value, avg(rate_change_pct) AS avg_rate_change
FROM trade GROUP BY 1""", ints="event_count", doubles="total_affected_value avg_rate_change", digits=2))
def events_by_product(spark, d):
    out = rollups.group_summary(B.trade_silver(spark, d), "product_category", {
        "event_count": F.count("*"), "total_affected_value": F.sum("affected_value_usd"), "avg_rate_change": F.avg("rate_change_pct"),
    }, order=[F.col("total_affected_value").desc(), "product_category"])
    return shown(out, digits=2)


@query("high_impact_events", sql("trade", """
SELECT event_id, event_date, event_type, country_name, hts_description, severity, impact_score FROM trade
WHERE severity IN ('CRITICAL', 'HIGH') ORDER BY event_date DESC, event_id LIMIT 20""", ints="event_id", doubles="impact_score"))
def high_impact_events(spark, d):
    return shown(risk.high_impact_events(B.trade_silver(spark, d)))


@query("geo_risk_monthly", sql("geo_m", "SELECT * FROM geo_m", ints="geo_event_count geo_critical_events", doubles="geo_risk_index geo_risk_max"))
def geo_risk_monthly(spark, d):
    return shown(rollups.geo_risk_monthly(B.geo_risk(spark, d)))


# --- prices -------------------------------------------------------------------------------
@query("month_end_last", sql("price_ind", "SELECT indicator_code, as_of_date, value FROM price_ind", doubles="value"))
def month_end_last(spark, d):
    return shown(B.price_indicators(spark, d), "indicator_code", "as_of_date", "value")


@query("pct_changes", sql("price_pct", """
SELECT indicator_code, as_of_date, value, pct_change_1mo, pct_change_3mo, pct_change_12mo FROM price_pct""",
                          doubles="value pct_change_1mo pct_change_3mo pct_change_12mo"))
def pct_changes(spark, d):
    return shown(prices.pct_changes(B.price_indicators(spark, d)), "indicator_code", "as_of_date", "value",
                 "pct_change_1mo", "pct_change_3mo", "pct_change_12mo")


@query("commodity_scores", sql("price_scores", """
SELECT indicator_code, as_of_date, pct_change_1mo, price_direction, volatility_flag, cost_pressure_score FROM price_scores""",
                               doubles="pct_change_1mo cost_pressure_score"))
def commodity_scores(spark, d):
    return shown(prices.commodity_scores(B.price_indicators(spark, d)), "indicator_code", "as_of_date", "pct_change_1mo",
                 "price_direction", "volatility_flag", "cost_pressure_score")


PRICE_DOUBLES = "close_price pct_change_1mo pct_change_3mo pct_change_12mo cost_pressure_score"


@query("commodity_enriched", sql("prices", "SELECT * FROM prices", doubles=PRICE_DOUBLES))
def commodity_enriched(spark, d):
    return shown(B.price_table(spark, d))


@query("commodity_latest", sql("prices", f"""
SELECT *, {V.bands('avg_pressure', K.PRESSURE_BANDS, 'FAVORABLE')} AS pressure_level FROM (
SELECT month, ticker, category, close_price, pct_change_1mo, cost_pressure_score, avg(cost_pressure_score) OVER () AS avg_pressure
FROM prices WHERE month = (SELECT max(month) FROM prices) AND upper(category) = 'INDUSTRIAL_METALS')""",
                               doubles="close_price pct_change_1mo cost_pressure_score avg_pressure"))
def commodity_latest(spark, d):
    out = prices.commodity_latest(cut_lineage(B.price_table(spark, d)), category="industrial_metals")
    return shown(out, "month", "ticker", "category", "close_price", "pct_change_1mo", "cost_pressure_score", "avg_pressure", "pressure_level")


@query("commodity_pressure_monthly", sql("comm_m", "SELECT * FROM comm_m", doubles="commodity_cost_pressure commodity_avg_1mo_change commodity_avg_3mo_change commodity_max_volatility"))
def commodity_pressure_monthly(spark, d):
    return shown(rollups.commodity_pressure_monthly(B.price_table(spark, d)))


# --- weather --------------------------------------------------------------------------------
FLAGS = "month location_id extreme_heat_days extreme_cold_days precipitation_anomaly storm_event_count snow_disruption_risk".split()


@query("weather_flags", sql("weather_flagged", f"SELECT {', '.join(FLAGS)} FROM weather_flagged", ints="extreme_heat_days extreme_cold_days storm_event_count"))
def weather_flags(spark, d):
    return shown(weather.weather_flags(B.weather_obs(spark, d)), *FLAGS)


@query("weather_index", sql("weather", f"SELECT {', '.join(FLAGS)}, location_type, weather_disruption_index, disruption_risk_level FROM weather",
                            ints="extreme_heat_days extreme_cold_days storm_event_count", doubles="weather_disruption_index"))
def weather_index(spark, d):
    return shown(B.weather_table(spark, d), *FLAGS, "location_type", "weather_disruption_index", "disruption_risk_level")


@query("weather_monthly", sql("weather_m", "SELECT * FROM weather_m", ints="total_extreme_heat_days total_extreme_cold_days total_storm_events",
                              doubles="weather_disruption_index weather_disruption_max"))
def weather_monthly(spark, d):
    return shown(rollups.weather_monthly(B.weather_table(spark, d)))


RECENT_WEATHER = "month >= DATE '2000-08-01'"


@query("weather_by_type", sql("weather", f"""
SELECT location_type, avg(weather_disruption_index) AS avg_disruption_index, sum(storm_event_count) AS total_storm_events,
       avg(extreme_heat_days) AS avg_heat_days, avg(extreme_cold_days) AS avg_cold_days FROM weather WHERE {RECENT_WEATHER} GROUP BY 1""",
                              ints="total_storm_events", doubles="avg_disruption_index avg_heat_days avg_cold_days"))
def weather_by_type(spark, d):
    rows = ranking.last_months(B.weather_table(spark, d), "month", 12, B.as_of())
    return shown(rollups.group_summary(rows, "location_type", {
        "avg_disruption_index": F.avg("weather_disruption_index"), "total_storm_events": F.sum("storm_event_count"),
        "avg_heat_days": F.avg("extreme_heat_days"), "avg_cold_days": F.avg("extreme_cold_days"),
    }, order=[F.col("avg_disruption_index").desc(), "location_type"]))


@query("weather_seasonal", sql("weather", f"""
SELECT month, avg(weather_disruption_index) AS avg_disruption_index, avg(tavg) AS avg_temp, sum(prcp) AS total_precip, sum(snow) AS total_snow
FROM weather WHERE {RECENT_WEATHER} GROUP BY 1""", doubles="avg_disruption_index avg_temp total_precip total_snow"))
def weather_seasonal(spark, d):
    rows = ranking.last_months(B.weather_table(spark, d), "month", 12, B.as_of())
    return shown(rollups.group_summary(rows, "month", {
        "avg_disruption_index": F.avg("weather_disruption_index"), "avg_temp": F.avg("tavg"),
        "total_precip": F.sum("prcp"), "total_snow": F.sum("snow"),
    }, order=["month"]))


@query("high_weather_events", sql("weather", """
SELECT month, location_id, weather_disruption_index, extreme_heat_days, extreme_cold_days, storm_event_count, snow FROM weather
WHERE disruption_risk_level = 'HIGH' ORDER BY month DESC, weather_disruption_index DESC, location_id LIMIT 20""",
                                  ints="extreme_heat_days extreme_cold_days storm_event_count", doubles="weather_disruption_index snow"))
def high_weather_events(spark, d):
    return shown(weather.high_weather_events(B.weather_table(spark, d)))


# --- signals ------------------------------------------------------------------------------
@query("month_spine", sql("", """
SELECT CAST(unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), INTERVAL 1 MONTH)) AS DATE) AS month
FROM (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders)"""))
def month_spine(spark, d):
    return dates.month_spine_of(B.read_parquet(spark, d, "orders"), "o_orderdate")


@query("fiscal_calendar", sql("contracts", f"""
SELECT effective_date, {V.fy('effective_date')} AS fiscal_year, {V.fq('effective_date')} AS fiscal_quarter, count(*) AS contract_count
FROM contracts GROUP BY 1, 2, 3""", ints="fiscal_year contract_count"))
def fiscal_calendar(spark, d):
    rows = B.contracts(spark, d).select("effective_date").groupBy("effective_date").agg(F.count("*").alias("contract_count"))
    day = F.col("effective_date")
    return shown(rows, "effective_date", dates.fiscal_year(day).alias("fiscal_year"), dates.fiscal_quarter(day).alias("fiscal_quarter"), "contract_count")


SIGNALS = f"SELECT month, risk_level, fiscal_quarter, {', '.join((V.SIGNAL_INTS + ' ' + V.SIGNAL_DOUBLES).split())} FROM signals"


@query("unified_demand_signals", sql("signals", SIGNALS, ints=V.SIGNAL_INTS, doubles=V.SIGNAL_DOUBLES))
def unified_demand_signals(spark, d):
    return shown(B.demand_signals(spark, d))


@query("fill_zero", sql("comm_m weather_m", f"""
SELECT s.month, coalesce(commodity_cost_pressure, 0) AS commodity_cost_pressure, coalesce(weather_disruption_index, 0) AS weather_disruption_index,
       coalesce(total_storm_events, 0) AS total_storm_events FROM ({V.months_of('comm_m', 'weather_m')}) s LEFT JOIN comm_m ON comm_m.month = s.month LEFT JOIN weather_m ON weather_m.month = s.month""",
                        ints="total_storm_events", doubles="commodity_cost_pressure weather_disruption_index"))
def fill_zero(spark, d):
    price, wet = rollups.commodity_pressure_monthly(B.price_table(spark, d)), rollups.weather_monthly(B.weather_table(spark, d))
    spine = dates.month_spine_of(price.select("month").unionByName(wet.select("month")), "month")
    wide = spine.join(price, "month", "left").join(wet, "month", "left")
    return shown(signals.fill_zero(wide.select("month", "commodity_cost_pressure", "weather_disruption_index", "total_storm_events")))


@query("series_spine", sql("vendor_demand", "SELECT series, month, total_obligations_usd, actions FROM vendor_demand", ints="actions", doubles="total_obligations_usd", digits=2))
def series_spine(spark, d):
    return shown(B.vendor_demand(spark, d), "series", "month", "total_obligations_usd", "actions", digits=2)


@query("signals_summary", sql("signals", """
SELECT count(*) AS total_months, min(month) AS first_month, max(month) AS last_month, sum(prime_obligations_usd) AS total_prime_obligations,
       sum(subaward_obligations_usd) AS total_subaward_obligations, avg(prime_obligations_usd) AS avg_monthly_prime,
       avg(subaward_obligations_usd) AS avg_monthly_subaward, avg(geo_risk_index) AS avg_geo_risk, avg(tariff_risk_index) AS avg_tariff_risk,
       avg(weather_disruption_index) AS avg_weather_risk, avg(commodity_cost_pressure) AS avg_commodity_pressure,
       avg(combined_risk_index) AS avg_combined_risk FROM signals""", ints="total_months", digits=2,
                              doubles="total_prime_obligations total_subaward_obligations avg_monthly_prime avg_monthly_subaward avg_geo_risk "
                                      "avg_tariff_risk avg_weather_risk avg_commodity_pressure avg_combined_risk"))
def signals_summary(spark, d):
    return shown(signals.signals_summary(B.demand_signals(spark, d)), digits=2)


@query("signals_by_fiscal_year", sql("signals", """
SELECT fiscal_year, sum(prime_obligations_usd) AS total_obligations, avg(combined_risk_index) AS avg_risk_index FROM signals GROUP BY 1""",
                                     ints="fiscal_year", doubles="total_obligations avg_risk_index", digits=2))
def signals_by_fiscal_year(spark, d):
    out = rollups.group_summary(B.demand_signals(spark, d), "fiscal_year", {
        "total_obligations": F.sum("prime_obligations_usd"), "avg_risk_index": F.avg("combined_risk_index"),
    }, order=["fiscal_year"])
    return shown(out, digits=2)


# --- inventory ------------------------------------------------------------------------------
ROLLED = [f"{name}_{k}mo{tail}" for k in (3, 6, 12) for name, tail in (("demand", "_avg"), ("demand_stddev", ""))]


@query("rolling_demand_stats", sql("vendor_stats", f"""
SELECT series, month, demand_proxy_usd, days_in_month, avg_daily_demand_proxy, {', '.join(ROLLED)}, demand_stddev_proxy, coefficient_of_variation
FROM vendor_stats""", ints="series days_in_month", digits=2, coefficient_of_variation=4,
                                   doubles=f"demand_proxy_usd avg_daily_demand_proxy {' '.join(ROLLED)} demand_stddev_proxy coefficient_of_variation"))
def rolling_demand_stats(spark, d):
    out = inventory.rolling_demand_stats(B.vendor_demand(spark, d), series="series")
    return shown(out, "series", "month", "demand_proxy_usd", "days_in_month", "avg_daily_demand_proxy", *ROLLED,
                 "demand_stddev_proxy", "coefficient_of_variation", digits=2, coefficient_of_variation=4)


STOCK = ("lead_time_demand safety_stock_proxy operating_level_demand reorder_point requirements_objective_proxy two_year_forecast_demand "
         "approved_acquisition_objective_proxy days_of_supply_proxy inventory_turnover_proxy")


@query("inventory_metrics", sql("vendor_stock", f"SELECT series, month, lead_time_days_assumed, {', '.join(STOCK.split())} FROM vendor_stock",
                                ints="series lead_time_days_assumed", doubles=STOCK, digits=2))
def inventory_metrics(spark, d):
    stats = inventory.rolling_demand_stats(B.vendor_demand(spark, d), series="series")
    return shown(inventory.inventory_metrics(stats), "series", "month", "lead_time_days_assumed", *STOCK.split(), digits=2)


RISKED = "risk_adjusted_safety_stock risk_adjusted_ro"
LABELS = ["demand_volatility_category", "nmcs_risk_indicator", "forecast_method_recommendation"]


@query("inventory_risk", sql("vendor_gold", f"SELECT series, month, {', '.join(RISKED.split() + LABELS)} FROM vendor_gold",
                             ints="series", doubles=RISKED, digits=2))
def inventory_risk(spark, d):
    stats = inventory.rolling_demand_stats(B.vendor_demand(spark, d), series="series")
    out = inventory.inventory_risk(inventory.inventory_metrics(stats))
    return shown(out, "series", "month", *RISKED.split(), *LABELS, digits=2)


GOLD_DOUBLES = " ".join(c for c in inventory.GOLD_COLUMNS if c.split("_")[0] in (
    "demand", "avg", "coefficient", "lead", "safety", "risk", "requirements", "approved", "days", "inventory", "reorder", "combined")
    and c not in ("demand_volatility_category", "lead_time_days_assumed", "risk_level"))


@query("inventory_metrics_gold", sql("gold", f"SELECT {', '.join(inventory.GOLD_COLUMNS)} FROM gold",
                                     ints="fiscal_year lead_time_days_assumed", doubles=GOLD_DOUBLES, digits=2))
def inventory_metrics_gold(spark, d):
    return shown(B.inventory_gold(B.demand_signals(spark, d)), digits=2)


@query("metrics_summary", sql("gold", """
SELECT avg(demand_proxy_usd) AS avg_monthly_demand, avg(avg_daily_demand_proxy) AS avg_daily_demand, avg(demand_stddev_proxy) AS avg_demand_stddev,
       avg(safety_stock_proxy) AS avg_safety_stock, avg(requirements_objective_proxy) AS avg_requirements_objective,
       avg(days_of_supply_proxy) AS avg_days_of_supply FROM gold""", digits=2,
                              doubles="avg_monthly_demand avg_daily_demand avg_demand_stddev avg_safety_stock avg_requirements_objective avg_days_of_supply"))
def metrics_summary(spark, d):
    return shown(inventory.metrics_summary(B.inventory_gold(B.demand_signals(spark, d))), digits=2)


@query("metrics_latest", sql("gold", f"""
SELECT month, requirements_objective_proxy, risk_adjusted_ro, approved_acquisition_objective_proxy, days_of_supply_proxy,
       {V.bands('days_of_supply_proxy', K.SUPPLY_DAYS_BANDS, 'CRITICAL')} AS supply_status, nmcs_risk_indicator, demand_volatility_category,
       coefficient_of_variation, forecast_method_recommendation FROM gold ORDER BY month DESC LIMIT 1""", digits=2,
                             doubles="requirements_objective_proxy risk_adjusted_ro approved_acquisition_objective_proxy days_of_supply_proxy coefficient_of_variation"))
def metrics_latest(spark, d):
    return shown(inventory.metrics_latest(B.inventory_gold(B.demand_signals(spark, d))), digits=2)


def vendor_inventory(spark, d):
    return inventory.inventory_table(B.vendor_demand(spark, d), series="series")


@query("volatility_distribution", sql("vendor_gold", """
SELECT demand_volatility_category, count(*) AS month_count, avg(coefficient_of_variation) AS avg_cv FROM vendor_gold GROUP BY 1""",
                                      ints="month_count", doubles="avg_cv"))
def volatility_distribution(spark, d):
    return shown(rollups.group_summary(vendor_inventory(spark, d), "demand_volatility_category", {
        "month_count": F.count("*"), "avg_cv": F.avg("coefficient_of_variation")}, order=["demand_volatility_category"]))


@query("nmcs_distribution", sql("vendor_gold", """
SELECT nmcs_risk_indicator, count(*) AS month_count, avg(days_of_supply_proxy) AS avg_days_of_supply, avg(combined_risk_index) AS avg_risk_index
FROM vendor_gold GROUP BY 1""", ints="month_count", doubles="avg_days_of_supply avg_risk_index"))
def nmcs_distribution(spark, d):
    return shown(rollups.group_summary(vendor_inventory(spark, d), "nmcs_risk_indicator", {
        "month_count": F.count("*"), "avg_days_of_supply": F.avg("days_of_supply_proxy"), "avg_risk_index": F.avg("combined_risk_index"),
    }, order=["nmcs_risk_indicator"]))


@query("method_distribution", sql("vendor_gold", """
SELECT forecast_method_recommendation, count(*) AS month_count FROM vendor_gold GROUP BY 1""", ints="month_count"))
def method_distribution(spark, d):
    return shown(rollups.group_summary(vendor_inventory(spark, d), "forecast_method_recommendation", {"month_count": F.count("*")},
                                       order=[F.col("month_count").desc(), "forecast_method_recommendation"]))
