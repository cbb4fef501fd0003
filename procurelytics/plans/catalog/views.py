"""SQL fragments: the domain views of ``bindings`` as the oracle reads them."""

from procurelytics import constants as K
from procurelytics.plans.bindings import (
    ACTUAL_TOOLS, CATEGORIES, DIFFICULTIES, EVENTS_START, EXPECTED_TOOLS, NOTICE_PHRASES, NOTICE_TYPES,
    PART_TYPES, PRICE_METADATA, REGION_NAMES, SEGMENT_CODES, SPECIALS, SUBSYSTEMS, WEATHER_START,
)
from procurelytics.plans.registry import cte


def text(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def pick(options, position) -> str:
    """The option at ``position`` modulo their number."""
    cases = " ".join(f"WHEN {i} THEN {o}" for i, o in enumerate(options))
    return f"CASE CAST({position} AS BIGINT) % {len(options)} {cases} END"


def mapped(expr, mapping, otherwise="NULL") -> str:
    cases = " ".join(f"WHEN {text(k)} THEN {text(v) if isinstance(v, str) else v}" for k, v in mapping.items())
    return f"CASE {expr} {cases} ELSE {otherwise} END"


def bands(expr, rules, otherwise) -> str:
    cases = " ".join(f"WHEN {expr} {op} {limit} THEN {text(label)}" for op, limit, label in rules)
    return f"CASE {cases} ELSE {text(otherwise)} END"


def fy(day) -> str:
    return f"(year({day}) + CASE WHEN month({day}) >= 10 THEN 1 ELSE 0 END)"


def fq(day) -> str:
    return f"('Q' || CAST(CASE WHEN month({day}) >= 10 THEN 1 WHEN month({day}) <= 3 THEN 2 WHEN month({day}) <= 6 THEN 3 ELSE 4 END AS VARCHAR))"


def km(lat1, lon1, lat2, lon2) -> str:
    return (
        f"2 * asin(sqrt(pow(sin(radians({lat2} - ({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon2} - ({lon1})) / 2), 2))) * {K.EARTH_RADIUS_KM}"
    )


cte("award_actions", "", """
SELECT o_orderkey AS award_id_piid, CAST(o_orderdate AS DATE) AS action_date,
       l_extendedprice * (1 - l_discount) AS federal_action_obligation, l_suppkey,
       s_name AS recipient_name, p_brand AS product_or_service_code
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
""")
cte("contracts", "", f"""
SELECT o_orderkey AS contract_id, c_name AS vendor_name, o_totalprice AS obligated_amount,
       CAST(o_orderdate AS DATE) AS effective_date, c_mktsegment AS psc_code, {fy('o_orderdate')} AS fiscal_year
FROM orders JOIN customer ON o_custkey = c_custkey
""")
cte("subawards", "", """
SELECT l_orderkey AS prime_award_id, l_extendedprice AS subaward_amount, CAST(l_shipdate AS DATE) AS subaward_action_date,
       s_name AS sub_awardee_name, p_type AS subsystem_category, n_name AS sub_awardee_state, r_name AS sub_awardee_country
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
cte("suppliers", "", f"""
SELECT s_suppkey AS supplier_key, s_name AS supplier_name, 'UEI' || CAST(s_suppkey AS VARCHAR) AS uei,
       n_name AS state, r_name AS country, lat, lon,
       {mapped('r_name', REGION_NAMES, "'OTHER'")} AS region_group,
       {pick([text(s) for s in SUBSYSTEMS], 's_suppkey')} AS subsystem_category,
       CASE WHEN s_acctbal < 3000 THEN 'SMALL' WHEN s_acctbal < 7000 THEN 'MEDIUM' ELSE 'LARGE' END AS company_size,
       {km('lat', 'lon', K.HOME_SITE[0], K.HOME_SITE[1])} AS distance_to_hq_km
FROM (SELECT *, CAST(s_suppkey * 37 % 120 - 60 AS DOUBLE) AS lat, CAST(s_suppkey * 53 % 360 - 180 AS DOUBLE) AS lon FROM supplier)
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
cte("trade", "", f"""
SELECT o_orderkey AS event_id, CAST(o_orderdate AS DATE) AS event_date,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS event_month,
       CASE o_orderstatus WHEN 'F' THEN 'SANCTION' WHEN 'O' THEN 'TARIFF_EXEMPTION' WHEN 'P' THEN 'TRADE_NOTICE' END AS event_type,
       CAST(c_nationkey AS VARCHAR) AS country_code, 'COUNTRY ' || CAST(c_nationkey AS VARCHAR) AS country_name,
       {mapped('c_mktsegment', SEGMENT_CODES, "'0000'")} AS hts_code,
       {mapped('c_mktsegment', {k: K.HTS_DESCRIPTIONS[v] for k, v in SEGMENT_CODES.items()}, "''")} AS hts_description,
       {mapped('c_mktsegment', {k: K.PRODUCT_PREFIXES.get(v[:2], 'OTHER') for k, v in SEGMENT_CODES.items()}, "'OTHER'")} AS product_category,
       coalesce(o_orderstatus = 'F', false) AS is_negative_event, 0.0 AS rate_change_pct,
       CASE WHEN o_orderpriority = '1-URGENT' AND o_custkey % 10 = 0 THEN 'CRITICAL'
            WHEN o_orderpriority = '2-HIGH' AND o_custkey % 10 = 1 THEN 'HIGH' ELSE 'MODERATE' END AS severity,
       o_totalprice % 100.0 AS impact_score, o_totalprice AS affected_value_usd
FROM orders JOIN customer ON o_custkey = c_custkey
""")
cte("trade_base", "trade", """
SELECT event_month AS month, count(*) AS event_count, sum(CASE WHEN is_negative_event THEN 1 ELSE 0 END) AS negative_event_count,
       avg(impact_score) AS avg_impact_score, max(impact_score) AS max_impact_score,
       sum(affected_value_usd) AS total_affected_value_usd, avg(rate_change_pct) AS avg_rate_change_pct,
       sum(CASE WHEN severity = 'CRITICAL' THEN 1 ELSE 0 END) AS critical_events,
       sum(CASE WHEN severity = 'HIGH' THEN 1 ELSE 0 END) AS high_events,
       count(DISTINCT country_code) AS countries_affected, count(DISTINCT hts_code) AS product_categories_affected
FROM trade GROUP BY 1
""")
cte("trade_index", "trade_base", f"""
SELECT *, {bands('tariff_risk_index', K.TARIFF_RISK_BANDS, 'MODERATE')} AS risk_level FROM (
SELECT *, least(100.0, percent_rank() OVER (ORDER BY event_count) * 25
       + (critical_events * 15 + high_events * 8) / greatest(event_count, 1) * 35
       + avg_impact_score / 100 * 25 + (countries_affected + product_categories_affected) / 20 * 15) AS tariff_risk_index
FROM trade_base)
""")
cte("geo_src", "", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, avg(o_totalprice % 100.0) AS composite_risk_index,
       count(*) AS event_count, sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS critical_events
FROM orders GROUP BY 1
""")
cte("geo_m", "geo_src", """
SELECT month, avg(composite_risk_index) AS geo_risk_index, max(composite_risk_index) AS geo_risk_max,
       sum(event_count) AS geo_event_count, sum(critical_events) AS geo_critical_events FROM geo_src GROUP BY 1
""")
cte("price_ind", "", """
SELECT p_type AS indicator_code, CAST(last_day(l_shipdate) AS DATE) AS as_of_date, l_extendedprice / l_quantity AS value
FROM lineitem JOIN part ON l_partkey = p_partkey
QUALIFY row_number() OVER (PARTITION BY p_type, last_day(l_shipdate)
    ORDER BY CAST(l_shipdate AS DATE) DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice / l_quantity DESC) = 1
""")
cte("price_pct", "price_ind", """
SELECT *, CASE WHEN p1 <> 0 THEN (value - p1) / p1 * 100 END AS pct_change_1mo,
       CASE WHEN p3 <> 0 THEN (value - p3) / p3 * 100 END AS pct_change_3mo,
       CASE WHEN p12 <> 0 THEN (value - p12) / p12 * 100 END AS pct_change_12mo
FROM (SELECT *, lag(value, 1) OVER w AS p1, lag(value, 3) OVER w AS p3, lag(value, 12) OVER w AS p12
      FROM price_ind WINDOW w AS (PARTITION BY indicator_code ORDER BY as_of_date))
""")
cte("price_scores", "price_pct", f"""
SELECT *, {bands('pct_change_1mo', K.PRICE_DIRECTION_BANDS, 'FALLING_FAST')} AS price_direction,
       {bands('abs(pct_change_1mo)', K.PRICE_VOLATILITY_BANDS, 'LOW_VOLATILITY')} AS volatility_flag,
       coalesce(pct_change_3mo, 0) * 0.5 + coalesce(pct_change_1mo, 0) * 0.3 + coalesce(pct_change_12mo, 0) * 0.2 AS cost_pressure_score
FROM price_pct
""")
cte("prices", "price_scores", f"""
SELECT as_of_date AS month, indicator_code AS ticker, upper(indicator_code[1:1]) || lower(indicator_code[2:]) AS commodity_name,
       {mapped('indicator_code', {t: c for t, c, _ in PRICE_METADATA}, "'OTHER'")} AS category,
       {mapped('indicator_code', {t: u for t, _, u in PRICE_METADATA}, "''")} AS defense_use,
       'USD/unit' AS unit, value AS close_price, pct_change_1mo, pct_change_3mo, pct_change_12mo,
       as_of_date AS month_date, price_direction, volatility_flag, cost_pressure_score
FROM price_scores
""")
cte("comm_m", "prices", """
SELECT CAST(date_trunc('month', month) AS DATE) AS month, avg(cost_pressure_score) AS commodity_cost_pressure,
       avg(pct_change_1mo) AS commodity_avg_1mo_change, avg(pct_change_3mo) AS commodity_avg_3mo_change,
       max(abs(pct_change_1mo)) AS commodity_max_volatility FROM prices GROUP BY 1
""")
cte("weather_obs", "", f"""
SELECT CAST(DATE '{WEATHER_START}' + to_months(CAST(period AS INTEGER)) AS DATE) AS month, 'LOC' || CAST(loc AS VARCHAR) AS location_id,
       CASE loc % 3 WHEN 0 THEN 'PLANT' WHEN 1 THEN 'PORT' ELSE 'SUPPLIER_HUB' END AS location_type,
       tavg, tmin, tmax, prcp, snow, wspd
FROM (SELECT user_id % 11 AS loc, date_diff('day', DATE '{EVENTS_START}', CAST(ts AS DATE)) AS period,
             max(value) / 10 AS tmax, min(value) * -10 AS tmin,
             CAST(sum(CAST(round(value * 100) AS BIGINT)) % 130 AS DOUBLE) AS prcp, avg(value) / 3 AS wspd, avg(value) AS tavg,
             CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) * 8 AS DOUBLE) AS snow
      FROM events GROUP BY 1, 2)
""")
cte("weather_flagged", "weather_obs", f"""
SELECT *, CASE WHEN tmax > 35 THEN 15 ELSE 0 END AS extreme_heat_days, CASE WHEN tmin < -15 THEN 15 ELSE 0 END AS extreme_cold_days,
       {bands('prcp', K.PRECIPITATION_BANDS, 'NORMAL')} AS precipitation_anomaly,
       CASE WHEN prcp > 80 AND wspd > 15 THEN 3 WHEN prcp > 50 OR wspd > 20 THEN 1 ELSE 0 END AS storm_event_count,
       {bands('snow', K.SNOW_BANDS, 'NONE')} AS snow_disruption_risk
FROM weather_obs
""")
cte("weather", "weather_flagged", f"""
SELECT *, {bands('weather_disruption_index', K.DISRUPTION_BANDS, 'LOW')} AS disruption_risk_level FROM (
SELECT *, least(100.0, extreme_heat_days / 30 * 25 + extreme_cold_days / 30 * 25
       + CASE precipitation_anomaly WHEN 'HEAVY' THEN 20 WHEN 'DROUGHT' THEN 15 ELSE 0 END + storm_event_count * 10
       + CASE snow_disruption_risk WHEN 'HIGH' THEN 20 WHEN 'MODERATE' THEN 10 WHEN 'LOW' THEN 5 ELSE 0 END) AS weather_disruption_index
FROM weather_flagged)
""")
cte("weather_m", "weather", """
SELECT month, avg(weather_disruption_index) AS weather_disruption_index, max(weather_disruption_index) AS weather_disruption_max,
       sum(extreme_heat_days) AS total_extreme_heat_days, sum(extreme_cold_days) AS total_extreme_cold_days,
       sum(storm_event_count) AS total_storm_events FROM weather GROUP BY 1
""")
cte("prime_m", "award_actions", """
SELECT CAST(date_trunc('month', action_date) AS DATE) AS month, sum(federal_action_obligation) AS prime_obligations_usd,
       count(*) AS prime_action_count, count(DISTINCT award_id_piid) AS unique_awards,
       avg(federal_action_obligation) AS avg_obligation_per_action FROM award_actions GROUP BY 1
""")
cte("sub_m", "subawards", f"""
SELECT CAST(date_trunc('month', subaward_action_date) AS DATE) AS month, sum(subaward_amount) AS subaward_obligations_usd,
       count(*) AS subaward_count, count(DISTINCT sub_awardee_name) AS unique_suppliers,
       {', '.join(f"sum(subaward_amount) FILTER (WHERE subsystem_category = '{t}') AS subsystem_{t.lower()}_usd" for t in PART_TYPES)}
FROM subawards GROUP BY 1
""")
def months_of(*sources) -> str:
    """Every month from the least to the greatest of the given tables."""
    rows = " UNION ALL ".join(f"SELECT month FROM {s}" for s in sources)
    return f"SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM ({rows})"


cte("spine", "prime_m sub_m geo_m trade_index comm_m weather_m", months_of("prime_m", "sub_m", "geo_m", "trade_index", "comm_m", "weather_m"))
cte("signals0", "spine prime_m sub_m geo_m trade_index comm_m weather_m", """
SELECT spine.month, coalesce(prime_obligations_usd, 0) AS prime_obligations_usd, coalesce(prime_action_count, 0) AS prime_action_count,
       coalesce(unique_awards, 0) AS unique_awards, coalesce(avg_obligation_per_action, 0) AS avg_obligation_per_action,
       coalesce(subaward_obligations_usd, 0) AS subaward_obligations_usd, coalesce(subaward_count, 0) AS subaward_count,
       coalesce(unique_suppliers, 0) AS unique_suppliers,
       coalesce(geo_risk_index, 0) AS geo_risk_index, coalesce(geo_risk_max, 0) AS geo_risk_max,
       coalesce(geo_event_count, 0) AS geo_event_count, coalesce(geo_critical_events, 0) AS geo_critical_events,
       coalesce(tariff_risk_index, 0) AS tariff_risk_index, coalesce(t.event_count, 0) AS trade_event_count,
       coalesce(t.critical_events, 0) AS trade_critical_events, coalesce(t.total_affected_value_usd, 0) AS trade_affected_value_usd,
       coalesce(commodity_cost_pressure, 0) AS commodity_cost_pressure, coalesce(commodity_avg_1mo_change, 0) AS commodity_avg_1mo_change,
       coalesce(commodity_avg_3mo_change, 0) AS commodity_avg_3mo_change, coalesce(commodity_max_volatility, 0) AS commodity_max_volatility,
       coalesce(weather_disruption_index, 0) AS weather_disruption_index, coalesce(weather_disruption_max, 0) AS weather_disruption_max,
       coalesce(total_extreme_heat_days, 0) AS total_extreme_heat_days, coalesce(total_extreme_cold_days, 0) AS total_extreme_cold_days,
       coalesce(total_storm_events, 0) AS total_storm_events
FROM spine LEFT JOIN prime_m ON prime_m.month = spine.month LEFT JOIN sub_m ON sub_m.month = spine.month
LEFT JOIN geo_m ON geo_m.month = spine.month LEFT JOIN trade_index t ON t.month = spine.month
LEFT JOIN comm_m ON comm_m.month = spine.month LEFT JOIN weather_m ON weather_m.month = spine.month
""")
cte("signals", "signals0", f"""
SELECT *, {bands('combined_risk_index', K.COMBINED_RISK_BANDS, 'MODERATE')} AS risk_level FROM (
SELECT *, prime_obligations_usd + subaward_obligations_usd AS total_obligations_usd,
       CASE WHEN prime_obligations_usd > 0 THEN subaward_obligations_usd / prime_obligations_usd ELSE 0 END AS subaward_ratio,
       geo_risk_index * 0.4 + tariff_risk_index * 0.3 + weather_disruption_index * 0.2 + abs(commodity_cost_pressure) * 0.1 AS combined_risk_index,
       {fy('month')} AS fiscal_year, {fq('month')} AS fiscal_quarter
FROM signals0)
""")
SIGNAL_INTS = (
    "prime_action_count unique_awards subaward_count unique_suppliers geo_event_count geo_critical_events trade_event_count "
    "trade_critical_events total_extreme_heat_days total_extreme_cold_days total_storm_events fiscal_year"
)
SIGNAL_DOUBLES = (
    "prime_obligations_usd avg_obligation_per_action subaward_obligations_usd geo_risk_index geo_risk_max tariff_risk_index "
    "trade_affected_value_usd commodity_cost_pressure commodity_avg_1mo_change commodity_avg_3mo_change commodity_max_volatility "
    "weather_disruption_index weather_disruption_max total_obligations_usd subaward_ratio combined_risk_index"
)


def stats(source, value, part="") -> str:
    partition = f"PARTITION BY {part} " if part else ""

    def over(k):
        return f"OVER ({partition}ORDER BY month ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"

    return f"""
SELECT *, coalesce(demand_stddev_6mo, demand_stddev_3mo, 0) AS demand_stddev_proxy,
       CASE WHEN demand_6mo_avg > 0 THEN demand_stddev_6mo / demand_6mo_avg ELSE 0 END AS coefficient_of_variation FROM (
SELECT *, {value} AS demand_proxy_usd, day(last_day(month)) AS days_in_month, {value} / day(last_day(month)) AS avg_daily_demand_proxy,
       {', '.join(f'avg({value}) {over(k)} AS demand_{k}mo_avg, stddev_samp({value}) {over(k)} AS demand_stddev_{k}mo' for k in (3, 6, 12))}
FROM {source})"""


def metrics(source) -> str:
    return f"""
SELECT *, requirements_objective_proxy + two_year_forecast_demand AS approved_acquisition_objective_proxy,
       CASE WHEN avg_daily_demand_proxy > 0 THEN requirements_objective_proxy / avg_daily_demand_proxy ELSE 0 END AS days_of_supply_proxy,
       CASE WHEN requirements_objective_proxy > 0 THEN demand_12mo_avg * 12 / requirements_objective_proxy ELSE 0 END AS inventory_turnover_proxy
FROM (SELECT *, lead_time_demand + safety_stock_proxy AS reorder_point,
             operating_level_demand + lead_time_demand + safety_stock_proxy AS requirements_objective_proxy
FROM (SELECT *, 120 AS lead_time_days_assumed, avg_daily_demand_proxy * 120 AS lead_time_demand,
             1.65 * demand_stddev_proxy * sqrt(120.0 / 30) AS safety_stock_proxy, avg_daily_demand_proxy * 30 AS operating_level_demand,
             demand_12mo_avg * 24 AS two_year_forecast_demand FROM {source}))"""


def stock_risk(source) -> str:
    return f"""
SELECT *, {mapped('demand_volatility_category', K.METHOD_BY_VOLATILITY)} AS forecast_method_recommendation FROM (
SELECT *, safety_stock_proxy * (1 + combined_risk_index / 100) AS risk_adjusted_safety_stock,
       operating_level_demand + lead_time_demand + safety_stock_proxy * (1 + combined_risk_index / 100) AS risk_adjusted_ro,
       {bands('coefficient_of_variation', K.VOLATILITY_BANDS, 'STABLE')} AS demand_volatility_category,
       CASE WHEN days_of_supply_proxy < 30 AND combined_risk_index > 40 THEN 'HIGH_RISK'
            WHEN days_of_supply_proxy < 60 OR combined_risk_index > 30 THEN 'ELEVATED_RISK' ELSE 'NORMAL' END AS nmcs_risk_indicator
FROM {source})"""


cte("demand_stats", "signals", stats("signals", "total_obligations_usd"))
cte("stock", "demand_stats", metrics("demand_stats"))
cte("gold", "stock", stock_risk("stock"))
def dense(source, zeros) -> str:
    """Every month of each series, 0 where it has no row."""
    return f"""
SELECT g.series, g.month, {', '.join(f'coalesce(s.{c}, 0) AS {c}' for c in zeros)}
FROM (SELECT series, CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM {source} GROUP BY series) g
LEFT JOIN {source} s ON s.series = g.series AND s.month = g.month"""


cte("vendor_rows", "award_actions", """
SELECT l_suppkey AS series, CAST(date_trunc('month', action_date) AS DATE) AS month, sum(federal_action_obligation) AS total_obligations_usd,
       count(*) AS actions FROM award_actions GROUP BY 1, 2
""")
cte("vendor_demand", "vendor_rows", f"SELECT *, CAST(series % 60 AS DOUBLE) AS combined_risk_index FROM ({dense('vendor_rows', ['total_obligations_usd', 'actions'])})")
cte("vendor_stats", "vendor_demand", stats("vendor_demand", "total_obligations_usd", "series"))
cte("vendor_stock", "vendor_stats", metrics("vendor_stats"))
cte("vendor_gold", "vendor_stock", stock_risk("vendor_stock"))
cte("type_rows", "", """
SELECT p_type AS series, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, sum(l_extendedprice) AS total_obligations_usd,
       avg(l_discount) * 100 AS tariff_risk_index, avg(l_tax) * 100 AS geo_risk_index
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2
""")
cte("type_demand", "type_rows", dense("type_rows", ["total_obligations_usd", "tariff_risk_index", "geo_risk_index"]))
cte("forecasts", "signals", """
SELECT model, model_type, CAST(month + INTERVAL 12 MONTH AS DATE) AS month, total_obligations_usd * f AS forecast_demand_usd,
       total_obligations_usd * f * 0.85 AS forecast_lower, total_obligations_usd * f * 1.15 AS forecast_upper
FROM signals CROSS JOIN (VALUES ('prophet', 'PROPHET', 1.00), ('arima', 'SARIMAX', 1.02), ('random_forest', 'RANDOM_FOREST', 0.97)) m(model, model_type, f)
""")
cte("pressure", "", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS as_of_date, avg(o_totalprice) / 100000 - 2.5 AS value FROM orders GROUP BY 1
""")
NAMES = [*K.FEATURE_LABELS, "vendor_count_x", "award_rate"]
LABELS = {**K.FEATURE_LABELS, "vendor_count_x": "Vendor Count X", "award_rate": "Award Rate"}


def category_case(expr) -> str:
    cases = " ".join(
        f"WHEN {' OR '.join(f'starts_with({expr}, {text(p)})' for p in prefixes)} THEN {text(c)}"
        for c, prefixes in K.FEATURE_CATEGORIES.items()
    )
    return f"CASE {cases} ELSE 'Other' END"


cte("fi", "", f"""
SELECT feature, w / sum(w) OVER () AS importance FROM (
SELECT {pick([text(n) for n in NAMES], 'p_partkey')} AS feature, sum(p_retailprice * p_size) AS w FROM part GROUP BY 1)
""")
cte("fi_ranked", "fi", f"""
SELECT feature, importance, row_number() OVER (ORDER BY importance DESC, feature) AS rank,
       {mapped('feature', LABELS)} AS label, {category_case('feature')} AS category FROM fi
""")
cte("notices", "", f"""
SELECT doc_id, {pick([text(p) for p in NOTICE_PHRASES], 'doc_id')} || ' ' || text AS title,
       {pick([text(t) for t in NOTICE_TYPES], 'doc_id')} AS doc_type FROM documents
""")


def text_list(values) -> str:
    return "CAST([" + ", ".join(text(v) for v in values) + "] AS VARCHAR[])"


cte("eval_log", "", f"""
SELECT *, CASE WHEN len(actual_tools) > 0 THEN prompt || ' $' || CAST(amount AS VARCHAR) END AS tool_text FROM (
SELECT 'run-' || CAST(a.turn AS VARCHAR) AS run_id, CAST(a.conv_id AS VARCHAR) || '-' || CAST(a.turn AS VARCHAR) AS prompt_id,
       {pick([text(c) for c in CATEGORIES], 'a.conv_id')} AS category, {pick([text(c) for c in DIFFICULTIES], 'a.conv_id')} AS difficulty,
       u.text AS prompt, (a.conv_id + 1) * 1000 AS amount,
       a.text || ' $' || CAST(CASE WHEN a.conv_id % 3 = 0 THEN (a.conv_id + 1) * 1100 ELSE (a.conv_id + 1) * 1000 END AS VARCHAR) AS response,
       {pick([text_list(t) for t in EXPECTED_TOOLS], 'a.conv_id')} AS expected_tools,
       {pick([text_list(t) for t in ACTUAL_TOOLS], 'length(a.text)')} AS actual_tools,
       string_split(u.text, ' ')[1:2] AS required_keywords, {text_list(['tion', 'xyzzy'])} AS banned_phrases,
       {pick([text(s) for s in SPECIALS], 'a.conv_id')} AS special, length(a.text) / 100.0 AS latency_seconds,
       CAST(DATE '{EVENTS_START}' + CAST(a.turn AS INTEGER) AS DATE) AS ts
FROM conversations a JOIN conversations u ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE a.role = 'assistant' AND u.role = 'user')
""")


def amounts(expr, skip_years) -> str:
    years = ", lambda v: NOT (v > 1900 AND v < 2100))" if skip_years else ", lambda v: true)"
    return f"""list_distinct(list_filter(list_concat(
 list_transform(regexp_extract_all({expr}, '{K.DOLLAR_PATTERN}'), lambda m: TRY_CAST(regexp_replace(m, '[$,]', '', 'g') AS DOUBLE)),
 list_filter(list_transform(regexp_extract_all({expr}, '{K.LONG_NUMBER_PATTERN}'), lambda m: TRY_CAST(m AS DOUBLE)){years}), lambda v: v IS NOT NULL))"""


cte("eval_parts", "eval_log", f"""
SELECT *, {amounts('response', True)} AS said, {amounts("coalesce(tool_text, '')", False)} AS known,
       list_filter(expected_tools, lambda t: list_contains(actual_tools, t)) AS tool_hits,
       CASE WHEN len(expected_tools) > 0 THEN list_filter(actual_tools, lambda t: NOT list_contains(expected_tools, t)) ELSE [] END AS unexpected,
       list_filter(required_keywords, lambda k: contains(lower(response), lower(k))) AS kw,
       list_filter(banned_phrases, lambda k: contains(lower(response), lower(k))) AS banned,
       CASE WHEN special = 'should_not_name_person' AND length(regexp_extract(response, '{K.NAMED_PERSON_PATTERN}', 1)) > 0 THEN 1 ELSE 0 END
       + CASE WHEN special = 'should_express_uncertainty' AND NOT ({' OR '.join(f"contains(lower(response), {text(p)})" for p in K.UNCERTAINTY_PHRASES)})
              THEN 1 ELSE 0 END AS n_special,
       list_filter(list_transform(string_split_regex(response, '[.!?\\n]'), lambda s: trim(regexp_replace(s, '[\\r\\t]', ' ', 'g'))),
                   lambda s: length(s) > 20) AS sentences
FROM eval_log
""")
cte("eval_lost", "eval_parts", """
SELECT *, list_filter(said, lambda n: len(list_filter(known, lambda t: (t = 0 AND n = 0) OR (t <> 0 AND abs((n - t) / t) < 0.05))) = 0) AS lost,
       list_filter(sentences, lambda s: len(list_filter(list_distinct(regexp_extract_all(lower(s), '[\\p{L}\\p{N}_]{4,}')),
             lambda w: contains(lower(tool_text), w))) * 1.0
             / nullif(len(list_distinct(regexp_extract_all(lower(s), '[\\p{L}\\p{N}_]{4,}'))), 0) > 0.3) AS grounded
FROM eval_parts
""")
cte("eval_scored", "eval_lost", """
SELECT *, overall_score >= 60 AND hallucination_score < 0.5 AS passed FROM (
SELECT *, tool_accuracy * 25 + keyword_score * 20 + (1 - hallucination_score) * 30 + groundedness_score * 15
       + CASE WHEN banned_phrase_violations = 0 THEN 10 ELSE 0 END AS overall_score FROM (
SELECT *, CASE WHEN len(expected_tools) > 0 THEN len(tool_hits) * 1.0 / len(expected_tools) ELSE 1.0 END AS tool_accuracy,
       CASE WHEN len(required_keywords) > 0 THEN len(kw) * 1.0 / len(required_keywords) ELSE 1.0 END AS keyword_score,
       len(banned) AS banned_phrase_violations,
       len(said) AS numbers_in_response, len(said) - len(lost) AS numbers_traceable,
       CASE WHEN len(said) > 0 THEN len(lost) + n_special ELSE 0 END AS n_flags,
       CASE WHEN len(said) = 0 THEN 0.0 WHEN len(lost) = 0 AND n_special > 0 THEN 0.5 ELSE len(lost) * 1.0 / len(said) END AS hallucination_score,
       CASE WHEN tool_text IS NULL OR len(sentences) = 0 THEN 0.5 ELSE len(grounded) * 1.0 / len(sentences) END AS groundedness_score
FROM eval_lost))
""")
