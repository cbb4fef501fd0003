"""Threshold ladders and formulas on hand-computed rows: at, below and above each edge, NULL, zero."""

import math

import pytest
from pyspark.sql import functions as F

from procurelytics import constants as K
from procurelytics.functions import dates, text
from procurelytics.functions.bands import band, clamp, lookup, ratio
from procurelytics.operators import inventory, prices, risk, signals, weather
from procurelytics.sources import payloads


def column(spark, values, kind, make):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(make(F.col("v"))).collect()]


@pytest.mark.parametrize("rules, otherwise, values, labels", [
    (K.COMBINED_RISK_BANDS, "MODERATE", [50.0, 49.99, 35.0, 34.99, 20.0, 19.99, None],
     ["CRITICAL", "HIGH", "HIGH", "ELEVATED", "ELEVATED", "MODERATE", "MODERATE"]),
    (K.TARIFF_RISK_BANDS, "MODERATE", [70.0, 69.9, 50.0, 49.9, 30.0, 29.9], ["CRITICAL", "HIGH", "HIGH", "ELEVATED", "ELEVATED", "MODERATE"]),
    (K.CONCENTRATION_BANDS, "LOW", [1.0, 2.0, 3.0, 4.0, 5.0], ["CRITICAL", "HIGH", "MODERATE", "MODERATE", "LOW"]),
    (K.PRICE_DIRECTION_BANDS, "FALLING_FAST", [5.01, 5.0, 0.01, 0.0, -4.99, -5.0, None],
     ["RISING_FAST", "RISING", "RISING", "FALLING", "FALLING", "FALLING_FAST", "FALLING_FAST"]),
    (K.VOLATILITY_BANDS, "STABLE", [1.01, 1.0, 0.5, 0.3, None], ["HIGHLY_INTERMITTENT", "INTERMITTENT", "VARIABLE", "STABLE", "STABLE"]),
    (K.DISRUPTION_BANDS, "LOW", [50.0, 49.9, 25.0, 24.9], ["HIGH", "MODERATE", "MODERATE", "LOW"]),
    (K.SUPPLY_DAYS_BANDS, "CRITICAL", [60.0, 59.0, 30.0, 29.0], ["Healthy", "Monitor", "Monitor", "CRITICAL"]),
    (K.GSCPI_BANDS, "LOW", [1.01, 1.0, -0.99, -1.0], ["ELEVATED", "NORMAL", "NORMAL", "LOW"]),
    (K.AGREEMENT_BANDS, "LOW", [4.9, 5.0, 14.9, 15.0], ["HIGH", "MODERATE", "MODERATE", "LOW"]),
])
def test_bands(spark, rules, otherwise, values, labels):
    assert column(spark, values, "double", lambda v: band(v, rules, otherwise)) == labels


def test_small_helpers(spark):
    assert column(spark, [-1.0, 50.0, 101.0, None], "double", clamp) == [0.0, 50.0, 100.0, None]
    assert column(spark, [4.0, 0.0, -1.0, None], "double", lambda v: ratio(F.lit(2.0), v)) == [0.5, 0.0, 0.0, 0.0]
    assert column(spark, ["a", "it's", "z", None], "string", lambda v: lookup(v, {"a": "A", "it's": "B"}, "?")) == ["A", "B", "?", "?"]


def test_weights_add_up():
    assert sum(K.COMBINED_RISK_WEIGHTS.values()) == pytest.approx(1)
    assert sum(K.COST_PRESSURE_WEIGHTS.values()) == pytest.approx(1)
    assert sum(K.COMPOSITE_WEIGHTS) == 100


# --- dates --------------------------------------------------------------------------
def days(values):
    return [None if v is None else v.isoformat() for v in values]


def test_fiscal_calendar(spark):
    values = ["2023-09-30", "2023-10-01", "2023-12-31", "2024-01-01", "2024-04-01", "2024-07-01", "bad", None]
    assert column(spark, values, "string", dates.fiscal_year) == [2023, 2024, 2024, 2024, 2024, 2024, None, None]
    assert column(spark, values, "string", dates.fiscal_quarter) == ["Q4", "Q1", "Q1", "Q2", "Q3", "Q4", None, None]


def test_period_spellings(spark):
    quarter = column(spark, ["2024Q1", "2024q4", "2024Q9", "2024-05-06", "2024", None, "x"], "string", dates.parse_quarter_period)
    assert days(quarter) == ["2024-01-01", "2024-10-01", "2024-01-01", "2024-05-06", "2024-01-01", None, None]
    compact = column(spark, ["202403", "2024", "20245", "bad", None], "string", dates.parse_compact_period)
    assert days(compact) == ["2024-03-01", "2024-01-01", None, None, None]
    index = column(spark, ["2024-3-31", "2024/11", "2024", "202402", "bad"], "string", dates.parse_index_date)
    plain = column(spark, ["2024-05-06T00:00", "2024", "May", None], "string", dates.parse_plain_period)
    assert days(plain) == ["2024-05-06", "2024-01-01", None, None]
    assert days(index) == ["2024-03-01", "2024-11-01", "2024-01-01", "2024-02-01", None]


def test_spine_has_no_gaps(spark):
    rows = spark.createDataFrame([("2024-01-31",), ("2024-04-01",), (None,)], "d string")
    assert days([r.month for r in dates.month_spine_of(rows, "d").orderBy("month").collect()]) == ["2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01"]
    assert dates.month_spine_of(rows.limit(0), "d").count() == 0


# --- texts --------------------------------------------------------------------------
def test_event_rules_are_substrings_in_order(spark):
    titles = ["URBAN planning", "Fiscal year end", "raise tariff ban", "new tariff exclusion", "nothing", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "i int, title string").orderBy("i")
    out = [r.event_type for r in payloads.classify_events(rows, "title").collect()]
    assert out == ["IMPORT_BAN", "EXPORT_CONTROL", "TARIFF_INCREASE", "NEW_TARIFF", "TRADE_NOTICE", "TRADE_NOTICE"]
    strict = [r.event_type for r in payloads.classify_events(rows, "title", word_boundary=True).collect()]
    assert strict == ["TRADE_NOTICE", "TRADE_NOTICE", "TARIFF_INCREASE", "NEW_TARIFF", "TRADE_NOTICE", "TRADE_NOTICE"]


def test_country_takes_list_order(spark):
    texts = ["goods of North Korea", "neutral ground", "Canada and China", "none", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    out = [(r.country_code, r.country_name) for r in payloads.extract_country(rows, "t").collect()]
    assert out == [("KR", "SOUTH KOREA"), ("EU", "EU"), ("CN", "CHINA"), (None, None), (None, None)]


def test_hts_and_numbers(spark):
    codes = column(spark, ["in 1999 code 8703 and 7601", "18703 x8703", "87031", None], "string",
                   lambda v: text.first_listed_code(v, list(K.HTS_DESCRIPTIONS), "0000"))
    assert codes == ["8703", "0000", "0000", "0000"]
    said = column(spark, ["$1,234.50 and 2024 and 1900 and 12345 $,", "", None], "string", lambda v: text.amounts(v, skip_years=True))
    assert sorted(said[0]) == [1234.5, 1900.0, 12345.0] and said[1] == [] and said[2] is None


def test_severity(spark):
    rows = spark.createDataFrame([("Rule", "a"), ("prorule", "b"), ("Proposed Rule", "c"), ("Notice", "d"), (None, "e")], "t string, id string")
    out = {r.id: (r.severity, r.impact_score) for r in payloads.severity_score(rows, "t").collect()}
    assert out == {"a": ("HIGH", 70), "b": ("ELEVATED", 50), "c": ("ELEVATED", 50), "d": ("MODERATE", 30), "e": ("MODERATE", 30)}
    spread = payloads.severity_score(rows, "t", jitter=10, id_col="id")
    first, again = [sorted((r.id, r.impact_score) for r in spread.collect()) for _ in range(2)]
    assert first == again and all(abs(v - out[i][1]) <= 10 for i, v in first)


def test_company_size(spark):
    assert column(spark, ["Small, Large", "Large", "Other", "", None], "string", payloads.company_size) == ["SMALL", "LARGE", "MEDIUM", None, None]


# --- geography -----------------------------------------------------------------------
def test_distance_and_nearest(spark):
    rows = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 5.0), (3, 44.0247, -88.5426)], "i int, lat double, lon double").orderBy("i")
    km = [r.distance_to_hq_km for r in risk.distance_to(rows).collect()]
    a = math.sin(math.radians(44.0247) / 2) ** 2 + math.cos(math.radians(44.0247)) * math.sin(math.radians(88.5426) / 2) ** 2
    assert km[0] == pytest.approx(2 * math.asin(math.sqrt(a)) * 6371) and km[1] is None and km[2] == pytest.approx(0)
    near = risk.nearest_facility(rows, [("far", 80.0, 80.0), ("home", 44.0, -88.5)]).collect()
    assert [r.nearest_facility for r in near] == ["far" if near[0].nearest_facility == "far" else "home", None, "home"]


def test_regions(spark):
    rows = spark.createDataFrame([("USA",), ("CHN",), ("ISR",), ("usa",), (None,)], "country string")
    got = [r.region_group for r in risk.region_lookup(rows, "country").collect()]
    assert got == ["AMERICAS", "CHINA", "MIDEAST", "OTHER", "OTHER"]
    located = risk.region_lookup(rows, "country").withColumn("distance_to_hq_km", F.lit(1.0))
    levels = {r.region_group: r.geographic_risk_level for r in risk.geographic_risk(located).collect()}
    assert levels == {"AMERICAS": "LOW", "CHINA": "CRITICAL", "MIDEAST": "HIGH", "OTHER": "UNKNOWN"}


# --- trade -----------------------------------------------------------------------------
def events(spark, rows):
    return spark.createDataFrame(rows, "event_id string, event_date string, event_type string, country_code string, hts_code string, "
                                       "severity string, impact_score double, affected_value_usd double, rate_change_pct double, effective_date string")


def test_trade_index_caps_only_the_sum(spark):
    raw = events(spark, [
        ("a", "2024-01-05", "SANCTION", "CN", "8703", "CRITICAL", 70.0, None, 0.0, None),
        ("b", "2024-02-05", "TRADE_NOTICE", "CN", "7308", "MODERATE", 30.0, None, 0.0, "bad"),
        ("c", "2024-02-09", None, None, "0000", "HIGH", 50.0, None, 0.0, "2024-02-09"),
    ])
    silver = risk.trade_events_silver(raw)
    assert [(r.is_negative_event, r.product_category) for r in silver.orderBy("event_id").collect()] == [
        (True, "VEHICLES"), (False, "STEEL_STRUCTURES"), (False, "OTHER")]
    jan, feb = risk.trade_risk_index(silver).orderBy("month").collect()
    assert (jan.event_count, jan.critical_events, jan.total_affected_value_usd) == (1, 1, None)
    assert jan.tariff_risk_index == 100 and jan.risk_level == "CRITICAL"  # 15 * 35 alone is above the cap
    assert feb.tariff_risk_index == 100  # 25 + 8/2*35 + 10 + 3/20*15, capped
    assert (feb.countries_affected, feb.product_categories_affected) == (1, 2)
    small = risk.trade_risk_index(silver.where("severity = 'MODERATE'")).first()
    assert small.tariff_risk_index == pytest.approx(0 + 0 + 7.5 + 2 / 20 * 15)


# --- prices, weather -------------------------------------------------------------------
def test_price_changes(spark):
    rows = spark.createDataFrame([("A", f"2024-{m:02d}-28", v) for m, v in [(1, 0.0), (2, 10.0), (3, 11.0), (4, 5.5)]],
                                 "indicator_code string, as_of_date string, value double")
    out = prices.commodity_scores(rows).orderBy("as_of_date").collect()
    assert [r.pct_change_1mo for r in out] == [None, None, pytest.approx(10), pytest.approx(-50)]
    assert [r.price_direction for r in out] == ["FALLING_FAST", "FALLING_FAST", "RISING_FAST", "FALLING_FAST"]
    assert [r.volatility_flag for r in out] == ["LOW_VOLATILITY", "LOW_VOLATILITY", "MODERATE_VOLATILITY", "HIGH_VOLATILITY"]
    assert out[2].cost_pressure_score == pytest.approx(3) and out[3].pct_change_3mo is None


def test_weather_edges(spark):
    rows = spark.createDataFrame([
        (35.0, -15.0, 100.0, 15.0, 0.0), (35.1, -15.1, 100.1, 15.1, 50.1), (20.0, 0.0, 9.9, 20.1, 20.0), (None, None, None, None, None),
    ], "tmax double, tmin double, prcp double, wspd double, snow double")
    out = weather.weather_index(rows.coalesce(1)).collect()
    assert [r.extreme_heat_days for r in out] == [0, 15, 0, 0]
    assert [r.precipitation_anomaly for r in out] == ["NORMAL", "HEAVY", "DROUGHT", "NORMAL"]
    assert [r.storm_event_count for r in out] == [1, 3, 1, 0]
    assert [r.snow_disruption_risk for r in out] == ["NONE", "HIGH", "LOW", "NONE"]
    assert [r.weather_disruption_index for r in out] == [10, 95, 30, 0]
    assert [r.disruption_risk_level for r in out] == ["LOW", "HIGH", "MODERATE", "LOW"]


# --- signals and stock --------------------------------------------------------------------
def test_signals_fill_before_scores(spark):
    spine = dates.month_spine(spark, "2024-01-01", "2024-03-01")
    prime = spark.createDataFrame([("2024-02-01", 100.0, 2, 1, 50.0)], "month string, prime_obligations_usd double, prime_action_count long, unique_awards long, avg_obligation_per_action double"
                                  ).withColumn("month", F.to_date("month"))
    out = signals.unified_demand_signals(spine, prime=prime).orderBy("month").collect()
    assert [r.total_obligations_usd for r in out] == [0, 100, 0] and [r.subaward_ratio for r in out] == [0, 0, 0]
    assert {r.risk_level for r in out} == {"MODERATE"} and {r.combined_risk_index for r in out} == {0}
    assert [(r.fiscal_year, r.fiscal_quarter) for r in out] == [(2024, "Q2")] * 3


def test_stock_formulas(spark):
    rows = spark.createDataFrame([("2024-01-01", 310.0, 50.0), ("2024-02-01", 290.0, 0.0), ("2024-03-01", 0.0, 40.1)],
                                 "month string, total_obligations_usd double, combined_risk_index double").withColumn("month", F.to_date("month"))
    rows = rows.withColumns({"risk_level": F.lit("x"), "fiscal_year": F.lit(2024), "fiscal_quarter": F.lit("Q2")})
    first, second, third = inventory.inventory_table(rows).orderBy("month").collect()
    assert first.coefficient_of_variation is None and first.demand_volatility_category == "STABLE"  # one row has no deviation
    assert first.demand_stddev_proxy == 0 and first.avg_daily_demand_proxy == 10
    assert first.requirements_objective_proxy == 10 * 30 + 10 * 120 and first.days_of_supply_proxy == 150
    assert first.approved_acquisition_objective_proxy == 1500 + 310 * 24
    sd = math.sqrt(200)
    assert second.safety_stock_proxy == pytest.approx(1.65 * sd * 2) and second.demand_6mo_avg == 300
    assert first.risk_adjusted_safety_stock == 0 and second.risk_adjusted_ro == pytest.approx(1500 + 1.65 * sd * 2)
    assert third.days_of_supply_proxy == 0 and third.nmcs_risk_indicator == "HIGH_RISK"
    assert first.nmcs_risk_indicator == "ELEVATED_RISK" and second.nmcs_risk_indicator == "NORMAL"


def test_windows_go_by_month_on_a_sparse_series(spark):
    from procurelytics.operators import inventory
    from procurelytics.operators.series import series_spine

    rows = spark.createDataFrame([("s", "2024-01-01", 10.0), ("s", "2024-06-01", 40.0), ("s", "2024-12-01", 70.0), ("t", "2024-03-01", 5.0)], "series string, m string, total_obligations_usd double")
    dense = series_spine(rows.select("series", F.to_date("m").alias("month"), "total_obligations_usd"), series="series", zero=["total_obligations_usd"])
    assert dense.count() == 13
    out = inventory.rolling_demand_stats(dense.withColumn("combined_risk_index", F.lit(1.0)), series="series")
    last = out.where("series = 's'").orderBy(F.desc("month")).first()
    assert round(last["demand_3mo_avg"], 1) == 23.3
