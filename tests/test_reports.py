"""Reports against numpy, and response scoring against plain Python."""

import datetime
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from procurelytics import constants as K
from procurelytics.operators import drivers, evaluate, insights, scenario
from procurelytics.sources.tables import literal_rows


@pytest.fixture(scope="module")
def demand():
    rng = np.random.default_rng(3)
    return 100 + 5 * np.arange(30) + rng.normal(0, 20, 30)


@pytest.fixture(scope="module")
def table(spark, demand):
    rows = [(datetime.date(2022 + m // 12, m % 12 + 1, 1), float(v), float(m % 5), float(m % 7), float(m % 3), float(m % 4)) for m, v in enumerate(demand)]
    return spark.createDataFrame(rows, "month date, total_obligations_usd double, geo_risk_index double, tariff_risk_index double, "
                                       "weather_disruption_index double, commodity_cost_pressure double").withColumn("combined_risk_index", F.lit(1.0))


def test_confidence(table, demand):
    y = demand[-12:]
    r = np.corrcoef(np.arange(12), y)[0, 1]
    out = insights.forecast_confidence(table, as_of=F.lit("2024-07-01").cast("date")).first()
    assert out.cv == pytest.approx(y.std() / y.mean()) and out.r2 == pytest.approx(r * r)
    assert out.t_statistic == pytest.approx(abs(r) * np.sqrt(10 / (1 - r * r)))
    assert out.days_since_last == 30 and out.recency_score == pytest.approx(50)
    risks = [np.array([m % k for m in range(18, 30)], float) for k in (5, 7, 3)]
    steady = np.mean([max(0, 100 - x.std(ddof=1) / (x.mean() + 1e-9) * 100) for x in risks])
    assert out.risk_score == pytest.approx(steady)


def test_trend_season_swings(table, demand):
    y = demand[-12:]
    slope = np.polyfit(np.arange(12), y, 1)[0]
    growth = insights.trend_growth(table).first()
    assert growth.slope == pytest.approx(slope) and growth.monthly_growth_pct == pytest.approx(slope / y.mean() * 100)
    season = insights.seasonality(table).first()
    assert season.peak_demand == pytest.approx(y.max()) and season.amplitude_pct == pytest.approx((y.max() - y.min()) / y.mean() * 100)
    swings = insights.volatility_swings(table, threshold=0.1).first()
    assert swings.large_swings == int((np.abs(np.diff(y) / y[:-1]) > 0.1).sum()) and swings.std_dev == pytest.approx(y.std())
    corr = {r.risk: r.correlation for r in insights.risk_correlations(table).collect()}
    assert corr["geo_risk_index"] == pytest.approx(np.corrcoef(y, [m % 5 for m in range(18, 30)])[0, 1])


def test_anomalies(table, demand):
    base = demand[:-6].mean()
    want = {round(v, 6) for v in demand[-6:] if abs((v - base) / base * 100) > 20}
    assert {round(r.total_obligations_usd, 6) for r in insights.detect_anomalies(table).collect()} == want


def test_short_and_zero_series(spark, table):
    one = table.limit(1)
    assert insights.trend_growth(one).first().slope is None
    assert insights.detect_anomalies(one).count() == 0
    late = table.withColumn("total_obligations_usd", F.when(F.col("month") == "2024-06-01", 5.0).otherwise(0.0))
    assert [r.severity for r in insights.detect_anomalies(late).collect()] == ["CRITICAL"]
    assert insights.volatility_swings(late).first().large_swings == 1
    zero = table.withColumn("total_obligations_usd", F.lit(0.0))
    assert insights.forecast_confidence(zero, as_of=F.current_date()).first().cv is None


def test_health_bounds_and_missing(spark, table):
    suppliers = literal_rows(spark, [("EUROPE",), ("ASIA",)], ["region_group"])
    metrics = literal_rows(spark, [("2024-01-01", 30.0, "ELEVATED_RISK")], ["month", "days_of_supply_proxy", "nmcs_risk_indicator"])
    commodity = literal_rows(spark, [("2024-01-01", 5.0)], ["month", "cost_pressure_score"])
    rows = {r.dimension: r for r in insights.health_scores(table, suppliers, commodity, metrics).collect()}
    assert rows["Supplier Base"].score == 21 and rows["Material Costs"].score == 70 and rows["Readiness"].score == 35
    assert all(0 <= r.score <= 100 for r in rows.values())
    assert rows["Readiness"].overall == pytest.approx(np.mean([r.score for r in rows.values()]))
    board = {r.dimension: r for r in insights.health_scores_dashboard(table.limit(1), metrics).collect()}
    assert board["Demand Stability"].score is None and board["Readiness"].score == 50
    gone = {r.dimension: r for r in insights.health_scores(table, suppliers, commodity.limit(0), metrics.limit(0)).collect()}
    assert gone["Readiness"].score is None and gone["Material Costs"].status is None and gone["Readiness"].overall > 0


def test_scenarios(spark, table, demand):
    base = demand[-12:].mean()
    geo = {r.risk_level: r for r in scenario.scenario_geo(table, literal_rows(spark, [("critical", "ALL"), ("odd", "ALL")], ["risk_level", "region"])).collect()}
    assert geo["critical"].projected_monthly == pytest.approx(base * 1.75) and geo["odd"].multiplier == 1.0
    whatif = scenario.scenario_whatif(table, literal_rows(spark, [(50.0, 25.0, 10.0, -10.0)], ["geo_risk_pct", "tariff_pct", "commodity_price_pct", "demand_shock_pct"])).first()
    assert whatif.net_impact_pct == pytest.approx(15 - 1.25 - 0.2 - 10) and whatif.projected_monthly == pytest.approx(base * 1.0355)
    tariff = scenario.scenario_tariff(table, literal_rows(spark, [(25.0, "ALL")], ["tariff_increase_pct", "product_category"])).first()
    assert tariff.monthly_tariff_cost == pytest.approx(base * 0.075) and tariff.share_of_spend_pct == pytest.approx(7.5)


def test_pareto(spark):
    fi = literal_rows(spark, [("demand_lag_1m", 0.5), ("geo_risk_index", 0.3), ("odd_name", 0.2)], ["feature", "importance"])
    rows = drivers.importance_pareto(fi).orderBy("rank").collect()
    assert [r.category for r in rows] == ["Demand History", "Risk Signals", "Other"] and rows[2].label == "Odd Name"
    assert [round(r.cumulative_pct) for r in rows] == [50, 80, 100] and rows[0].features_to_cutoff in (2, 3)
    assert drivers.demand_drivers(fi).first().insight == "Historical patterns dominate"


# --- responses: the rules in plain Python -------------------------------------------------
def plain_numbers(text, skip):
    out = set()
    for m in re.findall(K.DOLLAR_PATTERN, text):
        try:
            out.add(float(m.replace("$", "").replace(",", "")))
        except ValueError:
            pass
    return out | {float(m) for m in re.findall(K.LONG_NUMBER_PATTERN, text) if not (skip and 1900 < float(m) < 2100)}


def plain_scores(row):
    said, known = plain_numbers(row["response"], True), plain_numbers(" ".join(row["tool_outputs"]), False)
    traced = sum(any((t == 0 and n == 0) or (t != 0 and abs(n - t) / abs(t) < 0.05) for t in known) for n in said)
    extra = 0
    if row["special"] == "should_not_name_person":
        extra += bool(re.search(K.NAMED_PERSON_PATTERN, row["response"]))
    if row["special"] == "should_express_uncertainty":
        extra += not any(w in row["response"].lower() for w in K.UNCERTAINTY_PHRASES)
    halluc = 0.0 if not said else 1 - traced / len(said)
    if said and halluc == 0 and extra:
        halluc = 0.5
    ground = 0.5
    tools = " ".join(row["tool_outputs"]).lower()
    sentences = [s.strip() for s in re.split(r"[.!?\n]", row["response"]) if len(s.strip()) > 20]
    if row["tool_outputs"] and sentences:
        hits = 0
        for s in sentences:
            words = set(re.findall(r"\b\w{4,}\b", s.lower()))
            hits += bool(words) and sum(w in tools for w in words) / len(words) > 0.3
        ground = hits / len(sentences)
    return halluc, ground


LOG = [
    ("a", "Spend was $1,000 and 20500 units. The forecast demand is rising strongly!", ["demand forecast $1,010 and 20000 rising"], ""),
    ("b", "In 2024 nothing happened at all in this quarter", ["x"], "should_express_uncertainty"),
    ("c", "The CEO is John Smith and spend is $5,000 in this quarter", ["spend 5000"], "should_not_name_person"),
    ("d", "Spend is $5,000 here, we cannot confirm anything else", ["spend 5000"], "should_express_uncertainty"),
    ("e", "Spend is $5,000 here and that is quite certain, dear user", ["spend 5000"], "should_express_uncertainty"),
    ("f", "short", [], ""), ("g", "Zero cost $0 and $, and 9999 élan élève vitesse", ["0 $0 élan élève"], ""),
]


def test_response_scores(spark):
    rows = [(i, r, t, s, ["x", "y"], ["y", "z", "z"], ["Spend", "élan"], ["user"]) for i, r, t, s in LOG]
    log = spark.createDataFrame(rows, "prompt_id string, response string, tool_outputs array<string>, special string, expected_tools array<string>, "
                                      "actual_tools array<string>, required_keywords array<string>, banned_phrases array<string>"
                                ).withColumns({"difficulty": F.lit("easy"), "category": F.lit("Multi Tool")})
    out = {r.prompt_id: r for r in evaluate.eval_composite(log).collect()}
    for i, response, tools, special in LOG:
        halluc, ground = plain_scores({"response": response, "tool_outputs": tools, "special": special})
        assert out[i].hallucination_score == pytest.approx(halluc), i
        assert out[i].groundedness_score == pytest.approx(ground), i
        assert out[i].tool_accuracy == 0.5 and out[i].unexpected_tools == ["z", "z"]
    assert out["b"].hallucination_flags == [] and out["c"].hallucination_score == 0.5 and out["d"].hallucination_flags == []
    assert out["e"].banned_phrase_violations == 1 and out["g"].keyword_hits == 1
    assert evaluate.in_scope(log, "multi-tool").count() == len(LOG) and evaluate.in_scope(log, "hard").count() == 0
    assert evaluate.in_scope(log, max_n=2).count() == 2


def test_empty_expectations(spark):
    log = spark.createDataFrame([("a", "hello there", [], "", [], ["z"], [], [])], "prompt_id string, response string, tool_outputs array<string>, special string, "
                                "expected_tools array<string>, actual_tools array<string>, required_keywords array<string>, banned_phrases array<string>")
    row = evaluate.eval_composite(log).first()
    assert (row.tool_accuracy, row.keyword_score, row.unexpected_tools, row.overall_score) == (1.0, 1.0, [], 25 + 20 + 30 + 7.5 + 10)
