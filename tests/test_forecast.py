"""Features against pandas; fits on planted series; splits without future rows."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from procurelytics.operators import features, forecast, forest, intermittent

SCHEMA = "series string, month date, total_obligations_usd double, geo_risk_index double, tariff_risk_index double"


def planted(name, n=96, noise=0.01, seed=0):
    rng = np.random.default_rng(seed)
    months = pd.date_range("2015-01-01", periods=n, freq="MS")
    season = 0.3 * np.sin(2 * np.pi * (months.month - 1) / 12)
    y = np.exp(10 + 0.1 * np.arange(n) / 12 + season + rng.normal(0, noise, n))
    return pd.DataFrame({"series": name, "month": months.date, "total_obligations_usd": y, "geo_risk_index": rng.normal(5, 1, n), "tariff_risk_index": rng.normal(5, 1, n)})


def future(n=96, horizon=12):
    t = np.arange(n, n + horizon)
    return np.exp(10 + 0.1 * t / 12 + 0.3 * np.sin(2 * np.pi * (t % 12) / 12))


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(pd.concat([planted("a"), planted("b", seed=1)]), SCHEMA)


def test_features_match_pandas(spark):
    pdf = planted("a", 30)
    out = features.demand_features(spark.createDataFrame(pdf, SCHEMA), series="series", parity=True, drop_incomplete=False).orderBy("month").toPandas()
    y = pdf["total_obligations_usd"]
    want = {"demand_lag_12m": y.shift(12), "demand_trend_3m": y.shift(1) - y.shift(3), "demand_pct_change_3m": y.pct_change(3),
            "geo_risk_lag_1m": pdf["geo_risk_index"].shift(1), "combined_risk_interaction": pdf["geo_risk_index"] * pdf["tariff_risk_index"]}
    for k in (3, 6, 12):
        rolled = y.shift(1).rolling(k)
        want |= {f"demand_rolling_mean_{k}m": rolled.mean(), f"demand_rolling_std_{k}m": rolled.std(), f"demand_rolling_max_{k}m": rolled.max()}
    for name, series in want.items():
        np.testing.assert_allclose(out[name].astype(float), series.astype(float), rtol=1e-9, err_msg=name)
    assert out["is_q4"].sum() == 6 and out["months_since_start"].iloc[1] == pytest.approx(31 / 30.44)


def test_no_leak_by_default_and_int_features_stay(rows):
    out = features.demand_features(rows, series="series")
    names = features.feature_columns(out, series="series")
    assert not any("pct_change" in n for n in names) and {"month_of_year", "quarter", "is_q4"} <= set(names)
    assert "total_obligations_usd" not in names and out.count() == 2 * (96 - 12)


def test_split_has_no_future_in_train(rows):
    out = features.temporal_split(rows, series="series")
    last, first = out.groupBy("series").agg(F.max(F.when(F.col("split") == "TRAIN", F.col("month"))).alias("a"),
                                            F.min(F.when(F.col("split") == "TEST", F.col("month"))).alias("b")).select("a", "b").first()
    assert last < first and out.where("split = 'TEST'").count() == 24


def test_event_flags(spark):
    rows = spark.createDataFrame([(m,) for m in ("2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01", "2024-09-01", "2024-10-01", "2024-11-01")], "m string")
    out = rows.select(*[c.alias(n) for n, c in features.event_flags(F.to_date("m")).items()]).collect()
    assert [r.budget_submission for r in out] == [1, 1, 1, 0, 0, 0, 0] and [r.fiscal_year_end for r in out] == [0, 0, 0, 0, 1, 0, 0]
    assert [r.fiscal_year_start for r in out] == [0, 0, 0, 0, 0, 1, 0] and [r.spring_exercise for r in out] == [0, 0, 0, 1, 0, 0, 0]
    assert features.calendar_events(spark, [2023, 2024]).count() == 10


@pytest.mark.parametrize("fit", [forecast.forecast_fourier, forecast.forecast_ar])
def test_fits_recover_a_planted_series(rows, fit):
    out = fit(rows, series="series").where("is_forecast").orderBy("series", "month").toPandas()
    for _, part in out.groupby("series"):
        error = np.abs(part["forecast_demand_usd"].to_numpy() / future() - 1).mean()
        naive = np.abs(np.exp(10 + 0.1 * 95 / 12 + 0.3 * np.sin(2 * np.pi * 11 / 12)) / future() - 1).mean()
        assert len(part) == 12 and error < 0.06 and error < naive / 2
        assert (part["forecast_lower"] < part["forecast_demand_usd"]).all() and (part["forecast_upper"] > part["forecast_demand_usd"]).all()
        assert str(part["month"].iloc[0]) == "2023-01-01"


def test_short_and_single_series(spark):
    short = spark.createDataFrame(planted("s", 5), SCHEMA)
    for out in (forecast.forecast_ar(short, series="series"), forecast.forecast_ar(short), forecast.forecast_fourier(short, events=False)):
        got = out.where("is_forecast").toPandas()["forecast_demand_usd"]
        assert len(got) == 12 and np.isfinite(got).all()
    one = spark.createDataFrame(planted("s", 1), SCHEMA)
    assert forecast.forecast_ar(one).where("is_forecast").count() == 12


def test_cv_uses_only_the_past(rows):
    out = forecast.forecast_cv(rows, series="series")
    assert out.where("month <= cutoff OR datediff(month, cutoff) > 90").count() == 0
    metrics = forecast.forecast_metrics(out).first()
    assert metrics.mape_pct < 6 and 0.5 < metrics.coverage <= 1


def test_metrics_by_hand(spark):
    preds = spark.createDataFrame([(100.0, 90.0, 80.0, 95.0), (0.0, 10.0, -5.0, 20.0)], "actual_demand_usd double, forecast_demand_usd double, forecast_lower double, forecast_upper double")
    out = forecast.forecast_metrics(preds).first()
    assert (out.mae, out.rmse, out.mape_pct, out.coverage) == (10.0, 10.0, 10.0, 0.5)


@pytest.fixture(scope="module")
def fitted(rows):
    data, names = forest.prepare(rows, series="series")
    return data, names, forest.fit_rf(data.where("split = 'TRAIN'"), names, trees=20, depth=6)


def test_forest_intervals_come_from_its_trees(fitted):
    data, names, model = fitted
    out = forest.rf_intervals(model, data.where("split = 'TEST'"), names).toPandas()
    assert len(out) == 24
    np.testing.assert_allclose(out["tree_mean"], out["forecast_demand_usd"], rtol=1e-9)
    assert (out["forecast_lower"] <= out["forecast_demand_usd"]).all() and (out["forecast_upper"] >= out["forecast_demand_usd"]).all()


def test_forest_importance(spark, fitted):
    data, names, model = fitted
    fi = forest.rf_importance(spark, model, names).toPandas()
    assert len(fi) == len(names) and fi["importance"].sum() == pytest.approx(1) and list(fi["rank"]) == list(range(1, len(names) + 1))
    permuted = forest.permutation_importance(model, data.where("split = 'TEST'"), names, series="series").toPandas()
    assert len(permuted) == len(names) and permuted["rmse_increase"].max() > 0


def test_recursive_forecast_steps(spark, rows, fitted):
    _, names, model = fitted
    out = forest.forecast_rf_recursive(model, rows, names, series="series", months=3).orderBy("series", "month").toPandas()
    assert len(out) == 6 and str(out["month"].iloc[0]) == "2023-01-01"
    np.testing.assert_allclose(out["forecast_lower"], out["forecast_demand_usd"] * 0.85)
    # the first step equals a prediction from features made the usual way
    extra = spark.createDataFrame([("a", pd.Timestamp("2023-01-01").date(), 0.0, None, None)], SCHEMA)
    carried = rows.where("series = 'a'").unionByName(extra)
    filled = forecast.carry_forward_regressors(carried.select("series", "month", "total_obligations_usd"), rows.where("series = 'a'"), ["geo_risk_index", "tariff_risk_index"], series="series")
    usual = forest.rf_predict(model, features.demand_features(filled, series="series").where("month = '2023-01-01'"), names).first()
    assert usual.forecast_demand_usd == pytest.approx(out["forecast_demand_usd"].iloc[0])


def test_croston_by_hand(spark):
    rows = spark.createDataFrame([("s", "2024-01-01", 10.0), ("s", "2024-03-01", 20.0), ("s", "2024-04-01", 0.0), ("s", "2024-06-01", 5.0)], "series string, month string, total_obligations_usd double"
                                 ).withColumn("month", F.to_date("month"))
    out = intermittent.croston_sba(rows, series="series", alpha=0.5).first()
    size, gap = (10 + 20) / 2 / 2 + 2.5, 2.5
    assert (out.demand_months, out.demand_size, out.demand_interval) == (3, size, gap)
    assert out.croston_forecast == pytest.approx(size / gap) and out.sba_forecast == pytest.approx(size / gap * 0.75)
    assert math.isfinite(out.sba_forecast)


def test_ar_goes_by_month_and_keeps_all_rows(spark):
    rng = np.random.default_rng(7)
    months = pd.date_range("2015-01-01", periods=96, freq="MS")
    value = np.exp(10 + 0.3 * np.sin(2 * np.pi * np.arange(108) / 12))
    noisy = value[:96] * np.exp(rng.normal(0, 0.02, 96))
    gaps = {86, 89, 92}
    data = [("g", m.date(), float(v)) for i, (m, v) in enumerate(zip(months, noisy)) if i not in gaps]
    out = forecast.forecast_ar(spark.createDataFrame(data, "series string, month date, total_obligations_usd double"), series="series").orderBy("month").toPandas()
    assert len(out) == 93 + 12 and out["forecast_demand_usd"].isna().sum() >= 12
    ahead = out[out["is_forecast"]]["forecast_demand_usd"].to_numpy()
    assert np.abs(ahead / value[96:] - 1).mean() < 0.05


def test_fourier_carries_one_sharp_month_a_year(spark):
    pdf = planted("a", 96)
    june = pd.to_datetime(pdf["month"]).dt.month == 6
    pdf.loc[june, "total_obligations_usd"] *= 4
    rows = spark.createDataFrame(pdf, SCHEMA)
    out = forecast.forecast_fourier(rows, series="series").where("is_forecast").orderBy("month").toPandas()
    want = future() * np.where(pd.to_datetime(out["month"]).dt.month == 6, 4, 1)
    assert np.abs(out["forecast_demand_usd"] / want - 1).max() < 0.04
    assert (out["forecast_upper"] / out["forecast_lower"]).max() < 1.1
    assert out["fiscal_quarterly_seasonality"].abs().max() > 0.1
    metrics = forecast.forecast_metrics(forecast.forecast_cv(rows, series="series")).first()
    assert metrics.mape_pct < 2.5
