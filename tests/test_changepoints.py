"""Bending trends: planted bends are found, straight series stay straight, intervals cover."""

import numpy as np
import pandas as pd
import pytest

from procurelytics.operators import changepoints, forecast
from test_forecast import SCHEMA, future, planted


def bent(name, n=108, at=60, before=0.25, after=-0.25, noise=0.02, seed=0, season=0.2):
    rng, t = np.random.default_rng(seed), np.arange(n) / 12
    trend = 10 + before * t + (after - before) * np.maximum(t - at / 12, 0)
    months = pd.date_range("2012-01-01", periods=n, freq="MS")
    y = np.exp(trend + season * np.sin(2 * np.pi * (months.month - 1) / 12) + rng.normal(0, noise, n))
    return pd.DataFrame({"series": name, "month": months.date, "total_obligations_usd": y, "geo_risk_index": 1.0, "tariff_risk_index": rng.normal(5, 1, n)})


def test_descent_solves_the_penalised_problem():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 8))
    y = x[:, 2] * 3 - x[:, 5] * 2 + rng.normal(0, 0.1, 60)
    b = changepoints.few_bends(x.T @ x, x.T @ y, 20.0, np.zeros(8))
    pull = x.T @ (y - x @ b)  # optimal: pulls equal the penalty where b is not zero, and stay below it elsewhere
    assert np.abs(pull[b != 0] - 20.0 * np.sign(b[b != 0])).max() < 1e-4 and np.abs(pull[b == 0]).max() <= 20.0 + 1e-6
    assert set(np.flatnonzero(b)) == {2, 5}


def test_a_planted_bend_is_found_and_followed(spark):
    df = spark.createDataFrame(bent("a").iloc[:96], SCHEMA)
    truth = bent("a", noise=0.0)["total_obligations_usd"].to_numpy()[96:]
    out = changepoints.forecast_changepoints(df, series="series", events=False).orderBy("month").toPandas()
    ahead, straight = out[out["is_forecast"]], forecast.forecast_fourier(df, series="series", events=False).where("is_forecast").orderBy("month").toPandas()
    error = np.abs(ahead["forecast_demand_usd"].to_numpy() / truth - 1).mean()
    assert error < 0.06 and error < np.abs(straight["forecast_demand_usd"].to_numpy() / truth - 1).mean() / 3
    assert out["n_bends"].iloc[0] >= 1 and out["yearly_growth"].iloc[0] == pytest.approx(-0.25, abs=0.06)
    assert abs((pd.Timestamp(out["last_bend"].iloc[0]) - pd.Timestamp("2017-01-01")).days) < 450
    width = np.log(ahead["forecast_upper"]) - np.log(ahead["forecast_lower"])
    assert width.iloc[-1] > width.iloc[0]


def test_a_straight_series_keeps_few_bends_and_its_forecast(spark):
    df = spark.createDataFrame(planted("a"), SCHEMA)
    out = changepoints.forecast_changepoints(df, series="series").where("is_forecast").orderBy("month").toPandas()
    assert np.abs(out["forecast_demand_usd"] / future() - 1).mean() < 0.03 and out["yearly_growth"].iloc[0] == pytest.approx(0.1, abs=0.03)


def test_interval_coverage(spark):
    rng = np.random.default_rng(3)
    whole = [bent(f"s{i}", at=int(rng.integers(20, 70)), before=rng.normal(0, 0.2), after=rng.normal(0, 0.2), noise=0.05, seed=i) for i in range(24)]
    df = spark.createDataFrame(pd.concat([w.iloc[:96] for w in whole]), SCHEMA)
    out = changepoints.forecast_changepoints(df, series="series", events=False).where("is_forecast").toPandas()
    actual = pd.concat([w.iloc[96:] for w in whole])[["series", "month", "total_obligations_usd"]]
    both = out.merge(actual, on=["series", "month"])
    inside = ((both["total_obligations_usd"] >= both["forecast_lower"]) & (both["total_obligations_usd"] <= both["forecast_upper"])).mean()
    assert len(both) == 24 * 12 and 0.8 < inside <= 1
    again = changepoints.forecast_changepoints(df.repartition(3), series="series", events=False).where("is_forecast").toPandas()
    key = ["series", "month"]
    assert again.sort_values(key)["forecast_upper"].to_numpy() == pytest.approx(out.sort_values(key)["forecast_upper"].to_numpy())


def test_short_series(spark):
    df = spark.createDataFrame(pd.concat([planted("s", 4), planted("o", 1), planted("p", 2)]), SCHEMA)
    out = changepoints.forecast_changepoints(df, series="series", regressors=["geo_risk_index"]).where("is_forecast").toPandas()
    assert out.groupby("series").size().to_dict() == {"s": 12, "o": 12, "p": 12} and np.isfinite(out["forecast_demand_usd"]).all()
