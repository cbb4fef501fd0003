"""Seasonal ARIMA: the likelihood against a dense one, orders and coefficients of planted series, gaps."""

import numpy as np
import pandas as pd
import pytest

from procurelytics.operators import arima, forecast
from test_forecast import SCHEMA, future, planted


def covariances(ar, ma, n, steps=4000):
    psi = arima.weights_of_shocks(ar, ma, 0, 0, 12, steps)
    return np.array([psi[: steps - k] @ psi[k:] for k in range(n)])


@pytest.mark.parametrize("ar, ma", [([0.5, -0.2], [0.4]), ([], [0.3, 0.0, 0.5]), ([0.9], []), ([], [])])
def test_likelihood_is_exact(ar, ma):
    rng = np.random.default_rng(1)
    x, ar, ma = rng.normal(size=25), np.array(ar), np.array(ma)
    keep = np.ones(25, bool)
    keep[[3, 4, 17]] = False
    lags = np.abs(np.subtract.outer(np.arange(25), np.arange(25)))
    dense = covariances(ar, ma, 25)[lags][np.ix_(keep, keep)]
    want = x[keep] @ np.linalg.solve(dense, x[keep]) + np.linalg.slogdet(dense)[1]
    out, spread = arima.kalman(np.where(keep, x, np.nan)[:, None], ar[None], ma[None])
    assert np.nansum(out[0, :, 0] ** 2 / spread[0]) + np.log(spread[0, keep]).sum() == pytest.approx(want, rel=1e-8)


def test_fast_filter_equals_the_full_one():
    rng = np.random.default_rng(6)
    z = rng.normal(size=(60, 3))
    for order in ((0, 0, 0, 0), (2, 1, 0, 0), (1, 2, 1, 0), (0, 1, 0, 1), (3, 3, 2, 2)):
        ar, ma = arima.polynomials(rng.normal(0, 0.8, (5, sum(order))), order, 12)
        for a, b in zip(arima.fast_filter(z, ar, ma), arima.kalman(z, ar, ma)):
            np.testing.assert_allclose(a, b, rtol=1e-4, atol=1e-5)


def test_gaps_have_the_likelihood_of_what_was_seen():
    rng = np.random.default_rng(7)
    z = np.column_stack([rng.normal(size=50), np.ones(50), rng.normal(size=50)])
    z[[0, 7, 8, 31, 49], 0] = np.nan
    seen, free = np.isfinite(z[:, 0]), rng.normal(0, 0.6, (3, 3))
    value, beta, var = arima._concentrated(z, free, (1, 1, 0, 1), 4)
    ar, ma = arima.polynomials(free, (1, 1, 0, 1), 4)
    for i in range(3):
        lags = np.abs(np.subtract.outer(np.arange(50), np.arange(50)))
        dense = covariances(ar[i], ma[i], 50)[lags][np.ix_(seen, seen)]
        x, y = z[seen][:, 1:], z[seen, 0]
        inv = np.linalg.inv(dense)
        b = np.linalg.solve(x.T @ inv @ x, x.T @ inv @ y)
        rest = y - x @ b
        s2 = rest @ inv @ rest / seen.sum()
        want = seen.sum() * (np.log(2 * np.pi * s2) + 1) + np.linalg.slogdet(dense)[1]
        assert value[i] == pytest.approx(want, rel=1e-6) and beta[i] == pytest.approx(b, rel=1e-4) and var[i] == pytest.approx(s2, rel=1e-5)


def test_coefficients_are_always_stationary():
    free = np.random.default_rng(3).normal(0, 2, (50, 8))
    ar, ma = arima.polynomials(free, (3, 2, 2, 1), 12)
    for row in ar:
        assert np.abs(np.roots(np.r_[1, -row])).max() < 1 + 1e-6
    for row in ma:
        assert np.abs(np.roots(np.r_[1, row])).max() < 1 + 1e-6
    assert ar.shape == (50, 27) and ma.shape == (50, 14)


def test_planted_arma_is_recovered():
    rng, x = np.random.default_rng(7), np.zeros(400)
    e = rng.normal(size=400)
    for t in range(1, 400):
        x[t] = 0.7 * x[t - 1] + e[t] + 0.5 * e[t - 1]
    z = np.column_stack([x, np.ones(400)])
    aic, free = arima.fit_order(z, (1, 1, 0, 0), 12)
    ar, ma = arima.polynomials(free[None], (1, 1, 0, 0), 12)
    assert ar[0, 0] == pytest.approx(0.7, abs=0.1) and ma[0, 0] == pytest.approx(0.5, abs=0.12)
    best, order, _ = arima.search_orders(z, 12, (3, 3, 0, 0))
    pure = min(arima.fit_order(z, (p, 0, 0, 0), 12)[0] for p in range(4))
    assert best <= aic + 1e-6 and best <= pure + 1e-6 and order[1] >= 1


def airline(n, theta=0.4, seasonal=0.6, sd=0.03, seed=1):
    rng, y = np.random.default_rng(seed), np.zeros(n)
    e = rng.normal(0, sd, n)
    w = e[13:] - theta * e[12:-1] - seasonal * e[1:-12] + theta * seasonal * e[:-13]
    y[:13] = 10 + 0.3 * np.sin(2 * np.pi * np.arange(13) / 12)
    for t in range(13, n):
        y[t] = y[t - 1] + y[t - 12] - y[t - 13] + w[t - 13]
    return y


def test_seasonal_moving_average_is_recovered():
    y = airline(260, seed=7)
    w = arima.difference(y, 1, 1, 12)[:, None]
    _, free = arima.fit_order(w, (0, 1, 0, 1), 12)
    ma = arima.polynomials(free[None], (0, 1, 0, 1), 12)[1][0]
    assert ma[0] == pytest.approx(-0.4, abs=0.15) and ma[11] == pytest.approx(-0.6, abs=0.15) and ma[12] == pytest.approx(ma[0] * ma[11])
    mean, sd, name, _ = arima.forecast_series(airline(157)[:145], np.zeros((157, 0)), 12, 12, (2, 2, 1, 1))
    assert name.endswith("12") and ",1," in name and np.abs(mean[145:] - airline(157)[145:]).max() < 3.5 * sd[145:].max()
    assert (np.diff(sd[145:]) >= 0).all() and np.isnan(mean[:13]).all()


def test_differences_by_test():
    rng = np.random.default_rng(5)
    noise = rng.normal(size=120)
    season = 5 * np.sin(2 * np.pi * np.arange(120) / 12)
    assert arima.differences_asked_for(noise, 12) == (0, 0)
    assert arima.differences_asked_for(np.cumsum(noise), 12)[0] == 1
    assert arima.differences_asked_for(noise * 0.3 + season, 12)[1] == 1
    assert arima.differences_asked_for(np.full(40, 3.0), 12) == (0, 0)


def test_shock_weights_of_a_random_walk():
    none = np.zeros(0)
    assert arima.weights_of_shocks(none, none, 1, 0, 12, 4).tolist() == [1, 1, 1, 1]
    assert arima.weights_of_shocks(none, none, 0, 1, 3, 7).tolist() == [1, 0, 0, 1, 0, 0, 1]
    assert arima.weights_of_shocks(np.array([0.5]), np.array([0.25]), 0, 0, 12, 4).tolist() == [1, 0.75, 0.375, 0.1875]


def test_frames_with_gaps_regressors_and_short_series(spark):
    long = planted("a")
    long = long[~long.index.isin([40, 41, 70])]
    short, one = planted("s", 5), planted("o", 1)
    df = spark.createDataFrame(pd.concat([long, short, one]), SCHEMA)
    out = arima.forecast_arima(df, series="series", exog=["geo_risk_index"], max_order=(1, 1, 1, 1)).orderBy("series", "month").toPandas()
    ahead = out[out["is_forecast"]]
    assert ahead.groupby("series").size().to_dict() == {"a": 12, "o": 12, "s": 12} and np.isfinite(ahead["forecast_demand_usd"]).all()
    assert len(out[~out["is_forecast"]]) == 93 + 5 + 1
    a = ahead[ahead["series"] == "a"]
    assert np.abs(a["forecast_demand_usd"].to_numpy() / future() - 1).mean() < 0.05
    assert (a["forecast_lower"] < a["forecast_demand_usd"]).all() and (a["forecast_upper"] > a["forecast_demand_usd"]).all()
    ours = out[(out["series"] == "a") & ~out["is_forecast"] & out["forecast_demand_usd"].notna()]
    assert len(ours) >= 93 - 13 - 40 and (np.abs(ours["forecast_demand_usd"] / ours["actual_demand_usd"] - 1)).median() < 0.05


def test_regressors_are_found():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(132, 1))
    y = 5 + 0.8 * x[:120, 0] + rng.normal(0, 0.05, 120)
    mean, sd, _, _ = arima.forecast_series(y, x, 12, 12, (1, 1, 0, 0))
    assert np.abs(mean[120:] - 5 - 0.8 * x[120:, 0]).max() < 0.1 and sd[-1] < 0.1
    assert forecast._z(0.95) == pytest.approx(1.96, abs=0.001)
