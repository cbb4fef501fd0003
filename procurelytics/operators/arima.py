"""Seasonal ARIMA with moving-average terms and exogenous regressors, many series in one job.

A series is one group of monthly rows.  The log of demand is differenced as two tests ask for; what is
left is regression with ARMA errors in state-space form.  The Kalman filter runs demand and
regressors through the same gains, so regression coefficients and variance have closed forms and only
the ARMA coefficients are searched, by a quasi-Newton descent over partial autocorrelations (always
stationary and invertible).  All points of a gradient or a line search are filtered as one batch.  Orders
are found by stepwise search on the information criterion."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from procurelytics.operators.forecast import VALUE, _spread, _z, forecast_horizon, monthly_series

#: Five-percent point of the stationarity statistic about a level.
KPSS_LEVEL = 0.463
#: Share of seasonal variance above which a yearly difference is taken.
SEASONAL_STRENGTH = 0.64


# --- differences --------------------------------------------------------------------------
def kpss(x: np.ndarray) -> float:
    """Stationarity statistic about a level, Bartlett weights; NaN is left out."""
    e = x[np.isfinite(x)]
    n = len(e)
    if n < 8:
        return 0.0
    e = e - e.mean()
    lags = int(4 * (n / 100) ** 0.25)
    long_run = e @ e / n + sum(2 * (1 - k / (lags + 1)) * (e[k:] @ e[:-k]) / n for k in range(1, lags + 1))
    return float((np.cumsum(e) ** 2).sum() / (n * n * max(long_run, 1e-300)))


def seasonal_strength(x: np.ndarray, season: int) -> float:
    """One minus the share of the remainder in season plus remainder, after a moving-average trend."""
    seen = np.isfinite(x)
    if seen.sum() < 2 * season + 1:
        return 0.0
    filled = np.interp(np.arange(len(x)), np.flatnonzero(seen), x[seen])
    half = season // 2
    weights = np.ones(season + 1)
    weights[[0, -1]] = 0.5
    trend = np.convolve(filled, weights / season, "valid")
    flat = (filled - np.concatenate([np.full(half, np.nan), trend, np.full(len(x) - half - len(trend), np.nan)]))
    flat[~seen] = np.nan
    month = np.arange(len(x)) % season
    means = np.array([np.nanmean(flat[month == m]) if np.isfinite(flat[month == m]).any() else 0.0 for m in range(season)])
    rest = flat - means[month]
    whole = np.nanvar(flat)
    return max(0.0, 1 - float(np.nanvar(rest)) / whole) if whole > 1e-18 else 0.0


def difference(x: np.ndarray, d: int, seasonal: int, season: int) -> np.ndarray:
    for _ in range(seasonal):
        x = x[season:] - x[:-season]
    for _ in range(d):
        x = x[1:] - x[:-1]
    return x


def _differences(d: int, seasonal: int, season: int) -> np.ndarray:
    """Weights of a level and its predecessors in the differenced value."""
    poly = np.array([1.0])
    for lag, times in ((season, seasonal), (1, d)):
        for _ in range(times):
            poly = np.convolve(poly, np.r_[1.0, np.zeros(lag - 1), -1.0])
    return poly


def differences_asked_for(x: np.ndarray, season: int, max_d: int = 2) -> tuple[int, int]:
    """(d, D) by the seasonal strength and by repeated stationarity tests."""
    seasonal = int(seasonal_strength(x, season) > SEASONAL_STRENGTH and np.isfinite(x).sum() >= 3 * season)
    d = 0
    while d < max_d and np.isfinite(rest := difference(x, d, seasonal, season)).sum() > season and np.nanvar(rest) > 1e-18 and kpss(rest) > KPSS_LEVEL:
        d += 1
    return d, seasonal


# --- coefficients ----------------------------------------------------------------------------
def _stationary(free: np.ndarray) -> np.ndarray:
    """AR coefficients from unbounded numbers through partial autocorrelations; (batch, order)."""
    partial, out = np.clip(np.tanh(free), -0.9995, 0.9995), np.zeros_like(free)
    for k in range(free.shape[1]):
        before = out[:, :k].copy()
        out[:, k] = partial[:, k]
        out[:, :k] = before - partial[:, k : k + 1] * before[:, ::-1]
    return out


def _expanded(short: np.ndarray, seasonal: np.ndarray, season: int) -> np.ndarray:
    """The product of both polynomials without its leading 1; (batch, order + season * seasonal order)."""
    n, p, s = len(short), short.shape[1], seasonal.shape[1]
    one = np.concatenate([np.ones((n, 1)), short], axis=1)
    out = np.zeros((n, p + s * season + 1))
    out[:, : p + 1] = one
    for k in range(s):
        out[:, (k + 1) * season : (k + 1) * season + p + 1] += seasonal[:, k : k + 1] * one
    return out[:, 1:]


def polynomials(free: np.ndarray, order, season: int) -> tuple[np.ndarray, np.ndarray]:
    """AR and MA weights (x[t] = sum ar[k] x[t-k] + e[t] + sum ma[k] e[t-k]) of a batch."""
    p, q, sp, sq = order
    cuts = np.cumsum([p, q, sp])
    short_ar, short_ma, long_ar, long_ma = np.split(free, cuts, axis=1)
    ar = -_expanded(-_stationary(short_ar), -_stationary(long_ar), season)
    return ar, _expanded(-_stationary(short_ma), -_stationary(long_ma), season)


# --- filter -----------------------------------------------------------------------------------
def _moved(m: np.ndarray, ar: np.ndarray) -> np.ndarray:
    """The transition matrix times ``m``: the first row spread by the AR weights, the others one up."""
    out = ar[:, :, None] * m[:, :1, :]
    out[:, :-1] += m[:, 1:]
    return out


def kalman(z: np.ndarray, ar: np.ndarray, ma: np.ndarray):
    """Innovations (batch, time, columns) and their variances (batch, time) of each column of ``z`` under
    ARMA errors of unit variance; a time with NaN in column 0 is passed over."""
    batch, size = len(ar), max(ar.shape[1], ma.shape[1] + 1, 1)
    phi, load = np.zeros((batch, size)), np.zeros((batch, size))
    phi[:, : ar.shape[1]], load[:, 0], load[:, 1 : ma.shape[1] + 1] = ar, 1.0, ma
    noise = load[:, :, None] * load[:, None, :]
    move = np.zeros((batch, size, size))
    move[:, :, 0] = phi
    move[:, np.arange(size - 1), np.arange(1, size)] = 1.0
    cov, power = noise.copy(), move  # the stationary covariance, by doubling
    for _ in range(30):
        step = power @ cov @ power.transpose(0, 2, 1)
        cov = cov + step
        if np.abs(step).max() <= 1e-9 * np.abs(cov).max():
            break
        power = power @ power
    state = np.zeros((batch, size, z.shape[1]))
    out, spread = np.full((batch, *z.shape), np.nan), np.empty((batch, len(z)))
    seen, steady = np.isfinite(z[:, 0]), False
    for t in range(len(z)):
        f = np.maximum(cov[:, 0, 0], 1e-12)
        spread[:, t] = f
        if seen[t]:
            v = z[t] - state[:, 0]
            out[:, t] = v
            if not steady:
                gain = cov[:, :, 0] / f[:, None]
                after = cov - gain[:, :, None] * gain[:, None, :] * f[:, None, None]
                grown = _moved(_moved(after, phi).transpose(0, 2, 1), phi) + noise
                steady = bool(seen[t:].all()) and np.abs(grown - cov).max() < 1e-10
                cov = grown
            state = _moved(state + gain[:, :, None] * v[:, None, :], phi)
        else:
            steady = False
            cov = _moved(_moved(cov, phi).transpose(0, 2, 1), phi) + noise
            state = _moved(state, phi)
    return out, spread


def _with_state(ar: np.ndarray, ma: np.ndarray, size: int) -> np.ndarray:
    """Covariance of the stationary state with the series' value, from its autocovariances; (batch, size)."""
    batch, p, q = len(ar), ar.shape[1], ma.shape[1]
    top = max(p, q, size) + 1
    theta, psi, right = np.concatenate([np.ones((batch, 1)), ma], axis=1), np.zeros((batch, top + 1)), np.zeros((batch, top + 1))
    for k in range(top + 1):
        psi[:, k] = theta[:, k] if k <= q else 0.0
        if m := min(k, p):
            psi[:, k] += (ar[:, :m] * psi[:, k - m : k][:, ::-1]).sum(axis=1)
    for k in range(q + 1):
        right[:, k] = (theta[:, k:] * psi[:, : q + 1 - k]).sum(axis=1)
    system = np.zeros((batch, p + 1, p + 1))
    for k in range(p + 1):
        system[:, k, k] += 1.0
        for i in range(1, p + 1):
            system[:, k, abs(k - i)] -= ar[:, i - 1]
    gamma = np.zeros((batch, top + 1))
    gamma[:, : p + 1] = np.linalg.solve(system, right[:, : p + 1, None])[:, :, 0]
    for k in range(p + 1, top + 1):
        gamma[:, k] = right[:, k] + ((ar * gamma[:, k - p : k][:, ::-1]).sum(axis=1) if p else 0.0)
    out = np.zeros((batch, size))
    for i in range(size):
        if i < p:
            out[:, i] += (ar[:, i:] * gamma[:, 1 : p - i + 1]).sum(axis=1)
        if i <= q:
            out[:, i] += (theta[:, i:] * psi[:, : q + 1 - i]).sum(axis=1)
    return out


def fast_filter(z: np.ndarray, ar: np.ndarray, ma: np.ndarray):
    """What ``kalman`` gives for complete columns.  From the stationary start the state's covariance changes by
    one rank a step, so a vector is carried instead of a matrix (Chandrasekhar recursions)."""
    batch, size = len(ar), max(ar.shape[1], ma.shape[1] + 1, 1)
    phi = np.zeros((batch, size))
    phi[:, : ar.shape[1]] = ar

    def moved(v):
        out = phi * v[:, :1]
        out[:, :-1] += v[:, 1:]
        return out

    first = _with_state(ar, ma, size)
    f = np.maximum(first[:, 0], 1e-12)
    change = moved(first)
    gain, weight = change / f[:, None], -1 / f
    state = np.zeros((batch, size, z.shape[1]))
    out, spread, steady = np.empty((batch, *z.shape)), np.empty((batch, len(z))), False
    for t in range(len(z)):
        spread[:, t] = f
        v = z[t] - state[:, 0]
        out[:, t] = v
        state = _moved(state, phi) + gain[:, :, None] * v[:, None, :]
        if not steady:
            lead, before = change[:, 0], f
            f = np.maximum(f + weight * lead * lead, 1e-12)
            on = moved(change)
            gain = (gain * before[:, None] + on * (weight * lead)[:, None]) / f[:, None]
            weight = weight + weight * weight * lead * lead / before
            change = on - gain * lead[:, None]
            steady = bool((np.abs(change) * np.sqrt(np.abs(weight))[:, None]).max() < 1e-7)
    return out, spread


def _concentrated(z: np.ndarray, free: np.ndarray, order, season: int):
    """-2 log likelihood, coefficients of the regressors and variance, each a batch.  A missing time gets a
    regressor of its own; with the determinant of these that is the likelihood of what was seen."""
    gaps, k = np.flatnonzero(~np.isfinite(z[:, 0])), z.shape[1] - 1
    n = len(z) - len(gaps)
    whole = np.zeros((len(z), z.shape[1] + len(gaps)))
    whole[:, : k + 1] = z
    whole[gaps, 0], whole[gaps, k + 1 + np.arange(len(gaps))] = 0.0, 1.0
    out, spread = fast_filter(whole, *polynomials(free, order, season))
    w = out / np.sqrt(spread)[:, :, None]
    y, x = w[:, :, 0], w[:, :, 1:]
    if x.shape[2]:
        gram = x.transpose(0, 2, 1) @ x
        light = np.where(np.arange(x.shape[2]) < k, 1e-8, 0.0)
        gram += np.eye(x.shape[2]) * (light * np.trace(gram, axis1=1, axis2=2)[:, None] / x.shape[2])[:, None, :] + np.eye(x.shape[2]) * 1e-12
        beta = np.linalg.solve(gram, (x.transpose(0, 2, 1) @ y[:, :, None]))[:, :, 0]
    else:
        beta = np.zeros((len(w), 0))
    rss = ((y - (x @ beta[:, :, None])[:, :, 0]) ** 2).sum(axis=1)
    var, holes = np.maximum(rss / n, 1e-12), x[:, :, k:]
    size = np.log(spread).sum(axis=1) + (np.linalg.slogdet(holes.transpose(0, 2, 1) @ holes)[1] if len(gaps) else 0.0)
    return n * (np.log(2 * math.pi * var) + 1) + size, beta[:, :k], var


def fit_order(z: np.ndarray, order, season: int, start=None, steps: int = 60, gain: float = 1e-6):
    """Maximum likelihood for one order: (AIC, free numbers).  Ends when a step gains less than ``gain``."""
    k = sum(order)
    free = np.zeros(k) if start is None else start
    size, scales = 1e-4, np.array([4.0, 2.0, 1.0, 0.5, 0.2, 0.05, 0.005])

    def at(points):
        return np.nan_to_num(_concentrated(z, np.atleast_2d(points), order, season)[0], nan=1e300, posinf=1e300)

    def slope(x):
        both = at(np.concatenate([x + size * np.eye(k), x - size * np.eye(k)]))
        return (both[:k] - both[k:]) / (2 * size)

    best = at(free[None])[0]
    if k:
        curve, g = np.eye(k) * 0.05, slope(free)
        for _ in range(steps):
            way = -curve @ g
            if way @ g >= 0:
                curve, way = np.eye(k) * 0.05, -0.05 * g
            way *= min(1.0, 2.0 / (np.abs(way).max() + 1e-300))
            tried = at(free + scales[:, None] * way)
            pick = int(np.argmin(tried))
            if tried[pick] > best - 1e-9:
                break
            s, gained, best = scales[pick] * way, best - tried[pick], tried[pick]
            if gained < gain:
                free = free + s
                break
            free = free + s
            new = slope(free)
            y, g = new - g, new
            if s @ y > 1e-12:
                rho, one = 1 / (s @ y), np.eye(k)
                curve = (one - rho * np.outer(s, y)) @ curve @ (one - rho * np.outer(y, s)) + rho * np.outer(s, s)
            if np.abs(g).max() < 1e-4:
                break
    return best + 2 * (k + z.shape[1] - 1 + 1), free


def search_orders(z: np.ndarray, season: int, max_order=(3, 3, 2, 2)):
    """Stepwise search: from four starts, the best order's neighbours until none is better.
    Returns (AIC, order, free numbers)."""
    n, tried = int(np.isfinite(z[:, 0]).sum()), {}

    def allowed(o):
        span = max(o[0] + season * o[2], o[1] + season * o[3])
        return all(0 <= a <= m for a, m in zip(o, max_order)) and n > 2 * (sum(o) + z.shape[1]) and (span == 0 or n > span + 4)

    def score(o):
        if o not in tried and allowed(o):
            tried[o] = fit_order(z, o, season, gain=0.01)  # finer than any choice needs
        return tried.get(o, (math.inf,))[0]

    for o in ((0, 0, 0, 0), (1, 0, 1, 0), (0, 1, 0, 1), (2, 2, 1, 1)):
        score(o)
    moves = [(1, 0, 0, 0), (0, 1, 0, 0), (0, 0, 1, 0), (0, 0, 0, 1), (1, 1, 0, 0), (0, 0, 1, 1), (1, -1, 0, 0), (0, 0, 1, -1)]
    if not tried:  # a few months: their mean
        tried[0, 0, 0, 0] = fit_order(z, (0, 0, 0, 0), season)
    best = min(tried, key=lambda o: tried[o][0])
    better = True
    while better:
        better = False
        for sign in (1, -1):
            for move in moves:
                near = tuple(a + sign * b for a, b in zip(best, move))
                if score(near) < tried[best][0] - 1e-6:
                    best, better = near, True
                    break
            if better:
                break
    aic, free = fit_order(z, best, season, start=tried[best][1])
    return aic, best, free


def weights_of_shocks(ar: np.ndarray, ma: np.ndarray, d: int, seasonal: int, season: int, steps: int) -> np.ndarray:
    """How much of a shock is left in the level after 0, 1, ... months."""
    poly = np.convolve(np.concatenate([[1.0], -ar]), _differences(d, seasonal, season))
    psi = np.zeros(steps)
    for h in range(steps):
        psi[h] = (1.0 if h == 0 else ma[h - 1] if h <= len(ma) else 0.0) - sum(poly[k] * psi[h - k] for k in range(1, min(h, len(poly) - 1) + 1))
    return psi


ARIMA_SCHEMA = (
    "series string, month date, forecast_demand_usd double, forecast_lower double, forecast_upper double, actual_demand_usd double, "
    "is_forecast boolean, arima_order string, aic double, model_type string"
)


def _filled(y: np.ndarray, season: int) -> np.ndarray:
    """Levels for integration: a missing month lies on the line between its neighbours."""
    seen = np.isfinite(y)
    return np.interp(np.arange(len(y)), np.flatnonzero(seen), y[seen])


def forecast_series(y: np.ndarray, exog: np.ndarray, horizon: int, season: int, max_order):
    """One series of log demand (NaN where unknown) with regressors over history and horizon.  Returns
    the mean and deviation by month (NaN before the differences begin), the order's name and AIC."""
    n = len(y)
    d, seasonal = differences_asked_for(y, season)
    lost = d + seasonal * season
    w = difference(y, d, seasonal, season)
    x = np.column_stack([difference(c, d, seasonal, season) for c in exog.T]) if exog.shape[1] else np.zeros((len(w) + horizon, 0))
    if d + seasonal < 2:
        x = np.column_stack([np.ones(len(x)), x])
    seen = np.isfinite(w)
    spread_of = x[: len(w)][seen].std(axis=0) if seen.any() else np.zeros(x.shape[1])
    x = x[:, (spread_of > 1e-9) | ((np.arange(x.shape[1]) == 0) & (d + seasonal < 2))]
    room = max(int(seen.sum()) // 4, 1)  # a short history carries few regressors
    x = x[:, :room]
    z = np.column_stack([w, x[: len(w)]])
    aic, order, free = search_orders(z, season, max_order)
    ar, ma = polynomials(free[None], order, season)
    _, beta, var = _concentrated(z, free[None], order, season)
    ahead = np.column_stack([np.full(horizon, np.nan), x[len(w) :]])
    # column 0 holds demand, unknown ahead; the regressors run through the same filter
    whole = np.concatenate([z, ahead])
    out, spread = kalman(whole, ar, ma)
    gone = np.nan_to_num(out[0, : len(w), 0] - out[0, : len(w), 1:] @ beta[0]) if len(w) else np.zeros(0)
    mean = np.full(n + horizon, np.nan)
    mean[lost:n] = np.where(seen, y[lost:] - gone, np.nan)
    level = list(_filled(y, season))
    errors = np.where(seen, w - x[: len(w)] @ beta[0], np.nan)
    paths = _predict(errors, ar[0], ma[0], horizon) + x[len(w) :] @ beta[0]
    poly = _differences(d, seasonal, season)
    for value in paths:  # undo the differences
        level.append(value - sum(poly[k] * level[-k] for k in range(1, len(poly)) if poly[k]))
    mean[n:] = level[n:]
    sd = np.concatenate([np.full(lost, np.nan), np.sqrt(var[0] * spread[0, : len(w)]), np.sqrt(var[0] * np.cumsum(weights_of_shocks(ar[0], ma[0], d, seasonal, season, horizon) ** 2))])
    p, q, sp, sq = order
    return mean, sd, f"({p},{d},{q})({sp},{seasonal},{sq}){season}", aic


def _predict(errors: np.ndarray, ar: np.ndarray, ma: np.ndarray, horizon: int) -> np.ndarray:
    """Means of the next months from the values and innovations so far; a gap holds its own prediction
    and no shock."""
    out, _ = kalman(errors[:, None], ar[None], ma[None])
    values, shocks = [], []
    for t in range(len(errors) + horizon):
        known = t < len(errors) and np.isfinite(errors[t])
        expected = sum(a * values[-k] for k, a in enumerate(ar, 1) if k <= t) + sum(m * shocks[-k] for k, m in enumerate(ma, 1) if k <= t)
        values.append(float(errors[t]) if known else expected)
        shocks.append(float(out[0, t, 0]) if known else 0.0)
    return np.array(values[len(errors) :])


def forecast_arima(df: DataFrame, *, series=None, y=VALUE, exog=(), season=12, max_order=(3, 3, 2, 2), horizon=12, level=0.95) -> DataFrame:
    """Seasonal ARIMA per series: differences by test, orders up to ``max_order`` (p, q, P, Q) by stepwise
    search, exact likelihood.  Months without demand are gaps that the filter passes over.  Every
    month of the history has a row, with a NULL forecast where the differences have not begun; fitted and
    the next ``horizon`` months carry an interval.  A series of a few months gets its mean."""
    exog = list(exog)
    rows = forecast_horizon(_spread(monthly_series(df, y, exog, series=series)), exog, periods=horizon, series="series")
    zq = _z(level)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("month").reset_index(drop=True)
        months = pd.to_datetime(pdf["month"])
        t = (months.dt.year * 12 + months.dt.month).to_numpy()
        t, past = t - t[0], ~pdf["is_forecast"].to_numpy(bool)
        n = t[past][-1] + 1
        target, e = np.full(n, np.nan), np.zeros((n + horizon, len(exog)))
        target[t[past]] = np.log1p(pdf["y"].to_numpy(float)[past])
        for j, name in enumerate(exog):
            known = pdf[name].notna().to_numpy()
            if known.any():
                e[:, j] = np.interp(np.arange(n + horizon), t[known], pdf[name].to_numpy(float)[known])
        mean, sd, name, aic = forecast_series(target, e, horizon, season, max_order)
        hat, spread = mean[t], sd[t]
        return pd.DataFrame({
            "series": pdf["series"], "month": pdf["month"], "forecast_demand_usd": np.expm1(hat),
            "forecast_lower": np.expm1(hat - zq * spread), "forecast_upper": np.expm1(hat + zq * spread),
            "actual_demand_usd": pdf["y"], "is_forecast": pdf["is_forecast"], "arima_order": name, "aic": aic, "model_type": "SARIMA",
        })

    return rows.groupBy("series").applyInPandas(fit, ARIMA_SCHEMA)
