"""Forecasts whose trend may bend: a piecewise-linear trend with few bends, seasons and regressors.

Candidate bends lie evenly over the first part of a series' history.  Bends carry an absolute
penalty, so most of them stay exactly zero; level, slope, seasons and regressors carry a light square one and
are solved out.  The future bends as often as the past did, by draws as large as the past's mean bend: their
spread and the residual's give the interval."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from procurelytics.operators.forecast import VALUE, _spread, _z, design_rows, forecast_horizon, monthly_series

#: Candidate bends, the share of the history they lie in, the scale of a bend (fixed values of the model).
BENDS, SHARE, SCALE = 25, 0.8, 0.05
#: Square penalty of level, slope, seasons and regressors: one over the square of their scale.
LIGHT = 0.01
#: Simulated futures of a series.
PATHS = 1000

CHANGES_SCHEMA = (
    "series string, month date, forecast_demand_usd double, forecast_lower double, forecast_upper double, trend double, "
    "actual_demand_usd double, is_forecast boolean, n_bends int, last_bend date, yearly_growth double, model_type string"
)


def few_bends(gram: np.ndarray, target: np.ndarray, penalty: float, start: np.ndarray) -> np.ndarray:
    """Coordinate descent for ``min 1/2 b'Gb - b't + penalty |b|``."""
    b = start.copy()
    rest = target - gram @ b
    for _ in range(2000):
        moved = 0.0
        for j in range(len(b)):
            if gram[j, j] < 1e-12:
                continue
            pull = rest[j] + gram[j, j] * b[j]
            new = np.sign(pull) * max(abs(pull) - penalty, 0.0) / gram[j, j]
            if new != b[j]:
                rest -= gram[:, j] * (new - b[j])
                moved, b[j] = max(moved, abs(new - b[j]) * np.sqrt(gram[j, j])), new
        if moved < 1e-7:
            break
    return b


class Bending:
    """The fit of one series: ``t`` is time over the history's length, ``x`` holds the other columns."""

    def __init__(self, t: np.ndarray, x: np.ndarray, y: np.ndarray, scale: float = SCALE):
        n = len(y)
        places = np.unique(np.floor(np.linspace(0, SHARE * (n - 1), BENDS + 1)[1:]).astype(int)) if n > 2 else np.zeros(0, int)
        self.at = t[places]
        self.low, self.range = y.min(), max(y.max() - y.min(), 1e-9)
        target, x = (y - self.low) / self.range, self._wide(t, x)
        bends = np.maximum(t[:, None] - self.at, 0.0)
        light = np.eye(x.shape[1]) * LIGHT
        light[0, 0] = 1e-9
        self.delta, var = np.zeros(len(self.at)), max(float(np.var(target)), 1e-9)
        for _ in range(12):  # bends and the residual's variance in turn
            solve = np.linalg.solve(x.T @ x + light * max(var, 1e-6), x.T)
            out = bends - x @ (solve @ bends)  # what level, seasons and regressors cannot say
            self.delta = few_bends(bends.T @ out, out.T @ target, var / scale, self.delta)
            self.beta = solve @ (target - bends @ self.delta)
            rest = target - bends @ self.delta - x @ self.beta
            new = max(float(rest @ rest) / max(n - x.shape[1] * 0.5 - np.count_nonzero(self.delta), 1), 1e-9)
            done, var = abs(new - var) < 1e-6 * var, new
            if done:
                break
        self.sd = np.sqrt(var)

    @staticmethod
    def _wide(t, x):
        return np.column_stack([np.ones(len(t)), t, x])

    def trend(self, t: np.ndarray) -> np.ndarray:
        return self.low + self.range * (self.beta[0] + self.beta[1] * t + np.maximum(t[:, None] - self.at, 0.0) @ self.delta)

    def predict(self, t: np.ndarray, x: np.ndarray) -> np.ndarray:
        return self.trend(t) + self.range * (x @ self.beta[2:])

    def growth(self) -> float:
        """Slope at the end of the history."""
        return self.range * (self.beta[1] + self.delta.sum())

    def spread(self, ahead: np.ndarray, seed: int) -> np.ndarray:
        """(paths, months): deviations from the forecast by new bends and noise."""
        rng, n = np.random.default_rng(seed), max(len(self.at), 1)
        size = float(np.abs(self.delta).mean()) if len(self.delta) else 0.0
        step = np.diff(np.r_[1.0, ahead])
        happens = rng.random((PATHS, len(ahead))) < np.minimum(step * n / SHARE, 1.0)
        slopes = np.cumsum(np.where(happens, rng.laplace(0.0, size + 1e-12, (PATHS, len(ahead))), 0.0), axis=1)
        return self.range * (np.cumsum(slopes * step, axis=1) + rng.normal(0.0, self.sd, (PATHS, len(ahead))))


def forecast_changepoints(df: DataFrame, *, series=None, y=VALUE, regressors=(), horizon=12, level=0.95, scale=SCALE, yearly=6,
                          quarterly=1, events=True) -> DataFrame:
    """Bending trend, yearly and quarterly season, calendar events and regressors per series on the log
    of demand; fitted months and the next ``horizon`` ones.  ``n_bends`` bends were kept, ``last_bend`` is the
    month of the last one, ``yearly_growth`` the slope after it.  Draws are seeded by the series' name, so a task
    that runs again gives the same interval."""
    rows = forecast_horizon(_spread(monthly_series(df, y, regressors, series=series)), list(regressors), periods=horizon, series="series")
    design = design_rows(rows, regressors, yearly=yearly, quarterly=quarterly, events=events)
    tail = (1 - level) / 2

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("month").reset_index(drop=True)
        months, known = pd.to_datetime(pdf["month"]), ~pdf["is_forecast"].to_numpy(bool)
        days = (months - months[0]).dt.days.to_numpy(float)
        length = max(days[known][-1], 1.0)
        t, x = days / length, np.stack(pdf["x"].to_numpy())[:, 2:]  # level and slope are the trend's
        x = x - x[known].mean(axis=0)
        x = x[:, np.abs(x[known]).max(axis=0, initial=0.0) > 1e-9]
        x = x / np.where(x[known].std(axis=0) > 0, x[known].std(axis=0), 1.0)
        model = Bending(t[known], x[known], np.log1p(pdf["y"].to_numpy(float)[known]), scale)
        hat = model.predict(t, x)
        high = np.full(len(t), _z(level) * model.range * model.sd)
        low = -high
        paths = model.spread(t[~known], zlib.crc32(str(pdf["series"].iloc[0]).encode()))
        low[~known], high[~known] = np.quantile(paths, [tail, 1 - tail], axis=0)
        bent = np.flatnonzero(np.abs(model.delta) > 1e-9)
        last = months[known].iloc[int(np.argmin(np.abs(t[known] - model.at[bent[-1]])))].date() if len(bent) else None
        return pd.DataFrame({
            "series": pdf["series"], "month": pdf["month"], "forecast_demand_usd": np.expm1(hat),
            "forecast_lower": np.expm1(hat + low), "forecast_upper": np.expm1(hat + high), "trend": np.expm1(model.trend(t)),
            "actual_demand_usd": pdf["y"], "is_forecast": pdf["is_forecast"], "n_bends": len(bent), "last_bend": last,
            "yearly_growth": model.growth() * 365.25 / length, "model_type": "CHANGEPOINTS",
        })

    return design.select("series", "month", "y", "x", "is_forecast").groupBy("series").applyInPandas(fit, CHANGES_SCHEMA)
