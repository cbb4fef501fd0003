"""Flat trees against the learner's own predictions; Shapley values against enumeration."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest

from procurelytics.operators import forest, trees
from test_forecast import SCHEMA, planted


@pytest.fixture(scope="module")
def fitted(spark):
    rows = spark.createDataFrame(pd.concat([planted("a"), planted("b", seed=1, noise=0.1)]), SCHEMA)
    data, names = forest.prepare(rows, series="series")
    model = forest.fit_rf(data.where("split = 'TRAIN'"), names, trees=12, depth=5)
    return data, names, model, trees.flatten(spark, model)


def test_votes_equal_the_model(fitted):
    data, names, model, flat = fitted
    pdf = data.toPandas()
    votes = flat.votes(pdf[names].to_numpy(float))
    want = forest.rf_predict(model, data, names).toPandas()
    key = ["series", "month"]
    joined = pdf[key].assign(mine=votes.mean(axis=1)).merge(want[[*key, "forecast_demand_usd"]], on=key)
    np.testing.assert_allclose(joined["mine"], joined["forecast_demand_usd"], rtol=1e-12)
    single = model.trees[3].setFeaturesCol(forest.VECTOR).setPredictionCol("prediction").transform(forest.assemble(data, names)).select(*key, "prediction").toPandas()
    joined = pdf[key].assign(mine=votes[:, 3]).merge(single, on=key)
    assert (joined["mine"] == joined["prediction"]).all()


def given(forest_, t, x, known, node=0):
    """What a tree predicts when only the features of ``known`` are known: others go both ways by cover."""
    j = forest_.feature[t, node]
    if j < 0:
        return forest_.value[t, node]
    left, right = forest_.left[t, node], forest_.right[t, node]
    if j in known:
        return given(forest_, t, x, known, left if x[j] <= forest_.threshold[t, node] else right)
    return (given(forest_, t, x, known, left) * forest_.cover[t, left] + given(forest_, t, x, known, right) * forest_.cover[t, right]) / forest_.cover[t, node]


def enumerated(forest_, x):
    m, out = len(x), np.zeros(len(x))
    worth = {s: np.mean([given(forest_, t, x, s) for t in range(len(forest_.feature))]) for n in range(m + 1) for s in map(frozenset, itertools.combinations(range(m), n))}
    for s, v in worth.items():
        for j in set(range(m)) - s:
            out[j] += math.factorial(len(s)) * math.factorial(m - len(s) - 1) / math.factorial(m) * (worth[s | {j}] - v)
    return out


def grown(rng, features, depth, size=64):
    """A random forest of three trees in flat form."""
    parts = {k: np.full((3, size), -1 if k == "feature" else 0, float if k in ("threshold", "value", "cover") else np.int32) for k in ("feature", "threshold", "left", "right", "value", "cover")}
    for t in range(3):
        free, stack = 1, [(0, 0, 200.0)]
        while stack:
            node, level, cover = stack.pop()
            parts["cover"][t, node], parts["value"][t, node] = cover, rng.normal()
            if level < depth and rng.random() < 0.9:
                share = rng.uniform(0.1, 0.9)
                parts["feature"][t, node], parts["threshold"][t, node] = rng.integers(features), rng.normal()
                parts["left"][t, node], parts["right"][t, node] = free, free + 1
                stack += [(free, level + 1, cover * share), (free + 1, level + 1, cover * (1 - share))]
                free += 2
    return trees.Forest(**parts, depth=depth)


def test_shapley_values_equal_enumeration(monkeypatch):
    rng = np.random.default_rng(4)
    for cells in (trees.CELLS, 50):
        monkeypatch.setattr(trees, "CELLS", cells)
        for depth in (0, 1, 3, 5):
            f = grown(rng, 5, depth)
            x = rng.normal(size=(6, 5))
            got = f.shapley(x)
            for row, mine in zip(x, got):
                np.testing.assert_allclose(mine, enumerated(f, row), atol=1e-10)
            np.testing.assert_allclose(f.base() + got.sum(axis=1), f.votes(x).mean(axis=1), atol=1e-10)


def test_values_and_base_add_up_on_the_model(fitted):
    data, names, model, _ = fitted
    rows = forest.rf_shap(model, data.where("split = 'TEST'"), names)
    out = rows.toPandas()
    np.testing.assert_allclose(out["base_value"] + out["shap"].map(sum), out["forecast_demand_usd"], rtol=1e-9)
    mean = trees.shap_importance(rows, names).toPandas().set_index("feature")["shap_importance"]
    want = np.abs(np.array(out["shap"].tolist())).mean(axis=0)
    np.testing.assert_allclose(mean[list(names)], want, rtol=1e-9)
    assert mean.idxmax() in set(names) and mean.max() > 0


def test_empty_rows(fitted):
    data, names, model, _ = fitted
    none = data.where("month < '1900-01-01'")
    assert forest.rf_shap(model, none, names).count() == 0 and forest.rf_intervals(model, none, names).count() == 0
