"""A fitted forest as flat node arrays: one walk per row, and exact Shapley values.

The arrays are as large as the model, at most trees x 2^(depth + 1) nodes, whatever the data; they travel with the
task like the learner's own model does."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from procurelytics.session import delete_folder, scratch_path

#: Cells (rows x leaves x path features) that are held at once.
CELLS = 2_000_000


@dataclass
class Forest:
    """Per tree and node: feature (-1 in a leaf), threshold, children, value and number of training rows."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    depth: int

    def votes(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): what each tree predicts."""
        trees, rows = np.arange(len(self.feature)), np.arange(len(x))[:, None]
        at = np.zeros((len(x), len(trees)), np.int32)
        for _ in range(self.depth):
            feature = self.feature[trees, at]
            goes_left = x[rows, np.maximum(feature, 0)] <= self.threshold[trees, at]
            at = np.where(feature < 0, at, np.where(goes_left, self.left[trees, at], self.right[trees, at]))
        return self.value[trees, at]

    def paths(self) -> list[dict]:
        """Leaves grouped by the number of features on their way: per leaf the features, the interval
        that each must lie in, and the share of training rows that meet it; base is the mean forecast."""
        groups: dict = {}
        for t in range(len(self.feature)):
            stack = [(0, {})]
            while stack:
                node, met = stack.pop()
                j = int(self.feature[t, node])
                if j < 0:
                    groups.setdefault(len(met), []).append((float(self.value[t, node]), met))
                    continue
                low, high, share = met.get(j, (-np.inf, np.inf, 1.0))
                for child, bounds in ((self.left[t, node], (low, min(high, self.threshold[t, node]))), (self.right[t, node], (max(low, self.threshold[t, node]), high))):
                    part = self.cover[t, child] / self.cover[t, node]
                    stack.append((int(child), met | {j: (*bounds, share * part)}))
        out = []
        for d, leaves in sorted(groups.items()):
            if d:
                cells = np.array([[m for m in met.values()] for _, met in leaves])
                out.append({"feature": np.array([list(met) for _, met in leaves]), "low": cells[:, :, 0], "high": cells[:, :, 1],
                            "share": cells[:, :, 2], "value": np.array([v for v, _ in leaves])})
        return out

    def base(self) -> float:
        """The mean forecast over the training rows of each tree."""
        weight = np.where(self.feature < 0, self.cover, 0.0)
        return float(((weight * self.value).sum(axis=1) / weight.sum(axis=1)).mean())

    def shapley(self, x: np.ndarray, paths=None) -> np.ndarray:
        """(rows, features): exact Shapley values of the forest's path-dependent game.

        A leaf's game is a product over the features on its way, so the mean over all orders of joining is
        the integral over t of products of (1 - t) * share + t * met: a polynomial of degree d - 1, which
        d / 2 Gauss points integrate exactly.  That is linear in the leaves and quadratic in the path."""
        out = np.zeros(x.shape)
        for group in self.paths() if paths is None else paths:
            d = group["feature"].shape[1]
            points, weights = np.polynomial.legendre.leggauss((d + 1) // 2)
            step = max(1, CELLS // (d * max(len(x), 1)))
            for a in range(0, len(group["value"]), step):
                feature, share = group["feature"][a : a + step], group["share"][a : a + step]
                values = x[:, feature]
                met = ~((values <= group["low"][a : a + step]) | (values > group["high"][a : a + step])) & ~np.isnan(values)
                met |= np.isnan(values) & np.isposinf(group["high"][a : a + step])  # NaN goes right everywhere
                total = np.zeros(met.shape)
                for t, w in zip((points + 1) / 2, weights / 2):
                    factor = share * (1 - t) + np.where(met, t, 0.0)
                    total += w * factor.prod(axis=2, keepdims=True) / factor
                total *= (met - share) * group["value"][a : a + step][:, None]
                place = np.zeros((feature.size, x.shape[1]))
                place[np.arange(feature.size), feature.ravel()] = 1.0
                out += total.reshape(len(x), -1) @ place
        return out / len(self.feature)


def flatten(spark, model: RandomForestRegressionModel) -> Forest:
    """The nodes of a fitted model, which Spark writes as a table: the model is saved to the shared folder,
    its nodes are read, the folder is deleted."""
    path = scratch_path(spark, "forest")
    model.write().save(path)
    node = F.col("nodeData")
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("id"), node["prediction"].alias("value"), node["impurityStats"][0].alias("cover"),
        node["leftChild"].alias("left"), node["rightChild"].alias("right"), node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
    ).toArrow().to_pandas()
    delete_folder(spark, path)
    shape = (int(nodes["tree"].max()) + 1, int(nodes["id"].max()) + 1)

    def filled(column, kind, otherwise=0):
        out = np.full(shape, otherwise, kind)
        out[nodes["tree"], nodes["id"]] = nodes[column].fillna(0)
        return out

    forest = Forest(filled("feature", np.int32, -1), filled("threshold", float), filled("left", np.int32), filled("right", np.int32), filled("value", float), filled("cover", float), 0)
    level, depth = [(t, 0) for t in range(shape[0])], 0
    while level := [(t, int(c[t, n])) for t, n in level if forest.feature[t, n] >= 0 for c in (forest.left, forest.right)]:
        depth += 1
    forest.depth = depth
    return forest


def feature_array(names) -> Column:
    return F.array(*[F.col(n).cast("double") for n in names])


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array([np.asarray(v, float) for v in column])


def with_intervals(df: DataFrame, forest: Forest, names, *, level=0.95) -> DataFrame:
    """The mean forecast with the lower and upper percentile of the single trees' votes."""
    tail = (1 - level) / 2 * 100

    @F.pandas_udf("forecast_demand_usd double, forecast_lower double, forecast_upper double")
    def judged(x: pd.Series) -> pd.DataFrame:
        votes = forest.votes(_matrix(x)) if len(x) else np.zeros((0, 1))
        low, high = np.percentile(votes, [tail, 100 - tail], axis=1) if len(x) else (np.zeros(0), np.zeros(0))
        return pd.DataFrame({"forecast_demand_usd": votes.mean(axis=1), "forecast_lower": low, "forecast_upper": high})

    return df.withColumn("_votes", judged(feature_array(names))).select(*df.columns, "_votes.*")


def shap_values(df: DataFrame, forest: Forest, names) -> DataFrame:
    """Adds ``base_value`` and ``shap``, one value per feature in the order of ``names``: how far each feature moves
    the row's forecast from the base.  Base and values add up to the forecast."""
    paths = forest.paths()

    @F.pandas_udf("array<double>")
    def explained(x: pd.Series) -> pd.Series:
        return pd.Series(list(forest.shapley(_matrix(x), paths))) if len(x) else pd.Series([], dtype=object)

    return df.withColumns({"base_value": F.lit(forest.base()), "shap": explained(feature_array(names))})


def shap_importance(explained: DataFrame, names) -> DataFrame:
    """Mean absolute Shapley value per feature over all rows."""
    named = F.explode(F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), F.col("shap").alias("value")))
    rows = explained.select(named.alias("f")).select("f.feature", F.abs("f.value").alias("value"))
    return rows.groupBy("feature").agg(F.avg("value").alias("shap_importance"))
