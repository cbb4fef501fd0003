"""Exact top-k by inner product with a Voronoi join.

Inner products become distances by one more component: with M the largest length of any vector,
(x, sqrt(M^2 - |x|^2)) lies at squared distance |q|^2 + M^2 - 2 q.x from (q, 0), so the nearest are
those with the highest product.  Data and queries are grouped by their nearest pivot.  Summaries of
the data cells (the k + 1 smallest distances to the pivot) bound each query cell's k-th distance from
above; the triangle inequality then tells for each vector which query cells can need it, and only to
those it is sent.  Cells are solved in blocks, so a full cell is many small tasks."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from procurelytics.llm.common import bounded_batches
from procurelytics.session import cut_lineage

#: Pivots, and rows of one block of data and of queries.
PIVOTS, DATA_BLOCK, QUERY_BLOCK = 16, 16_384, 1024
#: Relative slack for the rounding of distances: a bound may only err towards sending more.
SLACK = 1e-9


def scaled_vectors(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component as doubles.  Vectors that are NULL, empty, or
    hold NULL or non-finite components, and rows without id, take no part.  Of rows that repeat an id
    the one with the least vector counts."""
    v = F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(x * scale).cast("double"))
    fine = F.col(key).isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x.cast("double")))
    return df.where(fine).select(F.col(key).cast("long").alias("vec_id"), v.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(column) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _distances(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """From each augmented row to each pivot."""
    full = np.hstack([x, extra[:, None]])
    square = (full**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * full @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def _scores(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Integer products: by doubles where those are exact, else by whole numbers of any size."""
    largest = max(1.0, float(np.abs(queries).max(initial=0))) * max(1.0, float(np.abs(data).max(initial=0))) * queries.shape[1]
    if largest < 2**53:
        return (queries @ data.T).astype(np.int64)
    whole = np.array([[int(x) for x in r] for r in queries], object) @ np.array([[int(x) for x in r] for r in data], object).T
    return np.clip(whole, -(2**63), 2**63 - 1).astype(np.int64)


def _best(query_ids, ids, scores, k):
    """Up to k rows (query, vector, score) per query: highest score, then smaller id."""
    order = np.argsort(ids, kind="stable")
    ids, scores = ids[order], scores[:, order]
    out = []
    for i, q in enumerate(query_ids):
        row = scores[i]
        other = np.flatnonzero(ids != q)
        if len(other) > 4 * k:
            floor = np.partition(row[other], len(other) - k)[len(other) - k]
            other = other[row[other] >= floor]
        top = other[np.argsort(-row[other], kind="stable")][:k]
        out += [(int(q), int(ids[j]), int(row[j])) for j in top]
    return out


def top_products(vectors: DataFrame, is_query, k: int = 5, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``vectors`` (vec_id, v) where ``is_query``
    holds, the k other rows with the highest inner product, ties to the smaller vec_id; all of them
    where there are fewer.  Vectors of another length than the most common one (the shorter of two
    equally common) take no part.  An empty table gives no rows.

    What the driver holds is bounded: the pivots, and k + 3 numbers per pivot."""
    spark = vectors.sparkSession
    bounded_batches(spark, 10_000)
    result = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("rank", T.IntegerType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.LongType())])
    sized = cut_lineage(vectors.withColumn("d", F.size("v")).withColumn("q", is_query))
    common = sized.groupBy("d").agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("m")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not common:
        return spark.createDataFrame([], result)
    size, m = common[0]["d"], common[0]["m"]
    data = sized.where(F.col("d") == size)
    chosen = data.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).select("v").collect()
    centres = np.unique(np.array([r["v"] for r in chosen], np.float64), axis=0)
    # pivots lie among the augmented data
    centres = np.hstack([centres, np.sqrt(np.maximum(m - (centres**2).sum(1), 0))[:, None]])
    cells = len(centres)

    def summarise(batches):
        """Per cell: the k + 1 smallest distances of data, and the largest of queries."""
        near, far, asked = [np.empty(0)] * cells, np.full(cells, -1.0), np.zeros(cells, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, q = _matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            to = _distances(x, np.sqrt(np.maximum(m - (x**2).sum(1), 0)), centres)
            cell = to.argmin(1)
            for c in np.unique(cell):
                near[c] = np.sort(np.concatenate([near[c], to[cell == c, c]]))[: k + 1]
            to = _distances(x[q], np.zeros(q.sum()), centres)
            np.maximum.at(far, to.argmin(1), to.min(1))
            np.add.at(asked, to.argmin(1), 1)
        yield pa.RecordBatch.from_pydict({"cell": list(range(cells)), "near": [list(map(float, n)) for n in near], "far": far.tolist(), "asked": asked.tolist()})

    parts = data.select("v", "q").mapInArrow(summarise, "cell long, near array<double>, far double, asked long")
    summary = parts.groupBy("cell").agg(
        F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, k + 1).alias("near"), F.max("far").alias("far"), F.sum("asked").alias("asked")).orderBy("cell").collect()
    near, radius = {r["cell"]: r["near"] for r in summary}, np.array([r["far"] for r in summary])
    parts = [math.ceil(r["asked"] / QUERY_BLOCK) for r in summary]
    between = _distances(centres[:, :-1], centres[:, -1], centres)
    # the k-th nearest other vector of any query of a cell is no farther than this; one more for the query itself
    reach = np.full(cells, math.inf)
    for c in np.flatnonzero(radius >= 0):
        bounds = np.sort(np.concatenate([radius[c] + between[c, j] + np.array(d) for j, d in near.items()]))
        if len(bounds) > k:
            reach[c] = bounds[k]
    used = np.flatnonzero(radius >= 0)
    slack = SLACK * (1 + math.sqrt(m) + float(between.max()) + float(radius.max()))
    data_blocks = math.ceil(common[0]["n"] / DATA_BLOCK)

    def needed(batches):
        """Each vector once per query cell that can need it, with its block."""
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, x = batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1))
            to = _distances(x, np.sqrt(np.maximum(m - (x**2).sum(1), 0)), centres)
            for c in used:
                # no query of the cell lies nearer than this
                at = np.flatnonzero(to[:, c] - radius[c] <= reach[c] + slack)
                for part in range(parts[c]) if len(at) else ():
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(at), c, np.int32)), pa.array(np.full(len(at), part, np.int32)), pa.array((ids[at] % data_blocks).astype(np.int32)),
                        pa.array(ids[at]), pa.array([r.tobytes() for r in x[at]], pa.binary())], names=["cell", "part", "block", "vec_id", "v"])

    def placed(batches):
        """Each query with its cell and block, once per block of data."""
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, x = batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1))
            cell = _distances(x, np.zeros(len(x)), centres).argmin(1).astype(np.int32)
            part = (pd.util.hash_array(ids) % np.array([max(p, 1) for p in parts], np.uint64)[cell]).astype(np.int32)
            for b in range(data_blocks):
                yield pa.RecordBatch.from_arrays([
                    pa.array(cell), pa.array(part), pa.array(np.full(len(x), b, np.int32)), pa.array(ids), pa.array([r.tobytes() for r in x], pa.binary())],
                    names=["cell", "part", "block", "vec_id", "v"])

    def solve(queries: pa.Table, block: pa.Table) -> pa.Table:
        rows = []
        if queries.num_rows and block.num_rows:
            ids = block.column("vec_id").to_numpy()
            x = np.frombuffer(b"".join(block.column("v").to_pylist()), np.float64).reshape(len(ids), -1)
            asked = queries.column("vec_id").to_numpy()
            for start in range(0, len(asked), 256):
                part = queries.slice(start, 256)
                q = np.frombuffer(b"".join(part.column("v").to_pylist()), np.float64).reshape(part.num_rows, -1)
                rows += _best(asked[start : start + 256], ids, _scores(q, x), k)
        query, vec, score = zip(*rows) if rows else ((), (), ())
        return pa.table([pa.array(query, pa.int64()), pa.array(vec, pa.int64()), pa.array(score, pa.int64())], names=["query_id", "vec_id", "score"])

    sent = data.select("vec_id", "v").mapInArrow(needed, "cell int, part int, block int, vec_id long, v binary")
    asked = data.where("q").select("vec_id", "v").mapInArrow(placed, "cell int, part int, block int, vec_id long, v binary")
    local = asked.groupBy("cell", "part", "block").cogroup(sent.groupBy("cell", "part", "block")).applyInArrow(solve, "query_id long, vec_id long, score long")
    from pyspark.sql import Window

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search_rows(embeddings: DataFrame) -> DataFrame:
    """The five best of every row whose vec_id is divisible by 50."""
    return top_products(scaled_vectors(embeddings, "vec_id", "embedding", 256), F.col("vec_id") % 50 == 0)


SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, e.vec_id, s AS score, row_number() OVER (PARTITION BY q.vec_id ORDER BY s DESC, e.vec_id) AS rank
  FROM (SELECT * FROM e WHERE vec_id % 50 = 0) q, e, LATERAL (SELECT CAST(list_dot_product(q.v, e.v) AS BIGINT) AS s) WHERE q.vec_id <> e.vec_id)
WHERE rank <= 5
"""
