"""Approximate nearest neighbours by a forest of random-projection trees.

Trees split a bounded sample of the vectors by random hyperplanes at the median until parts are small; the forest is small
enough to go to every task. Every vector is filed in one leaf per tree. A query walks all trees at once with one
priority queue: the branch it missed by the least is taken next, in whichever tree it is, until enough leaves are
open. How many are enough is measured on the table itself: drawn queries are answered by brute force, one pass over the
vectors, and leaves are opened until the forest finds ``RECALL`` of these answers. A leaf that grows beyond a bound has a
forest of its own, built and measured likewise where the leaf is searched. All vectors of the open leaves are scored exactly.

Inner products are searched as angles: one more coordinate lifts every vector to the same length.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import col, map_batches, materialize

TREES = 16
# Leaves opened at least; more where the share of the neighbours that drawn queries find asks for it.
LEAVES_OPEN = 96
RECALL = 0.95
LEAF_RECALL = 0.99
DRAWN_QUERIES = 256
# Vectors that shape the trees, at most; vectors per leaf aimed at; sampled vectors a leaf needs at least.
SAMPLE = 65_536
LEAF = 512
LEAF_SAMPLE = 8
# A leaf with more vectors than this is searched by a forest of its own.
LEAF_LIMIT = 16_384
QUERY_MODULUS = 20


class Forest:
    """Trees over vectors; node i of a tree has the children 2 i + 1 and 2 i + 2."""

    def __init__(self, sample: np.ndarray, trees: int, depth: int, seed: int):
        draws = np.random.default_rng(seed)
        self.depth, self.trees = depth, trees
        inner = (1 << depth) - 1
        self.normals = np.zeros((trees, inner, sample.shape[1]), np.float32)
        self.offsets = np.zeros((trees, inner), np.float32)
        for t in range(trees):
            parts = {0: np.arange(len(sample))}
            for node in range(inner):
                rows = parts.pop(node)
                # The plane between two drawn vectors; a random one where they coincide.
                a, b = sample[draws.choice(rows, 2)] if len(rows) else (np.zeros(sample.shape[1]),) * 2
                normal = a - b
                if not normal.any():
                    normal = draws.standard_normal(sample.shape[1])
                normal = normal / np.linalg.norm(normal)
                at = sample[rows] @ normal
                middle = np.median(at) if len(rows) else 0.0
                self.normals[t, node], self.offsets[t, node] = normal, middle
                right = at > self.offsets[t, node]
                parts[2 * node + 1], parts[2 * node + 2] = rows[~right], rows[right]

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        out = np.zeros((len(vectors), self.trees), np.int64)
        for t in range(self.trees):
            node = np.zeros(len(vectors), np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", vectors, self.normals[t, node]) > self.offsets[t, node]
                node = 2 * node + 1 + side
            out[:, t] = node
        return out

    def missed(self, vector: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """For each row the margin by which ``vector`` misses its leaf, in the tree where that is least."""
        best_ = np.full(len(rows), np.inf)
        for t in range(self.trees):
            node, worst = np.zeros(len(rows), np.int64), np.zeros(len(rows))
            margins = self.normals[t] @ vector - self.offsets[t]
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", rows, self.normals[t, node]) > self.offsets[t, node]
                margin = margins[node]
                worst = np.where(side == (margin > 0), worst, np.maximum(worst, np.abs(margin)))
                node = 2 * node + 1 + side
            best_ = np.minimum(best_, worst)
        return best_

    def margins(self, vector: np.ndarray) -> np.ndarray:
        """The margins by which ``vector`` misses the leaves of all trees, in rising order."""
        out = []
        for t in range(self.trees):
            margins = self.normals[t] @ vector - self.offsets[t]
            worst = np.zeros(1)
            for level in range(self.depth):
                margin = margins[(1 << level) - 1 : (2 << level) - 1]
                other = np.maximum(worst, np.abs(margin))
                worst = np.column_stack([np.where(margin > 0, other, worst), np.where(margin > 0, worst, other)]).ravel()
            out.append(worst)
        return np.sort(np.concatenate(out))

    def enough(self, missed: list[tuple[np.ndarray, np.ndarray]], recall: float) -> int:
        """Leaves to open so that vectors find this share of their neighbours, given by the margins that miss them."""
        # Sums differ in the last places between one row and many, so leaves at about the margin are counted.
        ranks = [np.searchsorted(self.margins(v), at + 1e-5, "right") for v, at in missed if len(at)]
        if not ranks:
            return 0
        ranks = np.sort(np.concatenate(ranks))
        return int(ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))) - 1)])

    def search(self, vector: np.ndarray, count: int) -> list[tuple[int, int]]:
        """The ``count`` leaves (tree, leaf) that the shared queue opens first."""
        inner = (1 << self.depth) - 1
        queue = [(0.0, t, 0) for t in range(self.trees)]
        found: list[tuple[int, int]] = []
        while queue and len(found) < count:
            missed, t, node = heapq.heappop(queue)
            while node < inner:
                margin = float(vector @ self.normals[t, node] - self.offsets[t, node])
                side = margin > 0
                heapq.heappush(queue, (max(missed, abs(margin)), t, 2 * node + 1 + (not side)))
                node = 2 * node + 1 + side
            found.append((t, node))
        return found


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        limit = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= limit)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))][:k]


def products(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products in double precision; equal vectors get equal results wherever they stand."""
    return (rows * query).sum(axis=1)


def search_leaf(ids: np.ndarray, rows: np.ndarray, lifted: np.ndarray, queries: np.ndarray, lifted_queries: np.ndarray, k: int):
    """For each query the places of its ``k`` best rows of a leaf and their products."""
    inner, count = None, 0
    if len(rows) > LEAF_LIMIT:
        depth = int(np.ceil(np.log2(len(rows) / LEAF)))
        draws = np.random.default_rng(len(rows))
        inner = Forest(lifted[draws.choice(len(rows), min(len(rows), SAMPLE), replace=False)], TREES, depth, 5)
        filed = inner.leaves(lifted)
        order = [np.argsort(filed[:, t], kind="stable") for t in range(TREES)]
        sorted_ = [filed[o, t] for t, o in enumerate(order)]
        missed = []
        for i in draws.choice(len(queries), min(len(queries), DRAWN_QUERIES), replace=False):
            near = best(products(queries[i], rows), ids, k)
            missed.append((lifted_queries[i], inner.missed(lifted_queries[i], lifted[near])))
        count = max(LEAVES_OPEN, inner.enough(missed, LEAF_RECALL))
    for q, l in zip(queries, lifted_queries, strict=True):
        places = np.arange(len(rows))
        if inner:
            spans = [order[t][np.searchsorted(sorted_[t], n) : np.searchsorted(sorted_[t], n, "right")] for t, n in inner.search(l, count)]
            places = np.unique(np.concatenate(spans))
        scores = products(q, rows[places])
        top = best(scores, ids[places], k)
        yield places[top], scores[top]


def enough_leaves(points: DataFrame, asked: DataFrame, forest, lift, lift_queries, k: int) -> int:
    """Leaves to open so that ``DRAWN_QUERIES`` of the queries find ``RECALL`` of their ``k`` best points.

    Each task passes on the ``k`` best of its points for each drawn query, so the answers do not depend on the forest.
    """
    drawn = asked.orderBy(F.xxhash64("point", F.lit(4))).select("v").limit(DRAWN_QUERIES).toPandas()["v"]
    if not len(drawn):
        return LEAVES_OPEN
    queries = np.stack(drawn.to_numpy()).astype(float)
    lifted = lift_queries(queries)
    schema = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("score", T.DoubleType()), T.StructField("missed", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        kept: list = [(np.zeros(0), np.zeros((0, queries.shape[1])))] * len(queries)
        for batch in batches:
            rows = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, -1).astype(float)
            scores = queries @ rows.T
            for i, here in enumerate(scores):
                top = np.argpartition(-here, k - 1)[:k] if len(here) > k else np.arange(len(here))
                s, v = np.concatenate([kept[i][0], here[top]]), np.concatenate([kept[i][1], rows[top]])
                order = np.argsort(-s, kind="stable")[:k]
                kept[i] = s[order], v[order]
        for i, (s, v) in enumerate(kept):
            if len(s):
                at = forest.value.missed(lifted[i], lift(v))
                yield [pa.array(np.full(len(s), i, np.int32)), pa.array(s), pa.array(at)]

    order = Window.partitionBy("query").orderBy(F.desc("score"), "missed")
    found = map_batches(points.select("v"), run, schema).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
    at = found.select("query", "missed").toPandas()
    missed = [(lifted[i], part.to_numpy()) for i, part in at.groupby("query")["missed"]]
    return max(LEAVES_OPEN, forest.value.enough(missed, RECALL))


def nearest(
    vectors: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", modulus: int = QUERY_MODULUS,
    trees: int = TREES, leaves_open: int | None = None,
) -> DataFrame:
    """``query_id, rank, <id>, score``: the ``k`` rows with the largest inner product found for each query.

    Queries are the rows whose id is divisible by ``modulus``; candidates are all rows but the query's own.

    Leaves are opened as :func:`enough_leaves` measures it, unless their number is given.

    * Rows whose id is null, whose vector is null, empty, zero or holds a null or non-finite element, and rows whose
      vector has not the commonest length, take no part.
    * Equal vectors are searched once. Of each, the ``k + 1`` smallest ids can be results, as ties go to smaller ids.
    * An id that repeats is a row as often as it does. Fewer than ``k`` candidates give all of them. An empty table
      gives an empty result. Other columns are not read.
    """
    # Single precision is kept as it is to shuffle less; all sums are in double precision.
    single = isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType)
    number, element = ("float", T.FloatType()) if single else ("double", T.DoubleType())
    wide = F.transform(col(vector_col), lambda x: x.cast(number))
    rows = vectors.select(col(id_col).alias("id"), wide.alias("v")).filter(
        F.col("id").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    )
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0).cast(number)))  # no negative zero
    rows = materialize(rows, "ann-rows")
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, id long, score double"
    if common is None:
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    rows = rows.filter(F.size("v") == common.n)
    # The window keeps at most k + 1 rows per vector and task before the shuffle, so a hot vector is no hot task.
    first = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    kept = rows.withColumn("place", first).filter(F.col("place") <= k + 1)
    points = materialize(
        kept.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("point", F.monotonically_increasing_id()),
        "ann-points",
    )
    longest = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    count, norm = points.agg(F.count("*"), F.max(longest)).first()
    depth = int(max(0, np.ceil(np.log2(min(count / LEAF, SAMPLE / LEAF_SAMPLE)))))
    drawn = points.orderBy(F.xxhash64("point", F.lit(3))).select("v").limit(SAMPLE).toPandas()["v"]

    def lift(x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, norm * norm - (x * x).sum(axis=1)))
        return (np.column_stack([x, rest]) / norm).astype(np.float32)

    def lift_queries(x: np.ndarray) -> np.ndarray:
        return (np.column_stack([x, np.zeros(len(x))]) / np.sqrt((x * x).sum(axis=1))[:, None]).astype(np.float32)

    forest = vectors.sparkSession.sparkContext.broadcast(Forest(lift(np.stack(drawn.to_numpy()).astype(float)), trees, depth, 1))

    def matrix(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column("v").flatten().to_numpy().reshape(batch.num_rows, -1).astype(float)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            found = forest.value.leaves(lift(matrix(batch)))
            take = pa.array(np.repeat(np.arange(len(found)), trees))
            yield [pa.array(np.tile(np.arange(trees, dtype=np.int32), len(found))), pa.array(found.ravel()),
                   batch.column("point").take(take), batch.column("ids").take(take), batch.column("v").take(take)]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            found = [forest.value.search(v, leaves_open) for v in lift_queries(matrix(batch))]
            take = pa.array(np.repeat(np.arange(len(found)), [*map(len, found)]))
            flat = np.array([leaf for f in found for leaf in f], np.int64).reshape(-1, 2)
            yield [pa.array(flat[:, 0].astype(np.int32)), pa.array(flat[:, 1]), batch.column("point").take(take),
                   batch.column("ids").take(take), batch.column("v").take(take)]

    filed_as = T.StructType([
        T.StructField("tree", T.IntegerType()), T.StructField("leaf", T.LongType()), T.StructField("point", T.LongType()),
        T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("v", T.ArrayType(element)),
    ])
    points = points.select("point", F.col("ids").cast("array<long>").alias("ids"), "v")
    queries = rows.filter(F.col("id") % modulus == 0).select(F.col("id").cast("long").alias("query_id"), "v")
    asked = materialize(queries.select("v").distinct().join(points, "v").select("point", "ids", "v"), "ann-queries")
    if leaves_open is None:
        leaves_open = enough_leaves(points, asked, forest, lift, lift_queries, k + 1)
    filed = map_batches(points, file, filed_as)
    wanted = map_batches(asked, ask, filed_as)

    def scan(key, leaf: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        if not len(leaf) or not len(asks):
            return pd.DataFrame({c: pd.Series([], dtype=object) for c in ("point", "found", "ids", "score")})
        v, q = (np.stack(x.v.to_numpy()).astype(float) for x in (leaf, asks))
        numbers, ids = leaf.point.to_numpy(), leaf.ids.to_numpy()
        smallest = np.array([i[0] for i in ids])
        parts = []
        for point, (top, scores) in zip(asks.point, search_leaf(smallest, v, lift(v), q, lift_queries(q), k + 1), strict=True):
            parts.append(pd.DataFrame({"point": point, "found": numbers[top], "ids": ids[top], "score": scores}))
        return pd.concat(parts)

    found = (
        filed.groupBy("tree", "leaf").cogroup(wanted.groupBy("tree", "leaf"))
        .applyInPandas(scan, "point long, found long, ids array<long>, score double")
        .dropDuplicates(["point", "found"])
    )
    # k + 1 results per distinct query vector, one of which may be the query's own row.
    order = Window.partitionBy("point").orderBy(F.desc("score"), "id")
    top = found.select("point", F.explode("ids").alias("id"), "score").withColumn("place", F.row_number().over(order))
    top = materialize(top.filter(F.col("place") <= k + 1).select("point", "id", "score", "place"), "ann-found")
    of = materialize(queries.join(asked.select("point", "v"), "v").select("query_id", "point"), "ann-asked")
    own = top.select(F.col("point").alias("p"), F.col("id").alias("own"), F.col("place").alias("own_place"))
    # A query's own place, if it is among the results: what comes after it moves up.
    placed = of.join(own, (F.col("point") == F.col("p")) & (F.col("query_id") == F.col("own")), "left")
    placed = placed.groupBy("query_id", "point").agg(F.min("own_place").alias("own_place"))
    result = placed.join(top, "point").filter(F.col("own_place").isNull() | (F.col("place") != F.col("own_place")))
    rank = F.col("place") - F.when(F.col("place") > F.col("own_place"), 1).otherwise(0)
    result = result.select("query_id", rank.cast("int").alias("rank"), F.col("id").alias(id_col), "score")
    return result.filter(F.col("rank") <= k)
