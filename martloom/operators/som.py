"""Self-organizing map: batch training, assignment, map errors and map views."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions import vectors
from martloom.session import materialize

# The map the segmentation uses.
ROWS, COLUMNS, SEED = 80, 40, 42
EPOCHS = 20
# The neighbourhood at the end of training: a unit and a little of those next to it.
SIGMA_END = 0.5
# Sums this small have lost digits; a unit so far from all rows stays where it is.
TOO_SMALL = 1e-200

# The weights travel to every task; larger maps than this are refused.
MAX_WEIGHT_BYTES = 64 << 20


def _check_size(units: int, width: int) -> None:
    if units * width * 8 > MAX_WEIGHT_BYTES:
        raise ValueError(f"a map of {units} units x {width} features exceeds {MAX_WEIGHT_BYTES} bytes")


def _as_doubles(cols: Sequence[str]):
    return [F.expr(f"CAST(`{c}` AS DOUBLE) AS `{c}`") for c in cols]


def initial_weights(df: DataFrame, cols: Sequence[str], id_col: str, units: int, seed: int) -> np.ndarray:
    """One data row per unit, the first in a seeded hash order of the id; repeated if rows are few.

    Rows whose hash lies above a generous threshold are left out before the sort, so on a large
    table each task sorts a handful of rows. If too few remain, the whole table is sorted.
    """
    total = df.count()
    if total == 0:
        raise ValueError("cannot fit a map to an empty table")
    wanted = min(units, total)
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
    hashed = df.select(order.alias("_order"), *_as_doubles(cols))
    threshold = min(1.0, 4.0 * wanted / total)
    sparse = hashed.filter(F.col("_order") <= f"{int(threshold * 0xFFFFFFFF):08x}" + "f" * 24)
    for candidates in (sparse, hashed):
        rows = candidates.orderBy("_order", *cols).limit(wanted).drop("_order").collect()
        if len(rows) == wanted:
            break
    return np.array([rows[u % wanted] for u in range(units)], dtype=float)


def covariance(df: DataFrame, cols: Sequence[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of rows, means and covariance (divisor n). One pass; tasks send whole numbers, so the result is the same
    for any partitioning."""
    width = len(cols) + 1

    def partials(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width), dtype=object)
        for batch in batches:
            for x in vectors.blocks(batch.to_numpy(dtype=float)):
                total = total + vectors.exact_products(x)
        a, b = np.indices(total.shape)
        yield pd.DataFrame({"a": a.ravel(), "b": b.ravel(), "p": [Decimal(int(v)) for v in total.ravel()]})

    parts = df.select(*_as_doubles(cols)).mapInPandas(partials, "a int, b int, p decimal(38,0)")
    summed = parts.groupBy("a", "b").agg(F.sum("p").alias("p")).collect()
    products = {(r["a"], r["b"]): int(r["p"]) for r in summed}
    one = 1 << vectors.PRODUCT_UNIT_BITS
    n = products.get((0, 0), 0) // one**2
    if n == 0:
        raise ValueError("cannot fit a map to an empty table")
    sums = [products[0, d] for d in range(1, width)]  # in units of one squared
    means = np.array([float(Fraction(s, n * one**2)) for s in sums])
    spread = [
        [float(Fraction(products[a + 1, b + 1], n * one**2) - Fraction(sums[a] * sums[b], n * n * one**4)) for b in range(width - 1)]
        for a in range(width - 1)
    ]
    return n, means, np.array(spread)


def plane_weights(df: DataFrame, cols: Sequence[str], m: int, n: int) -> np.ndarray:
    """Units on the plane through the mean along the two widest directions, a deviation to each side of it.

    The longer side of the grid lies along the widest direction, so neighbours on the grid are neighbours in the data from
    the first epoch on.
    """
    _, mean, spread = covariance(df, cols)
    values, axes = np.linalg.eigh(spread)
    # An axis has two directions; its largest entry is to be positive.
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(mean))])
    steps = axes * np.sqrt(np.maximum(values, 0.0))
    first = steps[:, -1]
    second = steps[:, -2] if len(mean) > 1 else np.zeros(len(mean))
    if n > m:
        first, second = second, first
    down, across = (np.linspace(-1.0, 1.0, size) if size > 1 else np.zeros(1) for size in (m, n))
    plane = mean + down[:, None, None] * first + across[None, :, None] * second
    return plane.reshape(m * n, len(mean))


def _epoch_sums(data: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and number of the rows nearest to each unit: one pass, at most one row per task and unit."""
    units, width = weights.shape
    shared = data.sparkSession.sparkContext.broadcast(weights)
    sum_cols = [f"s{d}" for d in range(width)]

    def partials(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = shared.value
        sums, counts = np.zeros((units, width), dtype=np.int64), np.zeros(units, dtype=np.int64)
        blocks = 0

        def added() -> pd.DataFrame:
            hit = np.flatnonzero(counts)
            out = pd.DataFrame(sums[hit], columns=sum_cols)
            out.insert(0, "n", counts[hit])
            out.insert(0, "unit", hit)
            return out

        for batch in batches:
            for x in vectors.blocks(batch.to_numpy(dtype=float)):
                vectors.add_to_units(sums, counts, x, vectors.nearest(x, w)[0])
                blocks += 1
                if blocks == vectors.BLOCKS_PER_SUM:  # before a sum can overflow
                    yield added()
                    sums[:], counts[:], blocks = 0, 0, 0
        yield added()

    schema = "unit long, n long, " + ", ".join(f"{c} long" for c in sum_cols)
    merged = (
        data.mapInPandas(partials, schema)
        .groupBy("unit")
        .agg(F.sum("n").alias("n"), *[F.expr(f"sum(CAST({c} AS DECIMAL(38,0))) AS {c}") for c in sum_cols])
        .collect()
    )
    sums, counts = np.zeros((units, width)), np.zeros(units)
    for row in merged:
        counts[row["unit"]] = row["n"]
        sums[row["unit"]] = [float(row[c]) / vectors.UNIT for c in sum_cols]
    shared.destroy()
    return sums, counts


def _kernel(length: int, radius: float) -> np.ndarray:
    at = np.arange(length)
    return np.exp(-((at[:, None] - at[None, :]) ** 2) / (2.0 * radius * radius))


def _smooth(grid: np.ndarray, radius: float) -> np.ndarray:
    """Gaussian neighbourhood sums over the first two axes; the kernel factors into rows and columns."""
    down, across = _kernel(grid.shape[0], radius), _kernel(grid.shape[1], radius)
    return np.einsum("jb,ib...->ij...", across, np.einsum("ia,ab...->ib...", down, grid))


def radii(epochs: int, first: float, last: float) -> list[float]:
    """The neighbourhood's radius in each epoch: it shrinks by the same factor from one to the next."""
    return [first * (last / first) ** (epoch / max(epochs - 1, 1)) for epoch in range(epochs)]


def som_fit(
    df: DataFrame,
    cols: Sequence[str],
    id_col: str,
    m: int = ROWS,
    n: int = COLUMNS,
    sigma: float | None = None,
    sigma_end: float = SIGMA_END,
    epochs: int = EPOCHS,
    seed: int = SEED,
    start: str = "plane",
) -> DataFrame:
    """Train a map by the batch rule and return its units ``(i, j, w)``.

    Each epoch is one scan that sends a sum per unit, then a neighbourhood-weighted mean over the units. The radius shrinks
    from ``sigma`` (half the longer side of the grid unless given) to ``sigma_end``: first the whole map follows the data, at
    last each unit its own rows. The map starts as a plane through the data (``plane_weights``) or, with ``start="rows"``, at
    rows drawn by ``seed``. All sums are exact integers, so the map is the same on any number of executors.
    """
    _check_size(m * n, len(cols))
    if start not in ("plane", "rows"):
        raise ValueError(start)
    data = materialize(df.select(id_col, *_as_doubles(cols)), "som-input")
    weights = plane_weights(data, cols, m, n) if start == "plane" else initial_weights(data, cols, id_col, m * n, seed)
    rows = data.select(*cols)
    for radius in radii(epochs, max(m, n) / 2 if sigma is None else sigma, sigma_end):
        sums, counts = _epoch_sums(rows, weights)
        top = _smooth(sums.reshape(m, n, -1), radius).reshape(m * n, -1)
        bottom = _smooth(counts.reshape(m, n), radius).reshape(m * n)
        moved = bottom > TOO_SMALL
        weights[moved] = top[moved] / bottom[moved, None]
    return df.sparkSession.createDataFrame(
        [(u // n, u % n, w.tolist()) for u, w in enumerate(weights)], "i int, j int, w array<double>"
    )


def som_assign(df: DataFrame, cols: Sequence[str], id_col: str, neurons: DataFrame) -> DataFrame:
    """Best and second best unit of each row; the first in row-major order on a tie."""
    _check_size(neurons.count(), len(cols))
    units = neurons.orderBy("i", "j").collect()
    if len(units) < 2:
        raise ValueError("a map needs two units at least")
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(
        (np.array([(u["i"], u["j"]) for u in units]), np.array([u["w"] for u in units], dtype=float))
    )

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, w = shared.value
        for batch in batches:
            ids, values = batch[id_col].to_numpy(), batch[list(cols)].to_numpy(dtype=float)
            for start in range(0, len(values), vectors.ROWS_PER_BLOCK):
                x = values[start : start + vectors.ROWS_PER_BLOCK]
                best, second = vectors.nearest(x, w, second=True)
                gap = x - w[best]
                yield pd.DataFrame(
                    {
                        id_col: ids[start : start + len(x)],
                        "i": place[best, 0],
                        "j": place[best, 1],
                        "dist": np.sqrt((gap * gap).sum(axis=1)),
                        "i2": place[second, 0],
                        "j2": place[second, 1],
                    }
                )

    schema = T.StructType(
        [T.StructField(id_col, df.schema[id_col].dataType)]
        + [T.StructField(c, T.IntegerType()) for c in ("i", "j")]
        + [T.StructField("dist", T.DoubleType())]
        + [T.StructField(c, T.IntegerType()) for c in ("i2", "j2")]
    )
    return df.select(id_col, *_as_doubles(cols)).mapInPandas(assign, schema)


def touching() -> Column:
    """Whether a row's two best units are next to each other, corners included."""
    return F.greatest(F.abs(F.col("i") - F.col("i2")), F.abs(F.col("j") - F.col("j2"))) <= 1


def _errors() -> list[Column]:
    return [F.avg("dist").alias("quantization_error"), F.avg((~touching()).cast("double")).alias("topographic_error")]


def quantization_error(assigned: DataFrame) -> DataFrame:
    """Mean distance to the best unit."""
    return assigned.agg(_errors()[0])


def topographic_error(assigned: DataFrame) -> DataFrame:
    """Share of rows whose two best units do not touch."""
    return assigned.agg(_errors()[1])


def map_errors(assigned: DataFrame) -> DataFrame:
    """Both errors in one pass."""
    return assigned.agg(*_errors())


def u_matrix(neurons: DataFrame) -> DataFrame:
    """Summed distance of each unit to its grid neighbours, as a share of the largest such sum."""
    steps = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a, b) != (0, 0)]
    around = F.array(*[F.struct((F.col("i") + a).alias("ni"), (F.col("j") + b).alias("nj")) for a, b in steps])
    towards = neurons.select("i", "j", "w", F.inline(around))
    other = neurons.select(F.col("i").alias("ni"), F.col("j").alias("nj"), F.col("w").alias("nw"))
    squares = F.zip_with("w", "nw", lambda a, b: (a - b) * (a - b))
    distance = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))
    summed = towards.join(other, ["ni", "nj"]).groupBy("i", "j").agg(F.sum(distance).alias("total"))
    largest = summed.agg(F.max("total").alias("largest")).scalar()
    return summed.select("i", "j", (F.col("total") / F.nullif(largest, F.lit(0.0))).alias("u"))


def component_planes(neurons: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Weight of each feature at each unit, in long form."""
    names = F.array(*[F.lit(c) for c in cols])
    long = neurons.select("i", "j", F.posexplode("w").alias("pos", "value"))
    return long.select(F.element_at(names, F.col("pos") + 1).alias("feature"), "i", "j", "value")


def neuron_columns(neurons: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Units with one column per feature."""
    return neurons.selectExpr("i", "j", *[f"w[{d}] AS `{c}`" for d, c in enumerate(cols)])
