"""Embedding whitening: uncorrelated components of unit variance.

Vectors are put on a grid of whole numbers, so sums of them and of their products are exact and do not depend on how
rows are dealt out: tasks add up their own rows and Spark adds up the tasks. The covariance, a
matrix of dimensions by dimensions whatever the number of rows, is solved by contour integration, one task per
interval of eigenvalues (:mod:`clearwell.llm.feast`). A last pass projects every row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearwell.llm import feast
from clearwell.llm.common import has
from clearwell.llm.topk import usable
from clearwell.session import stage

#: Steps of the grid per unit, and its shift.
FACTOR, OFFSET = 64, 1_000_000
#: Entries must be below this on the grid, so that sums of squares fit 38 digits.
LARGEST = float(1 << 40)

_EXACT = 2.0**53


def on_grid(vector: Column) -> Column:
    """Whole numbers ``floor(FACTOR * c)``, without the shift, which no difference depends on."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * FACTOR))


def _rows(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dims)


def _product(rows: np.ndarray) -> np.ndarray:
    """``rows.T @ rows`` exactly: in doubles as long as no sum reaches 2**53, else in Python's integers."""
    most = float(np.abs(rows).max(initial=0)) ** 2
    if most >= _EXACT:
        return rows.T.astype(object) @ rows.astype(object)
    at_once = max(1, int(_EXACT / max(most, 1.0)) - 1)
    total = np.zeros((rows.shape[1], rows.shape[1]), dtype=object if most * len(rows) >= 2.0**62 else np.int64)
    for start in range(0, len(rows), at_once):
        part = rows[start : start + at_once].astype(float)
        total = total + (part.T @ part).astype(np.int64)
    return total


def _summed(vectors: DataFrame, dims: int, part: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """Sum over all rows of ``part``, a matrix with as many columns for any block of rows.

    Every task adds up its own rows and gives one row per row of the matrix; Spark adds up the tasks. The matrix comes
    to the driver: it has dimensions times dimensions numbers at most.
    """
    arrow = pa.decimal128(38, 0) if kind == "decimal(38,0)" else pa.float64()

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = part(_rows(batch.column(0), dims))
                own = own.astype(object) if kind != "double" else own
                total = own if total is None else total + own
        if total is not None:
            lines = [[Decimal(int(x)) for x in line] for line in total] if kind != "double" else total.tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(lines)), pa.int32()), pa.array(lines, pa.list_(arrow))], names=["i", "line"]
            )

    lines = vectors.select("x").mapInArrow(partial, f"i int, line array<{kind}>")
    cells = lines.select("i", F.posexplode("line").alias("j", "value")).groupBy("i", "j")
    found = cells.agg(F.sum("value").cast(kind).alias("value")).collect()
    if not found:
        return np.zeros((0, 0))
    out = np.zeros((1 + max(r.i for r in found), 1 + max(r.j for r in found)), dtype=object if kind != "double" else float)
    for r in found:
        out[r.i, r.j] = int(r.value) if kind != "double" else r.value
    return out


def _components(spark, covariance: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and their vectors; every interval is solved by a task."""
    parts = feast.intervals(covariance, wanted)
    if not parts:
        return np.zeros(0), np.zeros((len(covariance), 0))
    shared = spark.sparkContext.broadcast(covariance)  # dimensions by dimensions

    def solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for low, high, count in batch.itertuples(index=False):
                values, vectors = feast.eigenpairs(shared.value, low, high, int(count))
                yield pd.DataFrame({"value": values, "vector": [v.tolist() for v in vectors.T]})

    tasks = spark.createDataFrame(parts, "low double, high double, n long").repartition(len(parts), "low")
    # At most ``wanted`` vectors and those of one more interval.
    found = sorted(tasks.mapInPandas(solved, "value double, vector array<double>").collect(), reverse=True)
    if len(found) != sum(count for *_, count in parts):
        raise RuntimeError("eigenvectors are missing")
    return feast.combined(covariance, np.array([r.vector for r in found]).T, wanted)


def whiten(embeddings: DataFrame, components: int = 32, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error`` of every usable row and component.

    Entries become whole numbers ``floor(FACTOR * c) + OFFSET``. Components are eigenvectors of their covariance (divisor
    n), numbered from 1 by falling eigenvalue, up to ``components`` of those whose eigenvalue is more than rounding error;
    vectors without any variance give no row. ``whitened`` is the centred vector on the component over the root of its
    eigenvalue, ``explained`` the eigenvalue's share of the trace, ``deviation`` the sum of squares of
    ``n * x - S`` as decimal(38,0), ``identity_error`` how far the covariance of what was whitened is from the identity.

    NULL and empty vectors, and those with NULL, NaN, infinite or huge entries (``LARGEST``), are left out. The number
    of dimensions is the most frequent one (of equally frequent ones the largest); other vectors are left out.
    Repeated rows and keys, and NULL keys, give rows each. An empty table gives an empty result. Keys keep their type.
    """
    has(embeddings, key=key, vector=vector)
    spark = embeddings.sparkSession
    rows = embeddings.where(usable(F.col(vector))).select(F.col(key).alias("key"), on_grid(F.col(vector)).alias("x"))
    rows = rows.where(F.forall("x", lambda x: F.abs(x.cast("double")) < LARGEST))
    kind = rows.schema["key"].dataType.simpleString()
    result = f"key {kind}, deviation decimal(38,0), w array<double>"

    sizes = rows.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.orderBy(F.desc("n"), F.desc("dims")).first()
    dims, n = tuple(largest) if largest else (1, 0)
    rows = rows.where(F.size("x") == dims)
    sums = _summed(rows, dims, lambda x: x.sum(axis=0)[None, :], "decimal(38,0)") if n else np.zeros((1, dims), object)
    # Differences to a whole number next to the mean are small, and their products exact.
    mean = [(2 * int(s) + n) // (2 * n) for s in sums[0]] if n else [0] * dims
    middle = np.array(mean, dtype=np.int64)
    rest = np.array([int(s) - n * m for s, m in zip(sums[0], mean, strict=True)], dtype=object)
    if n:
        squares = _summed(rows, dims, lambda x: _product(x - middle), "decimal(38,0)")
        numerators = n * squares - np.outer(rest, rest)
        covariance = np.array([[int(c) / (n * n) for c in line] for line in numerators])
        values, vectors = _components(spark, covariance, components)
        trace = sum(int(numerators[i, i]) for i in range(dims)) / (n * n)
    else:
        values, vectors, trace = np.zeros(0), np.zeros((dims, 0)), 1.0
    to_unit = spark.sparkContext.broadcast((middle, rest, vectors / np.sqrt(values)))  # dimensions by components

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle, rest, directions = to_unit.value
        for batch in batches:
            if not batch.num_rows:
                continue
            centred = _rows(batch.column(1), dims) - middle
            most = (float(np.abs(centred).max()) + 1) * n
            if most * most * dims < 2.0**62:
                whole = centred * n - rest.astype(np.int64)
                deviation = pa.array((whole * whole).sum(axis=1)).cast(pa.decimal128(38, 0))
            else:
                whole = centred.astype(object) * n - rest
                sums = ((whole * whole).sum(axis=1)).tolist()
                deviation = pa.array([Decimal(s) if s < 10**38 else None for s in sums], pa.decimal128(38, 0))
            w = (whole / n).astype(float) @ directions
            ends = np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), deviation, pa.ListArray.from_arrays(ends, pa.array(w.ravel()))],
                names=["key", "deviation", "w"],
            )

    whitened = stage(rows.mapInArrow(projected, result), "whitened")
    k, error = len(values), None
    if k:
        means = _summed(whitened.select(F.col("w").alias("x")), k, lambda w: w.sum(axis=0)[None, :], "double")[0] / n
        products = _summed(
            whitened.select(F.col("w").alias("x")), k, lambda w: (w - means).T @ (w - means), "double"
        )
        error = float(np.abs(products / n - np.eye(k)).max())
    shares = F.array(*[F.lit(float(v / trace)) for v in values]) if k else F.array().cast("array<double>")
    return whitened.select("key", "deviation", F.posexplode("w").alias("place", "whitened")).select(
        F.col("key").alias(key), (F.col("place") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        "whitened", F.get(shares, F.col("place")).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )
