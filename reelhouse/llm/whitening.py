"""Whitening of embeddings by shifted CholeskyQR.

The centred vectors are made orthonormal by passes over the rows: a pass sums the Gram matrix of the rows as
they are so far, its Cholesky factor R goes into the list of factors, and rows are sent through triangular
solves with the whole list when they are next read. The first Gram matrix is shifted, so that its factor exists
even if columns depend on each other. The product of the factors is the R of the rows' QR decomposition; its
SVD gives components and eigenvalues without ever squaring the condition number for good. What the driver
sees is a matrix as wide as the vectors, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.llm.common import kept, read

GRAIN = 256  # steps of the grid per unit
COMPONENTS = 4
PASSES = 12  # more than enough; the job fails if rows are not orthonormal by then
ROUND = float(np.finfo(float).eps) / 2
FLAT = 1e-11  # a direction whose spread is this much smaller than the largest is rounding, not a component
SOUND = 1e-8  # least eigenvalue of a Gram matrix that needs no shift
UNSEEN = 1e-10  # an eigenvalue that is nothing, once shifts have lifted all that counts above it
_WIDE = 2.0**62


def grid(vector: Column) -> Column:
    """floor(256 * entry) of each entry as a long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * GRAIN).cast("bigint"))


def whole(df: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector is there and has neither null nor non-finite entries."""

    def sound(c: Column) -> Column:
        return F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False))  # NaN is above infinity

    return df.filter(F.col(vector).isNotNull() & F.coalesce(F.forall(vector, sound), F.lit(False)))


def matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The vectors of a batch as a matrix of longs."""
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def offsets(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, without rounding: as longs, or as Python's integers where these are too short."""
    if float(n) * max(np.abs(x.astype(float)).max(initial=0.0), 1.0) + max(map(abs, sums), default=0) < _WIDE:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def solved(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """The rows Q with Q @ upper == rows, column by column."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


def _totals(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums per dimension; a sum beyond a long fails the job."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * width
        for batch in batches:
            x = matrix(batch, width)
            if np.abs(x.astype(float)).sum(axis=0).max(initial=0.0) < _WIDE:
                some = x.sum(axis=0).tolist()
            else:
                some = x.astype(object).sum(axis=0).tolist()
            n, sums = n + len(x), [a + b for a, b in zip(sums, some)]
        at = pa.array(range(-1, width), pa.int32())
        yield pa.RecordBatch.from_arrays([at, pa.array([n, *sums], pa.int64())], names=["i", "s"])

    found = fit.mapInArrow(add, "i int, s bigint").groupBy("i").agg(F.sum("s").alias("s")).collect()
    sums = {r["i"]: r["s"] for r in found}  # one row per dimension
    return sums.get(-1, 0), [sums.get(i, 0) for i in range(width)]


def _gram(fit: DataFrame, n: int, sums: list[int], factors: list[np.ndarray], project=None) -> np.ndarray:
    """Sum over the centred rows, sent through the factors (and a projection), of their outer products."""
    width = len(sums)
    side = width if project is None else project.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((side, side))
        for batch in batches:
            rows = offsets(matrix(batch, width), n, sums).astype(float) / n
            for upper in factors:
                rows = solved(rows, upper)
            if project is not None:
                rows = rows @ project
            total += rows.T @ rows
        i, j = np.divmod(np.arange(side * side, dtype="i4"), side)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], names=["i", "j", "v"])

    out = np.zeros((side, side))
    parts = fit.mapInArrow(add, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    for r in parts.collect():  # the square of the vectors' width
        out[r["i"], r["j"]] = r["v"]
    return (out + out.T) / 2


def factor(gram: np.ndarray, n: int, shifted: bool) -> tuple[np.ndarray, float]:
    """Upper Cholesky factor, of the shifted matrix if asked for, and the shift relative to the norm."""
    width = len(gram)
    share = 11.0 * (n * width + width * (width + 1)) * ROUND if shifted else 0.0
    shift = share * float(np.linalg.eigvalsh(gram)[-1])
    return np.linalg.cholesky(gram + shift * np.eye(width)).T, share


def principal(fit: DataFrame, n: int, sums: list[int], count: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Components as columns, their eigenvalues, and the trace of the covariance of the distinct vectors.

    At most `count`; fewer if the vectors spread in fewer directions.
    """
    width = len(sums)
    product, factors = np.eye(width), []
    if n < 2:
        return np.zeros((width, 0)), np.zeros(0), 0.0
    lifted = 1.0  # what a direction has to have of the largest spread, squared, to be seen by now
    for i in range(PASSES):
        gram = _gram(fit, n, sums, factors)
        if not gram.any():
            return np.zeros((width, 0)), np.zeros(0), 0.0
        found = np.linalg.eigvalsh(gram)
        nothing = found <= UNSEEN  # columns that depend on others leave zero, or rounding, behind
        if i and np.abs(found[~nothing] - 1).max() <= 1e-13 * max(width, 8) and (
            not nothing.any() or UNSEEN * lifted <= FLAT**2
        ):
            break
        upper, share = factor(gram, n, shifted=i == 0 or found[0] < SOUND)
        lifted *= share or 1.0
        factors.append(upper)
        product = upper @ product
    else:
        raise ArithmeticError(f"rows are not orthonormal after {PASSES} passes")
    # directions without any spread are zero in the rows, so they are zero in their R as well
    found, sides = np.linalg.eigh(gram)
    product = np.sqrt(np.where(found > UNSEEN, found, 0.0))[:, None] * (sides.T @ product)
    _, spread, turned = np.linalg.svd(product)
    values = spread**2 / n
    real = int((spread > FLAT * spread[0]).sum())
    count = min(count, real)
    return turned[:count].T.copy(), values[:count], float(values.sum())


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """`key`, component, n, deviation, whitened, explained, identity_error; a row per vector and component.

    Vectors that are null or hold a null or non-finite entry are left out; a vector shorter than the longest
    one lacks entries and is left out as well. Equal vectors count once in the fit and each have their rows;
    null and repeated keys are kept as they are. Entries too large for the grid stop at the ends of a long.
    Components of equal eigenvalues come in the order the SVD gives. Without spread, as for an empty table
    or one vector, there are no components and no rows. A deviation beyond a long is NULL.
    """
    spark = df.sparkSession
    sound = whole(df.select(F.col(key).alias("key"), F.col(vector).alias("v")), "v")
    rows = kept(sound.select("key", grid(F.col("v")).alias("x")), "vectors")
    width = rows.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0]
    rows = rows.filter(F.size("x") == width)
    schema = T.StructType([T.StructField(key, df.schema[key].dataType)])
    for name, kind in (
        ("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()),
        ("whitened", T.DoubleType()), ("explained", T.DoubleType()), ("identity_error", T.DoubleType()),
    ):
        schema = schema.add(name, kind)
    if not width:
        return spark.createDataFrame([], schema)
    fit = kept(rows.select("x").distinct(), "distinct")
    n, sums = _totals(fit, width)
    components, values, trace = principal(fit, n, sums, count)
    count = len(values)
    if not count:
        return spark.createDataFrame([], schema)
    scaled = components / np.sqrt(values)
    error = float(np.abs(_gram(fit, n, sums, [], scaled) / n - np.eye(count)).max())
    explained = values / trace

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off = offsets(matrix(batch, width), n, sums)
            if (off.astype(float) ** 2).sum(axis=1).max(initial=0.0) < _WIDE:
                deviation = (off * off).sum(axis=1).tolist()
            else:
                exact = [sum(int(a) ** 2 for a in row) for row in off]
                deviation = [a if a < 1 << 63 else None for a in exact]
            at = off.astype(float) / n
            # sums by row and no product of matrices, whose rounding hangs on the place of a row in its batch
            found = np.stack([(at * side).sum(axis=1) for side in scaled.T], axis=1)
            m = batch.num_rows
            columns = [
                batch.column("key").take(pa.array(np.repeat(np.arange(m), count))),
                pa.array(np.tile(np.arange(1, count + 1, dtype="i4"), m)),
                pa.array(np.full(m * count, n)),
                pa.array([d for d in deviation for _ in range(count)], pa.int64()),
                pa.array(found.ravel()),
                pa.array(np.tile(explained, m)),
                pa.array(np.full(m * count, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return rows.mapInArrow(score, schema)


def op12_cholesky_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))
