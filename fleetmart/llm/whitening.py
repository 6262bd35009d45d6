"""Whitening of vectors along their leading principal components, which contour integration finds.

Everything that grows with the rows is Spark's: different vectors, their sums, the centred products, the projections.
The driver sees sums of the size of a vector and its square.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.contour import leading
from fleetmart.llm.store import Workspace
from fleetmart.llm.vectors import matrix

SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Whitening:
    """Parameters."""

    components: int = 4
    #: Entries become whole numbers of this part of one.
    parts: int = 256


@dataclass(frozen=True)
class Fitted:
    """Number and sums of the fitted vectors; the projection (dimension, component), explained parts, and what is left of the identity."""

    n: int
    sums: tuple[int, ...]
    project: np.ndarray
    explained: np.ndarray
    error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x - np.array([s / self.n for s in self.sums])


def whole() -> Column:
    """Entries as whole numbers; null unless all are finite."""
    wrong = F.exists("vector", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce(~wrong, F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    return matrix(column).astype(np.int64)


def _products(centred):
    """Sums of the outer products of centred rows, one row of the matrix each; a task hands on one matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                y = centred(_matrix(batch.column("x")))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            d = len(total)
            rows = pa.ListArray.from_arrays(pa.array(np.arange(d + 1, dtype=np.int32) * d), pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), rows], ["i", "row"])

    return run


def _summed(x: DataFrame, centred, d: int) -> np.ndarray:
    """The matrix of summed products; ``d`` by ``d`` numbers come to the driver."""
    parts = x.mapInArrow(_products(centred), "i int, row array<double>").select("i", F.posexplode("row").alias("j", "v"))
    out = np.zeros((d, d))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = r["v"]
    return out


def fit(x: DataFrame, d: int, params: Whitening = Whitening()) -> Fitted | None:
    """Fits different vectors (column x) of ``d`` whole numbers; None if there are none."""
    sums = x.select(F.posexplode("x").alias("j", "v")).groupBy("j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")).collect()
    if not sums:
        return None
    n = sums[0]["n"]
    s = [0] * d
    for r in sums:
        s[r["j"]] = int(r["s"])
    start = Fitted(n, tuple(s), np.zeros((d, 0)), np.zeros(0))
    covariance = _summed(x, start.centred, d) / n
    values, vectors = leading(covariance, params.components)
    project = vectors / np.sqrt(values)
    fitted = Fitted(n, tuple(s), project, values / max(np.trace(covariance), np.finfo(float).tiny))
    k = len(values)
    if not k:
        return fitted
    # Columns of the projection and one of ones: means and products at once.
    again = _summed(x, lambda rows: np.concatenate((fitted.centred(rows) @ project, np.ones((len(rows), 1))), 1), k + 1) / n
    error = again[:k, :k] - np.outer(again[:k, k], again[:k, k]) - np.eye(k)
    return Fitted(n, tuple(s), project, fitted.explained, float(np.abs(error).max()))


def _deviation(x: np.ndarray, fitted: Fitted) -> list[int | None]:
    """Sum of (n * x - S)^2 over the dimensions, exact; None if it is no 64-bit number."""
    s = np.array(fitted.sums, dtype=object)
    most = fitted.n * float(np.abs(x.astype(float)).max(initial=0.0)) + max((abs(float(v)) for v in fitted.sums), default=0.0)
    if most * most * max(x.shape[1], 1) < 2.0**62:
        y = x * fitted.n - s.astype(np.int64)
        return (y * y).sum(1).tolist()
    y = x.astype(object) * fitted.n - s
    return [v if v < 1 << 63 else None for v in (y * y).sum(1)]


def _whitener(fitted: Fitted):
    k = len(fitted.explained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x, rows = _matrix(batch.column("x")), batch.num_rows
            each = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, fitted.n)),
                    pa.array(_deviation(x, fitted), pa.int64()).take(each), pa.array((fitted.centred(x) @ fitted.project).ravel()),
                    pa.array(np.tile(fitted.explained, rows)), pa.array(np.full(rows * k, fitted.error)),
                ],
                [c.split()[0] for c in SCHEMA.split(", ")],
            )

    return run


def whiten(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", params: Whitening = Whitening()) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per row with a whole vector and component.

    Entries c become floor(parts * c). The different vectors are fitted: n of them, with sums S per dimension, and a
    covariance V with divisor n. Components are unit eigenvectors of V by falling eigenvalue e, equal ones in any
    order; ``whitened`` is (x - S / n) on the component over sqrt(e), ``explained`` e / trace(V), ``deviation`` the sum of
    (n * x - S)^2, null if it is no 64-bit number, and ``identity_error`` the largest entry of the fitted rows' whitened
    covariance less the identity.

    Rows with a null vector or with null or non-finite entries go. Every length of vectors is fitted by itself; empty
    vectors and a length without variance have no components and so no rows, and one of less rank than ``components`` has
    as many components as its rank. Entries beyond 64 bits are cut to them. Repeated rows and ids are all returned;
    rows without an id too. An empty table gives an empty result; further columns are not read.
    """
    spark = table.sparkSession
    work = Workspace(spark, "whitening")
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).where(F.col("vector").isNotNull() & whole() & (F.size("vector") > 0))
    rows = work.save(rows.select("vec_id", F.transform("vector", lambda c: F.floor(c * params.parts).cast("long")).alias("x"), F.size("vector").alias("d")), "rows")
    out = spark.createDataFrame([], SCHEMA)
    # Vectors of a table have one length, or a few.
    lengths = [r["d"] for r in rows.select("d").distinct().orderBy("d").collect()]
    for d in lengths:
        mine = rows.where(F.col("d") == d)
        distinct = work.save(mine.select("x").distinct(), "distinct")
        fitted = fit(distinct, d, params)
        out = out.unionByName(mine.select("vec_id", "x").mapInArrow(_whitener(fitted), SCHEMA)) if len(lengths) > 1 else mine.select("vec_id", "x").mapInArrow(_whitener(fitted), SCHEMA)
    return out
