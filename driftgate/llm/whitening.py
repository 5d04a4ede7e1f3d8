"""Embedding whitening by weighted multiplicity covariance.

Every vector entry ``c`` becomes the integer ``floor(scale * c)``. Rows are grouped by that integer
vector, so copies (a third of all rows may be one vector) collapse before anything is shuffled; each
distinct vector enters the fit with weight one, or with its number of rows (``weight="count"``).
Two passes over the distinct vectors give the exact sums and then the centred Gram matrix: every
task multiplies its own centred rows (one GEMM a batch) and hands on one d x d matrix, which are
added in two steps. Only d x d numbers reach the driver, never a number that grows with the rows.
Each distinct vector is whitened once, and the rows get the result by an equi-join on the vector.

Defined results: a row whose vector is null, empty, or holds a null or non-finite entry is left out.
Vectors of another length than the most frequent one (ties: the shorter) are left out too. Repeated
rows and rows with a null id stay, each with its own result rows. A component without variance has
``whitened`` 0.0 and is left out of ``identity_error``; if no vector varies, ``explained`` is 0.0.
An empty table gives no rows. ``deviation`` is null where it does not fit in a long. Further columns
are ignored. Entries are exact while ``abs(scale * c)`` is below 2^53.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftgate.llm.common import ship
from driftgate.session import written

SCALE = 256
COMPONENTS = 4
#: Partial Gram matrices are added in this many groups, then those sums in one task.
PARTIAL_GROUPS = 64
_SAFE = 2**62


@dataclass(frozen=True)
class Whitening:
    """A fit: weight total, exact sums, and components by falling eigenvalue (columns of ``axes``)."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    axes: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums], dtype=np.float64)

    def varies(self, k: int) -> bool:
        return bool(self.eigenvalues[k] > len(self.sums) * np.finfo(np.float64).eps * self.trace)

    def explained(self, k: int) -> float:
        return float(self.eigenvalues[k] / self.trace) if self.trace > 0 else 0.0

    def projection(self, components: int) -> np.ndarray:
        """d x components: centred vector -> whitened coordinates."""
        scaled = [self.axes[:, k] / np.sqrt(self.eigenvalues[k]) if self.varies(k) else np.zeros(len(self.sums)) for k in range(components)]
        return np.column_stack(scaled)


def quantised(rows: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id, x array<bigint>) of the usable rows."""
    entry = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    usable = rows.select(F.col(id_col).alias("id"), entry.alias("v")).filter((F.size("v") > 0) & ~F.exists("v", bad))
    return usable.select("id", F.transform("v", lambda c: F.floor(F.lit(float(scale)) * c).cast("bigint")).alias("x"))


def distinct_vectors(x: DataFrame) -> DataFrame:
    """(x, rows): each distinct vector once, written."""
    return written(x.groupBy("x").agg(F.count(F.lit(1)).alias("rows")), "vectors")


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _magnitude(x: np.ndarray) -> int:
    """Largest absolute entry, exact also for the smallest long."""
    return max(int(x.max()), -int(x.min())) if x.size else 0


def _weights(batch: pa.RecordBatch, weight: str) -> np.ndarray:
    return batch.column(1).to_numpy(zero_copy_only=False) if weight == "count" else np.ones(batch.num_rows, np.int64)


def _sums(vectors: DataFrame, d: int, weight: str) -> tuple[int, list[int]]:
    """Weight total and exact weighted sums by dimension: one row a task, added as decimals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(d, object)
        for batch in batches:
            x, w = _matrix(batch.column(0), d), _weights(batch, weight)
            total = int(w.sum())
            exact = x if _magnitude(x) * total < _SAFE else x.astype(object)
            n += total
            sums += (exact * w[:, None]).sum(axis=0).astype(object)
        cells = [str(n), *map(str, sums)]
        yield pa.RecordBatch.from_arrays([pa.array(range(d + 1), pa.int32()), pa.array(cells)], names=["k", "part"])

    parts = vectors.mapInArrow(run, "k int, part string")
    totals = parts.groupBy("k").agg(F.sum(F.col("part").cast("decimal(38,0)")).cast("string").alias("total")).collect()
    by_k = {r.k: int(r.total) for r in totals}
    return by_k[0], [by_k[k] for k in range(1, d + 1)]


def _gram(vectors: DataFrame, mean: np.ndarray, weight: str) -> np.ndarray:
    """Sum of w * (x - mean)(x - mean)^T over the distinct vectors."""
    d = len(mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, seen = np.zeros((d, d)), False
        for batch in batches:
            centred = _matrix(batch.column(0), d).astype(np.float64) - mean
            gram += (centred * _weights(batch, weight)[:, None]).T @ centred
            seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([gram.tobytes()], pa.binary())], names=["gram"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(d * d)
        for cell in table.column("gram"):
            total += np.frombuffer(cell.as_buffer(), np.float64)
        return pa.table({"gram": pa.array([total.tobytes()], pa.binary())})

    parts = vectors.mapInArrow(run, "gram binary").withColumn("g", F.spark_partition_id() % PARTIAL_GROUPS)
    sums = parts.groupBy("g").applyInArrow(add, "gram binary")
    blob = sums.withColumn("g", F.lit("all")).groupBy("g").applyInArrow(add, "gram binary").first()
    return np.frombuffer(bytes(blob.gram), np.float64).reshape(d, d)


def fit(vectors: DataFrame, weight: str = "one") -> Whitening | None:
    """Fit on ``distinct_vectors`` rows of one length; None if there are none."""
    if weight not in ("one", "count"):
        raise ValueError(f"weight must be 'one' or 'count', not {weight!r}")
    first = vectors.select(F.size("x")).first()
    if first is None:
        return None
    n, sums = _sums(vectors, first[0], weight)
    mean = np.array([s / n for s in sums], dtype=np.float64)
    cov = _gram(vectors, mean, weight) / n
    values, axes = np.linalg.eigh((cov + cov.T) / 2)
    values, axes = np.maximum(values[::-1], 0.0), axes[:, ::-1]
    flip = np.where(axes[np.abs(axes).argmax(axis=0), range(len(sums))] < 0, -1.0, 1.0)
    return Whitening(n, sums, values, axes * flip, float(np.trace(cov)))


def transform(vectors: DataFrame, model: Whitening, components: int) -> DataFrame:
    """(x, rows, deviation, z): each distinct vector whitened once."""
    mean, projection, n, sums = model.mean, model.projection(components), model.n, model.sums
    d, largest = len(sums), max(map(abs, sums))

    def deviations(x: np.ndarray) -> list[int | None]:
        bound = n * _magnitude(x) + largest
        fits = bound * bound * d < _SAFE
        scaled = x * n - np.array(sums) if fits else x.astype(object) * n - np.array(sums, object)
        return [int(v) if v < 2**63 else None for v in (scaled * scaled).sum(axis=1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = _matrix(batch.column(0), d)
            z = (x.astype(np.float64) - mean) @ projection
            offsets = pa.array(range(0, z.size + 1, components), pa.int32())
            columns = [batch.column(0), batch.column(1), pa.array(deviations(x), pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(z.ravel()))]
            yield pa.RecordBatch.from_arrays(columns, names=["x", "rows", "deviation", "z"])

    return vectors.mapInArrow(run, "x array<bigint>, rows bigint, deviation bigint, z array<double>")


def identity_error(whitened: DataFrame, model: Whitening, components: int, weight: str) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    ks = [k for k in range(components) if model.varies(k)]
    if not ks:
        return 0.0
    w = F.col("rows").cast("double") if weight == "count" else F.lit(1.0)
    means = whitened.agg(*[F.sum(w * F.col("z")[k]).alias(f"m{k}") for k in ks]).first()
    centred = {k: F.col("z")[k] - F.lit(means[f"m{k}"] / model.n) for k in ks}
    pairs = [(a, b) for a in ks for b in ks if a <= b]
    moments = whitened.agg(*[F.sum(w * centred[a] * centred[b]).alias(f"c{a}_{b}") for a, b in pairs]).first()
    return max(abs(moments[f"c{a}_{b}"] / model.n - (a == b)) for a, b in pairs)


def whiten(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, weight: str = "one"
) -> DataFrame:
    """One row per usable input row and component, numbered from 1 by falling eigenvalue: the id,
    component, n, deviation, whitened, explained, identity_error."""
    x = quantised(rows, id_col, vector_col, scale)
    vectors = distinct_vectors(x)
    length = vectors.groupBy(F.size("x").alias("d")).agg(F.sum("rows").alias("c")).orderBy(F.col("c").desc(), "d").first()
    if length is not None:
        vectors = vectors.filter(F.size("x") == length.d)
    model = fit(vectors, weight)
    out_type = rows.schema[id_col].dataType.simpleString()
    if model is None:
        schema = f"`{id_col}` {out_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return rows.sparkSession.createDataFrame([], schema)
    components = min(components, length.d)
    table = written(transform(vectors, model, components), "whitened")
    error = identity_error(table, model, components, weight)
    explained = F.array(*[F.lit(model.explained(k)) for k in range(components)])
    back = x.join(table.select("x", "deviation", "z"), "x").select("id", "deviation", F.posexplode("z").alias("k", "whitened"))
    return back.select(
        F.col("id").alias(id_col),
        (F.col("k") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("k")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


ship(__name__)
