"""Operator 11, whitening by Golub-Kahan-Lanczos bidiagonalisation.

The vectors become integers x = floor(scale * c) + offset, so counts and sums are exact.  Rows of X
are the centred vectors (n * x - S) / n.  Step k multiplies X by the direction v_k and X' by the new
left vector, row block by row block: one Spark pass a step.  A left vector has an entry per row and
is never stored: with X V = U R (R upper triangular, bidiagonal but for rounding) a task computes
its rows of U from its rows of X and the small V and R it is sent.  A pass returns sums only (X' p, U' p
and p' p of the new product p), added up by Spark per position, so the driver gets a few numbers a
dimension, whatever the number of rows.  Both sides are fully reorthogonalised: U by the sums of the
pass, V (of the size of one vector) on the driver, twice.  When a direction is used up, the next one
is random, orthogonal to all before.

The small bidiagonal matrix is decomposed: its singular values give the deviations, its right vectors
times V the components.  Steps end when all dimensions are used, or when the wanted components have
converged to double precision and the variance outside the directions found is below the last wanted
one, so that none can have been missed.

Defined cases: a vector that is null or holds a null or non-finite entry is left out, as is one whose
entry, scaled, passes 2^52; if vectors have several lengths the most frequent one is taken (of ties the
larger) and the others are left out, so vectors without entries give nothing where there are others;
repeated identifiers and rows are separate rows of the fit; null identifiers are kept; components of no
variance (below `RANK` of the largest, as for a single vector or equal ones) are not returned; of equal
variances any orthogonal basis may be returned; a squared deviation beyond 64 bits is null; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.shared import materialise
from tidepool.session import table_path

COMPONENTS = 32
SCALE, OFFSET = 64.0, 1_000_000
LARGEST = float(1 << 52)
ROWS = 4096  # of a matrix at once
EXACT = 1e-15  # error of a converged component, relative to the largest deviation
RANK = 1e-12  # variances below this part of the largest count as none

WHITENED = "vec_id long, component int, deviation long, whitened double"


@dataclass
class Whitening:
    """n vectors with sums `sums`; `components` (a column each) with variances, largest first; the total variance."""
    n: int
    sums: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    total: float
    steps: int


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = SCALE,
                    offset: int = OFFSET) -> DataFrame:
    """vec_id, x (array of long) of the vectors that count, written."""
    vec = F.col(vec_col).cast("array<double>")
    scaled = F.transform(vec, lambda c: c * F.lit(scale))
    usable = F.col("y").isNotNull() & F.forall("y", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) <= F.lit(LARGEST)), F.lit(False)))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), scaled.alias("y")).where(usable)
    x = F.transform("y", lambda c: F.floor(c) + F.lit(offset).cast("long"))
    return materialise(rows.select("vec_id", x.alias("x")), "vectors")


def _matrix(batch: pa.RecordBatch, n: int, sums: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(identifiers, n * x - S) of runs of rows."""
    for at in range(0, batch.num_rows, ROWS):
        part = batch.slice(at, ROWS)
        x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, len(sums))
        yield part.column("vec_id"), n * x - sums


def _summed(rows: DataFrame, n: int, sums: np.ndarray, figures, size: int) -> np.ndarray:
    """Sum over all row blocks of `figures(block of X)`, an array of `size` numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for _, d in _matrix(batch, n, sums):
                total += figures(d / n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total)], names=["place", "value"])

    out = np.zeros(size)
    for r in rows.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect():
        out[r.place] = r.value
    return out


def fit(rows: DataFrame, components: int = COMPONENTS, seed: int = 0) -> tuple[DataFrame, Whitening | None]:
    """The whitening of integer vectors, and those of them that it is for; None where there are none."""
    sizes = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if sizes is None or sizes["size"] == 0:
        return rows.limit(0), None
    dim, n = sizes["size"], sizes["count"]
    rows = rows.where(F.size("x") == dim)
    sums = np.zeros(dim, dtype=object)
    for r in rows.select(F.posexplode("x").alias("place", "c")).groupBy("place").agg(F.sum(F.col("c").cast("decimal(38,0)")).alias("s")).collect():
        sums[r.place] = int(r.s)
    sums = sums.astype(np.int64)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return rows, _bidiagonalise(rows, n, sums, min(components, dim), np.random.default_rng(seed))
    finally:
        rows.unpersist()


def _orthogonal(w: np.ndarray, v: np.ndarray) -> np.ndarray:
    for _ in range(2):
        w = w - v @ (v.T @ w)
    return w


def _bidiagonalise(rows: DataFrame, n: int, sums: np.ndarray, wanted: int, rng: np.random.Generator) -> Whitening:
    dim = len(sums)
    total = float(_summed(rows, n, sums, lambda x: np.array([np.square(x).sum()]), 1)[0])
    empty = Whitening(n, sums, np.zeros((dim, 0)), np.zeros(0), 0.0, 0)
    if total == 0:
        return empty
    tiny = np.sqrt(total) * 1e-14
    v = np.zeros((dim, 0))  # right vectors
    r = np.zeros((0, 0))  # X V = U R
    xu = np.zeros((dim, 0))  # X' U
    alpha, beta = [], []
    new = rng.standard_normal(dim)
    new /= np.linalg.norm(new)
    while True:
        k = v.shape[1]
        solve = _inverse(r)

        def figures(x, v=v, solve=solve, new=new, back=(beta[-1] if beta else 0.0)):
            u = x @ (v @ solve)
            p = x @ new - (back * u[:, -1] if u.shape[1] else 0.0)
            return np.concatenate([x.T @ p, u.T @ p, [p @ p]])

        got = _summed(rows, n, sums, figures, dim + k + 1)
        c = got[dim:dim + k]
        left = got[-1] - c @ c
        a = np.sqrt(left) if left > tiny * tiny else 0.0
        column = np.append(c, a)
        if beta:
            column[k - 1] += beta[-1]
        r = np.block([[r, column[:k, None]], [np.zeros((1, k)), np.array([[a]])]])
        side = (got[:dim] - xu @ c) / a if a else np.zeros(dim)  # X' u of the new left vector
        xu, v = np.column_stack([xu, side]), np.column_stack([v, new])
        alpha.append(a)
        k += 1
        w = _orthogonal(side - a * new, v)
        b = np.linalg.norm(w)
        beta.append(b if b > tiny else 0.0)
        small = np.diag(alpha) + np.diag(beta[:-1], 1)
        left_vectors, s, right = np.linalg.svd(small)
        top = min(wanted, k)
        converged = k >= wanted and np.all(beta[-1] * np.abs(left_vectors[-1, :top]) <= EXACT * s[0])
        if k == dim or (converged and total - np.square(s).sum() < s[top - 1] ** 2):
            break
        if beta[-1] == 0.0:  # these directions are used up
            w = _orthogonal(rng.standard_normal(dim), v)
            b = np.linalg.norm(w)
        new = w / b
    found = v @ right[:top].T
    var = np.square(s[:top]) / n
    has = var > RANK * var[0]
    return Whitening(n, sums, found[:, has], var[has], total / n, k)


def _inverse(r: np.ndarray) -> np.ndarray:
    """The inverse of an upper triangular matrix; left vectors of no length (zero on the diagonal) stay zero."""
    out = np.zeros_like(r)
    for j in range(len(r)):
        if r[j, j]:
            out[:j, j] = -(out[:j, :j] @ r[:j, j]) / r[j, j]
            out[j, j] = 1 / r[j, j]
    return out


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, component (from 1), deviation (sum over dimensions of (n * x - S)^2, exact), whitened."""
    n, sums, matrix = model.n, model.sums, model.components / np.sqrt(model.variances)
    wide = matrix.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, d in _matrix(batch, n, sums):
                whitened = (d / n) @ matrix
                at = np.repeat(np.arange(len(d)), wide)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(at)), pa.array(np.tile(np.arange(1, wide + 1, dtype=np.int32), len(d))),
                    _squares(d).take(pa.array(at)), pa.array(whitened.ravel())],
                    names=["vec_id", "component", "deviation", "whitened"])

    return rows.mapInArrow(run, WHITENED)


def _squares(d: np.ndarray) -> pa.Array:
    """Exact sums of squares of integer rows; null beyond 64 bits."""
    if np.square(d, dtype=np.float64).sum(axis=1).max(initial=0) < 2.0 ** 62:
        return pa.array(np.square(d).sum(axis=1), pa.int64())
    exact = [sum(int(x) ** 2 for x in row) for row in d]
    return pa.array([x if x < 1 << 63 else None for x in exact], pa.int64())


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of all whitened rows, minus the identity."""
    n, sums, matrix = model.n, model.sums, model.components / np.sqrt(model.variances)
    wide = matrix.shape[1]
    mean = _summed(rows, n, sums, lambda x: (x @ matrix).sum(axis=0), wide) / n

    def products(x):
        y = x @ matrix - mean
        return (y.T @ y).ravel()

    covariance = _summed(rows, n, sums, products, wide * wide).reshape(wide, wide) / n
    return float(np.abs(covariance - np.eye(wide)).max())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every vector that counts."""
    rows, model = fit(integer_vectors(vectors, id_col, vec_col), components)
    if model is None or not len(model.variances):
        schema = WHITENED + ", n long, explained double, identity_error double"
        return rows.sparkSession.createDataFrame([], schema).select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
    share = F.create_map(*[F.lit(x) for i, e in enumerate(model.variances) for x in (i + 1, float(e / model.total))])
    return transform(rows, model).select(
        "vec_id", "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(share, F.col("component")).alias("explained"), F.lit(identity_error(rows, model)).alias("identity_error"))


def op11_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(table_path(sf_dir, "embeddings")))
