"""Embedding whitening by spectrum slicing.

Spark adds up the exact integer sums of the vectors, then the covariance of the
centred vectors (one partial matrix a task). On the driver, which holds that
matrix of dimension x dimension numbers only, an LDL' factorisation of the
covariance minus a shift counts the eigenvalues above the shift (inertia).
Bisection by these counts isolates each leading eigenvalue, Rayleigh quotient
iteration refines it, and counts on both sides of the result certify its number.
A last pass projects every vector, and the whitened covariance is measured.

Defined results: a row whose vector is null, empty, or holds a null, non-finite
or out-of-range entry (scaled beyond 2**52) is left out, and so is one whose
length is not the most frequent (the longest of several). Repeated rows count
each; a null id stays null. Fewer dimensions than components give fewer rows. A
component without variance (under rounding) has null ``whitened``, and null
``explained`` if no component has any; equal eigenvalues share their space in
any orthonormal basis. A deviation beyond the range of the output's type is
null. An empty table gives no rows. Only id and vector are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.llm.common import stage, table

COMPONENTS = 8
#: An entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
_EPS = np.finfo(float).eps


# ------------------------------------------------------------------ the spectrum

def count_above(v: np.ndarray, shift: float) -> int:
    """Eigenvalues of the symmetric ``v`` above ``shift``: positive pivots of LDL' with complete
    pivoting (1 x 1, or 2 x 2 where the diagonal is small: one pivot of either sign)."""
    a, n = v - shift * np.eye(len(v)), 0
    least = _EPS * np.abs(a).max(initial=0.0)  # what is left below this is rounding: eigenvalues at the shift
    while len(a):
        own, off = np.abs(a.diagonal()), np.abs(a)
        np.fill_diagonal(off, 0)
        r, (p, q) = int(own.argmax()), np.unravel_index(int(off.argmax()), off.shape)
        if own[r] <= least and off[p, q] <= least:
            break
        if own[r] >= (1 + 17 ** 0.5) / 8 * off[p, q]:
            n += a[r, r] > 0
            pivots = [r]
            a = a - np.outer(a[:, r] / a[r, r], a[r])
        else:
            n += 1
            pivots = [p, q]
            (x, y), (_, z) = a[np.ix_(pivots, pivots)]
            inverse = np.array([[z, -y], [-y, x]]) / (x * z - y * y)  # x z is far below y y
            a = a - a[:, pivots] @ inverse @ a[pivots]
        rest = np.delete(np.arange(len(a)), pivots)
        a = a[np.ix_(rest, rest)]
        a = (a + a.T) / 2
    return int(n)


class Slices:
    """Known counts of eigenvalues above shifts; every count narrows all components at once."""

    def __init__(self, v: np.ndarray):
        self.v, self.norm = v, float(np.abs(v).sum(axis=1).max())
        self.counts = {-2 * self.norm: len(v), 2 * self.norm: 0}

    def count(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = count_above(self.v, shift)
        return self.counts[shift]

    def bounds(self, i: int) -> tuple[float, float]:
        """The tightest known (low, high) around eigenvalue number i."""
        return max(s for s, n in self.counts.items() if n >= i), min(s for s, n in self.counts.items() if n < i)


def _solved(v: np.ndarray, shift: float, x: np.ndarray, found: list, norm: float) -> np.ndarray:
    """One step of inverse iteration, orthogonal to the vectors found, of length one."""
    for nudge in (0.0, _EPS, 16 * _EPS):
        try:
            y = np.linalg.solve(v - (shift + nudge * norm) * np.eye(len(v)), x)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(y).all() and np.abs(y).max() > 0:
            y = y / np.abs(y).max()
            for _ in range(2):
                for f in found:
                    y = y - (f @ y) * f
            return y / np.linalg.norm(y)
    return x


def leading(v: np.ndarray, k: int) -> list[tuple[float, np.ndarray, float]]:
    """(eigenvalue, unit vector, certified bound of the eigenvalue's error) of the ``k`` largest, falling."""
    v = (v + v.T) / 2
    s, out = Slices(v), []
    if s.norm == 0:
        return [(0.0, e, 0.0) for e in np.eye(len(v))[:k]]
    least = 4 * len(v) * _EPS * s.norm
    for i in range(1, min(k, len(v)) + 1):
        while True:
            low, high = s.bounds(i)
            mid = (low + high) / 2
            alone = s.counts[low] == i and s.counts[high] == i - 1
            if not alone and high - low > least:
                s.count(mid)
                continue
            # Vectors found stay apart by themselves, except those of (nearly) the same eigenvalue.
            close = [x for e, x, _ in out if abs(e - mid) <= (high - low) + 1e-6 * s.norm]
            x = np.random.default_rng(i).standard_normal(len(v))
            for _ in range(3):
                x = _solved(v, mid, x, close, s.norm)
            best, last, slow = np.inf, None, 0
            while slow < 4 and best > _EPS * s.norm:  # cubic once it is near: a few steps do
                rho = float(x @ v @ x)
                error = np.linalg.norm(v @ x - rho * x)
                slow += error > best / 2
                if error < best:
                    best, last = error, (rho, x)
                x = _solved(v, rho, x, close, s.norm)
            rho, x = last
            # Well inside: an eigenvalue at a bound may be the neighbour's.
            near = low + least < rho < high - least and best <= 16 * least
            if near or high - low <= least:
                break
            s.count(mid)
        bound = least
        while not (s.count(rho - bound) >= i > s.count(rho + bound)):
            bound *= 2
        out.append((rho, x * np.sign(x[np.abs(x).argmax()]), bound))
    return out


# ------------------------------------------------------------------ the passes

@dataclass
class Whitening:
    """A fitted list: vectors counted, their sums, leading components, trace of the covariance."""

    n: int
    sums: np.ndarray
    components: list[tuple[float, np.ndarray, float]]
    trace: float

    @property
    def dim(self) -> int:
        return len(self.sums)

    def live(self) -> np.ndarray:
        """Which components have variance beyond rounding."""
        e = np.array([c[0] for c in self.components])
        return e > 64 * self.dim * _EPS * max([0.0, *e])


def _integers(column: pa.Array, dim: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(usable rows, their lengths, their integers one after the other) of an array column."""
    values = column.flatten()
    n = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)), 0).astype(np.int64)
    whole = np.floor(SCALE * values.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float))  # a null is not finite either
    fine = np.abs(whole) < 2.0 ** 52
    upto = np.concatenate([[0], np.cumsum(fine)])[np.concatenate([[0], np.cumsum(n)])]
    ok = (n > 0) & (np.diff(upto) == n) & ((n == dim) | (dim is None))
    return ok, n[ok], whole[np.repeat(ok, n)].astype(np.int64) + OFFSET


def _vectors(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    return df.select(F.col(id_column).alias("id"), F.col(vector).cast("array<double>").alias("v"))


def _dimension(rows: DataFrame) -> int:
    def run(batches):
        for b in batches:
            lens, n = np.unique(_integers(b.column("v"), None)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(lens, pa.int64()), pa.array(n, pa.int64())], names=["dim", "n"])

    top = (rows.select("v").mapInArrow(run, "dim long, n long").groupBy("dim").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), F.desc("dim")).first())
    return top["dim"] if top else 0


def fit(vectors: DataFrame, id_column: str, vector: str, k: int = COMPONENTS) -> Whitening:
    """Exact sums, covariance and leading components of all usable vectors."""
    rows = _vectors(vectors, id_column, vector)
    dim = _dimension(rows)

    def sums(batches):
        n, total = 0, np.zeros(dim, np.int64)
        for b in batches:
            x = _integers(b.column("v"), dim)[2].reshape(-1, dim)
            n, total = n + len(x), total + x.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(dim, n), pa.int64()), pa.array(np.arange(dim), pa.int32()), pa.array(total, pa.int64())],
                                         names=["n", "i", "s"])

    if not dim:
        return Whitening(0, np.zeros(0, object), [], 0.0)
    got = (rows.select("v").mapInArrow(sums, "n long, i int, s long").groupBy("i")
           .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect())
    n, total = got[0]["n"], np.array([int(r["s"]) for r in got], object)
    mean = np.array([float(s / n) for s in total])

    def products(batches):
        gram = np.zeros((dim, dim))
        for b in batches:
            x = _integers(b.column("v"), dim)[2].reshape(-1, dim) - mean
            gram += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim), pa.int32()), pa.array(list(gram), pa.list_(pa.float64()))], names=["i", "g"])

    parts = rows.select("v").mapInArrow(products, "i int, g array<double>").select("i", F.posexplode("g").alias("j", "g"))
    v = np.zeros((dim, dim))
    for r in parts.groupBy("i", "j").agg(F.sum("g").alias("g")).collect():
        v[r["i"], r["j"]] = r["g"] / n
    return Whitening(n, total, leading(v, k), float(v.trace()))


def project(vectors: DataFrame, id_column: str, vector: str, model: Whitening) -> DataFrame:
    """(id, deviation, whitened) of every usable row; ``deviation`` is exact, up to 38 digits."""
    dim, n, mean = model.dim, model.n, np.array([float(s / model.n) for s in model.sums]) if model.n else np.zeros(0)
    sums, live = model.sums, model.live()
    basis = np.array([c[1] / np.sqrt(c[0]) for c, ok in zip(model.components, live) if ok]).reshape(int(live.sum()), dim).T
    kind = pa.decimal128(38, 0)

    def run(batches):
        for b in batches:
            ok, _, flat = _integers(b.column("v"), dim)
            x = flat.reshape(-1, dim) if dim else np.zeros((0, 0), np.int64)
            if not len(x):
                continue
            far = n * max(abs(int(x.max())), abs(int(x.min()))) + max(abs(s) for s in sums)
            if far < 1 << 62 and int(np.abs(d := n * x - sums.astype(np.int64)).max()) ** 2 * dim < 1 << 63:
                deviation = pa.array((d * d).sum(axis=1), pa.int64()).cast(kind)
            else:  # integers of any size
                d = x.astype(object) * n - sums
                deviation = pa.array([y if y < 10 ** 38 else None for y in (d * d).sum(axis=1)], kind)
            w = np.full((len(x), len(live)), np.nan)
            w[:, live] = (x - mean) @ basis
            yield pa.RecordBatch.from_arrays([b.column("id").filter(pa.array(ok)), deviation, pa.array(list(w), pa.list_(pa.float64()))],
                                             names=["id", "deviation", "w"])

    rows = _vectors(vectors, id_column, vector)
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, deviation decimal(38,0), w array<double>")


def identity_error(whitened: DataFrame, live: np.ndarray) -> float | None:
    """Largest absolute entry of the covariance of the whitened components minus the identity."""
    at = np.flatnonzero(live).tolist()
    if not at:
        return None
    mean = whitened.agg(*[F.avg(F.col("w")[i]).alias(f"m{i}") for i in at]).first()
    if mean[0] is None:
        return None
    centred = {i: F.col("w")[i] - F.lit(m) for i, m in zip(at, mean)}
    cov = whitened.agg(*[F.avg(centred[i] * centred[j]) for i in at for j in at if i <= j]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(cov, [(i, j) for i in at for j in at if i <= j]))


def whiten(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row for each usable vector and component."""
    model = fit(vectors, id_column, vector, k)
    rows = stage(project(vectors, id_column, vector, model), "whitened")
    error = identity_error(rows, model.live())
    explained = [max(0.0, e / model.trace) if model.trace else None for e, _, _ in model.components]
    out = rows.select("id", "deviation", F.posexplode("w").alias("at", "w"))
    share = F.array(*[F.lit(e).cast("double") for e in explained]) if explained else F.array().cast("array<double>")
    return out.select(F.col("id").alias(id_column), (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                      F.when(~F.isnan("w"), F.col("w")).alias("whitened"), share[F.col("at")].alias("explained"),
                      F.lit(error).cast("double").alias("identity_error"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
