"""Whitening of embeddings by blockwise QR, a bidiagonal qd solver and twisted factorisations.

The fit list is each distinct vector once (n vectors, sums S by dimension).

1. Every task reduces its centred rows, block by block, to a triangle R of its
   own (Householder QR); triangles are stacked and reduced eight at a time until
   one is left. ``R'R`` is n times the covariance, which is never formed.
2. Householder reflections from both sides make R upper bidiagonal, ``R = U B V'``.
3. dqds finds the squared singular values of B to high relative accuracy: every
   step is shifted by a proven lower bound of the smallest one.
4. For each wanted value, the twisted factorisation of ``B'B - s`` with the least
   twist element gives its vector in one solve; values closer than 1e-5 of each
   other are solved from several starts and kept at right angles.
5. ``V`` times that vector is a unit eigenvector of the covariance. Rows are
   projected on it and divided by the root of its eigenvalue.

Only triangles and sums, whose size depends on the dimensions alone, reach the
driver; rows are read where they lie.

Defined cases: vectors that are null or hold a null, NaN or infinite component
take no part; shorter ones count as padded with zeros; a null id is kept as
null; repeated rows are whitened each and fitted once; components without
variance (beyond the rank, or all of them where the vectors are equal) have no
rows; a ``deviation`` beyond a long is null; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_marts.llm.common import Scratch, table
from retail_marts.llm.va_file import scaled

COMPONENTS = 4
BLOCK = 4096   # rows of one QR step
FAN = 8        # triangles reduced to one
_EPS = 2.0**-53


def rows_of(col: pa.Array, dims: int) -> np.ndarray:
    """A list column as whole numbers, short rows padded with zeros."""
    size = col.value_lengths().to_numpy(zero_copy_only=False)
    flat = np.asarray(col.flatten(), np.int64)
    out = np.zeros((len(col), dims), np.int64)
    out[np.repeat(np.arange(len(col)), size), np.arange(flat.size) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def triangle(a: np.ndarray) -> np.ndarray:
    return np.linalg.qr(a, mode="r")


# the small dense part -------------------------------------------------------

def _reflector(x: np.ndarray) -> np.ndarray | None:
    """Unit v with (1 - 2vv')x a multiple of the first unit vector; None where x already is one."""
    rest = np.abs(x[1:]).max(initial=0.0)
    if rest == 0.0:
        return None
    v = x / max(abs(x[0]), rest)
    v[0] += np.copysign(np.linalg.norm(v), v[0])
    return v / np.linalg.norm(v)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a and superdiagonal b of B, and V, with r = U B V'."""
    n = r.shape[0]
    m, v = r.copy(), np.eye(n)
    for k in range(n):
        u = _reflector(m[k:, k])
        if u is not None:
            m[k:, k:] -= 2.0 * np.outer(u, u @ m[k:, k:])
        if k + 2 < n:
            w = _reflector(m[k, k + 1:])
            if w is not None:
                m[k:, k + 1:] -= 2.0 * np.outer(m[k:, k + 1:] @ w, w)
                v[:, k + 1:] -= 2.0 * np.outer(v[:, k + 1:] @ w, w)
    return np.diag(m).copy(), np.diag(m, 1).copy(), v


def _qd(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One differential qd step with a shift: the new q and e, and the d of the sweep."""
    d, ds, out, oute = q[0] - shift, [], [], []
    for i in range(len(e)):
        ds.append(d)
        top = d + e[i]
        ratio = q[i + 1] / top if top != 0.0 else 0.0
        out.append(top)
        oute.append(e[i] * ratio)
        d = d * ratio - shift
    ds.append(d)
    out.append(d)
    return out, oute, ds


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of the upper bidiagonal (a, b), falling."""
    found: list[float] = []
    work = [([float(x) ** 2 for x in a], [float(x) ** 2 for x in b], 0.0)]
    while work:
        q, e, total = work.pop()
        while q:
            if len(q) == 1 or e[-1] <= _EPS * _EPS * (total + q[-1]):
                found.append(max(total + q[-1], 0.0))
                q, e = q[:-1], e[:-1]
                continue
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= _EPS * _EPS * (total + min(q[i], q[i + 1])) or e[i] < 1e-300), None)
            if cut is not None:
                work.append((q[:cut + 1], e[:cut], total))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            q, e, d = _qd(q, e, 0.0)
            # the d of an unshifted sweep are the inverse of the inverse's diagonal: one over their sum bounds the least value from below
            least = 0.0 if min(d) <= 0.0 else (1.0 - 1e-12) / sum(1.0 / x for x in d)
            while least > _EPS * total * 1e-3:
                nq, ne, nd = _qd(q, e, least)
                if min(nd) >= 0.0:
                    q, e, total = nq, ne, total + least
                    break
                least /= 4.0  # rounding alone can pass the bound
    return np.sort(np.array(found))[::-1]


def _twisted(a: np.ndarray, b: np.ndarray, value: float) -> tuple[np.ndarray, ...]:
    """Both factorisations of B'B - value and the twist elements gamma."""
    n, tiny = a.size, _EPS * value
    away = lambda x: x if abs(x) > tiny else tiny  # noqa: E731  no pivot is zero
    big, low = a * a, b / a[:-1]
    dp, lp, s = np.zeros(n), np.zeros(n - 1), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        dp[i] = away(s[i] + big[i])
        lp[i] = big[i] * low[i] / dp[i]
        s[i + 1] = lp[i] * low[i] * s[i] - value
    dp[-1] = away(s[-1] + big[-1])
    dm, um, p = np.zeros(n), np.zeros(n - 1), np.zeros(n)
    p[-1] = big[-1] - value
    for i in range(n - 2, -1, -1):
        dm[i + 1] = away(big[i] * low[i] ** 2 + p[i + 1])
        t = big[i] / dm[i + 1]
        um[i] = low[i] * t
        p[i] = p[i + 1] * t - value
    return dp, lp, um, s + p + value


def _beside(z: np.ndarray, near: list[np.ndarray], dp: np.ndarray, lp: np.ndarray, start: np.random.Generator) -> np.ndarray:
    """A vector of the value's cluster at right angles to ``near``, by inverse iteration from other starts where ``z`` has none."""
    basis = np.linalg.qr(np.stack(near, axis=1))[0].T
    for _ in range(40):
        for _ in range(2):
            z = z - basis.T @ (basis @ z)
        if np.linalg.norm(z) > 0.1:
            break
        z = start.standard_normal(z.size)
        for _ in range(2):
            z = z - basis.T @ (basis @ z)
            for x in range(z.size - 1):
                z[x + 1] -= lp[x] * z[x]
            z /= dp
            for x in range(z.size - 2, -1, -1):
                z[x] -= lp[x] * z[x + 1]
            z /= np.linalg.norm(z)
    z = z / np.linalg.norm(z)
    return z - basis.T @ (basis @ z)


def vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of B'B for falling ``values``, one column each."""
    n = a.size
    floor = np.abs(np.concatenate([a, b])).max() * _EPS * 1e-4
    a = np.where(np.abs(a) < floor, floor, a)
    out, start = np.zeros((n, values.size)), np.random.default_rng(7)
    # B falls apart where b is nothing beside its neighbours: a vector lives in one part
    whole = np.abs(np.concatenate([a, b])).max()
    cut = [0, *[i + 1 for i in range(n - 1) if abs(b[i]) <= 4.0 * _EPS * whole], n]
    parts = [(i, j, dqds(a[i:j], b[i:j - 1])) for i, j in zip(cut[:-1], cut[1:])]
    used = [0] * len(parts)
    for k, value in enumerate(values):
        # the part whose next unused value is the greatest holds this one
        at = max((x for x in range(len(parts)) if used[x] < len(parts[x][2])), key=lambda x: parts[x][2][used[x]])
        i, j, own = parts[at]
        used[at] += 1
        if j - i == 1:
            out[i, k] = 1.0
            continue
        dp, lp, um, gamma = _twisted(a[i:j], b[i:j - 1], own[used[at] - 1])
        r = int(np.abs(gamma).argmin())
        z = np.zeros(j - i)
        z[r] = 1.0
        for x in range(r - 1, -1, -1):
            z[x] = -lp[x] * z[x + 1]
        for x in range(r, j - i - 1):
            z[x + 1] = -um[x] * z[x]
        near = [out[i:j, c] for c in range(k) if out[i:j, c].any() and abs(values[c] - value) <= 1e-5 * values[c]]
        if near:
            z = _beside(z / np.linalg.norm(z), near, dp, lp, start)
        out[i:j, k] = z / np.linalg.norm(z)
    return out


# the distributed part -------------------------------------------------------

@dataclass
class Whitening:
    """``directions``: one column per component; ``values``: eigenvalues; ``explained``: their shares."""

    n: int
    sums: list[int]
    mean: np.ndarray
    directions: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.directions / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact."""
        most = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        if most * most * max(len(self.sums), 1) < 2**63:
            y = self.n * x - np.array(self.sums, np.int64)
            return (y * y).sum(axis=1).tolist()
        exact = [sum((self.n * int(v) - s) ** 2 for v, s in zip(row, self.sums)) for row in x]
        return [v if v < 2**63 else None for v in exact]


def fit(x: DataFrame, scratch: Scratch, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a table of distinct vectors, column ``x`` (array<long>)."""
    sums = (x.select(F.posexplode("x").alias("i", "v")).groupBy("i")
            .agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).orderBy("i").collect())  # one row a dimension
    n, dims = x.count(), len(sums)
    if not n or not dims:
        return None
    total = [int(r["s"]) for r in sums]
    mean = np.array([float(Fraction(s, n)) for s in total])

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                rows = rows_of(b.column("x").slice(at, BLOCK), dims) - mean
                r = triangle(rows if r is None else np.concatenate([r, rows]))
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()])], names=["part", "r"])

    def stack(pdf: pd.DataFrame) -> pd.DataFrame:
        r = triangle(np.concatenate([np.frombuffer(x).reshape(-1, dims) for x in pdf.sort_values("part")["r"]]))
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0]) // FAN], "r": [r.tobytes()]})

    rs = scratch.put(x.mapInArrow(reduce_rows, "part long, r binary"), "triangles")
    while rs.agg(F.max("part")).first()[0] >= FAN:
        smaller = scratch.put(rs.groupBy(F.floor(F.col("part") / FAN)).applyInPandas(stack, "part long, r binary"), "triangles")
        scratch.drop(rs)
        rs = smaller
    last = triangle(np.concatenate([np.frombuffer(t["r"]).reshape(-1, dims) for t in rs.orderBy("part").collect()]))  # FAN triangles at most
    scratch.drop(rs)
    r = np.zeros((dims, dims))
    r[:last.shape[0]] = last
    scale = np.abs(r).max()
    if scale == 0.0:
        return None
    a, b, v = bidiagonal(r / scale)
    squared = dqds(a, b)
    some = squared[:components]
    some = some[some > squared[0] * dims * dims * _EPS * _EPS]
    return Whitening(n, total, mean, v @ vectors(a, b, some), some * scale * scale / n, some / squared.sum())


def identity_error(x: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    dims, k = model.mean.size, model.values.size

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                z = model.project(rows_of(b.column("x").slice(at, BLOCK), dims))
                first += z.sum(axis=0)
                second += z.T @ z
        flat = np.concatenate([first, second.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(flat.size)), pa.array(flat)], names=["i", "v"])

    got = {r["i"]: r["v"] for r in x.mapInArrow(moments, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()}
    m = np.array([got[i] for i in range(k)]) / model.n
    second = np.array([got[k + i] for i in range(k * k)]).reshape(k, k) / model.n
    return float(np.abs(second - np.outer(m, m) - np.eye(k)).max())


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors_: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per vector and component."""
    spark = vectors_.sparkSession
    scratch = Scratch(spark, "whitening")
    rows = vectors_.select(F.col(id_col).cast("long").alias("vec_id"), scaled(F.col(vec_col)).alias("x")).where("x IS NOT NULL")
    list_ = scratch.put(rows.select("x").distinct(), "fit")
    model = fit(list_, scratch, components)
    if model is None:
        scratch.close()
        return spark.createDataFrame([], _OUT)
    error, dims, k = identity_error(list_, model), model.mean.size, model.values.size
    scratch.close()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                b = whole.slice(at, BLOCK)
                x = rows_of(b.column("x"), dims)
                each = np.repeat(np.arange(b.num_rows), k)
                far = pa.array(model.deviation(x), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), b.num_rows)),
                     pa.array(np.full(each.size, model.n)), far.take(pa.array(each)), pa.array(model.project(x).ravel()),
                     pa.array(np.tile(model.explained, b.num_rows)), pa.array(np.full(each.size, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, _OUT)


def op12_qd_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's first 4 whitened components."""
    return whiten(table(spark, sf_dir, "embeddings"))
