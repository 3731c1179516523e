"""Whitening of embeddings: incremental eigendecomposition, spectra combined by rank-one updates, Rayleigh-Ritz refinement."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duolog.sources.scratch import materialize

#: Summaries that one task combines.
FAN_IN = 16
#: Rows handled at once by matrix products.
ROWS = 4096
_EPS = np.finfo(float).eps


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(d) + rho z z' for increasing distinct d, rho > 0 and z without zeros: the roots of
    1 + rho * sum(z_j^2 / (d_j - x)), one between each two of d and one above. Returns them and the matrix d_j - root_k, which is
    exact to a few units in the last place as each root is sought as an offset from the nearer pole.

    Each step fits one pole at either side of a root to value and slope of the two halves of the sum; a step that leaves the
    bracket is replaced by its middle."""
    m = len(d)
    weight = rho * z * z
    upper = np.append(d[1:], d[-1] + weight.sum() * (1 + 4 * _EPS))
    width = upper - d
    own = np.arange(m)
    below = (own[:, None] <= own[None, :]).astype(float)  # poles up to a root's lower one
    above = 1.0 - below
    gaps = d[:, None] - d[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        middle = 1 + (weight[:, None] / (gaps - width / 2)).sum(0)
    from_upper = (middle < 0) & (own < m - 1)  # the root lies in the upper half
    gaps = np.where(from_upper, d[:, None] - upper, gaps)
    lo = np.where(from_upper, -width / 2, 0.0)
    hi = np.where(from_upper, 0.0, np.where((middle < 0) | (own == m - 1), width, width / 2))
    lo = np.where((own == m - 1) & (middle < 0), width / 2, lo)
    hi = np.where((own == m - 1) & (middle >= 0), width / 2, hi)
    to_lower = np.where(from_upper, -width, 0.0)
    to_upper = to_lower + width
    tau, done = (lo + hi) / 2, np.zeros(m, bool)
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        for _ in range(100):
            away = gaps - tau
            terms = weight[:, None] / away
            slopes = terms / away
            left, right, slope_left, slope_right = (np.einsum("jk,jk->k", x, side) for x in (terms, slopes) for side in (below, above))
            f = 1 + left + right
            lo, hi = np.where(f < 0, tau, lo), np.where(f >= 0, tau, hi)
            done |= (np.abs(f) <= (m + 8) * _EPS * (1 + np.abs(left) + np.abs(right))) | (hi - lo <= 2 * _EPS * np.maximum(np.abs(lo), np.abs(hi)))
            if done.all():
                break
            a, b = to_lower - tau, to_upper - tau
            c = f - a * slope_left - b * slope_right
            p, q = (a + b) * f - a * b * (slope_left + slope_right), a * b * f
            root = np.sqrt(np.maximum(p * p - 4 * q * c, 0.0))
            step = np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
            new = tau + step
            tau = np.where(done, tau, np.where(np.isfinite(new) & (new > lo) & (new < hi), new, (lo + hi) / 2))
    return np.where(from_upper, upper, d) + tau, gaps - tau


class Spectrum:
    """Count, mean and eigendecomposition of the scatter matrix (sum of centred outer products) of vectors seen so far."""

    def __init__(self, size: int):
        self.n, self.mean = 0, np.zeros(size)
        self.values, self.vectors = np.zeros(size), np.eye(size)  # values rise

    def add(self, x: np.ndarray) -> None:
        """One vector more: a rank-one update by its distance from the mean."""
        away = x - self.mean
        self.update(away, self.n / (self.n + 1))
        self.n += 1
        self.mean += away / self.n

    def merge(self, other: Spectrum) -> None:
        """The vectors of other as well: its eigenpairs and the distance of the means, one rank-one update each."""
        if not other.n:
            return
        away, n = other.mean - self.mean, self.n + other.n
        for k in np.flatnonzero(other.values > 0):
            self.update(other.vectors[:, k], other.values[k])
        self.update(away, self.n * other.n / n)
        self.mean += away * (other.n / n)
        self.n = n

    def update(self, v: np.ndarray, rho: float) -> None:
        """Scatter matrix plus rho v v'. Directions that v does not touch, and all but one of each set of equal eigenvalues (after a
        rotation among them), stay as they are; the rest follow from the secular equation."""
        z = self.vectors.T @ v
        norm = z @ z
        if not rho * norm > 0:
            return
        z, rho = z / np.sqrt(norm), rho * norm
        d, vectors = self.values, self.vectors
        small = 8 * _EPS * max(d[-1], rho)
        live = np.flatnonzero(rho * np.abs(z) > small)
        if (np.diff(d[live]) * 0.5 <= small).any():  # maybe equal values
            kept = []
            for k in live.tolist():
                if kept:
                    j = kept[-1]
                    r = np.hypot(z[j], z[k])
                    c, s = z[k] / r, z[j] / r
                    if abs((d[k] - d[j]) * c * s) <= small:
                        a, b = vectors[:, j].copy(), vectors[:, k].copy()
                        vectors[:, j], vectors[:, k] = c * a - s * b, s * a + c * b
                        d[j], d[k] = d[j] * c * c + d[k] * s * s, d[j] * s * s + d[k] * c * c
                        z[j], z[k] = 0.0, r
                        kept.pop()
                kept.append(k)
            live = np.array([k for k in kept if rho * abs(z[k]) > small], np.int64)
            live = live[np.argsort(d[live], kind="stable")]
        if not len(live):
            return
        poles, weight = d[live], z[live]
        roots, away = secular_roots(poles, weight, rho)
        # the weights for which these roots are exact, so that the eigenvectors are orthogonal
        ratio = poles[:, None] - poles[None, :]
        np.fill_diagonal(ratio, 1.0)
        ratio = np.where(np.eye(len(live), dtype=bool), away, away / ratio)
        fitted = np.sqrt(np.abs(np.prod(ratio, axis=1))) * np.sign(weight)
        turn = fitted[:, None] / away
        turn /= np.sqrt((turn * turn).sum(0))
        d[live], vectors[:, live] = roots, vectors[:, live] @ turn
        order = np.argsort(d, kind="stable")
        self.values, self.vectors = d[order], vectors[:, order]

    def packed(self) -> bytes:
        return np.concatenate([[float(self.n)], self.mean, self.values, self.vectors.ravel()]).tobytes()

    @classmethod
    def unpacked(cls, raw: bytes) -> Spectrum:
        flat = np.frombuffer(raw).copy()
        size = round((len(flat) - 1 + 1) ** 0.5) - 1  # size^2 + 2 size + 1 numbers
        out = cls(size)
        out.n, out.mean, out.values = int(flat[0]), flat[1 : size + 1], flat[size + 1 : 2 * size + 1]
        out.vectors = flat[2 * size + 1 :].reshape(size, size)
        return out


def _merged_spectra(parts: list[bytes]) -> bytes:
    first = Spectrum.unpacked(parts[0])
    for raw in parts[1:]:
        first.merge(Spectrum.unpacked(raw))
    return first.packed()


def _added(parts: list[bytes]) -> bytes:
    return np.sum([np.frombuffer(p) for p in parts], axis=0).tobytes()


def _folded(parts: DataFrame, combine) -> bytes | None:
    """parts (place long, raw binary; places are the numbers of the tasks) combined in the order of their places, FAN_IN at a time in a task, until one is left:
    the only value that reaches the driver. None without parts."""
    parts, width = materialize(parts), FAN_IN
    while parts.count() > 1:

        def fold(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("place")
            return pd.DataFrame({"place": [int(rows["place"].iloc[0])], "raw": [combine(rows["raw"].tolist())]})

        group = F.floor(F.col("place") / width).cast("long")
        parts = materialize(parts.groupBy(group.alias("_g")).applyInPandas(fold, "place long, raw binary"))
        width *= FAN_IN
    row = parts.select("raw").first()
    return None if row is None else bytes(row.raw)


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows of a matrix of 64-bit integers."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _per_task(rows: DataFrame, start, step, finish) -> DataFrame:
    """One summary a task of rows (x): start(size) -> state, step(state, matrix), finish(state) -> numbers."""

    def run(batches):
        state, place = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                x = _matrix(some.column("x"))
                if state is None:
                    state, place = start(x.shape[1]), some.column("place")[0].as_py()
                state = step(state, x)
        if state is not None:
            yield pa.record_batch([pa.array([place], pa.int64()), pa.array([finish(state)], pa.binary())], ["place", "raw"])

    return rows.select("x", F.spark_partition_id().cast("long").alias("place")).mapInArrow(run, "place long, raw binary")


class Whitening:
    """n, S (sums of each dimension, Python integers), eigenvalues (falling) and unit eigenvectors (columns) of the covariance, its trace."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray, trace: float, identity_error: float):
        self.n, self.sums, self.values, self.vectors, self.trace, self.identity_error = n, sums, values, vectors, trace, identity_error


def _summaries(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and exact sums of each dimension: one small row an index."""
    n = fit.count()
    sums = fit.select(F.posexplode("x").alias("k", "v")).groupBy("k").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).collect()  # a row a dimension
    out = [0] * len(sums)
    for r in sums:
        out[r.k] = int(r.s)
    return n, out


def fitted(fit: DataFrame, components: int = 4, passes: int = 8) -> Whitening | None:
    """The whitening of the distinct vectors fit (x array<long>, stored); None without any.

    Every task keeps a `Spectrum` of its vectors, updated one by one; spectra are combined in a tree. Its basis is refined by
    Rayleigh-Ritz steps: the covariance within the basis is summed anew over all vectors, centred before multiplying, and its
    eigenvectors turn the basis, until the residual of the wanted components is within rounding (one step, unless rounding was bad). What
    reaches the driver is one matrix of the size of the dimensions squared."""
    raw = _folded(_per_task(fit, Spectrum, _add_all, lambda s: s.packed()), _merged_spectra)
    if raw is None:
        return None
    n, sums = _summaries(fit)
    mean = np.array([s / n for s in sums])
    basis = np.linalg.qr(Spectrum.unpacked(raw).vectors[:, ::-1])[0]
    for _ in range(passes):
        size = basis.shape[1]
        start = lambda d: np.zeros((size, size))  # noqa: B023, E731
        step = lambda state, x: state + (y := (x - mean) @ basis).T @ y  # noqa: B023, E731
        within = np.frombuffer(_folded(_per_task(fit, start, step, lambda s: s.tobytes()), _added)).reshape(size, size) / n
        values, turn = np.linalg.eigh((within + within.T) / 2)
        basis = np.linalg.qr(basis @ turn[:, ::-1])[0]
        values = values[::-1]
        rest = within - np.diag(np.diag(within))
        if np.abs(rest).max(initial=0.0) <= 64 * size * _EPS * max(float(values[0]), 0.0):
            break
    trace = float(np.trace(within))
    basis *= np.where(basis[np.abs(basis).argmax(0), np.arange(basis.shape[1])] < 0, -1.0, 1.0)
    keep = min(components, len(values))
    values, vectors = values[:keep].copy(), basis[:, :keep]
    values[values <= len(mean) * _EPS * max(trace, 0.0)] = 0.0
    model = Whitening(n, sums, values, vectors, trace, 0.0)
    project, used = _projection(model), np.flatnonzero(values > 0)
    if len(used):
        start = lambda d: np.zeros((1 + keep, keep))
        step = lambda state, x: state + np.vstack([(w := project(x)).sum(0), w.T @ w])
        total = np.frombuffer(_folded(_per_task(fit, start, step, lambda s: s.tobytes()), _added)).reshape(1 + keep, keep) / n
        covariance = total[1:] - np.outer(total[0], total[0])
        model.identity_error = float(np.abs(covariance - np.eye(keep))[np.ix_(used, used)].max())
    return model


def _add_all(state: Spectrum, x: np.ndarray) -> Spectrum:
    for row in x.astype(float):
        state.add(row)
    return state


def _projection(model: Whitening):
    mean = np.array([s / model.n for s in model.sums])
    scale = np.divide(1.0, np.sqrt(model.values), out=np.zeros_like(model.values), where=model.values > 0)
    return lambda x: ((x - mean) @ model.vectors) * scale


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2, exact; None where it does not fit into 64 bits."""
    most = max((abs(n * int(v) - s) for low, high, s in zip(x.min(0).tolist(), x.max(0).tolist(), sums) for v in (low, high)), default=0) if len(x) else 0
    if most * most * max(1, len(sums)) < 2**63:
        away = n * x - np.array(sums, np.int64)
        return (away * away).sum(1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [v if v < 2**63 else None for v in exact]


def quantised(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, embedding) -> vec_id, x array<long>: floor(scale * c) of each entry as double. Rows with a null vector, null or
    non-finite entries or none at all go, and so do those of another length than most rows have (the longest of equally frequent ones)."""
    plain = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda c: c.cast("double")).alias("c"))
    good = plain.where("c is not null and size(c) > 0 and forall(c, v -> v is not null and not isnan(v) and abs(v) < double('infinity'))")
    lengths = good.groupBy(F.size("c").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    rows = good.where(F.size("c") == F.lit(0 if lengths is None else lengths["size"]))
    return rows.select("vec_id", F.transform("c", lambda v: F.floor(v * F.lit(float(scale))).cast("long")).alias("x"))


def whitened(embeddings: DataFrame, components: int = 4, scale: int = 256) -> DataFrame:
    """(vec_id, embedding) -> vec_id, component (from 1), n, deviation, whitened, explained, identity_error, one row per remaining
    row and component; see `quantised` for rows that go, `fitted` for the fit over the distinct vectors.

    `deviation` is the exact squared distance from the mean times n, null where it exceeds 64 bits; `whitened` the projection on the component over the
    root of its eigenvalue; `explained` the eigenvalue's part of the trace; `identity_error` the largest error of the whitened
    covariance. Components without variance (fewer distinct vectors than components) are whitened to 0 and explain 0. There are no more components than
    dimensions. Repeated rows and null ids each get their rows. No remaining rows: none are returned. Only vec_id and embedding are read."""
    rows = materialize(quantised(embeddings, scale))
    fit = materialize(rows.select("x").distinct())
    model = fitted(fit, components)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return rows.limit(0).selectExpr(*[f"cast(null as {kind}) as {name}" for name, kind in (c.split() for c in schema.split(", "))])
    share = (model.values / model.trace if model.trace > 0 else np.zeros_like(model.values)).tolist()

    def project(batches):
        apply, keep = _projection(model), len(model.values)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                x = _matrix(some.column("x"))
                each = np.repeat(np.arange(len(x)), keep)
                far = deviations(x, model.n, model.sums)
                columns = [
                    some.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, keep + 1, dtype=np.int32), len(x))), pa.array(np.full(len(each), model.n, np.int64)),
                    pa.array([far[k] for k in each.tolist()], pa.int64()), pa.array(apply(x).ravel()), pa.array(share * len(x), pa.float64()), pa.array(np.full(len(each), model.identity_error)),
                ]
                yield pa.record_batch(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema)
