"""Operator 11: whitening of embeddings by eigenvectors refined beyond working precision.

Sums and the covariance are gathered exactly, in whole numbers, by Spark. Only
a matrix of the vectors' dimension reaches the driver: its float32
eigenvectors are corrected by the iteration of Ogita and Aishima, which needs
matrix products alone, and each correction about squares the error. Groups of
eigenvalues too close for it are solved once more by themselves, shifted to
their mean, so that their differences count in full.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries become whole numbers: floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Components returned at most.
COMPONENTS = 32
#: Whole numbers beyond this are held at it, far outside of any embedding.
LIMIT = 2.0**52
#: Rows multiplied at once; with entries below ``SMALL`` all sums of products fit a double exactly.
ROWS, SMALL = 2048, 2.0**20
#: Rounds of correction at most; each about squares the error, so that a handful serves.

ROUNDS = 60

High = np.longdouble


@dataclass(frozen=True)
class Whitening:
    """What whitens a vector: ``n`` vectors fitted, their sums, and components by falling eigenvalue.

    ``whole`` is the nearest whole number to each mean, ``rest`` the mean less
    that, times ``n``: both exact.
    """

    n: int
    sums: list[int]
    whole: list[int]
    rest: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace


def clean(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector has entries, none of them NULL, NaN or infinite."""
    bad = F.exists(F.col(vector).cast("array<double>"), lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return df.where((F.size(vector) > 0) & ~bad)


def _numbers(df: DataFrame, vector: str, *others: str) -> DataFrame:
    return df.select(F.col(vector).cast("array<double>").alias("_v"), *others)


def _blocks(batches, dim: int | None = None):
    """Of each slice of the rows with one length: the whole numbers less OFFSET, as doubles, and the rows' places."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("_v"))
        sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int32)
        flat = np.clip(np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False)), -LIMIT, LIMIT)
        start = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        for d in np.unique(sizes) if dim is None else [dim]:
            at = np.flatnonzero(sizes == d)
            for i in range(0, len(at), ROWS):
                some = at[i : i + ROWS]
                yield batch, some, flat[start[some][:, None] + np.arange(d)]


def _whole_sum(x: np.ndarray) -> np.ndarray:
    """Exact column sums, as Python numbers."""
    x = x.astype(np.int64)
    return x.sum(0).astype(object) if not len(x) or np.abs(x).max() < 2**40 else x.astype(object).sum(0)


def _sums(batches):
    total: dict[int, list] = {}
    for _, some, x in _blocks(batches):
        known = total.setdefault(x.shape[1], [0, np.zeros(x.shape[1], object)])
        known[0] += len(some)
        known[1] = known[1] + _whole_sum(x)
    for d, (n, s) in total.items():
        yield pa.RecordBatch.from_pydict({"dim": pa.array([d] * d, pa.int32()), "j": pa.array(range(d), pa.int32()), "n": pa.array([n] * d, pa.int64()), "s": _decimals(s)})


def _decimals(values) -> pa.Array:
    from decimal import Decimal

    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def _gram(x: np.ndarray) -> np.ndarray:
    """Exact products of all pairs of columns, as Python numbers."""
    small = (np.abs(x) < SMALL).all(1)
    out = (x[small].T @ x[small]).astype(np.int64).astype(object)
    if not small.all():
        large = x[~small].astype(np.int64).astype(object)
        out = out + large.T @ large
    return out


def _pairs(dim: int, values: np.ndarray, kind) -> pa.RecordBatch:
    i, j = np.triu_indices(dim)
    return pa.RecordBatch.from_pydict({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "v": kind(values[i, j])})


def covariance(df: DataFrame, vector: str, dim: int, n: int, whole: list[int], rest: list[int]) -> np.ndarray:
    """The covariance over all rows, divisor n, beyond double precision.

    Rows are centred by the whole mean before they are multiplied, which loses
    nothing; what the mean has beyond it is one product, taken off the exact
    totals. One row per pair of dimensions leaves each task and reaches the
    driver, which depends on the dimension alone.
    """
    centre = np.array(whole, float) - OFFSET

    def products(batches):
        total = np.zeros((dim, dim), object)
        for _, _, x in _blocks(batches, dim):
            total = total + _gram(x - centre)
        yield _pairs(dim, total, _decimals)

    rows = _numbers(df, vector).mapInArrow(products, "i int, j int, v decimal(38,0)")
    high = np.zeros((dim, dim), High)
    for r in rows.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        exact = n * int(r.v) - rest[r.i] * rest[r.j]
        high[r.i, r.j] = high[r.j, r.i] = _high(exact) / (High(n) * High(n))
    return high


def _high(v: int) -> np.longdouble:
    near = float(v)
    return High(near) + High(float(v - int(near)))


def refine(a: np.ndarray, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of a symmetric matrix to the precision of ``np.longdouble``.

    ``start`` are rough eigenvectors; without them those of float32 serve.
    Converges within a few rounds, as the error about squares in each; ends
    when a round changes nothing that the format can hold.
    """
    a = np.asarray(a, High)
    d = len(a)
    eye, tiny = np.eye(d, dtype=High), np.finfo(High).eps * 16 * max(d, 1)
    top = np.abs(a).max() if d else High(0)
    if not top:
        return np.zeros(d, High), eye
    a = a / top
    x = (np.linalg.eigh(a.astype(np.float32))[1] if start is None else start).astype(High)
    for _ in range(ROUNDS):
        r = eye - x.T @ x
        s = x.T @ a @ x
        s = (s + s.T) / 2  # unequal halves would leave the vectors askew
        value = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(value)
        # a correction is right to its square, so rounding in the sums must stay below the root of its size
        near = max(2 * (_norm(off) + _norm(a) * _norm(r)), np.sqrt(tiny))
        gap = value[None, :] - value[:, None]
        apart = np.abs(gap) > near
        change = np.where(apart, (s + value[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ change
        turned = [_within(a, x, group) for group in _groups(value, near)]
        if not any(turned) and max(np.abs(r).max(), np.abs(np.where(apart, off, 0)).max()) <= tiny:
            break
    s = x.T @ a @ x
    value = np.diag(s)
    order = np.argsort(-value, kind="stable")
    return value[order] * top, x[:, order]


def _norm(m: np.ndarray) -> np.longdouble:
    """An upper bound of the spectral norm of a nearly symmetric matrix."""
    return min(np.sqrt((m * m).sum()), np.abs(m).sum(1).max())


def _groups(value: np.ndarray, near) -> list[np.ndarray]:
    """Runs of eigenvalues whose neighbours are not apart, those of one left out."""
    order = np.argsort(value)
    cut = np.flatnonzero(np.diff(value[order]) > near) + 1
    return [g for g in np.split(order, cut) if len(g) > 1]


def _within(a: np.ndarray, x: np.ndarray, group: np.ndarray) -> bool:
    """Turn some eigenvectors in place so that their eigenvalues part, by a solve of their own; whether that was needed."""
    own = x[:, group]
    t = own.T @ a @ own
    t = t - np.trace(t) / len(t) * (own.T @ own)
    t = (t + t.T) / 2
    if np.abs(t - np.diag(np.diag(t))).max() <= np.finfo(High).eps * 16 * len(a):
        return False
    x[:, group] = own @ refine(t)[1]
    return True


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Fit on all rows of ``clean(df)`` whose vector has the commonest length (of equally common ones the longest).

    None where there is nothing to whiten: no rows, or rows that are all
    equal. Components whose eigenvalue is zero to the precision of the sums
    are left out, as no scale gives them unit variance.
    """
    df = clean(df, vector)
    sums = _numbers(df, vector).mapInArrow(_sums, "dim int, j int, n long, s decimal(38,0)").groupBy("dim", "j").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    best: dict[int, tuple] = {}
    for r in sums.collect():  # one row per dimension
        best.setdefault(r.dim, (r.n, []))[1].append((r.j, int(r.s)))
    if not best:
        return None
    dim, (n, listed) = max(best.items(), key=lambda e: (e[1][0], e[0]))
    total = [s + OFFSET * n for _, s in sorted(listed)]
    whole = [(2 * s + n) // (2 * n) for s in total]
    rest = [s - n * w for s, w in zip(total, whole)]
    cov = covariance(df, vector, dim, n, whole, rest)
    value, vectors = refine(cov)
    trace = np.trace(cov)
    keep = np.flatnonzero(value > trace * dim * 1e-15)[:components]
    if not len(keep):
        return None
    vectors = vectors[:, keep]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(keep))])
    return Whitening(n, total, whole, rest, vectors.astype(float), value[keep].astype(float), float(trace))


def _project(x: np.ndarray, model: Whitening) -> np.ndarray:
    centred = (x - (np.array(model.whole, float) - OFFSET)) - np.array([r / model.n for r in model.rest])
    return centred @ model.vectors / np.sqrt(model.values)


def _deviation(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Squared distance from the mean times n squared, exact; None beyond 64 bits."""
    z = (x - (np.array(model.whole, float) - OFFSET)).astype(np.int64)
    n, rest = model.n, model.rest
    bound = n * (int(np.abs(z).max(initial=0)) + 1)
    if bound * bound * len(rest) < 2**63:
        y = n * z - np.array(rest, np.int64)
        return (y * y).sum(1).tolist()
    y = n * z.astype(object) - np.array(rest, object)
    return [v if v < 2**63 else None for v in (y * y).sum(1).tolist()]


def identity_error(df: DataFrame, model: Whitening, vector: str = "embedding") -> float:
    """The largest entry of the whitened rows' covariance less the identity, measured over all fitted rows.

    Each task centres its rows on their own mean before it multiplies them;
    the parts are put together by their counts and means.
    """
    k, dim, n = len(model.values), len(model.sums), model.n

    def parts(batches):
        for _, some, x in _blocks(batches, dim):
            w = _project(x, model)
            mean = w.mean(0)
            w = w - mean
            yield _pairs(k, w.T @ w + len(some) * np.outer(mean, mean), lambda v: pa.array(v, pa.float64()))
            yield pa.RecordBatch.from_pydict({"i": pa.array([-1] * k, pa.int32()), "j": pa.array(range(k), pa.int32()), "v": pa.array(len(some) * mean, pa.float64())})

    rows = _numbers(clean(df, vector), vector).mapInArrow(parts, "i int, j int, v double")
    cov, mean = np.zeros((k, k)), np.zeros(k)
    for r in rows.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # at most 33 * 32 rows
        if r.i < 0:
            mean[r.j] = r.v / n
        else:
            cov[r.i, r.j] = cov[r.j, r.i] = r.v / n
    return float(np.abs(cov - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, model: Whitening | None, vector: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """One row per vector and component: id, ``component`` from 1, ``deviation``, ``whitened``.

    Vectors that :func:`clean` drops, and those of another length than the
    model's, give no rows; without a model there are none. Rows that repeat
    and rows without id stay as they are; other columns are not read.
    ``deviation`` is NULL where it passes 64 bits.
    """
    kind = df.schema[id_col].dataType
    rows = _numbers(clean(df, vector), vector, F.col(id_col).alias("_id"))
    schema = f"_id {kind.simpleString()}, component int, deviation long, whitened double"
    if model is None:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("_id", id_col)
    k, dim = len(model.values), len(model.sums)

    def project(batches):
        for batch, some, x in _blocks(batches, dim):
            ids = batch.column(batch.schema.get_field_index("_id"))
            yield pa.RecordBatch.from_pydict(
                {
                    "_id": ids.take(pa.array(np.repeat(some, k))),
                    "component": pa.array(np.tile(np.arange(1, k + 1), len(some)), pa.int32()),
                    "deviation": pa.array(_deviation(x, model), pa.int64()).take(pa.array(np.repeat(np.arange(len(some)), k))),
                    "whitened": pa.array(_project(x, model).ravel(), pa.float64()),
                }
            )

    return rows.mapInArrow(project, schema).withColumnRenamed("_id", id_col)


def whiten_embeddings(df: DataFrame, vector: str = "embedding", id_col: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """Fit on the whole table and whiten it, with the fit's figures on every row.

    ``n`` is the number of vectors fitted, ``explained`` the component's share
    of the variance, ``identity_error`` how far the whitened covariance is
    from the identity. An empty table, or one whose vectors are all equal,
    gives no rows.
    """
    model = fit(df, vector, components)
    out = whiten(df, model, vector, id_col)
    if model is None:
        error, n, share = None, None, F.lit(None)
    else:
        error, n = identity_error(df, model, vector), model.n
        share = F.element_at(F.array(*map(F.lit, model.explained.tolist())), F.col("component"))
    return out.select(
        id_col,
        "component",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        share.cast("double").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
