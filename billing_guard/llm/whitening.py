"""Whitening of embeddings on their leading components, by spectrum slicing.

The covariance is taken over the distinct vectors of whole numbers ``floor(SCALE * c)``: exact
sums first, then products of the centred entries, added up per part of the data and by
Spark.  Its leading eigenvalues are found without a full decomposition:

* Sylvester's law of inertia: the LDLᵀ factorisation of ``V - s I`` (symmetric, with 1x1 and
  2x2 pivots) has as many positive pivots as V has eigenvalues above s.  Bisection on that
  count cuts the spectrum into slices that hold one eigenvalue each;
* inside its slice Rayleigh quotient iteration converges cubically; a quotient that leaves
  the slice sends the search back to bisection;
* the count on both sides of every result certifies that it is the eigenvalue of its
  number.  Eigenvalues too close for the counts to part form one cluster, whose vectors are
  made orthogonal within it.

Edge cases: rows whose vector is NULL or holds NULL or non-finite entries are left out;
empty vectors have no component and no row; vectors of different length are fitted apart
(each length has its own n); components without variance (one distinct vector, or fewer
dimensions than asked for) are left out; entries beyond a long after scaling are held at
its ends, and a deviation beyond a long is NULL; a NULL vec_id is kept; repeated rows count
once in the fit and each get their rows; only vec_id and the vector are read.

Size bounds: the driver and the tasks hold, per length of vectors that occurs, the sums (d
numbers) and ``components`` vectors; one task solves one d x d matrix.  Nothing held grows with
the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billing_guard.llm.common import written

SCALE = 256
COMPONENTS = 4
_EPS = np.finfo(float).eps
_LONG = (1 << 63) - 1


# --- one symmetric matrix ----------------------------------------------------------------
def inertia_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix lie above ``shift``: the positive pivots of
    the LDLᵀ factorisation of ``matrix - shift I`` with diagonal (Bunch-Kaufman) pivoting."""
    a = matrix - shift * np.eye(len(matrix))
    alpha = (1 + np.sqrt(17)) / 8  # balances the growth of 1x1 and 2x2 pivots
    positive = 0
    while len(a):
        column = np.abs(a[1:, 0])
        r = int(column.argmax()) + 1 if len(column) else 0
        below = column[r - 1] if r else 0.0
        size = 1
        if abs(a[0, 0]) < alpha * below:
            row = np.abs(a[r])
            row[r] = 0.0
            widest = row.max()
            if abs(a[0, 0]) * widest >= alpha * below * below:
                pass
            elif abs(a[r, r]) >= alpha * widest:
                _swap(a, 0, r)
            else:
                _swap(a, 1, r)
                size = 2
        pivot, rest = a[:size, :size], a[size:, :size]
        if size == 2:
            positive += 1  # its determinant is negative: one eigenvalue of each sign
            a = a[2:, 2:] - rest @ np.linalg.solve(pivot, rest.T)
        else:
            positive += bool(pivot[0, 0] > 0)
            a = a[1:, 1:] - (np.outer(rest, rest) / pivot[0, 0] if pivot[0, 0] else 0.0)
    return positive


def _swap(a: np.ndarray, i: int, j: int) -> None:
    if i != j:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]


def leading_eigenpairs(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues (falling) and their unit vectors, as rows.

    Fewer if the rest cannot be told from zero.
    """
    d = len(matrix)
    size = float(np.abs(matrix).sum(axis=1).max()) if d else 0.0
    if size == 0:
        return np.zeros(0), np.zeros((0, d))
    noise = 4 * d * _EPS * size          # what the counts cannot resolve
    counted: dict[float, int] = {}

    def above(s: float) -> int:
        if s not in counted:
            counted[s] = inertia_above(matrix, s)
        return counted[s]

    count = min(count, above(noise))     # all others are zero to rounding
    values, vectors = [], np.zeros((0, d))
    while len(values) < count:
        j = len(values)                  # the next eigenvalue has j above it
        high = min([s for s, n in counted.items() if n == j], default=size + noise)
        low = max([s for s, n in counted.items() if n > j], default=-size - noise)
        while True:
            if above(low) == j + 1:      # one eigenvalue in the slice
                found = _rayleigh(matrix, low, high, vectors, noise)
                if found and above(found[0] + noise) <= j < above(found[0] - noise):
                    values.append(found[0])
                    vectors = np.vstack([vectors, found[1]])
                    break
            if high - low <= noise:      # closer than the counts can part
                cluster = min(above(low), count) - j
                v, basis = _cluster(matrix, (low + high) / 2, above(low) - j, vectors)
                values += list(v[:cluster])
                vectors = np.vstack([vectors, basis[:cluster]])
                break
            middle = (low + high) / 2
            if above(middle) > j:
                low = middle
            else:
                high = middle
    order = np.argsort(-np.array(values), kind="stable")
    values, vectors = np.array(values)[order], vectors[order]
    signs = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])
    return values, vectors * signs[:, None]


def _solve(matrix: np.ndarray, shift: float, right: np.ndarray) -> np.ndarray:
    """Solve with the shifted matrix; a shift that hits an eigenvalue is moved by rounding."""
    d = len(matrix)
    step = _EPS * max(abs(shift), np.abs(matrix).max())
    while True:
        try:
            return np.linalg.solve(matrix - shift * np.eye(d), right)
        except np.linalg.LinAlgError:
            shift += step
            step *= 2


def _apart(vector: np.ndarray, others: np.ndarray) -> np.ndarray:
    """A unit vector orthogonal to the given ones."""
    for _ in range(2):
        vector = vector - others.T @ (others @ vector)
    return vector / np.linalg.norm(vector)


def _rayleigh(matrix: np.ndarray, low: float, high: float, found: np.ndarray, noise: float):
    """Rayleigh quotient iteration for the one eigenvalue in (low, high].

    None if it leaves the slice or does not come to rest in it.
    """
    vector = _apart(np.cos(np.arange(1, len(matrix) + 1) ** 2), found)
    for _ in range(2):                   # inverse iteration turns the start towards the slice
        vector = _apart(_solve(matrix, (low + high) / 2, vector), found)
    best, least = None, noise
    for _ in range(12):
        value = float(vector @ matrix @ vector)
        residual = float(np.linalg.norm(matrix @ vector - value * vector))
        if not low <= value <= high:
            return None
        if residual < least:
            best, least = (value, vector), residual / 2
        elif best:                       # rounding is reached
            break
        vector = _apart(_solve(matrix, value, vector), found)
    return best


def _cluster(matrix: np.ndarray, shift: float, size: int, found: np.ndarray):
    """``size`` eigenpairs next to ``shift``: subspace iteration with the shifted inverse."""
    d = len(matrix)
    basis = np.cos(np.outer(np.arange(1, size + 1), np.arange(1, d + 1) ** 2)).T
    for _ in range(4):
        basis = basis - found.T @ (found @ basis)
        basis = np.linalg.qr(_solve(matrix, shift, np.linalg.qr(basis)[0]))[0]
    small = basis.T @ matrix @ basis
    values, turn = np.linalg.eigh((small + small.T) / 2)
    return values[::-1], (basis @ turn).T[::-1]


# --- Spark -------------------------------------------------------------------------------
@dataclass(frozen=True)
class Fit:
    """What whitens the vectors of one length."""
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = float("nan")

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n`` of whole-number rows, each entry rounded once."""
        exact = _exact(x, self)
        if exact is None:
            return x - np.array([s / self.n for s in self.sums])
        return exact / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors.T / np.sqrt(self.values)


def _exact(x: np.ndarray, fit: Fit) -> np.ndarray | None:
    """``n x - S`` in whole numbers, None if they may not fit."""
    largest = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * fit.n
    if largest + max(map(abs, fit.sums), default=0) > _LONG // 2:
        return None
    return x * fit.n - np.array(fit.sums, np.int64)


def deviations(x: np.ndarray, fit: Fit) -> list[int | None]:
    """Sum over the dimensions of ``(n x - S)^2``, exact; None beyond a long."""
    exact = _exact(x, fit)
    if exact is not None and int(np.abs(exact).max(initial=0)) ** 2 * x.shape[1] <= _LONG:
        return (exact * exact).sum(axis=1).tolist()
    totals = [sum((fit.n * int(v) - s) ** 2 for v, s in zip(row, fit.sums)) for row in x]
    return [t if t <= _LONG else None for t in totals]


def scaled(vector: Column) -> Column:
    """The whole-number vector; NULL if the vector is NULL or holds NULL or non-finite entries."""
    whole = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v.cast("double"))
                     & (F.abs(v.cast("double")) < float("inf")))
    return F.when(whole, F.transform(vector, lambda v: F.floor(v.cast("double") * SCALE) + 0))


def _by_length(batches: Iterator[pd.DataFrame]):
    """(rows, matrix) for every length of vectors in every batch."""
    for rows in batches:
        lengths = rows["x"].map(len)
        for d in lengths.unique():
            part = rows[lengths == d]
            yield part, np.stack(part["x"].to_numpy()).astype(np.int64).reshape(len(part), d)


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: dict[int, list] = {}
    for rows, x in _by_length(batches):
        held = total.setdefault(x.shape[1], [0, [0] * x.shape[1]])
        held[0] += len(rows)
        low = x & 0xFFFFFFFF  # halves, so that no sum of a batch overflows
        high = (x - low) >> 32
        held[1] = [a + (int(h) << 32) + int(b) for a, h, b in zip(held[1], high.sum(axis=0), low.sum(axis=0))]
    for d, (n, sums) in total.items():
        yield pd.DataFrame({"d": d, "i": range(d), "n": n, "s": [str(s) for s in sums]})


def _products(fits: dict[int, Fit]):
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for _, x in _by_length(batches):
            d = x.shape[1]
            y = fits[d].centred(x)
            total[d] = total.get(d, 0.0) + y.T @ y
        for d, product in total.items():
            i, j = np.triu_indices(d)
            yield pd.DataFrame({"d": d, "i": i, "j": j, "s": product[i, j]})
    return add


def _solver(n_of: dict[int, int], components: int):
    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        d = int(rows["d"].iloc[0])
        i, j = rows["i"].to_numpy(), rows["j"].to_numpy()
        v = np.zeros((d, d))
        v[i, j] = v[j, i] = rows["s"].to_numpy() / n_of[d]
        values, vectors = leading_eigenpairs(v, components)
        return pd.DataFrame({"d": d, "component": range(1, len(values) + 1), "value": values,
                             "vector": pd.Series(list(vectors), dtype=object),
                             "trace": float(np.trace(v))})
    return solve


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """Fits by length of vectors, from all distinct whole-number vectors of ``x``."""
    distinct = written(vectors.select("x").where("x IS NOT NULL AND size(x) > 0").distinct(), "whitening_fit")
    sums = (distinct.mapInPandas(_sums, "d int, i int, n long, s string").groupBy("d", "i")
            .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
            .groupBy("d").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("i", "s"))).alias("s")))
    fits = {r.d: Fit(r.n, [int(e.s) for e in r.s], np.zeros(0), np.zeros((0, r.d)), 0.0) for r in sums.collect()}
    products = (distinct.mapInPandas(_products(fits), "d int, i int, j int, s double")
                .groupBy("d", "i", "j").agg(F.sum("s").alias("s")))
    solved = products.groupBy("d").applyInPandas(
        _solver({d: f.n for d, f in fits.items()}, components),
        "d int, component int, value double, vector array<double>, trace double")
    parts: dict[int, list] = {}
    for r in solved.collect():
        parts.setdefault(r.d, []).append(r)
    for d, rows in parts.items():
        rows.sort(key=lambda r: r.component)
        fits[d] = Fit(fits[d].n, fits[d].sums, np.array([r.value for r in rows]),
                      np.array([r.vector for r in rows]), rows[0].trace)
    fits = {d: f for d, f in fits.items() if len(f.values)}
    return {d: Fit(f.n, f.sums, f.values, f.vectors, f.trace, e)
            for (d, f), e in zip(fits.items(), _identity_errors(distinct, fits, components))}


def _identity_errors(distinct: DataFrame, fits: dict[int, Fit], components: int) -> list[float]:
    """For every fit, the largest absolute entry of the whitened covariance minus the identity."""
    names = [f"w{c}" for c in range(components)]

    def whiten(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, x in _by_length(batches):
            if x.shape[1] in fits:
                w = fits[x.shape[1]].whitened(x)
                yield pd.DataFrame({"d": x.shape[1]} | {
                    name: w[:, c] if c < w.shape[1] else None for c, name in enumerate(names)},
                    index=range(len(w)))

    pairs = [(a, b) for a in range(components) for b in range(a, components)]
    covariances = (distinct.mapInPandas(whiten, "d int, " + ", ".join(f"{n} double" for n in names))
                   .groupBy("d").agg(*[F.covar_pop(names[a], names[b]).alias(f"c{a}_{b}") for a, b in pairs]))
    worst = {}
    for r in covariances.collect():
        entries = [r[f"c{a}_{b}"] - (a == b) for a, b in pairs if r[f"c{a}_{b}"] is not None]
        worst[r.d] = max(map(abs, entries))
    return [worst[d] for d in fits]


OUTPUT = ("component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


def whiten_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
                   components: int = COMPONENTS) -> DataFrame:
    """One row for every row and component, see OUTPUT."""
    rows = vectors.select(F.col(vec_id), scaled(F.col(vector)).alias("x"))
    fits = fit_whitening(rows, components)

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, x in _by_length(batches):
            fit = fits.get(x.shape[1])
            if fit is None:
                continue
            w, k = fit.whitened(x), len(fit.values)
            yield pd.DataFrame({
                vec_id: part[vec_id].repeat(k).to_numpy(),
                "component": np.tile(np.arange(1, k + 1), len(x)),
                "n": fit.n,
                "deviation": pd.array(deviations(x, fit), "Int64").repeat(k),
                "whitened": w.ravel(),
                "explained": np.tile(fit.values / fit.trace, len(x)),
                "identity_error": fit.identity_error})

    id_type = vectors.schema[vec_id].dataType.simpleString()
    return rows.where("x IS NOT NULL AND size(x) > 0").mapInPandas(project, f"{vec_id} {id_type}, {OUTPUT}")
