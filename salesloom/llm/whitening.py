"""Whitened vectors by a block Jacobi-Davidson method on distributed products.

The covariance is never formed. It acts on a block of trial vectors by one Spark job, in which every
task multiplies its own centred rows. A search space of such vectors is rotated to its best
approximations (Rayleigh-Ritz); each that has reached double precision is locked, and each other one
gets a correction from its projected equation, solved by a few steps of MINRES. All corrections are
solved side by side, so one step of all of them is one job.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom import scratch
from salesloom.llm.batches import small_batches

SCALE, SHIFT = 64, 1_000_000
REACH = 2.0**46  # entries from here on have no exact whole number
EPS = float(np.finfo(np.float64).eps)
ROWS = 1024  # vectors of a stored block
GUARD = 4  # approximations kept beside those wanted

Product = Callable[[np.ndarray], np.ndarray]


def usable(vector: Column) -> Column:
    """No null vector, no entry that is null, not finite or beyond 2^46."""
    inside = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < REACH))
    return F.coalesce(inside, F.lit(False))


def whole_numbers(vector: Column) -> Column:
    """Each entry c as floor(64 c) + 1,000,000."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint") + SHIFT)


@dataclass(frozen=True)
class Centre:
    """Number of vectors of one length and their sums, which give the mean without rounding."""

    n: int
    sums: tuple[int, ...]

    def base(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    def rest(self) -> np.ndarray:
        return np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n. The whole part of the mean comes off first, exactly."""
        return (x - self.base()) - self.rest() / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n x - S)^2, exact; null where a bigint cannot hold it."""
        near = self.n**2 * np.square(self.centred(x)).sum(axis=1)
        if near.max(initial=0) < 2.0**62:
            return list(np.square(self.n * (x - self.base()) - self.rest()).sum(axis=1))
        away = [[self.n * (int(v) - int(b)) - int(r) for v, b, r in zip(row, self.base(), self.rest())] for row in x]
        exact = (sum(v * v for v in row) for row in away)
        return [e if e < 2**63 else None for e in exact]


@dataclass(frozen=True)
class Whitening:
    """What is learnt from vectors of one length: ``axes`` are columns, the strongest first."""

    centre: Centre
    axes: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ (self.axes / np.sqrt(self.values))


def stored_blocks(vectors: DataFrame) -> DataFrame:
    """Distinct vectors ``x`` as blocks ``(dim, x)`` of many rows, which products read quickly."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby(batch["x"].map(len))["x"]:
                for i in range(0, len(part), ROWS):
                    raw = np.stack(part.iloc[i : i + ROWS]).astype(np.int64).tobytes()
                    yield pd.DataFrame({"dim": [dim], "x": [raw]})

    distinct = vectors.where(F.size("x") > 0).groupBy("x").agg(F.lit(1).alias("one")).select("x")
    return scratch.materialize(distinct.mapInPandas(pack, "dim int, x binary"), "blocks")


def _rows(block: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(block, np.int64).reshape(-1, dim)


def _added_up(blocks: DataFrame, dim: int, part: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """Sum over all rows of what ``part`` makes of a block of them. Tasks add their own blocks, and
    the sums of tasks are added by place, so only one flat array reaches the driver."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            for block in batch["x"]:
                one = part(_rows(block, dim))
                total = one if total is None else total + one
        if total is not None:
            yield pd.DataFrame({"place": np.arange(total.size), "v": total.ravel()})

    parts = blocks.where(F.col("dim") == dim).select("x").mapInPandas(add, f"place bigint, v {kind}")
    found = parts.groupBy("place").agg(F.sum("v").alias("v")).toPandas().sort_values("place")
    return found["v"].to_numpy()


def centre_of(blocks: DataFrame, dim: int) -> Centre:
    sums = _added_up(blocks, dim, lambda x: np.append(x.sum(axis=0), len(x)), "bigint")
    return Centre(int(sums[-1]), tuple(int(s) for s in sums[:-1]))


def covariance_product(blocks: DataFrame, dim: int, centre: Centre) -> Product:
    """The covariance times a block of vectors, one job a call."""

    def product(block: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            rows = centre.centred(x)
            return rows.T @ (rows @ block)

        return _added_up(blocks, dim, part, "double").reshape(block.shape) / centre.n

    return product


def minres(product: Product, right: np.ndarray, steps: int, enough: float = 1e-3) -> np.ndarray:
    """Solutions of one symmetric system for each column of ``right``, all in step.

    A column rests once its residual has fallen to ``enough`` of the start, or when its Krylov space
    is used up.
    """

    def safe(x: np.ndarray) -> np.ndarray:
        return np.where(x == 0, 1.0, x)

    beta = np.linalg.norm(right, axis=0)
    first, eta, work = beta, beta.copy(), beta > 0
    v, before = right / safe(beta), np.zeros_like(right)
    w, w_before, out = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    c, c_before = np.ones(len(beta)), np.ones(len(beta))
    s, s_before = np.zeros(len(beta)), np.zeros(len(beta))
    beta = np.zeros(len(beta))
    for _ in range(steps):
        if not work.any():
            break
        av = product(v)
        alpha = (v * av).sum(axis=0)
        av = av - alpha * v - beta * before
        following = np.linalg.norm(av, axis=0)
        # The last two rotations, applied to the new column of the tridiagonal matrix.
        diagonal = c * alpha - c_before * s * beta
        length = np.hypot(diagonal, following)
        above, far_above = s * alpha + c_before * c * beta, s_before * beta
        work = work & (length > 0)
        c_before, c = c, np.where(work, diagonal / safe(length), c)
        s_before, s = s, np.where(work, following / safe(length), s)
        w_before, w = w, np.where(work, (v - far_above * w_before - above * w) / safe(length), w)
        out = out + np.where(work, c * eta * w, 0.0)
        eta = np.where(work, -s * eta, eta)
        before, v, beta = v, av / safe(following), following
        work = work & (np.abs(eta) > enough * first) & (following > EPS * np.abs(alpha))
    return out


def _new_directions(basis: np.ndarray, block: np.ndarray) -> np.ndarray:
    """What ``block`` adds to an orthonormal ``basis``, orthonormal; directions lost to rounding go."""
    norms = np.linalg.norm(block, axis=0)
    block = block[:, norms > 0] / norms[norms > 0]
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
    left, size, _ = np.linalg.svd(block, full_matrices=False)
    block = left[:, size > 1e-8]
    block = block - basis @ (basis.T @ block)
    return np.linalg.qr(block)[0] if block.shape[1] else block


def jacobi_davidson(
    product: Product,
    dim: int,
    wanted: int,
    seed: int = 7,
    steps: int = 6,
    rounds: int = 200,
) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric product and their vectors as columns.

    Each is locked once its residual is within a few roundings of the largest eigenvalue. The search
    space holds four blocks at most and then starts again from its best vectors, so the driver's
    memory is a small multiple of the result.
    """
    wanted = min(wanted, dim)
    block = min(dim, wanted + GUARD)
    start = np.random.default_rng(seed).standard_normal((dim, block))
    locked, values = np.empty((dim, 0)), np.empty(0)
    basis = np.linalg.qr(start)[0]
    image = product(basis)
    for _ in range(rounds):
        theta, turn = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        keep = min(block, basis.shape[1])
        ritz, ritz_image = basis @ turn[:, :keep], image @ turn[:, :keep]
        residual = ritz_image - ritz * theta[:keep]
        off = np.linalg.norm(residual, axis=0)
        largest = max([*np.abs(values[:1]), *np.abs(theta[:1])], default=0.0)
        bound = 16 * EPS * np.sqrt(dim) * largest
        # From the strongest on, so that none is passed over.
        need = wanted - len(values)
        done = int(np.argmax(off[:need] > bound)) if (off[:need] > bound).any() else min(need, keep)
        locked, values = np.hstack([locked, ritz[:, :done]]), np.append(values, theta[:done])
        if len(values) == wanted:
            return values, locked
        if basis.shape[1] + block > 4 * block:
            basis, image = ritz, ritz_image
        else:
            basis, image = basis @ turn, image @ turn
        basis, image = basis[:, done:], image[:, done:]
        open_ = slice(done, min(keep, need + GUARD))
        own, level, right = ritz[:, open_], theta[open_], residual[:, open_]

        def projected(p: np.ndarray) -> np.ndarray:
            p = p - locked @ (locked.T @ p)
            return p - own * (own * p).sum(axis=0)

        def shifted(p: np.ndarray) -> np.ndarray:
            p = projected(p)
            return projected(product(p) - p * level)

        correction = projected(minres(shifted, -projected(right), steps)) if own.shape[1] else own
        known = np.hstack([locked, basis])
        added = _new_directions(known, correction)
        if not added.shape[1] and known.shape[1] < dim:
            fresh = np.random.default_rng(len(values) + known.shape[1]).standard_normal((dim, block))
            added = _new_directions(known, fresh)[:, : dim - known.shape[1]]
        if added.shape[1]:
            basis, image = np.hstack([basis, added]), np.hstack([image, product(added)])
        else:
            # The space is whole; what is left is rounding in the stored images.
            image = product(basis)
    raise RuntimeError(f"eigenvectors did not settle in {rounds} rounds")


def fit(vectors: DataFrame, components: int = 16, seed: int = 7) -> dict[int, Whitening]:
    """A whitening for each length of the vectors ``x``, learnt from every distinct one once.

    It has at most ``components`` axes, and fewer if the vectors vary in fewer directions. The
    driver holds sums, axes and products of a block of trial vectors, never vectors.
    """
    blocks = stored_blocks(vectors)
    out = {}
    for dim in sorted(row["dim"] for row in blocks.select("dim").distinct().collect()):
        centre = centre_of(blocks, dim)
        product = covariance_product(blocks, dim, centre)
        spread = _added_up(blocks, dim, lambda x: np.square(centre.centred(x)).sum(axis=0), "double")
        trace = float(spread.sum() / centre.n)
        if trace > 0:
            values, axes = jacobi_davidson(product, dim, components, seed)
            real = values > values[0] * dim * 16 * EPS
            values, axes = values[real], axes[:, real]
        else:
            values, axes = np.empty(0), np.empty((dim, 0))
        model = Whitening(centre, axes, values, trace, 0.0)
        out[dim] = Whitening(centre, axes, values, trace, identity_error(blocks, dim, model))
    return out


def identity_error(blocks: DataFrame, dim: int, model: Whitening) -> float:
    """Largest absolute entry of the covariance of all whitened vectors minus the identity."""
    k = len(model.values)
    if not k:
        return 0.0

    def part(x: np.ndarray) -> np.ndarray:
        w = model.whitened(x)
        return np.append(w.T @ w, w.sum(axis=0))

    found = _added_up(blocks, dim, part, "double") / model.centre.n
    second, mean = found[: k * k].reshape(k, k), found[k * k :]
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whiten(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = 16,
    seed: int = 7,
) -> DataFrame:
    """``(id_col, n, deviation, whitened, explained, identity_error)`` for every usable vector.

    ``whitened`` and ``explained`` are arrays by component, from the strongest on. Rows whose vector
    is null or holds an entry that is null, not finite or beyond 2^46 are left out. Repeated rows and
    equal vectors all stay but count once in the fit. Vectors of each length are whitened apart; an
    empty vector, or one of a length in which all vectors are equal, has empty arrays. Directions
    without variance have no component. An empty table gives an empty result, a null id stays null,
    other columns are left out. A deviation beyond a bigint is null.

    The axes are fitted once and travel with the tasks, so all rows see the same.
    """
    small_batches(df.sparkSession, 2000)
    rows = df.where(usable(F.col(vector_col))).select(
        F.col(id_col).alias("id"), whole_numbers(F.col(vector_col)).alias("x")
    )
    models = fit(rows.select("x"), components, seed)

    @F.pandas_udf("deviation bigint, whitened array<double>")
    def project(vectors: pd.Series) -> pd.DataFrame:
        deviation, whitened = [0] * len(vectors), [np.empty(0)] * len(vectors)
        lengths = vectors.map(len).to_numpy()
        for dim in set(lengths[lengths > 0]):
            at = np.flatnonzero(lengths == dim)
            x, model = np.stack(vectors.iloc[at]), models[int(dim)]
            for i, d, w in zip(at, model.centre.deviations(x), model.whitened(x)):
                deviation[i], whitened[i] = d, w
        return pd.DataFrame({"deviation": pd.array(deviation, "Int64"), "whitened": whitened})

    def by_length(value: Callable[[Whitening], Column], empty: Column) -> Column:
        out = empty
        for dim, model in models.items():
            out = F.when(F.size("x") == dim, value(model)).otherwise(out)
        return out

    def shares(model: Whitening) -> Column:
        return F.array(*[F.lit(float(e / model.trace)) for e in model.values]).cast("array<double>")

    found = rows.withColumn("found", project(F.col("x")))
    return found.select(
        F.col("id").alias(id_col),
        by_length(lambda m: F.lit(m.centre.n).cast("bigint"), F.lit(0).cast("bigint")).alias("n"),
        "found.deviation",
        "found.whitened",
        by_length(shares, F.array().cast("array<double>")).alias("explained"),
        by_length(lambda m: F.lit(m.identity_error), F.lit(0.0)).alias("identity_error"),
    )
