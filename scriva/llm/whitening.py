"""Embedding whitening: leading components of the covariance by Chebyshev-filtered subspace iteration.

Entries become whole numbers floor(64 c); sums, counts and deviations are exact. The covariance itself is never formed: a pass over
the stored vectors multiplies it with a block Q of a few vectors, each task with its rows, centred first, and partial products are
added up by Spark. Between passes the driver holds dimensions x block, which does not grow with the rows. A few Lanczos steps say where
the spectrum begins. A round applies a polynomial of the covariance to the block by the Chebyshev three-term recurrence, one pass a
degree: it stays small from there to the block's least Ritz value and grows above it, so that the unwanted spectrum is damped. QR
and Rayleigh-Ritz then give components, and their residuals |V q - e q| decide whether they are certified.

Defined cases: rows whose vector is null, or has null, NaN or infinite entries, or entries that give no long, are dropped; so are
vectors of another length than the most frequent one (the longer of two as frequent). Null and repeated ids and repeated vectors
count row by row. Vectors of d < 32 entries have d components. A component without variance (constant or too few vectors) has
whitened and explained 0 and is no part of identity_error. A deviation that is no long is null. No remaining row: an empty
result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriva.llm.common import Scratch, stored

SHIFT = 1_000_000
COMPONENTS = 32
#: Vectors of the block beside the wanted ones, degree of the filter, rounds at most, Lanczos steps.
GUARD, DEGREE, ROUNDS, STEPS = 24, 10, 40, 8
#: Certified: residuals up to TOLERANCE of the largest eigenvalue, and no longer falling by half from round to round; up to
#: LOOSE they pass in the last round.
TOLERANCE, LOOSE = 1e-13, 1e-9
#: A variance up to this share of the largest counts as none.
NOTHING = 1e-12
#: Rows that a task multiplies together.
ROWS = 4_096


def whole_numbers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, y): the vectors that remain, y = floor(64 c) for each entry; x of the contract is y + SHIFT."""
    scaled = F.transform(F.col(vector_col), lambda c: c.cast("double") * 64)
    rows = vectors.select(F.col(id_col).alias("vec_id"), scaled.alias("y")).where(F.forall("y", lambda c: F.coalesce(F.abs(c) < 2.0**62, F.lit(False)) & ~F.isnan(c)))
    lengths = rows.groupBy(F.size("y").alias("d")).agg(F.count("*").alias("n"))
    first = lengths.where("d > 0").orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size("y") == (first["d"] if first else -1)).withColumn("y", F.transform("y", lambda c: F.floor(c)))


def blocks(batch: pa.RecordBatch, d: int) -> np.ndarray:
    column = batch.column("y")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def total(y: np.ndarray) -> list[int]:
    """Exact sums of the columns."""
    bound = max(abs(int(y.min())), abs(int(y.max()))) if y.size else 0
    return (y if bound * len(y) < 2**63 else y.astype(object)).sum(0).tolist()


def passed(rows: DataFrame, d: int, width: int, work: Callable[[np.ndarray], np.ndarray], height: int) -> np.ndarray:
    """The sum of work(y) (height x width) over all rows: tasks sum their own, Spark sums the lines of all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = work(blocks(batch.slice(a, ROWS), d))
                out = part if out is None else out + part
        if out is not None:
            values = pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), width).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(height, dtype=np.int32)), values], names=["line", "v"])

    lines = rows.select("y").mapInArrow(run, "line int, v array<double>")
    found = lines.groupBy("line").agg(*[F.sum(F.col("v")[k]).alias(f"c{k}") for k in range(width)]).collect()
    out = np.zeros((height, width))
    for r in found:
        out[r[0]] = r[1:]
    return out


def sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of rows and exact sums of all dimensions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = 0, [0] * d
        for batch in batches:
            n += batch.num_rows
            s = [a + b for a, b in zip(s, total(blocks(batch, d)), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array([str(x) for x in s]), pa.array([n] * d)], names=["k", "s", "n"])

    found = rows.select("y").mapInArrow(run, "k int, s string, n long").groupBy("k").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect()
    by_dimension = {r["k"]: r for r in found}
    return (by_dimension[0]["n"], [int(by_dimension[k]["s"]) for k in range(d)]) if found else (0, [0] * d)


def spread(y: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """n x - S of each entry, exact: int64, or Python's numbers where that is too narrow."""
    bound = n * max(abs(int(y.min())), abs(int(y.max()))) + max(map(abs, s)) if y.size else 0
    if bound < 2**63:
        return n * y - np.array(s, np.int64)
    return n * y.astype(object) - np.array(s, object)


def centred(y: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    return spread(y, n, s).astype(np.float64) / n


def deviations(y: np.ndarray, n: int, s: list[int]) -> list[int | None]:
    gaps = spread(y, n, s)
    if gaps.dtype != object and (not gaps.size or gaps.shape[1] * int(np.abs(gaps).max()) ** 2 < 2**63):
        return (gaps * gaps).sum(1).tolist()
    return [x if x < 2**63 else None for x in (gaps.astype(object) ** 2).sum(1).tolist()]


class Components:
    """Unit eigenvectors (columns of `vectors`) of a covariance by falling eigenvalue, and what certifies them."""

    def __init__(self, n: int, s: list[int], vectors: np.ndarray, values: np.ndarray, trace: float, residual: float, passes: int):
        self.n, self.s, self.vectors, self.values, self.trace, self.residual, self.passes = n, s, vectors, values, trace, residual, passes

    def scaled(self) -> np.ndarray:
        """The projections that whiten; zero for components without variance."""
        some = self.values > NOTHING * max(self.values[0], 0)
        return np.where(some, self.vectors / np.sqrt(np.where(some, self.values, 1)), 0)


def lower_bound(product: Callable[[np.ndarray], np.ndarray], d: int, steps: int = STEPS, seed: int = 5) -> float:
    """About where the spectrum begins: the least Ritz value of some Lanczos steps, less its residual. The filter only grows slowly
    on what lies below, and the certificate doesn't rest on it."""
    q = np.random.default_rng(seed).normal(size=(d, 1))
    basis, diagonal, beside = q / np.linalg.norm(q), [], []
    for _ in range(min(steps, d - 1)):
        image = product(basis[:, -1:])
        diagonal.append(float(basis[:, -1] @ image[:, 0]))
        for _ in range(2):
            image = image - basis @ (basis.T @ image)
        beside.append(float(np.linalg.norm(image)))
        if beside[-1] <= NOTHING * max(map(abs, diagonal)):
            break
        basis = np.hstack([basis, image / beside[-1]])
    values, vectors = np.linalg.eigh(np.diag(diagonal) + np.diag(beside[:-1], 1) + np.diag(beside[:-1], -1)) if diagonal else (np.zeros(1), np.zeros((1, 1)))
    return max(0.0, float(values[0] - beside[-1] * abs(vectors[-1, 0]))) if beside else 0.0


def fit(rows: DataFrame, d: int, k: int = COMPONENTS, guard: int = GUARD, seed: int = 17) -> Components | None:
    """The leading k components of rows (vec_id, y); rows should be a stored table, it is read once for each pass."""
    n, s = sums(rows, d)
    if not n:
        return None
    k, m, passes = min(k, d), min(k + guard, d), 0

    def product(q: np.ndarray) -> np.ndarray:
        """Covariance times q."""
        nonlocal passes
        passes += 1

        def work(y: np.ndarray) -> np.ndarray:
            x = centred(y, n, s)
            return x.T @ (x @ q)

        return passed(rows, d, q.shape[1], work, d) / n

    def variance(y: np.ndarray) -> np.ndarray:
        return (centred(y, n, s) ** 2).sum().reshape(1, 1)

    trace = float(passed(rows, d, 1, variance, 1)[0, 0]) / n
    begins = lower_bound(product, d) if m < d else 0.0
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, m)))[0]
    before = np.inf
    for turn in range(ROUNDS + 1):
        image = product(q)
        values, turned = np.linalg.eigh((q.T @ image + image.T @ q) / 2)
        values, turned = values[::-1], turned[:, ::-1]
        q, image = q @ turned, image @ turned
        top = max(values[0], 0.0)
        residual = float(np.linalg.norm(image[:, :k] - q[:, :k] * values[:k], axis=0).max()) / top if top else 0.0
        if m == d or not top or residual <= TOLERANCE and residual > before / 2 or residual <= TOLERANCE / 100:
            return Components(n, s, q[:, :k], np.maximum(values[:k], 0), trace, residual, passes)
        if turn == ROUNDS:
            break
        before = residual
        # the filter: T_degree of the covariance, mapped so that what lies from `begins` to the least Ritz value goes to [-1, 1],
        # divided by its value at the largest Ritz value
        high = max(values[-1], NOTHING * top)
        low = min(begins, 0.99 * high)
        middle, half = (high + low) / 2, (high - low) / 2
        ratio = half / (top - middle)
        scale, last = ratio, q
        now = (image - middle * q) * (scale / half)
        for _ in range(DEGREE - 1):
            following = 1 / (2 / ratio - scale)
            last, now, scale = now, (product(now) - middle * now) * (2 * following / half) - scale * following * last, following
        q = np.linalg.qr(now)[0]
    if residual > LOOSE:
        raise ArithmeticError(f"components are not certified after {passes} passes: residual {residual:.2g} of the largest eigenvalue")
    return Components(n, s, q[:, :k], np.maximum(values[:k], 0), trace, residual, passes)


def identity_error(rows: DataFrame, d: int, found: Components) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, over the rows themselves."""
    p, n, s = found.scaled(), found.n, found.s
    p = p[:, np.abs(p).max(0) > 0]
    k = p.shape[1]
    if not k:
        return 0.0

    def work(y: np.ndarray) -> np.ndarray:
        w = centred(y, n, s) @ p
        return np.vstack([w.T @ w, w.sum(0)])

    both = passed(rows, d, k, work, k + 1) / n
    return float(np.abs(both[:k] - np.outer(both[k], both[k]) - np.eye(k)).max())


def whiten(vectors: DataFrame, k: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), one row for each remaining vector and component."""
    kind = vectors.select(id_col).schema[0].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    with Scratch(vectors.sparkSession) as scratch:
        rows = scratch.stored(whole_numbers(vectors, id_col, vector_col), "whitening-rows")
        head = rows.select(F.size("y").alias("d")).first()
        d = head["d"] if head else 0
        found = fit(rows, d, k) if d else None
        if found is None:
            return vectors.sparkSession.createDataFrame([], schema)
        error = identity_error(rows, d, found)
        p, n, s, explained = found.scaled(), found.n, found.s, found.values / (found.trace or 1.0)
        k = p.shape[1]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, ROWS):
                    part = batch.slice(a, ROWS)
                    y, count = blocks(part, d), part.num_rows
                    each = np.repeat(np.arange(count), k)
                    columns = [part.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)), pa.array(np.full(count * k, n)), pa.array(deviations(y, n, s), pa.int64()).take(pa.array(each))]
                    columns += [pa.array((centred(y, n, s) @ p).ravel()), pa.array(np.tile(explained, count)), pa.array(np.full(count * k, error))]
                    yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

        return stored(rows.mapInArrow(run, schema), "whitened")
