"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The vectors are read as whole numbers of 1/256. Every distinct vector is written once, in blocks, to the shared folder (the fit list). With X
the centred fit list, each step of the bidiagonalisation is one pass over the blocks that forms the left vector Xv, its inner products with all
left vectors before it, and Xᵀ of it. A left vector has as many entries as the list has rows, so it is never stored: it is X times a
short vector, which the driver keeps beside the right vectors. Both sides are reorthogonalised in full. The singular values of the small
bidiagonal matrix are the deviations, its right vectors the components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweave.llm.common import written

SCALE = 256
COMPONENTS = 4
BLOCK_ROWS = 2048
#: Parts of the whole below which double precision cannot tell a value from nothing: of lengths in a step, and of the variance.
NO_LENGTH, NO_VARIANCE = 1e-11, 1e-13


@dataclass
class Whitening:
    """``n`` and ``sums`` of the fit list, components (rows of unit length), their variances, and the variance of all dimensions together."""

    n: int
    sums: np.ndarray
    largest: int
    components: np.ndarray
    variances: np.ndarray
    total: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x - self.sums / self.n

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.variances)[:, None]).T


def whole_numbers(vectors: DataFrame, vector: str = "embedding", id_col: str = "vec_id") -> tuple[DataFrame, int]:
    """``vec_id`` and ``x`` (its numbers as 64-bit integers in bytes) of each row whose vector is whole and finite, and the dimension.

    Shorter vectors are read with zeros behind them. Numbers beyond 2^54 or so, whose 256-fold is no long, raise.
    """
    entry = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    whole = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector).alias("vector")).where(F.col("vector").isNotNull() & F.forall("vector", entry))
    size = whole.agg(F.coalesce(F.max(F.size("vector")), F.lit(0))).first()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            flat = np.floor(SCALE * pc.list_flatten(lists).cast(pa.float64()).to_numpy(zero_copy_only=False))
            if len(flat) and np.abs(flat).max() >= 2.0**62:
                raise ValueError("an entry is too large to be a whole number of 1/256")
            x = np.zeros((batch.num_rows, size), np.int64)
            x[np.arange(size) < lengths[:, None]] = flat.astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([row.tobytes() for row in x], pa.binary())], ["vec_id", "x"])

    kind = vectors.schema[id_col].dataType.simpleString()
    return whole.mapInArrow(run, f"vec_id {kind}, x binary"), size


def fit_list(numbers: DataFrame) -> DataFrame:
    """Each distinct vector once, in written blocks of some thousand. Copies are folded before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("x").to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(rows[a : a + BLOCK_ROWS]) for a in range(0, len(rows), BLOCK_ROWS)], pa.binary())], ["block"])

    return written(numbers.select("x").distinct().mapInArrow(run, "block binary"), "fit-list")


def summed(blocks: DataFrame, size: int, measure: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """The sum over all blocks of a vector measured on each; at most one vector a task is shuffled, and its sum is small."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for block in batch.column("block"):
                found = measure(np.frombuffer(block.as_buffer(), np.int64).reshape(-1, size))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["place", "value"])

    rows = blocks.mapInArrow(run, f"place int, value {kind}").groupBy("place").agg(F.sum("value").alias("value")).collect()
    return np.array([r["value"] for r in sorted(rows)])


def _orthogonal(r: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``r`` without its parts along the rows of ``basis``, twice, as once leaves rounding behind."""
    for _ in range(2):
        r = r - basis.T @ (basis @ r)
    return r


def bidiagonalise(product: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], size: int, length: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Right vectors V (rows) and the upper bidiagonal B of X V = U B, after ``steps`` steps.

    ``product(w, W)`` gives, for y = Xw, the inner products of y with y and with each row of W times X, and Xᵀy; ``length`` is the root of
    the sum of squares of X. Where X has no part left along a right vector, or a right vector none outside those before it, the next step
    starts from a new direction, so equal singular values come out as often as they occur.
    """
    draw = np.random.default_rng(12)
    right = _orthogonal(draw.standard_normal(size), np.zeros((0, size)))[None]
    right /= np.linalg.norm(right)
    short, back = np.zeros((0, size)), np.zeros((0, size))  # w and Xᵀu of each left vector u = Xw
    diagonal, upper = [], []
    for step in range(steps):
        v = right[step]
        w = v - (upper[-1] * short[-1] if step else 0.0)
        inner, z = product(w, short)
        # the recurrence has taken out the last left vector; what rounding left of all others is taken out here
        w, z = w - short.T @ inner[1:], z - back.T @ inner[1:]
        alpha = float(np.sqrt(max(inner[0] - inner[1:] @ inner[1:], 0.0)))
        if alpha <= NO_LENGTH * length:
            alpha, w, z = 0.0, np.zeros(size), np.zeros(size)
        else:
            w, z = w / alpha, z / alpha
        diagonal.append(alpha)
        short, back = np.vstack([short, w]), np.vstack([back, z])
        if step + 1 == steps:
            break
        r = _orthogonal(z - alpha * v, right)
        beta = float(np.linalg.norm(r))
        if beta <= NO_LENGTH * length:
            beta, r = 0.0, _orthogonal(draw.standard_normal(size), right)
        upper.append(beta)
        right = np.vstack([right, _orthogonal(r / np.linalg.norm(r), right)])
        right[-1] /= np.linalg.norm(right[-1])
    return right, np.diag(diagonal) + np.diag(upper, 1)


def fit(blocks: DataFrame, size: int, components: int = COMPONENTS, steps: int | None = None) -> Whitening | None:
    """The whitening of a fit list; nothing without rows or without variance.

    Without ``steps`` the bidiagonalisation runs through all dimensions, which settles close and equal variances as well.
    """
    if not size:
        return None
    square = lambda x: np.r_[len(x), x.sum(axis=0), np.abs(x).max(initial=0)]
    first = summed(blocks, size, square, "long")
    if not len(first):
        return None
    n, sums = int(first[0]), first[1 : 1 + size].astype(np.int64)
    # the sum of the largest entries of all tasks is a bound for each
    model = Whitening(n, sums, int(first[-1]), np.zeros((0, size)), np.zeros(0), 0.0)
    if n * model.largest >= 1 << 62:
        raise ValueError("the sums of the fit list are no longs")
    length = float(summed(blocks, size, lambda x: np.array([(model.centred(x) ** 2).sum()]))[0])
    if length <= 0:
        return None
    model.total = length / n

    def product(w: np.ndarray, earlier: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def measure(x: np.ndarray) -> np.ndarray:
            rows = model.centred(x)
            y = rows @ w
            return np.r_[y @ y, (rows @ earlier.T).T @ y, rows.T @ y]

        found = summed(blocks, size, measure)
        return found[: len(found) - size], found[len(found) - size :]

    right, small = bidiagonalise(product, size, np.sqrt(length), min(steps or size, size))
    _, values, turned = np.linalg.svd(small)
    variances = values**2 / n
    kept = min(components, int((variances > NO_VARIANCE * model.total).sum()))
    found = turned[:kept] @ right
    found /= np.linalg.norm(found, axis=1)[:, None]
    model.components = found * np.sign(found[np.arange(kept), np.abs(found).argmax(axis=1)])[:, None]
    model.variances = variances[:kept]
    model.identity_error = _identity_error(blocks, size, model)
    return model


def _identity_error(blocks: DataFrame, size: int, model: Whitening) -> float:
    """How far the covariance of the whitened fit list is from the identity, in its worst entry."""
    k = len(model.components)
    if not k:
        return 0.0

    def measure(x: np.ndarray) -> np.ndarray:
        y = model.project(x)
        return np.r_[y.sum(axis=0), (y.T @ y).ravel()]

    found = summed(blocks, size, measure) / model.n
    covariance = found[k:].reshape(k, k) - np.outer(found[:k], found[:k])
    return float(np.abs(covariance - np.eye(k)).max())


def deviations(x: np.ndarray, model: Whitening) -> pa.Array:
    """For each row the sum of (n x - S)^2 over the dimensions, exact, as a decimal."""
    bound = model.n * (model.largest + int(np.abs(model.sums).max(initial=0)) // model.n + 1)
    if x.shape[1] * bound * bound < 1 << 63:
        return pa.array(((model.n * x - model.sums) ** 2).sum(axis=1)).cast(pa.decimal128(38, 0))
    wide = ((model.n * x.astype(object) - model.sums.astype(object)) ** 2).sum(axis=1)
    return pa.array([Decimal(v) for v in wide], pa.decimal128(38, 0))


def whiten(vectors: DataFrame, vector: str = "embedding", id_col: str = "vec_id", components: int = COMPONENTS, steps: int | None = None) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each row with a whole, finite vector and each component.

    Rows whose vector is null or holds null, NaN or infinity go. Rows are taken one by one, so repeated rows and null ids come out as
    they went in; other columns are not read. The components are fitted on each distinct vector once. Where the fit list has fewer directions
    with variance than ``components`` (none, for a single distinct vector), there are as many rows. ``deviation`` is a decimal of 38 digits.
    """
    numbers, size = whole_numbers(vectors, vector, id_col)
    model = fit(fit_list(numbers), size, components, steps) if size else None
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if model is None or not len(model.components):
        return numbers.sparkSession.createDataFrame([], schema)
    k = len(model.components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.int64).reshape(-1, size)
            each = pa.array(np.repeat(np.arange(len(x)), k))
            number = np.tile(np.arange(k), len(x))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(each), pa.array((number + 1).astype(np.int32)), pa.array(np.full(len(number), model.n, np.int64)), deviations(x, model).take(each),
                 pa.array(model.project(x).ravel()), pa.array((model.variances / model.total)[number]), pa.array(np.full(len(number), model.identity_error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return numbers.mapInArrow(run, schema)
