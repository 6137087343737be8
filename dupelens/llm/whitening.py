"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers, so that rows can be told apart and summed exactly; each distinct vector is fitted once. With X
the centred rows of the fit, the bidiagonalisation takes one pass over the rows per step: the rows give w = X q and add
up X'w, a vector of as many numbers as there are dimensions, in sums that Spark combines. Nothing else leaves the tasks, and
no row is ever written again.

The left vectors u = X p are not stored: they are products with the rows, so p, of the length of a row, stands for u, and
products of w with all earlier u are P'(X'w). Both sides are made orthogonal to all earlier vectors in every step, the right one
twice. Where a step ends in a zero (few different rows, repeated eigenvalues), a new direction starts a further block, so that
the steps always span all dimensions. The singular values and right vectors of the small bidiagonal matrix give the
deviations and components.

Defined cases: rows whose vector is null or holds a null or non-finite entry, or one of 2^40 or more in size, are left out, and so
are empty vectors and those of another length than most rows have (of two equally frequent lengths the longer counts). Null ids
stay, repeated rows are fitted once and returned each. Components without any variance (one part in 10^22 of the
greatest, or less) are left out, so a table with less than two different vectors gives no rows, like an empty one. Other columns
are left out. ``deviation`` is null where it does not fit into a long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dupelens.llm.tables import keep

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
LARGEST = float(1 << 40)
#: Lengths below this part of the size of all rows are rounding.
NOTHING = 1e-13
LEAST_SHARE = 1e-11
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Centre:
    """Number of fitted rows and exact sums: a row minus the mean is (x - whole) - rest / n."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    def of(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n


@dataclass(frozen=True)
class Whitening:
    """Unit components as columns, by falling deviation (the singular values over the root of n)."""

    centre: Centre
    components: np.ndarray
    deviations: np.ndarray
    explained: np.ndarray
    identity_error: float


def usable(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, v)`` of the rows that take part, entries as doubles."""
    plain = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST))
    sound = plain.where(F.col("v").isNotNull() & (F.size("v") > 0)).where(~F.coalesce(bad, F.lit(False)))
    lengths = sound.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return sound.where(F.size("v") == (lengths[0]["d"] if lengths else 0))


def whole_numbers(column: pa.ListArray) -> np.ndarray:
    """A row of whole numbers for each vector of a batch."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return (np.floor(SCALE * flat).astype(np.int64) + SHIFT).reshape(len(column), -1)


def fit_list(rows: DataFrame) -> DataFrame:
    """``(x)``: each distinct vector of whole numbers once, as 8 bytes per entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = whole_numbers(batch.column(0))
                yield pa.RecordBatch.from_arrays([pa.array([row.tobytes() for row in x], pa.binary())], names=["x"])

    return keep(rows.select("v").mapInArrow(run, "x binary").distinct(), "whitening-fit")


def summed(fitted: DataFrame, part: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> list:
    """The sum of ``part(rows)``, a vector, over all rows of the fit list; tasks add up their own batches first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                column = batch.column(0)
                _, _, data = column.buffers()
                size = len(column[0].as_py())
                first = int(np.frombuffer(column.buffers()[1], np.int32, 1, 4 * column.offset)[0])
                x = np.frombuffer(data, np.int64, len(column) * size // 8, first).reshape(len(column), -1)
                own = part(x)
                total = own if total is None else total + own
        if total is not None:
            values = pa.array([str(v) for v in total.tolist()], pa.string()) if kind != "double" else pa.array(total, pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), values], names=["at", "value"])

    if kind == "double":
        sums = fitted.mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    else:
        exact = fitted.mapInArrow(run, "at int, value string").select("at", F.col("value").cast("decimal(38,0)").alias("value"))
        sums = exact.groupBy("at").agg(F.sum("value").alias("value"))
    return [row["value"] for row in sorted(sums.collect(), key=lambda r: r["at"])]


def centre_of(fitted: DataFrame) -> Centre | None:
    """Exact count and sums; none for an empty list."""
    totals = summed(fitted, lambda x: np.append(x.sum(axis=0), len(x)).astype(object), "decimal")
    if not totals:
        return None
    *sums, n = (int(t) for t in totals)
    return Centre(n, np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.float64))


def bidiagonalise(product: Callable[[np.ndarray], tuple[np.ndarray, float]], d: int, size: float) -> tuple[np.ndarray, np.ndarray]:
    """Right vectors (columns) and upper bidiagonal matrix of X, given ``product(q)`` = (X'Xq, |Xq|^2)."""
    random = np.random.default_rng(12)
    right, behind, images = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))
    bidiagonal = np.zeros((d, d))

    def apart(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - right @ (right.T @ v)
        return v

    v, beta = random.standard_normal(d), 0.0
    v /= np.linalg.norm(v)
    for j in range(d):
        right = np.column_stack([right, v])
        # w = X v - beta u, as a product with the rows; then w loses what it has in common with the earlier u.
        q = v - beta * behind[:, -1] if beta else v
        image, square = product(q)
        common = behind.T @ image
        q, image, square = q - behind @ common, image - images @ common, square - float(common @ common)
        alpha = np.sqrt(max(square, 0.0))
        if alpha <= NOTHING * size:
            alpha, p, image = 0.0, np.zeros(d), np.zeros(d)
        else:
            p, image = q / alpha, image / alpha
        behind, images = np.column_stack([behind, p]), np.column_stack([images, image])
        bidiagonal[j, j] = alpha
        if j + 1 == d:
            break
        v = apart(image - alpha * v)
        beta = float(np.linalg.norm(v))
        if beta <= NOTHING * size:
            beta, v = 0.0, apart(random.standard_normal(d))
            v /= np.linalg.norm(v)
        else:
            v = apart(v / beta)
            v /= np.linalg.norm(v)
        bidiagonal[j, j + 1] = beta
    return right, bidiagonal


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Components and deviations of the usable rows; none where no direction has any variance."""
    fitted = fit_list(rows)
    centre = centre_of(fitted)
    if centre is None:
        return None
    d = len(centre.whole)
    total = summed(fitted, lambda x: np.array([np.square(centre.of(x)).sum()]))[0]

    def product(q: np.ndarray) -> tuple[np.ndarray, float]:
        def part(x: np.ndarray) -> np.ndarray:
            centred = centre.of(x)
            w = centred @ q
            return np.append(centred.T @ w, w @ w)

        *image, square = summed(fitted, part)
        return np.array(image), square

    if total <= 0:
        return None
    right, bidiagonal = bidiagonalise(product, d, float(np.sqrt(total)))
    _, values, turned = np.linalg.svd(bidiagonal)
    chosen = [i for i in range(min(components, d)) if values[i] > LEAST_SHARE * values[0]]
    axes = right @ turned[chosen].T
    axes /= np.linalg.norm(axes, axis=0)
    deviations = values[chosen] / np.sqrt(centre.n)
    k = len(chosen)

    def spread(x: np.ndarray) -> np.ndarray:
        white = centre.of(x) @ axes / deviations
        return np.concatenate([white.sum(axis=0), (white.T @ white).ravel()])

    sums = np.array(summed(fitted, spread)) / centre.n
    covariance = sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k])
    error = float(np.abs(covariance - np.eye(k)).max())
    return Whitening(centre, axes, deviations, values[chosen] ** 2 / total, error)


def exact_deviation(centre: Centre, x: np.ndarray) -> list[int | None]:
    """The sum over dimensions of (n x - S)^2, without rounding."""
    away, rest, n = x - centre.whole, centre.rest.astype(np.int64), centre.n
    if len(x) and max(int(np.abs(away).max()), int(rest.max())) >= 1 << 26:
        away, rest = away.astype(object), rest.astype(object)
    squares, mixed, fixed = (away * away).sum(axis=1), (away * rest).sum(axis=1), int((rest.astype(object) ** 2).sum())
    exact = [n * n * int(a) - 2 * n * int(b) + fixed for a, b in zip(squares, mixed, strict=True)]
    return [v if v < 1 << 63 else None for v in exact]


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``RESULT``: a row for each usable row of the table and each component, numbered from 1 by falling variance."""
    rows = usable(embeddings)
    model = fit(rows, components)
    if model is None:
        return rows.sparkSession.createDataFrame([], RESULT)
    names = [field.split()[0] for field in RESULT.split(", ")]
    scaled, k = model.components / model.deviations, len(model.deviations)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = batch.num_rows
            if not count:
                continue
            x = whole_numbers(batch.column(1))
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(count), k)))
            deviation = pa.array(exact_deviation(model.centre, x), pa.int64()).take(pa.array(np.repeat(np.arange(count), k)))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                    pa.array(np.full(count * k, model.centre.n, np.int64)),
                    deviation,
                    pa.array((model.centre.of(x) @ scaled).ravel()),
                    pa.array(np.tile(model.explained, count)),
                    pa.array(np.full(count * k, model.identity_error)),
                ],
                names=names,
            )

    return rows.mapInArrow(run, RESULT)
