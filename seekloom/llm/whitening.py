"""Whitening of embeddings along their largest principal components, by contour integration.

Vectors become whole numbers, ``floor(256 * c)``. The covariance of the distinct ones is summed
by Spark. Its largest eigenvalues are bracketed by inertia counts. FEAST then projects a random
block onto the eigenvectors inside the bracket: the resolvent is integrated over a circle around
it, by complex shifted solves at the nodes of a quadrature. Rayleigh-Ritz extracts the
components from the projected block; it is repeated until residuals are at rounding level, and
the number of components found has to equal the inertia count.

Rows whose vector is null, or holds null, NaN or infinite entries are dropped, and so are rows
of another length than most rows have (of lengths that are equally frequent the greatest
counts). Numbers past the range of a long are its limits. Equal vectors count once in the
covariance; every row is whitened. Directions without variance are no components, so fewer than
asked may be found, and none when all vectors are equal. Other columns are ignored. An empty
table gives no rows. The driver holds one matrix of dimension times dimension.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekloom.llm.batches import as_batch
from seekloom.session import cut_lineage

#: Quadrature nodes on the upper half of the circle.
NODES = 8
_ROWS = 4096
_EPSILON = np.finfo(np.float64).eps


def inertia(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are above ``shift``: positive pivots of LDL'."""
    size = np.abs(matrix).max() + abs(shift) or 1.0
    while True:
        left = matrix - shift * np.eye(len(matrix))
        above = 0
        for k in range(len(left)):
            pivot = left[k, k]
            if abs(pivot) < 1e-11 * size:
                break
            above += pivot > 0
            row = left[k, k + 1 :].copy()
            left[k + 1 :, k + 1 :] -= np.multiply.outer(row / pivot, row)
        else:
            return above
        shift += 1e-9 * size


def bracket(matrix: np.ndarray, wanted: int, extra: int = 8) -> tuple[float, float, int]:
    """Bounds with ``wanted`` eigenvalues or up to ``extra`` more between them, and their number.

    Counts are bisected until few enough are left; then the lower bound goes to the middle of
    the widest gap that a grid of shifts shows. Of more than that many equal eigenvalues all
    are inside.
    """
    n = len(matrix)
    high = float(np.abs(matrix).sum(axis=1).max()) * (1 + 1e-6)
    seen = {high: 0, -1e-6 * high: n}

    def ends() -> tuple[float, float]:
        return min(s for s, c in seen.items() if c < wanted), max(s for s, c in seen.items() if c >= wanted)

    few, enough = ends()
    while seen[enough] > min(n, wanted + extra) and few - enough > 1e-13 * high:
        middle = (few + enough) / 2
        seen[middle] = inertia(matrix, middle)
        few, enough = ends()
    for shift in np.linspace(enough, few, 14)[1:-1].tolist():
        seen[shift] = inertia(matrix, shift)
    groups: dict[int, list[float]] = {}
    for shift, count in seen.items():
        if count >= wanted and shift >= enough:
            groups.setdefault(count, []).append(shift)
    count, inside = max(groups.items(), key=lambda g: (max(g[1]) - min(g[1]), g[0]))
    return (max(inside) + min(inside)) / 2, high, count


def feast(matrix: np.ndarray, wanted: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns.

    Eigenvalues at the level of rounding are left out.
    """
    n = len(matrix)
    scale = float(np.trace(matrix))
    if not n or not scale > 0:
        return np.empty(0), np.empty((n, 0))
    work = (matrix + matrix.T) / (2 * scale)
    wanted = min(wanted, n)
    low, high, count = bracket(work, wanted)
    centre, radius = (low + high) / 2, (high - low) / 2
    angles, weights = np.polynomial.legendre.leggauss(NODES)
    points = np.exp(0.5j * np.pi * (angles + 1))
    random = np.random.default_rng(seed)
    columns = min(n, count + count // 2 + 4)
    while True:
        block = random.standard_normal((n, columns))
        best = np.inf
        for _ in range(40):
            projected = np.zeros((n, columns))
            for point, weight in zip(points, weights, strict=True):
                solved = np.linalg.solve((centre + radius * point) * np.eye(n) - work, block.astype(np.complex128))
                projected += 0.5 * weight * (radius * point * solved).real
            basis, _ = np.linalg.qr(projected)
            values, turned = np.linalg.eigh(basis.T @ work @ basis)
            block = basis @ turned
            found = values > low
            residual = np.linalg.norm(work @ block - block * values, axis=0)[found].max(initial=0.0)
            if residual < 1e-10 * high and residual > best / 2:
                break
            best = min(best, residual)
        if found.sum() == count or columns == n:
            break
        columns = min(n, 2 * columns)
    order = np.argsort(-values)[:wanted]
    order = order[values[order] > n * n * _EPSILON]
    vectors = block[:, order] / np.linalg.norm(block[:, order], axis=0)
    # Signs are a convention: the entry of largest size is positive.
    top = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))]
    return values[order] * scale, vectors * np.where(top < 0, -1.0, 1.0)


def whole_numbers(embeddings: DataFrame, key: str, column: str) -> DataFrame:
    """``(key, x)`` of the rows with a complete vector of the common length."""
    vector = F.col(column)
    broken = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    valid = embeddings.where(vector.isNotNull() & ~broken)
    lengths = valid.groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    size = lengths["n"] if lengths else 0
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * 256))
    return valid.where((F.size(vector) == size) & (F.size(vector) > 0)).select(F.col(key).cast("long").alias(key), x.alias("x"))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            part = batch.slice(start, _ROWS)
            yield part, part.column("x").flatten().to_numpy().reshape(part.num_rows, -1)


def _exact_sum(rows: np.ndarray) -> list[int]:
    if len(rows) * int(np.abs(rows.astype(np.float64)).max(initial=0)) < 2**62:
        return rows.sum(axis=0).tolist()
    return rows.astype(object).sum(axis=0).tolist()


def totals(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("at", pa.int64()), ("total", pa.decimal128(38, 0))])
        sums, n = [], 0
        for _, rows in _matrices(batches):
            own = _exact_sum(rows)
            sums = [a + b for a, b in zip(sums, own, strict=True)] if n else own
            n += len(rows)
        if n:
            yield as_batch(schema, range(-1, len(sums)), [Decimal(v) for v in (n, *sums)])

    parts = fit.mapInArrow(add, "at long, total decimal(38,0)")
    found = {r["at"]: int(r["total"]) for r in parts.groupBy("at").agg(F.sum("total").alias("total")).collect()}
    return found.pop(-1, 0), [found[i] for i in sorted(found)]


def _means(n: int, sums: list[int]) -> np.ndarray:
    return np.array([s / n for s in sums], dtype=np.float64)


def covariance(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Covariance matrix, divisor ``n``; entries are centred before they are multiplied."""
    mean, size = _means(n, sums), len(sums)
    rows_at, columns_at = np.triu_indices(size)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("at", pa.int64()), ("total", pa.float64())])
        products = None
        for _, rows in _matrices(batches):
            centred = rows - mean
            own = centred.T @ centred
            products = own if products is None else products + own
        if products is not None:
            yield as_batch(schema, np.arange(len(rows_at)), products[rows_at, columns_at])

    parts = fit.mapInArrow(multiply, "at long, total double")
    out = np.zeros((size, size))
    for r in parts.groupBy("at").agg(F.sum("total").alias("total")).collect():
        out[rows_at[r["at"]], columns_at[r["at"]]] = out[columns_at[r["at"]], rows_at[r["at"]]] = r["total"] / n
    return out


def _projected(rows: np.ndarray, mean: np.ndarray, values: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    return (rows - mean) @ vectors / np.sqrt(values)


def identity_error(fit: DataFrame, mean: np.ndarray, values: np.ndarray, vectors: np.ndarray) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity.

    Each task gives its count, means and centred products, which are merged.
    """

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("n", pa.int64()), ("mean", pa.list_(pa.float64())), ("products", pa.list_(pa.float64()))])
        held = None
        for _, rows in _matrices(batches):
            white = _projected(rows, mean, values, vectors)
            own = white.mean(axis=0)
            held = merged(held, (len(white), own, (white - own).T @ (white - own)))
        if held:
            yield as_batch(schema, [held[0]], [held[1].tolist()], [held[2].ravel().tolist()])

    k, held = len(values), None
    for r in fit.mapInArrow(describe, "n long, mean array<double>, products array<double>").toLocalIterator():
        held = merged(held, (r["n"], np.array(r["mean"]), np.array(r["products"]).reshape(k, k)))
    return float(np.abs(held[2] / held[0] - np.eye(k)).max()) if held and k else 0.0


def merged(one: tuple | None, two: tuple) -> tuple:
    """Count, means and centred products of two groups together."""
    if one is None:
        return two
    n = one[0] + two[0]
    apart = two[1] - one[1]
    return n, one[1] + apart * (two[0] / n), one[2] + two[2] + np.outer(apart, apart) * (one[0] * two[0] / n)


def deviations(rows: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of ``(n * x - sum) ** 2``, exact; null where a long can't hold it."""
    most = n * int(np.abs(rows.astype(np.float64)).max(initial=0)) + max(map(abs, sums))
    if most * most * len(sums) < 2**63:
        apart = n * rows - np.array(sums, dtype=np.int64)
        return (apart * apart).sum(axis=1).tolist()
    apart = rows.astype(object) * n - np.array(sums, dtype=object)
    return [v if v < 2**63 else None for v in (apart * apart).sum(axis=1).tolist()]


def whiten(embeddings: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = 4) -> DataFrame:
    """One row per vector and component: its whitened coordinate, and what the fit is worth.

    ``explained`` is the component's share of the variance; ``identity_error`` is one value for
    all rows, measured on the distinct vectors.
    """
    vectors = whole_numbers(embeddings, key, column)
    fit = cut_lineage(vectors.select("x").distinct())
    n, sums = totals(fit)
    matrix = covariance(fit, n, sums) if n else np.empty((0, 0))
    values, directions = feast(matrix, components)
    mean = _means(n, sums)
    error = identity_error(fit, mean, values, directions)
    shares, k = values / max(float(np.trace(matrix)), 5e-324), len(values)
    schema = pa.schema(
        [(key, pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64())]
        + [(name, pa.float64()) for name in ("whitened", "explained", "identity_error")]
    )

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows in _matrices(batches):
            count = len(rows)
            yield as_batch(
                schema,
                batch.column(key).take(pa.array(np.repeat(np.arange(count), k))),
                np.tile(np.arange(1, k + 1, dtype=np.int32), count),
                np.full(count * k, n),
                [d for d in deviations(rows, n, sums) for _ in range(k)],
                _projected(rows, mean, values, directions).ravel(),
                np.tile(shares, count),
                np.full(count * k, error),
            )

    names = f"{key} long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not k:
        return embeddings.sparkSession.createDataFrame([], names)
    return vectors.mapInArrow(project, names)
