"""Embedding whitening by spectrum slicing.

Entries become longs, ``x = floor(64 * c) + 1000000``. Two scans give the sums
and, around the nearest whole centre, the sums of products; both are whole
numbers, so the covariance is exact until its last division. The leading
eigenpairs come from spectrum slicing: the LDL^T factors of the covariance less
a shift have as many positive pivots as eigenvalues lie above the shift
(Sylvester), so bisection on that count isolates one eigenvalue after another;
Rayleigh quotient iteration then converges cubically, and its result stands
only if quotient and residual prove it to lie in the isolated interval, whose
two counts certify its number. Eigenvalues that agree to rounding are solved
together as one block. A third scan measures the covariance of the whitened
rows, a fourth writes them.

Edge cases: vectors that are NULL or hold a NULL or a non-finite entry take no
part; shorter and empty vectors count as padded with entries 0; entries beyond
2^40 / 64 in size are cut to that; repeated rows count as often as they come,
and a NULL vec_id is kept; components with a variance of at most 1e-10 of the
whole are not there (equal vectors, a single row: no rows); an empty table
gives no rows; a deviation beyond 64 bits is cut to the largest long; extra
columns are ignored.

Scale: rows are never shuffled. A task sends one number for each dimension, or
pair of dimensions, into partial aggregates; the driver sees only those sums,
whose size follows the vectors' width and not the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txpipe.llm.common import table

SCALE = 64.0
SHIFT = 1_000_000
COMPONENTS = 32
LEAST = 1e-10  # of the trace: smaller eigenvalues cannot be told from rounding
WIDEST = 1 << 40
CELLS = 1 << 20  # matrix entries worked on at once
_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id, embedding`` of the rows that take part."""
    finite = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.where(F.col("embedding").isNotNull() & F.forall("embedding", finite))


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and whole entries ``x - SHIFT``, padded to ``width``, a bounded matrix at a time."""
    step = max(1, CELLS // max(1, width))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            lists = part.column(1)
            flat = np.asarray(lists.flatten(), np.float64)
            sizes = np.diff(np.asarray(lists.offsets, np.int64))
            y = np.zeros((part.num_rows, width))
            y[np.arange(width) < sizes[:, None]] = flat
            yield part.column(0), np.clip(np.floor(SCALE * y), -WIDEST, WIDEST).astype(np.int64)


def _products(z: np.ndarray) -> np.ndarray:
    """z^T z as exact Python integers, by matrix products that stay below 2^53."""
    bits = 10 if len(z) < 1 << 20 else 5
    parts, rest = [], z
    if len(z) * float(np.abs(z).max(initial=0)) ** 2 < 2.0**53:
        f = z.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    while np.abs(rest).max(initial=0) > 0:  # digits of the same sign as the entry
        high = np.sign(rest) * (np.abs(rest) >> bits)
        parts.append((rest - (high << bits)).astype(np.float64))
        rest = high
    total = np.zeros((z.shape[1], z.shape[1]), object)
    for i, a in enumerate(parts):
        for j, b in enumerate(parts):
            total += (a.T @ b).astype(np.int64).astype(object) * (1 << bits * (i + j))
    return total


def _sums(rows: DataFrame, width: int, centre: list[int]) -> list[list[int]]:
    """Sum over rows of z z^T, z being the entries less ``centre``; each task sends
    its upper triangle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, m = np.zeros((width, width), object), np.array(centre, np.int64)
        for _, y in _blocks(batches, width):
            total += _products(y - m)
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([str(v) for v in total[i, j]], pa.string())], ["i", "j", "v"])

    out = [[0] * width for _ in range(width)]
    for r in rows.mapInArrow(run, "i int, j int, v string").groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect():
        out[r["i"]][r["j"]] = out[r["j"]][r["i"]] = int(r["v"])
    return out


@dataclass
class Moments:
    """Exact first and second moments; ``v`` is the covariance in doubles."""

    n: int
    centre: list[int]  # whole numbers next to the means of x - SHIFT
    rest: list[int]  # sums of entries less the centre
    v: np.ndarray

    @property
    def width(self) -> int:
        return len(self.centre)


def moments(rows: DataFrame) -> Moments:
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("width")).first()
    n, width = size["n"], size["width"] or 0
    if not n or not width:
        return Moments(n, [], [], np.zeros((0, 0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, object)
        for _, y in _blocks(batches, width):
            total += y.sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([str(v) for v in total], pa.string())], ["i", "v"])

    sums = {r["i"]: int(r["v"]) for r in rows.mapInArrow(run, "i int, v string").groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()}
    centre = [(2 * sums[i] + n) // (2 * n) for i in range(width)]
    rest = [sums[i] - n * centre[i] for i in range(width)]
    t = _sums(rows, width, centre)
    v = [[(n * t[i][j] - rest[i] * rest[j]) / n**2 for j in range(width)] for i in range(width)]
    return Moments(n, centre, rest, np.array(v))


def pivots_above(v: np.ndarray, shift: float) -> int:
    """Eigenvalues of ``v`` above ``shift``: positive pivots of the LDL^T factors
    of ``v - shift I`` (Bunch and Kaufman's pivots of one or two rows)."""
    a = v - shift * np.eye(len(v))
    positive, k, n, alpha = 0, 0, len(v), (1 + 17**0.5) / 8

    def swap(p: int, q: int) -> None:
        if p != q:
            a[[p, q], k:] = a[[q, p], k:]
            a[k:, [p, q]] = a[k:, [q, p]]

    while k < n:
        one = True
        if k + 1 < n:
            below = np.abs(a[k + 1 :, k])
            r = k + 1 + int(below.argmax())
            lam, own = below.max(), abs(a[k, k])
            if own < alpha * lam:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                if own * row.max() >= alpha * lam**2:
                    pass
                elif abs(a[r, r]) >= alpha * row.max():
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    one = False
        if one:
            d = a[k, k]
            positive += d > 0
            if d != 0 and k + 1 < n:
                c = a[k + 1 :, k].copy()
                a[k + 1 :, k + 1 :] -= np.outer(c, c / d)
            k += 1
        else:  # such a block has one eigenvalue of either sign
            positive += 1
            c = a[k + 2 :, k : k + 2].copy()
            if len(c):
                a[k + 2 :, k + 2 :] -= c @ np.linalg.solve(a[k : k + 2, k : k + 2], c.T)
            k += 2
    return positive


def leading(v: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues (falling, at most ``most``, above LEAST of the
    trace) and their unit eigenvectors as columns."""
    d, trace = len(v), float(np.trace(v))
    if d == 0 or not trace > 0:
        return np.empty(0), np.empty((d, 0))
    scale = float(np.abs(v).sum(axis=1).max())
    tiny = 4 * d * np.finfo(float).eps * scale
    counts: dict[float, int] = {LEAST * trace: pivots_above(v, LEAST * trace), scale + tiny: 0}
    rng = np.random.default_rng(0)

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = pivots_above(v, shift)
        return counts[shift]

    def solved(shift: float, x: np.ndarray) -> np.ndarray:
        for nudge in (0.0, tiny / d, tiny):
            try:
                y = np.linalg.solve(v - (shift + nudge) * np.eye(d), x)
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(y).all():
                return y
        return x

    def clean(x: np.ndarray, found: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - found @ (found.T @ x)
        return np.linalg.qr(x)[0]

    values: list[float] = []
    q = np.empty((d, 0))
    want = min(most, above(LEAST * trace))
    while len(values) < want:
        k = len(values) + 1
        low = max(s for s, c in counts.items() if c >= k)
        high = min(s for s, c in counts.items() if c < k)
        pair = None
        while pair is None and high - low > tiny:
            mid = (low + high) / 2
            if above(low) > k or above(high) < k - 1:  # not alone yet
                low, high = (mid, high) if above(mid) >= k else (low, mid)
                continue
            x = clean(rng.standard_normal((d, 1)), q)
            for _ in range(3):
                x = clean(solved(mid, x), q)
            rho, last = float((x.T @ v @ x).item()), np.inf
            for _ in range(12):
                r = float(np.linalg.norm(v @ x - rho * x))
                # An eigenvalue lies within r of rho: inside the interval it is number k.
                if not (low < rho - r and rho + r < high) or r >= last / 2 or r == 0:
                    break
                pair, last = (rho, x), r
                x = clean(solved(rho, x), q)
                rho = float((x.T @ v @ x).item())
            low, high = (mid, high) if above(mid) >= k else (low, mid)
        if pair is not None:
            values.append(pair[0])
            q = np.hstack([q, pair[1]])
            continue
        # Equal to rounding: as many as the counts say, solved as one block.
        block = clean(rng.standard_normal((d, max(1, above(low) - len(values)))), q)
        for _ in range(6):
            block = clean(solved((low + high) / 2, block), q)
        e, turn = np.linalg.eigh(block.T @ v @ block)
        values += e[::-1].tolist()
        q = np.hstack([q, block @ turn[:, ::-1]])
    return np.array(values[:want]), q[:, :want]


def whitener(m: Moments, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, and the matrix that whitens centred rows."""
    values, q = leading(m.v, most)
    return values, q / np.sqrt(values)


def _white(y: np.ndarray, m: Moments, p: np.ndarray) -> np.ndarray:
    return ((y - np.array(m.centre, np.int64)).astype(np.float64) - np.array([r / m.n for r in m.rest])) @ p


def identity_error(rows: DataFrame, m: Moments, p: np.ndarray) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity,
    measured over all rows."""
    k, width = p.shape[1], m.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for _, y in _blocks(batches, width):
            w = _white(y, m, p)
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
        i, j = np.indices(total.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel(), pa.float64())], ["i", "j", "v"])

    total = np.zeros((k + 1, k))
    for r in rows.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        total[r["i"], r["j"]] = r["v"]
    mean = total[k] / m.n
    return float(np.abs(total[:k] / m.n - np.outer(mean, mean) - np.eye(k)).max())


def _deviations(y: np.ndarray, m: Moments) -> list[int]:
    """Sum over dimensions of (n x - S)^2, exact."""
    off = (y - np.array(m.centre, np.int64)).astype(object) * m.n - np.array(m.rest, object)
    if not off.size or max(abs(off.max()), abs(off.min())) ** 2 * m.width < 2**63:
        return (off.astype(np.int64) ** 2).sum(axis=1).tolist()
    return [min(v, 2**63 - 1) for v in (off**2).sum(axis=1)]


def whitened(embeddings: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """One row per usable row and component; see the module's docstring."""
    rows = usable(embeddings)
    m = moments(rows)
    values, p = whitener(m, most)
    k = len(values)
    if not k:
        return rows.sparkSession.createDataFrame([], _OUT)
    error = identity_error(rows, m, p)
    share = values / float(np.trace(m.v))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, y in _blocks(batches, m.width):
            b = len(y)
            each = np.repeat(np.arange(b), k)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), b), pa.int32()), pa.array(np.full(b * k, m.n), pa.int64()), pa.array(np.repeat(np.array(_deviations(y, m), np.int64), k)),
                 pa.array(_white(y, m, p).ravel()), pa.array(np.tile(share, b)), pa.array(np.full(b * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, _OUT)


def op13_spectrum_slicing_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
