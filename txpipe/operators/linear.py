"""Many linear classifiers fitted over shared passes (M6, M8 inside M10).

Cross-validation fits logistic regressions and support vector machines for
each fold and grid point, and MLlib reads all rows anew for every one. Here
the rows become blocks of numbers once, and one pass over them gives loss and
gradient of all models of all folds that wait for one. Each model goes the way
of MLlib's: features scaled and centred by its own training rows, the same
start, and Breeze's OWL-QN step by step. Points that differ in ``maxIter``
alone are one model: fewer iterations are the first ones of more. A last pass
counts the predictions on the folds left out.

What is not plain (a fold without rows or without both labels, labels besides
0 and 1, values that are not finite, a line search that fails) is left out of
the answer, and MLlib fits it.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txpipe.session import work_path

KINDS = ("logistic_regression", "svm")
ROWS = 1_024  # rows in a block
GROUP_BYTES = 8 << 20
_MEMORY = 10  # MLlib's corrections kept by OWL-QN
_SEARCHES = 20
_FOUND = pa.schema([("task", pa.int64()), ("key", pa.int64()), ("arrays", pa.list_(pa.binary())), ("shapes", pa.list_(pa.list_(pa.int64())))])


class Unsure(Exception):
    """The optimizer got where MLlib would start anew or give up."""


def blocks(data: DataFrame, fold: str, features: str, label: str) -> DataFrame:
    """``fold, y, x``: rows of one fold as float64 bytes; ``y`` is NULL where a
    row is not plain. Rows without a fold are left out, as comparisons do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folds, y, x = (batch.column(i) for i in range(3))
            plain = not (y.null_count or x.null_count or x.flatten().null_count)
            found = folds.to_numpy(zero_copy_only=False)
            values, labels = np.empty((len(found), 0)), None
            if plain:
                flat, labels = x.flatten().to_numpy(zero_copy_only=False), y.to_numpy(zero_copy_only=False)
                plain = len(found) > 0 and len(flat) % len(found) == 0 and bool(np.isfinite(flat).all()) and bool(np.isin(labels, (0.0, 1.0)).all())
                values = flat.reshape(len(found), -1) if plain else values
            for f in np.unique(found):
                of = np.flatnonzero(found == f)
                for at in range(0, len(of), ROWS):
                    some = of[at : at + ROWS]
                    row = [int(f)], [labels[some].tobytes() if plain else None], [values[some].tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, (pa.int64(), pa.binary(), pa.binary()), strict=True)], ["fold", "y", "x"])

    rows = data.where(F.col(fold).isNotNull()).select(F.col(fold).cast("long").alias("fold"), F.col(label).cast("double").alias("y"), vector_to_array(F.col(features)).alias("x"))
    made, path = rows.mapInArrow(run, "fold long, y binary, x binary"), work_path(data.sparkSession, "linear-blocks")
    # Spark reads thousands of rows of a row group at once: small groups keep that small.
    made.write.option("parquet.block.size", GROUP_BYTES).option("parquet.block.size.row.check.min", 1).parquet(path)
    return data.sparkSession.read.schema(made.schema).parquet(path)


def _each(blocked: DataFrame, step, merge) -> list[tuple[int, list[np.ndarray]]]:
    """``step(fold, x, y)`` gives arrays, or None; those of a task are merged.
    Returns the tasks' arrays by key in order of the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for f, y, x in zip(*(batch.column(i) for i in range(3)), strict=True):
                if not y.is_valid:
                    raise ValueError("rows that are not plain")
                labels = np.frombuffer(y.as_buffer(), np.float64)
                for key, arrays in step(f.as_py(), np.frombuffer(x.as_buffer(), np.float64).reshape(len(labels), -1), labels):
                    held[key] = merge(held[key], arrays) if key in held else arrays
        for key, arrays in held.items():
            row = {"task": TaskContext.get().partitionId(), "key": key, "arrays": [np.asarray(a, np.float64).tobytes() for a in arrays], "shapes": [list(a.shape) for a in arrays]}
            yield pa.RecordBatch.from_pylist([row], _FOUND)

    rows = blocked.mapInArrow(run, "task long, key long, arrays array<binary>, shapes array<array<bigint>>").collect()
    rows.sort(key=lambda r: (r["task"], r["key"]))
    return [(r["key"], [np.frombuffer(a, np.float64).reshape(s) for a, s in zip(r["arrays"], r["shapes"], strict=True)]) for r in rows]


def _moments(fold: int, x: np.ndarray, y: np.ndarray):
    """Rows, mean and squares about it, and rows of label 1. Taken about the
    first row: a constant column has no spread at all."""
    d = x - x[0]
    mean = d.mean(axis=0)
    yield fold, [np.float64(len(y)), x[0] + mean, ((d - mean) ** 2).sum(axis=0), np.float64(y.sum())]


def _joined(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    n = a[0] + b[0]
    delta = b[1] - a[1]
    return [n, a[1] + delta * (b[0] / n), a[2] + b[2] + delta**2 * (a[0] * b[0] / n), a[3] + b[3]]


def _added(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    return [p + q for p, q in zip(a, b, strict=True)]


@dataclass
class Scale:
    """A training set: rows, and what makes its features those MLlib fits on."""

    rows: float
    inverse: np.ndarray
    mean: np.ndarray  # of the scaled features
    start: float  # the intercept that follows the labels

    @staticmethod
    def of(moments: list[np.ndarray]) -> Scale:
        n, mean, squares, ones = moments
        std = np.sqrt(squares / (n - 1)) if n > 1 else np.zeros_like(mean)
        inverse = np.divide(1.0, std, out=np.zeros_like(std), where=std != 0)
        return Scale(float(n), inverse, mean * inverse, float(np.log(ones / (n - ones))))

    def plain(self, w: np.ndarray) -> tuple[np.ndarray, float]:
        """Coefficients and intercept for features as they come."""
        return w[:-1] * self.inverse, float(w[-1] - w[:-1] @ self.mean)


def owlqn(x: np.ndarray, l1: np.ndarray, rounds: int, tolerance: float) -> Generator[np.ndarray, tuple[float, np.ndarray], list[np.ndarray]]:
    """Breeze's OWL-QN as MLlib calls it. Yields points and gets their value and
    gradient; returns the solutions after 0, 1, 2, ... iterations."""

    def adjusted(x, value, grad):
        low, high = grad - l1, grad + l1
        at_zero = np.where(low > 0, low, np.where(high < 0, high, 0.0))
        return value + float(np.abs(l1 * x).sum()), np.where(l1 == 0, grad, np.where(x == 0, at_zero, grad + np.sign(x) * l1))

    value, grad = yield x
    whole, slope = adjusted(x, value, grad)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    found = [x]
    while len(found) <= rounds and np.linalg.norm(slope) > max(tolerance * abs(whole), 1e-8):
        way, scale = slope.copy(), 1.0
        if steps:
            s, g = steps[0]
            if not s @ g >= 0:
                raise Unsure
            scale = (s @ g) / (g @ g)
        parts = []
        for s, g in steps:
            rho = s @ g
            a = (s @ way) / rho
            if np.isnan(a):
                raise Unsure
            parts.append((rho, a))
            way = way - a * g
        way = way * scale
        for (s, g), (rho, a) in reversed(list(zip(steps, parts, strict=True))):
            way = way + (a - (g @ way) / rho) * s
        way = -way
        way = np.where(way * slope < 0, way, 0.0)
        side = np.where(x != 0, np.sign(x), np.sign(-slope))
        first = len(found) == 1
        alpha = 0.5 / np.linalg.norm(grad) if first else 1.0
        down = float(slope @ way)
        for tries in range(_SEARCHES):  # after the last one, that step is taken
            stepped = x + way * alpha
            stepped = stepped * (np.sign(stepped) == side)
            v, g = yield stepped
            w, s = adjusted(stepped, v, g)
            along = float(s @ way)
            if not np.isfinite(w + along):
                raise Unsure
            if (w if tries else value) > whole + alpha * down * 1e-4:  # Breeze takes the value before for the first try
                by = 0.1 if first else 0.5
            elif along < 0.9 * down:
                by = 2.1
            elif along > -0.9 * down:
                by = 0.1 if first else 0.5
            else:
                break
            alpha *= by
            if not 1e-10 <= alpha <= 1e10:
                raise Unsure
        steps = [(stepped - x, g - grad), *steps][:_MEMORY]
        x, value, grad, whole, slope = stepped, v, g, w, s
        found.append(x)
    return found


def _losses(kind: str, folds: np.ndarray, weights: np.ndarray, offsets: np.ndarray):
    """Loss, and its gradient by weights and offset, of the models for which a
    block's fold is not the one left out."""

    def step(fold: int, x: np.ndarray, y: np.ndarray):
        on = np.flatnonzero(folds != fold)
        if not len(on):
            return
        margin = x @ weights[:, on]
        margin += offsets[on]
        y = y[:, None]
        if kind == "svm":
            sign = 2.0 * y - 1.0
            short = 1.0 - sign * margin
            loss, slope = np.maximum(short, 0.0), np.where(short > 0, -sign, 0.0)
        else:
            e = np.exp(-np.abs(margin))
            loss = np.log1p(e) + np.maximum(-margin, 0.0) + (1.0 - y) * margin
            slope = np.where(margin >= 0, 1.0, e) / (1.0 + e) - y
        out = np.zeros((len(x.T) + 2, len(folds)))
        out[0, on], out[1, on], out[2:, on] = loss.sum(axis=0), slope.sum(axis=0), x.T @ slope
        yield 0, [out]

    return step


def _counts(folds: np.ndarray, weights: np.ndarray, offsets: np.ndarray):
    """TP, FN, FP, TN of the models that a block's fold was left out for."""

    def step(fold: int, x: np.ndarray, y: np.ndarray):
        on = np.flatnonzero(folds == fold)
        said, true = x @ weights[:, on] + offsets[on] > 0, y[:, None] == 1
        out = np.zeros((4, len(folds)))
        out[:, on] = [(true & said).sum(axis=0), (true & ~said).sum(axis=0), (~true & said).sum(axis=0), (~true & ~said).sum(axis=0)]
        yield 0, [out]

    return step


def _summed(found: list[tuple[int, list[np.ndarray]]]) -> np.ndarray:
    return sum((arrays[0] for _, arrays in found[1:]), found[0][1][0])


def solutions(kind: str, blocked: DataFrame, settings: list[tuple[int, float, float, int, float]], scales: dict[int, Scale]) -> list[list[np.ndarray] | None]:
    """For each (fold left out, L1, L2, iterations, tolerance): the solutions by
    iterations, on scaled features, or None where the optimizer is unsure."""
    width = len(next(iter(scales.values())).mean)
    ways, out, asked = [], [None] * len(settings), {}
    for k, (f, l1, _, rounds, tolerance) in enumerate(settings):
        start = np.zeros(width + 1)
        start[-1] = scales[f].start if kind == "logistic_regression" else 0.0
        ways.append(owlqn(start, np.append(np.full(width, l1), 0.0), rounds, tolerance))
        asked[k] = next(ways[k])
    while asked:
        ks = list(asked)
        plain = [scales[settings[k][0]].plain(asked[k]) for k in ks]
        sums = _summed(_each(blocked, _losses(kind, np.array([settings[k][0] for k in ks]), np.array([w for w, _ in plain]).T, np.array([b for _, b in plain])), _added))
        for j, k in enumerate(ks):
            w, scale, l2 = asked.pop(k), scales[settings[k][0]], settings[k][2]
            loss, total, by = sums[0, j], sums[1, j], sums[2:, j]
            grad = np.append(by * scale.inverse - total * scale.mean, total) / scale.rows
            grad[:-1] += l2 * w[:-1]
            try:
                asked[k] = ways[k].send((float(loss / scale.rows + 0.5 * l2 * (w[:-1] @ w[:-1])), grad))
            except StopIteration as end:
                out[k] = end.value
            except Unsure:
                pass
    return out


def fold_counts(kind: str, est, grid: list, data: DataFrame, fold: str, folds: int, features: str, label: str) -> dict[tuple[int, int], tuple[int, int, int, int]]:
    """(fold, grid point) -> TP, FN, FP, TN on that fold of the point fitted to
    all other rows; what is not plain is missing."""
    points = [est.copy(pm) for pm in grid]
    settings = []
    for p in points:
        reg, share = p.getRegParam(), p.getElasticNetParam() if kind == "logistic_regression" else 0.0
        if kind == "logistic_regression" and not reg * share > 0:
            return {}  # MLlib takes another optimizer
        settings.append((reg * share if share else 0.0, (1.0 - share) * reg, p.getTol()))
    blocked = blocks(data, fold, features, label)
    if blocked.isEmpty() or not blocked.where("y IS NULL").isEmpty():
        return {}
    moments: dict[int, list[np.ndarray]] = {}
    for f, m in _each(blocked, _moments, _joined):
        moments[f] = _joined(moments[f], m) if f in moments else m
    scales = {}
    for f in range(folds):
        rest = [m for g, m in moments.items() if g != f]
        if f in moments and rest:
            train = rest[0]
            for m in rest[1:]:
                train = _joined(train, m)
            if 0 < train[3] < train[0]:
                scales[f] = Scale.of(train)
    runs = [(f, s) for f in scales for s in dict.fromkeys(settings)]
    if not runs:
        return {}
    most = {s: max(p.getMaxIter() for p, t in zip(points, settings, strict=True) if t == s) for s in settings}
    found = dict(zip(runs, solutions(kind, blocked, [(f, l1, l2, most[l1, l2, tol], tol) for f, (l1, l2, tol) in runs], scales), strict=True))
    models = [(f, i, scales[f].plain(xs[min(p.getMaxIter(), len(xs) - 1)])) for f in scales for i, (p, s) in enumerate(zip(points, settings, strict=True)) if (xs := found[f, s]) is not None]
    if not models:
        return {}
    counts = _summed(_each(blocked, _counts(np.array([f for f, _, _ in models]), np.array([w for _, _, (w, _) in models]).T, np.array([b for _, _, (_, b) in models])), _added))
    return {(f, i): tuple(map(int, counts[:, j])) for j, (f, i, _) in enumerate(models)}
