"""Quality classifier by positive-unlabelled learning.

Trusted positives are rows labelled of good quality; unlabelled rows are web
text of unknown quality; rows labelled bad are not used. A small network is
fitted by minimising the non-negative unbiased risk

    prior * R_p(+1) + max(0, R_u(-1) - prior * R_p(-1))

with the logistic loss. The class prior is estimated first: a discriminator of
positives against unlabelled rows orders all rows, and the prior is the least
ratio of the unlabelled to the positive share above any threshold (each share
with its sampling error on the safe side), over histograms of all rows.

Features come from whole texts only: shares of byte classes and of pairs of
neighbouring classes, word and line repetition, word length, size.

Edge cases: NULL and empty texts have zero features and get a score like any
other; a doc_id with conflicting labels is no trusted positive; repeated rows
get equal scores; with fewer than
``FEW`` unlabelled rows all learning rows, good and bad, stand in for them; without
trusted positives every score is 0.5; an empty table gives no rows; extra
columns are ignored.

Scale: features are computed once and stored; texts are not shuffled. The fit
uses at most ``POSITIVES`` and ``UNLABELLED`` rows of lowest hash, which the
driver holds; the prior's histograms and the scores cover all rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txpipe.llm.common import map_batches, remainder, stored, table, text_bytes

POSITIVES = 6_000
UNLABELLED = 12_000
FEW = 30
HIDDEN = 16
BINS = 256
HELD_OUT_MODULUS, HELD_OUT_AT = 3, 1

_GROUPS = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".", b",;:", b"'\"`", b"!?", b"()[]{}", b"|", b"#$%&*^~", b"-_/\\", b"@+=<>"]
CLASSES = len(_GROUPS) + 2  # the rest of ASCII, and bytes beyond it
_CLASS = np.full(256, len(_GROUPS), np.uint8)
_CLASS[128:] = len(_GROUPS) + 1
for _k, _group in enumerate(_GROUPS):
    _CLASS[list(_group)] = _k
WIDTH = CLASSES + CLASSES * CLASSES + 6


def features(raw: bytes) -> np.ndarray:
    out = np.zeros(WIDTH, np.float32)
    if not raw:
        return out
    kinds = _CLASS[np.frombuffer(raw, np.uint8)]
    out[:CLASSES] = np.bincount(kinds, minlength=CLASSES) / len(kinds)
    if len(kinds) > 1:
        pairs = kinds[:-1] * np.uint8(CLASSES) + kinds[1:]  # 16 classes: fits a byte
        out[CLASSES : CLASSES + CLASSES * CLASSES] = np.bincount(pairs, minlength=CLASSES * CLASSES) / len(pairs)
    words, lines = raw.split(), raw.split(b"\n")
    n = max(1, len(words))
    again = sum(map(bytes.__eq__, words, words[1:]))
    out[-6:] = (np.log1p(len(set(words))) / np.log1p(n), len(set(words)) / n, len(set(lines)) / len(lines), again / n, min(len(raw) / n, 50) / 10, np.log1p(len(raw)) / 10)
    return out


def feature_table(documents: DataFrame) -> DataFrame:
    """``doc_id, f`` (float32 bytes) per row."""

    def make():
        def step(batch: pa.RecordBatch):
            rows = [features(raw).tobytes() for raw in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["doc_id", "f"])

        return step

    return map_batches(documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, "doc_id long, f binary")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """One hidden layer of tanh units on standardised features."""

    def __init__(self, x: np.ndarray, hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), 1 / (x.std(0) + 1e-3)
        self.w = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        z = np.clip((x - self.mean) * self.scale, -6, 6)
        h = np.tanh(z @ self.w[0] + self.w[1])
        return z, h, h @ self.w[2] + self.w[3][0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.forward(x)[2])

    def fit(self, x: np.ndarray, loss_slope, epochs: int, rate: float = 3e-3, batch: int = 1024, decay: float = 1e-3, seed: int = 11) -> None:
        """Adam on minibatches; loss_slope(rows, outputs) is dRisk/dOutput."""
        rng, m, v, t = np.random.default_rng(seed), [0.0] * 4, [0.0] * 4, 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                rows = order[at : at + batch]
                z, h, out = self.forward(x[rows])
                d = loss_slope(rows, out)
                back = d[:, None] * self.w[2] * (1 - h * h)
                t += 1
                for k, g in enumerate((z.T @ back + decay * self.w[0], back.sum(0), h.T @ d + decay * self.w[2], np.array([d.sum()]))):
                    m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                    self.w[k] = self.w[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)


def fit_discriminator(positive: np.ndarray, unlabelled: np.ndarray) -> Network:
    """Balanced logistic fit of positives against unlabelled rows."""
    x, y = np.concatenate([positive, unlabelled]), np.repeat([1.0, 0.0], [len(positive), len(unlabelled)])
    weight = np.where(y == 1, 0.5 / len(positive), 0.5 / len(unlabelled)) * len(x)
    net = Network(x)
    net.fit(x, lambda rows, out: weight[rows] * (_sigmoid(out) - y[rows]) / len(rows), epochs=12)
    return net


def fit_nonnegative(positive: np.ndarray, unlabelled: np.ndarray, prior: float, epochs: int = 40) -> Network:
    """Minimise the non-negative risk; where the part of the unlabelled loss
    that is left for negatives falls below zero, step back up instead."""
    x, is_p = np.concatenate([positive, unlabelled]), np.repeat([True, False], [len(positive), len(unlabelled)])

    def slope(rows: np.ndarray, out: np.ndarray) -> np.ndarray:
        p = is_p[rows]
        n_p, n_u, s = max(1, p.sum()), max(1, (~p).sum()), _sigmoid(out)
        loss_neg = np.logaddexp(0, out)
        rest = loss_neg[~p].sum() / n_u - prior * loss_neg[p].sum() / n_p
        negative = np.where(p, -prior * s / n_p, s / n_u)
        return np.where(p, prior * (s - 1) / n_p, 0.0) + negative if rest >= 0 else -negative

    net = Network(x)
    net.fit(x, slope, epochs)
    return net


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Least ratio of upper tails of two histograms by score, over tails that
    hold enough positives, with half a sampling error on the safe side."""
    tail = lambda c: np.cumsum(c[::-1])[::-1] / max(1, c.sum())
    error = lambda c: 0.5 / np.sqrt(max(1, c.sum()))
    p, u = tail(positive), tail(unlabelled)
    safe = p > max(0.3, 4 * error(positive))
    ratio = (u[safe] + error(unlabelled)) / (p[safe] - error(positive))
    return float(np.clip(ratio.min(initial=1.0), 0.02, 0.98))


def _scored(rows: DataFrame, net: Network, name: str) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(net)

    def make():
        def step(batch: pa.RecordBatch):
            if batch.num_rows:
                x = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float32).reshape(-1, WIDTH)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(x))], ["doc_id", name])

        return step

    return map_batches(rows.select("doc_id", "f"), make, f"doc_id long, {name} double")


def _drawn(rows: DataFrame, wanted: DataFrame, n: int, salt: int) -> np.ndarray:
    """Features of the n wanted rows of lowest hash (a documented bound)."""
    ids = wanted.orderBy(F.xxhash64(F.col("doc_id"), F.lit(salt)), "doc_id").limit(n)
    found = rows.join(F.broadcast(ids), "doc_id").select("f").limit(2 * n).collect()
    return np.frombuffer(b"".join(bytes(r["f"]) for r in found), np.float32).reshape(-1, WIDTH).astype(float)


def fit(rows: DataFrame, labels: DataFrame, modulus: int, held_out_at: int) -> Network | None:
    """The network fitted on the learning rows of a feature table."""
    ids = rows.select("doc_id").distinct()
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("low"))
    learn = ids.where(F.col("doc_id").isNotNull() & (remainder("doc_id", modulus) != held_out_at)).join(marks, "doc_id", "left").select("doc_id", F.when(F.col("low") == 1, "p").when(F.col("low").isNull(), "u").otherwise("n").alias("kind"))
    learn = stored(learn, "quality-marks")
    positive = _drawn(rows, learn.where("kind = 'p'").select("doc_id"), POSITIVES, 1)
    unlabelled = _drawn(rows, learn.where("kind = 'u'").select("doc_id"), UNLABELLED, 2)
    kinds = "u"
    if len(unlabelled) < FEW:
        unlabelled, kinds = _drawn(rows, learn.select("doc_id"), UNLABELLED, 2), "upn"
    if not len(positive) or not len(unlabelled):
        return None
    first = _scored(rows, fit_discriminator(positive, unlabelled), "s").join(learn, "doc_id")
    bins = F.least(F.floor(F.col("s") * BINS), F.lit(BINS - 1)).cast("int")
    counts = {(r["kind"], r["b"]): r["count"] for r in first.groupBy("kind", bins.alias("b")).count().collect()}
    histogram = lambda side: np.array([sum(counts.get((k, b), 0) for k in side) for b in range(BINS)], float)
    return fit_nonnegative(positive, unlabelled, estimate_prior(histogram("p"), histogram(kinds)))


def scores(documents: DataFrame, labels: DataFrame, modulus: int = HELD_OUT_MODULUS, held_out_at: int = HELD_OUT_AT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of documents."""
    rows = stored(feature_table(documents), "quality-features")
    net = fit(rows, labels, modulus, held_out_at)
    out = _scored(rows, net, "score") if net else rows.select("doc_id", F.lit(0.5).alias("score"))
    return out.select("doc_id", (remainder("doc_id", modulus) == held_out_at).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents not rejected, columns as they came; the rows are filtered
    where they are read, without a shuffle of texts."""
    net = fit(stored(feature_table(documents), "quality-features"), labels, HELD_OUT_MODULUS, HELD_OUT_AT)
    if net is None:
        return documents
    shared, text = documents.sparkSession.sparkContext.broadcast(net), documents.columns.index("text")

    def make():
        def step(batch: pa.RecordBatch):
            if batch.num_rows:
                good = shared.value.score(np.stack([features(raw) for raw in text_bytes(batch.column(text))])) >= 0.5
                yield batch.filter(pa.array(good))

        return step

    return map_batches(documents, make, documents.schema)


def op2_quality_positive_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
