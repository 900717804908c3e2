"""Toxicity by a string-kernel support vector machine with Nystroem landmarks.

The kernel of two words is that of their common subsequences of ``P`` letters,
gaps allowed and each letter of the spanned stretch costing a factor ``DECAY``,
normalised and raised to ``POWER``: an inserted, left-out or swapped character
lowers it a little. Landmarks are words that mark toxic documents among the
labelled ones, chosen to be unlike each other. A document's kernel value for a
landmark is its best word's, and beside it stands the logarithm of the sum over
its different words, by the number of those (one insult in a long text shows in
the first, a habit of odd words in the second); both are whitened with the
landmarks' own kernel matrix (Nystroem), and a linear support vector machine with squared
hinge loss is fitted on labelled rows; its margin becomes a probability by a
logistic fit.

Words: lower case, accents folded, punctuation inside dropped ("i.d.i.o.t") and
also read as a break ("listen...idiot"), digits read as the letters they
resemble, runs of single letters ("i d i o t") also read as one word. Of words
of more than ``LONG`` letters every stretch of ``STRETCHES`` letters counts as a
word, too (longer stretches have too many other letters for a kernel value
above ``LEAST``); beyond ``WHOLE`` letters only those count. Words whose best kernel value is below ``LEAST`` count
as unlike every landmark.

Edge cases: NULL and empty texts have no words and get the score of a text
without any insult; doc_ids with conflicting labels are left out of the fit;
repeated rows get equal scores; without labelled rows of both classes every
score is 0; an empty table gives no rows; extra columns are ignored.

Scale: no shuffle of texts. The fit uses at most ``FIT_ROWS`` labelled rows of
each class, of lowest hash; their words are counted in Spark, and the driver
gets ``CANDIDATES`` words and a feature row for each. Scores cover all rows
and whole texts. A task keeps kernel values of known words in a bounded table.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txpipe.llm.common import map_batches, remainder, table

P = 3
DECAY = 0.6
POWER = 2
LEAST = 0.2
CLOSE = 0.4  # words count in the sums from this value on
PER_WORDS = 100
PLAIN_WORDS = 150
SURE = 27  # toxic documents that a landmark must mark, and no other, to be an example by itself
LANDMARKS = 96
CANDIDATES = 600
FIT_ROWS = 6_000  # of each class
KNOWN_WORDS = 600_000
LONG, WHOLE, STRETCHES = 20, 64, (6, 9)
TOGETHER = 1 << 16  # words looked up together
HELD_OUT_MODULUS, HELD_OUT_AT = 5, 0

_STEPS = [(a, b) for a in (1, 2, 3) for b in (1, 2, 3) if a + b <= 4]
_LETTERS = 28  # a-z, other letters, edge of a word
_DROP = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_LOOKS = bytes.maketrans(b"0134578", b"oieastb")  # on UTF-8: other bytes of letters stay
_BREAK = bytes.maketrans(b"0134578" + _DROP, b"oieastb" + b" " * len(_DROP))
_CODES = bytes(c - 97 if 97 <= c <= 122 else 26 for c in range(256))
_SINGLES = re.compile(r"(?: \S){3,}(?= |$)")


def words(text: str) -> list[str]:
    raw = text.lower().encode("utf-8", "surrogatepass")
    text = " ".join(raw.translate(_LOOKS, _DROP).decode("utf-8", "surrogatepass").split())
    out = text.split(" ")
    out += [m.replace(" ", "") for m in _SINGLES.findall(" " + text)]
    out += [w for w in raw.translate(_BREAK).decode("utf-8", "surrogatepass").split() if len(w) > 2]
    return out


def word_sets(text: str) -> Iterator[set[str]]:
    """The different words of a text, then stretches of its long ones (in sets of
    bounded size; letters that the kernel does not tell apart are made equal)."""
    every = set(words(text))
    out = {w for w in every if len(w) <= WHOLE}
    for w in every:
        if len(w) > LONG:
            same = "".join(chr(c + 97) if c < 26 else "~" for c in _fold(w)[1:-1])
            for at in range(0, len(same), TOGETHER):
                out.update(same[i : i + n] for n in STRETCHES for i in range(at, min(at + TOGETHER, max(1, len(same) - n + 1))))
                if len(out) > TOGETHER:
                    yield out
                    out = set()
    if out:
        yield out


def _fold(word: str) -> bytes:
    """A letter code each, with the edges."""
    if word.isascii():
        return b"\x1b" + word.encode().translate(_CODES) + b"\x1b"
    plain = unicodedata.normalize("NFD", word)
    return bytes([27, *(ord(c) - 97 if "a" <= c <= "z" else 26 for c in plain if not unicodedata.combining(c)), 27])


def subsequences(ws: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, subsequence code, weight), each pair once."""
    letters = [_fold(w) for w in ws]
    flat = np.frombuffer(b"".join(letters), np.uint8).astype(np.int64)
    owner = np.repeat(np.arange(len(ws)), [len(ls) for ls in letters])
    keys, weights = [], []
    for a, b in _STEPS:
        n = len(flat) - a - b
        if n > 0:
            same = owner[:n] == owner[a + b :]
            code = (flat[:n] * _LETTERS + flat[a : a + n]) * _LETTERS + flat[a + b :]
            keys.append((owner[:n] * _LETTERS**3 + code)[same])
            weights.append(np.full(same.sum(), DECAY ** (a + b - 2)))
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    key, back = np.unique(np.concatenate(keys), return_inverse=True)
    return key // _LETTERS**3, key % _LETTERS**3, np.bincount(back, np.concatenate(weights), len(key))


class Kernel:
    """Kernel values of words with fixed landmarks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        owner, code, weight = subsequences(landmarks)
        norm = np.sqrt(np.bincount(owner, weight**2, len(landmarks)))
        self.table = np.zeros((_LETTERS**3, len(landmarks)), np.float32)
        self.table[code, owner] = weight / norm[owner]

    def values(self, ws: list[str]) -> np.ndarray:
        owner, code, weight = subsequences(ws)
        norm = np.sqrt(np.bincount(owner, weight**2, len(ws))) + 1e-12
        used = self.table.any(axis=1)[code]
        owner, code, weight = owner[used], code[used], weight[used]
        out = np.zeros((len(ws), len(self.landmarks)), np.float32)
        if len(owner):
            firsts = np.flatnonzero(np.diff(owner, prepend=-1))
            out[owner[firsts]] = np.add.reduceat(self.table[code] * weight[:, None].astype(np.float32), firsts, axis=0)
        return (out / norm[:, None].astype(np.float32)) ** POWER


def choose(candidates: list[str], n: int = LANDMARKS, alike: float = 0.85) -> list[str]:
    """The first n candidates that are unlike those chosen before."""
    if not candidates:
        return []
    k, out = Kernel(candidates).values(candidates), []
    for i in range(len(candidates)):
        if len(out) < n and all(k[i, j] < alike for j in out):
            out.append(i)
    return [candidates[i] for i in out]


class Words:
    """A task's table of known words: 0, or one more than the row of values."""

    def __init__(self, kernel: Kernel):
        self.kernel, self.known = kernel, {}
        self.rows = [np.zeros(len(kernel.landmarks), np.float32)]

    def values(self, texts: list[str]) -> np.ndarray:
        """Each text's best word's kernel value with each landmark, then its
        words' sums (by number of words, as logarithms)."""
        n = len(self.rows[0])
        best, sums, count = np.zeros((len(texts), n), np.float32), np.zeros((len(texts), n), np.float32), np.zeros((len(texts), 1), np.float32)
        held, size = [], 0

        def look_up() -> None:
            self._learn({w for _, ws in held for w in ws})
            for i, ws in held:
                count[i] += len(ws)
                if at := [k for k in map(self.known.__getitem__, ws) if k]:
                    found = np.array([self.rows[k] for k in at])
                    best[i] = np.maximum(best[i], found.max(axis=0))
                    sums[i] += (found * (found >= CLOSE)).sum(axis=0)

        for i, t in enumerate(texts):
            for ws in word_sets(t) if t else ():
                held.append((i, ws))
                size += len(ws)
                if size > 4 * TOGETHER:
                    look_up()
                    held, size = [], 0
        look_up()
        return np.concatenate([best, np.log1p(PER_WORDS * sums / np.maximum(count, 1))], axis=1)

    def _learn(self, ws: set[str]) -> None:
        if len(self.known) > KNOWN_WORDS:
            self.known, self.rows = {}, self.rows[:1]
        new = list(ws.difference(self.known))
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            values = self.kernel.values(part)
            near = np.flatnonzero(values.max(axis=1, initial=0) >= LEAST)
            self.known.update(dict.fromkeys(part, 0))
            for i in near:
                self.known[part[i]] = len(self.rows)
                self.rows.append(values[i])


@lru_cache(maxsize=1)
def words_of(landmarks: tuple[str, ...]) -> Words:
    """A Python worker's table for some landmarks; it serves all its tasks."""
    return Words(Kernel(list(landmarks)))


class Machine:
    """Whitening, linear machine and calibration."""

    def __init__(self, kernel: Kernel, values: np.ndarray, toxic: np.ndarray, sure: list[int] = ()):
        """``sure``: landmarks that mark toxic texts only; each by itself, in
        a text of otherwise plain words, is one more toxic example, so that
        one insult is enough."""
        k = kernel.values(kernel.landmarks).astype(float)
        e, v = np.linalg.eigh((k + k.T) / 2)
        keep = e > 1e-6 * e.max()
        white = v[:, keep] / np.sqrt(e[keep])
        self.landmarks, self.white = tuple(kernel.landmarks), np.kron(np.eye(2), white)
        alone = k[list(sure)]
        alone = np.concatenate([alone, np.log1p(PER_WORDS * alone * (alone >= CLOSE) / PLAIN_WORDS)], axis=1)
        found, toxic = toxic, np.concatenate([toxic, np.ones(len(alone), bool)])
        x, y = self.inputs(np.concatenate([values, alone])), np.where(toxic, 1.0, -1.0)
        weight = np.where(toxic, 0.5 / found.sum(), 0.5 / (~found).sum()) * len(found)
        weight[len(found) :] = 0.5 * len(found) / max(1, len(alone))
        self.w = np.zeros(x.shape[1])
        for _ in range(50):  # Newton steps on squared hinge
            active = y * (x @ self.w) < 1
            xa, wa = x[active], weight[active]
            ridge = np.full(x.shape[1], 1.0)
            ridge[-1] = 1e-6
            new = np.linalg.solve(xa.T @ (xa * wa[:, None]) + np.diag(ridge), xa.T @ (wa * y[active]))
            done = np.allclose(new, self.w, atol=1e-8)
            self.w = new
            if done:
                break
        m = (x @ self.w)[: len(found)]
        target = np.where(found, (found.sum() + 1) / (found.sum() + 2), 1 / ((~found).sum() + 2))
        z = np.stack([m, np.ones_like(m)], axis=1)
        ab = np.array([2.0, 0.0])
        for _ in range(50):  # Platt's logistic fit of margins
            p = 1 / (1 + np.exp(-np.clip(z @ ab, -30, 30)))
            ab = ab - np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + 1e-6 * np.eye(2), z.T @ (p - target) + 1e-6 * ab)
        self.a = max(1.0, float(ab[0]))

    def inputs(self, values: np.ndarray) -> np.ndarray:
        return np.concatenate([values @ self.white, np.ones((len(values), 1))], axis=1)

    def score(self, values: np.ndarray) -> np.ndarray:
        """Toxic from the margin's sign on; the logistic fit gives the slope."""
        return 1 / (1 + np.exp(-np.clip(self.a * (self.inputs(values) @ self.w), -30, 30)))


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def word_counts(sample: DataFrame) -> DataFrame:
    """``word, pos, neg``: documents of either class that hold a word."""

    def make():
        def step(batch: pa.RecordBatch):
            counts = Counter(), Counter()
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[toxic].update({w for w in words(text or "") if 2 < len(w) <= 32})
            every = list(counts[0] | counts[1])
            yield pa.RecordBatch.from_arrays([pa.array(every, pa.string()), pa.array([counts[1][w] for w in every], pa.int64()), pa.array([counts[0][w] for w in every], pa.int64())], ["word", "pos", "neg"])

        return step

    return map_batches(sample.select("text", "toxic"), make, "word string, pos long, neg long").groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _best(rows: DataFrame, landmarks: tuple[str, ...], keep: str) -> DataFrame:
    def make():
        state = words_of(landmarks)

        def step(batch: pa.RecordBatch):
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                best = state.values([t or "" for t in part.column(0).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array([b.tobytes() for b in best], pa.binary())], [keep, "best"])

        return step

    return map_batches(rows.select("text", keep), make, f"{keep} int, best binary")


def fit(documents: DataFrame, labels: DataFrame, modulus: int = HELD_OUT_MODULUS, held_out_at: int = HELD_OUT_AT) -> Machine | None:
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (remainder("doc_id", modulus) != held_out_at))
    marks = marks.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").alias("high")).where("toxic = high and toxic in (0, 1)").drop("high")
    drawn = [marks.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS) for c in (0, 1)]
    sample = _texts(documents).join(F.broadcast(drawn[0].unionByName(drawn[1])), "doc_id")
    totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not totals.get(0) or not totals.get(1):
        return None
    odds = F.log((F.col("pos") + 0.5) / (totals[1] + 1)) - F.log((F.col("neg") + 0.5) / (totals[0] + 1))
    seen = word_counts(sample).where(F.col("pos") >= 2)
    top = seen.select("word", "pos", "neg", (F.sqrt("pos") * odds).alias("mark")).where(odds > 1.5).orderBy(F.desc("mark"), "word").limit(CANDIDATES).collect()
    landmarks = choose([r["word"] for r in top])
    if not landmarks:
        return None
    kernel = Kernel(landmarks)
    rows = _best(sample, tuple(landmarks), "toxic").collect()  # at most 2 * FIT_ROWS
    best = np.frombuffer(b"".join(bytes(r["best"]) for r in rows), np.float32).reshape(len(rows), -1)
    alone = {r["word"] for r in top if r["pos"] >= SURE and not r["neg"]}
    return Machine(kernel, best.astype(float), np.array([r["toxic"] == 1 for r in rows]), [i for i, w in enumerate(landmarks) if w in alone])


def scores(documents: DataFrame, labels: DataFrame, modulus: int = HELD_OUT_MODULUS, held_out_at: int = HELD_OUT_AT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of documents."""
    machine = documents.sparkSession.sparkContext.broadcast(fit(documents, labels, modulus, held_out_at))

    def make():
        model = machine.value
        state = words_of(model.landmarks) if model else None

        def step(batch: pa.RecordBatch):
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                value = model.score(state.values([t or "" for t in part.column(1).to_pylist()])) if model else np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(value, pa.float64())], ["doc_id", "score"])

        return step

    out = map_batches(_texts(documents), make, "doc_id long, score double")
    return out.select("doc_id", (remainder("doc_id", modulus) == held_out_at).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_toxicity_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
