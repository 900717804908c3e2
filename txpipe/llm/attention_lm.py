"""Language-model scoring with causal self-attention, beside a word baseline.

Tokens are words in lower case (A-Z only) and one end a document. The baseline
is their add-0.1 unigram. The model spells each word in byte-level subword ids
(with a space before it) and gives the log10 probability of all ids and the end:
P(id | before) = P(class | attention over the ids before) * P(id | class, id before).
Attention is one causal layer. Steps on a bounded sample of training documents only
give it a start; then it is trained on every id of every training document, in numpy
inside tasks whose weights are averaged. The classes come from the neighbours of ids,
P(id | class, id before) from counts of ids and of pairs of ids, both over all training
documents. A document is scored in windows of ``CONTEXT`` ids that overlap by half: each id is
scored once, in the window where at least half of the window (or all of the
document before it) is its context; windows are batched under a causal mask.

Plan: one scan cuts each partition into blocks of documents. A block keeps its
distinct words once: their hashes and training counts go to buckets by hash,
where counts of all blocks are summed, and the sums come back to the block; its
word sequences and the words' ids wait for them. So the shuffle carries a word
once a block, never once a document, and texts are tokenized once.

Edge cases: NULL, empty and blank texts are one end; rows that repeat are scored
each; a NULL doc_id counts as empty text for the remainder; an empty table gives
no rows; without training documents P is uniform in the model and 0.1 over
0.1 * (V + 1) in the baseline; extra columns are ignored.

Scale: a hot word is one entry a block. Buckets grow with the partitions up to
``BUCKETS``; the driver gets the id counts (a vector of the vocabulary), tables of
neighbours and pairs of fixed size, averaged weights, at most ``SAMPLE_DOCS`` sample
documents, and two totals.
"""

from __future__ import annotations

import base64
import copy
import heapq
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txpipe.llm.common import remainder, stored, table, text_bytes

HELD_OUT_MODULUS = 10
SMOOTHING = 0.1
VOCABULARY = 50_257
END = 50_256
BLOCK_BYTES = 4 << 20
BUCKETS = 4_096
SAMPLE_TASK, SAMPLE_DOCS, SAMPLE_IDS = 256, 1_024, 1_500_000  # documents of least hash of a task, of all; their ids
STEPS = 1_200  # steps on the sample, from which the pass over all documents starts
RATES = (1e-3, 5e-4, 2e-4)  # of the rounds of that pass
COLUMNS = 256  # most frequent neighbours by which ids are classed

CLASSES = 48
OWN_CLASS = 16  # most frequent ids with a class each
OWN_VECTOR = 2_048  # most frequent ids with an input vector each; others share their class's
BEFORE, AFTER = 1_024, 4_096  # pair counts: most frequent ids before (others by class) and after
BACKING = 8.0  # pairs that the counts of single ids stand for
WIDTH = 24
CONTEXT = 32
BOUND = 60  # of exponents

_DOCS, _IDS, _SAMPLE = -1, -2, -3
_SCHEMA = "block long, kind int, a binary, b binary, c binary"
_DOC = np.dtype([("doc_id", "<i8"), ("known_id", "?"), ("held_out", "?"), ("n_words", "<i4")])
_ODD_SPACE = re.compile(r"[^\S ]")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))


def split_words(raw: bytes) -> list[bytes]:
    return raw.translate(_LOWER).split()


def encoding(path: str | None = None):
    """Byte-level subword encoder; its file's place is a parameter."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("subwords", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Speller:
    """Ids of words as bytes (little-endian uint16).

    Words are encoded many at a time, each after a space, which begins a
    new piece; ids are told apart by the bytes they stand for. Words with other
    white space inside go one by one."""

    def __init__(self, path: str | None):
        encoding_ = encoding(path)
        self.encode = encoding_.encode_to_numpy
        self.sizes = np.array([len(encoding_.decode_single_token_bytes(i)) for i in range(END)])

    def _some(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        text = (b" " + b" ".join(words)).decode("utf-8", "replace")
        if text.count(" ") == len(words) and not _ODD_SPACE.search(text):
            ids = self.encode(text)
            ends, stops = np.cumsum([len(w) + 1 for w in words]), np.cumsum(self.sizes[ids])
            cuts = np.searchsorted(stops, ends)
            if stops[-1] == ends[-1] and (stops[cuts] == ends).all():
                return ids.astype("<u2"), np.diff(cuts, prepend=-1)
        each = [self.encode(" " + w.decode("utf-8", "replace")).astype("<u2") for w in words]
        return np.concatenate(each), np.array([len(ids) for ids in each])

    def spelled(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, joined, and the number of each word's."""
        parts = [self._some(words[at : at + 512]) for at in range(0, len(words), 512)]
        return tuple(np.concatenate([p[i] for p in parts] or [[]]).astype(kind) for i, kind in ((0, "<u2"), (1, np.int64)))

    def ids(self, words: list[bytes]) -> list[bytes]:
        flat, sizes = self.spelled(words)
        raw, at = flat.tobytes(), (2 * np.cumsum(sizes)).tolist()
        return [raw[i:j] for i, j in zip([0, *at], at, strict=False)]


@lru_cache(maxsize=1)
def speller_of(path: str | None) -> Speller:
    """A Python worker's speller; it serves all its tasks."""
    return Speller(path)


def _gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """values[starts[w] : starts[w] + sizes[w]] for each w of which, joined."""
    n = sizes[which]
    at = np.arange(int(n.sum())) + np.repeat(starts[which] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
    return values[at]


class Block:
    """Word sequences of some documents. Words are numbered by bucket (of their
    hash), so a bucket's words are a range of numbers; ``end`` is the end's."""

    def __init__(self, texts: list[bytes], training: list[bool], buckets: int):
        import xxhash

        every = np.frombuffer(b" ".join(texts).translate(_LOWER), np.uint8)
        inside = ~_SPACE[every]
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, offsets = edges[::2], np.concatenate([[0], np.cumsum(edges[1::2] - edges[::2])])
        self.n_words = np.diff(np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts])), prepend=0).astype(np.int32)
        buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(every[inside])]
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        sequence, words = coded.indices.to_numpy() + 1, [b"", *coded.dictionary.to_numpy(zero_copy_only=False)]
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
        order = np.argsort(hashes % np.uint64(buckets), kind="stable")
        number = np.empty(len(words), np.uint32)
        number[order] = np.arange(len(words), dtype=np.uint32)
        self.end, self.sequence, self.hashes = int(number[0]), number[sequence], hashes[order]
        self.words = [words[i] for i in order.tolist()]
        train = np.array(training, bool)
        self.counts = np.bincount(self.sequence[np.repeat(train, self.n_words)], minlength=len(words)).astype(np.uint32)
        self.counts[self.end] = train.sum()
        bucket = self.hashes % np.uint64(buckets)
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])).tolist()
        #: (bucket, first number, last) of the words
        self.ranges = [(int(bucket[a]), a, b) for a, b in zip(first, [*first[1:], len(words)], strict=True)]


def blocks(docs: DataFrame, path: str | None, buckets: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of ``_SCHEMA``: a block's documents (kind -1), id counts (-2), sample
    documents (-3), and its words by bucket (0 and up)."""

    def run(batches):
        import xxhash
        import zstandard

        speller, pack = speller_of(path), zstandard.ZstdCompressor(level=1).compress
        first, number = TaskContext.get().partitionId() << 32, 0

        def row(block, kind, a, b=None, c=None):
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((block, kind, a, b, c), kinds, strict=True)], ["block", "kind", "a", "b", "c"])

        def emit(ids, held, texts):
            block = Block(texts, [not h for h in held], buckets)
            own = first + number
            meta = np.array([(i or 0, i is not None, h, n) for i, h, n in zip(ids, held, block.n_words, strict=True)], _DOC)
            flat, sizes = speller.spelled(block.words[: block.end] + block.words[block.end + 1 :])
            flat, sizes = np.insert(flat, sizes[: block.end].sum(), END), np.insert(sizes, block.end, 1)
            starts = np.cumsum(sizes) - sizes
            totals = np.bincount(flat, np.repeat(block.counts, sizes), VOCABULARY).astype("<u8")
            head = np.array([len(sizes), block.end], "<u4").tobytes()
            yield row(own, _DOCS, pack(meta.tobytes()), pack(block.sequence.tobytes()), pack(head + sizes.astype("<u4").tobytes() + flat.tobytes()))
            yield row(own, _IDS, pack(totals.tobytes()))
            for bucket, a, b in block.ranges:
                yield row(own, bucket, np.array([a], "<u4").tobytes(), block.hashes[a:b].tobytes(), pack(block.counts[a:b].tobytes()))
            begins = np.concatenate([[0], np.cumsum(block.n_words)])
            for i, (text, h) in enumerate(zip(texts, held, strict=True)):
                least = -xxhash.xxh3_64_intdigest(text)
                if not h and (len(drawn) < SAMPLE_TASK or least > drawn[0][0]):
                    ids_of = _gather(flat, starts, sizes, np.append(block.sequence[begins[i] : begins[i + 1]], block.end))
                    (heapq.heappush if len(drawn) < SAMPLE_TASK else heapq.heapreplace)(drawn, (least, ids_of[:SAMPLE_IDS].tobytes()))

        drawn: list[tuple[int, bytes]] = []
        held_rows, size = ([], [], []), 0
        for part in (batch.slice(at, 256) for batch in batches for at in range(0, batch.num_rows, 256)):
            for doc_id, held, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), text_bytes(part.column(2)), strict=True):
                for column, value in zip(held_rows, (doc_id, held, text), strict=True):
                    column.append(value)
                size += len(text) + 64
                if size >= block_bytes:
                    yield from emit(*held_rows)
                    held_rows, size, number = ([], [], []), 0, number + 1
        if held_rows[0]:
            yield from emit(*held_rows)
        for _, ids_of in drawn:
            yield row(first, _SAMPLE, pack(ids_of))

    return docs.mapInArrow(run, _SCHEMA)


def summed(words: DataFrame) -> DataFrame:
    """Counts of a bucket's words over all blocks, back by block: ``block,
    first`` (the first word's number), ``n`` (packed counts); and a row without
    a block with the bucket's ``types`` and ``tokens``."""

    def add(part: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        hashes = [np.frombuffer(x, np.uint64) for x in part["b"]]
        every, back = np.unique(np.concatenate(hashes), return_inverse=True)
        totals = np.bincount(back, np.concatenate([_unpacked(x, np.uint32) for x in part["c"]]), len(every)).astype("<u8")
        at, out = 0, []
        for block, first, h in zip(part["block"], part["a"], hashes, strict=True):
            out.append((block, int(np.frombuffer(first, "<u4")[0]), pack(totals[back[at : at + len(h)]].tobytes()), 0, 0))
            at += len(h)
        out.append((None, None, None, int((totals > 0).sum()), int(totals.sum())))
        frame = pd.DataFrame(out, columns=["block", "first", "n", "types", "tokens"])
        return frame.astype({"block": "Int64", "first": "Int64", "types": "int64", "tokens": "int64"})

    return words.groupBy("kind").applyInPandas(add, "block long, first long, n binary, types long, tokens long")


def _unpacked(raw: bytes, kind) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(raw)), kind)


def id_counts(rows: DataFrame) -> np.ndarray:
    """Training count of every id: partial sums in Spark, the last 16 here."""

    def add(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"a": [sum(_unpacked(x, "<u8") for x in part["a"]).astype("<u8").tobytes()]})

    sums = rows.groupBy(F.pmod(F.xxhash64("block"), F.lit(16))).applyInPandas(add, "a binary").collect()
    return sum((np.frombuffer(bytes(r["a"]), "<u8") for r in sums), np.zeros(VOCABULARY, np.uint64)).astype(np.int64)


def ranked(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids by falling count, and the place of each id in that order."""
    order = np.lexsort((np.arange(len(counts)), -counts))
    rank = np.empty(len(counts), np.int64)
    rank[order] = np.arange(len(counts))
    return order, rank


def neighbour_counts(rank: np.ndarray, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Cells (rank of an id, what stands beside it) of the table of neighbours, one for
    each side of each pair; the ``COLUMNS`` most frequent neighbours have a column
    each side, the others share one."""
    b, i = rank[before], rank[ids]
    return np.concatenate([i * (2 * COLUMNS + 2) + np.minimum(b, COLUMNS), b * (2 * COLUMNS + 2) + COLUMNS + 1 + np.minimum(i, COLUMNS)])


def neighbour_classes(rank: np.ndarray, shares: np.ndarray, n: int, seed: int = 9) -> np.ndarray:
    """Class of each id by the ids that stand before and after it: k-means on the
    square roots of their shares. ``shares`` holds the counts, a row a rank, and is
    worked on in place. Ids without neighbours fall to the classes in turn."""
    own = np.arange(len(rank)) % n
    weight = shares.sum(axis=1)
    weight[:OWN_CLASS] = 0
    points = np.flatnonzero(weight)
    if len(points) <= n:
        return own[rank]
    shares /= np.maximum(1, shares.sum(axis=1))[:, None]
    np.sqrt(shares, out=shares)
    rng = np.random.default_rng(seed)
    centres = shares[rng.choice(points, n, replace=False, p=weight[points] / weight[points].sum(dtype=np.float64))]
    for _ in range(15):
        sums, length = np.zeros_like(centres), (centres**2).sum(1)[None, :]
        for at in range(0, len(points), 4_096):
            some = points[at : at + 4_096]
            own[some] = np.argmin(length - 2 * shares[some] @ centres.T, axis=1)
            one_hot = np.zeros((n, len(some)), np.float32)
            one_hot[own[some], np.arange(len(some))] = weight[some]
            sums += one_hot @ shares[some]
        total = np.bincount(own[points], weight[points], n)
        centres = np.where(total[:, None] > 0, sums / np.maximum(total, 1)[:, None], centres).astype(np.float32)
    return own[rank]


class Attention:
    """Class-factored language model; see the module's text."""

    def __init__(self, counts: np.ndarray, sample: list[np.ndarray], width: int = WIDTH, context: int = CONTEXT, seed: int = 5, neighbours: np.ndarray | None = None):
        """``neighbours`` are the counts of :func:`neighbour_table`; without them those
        of the ``sample`` are taken."""
        order, rank = ranked(counts)
        if neighbours is None:
            neighbours = np.zeros((len(rank), 2 * COLUMNS + 2), np.float32)
            for ids in sample:
                np.add.at(neighbours.reshape(-1), neighbour_counts(rank, np.concatenate([[END], ids[:-1]]), ids), np.float32(1))
        # The most frequent ids are classes of their own; the rest are grouped by their neighbours.
        self.of = np.where(rank < OWN_CLASS, rank, OWN_CLASS + neighbour_classes(rank, neighbours, CLASSES - OWN_CLASS))
        self.input = np.where(rank < OWN_VECTOR, rank, OWN_VECTOR + self.of)
        smooth = counts + SMOOTHING
        self.within = np.log10(smooth / np.bincount(self.of, smooth, CLASSES)[self.of]).astype(np.float32)
        self.before, self.after, self.frequent = np.where(rank < BEFORE, rank, BEFORE + self.of), np.minimum(rank, AFTER), order[:AFTER]
        self.pairs = self.spare = None
        rng, d = np.random.default_rng(seed), width
        make = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        self.p = {
            "e": make(OWN_VECTOR + CLASSES, d, scale=0.3), "q": make(d, d, scale=d**-0.5), "k": make(d, d, scale=d**-0.5), "v": make(d, d, scale=d**-0.5),
            "o": make(d, d, scale=d**-0.5), "r": np.zeros(context, np.float32), "u": make(d, CLASSES, scale=d**-0.5), "b": np.log(np.bincount(self.of, smooth, CLASSES) / smooth.sum()).astype(np.float32),
        }
        self.context = context

    def count_pairs(self, ids: np.ndarray, first: np.ndarray, into: np.ndarray | None = None) -> np.ndarray:
        """Adds the pairs (id before, id) to a table of counts and returns it;
        ``first`` marks texts' first ids."""
        table_ = np.zeros((BEFORE + CLASSES) * (AFTER + 1), np.uint32) if into is None else into
        before = np.where(first, END, np.concatenate([[END], ids[:-1]]))
        np.add.at(table_, self.before[before] * (AFTER + 1) + self.after[ids], np.uint32(1))
        return table_

    def set_pairs(self, pairs: np.ndarray) -> None:
        """P(id | class, id before), backed by P(id | class)."""
        counts, classes = pairs.reshape(-1, AFTER + 1)[:, : len(self.frequent)].astype(np.float64), self.of[self.frequent]
        by_class = np.stack([np.bincount(classes, row, CLASSES) for row in counts])
        self.pairs = np.zeros((len(counts), AFTER + 1), np.float32)
        self.pairs[:, : len(self.frequent)] = np.log10((counts + BACKING * 10.0 ** self.within[self.frequent]) / (by_class[:, classes] + BACKING))
        self.spare = np.log10(BACKING / (by_class + BACKING)).astype(np.float32)

    def within_class(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        if self.pairs is None:
            return self.within[ids]
        row, column = self.before[before], self.after[ids]
        out = self.pairs[row, column]
        rare = np.flatnonzero(column == AFTER)
        out[rare] = self.within[ids[rare]] + self.spare[row[rare], self.of[ids[rare]]]
        return out

    def _bias(self, queries: int) -> tuple[np.ndarray, np.ndarray]:
        """Learned bias by distance of all positions (rows) from the last ones, and the causal mask."""
        distance = np.arange(self.context - queries, self.context)[None, :] - np.arange(self.context)[:, None]
        return self.p["r"][np.maximum(distance, 0)], (distance >= 0).astype(np.float32)

    def _weights(self, s: np.ndarray, bias: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Attention weights, in place, before they are divided by their sum."""
        if max(s.max(), -s.min()) + abs(bias).max() <= BOUND:
            np.exp(s, out=s)
            s *= np.exp(bias) * mask
            return s
        s += bias
        np.clip(s, -BOUND, BOUND, out=s)  # so that exponentials neither vanish nor overflow
        np.exp(s, out=s)
        s *= mask
        return s

    def _class_logits(self, h: np.ndarray, z: np.ndarray) -> np.ndarray:
        """Logits of the classes (rows) in ``z``; the last row of ``h`` is ones."""
        np.matmul(np.concatenate([self.p["u"].T, self.p["b"][:, None]], axis=1), h, out=z)
        return z if max(z.max(), -z.min()) <= BOUND else np.clip(z, -BOUND, BOUND, out=z)

    def _products(self) -> np.ndarray:
        """What makes of an input (a column) itself, the vector whose products with other
        inputs are attention logits, and what it adds where it is attended to."""
        p, d = self.p, len(self.p["q"])
        return np.concatenate([np.eye(d, dtype=np.float32), p["k"] @ p["q"].T / np.float32(math.sqrt(d)), (p["v"] @ p["o"]).T])

    def windows(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inputs, classes to foretell and which of them are there, a row a window;
        the windows of a text hold each of its ids once. ``ids`` as in ``scores``."""
        c, begins = self.context, np.cumsum(sizes) - sizes
        shifted = np.concatenate([[END], ids[:-1]])
        shifted[begins] = END
        n = -(-sizes // c)
        owner = np.repeat(np.arange(len(sizes)), n)
        place = (begins[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)) * c)[:, None] + np.arange(c)[None, :]
        there = place < (begins + sizes)[owner][:, None]
        np.minimum(place, len(ids) - 1, out=place)
        return self.input[shifted[place]].astype(np.int32), self.of[ids[place]].astype(np.int8), there

    def _gradient(self, inputs: np.ndarray, target: np.ndarray, there: np.ndarray, into: dict[str, np.ndarray], room: Room) -> None:
        """Gradient of the mean loss over the positions that are there. Arrays hold a row
        a feature and a column a position, so that what numpy does is done on long rows; some more
        columns, which count for nothing, keep rows from places a power of two apart."""
        p, c, d, n = self.p, self.context, len(self.p["q"]), inputs.size
        wide, windows = n + 16, len(inputs)
        deep = lambda y: y[:, :n].reshape(len(y), -1, c).transpose(1, 0, 2)  # noqa: E731  (window, feature, position)
        at, share = np.zeros(wide, np.intp), np.zeros(wide, np.float32)
        at[:n], share[:n] = inputs.ravel(), there.ravel() / np.float32(max(1, there.sum()))
        made, y = self._products(), room("y", 3 * d + 1, wide)
        np.matmul(made, np.take(p["e"], at, axis=0, out=room("e", wide, d), mode="clip").T, out=y[:-1])
        y[-1] = 1  # its attended sum is the weights' sum
        x, x3, t3, u3 = y[:d], deep(y[:d]), deep(y[d : 2 * d]), deep(y[2 * d :])
        # (window, attended, attending)
        w = self._weights(np.matmul(x3.transpose(0, 2, 1), t3, out=room("w", windows, c, c)), *self._bias(c))
        o, h = room("o", d + 1, wide), room("h", d + 1, wide)
        o[:, n:] = 1
        np.matmul(u3, w, out=deep(o))
        inverse = 1 / o[-1]
        o[:-1] *= inverse
        np.add(x, o[:-1], out=h[:-1])
        h[-1] = 1
        dz = self._class_logits(h, room("z", CLASSES, wide))
        np.exp(dz, out=dz)
        dz *= share / (np.ones(len(dz), np.float32) @ dz)
        dz.reshape(-1)[target.ravel() * np.intp(wide) + np.arange(n)] -= share[:n]
        du = h @ dz.T
        into["u"][...], into["b"][...] = du[:-1], du[-1]
        dx, g, dh = room("dx", d, wide), room("g", d + 1, wide), h[:-1]
        np.matmul(p["u"], dz, out=dx)
        np.multiply(dx, inverse, out=g[:-1])
        np.multiply(g[:-1], o[:-1], out=dh)
        np.negative(np.ones(d, np.float32) @ dh, out=g[-1])
        g3 = deep(g)
        ds = np.matmul(u3.transpose(0, 2, 1), g3, out=room("ds", windows, c, c))
        ds *= w
        dtu, dk = room("dtu", 2 * d, wide), o[:-1]
        dtu[:, n:], dk[:, n:] = 0, 0
        np.matmul(x3, ds, out=deep(dtu[:d]))
        np.matmul(g3[:, :-1], w.transpose(0, 2, 1), out=deep(dtu[d:]))
        np.matmul(t3, ds.transpose(0, 2, 1), out=deep(dk))
        dx += dk
        dx += np.matmul(np.ascontiguousarray(made[d:].T), dtu, out=dh)
        dboth = dtu @ x.T
        dqk, dvo = dboth[:d] / np.float32(math.sqrt(d)), dboth[d:]
        into["q"][...], into["k"][...], into["v"][...], into["o"][...] = dqk.T @ p["k"], dqk @ p["q"], (p["o"] @ dvo).T, (dvo @ p["v"]).T
        for own, row in zip(into["e"].T, dx, strict=True):
            own[...] = np.bincount(at, row, len(own))
        distance = np.maximum(np.arange(c)[None, :] - np.arange(c)[:, None], 0)
        into["r"][...] = np.bincount(distance.ravel(), np.ones(windows, np.float32) @ ds.reshape(windows, -1), c)

    def train(self, texts: list[np.ndarray], steps: int = STEPS, batch: int = 64, rate: float = 4e-3, seed: int = 3) -> None:
        """Adam over windows of the texts; every position of a window counts."""
        if not texts:
            return
        inputs, target, there = self.windows(np.concatenate(texts), np.array([len(t) for t in texts]))
        rng, adam = np.random.default_rng(seed), Adam(self)
        while adam.steps < steps:
            order = rng.permutation(len(inputs))
            for at in range(0, len(order), batch):
                if adam.steps == steps:
                    break
                own = order[at : at + batch]
                self._gradient(inputs[own], target[own], there[own], adam.gradient, adam.room)
                adam.step(rate * (1 - 0.9 * (adam.steps + 1) / steps))

    def learn(self, adam: Adam, ids: np.ndarray, sizes: np.ndarray, rate: float, batch: int = 64, seed: int = 4) -> int:
        """Adam once over all windows of some texts; returns their number."""
        inputs, target, there = self.windows(ids, sizes)
        order = np.random.default_rng(seed).permutation(len(inputs))
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            self._gradient(inputs[own], target[own], there[own], adam.gradient, adam.room)
            adam.step(rate * len(own) / batch)
        return len(order)

    def scores(self, ids: np.ndarray, sizes: np.ndarray, batch: int = 128) -> np.ndarray:
        """log10 probability of each text; ``ids`` holds all texts, each with
        its end, of ``sizes`` ids. Texts are cut into half windows; the ids of
        one attend to it and to the one before. Rows and columns as in ``_gradient``."""
        p, c, half, d, begins = self.p, self.context, self.context // 2, len(self.p["q"]), np.cumsum(sizes) - sizes
        shifted = np.empty_like(ids)
        shifted[1:] = ids[:-1]
        shifted[begins] = END  # what stands before a text
        n = -(-sizes // half)
        owner = np.repeat(np.arange(len(sizes)), n)
        turn = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        place = (begins[owner] + turn * half)[:, None] + np.arange(half)[None, :]
        valid = place < (begins + sizes)[owner][:, None]
        np.minimum(place, len(ids) - 1, out=place)
        inputs, targets = self.input[shifted][np.concatenate([place[:1], place])], self.of[ids][place]
        out = np.bincount(np.repeat(np.arange(len(sizes)), sizes), self.within_class(shifted, ids), len(sizes))
        bias = self._bias(half)
        room, made = Room(), self._products()
        for at in range(0, len(owner), batch):
            own = slice(at, at + batch)
            i = inputs[at : at + batch + 1].ravel()  # with the half window before
            y = room("y", 3 * d + 1, len(i))
            np.matmul(made, np.take(p["e"], i, axis=0, out=room("e", len(i), d), mode="clip").T, out=y[:-1])
            y[-1] = 1
            step, long = y.strides[1], y.strides[0]
            attended = np.lib.stride_tricks.as_strided(y, (len(i) // half - 1, len(y), c), (half * step, long, step))
            deep = lambda a: a.reshape(len(a), -1, half).transpose(1, 0, 2)
            w = self._weights(np.matmul(attended[:, :d].transpose(0, 2, 1), deep(y[d : 2 * d, half:]), out=room("w", len(attended), c, half)), *bias)
            w[turn[own] == 0, :half] = 0  # a text's first half window has none before it
            h = room("h", d + 1, len(i) - half)
            np.matmul(attended[:, 2 * d :], w, out=deep(h))
            h[:-1] /= h[-1]
            h[:-1] += y[:d, half:]
            h[-1] = 1
            z = self._class_logits(h, room("z", CLASSES, len(i) - half))
            logs = np.take(z, targets[own].ravel() * z.shape[1] + np.arange(z.shape[1]))
            np.exp(z, out=z)
            logs -= np.log(np.ones(len(z), np.float32) @ z)
            out += np.bincount(owner[own], np.where(valid[own], logs.reshape(-1, half), 0).sum(axis=1, dtype=np.float64) / math.log(10), len(sizes))
        return out


class Room:
    """Arrays by name, kept from step to step: memory taken anew would be cleared each time."""

    def __init__(self):
        self.kept = {}

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        size = math.prod(shape)
        if name not in self.kept or self.kept[name].size < size:
            self.kept[name] = np.empty(size, np.float32)
        return self.kept[name][:size].reshape(shape)


class Adam:
    """Adam on the weights of a model. They and their gradient become views of one vector
    each."""

    def __init__(self, model: Attention):
        self.room, self.steps, self.weights = Room(), 0, np.concatenate([a.ravel() for a in model.p.values()], dtype=np.float32)
        self.vector, self.mean, self.square = (np.zeros_like(self.weights) for _ in range(3))
        shapes = {name: a.shape for name, a in model.p.items()}
        model.p, self.gradient = ({}, {})
        at = 0
        for name, shape in shapes.items():
            size = math.prod(shape)
            for views, vector in ((model.p, self.weights), (self.gradient, self.vector)):
                own = vector[at : at + size]
                views[name] = own.reshape(shape)
            at += size

    def step(self, rate: float) -> None:
        self.steps += 1
        t, g, m, v = self.steps, self.vector, self.mean, self.square
        g *= np.float32(0.1)
        m *= np.float32(0.9)
        m += g
        g *= g  # a hundredth of the squares
        v *= np.float32(0.99)
        v += g
        root = math.sqrt(1 - 0.99**t)
        np.sqrt(v, out=g)
        g += np.float32(1e-8 * root)
        np.divide(m, g, out=g)
        g *= np.float32(rate * root / (1 - 0.9**t))
        self.weights -= g


def _opened(block) -> tuple[np.ndarray, ...]:
    """Documents, words (each text's, then the end), and the words' ids with
    their sizes, of a block's row."""
    meta, sequence = _unpacked(block["a"], _DOC), _unpacked(block["b"], np.uint32)
    raw = _unpacked(block["c"], np.uint8).tobytes()
    n, end = map(int, np.frombuffer(raw, "<u4", 2))
    words = np.insert(sequence.astype(np.int64), np.cumsum(meta["n_words"]), end)
    return meta, words, np.frombuffer(raw, "<u2", -1, 8 + 4 * n), np.frombuffer(raw, "<u4", n, 8).astype(np.int64)


def _spelled(meta, words, flat, sizes, texts: int = 512):
    """(first text, last, its ids, number of ids of each) of some texts at a time."""
    n_tokens = meta["n_words"].astype(np.int64) + 1
    starts, begin = np.cumsum(n_tokens) - n_tokens, np.cumsum(sizes) - sizes
    for a in range(0, len(meta), texts):
        b = min(a + texts, len(meta))
        own = words[starts[a] : starts[b - 1] + n_tokens[b - 1]]
        yield a, b, _gather(flat, begin, sizes, own).astype(np.int64), np.add.reduceat(sizes[own], starts[a:b] - starts[a])


def pair_counts(rows: DataFrame, model: Attention) -> np.ndarray:
    """Pairs of ids over all training documents: a sum in each task, four sums
    of those in Spark, the last one here (the table's size is fixed)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import zstandard

        total = None
        for row in _rows_of(batches):
            for ids, n in _training(row):
                first = np.zeros(len(ids), bool)
                first[np.cumsum(n) - n] = True
                total = shared.value.count_pairs(ids, first, total)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % 4], pa.int32()), pa.array([zstandard.ZstdCompressor(level=1).compress(total.tobytes())], pa.binary())], ["part", "a"])

    def add(part: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        total = np.zeros((BEFORE + CLASSES) * (AFTER + 1), np.uint64)
        for x in part["a"]:
            total += _unpacked(x, "<u4")
        return pd.DataFrame({"a": [zstandard.ZstdCompressor(level=1).compress(total.tobytes())]})

    sums = rows.select("a", "b", "c").mapInArrow(run, "part int, a binary").groupBy("part").applyInPandas(add, "a binary").collect()
    return sum((_unpacked(r["a"], "<u8") for r in sums), np.zeros((BEFORE + CLASSES) * (AFTER + 1), np.uint64))


def _training(row) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, number of ids of each) of a block's training texts, some at a time."""
    opened = _opened(row)
    for a, b, ids, n in _spelled(*opened):
        train = ~opened[0]["held_out"][a:b]
        if train.any():
            yield ids[np.repeat(train, n)], n[train]


def _rows_of(batches) -> Iterator[dict]:
    for part in (batch.slice(at, 1) for batch in batches for at in range(batch.num_rows)):
        yield from part.to_pylist()


def neighbour_table(rows: DataFrame, counts: np.ndarray) -> np.ndarray:
    """Neighbours of every id (a row a rank) over all training documents: a sum in
    each task, sums of cell ranges in Spark; the table's size is fixed."""
    cells = VOCABULARY * (2 * COLUMNS + 2)
    step = -(-cells // 16)
    shared = rows.sparkSession.sparkContext.broadcast(ranked(counts)[1])

    def run(batches):
        import zstandard

        pack, total = zstandard.ZstdCompressor(level=1).compress, None
        for row in _rows_of(batches):
            for ids, n in _training(row):
                before = np.concatenate([[END], ids[:-1]])
                before[np.cumsum(n) - n] = END
                total = np.zeros(cells, np.uint32) if total is None else total
                np.add.at(total, neighbour_counts(shared.value, before, ids), np.uint32(1))
        for part in range(16 if total is not None else 0):
            own = total[part * step : (part + 1) * step]
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([pack(at.astype("<u4").tobytes())], pa.binary()), pa.array([pack(own[at].tobytes())], pa.binary())], ["part", "a", "b"])

    def add(part: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        total, pack = np.zeros(step, np.uint64), zstandard.ZstdCompressor(level=1).compress
        for at, n in zip(part["a"], part["b"], strict=True):
            total[_unpacked(at, "<u4")] += _unpacked(n, "<u4")
        return pd.DataFrame({"part": [int(part["part"].iloc[0])], "a": [pack(total.astype("<f4").tobytes())]})

    out = np.zeros(cells, np.float32)
    for r in rows.select("a", "b", "c").mapInArrow(run, "part int, a binary, b binary").groupBy("part").applyInPandas(add, "part int, a binary").collect():
        own = out[r["part"] * step : (r["part"] + 1) * step]
        own[:] = _unpacked(r["a"], "<f4")[: len(own)]
    return out.reshape(VOCABULARY, -1)


def learn_all(rows: DataFrame, model: Attention) -> int:
    """Trains the model once on every id of every training document, in rounds of
    some of the blocks: each task goes on from the shared weights over its own
    documents, and the tasks' weights are averaged by their windows. Returns the
    number of windows."""
    names, seen = list(model.p), 0
    for turn, rate in enumerate(RATES):
        shared = rows.sparkSession.sparkContext.broadcast(model)

        def run(batches, shared=shared, rate=rate):
            own, windows = copy.copy(shared.value), 0
            adam = Adam(own)
            for row in _rows_of(batches):
                for ids, n in _training(row):
                    windows += own.learn(adam, ids, n, rate)
            if windows:
                weights = np.concatenate([own.p[k].ravel() for k in names]).astype("<f8") * windows
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % 16], pa.int32()), pa.array([windows], pa.int64()), pa.array([weights.tobytes()], pa.binary())], ["part", "windows", "a"])

        def add(part: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(bytes(x), "<f8") for x in part["a"])
            return pd.DataFrame({"windows": [int(part["windows"].sum())], "a": [total.tobytes()]})

        some = rows.where(F.pmod(F.xxhash64("block"), F.lit(len(RATES))) == turn).select("a", "b", "c")
        sums = some.mapInArrow(run, "part int, windows long, a binary").groupBy("part").applyInPandas(add, "windows long, a binary").collect()
        windows = sum(r["windows"] for r in sums)
        if windows:
            mean, at = sum(np.frombuffer(bytes(r["a"]), "<f8") for r in sums) / windows, 0
            for name in names:
                model.p[name] = mean[at : at + model.p[name].size].reshape(model.p[name].shape).astype(np.float32)
                at += model.p[name].size
        seen += windows
    return seen


def scores(documents: DataFrame, path: str | None = None, modulus: int = HELD_OUT_MODULUS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long"), (remainder("doc_id", modulus) == 0).alias("held_out"), F.col("text").cast("string"))
    buckets = min(BUCKETS, max(16, 4 * docs.rdd.getNumPartitions()))
    rows = stored(blocks(docs, path, buckets, block_bytes), "lm-blocks")
    sums = stored(summed(rows.where("kind >= 0")), "lm-counts")
    totals = sums.agg(F.sum("types").alias("v"), F.sum("tokens").alias("n")).first()
    types, tokens = totals["v"] or 0, totals["n"] or 0
    drawn = rows.where(F.col("kind") == _SAMPLE).orderBy(F.xxhash64("a")).limit(SAMPLE_DOCS).collect()
    sample, left = [], SAMPLE_IDS
    for r in drawn:
        ids = _unpacked(r["a"], "<u2").astype(np.int64)[: max(0, left)]
        left -= len(ids)
        sample.append(ids)
    sample = [s for s in sample if len(s)]
    whole, counts = rows.where(F.col("kind") == _DOCS), id_counts(rows.where(F.col("kind") == _IDS))
    model = Attention(counts, sample, neighbours=neighbour_table(whole, counts))
    pairs = pair_counts(whole, model)
    model.train(sample)
    learn_all(whole, model)
    model.set_pairs(pairs)
    shared = spark.sparkContext.broadcast(model)

    def score(block: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
        if not len(block):
            return pd.DataFrame({c: [] for c in names})
        meta, words, flat, sizes = _opened(block.iloc[0])
        seen = np.zeros(len(sizes))
        for first, n in zip(counts["first"], counts["n"], strict=True):
            own = _unpacked(n, "<u8")
            seen[int(first) : int(first) + len(own)] = own
        n_tokens = meta["n_words"].astype(np.int64) + 1
        starts = np.cumsum(n_tokens) - n_tokens
        base = np.add.reduceat(np.log10(seen + SMOOTHING)[words], starts) - n_tokens * math.log10(tokens + SMOOTHING * (types + 1))
        known = np.add.reduceat((seen > 0).astype(np.int64)[words], starts)
        result = np.empty(len(meta))
        for a, b, ids, n in _spelled(meta, words, flat, sizes):
            result[a:b] = shared.value.scores(ids, n)
        return pd.DataFrame({"doc_id": pd.array(meta["doc_id"], "Int64").copy() if meta["known_id"].all() else pd.array([int(i) if k else None for i, k in zip(meta["doc_id"], meta["known_id"], strict=True)], "Int64"), "held_out": meta["held_out"], "n_tokens": n_tokens, "n_known": known, "base_score": base, "score": result})

    left_rows = rows.where(F.col("kind") == _DOCS).select("block", "a", "b", "c")
    right_rows = sums.where("block is not null").select("block", "first", "n")
    out = left_rows.groupBy("block").cogroup(right_rows.groupBy("block")).applyInPandas(score, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op8_attention_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"))
