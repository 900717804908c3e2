"""Sum-of-squares online packing of token ids into windows.

Each document (its ids, then ``END_ID``) is cut into full windows and a rest.
The rest goes, online, to the fill level that makes the sum of the squared
counts of partly filled windows least; the counts are a level array, and the
choice is one vectorised look at it. A level's windows form a stack.

At the end of a task, or when ``max_open`` windows are open, the open windows
are closed: the emptiest ones are cut to fill the fullest, and the last rest
is cut into powers of two, which need no padding. So padding is 0.

Edge cases: NULL and empty texts are one token (the end id); repeated rows are
packed each by itself; a NULL doc_id stays NULL; very long texts only yield
more full windows; extra columns are ignored.

Scale: no shuffle. Each input partition packs its own rows; sequence ids carry
the partition number. The state of a task is at most ``max_open`` open windows.
A retried task reads the same rows in the same order and packs them alike.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txpipe.llm.common import table

CAPACITY = 4096
END_ID = 2
MAX_OPEN = 2048
TOKENIZER = "word_bpe_49k.json"
CACHE_WORDS = 800_000

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

# Latin-1 only: letters, numbers and white space are then known, and every text is in NFC.
_PIECE = re.compile("[a-zªµºß-öø-ÿ]+|'(?:s|t|re|ve|m|ll|d)|[0-9²³¹¼½¾]|[^\t-\r \x85\xa0a-z0-9ªµºß-öø-ÿ²³¹¼½¾]+")


def _plain(text: str) -> bool:
    if "<|" in text:
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts as little-endian uint32 bytes, with the pieces' ids kept.

    The tokenizer encodes each piece by itself, so a piece has the same ids
    everywhere; new ones are encoded many at a time, and told apart by the
    tokens that end a word. Texts beyond Latin-1, or with a special token's
    opening, go to the tokenizer whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> None:
        ids = np.asarray(self.tokenizer.encode(" ".join(pieces), add_special_tokens=False).ids, "<u4")
        cuts = [0, *(4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()]
        if len(cuts) != len(pieces) + 1 or cuts[-1] != 4 * len(ids):
            self.known.update(zip(pieces, self._ids(pieces), strict=True))
            return
        raw = ids.tobytes()
        self.known.update((p, raw[a:b]) for p, a, b in zip(pieces, cuts, cuts[1:], strict=False))

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        get, out, new, gaps = self.known.get, [], set(), []
        for text in texts:
            if not _plain(text):
                out.append(self._ids([text]))
                continue
            pieces = _PIECE.findall(text.lower())
            out.append(ids := list(map(get, pieces)))
            if None in ids:
                own = [i for i, x in enumerate(ids) if x is None]
                gaps.append((pieces, ids, own))
                new.update(pieces[i] for i in own)
        pending = list(new)
        for i in range(0, len(pending), 1024):
            self._learn(pending[i : i + 1024])
        for pieces, ids, own in gaps:
            for i in own:
                ids[i] = self.known[pieces[i]]
        return list(map(b"".join, out))


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """A Python worker's encoder; what it knows serves all its tasks."""
    return Encoder(path)


class Packer:
    """State of one task. A piece is (doc_id, start, ids as bytes, doc_tokens)."""

    def __init__(self, first_id: int, capacity: int = CAPACITY, max_open: int = MAX_OPEN):
        self.capacity, self.max_open, self.next_id = capacity, max_open, first_id
        self.levels = np.zeros(capacity + 1, np.int64)  # partly filled windows by fill; 0 and capacity stay 0
        self.stacks: dict[int, list[list[tuple]]] = {}
        self.rows: list[tuple] = []

    def emit(self, window: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in window:
            n = len(ids) // 4
            self.rows.append((doc_id, start, n, zlib.crc32(ids), total, self.next_id, offset))
            offset += n
        self.next_id += 1

    def level_for(self, size: int) -> int:
        """Fill level whose window takes the piece: least growth of the sum of
        squared counts; of equal ones the fullest. 0: a new window."""
        n, cap = self.levels, self.capacity
        growth = 2 * (n[size : cap + 1] - n[: cap + 1 - size]) + 2
        growth[-1] = 1 - 2 * n[cap - size]
        growth[1:][n[1 : cap + 1 - size] == 0] = np.iinfo(np.int64).max
        growth[0] = 2 * n[size] + 1
        return len(growth) - 1 - int(np.argmin(growth[::-1]))

    def add(self, doc_id, ids: bytes) -> None:
        cap, total = 4 * self.capacity, len(ids) // 4
        full = len(ids) // cap * cap
        for at in range(0, full, cap):
            self.emit([(doc_id, at // 4, ids[at : at + cap], total)])
        if size := (len(ids) - full) // 4:
            level = self.level_for(size)
            window = self.stacks[level].pop() if level else []
            window.append((doc_id, full // 4, ids[full:], total))
            if level:
                self.levels[level] -= 1
            if level + size == self.capacity:
                self.emit(window)
            else:
                self.levels[level + size] += 1
                self.stacks.setdefault(level + size, []).append(window)
                if int(self.levels.sum()) >= self.max_open:
                    self.close()

    def close(self) -> None:
        """Fill the fullest open windows with pieces cut from the emptiest."""
        fills = [(level, w) for level in sorted(self.stacks, reverse=True) for w in self.stacks[level]]
        self.stacks, self.levels[:] = {}, 0
        lo, hi, last = 0, len(fills) - 1, None
        while lo <= hi:
            level, window = fills[lo]
            lo += 1
            while level < self.capacity and lo <= hi:
                donor = fills[hi][1]
                doc_id, start, ids, total = donor.pop()
                take = min(self.capacity - level, len(ids) // 4)
                window.append((doc_id, start, ids[: 4 * take], total))
                level += take
                if 4 * take < len(ids):
                    donor.append((doc_id, start + take, ids[4 * take :], total))
                if not donor:
                    hi -= 1
            if level == self.capacity:
                self.emit(window)
            else:
                last = window
        if last:
            self.tail(last)

    def tail(self, window: list[tuple]) -> None:
        """The last rest in sequences whose lengths are powers of two."""
        left = sum(len(p[2]) for p in window) // 4
        queue = window[::-1]
        while left:
            room, part = 1 << (left.bit_length() - 1), []
            left -= room
            while room:
                doc_id, start, ids, total = queue.pop()
                take = min(room, len(ids) // 4)
                part.append((doc_id, start, ids[: 4 * take], total))
                room -= take
                if 4 * take < len(ids):
                    queue.append((doc_id, start + take, ids[4 * take :], total))
            self.emit(part)

    def take_rows(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * len(names))], names)


def pack(documents: DataFrame, path: str | None = None, capacity: int = CAPACITY, max_open: int = MAX_OPEN) -> DataFrame:
    """One row per piece; see ``SCHEMA``."""
    path = path or tokenizer_path()
    end = np.asarray([END_ID], "<u4").tobytes()

    def run(batches):
        packer = Packer(TaskContext.get().partitionId() << 36, capacity, max_open)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder(path).encode(texts), strict=True):
                    packer.add(doc_id, ids + end)
            if rows := packer.take_rows():
                yield _batch(rows)
        packer.close()
        yield _batch(packer.take_rows())

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def op5_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


