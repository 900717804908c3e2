"""Phrase collocations, counted in counting quotient filters.

Texts are read once: blocks of some 8 MB become numbers into the block's own
list of words, kept as small rows: one a word, and pieces of the text. Words of
``LEAST`` or more occurrences in their language get dense ids, joined back to
the blocks; no phrase with a rarer word can be a candidate. A block's rows are
sorted and streamed to one task, which holds one block at a time. Its word
n-grams go into quotient filters (``quotient.py``), split by the first bits of
the permuted key. Filters of one shard are merged, up to ``FAN`` at once; where
there are more blocks, groups of them are merged first and split further, so
that a task's share stays that of a block. An id belongs to one language, so
keys need no language beside them.

Then plain joins: the counts of a candidate's parts at each cut, the lowest
score, the longer candidates that swallow it, and the first ranks per language.
All counts are exact.

Edge cases: NULL and empty texts have no words; a NULL language is ``und``;
repeated rows count as often as they come; doc_id is not used; a language
without candidates has no rows; an empty table gives none; extra columns are
ignored. A single text longer than a block is a block by itself.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txpipe.llm import quotient as Q
from txpipe.llm.common import stored, table, text_bytes

LEAST = 30
TOP = 2_000
SHARE = 80  # per cent of a phrase's occurrences that a longer one must reach to swallow it
LONGEST = 4
SCALE = 2_000_000
BLOCK = 8 << 20  # bytes of text
FAN = 4_096
ID_ROWS = 1 << 16  # words numbered by one task
RANK_ROWS = 1 << 20
TEXTS = 256  # texts taken out of a batch at once
WORD_ROWS = 8_192  # words of a block in one batch
TEXT_NUMBERS = 1 << 16  # numbers of a block's text in one row
KEYS = 1 << 18  # places of n-grams permuted at once
_ROW = pa.schema([("block", pa.int64()), ("place", pa.int32()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64()), ("ids", pa.binary())])

# The characters that end a piece.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_FOLD = bytes(10 if b in _ENDS else b + 32 if 65 <= b <= 90 else b for b in range(256))


def blocks(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """``block, place, lang, word, n, ids``: a row for each word of a block, at
    its place, and rows without a word that hold the block's text in order:
    numbers, one more than a word's place, 0 between pieces, as two or four
    bytes; ``n`` is then the number of words. No row is large."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        langs: dict[str, defaultdict] = {}
        size, width, pieces = 0, 0, []

        def rows(*columns) -> pa.RecordBatch:
            columns = ([part << 32 | made] * len(columns[0]), *columns)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _ROW.types, strict=True)], schema=_ROW)

        def flush() -> Iterator[pa.RecordBatch]:
            n = np.zeros(width + 1, np.int64)
            for body in _cut(pieces, TEXT_NUMBERS):
                n += np.bincount(body, minlength=width + 1)
            words, of = [b""] * width, [""] * width
            for lang, known in langs.items():
                for word, i in known.items():
                    words[i - 1], of[i - 1] = word, lang
            for at in range(0, width, WORD_ROWS):
                to = min(width, at + WORD_ROWS)
                yield rows(np.arange(at, to), of[at:to], pa.array(words[at:to], pa.binary()).cast(pa.string()), n[at + 1 : to + 1], [None] * (to - at))
            kind = np.uint16 if width < 1 << 16 else np.uint32
            for at, body in enumerate(_cut(pieces, TEXT_NUMBERS)):
                yield rows([at], [None], [None], [width], [body.astype(kind).tobytes()])

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                some = batch.slice(at, TEXTS)
                for raw, lang in zip(text_bytes(some.column(0)), some.column(1).to_pylist(), strict=True):
                    known = langs.setdefault(lang, defaultdict())
                    known.default_factory = lambda: width + 1
                    ids: list[int] = []
                    for piece in raw.translate(_FOLD).split(b"\n"):
                        for word in piece.split():
                            i = known[word]
                            if i > width:
                                width = i
                            ids.append(i)
                        ids.append(0)
                    pieces.append(np.array(ids, np.uint32))
                    size += len(raw)
                    if size >= block:
                        yield from flush()
                        langs, size, width, pieces, made = {}, 0, 0, [], made + 1
        if width:
            yield from flush()

    texts = documents.select(F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    return texts.mapInArrow(run, "block long, place int, lang string, word string, n long, ids binary")


def _cut(pieces: list[np.ndarray], most: int) -> Iterator[np.ndarray]:
    """The pieces in order, as arrays of ``most`` numbers, the last one of fewer."""
    held, size = [], 0
    for piece in pieces:
        while size + len(piece) >= most:
            yield np.concatenate([*held, piece[: most - size]])
            piece, held, size = piece[most - size :], [], 0
        held.append(piece)
        size += len(piece)
    if size:
        yield np.concatenate(held)


def _words(blocked: DataFrame) -> DataFrame:
    return blocked.where(F.col("word").isNotNull()).drop("ids")


def _texts(blocked: DataFrame) -> DataFrame:
    return blocked.where(F.col("word").isNull())


def vocabulary(blocked: DataFrame, least: int = LEAST) -> DataFrame:
    """``lang, word, a, id`` of words with ``least`` or more occurrences; stored."""
    words = _words(blocked).groupBy("lang", "word").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    words = stored(words, "phrase-words")
    parts = max(1, math.ceil(words.count() / ID_ROWS))
    words = words.withColumn("p", F.pmod(F.xxhash64("lang", "word"), F.lit(parts)))
    at = F.row_number().over(Window.partitionBy("p").orderBy("lang", "word"))
    return stored(words.withColumn("id", (at - 1).cast("long") * parts + F.col("p")).drop("p"), "phrase-ids")


def grams(ids: np.ndarray, n: int, bits: int) -> Q.Keys:
    """Keys of the ``n``-grams of frequent words; ``ids`` holds -1 for others and
    between pieces."""
    m = max(0, len(ids) - n + 1)
    parts = [Q.permuted([np.zeros(0, np.uint64)] * n, bits)]
    for start in range(0, m, KEYS):
        part = ids[start : start + KEYS + n - 1]
        good = np.ones(len(part) - n + 1, bool)
        for j in range(n):
            good &= part[j : j + len(good)] >= 0
        at = np.flatnonzero(good)
        parts.append(Q.permuted([part[at + j].astype(np.uint64) for j in range(n)], bits))
    return np.concatenate([hi for hi, _ in parts]), np.concatenate([lo for _, lo in parts])


def filters(blocked: DataFrame, vocab: DataFrame, bits: int, split: int) -> DataFrame:
    """``n, shard, source, body``: each block's filters. A block's frequent words
    and then its text come to one task as sorted rows."""
    known = _words(blocked).join(vocab.select("lang", "word", "id"), ["lang", "word"])
    known = known.select("block", F.lit(False).alias("text"), "place", F.col("id").alias("n"), F.lit(None).cast("binary").alias("ids"))
    texts = _texts(blocked).select("block", F.lit(True).alias("text"), "place", "n", "ids")
    rows = known.unionByName(texts).repartition("block").sortWithinPartitions("block", "text", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_block, words, texts = None, [], []

        def made() -> Iterator[pa.RecordBatch]:
            if not words or not texts:
                return
            width = texts[0][0]
            number = np.full(width + 1, -1, np.int64)
            for place, word in words:
                number[place + 1] = word
            ids = np.concatenate([number[np.frombuffer(body, np.uint16 if width < 1 << 16 else np.uint32)] for _, body in texts])
            texts.clear()
            for n in range(2, LONGEST + 1):
                keys, counts = Q.counted(grams(ids, n, bits))
                for part in batched(Q.sharded(keys, counts, n * bits, min(split, n * bits)), 512):
                    columns = [pa.array([n] * len(part), pa.int32()), pa.array([s for s, _ in part], pa.int64()), pa.array([at_block] * len(part), pa.int64()), pa.array([b for _, b in part], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["n", "shard", "source", "body"])

        for batch in batches:
            blocks = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if blocks[a] != at_block:
                    yield from made()
                    at_block, words, texts = int(blocks[a]), [], []
                part = batch.slice(a, b - a)
                first = (b - a) - part.column(1).true_count
                if first:
                    words.append((part.column(2).slice(0, first).to_numpy(), part.column(3).slice(0, first).to_numpy()))
                texts += zip(part.column(3).slice(first).to_pylist(), part.column(4).slice(first).to_pylist(), strict=True)
        yield from made()

    return rows.mapInArrow(run, "n int, shard long, source long, body binary")


def _merger(bits: int, split: int):
    """Merges a group's filters and splits the result further."""

    def again(group: pd.DataFrame) -> pd.DataFrame:
        n, shard, source = (int(group[c].iloc[0]) for c in ("n", "shard", "source"))
        keys, counts = Q.merged(list(group["body"]), n * bits, shard)
        out = list(Q.sharded(keys, counts, n * bits, min(split, n * bits)))
        return pd.DataFrame({"n": n, "shard": [s for s, _ in out], "source": source, "body": [b for _, b in out]})

    return again


def phrases(blocked: DataFrame, vocab: DataFrame, least: int = LEAST, fan: int = FAN) -> DataFrame:
    """``ids, a`` of all phrases of two to ``LONGEST`` words with ``least`` or more
    occurrences."""
    top = vocab.agg(F.max("id")).first()[0] or 0
    bits = max(1, int(top).bit_length())
    if bits * LONGEST > 128:
        raise ValueError(f"word ids of {bits} bits do not fit")
    n_blocks = max(1, _texts(blocked).where(F.col("place") == 0).count())
    step = min(fan.bit_length() - 1, n_blocks.bit_length() + 1)  # bits of the key by which each round splits
    rounds = max(1, math.ceil(math.log(n_blocks, fan)))
    rows = filters(blocked, vocab, bits, step)
    for i in range(1, rounds):
        rows = rows.withColumn("source", F.pmod(F.xxhash64("source"), F.lit(math.ceil(n_blocks / fan**i))))
        rows = rows.groupBy("n", "shard", "source").applyInPandas(_merger(bits, step * (i + 1)), "n int, shard long, source long, body binary")

    def frequent(group: pd.DataFrame) -> pd.DataFrame:
        n = int(group["n"].iloc[0])
        (hi, lo), counts = Q.merged(list(group["body"]), n * bits, int(group["shard"].iloc[0]))
        often = counts >= least
        ids = Q.restored((hi[often], lo[often]), n, bits).astype(np.int64)
        return pd.DataFrame({"ids": pd.Series(list(ids), dtype=object), "a": counts[often]})

    return rows.groupBy("n", "shard").applyInPandas(frequent, "ids array<bigint>, a long")


def scored(found: DataFrame, vocab: DataFrame, share: int = SHARE) -> DataFrame:
    """``ids, a, l, r, score`` of the candidates that no longer one swallows."""
    counts = found.unionByName(vocab.select(F.array("id").alias("ids"), "a"))
    n = F.size("ids")
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), n - 1)))
    cuts = cuts.withColumns({"first": F.slice("ids", F.lit(1), F.col("k")), "rest": F.slice("ids", F.col("k") + 1, n - F.col("k"))})
    cuts = cuts.join(counts.select(F.col("ids").alias("first"), F.col("a").alias("l")), "first").join(counts.select(F.col("ids").alias("rest"), F.col("a").alias("r")), "rest")
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    score = F.expr(f"CAST(a AS DECIMAL(20,0)) * {SCALE} DIV (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    best = cuts.groupBy("ids", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("s")).select("ids", "a", "s.l", "s.r", "s.score")
    inside = F.flatten(F.transform(F.sequence(F.lit(2), n - 1), lambda m: F.transform(F.sequence(F.lit(1), n - m + 1), lambda i: F.slice("ids", i, m))))
    longer = found.where(n > 2).select(F.explode(inside).alias("ids"), F.col("a").alias("b")).groupBy("ids").agg(F.max("b").alias("b"))
    kept = best.join(longer, "ids", "left")
    return kept.where(F.col("b").isNull() | (wide("b") * 100 < wide("a") * share)).drop("b")


def collocations(documents: DataFrame, least: int = LEAST, top: int = TOP, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``."""
    blocked = stored(blocks(documents, block), "phrase-blocks")
    vocab = vocabulary(blocked, least)
    found = stored(phrases(blocked, vocab, least, fan), "phrases")
    rows = scored(found, vocab).withColumn("key", F.xxhash64("ids"))
    words = rows.select("ids", F.posexplode("ids").alias("at", "id")).join(vocab.select("id", "lang", "word"), "id")
    words = words.groupBy("ids").agg(F.first("lang").alias("lang"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ").alias("phrase"))
    rows = stored(rows.join(words, "ids").select("lang", "phrase", "a", "l", "r", "score"), "phrase-scores")
    # A language may hold all rows: first ranks within bounded shares of it, then among those.
    shares = max(1, math.ceil(rows.count() / RANK_ROWS))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = Window.partitionBy("lang", "share").orderBy(*order)
    rows = rows.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(shares))).withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    total = _words(blocked).groupBy("lang").agg(F.sum("n").alias("n"))
    return rows.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_quotient_filter_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    lead = lambda j: f"w || ' ' || " + " || ' ' || ".join(f"lead(w, {i}) OVER o" for i in range(1, j))  # noqa: E731, F541
    cut = lambda x, a, b: f"array_to_string(string_split({x}, ' ')[{a}:{b}], ' ')"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{upper}', '{lower}') AS t FROM documents),
p AS (SELECT r, lang, unnest(s) AS p, generate_subscripts(s, 1) AS i FROM (SELECT r, lang, string_split_regex(t, '[.,;:!?\\x0A-\\x0D]') AS s FROM d)),
w AS (SELECT r, lang, i, unnest(s) AS w, generate_subscripts(s, 1) AS j FROM (SELECT r, lang, i, regexp_extract_all(p, '[^\\x20\\x09]+') AS s FROM p)),
g AS (SELECT lang, w AS g1, {lead(2)} AS g2, {lead(3)} AS g3, {lead(4)} AS g4 FROM w WINDOW o AS (PARTITION BY r, i ORDER BY j)),
f AS (SELECT lang, 1 AS m, g1 AS p, count(*) AS a FROM g GROUP BY ALL UNION ALL SELECT lang, 2, g2, count(*) FROM g WHERE g2 IS NOT NULL GROUP BY ALL
      UNION ALL SELECT lang, 3, g3, count(*) FROM g WHERE g3 IS NOT NULL GROUP BY ALL UNION ALL SELECT lang, 4, g4, count(*) FROM g WHERE g4 IS NOT NULL GROUP BY ALL),
c AS (SELECT * FROM f WHERE m > 1 AND a >= {LEAST}),
k AS (SELECT c.*, k FROM c, range(1, {LONGEST}) t(k) WHERE k < m),
s AS (SELECT k.lang, k.p, k.a, k.k, x.a AS l, y.a AS r, CAST({SCALE} * CAST(k.a AS HUGEINT) // (x.a + y.a) AS BIGINT) AS score
      FROM k JOIN f x ON x.lang = k.lang AND x.p = {cut("k.p", 1, "k.k")} JOIN f y ON y.lang = k.lang AND y.p = {cut("k.p", "k.k + 1", "k.m")}),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
i AS (SELECT lang, {cut("p", "i", "i + n - 1")} AS p, max(a) AS a FROM c, range(2, {LONGEST}) t(n), range(1, {LONGEST}) u(i) WHERE n < m AND i + n - 1 <= m GROUP BY ALL),
e AS (SELECT b.* FROM b LEFT JOIN i ON i.lang = b.lang AND i.p = b.p WHERE i.a IS NULL OR 100 * CAST(i.a AS HUGEINT) < {SHARE} * CAST(b.a AS HUGEINT)),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rk FROM e)
SELECT o.lang, CAST(rk AS BIGINT) AS rank, p AS phrase, a, l, r, CAST(n.n AS BIGINT) AS n, score
FROM o JOIN (SELECT lang, count(*) AS n FROM w GROUP BY lang) n ON n.lang = o.lang WHERE rk <= {TOP}
"""


ORACLE_SQL = _oracle()
