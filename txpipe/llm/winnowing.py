"""Document fingerprints by winnowing, in DataFrame functions only.

A text's k-grams of code points get polynomial hashes modulo 2^31 - 1, and of
each window of ``WINDOW`` consecutive k-grams the least hash is chosen, the
rightmost of equal ones. The fingerprint is the list of chosen (hash, position)
pairs. So any passage of ``WINDOW + K - 1`` code points that two texts share
gives them a common hash, and none shorter than ``K`` does by itself. Hashes of
2, 4 and 8 code points come from those of half the length, and so do least
values of 2 to 32 k-grams: array functions over a bounded segment of the text.
A hash and its place are packed in one long, so the least one is the rightmost
of ties. The likeness of two fingerprints is the Jaccard index of their hashes.

``compared`` sets each document against an edited self, the last half replaced
by the beginning of the next document, and against that next document. The
order is by descending doc_id, then by a hash of the row; after the last row
comes the first.

Edge cases: NULL and empty texts have the fingerprint of a k-gram of zeros, as
all texts shorter than ``K`` are filled up with zeros, and of fewer k-grams
than a window all are one window; rows that are equal in doc_id and text follow
one another, so all but the last have themselves as next; NULL ids come last;
a single row is its own next; an empty table gives no rows; extra columns are
ignored.

Scale: the order is cut into ranges on keys alone (a few for each shuffle
partition; their bounds pass the driver), and a text is shuffled once, without
its fingerprint, into its part, where the next row is its neighbour; the first
row of the next part is sent along. Windows that lie in the kept half
are not chosen from again. Rows that are there over ``COPIES`` times are merged
before the shuffle and dealt out again after it.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txpipe.llm.common import stored, table, with_row_keys

K = 8
WINDOW = 32
BASE = 1_000_003
MODULUS = 2**31 - 1
SEGMENT = 16_384  # windows worked on at once
COPIES = 1_024  # equal rows that are shuffled each by itself
PARTS = 4  # of the order, for each shuffle partition
_LOW = 2**32 - 1
_LEAST = -(2**62)
COMMON = 5


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


def _paired(values: Column, far: int, join: Callable[[Column, Column], Column]) -> Column:
    """``join(values[i], values[i + far])`` for all i that have both."""
    n = F.size(values) - far
    return F.zip_with(F.slice(values, 1, n), F.slice(values, far + 1, n), join)


def _filled(values: Column, least: int, value: int) -> Column:
    return F.concat(values, F.array_repeat(F.lit(value).cast("long"), F.greatest(F.lit(least) - F.size(values), F.lit(0))))


def _without_peaks(packed: Column) -> Column:
    """The values, between two lesser bounds, that are the least of a window.

    A value is not if the next lesser ones on both sides are at most ``WINDOW``
    apart. One that is less than neither neighbour, where those lie so near, is
    never the next lesser one of another value, so all such go at once; what is
    left when none goes is the answer. Of the values between two so near, each
    round takes one or more, so ``WINDOW`` rounds always do."""

    def kept(values: Column) -> Column:
        before, after = lambda i: F.get(values, i - 1), lambda i: F.get(values, i + 1)
        apart = lambda i: before(i).bitwiseAND(F.lit(_LOW)) - after(i).bitwiseAND(F.lit(_LOW))
        return F.filter(values, lambda v, i: (v < before(i)) | (v < after(i)) | (apart(i) > F.lit(WINDOW)))

    def state(values: Column, size: Column) -> Column:
        return F.struct(values.alias("v"), size.alias("n"))

    def go_on(s: Column, _: Column) -> Column:
        return F.when(F.size(s["v"]) == s["n"], s).otherwise(state(kept(s["v"]), F.size(s["v"])))

    return F.aggregate(F.sequence(F.lit(1), F.lit(WINDOW)), state(packed, F.lit(-1)), go_on, lambda s: s["v"])


def _chosen(segment: Column, first: Column) -> Column:
    """Packed (hash, place) of each window of a segment that begins at ``first``.

    Hashes in the lowest ``COMMON`` of 32 parts are enough wherever each window
    holds one. Windows that hold none lie in a gap between two of those; there all
    hashes are looked at."""

    def grams(codes: Column, n: int = 1) -> Column:
        power = pow(BASE, n, MODULUS)
        joined = lambda a, b: (a * F.lit(power) + b) % F.lit(MODULUS)
        if 2 * n < K:
            return _let(_paired(codes, n, joined), lambda h: grams(h, 2 * n))
        last = F.slice(codes, 1, F.size(codes) - n)  # places count from 1 here
        return F.transform(last, lambda a, i: joined(a, F.get(codes, i + n)) * F.lit(_LOW + 1) + (F.lit(_LOW - 1) - i))

    def bounded(all_: Column, some: Column) -> Column:
        end = F.greatest(F.size(all_), F.lit(WINDOW)) + 1
        return F.concat(F.array(F.lit(_LEAST + _LOW)), some, F.array(F.lit(_LEAST + _LOW) - end))

    def least(all_: Column) -> Column:
        def with_gap(low: Column) -> Column:
            at = lambda v: v.bitwiseAND(F.lit(_LOW))
            apart = lambda v, i: at(v) - at(F.get(low, i + 1))
            between = lambda v, n: F.slice(all_, place(v).cast("int") + 1, n.cast("int") - 1)
            return F.flatten(F.transform(low, lambda v, i: F.when(apart(v, i) > F.lit(WINDOW), F.concat(F.array(v), between(v, apart(v, i)))).otherwise(F.array(v))))

        low = bounded(all_, F.filter(all_, lambda v: v < F.lit(COMMON << 58)))
        return _without_peaks(_let(low, with_gap))

    codes = F.transform(F.split(segment, ""), F.ascii).cast("array<bigint>")
    filled = _let(codes, lambda c: _filled(c, K, 0))
    found = _let(_let(filled, grams), least)
    return _let(found, lambda v: F.transform(F.slice(v, 2, F.size(v) - 2), lambda x: x + 1 - first))


def fingerprint(text: Column, first: Column | None = None, last: Column | None = None) -> Column:
    """The chosen (hash, place) pairs of a text, packed in longs, by place: those
    of all its windows, or of windows ``first`` to ``last`` (long, not before it)."""
    end = F.greatest(F.length(text) - (K + WINDOW - 2), F.lit(1)) - 1 if last is None else last
    starts = F.sequence(F.lit(0) if first is None else first, end, F.lit(SEGMENT))
    size = lambda s: F.least(F.lit(SEGMENT), end - s + 1) + (K + WINDOW - 2)
    parts = F.transform(starts, lambda s: _chosen(F.substr(text, s + 1, size(s)), s.cast("long")))
    return F.array_distinct(F.flatten(parts))


def hashes(packed: Column) -> Column:
    return F.array_distinct(F.transform(packed, lambda v: F.shiftright(v, 32).cast("int")))


def place(packed: Column) -> Column:
    return F.lit(_LOW) - packed.bitwiseAND(F.lit(_LOW))


def shown(packed: Column) -> Column:
    """``hash:place`` of each pair, comma-joined."""
    pair = lambda v: F.concat_ws(":", F.shiftright(v, 32), place(v))
    return F.array_join(F.transform(packed, pair), ",")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two arrays of hashes, neither of them empty."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def _order() -> Column:
    """Sorts by descending doc_id, NULLs last, then by the row."""
    return F.struct(F.col("doc_id").isNull().alias("n"), F.coalesce(F.bitwise_not("doc_id"), F.lit(0).cast("long")).alias("d"), F.col("row_key").alias("r"), F.col("id_key").alias("i"))


def _keyed(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return with_row_keys(documents, F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def parts(rows: DataFrame) -> tuple[list[tuple], int]:
    """The first place of each part of the order, and how often the commonest row
    is there. Equal rows count once; parts are a multiple of the shuffle setting."""
    n = PARTS * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    once = rows.groupBy("id_key", "row_key").agg(F.max("doc_id").alias("doc_id"), F.count("*").alias("copies")).withColumn("o", _order())
    ranged = once.repartitionByRange(n, "o").groupBy(F.spark_partition_id().alias("part")).agg(F.min("o").alias("o"), F.max("copies").alias("copies"))
    found = ranged.collect()
    return sorted(tuple(r["o"]) for r in found), max((r["copies"] for r in found), default=0)


def _part(bounds: list[tuple]) -> Column:
    """Number of the part that a row belongs to: how many of ``bounds`` are at or
    before it, less one; first among every 64th of them, then between two of those."""
    array = lambda rows: F.from_json(F.lit(json.dumps([dict(zip("ndri", b, strict=True)) for b in rows])), "array<struct<n:boolean,d:bigint,r:bigint,i:bigint>>")
    up_to = lambda rows, at: F.size(F.filter(rows, lambda b: b <= at))
    coarse = lambda at: (up_to(array(bounds[::64]), at) - 1) * 64
    return _let(_order(), lambda at: _let(coarse(at), lambda c: c + up_to(F.slice(array(bounds), F.greatest(c, F.lit(0)) + 1, 64), at) - 1))


def compared(documents: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_chars, edited`` (the text), ``chosen,
    edited_chosen`` (packed pairs), ``near_edited, near_next``."""
    keys, spark = ["id_key", "row_key"], documents.sparkSession
    docs = _keyed(documents)
    bounds, most = parts(docs)
    rows = docs.withColumn("copies", F.lit(1).cast("long"))
    if most > COPIES:  # such rows come as one with a count
        hot = docs.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > COPIES)
        hot = stored(hot, "winnow-hot")
        once = docs.join(hot, keys).groupBy(*keys).agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.count("*").alias("copies"))
        rows = rows.join(hot, keys, "left_anti").unionByName(once)
    rows = rows.withColumn("part", _part(bounds)).withColumn("ghost", F.lit(False))
    # The first row of the next part stands at the end of each part as well.
    heads = spark.createDataFrame([((i - 1) % len(bounds), b[3], b[2]) for i, b in enumerate(bounds)], "part int, id_key long, row_key long")
    ghosts = docs.join(F.broadcast(heads), keys).dropDuplicates(keys).withColumn("copies", F.lit(1).cast("long")).withColumn("ghost", F.lit(True))
    rows = rows.unionByName(ghosts).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "part").withColumn("chosen", fingerprint(F.col("text")))
    along = Window.partitionBy("part").orderBy("ghost", _order())
    following = F.lead(F.struct("text", "chosen")).over(along)
    rows = rows.withColumn("next", following).where(~F.col("ghost")).withColumn("times", F.lit(1).cast("long"))
    if most > COPIES:
        own = F.struct(F.struct("text", "chosen").alias("next"), (F.col("copies") - 1).alias("times"))
        rows = rows.withColumn("v", F.explode(F.when(F.col("copies") > 1, F.array(own, F.struct("next", "times"))).otherwise(F.array(F.struct("next", "times")))))
        rows = rows.withColumns({"next": F.col("v.next"), "times": F.col("v.times")}).drop("v")
    n = F.length("text")
    kept = n - F.floor(n / 2).cast("int")
    rows = rows.withColumn("kept", kept).withColumn("edited", F.concat(F.substr("text", F.lit(1), kept), F.substr("next.text", F.lit(1), n - kept)))
    # Windows that lie in the kept half, or in the half that comes from the next
    # text, choose what they chose there. Those across the cut, and the last ones
    # before each end, are chosen from again.
    reach = K + WINDOW - 1
    rows = rows.withColumn("moved", F.length("edited") - F.col("kept"))
    end = F.greatest(F.col("kept") + F.col("moved") - reach, F.lit(0))
    same, same_next = F.col("kept") - reach, F.col("moved") - reach
    across = fingerprint(F.col("edited"), F.greatest(same - (WINDOW - 1), F.lit(0)), F.least(F.col("kept"), end))
    own = F.filter("chosen", lambda v: place(v) <= same)
    theirs = F.transform(F.filter("next.chosen", lambda v: place(v) <= same_next), lambda v: v - F.col("kept").cast("long"))
    tail = fingerprint(F.col("edited"), F.greatest(F.col("kept"), end - (WINDOW - 1)), end)
    rows = rows.withColumn("edited_chosen", F.array_distinct(F.when(same_next < 0, F.concat(own, across)).otherwise(F.concat(own, across, theirs, tail))))
    rows = rows.withColumn("own", hashes(F.col("chosen")))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "edited", "chosen", "edited_chosen", likeness(F.col("own"), hashes(F.col("edited_chosen"))).alias("near_edited"), likeness(F.col("own"), hashes(F.col("next.chosen"))).alias("near_next"), "times")
    if most <= COPIES:
        return rows.drop("times")
    few = rows.where(F.col("times") == 1).drop("times")
    dealt = rows.where(F.col("times") > 1).withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1, F.lit(COPIES))))
    dealt = dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "_c", "doc_id")
    dealt = dealt.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(COPIES), F.col("times") - F.col("_c")))))
    return few.unionByName(dealt.drop("times", "_c", "_i"))


def op11_winnowing_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), shown(F.col("chosen")).alias("fingerprint"), shown(F.col("edited_chosen")).alias("edited_fingerprint"), "near_edited", "near_next",
    )


_GRAM = " + ".join(f"coalesce(lead(c, {j}) OVER w, 0) * {pow(BASE, K - 1 - j, MODULUS)}" for j in range(K))
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id DESC NULLS LAST, text) AS r FROM documents),
e AS (SELECT r, doc_id, t, length(t) AS n, length(t) // 2 AS h,
        coalesce(lead(r) OVER (ORDER BY r), 1) AS nr, coalesce(lead(t) OVER (ORDER BY r), first_value(t) OVER (ORDER BY r)) AS nt FROM d),
x AS (SELECT r, 0 AS edited, t FROM e UNION ALL SELECT r, 1, substr(t, 1, n - h) || substr(nt, 1, h) FROM e),
l AS (SELECT r, edited, t, greatest(length(t), {K}) AS n FROM x),
c AS (SELECT r, edited, unnest(range(n)) AS i, n, unnest(list_resize(list_transform(regexp_extract_all(t, '(?s).'), lambda s: CAST(unicode(s) AS BIGINT)), n, 0)) AS c FROM l),
g AS (SELECT r, edited, i, n - {K} + 1 AS m, ({_GRAM}) % {MODULUS} AS h FROM c WINDOW w AS (PARTITION BY r, edited ORDER BY i)),
k AS (SELECT r, edited, i, m, min(h * {_LOW + 1} + ({_LOW} - i)) OVER (PARTITION BY r, edited ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS v
      FROM g WHERE i < m),
s AS (SELECT DISTINCT r, edited, v >> 32 AS h, {_LOW} - (v & {_LOW}) AS p FROM k WHERE i <= greatest(m - {WINDOW}, 0)),
f AS (SELECT r, edited, string_agg(h || ':' || p, ',' ORDER BY p) AS f, count(DISTINCT h) AS n FROM s GROUP BY r, edited),
u AS (SELECT DISTINCT r, edited, h FROM s),
b AS (SELECT a.r, count(*) AS n FROM u a JOIN u o ON o.r = a.r AND a.edited = 0 AND o.edited = 1 AND a.h = o.h GROUP BY a.r),
y AS (SELECT e.r, count(*) AS n FROM e JOIN u a ON a.r = e.r AND a.edited = 0 JOIN u o ON o.r = e.nr AND o.edited = 0 AND a.h = o.h GROUP BY e.r)
SELECT e.doc_id, CAST(e.n AS BIGINT) AS n_chars, sha256(substr(t, 1, e.n - h) || substr(nt, 1, h)) AS edited_sha256, f0.f AS fingerprint, f1.f AS edited_fingerprint,
  CAST(coalesce(b.n, 0) AS DOUBLE) / (f0.n + f1.n - coalesce(b.n, 0)) AS near_edited, CAST(coalesce(y.n, 0) AS DOUBLE) / (f0.n + f2.n - coalesce(y.n, 0)) AS near_next
FROM e JOIN f f0 ON f0.r = e.r AND f0.edited = 0 JOIN f f1 ON f1.r = e.r AND f1.edited = 1 JOIN f f2 ON f2.r = e.nr AND f2.edited = 0
LEFT JOIN b ON b.r = e.r LEFT JOIN y ON y.r = e.r
"""
