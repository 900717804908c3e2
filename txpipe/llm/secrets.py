"""Secret scan with multipart credential linking, in DataFrame functions only.

Strong kinds are reported wherever they match: ``assign``, ``access``, ``hex``.
Weak kinds -- ``id`` (a named account or key id), ``key`` (a bare opaque
token), ``endpoint`` (a URL or an IPv4 address) -- look like parts of a
credential and are reported only if complementary parts co-occur in scope:
an ``id`` needs a secret part, a ``key`` an identifier or an endpoint, an
``endpoint`` both an identifier and a secret part. Two parts are in one scope
if at most ``SCOPE`` code points lie between them. Weak matches that overlap a
strong one say nothing new and are left out.

The scope join is an interval join for existence: in a document's parts by
position, running maxima of ends and minima of starts by role give the nearest
complementary part on either side, so no pairs are made.

Offsets are code points. They come from ``split`` (the text between matches)
next to ``regexp_extract_all`` (the matches), as running sums of lengths.

Edge cases: NULL and empty texts have no spans; repeated rows are scanned each
by itself (rows are keyed by position, not by doc_id); a NULL doc_id is kept;
an empty table gives no rows; extra columns are ignored.

Scale: texts stay where they are read; only match rows (and one row a
document) are shuffled, once, by row. A document's matches are bounded by its
text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txpipe.llm.common import table

SCOPE = 300


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The base patterns, with either case of the names spelled out.
_NAMES = "|".join(map(_either, ("password", "passwd", "secret", "token"))) + "|" + _either("api") + "_?" + _either("key")
ASSIGN = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
# The method's own weak parts.
_ID_NAMES = f"{_either('access')}_?{_either('key')}_?{_either('id')}|{_either('client')}_?{_either('id')}|{_either('user')}_?{_either('name')}|{_either('login')}|{_either('account')}"
WEAK_ID = rf"""({_ID_NAMES})["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]+"""
WEAK_KEY = "[A-Za-z0-9+/_=-]{20,}"
ENDPOINT = r"""[a-z][a-z0-9+]*://[A-Za-z0-9._~:/?#@!$&()*+;=%-]+|[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(:[0-9]+)?"""

#: kind, pattern, group whose length counts, least length, roles, weak; in report order.
KINDS: list[tuple[str, str, int, int, str, bool]] = [
    ("assign", ASSIGN, 2, 8, "secret", False),
    ("access", ACCESS, 0, 16, "id", False),
    ("hex", HEX, 0, 32, "secret", False),
    ("id", WEAK_ID, 0, 1, "id", True),
    ("key", WEAK_KEY, 0, 20, "secret", True),
    ("endpoint", ENDPOINT, 0, 7, "endpoint", True),
]
#: Cheap patterns that a text with a valid match must hold.
_HINTS = {"hex": "[0-9a-f]{32}", "access": "AKIA[A-Z0-9]{12}"}


def _matches(k: int, text: Column) -> Column:
    """Array of (kind, i, before, n, valid): code points since the match before
    and in the match; empty if there is none."""
    kind, pattern, group, least, _, _ = KINDS[k]
    lit = F.lit(pattern)
    whole = F.regexp_extract_all(text, lit, F.lit(0))
    counted = F.regexp_extract_all(text, lit, F.lit(group)) if group else whole
    if kind == "key":  # opaque: letters of both cases or digits among letters
        good = F.transform(whole, lambda m: m.rlike("[0-9]") & m.rlike("[A-Za-z]"))
    else:
        good = F.transform(counted, lambda m: F.length(m) >= least)
    kind_t = "array<struct<k:int,i:int,before:int,n:int,valid:boolean>>"
    rows = F.zip_with(
        F.zip_with(F.split(text, pattern, -1), whole, lambda s, m: F.struct(s.alias("s"), m.alias("m"))), good,
        lambda r, g: F.struct(F.lit(k).alias("k"), F.lit(0).alias("i"), F.length(r["s"]).alias("before"), F.length(r["m"]).alias("n"), g.alias("valid")),
    )
    rows = F.filter(F.transform(rows, lambda r, i: F.struct(r["k"].alias("k"), i.alias("i"), r["before"].alias("before"), r["n"].alias("n"), r["valid"].alias("valid"))), lambda r: r["n"].isNotNull())
    return F.when(text.rlike(_HINTS.get(kind, pattern)), rows.cast(kind_t)).otherwise(F.array().cast(kind_t))


def parts(documents: DataFrame, carry: list[str]) -> DataFrame:
    """One row per document (``k`` NULL, with the columns of ``carry``) and one
    per match, with ``row_key, k, i, start, stop, valid``."""
    text = F.col("body")
    found = F.concat(F.array(F.lit(None).cast("struct<k:int,i:int,before:int,n:int,valid:boolean>")), *[_matches(k, text) for k in range(len(KINDS))])
    docs = documents.select(F.monotonically_increasing_id().alias("row_key"), F.struct(*carry).alias("carry"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"))
    rows = docs.select("row_key", "carry", F.explode(found).alias("m")).select("row_key", F.when(F.col("m").isNull(), F.col("carry")).alias("carry"), "m.*").repartition("row_key")
    so_far = Window.partitionBy("row_key", "k").orderBy("i")
    stop = F.sum(F.col("before") + F.col("n")).over(so_far)
    return rows.withColumn("stop", stop).withColumn("start", F.col("stop") - F.col("n"))


def _is(role: str) -> Column:
    return F.col("k").isin([k for k, kind in enumerate(KINDS) if kind[4] == role])


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The parts that count: valid strong ones, and weak ones whose
    complementary parts are in scope; the document rows stay."""
    strong = F.col("k").isin([k for k, kind in enumerate(KINDS) if not kind[5]])
    found = found.where(F.col("k").isNull() | F.col("valid"))
    place = Window.partitionBy("row_key").orderBy("start", "k")
    before, after = place.rowsBetween(Window.unboundedPreceding, -1), place.rowsBetween(1, Window.unboundedFollowing)
    # A strong part that begins at the same place has a smaller k, so it stands before.
    overlaps = F.coalesce(F.max(F.when(strong, F.col("stop"))).over(before) > F.col("start"), F.lit(False)) | F.coalesce(F.min(F.when(strong, F.col("start"))).over(after) < F.col("stop"), F.lit(False))
    found = found.where(F.col("k").isNull() | strong | F.col("valid")).withColumn("covered", F.col("k").isNotNull() & ~strong & overlaps).where(~F.col("covered")).drop("covered")
    near = lambda role: F.coalesce(F.max(F.when(_is(role), F.col("stop"))).over(before) + scope >= F.col("start"), F.lit(False)) | F.coalesce(F.min(F.when(_is(role), F.col("start"))).over(after) - scope <= F.col("stop"), F.lit(False))
    number = {kind[0]: k for k, kind in enumerate(KINDS)}
    near_id, near_secret, near_endpoint = near("id"), near("secret"), near("endpoint")
    found = found.withColumns({"near_id": near_id, "near_secret": near_secret, "near_endpoint": near_endpoint})
    k = F.col("k")
    holds = (
        k.isNull() | strong | ((k == number["id"]) & F.col("near_secret")) | ((k == number["key"]) & (F.col("near_id") | F.col("near_endpoint")))
        | ((k == number["endpoint"]) & F.col("near_id") & F.col("near_secret"))
    )
    return found.where(holds)


def scan(documents: DataFrame, carry: list[str], scope: int = SCOPE) -> DataFrame:
    """One row per document: ``carry``, a struct of columns that come along,
    and ``parts``, an array of (start, k, stop) by position."""
    kept = linked(parts(documents, carry), scope)
    spans = F.array_sort(F.collect_list(F.when(F.col("k").isNotNull(), F.struct("start", "k", "stop"))))
    return kept.groupBy("row_key").agg(F.first("carry", ignorenulls=True).alias("carry"), spans.alias("parts")).drop("row_key")


def _name(k: Column) -> Column:
    return F.element_at(F.array(*[F.lit(kind[0]) for kind in KINDS]), k + 1)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda p: F.concat_ws(":", _name(p["k"]), p["start"], p["stop"])), ",")


def digest(found: DataFrame) -> DataFrame:
    of = lambda k: F.size(F.filter("parts", lambda p: p["k"] == k)).cast("long")
    return found.select(
        F.col("carry.doc_id").cast("long").alias("doc_id"), *[of(k).alias(f"n_{KINDS[k][0]}") for k in range(3)],
        F.sha2(_joined(F.filter("parts", lambda p: p["k"] < 3)).cast("binary"), 256).alias("base_sha256"), _joined(F.col("parts")).alias("spans"),
    )


def redact(documents: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The documents with every span's text replaced by its kind in brackets;
    ``n_chars`` follows. Documents without spans stay as they are."""
    found = scan(documents, documents.columns, scope)
    text = F.coalesce(F.col("carry.text").cast("string"), F.lit(""))
    n = F.size("parts")
    reach = lambda i: F.coalesce(F.array_max(F.transform(F.slice("parts", 1, i), lambda p: p["stop"])), F.lit(0).cast("bigint"))
    name = lambda p, i: F.when(p["start"] >= reach(i), F.concat(F.lit("["), _name(p["k"]), F.lit("]"))).otherwise(F.lit(""))
    piece = lambda p, i: F.concat(text.substr((reach(i) + 1).cast("int"), F.greatest(p["start"] - reach(i), F.lit(0)).cast("int")), name(p, i))
    tail = text.substr((reach(n) + 1).cast("int"), F.length(text))
    new = {"text": F.concat(F.array_join(F.transform("parts", piece), ""), tail)}
    if "n_chars" in documents.columns:
        new["n_chars"] = F.length(new["text"]).cast(documents.schema["n_chars"].dataType)
    kept = lambda c: F.col(f"carry.`{c}`")
    return found.select(*[(F.when(n == 0, kept(c)).otherwise(new[c]) if c in new else kept(c)).alias(c) for c in documents.columns])


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan(table(spark, sf_dir, "documents"), ["doc_id"]))


def _oracle() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    ctes = []
    for k, (kind, pattern, group, least, role, weak) in enumerate(KINDS):
        good = "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]')" if kind == "key" else f"length(g) >= {least}"
        ctes.append(f"""SELECT r, {k} AS k, '{role}' AS role, {weak} AS weak, i, length(s) AS b, length(m) AS n, {good} AS valid FROM (
  SELECT r, unnest(string_split_regex(t, {quote(pattern)})[1:len(a)]) AS s, unnest(a) AS m, unnest(g) AS g, unnest(range(len(a))) AS i
  FROM (SELECT r, t, regexp_extract_all(t, {quote(pattern)}) AS a, regexp_extract_all(t, {quote(pattern)}, {group}) AS g FROM d) WHERE len(a) > 0)""")
    names = "CASE k " + " ".join(f"WHEN {k} THEN '{kind[0]}'" for k, kind in enumerate(KINDS)) + " END"
    near = lambda role: f"EXISTS (SELECT 1 FROM w o WHERE o.r = x.r AND o.role = '{role}' AND o.start - {SCOPE} <= x.stop AND o.stop + {SCOPE} >= x.start)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
raw AS ({" UNION ALL ".join(ctes)}),
placed AS (SELECT *, sum(b + n) OVER (PARTITION BY r, k ORDER BY i) AS stop, sum(b + n) OVER (PARTITION BY r, k ORDER BY i) - n AS start FROM raw),
v AS (SELECT r, k, role, weak, CAST(start AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM placed WHERE valid),
w AS (SELECT * FROM v x WHERE NOT weak OR NOT EXISTS (SELECT 1 FROM v o WHERE o.r = x.r AND NOT o.weak AND o.start < x.stop AND o.stop > x.start)),
h AS (SELECT * FROM w x WHERE NOT weak OR (k = 3 AND {near("secret")}) OR (k = 4 AND ({near("id")} OR {near("endpoint")}))
      OR (k = 5 AND {near("id")} AND {near("secret")})),
s AS (SELECT r, count(*) FILTER (k = 0) AS a, count(*) FILTER (k = 1) AS c, count(*) FILTER (k = 2) AS x,
        string_agg({names} || ':' || start || ':' || stop, ',' ORDER BY start, k) FILTER (k < 3) AS base,
        string_agg({names} || ':' || start || ':' || stop, ',' ORDER BY start, k) AS spans FROM h GROUP BY r)
SELECT doc_id, CAST(coalesce(a, 0) AS BIGINT) AS n_assign, CAST(coalesce(c, 0) AS BIGINT) AS n_access, CAST(coalesce(x, 0) AS BIGINT) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN s USING (r)
"""


ORACLE_SQL = _oracle()
