"""Secret scan by multipart credential linking (DataFrame functions only).

Strong patterns (assign, access, hex) are reported as they stand. Weak parts (client and user identifiers,
opaque tokens, endpoints) look like much harmless text, so each is reported only where the parts that complete
a credential lie in its scope, ``SCOPE`` code points to either side: an identifier needs a secret, an opaque
token needs an identifier, two weak ones need an endpoint as well, and an endpoint is reported where an
identifier and a secret are. The interval join is a range-framed window over the parts of one text, sorted by
place: linear in the number of parts, with no pairs made. Texts are read once and never shuffled.

Defined results: null text counts as empty and gives zero counts and empty strings; rows that repeat a doc_id
are scanned each by itself; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

SCOPE = 400
#: Fixed patterns, by kind in their order. assign keeps matches whose value has MIN_VALUE characters; the other
#: two say their least lengths, 24 and 20, as repeats (a run of the class has one match either way).
ASSIGN = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
MIN_VALUE = 6
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "ident", "opaque", "endpoint")
IDENT = "(?:[Cc]lient|[Aa]ccount|[Uu]ser|[Kk]ey)[_-]?(?:[Ii]d|ID|[Nn]ame)[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9_.@-]{4,}"
OPAQUE = "[A-Za-z0-9+/_-]{20,}"
ENDPOINT = "[a-z][a-z0-9+]{1,12}://[^\\x20\\x09-\\x0D\"'<>]+"


def places(text: Column, pattern: str, kind: str, value_least: int = 0) -> Column:
    """Array of (kind, start, end) of a pattern's matches, in code points: what lies between them gives where they are."""
    rx = F.lit(pattern)
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, rx, F.lit(0)).alias("hit"), (F.regexp_extract_all(text, rx, F.lit(2)) if value_least else F.array().cast("array<string>")).alias("value"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:int>>").alias("out"))

    def step(acc, x):
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.coalesce(F.length(x["hit"]), F.lit(0))
        return F.struct(end.alias("at"), F.when(x["hit"].isNotNull(), F.array_append(acc["out"], F.struct(begin.alias("start"), end.alias("end"), F.coalesce(F.length(x["value"]), F.lit(0)).alias("value")))).otherwise(acc["out"]).alias("out"))

    found = F.aggregate(pairs, start, step, lambda acc: acc["out"])
    found = F.filter(found, lambda x: x["value"] >= value_least) if value_least else found
    named = F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), x["end"].alias("end")))
    return F.when(F.regexp_like(text, rx), named).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>"))


def joined(parts: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(parts), lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def secret_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked."""
    t = F.coalesce(F.col(text), F.lit(""))
    opaque = lambda hit: F.regexp_like(hit, F.lit("[0-9]")) & F.regexp_like(hit, F.lit("[A-Z]")) & F.regexp_like(hit, F.lit("[a-z]"))
    read = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(doc_id).alias("doc_id"), t.alias("t")).select(
        "rid", "doc_id", places(F.col("t"), ASSIGN, "assign", MIN_VALUE).alias("assign"), places(F.col("t"), ACCESS, "access").alias("access"), places(F.col("t"), HEX, "hex").alias("hex"),
        places(F.col("t"), IDENT, "ident").alias("ident"),
        F.filter(F.transform(places(F.col("t"), OPAQUE, "opaque"), lambda x: F.struct(x.alias("x"), F.substring(F.col("t"), x["start"] + 1, x["end"] - x["start"]).alias("hit"))), lambda x: opaque(x["hit"])).alias("opaque"),
        places(F.col("t"), ENDPOINT, "endpoint").alias("endpoint"),
    )
    base = F.concat("assign", "access", "hex")
    apart = lambda x: ~F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
    weak = F.concat(*(F.filter(c, apart) for c in (F.col("ident"), F.transform("opaque", lambda x: x["x"]), F.col("endpoint"))))
    rows = read.select("rid", "doc_id", *(F.size(c).cast("bigint").alias(f"n_{c}") for c in KINDS[:3]), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), base.alias("base"), weak.alias("weak"))
    return linked(rows, scope)


def linked(rows: DataFrame, scope: int) -> DataFrame:
    """Keep of each text's weak parts those that complete a credential; base parts stay."""
    kept = ["rid", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]
    parts = rows.select(*kept, F.explode_outer(F.when(F.size("weak") > 0, F.concat("base", "weak")).otherwise(F.col("base"))).alias("part"))
    near = W.partitionBy("rid").orderBy(F.col("part.start")).rangeBetween(-scope, scope)
    kind = F.col("part.kind")
    has = lambda *names: F.max(kind.isin([KINDS.index(n) for n in names])).over(near)
    strong_id, strong_secret, ident, token, endpoint = has("access"), has("assign", "hex"), has("ident"), has("opaque"), has("endpoint")
    rules = {
        "ident": strong_secret | (token & endpoint),
        "opaque": strong_id | (ident & endpoint),
        "endpoint": (strong_id | ident) & (strong_secret | token),
    }
    keep = reduce(lambda a, b: a | b, [(kind == KINDS.index(k)) & v for k, v in rules.items()], kind < 3)
    parts = parts.withColumn("keep", keep)
    reported = F.collect_list(F.when(F.col("keep"), F.col("part")))
    return parts.groupBy(*kept).agg(joined(reported).alias("spans"), F.count_if(F.col("keep") & (kind >= 3)).alias("n_linked")).drop("rid")


def oracle(scope: int = SCOPE) -> str:
    """The same in DuckDB SQL."""
    quote = lambda x: "'" + x.replace("'", "''").replace("\\\\", "\\") + "'"
    patterns = ", ".join(f"({k}, '{kind}', {quote(rx)})" for k, (kind, rx) in enumerate(zip(KINDS, (ASSIGN, ACCESS, HEX, IDENT, OPAQUE, ENDPOINT))))
    return f"""
WITH p(k, kind, rx) AS (VALUES {patterns}),
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
hit AS (SELECT doc_id, k, kind, string_split_regex(t, rx) AS gaps, regexp_extract_all(t, rx) AS hits, CASE WHEN k = 0 THEN regexp_extract_all(t, {quote(ASSIGN)}, 2) END AS vals FROM d, p),
nth AS (SELECT *, unnest(generate_series(1, len(hits))) AS i FROM hit WHERE len(hits) > 0),
part AS (SELECT doc_id, k, kind, hits[i] AS h, vals[i] AS v,
  list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS s FROM nth),
placed AS (SELECT doc_id, k, kind, s::BIGINT AS s, (s + length(h))::BIGINT AS e FROM part
  WHERE CASE k WHEN 0 THEN length(v) >= {MIN_VALUE} WHEN 4 THEN regexp_matches(h, '[0-9]') AND regexp_matches(h, '[A-Z]') AND regexp_matches(h, '[a-z]') ELSE true END),
apart AS (SELECT * FROM placed a WHERE k < 3 OR NOT EXISTS (SELECT 1 FROM placed b WHERE b.doc_id = a.doc_id AND b.k < 3 AND b.s < a.e AND a.s < b.e)),
near AS (SELECT *, coalesce(bool_or(k = 1) OVER w, false) AS strong_id, coalesce(bool_or(k IN (0, 2)) OVER w, false) AS strong_secret,
  bool_or(k = 3) OVER w AS ident, bool_or(k = 4) OVER w AS token, bool_or(k = 5) OVER w AS endpoint
  FROM apart WINDOW w AS (PARTITION BY doc_id ORDER BY s RANGE BETWEEN {scope} PRECEDING AND {scope} FOLLOWING)),
kept AS (SELECT * FROM near WHERE CASE k WHEN 3 THEN strong_secret OR (token AND endpoint) WHEN 4 THEN strong_id OR (ident AND endpoint)
  WHEN 5 THEN (strong_id OR ident) AND (strong_secret OR token) ELSE true END),
said AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex, count(*) FILTER (k > 2) AS n_linked,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < 3) AS base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans FROM kept GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, coalesce(n_linked, 0) AS n_linked,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN said USING (doc_id)
"""
