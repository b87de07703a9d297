"""Secret scans in DataFrame functions only: fixed patterns, and character Markov models.

Two first-order Markov models over characters, one of random strings and one of ordinary identifiers,
are counted from labelled samples. A run of 16 or more characters is a secret if the logarithm of its
likelihood ratio is large, in all and for each character; more is asked of runs without a digit. The
counts of character pairs come to the driver summed (at most 2 x 128 x 128 rows); the ratios go back into
the plan as one constant array, so scanning is a projection without a shuffle. Its time is in proportion
to the text, and to the root of the number of matches in one text besides.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.llm.scratch import columns_of

#: Kinds in order of their names in a span list, pattern, group whose length counts, its least length.
BASE = (
    ("assign", r"""((?i)password|passwd|secret|token|api_?key(?-i))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"(AKIA[A-Z0-9]+)", 1, 20),
    ("hex", r"([0-9a-f]{24,})", 1, 24),
)
#: Tokens that the models judge: whole runs of these characters, 16 or more.
CANDIDATE = r"([A-Za-z0-9+/_-]{16,})"
#: Words that stand for ordinary identifiers when the models are trained from a corpus.
ORDINARY = r"(?<![^\x20\x09-\x0D])([A-Za-z_]{6,})(?![^\x20\x09-\x0D.,])"
#: Documents whose tokens train the models at most.
FIT_ROWS = 20_000
#: Added to the count of a character, and weight of its share among the pairs that begin with another one.
SMOOTHING, BACKOFF = 0.5, 8.0
#: What the log-likelihood ratio of a token must be in all, and for each character: with a digit, and without one.
LEAST_RATIO, LEAST_RATIO_PER_CHAR, LEAST_RATIO_PER_LETTER = 12.0, 0.75, 1.0
MASK = "[SECRET]"
#: Characters of a text that redaction holds against the spans at a time.
CHUNK = 4096
_SPANS = "array<struct<start:int,ord:int,end:int,kind:string,token:string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, also where body uses it inside of a lambda."""
    return F.transform(F.array(value), body)[0]


def _running(steps: Column) -> Column:
    """Sums of the first one, two, ... of an array of ints, in blocks of about the root of its size."""
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(steps))).cast("int"))
    ints = F.array().cast("array<int>")
    more = lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"] + x)).alias("out"))
    sums = lambda values: F.aggregate(values, F.struct(F.lit(0).alias("at"), ints.alias("out")), more)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / width).cast("int")), lambda b: sums(F.slice(steps, b * width + 1, width)))
    joined = lambda inner: F.flatten(F.zip_with(inner, sums(F.transform(inner, lambda b: b["at"]))["out"], lambda b, total: F.transform(b["out"], lambda x: x + total - b["at"])))
    return F.when(F.size(steps) > 0, _let(blocks, joined)).otherwise(ints)


def found(text: Column, pattern: str, group: int, least: int, kind: str, order: int) -> Column:
    """All leftmost non-overlapping matches: array of (start, order, end, kind, token), in code points."""
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("token"))
    sized = F.transform(F.filter(parts, lambda p: p["hit"].isNotNull()), lambda p: F.struct(F.length(p["gap"]).alias("gap"), F.length(p["hit"]).alias("hit"), p["token"].alias("token")))

    def spans(p: Column) -> Column:
        ends = _running(F.transform(p, lambda x: x["gap"] + x["hit"]))
        every = F.zip_with(p, ends, lambda x, end: F.struct((end - x["hit"]).alias("start"), F.lit(order).alias("ord"), end.alias("end"), F.lit(kind).alias("kind"), x["token"].alias("token")))
        return F.filter(every, lambda x: F.length(x["token"]) >= least)

    return F.when(text.rlike(pattern), _let(sized, spans)).otherwise(F.array().cast(_SPANS))


def base_spans(text: Column) -> Column:
    """Matches of the fixed patterns, by start and then by kind as listed."""
    return F.array_sort(F.concat(*[found(text, pattern, group, least, kind, k) for k, (kind, pattern, group, least) in enumerate(BASE)]))


def corpus_samples(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Labelled tokens (token, secret) from at most fit_rows documents, those with the least hashes of doc_id.

    Values that a fixed pattern matches are secrets; words of letters alone, outside of them, are ordinary.
    """
    ids = docs.where("doc_id is not null and text is not null").select("doc_id").distinct().orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(fit_rows)
    rows = docs.where("text is not null").join(F.broadcast(ids), "doc_id").select("text")
    secret = rows.select(F.explode(F.transform(base_spans(F.col("text")), lambda s: s["token"])).alias("token"), F.lit(True).alias("secret"))
    plain = rows.select(F.explode(F.regexp_extract_all("text", F.lit(ORDINARY), F.lit(1))).alias("token"), F.lit(False).alias("secret"))
    return secret.unionByName(plain)


def fit(samples: DataFrame) -> list[float] | None:
    """Log-likelihood ratios of all pairs of ASCII characters, the first one times 128 plus the second.

    samples: token, secret. Null tokens, tokens of one character and null labels are left out. Without
    samples of both kinds there is no model.
    """
    known = samples.where("token is not null and secret is not null and length(token) > 1")
    rows = known.select("secret", F.explode(_cells(F.col("token"))).alias("cell")).where("cell >= 0").groupBy("secret", "cell").count().collect()
    counts = {True: [0.0] * (128 * 128), False: [0.0] * (128 * 128)}
    for r in rows:
        counts[r["secret"]][r["cell"]] = float(r["count"])
    if not any(counts[True]) or not any(counts[False]):
        return None
    width, logs = 66, {}
    for kind, n in counts.items():
        ends = [sum(n[b::128]) for b in range(128)]
        share = [(e + SMOOTHING) / (sum(ends) + SMOOTHING * width) for e in ends]
        starts = [sum(n[a * 128 : a * 128 + 128]) for a in range(128)]
        logs[kind] = [math.log((n[a * 128 + b] + BACKOFF * share[b]) / (starts[a] + BACKOFF)) for a in range(128) for b in range(128)]
    return [p - q for p, q in zip(logs[True], logs[False], strict=True)]


def _cells(token: Column) -> Column:
    """The numbers of the pairs of neighbours in a token, -1 for those with other characters than ASCII."""
    code = F.transform(F.split(token, ""), lambda c: F.ascii(c))
    pair = lambda a, b: F.when((a < 128) & (b < 128), a * 128 + b).otherwise(-1)
    return _let(code, lambda c: F.zip_with(F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0))), F.slice(c, 2, F.size(c)), pair))


def ratio(token: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of an ASCII token under the two models."""
    table = F.split(F.lit(",".join(f"{x:.6g}" for x in model)), ",").cast("array<double>")
    return F.aggregate(_cells(token), F.lit(0.0), lambda acc, cell: acc + F.element_at(table, cell + 1))


def model_spans(text: Column, base: Column, model: list[float] | None) -> Column:
    """Tokens that the models call random and that do not lie within one base span.

    A token in the value of an assign span lies within it; as a whole, it can also be a hex or an access span.
    """
    if model is None:
        return F.array().cast(_SPANS)
    seen = F.filter(found(text, CANDIDATE, 1, 16, "random", len(BASE)), lambda s: ~s["token"].rlike("^([0-9a-f]{24,}|AKIA[A-Z0-9]{16,})$"))
    per_char = lambda token: F.when(token.rlike("[0-9]"), LEAST_RATIO_PER_CHAR).otherwise(LEAST_RATIO_PER_LETTER)
    random = F.filter(seen, lambda s: ratio(s["token"], model) >= F.greatest(F.lit(LEAST_RATIO), F.length(s["token"]) * per_char(s["token"])))
    code = lambda s: F.shiftleft(s["start"].cast("long"), 32) + s["end"]
    value = lambda b: F.transform(found(b["token"], CANDIDATE, 1, 16, "", 0), lambda s: code(s) + (b["end"] - F.length(b["token"])).cast("long") * ((1 << 32) + 1))
    within = F.flatten(F.transform(F.filter(base, lambda b: b["kind"] == "assign"), value))
    span = lambda c: F.struct(F.shiftright(c, 32).cast("int").alias("start"), F.lit(len(BASE)).alias("ord"), (c % (1 << 32)).cast("int").alias("end"), F.lit("random").alias("kind"), F.lit(None).cast("string").alias("token"))
    return F.transform(F.array_except(F.transform(random, code), within), span)


def scan(docs: DataFrame, model: list[float] | None) -> DataFrame:
    """docs with base (array of start, ord, end, kind, token) and spans (base and model spans, likewise).

    Null text is empty and has no spans. Columns of docs of these names are replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    with_base = docs.withColumn("base", base_spans(text))
    return with_base.withColumn("spans", F.array_sort(F.concat("base", model_spans(text, F.col("base"), model))))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, model: list[float] | None) -> DataFrame:
    """Counts and digests of the spans of each row of docs; an empty table gives an empty one."""
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return scan(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model).select(
        "doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_random"),
    )


def redact(docs: DataFrame, model: list[float] | None) -> DataFrame:
    """All rows of docs with every span of text replaced by [SECRET], and n_chars to match where it was there.

    Rows without spans are unchanged, null texts too. Overlapping spans become one. Equal rows have equal
    results; columns of any names stay as they are. An empty table gives an empty one.
    """
    zero = lambda at: F.struct(at.alias("at"), F.array().cast("array<string>").alias("out"))

    def masked(chunk: Column, number: Column, spans: Column) -> Column:
        """A chunk of the text without what spans cover, with a mask where one begins."""
        first = number * CHUNK
        own = F.filter(spans, lambda s: (s["end"] > first) & (s["start"] < first + F.length(chunk)))
        step = lambda acc, s: F.when(
            s["start"] >= acc["at"], F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(F.substr(chunk, acc["at"] - first + 1, s["start"] - acc["at"]), F.lit(MASK))).alias("out"))
        ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))
        end = lambda acc: F.array_join(F.concat(acc["out"], F.array(F.substr(chunk, acc["at"] - first + 1))), "")
        return F.aggregate(own, zero(first), step, end)

    own = F.struct(*columns_of(docs))
    marked = scan(docs.select("text", own.alias("row")), model)
    whole = F.transform(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)), lambda chunk, k: masked(chunk, k, F.col("spans")))
    clean = marked.select("row", F.when(F.size("spans") > 0, F.array_join(whole, "")).alias("clean"))
    new = {c: F.col("row")[c] for c in docs.columns}
    new["text"] = F.coalesce("clean", new["text"])
    if "n_chars" in new:
        new["n_chars"] = F.when(F.col("clean").isNotNull(), F.length("clean").cast(docs.schema["n_chars"].dataType)).otherwise(new["n_chars"])
    return clean.select(*[c.alias(n) for n, c in new.items()])


_WORDS = ("password", "passwd", "secret", "token")
_ANY_CASE = "|".join(["".join(f"[{c}{c.upper()}]" for c in w) for w in _WORDS] + ["[aA][pP][iI]_?[kK][eE][yY]"])
_GAPS = """SELECT r, {order} AS ord, '{kind}' AS kind, unnest(hits) AS hit, unnest(gaps[1:len(hits)]) AS gap, unnest(tokens) AS token, unnest(range(len(hits))) AS k
  FROM (SELECT r, regexp_extract_all(text, '{pattern}') AS hits, regexp_extract_all(text, '{pattern}', {group}) AS tokens, string_split_regex(text, '{pattern}') AS gaps FROM doc)"""
_PATTERNS = (
    ("assign", f"({_ANY_CASE})[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 6), ("access", "(AKIA[A-Z0-9]+)", 1, 20), ("hex", "([0-9a-f]{24,})", 1, 24), ("random", "([A-Za-z0-9+/_-]{16,})", 1, 16),
)
#: Patterns and models in DuckDB, for tables of at most FIT_ROWS documents with distinct ids.
SQL = (
    "WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, text IS NOT NULL AND doc_id IS NOT NULL AS known FROM documents),\nparts AS ("
    + "\n  UNION ALL ".join(_GAPS.format(order=k, kind=kind, pattern=pattern, group=group) for k, (kind, pattern, group, _) in enumerate(_PATTERNS))
    + "),\n"
    + rf"""
placed AS (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY r, ord ORDER BY k) AS stop FROM parts),
every AS (SELECT r, ord, kind, token, CAST(stop - length(hit) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM placed
  WHERE length(token) >= CASE kind WHEN 'assign' THEN 6 WHEN 'access' THEN 20 WHEN 'hex' THEN 24 ELSE 16 END),
base AS (SELECT * FROM every WHERE ord < 3),
fitted AS (SELECT r FROM doc WHERE known AND r IN (SELECT r FROM doc WHERE known ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT {FIT_ROWS})),
sample AS (
  SELECT token, TRUE AS secret FROM base JOIN fitted USING (r)
  UNION ALL SELECT regexp_extract(word, '^([A-Za-z_]{{6,}})([.,]|$)', 1), FALSE
  FROM (SELECT unnest(regexp_extract_all(text, '[^ 	-
]+')) AS word FROM doc JOIN fitted USING (r)) WHERE regexp_matches(word, '^[A-Za-z_]{{6,}}([.,]|$)')),
cells AS (SELECT secret, ascii(token[i]) AS a, ascii(token[i + 1]) AS b, count(*) AS n
  FROM (SELECT secret, token, unnest(range(1, length(token))) AS i FROM sample WHERE length(token) > 1) GROUP BY ALL),
grid AS (SELECT secret, a, b FROM (VALUES (TRUE), (FALSE)) s(secret), range(128) x(a), range(128) y(b)),
logs AS (
  SELECT g.secret, g.a, g.b, ln((coalesce(n, 0) + {BACKOFF} * (coalesce(ends, 0) + {SMOOTHING}) / (total + {SMOOTHING} * 66)) / (coalesce(starts, 0) + {BACKOFF})) AS x
  FROM grid g LEFT JOIN cells c ON g.secret = c.secret AND g.a = c.a AND g.b = c.b
  LEFT JOIN (SELECT secret, b, sum(n) AS ends FROM cells GROUP BY ALL) e ON g.secret = e.secret AND g.b = e.b
  LEFT JOIN (SELECT secret, a, sum(n) AS starts FROM cells GROUP BY ALL) s ON g.secret = s.secret AND g.a = s.a
  JOIN (SELECT secret, sum(n) AS total FROM cells GROUP BY ALL) t ON g.secret = t.secret),
model AS (SELECT p.a, p.b, CAST(format('{{:.6g}}', p.x - q.x) AS DOUBLE) AS x FROM logs p JOIN logs q ON p.a = q.a AND p.b = q.b WHERE p.secret AND NOT q.secret),
judged AS (
  SELECT r, start, stop, any_value(token) AS token, sum(x) AS ratio
  FROM (SELECT *, unnest(range(1, length(token))) AS i FROM every WHERE ord = 3) e JOIN model m ON m.a = ascii(token[i]) AND m.b = ascii(token[i + 1]) GROUP BY r, start, stop),
random AS (
  SELECT r, 3 AS ord, 'random' AS kind, start, stop FROM judged j
  WHERE ratio >= greatest({LEAST_RATIO}, length(token) * CASE WHEN regexp_matches(token, '[0-9]') THEN {LEAST_RATIO_PER_CHAR} ELSE {LEAST_RATIO_PER_LETTER} END)
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.r = j.r AND b.start <= j.start AND j.stop <= b.stop)),
spans AS (SELECT r, ord, kind, start, stop FROM base UNION ALL SELECT * FROM random),
listed AS (
  SELECT r, count(*) FILTER (WHERE ord = 0) AS n_assign, count(*) FILTER (WHERE ord = 1) AS n_access, count(*) FILTER (WHERE ord = 2) AS n_hex, count(*) FILTER (WHERE ord = 3) AS n_random,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) FILTER (WHERE ord < 3) AS base, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) AS spans
  FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(listed.spans, '') AS spans, coalesce(n_random, 0) AS n_random
FROM doc LEFT JOIN listed USING (r)
"""
)
