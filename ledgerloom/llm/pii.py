"""Personal data: regular expressions propose spans, checksums confirm them, context words near by adjust the score.

DataFrame functions only. A kind's matches are marked by one regexp_replace with a private-use character (which no
pattern matches; where a text holds it, another stands in, of the same length), so that splitting at the mark gives
matches and the lengths between them, hence code point offsets. Loops in the patterns are possessive and matches can't
begin inside a run that already failed, so long runs cost linear time and no stack.

A proposal's score is BASE of its kind, plus CHECKED if its checksum holds, plus NEARBY if one of the kind's words stands
in the CONTEXT characters around it; spans of ACCEPT and more are kept. Email, ip, card and phone are kept whenever they
are valid: cards pass Luhn, parts of an ip are at most 255, phones have 8 to 15 digits. IBANs must pass mod-97. Social
security numbers, local telephone numbers and long hexadecimal secrets need a word near by.

Offsets are running sums, made in groups of GROUP and groups of those (a fold would copy its result in each step); context
and the pieces of a redacted text are cut from blocks of BLOCK characters. So a text of n matches costs about n steps.

Null and empty texts have no spans. Repeated rows are scanned alike. A column with the name of the result is replaced, all
others stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free, table

MARK, OTHER = "\ue000", "\ue001"
ACCEPT, CHECKED, NEARBY, CONTEXT = 0.5, 0.5, 0.4, 40
BLOCK, GROUP, LEVELS = 256, 16, 4  # characters of a block; elements of a group; groups of groups
#: Kind, pattern for Java, the same for RE2, base score, words near by.
KINDS = [
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 0.5, ""),
    ("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", 0.5, ""),
    ("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9]([\x20-]?[0-9])+", 0.0, "card|visa|credit|carte|karte|tarjeta"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", 0.5, ""),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b", r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b", 0.0, "iban|account|konto|compte|cuenta"),
    ("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", 0.2, "ssn|social security"),
    ("tel", r"\b[0-9]{3}[\x20.-][0-9]{3}[\x20.-][0-9]{4}\b", r"\b[0-9]{3}[\x20.-][0-9]{3}[\x20.-][0-9]{4}\b", 0.2, "phone|tel|call|fax|mobile|cell"),
    ("secret", r"\b[0-9a-f]{32,}+\b", r"\b[0-9a-f]{32,}\b", 0.2, "token|secret|key|password|passwd|pwd"),
]
BASE_KINDS = ("email", "ip", "card", "phone")
#: Cheap tests that a text without a match of the kind fails.
NEEDS = {"email": "@", "phone": "+"}
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _mod97(m: Column) -> Column:
    """Whether the IBAN's remainder is 1; letters count as two digits."""
    s = F.translate(m, " ", "")
    turned = F.concat(F.substr(s, F.lit(5)), F.substr(s, F.lit(1), F.lit(4)))
    step = lambda acc, c: F.when(c.between("0", "9"), (acc * 10 + c.try_cast("int")) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _valid(kind: Column, m: Column) -> Column:
    """Whether a match may stand at all."""
    d = _digits(m)
    return (
        F.when(kind == "ip", m.rlike(rf"^{PART}\.{PART}\.{PART}\.{PART}$")).when(kind == "card", F.length(d).between(16, 19) & F.call_function("luhn_check", d))
        .when(kind == "phone", F.length(d).between(8, 15)).when(kind == "iban", _mod97(m)).otherwise(F.lit(True))
    )


def _of_kind(kind: Column, values: dict[str, Column], other: Column) -> Column:
    out = None
    for k, v in values.items():
        out = (F.when if out is None else out.when)(kind == k, v)
    return out.otherwise(other)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of the value, which is computed once however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(a: Column, op: Callable[[Column, Column], Column], levels: int = LEVELS) -> Column:
    """For each element of an array of integers, op over those before it (0 for the first)."""
    over = lambda x, start, n: F.aggregate(F.slice(x, start, n), F.lit(0), op)
    if not levels:
        return F.transform(a, lambda _, i: over(a, F.lit(1), i))
    last = F.greatest(F.ceil(F.size(a) / GROUP).cast("int") - 1, F.lit(0))
    groups = F.transform(F.sequence(F.lit(0), last), lambda g: over(a, g * GROUP + 1, F.lit(GROUP)))
    within = lambda i: over(a, i - i % GROUP + 1, i % GROUP)
    full = lambda before: F.transform(a, lambda _, i: op(F.get(before, F.floor(i / GROUP).cast("int")), within(i)))
    return F.when(F.size(a) <= GROUP, F.transform(a, lambda _, i: within(i))).otherwise(let(let(groups, lambda g: running(g, op, levels - 1)), full))


def add(x: Column, y: Column) -> Column:
    return x + y


def most(x: Column, y: Column) -> Column:
    return F.greatest(x, y)


def blocks(text: Column) -> Column:
    """The text as an array of pieces of BLOCK characters."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def cut(pieces: Column, start: Column, end: Column) -> Column:
    """Characters start to end (exclusive) of the text that the blocks make up."""
    first = F.floor(F.greatest(start, F.lit(0)) / BLOCK).cast("int")
    some = F.array_join(F.slice(pieces, first + 1, F.floor(F.greatest(end, F.lit(0)) / BLOCK).cast("int") - first + 1), "")
    return F.substr(some, F.greatest(start, F.lit(0)) - first * BLOCK + 1, F.greatest(end - F.greatest(start, F.lit(0)), F.lit(0)))


def marked(text: Column, pattern: str) -> Column:
    """The text cut at the ends of the pattern's matches: every other piece, from the second on, is a match."""
    free_of_marks = F.when(text.contains(MARK), F.translate(text, MARK, OTHER)).otherwise(text)
    return F.split(F.regexp_replace(free_of_marks, pattern, f"{MARK}$0{MARK}"), MARK)


def placed(pieces: Column) -> Column:
    """array<struct<m, start, end>> of the matches among the pieces, leftmost first and not overlapping."""
    none = F.array().cast("array<struct<m string, start int, end int>>")
    of = lambda starts: F.transform(F.sequence(F.lit(1), F.size(pieces) - 1, F.lit(2)), lambda i: F.struct(F.get(pieces, i).alias("m"), F.get(starts, i).alias("start"), (F.get(starts, i) + F.length(F.get(pieces, i))).alias("end")))
    return F.when(F.size(pieces) > 1, let(let(F.transform(pieces, lambda x: F.length(x)), lambda n: running(n, add)), of)).otherwise(none)


SPAN = "struct<kind string, start int, end int, score double>"


def spans(text: Column) -> Column:
    """array<struct<kind, start, end, score>> by kind as listed, then start.

    Only the patterns are applied kind by kind; places, checks and scores are one expression over an array of all kinds.
    """
    t = F.coalesce(text, F.lit(""))
    needed = lambda kind: t.contains(NEEDS[kind]) if kind in NEEDS else t.rlike("[0-9]")
    every = F.array(*(F.struct(F.lit(k).alias("kind"), F.when(needed(k) & t.rlike(p), marked(t, p)).otherwise(F.array().cast("array<string>")).alias("pieces")) for k, p, *_ in KINDS))
    found = F.transform(F.filter(every, lambda e: F.size(e["pieces"]) > 1), lambda e: F.struct(e["kind"].alias("kind"), placed(e["pieces"]).alias("found")))
    bases = {k: F.lit(base) for k, _, _, base, _ in KINDS}

    def scored(kind: Column, p: Column, blocks_: Column) -> Column:
        start = F.greatest(p["start"] - CONTEXT, F.lit(0))
        asked = {k: words for k, _, _, _, words in KINDS if words}
        near = cut(blocks_, start, start + p["end"] - p["start"] + 2 * CONTEXT)
        told = F.when(kind.isin(*asked), let(near, lambda n: _of_kind(kind, {k: n.rlike(f"(?i){words}") for k, words in asked.items()}, F.lit(False)))).otherwise(F.lit(False))
        score = _of_kind(kind, bases, F.lit(0.0)) + F.when(kind.isin("card", "iban"), CHECKED).otherwise(0.0) + F.when(told, NEARBY).otherwise(0.0)
        return F.struct(kind.alias("kind"), p["start"].alias("start"), p["end"].alias("end"), F.when(_valid(kind, p["m"]), score).otherwise(F.lit(0.0)).alias("score"))

    accepted = lambda f, blocks_: F.flatten(F.transform(f, lambda e: F.filter(F.transform(e["found"], lambda p: scored(e["kind"], p, blocks_)), lambda s: s["score"] >= ACCEPT)))
    return let(found, lambda f: F.when(F.size(f) > 0, let(blocks(t), lambda b: accepted(f, b))).otherwise(F.array().cast(f"array<{SPAN}>")))


def _without_inner(every: Column) -> Column:
    """Spans without local telephone numbers inside a phone. A phone begins with +, which a local number never holds, so only phones that begin before it matter."""
    place = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score"), (s["kind"] == "tel").alias("tel"))
    both = F.array_sort(F.transform(F.filter(every, lambda s: s["kind"].isin("phone", "tel")), place))

    def outer(x: Column) -> Column:
        ends = F.transform(x, lambda s: F.when(s["tel"], 0).otherwise(s["end"]))
        kept = lambda before: F.filter(F.transform(x, lambda s, i: F.when(s["tel"] & (s["start"] >= F.get(before, i)), F.struct(F.lit("tel").alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score")))), lambda s: s.isNotNull())
        return let(let(ends, lambda e: running(e, most)), kept)

    kinds = [k for k, *_ in KINDS]
    before, after = kinds[: kinds.index("tel")], kinds[kinds.index("tel") + 1 :]
    return F.concat(F.filter(every, lambda s: s["kind"].isin(*before)), let(both, outer), F.filter(every, lambda s: s["kind"].isin(*after)))


def find(docs: DataFrame, text: str = "text", out: str = "pii_spans") -> DataFrame:
    """The documents with their spans in the column out. A local telephone number inside a phone span is that phone."""
    every = F.col(out)
    return docs.withColumn(out, spans(F.col(text))).withColumn(out, F.when(F.exists(every, lambda s: s["kind"] == "tel"), _without_inner(every)).otherwise(every))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with each span replaced by <KIND>; overlapping spans become one. Columns stay as they were."""
    out = free(docs, "spans")
    found, t = find(docs, text, out), F.col(text)
    ordered = F.array_sort(F.transform(F.col(out), lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("neg"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def text_of(pieces: Column) -> Column:
        tag = lambda s: F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        done = lambda x, at: F.transform(x, lambda s, i: F.when(s["end"] > F.get(at, i), F.concat(cut(pieces, F.get(at, i), s["start"]), tag(s))).otherwise(""))
        every = lambda x: let(let(F.transform(x, lambda s: s["end"]), lambda e: running(e, most)), lambda at: F.array_join(done(x, at), ""))
        return let(ordered, lambda x: F.concat(every(x), cut(pieces, F.array_max(F.transform(x, lambda s: s["end"])), F.length(t))))

    clean = F.when(F.size(out) > 0, let(blocks(t), text_of)).otherwise(t)
    return found.withColumn(text, clean).select(*(F.col(f"`{c}`") for c in docs.columns))


def _listed(s: Column) -> Column:
    return F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def query(spark, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    s = F.col("pii_spans")
    of = lambda kind: F.filter(s, lambda x: x["kind"] == kind)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    base = F.filter(s, lambda x: x["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(s).alias("spans"))


def _sql() -> str:
    kinds = ", ".join(f"({i}, '{k}', '{p}', {b}, '{w}')" for i, (k, _, p, b, w) in enumerate(KINDS))
    digits, bare = "regexp_replace(m, '[^0-9]', '', 'g')", "replace(m, ' ', '')"
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
kinds(k, kind, pattern, base, words) AS (VALUES {kinds}),
parts AS (
  SELECT rid, k, kind, base, words, text, string_split(regexp_replace(replace(text, chr(57344), chr(57345)), pattern, chr(57344) || '\0' || chr(57344), 'g'), chr(57344)) AS p
  FROM docs, kinds
), cut AS (
  SELECT rid, k, kind, base, words, text, unnest(p) AS m, generate_subscripts(p, 1) AS i FROM parts WHERE len(p) > 1
), placed AS (
  SELECT *, CAST(sum(length(m)) OVER (PARTITION BY rid, k ORDER BY i) AS BIGINT) AS e FROM cut
), tried AS (
  SELECT rid, k, kind, e - length(m) AS s, e, base, words, substr(text, greatest(e - length(m) - {CONTEXT}, 0) + 1, length(m) + 2 * {CONTEXT}) AS near,
    CASE kind WHEN 'ip' THEN regexp_full_match(m, '{PART}\.{PART}\.{PART}\.{PART}') WHEN 'phone' THEN length({digits}) BETWEEN 8 AND 15
      WHEN 'card' THEN length({digits}) BETWEEN 16 AND 19 AND
        list_sum(list_transform(list_reverse(string_split({digits}, '')), lambda x, i: CASE WHEN i % 2 = 0 THEN (TRY_CAST(x AS INT) * 2) // 10 + (TRY_CAST(x AS INT) * 2) % 10 ELSE TRY_CAST(x AS INT) END)) % 10 = 0
      WHEN 'iban' THEN list_reduce(list_prepend(0, list_transform(string_split(substr({bare}, 5) || substr({bare}, 1, 4), ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END)),
        lambda a, v: CASE WHEN v < 10 THEN (a * 10 + v) % 97 ELSE (a * 100 + v) % 97 END) = 1
      ELSE TRUE END AS valid
  FROM placed WHERE i % 2 = 0
), scored AS (
  SELECT * FROM tried WHERE valid AND base + CASE WHEN kind IN ('card', 'iban') THEN {CHECKED} ELSE 0 END
    + CASE WHEN words <> '' AND regexp_matches(near, '(?i)' || words) THEN {NEARBY} ELSE 0 END >= {ACCEPT}
), own AS (
  SELECT * FROM scored a WHERE kind <> 'tel' OR NOT EXISTS (SELECT 1 FROM scored b WHERE b.rid = a.rid AND b.kind = 'phone' AND b.s < a.e AND a.s < b.e)
), per AS (
  SELECT rid, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip, count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) FILTER (k < 4) AS base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) AS spans
  FROM own GROUP BY rid
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN per USING (rid)
"""


ORACLE_SQL = _sql()
