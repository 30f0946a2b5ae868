r"""Personal data in texts: patterns propose, checksums confirm, context words adjust the score.

DataFrame functions only. Every kind has a pattern whose matches are taken from left to right
without overlap. ``regexp_extract_all`` gives the matches and ``split`` the text between them;
their lengths add up to places, and the text between is where context words are looked for:
at most ``NEAR`` characters on either side, not beyond the neighbouring match of the kind.

The base kinds (email, ip, card, phone) keep every match that passes its validator, whatever the
score. The further kinds are kept from a score of ``KEEP`` on:

* ``iban``: the length of its country and the remainder 1 modulo 97 are required;
* ``ssn``: three groups of digits without the numbers that are never given out; it has no
  checksum, so it needs a word such as "social security" nearby;
* ``tel``: a local number of ten digits, which needs a word such as "call" nearby.

A helpful word raises the score, a misleading one ("order", "isbn") lowers it. The patterns are
those of the definitions, written so that they run in linear time and without recursion on very
long texts: possessive repetition, and no start inside a run whose beginning has failed.

Defined cases: null texts are empty and hold nothing; null ids stay; rows that repeat are
searched each for itself; an empty table gives no rows; other columns are ignored by
``spans_of`` and kept by ``find``, which refuses nothing but a column named as its result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.llm.shared import table

KEEP, NEAR, BLOCK = 0.5, 40, 128
PARTS = ["hits", "gaps", "steps", "blocks", "sums"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE = ["email", "ip", "card", "phone"]
#: Lengths of account numbers by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18,
    "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26,
    "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28,
    "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26,
}

#: Edges of words of ASCII letters, digits and underscores: the character just read begins one;
#: none goes on.
NOT_AFTER, NOT_BEFORE = "(?<![A-Za-z0-9_].)", "(?![A-Za-z0-9_])"


@dataclass(frozen=True)
class Kind:
    """A kind of span: Java's pattern, its plain form for SQL, score and words around it."""

    name: str
    pattern: str
    plain: str
    score: float
    raised_by: tuple[str, ...] = ()
    lowered_by: tuple[str, ...] = ()
    holds: str = ""  # a character without which there is no match


KINDS = [
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        0.9,
        ("mail", "email", "contact", "write"),
        ("example", "noreply"),
        "@",
    ),
    Kind(
        "ip",
        r"[0-9](?:(?<=\G[0-9])|(?<![0-9]{2}))[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        0.6,
        ("ip", "host", "address", "server"),
        ("version", "section", "release"),
        ".",
    ),
    Kind(
        "card",
        # Only runs that hold the 14 digits a card needs; shorter ones would fail anyway.
        r"[0-9](?<![0-9]{2})(?:[ -]?[0-9]){13,}+",
        r"[0-9]([\x20-]?[0-9])+",
        0.9,
        ("card", "visa", "credit", "debit"),
        ("order", "isbn", "tracking"),
    ),
    Kind(
        "phone",
        r"\+[0-9][ ().0-9-]+[0-9]",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        0.7,
        ("call", "phone", "tel", "mobile", "fax"),
        ("order", "isbn"),
        "+",
    ),
    Kind(
        "iban",
        r"[A-Z]" + NOT_AFTER + r"[A-Z][0-9]{2}(?: ?[A-Z0-9]){11,}+",
        r"\b[A-Z]{2}[0-9]{2}( ?[A-Z0-9]){11,}",
        0.8,
        ("iban", "account", "bank", "konto", "compte", "cuenta"),
    ),
    Kind(
        "ssn",
        r"[0-9]" + NOT_AFTER + r"[0-9]{2}-[0-9]{2}-[0-9]{4}" + NOT_BEFORE,
        r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
        0.3,
        ("ssn", "social", "security", "taxpayer"),
        ("order", "invoice", "part", "isbn"),
        "-",
    ),
    Kind(
        "tel",
        rf"[(0-9](?:(?<=\()[0-9]{{3}}\) ?|(?<=[0-9]){NOT_AFTER}[0-9]{{2}}[ .-])[0-9]{{3}}[ .-][0-9]{{4}}" + NOT_BEFORE,
        r"(\([0-9]{3}\) ?|\b[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}\b",
        0.3,
        ("call", "phone", "tel", "telephone", "mobile", "fax", "cell", "telefon"),
        ("order", "invoice", "part", "isbn"),
    ),
]
RAISE, LOWERED = 0.4, 0.3
SPAN = "struct<start:int,rank:int,end:int,kind:string,score:double>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn checksum."""
    n = F.length(digits)
    figure = lambda i: F.substring(digits, n - i, F.lit(1)).cast("int")
    doubled = lambda i: figure(i) * 2 - F.when(figure(i) > 4, 9).otherwise(0)
    total = F.aggregate(
        F.sequence(F.lit(0), n - 1), F.lit(0), lambda sum_, i: sum_ + F.when(i % 2 == 1, doubled(i)).otherwise(figure(i))
    )
    return (n > 0) & (total % 10 == 0)


def mod97(compact: Column) -> Column:
    """Whether an account number without blanks leaves 1 modulo 97, its first four at the end."""
    turned = F.concat(F.substring(compact, F.lit(5), F.length(compact)), F.left(compact, F.lit(4)))
    value = lambda c: F.instr(F.lit("0123456789" + UPPER), c) - 1
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda r, c: F.when(c == "", r).otherwise((r * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97),
    )
    return rest == 1


def _iban(hit: Column) -> Column:
    """The beginning of a match that is as long as its country's numbers, or ''."""
    lengths = F.create_map(*(F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair))
    n = F.try_element_at(lengths, F.left(hit, F.lit(2)))
    exact = F.concat(F.lit("^(?:[A-Z0-9] ?){"), (n - 1).cast("string"), F.lit("}[A-Z0-9]"))
    return F.coalesce(F.regexp_substr(hit, exact), F.lit(""))


def _confirmed(kind: str, before: Column, hit: Column, after: Column) -> tuple[Column, Column]:
    """The text of the span within a match, and whether it passes its validator."""
    if kind == "ip":
        parts = F.split(hit, r"\.")
        return hit, F.forall(parts, lambda p: F.coalesce(p.try_cast("bigint") <= 255, F.lit(False)))
    if kind == "card":
        digits = _digits(hit)
        return hit, F.length(digits).between(14, 19) & luhn(digits)
    if kind == "phone":
        return hit, F.length(_digits(hit)).between(10, 15)
    if kind == "iban":
        cut = _iban(hit)
        follows = F.left(F.concat(F.substring(hit, F.length(cut) + 1, F.lit(1)), after), F.lit(1))
        return cut, (cut != "") & ~follows.rlike("^[A-Za-z0-9]") & mod97(F.translate(cut, " ", ""))
    if kind == "ssn":
        area, group, serial = F.left(hit, F.lit(3)), F.substring(hit, 5, 2), F.right(hit, F.lit(4))
        never = area.isin("000", "666") | (F.left(area, F.lit(1)) == "9") | (group == "00") | (serial == "0000")
        return hit, ~never & (F.right(before, F.lit(1)) != "-") & (F.left(after, F.lit(1)) != "-")
    if kind == "tel":
        inside = F.right(before, F.lit(5)).rlike(r"(?:\+[0-9]{1,3}[ -]?|[0-9+.-])$")
        return hit, ~inside & (F.left(after, F.lit(1)) != "-")
    return hit, F.lit(True)


def _near(before: Column, after: Column, words: tuple[str, ...]) -> Column:
    if not words:
        return F.lit(False)
    around = F.concat(F.right(before, F.lit(NEAR)), F.lit(" "), F.left(after, F.lit(NEAR)))
    return F.translate(around, UPPER, LOWER).rlike("(?:^|[^a-z])(?:" + "|".join(words) + ")(?:[^a-z]|$)")


def _spans(rank: int, kind: Kind, c: dict[str, str]) -> Column:
    """Confirmed spans among the matches of one kind, from the columns that ``find`` prepares."""
    n, none = F.size(c["hits"]), F.array().cast(f"array<{SPAN}>")
    plus = lambda a, b: a + b
    # Running sums of the steps from match to match: inside each block, then of whole blocks.
    inside = F.transform(c["blocks"], lambda b: F.transform(b, lambda _, j: F.aggregate(F.slice(b, 1, j), F.lit(0), plus)))
    before = F.transform(c["sums"], lambda _, i: F.aggregate(F.slice(c["sums"], 1, i), F.lit(0), plus))
    at = F.flatten(F.zip_with(inside, before, lambda b, o: F.transform(b, lambda x: x + o)))
    parts = F.arrays_zip(
        F.slice(c["gaps"], 1, n).alias("before"),
        F.col(c["hits"]).alias("hit"),
        F.slice(c["gaps"], 2, n).alias("after"),
        at.alias("at"),
    )

    def span(x: Column) -> Column:
        start = x["at"] + F.length(x["before"])
        text, good = _confirmed(kind.name, x["before"], x["hit"], x["after"])
        score = F.lit(kind.score) + F.when(_near(x["before"], x["after"], kind.raised_by), RAISE).otherwise(0.0)
        score = score - F.when(_near(x["before"], x["after"], kind.lowered_by), LOWERED).otherwise(0.0)
        if kind.name not in BASE:
            good = good & (score >= KEEP)
        return F.when(
            good,
            F.struct(
                start.alias("start"),
                F.lit(rank).alias("rank"),
                (start + F.length(text)).alias("end"),
                F.lit(kind.name).alias("kind"),
                score.alias("score"),
            ),
        )

    return F.when(n > 0, F.array_compact(F.transform(parts, span))).otherwise(none).cast(f"array<{SPAN}>")


def _slice(steps: str):
    return lambda first: F.slice(steps, first, F.lit(BLOCK))


def find(docs: DataFrame, text: str = "text", into: str = "personal_data") -> DataFrame:
    """docs with their spans in one more column: (start, rank, end, kind, score), by place.

    Places count code points from 0, the end is exclusive; ``rank`` orders kinds at one place.
    Everything is linear in the text and the number of matches, but for the sums of blocks,
    of which there are few.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    columns = {k.name: {part: f"_pd_{k.name}_{part}" for part in PARTS} for k in KINDS}
    # One step after the other, so that each column is computed once and then only read.
    steps: list[dict[str, Column]] = [{} for _ in PARTS]
    for kind in KINDS:
        c = columns[kind.name]
        hits = F.regexp_extract_all(whole, F.lit(kind.pattern), F.lit(0))
        if kind.holds:
            hits = F.when(F.contains(whole, F.lit(kind.holds)), hits)
        some, n = F.size(c["hits"]) > 0, F.size(c["hits"])
        # The pattern runs a second time, for the text between, only where it was found.
        advance = F.zip_with(F.slice(c["gaps"], 1, n), c["hits"], lambda g, h: F.length(g) + F.length(h))
        starts = F.sequence(F.lit(1), n, F.lit(BLOCK))
        made = {
            "hits": F.coalesce(hits, F.array().cast("array<string>")),
            "gaps": F.when(some, F.split(whole, kind.pattern, -1)),
            "steps": F.when(some, advance),
            "blocks": F.when(some, F.transform(starts, _slice(c["steps"]))),
            "sums": F.transform(c["blocks"], lambda b: F.aggregate(b, F.lit(0), lambda x, y: x + y)),
        }
        for i, part in enumerate(PARTS):
            steps[i][c[part]] = made[part]
    rows = docs
    for made in steps:
        rows = rows.withColumns(made)
    lists = [_spans(i, kind, columns[kind.name]) for i, kind in enumerate(KINDS)]
    rows = rows.withColumn(into, F.array_sort(F.concat(*lists)))
    return rows.drop(*(name for c in columns.values() for name in c.values()))


def _joined(spans: Column) -> Column:
    shown = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, shown), ",")


def digest(found: DataFrame, spans: str = "personal_data") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for each row of ``find``."""
    every = F.col(spans)

    def count(kind: str) -> Column:
        return F.size(F.filter(every, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter(every, lambda s: s["rank"] < len(BASE))
    return found.select("doc_id", *map(count, BASE), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(every).alias("spans"))


def op13_pii_spans(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return digest(find(docs)).select("doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans")


def _sql() -> str:
    def near(words: tuple[str, ...]) -> str:
        around = f"translate(right(before, {NEAR}) || ' ' || left(after, {NEAR}), '{UPPER}', '{LOWER}')"
        return f"regexp_matches({around}, '(?:^|[^a-z])(?:{'|'.join(words)})(?:[^a-z]|$)')" if words else "false"

    matches, scores = [], []
    for rank, kind in enumerate(KINDS):
        found = f"regexp_extract_all(t, '{kind.plain}') AS h, string_split_regex(t, '{kind.plain}') AS g"
        matches.append(f"""
  SELECT id, {rank} AS rank, '{kind.name}' AS kind, unnest(range(len(h))) AS i, unnest(h) AS hit,
         unnest(g[1:len(h)]) AS before, unnest(g[2:]) AS after
  FROM (SELECT id, {found} FROM texts) WHERE len(h) > 0""")
        score = f"{kind.score}::DOUBLE + CASE WHEN {near(kind.raised_by)} THEN {RAISE}::DOUBLE ELSE 0 END"
        score += f" - CASE WHEN {near(kind.lowered_by)} THEN {LOWERED}::DOUBLE ELSE 0 END"
        scores.append(f"WHEN kind = '{kind.name}' THEN {score}")
    lengths = ", ".join(f"'{k}': {v}" for k, v in IBAN_LENGTHS.items())
    return rf"""
WITH texts AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t FROM documents
), matches AS ({" UNION ALL ".join(matches)}
), placed AS (
  SELECT *, (sum(len(before) + len(hit)) OVER (PARTITION BY id, rank ORDER BY i) - len(hit))::BIGINT AS start,
         regexp_replace(hit, '[^0-9]', '', 'g') AS digits,
         CASE WHEN kind <> 'iban' THEN hit
              ELSE coalesce(regexp_extract(hit, '^(?:[A-Z0-9] ?){{' || (MAP {{{lengths}}}[left(hit, 2)] - 1) || '}}[A-Z0-9]'), '') END AS cut,
         CASE {" ".join(scores)} END AS score
  FROM matches
), judged AS (
  SELECT *, start + len(cut) AS stop, replace(cut, ' ', '') AS compact, CASE kind
    WHEN 'ip' THEN len(list_filter(string_split(hit, '.'), lambda p: coalesce(TRY_CAST(p AS BIGINT) <= 255, false))) = 4
    WHEN 'card' THEN len(digits) BETWEEN 14 AND 19 AND list_sum(list_transform(range(len(digits)), lambda i:
           CASE WHEN i % 2 = 0 THEN substr(digits, (len(digits) - i)::BIGINT, 1)::INT
                ELSE substr(digits, (len(digits) - i)::BIGINT, 1)::INT * 2 - CASE WHEN substr(digits, (len(digits) - i)::BIGINT, 1) > '4' THEN 9 ELSE 0 END END)) % 10 = 0
    WHEN 'phone' THEN len(digits) BETWEEN 10 AND 15
    WHEN 'iban' THEN cut <> '' AND NOT regexp_matches(substr(hit, len(cut) + 1, 1) || after, '^[A-Za-z0-9]') AND score >= {KEEP}
    WHEN 'ssn' THEN left(hit, 3) NOT IN ('000', '666') AND left(hit, 1) <> '9' AND substr(hit, 5, 2) <> '00' AND right(hit, 4) <> '0000'
           AND right(before, 1) <> '-' AND left(after, 1) <> '-' AND score >= {KEEP}
    WHEN 'tel' THEN NOT regexp_matches(right(before, 5), '(?:\+[0-9]{{1,3}}[ -]?|[0-9+.-])$') AND left(after, 1) <> '-' AND score >= {KEEP}
    ELSE true END AS good
  FROM placed
), spans AS (
  SELECT * FROM judged WHERE good AND (kind <> 'iban' OR list_reduce(list_prepend(0::BIGINT, list_transform(
    string_split(substr(compact, 5) || left(compact, 4), ''), lambda c: (strpos('0123456789{UPPER}', c) - 1)::BIGINT)),
    lambda r, v: (r * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1)
), grouped AS (
  SELECT id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < {len(BASE)}) AS base
  FROM spans GROUP BY id
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN grouped USING (id)
"""


SQL = _sql()
