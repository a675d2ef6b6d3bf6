"""Personal data: patterns propose spans, checksums confirm them, context sets their score.

Everything is a function of the row's own text in built-in functions: pieces between the
matches of a pattern and the matches themselves give the places by a running sum, in
time that grows with the text. Patterns are written so that a run of characters is
tried once, not from each of its characters.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kudosflow.llm.common import let, running_sum

#: Characters around a match in which context words count.
CONTEXT_CHARS = 40
#: The score at which a span counts, and what context words add. Confirmed kinds reach it
#: without context.
LEAST_SCORE = 50
_NEAR_SCORE = 25


class Kind(NamedTuple):
    """``hint`` must occur in a text for the pattern to be tried. With ``length``, the
    pattern matches the first ``head`` characters of a span, its group what the span may
    reach to, and ``length`` gives how much of the group is confirmed, or null."""

    name: str
    pattern: str
    hint: str
    valid: Callable[[Column], Column]
    score: int
    context: str
    head: int = 0
    length: Callable[[Column], Column] | None = None


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column, most: int = 19) -> Column:
    """Whether a string of at most ``most`` digits passes the Luhn test."""
    padded = F.lpad(digits, most + most % 2, "0")
    doubled = F.translate(padded, "0123456789", "0246813579")

    def at(i: Column) -> Column:
        taken = F.when(i % 2 == 0, F.substring(padded, i, 1))
        return taken.otherwise(F.substring(doubled, i, 1)).cast("int")

    numbers = F.transform(F.sequence(F.lit(1), F.lit(most + most % 2)), at)
    return F.aggregate(numbers, F.lit(0), lambda total, x: total + x) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether letters and digits, the first four moved to the end, leave 1 modulo 97."""
    moved = F.concat(F.substring(code, 5, 1_000), F.substring(code, 1, 4))

    def step(rest: Column, sign: Column) -> Column:
        value = F.ascii(sign)
        letter = (rest * 100 + value - 55) % 97
        return F.when(value >= 65, letter).otherwise((rest * 10 + value - 48) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), lambda rest, s: F.when(
        s == "", rest).otherwise(step(rest, s))) == 1


_ACCOUNT = r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?"
#: Letters and digits of the registered countries' account numbers.
_ACCOUNT_SIGNS = {
    country: int(signs)
    for signs, countries in (
        line.split(": ")
        for line in (
            "15: NO",
            "16: BE",
            "18: DK FI FK FO GL NL SD",
            "19: MK SI",
            "20: AT BA EE KZ LT LU MN XK",
            "21: CH HR LI LV",
            "22: BG BH CR DE GB GE IE ME RS VA",
            "23: AE GI IL IQ OM SO TL",
            "24: AD CZ ES MD PK RO SA SE SK TN VG",
            "25: LY PT ST",
            "26: IS TR",
            "27: BI DJ FR GR IT MC MR SM",
            "28: AL AZ BY CY DO GT HN HU LB NI PL SV",
            "29: BR EG PS QA UA",
            "30: JO KW MU YE",
            "31: MT SC",
            "32: LC",
            "33: RU",
        )
    )
    for country in countries.split()
}


def _account(match: Column) -> Column:
    return mod97(F.replace(match, F.lit(" "), F.lit("")))


def _account_length(reach: Column) -> Column:
    """How much of ``reach`` is an account number: as much as the country's numbers have,
    whatever follows, or else all of it, if the checksum holds."""
    known = F.create_map(*[F.lit(x) for pair in _ACCOUNT_SIGNS.items() for x in pair])
    signs = F.try_element_at(known, F.substring(reach, F.lit(1), F.lit(2)))

    def registered(n: Column) -> Column:
        ends = (n == F.length(reach)) | (F.substring(reach, n + 1, F.lit(1)) == " ")
        part = F.substring(reach, F.lit(1), n)
        whole = F.length(F.replace(part, F.lit(" "), F.lit(""))) == signs
        return ends & whole & part.rlike(f"^{_ACCOUNT}$") & _account(part)

    lengths = F.sequence(F.lit(1), F.length(reach))
    every = F.when(_account(reach), F.length(reach))
    return F.coalesce(F.get(F.filter(lengths, registered), F.lit(0)), every)


def _digits_between(low: int, high: int) -> Callable[[Column], Column]:
    return lambda match: F.length(_digits(match)).between(low, high)


def _card(match: Column) -> Column:
    return let(
        _digits(match),
        lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(F.lit(False)),
    )


_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

#: Kinds whose spans count whatever stands around them, in the order of equal starts.
BASE = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        lambda match: F.lit(True),
        70,
        "mail|contact|write",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
        ".",
        lambda match: match.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"),
        60,
        "address|host|server|login",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        "",
        _card,
        70,
        "card|visa|master|pay|karte|carte|tarjeta",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        "+",
        _digits_between(10, 15),
        60,
        "phone|call|tel|mobile",
    ),
)
def _secret(match: Column) -> Column:
    """Whether letters and digits take turns, and enough signs are different."""
    def runs(pattern: str) -> Column:
        return F.size(F.regexp_extract_all(match, F.lit(pattern), F.lit(0)))

    signs = F.array_distinct(F.filter(F.split(match, ""), lambda sign: sign != ""))
    return (runs("[0-9]+") >= 2) & (runs("[A-Za-z]+") >= 2) & (F.size(signs) >= 10)


_SECRET = "[A-Za-z0-9_+/-]{20,}"
#: Kinds the method adds. An account number is confirmed by its checksum. A national number
#: and a secret have none, so that only context lifts them over the least score: a hash or an
#: address that nothing calls a token or a key is left alone.
ADDED = (
    Kind(
        "iban",
        rf"(?<![A-Za-z0-9_])(?=({_ACCOUNT})(?![A-Za-z0-9_]))[A-Z]{{2}}[0-9]{{2}}",
        "",
        _account,
        70,
        "iban|bank|account|konto|compte|cuenta",
        4,
        _account_length,
    ),
    Kind(
        "national_id",
        r"(?<![A-Za-z0-9_])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_])",
        "-",
        lambda match: ~match.rlike("^(?:000|666|9)|-00-|-0000$"),
        30,
        "ssn|social security|national id|identity number",
    ),
    Kind(
        "secret",
        rf"(?<![A-Za-z0-9_+/-]){_SECRET[:-1]}}}+={{0,2}}",
        "",
        _secret,
        30,
        "token|secret|passw|credential|bearer|auth|(?:[a-z]+[_-])*(?:key|token|secret)",
    ),
)
KINDS = BASE + ADDED
_SPAN = "struct<start:bigint,kind_no:int,end:bigint,kind:string,score:int>"


def _spans(text: Column, kind: Kind, number: int) -> Column:
    """The confirmed spans of one kind, leftmost first."""

    def located(parts: Column, matches: Column, reaches: Column) -> Column:
        steps = F.transform(
            matches,
            lambda m, i: F.length(F.get(parts, i))
            + F.coalesce(F.length(F.get(matches, i - 1)), F.lit(0)),
        )

        def span(starts: Column, i: Column) -> Column:
            match, start = F.get(matches, i), F.get(starts, i)
            if kind.length:
                return let(
                    kind.length(F.get(reaches, i)),
                    lambda n: judged(i, start, n, n.isNotNull(), n - kind.head + 1),
                )
            return judged(i, start, F.length(match), kind.valid(match), F.lit(1))

        def judged(i: Column, start: Column, n: Column, valid: Column, rest: Column) -> Column:
            after = F.get(parts, i + 1)
            after = F.substring(after, rest, F.lit(CONTEXT_CHARS)) if kind.length else after
            near = F.concat_ws(
                " ",
                F.lower(F.right(F.get(parts, i), F.lit(CONTEXT_CHARS))),
                F.lower(F.left(after, F.lit(CONTEXT_CHARS))),
            )
            score = F.lit(kind.score) + F.when(
                near.rlike(f"(?<![a-z0-9_])(?:{kind.context})"), _NEAR_SCORE
            ).otherwise(0)
            return F.struct(
                start.alias("start"),
                F.lit(number).alias("kind_no"),
                (start + n).alias("end"),
                F.lit(kind.name).alias("kind"),
                F.when(valid, score).otherwise(0).alias("score"),
            )

        placed = let(
            running_sum(steps),
            lambda starts: F.transform(matches, lambda m, i: span(starts, i)),
        )
        counted = F.filter(placed, lambda s: s["score"] >= LEAST_SCORE)
        return _apart(counted) if kind.length else counted

    both = F.struct(
        F.split(text, kind.pattern).alias("parts"),
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("matches"),
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(1 if kind.length else 0)).alias(
            "reaches"
        ),
    )
    found = let(both, lambda b: located(b["parts"], b["matches"], b["reaches"]))
    hinted = F.contains(text, F.lit(kind.hint)) & text.rlike("[0-9]|@")
    return F.when(hinted, found).otherwise(F.array()).cast(f"array<{_SPAN}>")


def _apart(spans: Column) -> Column:
    """Spans by start without those that begin inside an earlier one."""
    kept = spans.cast(f"array<{_SPAN}>")
    first = F.array().cast(f"array<{_SPAN}>")

    def step(done: Column, s: Column) -> Column:
        clear = s["start"] >= F.coalesce(F.get(done, F.size(done) - 1)["end"], F.lit(0))
        return F.when(clear, F.concat(done, F.array(s))).otherwise(done)

    return F.aggregate(kept, first, step)


def find_pii(df: DataFrame, text: str = "text", kinds=KINDS, spans: str = "pii_spans") -> DataFrame:
    """Add the spans of personal data in each text, by start and then kind as listed.

    A span has ``start``, ``end`` (code points, end exclusive), ``kind`` and ``score``.
    Spans of one kind do not overlap, those of several may. Missing and empty texts
    have none. A column by the name of ``spans`` is replaced.
    """
    source = F.coalesce(F.col(text).cast("string"), F.lit(""))
    found = F.concat(*[_spans(source, kind, number) for number, kind in enumerate(kinds)])
    return df.withColumn(spans, F.sort_array(found))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


#: Code points of a block; cutting a text reads whole blocks only.
_BLOCK = 1024


def redact(text: Column, spans: Column) -> Column:
    """The text with every stretch covered by spans replaced by the first one's ``<KIND>``.

    Overlapping spans are replaced as one. A text without spans stays as it is, null
    included.
    """

    def merged(items: Column) -> Column:
        first = F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>")

        def step(done: Column, s: Column) -> Column:
            last = F.get(done, F.size(done) - 1)
            joined = F.struct(
                last["start"].alias("start"),
                F.greatest(last["end"], s["end"]).alias("end"),
                last["kind"].alias("kind"),
            )
            own = F.struct(s["start"], s["end"], s["kind"])
            return F.when(
                (F.size(done) > 0) & (s["start"] < last["end"]),
                F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined)),
            ).otherwise(F.concat(done, F.array(own)))

        return F.aggregate(items, first, step)

    def cut(blocks: Column, start: Column, end: Column) -> Column:
        first = F.floor(start / _BLOCK).cast("int")
        count = (F.floor((end - 1) / _BLOCK) - first).cast("int") + 1
        part = F.array_join(F.slice(blocks, first + 1, F.greatest(count, F.lit(0))), "")
        inside = F.substr(part, (start % _BLOCK + 1).cast("int"), (end - start).cast("int"))
        return F.when(end > start, inside).otherwise("")

    def rebuilt(parts: Column, blocks: Column) -> Column:
        heads = F.transform(
            parts,
            lambda s, i: F.concat(
                cut(blocks, F.coalesce(F.get(parts, i - 1)["end"], F.lit(0)), s["start"]),
                F.lit("<"),
                F.upper(s["kind"]),
                F.lit(">"),
            ),
        )
        last = F.get(parts, F.size(parts) - 1)["end"]
        return F.concat(F.array_join(heads, ""), cut(blocks, last, F.length(text).cast("bigint")))

    blocks = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{_BLOCK}}}"), F.lit(0))
    changed = let(merged(spans), lambda parts: let(blocks, lambda b: rebuilt(parts, b)))
    return F.when(F.size(spans) > 0, changed).otherwise(text)


def _sql_kinds() -> str:
    """The kinds as rows, with patterns that need no look around a match."""
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(?:\.[0-9]+){3}",
        "card": r"[0-9](?:[\x20-]?[0-9])+",
        "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b",
        "national_id": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
        "secret": rf"{_SECRET}={{0,2}}",
    }
    rows = [
        f"({i}, '{kind.name}', '{plain.get(kind.name, kind.pattern)}', {kind.score},"
        f" '\\b(?:{kind.context})')"
        for i, kind in enumerate(KINDS)
    ]
    return ",\n  ".join(rows)


def _sql_columns() -> str:
    counts = [
        f"count(*) FILTER (kind = '{kind.name}') AS n_{kind.name}" for kind in KINDS
    ]
    span = "kind || ':' || start || ':' || (start + length(match)), ',' ORDER BY start, no"
    base = f"string_agg({span}) FILTER (no < {len(BASE)})"
    counts.append(f"sha256(coalesce({base}, '')) AS base_sha256")
    counts.append(f"coalesce(string_agg({span}), '') AS spans")
    return ", ".join(counts)


#: The registered query in DuckDB.
ORACLE_SQL = rf"""
WITH kinds(no, kind, pattern, score, context) AS (VALUES
  {_sql_kinds()}),
parts AS (
  SELECT doc_id, kinds.*, regexp_extract_all(coalesce(text, ''), pattern) AS m,
    string_split_regex(coalesce(text, ''), pattern) AS p
  FROM documents, kinds),
located AS (
  SELECT * EXCLUDE (m, p), m[i] AS match, regexp_replace(m[i], '[^0-9]', '', 'g') AS digits,
    replace(m[i], ' ', '') AS code,
    length(array_to_string(p[: i], '')) + length(array_to_string(m[: i - 1], '')) AS start,
    lower(right(p[i], {CONTEXT_CHARS})) || ' ' || lower(left(p[i + 1], {CONTEXT_CHARS})) AS near
  FROM parts, unnest(range(1, len(m) + 1)) AS t(i)),
checked AS (
  SELECT *, CASE kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN regexp_full_match(match, '{_BYTE}(?:\.{_BYTE}){{3}}')
    WHEN 'card' THEN length(digits) BETWEEN 14 AND 19 AND list_sum(list_transform(
      range(length(digits)), lambda k: CASE WHEN k % 2 = 0
        THEN CAST(substr(digits, length(digits) - k, 1) AS INT)
        ELSE CAST(translate(substr(digits, length(digits) - k, 1),
          '0123456789', '0246813579') AS INT) END)) % 10 = 0
    WHEN 'phone' THEN length(digits) BETWEEN 10 AND 15
    WHEN 'iban' THEN list_reduce(list_prepend(0, list_transform(
      string_split(substr(code, 5) || substr(code, 1, 4), ''),
      lambda s: CASE WHEN s >= 'A' THEN ascii(s) - 55 ELSE ascii(s) - 48 END)),
      lambda rest, x: (rest * CASE WHEN x > 9 THEN 100 ELSE 10 END + x) % 97) = 1
    WHEN 'secret' THEN len(regexp_extract_all(match, '[0-9]+')) >= 2
      AND len(regexp_extract_all(match, '[A-Za-z]+')) >= 2
      AND len(list_distinct(string_split(match, ''))) >= 10
    ELSE NOT regexp_matches(match, '^(?:000|666|9)|-00-|-0000$') END AS valid
  FROM located),
found AS (
  SELECT * FROM checked WHERE valid
    AND score + CASE WHEN regexp_matches(near, context) THEN {_NEAR_SCORE} ELSE 0 END
      >= {LEAST_SCORE}),
spans AS (SELECT doc_id, {_sql_columns()} FROM found GROUP BY doc_id)
SELECT documents.doc_id,
  {", ".join(f"coalesce(n_{kind.name}, 0) AS n_{kind.name}" for kind in KINDS)},
  coalesce(base_sha256, sha256('')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN spans ON documents.doc_id = spans.doc_id
"""
