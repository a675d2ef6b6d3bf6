"""Quality rules: a table of thresholds compiled into one projection.

Every rule compares a ratio of two counts of a text with bounds in thousandths, in
whole numbers, so any engine gives the same answer. Nothing is shuffled and no user
function runs: the counts are array and string functions of the row's own text.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kudosflow.llm.common import SPACES, let, quoted


class Rule(NamedTuple):
    """A text fails if ``1000 * count`` is outside ``low`` to ``high`` times ``per``."""

    name: str
    count: str
    per: str
    low: int | None = None
    high: int | None = None


# Frequent function words of the four languages.
STOP_WORDS = (
    "a an and are as at be by for from had has have he her his i in is it not of on or she "
    "that the they this to was we were which with you "
    "au aux ce dans de des du elle en est et il la le les mais ne ou par pas pour que qui se "
    "son sur un une "
    "aber als auch auf aus bei das dass dem den der die ein eine einen er es für hat ich im "
    "ist mit nach nicht sich sie sind und von war wie zu zum "
    "al como con del el ella ese esta fue las lo los más no para pero por sin su sus una y"
).split()

RULES = (
    Rule("length", "n_words", "one", high=100_000_000),
    Rule("word_length", "word_chars", "n_words", low=2_000, high=15_000),
    Rule("symbols", "n_symbols", "n_words", high=100),
    Rule("stop_words", "n_stop_words", "n_words", low=20),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=500),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=900),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=300),
)


def _repeated(words: Column) -> Column:
    """Words in three-word windows that the text has twice or more."""

    def window(word: Column, i: Column) -> Column:
        gram = F.concat_ws(" ", word, F.get(words, i + 1), F.get(words, i + 2))
        return F.struct(gram.alias("gram"), i.alias("at"))

    def shared(ordered: Column) -> Column:
        again = F.filter(
            ordered,
            lambda w, i: (w["gram"] == F.get(ordered, i - 1)["gram"])
            | (w["gram"] == F.get(ordered, i + 1)["gram"]),
        )
        return F.sort_array(F.transform(again, lambda w: w["at"]))

    def covered(starts: Column) -> Column:
        first = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n"))
        return F.aggregate(
            starts,
            first,
            lambda s, at: F.struct(
                at.alias("last"), (s["n"] + F.least(at - s["last"], F.lit(3))).alias("n")
            ),
            lambda s: s["n"],
        )

    windows = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))), window)
    return let(F.sort_array(windows), lambda ordered: covered(shared(ordered)))


def text_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts that rules compare. No text: all are 0.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines`` (lines with a word),
    ``n_dup_lines`` (those equal to an earlier one), ``n_repeat_words``,
    ``n_stop_words``, ``n_bullet_lines``, ``n_ellipsis_lines``. A column of the table
    by one of these names is replaced.
    """
    source = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = F.array_remove(F.split(source, f"[{SPACES}]+"), "")
    lines = F.filter(F.split(source, "\n"), lambda line: line.rlike(f"[^{SPACES}]"))

    def count(items: Column, test) -> Column:
        return F.size(F.filter(items, test))

    of_words = let(
        words,
        lambda w: F.struct(
            F.size(w).alias("n_words"),
            F.length(F.array_join(w, "")).alias("word_chars"),
            _repeated(w).alias("n_repeat_words"),
            count(w, lambda x: F.lower(x).isin(*STOP_WORDS)).alias("n_stop_words"),
        ),
    )
    of_lines = let(
        lines,
        lambda line: F.struct(
            F.size(line).alias("n_lines"),
            (F.size(line) - F.size(F.array_distinct(line))).alias("n_dup_lines"),
            count(line, lambda x: x.rlike(rf"^[{SPACES}]*[-*•]")).alias("n_bullet_lines"),
            count(line, lambda x: x.rlike(rf"(?:\.\.\.|…)[{SPACES}]*$")).alias(
                "n_ellipsis_lines"
            ),
        ),
    )
    symbols = F.length(source) - F.length(F.translate(source, "#*$%&|<>", ""))
    counted = {
        **{name: ("w", name) for name in ("n_words", "word_chars")},
        "n_symbols": ("", "n_symbols"),
        "n_lines": ("l", "n_lines"),
        "n_dup_lines": ("l", "n_dup_lines"),
        **{name: ("w", name) for name in ("n_repeat_words", "n_stop_words")},
        **{name: ("l", name) for name in ("n_bullet_lines", "n_ellipsis_lines")},
    }
    kept = [c for c in df.columns if c.lower() not in counted]
    staged = df.select(
        F.struct(*[F.col(quoted(c)) for c in kept]).alias("row"),
        F.struct(
            of_words.alias("w"), of_lines.alias("l"), symbols.alias("n_symbols")
        ).alias("counts"),
    )
    return staged.select(
        "row.*",
        *[
            (F.col(f"counts.{group}.{name}") if group else F.col(f"counts.{name}"))
            .cast("bigint")
            .alias(out)
            for out, (group, name) in counted.items()
        ],
    )


def failures(rules=RULES) -> Column:
    """The names of the rules that a row of counts fails, in the rules' order."""
    tests = []
    for rule in rules:
        per = F.lit(1) if rule.per == "one" else F.col(rule.per)
        value, broken = F.col(rule.count) * 1000, F.lit(False)
        if rule.low is not None:
            broken |= value < per * rule.low
        if rule.high is not None:
            broken |= value > per * rule.high
        tests.append(F.when(broken, F.lit(rule.name)))
    return F.filter(F.array(*tests), lambda name: name.isNotNull())


def quality_rules(df: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """Judge every text by the rules.

    Adds the counts of ``text_counts``, ``base_failed`` (under 50 words, or over half
    of them in repeated windows), ``failed_rules`` and ``kept``: neither of the two.
    Missing and empty texts have no words and so fail. Every row is judged by itself,
    so equal rows get equal answers and an empty table stays empty.
    """
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    added = {"base_failed", "failed_rules", "kept"}
    rest = text_counts(df.drop(*[c for c in df.columns if c.lower() in added]), text)
    return (
        rest.withColumn("base_failed", base)
        .withColumn("failed_rules", failures(rules))
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    )


def _sql_failures(rules) -> str:
    tests = []
    for rule in rules:
        per = "1" if rule.per == "one" else rule.per
        low = [f"1000 * {rule.count} < {rule.low} * {per}"] if rule.low is not None else []
        high = [f"1000 * {rule.count} > {rule.high} * {per}"] if rule.high is not None else []
        tests.append(f"CASE WHEN {' OR '.join(low + high)} THEN '{rule.name}' END")
    return f"list_filter([{', '.join(tests)}], lambda x: x IS NOT NULL)"


#: The registered query in DuckDB.
ORACLE_SQL = rf"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^{SPACES}]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^{SPACES}]')) AS l
  FROM documents),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM (
    SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
    FROM texts, unnest(range(1, len(w) - 1)) AS t(i))),
again AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM windows, unnest([0, 1, 2]) AS t(k) WHERE n > 1 GROUP BY doc_id),
counts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(len(l) AS BIGINT) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(again.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(list_filter(w, lambda x: list_contains({STOP_WORDS!r}, lower(x)))) AS BIGINT)
      AS n_stop_words,
    CAST(len(list_filter(l, lambda x: regexp_matches(x, '^[{SPACES}]*[-*\x{{2022}}]'))) AS BIGINT)
      AS n_bullet_lines,
    CAST(len(list_filter(l, lambda x: regexp_matches(x, '(?:\.\.\.|\x{{2026}})[{SPACES}]*$')))
      AS BIGINT) AS n_ellipsis_lines
  FROM texts LEFT JOIN again USING (doc_id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    array_to_string({_sql_failures(RULES)}, ',') AS failed_rules
  FROM counts)
SELECT *, NOT base_failed AND failed_rules = '' AS kept FROM judged
"""
