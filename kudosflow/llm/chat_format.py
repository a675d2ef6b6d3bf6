"""Chat formatting: records of many layouts become turns, and turns marked text.

A record is a JSON object. The paths of its nested fields, such as ``messages[].role``, as
far as some layout names them, are sorted and hashed. This fingerprint selects a layout, and
the layout declares which fields make which turns. Each optional field gives fingerprints of
its own; they are computed once from the table of layouts.

A turn is formatted by itself: marks of its role around its text. Control strings inside a
text get a backslash after their bracket, and so do those that have backslashes there, so
that taking one away gives the text back and no text can end its turn or begin another.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain, combinations
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kudosflow.llm.common import all_columns, fresh, lists, record_batch


class Fields(NamedTuple):
    """One turn of a role, its text the fields at the paths that have one, a blank line
    between them. There is no turn if none has one."""

    role: str
    paths: tuple[str, ...]


class Messages(NamedTuple):
    """A turn for each object of the list at a path, or for the record itself at ``""``."""

    path: str
    role: str
    text: str
    order: str | None = None


class Layout(NamedTuple):
    """``needed`` paths are in every record of the layout, ``optional`` ones in some."""

    name: str
    needed: tuple[str, ...]
    optional: tuple[str, ...]
    turns: tuple[Fields | Messages, ...]
    roles: dict[str, str] = {}


_SYSTEM = Fields("system", ("system",))
_SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

#: More layouts may be passed to ``canonical_turns``.
LAYOUTS = (
    Layout("turn", ("role", "text"), ("turn",), (Messages("", "role", "text", "turn"),)),
    Layout(
        "messages",
        ("messages[].role", "messages[].content"),
        ("system", "prompt"),  # some tables repeat the first message as prompt
        (_SYSTEM, Messages("messages", "role", "content")),
    ),
    Layout(
        "message parts",
        ("messages[].role", "messages[].content[].text"),
        ("messages[].content[].type", "messages[].content", "system"),
        (_SYSTEM, Messages("messages", "role", "content")),
    ),
    Layout(
        "speakers",
        ("conversations[].from", "conversations[].value"),
        ("system",),
        (_SYSTEM, Messages("conversations", "from", "value")),
        _SPEAKERS,
    ),
    Layout(
        "instruction",
        ("instruction", "output"),
        ("input", "system"),
        (_SYSTEM, Fields("user", ("instruction", "input")), Fields("assistant", ("output",))),
    ),
    Layout(
        "prompt and response",
        ("prompt", "response"),
        ("system",),
        (_SYSTEM, Fields("user", ("prompt",)), Fields("assistant", ("response",))),
    ),
    Layout(
        "prompt and completion",
        ("prompt", "completion"),
        ("system",),
        (_SYSTEM, Fields("user", ("prompt",)), Fields("assistant", ("completion",))),
    ),
    Layout(
        "question and answer",
        ("question", "answer"),
        ("context", "system"),
        (_SYSTEM, Fields("user", ("context", "question")), Fields("assistant", ("answer",))),
    ),
    Layout(
        "prompt and completion messages",
        ("prompt[].role", "prompt[].content", "completion[].role", "completion[].content"),
        ("system",),
        (_SYSTEM, Messages("prompt", "role", "content"), Messages("completion", "role", "content")),
    ),
    Layout(
        "data",
        ("data.messages[].role", "data.messages[].content"),
        ("data.system",),
        (Fields("system", ("data.system",)), Messages("data.messages", "role", "content")),
    ),
)


def field_paths(value: Any, at: str = "") -> Iterator[str]:
    """The paths of all fields without fields of their own; ``[]`` stands for any place."""
    if isinstance(value, dict) and value:
        for name, inner in value.items():
            yield from field_paths(inner, f"{at}.{name}" if at else name)
    elif isinstance(value, list) and value:
        for inner in value:
            yield from field_paths(inner, f"{at}[]")
    else:
        yield at


def fingerprint(paths: frozenset[str]) -> str:
    return hashlib.blake2b("\n".join(sorted(paths)).encode(), digest_size=8).hexdigest()


def by_fingerprint(layouts: tuple[Layout, ...]) -> dict[str, Layout]:
    """The layout of each fingerprint that some record of it may have; the first one that
    claims a fingerprint has it."""
    table: dict[str, Layout] = {}
    for layout in layouts:
        sizes = range(len(layout.optional) + 1)
        for more in chain.from_iterable(combinations(layout.optional, size) for size in sizes):
            table.setdefault(fingerprint(frozenset(layout.needed + more)), layout)
    return table


_HALF = re.compile("[\ud800-\udfff]")


def _field(value: Any, path: str) -> Any:
    for name in path.split(".") if path else ():
        value = value.get(name) if isinstance(value, dict) else None
    return value


def _text(value: Any) -> str:
    if isinstance(value, str):
        # JSON can spell half a character, which no text can hold.
        return _HALF.sub("\ufffd", value)
    if isinstance(value, list):
        return "".join(_text(part.get("text") if isinstance(part, dict) else part) for part in value)
    return "" if value is None else json.dumps(value, ensure_ascii=False)


def _place(value: Any, default: int) -> int | None:
    if value is None:
        return None
    whole = isinstance(value, int) and -(1 << 63) <= value < 1 << 63
    return int(value) if whole else default


class Layouts:
    """Finds the layouts of records."""

    def __init__(self, layouts: tuple[Layout, ...]) -> None:
        self.table = by_fingerprint(layouts)
        self.named = frozenset(path for one in layouts for path in one.needed + one.optional)
        self.known: dict[frozenset[str], str] = {}

    def turns(self, record: str | None) -> tuple[str | None, str | None, list[tuple]]:
        """Fingerprint, name of the layout, and number, role and text of each turn."""
        try:
            value = json.loads(record, strict=False) if record else None
        except (ValueError, RecursionError):
            value = None
        if not isinstance(value, dict):
            return None, None, []
        paths = self.named.intersection(field_paths(value))
        mark = self.known.get(paths)
        if mark is None:
            mark = self.known[paths] = fingerprint(paths)
        layout = self.table.get(mark)
        if layout is None:
            return mark, None, []
        out: list[tuple] = []
        for rule in layout.turns:
            if isinstance(rule, Fields):
                parts = [_text(part) for path in rule.paths if (part := _field(value, path))]
                needed = any(path in layout.needed for path in rule.paths)
                if parts or needed:
                    out.append((len(out), rule.role, "\n\n".join(parts)))
                continue
            found = _field(value, rule.path)
            for one in found if isinstance(found, list) else [found]:
                one = one if isinstance(one, dict) else {rule.text: one}
                place = _place(one.get(rule.order), len(out)) if rule.order else len(out)
                role = _text(one.get(rule.role))
                out.append((place, layout.roles.get(role, role), _text(one.get(rule.text))))
        return mark, layout.name, out


def as_records(df: DataFrame, fields: list[str], name: str = "record") -> DataFrame:
    """``df`` with the fields as one column of JSON instead; nulls are fields too."""
    record = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    others = [column for column in df.columns if column not in fields]
    return df.select(*all_columns(df.select(*others)), record.alias(name))


_TURNS = "fingerprint string, layout string, turn bigint, role string, text string"


def canonical_turns(
    records: DataFrame,
    key: str = "conv_id",
    record: str = "record",
    layouts: tuple[Layout, ...] = LAYOUTS,
) -> DataFrame:
    """``key``, ``fingerprint, layout, turn, role, text``: the turns of all records.

    A record without a layout, or that is no JSON object, gives one row whose ``layout``,
    ``turn``, ``role`` and ``text`` are null, so that none is lost. Fields that no layout names
    do not count. Null and missing roles and texts are empty; a list of parts is joined; other
    values are written as JSON. A record of a single turn has the number that it gives, null
    if that is null. Records are taken one by one, whole, and not moved; rows that repeat a
    key are records of their own, and an empty table gives an empty one.
    """
    kind = records.schema[key].dataType.simpleString()
    rows = records.select(F.col(key).alias("key"), F.col(record).cast("string").alias("record"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Layouts(layouts)
        for batch in batches:
            own = batch.schema.field("key").type
            for part in lists(iter([batch])):
                out = []
                for number, value in zip(part["key"], part["record"]):
                    mark, name, turns = finder.turns(value)
                    if name is None:
                        out.append((number, mark, None, None, None, None))
                    out += [(number, mark, name, *turn) for turn in turns]
                columns = list(zip(*out)) or [()] * 6
                yield record_batch(
                    key=(own, columns[0]),
                    fingerprint=(pa.string(), columns[1]),
                    layout=(pa.string(), columns[2]),
                    turn=(pa.int64(), columns[3]),
                    role=(pa.string(), columns[4]),
                    text=(pa.string(), columns[5]),
                )

    return rows.mapInArrow(find, f"key {kind}, {_TURNS}").withColumnRenamed("key", key)


#: What opens and closes the text of a role. No mark begins or ends with a sign that a
#: control string could go on with.
MARKS = {
    "system": ("<<SYS>> ", " <</SYS>>\n"),
    "user": ("[INST] ", " [/INST]\n"),
    "assistant": ("<s> ", " </s>\n"),
}
#: Any other role is written out.
OTHER = "[ROLE] ", " [TEXT] ", " [/ROLE]\n"

_CONTROL = r"(<<|<|\[)(\\*)(/?SYS>>|/?s>|/?INST\]|/?ROLE\]|TEXT\])"
_ESCAPED = re.compile(r"(<<|<|\[)\\(\\*)(/?SYS>>|/?s>|/?INST\]|/?ROLE\]|TEXT\])")
_TURN = re.compile(
    "|".join(
        [
            *(f"{re.escape(a)}(?P<{role}>.*?){re.escape(b)}" for role, (a, b) in MARKS.items()),
            "(?P<role>.*?)".join(map(re.escape, OTHER[:2])) + "(?P<text>.*?)" + re.escape(OTHER[2]),
        ]
    ),
    re.DOTALL,
)


def escaped(text: Column) -> Column:
    """The text with a backslash more in whatever looks like a control string."""
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def format_turns(turns: DataFrame) -> DataFrame:
    """``turns`` with ``formatted``, and where the loss mask lies in it: ``loss_start`` and
    ``loss_length`` in code points, null for all roles but the assistant's.

    Row by row with built-in functions; a conversation's text is that of its turns in order.
    Null roles and texts count as empty. Rows without a layout are formatted by no one: drop
    or mend them before. The table's own columns are kept, whatever their names; ``role`` and
    ``text`` are read.
    """
    role = F.coalesce("role", F.lit(""))
    text = escaped(F.coalesce("text", F.lit("")))
    marked = F.concat(F.lit(OTHER[0]), escaped(role), F.lit(OTHER[1]), text, F.lit(OTHER[2]))
    for name, (opened, closed) in MARKS.items():
        own = F.concat(F.lit(opened), text, F.lit(closed))
        marked = F.when(role == name, own).otherwise(marked)
    learned = role == "assistant"
    names = [fresh(turns, name) for name in ("formatted", "loss_start", "loss_length")]
    return turns.select(
        *all_columns(turns),
        marked.alias(names[0]),
        F.when(learned, F.lit(len(MARKS["assistant"][0]))).alias(names[1]),
        F.when(learned, F.length(text)).alias(names[2]),
    )


def parsed(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted text."""
    out, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if found is None:
            raise ValueError(f"no turn at {at}")
        if found["role"] is not None:
            out.append((unescaped(found["role"]), unescaped(found["text"])))
        else:
            out.append((found.lastgroup, unescaped(found[found.lastgroup])))
        at = found.end()
    return out


_DIGESTS = (
    "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint"
)


class _Digest:
    """What is said of one conversation, gathered turn by turn."""

    def __init__(self, key: Any) -> None:
        self.key, self.turns, self.chars, self.loss = key, 0, 0, 0
        self.all, self.learned = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start: int | None, length: int | None) -> None:
        for role, text in parsed(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        self.chars += len(formatted)
        if start is not None:
            learned = unescaped(formatted[start : start + length])
            self.loss += len(learned)
            self.learned.update(learned.encode())

    def row(self) -> tuple:
        digests = self.all.hexdigest(), self.learned.hexdigest()
        return self.key, self.turns, digests[0], self.loss, digests[1], self.chars


def read_back(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per conversation with what its formatted turns say when they are parsed.

    ``n_turns``; ``turns_sha256`` of role, line feed, text, line feed of each turn;
    ``loss_chars`` and ``loss_sha256`` of the texts under the loss mask; ``formatted_chars``.
    Turns come by ``turn``, null first, those with one number by their formatted text. Rows
    without a key are one conversation. A digest runs over a conversation from its first turn
    to its last, so a task meets all of them, but holds no more than a batch at a time.
    """
    kind = formatted.schema[key].dataType.simpleString()
    rows = formatted.select(F.col(key).alias("key"), "turn", "formatted", "loss_start", "loss_length")
    dealt = rows.repartition("key").sortWithinPartitions("key", "turn", "formatted")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, current, done = None, None, []

        def batch() -> pa.RecordBatch:
            key, turns, sha, loss, loss_sha, chars = zip(*done)
            return record_batch(
                key=(own, key),
                n_turns=(pa.int64(), turns),
                turns_sha256=(pa.string(), sha),
                loss_chars=(pa.int64(), loss),
                loss_sha256=(pa.string(), loss_sha),
                formatted_chars=(pa.int64(), chars),
            )

        for whole in batches:
            own = whole.schema.field("key").type
            for part in lists(iter([whole])):
                turns = zip(part["formatted"], part["loss_start"], part["loss_length"])
                for number, turn in zip(part["key"], turns):
                    if current is None or number != current.key:
                        done += [current.row()] if current else []
                        current = _Digest(number)
                    current.add(*turn)
                if len(done) >= 1_000:
                    yield batch()
                    done = []
        done += [current.row()] if current else []
        if done:
            yield batch()

    return dealt.mapInArrow(digest, f"key {kind}, {_DIGESTS}").withColumnRenamed("key", key)


ORACLE_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL
    SELECT -7, own.turn, own.role, '</s>[INST] ok [/INST]'
    FROM (VALUES (0, 'user'), (1, 'assistant')) AS own(turn, role)
),
escaped AS (
    SELECT *,
        regexp_replace(
            text, '(<<|<|\[)(\\*)(/?SYS>>|/?s>|/?INST\]|/?ROLE\]|TEXT\])', '\1\\\2\3', 'g'
        ) AS e,
        regexp_replace(
            role, '(<<|<|\[)(\\*)(/?SYS>>|/?s>|/?INST\]|/?ROLE\]|TEXT\])', '\1\\\2\3', 'g'
        ) AS r
    FROM turns
),
formatted AS (
    SELECT *,
        CASE role
            WHEN 'system' THEN '<<SYS>> ' || e || ' <</SYS>>' || chr(10)
            WHEN 'user' THEN '[INST] ' || e || ' [/INST]' || chr(10)
            WHEN 'assistant' THEN '<s> ' || e || ' </s>' || chr(10)
            ELSE '[ROLE] ' || r || ' [TEXT] ' || e || ' [/ROLE]' || chr(10)
        END AS formatted,
        CASE WHEN role = 'assistant' THEN text ELSE '' END AS learned
    FROM escaped
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(
        role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, formatted
    )) AS turns_sha256,
    sum(length(learned))::BIGINT AS loss_chars,
    sha256(string_agg(learned, '' ORDER BY turn NULLS FIRST, formatted)) AS loss_sha256,
    sum(length(formatted))::BIGINT AS formatted_chars
FROM formatted
GROUP BY conv_id
"""
