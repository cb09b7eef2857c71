r"""Chat formatting by schema fingerprint.

A record's nested field paths, sorted and hashed, are its fingerprint. It
selects a declarative mapping that lists where the turns are, so records of
several layouts (message lists, from/value lists, prompt/completion,
instruction/input/output, row per turn) become the same canonical turns. The
template then writes turns as
``<s>[INST] ... [/INST] ... </s>`` blocks with a role line each, and escapes
control strings inside texts so that they can be read back:

    turn:   ``<s>`` role ``[INST]`` text ``[/INST]`` or, for an assistant,
            ``<s>`` role ``[/INST]`` text ``</s>``, each with a line feed after it
    escape: ``\`` becomes ``\\``; the first character of a control string becomes
            ``\l`` for ``<`` and ``\b`` for ``[``

Turns stay rows until the digest: a conversation's rows are sorted within a
partition and hashed as they pass, so no conversation is ever held whole, and a
conversation with very many turns needs no more memory than a short one.

Defined results: null texts and roles are empty; turns of equal number
are ordered by their formatted text, assistant turns last; rows that repeat are turns of their own; rows with a
null conversation id form one conversation with a null id; an empty table
gives no rows. Texts in a record that are no strings are written as JSON, lists
of parts joined by line feeds, and list elements that are no objects become
turns without a role; records that are no JSON object, or fit no layout, give no
turns. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import slices, small_batches

#: The template's control strings.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: Other names of roles; a row of role and text has its role as it is.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}

#: Declarative mappings: field paths that a layout has -> where its turns are.
#: ``each`` walks a list; ``turns`` lists (role, field) pairs, joined where several share a role.
LAYOUTS: tuple[tuple[frozenset, dict], ...] = (
    (frozenset({"messages[].role", "messages[].content"}), {"each": "messages", "role": "role", "text": "content"}),
    (frozenset({"messages[].role", "messages[].content[].text"}), {"each": "messages", "role": "role", "text": "content"}),
    (frozenset({"conversations[].from", "conversations[].value"}), {"each": "conversations", "role": "from", "text": "value"}),
    (frozenset({"turns[].role", "turns[].text"}), {"each": "turns", "role": "role", "text": "text"}),
    (frozenset({"role", "text"}), {"turns": ((("role",), ("text",)),), "plain": True}),
    (frozenset({"role", "content"}), {"turns": ((("role",), ("content",)),)}),
    (frozenset({"instruction", "input", "output"}), {"turns": (("user", ("instruction", "input")), ("assistant", ("output",)))}),
    (frozenset({"instruction", "output"}), {"turns": (("user", ("instruction",)), ("assistant", ("output",)))}),
    (frozenset({"instruction", "response"}), {"turns": (("user", ("instruction",)), ("assistant", ("response",)))}),
    (frozenset({"system", "prompt", "completion"}), {"turns": (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))}),
    (frozenset({"prompt", "completion"}), {"turns": (("user", ("prompt",)), ("assistant", ("completion",)))}),
    (frozenset({"prompt", "response"}), {"turns": (("user", ("prompt",)), ("assistant", ("response",)))}),
    (frozenset({"question", "answer"}), {"turns": (("user", ("question",)), ("assistant", ("answer",)))}),
)


def field_paths(value: object, prefix: str = "") -> set[str]:
    """Paths of the leaves of nested data; list elements share one path."""
    if isinstance(value, dict):
        return set().union(*(field_paths(v, f"{prefix}.{k}" if prefix else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union(*(field_paths(v, f"{prefix}[]") for v in value))
    return {prefix}


def fingerprint(paths: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


class Mappings(dict):
    """Fingerprint -> mapping; one with unlisted extra fields takes the largest layout it holds."""

    def __init__(self):
        super().__init__({fingerprint(p): m for p, m in LAYOUTS})

    def of(self, record: dict) -> dict | None:
        paths = field_paths(record)
        key = fingerprint(paths)
        if key not in self:
            inside = [(len(p), m) for p, m in LAYOUTS if p <= paths]
            self[key] = max(inside, key=lambda x: x[0])[1] if inside else None
        return self[key]


def role_of(name: object) -> str:
    name = "" if name is None else str(name)
    return ROLES.get(name, name)


def written(value: object) -> str:
    """A text; null is empty, lists and objects of text parts are joined, any other value is written as JSON."""
    if value is None:
        return ""
    if isinstance(value, str):
        return value
    if isinstance(value, list):
        return "\n".join(t for v in value if (t := written(v)))
    if isinstance(value, dict) and isinstance(value.get("text"), str):
        return value["text"]
    return json.dumps(value, ensure_ascii=False, sort_keys=True)


def canonical_turns(record: dict, mappings: Mappings) -> list[tuple[str, str]] | None:
    """(role, text) turns of a record; None where no mapping fits its fields."""
    mapping = mappings.of(record)
    if mapping is None:
        return None
    if "each" in mapping:
        each = record[mapping["each"]]
        each = each if isinstance(each, list) else [each]
        # what isn't an object is said by nobody
        return [(role_of(m.get(mapping["role"])), written(m.get(mapping["text"]))) if isinstance(m, dict) else ("", written(m)) for m in each if m is not None]
    turns = []
    for role, fields in mapping["turns"]:
        text = "\n".join(t for f in fields if (t := written(record.get(f))))
        named = record.get(role[0]) if isinstance(role, tuple) else role
        turns.append((written(named) if mapping.get("plain") else role_of(named), text))
    return turns


_CONTROL = re.compile("|".join(map(re.escape, sorted(CONTROL, key=len, reverse=True))) + r"|\\")
_ESCAPED = re.compile(r"\\([\\lb])")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: {"\\": "\\\\", "<": "\\l", "[": "\\b"}[m[0][0]] + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: {"\\": "\\", "l": "<", "b": "["}[m[1]], text)


def format_turn(role: str, text: str) -> str:
    """One turn as the template writes it."""
    if role == "assistant":
        return f"<s>{escape(role)}[/INST]{escape(text)}</s>\n"
    return f"<s>{escape(role)}[INST]{escape(text)}[/INST]\n"


def loss_span(formatted: str) -> tuple[int, int]:
    """Where the loss mask is set in a formatted turn; (0, 0) outside assistant turns."""
    if formatted.startswith("<s>assistant[/INST]"):
        return len("<s>assistant[/INST]"), len(formatted) - len("</s>\n")
    return 0, 0


_TURN = re.compile(r"<s>((?:(?!\[/?INST\]).)*)(?:\[INST\](.*)\[/INST\]|\[/INST\](.*)</s>)\n", re.S)


def read_turn(formatted: str) -> tuple[str, str]:
    """The role and text that format_turn was given."""
    m = _TURN.fullmatch(formatted)
    return unescape(m[1]), unescape(m[2] if m[2] is not None else m[3])


TURNS = "conv_id long, turn long, formatted string, loss_start int, loss_end int"


def format_records(records: DataFrame, conv_id: str, turn: str, body: Column) -> DataFrame:
    """Formatted turns of JSON records: conv_id, turn, formatted, loss_start, loss_end.

    body: the record as a JSON string. A record of several turns numbers them
    from its own turn number on.
    """
    small_batches(records.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mappings = Mappings()
        for batch in slices(batches):
            rows: tuple[list, ...] = ([], [], [], [], [])
            for conv, at, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                try:
                    record = json.loads(text or "null")
                except ValueError:
                    record = None
                turns = canonical_turns(record, mappings) if isinstance(record, dict) else None
                for k, (role, said) in enumerate(turns or ()):
                    formatted = format_turn(role, said)
                    for out, value in zip(rows, (conv, None if at is None else at + k, formatted, *loss_span(formatted)), strict=True):
                        out.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32()), strict=True)], ["conv_id", "turn", "formatted", "loss_start", "loss_end"])

    picked = records.select(F.col(conv_id).cast("long"), F.col(turn).cast("long"), body)
    return picked.mapInArrow(run, TURNS)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation what is read back from its formatted turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: object = run  # no conversation yet
        n = loss = chars = 0
        all_turns, all_loss = hashlib.sha256(), hashlib.sha256()
        done: list[tuple] = []

        def emit() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [x.split()[0] for x in DIGESTS.split(", ")])
            done.clear()
            return out

        for batch in slices(batches):
            for conv, formatted, start, end in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end")), strict=True):
                if conv != key or key is run:
                    if key is not run:
                        done.append((key, n, all_turns.hexdigest(), loss, all_loss.hexdigest(), chars))
                    key, n, loss, chars = conv, 0, 0, 0
                    all_turns, all_loss = hashlib.sha256(), hashlib.sha256()
                role, text = read_turn(formatted)
                n += 1
                chars += len(formatted)
                all_turns.update(f"{role}\n{text}\n".encode())
                if end:
                    learned = unescape(formatted[start:end])
                    loss += len(learned)
                    all_loss.update(learned.encode())
            if done:
                yield emit()
        if key is not run:
            done.append((key, n, all_turns.hexdigest(), loss, all_loss.hexdigest(), chars))
            yield emit()

    ordered = turns.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "order_role", "order_text")
    return ordered.select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(run, DIGESTS)


def format_conversations(rows: DataFrame) -> DataFrame:
    """The digests of a table of turns (conv_id, turn, role, text)."""
    text, role = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("role"), F.lit(""))
    body = F.to_json(F.struct(role.alias("role"), text.alias("text")))
    turns = format_records(rows.select("conv_id", "turn", "role", "text"), "conv_id", "turn", body)
    return digests(turns.withColumns({"order_role": F.col("loss_end") > 0, "order_text": F.col("formatted")}))
