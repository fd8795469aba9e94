"""Chat records of many layouts to one formatted text with a loss mask.

A record is a JSON object.  Its schema fingerprint is a hash of the sorted paths of its
fields (``a.b``, ``a[].b``; the type of the value at the end), and a table from
fingerprints to declarative mappings says where prompts, instructions or messages stand.
So a new layout is a new row of ``LAYOUTS``, not code.  Fields that begin with a name no
layout uses (``id``, ``source`` and the like) and null ones do not count; a layout has a
fingerprint for each choice of its optional fields.  Records whose fingerprint has no
mapping are returned as such, with their fingerprint.

The template is ``<|im_start|>role NEWLINE text<|im_end|> NEWLINE``.  In a text every ``<``
with any number of backslashes and ``|`` after it gets one backslash more, which can be
taken back exactly; so no text holds a control string.  Every assistant text is in the
loss mask, as offsets of its escaped form.

Long conversations go through in parts of at most ``PART_TURNS`` turns, cut by turn number,
so no task holds a whole one; only the digests of ``read_back`` take one in order.
Conversations are named by whole numbers.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from .common import materialize

START, END = "<|im_start|>", "<|im_end|>\n"
PART_TURNS = 64
#: Turns from which a conversation is numbered over several tasks.
LONG_CONVERSATION = 1 << 13
#: Rows of a batch that goes back to Spark.
_ROWS = 512

Turn = tuple[str, str]


@dataclass(frozen=True)
class Layout:
    """``paths``: fields that a record has, with their types; ``extra``: those it may have.
    ``fields``: (role, path) of single texts, in order; empty optional ones give no turn.
    ``turns``: path of a list whose items have a role at ``role`` and a text at ``text``."""

    paths: tuple[str, ...]
    fields: tuple[tuple[str, str], ...] = ()
    extra: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    turns: str = ""
    role: str = ""
    text: str = ""
    roles: tuple[tuple[str, str], ...] = ()  # names of roles that differ


#: Layouts in public use, told apart by the paths of their fields.
LAYOUTS = {
    "prompt": Layout(("completion:str", "prompt:str"), (("user", "prompt"), ("assistant", "completion"))),
    "instruction": Layout(
        ("instruction:str", "output:str"), (("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")),
        ("input:str", "system:str"), ("input", "system")),
    "question": Layout(
        ("question:str", "response:str"), (("system", "system_prompt"), ("user", "question"), ("assistant", "response")),
        ("system_prompt:str",), ("system_prompt",)),
    "messages": Layout(("messages[].content:str", "messages[].role:str"), extra=("messages[].name:str",), turns="messages", role="role", text="content"),
    "shares": Layout(
        ("conversations[].from:str", "conversations[].value:str"), extra=("system:str",), turns="conversations", role="from", text="value",
        roles=(("human", "user"), ("gpt", "assistant"))),
    "dialogue": Layout(
        ("dialogue.turns[].message.text:str", "dialogue.turns[].speaker:str"), extra=("dialogue.id:str", "dialogue.id:int"), turns="dialogue.turns", role="speaker",
        text="message.text"),
}
#: Names a layout's fields begin with; other fields of a record are no part of its layout.
ROOTS = {re.split(r"[.:\[]", path)[0] for layout in LAYOUTS.values() for path in (*layout.paths, *layout.extra)}


def field_paths(value, path: str = "") -> set[str]:
    """Paths of all values with their types; items of a list count as one, null is no value."""
    if value is None:
        return set()
    if isinstance(value, dict) and value:
        return set().union(*(field_paths(x, f"{path}.{name}" if path else name) for name, x in value.items()))
    if isinstance(value, list) and value:
        return set().union(*(field_paths(x, f"{path}[]") for x in value))
    return {f"{path}:{type(value).__name__}"}


def fingerprint(paths) -> str:
    return hashlib.sha1("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def record_fingerprint(record: dict) -> str:
    return fingerprint(field_paths({name: x for name, x in record.items() if name in ROOTS}))


#: Every layout under the fingerprint of each choice of its extra fields.
BY_FINGERPRINT = {
    fingerprint((*layout.paths, *some)): layout
    for layout in LAYOUTS.values() for n in range(len(layout.extra) + 1) for some in itertools.combinations(layout.extra, n)
}


def _at(value, path: str):
    """The value at a path; '' where an item of a list lacks it."""
    for name in path.split("."):
        value = (value or {}).get(name)
    return "" if value is None else value


def turns_of(record: dict, layout: Layout) -> list[Turn]:
    """Canonical turns of a record of the layout."""
    if layout.turns:
        names = dict(layout.roles)
        before = [("system", record["system"])] if record.get("system") and "system:str" in layout.extra else []
        return before + [(names.get(_at(x, layout.role), _at(x, layout.role)), _at(x, layout.text)) for x in _at(record, layout.turns)]
    texts = [(role, path, _at(record, path)) for role, path in layout.fields]
    return [(role, text) for role, path, text in texts if text or path not in layout.optional]


def record_of(turns: list[Turn], name: str) -> dict:
    """The turns in the layout of that name (the reverse of ``turns_of``)."""
    layout = LAYOUTS[name]
    out: dict = {}

    def put(target: dict, path: str, value) -> None:
        *above, last = path.split(".")
        for x in above:
            target = target.setdefault(x, {})
        target[last] = value

    if layout.turns:
        names = {own: role for role, own in layout.roles}
        items: list[dict] = []
        for role, text in turns:
            items.append({})
            put(items[-1], layout.role, names.get(role, role))
            put(items[-1], layout.text, text)
        put(out, layout.turns, items)
        return out
    rest = list(turns)
    for role, path in layout.fields:
        given = rest and rest[0][0] == role and (path not in layout.optional or path in ("system", "system_prompt"))
        put(out, path, rest.pop(0)[1] if given else "")
    return out


def fitting(turns: list[Turn], whole: bool) -> list[str]:
    """Layouts that hold these turns without loss, if they are a ``whole`` conversation."""
    roles = [r for r, _ in turns]
    lists = ["messages", "dialogue"] + ["shares"] * (not {"human", "gpt"} & set(roles))
    if whole and roles == ["user", "assistant"]:
        return lists + ["prompt", "instruction"]
    if whole and roles == ["system", "user", "assistant"] and turns[0][1]:
        return lists + ["question", "instruction"]
    return lists


# In Java and Python alike: a text is changed only where it could be read as a mark.
_MARK, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<(\\*)\\\|")


def escape(text: str) -> str:
    return _MARK.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def formatted(turns: list[Turn]) -> tuple[str, list[tuple[int, int]]]:
    """The text of the turns and the spans of the assistant's."""
    parts, spans, size = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role).replace(chr(92), chr(92) * 2).replace(chr(10), chr(92) + 'n')}\n", escape(text)
        if role == "assistant":
            spans.append((size + len(head), size + len(head) + len(body)))
        parts += [head, body, END]
        size += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parsed(text: str) -> list[Turn]:
    """The turns of a formatted text."""
    out = []
    for part in text.split(START)[1:]:
        role, body = part.split("\n", 1)
        if not body.endswith(END):
            raise ValueError("a turn has no end")
        plain = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role)
        out.append((unescape(plain), unescape(body[: -len(END)])))
    return out


def _stream(df: DataFrame, make: Callable[[dict], tuple | None], fields: list[tuple[str, pa.DataType]], schema: str) -> DataFrame:
    """A function of single rows, in batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                rows = [make(x) for x in batch.slice(at, _ROWS).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, (_, kind) in zip(zip(*rows), fields)], names=[n for n, _ in fields])

    return df.mapInArrow(run, schema)


def to_records(turns: DataFrame) -> DataFrame:
    """Rows by turn (``conv_id, turn, role, text``) to JSON records of mixed layouts.

    Turns are ordered by number (null first), role and text; a null role or text is empty.
    Rows without a conversation are one of their own; repeated rows are turns each.  Turns
    are numbered first, over several tasks in a long conversation, and meet by part.
    """

    def make(row: dict) -> tuple:
        held = [(x["role"], x["text"]) for x in row["turns"]]
        options = fitting(held, row["part"] == 0 and len(held) < PART_TURNS)
        pick = int.from_bytes(hashlib.sha1(f"{row['conv_id']}/{row['part']}".encode()).digest()[:4], "little") % len(options)
        return row["conv_id"], row["part"], json.dumps(record_of(held, options[pick]), ensure_ascii=False)

    empty = F.lit("")
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    rows = number_rows(rows, ["turn", "role", "text"], ["conv_id"], "no", hot_rows=LONG_CONVERSATION)
    parts = rows.groupBy("conv_id", F.floor((F.col("no") - 1) / PART_TURNS).cast("int").alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("no", "role", "text"))).alias("turns"))
    fields = [("conv_id", pa.int64()), ("part", pa.int32()), ("record", pa.string())]
    return _stream(parts, make, fields, "conv_id bigint, part int, record string")


_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_SPANS = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))


def canonical(records: DataFrame) -> DataFrame:
    """``conv_id, part, fingerprint, turns`` of records (``conv_id, part, record``).

    ``turns`` is null where the fingerprint has no mapping or the record is no JSON object
    (then the fingerprint is null too).
    """

    def make(row: dict) -> tuple:
        try:
            record = json.loads(row["record"] or "")
        except ValueError:
            record = None
        if not isinstance(record, dict):
            return row["conv_id"], row["part"], None, None
        key = record_fingerprint(record)
        layout = BY_FINGERPRINT.get(key)
        turns = None if layout is None else [{"role": r, "text": t} for r, t in turns_of(record, layout)]
        return row["conv_id"], row["part"], key, turns

    fields = [("conv_id", pa.int64()), ("part", pa.int32()), ("fingerprint", pa.string()), ("turns", _TURNS)]
    return _stream(records, make, fields, "conv_id bigint, part int, fingerprint string, turns array<struct<role:string,text:string>>")


def to_text(turns: DataFrame) -> DataFrame:
    """``conv_id, part, fingerprint, formatted, loss`` of canonical turns; the last two are
    null where there are no turns, so no record is lost."""

    def make(row: dict) -> tuple:
        if row["turns"] is None:
            return row["conv_id"], row["part"], row["fingerprint"], None, None
        text, spans = formatted([(x["role"], x["text"]) for x in row["turns"]])
        return row["conv_id"], row["part"], row["fingerprint"], text, [{"from": a, "to": b} for a, b in spans]

    fields = [("conv_id", pa.int64()), ("part", pa.int32()), ("fingerprint", pa.string()), ("formatted", pa.string()), ("loss", _SPANS)]
    return _stream(turns, make, fields, "conv_id bigint, part int, fingerprint string, formatted string, loss array<struct<from:bigint,to:bigint>>")


def format_records(records: DataFrame) -> DataFrame:
    """Records of any layout (``conv_id, part, record``) to formatted text, a row each;
    those without a mapping keep their fingerprint and have no text."""
    return to_text(canonical(records))


def read_back(output: DataFrame) -> DataFrame:
    """One row per conversation from the formatted parts, read in order: ``conv_id``,
    ``n_turns``, digests of its turns and of the text under the mask, and sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        rows: list[tuple] = []
        state = None
        batch_of = lambda: pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)

        def close() -> None:
            if state:
                conv, n, turns, chars, loss, size = state
                rows.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size))

        for batch in batches:
            for row in batch.to_pylist():
                if state is None or state[0] != row["conv_id"]:
                    close()
                    state = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                    if len(rows) >= _ROWS:
                        yield batch_of()
                        rows.clear()
                text = row["formatted"]
                for role, said in parsed(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                for span in row["loss"]:
                    said = unescape(text[span["from"] : span["to"]])
                    state[3] += len(said)
                    state[4].update(said.encode())
                state[5] += len(text)
        close()
        if rows:
            yield batch_of()

    ordered = output.where("formatted is not null").select("conv_id", "part", "formatted", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return ordered.mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def format_conversations(turns: DataFrame) -> DataFrame:
    """Rows by turn to written, formatted parts (``conv_id, part, fingerprint, formatted, loss``)."""
    return materialize(format_records(to_records(turns)), "chat")
