"""Chat formatting: layouts found by fingerprint, canonical turns, a reversible template.

A fingerprint is the hash of nested field paths: of the largest set of paths of a layout
that a table (or one JSON record) has. It selects a declarative mapping to canonical
turns (conversation, turn, role, text). Turns are rendered with control strings that
can't occur in a rendered text: their first characters are escaped there, reversibly.
Turns are dealt out by ranges of (conversation, turn), so a conversation that holds any
share of all rows is rendered by several tasks, in segments of bounded size.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspark.llm.common import text_of

OPEN, HEAD, CLOSE = "<|turn|>", "<|text|>", "<|end|>"
SEGMENT_CHARS = 1 << 20
_TURN = re.compile(re.escape(OPEN) + r"([^<]*)" + re.escape(HEAD) + r"([^<]*)" + re.escape(CLOSE))
_ESCAPES = {"\\": "\\\\", "<": "\\l", "[": "\\b"}
_BACK = {"\\\\": "\\", "\\l": "<", "\\b": "["}
#: Roles of other layouts and the canonical ones.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def escape(text: str) -> str:
    """text without any character that starts a control string (of this or of common other templates)."""
    return re.sub(r"[\\<\[]", lambda m: _ESCAPES[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\[\\lb]", lambda m: _BACK[m[0]], text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn, and where its text stands in it."""
    head = OPEN + escape(role) + HEAD
    body = escape(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of rendered text."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


# Layouts


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def field_paths(kind: T.DataType, path: str = "") -> Iterator[str]:
    """Paths of the leaves of a schema; [] stands for an array's elements."""
    if isinstance(kind, T.StructType):
        for field in kind:
            yield from field_paths(field.dataType, f"{path}.{field.name}" if path else field.name)
    elif isinstance(kind, T.ArrayType):
        yield from field_paths(kind.elementType, path + "[]")
    else:
        yield path


def _turn(role: str | Column, text: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    canonical = F.coalesce(F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])[role], role, F.lit(""))
    return F.struct(canonical.alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _said(*turns: tuple[str, str]):
    return lambda of: F.array(*[_turn(role, of(path)) for role, path in turns])


def _one_row(of) -> Column:
    """A table with a row for each turn: roles as they are, numbered by the turn."""
    text = lambda path: F.coalesce(of(path).cast("string"), F.lit(""))
    return F.array(F.struct(text("role").alias("role"), text("text").alias("text")))


def _listed(path: str, role: str, text: str):
    return lambda of: F.transform(of(path), lambda x: _turn(x[role], x[text]))


def _instructed(of) -> Column:
    given = F.when(F.coalesce(of("input"), F.lit("")) == "", of("instruction")).otherwise(F.concat(F.coalesce(of("instruction"), F.lit("")), F.lit("\n\n"), of("input")))
    return F.array(_turn("user", given), _turn("assistant", of("output")))


#: Paths of a layout to the mapping that makes its turns, the larger ones first; of equal ones the first counts.
_LAYOUTS = {
    ("turn", "role", "text"): _one_row,
    ("instruction", "input", "output"): _instructed,
    ("messages[].role", "messages[].content"): _listed("messages", "role", "content"),
    ("conversations[].from", "conversations[].value"): _listed("conversations", "from", "value"),
    ("instruction", "output"): _said(("user", "instruction"), ("assistant", "output")),
    ("prompt", "response"): _said(("user", "prompt"), ("assistant", "response")),
    ("prompt", "completion"): _said(("user", "prompt"), ("assistant", "completion")),
    ("question", "answer"): _said(("user", "question"), ("assistant", "answer")),
}
TURN_ROWS = fingerprint(("turn", "role", "text"))
#: A system prompt may come with any of them but the first.
LAYOUTS = {fingerprint([*paths, *more]): (mapping, bool(more)) for paths, mapping in _LAYOUTS.items() for more in ((), ("system",)) if not (more and mapping is _one_row)}
PATHS = sorted({path for paths in _LAYOUTS for path in paths} | {"system"})


def chosen(paths: set[str]) -> str | None:
    """The fingerprint of the largest layout whose paths are all there; None if there is none."""
    for known, mapping in _LAYOUTS.items():
        if paths.issuperset(known):
            return fingerprint([*known, "system"] if "system" in paths and mapping is not _one_row else known)
    return None


_JSON = "messages array<struct<role:string,content:string>>, conversations array<struct<`from`:string,value:string>>, instruction string, input string, output string, prompt string, response string, completion string, question string, answer string, system string, turn long, role string, text string"


def _mapped(print_of: str, of) -> Column:
    mapping, system = LAYOUTS[print_of]
    return F.concat(F.array(_turn("system", of("system"))), mapping(of)) if system else mapping(of)


def _rows(df: DataFrame) -> DataFrame:
    """Turns one by one; number: that of a table with a row for each, else turns are numbered as they stand."""
    told = df.select("conv", "number", "turn_rows", F.posexplode("turns").alias("turn", "said"))
    turn = F.when(F.col("turn_rows"), F.col("number")).otherwise(F.col("turn").cast("long"))
    return told.select("conv", turn.alias("turn"), "said.role", "said.text")


def canonical_turns(df: DataFrame, *, id_col: str = "conv_id") -> DataFrame:
    """(conv, turn, role, text) of a table in any known layout, which the fingerprint of its schema selects.

    Of several layouts the largest counts; columns that it doesn't use are passed over,
    whatever their names. A null text or role becomes empty, a null turn stays null (and
    comes first), null messages have no turns; a table of unknown layout fails.
    """
    paths = set(field_paths(df.schema)) & set(PATHS)
    found = chosen(paths)
    if found is None:
        raise ValueError(f"no layout with the fields {sorted(paths)}")
    number = df["turn"].cast("long") if found == TURN_ROWS else F.lit(None).cast("long")
    return _rows(df.select(df[id_col].alias("conv"), number.alias("number"), F.lit(found == TURN_ROWS).alias("turn_rows"), _mapped(found, lambda path: df[path]).alias("turns")))


def canonical_turns_of_json(df: DataFrame, *, id_col: str = "conv_id", json_col: str = "record") -> tuple[DataFrame, DataFrame]:
    """Turns as canonical_turns(), of records that each have a layout of their own, and (conv, fingerprint) of the rest.

    A field counts as there if it isn't null. Records of no known layout, broken or null ones are in the rest, none is lost.
    """
    parsed = df.select(df[id_col].alias("conv"), F.from_json(df[json_col], _JSON).alias("r"))

    def there(path: str) -> Column:
        if "[]" in path:
            list_name, field = path.split("[].")
            return F.exists(F.col(f"r.{list_name}"), lambda x: x[field].isNotNull())
        return F.col(f"r.{path}").isNotNull()

    present = {path: there(path) for path in PATHS}
    told = F.sha2(F.array_join(F.array_compact(F.array(*[F.when(present[p], F.lit(p)) for p in PATHS])), "\n"), 256)
    for known, mapping in reversed(_LAYOUTS.items()):
        every = reduce(and_, [present[p] for p in known])
        alone, prompted = fingerprint(known), fingerprint([*known, "system"])
        told = F.when(every, F.when(present["system"], F.lit(prompted)).otherwise(F.lit(alone)) if mapping is not _one_row else F.lit(alone)).otherwise(told)
    printed = parsed.withColumn("fingerprint", told)
    turns = F.lit(None)
    for known in LAYOUTS:
        turns = F.when(F.col("fingerprint") == known, _mapped(known, lambda path: F.col(f"r.{path}"))).otherwise(turns)
    known = F.coalesce(F.col("fingerprint").isin(*LAYOUTS), F.lit(False))
    number = F.col("r.turn").alias("number"), (F.col("fingerprint") == TURN_ROWS).alias("turn_rows")
    return _rows(printed.filter(known).select("conv", *number, turns.alias("turns"))), printed.filter(~known).select("conv", "fingerprint")


# Rendering


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv, segment, formatted, loss) of canonical turns: segments of whole turns.

    loss: [start, stop) of assistant texts in that segment, in code points. Turns go by
    turn, then role, then text (so ties and repeated rows have one order, nulls first); a
    null conversation is one of its own. An empty table gives no rows. Ordered by segment,
    a conversation's segments are its text; their numbers grow, but may leave some out. A
    segment has SEGMENT_CHARS at least, but for the last one of a task.
    """
    kind = turns.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, conv, size = TaskContext.get().partitionId() << 32, None, 0  # tasks follow each other
        parts: list[str] = []
        loss: list[dict[str, int]] = []

        def flush() -> pa.RecordBatch:
            spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            out = pa.record_batch([pa.array([conv], conv_type), pa.array([number], pa.int64()), pa.array(["".join(parts)], pa.string()), pa.array([loss], spans)], ["conv", "segment", "formatted", "loss"])
            parts.clear()
            loss.clear()
            return out

        for batch in batches:
            conv_type = batch.schema.field(0).type
            for key, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if parts and (key != conv or size >= SEGMENT_CHARS):
                    yield flush()
                    number, size = number + 1, 0
                conv = key
                said, start, stop = render(role, text)
                if role == "assistant":
                    loss.append({"start": size + start, "stop": size + stop})
                parts.append(said)
                size += len(said)
        if parts:
            yield flush()

    order = ("conv", "turn", "role", "text")
    return turns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, f"conv {kind}, segment long, formatted string, loss array<struct<start:long,stop:long>>")


def read_back(segments: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id_col, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) out of the segments of format_turns().

    Segments may come in any order. A digest of a whole conversation has to be made in
    one task; it streams over the sorted segments there and holds one at a time.
    """
    kind = segments.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = []
        state = None

        def ended(conv, turns, said, masked, chars, formatted) -> None:
            rows.append([conv, turns, said.hexdigest(), chars, masked.hexdigest(), formatted])

        def out() -> pa.RecordBatch:
            columns = [*zip(*rows)]
            rows.clear()
            return pa.record_batch([pa.array(columns[0], conv_type), *[pa.array(c) for c in columns[1:]]], [id_col, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            conv_type = batch.schema.field(0).type
            for conv, _, formatted, loss in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or state[0] != conv:
                    if state:
                        ended(*state)
                    state = [conv, 0, hashlib.sha256(), hashlib.sha256(), 0, 0]
                for role, text in parse(formatted):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                for span in loss:
                    text = unescape(formatted[span["start"] : span["stop"]])
                    state[4] += len(text)
                    state[3].update(text.encode())
                state[5] += len(formatted)
            if rows:
                yield out()
        if state:
            ended(*state)
            yield out()

    ordered = segments.select("conv", "segment", "formatted", "loss").repartition("conv").sortWithinPartitions("conv", "segment")
    return ordered.mapInArrow(run, f"`{id_col}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
