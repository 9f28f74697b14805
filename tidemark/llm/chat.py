"""Chat formatting with a grammar round trip.

    conversation := "<s>" turn*
    turn := "[INST] " body " [/INST]"            user
          | "<<SYS>> " body " <</SYS>>"          system
          | "[OUT] " body "</s>"                 assistant
          | "[ROLE] " body " [IS] " body " [/ROLE]"   any other role, named first

A backslash makes the next character plain text.  Each turn is rendered, reparsed by the deterministic parser and
compared with its source; what differs is rendered again with more of its text escaped (control strings first, then every
bracket) until role and text come back as they were.  A turn's segment is parsed the same way wherever it stands, so a
conversation is the concatenation of its segments and turns are rendered in parallel.

The loss mask is the body of assistant turns, as a span of code points of the segment.

Null texts and roles are empty; a null turn number comes first; rows that repeat conversation and turn are all kept,
ordered by role and text; a null conversation id is a conversation of its own; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAD = "<s>"
#: Opening and closing of the roles that have their own.
MARKS = {"user": ("[INST] ", " [/INST]"), "system": ("<<SYS>> ", " <</SYS>>"), "assistant": ("[OUT] ", "</s>")}
OTHER_OPEN, OTHER_NAMED, OTHER_CLOSE = "[ROLE] ", " [IS] ", " [/ROLE]"
CONTROLS = ("[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[OUT]", "[ROLE]", "[IS]", "[/ROLE]", "<s>", "</s>")
LOSS_ROLE = "assistant"
ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escaped(text: str, level: int) -> str:
    """Level 0: as it is; 1: backslashes and control strings; 2: backslashes, brackets and blanks."""
    if level == 0:
        return text
    text = text.replace("\\", "\\\\")
    if level == 1:
        for control in CONTROLS:
            text = text.replace(control, "\\" + control)
        return text
    return re.sub(r"([\[\]<> ])", r"\\\1", text)


def plain(text: str) -> str:
    return ESCAPED.sub(r"\1", text) if "\\" in text else text


def _until(text: str, start: int, mark: str) -> int:
    """Where ``mark`` begins next outside an escape; -1 if it does not."""
    at = text.find(mark, start)
    while at >= 0:
        back = at
        while back > start and text[back - 1] == "\\":
            back -= 1
        if (at - back) % 2 == 0:
            return at
        at = text.find(mark, at + 1)
    return -1


def parse_turn(text: str, at: int = 0) -> tuple[str, str, int, int, int] | None:
    """(role, text, begin and end of the body, end of the turn) of the turn that begins at ``at``."""
    for role, (opening, closing) in MARKS.items():
        if text.startswith(opening, at):
            begin = at + len(opening)
            end = _until(text, begin, closing)
            return None if end < 0 else (role, plain(text[begin:end]), begin, end, end + len(closing))
    if not text.startswith(OTHER_OPEN, at):
        return None
    name_at = at + len(OTHER_OPEN)
    named = _until(text, name_at, OTHER_NAMED)
    if named < 0:
        return None
    begin = named + len(OTHER_NAMED)
    end = _until(text, begin, OTHER_CLOSE)
    return None if end < 0 else (plain(text[name_at:named]), plain(text[begin:end]), begin, end, end + len(OTHER_CLOSE))


def parse(text: str) -> list[tuple[str, str]]:
    """Roles and texts of a whole formatted conversation."""
    if not text.startswith(HEAD):
        raise ValueError("no conversation begins here")
    turns, at = [], len(HEAD)
    while at < len(text):
        found = parse_turn(text, at)
        if found is None:
            raise ValueError(f"no turn begins at {at}")
        turns.append(found[:2])
        at = found[4]
    return turns


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """Segment and span of its body, escaped as far as the round trip asks for."""
    suspicious = "\\" in text or any(c in text for c in CONTROLS)
    for level in range(1 if suspicious else 0, 3):
        body = escaped(text, level)
        if role in MARKS:
            opening, closing = MARKS[role]
            segment = opening + body + closing
        else:
            opening = OTHER_OPEN + escaped(role, max(level, 1)) + OTHER_NAMED
            segment = opening + body + OTHER_CLOSE
        found = parse_turn(segment)
        if found is not None and found[:2] == (role, text) and found[4] == len(segment):
            return segment, len(opening), len(opening) + len(body)
    raise AssertionError("a fully escaped turn always comes back")


def format_turns(conversations: DataFrame) -> DataFrame:
    """One segment per row: conv_id, turn, role, text, segment, loss_start, loss_end (empty span: not under the loss)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segment, said, start, end = [], [], [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
                made, b, e = render_turn(role or "", text or "")
                under = (role or "") == LOSS_ROLE
                segment.append(made)
                said.append(text or "")
                start.append(b if under else 0)
                end.append(e if under else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), batch.column("role").fill_null(""), pa.array(said, pa.string()), pa.array(segment, pa.string()), pa.array(start), pa.array(end)],
                names=["conv_id", "turn", "role", "text", "segment", "loss_start", "loss_end"],
            )

    kind = {c: conversations.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    schema = f"conv_id {kind['conv_id']}, turn {kind['turn']}, role string, text string, segment string, loss_start long, loss_end long"
    return conversations.select("conv_id", "turn", "role", "text").mapInArrow(run, schema)


def whole(segments: DataFrame) -> DataFrame:
    """conv_id, formatted: the text of each conversation in one string (for conversations that fit in one)."""
    order = F.array_sort(F.collect_list(F.struct("turn", "role", "text", "segment")))
    return segments.groupBy("conv_id").agg(F.concat(F.lit(HEAD), F.array_join(F.transform(order, lambda p: p["segment"]), "")).alias("formatted"))


def read_back(segments: DataFrame) -> DataFrame:
    """Digests of what the parser finds in the formatted text, read as a stream.

    Segments are sorted within a task and hashed one after the other, so a conversation of any length needs the memory
    of one segment.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        state: list | None = None
        for batch in batches:
            rows: list[list] = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "segment", "loss_start", "loss_end"))
            for conv, segment, begin, end in zip(*columns, strict=True):
                if state is None or state[0] != conv:
                    if state is not None:
                        rows.append(state)
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), len(HEAD)]
                role, text, *_, stop = parse_turn(segment)
                if stop != len(segment):
                    raise ValueError("a segment holds more than one turn")
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                masked = plain(segment[begin:end])
                state[3] += len(masked)
                state[4].update(masked.encode("utf-8", "surrogatepass"))
                state[5] += len(segment)
            yield _digests(rows, batch.schema.field("conv_id").type, names)
        if state is not None:
            yield _digests([state], batch.schema.field("conv_id").type, names)

    kind = segments.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "segment", "loss_start", "loss_end").mapInArrow(run, schema)


def _digests(rows: list[list], id_type: pa.DataType, names: list[str]) -> pa.RecordBatch:
    made = [[r[0], r[1], r[2].hexdigest(), r[3], r[4].hexdigest(), r[5]] for r in rows]
    types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], t) for i, t in enumerate(types)], names=names)
