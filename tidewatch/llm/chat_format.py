"""Chat formatting by a finite-state machine over roles.

A declarative template names, per role, the marks before and after a turn and
whether its text bears loss. A machine with one state per role and a table of
allowed steps validates the order of turns; a wrong step is counted and the
machine goes on from the role it saw. Output: the formatted text, segments
``(start, end, loss, turn)`` in code points that cover it without gaps (the
text of a loss-bearing turn is one segment of its own, marks bear no loss),
and the machine's verdict.

Control strings inside texts are escaped reversibly: a backslash is doubled,
and every control string gets a backslash after its first character, so the
output holds marks only where a turn begins or ends. :func:`parse` reads a
formatted conversation back.

Turns are sorted over the cluster by conversation and turn number (then role
and text, so ties are settled; equal rows travel as one with a count) and
formatted where they lie, as pieces of whole turns of about ``PIECE_CHARS``. A
stream over the pieces carries offset, turn number and role on, so no task
holds a conversation; the pieces of one pass through one task, in order.

Edge cases: null text is an empty turn; a null or unknown role is written with
its name in a mark of its own and is a wrong step; null turn numbers come
first; repeated rows are turns of their own; a null id is one conversation; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_CHARS = 1 << 16


@dataclass(frozen=True)
class Mark:
    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    roles: dict[str, Mark] = field(default_factory=lambda: {
        "system": Mark("<<SYS>>\n", "\n<</SYS>>\n"),
        "user": Mark("<s>[INST] ", " [/INST]"),
        "assistant": Mark("[OUT] ", "</s>", loss=True),
    })
    #: other roles: their name follows as a JSON string
    other: Mark = Mark("[ROLE]", "[/ROLE]")
    #: allowed steps from the start and from each role, and where a conversation may end
    steps: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple[str, ...] = ("assistant", "user")

    def control_strings(self) -> list[str]:
        marks = [*self.roles.values(), self.other]
        return sorted({s.strip() for m in marks for s in (m.before, m.after)} | {"<s>", "[INST]"}, key=lambda s: (-len(s), s))


class Formatter:
    def __init__(self, template: Template):
        self.t = template
        controls = template.control_strings()
        # the longest marks contain shorter ones: escape wherever any of them could begin
        self.escapable = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in controls))
        marks = [(m.before, r) for r, m in template.roles.items()] + [(template.other.before, None)]
        self.openers = sorted(marks, key=lambda x: -len(x[0]))

    def escape(self, text: str) -> str:
        return self.escapable.sub(lambda m: m.group() + "\\", text.replace("\\", "\\\\"))

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def check(self, roles: list[str]) -> tuple[bool, int]:
        """Whether the machine accepts the roles, and how many steps were wrong."""
        state, wrong = "", 0
        for role in roles:
            wrong += role not in self.t.steps.get(state, ())
            state = role
        return wrong == 0 and state in self.t.final, wrong

    def render(self, turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int, bool, int]]]:
        """Formatted text and its segments."""
        parts, segments, at = [], [], 0

        def put(text: str, loss: bool, turn: int) -> None:
            nonlocal at
            parts.append(text)
            segments.append((at, at + len(text), loss, turn))
            at += len(text)

        for i, (role, text) in enumerate(turns):
            mark = self.t.roles.get(role)
            if mark is None:
                name = self.escape(json.dumps(role, ensure_ascii=False))
                put(f"{self.t.other.before}{name}\n", False, i)
                mark = self.t.other
            else:
                put(mark.before, False, i)
            put(self.escape(text), mark.loss, i)
            put(mark.after, False, i)
        return "".join(parts), segments

    def parse(self, formatted: str) -> Iterator[tuple[str, str]]:
        """Roles and texts, read back from a formatted conversation alone."""
        at = 0
        while at < len(formatted):
            before, role = next((b, r) for b, r in self.openers if formatted.startswith(b, at))
            at += len(before)
            after = self.t.other.after if role is None else self.t.roles[role].after
            if role is None:
                end = formatted.index("\n", at)
                role, at = json.loads(self.unescape(formatted[at:end])), end + 1
            # a mark may begin with white space that the text also ends with: find its control string
            control = after.strip()
            lead = len(after) - len(after.lstrip())
            end = formatted.index(control, at) - lead
            yield role, self.unescape(formatted[at:end])
            at = end + len(after)


def _ordered(df: DataFrame) -> DataFrame:
    """All pieces of a conversation in one task, in order, for a stream that holds one batch."""
    return df.repartition(F.col("conv")).sortWithinPartitions("conv", "part", "piece")


def _gathered(batches, rows: int = 256, size: int = 4 << 20):
    """Batches of one row as fewer, larger ones."""
    held, held_bytes = [], 0
    for batch in batches:
        held.append(batch)
        held_bytes += batch.nbytes
        if len(held) >= rows or held_bytes >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, held_bytes = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _streamed(batches, start):
    """``(batch, row, state, last)`` of sorted rows; ``start()`` makes a conversation's state."""
    held, state, conv = None, None, None
    for batch in batches:
        for i, c in enumerate(batch.column("conv").to_pylist()):
            if held is not None:
                yield *held, state, c != conv
            if held is None or c != conv:
                state, conv = start(), c
            held = (batch, i)
    if held is not None:
        yield *held, state, True


def format_conversations(turns: DataFrame, template: Template | None = None, conv: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text", piece_chars: int = PIECE_CHARS) -> DataFrame:
    """``conv, part, piece, formatted, segments, n_turns, valid, wrong_steps``: pieces of whole turns, in the order of
    ``part, piece``. Offsets and turn numbers are those of the conversation; the last three hold up to the piece's end."""
    made = Formatter(template or Template())
    kind = dict(turns.dtypes)[conv]
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    by = ["conv", "turn", "role", "text"]
    rows = rows.groupBy(*by).agg(F.count("*").alias("copies")).repartitionByRange(*by).sortWithinPartitions(*by)
    segment = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("loss", pa.bool_()), ("turn", pa.int32())]))
    names = ["start", "end", "loss", "turn"]

    def render(batches):
        from pyspark import TaskContext

        part, made_pieces, open_conv, held, size = TaskContext.get().partitionId(), 0, None, [], 0

        def piece(of):
            nonlocal made_pieces, held, size
            formatted, segments = made.render(held)
            roles = [r for r, _ in held]
            inner = sum(b not in made.t.steps.get(a, ()) for a, b in zip(roles[:-1], roles[1:], strict=True))
            made_pieces, held, size = made_pieces + 1, [], 0
            return pa.RecordBatch.from_arrays(
                [of, pa.array([part], pa.int32()), pa.array([made_pieces], pa.int64()), pa.array([formatted], pa.string()),
                 pa.array([[dict(zip(names, x, strict=True)) for x in segments]], segment), pa.array([len(roles)], pa.int64()),
                 pa.array([roles[0]], pa.string()), pa.array([roles[-1]], pa.string()), pa.array([inner], pa.int64())],
                names=["conv", "part", "piece", "formatted", "segments", "n", "first", "final", "inner"])

        of = None
        for batch in batches:
            for i in range(batch.num_rows):
                c = batch.column("conv")[i].as_py()
                if held and c != open_conv:
                    yield piece(of)
                open_conv, of = c, batch.column("conv").slice(i, 1)
                said = batch.column("role")[i].as_py(), batch.column("text")[i].as_py()
                for _ in range(batch.column("copies")[i].as_py()):
                    held.append(said)
                    size += len(said[1]) + 32
                    if size >= piece_chars:
                        yield piece(of)
        if held:
            yield piece(of)

    def place(batches):
        for batch, i, at, _ in _streamed(batches, lambda: {"chars": 0, "turns": 0, "wrong": 0, "role": ""}):
            row = {c: batch.column(c)[i].as_py() for c in ("formatted", "segments", "n", "first", "final", "inner")}
            moved = [x | {"start": x["start"] + at["chars"], "end": x["end"] + at["chars"], "turn": x["turn"] + at["turns"]} for x in row["segments"]]
            at["chars"] += len(row["formatted"])
            at["turns"] += row["n"]
            at["wrong"] += row["inner"] + (row["first"] not in made.t.steps.get(at["role"], ()))
            at["role"] = row["final"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(i, 1) for c in ("conv", "part", "piece", "formatted")), pa.array([moved], segment),
                 pa.array([at["turns"]], pa.int64()), pa.array([at["wrong"] == 0 and at["role"] in made.t.final]), pa.array([at["wrong"]], pa.int64())],
                names=["conv", "part", "piece", "formatted", "segments", "n_turns", "valid", "wrong_steps"])

    head = f"conv {kind}, part int, piece long, formatted string, segments array<struct<start:long,end:long,loss:boolean,turn:int>>, "
    pieces = rows.mapInArrow(lambda batches: _gathered(render(batches)), head + "n long, first string, final string, inner long")
    return _ordered(pieces).mapInArrow(lambda batches: _gathered(place(batches)), head + "n_turns long, valid boolean, wrong_steps long").withColumnRenamed("conv", conv)


def read_back(formatted: DataFrame, template: Template | None = None, conv: str = "conv_id") -> DataFrame:
    """Digests of what the formatted texts and their masks hold, from all pieces of a conversation:
    ``conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid``."""
    import hashlib

    made = Formatter(template or Template())
    kind = dict(formatted.dtypes)[conv]

    def parse(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                text, segments = batch.column("formatted")[i].as_py(), batch.column("segments")[i].as_py()
                turns, base = list(made.parse(text)), segments[0]["start"]
                masked = "".join(made.unescape(text[s["start"] - base: s["end"] - base]) for s in segments if s["loss"])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(i, 1) for c in ("conv", "part", "piece", "valid")), pa.array([len(turns)], pa.int64()),
                     pa.array(["".join(f"{r}\n{t}\n" for r, t in turns)], pa.string()), pa.array([masked], pa.string()), pa.array([len(text)], pa.int64())],
                    names=["conv", "part", "piece", "valid", "n", "said", "masked", "chars"])

    def digest(batches):
        for batch, i, at, last in _streamed(batches, lambda: {"n": 0, "loss": 0, "chars": 0, "said": hashlib.sha256(), "masked": hashlib.sha256()}):
            masked = batch.column("masked")[i].as_py()
            at["said"].update(batch.column("said")[i].as_buffer())
            at["masked"].update(masked.encode())
            at["n"] += batch.column("n")[i].as_py()
            at["loss"] += len(masked)
            at["chars"] += batch.column("chars")[i].as_py()
            if last:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("conv").slice(i, 1), pa.array([at["n"]], pa.int64()), pa.array([at["said"].hexdigest()]), pa.array([at["loss"]], pa.int64()),
                     pa.array([at["masked"].hexdigest()]), pa.array([at["chars"]], pa.int64()), batch.column("valid").slice(i, 1)],
                    names=["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"])

    parsed = formatted.select(F.col(conv).alias("conv"), "part", "piece", "formatted", "segments", "valid").mapInArrow(
        lambda batches: _gathered(parse(batches)), f"conv {kind}, part int, piece long, valid boolean, n long, said string, masked string, chars long")
    return _ordered(parsed).mapInArrow(
        lambda batches: _gathered(digest(batches)), f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"
    ).withColumnRenamed("conv", conv)
