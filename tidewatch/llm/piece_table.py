"""Fill-in-middle transformation on piece tables.

A document is a list of descriptors ``(buffer, start, length)`` over two
buffers that never change: its text and the sentinels. Cutting splits a
descriptor, an arrangement puts the parts into another order with sentinels
between, and restoring cuts the written output at its sentinels and applies the
inverse order. Digests read the bytes that the descriptors name one after the
other; nothing is joined for them. One Arrow scan, no shuffle.

Cuts count code points. ``h1`` to ``h4`` are the first four 8-digit groups of
the hex SHA-256 of ``salt`` and the decimal key. A text that is empty or holds a
sentinel stays plain, so the first occurrence of each sentinel in an output is
the one the arrangement wrote (no sentinel can arise across a border: each
starts with ``<``, ends with ``>`` and holds neither inside).

Edge cases: a null text is an empty text (plain); a null key has the empty
string as its decimal form; repeated rows come out alike; an empty table gives
an empty result; extra columns are ignored (``keep`` carries the wanted ones).
An output without the sentinels of its form, a null output or an unknown form
restores to null.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.words import blocks

#: fixed values: the sentinels, and the arrangements as sentinels and parts (0 prefix, 1 middle, 2 suffix)
SENTINELS = ("<P>", "<S>", "<M>")
ARRANGEMENTS = {"psm": ("<P>", 0, "<S>", 2, "<M>", 1), "spm": ("<S>", 2, "<P>", 0, "<M>", 1)}
PLAIN = "plain"

TEXT, SENTINEL = 0, 1
_SENTINEL_BUFFER = "".join(SENTINELS).encode()
_SENTINEL_AT = {s: (SENTINEL, _SENTINEL_BUFFER.index(s.encode()), len(s.encode())) for s in SENTINELS}


@dataclass
class PieceTable:
    """Descriptors ``(buffer, start, length)`` in bytes over ``text`` and the sentinels."""

    text: bytes | memoryview
    pieces: list[tuple[int, int, int]] = field(default_factory=list)

    @classmethod
    def of(cls, text: bytes | memoryview) -> PieceTable:
        return cls(text, [(TEXT, 0, len(text))])

    def cut(self, at: int) -> None:
        """Splits the descriptor that holds byte ``at`` of the document (an end may be cut off too: one part is empty)."""
        for k, (buffer, start, length) in enumerate(self.pieces):
            if at <= length:
                self.pieces[k: k + 1] = [(buffer, start, at), (buffer, start + at, length - at)]
                return
            at -= length
        raise IndexError("cut beyond the end of the document")

    def arranged(self, form: str) -> PieceTable:
        """The three parts in the order of ``form``, sentinels between."""
        return PieceTable(self.text, [_SENTINEL_AT[x] if isinstance(x, str) else self.pieces[x] for x in ARRANGEMENTS[form]])

    def restored(self, form: str) -> PieceTable:
        """The inverse of :meth:`arranged` for a table over a written output."""
        whole = bytes(self.text)
        parts, at = {}, 0
        order = ARRANGEMENTS[form]
        for sentinel, part, following in zip(order[::2], order[1::2], [*order[2::2], None], strict=True):
            mark = sentinel.encode()
            if whole[at: at + len(mark)] != mark:
                raise ValueError(f"no {sentinel} where form {form} has it")
            begin = at + len(mark)
            at = whole.find(following.encode(), begin) if following else len(whole)
            if at < 0:
                raise ValueError(f"no {following} in an output of form {form}")
            parts[part] = (TEXT, begin, at - begin)
        return PieceTable(self.text, [parts[k] for k in sorted(parts)])

    def spans(self):
        """The bytes of each descriptor, without copies."""
        views = (memoryview(self.text), memoryview(_SENTINEL_BUFFER))
        return (views[b][s: s + n] for b, s, n in self.pieces)

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for span in self.spans():
            digest.update(span)
        return digest.hexdigest()

    def written(self) -> bytes:
        return b"".join(self.spans())


def draws(salted: str) -> list[int]:
    digest = hashlib.sha256(salted.encode()).hexdigest()
    return [int(digest[k: k + 8], 16) for k in range(0, 32, 8)]


def byte_offset(starts: np.ndarray | None, points: int, length: int) -> int:
    """Byte where code point number ``points`` starts; ``starts`` is None for ASCII."""
    if starts is None:
        return points
    return int(starts[points]) if points < len(starts) else length


def split_text(raw: bytes, salted: str, plain_from: int = 90, spm_below: int = 20) -> tuple[PieceTable, str, int, int | None, int | None]:
    """Piece table of the output, its form, the text's code points, and those of prefix and middle."""
    view = np.frombuffer(raw, dtype=np.uint8)
    starts = None if raw.isascii() else np.flatnonzero((view & 0xC0) != 0x80)
    n = len(raw) if starts is None else len(starts)
    h1, h2, h3, h4 = draws(salted)
    table = PieceTable.of(raw)
    if not raw or any(s.encode() in raw for s in SENTINELS) or h3 % 100 >= plain_from:
        return table, PLAIN, n, None, None
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    table.cut(byte_offset(starts, high, len(raw)))
    table.cut(byte_offset(starts, low, len(raw)))
    form = "spm" if h4 % 100 < spm_below else "psm"
    return table.arranged(form), form, n, low, high - low


PIECE = "struct<buffer: string, start: bigint, length: bigint>"


def _piece_list(tables: list[PieceTable]) -> pa.ListArray:
    rows = [p for t in tables for p in t.pieces]
    sizes = np.r_[0, np.cumsum([len(t.pieces) for t in tables])].astype(np.int32)
    columns = [pa.array([("text", "sentinel")[b] for b, _, _ in rows], pa.string()), pa.array([s for _, s, _ in rows], pa.int64()),
               pa.array([n for _, _, n in rows], pa.int64())]
    return pa.ListArray.from_arrays(pa.array(sizes), pa.StructArray.from_arrays(columns, names=["buffer", "start", "length"]))


def _each(batch: pa.RecordBatch, column: str):
    """Blocks of rows with their texts as bytes."""
    for i, j, buf, offs in blocks(batch.column(column)):
        yield i, j, [buf[a:b].tobytes() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]


def fill_in_middle(docs: DataFrame, keep: list[str], key: str = "doc_id", text: str = "text", salt: str = "1:",
                   plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """``keep``, ``n`` (code points), ``form``, ``prefix_chars``, ``middle_chars``,
    ``output``, ``output_sha256`` and ``pieces`` (the output's descriptors, in bytes) of every row."""
    source = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).cast("string").alias("body"),
                         F.concat(F.lit(salt), F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("salted"))
    kinds = dict(source.dtypes)
    names = [f"k{i}" for i in range(len(keep))]
    made = ["n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "pieces"]

    def run(batches):
        for batch in batches:
            for i, j, texts in _each(batch, "body"):
                salted = batch.column("salted").slice(i, j - i).to_pylist()
                tables, forms, n, prefix, middle = zip(*[split_text(t, s, plain_from, spm_below) for t, s in zip(texts, salted, strict=True)], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(i, j - i) for c in names), pa.array(n, pa.int64()), pa.array(forms, pa.string()),
                     pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array([t.written() for t in tables], pa.binary()).cast(pa.string()),
                     pa.array([t.sha256() for t in tables], pa.string()), _piece_list(tables)], names=[*names, *made])

    schema = ["n long", "form string", "prefix_chars long", "middle_chars long", "output string", "output_sha256 string", f"pieces array<{PIECE}>"]
    return source.mapInArrow(run, ", ".join([*(f"{c} {kinds[c]}" for c in names), *schema])).toDF(*keep, *made)


def restore_table(raw: bytes | None, form: str | None) -> PieceTable | None:
    if raw is None or form not in (PLAIN, *ARRANGEMENTS):
        return None
    table = PieceTable.of(raw)
    if form == PLAIN:
        return table
    try:
        return table.restored(form)
    except ValueError:
        return None


def restore(outputs: DataFrame, keep: list[str], output: str = "output", form: str = "form", with_text: bool = True) -> DataFrame:
    """``keep``, ``restored_sha256`` and, if wanted, ``text`` rebuilt from outputs and forms alone."""
    source = outputs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(output).cast("string").alias("body"),
                            F.col(form).cast("string").alias("arrangement"))
    kinds = dict(source.dtypes)
    names = [f"k{i}" for i in range(len(keep))]

    def run(batches):
        for batch in batches:
            for i, j, texts in _each(batch, "body"):
                here = batch.column("body").slice(i, j - i).is_valid().to_pylist()
                forms = batch.column("arrangement").slice(i, j - i).to_pylist()
                tables = [restore_table(t if v else None, f) for t, v, f in zip(texts, here, forms, strict=True)]
                columns = [pa.array([t and t.sha256() for t in tables], pa.string())]
                if with_text:
                    columns.append(pa.array([None if t is None else t.written() for t in tables], pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in names), *columns], names=[*names, *made])

    made = ["restored_sha256", *(["text"] if with_text else [])]
    return source.mapInArrow(run, ", ".join([*(f"{c} {kinds[c]}" for c in names), *(f"{c} string" for c in made)])).toDF(*keep, *made)
