"""Packing of tokenised examples into fixed-length sequences by vector bin packing.

Every sequence has three limits at once: tokens, segments (pieces) and
loss-bearing tokens. An example longer than a sequence gives full pieces and
one remainder; remainders are placed by the dot-product heuristic: the open
sequence takes, among the pieces that fit, the one whose demand vector has the
largest weighted inner product with what the sequence has left (weights: mean
demand of each dimension). When nothing fits, the sequence closes.

Each task packs its own scan partition in groups of ``group_pieces`` pieces,
so there is no shuffle, memory is bounded and a lost task is run again with
the same result. Sequences that a group leaves badly filled hand their pieces
to the next group. ``sequence_id`` is the task's partition number and a
counter, unique over the table.

Loss: without ``loss`` every token bears loss. Otherwise ``loss`` names a
column with the number of loss-bearing tokens, which are the example's last
ones (the response); pieces are cut so that each keeps every limit.

Edge cases: null or empty text is the end token alone; repeated rows are
packed each; null keys are carried; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.tokens import encoder, tokenizer_path
from tidewatch.llm.words import blocks, tidy

END_ID = 1
SCHEMA = ("start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long, "
          "sequence_id long, offset long, ids binary")


def cut(tokens: int, loss: int, max_tokens: int, max_loss: int) -> Iterator[tuple[int, int, int]]:
    """Pieces ``(start, length, loss tokens)`` of an example whose last ``loss`` tokens bear loss."""
    start, first_loss = 0, tokens - loss
    while start < tokens:
        length = min(max_tokens, tokens - start)
        if start + length > first_loss:
            length = min(length, max(first_loss - start, 0) + max_loss)
        yield start, length, max(0, start + length - max(start, first_loss))
        start += length


def dot_product_bins(demand: np.ndarray, limits: np.ndarray) -> list[list[int]]:
    """Bins (lists of row numbers) for demand vectors that each fit the limits.

    Equal vectors are one class with a count, so a step looks at distinct
    vectors only."""
    kinds, which, counts = np.unique(demand, axis=0, return_inverse=True, return_counts=True)
    which = which.reshape(-1)
    members = np.split(np.argsort(which, kind="stable"), np.cumsum(counts)[:-1])
    taken = np.zeros(len(kinds), dtype=np.int64)
    share = kinds / limits
    weight = (share * counts[:, None]).sum(0) / max(1, counts.sum())
    bins, placed, total = [], 0, len(demand)
    while placed < total:
        left, rows = limits.astype(np.float64), []
        while True:
            fits = (taken < counts) & (kinds <= left).all(1)
            if not fits.any():
                break
            gain = np.where(fits, share @ (weight * left / limits), -1.0)
            k = int(gain.argmax())
            rows.append(int(members[k][taken[k]]))
            taken[k] += 1
            left = left - kinds[k]
        bins.append(rows)
        placed += len(rows)
    return bins


def pack(df: DataFrame, key: str = "doc_id", text: str = "text", loss: str | None = None,
         max_tokens: int = 2048, max_segments: int = 256, max_loss: int | None = None,
         tokenizer: str | None = None, end_id: int = END_ID, group_pieces: int = 4096,
         with_ids: bool = True) -> DataFrame:
    """One row per piece: ``key``, its place in the example and in its sequence, and its ids."""
    path = tokenizer or tokenizer_path()
    limits = np.array([max_tokens, max_segments, max_loss or max_tokens], dtype=np.int64)
    kind = dict(df.select(key).dtypes)[key]
    source = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"),
                       (F.col(loss).cast("long") if loss else F.lit(None).cast("long")).alias("loss"))

    def run(batches):
        from pyspark import TaskContext

        ids_of = encoder(path).encode
        encoder.cache_clear()  # the worker outlives this task, and its tables would count against later stages
        base, made = TaskContext.get().partitionId() << 40, 0
        end = np.array([end_id], dtype="<u4").tobytes()
        waiting: list[tuple] = []  # (key, start, length, loss, tokens, ids)

        def sequence(pieces, out):
            nonlocal made
            offset = 0
            for k, start, length, n_loss, tokens, ids in pieces:
                out.append((k, start, length, zlib.crc32(ids), tokens, n_loss, base + made, offset, ids if with_ids else None))
                offset += length
            made += 1

        def close(out, last):
            nonlocal waiting
            demand = np.array([(p[2], 1, p[3]) for p in waiting], dtype=np.int64)
            rest = []
            for rows in dot_product_bins(demand, limits):
                pieces = [waiting[i] for i in rows]
                filled = (demand[rows].sum(0) / limits).max()
                if last or filled >= 0.98:
                    sequence(pieces, out)
                else:
                    rest += pieces
            if len(rest) > group_pieces // 2:  # these do not pack any better later
                for rows in dot_product_bins(np.array([(p[2], 1, p[3]) for p in rest], dtype=np.int64), limits):
                    sequence([rest[i] for i in rows], out)
                rest = []
            waiting = rest

        def table(out):
            cols = list(zip(*out, strict=True)) if out else [()] * 9
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], type=key_type), *(pa.array(c, type=pa.int64()) for c in cols[1:8]),
                 pa.array(cols[8], type=pa.binary())],
                names=["key", "start", "length", "ids_crc32", "doc_tokens", "loss_tokens", "sequence_id", "offset", "ids"])

        key_type = None
        for batch in batches:
            key_type = batch.schema.field("key").type
            texts = batch.column("text")
            for i, j, _, _ in blocks(texts):
                out: list[tuple] = []
                keys = batch.column("key").slice(i, j - i).to_pylist()
                losses = batch.column("loss").slice(i, j - i).to_pylist()
                for k, n_loss, ids in zip(keys, losses, ids_of([t or "" for t in texts.slice(i, j - i).to_pylist()]), strict=True):
                    ids += end
                    n = len(ids) // 4
                    n_loss = n if n_loss is None else max(0, min(n_loss, n))
                    for start, length, bearing in cut(n, n_loss, max_tokens, int(limits[2])):
                        piece = (k, start, length, bearing, n, ids[4 * start: 4 * (start + length)])
                        if length == max_tokens or bearing == limits[2]:
                            sequence([piece], out)
                        else:
                            waiting.append(piece)
                    if len(waiting) >= group_pieces:
                        close(out, last=False)
                if out:
                    yield table(out)
        if waiting:
            out = []
            close(out, last=True)
            yield table(out)

    packed = source.mapInArrow(tidy(run), f"key {kind}, {SCHEMA}")
    return packed.withColumnRenamed("key", key) if with_ids else packed.withColumnRenamed("key", key).drop("ids")
