"""Benchmark decontamination with an FM-index per training shard.

Test phrases are the windows of ``width`` consecutive words of each benchmark
item (an item with fewer words is one phrase). A task cuts its scan partition
into shards of about ``shard_bytes`` of whole texts, builds one FM-index over
the shard's words, searches all phrases backward through wavelet-tree ranks,
locates the occurrences by sampled suffix positions and merges overlapping
occurrences into removal spans. No shuffle, one scan, memory bounded by the
shard (one longer text is a shard of its own).

The index's alphabet is the benchmark's vocabulary; any other word separates
runs of words, as a text's end does, and a run shorter than the shortest
phrase cannot hold an occurrence and is left out of the index.

Phrases are read on the driver in blocks of at most ``block_items`` items;
each block is one more pass in the same task chain (no shuffle), so neither
the closure nor the driver holds more than a block.

Edge cases: null or wordless texts have no hits; wordless items and null
items are no phrases; repeated rows and items count each (an item id once per
document); an empty benchmark hits nothing; extra columns of the documents
are carried, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.fm_index import FMIndex
from tidewatch.llm.words import ALNUM, LOWER, blocks, span_hashes, tidy, word_spans

WIDTH = 13
SHARD_BYTES = 4 << 20
BLOCK_ITEMS = 20_000
COLUMNS = ("fm_words", "fm_spans", "fm_items")


def _hashed_words(buf, offs):
    low = LOWER[buf]
    starts, ends, first = word_spans(low, offs, ALNUM)
    return span_hashes(low, starts, ends), starts, ends, first


class Phrases:
    """Windows of a block of benchmark items as symbol rows, by length."""

    def __init__(self, items: list[tuple], width: int):
        texts = pa.array([t or "" for _, t in items], type=pa.large_string())
        words = [np.zeros(0, np.uint64)] * len(items)
        for i, j, buf, offs in blocks(texts):
            h, _, _, first = _hashed_words(buf, offs)
            for k in range(i, j):
                words[k] = h[first[k - i]: first[k - i + 1]]
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *words]))
        rows: dict[int, dict[bytes, list[int]]] = {}
        for k, w in enumerate(words):
            n = min(width, len(w))
            symbols = np.searchsorted(self.vocabulary, w) + 1
            for s in range(len(w) - n + 1 if n else 0):
                rows.setdefault(n, {}).setdefault(symbols[s: s + n].astype(np.int64).tobytes(), []).append(k)
        self.by_length = []
        for n, found in sorted(rows.items()):
            owners = [sorted(set(x)) for x in found.values()]
            self.by_length.append((n, np.frombuffer(b"".join(found), dtype=np.int64).reshape(-1, n), owners))
        self.ids = [None if i is None else str(i) for i, _ in items]

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary number from 1, or 0 for other words."""
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def occurrences(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
        """Word positions, lengths and owning items of all occurrences in a shard."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), []
        if not self.by_length or not len(hashes):
            return none
        symbols, n = self.symbols(hashes), len(hashes)
        # runs of known words inside one text
        breaks = symbols == 0
        begin = np.zeros(n, dtype=bool)
        begin[first[:-1][first[:-1] < n]] = True
        start = ~breaks & (begin | np.r_[True, breaks[:-1]])
        run_first = np.flatnonzero(start)
        if not len(run_first):
            return none
        run = np.cumsum(start) - 1
        length = np.bincount(run[~breaks], minlength=len(run_first))
        long = length >= self.by_length[0][0]
        kept = np.flatnonzero(~breaks & long[np.maximum(run, 0)])
        if not len(kept):
            return none
        # kept words, with a separator after each run
        slot = np.arange(len(kept)) + np.cumsum(np.r_[0, (run[kept][1:] != run[kept][:-1]).astype(np.int64)])
        seq = np.zeros(slot[-1] + 2, dtype=np.int64)
        seq[slot] = symbols[kept]
        place = np.zeros(len(seq), dtype=np.int64)
        place[slot] = kept
        index = FMIndex(seq, len(self.vocabulary) + 1)
        at, sizes, owners = [], [], []
        for width, rows, owner in self.by_length:
            lo, hi = index.search(rows)
            counts = hi - lo
            which = np.repeat(np.arange(len(rows)), counts)
            places = lo[which] + np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
            at.append(place[index.locate(places)])
            sizes.append(np.full(len(which), width))
            owners += [owner[k] for k in which]
        return np.concatenate(at), np.concatenate(sizes), owners


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _search_block(docs: DataFrame, text: str, phrases: Phrases, shard_bytes: int, first_block: bool) -> DataFrame:
    schema = T.StructType([*docs.schema.fields] if not first_block else [
        *docs.schema.fields, T.StructField(COLUMNS[0], T.LongType()),
        T.StructField(COLUMNS[1], T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("first", "last", "start", "end")]))),
        T.StructField(COLUMNS[2], T.ArrayType(T.StringType()))])
    spans_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("first", "last", "start", "end")]))
    where, n_cols, names = docs.columns.index(text), len(docs.columns), schema.fieldNames()

    def search(batches):
        for batch in batches:
            column = batch.column(where)
            n_words: list[int] = []
            spans: list[list[dict]] = []
            items: list[list] = []
            for _, _, buf, offs in blocks(column, shard_bytes):
                hashes, starts, ends, first = _hashed_words_in_parts(buf, offs)
                at, sizes, owners = phrases.occurrences(hashes, first)
                doc = np.searchsorted(first, at, side="right") - 1
                found: dict[int, tuple[list, set]] = {}
                for d, p, size, own in zip(doc.tolist(), at.tolist(), sizes.tolist(), owners, strict=True):
                    hits, ids = found.setdefault(d, ([], set()))
                    hits.append((p, p + size))
                    ids.update(own)
                for d in range(len(offs) - 1):
                    n_words.append(int(first[d + 1] - first[d]))
                    hits, ids = found.get(d, ((), ()))
                    merged = _merge(hits)
                    points = _points(buf[offs[d]: offs[d + 1]]) if merged else None
                    spans.append([{"first": s - first[d], "last": e - first[d],
                                   "start": int(points[starts[s] - offs[d]]), "end": int(points[ends[e - 1] - offs[d]])} for s, e in merged])
                    items.append(sorted({phrases.ids[k] for k in ids if phrases.ids[k] is not None}))
            cols = [batch.column(i) for i in range(n_cols)]
            if not first_block:
                old_spans, old_items = cols[-2].to_pylist(), cols[-1].to_pylist()
                spans = [_merge_spans(a, b) for a, b in zip(old_spans, spans, strict=True)]
                items = [sorted({*a, *b}) for a, b in zip(old_items, items, strict=True)]
                cols = cols[:-3]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(n_words, type=pa.int64()), pa.array(spans, type=spans_type), pa.array(items, type=pa.list_(pa.string()))],
                names=names)

    return docs.mapInArrow(tidy(search), schema)


def _points(raw: np.ndarray) -> np.ndarray:
    return np.r_[0, np.cumsum((raw & 0xC0) != 0x80)]


def _merge_spans(a: list[dict], b: list[dict]) -> list[dict]:
    """Union of two lists of disjoint spans."""
    ends = {x["first"]: x for x in sorted([*a, *b], key=lambda x: x["last"])}
    char = {x["last"]: x["end"] for x in [*a, *b]}
    return [{"first": s, "last": e, "start": ends[s]["start"], "end": char[e]}
            for s, e in _merge([(x["first"], x["last"]) for x in [*a, *b]])]


def _hashed_words_in_parts(buf, offs, part: int = 2 << 20):
    """Word hashes of a shard, hashed in parts: the running sums take 8 bytes a byte."""
    h, s, e, f = [], [], [], [np.zeros(1, np.int64)]
    i, n, count = 0, len(offs) - 1, 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offs, offs[i] + part, side="right")) - 1))
        hashes, starts, ends, first = _hashed_words(buf[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
        h.append(hashes)
        s.append(starts + offs[i])
        e.append(ends + offs[i])
        f.append(first[1:] + count)
        count += len(hashes)
        i = j
    return np.concatenate(h), np.concatenate(s), np.concatenate(e), np.concatenate(f)


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                       item_text: str = "text", width: int = WIDTH, shard_bytes: int = SHARD_BYTES,
                       block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``docs`` with ``fm_words`` (word count), ``fm_spans`` (merged removal
    spans: words ``[first, last)``, code points ``[start, end)``) and
    ``fm_items`` (sorted ids, as text, of items with an occurrence)."""
    if clash := set(COLUMNS) & set(docs.columns):
        raise ValueError(f"documents already have {sorted(clash)}")
    out, block, first = docs, [], True
    for row in benchmark.select(F.col(item).cast("string"), item_text).toLocalIterator():
        block.append((row[0], row[1]))
        if len(block) == block_items:
            out, block, first = _search_block(out, text, Phrases(block, width), shard_bytes, first), [], False
    if block or first:
        out = _search_block(out, text, Phrases(block, width), shard_bytes, first)
    return out


def verdicts(found: DataFrame, share: int = 20) -> DataFrame:
    """Adds ``n_words, n_hit, n_items, items_sha256, contaminated`` (hit words at least 1/share of all)."""
    hit = F.aggregate("fm_spans", F.lit(0).cast("long"), lambda acc, s: acc + s["last"] - s["first"])
    return (found.withColumn("n_words", F.col("fm_words")).withColumn("n_hit", hit)
            .withColumn("n_items", F.size("fm_items").cast("long"))
            .withColumn("items_sha256", F.sha2(F.concat_ws(",", "fm_items"), 256))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))))


def remove_spans(found: DataFrame, text: str = "text") -> DataFrame:
    """Texts without their removal spans (code points), the spans' columns dropped."""
    body = F.coalesce(F.col(text), F.lit(""))
    cut = F.aggregate(
        "fm_spans", F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("kept")),
        lambda acc, s: F.struct(s["end"].alias("at"), F.concat(acc["kept"], F.substr(body, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))).alias("kept")),
        lambda acc: F.concat(acc["kept"], F.substr(body, (acc["at"] + 1).cast("int"), F.length(body))))
    return found.withColumn(text, F.when(F.size("fm_spans") > 0, cut).otherwise(F.col(text))).drop(*COLUMNS)
