"""Language-model scores by deleted interpolation of n-gram estimates.

A token's probability after context ``v`` mixes the maximum-likelihood bigram
and unigram estimates with a uniform one over the training vocabulary and one
unknown word::

    p(w | v) = l2 * c(v, w) / c(v) + l1 * c(w) / N + l0 / (V + 1)

with weights per bucket of the context's frequency (powers of two). The
weights come from expectation-maximisation on held-out counts: every training
token is held out in turn, so its own occurrence is deleted from all counts.
A text is its words and one end token; the context of its first token is an
end token.

How it runs (counts of the whole corpus, no cap, nothing on the driver but one
bounded histogram):

1. Texts become chunks of about ``chunk_bytes``, written compressed once.
2. Each chunk sends its distinct unigram and bigram hashes with their training
   counts to hash-range buckets, as sorted compressed arrays (so a frequent
   word costs one entry a chunk); a bucket adds them up and answers each chunk
   in the chunk's own order.
3. A chunk and its answers meet; every token gets its counts, kept per
   document as compressed arrays.
4. One scan of those sums the deleted counts into a histogram (frequency
   bucket x log-scale cells, bounded whatever the data's size, each cell with
   its exact sums); EM runs on it; a last scan scores.

The number of buckets follows the data, so a bucket stays at about
``bucket_bytes`` of text. A key is a 64-bit hash.

Edge cases: null and empty texts are an end token alone; without training
rows all counts are 0 and the model is uniform over one unknown word; null
keys are held out or not as the caller's flag says (null: not used for
training); repeated rows count each; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.words import LOWER, NON_SPACE, blocks, mix, span_hashes, word_spans
from tidewatch.session import cut_lineage

CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 8 << 20
END = np.uint64(0x5851F42D4C957F2D)
LEVELS = 32  # context-frequency buckets: 0, 1, 2-3, 4-7, ...
CELLS = 96  # half octaves of an estimate; cell 0 is zero


def _squeeze(a: np.ndarray) -> bytes:
    """Compressed byte planes of an integer array."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)
    return zstandard.compress(planes.tobytes(), 1)


def _unsqueeze(raw: bytes, kind: str) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def _grams(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unigram and bigram hash of every token (words and ends), and each text's first token."""
    low = LOWER[buf]
    starts, ends, first = word_spans(low, offs, NON_SPACE)
    words = span_hashes(low, starts, ends)
    n = len(offs) - 1
    bounds = first + np.arange(n + 1)
    uni = np.full(len(words) + n, END, dtype=np.uint64)
    doc = np.repeat(np.arange(n), np.diff(first))
    uni[np.arange(len(words)) + doc] = words
    before = np.r_[END, uni[:-1]] if n else uni  # the token before a text's first one is an end
    return uni, mix(before * np.uint64(0x9FB21C651E98DF25) + uni), bounds


def _chunk_rows(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """``chunk, rows, bytes, body``: whole texts of one task, compressed, with keys and flags as Arrow data."""

    def run(batches):
        from pyspark import TaskContext

        base, made = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for i, j, _, offs in blocks(batch.column("text"), chunk_bytes):
                part = batch.slice(i, j - i)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema) as out:
                    out.write_batch(part)
                body = zstandard.compress(sink.getvalue(), 3)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([base + made]), pa.array([j - i]), pa.array([int(offs[-1])]), pa.array([body], pa.binary())],
                    names=["chunk", "rows", "bytes", "body"])
                made += 1

    return docs.mapInArrow(run, "chunk long, rows long, bytes long, body binary")


def _open(body: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(zstandard.decompress(body)).read_next_batch()


def _parts(batch: pa.RecordBatch, part: int = 2 << 20):
    """Gram arrays of a chunk, hashed in parts and joined: ``uni, bi, bounds``."""
    uni, bi, bounds, at = [], [], [np.zeros(1, np.int64)], 0
    for _, _, buf, offs in blocks(batch.column("text"), part):
        u, b, f = _grams(buf, offs)
        uni.append(u)
        bi.append(b)
        bounds.append(f[1:] + at)
        at += len(u)
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *uni]), np.concatenate([none, *bi]), np.concatenate(bounds)


def _train_flags(batch: pa.RecordBatch, bounds: np.ndarray) -> np.ndarray:
    train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
    return np.repeat(train, np.diff(bounds))


def _sent(chunks: DataFrame, bits: int) -> DataFrame:
    """``bucket, size, chunk, keys, counts``: distinct hashes of a chunk by hash range, with training counts."""

    def run(batches):
        shift = np.uint64(64 - bits)
        for batch in batches:
            for chunk, body in zip(batch.column("chunk").to_pylist(), batch.column("body"), strict=True):
                part = _open(body.as_buffer())
                uni, bi, bounds = _parts(part)
                train = _train_flags(part, bounds)
                for size, grams in ((1, uni), (2, bi)):
                    keys, which = np.unique(grams, return_inverse=True)
                    counts = np.bincount(which, weights=train, minlength=len(keys)).astype("<u4")
                    cut = np.searchsorted(keys >> shift, np.arange((1 << bits) + 1, dtype=np.uint64))
                    used = [b for b in range(1 << bits) if cut[b] < cut[b + 1]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(used, pa.int32()), pa.array([size] * len(used), pa.int32()), pa.array([chunk] * len(used), pa.int64()),
                         pa.array([_squeeze(np.diff(keys[cut[b]: cut[b + 1]], prepend=np.uint64(0))) for b in used], pa.binary()),
                         pa.array([_squeeze(counts[cut[b]: cut[b + 1]]) for b in used], pa.binary())],
                        names=["bucket", "size", "chunk", "keys", "counts"])

    return chunks.select("chunk", "body").mapInArrow(run, "bucket int, size int, chunk long, keys binary, counts binary")


def _added(sent: DataFrame) -> DataFrame:
    """Each sender's totals, in its order; one row per bucket (chunk null) with types and tokens."""

    def run(table: pa.Table) -> pa.Table:
        keys = [np.cumsum(_unsqueeze(k.as_buffer(), "<u8"), dtype=np.uint64) for k in table.column("keys")]
        counts = np.concatenate([_unsqueeze(c.as_buffer(), "<u4") for c in table.column("counts")])
        distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(which, weights=counts, minlength=len(distinct)).astype(np.int64)
        asked = np.split(which, np.cumsum([len(k) for k in keys])[:-1])
        n = len(keys) + 1
        return pa.table({
            "chunk": pa.array([*table.column("chunk").to_pylist(), None], pa.int64()),
            "size": pa.array([table.column("size")[0].as_py()] * n, pa.int32()),
            "bucket": pa.array([table.column("bucket")[0].as_py()] * n, pa.int32()),
            "totals": pa.array([*(_squeeze(total[a].astype("<u8")) for a in asked), None], pa.binary()),
            "types": pa.array([None] * (n - 1) + [int((total > 0).sum())], pa.int64()),
            "tokens": pa.array([None] * (n - 1) + [int(total.sum())], pa.int64())})

    return sent.groupBy("bucket", "size").applyInArrow(
        run, "chunk long, size int, bucket int, totals binary, types long, tokens long")


def _looked_up(chunks: DataFrame, totals: DataFrame, kind: str) -> DataFrame:
    """Per document ``key, train, n_tokens, one, two``: training counts of its tokens and their bigrams."""
    rows = chunks.select("chunk", F.lit(0).alias("size"), F.lit(0).alias("bucket"), F.col("body").alias("data")).union(
        totals.where("chunk is not null").select("chunk", "size", "bucket", F.col("totals").alias("data")))

    def run(table: pa.Table) -> pa.Table:
        size, bucket = table.column("size").to_pylist(), table.column("bucket").to_pylist()
        order = sorted(range(len(size)), key=lambda i: (size[i], bucket[i]))
        part = _open(table.column("data")[order[0]].as_buffer())
        uni, bi, bounds = _parts(part)
        found = []
        for n, grams in ((1, uni), (2, bi)):
            answers = np.concatenate([_unsqueeze(table.column("data")[i].as_buffer(), "<u8") for i in order if size[i] == n])
            found.append(answers[np.unique(grams, return_inverse=True)[1]])
        cuts = [[_squeeze(c[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)] for c in found]
        return pa.table({"key": part.column("key"), "train": part.column("train"), "n_tokens": pa.array(np.diff(bounds)),
                         "one": pa.array(cuts[0], pa.binary()), "two": pa.array(cuts[1], pa.binary())})

    return rows.groupBy("chunk").applyInArrow(run, f"key {kind}, train boolean, n_tokens long, one binary, two binary")


def _level(context: np.ndarray) -> np.ndarray:
    """Bucket of a context frequency: 0, then the number of bits."""
    return np.minimum(np.frexp(context.astype(np.float64))[1], LEVELS - 1)


def _counts(one: bytes, two: bytes, ends: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of a text's tokens, of their contexts and of the bigrams."""
    c1 = _unsqueeze(one, "<u8").astype(np.int64)
    return c1, np.r_[ends, c1[:-1]], _unsqueeze(two, "<u8").astype(np.int64)


def _cell(estimate: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        half = np.where(estimate > 0, np.floor(2 * np.log2(estimate)), 0)
    return np.where(estimate > 0, np.clip(CELLS - 1 + half, 1, CELLS - 1), 0).astype(np.int64)


def _histogram(found: DataFrame, n: int, ends: int) -> DataFrame:
    """Deleted estimates of all training tokens: ``cell, n, two, one`` (count and sums)."""

    def run(batches):
        size = LEVELS * CELLS * CELLS
        for batch in batches:
            cells, twos, ones = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0)]
            for one, two in zip(batch.column("one"), batch.column("two"), strict=True):
                c1, cv, c2 = _counts(one.as_buffer(), two.as_buffer(), ends)
                f1 = (c1 - 1) / max(1, n - 1)
                f2 = np.where(cv > 1, (c2 - 1) / np.maximum(1, cv - 1), 0.0)
                cells.append((_level(cv - 1) * CELLS + _cell(f2)) * CELLS + _cell(f1))
                twos.append(f2)
                ones.append(f1)
            cell, which = np.unique(np.concatenate(cells), return_inverse=True)
            assert len(cell) <= size
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int64()), pa.array(np.bincount(which, minlength=len(cell)).astype(np.int64)),
                 pa.array(np.bincount(which, np.concatenate(twos), len(cell))), pa.array(np.bincount(which, np.concatenate(ones), len(cell)))],
                names=["cell", "n", "two", "one"])

    return (found.where("train").select("one", "two").mapInArrow(run, "cell long, n long, two double, one double")
            .groupBy("cell").agg(F.sum("n").alias("n"), F.sum("two").alias("two"), F.sum("one").alias("one")))


def learn_weights(cell: np.ndarray, n: np.ndarray, two: np.ndarray, one: np.ndarray, types: int, rounds: int = 100) -> np.ndarray:
    """Weights (bigram, unigram, uniform) per frequency bucket, by EM on the deleted estimates."""
    level, f2, f1 = cell // (CELLS * CELLS), two / n, one / n
    estimates = np.stack([f2, f1, np.full(len(n), 1 / (types + 1))], axis=1)
    weights = np.tile([0.4, 0.4, 0.2], (LEVELS, 1))
    weights[0] = [0.0, 0.8, 0.2]  # an unseen context has no bigram estimate
    for _ in range(rounds):
        share = weights[level] * estimates
        share *= (n / share.sum(1))[:, None]
        mass = np.zeros((LEVELS, 3))
        np.add.at(mass, level, share)
        mass[1:] += 1e-3  # a bucket without tokens keeps equal weights
        mass[0, 1:] += 1e-3
        weights = mass / mass.sum(1, keepdims=True)
    return weights


def score_texts(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text",
                chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, dict]:
    """``key, train, n_tokens, n_known, train_tokens, base_score, score`` of every row, and the model's
    ``tokens, types, weights``. ``train`` marks the rows that the model learns from."""
    kind = dict(docs.dtypes)[key]
    source = docs.select(F.col(key).alias("key"), F.coalesce(train, F.lit(False)).alias("train"),
                         F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    chunks = cut_lineage(_chunk_rows(source, chunk_bytes), "lm-chunks")
    total = chunks.agg(F.sum("bytes").alias("b")).head()["b"] or 0
    bits = max(4, (total // bucket_bytes).bit_length())
    totals = cut_lineage(_added(_sent(chunks, bits)), "lm-totals")
    sums = totals.where("chunk is null and size = 1").agg(F.sum("types").alias("types"), F.sum("tokens").alias("tokens")).head()
    types, tokens = sums["types"] or 0, sums["tokens"] or 0
    found = cut_lineage(_looked_up(chunks, totals, kind), "lm-counts")
    ends = found.where("train").count()  # each training text ends once
    cells = sorted(tuple(r) for r in _histogram(found, tokens, ends).collect())  # at most LEVELS * CELLS * CELLS
    if cells:
        cell, n, two, one = (np.array(c) for c in zip(*cells, strict=True))
        weights = learn_weights(cell, n, two, one, types)
    else:
        weights = np.tile([0.0, 0.0, 1.0], (LEVELS, 1))

    def run(batches):
        for batch in batches:
            known, base, score = [], [], []
            for one, two in zip(batch.column("one"), batch.column("two"), strict=True):
                c1, cv, c2 = _counts(one.as_buffer(), two.as_buffer(), ends)
                w = weights[_level(cv)]
                p = w[:, 0] * c2 / np.maximum(cv, 1) + w[:, 1] * c1 / max(1, tokens) + w[:, 2] / (types + 1)
                known.append(int((c1 > 0).sum()))
                base.append(float(np.log10((c1 + 1) / (tokens + types + 1)).sum()))
                score.append(float(np.log10(p).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("train"), batch.column("n_tokens"), pa.array(known, pa.int64()),
                 pa.array([tokens] * len(known), pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64())],
                names=["key", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    out = found.mapInArrow(run, f"key {kind}, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumnRenamed("key", key), {"tokens": tokens, "types": types, "weights": weights}
