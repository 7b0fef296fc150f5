"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages (runs of ``PASSAGE`` words). Every passage is
encoded: surface statistics (word lengths, symbol classes, capitals, digits,
repetition inside the passage) go through one learned tanh layer. Gated
attention, ``softmax(w . (tanh(V h) * sigmoid(U h)))``, weighs the passages
with parameters learned from document labels alone, and a logistic unit scores
the weighted passage representation. Gradients are written out below; Adam
minimises the class-balanced log loss.

The model is fitted on the driver from a bounded sample of labelled rows:
at most ``max_docs`` of each class, those with the smallest hash of the key, and at
most ``max_passages`` passages. Scoring is one scan of all texts without a
shuffle; a long text's passages are pooled in one pass, so memory follows the
block of texts.

Edge cases: null, empty and wordless texts are bags of one passage of zeros
and get the score the model gives that; null labels and keys are not learned
from; with labels of one class only (or none) every score is that class's share (0.5 without labels);
repeated rows are scored each; an empty table gives an empty result; extra
columns are ignored by the score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.words import LOWER, NON_SPACE, blocks, mix, span_hashes, sums, tidy, word_spans

PASSAGE = 64
MAX_DOCS = 1000
MAX_PASSAGES = 120_000
HIDDEN, GATE = 16, 8

_CLASSES = np.zeros((6, 256), dtype=bool)
_CLASSES[0, list(b"#*$%&<>")] = True
_CLASSES[1, list(b"|")] = True
_CLASSES[2, list(b"!?")] = True
_CLASSES[3, list(b".,;:")] = True
_CLASSES[4, list(b"0123456789")] = True
_CLASSES[5, list(range(0x41, 0x5B))] = True
N_FEATURES = 2 * len(_CLASSES) + 8


def passage_features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages of some texts, and each text's first passage."""
    starts, ends, first = word_spans(buf, offs, NON_SPACE)
    words = np.diff(first)
    per_doc = np.maximum(1, -(-words // PASSAGE))
    bag = np.r_[0, np.cumsum(per_doc)]
    n = int(bag[-1])
    out = np.zeros((n, N_FEATURES))
    if not len(starts):
        return out, bag
    doc = np.repeat(np.arange(len(words)), words)
    place = np.arange(len(starts)) - first[doc]
    passage = bag[doc] + place // PASSAGE
    bound = np.searchsorted(passage, np.arange(n + 1))
    count = np.maximum(1, np.diff(bound)).astype(np.float64)
    length = (ends - starts).astype(np.float64)
    chars = np.maximum(1.0, sums(length, bound))
    h = span_hashes(LOWER[buf], starts, ends)
    repeat = np.zeros(len(h))
    repeat[1:] = (h[1:] == h[:-1]) & (passage[1:] == passage[:-1])
    firsts = np.unique(mix(h + passage.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
    distinct = np.bincount(passage[firsts], minlength=n)
    k = 0
    for marks in _CLASSES:
        total = np.zeros(len(buf) + 1, dtype=np.int64)
        np.cumsum(marks[buf], out=total[1:])
        per_word = total[ends] - total[starts]
        out[:, k] = sums(per_word, bound) / chars * 10
        out[:, k + 1] = sums((per_word > 0).astype(np.float64), bound) / count
        k += 2
    wide = (buf[starts] >= 0x80).astype(np.float64)
    for column in (sums(length, bound) / count / 8, sums((length > 16).astype(np.float64), bound) / count,
                   sums(repeat, bound) / count, distinct / count, sums((length == 1).astype(np.float64), bound) / count,
                   sums(wide, bound) / count, count / PASSAGE, np.ones(n)):
        out[:, k] = column
        k += 1
    out[np.diff(bound) == 0] = 0.0
    return out, bag


class Model:
    """Encoder, gated attention and logistic unit."""

    def __init__(self, n_in: int, seed: int = 7):
        g = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(n_in), np.ones(n_in)
        self.p = {"W": g.normal(0, n_in**-0.5, (n_in, HIDDEN)), "b": np.zeros(HIDDEN),
                  "V": g.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "U": g.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
                  "w": g.normal(0, 0.1, GATE), "c": g.normal(0, HIDDEN**-0.5, HIDDEN), "d": np.zeros(1)}

    def forward(self, x: np.ndarray, bag: np.ndarray) -> tuple[np.ndarray, dict]:
        p = self.p
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        which = np.repeat(np.arange(len(bag) - 1), np.diff(bag))
        e = np.exp(e - np.maximum.reduceat(e, bag[:-1])[which])
        a = e / np.add.reduceat(e, bag[:-1])[which]
        z = np.add.reduceat(a[:, None] * h, bag[:-1])
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        return y, {"x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "which": which}

    def gradient(self, f: dict, bag: np.ndarray, error: np.ndarray) -> dict[str, np.ndarray]:
        """``error``: derivative of the loss by the logit, per bag."""
        p, w = self.p, f["which"]
        dz = error[:, None] * p["c"]
        along = (dz[w] * f["h"]).sum(1)  # derivative by each attention weight
        de = f["a"] * (along - np.add.reduceat(f["a"] * along, bag[:-1])[w])
        gate = de[:, None] * p["w"]
        dt, ds = gate * f["s"] * (1 - f["t"] ** 2), gate * f["t"] * f["s"] * (1 - f["s"])
        dh = (f["a"][:, None] * dz[w] + dt @ p["V"].T + ds @ p["U"].T) * (1 - f["h"] ** 2)
        return {"W": f["x"].T @ dh, "b": dh.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ ds,
                "w": (de[:, None] * f["t"] * f["s"]).sum(0), "c": f["z"].T @ error, "d": error.sum(keepdims=True)}

    def fit(self, x: np.ndarray, bag: np.ndarray, label: np.ndarray, steps: int = 250, rate: float = 0.03, decay: float = 1e-4) -> Model:
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        balance = np.where(label == 1, 0.5 / max(1, (label == 1).sum()), 0.5 / max(1, (label == 0).sum()))
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(u) for k, u in self.p.items()}
        for step in range(1, steps + 1):
            y, f = self.forward(x, bag)
            for k, g in self.gradient(f, bag, (y - label) * balance).items():
                g = g + decay * self.p[k]
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.99 * v[k] + 0.01 * g * g
                self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
        return self


def _bags(batches):
    """Passage features of the text column (the last one), as one binary value a row."""
    for batch in batches:
        rows: list[bytes] = []
        for i, j, buf, offs in blocks(batch.column(batch.num_columns - 1)):
            x, bag = passage_features(buf, offs)
            x = x.astype("<f4")
            rows += [x[bag[k]: bag[k + 1]].tobytes() for k in range(j - i)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["label", "bag"])


def learnable(key: str) -> Column:
    """Rows that labels may be learned from: crc32 of the key as text, mod 3, is not 1."""
    return F.crc32(F.encode(F.col(key).cast("string"), "UTF-8")) % 3 != 1


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        max_docs: int = MAX_DOCS, max_passages: int = MAX_PASSAGES) -> Model | float:
    """Model from a bounded sample of the labelled rows, or a constant score
    where there are not two classes."""
    marked = (labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & learnable(key))
              .select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")))
    order = F.xxhash64("key", F.lit(11))
    chosen = [r for side in (0, 1) for r in marked.where(F.col("label") == side).orderBy(order, "key").limit(max_docs).collect()]
    shares = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not shares.get(0) or not shares.get(1):
        return shares.get(1, 0) / sum(shares.values()) if shares else 0.5
    picked = docs.sparkSession.createDataFrame([(r["key"], r["label"]) for r in chosen], "key " + dict(docs.dtypes)[key] + ", label int")
    sample = (docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
              .join(F.broadcast(picked), "key").select("label", "text").mapInArrow(tidy(_bags), "label int, bag binary"))
    bags, label_of, size = [], [], 0
    for r in sample.toLocalIterator():
        x = np.frombuffer(r["bag"], "<f4").reshape(-1, N_FEATURES)
        if size + len(x) <= max_passages:
            bags.append(x)
            label_of.append(r["label"])
            size += len(x)
    y = np.array(label_of, dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.5
    return Model(N_FEATURES).fit(np.concatenate(bags).astype(np.float64), np.r_[0, np.cumsum([len(x) for x in bags])], y)


def score(docs: DataFrame, model: Model | float, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the model's score, 0 to 1 (higher: label 1 is likelier)."""
    names, where = [*docs.columns, out], docs.columns.index(text)

    def run(batches):
        for batch in batches:
            scores = [np.zeros(0)]
            for i, j, buf, offs in blocks(batch.column(where)):
                if isinstance(model, float):
                    scores.append(np.full(j - i, model))
                else:
                    x, bag = passage_features(buf, offs)
                    scores.append(model.forward(x, bag)[0])
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(batch.num_columns)), pa.array(np.concatenate(scores), pa.float64())], names=names)

    return docs.mapInArrow(tidy(run), T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))
