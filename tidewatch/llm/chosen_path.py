"""Near-duplicate documents by a chosen-path set similarity join.

A document's set is its distinct word shingles (64-bit hashes). Documents with
equal sets form one class. Classes branch in ``trees`` independent trees: at a
node a class follows each of its tokens with probability ``1 / (share *
size)``, decided by the node's own hash of the token, so two sets at the
threshold share at least one child per node on average. The first level
chooses among all shingles, later ones among the class's 128 minwise tokens
(smallest hash in each of 128 hash ranges). In a node with at most ``leaf``
classes outside its largest component, these are compared with all of its
classes, which is exact for components and costs at most ``leaf`` comparisons
a class. In any other node every class is compared with a pivot (a random
member, another one in each node), and the node branches on: first into
overlapping windows of set sizes (two sets at the threshold always share
one), then by tokens. What is still open after ``depth`` levels (dense groups
of texts that are similar, but not enough) is handled exactly by prefixes: in
an order of tokens by their frequency there, rarest first, two sets at the
threshold share a token among the first few of each, at places that leave
enough tokens for the overlap.

A few trees run first: each class confirms one candidate of theirs, and the
forest of these links connects most near-copies. After that only nodes with
several components are looked at, and only pairs across components. Links are
confirmed after the first level of all trees, and once for all later levels.

In a node, a pair whose sizes rule the threshold out, or whose one-bit minwise
values (of up to 64) differ in more places than six standard deviations above
the mean at the threshold, is not looked at further. The others pass a parity
filter that loses no link: every class has a bitmap of two to four bits
a shingle (512 to ``2**15``), in which each shingle flips the bit at its hash.
Two bitmaps differ in at most as many bits as their sets have shingles that the
other lacks, so a pair whose bitmaps differ more than the threshold allows is
no link. Members of a node carry the bitmaps folded to 128 bits, so that most
pairs of texts that are similar, but not enough, are never rows; the exact
prefixes carry them folded to 512 bits. Candidates are held against the whole
bitmaps, and what is left is confirmed on full sets.
Components come from :mod:`components`. Tables that no later step reads are
deleted when the next one is written.

Recall: a pair at the threshold meets in one tree with probability about 0.6,
0.47 and 0.37 at levels 1 to 3, so 24 trees miss it in 1e-9, 1e-6 and 2e-5 of
cases; a pair above the threshold meets more often.

No group beyond ``leaf`` members is collected or expanded into all pairs; hot
nodes are pre-aggregated, and joins on nodes, classes and documents are ones
that Spark's skew handling can split. Texts are read again only for classes
that have candidates; the broadcast that finds them has at most ``SLOTS`` rows.

Edge cases: null, empty and wordless texts have an empty set, are linked with
nothing and keep their own id; rows with a null key are linked with nothing
(component null, kept); rows that share a key are one node; texts of fewer
words than a shingle are one shingle; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import math
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.components import connected
from tidewatch.llm.words import LOWER, NON_SPACE, blocks, mix, shingles, span_hashes, tidy, word_spans
from tidewatch.session import cut_lineage, drop_stage

BINS = 128
SKETCH = ("b", "u", "p1", "p2")  # one-bit values, which of them exist, and a parity bitmap folded to 128 bits
FOLDS = tuple(f"q{i}" for i in range(8))  # a parity bitmap folded to 512 bits
PARITY_BITS = (1 << 9, 1 << 15)
MEMBER = ("cid", "n", *SKETCH)
SLOTS = 1 << 18
_SEED = np.uint64(0xD1B54A32D192ED03)


def _sets(texts: pa.Array, width: int):
    """Index and shingle set of every text."""
    for i, j, buf, offs in blocks(texts):
        low = LOWER[buf]
        starts, ends, first = word_spans(low, offs, NON_SPACE)
        words = span_hashes(low, starts, ends)
        for k in range(j - i):
            yield i + k, shingles(words[first[k]: first[k + 1]], width)


def _digest(s: np.ndarray) -> int:
    """64-bit value of a set."""
    return int(mix(mix(s ^ _SEED).sum(keepdims=True) + np.uint64(len(s))).view(np.int64)[0])


def _minwise(s: np.ndarray) -> np.ndarray:
    """Smallest 16 bits in each of ``BINS`` hash ranges, 0xFFFF for an empty one (sets are sorted)."""
    out = np.full(BINS, 0xFFFF, dtype="<u2")
    bins = (s >> np.uint64(57)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
    out[bins[first]] = np.minimum((s[first] >> np.uint64(41)) & np.uint64(0xFFFF), 0xFFFE).astype(np.uint16)
    return out


def _bits(minwise: np.ndarray) -> list[int]:
    """Lowest bit of the minwise value of every two neighbouring ranges (0 for empty ones) and the ranges that are not empty, 64 bits each."""
    low = np.where(minwise[::2] != 0xFFFF, minwise[::2], minwise[1::2])
    used = low != 0xFFFF
    return [*np.packbits((low & 1) & used).view(np.int64).tolist(), *np.packbits(used).view(np.int64).tolist()]


def _parity(s: np.ndarray) -> np.ndarray:
    """Bitmap in which every member of a set flips one bit (bytes)."""
    least, most = PARITY_BITS
    bits = min(most, max(least, 1 << (2 * len(s) - 1).bit_length()))
    return np.packbits(np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little")


def _folded(rows: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (one a row) as those of ``size`` bytes: the halves' exclusive or."""
    while rows.shape[1] > size:
        half = rows.shape[1] // 2
        rows = rows[:, :half] ^ rows[:, half:]
    return rows


def _rows_of(column: pa.Array, at: np.ndarray) -> np.ndarray:
    """The bitmaps of rows ``at``, which are of equal sizes."""
    return np.frombuffer(b"".join(column.take(pa.array(at)).to_pylist()), np.uint8).reshape(len(at), -1)


def _children(s: np.ndarray, nodes: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Child nodes that a set chooses below each of ``nodes``, and the number of the parent."""
    limit = np.uint64(min(2.0**64 - 2048, 2.0**64 / (share * len(s))))
    odd = (mix(nodes ^ _SEED) | np.uint64(1))[:, None]
    chosen = ((s ^ nodes[:, None]) * odd) < limit
    at, token = np.nonzero(chosen)
    return mix(mix(nodes[at]) + s[token]), at


def _roots(trees: int) -> np.ndarray:
    return mix(np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def class_rows(docs: DataFrame, key: str, text: str, width: int, share: float, trees: int, early: int) -> DataFrame:
    """``key, n, cid, nodes, early, minwise, parity`` and the one-bit sketch; ``cid`` is the set's digest, ``early``
    counts the nodes of the first trees."""
    kind = dict(docs.dtypes)[key]
    names = ["key", "n", "cid", "nodes", "early", "minwise", "parity", *SKETCH]
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * len(SKETCH)]

    def run(batches):
        roots = _roots(trees)
        for batch in batches:
            rows = []
            for _, s in _sets(batch.column(1), width):
                if len(s):
                    (nodes, tree), least, parity = _children(s, roots, share), _minwise(s), _parity(s)
                    rows.append((len(s), _digest(s), nodes.view(np.int64), int(np.searchsorted(tree, early)), least.tobytes(), parity.tobytes(),
                                 *_bits(least), *_folded(parity[None, :], 16).view(np.int64)[0].tolist()))
                else:
                    rows.append((0, 0, (), 0, b"", b"", 0, 0, 0, 0))
            cols = zip(*rows, strict=True) if rows else [()] * len(types)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=names)

    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        tidy(run), f"key {kind}, n long, cid long, nodes array<long>, early int, minwise binary, parity binary, " + ", ".join(f"{c} long" for c in SKETCH))


def with_frequency(tokens: DataFrame) -> DataFrame:
    """``token, cid`` and ``f``, the number of the token's rows: each row is dealt
    once and counted where it lies, without a join of the rows with their counts."""
    return tokens.withColumn("f", F.count("*").over(Window.partitionBy("token")))


class _Join:
    """State of one run: documents, class table, links and labels so far."""

    def __init__(self, docs, key, text, width, num, den, trees, leaf, early):
        self.docs = docs.select(F.col(key).alias("rep"), F.col(text).cast("string").alias("text"))
        self.width, self.num, self.den, self.share, self.leaf = width, num, den, num / den, leaf
        sets = cut_lineage(class_rows(docs, key, text, width, self.share, trees, early), "sets")
        cols = ("n", "nodes", "early", "minwise", "parity", *SKETCH)
        self.classes = cut_lineage(sets.where("n > 0 and key is not null").groupBy("cid")
                                   .agg(F.min("key").alias("rep"), *[F.first(c).alias(c) for c in cols]), "classes")
        self.rows = cut_lineage(sets.select("key", "n", "cid"), "ids")
        drop_stage(sets)
        # rows that share a key are one document
        shared = self.rows.where("n > 0 and key is not null").groupBy("key").agg(F.min("cid").alias("a"), F.max("cid").alias("z")).where("a < z")
        ties = self.rows.where("n > 0").join(shared.select("key", "a"), "key").select("a", F.col("cid").alias("b")).where("a <> b").distinct()
        self.links = cut_lineage(ties, "links")
        self.labels = connected(self.links)

    # --- full sets

    def texts_of(self, wanted: DataFrame) -> DataFrame:
        """Texts joined to ``wanted`` (with ``rep``): only rows whose key shares a hash slot take part."""
        slot = F.pmod(F.xxhash64("rep"), F.lit(SLOTS))
        slots = wanted.select(slot.alias("slot")).distinct()  # at most SLOTS rows
        some = self.docs.withColumn("slot", slot).join(F.broadcast(slots), "slot", "left_semi").drop("slot")
        return some.join(wanted, "rep")

    def with_sets(self, wanted: DataFrame) -> DataFrame:
        """``wanted(rep, cid, hub)`` to ``cid, hub, words`` (sorted hashes as bytes)."""
        width = self.width

        def run(batches):
            for batch in batches:
                sets = [s for _, s in _sets(batch.column(0), width)]
                same = pa.array([bool(len(s)) and _digest(s) == c for s, c in zip(sets, batch.column(1).to_pylist(), strict=True)], pa.bool_())
                out = pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array([s.tobytes() for s in sets], pa.binary())], names=["cid", "hub", "words"])
                yield out.filter(same)  # rows that share a key may hold other texts

        return self.texts_of(wanted).select("text", "cid", "hub").mapInArrow(tidy(run), "cid long, hub long, words binary")

    def confirm(self, pairs: DataFrame) -> None:
        """Adds the pairs (a, b) whose full sets reach the threshold; components change only with new links."""
        if pairs.isEmpty():
            return
        num, den = self.num, self.den
        named = self.classes.select("cid", "rep")
        hubs = self.with_sets(pairs.select(F.col("a").alias("cid")).distinct().join(named, "cid").select("rep", "cid", F.col("cid").alias("hub")))
        hubs = hubs.groupBy("hub").agg(F.first("words").alias("other"))
        leaves = self.with_sets(pairs.select(F.col("b").alias("cid"), F.col("a").alias("hub")).join(named, "cid").select("rep", "cid", "hub"))

        def run(batches):
            for batch in batches:
                keep = []
                for x, y in zip(batch.column(2), batch.column(3), strict=True):
                    s, t = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                    both = len(s) + len(t) - len(np.unique(np.concatenate([s, t])))
                    keep.append(den * both >= num * (len(s) + len(t) - both))
                yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

        found = leaves.join(hubs, "hub").select(F.col("hub").alias("a"), F.col("cid").alias("b"), "words", "other")
        new = cut_lineage(found.mapInArrow(tidy(run), "a long, b long"), "links")
        if not new.isEmpty():
            self.links = self.links.union(new)
            self.labels = connected(self.links)
        else:
            drop_stage(new)

    # --- nodes

    def members(self, nodes) -> DataFrame:
        return self.classes.select(F.explode(nodes).alias("node"), "cid")

    def opened(self, members: DataFrame) -> DataFrame:
        """Members of nodes with more than one component: with ``root``, the node's largest
        component ``top``, the number of classes ``outside`` it, and a ``pivot``."""
        rooted = members.join(self.labels.toDF("cid", "root"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
        parts = rooted.groupBy("node", "root").agg(F.count("*").alias("k"), F.min(F.struct(F.xxhash64("node", "cid").alias("h"), "cid")).alias("p"))
        nodes = parts.groupBy("node").agg(F.sum("k").alias("members"), F.max(F.struct("k", "root")).alias("t"), F.min("p").alias("p"))
        nodes = nodes.where("members > t.k").select("node", F.col("t.root").alias("top"), (F.col("members") - F.col("t.k")).alias("outside"), F.col("p.cid").alias("pivot"))
        return cut_lineage(rooted.join(nodes, "node").join(self.classes.select(*MEMBER), "cid"), "nodes")

    def possible(self, x, y):
        """Pairs across components that sizes, one-bit sketches and folded parity bitmaps allow."""
        odds = (1 - self.share) / 2
        far, used = F.bit_count(x["b"].bitwiseXOR(y["b"])), F.bit_count(x["u"].bitwiseOR(y["u"]))
        return ((x["root"] != y["root"]) & (F.least(x["n"], y["n"]) * self.den >= F.greatest(x["n"], y["n"]) * self.num)
                & (far <= used * odds + 6 * F.sqrt(used * odds * (1 - odds))) & self.near(x, y, ("p1", "p2")))

    def near(self, x, y, columns):
        """Pairs whose parity bitmaps (64 bits a column) differ in no more bits than the threshold allows shingles that one lacks."""
        far = reduce(lambda p, q: p + q, [F.bit_count(x[c].bitwiseXOR(y[c])) for c in columns])
        n = x["n"] + y["n"]
        return far <= n - 2 * F.ceil(n * self.num / (self.num + self.den))

    def pairs(self, opened: DataFrame) -> DataFrame:
        """Distinct candidate pairs (a < b): classes outside the largest component with all, pivots of the other nodes."""
        member = F.struct(*MEMBER, "root")
        x, y = F.col("x"), F.col("y")
        closed = opened.where(F.col("outside") <= self.leaf)
        outside = closed.where("root <> top").groupBy("node").agg(F.collect_list(member).alias("m"))  # at most leaf
        both = closed.select("node", member.alias("y")).join(outside, "node").select(F.explode("m").alias("x"), "y")
        both = both.where(self.possible(x, y))
        large = opened.where(F.col("outside") > self.leaf)
        star = large.select("node", member.alias("x")).join(large.where("cid = pivot").select("node", member.alias("y")), "node").where(self.possible(x, y))
        return (both.select("x.cid", y["cid"].alias("other")).union(star.select("x.cid", y["cid"]))
                .select(F.least("cid", "other").alias("a"), F.greatest("cid", "other").alias("b")).distinct())

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose parity bitmaps differ in no more bits than the threshold allows shingles that one lacks."""
        num, den = self.num, self.den

        def run(batches):
            for batch in batches:
                n = sum(batch.column(i).to_numpy().astype(np.int64) for i in (2, 3))
                most = n - 2 * -(-n * num // (num + den))
                left, right = batch.column(4), batch.column(5)
                sizes = np.stack([pc.binary_length(c).to_numpy(zero_copy_only=False) for c in (left, right)], axis=1)
                far = np.zeros(len(n), np.int64)
                for pair in np.unique(sizes, axis=0):
                    at = np.flatnonzero((sizes == pair).all(axis=1))
                    x, y = (_folded(_rows_of(c, at), int(pair.min())) for c in (left, right))
                    far[at] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
                yield batch.select([0, 1]).filter(pa.array(far <= most))

        left, right = (self.classes.select(F.col("cid").alias(c), F.col("n").alias(f"n{c}"), F.col("parity").alias(f"p{c}")) for c in ("a", "b"))
        joined = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "pa", "pb")
        return cut_lineage(joined.mapInArrow(tidy(run), "a long, b long"), "likely")

    def folds(self, members: DataFrame) -> DataFrame:
        """``cid, n`` and the parity bitmap in 512 bits of the members' classes."""
        size = 8 * len(FOLDS)

        def run(batches):
            for batch in batches:
                words = [_folded(np.frombuffer(p.as_buffer(), np.uint8)[None, :], size).view(np.int64)[0] for p in batch.column(2)]
                table = np.array(words, np.int64).reshape(-1, len(FOLDS))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c) for c in table.T.copy())], names=["cid", "n", *FOLDS])

        named = members.select("cid").distinct().join(self.classes.select("cid", "n", "parity"), "cid")
        return named.mapInArrow(tidy(run), "cid long, n long, " + ", ".join(f"{c} long" for c in FOLDS))

    def still_open(self, opened: DataFrame) -> DataFrame:
        """Members of the nodes that were not compared in full, for the next level."""
        return opened.where(F.col("outside") > self.leaf).select("node", "cid")

    def prefix_pairs(self, members: DataFrame) -> DataFrame:
        """All pairs of the members' classes that can reach the threshold, by prefixes of their token lists."""
        num, den = self.num, self.den

        def run(batches):
            for batch in batches:
                for cid, words in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    tokens = np.frombuffer(words.as_buffer(), np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(np.full(len(tokens), cid))], names=["token", "cid"])

        wanted = members.select("cid").distinct().join(self.classes.select("cid", "rep"), "cid").select("rep", "cid", F.col("cid").alias("hub"))
        sets = self.with_sets(wanted).groupBy("cid").agg(F.first("words").alias("words"))
        tokens = cut_lineage(sets.mapInArrow(tidy(run), "token long, cid long"), "tokens")
        # tokens of one class alone come first in its order and join with nothing: they only count
        own, n = Window.partitionBy("cid"), F.col("n")
        placed = (with_frequency(tokens).where("f > 1").withColumn("shared", F.count("*").over(own))
                  .withColumn("place", F.row_number().over(own.orderBy("f", "token"))).join(self.folds(members), "cid")
                  .withColumn("place", F.col("place") + n - F.col("shared")).drop("shared")
                  .where(F.col("place") <= n - F.ceil(n * num / den) + 1))
        placed = cut_lineage(placed.join(self.labels.toDF("cid", "root"), "cid", "left").withColumn("root", F.coalesce("root", "cid")), "prefixes")
        drop_stage(tokens)
        # the shorter set (or, at equal sizes, the smaller id) needs the token in a shorter prefix
        short = placed.where(F.col("place") <= n - F.ceil(n * (2 * num) / (num + den)) + 1)
        x, y = (t.select("token", F.struct("cid", "n", "place", "root", *FOLDS).alias(c)) for t, c in ((short, "x"), (placed, "y")))
        x_, y_ = F.col("x"), F.col("y")
        most = 1 + F.least(x_["n"] - x_["place"], y_["n"] - y_["place"])
        fits = ((x_["root"] != y_["root"]) & ((x_["n"] < y_["n"]) | (x_["n"] == y_["n"]) & (x_["cid"] < y_["cid"]))
                & (x_["n"] * den >= y_["n"] * num) & (most * (num + den) >= (x_["n"] + y_["n"]) * num)
                & self.near(x_, y_, FOLDS))
        pairs = cut_lineage(x.join(y, "token").where(fits).select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b")).distinct(), "pairs")
        drop_stage(placed)
        return pairs

    def windows(self, members: DataFrame) -> DataFrame:
        """Nodes split by set size: bands of one threshold ratio, two neighbouring bands in a window."""
        band = F.floor(F.log(F.col("n").cast("double")) / -math.log(self.share)).cast("int")
        sized = members.join(self.classes.select("cid", "n"), "cid")
        return sized.select("cid", "node", F.explode(F.array(band, band + 1)).alias("band")).select(F.xxhash64("node", "band").alias("node"), "cid")

    def branch(self, members: DataFrame) -> DataFrame:
        """Children by chosen minwise tokens."""
        share = self.share

        def run(batches):
            at = np.arange(BINS, dtype=np.uint64) << np.uint64(16)
            for batch in batches:
                taken, nodes = [], []
                for i, (node, raw) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1), strict=True)):
                    least = np.frombuffer(raw.as_buffer(), "<u2")
                    used = least != 0xFFFF
                    kids, _ = _children(mix(at[used] | least[used].astype(np.uint64)), np.array([node], np.int64).view(np.uint64), share)
                    taken += [i] * len(kids)
                    nodes += kids.view(np.int64).tolist()
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), batch.column(2).take(pa.array(taken, pa.int64()))], names=["node", "cid"])

        named = members.join(self.classes.select("cid", "minwise"), "cid").select("node", "minwise", "cid")
        return named.mapInArrow(tidy(run), "node long, cid long")


@contextmanager
def _batch_rows(spark, rows: int):
    """Rows of texts and sets travel to Python in smaller batches meanwhile (every job with Python ends inside)."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before))) if int(before) > 0 else str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, num: int = 80, den: int = 100,
                    trees: int = 24, leaf: int = 64, depth: int = 3, early: int = 3) -> DataFrame:
    """``key, n_shingles, component_id, kept`` for every row; ``component_id`` is the
    smallest key reachable over links with ``den * intersection >= num * union``."""
    with _batch_rows(docs.sparkSession, 2000):
        j = _Join(docs, key, text, width, num, den, trees, leaf, early)
        opened = j.opened(j.members(F.slice("nodes", F.lit(1), F.col("early"))))
        forest = cut_lineage(j.pairs(opened).groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "forest")
        drop_stage(opened)
        j.confirm(forest)
        drop_stage(forest)
        members, found, before = j.members("nodes"), [], None
        for level in range(depth):
            opened = j.opened(members)
            if before is not None:
                drop_stage(before)
            if opened.isEmpty():
                break
            pairs = cut_lineage(j.pairs(opened), "pairs")
            found.append(j.likely(pairs))
            drop_stage(pairs)
            if level == 0:  # later levels find few links: their candidates are confirmed together
                j.confirm(found[0])
                drop_stage(found.pop())
            members = j.still_open(opened)
            if members.isEmpty():
                break
            if level == depth - 1:
                pairs = j.prefix_pairs(members)
                found.append(j.likely(pairs))
                drop_stage(pairs)
            else:
                members = before = cut_lineage(j.branch(members) if level else j.windows(members), "members")
            drop_stage(opened)
        if found:
            j.confirm(reduce(DataFrame.union, found).distinct())
    named = j.classes.select("cid", "rep").join(j.labels.toDF("cid", "root"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = named.groupBy("root").agg(F.min("rep").alias("component"))
    final = cut_lineage(named.join(least, "root").select("cid", "component"), "components")
    out = j.rows.select("key", "n", F.when(F.col("n") > 0, F.col("cid")).alias("cid")).join(final, "cid", "left")
    component = F.when(F.col("key").isNotNull(), F.coalesce("component", "key"))
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(component == F.col("key"), F.lit(True)).alias("kept"))


def meeting_probability(similarity: float, share: float, level: int) -> float:
    """Chance that two sets share a node after ``level`` levels of one tree."""
    p = 1.0
    for _ in range(level):
        p = 1 - math.exp(-similarity / share * p)
    return p
