"""Quality rules whose thresholds adapt to language and source.

One scan measures every whole text. Quantile sketches of the rule metrics are
kept per (language, source), per language and for all rows; sketches are
mergeable, so Spark builds them next to the data and merges them in the
shuffle, also for a group that holds most rows. A metric's fence is its upper
(or lower) quartile plus ``reach`` interquartile ranges, each range taken as
at least the metric's ``slack``, so a group of clean texts keeps all of them.
Groups with fewer than ``least_rows`` rows use their language's fences, or
those of all rows. The fences come back to the rows by a join on
(language, source) that Spark may split when a group is hot.

Edge cases: null and empty texts have zero metrics and fail the base rule;
null language or source is a group of its own; repeated rows count each; an
empty table gives an empty result; extra columns are ignored (``keep`` carries
the wanted ones).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.words import NON_SPACE, blocks, code_points, mix, span_hashes, sums, word_spans
from tidewatch.session import cut_lineage

WINDOW = 8
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURED = (*COUNTS, "n_lines")  # lines with a word: only the rules need them


@dataclass(frozen=True)
class Rule:
    """A metric (SQL over the counts), the side it may fail on and its smallest spread."""

    name: str
    metric: str
    slack: float
    low: bool = False


RULES = (
    Rule("word_length", "word_chars / n_words", 0.5),
    Rule("short_words", "word_chars / n_words", 0.5, low=True),
    Rule("symbols", "n_symbols / n_words", 0.02),
    # a clean group's fence is at 18 %, below the 30 % of the base rule
    Rule("dup_lines", "n_dup_lines / n_lines", 0.03),
    Rule("repeats", "n_repeat_words / n_words", 0.03),
)


def text_counts(buf: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """The counts of ``MEASURED`` for some texts."""
    n = len(offs) - 1
    starts, ends, first = word_spans(buf, offs, NON_SPACE)
    points = code_points(buf)
    n_words = np.diff(first)
    word_chars = sums(points[ends] - points[starts], first)
    symbols = np.zeros(len(buf) + 1, dtype=np.int64)
    np.cumsum(_SYMBOL[buf], out=symbols[1:])
    # lines with a word: one hash per (text, line); a line beyond the first of its kind is a copy
    breaks = np.flatnonzero(buf == 0x0A)
    begin = np.union1d(offs[:-1][n_words > 0], breaks + 1)
    begin = begin[begin < len(buf)]
    doc = np.searchsorted(offs, begin, side="right") - 1
    end = np.minimum(np.r_[breaks, len(buf)][np.searchsorted(breaks, begin)], offs[doc + 1])
    worded = np.searchsorted(starts, end) > np.searchsorted(starts, begin)
    begin, end, doc = begin[worded], end[worded], doc[worded]
    line = mix(span_hashes(buf, begin, end) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    kinds = np.unique(line, return_index=True)[1]
    n_lines = np.bincount(doc, minlength=n)
    n_dup = n_lines - np.bincount(doc[kinds], minlength=n)
    return [n_words, word_chars, symbols[offs[1:]] - symbols[offs[:-1]], n_dup, _repeat_words(span_hashes(buf, starts, ends), first), n_lines]


def _repeat_words(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words inside windows of ``WINDOW`` words that a text has twice or more."""
    n, total = len(first) - 1, len(words)
    if total < WINDOW:
        return np.zeros(n, dtype=np.int64)
    doc = np.repeat(np.arange(n), np.diff(first))
    h = words[: total - WINDOW + 1].copy()
    for j in range(1, WINDOW):
        h = mix(h * np.uint64(0x9FB21C651E98DF25) + words[j: total - WINDOW + 1 + j])
    inside = doc[: len(h)] == doc[WINDOW - 1:]
    at = np.flatnonzero(inside)
    key = mix(h[at] + doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, which, count = np.unique(key, return_inverse=True, return_counts=True)
    found = at[count[which] > 1]
    step = np.zeros(total + 1, dtype=np.int64)
    np.add.at(step, found, 1)
    np.add.at(step, found + WINDOW, -1)
    return sums((np.cumsum(step[:-1]) > 0).astype(np.int64), first)


def measure(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and the counts of every row's whole text."""
    source = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).cast("string").alias("body"))
    kinds = dict(source.dtypes)
    names = [f"k{i}" for i in range(len(keep))]

    def run(batches):
        for batch in batches:
            found = [[np.zeros(0, np.int64)] for _ in MEASURED]
            for _, _, buf, offs in blocks(batch.column("body")):
                for into, values in zip(found, text_counts(buf, offs), strict=True):
                    into.append(values)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *(pa.array(np.concatenate(v), pa.int64()) for v in found)],
                                             names=[*names, *MEASURED])

    out = source.mapInArrow(run, ", ".join([*(f"{c} {kinds[c]}" for c in names), *(f"{c} long" for c in MEASURED)]))
    return out.toDF(*keep, *MEASURED)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _metric(rule: Rule) -> Column:
    return F.when(F.col("n_words") > 0, F.expr(rule.metric).cast("double"))


def fences(measured: DataFrame, groups: list[str], reach: float = 6.0, least_rows: int = 50, accuracy: int = 2000) -> DataFrame:
    """``groups`` and one fence per rule, from sketches at every level."""
    def level(by: list[str]) -> DataFrame:
        quartiles = [F.percentile_approx(_metric(r), [0.25, 0.75], accuracy).alias(r.name) for r in RULES]
        rows = measured.where("n_words > 0").groupBy(*by).agg(F.count("*").alias("rows"), *quartiles)
        limits = []
        for r in RULES:
            q1, q3 = F.col(r.name)[0], F.col(r.name)[1]
            spread = F.greatest(q3 - q1, F.lit(r.slack)) * reach
            limits.append((q1 - spread if r.low else q3 + spread).alias(r.name))
        return rows.select(*by, "rows", *limits)

    named = [r.name for r in RULES]
    own = level(groups)
    wide = level(groups[:1]).select(F.col(groups[0]).alias("wide_key"), F.struct(*[F.when(F.col("rows") >= least_rows, F.col(c)).alias(c) for c in named]).alias("wide"))
    all_rows = level([]).select(F.struct(*named).alias("v")).scalar()
    out = own.join(wide, F.col(groups[0]).eqNullSafe(F.col("wide_key")), "left").withColumn("every", all_rows)
    return out.select(*groups, *[F.coalesce(F.when(F.col("rows") >= least_rows, F.col(c)), F.col("wide")[c], F.col("every")[c]).alias(f"fence_{c}") for c in named])


def judge(docs: DataFrame, keep: list[str], groups: list[str], text: str = "text", **options) -> DataFrame:
    """``keep``, the counts, ``base_failed``, ``failed_rules`` and ``kept`` of every row."""
    wanted = [*keep, *[g for g in groups if g not in keep]]
    measured = cut_lineage(measure(docs, wanted, text), "text-counts")
    limits = cut_lineage(fences(measured, groups, **options), "fences")
    keys = [f"g{i}" for i in range(len(groups))]
    limits = limits.toDF(*keys, *limits.columns[len(groups):])
    # equality of present values, so that Spark can split a hot group; null groups are marked

    def side(cols: list[str]) -> list[Column]:
        return [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) for c in cols]

    left = measured.withColumn("_g", F.concat_ws("\u0001", *side(groups)))
    right = limits.withColumn("_g", F.concat_ws("\u0001", *side(keys))).drop(*keys)
    joined = left.join(right, "_g", "left")
    broken = [F.when((_metric(r) < F.col(f"fence_{r.name}")) if r.low else (_metric(r) > F.col(f"fence_{r.name}")), F.lit(r.name)) for r in RULES]
    return joined.select(
        *keep, *COUNTS, base_failed().alias("base_failed"), F.array_compact(F.array(*broken)).alias("failed_rules")
    ).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
