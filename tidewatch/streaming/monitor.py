"""Structured Streaming jobs for the monitor.

* ``windowed_drift_stream`` - event-time tumbling windows. The state per window,
  segment and feature is a mergeable sketch: per bin of the reference's
  distribution the count, mean and variance. A window is written once, when the
  watermark has passed its end, and then leaves the state (append mode).
* ``event_counts_stream`` - counters per window; a micro-batch writes the windows
  it has changed (update mode), readers take the newest row of each.
* ``drift_score_stream`` - the accumulated drift score per segment as arbitrary
  state with timers over two inputs, cycle rows and retrain events.

Results are published per micro-batch in :class:`VersionedTables`, so a batch
that is run again changes nothing. All files go under the session's shared
checkpoint folder. The full monitoring cycle is in ``streaming/cycle.py``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewatch.operators import monitor as mon
from tidewatch.operators.cohorts import as_number, to_long
from tidewatch.operators.drift import _bucket
from tidewatch.operators.small import join_on, join_small
from tidewatch.session import cut_lineage, ensure_checkpoint_dir
from tidewatch.sources.versions import VersionedTables


def scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidewatch/streams/{name}-{uuid.uuid4().hex}"


def once(store: VersionedTables, table: str, make: Callable[[DataFrame], DataFrame]):
    """``foreachBatch`` body that appends ``make(batch)`` to a table, once per batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        done = store.batch()
        if done is None or batch_id > done:
            store.publish(batch_id, appended={table: make(batch).withColumn("batch_id", F.lit(batch_id).cast("long"))})

    return write


def drain(writer, checkpoint: str) -> None:
    """Runs a stream over all input that has arrived and ends it."""
    query = writer.trigger(availableNow=True).option("checkpointLocation", checkpoint).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()


# ------------------------------------------------------------ windowed drift
def width_cuts(reference: DataFrame, features: Sequence[str], keys: Sequence[str], bins: int = 50) -> DataFrame:
    """(keys, feature, cuts): bounds that cut the reference's range into ``bins`` equal parts."""
    long = to_long(reference.withColumn("cohort", F.lit("ref")), features, keys)
    g = long.groupBy(*keys, "feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    step = (F.col("hi") - F.col("lo")) / bins
    return g.select(*keys, "feature", F.transform(F.sequence(F.lit(1), F.lit(bins - 1)), lambda i: F.col("lo") + step * i).alias("cuts"))


def quantile_cuts(reference: DataFrame, features: Sequence[str], keys: Sequence[str], bins: int = 50) -> DataFrame:
    """(keys, feature, cuts): approximate quantiles of the reference, for skewed features."""
    long = to_long(reference.withColumn("cohort", F.lit("ref")), features, keys)
    cuts = F.percentile_approx("value", [i / bins for i in range(1, bins)], 20 * bins)
    return long.groupBy(*keys, "feature").agg(F.array_sort(F.array_distinct(cuts)).alias("cuts"))


def _binned(rows: DataFrame, cuts: DataFrame, features: Sequence[str], keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Long rows ``(keys, by, feature, value, bin, top)``: bin = cuts below the
    value, top = the bin's upper end (the largest cut above the last bin)."""
    named = [F.struct(F.lit(f).alias("feature"), as_number(rows, f)[0].alias("value")) for f in features]
    long = rows.select(*keys, *by, F.explode(F.array(*named)).alias("v")).select(*keys, *by, "v.feature", "v.value").where("value is not null")
    long = join_on(long, cuts, [*keys, "feature"], "left")
    at = F.coalesce(_bucket("cuts", F.col("value")), F.lit(0))
    return long.withColumn("bin", at).drop("cuts")


def _sketch(binned: DataFrame, by: Sequence[str]) -> DataFrame:
    return binned.groupBy(*by, "feature", "bin").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.var_pop("value").alias("var"),
                                                     F.min("value").alias("low"), F.max("value").alias("high"))


def reference_sketch(reference: DataFrame, cuts: DataFrame, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    return _sketch(_binned(reference, cuts, features, keys, []), keys)


def sketch_drift(current: DataFrame, reference: DataFrame, cuts: DataFrame, keys: Sequence[str], effect: float = 0.1,
                 distance: float = 0.05) -> DataFrame:
    """Drift of window sketches ``(keys, window_start, feature, bin, ...)``
    against reference sketches. Cohen's d and Welch t are exact (merged
    moments); KS D and Wasserstein see the distributions at the cuts, so D is at
    most the heaviest bin's share too small."""
    k = [*keys, "window_start", "feature"]
    windows = current.select(*k).distinct()
    ref = join_on(windows, reference, [*keys, "feature"])
    both = current.withColumn("cohort", F.lit("cur")).unionByName(ref.withColumn("cohort", F.lit("ref")))
    cells = both.groupBy(*k, "bin").agg(*[F.coalesce(F.sum(F.when(F.col("cohort") == c, F.col("n"))), F.lit(0)).alias(f"n_{c}") for c in ("ref", "cur")])
    group = Window.partitionBy(*k)
    running = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = {c: F.sum(f"n_{c}").over(group) for c in ("ref", "cur")}
    gap = F.abs(F.try_divide(F.sum("n_ref").over(running), total["ref"]) - F.try_divide(F.sum("n_cur").over(running), total["cur"]))
    cells = join_on(cells.withColumns({"gap": gap, "_after": F.lead("bin").over(group.orderBy("bin"))}), cuts, [*keys, "feature"], "left")

    def end(column: str) -> Column:  # upper end of a bin below the last
        return F.get("cuts", F.col(column))

    # between two cells that hold rows the difference stays as it is
    stretch = end("_after") - end("bin")
    stretch = F.when(F.col("_after") == F.size("cuts"), F.get("cuts", F.size("cuts") - 1) - end("bin")).otherwise(stretch)
    shape = cells.groupBy(*k).agg(F.max("gap").alias("ks_statistic"), F.coalesce(F.sum(F.col("gap") * stretch), F.lit(0.0)).alias("_w"),
                                  F.first(F.get("cuts", F.size("cuts") - 1) - F.get("cuts", F.lit(0))).alias("_extent"))
    moments = both.withColumn("_m", F.sum(F.col("n") * F.col("mean")).over(Window.partitionBy(*k, "cohort")) / F.sum("n").over(Window.partitionBy(*k, "cohort")))
    aggs = []
    for c in ("ref", "cur"):
        own = F.col("cohort") == c
        square = F.col("n") * (F.col("var") + F.pow(F.col("mean") - F.col("_m"), 2))
        count = F.coalesce(F.sum(F.when(own, F.col("n"))), F.lit(0))
        aggs += [count.alias(f"n_{c}"), F.max(F.when(own, F.col("_m"))).alias(f"mean_{c}"),
                 F.when(count > 1, F.sum(F.when(own, square)) / (count - 1)).alias(f"var_{c}")]
    moments = moments.groupBy(*k).agg(*aggs)
    of_reference = moments.select(*k, "n_ref", "mean_ref", "var_ref")
    out = mon.window_drift(moments.select(*k, "n_cur", "mean_cur", "var_cur"), of_reference, [*keys, "window_start"], effect)
    out = join_on(out, shape, k)
    out = out.withColumn("normalized_distance", F.coalesce(F.try_divide("_w", "_extent"), F.lit(0.0))).drop("_w", "_extent")
    return out.withColumn("drift_detected", F.col("drift_detected") | F.coalesce(F.col("normalized_distance") > distance, F.lit(False)))


def windowed_drift_stream(events: DataFrame, reference: DataFrame, cuts: DataFrame, features: Sequence[str], keys: Sequence[str],
                          store: VersionedTables, checkpoint: str, ts: str = "ts", width: str = "1 day", delay: str = "2 days",
                          effect: float = 0.1) -> None:
    """Streams ``events`` into the table ``windows`` of ``store``: drift of every
    closed window against ``reference`` (a :func:`reference_sketch`)."""
    rows = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    rows = rows.withColumn("_window", F.window("_ts", width))
    sketches = _sketch(_binned(rows, cuts, features, keys, ["_window"]), [*keys, "_window"])

    def judged(batch: DataFrame) -> DataFrame:
        closed = cut_lineage(batch.withColumn("window_start", F.col("_window.start").cast("timestamp_ntz")).drop("_window"), "closed-windows")
        return sketch_drift(closed, reference, cuts, keys, effect)

    drain(sketches.writeStream.outputMode("append").foreachBatch(once(store, "windows", judged)), checkpoint)


# ------------------------------------------------------------------ counters
def event_counts_stream(events: DataFrame, store: VersionedTables, checkpoint: str, keys: Sequence[str] = ("event_type",),
                        ts: str = "ts", width: str = "1 day", delay: str = "2 days") -> None:
    """Streams counters per tumbling window into the table ``counts``: a row for
    each window that a micro-batch has changed."""
    rows = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    counts = rows.groupBy(F.window("_ts", width).start.alias("_start"), *keys).agg(F.count("*").alias("n"))

    def changed(batch: DataFrame) -> DataFrame:
        return batch.withColumn("window_start", F.col("_start").cast("timestamp_ntz")).drop("_start")

    drain(counts.writeStream.outputMode("update").foreachBatch(once(store, "counts", changed)), checkpoint)


def newest_counts(store: VersionedTables, keys: Sequence[str] = ("event_type",)) -> DataFrame:
    return store.read("counts").groupBy("window_start", *keys).agg(F.max_by("n", "batch_id").alias("n"))


# ----------------------------------------------------------------- the score
CYCLE, RETRAIN = "cycle", "retrain"
SCORE_IN = ("kind string, at timestamp, cycle int, n_drifted_features long, share_drifted_features double, dataset_drift boolean, "
            "data_added boolean, generation_failed boolean")
SCORE_OUT = ("at timestamp, cycle int, data_added boolean, generation_failed boolean, retrained boolean, reset boolean, increment double, "
             "drift_score double")


# state rows hold Python values of exactly these types
_PLAIN = (str, lambda v: pd.Timestamp(v).to_pydatetime(), int, int, float, bool, bool, bool)


def _gain(n: float, share: float, flag: bool, added: bool) -> float:
    found = mon.SCORE_PER_FEATURE * n + mon.SCORE_PER_SHARE * share + (mon.SCORE_DATASET_FLAG if flag else 0.0) if n > 0 else 0.0
    return found + (mon.SCORE_DATA_ADDED if added else 0.0)


class ScoreState(StatefulProcessor):
    """score = min(cap, (reset ? 0 : score) + increment), in event time.

    Rows wait in the state until the watermark has passed them, then a timer
    takes them in order of their time (a retrain before a cycle of the same
    time), whatever order they arrived in. A retrain counts for cycles that start
    less than ``RETRAIN_SECONDS`` later; a timer forgets it after that.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", SCORE_IN)
        self.score = handle.getValueState("score", "score double")
        self.retrained = handle.getValueState("retrained", "at timestamp")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in SCORE_IN.split(", ")]
        for frame in rows:
            for row in frame[names].itertuples(index=False, name=None):
                row = tuple(None if pd.isna(v) else kind(v) for kind, v in zip(_PLAIN, row, strict=True))
                self.waiting.appendValue(row)
                self.handle.registerTimer(_millis(row[1]))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        rows = list(self.waiting.get())
        due = sorted((r for r in rows if _millis(r[1]) <= now), key=lambda r: (r[1], r[0] != RETRAIN, r[2] or 0))
        if due:
            rest = [r for r in rows if _millis(r[1]) > now]
            if rest:
                self.waiting.put(rest)
            else:
                self.waiting.clear()
        if self.retrained.exists() and _millis(self.retrained.get()[0]) + mon.RETRAIN_SECONDS * 1000 <= now and not due:
            self.retrained.clear()
        out = [self._cycle(r) for r in due if r[0] == CYCLE or self._mark(r)]
        yield pd.DataFrame([(*key, *r) for r in out], columns=[*[f"k{i}" for i in range(len(key))], *(c.split()[0] for c in SCORE_OUT.split(", "))])

    def _mark(self, row) -> bool:
        if row[0] == RETRAIN:
            self.retrained.update((row[1],))
            self.handle.registerTimer(_millis(row[1]) + mon.RETRAIN_SECONDS * 1000)
        return False

    def _cycle(self, row) -> tuple:
        _, at, cycle, n, share, flag, added, failed = row
        n, share, flag, added, failed = n or 0, share or 0.0, bool(flag), bool(added), bool(failed)
        since = at - self.retrained.get()[0] if self.retrained.exists() else None
        retrained = since is not None and pd.Timedelta(0) <= pd.Timedelta(since) < pd.Timedelta(seconds=mon.RETRAIN_SECONDS)
        reset = not flag or retrained
        increment = _gain(n, share, flag, False)
        score = self.score.get()[0] if self.score.exists() else 0.0
        score = min(mon.SCORE_CAP, (0.0 if reset else score) + increment)
        if added:
            second = _gain(1, 0.1, False, True) if failed else _gain(n, share, flag, True)
            score = min(mon.SCORE_CAP, (score if flag or failed else 0.0) + second)
            increment += second
        self.score.update((score,))
        return at, cycle, added, failed, retrained, reset, increment, score

    def close(self) -> None:
        pass


def _millis(at) -> int:
    return int(pd.Timestamp(at).value // 1_000_000)


@contextmanager
def _state_store(spark: SparkSession):
    """Arbitrary state with timers needs the embedded key-value state store."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def drift_score_stream(rows: DataFrame, out: str, checkpoint: str, keys: Sequence[str], delay: str = "0 seconds") -> None:
    """Streams ``rows`` (keys and the columns of ``SCORE_IN``; a row of another
    kind only moves the watermark) into Parquet files at ``out``."""
    kinds = dict(rows.dtypes)
    names = [c.split()[0] for c in SCORE_IN.split(", ")]
    stream = rows.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], *names).withWatermark("at", delay)
    schema = ", ".join([*(f"k{i} {kinds[k]}" for i, k in enumerate(keys)), SCORE_OUT])
    scored = stream.groupBy(*[f"k{i}" for i in range(len(keys))]).transformWithStateInPandas(
        statefulProcessor=ScoreState(), outputStructType=schema, outputMode="append", timeMode="EventTime")
    scored = scored.withColumnsRenamed({f"k{i}": k for i, k in enumerate(keys)})
    with _state_store(rows.sparkSession):
        drain(scored.writeStream.outputMode("append").format("parquet").option("path", out), checkpoint)


def arrivals(spark: SparkSession, parts: Iterable[DataFrame], folder: str) -> Iterator[DataFrame]:
    """Writes the parts into ``folder`` one after the other, as they would
    arrive, and yields the folder's stream after each."""
    for part in parts:
        part.write.mode("append").parquet(folder)
        yield spark.readStream.schema(part.schema).parquet(folder)
