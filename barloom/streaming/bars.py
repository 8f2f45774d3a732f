"""Structured Streaming twins of the batch builders (ST1–ST7).

* ST1  ticks → tumbling bars with a watermark (append mode: closed windows only).
* ST2/ST3/ST6  features (and scores) of the newest bars: ``foreachBatch`` keeps the
  last N bars per symbol and the scans' results on them in a table; each micro-batch
  runs the *batch* feature builders on tail + new bars (one definition for batch and
  stream, FP4) and writes the rows of the new bars; the tail can be seeded from history.
* ST4  target position with exits: ``transformWithStateInPandas`` with the position,
  entry price, bars held and, by hour, the rows ahead of the watermark as the per-symbol state.
* ST5  stream–static left join (signal by time, 0 when missing).
* ST7  ``dropDuplicatesWithinWatermark``; rows later than the watermark are dropped, and
  :func:`run_counted` tells how many.

Non-linear recurrences (cycle family, MAMA, SAR) have their own keyed state, see
:mod:`barloom.streaming.live`.

Sinks are parquet folders under the session's checkpoint folder (shared storage on
a cluster), never the driver's memory.
"""

from __future__ import annotations

import contextlib
import os
import threading
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

from barloom.session import checkpoint_dir, reliable_checkpoint

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint location for a sink or stream checkpoint."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "streams", f"{name}-{uuid.uuid4().hex[:12]}")


def event_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """A folder of event files (see :func:`event_files`) as a file stream: new files are new data."""
    r = spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", "*.parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(folder)


#: Rows of one file of an event folder.
FILE_ROWS = 1_000_000


def event_files(spark: SparkSession, sf_dir: str, parts: int = 5, held=None, twice=None) -> tuple[str, int]:
    """``events`` as a growing folder: ``parts`` slices of consecutive days, rows in no order inside one.

    The slices are written one after the other, as a feed would, so a file stream takes
    them in time order.  Returns the folder and the files of a slice (as many as its rows
    ask for; a slice's rows are dealt by the hash of their id).  Rows with ``held`` come late, in one more slice
    at the end; rows with ``twice`` come twice in their slice."""
    from barloom.sources.tables import table
    ev = table(spark, sf_dir, "events").select(*EVENT_SCHEMA.fieldNames())
    day = F.datediff(F.col("ts").cast("date"), F.lit(ev.agg(F.min(F.col("ts").cast("date"))).first()[0]))
    n, rows = ev.agg(F.max(day) + 1, F.count(F.lit(1))).first()
    files = -(-rows // (parts * FILE_ROWS)) or 1
    path = scratch(spark, "event-files")

    def write(part: DataFrame) -> None:
        (part.repartition(files, F.xxhash64("event_id")).sortWithinPartitions(F.xxhash64("event_id"))
         .write.mode("append").parquet(path))

    prompt = ev if held is None else ev.where(~held)
    if twice is not None:
        prompt = prompt.unionByName(prompt.where(twice))
    for i in range(parts):
        write(prompt.where((day >= i * n // parts) & (day < (i + 1) * n // parts)))
    if held is not None:
        write(ev.where(held))
    return path, files


def _epoch():
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def event_time(c):
    """timestamp_ntz wall clock → TIMESTAMP instant read as UTC (session zone does not matter)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), c))


def wall_clock(c):
    """TIMESTAMP instant → timestamp_ntz wall clock in UTC."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), _epoch())


def tick_bars(ticks: DataFrame, interval: str = "1 hour", delay: str = "1 hour", key: str = "event_type",
              ts: str = "ts", price: str = "value", order: str = "event_id") -> DataFrame:
    """ST1: tumbling bars; ``withWatermark`` needs a timestamp (not timestamp_ntz) column."""
    t = ticks.withColumn("_ets", event_time(F.col(ts))).withWatermark("_ets", delay)
    return (t.groupBy(F.col(key).alias("symbol"), F.window("_ets", interval).alias("w"))
            .agg(F.min_by(price, order).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
                 F.max_by(price, order).alias("close"), F.count(F.lit(1)).cast("double").alias("volume"))
            .select("symbol", wall_clock(F.col("w.start")).alias("ts"),
                    wall_clock(F.col("w.end")).alias("ts_end"), "open", "high", "low", "close", "volume"))


@contextlib.contextmanager
def state_store(spark: SparkSession):
    """Queries started inside use the RocksDB state store, which keyed state needs; the session's setting is put back."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def run_to_table(df: DataFrame, name: str, mode: str = "append", partition_by=None) -> str:
    """Run a streaming DataFrame with ``availableNow`` into a parquet folder, state in RocksDB; return its path."""
    spark = df.sparkSession
    out, ck = scratch(spark, f"{name}-out"), scratch(spark, f"{name}-ck")
    w = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).outputMode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with state_store(spark):
        q = w.trigger(availableNow=True).start()
        q.awaitTermination()
    return out


class RowCounts(StreamingQueryListener):
    """Rows that the stateful operators of each run took in, dropped as late and dropped as repeated."""

    def __init__(self):
        self.rows: dict[str, Counter] = defaultdict(Counter)
        self.over: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        count = self.rows[str(p.runId)]
        count["read"] += max(int(p.numInputRows), 0)
        for op in p.stateOperators:
            count["late"] += int(op.numRowsDroppedByWatermark)
            count["repeated"] += int(op.customMetrics.get("numDroppedDuplicateRows", 0))

    def onQueryTerminated(self, event) -> None:
        self.over[str(event.runId)].set()


def run_counted(df: DataFrame, name: str, mode: str = "append") -> tuple[str, Counter]:
    """As :func:`run_to_table`, and the counts ``read``, ``late`` and ``repeated`` over all micro-batches of the run.

    A listener adds up every batch's progress, so the counts do not depend on how many the query remembers."""
    spark = df.sparkSession
    out, ck = scratch(spark, f"{name}-out"), scratch(spark, f"{name}-ck")
    counts = RowCounts()
    spark.streams.addListener(counts)
    try:
        q = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).outputMode(mode)
             .trigger(availableNow=True).start())
        q.awaitTermination()
        if not counts.over[str(q.runId)].wait(60):
            raise RuntimeError("the query's last progress did not arrive")
    finally:
        spark.streams.removeListener(counts)
    return out, counts.rows[str(q.runId)]


def dedup_within_watermark(ticks: DataFrame, keys=("event_type", "ts"), delay: str = "1 hour", ts: str = "ts") -> DataFrame:
    """ST7: drop repeated (key, time) rows within the watermark; late rows are dropped."""
    t = ticks.withColumn("_ets", event_time(F.col(ts))).withWatermark("_ets", delay)
    return t.dropDuplicatesWithinWatermark(list(keys)).drop("_ets")


def signal_lookup_stream(stream: DataFrame, signals: DataFrame, key=("symbol", "ts"), value: str = "ret") -> DataFrame:
    """ST5: stream–static left join; 0.0 where the static table has no row."""
    s = signals.select(*key, F.col(value).alias("_sig"))
    return stream.join(s, list(key), "left").withColumn(value, F.coalesce(F.col("_sig"), F.lit(0.0))).drop("_sig")


# -------------------------------------------------------- ST2 / ST3 / ST6
class FeatureStream:
    """Features (and scores) of the newest bars with the batch builders (``build(BarFrame) -> BarFrame``).

    After micro-batch ``k`` the folder ``base/tail/b<k>`` holds the last ``buffer`` bars per
    symbol with their row numbers and the results of every scan on them; batch ``k``
    reads ``b<k-1>`` and goes on from there (:meth:`BarFrame.resumed`), so recurrences
    equal one pass over all bars and finite windows read the buffered bars.  A plan
    whose windows reach further than the buffer raises.  Features go to
    ``base/out/batch_id=<k>``: a batch that is run again writes the same files, and a new
    object on the same ``base`` continues after a restart.  ``model`` (a fitted
    PipelineModel) scores the new rows (ST3).  Bars must arrive in time order per
    symbol, as closed windows do; bars not later than the last one seen are dropped.
    ``extra`` columns of the bars (such as those of :mod:`barloom.streaming.live`) reach ``build`` on
    new rows; they are null on buffered and seeded ones.
    """

    COLUMNS = ("open", "high", "low", "close", "volume")

    def __init__(self, spark: SparkSession, build, buffer: int = 300, model=None, base: str | None = None,
                 key: str = "symbol", ts: str = "ts", block_rows: int = 4096, extra: tuple[str, ...] = ()):
        self.spark, self.build, self.buffer, self.model, self.extra = spark, build, buffer, model, extra
        self.key, self.ts, self.block_rows = key, ts, block_rows
        self.base = base or scratch(spark, "features")
        self.out = f"{self.base}/out"

    def _path(self, batch_id: int) -> str:
        return f"{self.base}/tail/b{batch_id}"

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _tail(self, batch_id: int) -> DataFrame | None:
        fs, p = self._fs(self._path(batch_id))
        return self.spark.read.parquet(self._path(batch_id)) if fs.exists(p) else None

    def started(self) -> bool:
        """Whether a query has run on this base before."""
        fs, p = self._fs(f"{self.base}/ck")
        return fs.exists(p)

    def seed(self, history: DataFrame) -> None:
        """ST6: warm-up from history: its bars are seen, but no features are written."""
        self._step(history, -1, write=False)

    def _step(self, bars: DataFrame, batch_id: int, write: bool) -> None:
        from barloom.plans.frame import from_sequenced, sequence
        key, ts = self.key, self.ts
        new = bars.select(key, ts, *self.COLUMNS, *[
            F.col(c) if c in bars.columns else F.lit(None).cast("double").alias(c) for c in self.extra])
        tail = self._tail(batch_id - 1)
        if tail is None:
            rows = new.withColumns({"_old": F.lit(False), "_before": F.lit(0).cast("long")})
            seen = None
        else:
            # one row per symbol
            seen = tail.groupBy(key).agg(F.max(ts).alias("_last"), (F.min("rn") - 1).alias("_off"), F.max("rn").alias("_seen"))
            fresh = new.join(seen, key, "left").where(F.col("_last").isNull() | (F.col(ts) > F.col("_last")))
            rows = (tail.withColumn("_old", F.lit(True)).drop("rn")
                    .unionByName(fresh.select(*new.columns, F.lit(False).alias("_old")), allowMissingColumns=True)
                    .join(seen.select(key, F.col("_off").alias("_before")), key, "left"))
        fr = sequence(rows, key=key, order=(ts,), block_rows=self.block_rows)
        df = fr.df.withColumn("rn", F.col("rn") + F.coalesce("_before", F.lit(0))).drop("_before", "blk", "sblk")
        last = F.lit(False) if seen is None else F.col("rn") == F.coalesce("_seen", F.lit(-1))
        if seen is not None:
            df = df.join(seen.select(key, "_seen"), key, "left")
        df = df.withColumn("_last_old", last).drop("_seen")
        made = self.build(from_sequenced(df, key=key, order=(ts,), block_rows=self.block_rows, stats=fr.stats).resumed())
        if made.reach > self.buffer:
            raise ValueError(f"the plan reads {made.reach} earlier bars, the buffer holds {self.buffer}")
        done = reliable_checkpoint(made.df.drop("blk", "sblk", "_last_old"))
        kept = [c for c in done.columns if c.startswith("_kept_")]
        if write:
            feats = done.where(~F.col("_old")).drop("_old", *kept)
            if self.model is not None:
                feats = self.model.transform(feats)
            feats.write.mode("overwrite").parquet(f"{self.out}/batch_id={batch_id}")
        upto = done.groupBy(key).agg(F.max("rn").alias("_n"))
        (done.join(upto, key).where(F.col("rn") > F.col("_n") - self.buffer)
         .select(key, ts, "rn", *self.COLUMNS, *kept).write.mode("overwrite").parquet(self._path(batch_id)))
        fs, old = self._fs(self._path(batch_id - 2))  # b<k-1> stays for a batch that is run again
        fs.delete(old, True)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        self._step(batch, batch_id, write=True)

    def run(self, bars_stream: DataFrame, checkpoint: str | None = None) -> str:
        q = (bars_stream.writeStream.foreachBatch(self.process)
             .option("checkpointLocation", checkpoint or f"{self.base}/ck").trigger(availableNow=True).start())
        q.awaitTermination()
        return self.out


# ------------------------------------------------------------------ ST4
#: Waiting rows as they lie in the state.
HELD = np.dtype([("us", "i8"), ("none", "?"), ("seq", "i8"), ("signal", "f8"), ("close", "f8")])
#: Rows of a symbol that a task gathers before they go to the state, and results before they leave.
HELD_ROWS = 100_000
HOUR_MS = 3_600_000


class Exits(StatefulProcessor):
    """The loop of one symbol.  Rows wait in the state in pieces, each of one hour; due hours are read one after the other."""

    def __init__(self, key: str, order: str, size: float, max_holding: int, stop_pct: float):
        self.key, self.order, self.rule = key, order, (size, max_holding, stop_pct)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # end of the loop so far, and the hour and number of every piece held
        self.at = handle.getValueState("at", "path array<double>, hours array<long>, pieces array<long>")
        self.held = handle.getMapState("held", "hour long, piece long", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        path, index = self._now()
        parts, n = [], 0
        for p in rows:
            if not len(p):
                continue
            part = np.empty(len(p), HELD)
            for name, col in zip(HELD.names, ("row_us", "no_seq", "row_seq", "row_signal", "row_close")):
                part[name] = p[col].to_numpy()
            parts.append(part)
            n += len(part)
            if n >= HELD_ROWS:
                self._hold(np.concatenate(parts), index)
                parts, n = [], 0
        if n:
            self._hold(np.concatenate(parts), index)
        yield from self._due(key, timerValues.getCurrentWatermarkInMs(), path, index)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._due(key, timerValues.getCurrentWatermarkInMs(), *self._now())

    def _now(self) -> tuple[list[float], dict[int, list[int]]]:
        """The loop's end and the pieces of every hour."""
        path, hours, pieces = self.at.get() if self.at.exists() else ([0.0, 0.0, 0.0], [], [])
        index: dict[int, list[int]] = {}
        for h, i in zip(hours, pieces):
            index.setdefault(int(h), []).append(int(i))
        return [float(x) for x in path], index

    def _hold(self, rows: np.ndarray, index: dict[int, list[int]]) -> None:
        hour = rows["us"] // (1000 * HOUR_MS)
        at = np.argsort(hour, kind="stable")
        rows, hour = rows[at], hour[at]
        starts = np.flatnonzero(np.r_[True, hour[1:] != hour[:-1]])
        for h, part in zip(hour[starts].tolist(), np.split(rows, starts[1:])):
            own = index.setdefault(h, [])
            own.append(own[-1] + 1 if own else 0)
            self.held.updateValue((h, own[-1]), (part.tobytes(),))

    def _due(self, key, mark: int, path: list[float], index: dict[int, list[int]]) -> Iterator[pd.DataFrame]:
        """Use the rows before the watermark in the order (ts, ``order``); the others stay, with a timer on the first of them."""
        from barloom.operators.grouped import exits_run
        done, n, wake = [], 0, None
        for h in sorted(index):
            if h * HOUR_MS >= mark:
                wake = h * HOUR_MS
                break
            rows = np.concatenate([np.frombuffer(self.held.getValue((h, i))[0], HELD) for i in index[h]])
            rows = rows[np.lexsort((rows["seq"], rows["none"], rows["us"]))]
            n_due = int(np.searchsorted(rows["us"], 1000 * mark, "left"))
            due, rest = rows[:n_due], rows[n_due:]
            if n_due:
                target, path = exits_run(due["signal"].tolist(), due["close"].tolist(), 0, path, *self.rule)
                done.append((due[["us", "none", "seq"]], target))
                n += n_due
                for i in index.pop(h):
                    self.held.removeKey((h, i))
                if len(rest):
                    self._hold(rest, index)
            if len(rest):
                wake = int(rest["us"][0]) // 1000
                break
            if n >= HELD_ROWS:
                yield self._rows(key, done)
                done, n = [], 0
        if n:
            yield self._rows(key, done)
        self.at.update(([float(x) for x in path], [h for h, own in index.items() for _ in own], [i for own in index.values() for i in own]))
        if wake is not None:  # a timer fires once the watermark is there, a row is due once it is beyond
            self.handle.registerTimer(wake + 1)

    def _rows(self, key, done) -> pd.DataFrame:
        at = np.concatenate([a for a, _ in done])
        seq = pd.Series(at["seq"].astype("int64")).astype("Int64").mask(at["none"])
        return pd.DataFrame({self.key: [key[0]] * len(at), self.order: seq, "us": at["us"].astype("int64"),
                             "target": np.concatenate([t for _, t in done])})


def stateful_exits(stream: DataFrame, signal: str = "signal", size: float = 1.0, max_holding: int = 20,
                   stop_pct: float = 0.02, key: str = "symbol", ts: str = "ts", order: str = "event_id",
                   delay: str = "1 hour") -> DataFrame:
    """ST4: target position with time exit and stop.

    State per symbol: (position, entry price, bars held) and the rows that the
    watermark has not passed.  A row is used once the watermark has passed it, in the
    order (ts, ``order``), so neither the order of arrival nor the size of Arrow
    chunks matters; rows later than the watermark are dropped by Spark.  Rows after
    the last watermark stay in the state (append mode); rows without a time never come due.  A task has ``HELD_ROWS`` rows or
    one hour of a symbol in memory, however many rows a micro-batch brings.  Needs :func:`state_store`, which :func:`run_to_table` sets."""
    kind = stream.schema[key].dataType.simpleString()
    s = stream.where(F.col(ts).isNotNull()).withColumn("_ets", event_time(F.col(ts))).withWatermark("_ets", delay)
    s = s.select(key, "_ets", F.unix_micros("_ets").alias("row_us"), F.col(order).isNull().alias("no_seq"),
                 F.coalesce(F.col(order).cast("long"), F.lit(0)).alias("row_seq"), F.coalesce(F.col(signal).cast("double"), F.lit(0.0)).alias("row_signal"),
                 F.coalesce(F.col("close").cast("double"), F.lit(float("nan"))).alias("row_close"))
    out = s.groupBy(key).transformWithStateInPandas(
        Exits(key, order, size, max_holding, stop_pct), outputStructType=f"`{key}` {kind}, `{order}` long, us long, target double",
        outputMode="Append", timeMode="EventTime")
    return out.select(key, order, wall_clock(F.timestamp_micros("us")).alias(ts), "target")
