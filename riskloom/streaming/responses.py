"""Response events as a stream: windows with late data, deduplication under a watermark, and repeats in a row."""

from __future__ import annotations

import datetime
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def read_events(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """path is a folder of Parquet files of events."""
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_trigger).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def per_window(events: DataFrame, size: str = "1 day", late: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))


def first_seen(events: DataFrame, late: str = "1 day") -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["user_id", "event_type"])


def first_events(events: DataFrame) -> DataFrame:
    """What first_seen keeps of a whole table: the earliest event of each user and type, of those of one time the one with the least id."""
    first = F.min(F.struct("ts", "event_id")).alias("e")
    return events.groupBy("user_id", "event_type").agg(first).select("user_id", "event_type", "e.event_id", "e.ts")


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EPOCH = datetime.datetime(1970, 1, 1)


def _millis(ts: object) -> int:
    return int(pd.Timestamp(ts).value // 1_000_000)


class Repeats(StatefulProcessor):
    """Keeps a site's responses until the watermark has passed them, then tells those that differ from the one before.

    State of a site: the responses that wait, by time and number, so that they leave in order however they came; the last URL that left; and
    the time of the one timer that is set. A site that is silent for quiet_ms, by event time, is forgotten, so its next response is a first one again.
    """

    def __init__(self, quiet_ms: int | None):
        self.quiet_ms = quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "at long, seq long", "url string, status int, micros long")
        self.last = handle.getValueState("last", "url string, at long")
        self.timer = handle.getValueState("timer", "at long")

    def wake_at(self, at: int | None) -> None:
        """Sets the site's timer to at, or clears it."""
        old = self.timer.get()[0] if self.timer.exists() else None
        if old == at:
            return
        if old is not None:
            self.handle.deleteTimer(old)
        if at is None:
            self.timer.clear()
        else:
            self.handle.registerTimer(at)
            self.timer.update((at,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        for frame in rows:
            for seq, url, status, ts in zip(frame["seq"], frame["url"], frame["status"], frame["ts"]):
                at = _millis(ts)
                if at >= passed:  # what is later than the watermark allows would come out of order
                    self.waiting.updateValue((at, int(seq)), (None if pd.isna(url) else url, None if pd.isna(status) else int(status), int(pd.Timestamp(ts).value // 1000)))
        first = min((at for at, _ in self.waiting.keys()), default=None)
        if first is not None:
            self.wake_at(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        self.timer.clear()
        known, prev, at = (True, *self.last.get()) if self.last.exists() else (False, None, None)
        out = []
        for (at_ms, seq), (url, status, micros) in sorted((tuple(k), tuple(v)) for k, v in self.waiting.iterator() if k[0] <= passed):
            if known and self.quiet_ms is not None and at_ms - at > self.quiet_ms:
                known = False
            if known and url != prev:
                out.append((key[0], seq, url, status, _EPOCH + datetime.timedelta(microseconds=micros)))
            known, prev, at = True, url, at_ms
            self.waiting.removeKey((at_ms, seq))
        if known:
            self.last.update((prev, at))
        first = min((x for x, _ in self.waiting.keys()), default=None)
        if first is not None:
            self.wake_at(first)
        elif known and self.quiet_ms is not None:
            if at + self.quiet_ms < passed:
                self.last.clear()
            else:
                self.wake_at(at + self.quiet_ms + 1)
        if out:
            yield pd.DataFrame(out, columns=["site", "seq", "url", "status", "ts"]).astype({"status": "Int32"})

    def close(self) -> None:
        pass


def without_repeats(log: DataFrame, late: str = "1 hour", quiet: datetime.timedelta | None = None) -> DataFrame:
    """(site, seq, url, status, ts): responses whose URL differs from that of the response before, without the first of each site.

    log is a stream of (site, seq, url, status, ts) in any order within late; responses are ordered by ts, then seq, and leave once the watermark has passed
    them. Later ones are dropped. quiet bounds the state: a site that is silent for longer starts anew. A response that comes twice counts once. All of a site's
    waiting responses are held by the task that has the site, in RocksDB.
    """
    ms = None if quiet is None else int(quiet.total_seconds() * 1000)
    kinds = {f.name: f.dataType.simpleString() for f in log.schema}
    rows = log.select("site", "seq", "url", "status", "ts").withWatermark("ts", late)
    return rows.groupBy("site").transformWithStateInPandas(Repeats(ms), f"site {kinds['site']}, seq long, url string, status int, ts timestamp", "append", "eventtime")


def use_rocksdb(spark: SparkSession) -> None:
    """State of arbitrary processors lives in RocksDB, on disk beside the executors and in the checkpoint."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def drained(stream: DataFrame, folder: str) -> DataFrame:
    """The rows of a stream, run over all that its source holds now and landed as Parquet below folder, beside its checkpoint."""
    q = stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint").option("path", f"{folder}/rows").trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")
