"""Running evidence of recurring anomalies, with bounded state per label that can start from history and expire."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.lists import DEFAULT_PROMOTION, PROMOTION_LIMITS

LABEL = ["field_name", "normalized_label"]
_OUT = "field_name string, normalized_label string"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Evidence(StatefulProcessor):
    """Calls, weeks and occurrences of a label up to its limits; beyond them only that they were reached.

    ``keep_ms`` forgets a label for which nothing came for so long by the watermark, ``ttl_ms`` each piece of evidence that
    old by the clock. Neither is set by default.
    """

    def __init__(self, keep_ms: int | None = None, ttl_ms: int | None = None):
        self.keep_ms, self.ttl_ms = keep_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.calls = handle.getMapState("calls", "call string", "seen boolean", self.ttl_ms)
        self.weeks = handle.getListState("weeks", "week string", self.ttl_ms)
        self.occurrences = handle.getValueState("occurrences", "n long", self.ttl_ms)
        self.history = handle.getValueState("history", "calls long, occurrences long, weeks long, last_week string", self.ttl_ms)
        self.met = handle.getValueState("met", "met boolean", self.ttl_ms)
        self.last = handle.getValueState("last", "ms long")

    def _clear(self) -> None:
        for state in (self.calls, self.weeks, self.occurrences, self.history):
            state.clear()

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        r = initialState.iloc[0]
        before = (int(r["calls"]), int(r["occurrences"]), int(r["weeks"]))
        if _reached(key[0], *before):
            self.met.update((True,))  # given out before this stream began
        else:
            self.history.update((*before, r["last_week"]))
        if self.keep_ms is not None:
            self._seen(int(r["last_ms"]))

    def _seen(self, ms: int) -> None:
        """Move the label's timer on if this is the newest time seen."""
        last = self.last.get()[0] if self.last.exists() else None
        if last is None or ms > last:
            if last is not None:
                self.handle.deleteTimer(last + self.keep_ms)
            self.handle.registerTimer(ms + self.keep_ms)
            self.last.update((ms,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        met = was_met = self.met.exists()
        base = self.history.get() if self.history.exists() else (0, 0, 0, None)
        calls = {} if met else {k[0] for k in self.calls.keys()}
        weeks = set() if met else {w[0] for w in self.weeks.get()}
        known, n = set(calls), self.occurrences.get()[0] if self.occurrences.exists() else 0
        newest = None
        for pdf in rows:
            if self.keep_ms is not None:
                newest = max(x for x in (newest, int(pdf["ms"].max())) if x is not None)
            if not met:
                n += len(pdf)
                calls = calls | set(pdf["source_record_id"].dropna())
                weeks = weeks | (set(pdf["week"].dropna()) - {base[3]})
                met = _reached(key[0], base[0] + len(calls), base[1] + n, base[2] + len(weeks))
        if met and not was_met:
            self._clear()
            self.met.update((True,))
            yield pd.DataFrame([key], columns=LABEL)
        elif not met:
            for call in calls - known:
                self.calls.updateValue((call,), (True,))
            if weeks:  # a list state cannot be empty
                self.weeks.put([(w,) for w in sorted(weeks)])
            self.occurrences.update((n,))
        if newest is not None:
            self._seen(newest)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._clear()
        self.met.clear()
        self.last.clear()
        return iter([])


def _reached(field: str, calls: int, occurrences: int, weeks: int) -> bool:
    limits = PROMOTION_LIMITS.get(field, DEFAULT_PROMOTION)
    return calls >= limits[0] or occurrences >= limits[1] or weeks >= limits[2]


def anomaly_rows(outputs: DataFrame) -> DataFrame:
    return outputs.filter(
        F.col("mapping_status").isin("TRUE_ANOMALY", "KNOWN_TRUE_ANOMALY") & (F.col("normalized_label") != "")
    )


def history_evidence(outputs: DataFrame) -> DataFrame:
    """Evidence of a table of past outputs, to start a stream from; its calls are not in the stream again."""
    week = F.date_trunc("week", "classified_at").cast("string")
    return anomaly_rows(outputs).groupBy(*LABEL).agg(
        F.countDistinct(F.col("source_record_id").cast("string")).alias("calls"), F.count("*").alias("occurrences"),
        F.countDistinct(week).alias("weeks"), F.max(week).alias("last_week"), F.max(F.unix_millis("classified_at")).alias("last_ms"))


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that processors with timers, maps and lists need; for streams started from now on."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)


def anomaly_state(outputs: DataFrame, history: DataFrame | None = None, keep: str | None = None, ttl: str | None = None,
                  watermark: str = "1 day") -> DataFrame:
    """Labels whose calls, occurrences or weeks reach the promotion limit, each once, when they do.

    Which labels come out does not depend on how the rows fall into batches. ``history`` (``history_evidence``) counts as if
    its rows had come first; what had reached a limit in it is not given out again. ``keep`` forgets a label, also that it
    was given out, when nothing came for so long before the watermark; ``ttl`` forgets evidence that old by the clock. Both
    are durations like '30 days', and only one can be set.
    """
    if keep and ttl:
        raise ValueError("keep counts event time, ttl the clock: set one")
    spark = outputs.sparkSession
    use_rocksdb(spark)

    def ms(duration: str | None) -> int | None:
        return None if duration is None else spark.sql(
            f"SELECT unix_millis(TIMESTAMP '2000-01-01' + INTERVAL {duration}) - unix_millis(TIMESTAMP '2000-01-01')").first()[0]

    rows = anomaly_rows(outputs.withWatermark("classified_at", watermark) if keep else outputs).select(
        *LABEL, F.col("source_record_id").cast("string").alias("source_record_id"),
        F.date_trunc("week", "classified_at").cast("string").alias("week"), F.unix_millis("classified_at").alias("ms"),
        *(["classified_at"] if keep else []),
    )
    return rows.groupBy(*LABEL).transformWithStateInPandas(
        Evidence(ms(keep), ms(ttl)), _OUT, "append", "EventTime" if keep else "ProcessingTime" if ttl else "None",
        history.groupBy(*LABEL) if history is not None else None)
