"""Silence as it happens: a stream of alerts for members that send nothing for some time, by timers on event time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def timer_state(spark: SparkSession) -> Iterator[None]:
    """Start queries with timers within this: they need a state store of their own kind. Other queries keep theirs."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


class _Silence(StatefulProcessor):
    """Of each member the time it was last seen, and whether its silence was told."""

    def __init__(self, names: list[str], limit_us: int, forget_us: int) -> None:
        self.names, self.limit, self.forget = names, limit_us, forget_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "at_us bigint, told boolean")

    def _timer(self, at_us: int) -> None:
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(-(-at_us // 1000))

    def _alerts(self, key, found: list[tuple[str, int]]) -> pd.DataFrame:
        members = {name: [value] * len(found) for name, value in zip(self.names, key, strict=True)}
        return pd.DataFrame({**members, "alert": [a for a, _ in found], "at_us": [t for _, t in found]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        times = sorted(t for frame in rows for t in frame["event_us"].tolist())
        last, told = self.seen.get() if self.seen.exists() else (None, False)
        found: list[tuple[str, int]] = []
        for at in times:
            if last is not None and at > last + self.limit:
                if not told:
                    found.append(("silent", last + self.limit))
                found.append(("back", at))
                told = False
            last = at if last is None else max(last, at)
        self.seen.update((last, told))
        self._timer(last + (self.forget if told else self.limit) + 1000)
        if found:
            yield self._alerts(key, found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, told = self.seen.get()
        if told:  # long silent: the member is forgotten, and new if it comes again
            self.seen.clear()
        else:
            self.seen.update((last, True))
            self.handle.registerTimer(-(-(last + self.forget) // 1000) + 1)
            yield self._alerts(key, [("silent", last + self.limit)])

    def close(self) -> None: ...


def silence_alerts(
    events: DataFrame, hours: float, by: Sequence[str] = ("service",), delay: str = "10 minutes", forget_hours: float = 24 * 30
) -> DataFrame:
    """A stream of (members, alert, at_us) for a stream of events: `silent` when a member's last event is `hours` old, once,
    and `back` with its next event.

    Time is that of the events: silence is told when the newest event of any member, less `delay`, is past it. Events later
    than that are not counted. A member that stays silent for `forget_hours` leaves the state.
    """
    types = {f.name: f.dataType.simpleString() for f in events.schema.fields}
    stamped = events.where(F.col("event_time").isNotNull()).select(*by, "event_time", F.unix_micros("event_time").alias("event_us"))
    processor = _Silence(list(by), int(hours * 3_600_000_000), int(forget_hours * 3_600_000_000))
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in by), "alert string", "at_us bigint"])
    return stamped.withWatermark("event_time", delay).groupBy(*by).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="EventTime"
    )
