"""Lookups that go on where they stopped: what each id has been answered is kept state, and refusals wait on timers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

STATE = "tries int, done boolean"
RESULT = "documentId string, value int, tries int"
Result = Row("documentId", "value", "tries")
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Lookup(StatefulProcessor):
    """Asks for an id once. An answer is final, and so is a null (a missing document, or ``most`` tries). A refusal
    waits ``wait`` seconds times the tries so far, on a timer, so no task sleeps."""

    def __init__(self, fetch: Callable[[str], tuple[int, int | None]], wait: float, most: int):
        self.fetch, self.wait, self.most = fetch, wait, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", STATE)

    def close(self) -> None:
        pass

    def ask(self, key: str, tries: int, now: int) -> Iterator[Row]:
        try:
            status, value = self.fetch(key)
        except OSError:
            status, value = 0, None
        tries += 1
        if status in (200, 404) or tries >= self.most:
            self.state.update((tries, True))
            yield Result(key, value if status == 200 else None, tries)
        else:
            self.state.update((tries, False))
            self.handle.registerTimer(now + int(self.wait * tries * 1000))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        known = list(row.known for row in rows if row.known is not None)
        if self.state.exists():  # asked already: answered, or a timer stands
            return
        if known:  # a value from an earlier run's progress table, null included
            self.state.update((0, True))
            yield Result(key[0], known[0]["value"], 0)  # structs of rows come as dicts
            return
        yield from self.ask(key[0], 0, timerValues.getCurrentProcessingTimeInMs())

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        tries, done = self.state.get()
        if not done:
            yield from self.ask(key[0], tries, timerValues.getCurrentProcessingTimeInMs())


def resumed(ids: DataFrame, fetch: Callable[[str], tuple[int, int | None]], wait: float = 30.0, most: int = 5) -> DataFrame:
    """(documentId, value, tries) of a stream of ids, each once however often it comes.

    ``ids``: documentId, and known: a struct of the value that an earlier run's progress table has, null where it has none
    (a struct with a null value is a known null). Needs the RocksDB state store (``start_resumed`` sets it).
    """
    return ids.groupBy("documentId").transformWithState(Lookup(fetch, wait, most), RESULT, "append", "processingTime")


def start_resumed(spark: SparkSession, ids: DataFrame, fetch: Callable[[str], tuple[int, int | None]], out: str, checkpoint: str, wait: float = 30.0, most: int = 5, every: str = "1 second") -> StreamingQuery:
    """Start a query that appends results to the Parquet folder ``out``; its checkpoint is what it goes on from."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    try:
        return resumed(ids, fetch, wait, most).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(processingTime=every).start()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
