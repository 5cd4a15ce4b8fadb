"""Sequenced changes applied by a stateful stream with event-time timers.

Each key's changes carry a number; they are applied in the order of these numbers, from 1. A change that comes early is held.
Its event time is a day; the watermark follows the largest day of all keys, delayed by the wait, and a timer stands at each
key's earliest held day. When the watermark passes it, the callback jumps the gap to the smallest held number and applies what
follows, and again while a held day is due. A number that is held or was passed already is rejected.

The query is started anew for each batch on one checkpoint and ends with what there is (``availableNow``). After a batch's rows
the watermark moves, so Spark runs a batch without data; what its timers jump belongs to the start of the batch that follows,
and is labelled so. At last a sentinel row beyond all days flushes what is still held.

Each key's state is one row with up to ``INLINE`` held changes; more go to a map in the state store, so a key with any number
of held changes needs memory for their numbers alone. All changes of a key go through one task, since each depends on those
before it; so a key with a third of the rows makes its task the longest.

Rows reach a task in no order. That is right all the same: days of later batches are larger, so of the changes with one
number the first by day and id is that held, whichever comes first, and numbers are applied only after a batch's rows.

Edge cases: rows that repeat count once; rows without a day (or an id, which the day depends on) go; a null key is a key like
others; null numbers rank before all. An unknown operation changes nothing but counts as applied. Days before the first batch
belong to it. An empty table gives no rows. Other columns of the input aren't carried, except that rows differing in them are
not repeated rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from ..operators.positions import dense_ranks
from .common import drop_path, fresh_path

DAY_MS = 86_400_000
#: Held changes that a key's state row holds itself, and changes of a key that a task holds in memory while it reads.
INLINE, MOST_READ = 64, 20_000
HELD = "n bigint, day bigint, change_id bigint, op string, city string, balance double"
STATE = f"next bigint, city string, balance double, timer bigint, held array<struct<{HELD.replace(' ', ':').replace(',:', ', ')}>>, stored bigint"
OUT = "change_id bigint, who string, n bigint, op string, status string, batch int, missed bigint, city string, balance double"
Out = Row(*(field.split(" ")[0] for field in OUT.split(", ")))
ROWS = "who string, n bigint, day bigint, change_id bigint, op string, city string, balance double, event timestamp"


class Applier(StatefulProcessor):
    """Applies one key's changes. ``batch``: that of the rows fed; ``began``: the watermark at its start, in milliseconds;
    ``last``: the label of what is flushed."""

    def __init__(self, batch: int, began: int, last: int):
        self.batch, self.began, self.last = batch, began, last

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", STATE)
        self.store = handle.getMapState("held", "n bigint", HELD)

    def close(self) -> None:
        pass

    def load(self) -> None:
        got = self.state.get() if self.state.exists() else None
        self.next, self.city, self.balance, self.timer, held, self.stored = got or (1, None, None, None, [], 0)
        self.held = {h[0]: tuple(h) for h in held or []}

    def save(self) -> None:
        """Store the state, with held changes beyond ``INLINE`` in the map, and move the timer to the earliest held day."""
        if len(self.held) > INLINE or self.stored and self.held:
            self.spill()
        days = [h[1] for h in self.held.values()]
        if self.stored:
            days.append(min(h[1] for h in self.store.values()))
        due = min(days) * DAY_MS - 1 if days else None  # a timer fires when the watermark is past it
        if due != self.timer:
            if self.timer is not None:
                self.handle.deleteTimer(self.timer)
            if due is not None:
                self.handle.registerTimer(due)
        self.state.update((self.next, self.city, self.balance, due, [tuple(h) for h in self.held.values()], self.stored))

    def spill(self) -> None:
        for n, h in self.held.items():
            self.store.updateValue((n,), h)
        self.stored += len(self.held)
        self.held = {}

    def find(self, n: int):
        """The held change of a number."""
        found = self.held.get(n)
        if found is None and self.stored and (kept := self.store.getValue((n,))) is not None:
            found = tuple(kept)
        return found

    def take(self, n: int):
        """The held change of a number, which is held no longer."""
        found = self.held.pop(n, None)
        if found is None and self.stored and (kept := self.store.getValue((n,))) is not None:
            found = tuple(kept)
            self.store.removeKey((n,))
            self.stored -= 1
        return found

    def rejected(self, who: str, h: tuple, label: int) -> Row:
        return Out(h[2], who, h[0], h[3], "rejected", label, 0, None, None)

    def applied(self, who: str, label: int, missed: int = 0) -> Iterator[Row]:
        """Apply held changes from ``next`` on, as far as they go."""
        while (h := self.take(self.next)) is not None:
            n, _, change_id, op, city, balance = h
            if op == "I":
                self.city, self.balance = city, balance
            elif op == "U":
                self.city, self.balance = self.city if city is None else city, self.balance if balance is None else balance
            elif op == "D":
                self.city = self.balance = None
            self.next += 1
            yield Out(change_id, who, n, op, "applied", label, missed, self.city, self.balance)
            missed = 0

    def jumped(self, who: str, watermark: int, label: int) -> Iterator[Row]:
        """Jump gaps while a held day is due, to the smallest held number each time."""
        numbers = [(h[0], h[1]) for h in self.held.values()]
        if self.stored:
            numbers += [(h[0], h[1]) for h in self.store.values()]
        due = max((n for n, day in numbers if day * DAY_MS <= watermark), default=0)
        for n in sorted(n for n, _ in numbers if n <= due):
            if n >= self.next:
                missed, self.next = n - self.next, n
                yield from self.applied(who, label, missed)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        who = key[0]
        if who == SENTINEL:
            return
        self.load()
        if self.timer is not None and self.timer < timerValues.getCurrentWatermarkInMs():  # a query that stopped before its batch without data
            yield from self.jumped(who, timerValues.getCurrentWatermarkInMs(), self.batch)
        for r in rows:
            change = (r.n, r.day, r.change_id, r.op, r.city, r.balance)
            if r.n < self.next:
                yield self.rejected(who, change, self.batch)
                continue
            known = self.find(r.n)
            if known is not None:
                if known[1:3] <= change[1:3]:
                    yield self.rejected(who, change, self.batch)
                    continue
                self.take(r.n)
                yield self.rejected(who, known, self.batch)
            self.held[r.n] = change
            if len(self.held) > MOST_READ:
                self.spill()
        yield from self.applied(who, self.batch)
        self.save()

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        self.load()
        watermark = timerValues.getCurrentWatermarkInMs()
        yield from self.jumped(key[0], watermark, min(self.last, self.batch + (watermark > self.began)))
        self.timer = None if self.timer == expiredTimerInfo.getExpiryTimeInMs() else self.timer  # Spark deletes the one that fired
        self.save()


#: The key of the row that moves the watermark beyond all days.
SENTINEL = "-"


def sequenced(spark: SparkSession, changes: DataFrame, first_day: int, days: int, batches: int) -> DataFrame:
    """Distinct changes with their number, day and batch; ``who`` is the key as text."""
    rows = changes.distinct().select("change_id", "client_id", "seq", "op", "valid_at", "city", "balance")
    ranks = dense_ranks(spark, rows, "client_id", "seq", "n").withColumnsRenamed({"client_id": "_client", "seq": "_seq"})
    code = F.crc32(F.col("change_id").cast("string").cast("binary"))
    day = F.unix_date(F.col("valid_at").cast("date")).cast("bigint") + 2 * (code % 4)
    batch = F.greatest(F.lit(1), F.least(F.lit(batches), 1 + F.floor((F.col("day") - first_day) * batches / days)))
    dated = rows.withColumn("day", day).where(F.col("day").isNotNull() & (code % 11 != 0))
    return (
        dated.join(ranks.hint("merge"), dated["client_id"].eqNullSafe(ranks["_client"]) & dated["seq"].eqNullSafe(ranks["_seq"]))
        .select(F.coalesce(F.concat(F.lit("k"), F.col("client_id").cast("string")), F.lit("null")).alias("who"), "n", "day", "change_id", "op", "city", F.col("balance").cast("double").alias("balance"))
        .withColumn("event", F.timestamp_seconds(F.col("day") * 86_400))
        .withColumn("batch", batch.cast("int"))
    )


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Settings of the session while its streaming queries start."""
    names = {"spark.sql.streaming." + k.replace("_", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder of the shared store, unless an earlier try did."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(path(source)):
        store.mkdirs(path(target).getParent())
        if not store.rename(path(source), path(target)):
            raise OSError(f"{source} can't be moved to {target}")


def apply_stream(spark: SparkSession, rows: DataFrame, wait: int, batches: int) -> DataFrame:
    """Feed ``rows`` batch by batch to the stream, and give what became of each.

    ``rows``: what ``sequenced`` gives. ``wait``: days that a held change waits for those before it. ``batches``: the number
    of the last batch; what is flushed after it is labelled by the next number.
    """
    home = fresh_path(spark, "changes")
    rows.write.partitionBy("batch").parquet(f"{home}/staged")
    largest = {r["batch"]: r["day"] for r in spark.read.schema(f"{ROWS}, batch int").parquet(f"{home}/staged").groupBy("batch").agg(F.max("day").alias("day")).collect()}
    last = batches + 1
    beyond = max(largest.values(), default=0) + 2 * wait + 1
    sentinel = spark.sql(f"SELECT '{SENTINEL}' AS who, 0L AS n, {beyond}L AS day, 0L AS change_id, '' AS op, '' AS city, 0D AS balance, timestamp_seconds({beyond}L * 86400) AS event")
    sentinel.write.parquet(f"{home}/staged/batch={last}")
    spark._jvm.org.apache.hadoop.fs.Path(f"{home}/fed").getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(spark._jvm.org.apache.hadoop.fs.Path(f"{home}/fed"))
    with settings(spark, stateStore_providerClass="org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", stateStore_rocksdb_changelogCheckpointing_enabled="true", stateStore_rocksdb_allowFAllocate="false", stateStore_maintenanceInterval="15s", noDataMicroBatches_enabled="true"):
        for batch in range(1, last + 1):
            move(spark, f"{home}/staged/batch={batch}", f"{home}/fed/batch={batch}")
            began = max([d for b, d in largest.items() if b < batch], default=0) - wait
            fed = spark.readStream.schema(f"{ROWS}, batch int").parquet(f"{home}/fed").drop("batch").withWatermark("event", f"{wait} days")
            out = fed.groupBy("who").transformWithState(Applier(batch, began * DAY_MS, last), OUT, "append", "eventTime")
            out.writeStream.format("parquet").option("path", f"{home}/out").option("checkpointLocation", f"{home}/checkpoint").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    drop_path(spark, f"{home}/fed")
    return spark.read.schema(OUT).parquet(f"{home}/out")


def apply_changes(spark: SparkSession, changes: DataFrame, first_day: int = 19_723, days: int = 160, batches: int = 8, wait: int = 5) -> DataFrame:
    """What becomes of each change: change_id, client_id, status, batch, missed, city, balance, current.

    ``first_day`` (as days since 1970) and ``days`` are cut into ``batches`` of equal length; later days belong to the last.
    """
    done = apply_stream(spark, sequenced(spark, changes, first_day, days, batches), wait, batches)
    ends = done.where("status = 'applied'").groupBy("who").agg(F.max("n").alias("n")).withColumn("final", F.lit(True)).withColumnsRenamed({"who": "_who", "n": "_n"})
    # one row of a key is its last, so this join deals a key with many rows out by their numbers
    marked = done.join(ends.hint("merge"), (done["who"] == ends["_who"]) & (done["n"] == ends["_n"]), "left")
    current = (F.col("status") == "applied") & F.coalesce(F.col("final"), F.lit(False)) & ~F.col("op").eqNullSafe("D")
    return marked.select("change_id", F.when(F.col("who") != "null", F.expr("substr(who, 2)").cast("bigint")).alias("client_id"), "status", "batch", "missed", "city", "balance", current.alias("current"))
