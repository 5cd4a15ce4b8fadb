"""Services asked while Spark runs: lookups by key, a listing as a stream, and a quota that all tasks share."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition

from .landing import ROW, Throttle, Unanswered

ANSWER = "documentId string, body string, found boolean"
LOOKED_UP = "status int, body string, refused bigint"


class KeyPartition(InputPartition):
    def __init__(self, keys: tuple[str, ...]):
        self.keys = keys


class KeyReader(DataSourceReader):
    """Bodies of the ids that a filter names. The service is asked for these ids only, ``keysPerTask`` of them in each task."""

    def __init__(self, options: dict, fetch: Callable[[str], tuple[int, dict | None]]):
        self.fetch, self.keys = fetch, None
        self.step, self.delay, self.wait, self.tries = int(options.get("keyspertask", 100)), float(options.get("delay", 1.0)), float(options.get("wait", 30.0)), int(options.get("tries", 2))
        self.strict = options.get("failures", "null") == "error"

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("documentId",):
                named = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.keys = named if self.keys is None else self.keys & named
            else:
                yield f  # Spark applies it to the rows

    def partitions(self) -> list[InputPartition]:
        if self.keys is None:
            raise ValueError("a lookup needs a filter that names its ids: documentId = ... or documentId IN (...)")
        keys = sorted(k for k in self.keys if k is not None)
        return [KeyPartition(tuple(keys[i : i + self.step])) for i in range(0, len(keys), self.step)] or [KeyPartition(())]

    def read(self, partition: KeyPartition) -> Iterator[tuple]:
        throttle = Throttle(self.delay, tries=self.tries, wait=self.wait, error_wait=self.wait)
        for key in partition.keys:
            absent = False

            def ask(key=key) -> tuple[int, dict | None]:
                nonlocal absent
                status, body = self.fetch(key)
                absent = status == 404
                return status, body

            body = throttle.call(ask)
            if body is None and not absent and self.strict:
                raise Unanswered(f"document {key}")
            yield key, None if body is None else json.dumps(body), body is not None


def lookup_source(fetch: Callable[[str], tuple[int, dict | None]]) -> type[DataSource]:
    """A data source class named ``lookup``: documentId, body (JSON), found. ``fetch``: id to (status, body).

    Needs ``spark.sql.python.filterPushdown.enabled``. Options: keysPerTask, delay, wait, tries, failures (``null``: an id without
    an answer has a null body; ``error``: its task fails and Spark tries it again). A missing document is null either way.
    """

    class LookupSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return "lookup"

        def schema(self) -> str:
            return ANSWER

        def reader(self, schema) -> DataSourceReader:
            return KeyReader({k.lower(): v for k, v in self.options.items()}, fetch)

    return LookupSource


class Pages(InputPartition):
    def __init__(self, sort: str, first: int, last: int, start: int, end: int):
        self.sort, self.first, self.last, self.start, self.end = sort, first, last, start, end


class ListingStream(DataSourceStreamReader):
    """What a listing has grown by since the last batch. Its sort orders must add new documents at their ends.

    The offset holds the number of rows of each sort order, and is asked of the service alone, so a query that starts again
    goes on where its checkpoint says: each row comes once.
    """

    def __init__(self, options: dict, fetch: Callable[[str, int, int], tuple[int, dict | None]]):
        self.sorts = [s for s in options.get("sorts", "postedDate").split(",") if s]
        self.size, self.step = int(options.get("pagesize", 250)), int(options.get("pagespertask", 20))
        self.delay, self.wait, self.fetch = float(options.get("delay", 1.0)), float(options.get("wait", 60.0)), fetch

    def page(self, throttle: Throttle, sort: str, page: int) -> dict:
        body = throttle.call(lambda: self.fetch(sort, page, self.size), ())
        if body is None:
            raise Unanswered(f"page {page} of sort order {sort}")
        return body

    def rows(self, sort: str) -> int:
        """Rows of a sort order: its total, or else where pages end, found by doubling and halving."""
        throttle = Throttle(self.delay, wait=self.wait, error_wait=self.wait / 2)
        body = self.page(throttle, sort, 1)
        total = (body.get("meta") or {}).get("totalElements")
        if total is not None:
            return int(total)
        held = lambda p: len(self.page(throttle, sort, p).get("data") or [])
        low, high = 0, 1  # pages up to ``low`` are full
        while held(high) == self.size:
            low, high = high, high * 2
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if held(middle) == self.size else (low, middle)
        return low * self.size + held(low + 1)

    def initialOffset(self) -> dict:
        return {s: 0 for s in self.sorts}

    def latestOffset(self) -> dict:
        return {s: self.rows(s) for s in self.sorts}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        parts: list[InputPartition] = []
        for s in self.sorts:
            first, last = start.get(s, 0), end.get(s, 0)
            for page in range(first // self.size + 1, -(-last // self.size) + 1, self.step):
                parts.append(Pages(s, page, min(page + self.step - 1, -(-last // self.size)), first, last))
        return parts

    def read(self, partition: Pages) -> Iterator[tuple]:
        throttle = Throttle(self.delay, wait=self.wait, error_wait=self.wait / 2)
        for page in range(partition.first, partition.last + 1):
            for i, d in enumerate(self.page(throttle, partition.sort, page).get("data") or []):
                if partition.start <= (page - 1) * self.size + i < partition.end:
                    a = d.get("attributes") or {}
                    yield d.get("id"), a.get("title"), a.get("postedDate"), a.get("lastModifiedDate"), a.get("documentType"), a.get("withdrawn"), partition.sort, page, i

    def commit(self, end: dict) -> None:
        pass


def listing_stream(fetch: Callable[[str, int, int], tuple[int, dict | None]]) -> type[DataSource]:
    """A data source class named ``listing_stream`` for ``spark.readStream``; rows and ``fetch`` as of ``landing.listing_source``."""

    class ListingStreamSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return "listing_stream"

        def schema(self) -> str:
            return ROW

        def streamReader(self, schema) -> DataSourceStreamReader:
            return ListingStream({k.lower(): v for k, v in self.options.items()}, fetch)

    return ListingStreamSource


def pace(tasks: int, task: int, per_hour: float) -> tuple[float, float]:
    """(seconds between calls of one task, seconds before its first) so that all tasks together keep to ``per_hour``."""
    between = 3600.0 * tasks / per_hour
    return between, between * task / tasks


def looked_up(ids: DataFrame, fetch: Callable[[str], tuple[int, dict | None]], key: str = "documentId", per_hour: float | None = None, tries: int = 5, wait: float = 30.0, tasks: int = 8, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Each id with the status and body of its last answer and the number of refusals (429) before it.

    With ``per_hour`` the tasks start together as one barrier stage, learn how many they are, and share the quota: each
    calls once in its share of the hour, one after the other, and tries again count as calls too. A service's refusals
    are a column, so their sum counts no call twice when a task is run again. An id without an answer has status 0.
    """
    kind = ids.schema[key].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        between = due = 0.0
        if per_hour:
            from pyspark import BarrierTaskContext

            context = BarrierTaskContext.get()
            context.barrier()
            between, first = pace(len(context.getTaskInfos()), context.partitionId(), per_hour)
            due = clock() + first
        for batch in batches:
            out: list[list] = [[], [], []]
            for value in batch.column(0).to_pylist():
                status, body, refused = 0, None, 0
                for n in range(tries):
                    if between:
                        sleep(max(0.0, due - clock()))
                        due = max(due, clock()) + between
                    try:
                        status, body = fetch(value)
                    except OSError:
                        status, body = 0, None
                    if status in (200, 404):
                        break
                    refused += status == 429
                    sleep(wait * (n + 1))
                for column, x in zip(out, (status, None if body is None else json.dumps(body), refused)):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out[0], pa.int32()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())], names=[key, "status", "body", "refused"])

    dealt = ids.select(key).repartition(tasks)
    return dealt.mapInArrow(run, f"{key} {kind}, {LOOKED_UP}", barrier=bool(per_hour))


FETCHED = "status int, content_type string, content binary"


def fetched_files(urls: DataFrame, fetch: Callable[[str], tuple[int, str | None, bytes | None]], url: str = "url", tries: int = 2, wait: float = 30.0, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """``urls`` with status, content_type and the content of what was fetched, null where it is no acceptable PDF.

    ``fetch``: url to (status, content type, bytes). Each url is tried again after a wait, twice in all if not told otherwise; only
    urls go to Python workers, and a few files at once come back.
    """
    from pyspark.sql import functions as F

    from .landing import acceptable_pdf

    kind = urls.schema[url].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for value in batch.column(0).to_pylist():
                answer: tuple = (0, None, None)
                for n in range(tries if value is not None else 0):
                    try:
                        answer = fetch(value)
                    except OSError:
                        answer = (0, None, None)
                    if answer[0] in (200, 404):
                        break
                    if n + 1 < tries:
                        sleep(wait * (n + 1))
                yield pa.RecordBatch.from_arrays([pa.array([value], batch.column(0).type), pa.array([answer[0]], pa.int32()), pa.array([answer[1]], pa.string()), pa.array([answer[2]], pa.binary())], names=["_url", "status", "content_type", "content"])

    got = urls.select(url).distinct().mapInArrow(run, f"_url {kind}, {FETCHED}")
    good = (F.col("status") == 200) & acceptable_pdf(F.length("content"), F.col("content_type"), F.substring("content", 1, 4))
    return urls.join(got.withColumn("content", F.when(good, F.col("content"))), F.col(url) == F.col("_url"), "left").drop("_url")
