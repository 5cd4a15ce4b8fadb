"""Positions, like names, versions, live sources, the committed writer and resumed lookups, against plain Python."""

import os
import random
import tempfile
import time
import uuid

import pytest
from pyspark.sql import functions as F

from gleaner.operators import likeness, positions, relational, versions
from gleaner.sources import committed, landing, live
from gleaner.streaming import resume


def folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="gleaner-test-")


# -- positions ---------------------------------------------------------------------------------------------------

def test_positions_equal_a_sorted_list(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(40)]), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    got = positions.numbered(spark, df, F.asc("a"), F.desc("b")).collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, -r[1]))
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.position)] == want and sorted(r.position for r in got) == list(range(1, 2001))
    part = positions.between(spark, df, 1500, 1520, F.asc("a"), F.desc("b")).collect()
    assert {(r.a, r.b) for r in part} == set(want[1499:1520])
    assert positions.numbered(spark, df.where("b < 0"), F.asc("a")).count() == 0 and positions.between(spark, df, 3000, 3010, F.asc("a")).count() == 0
    assert {(r.a, r.b) for r in relational.row_range(df, [F.asc("a"), F.desc("b")], 1990, 2005).collect()} == set(want[1989:])


def test_positions_bring_all_rows_to_no_task(spark):
    plan = positions.numbered(spark, spark.range(1000), F.desc("id"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert all("_range" in w for w in plan.split("Window [")[1:])  # the only window numbers ranges, not rows


def test_dense_ranks_equal_brute_force(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, 1, 1, 1, 2, 3]), rng.choice([None, *range(30)])) for _ in range(3000)]
    got = positions.dense_ranks(spark, spark.createDataFrame(rows, "k int, v int").repartition(5), "k", "v").collect()
    want = set()
    for k in {r[0] for r in rows}:
        own = sorted({v for key, v in rows if key == k}, key=lambda v: (v is not None, v or 0))
        want |= {(k, v, n + 1) for n, v in enumerate(own)}
    assert {(r.k, r.v, r["rank"]) for r in got} == want and len(got) == len(want)


# -- like names --------------------------------------------------------------------------------------------------

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        before, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, before + (x != y))
    return row[-1]


@pytest.mark.parametrize("percent,q", [(80, 2), (70, 3), (50, 2), (100, 2)])
def test_like_pairs_equal_all_pairs(spark, percent, q):
    rng = random.Random(percent)
    names = {"".join(rng.choice("aabé ") for _ in range(rng.randint(1, 14))) for _ in range(220)} | {"aaaaaaaaaa", "aaaaaaaaa", "aaaaaaaabb"}
    df = spark.createDataFrame([(n,) for n in [*names, *list(names)[:9], None, ""]], "name string")
    got = {(r.a, r.b, r.edits) for r in likeness.like_pairs(df, "name", percent, q).collect()}
    order = sorted(names, key=lambda n: n.encode())
    want = set()
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            d = distance(a, b)
            if 100 * d <= (100 - percent) * max(len(a), len(b)):
                want.add((a, b, d))
    assert got == want and (percent == 100 or len(want) > 20)


def test_like_pairs_need_no_cross_join(spark):
    df = spark.createDataFrame([("a b",), ("a c",)], "name string")
    plan = likeness.like_pairs(df, "name")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    with pytest.raises(ValueError):
        likeness.like_pairs(df, "name", 40, 2)


def test_like_pairs_never_meet_on_the_driver(spark):
    from gleaner.plans.services import like_clients

    pairs = like_clients(spark, "/root/testdata/sf0.001")
    pairs.collect()
    # a name's pieces are many times its size, which Spark's estimate doesn't know
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


# -- versions ----------------------------------------------------------------------------------------------------

def test_versions_are_added_and_the_table_stays(spark):
    name = f"v_{uuid.uuid4().hex}"
    rows = lambda *r: spark.createDataFrame(list(r), "id long, x string")
    versions.add_version(spark, name, rows((1, "a"), (2, "b"), (3, None)), "id", 1, buckets=4)
    before = set(spark.table(name).inputFiles())
    for _ in range(2):  # the second time changes nothing
        versions.add_version(spark, name, rows((2, "c"), (4, "d")), "id", 2, buckets=4)
        assert {(r.id, r.x, r.version) for r in versions.latest(spark, name, "id").collect()} == {(1, "a", 1), (2, "c", 2), (3, None, 1), (4, "d", 2)}
    assert before <= set(spark.table(name).inputFiles())
    assert "Exchange" not in versions.latest(spark, name, "id")._jdf.queryExecution().executedPlan().toString()
    assert [r.id for r in versions.unfinished(spark, name, rows((4, ""), (9, "")), "id").collect()] == [9]


# -- services ----------------------------------------------------------------------------------------------------

def test_lookup_asks_for_the_filtered_ids_only(spark):
    log = tempfile.mkdtemp()

    def fetch(key, log=log):
        with open(f"{log}/{key}-{uuid.uuid4().hex}", "w"):
            pass
        return (404, None) if key == "D4" else (500, None) if key == "D5" else (200, {"n": key})

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(live.lookup_source(fetch))
    read = lambda **o: spark.read.format("lookup").options(delay="0", wait="0", keysPerTask="2", **o).load()
    got = {r.documentId: (r.body, r.found) for r in read().where("documentId IN ('D1', 'D4', 'D5')").collect()}
    assert got == {"D1": ('{"n": "D1"}', True), "D4": (None, False), "D5": (None, False)}
    asked = sorted(f.split("-")[0] for f in os.listdir(log))
    assert asked == ["D1", "D4", "D5", "D5"]  # two tries where there is no answer, and no other id
    assert [r.found for r in read().where("documentId = 'D7' AND found").collect()] == [True]
    with pytest.raises(Exception, match="names its ids"):
        read().collect()
    with pytest.raises(Exception, match="D5"):
        read(failures="error").where("documentId = 'D5'").collect()


def listing(total, tell=True):
    def fetch(sort, page, size):
        ids = range(total) if sort == "up" else range(1000, 1000 + total)
        data = [{"id": f"{sort}{i}", "attributes": {"title": f"t{i}"}} for i in list(ids)[(page - 1) * size : page * size]]
        return 200, {"data": data, "meta": {"totalElements": total} if tell else {}}

    return fetch


@pytest.mark.parametrize("tell", [True, False])
def test_listing_stream_gives_each_row_once_over_restarts(spark, tell):
    out, checkpoint = folder(), folder()
    for total in (7, 7, 23, 24):  # the query is started anew each time
        spark.dataSource.register(live.listing_stream(listing(total, tell)))
        stream = spark.readStream.format("listing_stream").options(sorts="up,other", pageSize="5", delay="0", wait="0", pagesPerTask="2").load()
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination(120)
    rows = [r[0] for r in spark.read.parquet(out).select(spark.read.parquet(out).columns[0]).collect()]
    assert sorted(rows) == sorted([f"up{i}" for i in range(24)] + [f"other{i}" for i in range(1000, 1024)])


def test_listing_without_an_end_is_an_error():
    reader = landing.ListingReader({"delay": "0", "wait": "0", "pagesize": "2"}, lambda s, p, n: (200, {"data": [{"id": "a"}, {"id": "b"}]}))
    (part,) = reader.partitions()
    with pytest.raises(landing.Unanswered):
        for _ in reader.read(part):
            pass


def test_tasks_share_the_quota(spark):
    log = tempfile.mkdtemp()

    def fetch(key, log=log):
        with open(f"{log}/{uuid.uuid4().hex}", "w") as f:
            f.write(repr(time.time()))
        return (429, None) if key == 3 and len(os.listdir(log)) < 3 else (200, {"n": key})

    per_hour = 36_000  # ten a second
    got = live.looked_up(spark.range(1, 25).withColumnRenamed("id", "documentId"), fetch, per_hour=per_hour, tasks=3, wait=0.0).collect()
    assert sorted(r.documentId for r in got) == list(range(1, 25)) and {r.status for r in got} <= {200}
    times = sorted(float(open(f"{log}/{f}").read()) for f in os.listdir(log))
    for i, t in enumerate(times):  # in no second more than the quota, and one call of each task to spare
        assert sum(t <= x < t + 1 for x in times[i:]) <= 10 + 3
    assert [live.pace(4, k, 3600)[1] for k in range(4)] == [0.0, 1.0, 2.0, 3.0]


def test_only_acceptable_files_are_kept(spark):
    log = tempfile.mkdtemp()

    def fetch(url, log=log):
        with open(f"{log}/{url}-{uuid.uuid4().hex}", "w"):
            pass
        if url == "bad":
            raise OSError("no")
        body = b"%PDF-1.4" + b"x" * 2000
        return {"pdf": (200, "application/pdf", body), "blank": (200, "", body), "html": (200, "text/html", body), "small": (200, "application/pdf", b"%PDF"), "other": (200, "", b"GIF8" + body), "gone": (404, None, None), "busy": (503, None, body)}[url]

    names = ["pdf", "blank", "html", "small", "other", "gone", "busy", "bad"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate([*names, "pdf", None])], "n int, url string")
    got = live.fetched_files(df, fetch, wait=0.0).collect()
    assert len(got) == 10 and {r.url for r in got if r.content is not None} == {"pdf", "blank"} and {r.url: r.status for r in got}["bad"] == 0
    asked = [f.split("-")[0] for f in os.listdir(log)]
    assert {u: asked.count(u) for u in names} == {**dict.fromkeys(names, 1), "busy": 2, "bad": 2}


# -- committed files ---------------------------------------------------------------------------------------------

def test_files_of_a_failed_write_are_not_seen(spark):
    spark.dataSource.register(committed.CommittedFiles)
    path = folder()
    save = lambda df: df.write.format("committed").mode("append").option("path", path).save()
    assert committed.committed(spark, path).count() == 0
    save(spark.createDataFrame([("a", b"1"), ("b", None), (None, b"x")], "file_name string, content binary").repartition(3))
    bad = spark.range(8).repartition(4).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("file_name"), F.when(F.col("id") == 6, F.raise_error(F.lit("no"))).otherwise(F.lit("y")).cast("binary").alias("content"))
    with pytest.raises(Exception):
        save(bad)
    assert {(r.name, bytes(r.content)) for r in committed.contents(spark, path).collect()} == {("a", b"1"), ("b", b"")}
    save(spark.createDataFrame([("d", b"22")], "file_name string, content binary"))
    assert {(r.name, r["size"]) for r in committed.committed(spark, path).collect()} == {("a", 1), ("b", 0), ("d", 2)}


# -- resumed lookups ---------------------------------------------------------------------------------------------

def test_resumed_lookups_ask_once_and_wait_on_timers(spark):
    log, source, out, checkpoint = tempfile.mkdtemp(), folder(), folder(), folder()

    def fetch(key, log=log):
        with open(f"{log}/{key}-{uuid.uuid4().hex}", "w"):
            pass
        asked = sum(f.startswith(f"{key}-") for f in os.listdir(log))
        return (429, None) if key == "slow" and asked < 3 else (404, None) if key == "gone" else (200, len(key))

    schema = "documentId string, known struct<value: int>"
    spark.createDataFrame([("a", None), ("slow", None), ("gone", None), ("had", (7,)), ("null", (None,))], schema).coalesce(1).write.mode("append").parquet(source)
    have, deadline = {}, time.time() + 100
    for start in range(2):  # stopped and started again on its checkpoint, with ids that come once more
        query = resume.start_resumed(spark, spark.readStream.schema(schema).parquet(source), fetch, out, checkpoint, wait=0.5)
        while query.isActive and time.time() < deadline and len(have) < 5 + start:
            time.sleep(1)
            try:
                have = {r.documentId: (r.value, r.tries) for r in spark.read.schema(resume.RESULT).parquet(out).collect()}
            except Exception:  # nothing written yet
                pass
        assert query.exception() is None
        query.stop()
        spark.createDataFrame([("a", None), ("gone", None), ("null", None), ("slow", None), ("new", None)], schema).coalesce(1).write.mode("append").parquet(source)
    rows = spark.read.schema(resume.RESULT).parquet(out).collect()
    assert {r.documentId: (r.value, r.tries) for r in rows} == {"a": (1, 1), "slow": (4, 3), "gone": (None, 1), "had": (7, 0), "null": (None, 0), "new": (3, 1)} and len(rows) == 6
    asked = [f.split("-")[0] for f in os.listdir(log)]
    assert {k: asked.count(k) for k in set(asked)} == {"a": 1, "slow": 3, "gone": 1, "new": 1}


# -- cards -------------------------------------------------------------------------------------------------------

def test_cards_keep_their_own_version_and_mark(spark):
    from gleaner.sources import cards

    head = lambda kind, when: f"<h3>Federal {kind} Raw\nData ({when})</h3>"
    pages = [
        (1, f"<div class='card'>{head('Employment', ' May 2020 ')}</div><p>Version: 7 Current<div class='card'>{head('separations', 'June 2021')}<p>Version: 12<span>Current</span></div>"),
        (2, f"<div><div><div>{head('Accessions', 'X')}</div>Version: 3</div>Current</div>"),  # no card: the parent of its parent
        (3, f"<div class=wide-card><div class='inner card'>{head('Employment', 'A')}</div>Version: 9 Current</div>"),  # the nearest one
        (4, f"<div class='card'><!-- Current --><script>if (a < b) {{ 'Version: 5' }}</script><img src='x'>{head('Employment', 'B&amp;C')}<br/><P>Version:4"),  # never closed
        (5, None), (6, ""), (7, "<h1>Federal Employment</h1> Raw Data (no)"), (8, "< <> </ </div></div>" + f"<div class=\"card\"><b class='the-title'>Federal <i>Employment</i>&nbsp;Raw Data (C)</b></div>"),
    ]
    got = {(r.page_id, r.card_no): (r.source, r.dateLabel, r.version, r.isCurrent) for r in cards.structured_cards(spark.createDataFrame(pages, "page_id int, html string"), "page_id").collect()}
    assert got == {
        (1, 0): ("Employment", "May 2020", "1", False), (1, 1): ("separations", "June 2021", "12", True), (2, 0): ("Accessions", "X", "3", False),
        (3, 0): ("Employment", "A", "1", False), (4, 0): ("Employment", "B&C", "1", False), (8, 0): ("Employment", "C", "1", False),
    }
