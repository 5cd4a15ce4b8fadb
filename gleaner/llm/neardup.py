"""Near duplicates by a signature-coordinate inverted join.

Every distinct set of word shingles gets a signature of COORDINATES minima. A set is posted under its
coordinate-value pairs, but only under a prefix: two sets that agree in MATCHES coordinates or more must
share one of the first COORDINATES - MATCHES + 1 pairs of any common order, so pairs that many sets hold
are put last and most postings of shared passages are skipped. Each posting list proposes its central
member to the others; collisions are counted on whole signatures, pairs below MATCHES are dropped, and each
member's best one is confirmed on the full sets.

What is left apart is compared in a second round, group by group in blocks, in which pairs inside one component are
skipped; blocks are bounded by sets and by shingles. A group of two is confirmed by its pair.

The order uses a frequency sketch of fixed size. Any common order gives the same candidates' guarantee; the sketch only
decides how long the lists get.

A pair of similarity 0.75 agrees in fewer than MATCHES = 34 of 64 coordinates with probability 4.4e-5 (binomial), once
in about 23,000 times. Every set is posted under its whole prefix, so a pair that agrees in MATCHES or more always shares
a list. A passage that many texts share makes its pairs frequent; a set with fewer than MATCHES frequent pairs has none of
them in its prefix.

Edge cases: texts without words (null ones too) have an empty set, are linked with nothing and kept; equal
texts and repeated rows share a component; texts that share an id stay apart unless they are linked; rows without an
id are linked like others, but never name a component (its id is null where no member has one); very long texts are
read whole; an empty table gives no rows; other columns are not carried by ``deduplicate``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column_function, drop_kept, drop_path, fresh_path, frugal, keep, text_bytes

SHINGLE, COORDINATES, MATCHES = 5, 64, 34
PREFIX = COORDINATES - MATCHES + 1
#: Similarity of linked sets: 100 * shared >= PERCENT * united.
PERCENT = 75
#: Counters of the frequency sketch, the least count at which a pair of coordinate and value is put later, and how
#: many times the mean count makes it so too (the counters' noise).
SKETCH, OFTEN, NOISE = 1 << 20, 32, 4
#: Sets of a block of the second round while a group has few and many blocks, blocks that count as many, and shingles
#: of a block on the average; a unit holds two blocks.
UNIT, LARGE, MANY, SHINGLES = 512, 4096, 16, 1 << 20
#: Most rows that are broadcast after they have been counted.
BROADCAST_ROWS = 100_000

_random = np.random.default_rng(20240229)
_FACTORS = _random.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _random.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
_SALTS = _random.integers(1, 1 << 63, COORDINATES, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(raw: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a UTF-8 text's shingles, A-Z lower-cased; the whole sequence if it is shorter."""
    words = raw.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b"\x00".join(words), seed=len(words))], np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - SHINGLE + 1
    mixed = each[:n].copy()
    for k in range(1, SHINGLE):
        mixed = (mixed ^ (mixed >> np.uint64(31))) * _STEP + each[k : k + n]
    return np.unique(mixed)


def signature(found: np.ndarray) -> np.ndarray:
    """Minima of a non-empty set under COORDINATES hash functions, as 32-bit values."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 2048):
        np.minimum(least, (found[None, at : at + 2048] * _FACTORS[:, None] + _OFFSETS[:, None]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def tokens(signatures: np.ndarray) -> np.ndarray:
    """64-bit names of coordinate-value pairs, one row per signature."""
    x = (signatures.astype(np.uint64) ^ _SALTS[None, :]) * _STEP
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def buckets(names: np.ndarray) -> np.ndarray:
    return (names >> np.uint64(44)).astype(np.int64)


def matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both) and both > 0


def key_of(found: np.ndarray) -> bytes | None:
    """Digest of a set; none for an empty one."""
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None


def fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, n_shingles, set_key (digest of the set) and signature; the last two null for an empty set."""
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_bytes(text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, signs = [], [], []
            for raw in batch.column(1):
                found = shingle_set(raw.as_py())
                sizes.append(len(found))
                keys.append(key_of(found))
                signs.append(signature(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signs, pa.binary())], names=["doc_id", "n_shingles", "set_key", "sig"])

    return source.mapInArrow(frugal(run), "doc_id bigint, n_shingles bigint, set_key binary, sig binary")


def frequency_sketch(sets: DataFrame) -> dict[int, int]:
    """Bucket and rough binary log of the count, for the buckets of pairs that are held often. At most SKETCH entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                total += np.bincount(buckets(tokens(matrix(batch.column(0).slice(at, 500)))).ravel(), minlength=SKETCH)
        at = np.flatnonzero(total >= max(2, NOISE * total.sum() // SKETCH))  # what is often everywhere is so in most tasks
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    least = max(OFTEN, NOISE * COORDINATES * sets.count() // SKETCH)
    counted = sets.select("sig").mapInArrow(frugal(run), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return {r["bucket"]: int(np.log2(r["n"])) for r in counted.toLocalIterator()}


def prefixes(signatures: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The first PREFIX pairs of each signature by the common order: seldom ones first."""
    names = tokens(signatures)
    order = np.lexsort((names, often[buckets(names)]), axis=1)[:, :PREFIX]
    return np.take_along_axis(names, order, axis=1)


def table_of(sketch: dict[int, int]) -> np.ndarray:
    often = np.zeros(SKETCH, np.int8)
    if sketch:
        often[np.fromiter(sketch.keys(), np.int64)] = np.fromiter(sketch.values(), np.int8)
    return often


def postings(sets: DataFrame, often) -> DataFrame:
    """(token, rep, frequent): each set under its prefix, with the number of its pairs that are frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = often.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                signs = matrix(part.column(1))
                names, frequent = prefixes(signs, order), (order[buckets(tokens(signs))] > 0).sum(axis=1)
                counts = np.repeat(frequent.astype(np.int32), PREFIX)
                yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64).ravel()), pa.array(np.repeat(part.column(0).to_numpy(), PREFIX)), pa.array(counts)], names=["token", "rep", "frequent"])

    return sets.select("rep", "sig").mapInArrow(frugal(run), "token bigint, rep bigint, frequent int")


def matched(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose signatures agree in MATCHES coordinates or more, with the number (matches)."""
    left, right = sets.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a")), sets.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                same = (matrix(batch.column(2)) == matrix(batch.column(3))).sum(axis=1)
                good = pa.array(same >= MATCHES)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good), pa.array(same, pa.int32()).filter(good)], names=["a", "b", "matches"])

    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(frugal(run), "a bigint, b bigint, matches int")


def confirmed(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """Pairs (a, b) that are linked on their full sets. held: (rep, text), of any superset of the pairs' members."""
    both = pairs.select("a", "b").join(held.select(F.col("rep").alias("b"), F.col("text").alias("text_b")), "b").join(held.select(F.col("rep").alias("a"), F.col("text").alias("text_a")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None
        for batch in batches:
            good = []
            for a, ta, tb in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if a != last or own is None:
                    last, own = a, shingle_set(ta.as_py())
                good.append(linked(own, shingle_set(tb.as_py())))
            good = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good)], names=["a", "b"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(frugal(run), "a bigint, b bigint")


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(rep, component) for the members of links (a, b): the smallest member that is reachable.

    Every round hooks each node to its smallest neighbour, follows that pointer once more, and contracts
    the links; the number of rounds grows with the log of the longest chain.
    """
    links = keep(spark, links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    label = keep(spark, links.select(F.explode(F.array("a", "b")).alias("rep")).distinct().withColumn("component", F.col("rep")), "labels")
    while links.limit(1).count():
        hook = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.min("b").alias("b"))
        hook = keep(spark, hook.select(F.col("a").alias("node"), F.least("a", "b").alias("to")), "hooks")
        jump = hook.select(F.col("node").alias("to"), F.col("to").alias("further"))
        hook = keep(spark, hook.join(jump, "to", "left").select("node", F.coalesce("further", "to").alias("to")), "hooks")
        label = keep(spark, label.join(hook.withColumnRenamed("node", "component"), "component", "left").select("rep", F.coalesce("to", "component").alias("component")), "labels")
        moved = links.join(hook.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").join(hook.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        links = keep(spark, moved.where("x != y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "links")
    return label


def second_round(spark: SparkSession, posted: DataFrame, sets: DataFrame, near: DataFrame, best: DataFrame, label: DataFrame, texts_of) -> DataFrame:
    """Links (a, b) between members of different components that share a list.

    Lists with one central member are taken together, so each set stands in a few groups only. A group is cut into
    blocks, each pair of blocks is a unit of bounded size, and a unit compares signatures, skips what is already
    connected, and confirms the rest on the full sets. Only links leave it. A group of two has one pair, which is
    confirmed if it is ``near`` and wasn't its member's ``best`` one.
    """
    members = posted.select("a", "rep").distinct().join(label, "rep", "left").join(sets.select("rep", "n_shingles"), "rep").select("a", "rep", "n_shingles", F.coalesce("component", "rep").alias("component"))
    members = keep(spark, members, "members")
    groups = members.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"), F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
    groups = keep(spark, groups.select("a", "n", "s"), "apart")
    single = keep(spark, near.select("a", "b").join(groups.where("n = 2").select("a"), "a", "left_semi").join(best, ["a", "b"], "left_anti"), "single")
    blocks = F.greatest(F.least(F.ceil(F.col("n") / UNIT), F.lit(MANY)), F.ceil(F.col("n") / LARGE), F.ceil(F.col("s") / SHINGLES)).cast("int")
    groups = keep(spark, groups.where("n > 2").select("a", blocks.alias("blocks")), "groups")
    rows = members.drop("n_shingles").join(groups, "a").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = keep(spark, rows, "open")
    held = texts_of(rows.select("rep"))
    full = rows.join(sets.select("rep", "sig"), "rep").join(held, "rep")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    units = full.select("a", "rep", "component", "sig", "text", "block", other).select("a", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "component", "sig", "text")

    def run(unit: pa.Table) -> pa.Table:
        unit = unit.combine_chunks()
        rep, component, block = (unit[c].to_numpy() for c in ("rep", "component", "block"))
        i, j = unit["i"][0].as_py(), unit["j"][0].as_py()
        signs, found, cache = matrix(unit["sig"]), [], {}
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        root = {int(c): int(c) for c in component}

        def top(c: int) -> int:
            while root[c] != c:
                c = root[c]
            return c

        def of(k: int) -> np.ndarray:
            if k not in cache:
                cache[k] = shingle_set(unit["text"][k].as_py())
            return cache[k]

        for x in left:
            same = (signs[x][None, :] == signs[right]).sum(axis=1)
            near = right[(same >= MATCHES) & (component[right] != component[x]) & (right > x if i == j else True)]
            for y in near:
                p, q = top(int(component[x])), top(int(component[y]))
                if p != q and linked(of(int(x)), of(int(y))):
                    root[max(p, q)] = min(p, q)
                    found.append((int(rep[x]), int(rep[y])))
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    found = keep(spark, units.groupBy("a", "i", "j").applyInArrow(run, "a bigint, b bigint"), "found")
    drop_kept(spark, held)
    return found.unionByName(confirmed(single, texts_of(single.select(F.explode(F.array("a", "b"))))))


def grouped(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all rows, and every distinct set: set_key, first_id (its smallest id), component and component_id.

    A component is known by a number of its own; its component_id is its smallest id.
    """
    facts = keep(spark, fingerprints(docs, id_col, text_col), "fingerprints")
    sets = facts.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"))
    sets = keep(spark, sets.withColumn("rep", F.monotonically_increasing_id()), "sets")
    often = spark.sparkContext.broadcast(table_of(frequency_sketch(sets)))
    path = fresh_path(spark, "postings")
    postings(sets, often).write.parquet(path)
    posted = spark.read.schema("token bigint, rep bigint, frequent int").parquet(path)

    # the central member of a list has most frequent pairs: copies of a text keep its pairs, and add their own.
    # kept, so that Spark can split a long list's rows on either side of the join
    lists = keep(spark, posted.groupBy("token").agg(F.max_by("rep", F.struct("frequent", -F.col("rep"))).alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").select("token", "a"), "lists")
    posted = keep(spark, posted.select("token", "rep").join(lists, "token").select("a", "rep"), "shared")  # most pairs of coordinate and value belong to one set
    drop_path(spark, path)
    near = keep(spark, matched(posted.where("a != rep").select("a", F.col("rep").alias("b")).distinct(), sets), "near")
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_bytes(text_col).alias("text"))

    nameless = sets.where("first_id is null").limit(1).count() > 0
    repeated = facts.where("doc_id is not null and set_key is not null").groupBy("doc_id").count().where("count > 1").limit(1).count() > 0

    def texts_of(reps: DataFrame) -> DataFrame:
        """(rep, text) of the given sets, each once, from a row that has the set's smallest id."""
        wanted = sets.select("rep", "first_id", "set_key").join(reps.toDF("rep").distinct(), "rep")
        if not (nameless or repeated):  # ids tell the texts
            wanted = keep(spark, wanted.select("rep", "first_id"), "wanted")
            few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
            return keep(spark, texts.join(F.broadcast(wanted) if few else wanted, texts["doc_id"] == wanted["first_id"]).select("rep", "text"), "texts")
        # ids may repeat with other texts or be missing: the digests tell the right ones
        wanted = keep(spark, wanted, "wanted")
        both = texts.join(wanted, texts["doc_id"] == wanted["first_id"]).select("rep", "set_key", "text")
        both = both.unionByName(texts.where("doc_id is null").select(F.lit(-1).cast("bigint").alias("rep"), F.lit(None).cast("binary").alias("set_key"), "text"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = [key_of(shingle_set(t.as_py())) for t in batch.column(2)]
                good = pa.array([k is not None and sought in (None, k) for k, sought in zip(keys, batch.column(1).to_pylist())], pa.bool_())
                yield pa.RecordBatch.from_arrays([c.filter(good) for c in (batch.column(0), pa.array(keys, pa.binary()), batch.column(2))], names=["rep", "set_key", "text"])

        found = keep(spark, both.mapInArrow(frugal(run), "rep bigint, set_key binary, text binary"), "found")
        own = found.where("rep = -1").drop("rep").join(wanted.where("first_id is null").select("rep", "set_key"), "set_key")
        found = found.where("rep != -1").unionByName(own.select("rep", "set_key", "text"))
        return keep(spark, found.select("rep", "text").dropDuplicates(["rep"]), "texts")

    best = keep(spark, near.groupBy("b").agg(F.max_by("a", F.struct("matches", -F.col("a"))).alias("a")).select("a", "b"), "best")
    held = texts_of(best.select(F.explode(F.array("a", "b"))))
    links = keep(spark, confirmed(best, held), "confirmed")
    drop_kept(spark, held)
    label = components(spark, links)
    again = keep(spark, second_round(spark, posted, sets, near, best, label, texts_of), "again")
    if again.limit(1).count():
        label = components(spark, links.unionByName(again))
    named = sets.join(label, "rep", "left").select("set_key", "rep", "first_id", F.coalesce("component", "rep").alias("component"))
    named = keep(spark, named, "named")
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return facts, keep(spark, named.join(least, "component"), "components")


def deduplicate(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id (bigint), n_shingles, component_id (smallest id reachable over links), kept (it is its own component_id).

    A row without an id is kept if no member of its component has one.
    """
    facts, sets = grouped(spark, docs, id_col, text_col)
    out = facts.select("doc_id", "n_shingles", "set_key").join(sets.select("set_key", F.col("component_id").alias("found")), "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("found"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def kept_documents(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, of one document of each component, and all without words.

    Of a component the row of the smallest id stays; where that id has several of its texts, that of one set; of rows
    that repeat, any one; rows without an id only where no row of the component has one. Columns may have any names but
    ``_gone_id`` and ``_gone_mixed``.
    """
    facts, sets = grouped(spark, docs, id_col, text_col)
    chosen = sets.where(F.col("first_id").eqNullSafe(F.col("component_id"))).groupBy("component").agg(F.min("rep").alias("rep"))
    chosen = sets.join(chosen, ["component", "rep"], "left_semi").select("set_key", "first_id")
    rows = facts.join(chosen.withColumn("one", F.lit(True)), "set_key", "left")
    stays = F.col("set_key").isNull() | F.coalesce("one", F.lit(False)) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    rows = keep(spark, rows.select("doc_id", "set_key", stays.alias("stays")), "verdicts")
    ids = rows.where("doc_id is not null").groupBy("doc_id").agg(F.count_if("stays").alias("stay"), F.count(F.lit(1)).alias("n"))
    # an id of one row, or none of whose rows stays, decides by itself; the others are told apart by their sets
    gone = keep(spark, ids.where("stay = 0 or (stay > 0 and n > 1)").select(F.col("doc_id").alias("_gone_id"), (F.col("stay") > 0).alias("_gone_mixed")), "gone")
    if gone.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    number = F.col(id_col).cast("bigint")
    kept = docs.where(number.isNotNull()).join(gone, number == F.col("_gone_id"), "left_anti")
    mixed = docs.join(gone.where("_gone_mixed"), number == F.col("_gone_id"), "left_semi").unionByName(docs.where(number.isNull()))
    if not mixed.limit(1).count():
        return kept

    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([key_of(shingle_set(t.as_py() or b"")) for t in batch], pa.binary())

    own = mixed.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), number.alias("_id"), column_function(each, "binary", steady=False)(F.col(text_col).cast("binary")).alias("_key"))
    stay = rows.where("stays").select(F.col("doc_id").alias("_stay_id"), F.col("set_key").alias("_stay_key")).distinct()
    own = own.join(stay, F.col("_id").eqNullSafe(F.col("_stay_id")) & F.col("_key").eqNullSafe(F.col("_stay_key")), "left_semi")
    worded = own.where("_key is not null").dropDuplicates(["_id", "_key"]).unionByName(own.where("_key is null"))
    return kept.unionByName(worded.select("_row.*"))
