"""Phrases whose words stand together more often than apart, counted exactly.

Words that occur often enough get an id of 64 bits; texts are cut into pieces at punctuation, and broken further at all other
words. Pairs and triples of neighbouring ids are packed into keys of fixed width, dealt by ranges of the keys, sorted and
counted as runs.

* The id is a hash of language and word, and the dictionary (the frequent words with their counts) is checked to have one
  word for each; if two ever meet, the hash is salted anew. So texts need no join with a dictionary that grows with them.
* Which ids are frequent, workers see in a bitmap of fixed size. A word that shares its bit with a frequent one only
  makes keys that are too seldom in the end, since a phrase is never more frequent than its words. The same goes for pairs,
  of which only frequent ones are made into triples.
* A key begins with a mix of its ids from which the last follows, so that ranges of equal width hold like numbers of keys, however
  often one word or phrase occurs. Each task counts its own keys before they are dealt, so a hot key has one row for each.

Edge cases: a null text is an empty one; an empty table gives no rows; a null language is ``und``; rows that repeat count each;
texts of any length are taken whole; a piece or a text of one word only has no phrase. Other columns aren't carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, frugal, keep, small_batches, text_bytes

#: Characters that end a piece, and those that end a word in it.
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
#: Bits of a bitmap: 2^12 ranges of 2^15 bits, 16 MB.
RANGE_BITS, BIT_BITS = 12, 15
#: Most words that a task remembers the ids of, and keys that it counts at once before they are dealt.
REMEMBERED, CHUNK = 400_000, 2_000_000
BREAK = b"\xff"  # never in UTF-8
CUT = bytes(0xFF if b in ENDS else 0x20 if b in BLANKS else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Odd factors of the mix: of pairs the first; of triples both.
FIRST, SECOND = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
MASK = (1 << 64) - 1


def tokens(raw: bytes) -> list[bytes]:
    """Lower-cased words of a text, with ``BREAK`` between pieces."""
    return raw.translate(CUT).replace(BREAK, b" \xff ").split(b" ")


def language(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit("und"))


def start(lang: str, salt: int) -> bytes:
    """What is hashed before a word; no two languages and words run together."""
    raw = lang.encode()
    return f"{salt}:{len(raw)}:".encode() + raw


def id_column(salt: int) -> Column:
    return F.xxhash64(F.concat(F.lit(f"{salt}:"), F.octet_length("lang").cast("string"), F.lit(":"), F.col("lang"), F.col("word")))


def word_id(begin: bytes, word: bytes) -> int:
    """The same in a worker, unsigned."""
    return xxhash.xxh64_intdigest(begin + word, 42)


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, n of all words of texts. Each batch is counted before words are dealt."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, dict[bytes, int]] = {}
            for lang, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = found.setdefault(lang, {})
                for word in tokens(raw.as_py()):
                    counts[word] = counts.get(word, 0) + 1
            for lang, counts in found.items():
                counts.pop(b"", None), counts.pop(BREAK, None)
                words = [w.decode("utf-8", "replace") for w in counts]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), pa.array(words, pa.string()), pa.array(counts.values(), pa.int64())], names=["lang", "word", "n"])

    return docs.mapInArrow(frugal(count), "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def bitmap(ids: DataFrame, col: str) -> np.ndarray:
    """Bits of the ids' first 27 bits: at most 4,096 rows of 4 KB come to the driver, however many ids there are."""
    place = F.shiftrightunsigned(col, 64 - RANGE_BITS - BIT_BITS).bitwiseAND((1 << BIT_BITS) - 1)
    rows = ids.groupBy(F.shiftrightunsigned(col, 64 - RANGE_BITS).alias("range")).agg(F.bitmap_construct_agg(place).alias("bits")).collect()
    out = np.zeros((1 << RANGE_BITS, 1 << (BIT_BITS - 3)), np.uint8)
    for r in rows:
        out[r["range"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out.reshape(-1)


def inside(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which of unsigned ids have their bit set."""
    at = (ids >> np.uint64(64 - RANGE_BITS - BIT_BITS)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def mixed(ids: list[np.ndarray]) -> np.ndarray:
    """The mix of a key's ids. With all ids but the last it gives the last."""
    factors = [np.uint64(f) for f in (FIRST, SECOND)[: len(ids) - 1]]
    return sum((i * f for i, f in zip(ids, factors)), ids[-1])


def packed(ids: list[np.ndarray]) -> pa.RecordBatch:
    """Keys of fixed width (mix, then all ids but the last) with counts, equal ones counted together."""
    mix = mixed(ids)
    order = np.argsort(mix, kind="stable")
    columns = [mix[order], *(i[order] for i in ids[:-1])]
    new = np.ones(len(mix), bool)
    if len(mix):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    first = np.flatnonzero(new)
    n = np.diff(first, append=len(mix))
    keys = np.stack([c[first] for c in columns], axis=1).astype(">u8")
    width = keys.shape[1] * 8
    offsets = pa.array(np.arange(len(first) + 1, dtype=np.int32) * width)
    key = pa.Array.from_buffers(pa.binary(), len(first), [None, offsets.buffers()[1], pa.py_buffer(keys.tobytes())])
    return pa.RecordBatch.from_arrays([key, pa.array(n, pa.int64())], names=["key", "n"])


def counted_keys(docs: DataFrame, size: int, salt: int, words: np.ndarray, pairs: np.ndarray | None = None) -> DataFrame:
    """key, n of the phrases of ``size`` words that are frequent as far as the bitmaps say, counted within each task's chunks."""
    spark = docs.sparkSession
    known, doubled = spark.sparkContext.broadcast(words), spark.sparkContext.broadcast(pairs)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, both = known.value, doubled.value
        memory: dict[str, dict[bytes, int]] = {}
        held: list[list[np.ndarray]] = []

        def numbers(lang: str, raw: bytes) -> np.ndarray:
            """Ids of words, 0 where a piece ends or a word is seldom."""
            ids = memory.setdefault(lang, {b"": -1, BREAK: 0})
            found, words = [], tokens(raw)
            fresh = {w for w in words if w not in ids}
            if fresh:
                begin, order = start(lang, salt), list(fresh)
                new = np.fromiter((word_id(begin, w) for w in order), np.uint64, len(order))
                ids.update(zip(order, np.where(inside(frequent, new), new, np.uint64(0)).tolist()))
            found = [i for i in map(ids.__getitem__, words) if i >= 0]
            if sum(map(len, memory.values())) > REMEMBERED:
                memory.clear()
            return np.array(found, np.uint64)

        def phrases(ids: np.ndarray) -> list[np.ndarray]:
            parts = [ids[k : len(ids) - size + 1 + k] for k in range(size)]
            good = np.logical_and.reduce([p != 0 for p in parts])
            parts = [p[good] for p in parts]
            if size == 3:
                good = inside(both, mixed(parts[:2])) & inside(both, mixed(parts[1:]))
                parts = [p[good] for p in parts]
            return parts

        def flush() -> pa.RecordBatch:
            return packed([np.concatenate(c) for c in zip(*held)])

        total = 0
        for batch in batches:
            for lang, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = numbers(lang, raw.as_py())
                if len(ids) >= size:
                    held.append(phrases(ids))
                    total += len(held[-1][0])
                    if total >= CHUNK:
                        yield from pieces_of(flush())
                        held, total = [], 0
        if held:
            yield from pieces_of(flush())

    return docs.mapInArrow(frugal(emit), "key binary, n bigint")


def pieces_of(batch: pa.RecordBatch, rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def runs(keys: DataFrame, size: int, least: int) -> DataFrame:
    """Ids and counts of phrases found ``least`` times or more: keys are dealt by ranges, sorted, and counted as runs."""
    width = size
    bucket = F.conv(F.hex(F.substring("key", 1, 2)), 16, 10).cast("int")
    dealt = keys.repartition(bucket).sortWithinPartitions("key")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, 0

        def made(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            good = counts >= least
            keys, counts = keys[good].astype(np.uint64), counts[good]
            ids = [keys[:, k] for k in range(1, width)]
            rest = keys[:, 0].copy()
            for i, f in zip(ids, (FIRST, SECOND)):
                rest -= i * np.uint64(f)
            return pa.RecordBatch.from_arrays([*(pa.array(i.view(np.int64)) for i in (*[np.ascontiguousarray(i) for i in ids], rest)), pa.array(counts, pa.int64())], names=[*(f"id{k}" for k in range(1, width + 1)), "a"])

        for batch in batches:
            if not batch.num_rows:
                continue
            raw = batch.column(0)
            flat = np.frombuffer(raw.buffers()[2], ">u8")
            begin = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset] // 8
            keys = flat[begin : begin + batch.num_rows * width].reshape(-1, width)
            counts = batch.column(1).to_numpy()
            if last is not None:
                keys, counts = np.concatenate([last, keys]), np.concatenate([[n], counts])
            first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
            sums = np.add.reduceat(counts, first)
            last, n = keys[first[-1:]].copy(), sums[-1]
            yield made(keys[first[:-1]], sums[:-1])
        if last is not None:
            yield made(last, np.array([n]))

    return dealt.mapInArrow(frugal(count), ", ".join(f"id{k} bigint" for k in range(1, size + 1)) + ", a bigint")


def dictionary(words: DataFrame, salt: int = 0) -> tuple[DataFrame, int]:
    """``words`` with ids of which each is one word's, none 0, and the salt that gives them."""
    while True:
        named = words.withColumn("id", id_column(salt))
        if named.groupBy("id").count().where("count > 1 OR id = 0").isEmpty():
            return named, salt
        salt += 1


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)), with products of up to 38 digits."""
    return F.expr(f"(CAST(1000000 AS DECIMAL(38, 0)) * CAST({a} AS DECIMAL(19, 0)) * CAST({a} AS DECIMAL(19, 0))) DIV (CAST({left} AS DECIMAL(19, 0)) * CAST({right} AS DECIMAL(19, 0)))")


def mine(spark: SparkSession, docs: DataFrame, least: int = 10, best: int = 2000, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Each language's ``best`` phrases of two or three words found ``least`` times or more: lang, rank, phrase, a, l, r, n, score."""
    small_batches(spark)
    source = docs.select(language(lang_col).alias("lang"), text_bytes(text_col).alias("text"))
    counts = keep(spark, word_counts(source), "words")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).withColumnRenamed("lang", "_lang")
    named, salt = dictionary(counts)
    frequent = keep(spark, named.where(F.col("n") >= least), "frequent")
    words = bitmap(frequent, "id")
    pairs = keep(spark, runs(counted_keys(source, 2, salt, words), 2, least), "pairs")
    doubled = bitmap(wrapped(pairs), "mix")
    triples = keep(spark, runs(counted_keys(source, 3, salt, words, doubled), 3, least), "triples")

    def word(k: int) -> DataFrame:
        return frequent.select(F.col("id").alias(f"id{k}"), F.col("word").alias(f"word{k}"), F.col("n").alias(f"n{k}"), *([F.col("lang")] if k == 1 else []))

    two = pairs.join(word(1), "id1").join(word(2), "id2")
    over = triples.select("id1", "id2", "a").unionByName(triples.select(F.col("id2").alias("id1"), F.col("id3").alias("id2"), "a")).groupBy("id1", "id2").agg(F.max("a").alias("longer"))
    free = two.join(over, ["id1", "id2"], "left").where("longer IS NULL OR 100 * longer < 50 * a")
    of_two = free.select("lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", F.col("n1").alias("l"), F.col("n2").alias("r"), score("a", "n1", "n2").alias("score"))
    head = pairs.withColumnsRenamed({"a": "a12"})
    tail = pairs.select(F.col("id1").alias("id2"), F.col("id2").alias("id3"), F.col("a").alias("a23"))
    three = triples.join(head, ["id1", "id2"]).join(tail, ["id2", "id3"]).join(word(1), "id1").join(word(2), "id2").join(word(3), "id3")
    early, late = score("a", "n1", "a23"), score("a", "a12", "n3")
    of_three = three.withColumn("early", early).withColumn("late", late).select(
        "lang",
        F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"),
        "a",
        F.when(F.col("early") <= F.col("late"), F.col("n1")).otherwise(F.col("a12")).alias("l"),
        F.when(F.col("early") <= F.col("late"), F.col("a23")).otherwise(F.col("n3")).alias("r"),
        F.least("early", "late").alias("score"),
    )
    ranked = top(of_two.unionByName(of_three), best)
    out = ranked.join(totals, ranked["lang"] == totals["_lang"])
    return out.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), F.col("score").cast("bigint").alias("score"))


def wrapped(pairs: DataFrame) -> DataFrame:
    """The mixes of pairs, as signed 64-bit numbers that wrap around."""

    def mix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [batch.column(k).to_numpy().view(np.uint64) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(mixed(ids).view(np.int64))], names=["mix"])

    return pairs.select("id1", "id2").mapInArrow(frugal(mix), "mix bigint")


def top(rows: DataFrame, best: int, parts: int = 64) -> DataFrame:
    """The first ``best`` rows of each language. Each language is dealt into parts, whose first rows alone meet in one task."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    local = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("_rank") <= best)
    return local.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= best).drop("_rank")


def sql() -> str:
    """The same rows in SQL."""
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(string_split(translate(coalesce(text, ''), '{UPPER}.,;:!?' || chr(11) || chr(12) || chr(13), '{LOWER}' || repeat(chr(10), 9)), chr(10))) AS p FROM documents)),
words AS (
  SELECT lang, k AS size, w[i : i + k - 1] AS w
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k)),
grams AS MATERIALIZED (SELECT lang, size, array_to_string(w, ' ') AS phrase, count(*) AS a FROM words GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM grams WHERE size = 1 GROUP BY lang),
cand AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS g FROM grams WHERE size > 1 AND a >= 10),
halves AS MATERIALIZED (
  SELECT lang, phrase, a, 1 AS k, g[1] AS head, array_to_string(g[2:], ' ') AS tail FROM cand
  UNION ALL SELECT lang, phrase, a, 2, array_to_string(g[1:2], ' '), g[3] FROM cand WHERE size = 3),
heads AS MATERIALIZED (SELECT h.*, p.a AS l FROM halves h JOIN grams p ON p.lang = h.lang AND p.phrase = h.head),
cuts AS (
  SELECT h.lang, h.phrase, h.a, h.k, h.l, r.a AS r, (1000000::HUGEINT * h.a * h.a) // (h.l::HUGEINT * r.a) AS score
  FROM heads h JOIN grams r ON r.lang = h.lang AND r.phrase = h.tail),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS a
  FROM (SELECT lang, array_to_string(g[1:2], ' ') AS phrase, a FROM cand WHERE size = 3 UNION ALL SELECT lang, array_to_string(g[2:3], ' '), a FROM cand WHERE size = 3)
  GROUP BY lang, phrase)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, s.phrase) AS rank, s.phrase, s.a, s.l, s.r, n.n, score::BIGINT AS score
FROM lowest s JOIN n ON n.lang = s.lang LEFT JOIN longer o ON o.lang = s.lang AND o.phrase = s.phrase
WHERE o.a IS NULL OR 100 * o.a < 50 * s.a
QUALIFY rank <= 2000"""
