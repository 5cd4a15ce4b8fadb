"""Host-level quality rules.

Each document is measured and held to the rules below. Rule failures are added up by host, and the
failure rate of every host is shrunk by a beta prior fitted to all hosts by moments, so that hosts of
few documents keep close to the usual rate. The moments weigh hosts by their documents and leave out the
variance that drawing documents makes by itself. A host fails a rule if its rate lies above the limit with
SURE standard errors of its posterior to spare; the limit is the prior's mean and HIGH of its standard
deviations, but at most MOST. The documents of a failing host are held to the strict rules too; elsewhere
only the base rule rejects.

Edge cases: a null or empty text has no words and so fails the base rule; documents without a host take
part in no host's rates and are held to the base rule alone; an empty table gives no rows; rows that
repeat are judged each; other columns are not carried by ``judge`` and all kept by ``kept_documents``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column_function, keep

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
WHITE, LATER = b" \t\n\x0b\x0c\r", bytes(range(0x80, 0xC0))
SYMBOLS = b"#*$%&|<>"
RULES = ("base", "symbols", "lines", "length")
#: Standard deviations of the prior above its mean, and greatest value, of a rule's limit; standard errors that a host
#: must exceed it by; least and greatest weight of the prior in documents.
HIGH, MOST, SURE, WEIGHTS = 2.0, 0.5, 1.645, (2.0, 10_000.0)
#: Most rows of failing hosts that are broadcast; more are joined by shuffles.
BROADCAST_HOSTS = 100_000


def measure(raw: bytes) -> tuple[int, ...]:
    """The MEASURES of a UTF-8 text."""
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n = len(words)
    repeats = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        often = {w for w, k in Counter(windows).items() if k > 1}
        end = 0
        for i, w in enumerate(windows):
            if w in often:
                repeats += i + 3 - max(i, end)
                end = i + 3
    return n, len(raw.translate(None, WHITE + LATER)), len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeats, len(lines)


KINDS = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])


def measures_of(text: Column) -> Column:
    """A struct of the MEASURES of a whole text. Only the texts go to Python workers, not the rows around them."""

    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            got = [measure(t.as_py() or b"") for t in batch]
            yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in zip(*got)] or [pa.array([], pa.int64())] * len(MEASURES), names=list(MEASURES))

    return column_function(each, KINDS, steady=False)(text.cast("binary"))  # else a filter on it measures twice


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the MEASURES of every whole text in place of columns of those names. One narrow pass."""
    rows = docs.select(*[c for c in docs.columns if c not in MEASURES]).withColumn("_m", measures_of(F.col(text_col)))
    return rows.select(*rows.columns[:-1], *[F.col("_m")[m].alias(m) for m in MEASURES])


def rules() -> dict[str, Column]:
    """Conditions on measured rows under which a document fails a rule."""
    n, chars = F.col("n_words"), F.col("word_chars")
    return {
        "base": (n < 50) | (100 * F.col("n_repeat_words") > 50 * n),
        "symbols": 10 * F.col("n_symbols") > n,
        "lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "length": (chars < 2 * n) | (chars > 12 * n),
    }


def host_verdicts(spark: SparkSession, facts: DataFrame, host_col: str = "source") -> DataFrame:
    """One row per host of measured rows: documents, failures, shrunk rates, and whether a rate exceeds its limit."""
    failed = {r: F.sum(c.cast("long")).alias(f"failed_{r}") for r, c in rules().items()}
    hosts = keep(spark, facts.where(F.col(host_col).isNotNull()).groupBy(host_col).agg(F.count(F.lit(1)).alias("n_docs"), *failed.values()), "hosts")
    n = F.col("n_docs").cast("double")
    sums = [F.count(F.lit(1)).alias("hosts"), F.sum(n).alias("n"), F.sum(n * n).alias("nn")]
    sums += [x for r in RULES for x in (F.sum(f"failed_{r}").alias(f"f_{r}"), F.sum(F.col(f"failed_{r}") * F.col(f"failed_{r}") / n).alias(f"q_{r}"))]
    one = hosts.agg(*sums).first()  # one row, whatever the number of hosts
    bad = F.lit(False)
    for r in RULES:
        mean, weight, limit = prior(one["hosts"], one["n"] or 0.0, one["nn"] or 0.0, one[f"f_{r}"] or 0, one[f"q_{r}"] or 0.0)
        rate = (F.col(f"failed_{r}") + F.lit(mean * weight)) / (n + F.lit(weight))
        hosts = hosts.withColumn(f"rate_{r}", rate)
        bad = bad | (rate - SURE * F.sqrt(rate * (1 - rate) / (n + F.lit(weight + 1))) > F.lit(limit))
    return hosts.withColumn("host_failed", bad)


def prior(hosts: int, n: float, nn: float, failed: int, squares: float) -> tuple[float, float, float]:
    """Mean and weight of a rule's beta prior, and the rule's limit. n, nn: sum of the hosts' documents and of their
    squares; squares: sum of squared failures by documents."""
    if not n:
        return 0.0, WEIGHTS[1], MOST
    mean = failed / n
    spread = n - nn / n
    between = (squares - n * mean * mean - mean * (1 - mean) * (hosts - 1)) / spread if spread > 0 else 0.0
    weight = min(WEIGHTS[1], max(WEIGHTS[0], mean * (1 - mean) / between - 1)) if between > 0 else WEIGHTS[1]
    return mean, weight, min(MOST, mean + HIGH * (mean * (1 - mean) / (weight + 1)) ** 0.5)


def with_verdicts(spark: SparkSession, facts: DataFrame, hosts: DataFrame, host_col: str = "source") -> DataFrame:
    """Measured rows with base_failed, host_failed and kept."""
    failing = hosts.where("host_failed").select(F.col(host_col).alias("_host"))
    if failing.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS:
        failing = F.broadcast(failing)
    rule = rules()
    strict = rule["symbols"] | rule["lines"] | rule["length"]
    return (
        facts.withColumn("base_failed", rule["base"])
        .join(failing, F.col(host_col) == F.col("_host"), "left")
        .withColumn("host_failed", F.col("_host").isNotNull())
        .withColumn("kept", ~F.col("base_failed") & ~(F.col("host_failed") & strict))
        .drop("_host")
    )


def judge(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Per document: id, host, measures, base_failed, host_failed, kept. Texts are read once; only measures are shuffled."""
    facts = keep(spark, measured(docs.select(id_col, host_col, text_col), text_col).drop(text_col), "measures")
    return with_verdicts(spark, facts, host_verdicts(spark, facts, host_col), host_col)


def kept_documents(spark: SparkSession, docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns. Texts are measured twice and never shuffled."""
    hosts = host_verdicts(spark, measured(docs.select(host_col, text_col), text_col).drop(text_col), host_col)
    own = F.struct(*[F.col(c) for c in docs.columns]).alias("_row")  # columns of clashing names stay apart
    rows = docs.select(own, F.col(host_col).alias("_source"), measures_of(F.col(text_col)).alias("_m"))
    rows = rows.select("_row", "_source", *[F.col("_m")[m].alias(m) for m in MEASURES])
    return with_verdicts(spark, rows, hosts.withColumnRenamed(host_col, "_source"), "_source").where("kept").select("_row.*")


def sql() -> str:
    """The rows of ``judge`` (without the host) as DuckDB SQL, over the view ``documents``."""
    sums = ", ".join(f"sum(f_{r}) AS s_{r}, sum(f_{r} * f_{r} / CAST(n AS DOUBLE)) AS q_{r}" for r in RULES)
    means = ", ".join(f"s_{r} / t AS m_{r}" for r in RULES)
    between = ", ".join(f"CASE WHEN t - tt / t > 0 THEN (q_{r} - t * m_{r} * m_{r} - m_{r} * (1 - m_{r}) * (k - 1)) / (t - tt / t) ELSE 0 END AS v_{r}" for r in RULES)
    weights = ", ".join(f"CASE WHEN v_{r} > 0 THEN least({WEIGHTS[1]}, greatest({WEIGHTS[0]}, m_{r} * (1 - m_{r}) / v_{r} - 1)) ELSE {WEIGHTS[1]} END AS w_{r}" for r in RULES)
    limits = ", ".join(f"least({MOST}, m_{r} + {HIGH} * sqrt(m_{r} * (1 - m_{r}) / (w_{r} + 1))) AS l_{r}" for r in RULES)
    rate = {r: f"(f_{r} + m_{r} * w_{r}) / (n + w_{r})" for r in RULES}
    bad = " OR ".join(f"{rate[r]} - {SURE} * sqrt({rate[r]} * (1 - {rate[r]}) / (n + w_{r} + 1)) > l_{r}" for r in RULES)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
lines AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
windows AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS three FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
often AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, three) > 1),
repeats AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM often) GROUP BY rid),
m AS (
  SELECT doc_id, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM w LEFT JOIN lines USING (rid) LEFT JOIN repeats USING (rid)),
f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base, 10 * n_symbols > n_words AS symbols, 10 * n_dup_lines > 3 * n_lines AS lines, word_chars < 2 * n_words OR word_chars > 12 * n_words AS length FROM m),
h AS (SELECT source, count(*) AS n, {", ".join(f"count(*) FILTER ({r}) AS f_{r}" for r in RULES)} FROM f WHERE source IS NOT NULL GROUP BY source),
one AS (
  SELECT *, {limits} FROM (SELECT *, {weights} FROM (SELECT *, {between} FROM (SELECT *, {means} FROM (
    SELECT CAST(count(*) AS DOUBLE) AS k, CAST(sum(n) AS DOUBLE) AS t, sum(CAST(n AS DOUBLE) * n) AS tt, {sums} FROM h))))),
bad AS (SELECT source FROM h, one WHERE {bad})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base AS base_failed, NOT base AND NOT (b.source IS NOT NULL AND (symbols OR lines OR length)) AS kept, b.source IS NOT NULL AS host_failed
FROM f LEFT JOIN bad b ON f.source = b.source
"""
