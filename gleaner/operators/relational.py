"""Relational operators of harvests: union of scans, duplicates, best picks, incremental merges and reports.

Wherever a first or last row counts, the order is an explicit column. Picks are aggregates (``min_by``/``max_by``
of a struct), not windows: they combine before the shuffle, and a key with many rows never lies in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from ..kept import keep
from . import positions


# -- picks ---------------------------------------------------------------------------------------------------

def _whole(df: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def pick(df: DataFrame, keys: list[str], order: Column, last: bool = False) -> DataFrame:
    """One row per key: the smallest by ``order``, or the largest if ``last``."""
    chosen = (F.max_by if last else F.min_by)(_whole(df), order)
    return df.groupBy(*keys).agg(chosen.alias("_row")).select("_row.*")


def first_rows(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return pick(df, keys, F.col(order))


def last_rows(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return pick(df, keys, F.col(order), last=True)


def best_candidate(df: DataFrame, key: str, score: str, pos: str) -> DataFrame:
    """The highest score; the first of equal ones."""
    return pick(df, [key], F.struct(F.col(score), -F.col(pos)), last=True)


def ranked(df: DataFrame, key: str, score: str, pos: str) -> DataFrame:
    """All candidates with their rank from 0, by score and then place. Keys hold a document's few attachments."""
    return df.withColumn("rank", F.row_number().over(W.partitionBy(key).orderBy(F.desc(score), F.asc(pos))) - 1)


def repick(df: DataFrame, key: str, rank: str, filled: str, enough: int = 5) -> DataFrame:
    """The first candidate with ``enough`` filled fields by rank; without one, the one with most, the first of equals."""
    done = F.col(filled) >= enough
    return pick(df, [key], F.struct(~done, F.when(done, 0).otherwise(-F.col(filled)), F.col(rank)))


def next_acceptable(df: DataFrame, key: str, rank: str, score: str, wrong: str, least: int = 8) -> DataFrame:
    """One row per key: the first candidate of the right type with enough score, or null columns if there is none."""
    good = F.when((F.col(score) >= least) & ~F.col(wrong), F.col(rank))
    return df.groupBy(key).agg(F.min_by(F.struct(*[c for c in df.columns if c != key]), good).alias("_row")).select(key, "_row.*")


def rescued(df: DataFrame, key: str, rank: str, rescue: str) -> DataFrame:
    """The first candidate by rank that has a rescue score."""
    return pick(df.where(F.col(rescue).isNotNull()), [key], F.col(rank))


# -- scans and duplicates --------------------------------------------------------------------------------------

def union_scans(scans: list[DataFrame], key: str, pos: str = "pos") -> DataFrame:
    """Scans, each with a place column, united by key with strategy (from 1) and first_seen.

    Between scans the first wins; inside the first scan the last row wins, inside others the first. first_seen is the
    place of the key's first row in its scan: ordering by (strategy, first_seen) gives the order of discovery.
    """
    every = reduce(DataFrame.unionByName, [s.withColumn("strategy", F.lit(i + 1)) for i, s in enumerate(scans)])
    inside = F.when(F.col("strategy") == 1, -F.col(pos)).otherwise(F.col(pos))
    seen = F.min(F.struct("strategy", pos)).alias("_seen")
    out = every.groupBy(key).agg(F.min_by(_whole(every), F.struct("strategy", inside)).alias("_row"), seen)
    return out.select("_row.*", F.col("_seen")[pos].alias("first_seen"))


def found_per_strategy(united: DataFrame, names: list[str]) -> DataFrame:
    """New documents of each scan and the running total; scans that found nothing new count 0."""
    listed = united.sparkSession.createDataFrame([(i + 1, n) for i, n in enumerate(names)], "strategy int, name string")
    counts = listed.join(united.groupBy("strategy").agg(F.count(F.lit(1)).alias("n")), "strategy", "left").withColumn("new", F.coalesce("n", F.lit(0)))
    # a row per scan, a handful: one partition is right here
    return counts.select("strategy", "name", "new", F.sum("new").over(W.orderBy("strategy").rowsBetween(W.unboundedPreceding, 0)).alias("total"))


def url_distinct(df: DataFrame, key: str = "doc_id", url: str = "url", pos: str = "pos") -> DataFrame:
    return first_rows(df, [key, url], pos)


# -- incremental merges ------------------------------------------------------------------------------------------

def not_done(docs: DataFrame, existing: DataFrame, key: str, method: str = "extraction_method", word: str = "Form Fields") -> DataFrame:
    """Documents that the existing results don't hold as done."""
    return docs.join(done_rows(existing, method, word).select(key).distinct(), key, "left_anti")


def done_rows(existing: DataFrame, method: str = "extraction_method", word: str = "Form Fields") -> DataFrame:
    """Existing rows whose method contains the word; a missing method doesn't."""
    return existing.where(F.coalesce(F.col(method).contains(word), F.lit(False)))


def keep_existing(existing: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return existing.join(ids.select(key).distinct(), key, "left_semi")


def merge_with_default(ids: DataFrame, results: DataFrame, key: str, defaults: dict) -> DataFrame:
    """Every id in the list, with its result or else the defaults. Results hold one row per id (``last_rows``, if they repeat)."""
    marked = results.withColumn("_there", F.lit(True))
    out = ids.join(marked, key, "left")
    return out.withColumns({c: F.when(F.col("_there").isNull(), F.lit(v)).otherwise(F.col(c)) for c, v in defaults.items()}).drop("_there")


def merge_present(ids: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Ids of the list that have a result; the others are dropped."""
    return ids.join(results, key)


def overlay(results: DataFrame, existing: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Existing values that aren't blank win over new ones."""
    old = existing.select(key, *[F.col(c).alias(f"_old_{c}") for c in columns])
    out = results.join(old, key, "left")
    value = lambda c: F.when(X.strip(F.col(f"_old_{c}").cast("string")) != "", F.col(f"_old_{c}"))
    return out.withColumns({c: F.coalesce(value(c), F.col(c)) for c in columns}).select(*results.columns)


def cache_lookup(ids: DataFrame, cache: DataFrame, key: str, value: str, retry_null: bool = False) -> DataFrame:
    """Ids with their cached value and ``cached``: whether the cache has the id, even with a null value (unless ``retry_null``)."""
    held = cache.where(F.col(value).isNotNull()) if retry_null else cache
    return ids.join(held.select(key, value, F.lit(True).alias("_there")), key, "left").select(*ids.columns, value, F.coalesce("_there", F.lit(False)).alias("cached"))


def missing_files(cards: DataFrame, files: DataFrame, name: str = "file_name") -> DataFrame:
    """Cards whose file isn't there; a card without a name is never skipped."""
    return cards.join(files.select(name).distinct(), name, "left_anti")


# -- projections -------------------------------------------------------------------------------------------------

def add_by_key(df: DataFrame, values: DataFrame, key: str) -> DataFrame:
    return df.join(values, key, "left")


def drop_date_columns(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.drop(*[c for c in df.columns if "date" in c.lower() and c not in keep])


def move_last(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in columns], *[c for c in columns if c in df.columns])


def listed_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """The listed columns that exist, in the list's order."""
    return df.select(*[c for c in columns if c in df.columns])


def pass_through(results: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Results with the source's other columns; where both have one, the result's stays."""
    return results.join(source.select(key, *[c for c in source.columns if c not in results.columns]), key, "left")


def id_column(df: DataFrame) -> str:
    return "documentId" if "documentId" in df.columns else "Document_ID"


#: A range that ends by this row is taken from the few first rows of each task, in one place; a later one by positions.
FEW_ROWS = 1_000


def row_range(df: DataFrame, order: list[Column], first: int, last: int) -> DataFrame:
    """Rows first to last, from 1 and inclusive, by an explicit order.

    Beyond ``FEW_ROWS`` the rows are sorted into ranges over the cluster, kept, and only the ranges that hold some of them
    are read on, so that no place holds all rows before ``last``.
    """
    if last <= FEW_ROWS:
        return df.orderBy(*order).offset(first - 1).limit(max(0, last - first + 1))
    return positions.between(df.sparkSession, df, first, last, *order)


def in_order(df: DataFrame, *order: Column) -> DataFrame:
    """The rows in their final order, sorted by ranges over the cluster."""
    return df.orderBy(*order)


def sample(df: DataFrame, n: int = 10) -> DataFrame:
    """The first rows of an ordered table with their place from 1; only so many are numbered."""
    few = df.limit(n).withColumn("_place", F.monotonically_increasing_id())
    return few.withColumn("place", F.row_number().over(W.orderBy("_place"))).drop("_place")


def withdrawn_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns of withdrawn documents."""
    return df.where(F.col("Withdrawn") == 1).select(*columns)


def contains_word(c: Column, word: str) -> Column:
    return F.coalesce(c.contains(word), F.lit(False))


def reply_any_case(title: Column) -> Column:
    """Titles that begin with re_, white space and case aside."""
    return F.coalesce(F.lower(X.strip(title)).startswith("re_"), F.lit(False))


def reply_prefix(title: Column) -> Column:
    return F.coalesce(title.startswith("Re_"), F.lit(False))


def reply_inside(title: Column) -> Column:
    return F.coalesce(title.contains("Re_"), F.lit(False))


# -- attachments -------------------------------------------------------------------------------------------------

def attachments(docs: DataFrame, key: str = "doc_id", column: str = "attachments") -> DataFrame:
    """One row per attachment: key, pos, id, title, fileFormats."""
    rows = docs.select(key, F.posexplode(column).alias("p", "a"))
    return rows.select(key, (F.col("p") + 1).alias("pos"), F.col("a.id").alias("attachment_id"), F.coalesce("a.attributes.title", F.lit("")).alias("title"), F.col("a.attributes.fileFormats").alias("formats"))


def pdf_urls(rows: DataFrame) -> DataFrame:
    """The first pdf format with a url of each attachment: url and size."""
    pdf = F.get(F.filter("formats", lambda f: (f["format"] == "pdf") & (F.coalesce(f["fileUrl"], F.lit("")) != "")), F.lit(0))
    return rows.withColumns({"url": pdf["fileUrl"], "size": pdf["size"]}).where("url is not null").drop("formats")


def large_enough(rows: DataFrame, least: int = 5000) -> DataFrame:
    """No reply letters (by prefix) and no files of ``least`` bytes or fewer."""
    return rows.where(~reply_prefix(F.col("title")) & (F.coalesce("size", F.lit(0)) > least))


def first_reply(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """The first attachment whose title contains Re_ and that has formats: the url of its first format of any kind."""
    return first_rows(rows.where(reply_inside(F.col("title")) & (F.size("formats") > 0)), [key], "pos").select(key, F.get("formats", F.lit(0))["fileUrl"].alias("url"))


def with_guessed_urls(urls: DataFrame, docs: DataFrame, base: str, lenient: bool, key: str = "doc_id") -> DataFrame:
    """Found pdf urls (key, pos, title, url) and guessed ones, distinct by document.

    docs: key, api_error, titles (array). Strict: guesses only where the listing succeeded and no pdf is other than a reply
    letter. Lenient: guesses unless all titles that aren't blank are reply letters.
    """
    if lenient:
        titles = F.filter(F.coalesce("titles", F.array().cast("array<string>")), lambda t: F.coalesce(t != "", F.lit(False)))
        wanted = docs.where(~((F.size(titles) > 0) & F.forall(titles, reply_any_case)))
    else:
        wanted = docs.where("api_error is null").join(urls.where(~reply_any_case(F.col("title"))).select(key).distinct(), key, "left_anti")
    numbers = wanted.select(key, F.explode(F.sequence(F.lit(1), F.lit(9))).alias("n"))
    guessed = numbers.select(key, (F.lit(1000) + F.col("n")).alias("pos"), F.lit("").alias("title"), F.concat(F.lit(f"{base}/"), F.col(key).cast("string"), F.format_string("/attachment_%d.pdf", "n")).alias("url"))
    return url_distinct(urls.select(key, "pos", "title", "url").unionByName(guessed), key)


# -- reports -----------------------------------------------------------------------------------------------------

def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Counts of values that aren't null, most first, then by value."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), column)


def breakdown(df: DataFrame, column: str) -> DataFrame:
    """Counts of values that aren't null, with their percentage of all rows to one place, half to even."""
    # kept, since counts and total would each read the input; the total is a scalar subquery, so that values never meet in one task
    counts = keep(df.sparkSession, df.groupBy(column).agg(F.count(F.lit(1)).alias("n")), "counts")
    every = counts.agg(F.sum("n")).scalar()
    return counts.select(column, "n", F.bround(F.col("n") / every * 100, 1).alias("percentage")).where(F.col(column).isNotNull())


def metrics(df: DataFrame, **columns: Column) -> DataFrame:
    """(metric, value) rows of aggregates, in one pass."""
    one = df.agg(*[c.cast("double").alias(n) for n, c in columns.items()])
    return one.select(F.stack(F.lit(len(columns)), *[x for n in columns for x in (F.lit(n), F.col(n))]).alias("metric", "value"))


def count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def fill_v1(method: Column) -> Column:
    return F.when(contains_word(method, "Scanned"), "FFE6E6")


def fill_withdrawn_cell(withdrawn: Column) -> Column:
    return F.when(withdrawn == 1, "FF0000")


def fill_v2(status: Column, withdrawn: Column) -> Column:
    return F.when(withdrawn == 1, "FFFF00").when(status == "Low", "FFCCCB").when(status == "pdf not present", "E8E8E8").when(status == "new pattern", "FFA500")


def fill_sibling(status: Column, withdrawn: Column) -> Column:
    return F.when(withdrawn == 1, "FFFF00").when(X.strip(status) == "Scanned", "FFCCCB").when(X.strip(status).isin("pdf not present", "API error"), "E8E8E8")


def date_counts(df: DataFrame, column: str) -> DataFrame:
    """How many rows there are, with a date and without one."""
    has = F.coalesce(F.col(column) != "", F.lit(False))
    return metrics(df, total=F.count(F.lit(1)), found=count_where(has), missing=count_where(~has))


def run_totals(judged: DataFrame) -> DataFrame:
    """What a run has processed (is_form, msg), the forms among it, and what the exclusions took."""
    return metrics(judged, processed=F.count(F.lit(1)), forms_found=count_where(F.col("is_form")), excluded=count_where(F.col("msg").contains("EXCLUDED")))
