"""Sources: captured listings, details and attachments, landed files, spreadsheets, id lists, cards of a site.

A harvest lands its raw answers once; everything after that reads the landing with a fixed schema. ``ListingSource``
fetches listings live, one partition per sort order and page range, with a pluggable ``fetch``.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import text as X

#: Schemas of captured answers.
LISTING = "data array<struct<id:string,attributes:struct<title:string,postedDate:string,lastModifiedDate:string,documentType:string,withdrawn:boolean>>>, meta struct<totalElements:bigint>"
DETAIL = "data struct<id:string,attributes:struct<postedDate:string,lastModifiedDate:string,withdrawn:boolean,comment:string>>"
ATTACHMENT = "array<struct<id:string,attributes:struct<title:string,fileFormats:array<struct<format:string,fileUrl:string,size:bigint>>>>>"
ATTACHMENTS = f"doc_id string, data {ATTACHMENT}"
WIDGETS = "doc_id string, page_no int, widget_no int, field_name string, field_value string"
PAGES = "doc_id string, att_no int, page_no int, text string"
ROW = "id string, title string, postedDate string, lastModifiedDate string, documentType string, withdrawn boolean, sort_strategy string, page_number int, pos int"
#: How a card's heading names its file, and its version.
CARD = r"(?iU)Federal\s+(Employment|Accessions|Separations)\s+Raw\s+Data\s*\(([^)]+)\)"
VERSION = r"(?iU)Version:\s*(\d+)"


def flattened(pages: DataFrame, base: str = "https://www.regulations.gov/document") -> DataFrame:
    """Documents of captured listing pages (LISTING with sort_strategy and page_number): one row each, with pos inside the page."""
    rows = pages.select("sort_strategy", "page_number", F.posexplode("data").alias("pos", "d"))
    return rows.select(
        F.col("d.id").alias("documentId"), F.coalesce("d.attributes.title", F.lit("")).alias("title"), F.col("d.attributes.postedDate").alias("postedDate"), F.col("d.attributes.lastModifiedDate").alias("lastModifiedDate"),
        F.col("d.attributes.documentType").alias("documentType"), F.concat(F.lit(f"{base}/"), F.col("d.id")).alias("document_url"), F.coalesce("d.attributes.withdrawn", F.lit(False)).cast("int").alias("Withdrawn"), "sort_strategy", "page_number", "pos",
    )


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Captured listing pages as JSON lines."""
    return spark.read.schema(f"{LISTING}, sort_strategy string, page_number int").json(path)


def details(answers: DataFrame) -> DataFrame:
    """documentId, withdrawn (1, 0 or null where nothing was answered) and comment of captured details."""
    withdrawn = F.when(F.col("data").isNotNull(), F.coalesce("data.attributes.withdrawn", F.lit(False)).cast("int"))
    return answers.select(F.col("data.id").alias("documentId"), F.col("data.attributes.postedDate").alias("Posted Date"), F.col("data.attributes.lastModifiedDate").alias("Last Modified Date"), withdrawn.alias("Withdrawn"), X.breaks_to_newlines(F.coalesce("data.attributes.comment", F.lit(""))).alias("comment"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Ids of a text file: blank lines and lines that begin with # (before stripping) are left out."""
    return ids_of_lines(spark.read.text(path))


def ids_of_lines(lines: DataFrame) -> DataFrame:
    """Ids of lines (value), as ``read_ids`` takes them from a file."""
    return lines.where(~F.col("value").startswith("#")).select(X.strip(F.col("value")).alias("documentId")).where("documentId != ''")


def read_files(spark: SparkSession, folder: str, least: int = 0) -> DataFrame:
    """Landed files with their content, larger than ``least`` bytes; the filter reaches the scan."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).where(F.col("length") > least)


def read_sheet(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """A table from Parquet, CSV or JSON by its ending; ``.xlsx`` through pandas, where openpyxl is installed.

    A sheet that doesn't exist falls back to the first one.
    """
    kind = path.rsplit(".", 1)[-1].lower()
    if kind == "xlsx":
        book = pd.ExcelFile(path)
        return spark.createDataFrame(book.parse(sheet if sheet in book.sheet_names else book.sheet_names[0], dtype=str))
    reader = spark.read.option("header", "true") if kind == "csv" else spark.read
    return getattr(reader, kind if kind in ("csv", "json") else "parquet")(path)


def first_pages(pages: DataFrame, most: int, by: tuple[str, ...] = ("doc_id", "att_no"), joiner: str = "\n") -> DataFrame:
    """Text of the first pages of each file, in page order. A file's pages are few; the cap is the rule's own."""
    wanted = pages.where(F.col("page_no") <= most)
    ordered = F.array_sort(F.collect_list(F.struct("page_no", "text")))
    return wanted.groupBy(*by).agg(F.array_join(F.transform(ordered, lambda p: F.coalesce(p["text"], F.lit(""))), joiner).alias("text"))


def layout_text(blocks):
    """Text of layout blocks (array of lines of spans) in reading order, blank spans left out."""
    spans = F.flatten(F.flatten(F.transform(blocks, lambda b: F.transform(b["lines"], lambda ln: ln["spans"]))))
    return F.array_join(F.filter(F.transform(spans, lambda s: X.strip(s["text"])), lambda t: t != ""), "\n")


def pdf_pages(files: DataFrame, most: int | None = None) -> DataFrame:
    """(path, page_no, text) of PDF files, where a PDF library is installed on the executors."""

    def run(batches: Iterator) -> Iterator:
        import io

        import pandas as pd
        import pdfplumber

        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"]):
                with pdfplumber.open(io.BytesIO(content)) as pdf:
                    rows += [(path, i + 1, p.extract_text() or "") for i, p in enumerate(pdf.pages[:most])]
            yield pd.DataFrame(rows, columns=["path", "page_no", "text"])

    return files.select("path", "content").mapInPandas(run, "path string, page_no int, text string")


def recognised(files: DataFrame, recognise: Callable[[bytes], str]) -> DataFrame:
    """ocr_text of files by a pluggable function from a file's bytes to its text; give only rows that need it."""
    def run(content: pd.Series) -> pd.Series:
        return content.map(recognise)

    return files.withColumn("ocr_text", F.pandas_udf(run, "string")("content"))


def mostly_blank(pixels, least_dark: float = 0.001, least_variance: float = 30.0):
    """Whether an array of gray values has under 0.1 % below 230 or hardly varies."""
    n = F.size(pixels)
    dark = F.size(F.filter(pixels, lambda p: p < 230)) / n
    mean = F.aggregate(pixels, F.lit(0.0), lambda a, p: a + p) / n
    variance = X.let(mean, lambda m: F.aggregate(pixels, F.lit(0.0), lambda a, p: a + (p - m) * (p - m))) / n
    return (dark < least_dark) | (variance < least_variance)


def enhanced(pixels, contrast: float = 2.5):
    """Gray values stretched to 0..255 and then away from their mean."""
    def stretched(ends):
        low, high = ends["low"], ends["high"]
        return F.transform(pixels, lambda p: F.when(high > low, F.floor((p - low) * 255.0 / (high - low))).otherwise(p).cast("double"))

    def contrasted(wide):
        mean = F.floor(F.aggregate(wide, F.lit(0.0), lambda a, p: a + p) / F.size(wide) + 0.5)
        return X.let(mean, lambda m: F.transform(wide, lambda p: F.floor(F.greatest(F.lit(0.0), F.least(F.lit(255.0), m + (p - m) * contrast))).cast("int")))

    ends = F.struct(F.array_min(pixels).alias("low"), F.array_max(pixels).alias("high"))
    return X.let(X.let(ends, stretched), contrasted)


def cards(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Download cards of captured pages: source, dateLabel, version and isCurrent; each card ends where the next begins."""
    text = F.regexp_replace(F.col(html_col), r"(?s)<[^>]*>", " ")
    rows = pages.select(*[c for c in pages.columns if c != html_col], F.posexplode(F.split(text, r"(?iU)(?=Federal\s+(?:Employment|Accessions|Separations)\s+Raw\s+Data\s*\()")).alias("card_no", "card"))
    rows = rows.where(F.col("card").rlike(CARD))
    return rows.select("*", F.regexp_extract("card", CARD, 1).alias("source"), X.strip(F.regexp_extract("card", CARD, 2)).alias("dateLabel"), F.coalesce(X.found(F.col("card"), VERSION), F.lit("1")).alias("version"), F.col("card").contains("Current").alias("isCurrent")).drop("card")


class Unanswered(RuntimeError):
    """A page that couldn't be had after all tries; Spark then tries the task again."""


class Throttle:
    """At least ``delay`` seconds between calls of a partition; calls that fail are tried again after growing waits."""

    def __init__(self, delay: float, tries: int = 5, wait: float = 60.0, sleep: Callable[[float], None] = time.sleep, error_wait: float = 30.0):
        self.delay, self.tries, self.wait, self.sleep, self.last, self.error_wait = delay, tries, wait, sleep, 0.0, error_wait

    def call(self, fetch: Callable[[], tuple[int, dict | None]], absent: tuple[int, ...] = (404,)) -> dict | None:
        """The answer's body; null for the ``absent`` statuses, and where no try was answered. Status 429 waits ``wait``
        times the number of tries, other errors ``error_wait`` times it."""
        for n in range(self.tries):
            self.sleep(max(0.0, self.last + self.delay - time.monotonic()))
            self.last = time.monotonic()
            try:
                status, body = fetch()
            except OSError:
                status, body = 0, None
            if status == 200:
                return body
            if status in absent:
                return None
            self.sleep((self.wait if status == 429 else self.error_wait) * (n + 1))
        return None


def acceptable_pdf(length: Column, content_type: Column, head: Column, least: int = 1000) -> Column:
    """Whether a fetched file counts as a PDF: over ``least`` bytes, its type names pdf or is blank, and it begins like one."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    return (length > least) & ((kind == "") | kind.contains("pdf")) & F.substring(head, 1, 4).eqNullSafe(F.lit(b"%PDF"))


#: Pages that one task reads at most of a listing without a total; if the last one is still full, that is an error.
MOST_PAGES = 1000


class ListingPartition(InputPartition):
    def __init__(self, sort: str, first: int, last: int, until_short: bool = False):
        self.sort, self.first, self.last, self.until_short = sort, first, last, until_short


class ListingReader(DataSourceReader):
    """Pages of one sort order until one is short or ``meta.totalElements`` rows are passed; each (sort, page range) is a task.

    A page without an answer fails its task, which Spark tries again: a listing is complete or an error. ``maxpages`` 0 asks
    the first page of each sort order for the number of rows and reads as many pages as that takes.
    """

    def __init__(self, options: dict, fetch: Callable[[str, int, int], tuple[int, dict | None]]):
        self.sorts = [s for s in options.get("sorts", "documentId").split(",") if s]
        self.size, self.pages, self.step = int(options.get("pagesize", 250)), int(options.get("maxpages", 0)), int(options.get("pagespertask", 20))
        self.delay, self.wait, self.fetch = float(options.get("delay", 1.0)), float(options.get("wait", 60.0)), fetch

    def last_page(self, sort: str) -> int | None:
        """The last page to read of a sort order; null where only a short page will tell."""
        if self.pages:
            return self.pages
        total = (self.page(self.throttle(), sort, 1).get("meta") or {}).get("totalElements")
        return max(1, -(-int(total) // self.size)) if total is not None else None

    def page(self, throttle: Throttle, sort: str, page: int) -> dict:
        body = throttle.call(lambda: self.fetch(sort, page, self.size), ())
        if body is None:
            raise Unanswered(f"page {page} of sort order {sort}")
        return body

    def throttle(self) -> Throttle:
        return Throttle(self.delay, wait=self.wait, error_wait=self.wait / 2)

    def partitions(self) -> list[InputPartition]:
        parts: list[InputPartition] = []
        for s in self.sorts:
            last = self.last_page(s)
            parts += [ListingPartition(s, 1, MOST_PAGES, True)] if last is None else [ListingPartition(s, p, min(last, p + self.step - 1)) for p in range(1, last + 1, self.step)]
        return parts

    def read(self, partition: ListingPartition) -> Iterator[tuple]:
        throttle = self.throttle()
        for page in range(partition.first, partition.last + 1):
            body = self.page(throttle, partition.sort, page)
            rows = body.get("data") or []
            for i, d in enumerate(rows):
                a = d.get("attributes") or {}
                yield d.get("id"), a.get("title"), a.get("postedDate"), a.get("lastModifiedDate"), a.get("documentType"), a.get("withdrawn"), partition.sort, page, i
            total = (body.get("meta") or {}).get("totalElements")
            if len(rows) < self.size or (total is not None and page * self.size >= int(total)):
                return
        if partition.until_short:
            raise Unanswered(f"sort order {partition.sort} goes on after page {partition.last} and tells no total: give maxPages")


def listing_source(fetch: Callable[[str, int, int], tuple[int, dict | None]]) -> type[DataSource]:
    """A data source class named ``listing`` for ``spark.dataSource.register``. fetch: (sort, page, size) to (status, body).

    Options: sorts, pageSize, maxPages (0: as many as there are), pagesPerTask, delay, wait. The key of the service belongs to ``fetch``, from the environment.
    """

    class ListingSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return "listing"

        def schema(self) -> str:
            return ROW

        def reader(self, schema) -> DataSourceReader:
            return ListingReader({k.lower(): v for k, v in self.options.items()}, fetch)

    return ListingSource


def safe_name(doc_id: str) -> str:
    return re.sub(r"[^A-Za-z0-9._-]", "_", doc_id)


def until_empty(pages: DataFrame, most: int = 51, by: str = "folder") -> DataFrame:
    """Captured pages of each category before two in a row hold no card, and ``most`` at the utmost (the site's own safety limit)."""
    from pyspark.sql import Window as W

    # a category has at most a few dozen pages
    order = W.partitionBy(by).orderBy("page_no")
    text = F.regexp_replace("html", r"(?s)<[^>]*>", " ")
    empty = ~F.coalesce(text.rlike(CARD), F.lit(False))
    rows = pages.where(F.col("page_no") <= most).withColumn("_e", empty).withColumn("_stop", F.col("_e") & F.coalesce(F.lag("_e").over(order), F.lit(False)))
    return rows.withColumn("_ended", F.max("_stop").over(order)).where("not _ended").drop("_e", "_stop", "_ended")


def pdf_widgets(files: DataFrame) -> DataFrame:
    """Form widgets (WIDGETS, with the path as doc_id) of PDF files, where PyMuPDF is installed on the executors."""

    def run(batches: Iterator) -> Iterator:
        import fitz
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"]):
                with fitz.open(stream=content, filetype="pdf") as pdf:
                    rows += [(path, p.number + 1, i, w.field_name, None if w.field_value is None else str(w.field_value)) for p in pdf for i, w in enumerate(p.widgets() or ())]
            yield pd.DataFrame(rows, columns=["doc_id", "page_no", "widget_no", "field_name", "field_value"])

    return files.select("path", "content").mapInPandas(run, WIDGETS)
