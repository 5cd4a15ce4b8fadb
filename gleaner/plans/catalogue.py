"""Named queries over the driver's tables, and the SQL that gives the same rows.

The tables hold no filings, so inputs are made from their columns by plain SQL that both engines read alike
(``BASES``); the operators then run on those inputs. Every query reads whole tables; where the feature needs ids or texts of
several kinds, an input's rows are told apart by remainders of their keys, as its SQL says.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes as K
from ..functions import text as X
from ..functions import titles as T
from ..operators import classify as C
from ..operators import extract as E
from ..operators import relational as R
from ..sources import landing as L

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations", "clicks", "sales", "sale_lines", "clients", "client_changes", "vendors", "items", "stamps")
DECISIONS = ("Exclusion Denied", "EXCLUSION GRANTED", "exclusion approved", "Exclusion Partially Approved", "Exclusion Partially Granted", "Exclusion Request Withdrawn", "Denied", "Approved", "granted", "Pending Review")


def cases(value: str, options, otherwise: str = "NULL") -> str:
    """A CASE over the numbers 0, 1, ... of a value."""
    quoted = [("NULL" if o is None else "'" + o.replace("'", "''") + "'") for o in options]
    return f"CASE {value} " + " ".join(f"WHEN {i} THEN {o}" for i, o in enumerate(quoted)) + f" ELSE {otherwise} END"


#: A place that no two rows of an order share.
PLACE = "CAST(l_linenumber AS BIGINT) * 1000000000000 + l_partkey * 100000 + l_suppkey"
#: Inputs, in SQL that Spark and DuckDB read alike.
BASES = {
    "titles": f"""SELECT l_orderkey AS doc, l_linenumber AS pos, {cases("(l_orderkey + l_linenumber) % 10", DECISIONS)} || ', ' || c_name || ', ' || p_name || ', HTSUS ' || lpad(CAST(p_partkey AS STRING), 10, '1') AS title
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey""",
    "candidates": f"SELECT l_orderkey AS doc, {PLACE} AS pos, CAST(l_quantity AS INT) % 12 AS score, CAST(l_partkey % 8 AS INT) AS filled, l_suppkey % 3 = 0 AS wrong FROM lineitem",
    "results": f"""SELECT o_orderkey AS doc, {cases("o_orderkey % 4", ("Form Fields", "Scanned (OCR)", "Text", None))} AS extraction_method,
        {cases("o_orderkey % 5", ("Success", "Low", "pdf not present", "new pattern", "Error"))} AS status, CAST(o_orderkey % 19 AS INT) AS filled,
        CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 < 3 THEN 1 ELSE 0 END AS withdrawn, CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE o_orderpriority END AS note FROM orders WHERE o_orderkey % 3 <> 0""",
    "existing": f"""SELECT o_orderkey AS doc, {cases("o_orderkey % 3", ("Form Fields", "Text", None))} AS extraction_method, CASE WHEN o_orderkey % 4 = 0 THEN '  ' WHEN o_orderkey % 4 = 1 THEN NULL ELSE o_orderstatus END AS note FROM orders WHERE o_orderkey % 2 = 0""",
    "ids": "SELECT o_orderkey AS doc FROM orders",
    "files": f"SELECT l_orderkey AS doc, {PLACE} AS pos, CASE WHEN l_linenumber % 3 = 1 THEN 'Re_' || l_returnflag WHEN l_linenumber % 3 = 2 THEN ' re_' || l_returnflag ELSE 'Form ' || l_linestatus END AS title, 'u' || CAST(l_suppkey % 4 AS STRING) AS url FROM lineitem",
}


def tables(text: str) -> list[str]:
    return [t for t in TABLES if re.search(rf"\b{t}\b", text)]


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of BASES as a frame."""
    text = BASES[name]
    for t in tables(text):
        text = re.sub(rf"(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in tables(BASES[name])})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over all cores. Costly rows of a small file would else be the work of a task or two: Spark cuts files by bytes."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism))


QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, *bases: str):
    """Register a function as a query, with its SQL, in which BASES can be read by their names."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            given = ", ".join(f"{b} AS ({BASES[b]})" for b in bases)
            SQL[f.__name__] = sql if not bases else f"WITH {given}, {sql[5:]}" if sql.startswith("WITH ") else f"WITH {given} {sql}"
        return f

    return register


# -- titles ---------------------------------------------------------------------------------------------------

DECISION_RE = "(?i)^(?:" + "|".join(T.DECISIONS) + ")"
DECISION_SQL = f"nullif(regexp_extract(title, '{DECISION_RE}'), '')"
#: initcap, word by word
INITCAP = "array_to_string(list_transform(string_split({0}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"
NORMAL_SQL = f"""CASE WHEN d IS NULL THEN NULL WHEN contains(d, 'withdrawn') THEN 'Withdrawn' WHEN contains(d, 'denied') THEN 'Denied'
  WHEN contains(d, 'partially') THEN 'Partially Approved' ELSE 'Approved' END"""


@query(f"""SELECT doc, pos, {INITCAP.format(DECISION_SQL)} AS decision,
  CASE WHEN {DECISION_SQL} IS NOT NULL THEN trim(string_split(title, ',')[2]) ELSE trim(string_split(title, ',')[1]) END AS requester,
  nullif(trim(regexp_replace(array_to_string(list_transform(string_split(title, ',')[CASE WHEN {DECISION_SQL} IS NOT NULL THEN 3 ELSE 2 END:], lambda x: trim(x)), ', '), '(?i),?\\s*HTS(?:US)?\\s*[0-9]{{8,10}}\\s*$', '')), '') AS material,
  nullif(regexp_extract(title, '(?i)\\bHTS(?:US)?\\s*([0-9]{{8,10}})\\b', 1), '') AS hts FROM titles""", "titles")
def title_parse(spark, sf_dir):
    """Titles cut into decision, requester, material and code."""
    return base(spark, sf_dir, "titles").withColumn("t", T.parse_title(F.col("title"))).select("doc", "pos", "t.*")


@query(f"SELECT doc, pos, {NORMAL_SQL} AS decision FROM (SELECT doc, pos, lower({DECISION_SQL}) AS d FROM titles)", "titles")
def decision_normalize(spark, sf_dir):
    """Decisions by their kind."""
    return base(spark, sf_dir, "titles").select("doc", "pos", T.normalize_decision(T.decision_of(F.col("title"))).alias("decision"))


@query(f"""SELECT decision, count(*) AS n, round_even(count(*) / (SELECT count(*) FROM titles) * 100, 1) AS percentage
  FROM (SELECT {NORMAL_SQL} AS decision FROM (SELECT lower({DECISION_SQL}) AS d FROM titles)) WHERE decision IS NOT NULL GROUP BY decision""", "titles")
def decision_breakdown(spark, sf_dir):
    """Decisions with their share of all documents."""
    return R.breakdown(base(spark, sf_dir, "titles").select(T.normalize_decision(T.decision_of(F.col("title"))).alias("decision")), "decision")


# -- scans ------------------------------------------------------------------------------------------------------

SORTS = (("newest", "o_orderdate DESC, o_orderkey", 3), ("oldest", "o_orderdate, o_orderkey", 4), ("dearest", "o_totalprice DESC, o_orderkey", 5), ("cheapest", "o_totalprice, o_orderkey", 2))


def scans(spark, sf_dir):
    """A scan per sort order that misses a part of all documents, and sees some in two places."""
    orders = table(spark, sf_dir, "orders")
    return [orders.where(F.col("o_orderkey") % (cut + 2) != 0).select("o_orderkey", (F.col("o_custkey") * 100 + F.col("o_orderkey") % 97).alias("pos"), F.lit(name).alias("sort_strategy")).unionByName(orders.where(F.col("o_orderkey") % (cut + 4) == 0).select("o_orderkey", (F.col("o_custkey") * 100 + F.col("o_orderkey") % 97 + 50).alias("pos"), F.lit(name).alias("sort_strategy"))) for name, _, cut in SORTS]


SCANS_SQL = " UNION ALL ".join(
    f"SELECT {i + 1} AS strategy, '{name}' AS sort_strategy, o_orderkey, o_custkey * 100 + o_orderkey % 97 AS pos FROM orders WHERE o_orderkey % {cut + 2} <> 0 UNION ALL SELECT {i + 1}, '{name}', o_orderkey, o_custkey * 100 + o_orderkey % 97 + 50 FROM orders WHERE o_orderkey % {cut + 4} = 0"
    for i, (name, _, cut) in enumerate(SORTS)
)
UNITED_SQL = f"""scans AS ({SCANS_SQL}), united AS (SELECT *, first_value(pos) OVER (PARTITION BY o_orderkey ORDER BY strategy, pos) AS first_seen FROM scans
  QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY strategy, CASE WHEN strategy = 1 THEN -pos ELSE pos END) = 1)"""


@query(f"WITH {UNITED_SQL} SELECT o_orderkey, pos, sort_strategy, strategy, first_seen FROM united")
def multi_sort_union_dedupe(spark, sf_dir):
    """Scans under several sort orders, united by document."""
    return R.union_scans(scans(spark, sf_dir), "o_orderkey")


@query(f"WITH {UNITED_SQL} SELECT sort_strategy, count(*) AS n FROM united GROUP BY 1")
def strategy_breakdown(spark, sf_dir):
    """Documents by the scan that found them."""
    return R.value_counts(R.union_scans(scans(spark, sf_dir), "o_orderkey"), "sort_strategy")


@query(f"""WITH {UNITED_SQL}, names AS (SELECT * FROM (VALUES {", ".join(f"({i + 1}, '{n}')" for i, (n, _, _) in enumerate(SORTS))}) t(strategy, name)),
  c AS (SELECT strategy, name, count(o_orderkey) AS new FROM names LEFT JOIN united USING (strategy) GROUP BY ALL)
  SELECT strategy, name, new, CAST(sum(new) OVER (ORDER BY strategy) AS BIGINT) AS total FROM c""")
def running_new_docs(spark, sf_dir):
    """New documents of each scan, and the running total."""
    return R.found_per_strategy(R.union_scans(scans(spark, sf_dir), "o_orderkey"), [n for n, _, _ in SORTS])


# -- picks ------------------------------------------------------------------------------------------------------

TOP = "FROM candidates QUALIFY row_number() OVER (PARTITION BY doc ORDER BY {0}) = 1"


@query("SELECT * " + TOP.format("score DESC, pos"), "candidates")
def best_candidate(spark, sf_dir):
    """The best-scored candidate, the first of equal ones."""
    return R.best_candidate(base(spark, sf_dir, "candidates"), "doc", "score", "pos")


@query("SELECT *, CAST(row_number() OVER (PARTITION BY doc ORDER BY score DESC, pos) - 1 AS INT) AS rank FROM candidates", "candidates")
def candidate_rank(spark, sf_dir):
    """All candidates, ranked."""
    return R.ranked(base(spark, sf_dir, "candidates"), "doc", "score", "pos")


@query("SELECT * " + TOP.format("filled >= 5 DESC, CASE WHEN filled >= 5 THEN 0 ELSE -filled END, pos"), "candidates")
def repick_by_filled(spark, sf_dir):
    """The first candidate with five filled fields, or the fullest."""
    return R.repick(base(spark, sf_dir, "candidates"), "doc", "pos", "filled")


@query("""SELECT i.doc, pos, score, filled, wrong FROM (SELECT DISTINCT doc FROM candidates) i
  LEFT JOIN (SELECT * FROM candidates WHERE score >= 8 AND NOT wrong QUALIFY row_number() OVER (PARTITION BY doc ORDER BY pos) = 1) c USING (doc)""", "candidates")
def next_acceptable(spark, sf_dir):
    """The first acceptable candidate, or none."""
    return R.next_acceptable(base(spark, sf_dir, "candidates"), "doc", "pos", "score", "wrong")


@query("SELECT * " + TOP.format("pos").replace("FROM candidates", "FROM (SELECT * FROM candidates WHERE filled > 4)"), "candidates")
def rescued_candidate(spark, sf_dir):
    """The first candidate that a rescue score accepts."""
    return R.rescued(base(spark, sf_dir, "candidates").withColumn("r", F.when(F.col("filled") > 4, F.col("filled"))), "doc", "pos", "r").drop("r")


@query("SELECT doc, url, pos, title FROM files QUALIFY row_number() OVER (PARTITION BY doc, url ORDER BY pos) = 1", "files")
def url_distinct(spark, sf_dir):
    """Urls once per document."""
    return R.url_distinct(base(spark, sf_dir, "files"), "doc")


@query("SELECT doc, pos, title, url FROM files QUALIFY row_number() OVER (PARTITION BY doc ORDER BY pos) = 1", "files")
def first_duplicate(spark, sf_dir):
    """The first row of each id."""
    return R.first_rows(base(spark, sf_dir, "files"), ["doc"], "pos")


@query("SELECT doc, pos, title, url FROM files QUALIFY row_number() OVER (PARTITION BY doc ORDER BY pos DESC) = 1", "files")
def last_duplicate(spark, sf_dir):
    """The last row of each id."""
    return R.last_rows(base(spark, sf_dir, "files"), ["doc"], "pos")


# -- incremental merges -------------------------------------------------------------------------------------------

@query("SELECT doc FROM ids WHERE doc NOT IN (SELECT doc FROM existing WHERE contains(extraction_method, 'Form Fields'))", "ids", "existing")
def skip_done_anti(spark, sf_dir):
    """Ids that aren't done yet."""
    return R.not_done(base(spark, sf_dir, "ids"), base(spark, sf_dir, "existing"), "doc")


@query("SELECT doc, extraction_method, note FROM existing WHERE doc IN (SELECT doc FROM ids WHERE doc % 5 <> 0)", "ids", "existing")
def keep_existing_semi(spark, sf_dir):
    """Existing rows of listed ids."""
    return R.keep_existing(base(spark, sf_dir, "existing"), base(spark, sf_dir, "ids").where("doc % 5 != 0"), "doc")


@query("SELECT i.doc, CASE WHEN r.doc IS NULL THEN '' ELSE extraction_method END AS extraction_method, CASE WHEN r.doc IS NULL THEN 'pdf not present' ELSE status END AS status, CASE WHEN r.doc IS NULL THEN 0 ELSE filled END AS filled, withdrawn, note FROM ids i LEFT JOIN results r ON i.doc = r.doc", "ids", "results")
def merge_default(spark, sf_dir):
    """Results for every id, defaults where there is none."""
    return R.merge_with_default(base(spark, sf_dir, "ids"), base(spark, sf_dir, "results"), "doc", {"extraction_method": "", "status": "pdf not present", "filled": 0})


@query("SELECT doc, extraction_method, status, filled, withdrawn, note FROM ids JOIN results USING (doc)", "ids", "results")
def merge_present(spark, sf_dir):
    """Results of listed ids; ids without one are dropped."""
    return R.merge_present(base(spark, sf_dir, "ids"), base(spark, sf_dir, "results"), "doc")


@query("SELECT r.doc, r.status, CASE WHEN trim(e.note) <> '' THEN e.note ELSE r.note END AS note FROM results r LEFT JOIN existing e ON r.doc = e.doc", "results", "existing")
def overlay_coalesce(spark, sf_dir):
    """Existing values over new ones."""
    return R.overlay(base(spark, sf_dir, "results").select("doc", "status", "note"), base(spark, sf_dir, "existing"), "doc", ["note"])


@query("SELECT i.doc, r.withdrawn, r.doc IS NOT NULL AS cached FROM ids i LEFT JOIN results r ON i.doc = r.doc", "ids", "results")
def cache_lookup(spark, sf_dir):
    """What the progress table knows; a cached null counts as known."""
    return R.cache_lookup(base(spark, sf_dir, "ids"), base(spark, sf_dir, "results"), "doc", "withdrawn")


MONTHS_SQL = cases("p_partkey % 13", (*[m.title() for m in K.MONTHS], "Foo"))
FILE_SQL = f"""SELECT p_partkey, CASE WHEN m <> 13 THEN {cases("p_partkey % 3", ("employment", "accessions", "separations"))} || '_' || CAST(2000 + p_size AS STRING) || lpad(CAST(m AS STRING), 2, '0') || '_' || CAST(p_size % 3 AS STRING) || '.txt' END AS file_name
  FROM (SELECT *, p_partkey % 13 + 1 AS m FROM part)"""


def _file_cards(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", K.file_name(F.expr(cases("p_partkey % 3", ("Employment", "Accessions", "Separations"))), F.concat(F.expr(MONTHS_SQL), F.lit(" "), (2000 + F.col("p_size")).cast("string")), (F.col("p_size") % 3).cast("string")).alias("file_name"))


@query(FILE_SQL)
def filename_build(spark, sf_dir):
    """File names of labels; unknown months have none."""
    return _file_cards(spark, sf_dir)


@query(f"WITH f AS ({FILE_SQL}) SELECT file_name, p_partkey FROM f WHERE file_name IS NULL OR file_name NOT IN (SELECT file_name FROM f WHERE p_partkey % 2 = 0 AND file_name IS NOT NULL)")
def missing_files(spark, sf_dir):
    """Cards whose file isn't there; those without a name stay."""
    f = _file_cards(spark, sf_dir)
    return R.missing_files(f, f.where("p_partkey % 2 = 0"))


# -- attachments ---------------------------------------------------------------------------------------------------

GUESS = "SELECT {0}, 1000 + n AS pos, '' AS title, 'b/' || CAST({0} AS STRING) || '/attachment_' || CAST(n AS STRING) || '.pdf' AS url FROM wanted, range(1, 10) r(n)"


@query("""SELECT doc, pos, title, url FROM (SELECT * FROM files WHERE doc % 2 = 0 QUALIFY row_number() OVER (PARTITION BY doc, url ORDER BY pos) = 1) UNION ALL
  SELECT * FROM (WITH wanted AS (SELECT doc FROM ids WHERE doc % 11 <> 0 AND doc NOT IN (SELECT doc FROM files WHERE doc % 2 = 0 AND NOT starts_with(lower(trim(title)), 're_'))) """ + GUESS.format("doc") + ")", "ids", "files")
def fallback_urls_strict(spark, sf_dir):
    """Found urls and guessed ones where the listing succeeded but gave reply letters only."""
    docs = base(spark, sf_dir, "ids").withColumn("api_error", F.when(F.col("doc") % 11 == 0, "API error 500"))
    return R.with_guessed_urls(base(spark, sf_dir, "files").where("doc % 2 = 0"), docs, "b", False, "doc")


@query("""SELECT doc, pos, title, url FROM (SELECT * FROM files WHERE doc % 2 = 0 QUALIFY row_number() OVER (PARTITION BY doc, url ORDER BY pos) = 1) UNION ALL
  SELECT * FROM (WITH wanted AS (SELECT i.doc FROM ids i LEFT JOIN files f ON i.doc = f.doc AND i.doc % 2 = 0 GROUP BY i.doc HAVING count(f.doc) = 0 OR NOT bool_and(starts_with(lower(trim(title)), 're_'))) """ + GUESS.format("doc") + ")", "ids", "files")
def fallback_urls_lenient(spark, sf_dir):
    """Found urls and guessed ones unless all titles are reply letters."""
    files = base(spark, sf_dir, "files").where("doc % 2 = 0")
    docs = base(spark, sf_dir, "ids").join(files.groupBy("doc").agg(F.collect_list("title").alias("titles")), "doc", "left")
    return R.with_guessed_urls(files, docs, "b", True, "doc")


@query("""SELECT conv_id AS doc_id, turn AS pos, role AS title, 'f' || CAST(turn AS STRING) || '.pdf' AS url, CAST(length(text) AS BIGINT) AS size FROM conversations WHERE turn % 3 <> 0 AND length(text) > 100""")
def attachments_explode(spark, sf_dir):
    """Conversations as attachment lists: the first pdf of each, large ones only. A conversation's turns are few."""
    turns = table(spark, sf_dir, "conversations")
    pdf = F.struct(F.lit("pdf").alias("format"), F.concat(F.lit("f"), F.col("turn").cast("string"), F.lit(".pdf")).alias("fileUrl"), F.length("text").cast("bigint").alias("size"))
    doc = F.struct(F.lit("docx").alias("format"), F.lit("x").alias("fileUrl"), F.lit(0).cast("bigint").alias("size"))
    formats = F.when(F.col("turn") % 3 != 0, F.array(doc, pdf)).otherwise(F.array(doc))
    item = F.struct(F.col("turn").cast("string").alias("id"), F.struct(F.col("role").alias("title"), formats.alias("fileFormats")).alias("attributes"))
    docs = turns.groupBy(F.col("conv_id").alias("doc_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", item.alias("item")))), lambda x: x["item"]).alias("attachments"))
    rows = R.large_enough(R.pdf_urls(R.attachments(docs)), 100)
    return rows.select("doc_id", F.col("attachment_id").cast("int").alias("pos"), "title", "url", "size")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, sf_dir):
    """Properties of events by a fixed schema."""
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("SELECT doc, url FROM (SELECT doc, pos, url FROM files WHERE contains(title, 'Re_')) QUALIFY row_number() OVER (PARTITION BY doc ORDER BY pos) = 1", "files")
def first_reply(spark, sf_dir):
    """The first reply letter of each document."""
    rows = base(spark, sf_dir, "files").withColumn("formats", F.array(F.struct(F.lit("pdf").alias("format"), F.col("url").alias("fileUrl"))))
    return R.first_reply(rows, "doc")


# -- projections -----------------------------------------------------------------------------------------------------

@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 500 OFFSET 100")
def row_range(spark, sf_dir):
    """Rows 101 to 600 by price (the range is the feature)."""
    return R.row_range(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), [F.desc("o_totalprice"), F.col("o_orderkey")], 101, 600)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 500 OFFSET 9000")
def late_row_range(spark, sf_dir):
    """Rows 9,001 to 9,500 by price, found by positions over the cluster."""
    return R.row_range(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), [F.desc("o_totalprice"), F.col("o_orderkey")], 9001, 9500)


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def drop_date_columns(spark, sf_dir):
    """Without columns whose name holds ``date``."""
    return R.drop_date_columns(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"))


@query("SELECT doc, extraction_method, status, filled, withdrawn, note FROM results WHERE contains(extraction_method, 'Form Fields')", "results")
def contains_filter(spark, sf_dir):
    """Rows whose method holds a word."""
    return R.done_rows(base(spark, sf_dir, "results"))


@query("SELECT doc, pos, starts_with(lower(trim(title)), 're_') AS any_case, starts_with(title, 'Re_') AS prefix, contains(title, 'Re_') AS inside FROM files", "files")
def reply_filters(spark, sf_dir):
    """The three tests of reply letters."""
    t = F.col("title")
    return base(spark, sf_dir, "files").select("doc", "pos", R.reply_any_case(t).alias("any_case"), R.reply_prefix(t).alias("prefix"), R.reply_inside(t).alias("inside"))


@query("SELECT doc, status, filled, note FROM results", "results")
def listed_columns(spark, sf_dir):
    """Listed columns that exist."""
    return R.listed_columns(base(spark, sf_dir, "results"), ["doc", "missing", "status", "filled", "note"])


@query("SELECT r.doc, r.status, e.extraction_method, e.note FROM (SELECT doc, status FROM results) r LEFT JOIN existing e ON r.doc = e.doc", "results", "existing")
def pass_through(spark, sf_dir):
    """Results with the source's other columns."""
    return R.pass_through(base(spark, sf_dir, "results").select("doc", "status"), base(spark, sf_dir, "existing"), "doc")


@query("SELECT o_orderkey, o_comment FROM (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'We will submit the request separately' WHEN 1 THEN 'Too large  to attach' ELSE 'attached' END AS o_comment FROM orders) WHERE regexp_matches(o_comment, '(?i)submit\\s+(?:the\\s+)?(?:confidential\\s+)?(?:request\\s+)?separately|too\\s+large\\s+to\\s+attach')")
def comment_filter(spark, sf_dir):
    """Comments that say the form isn't attached."""
    made = F.expr(cases("o_orderkey % 3", ("We will submit the request separately", "Too large  to attach"), "'attached'"))
    return table(spark, sf_dir, "orders").select("o_orderkey", made.alias("o_comment")).where(C.not_attached(F.col("o_comment")))


# -- scalar functions ----------------------------------------------------------------------------------------------------

BCI = ("p", "PV", " b ", "bci", "Public version of x", "a public one", " other ", "")
YES = ("y e s", "On", "n", "off", "n/a", "NA", "maybe ", "")


@query(f"""SELECT p_partkey, CASE WHEN v = '' THEN '' WHEN u = 'P' THEN 'Public Document' WHEN u = 'PV' THEN 'Public Version of BCI' WHEN u IN ('B', 'BCI') THEN 'BCI' WHEN contains(u, 'PUBLIC VERSION') THEN 'Public Version of BCI' WHEN contains(u, 'PUBLIC') THEN 'Public Document' ELSE v END AS bci
  FROM (SELECT p_partkey, v, upper(trim(v)) AS u FROM (SELECT p_partkey, {cases("p_partkey % 8", BCI)} AS v FROM part))""")
def bci_norm(spark, sf_dir):
    """Confidentiality codes."""
    return table(spark, sf_dir, "part").select("p_partkey", X.bci_status(F.expr(cases("p_partkey % 8", BCI))).alias("bci"))


@query(f"""SELECT p_partkey, CASE WHEN v = '' THEN '' WHEN u IN ('YES', 'Y', 'ON') THEN 'YES' WHEN u IN ('NO', 'N', 'OFF') THEN 'NO' WHEN u IN ('N/A', 'NA') THEN 'N/A' ELSE v END AS answer
  FROM (SELECT p_partkey, v, upper(replace(v, ' ', '')) AS u FROM (SELECT p_partkey, {cases("p_partkey % 8", YES)} AS v FROM part))""")
def yes_no_norm(spark, sf_dir):
    """Answers."""
    return table(spark, sf_dir, "part").select("p_partkey", X.yes_no(F.expr(cases("p_partkey % 8", YES))).alias("answer"))


@query("SELECT o_orderkey, replace(replace('$' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) || ',50', '$', ''), ',', '') AS money FROM orders")
def money_norm(spark, sf_dir):
    """Money without signs."""
    return table(spark, sf_dir, "orders").select("o_orderkey", K.money(F.concat(F.lit("$"), F.floor("o_totalprice").cast("string"), F.lit(",50"))).alias("money"))


@query("SELECT o_orderkey, CASE WHEN length(d) BETWEEN 8 AND 10 THEN rpad(d, 10, '0') END AS code FROM (SELECT o_orderkey, CAST(o_orderkey * 7919 AS STRING) || '00' AS d FROM orders)")
def hts_pad(spark, sf_dir):
    """Codes filled to ten digits."""
    raw = F.concat((F.col("o_orderkey") * 7919).cast("string"), F.lit(".00"))
    return table(spark, sf_dir, "orders").select("o_orderkey", K.padded_code(raw).alias("code"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(CAST(trunc(CAST(v AS DOUBLE) * 1000000) AS BIGINT) AS STRING) WHEN 1 THEN v WHEN 2 THEN v || '.3' END AS amount
  FROM (SELECT o_orderkey, CAST(o_custkey AS STRING) || '.5' AS v FROM orders)""")
def million_scale(spark, sf_dir):
    """Values with units: millions multiply, thousands don't, what isn't a number stays."""
    v = "CAST(o_custkey AS STRING) || '.5"
    text = F.expr(f"CASE o_orderkey % 4 WHEN 0 THEN '2015 Value: $' || {v} Million' WHEN 1 THEN '2015 value ' || {v} Thousand' WHEN 2 THEN '2015 Value ' || {v}.3 million' ELSE 'none' END")
    return table(spark, sf_dir, "orders").select("o_orderkey", K.scaled_value(text, "2015").alias("amount"))


CODE_TEXT = "'HTS: ' || substr(k, 1, 4) || '.' || substr(k, 5, 2) || '.' || substr(k, 7, 4) || ' and ' || reverse(k) || ' or 1234567890 x'"


@query(f"""SELECT o_orderkey, list_sort(list_distinct([k, reverse(k)])) AS codes FROM (SELECT o_orderkey, lpad(CAST(o_orderkey % 100000 AS STRING), 10, '2') AS k FROM orders)""")
def hts_extract(spark, sf_dir):
    """All codes of a text, without the examples."""
    keyed = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "lpad(CAST(o_orderkey % 100000 AS STRING), 10, '2') AS k")
    return keyed.select("o_orderkey", K.codes(F.expr(CODE_TEXT)).alias("codes"))


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') WHEN 1 THEN 'February 31 ' || CAST(year(o_orderdate) AS STRING) END AS letter_date FROM orders""")
def month_date(spark, sf_dir):
    """Dates of letters; days that don't exist stay as text."""
    day = F.date_format("o_orderdate", "MMMM d, yyyy")
    text = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("Washington "), day)).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("February 31, "), F.year("o_orderdate").cast("string"))).otherwise(F.lower(day))
    return table(spark, sf_dir, "orders").select("o_orderkey", K.letter_date(text).alias("letter_date"))


@query("SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]', '', 'g'), E' \\t\\n\\r') AS text FROM documents")
def sanitize_text(spark, sf_dir):
    """Texts without control characters."""
    return table(spark, sf_dir, "documents").select("doc_id", X.sanitize(F.col("text")).alias("text"))


@query("SELECT doc_id, CAST(len(list_filter(range(2, len(s) + 1), lambda i: substr(s, i, 1) = substr(s, i - 1, 1))) AS INT) AS doubled FROM (SELECT doc_id, substr(text, 1, 500) AS s FROM documents)")
def collapse_runs_metric(spark, sf_dir):
    """Neighbouring equal characters among the first 500, as the doubling test has them."""
    return table(spark, sf_dir, "documents").select("doc_id", X.doubled_count(F.col("text")).alias("doubled"))


@query("SELECT doc_id, regexp_replace(replace(regexp_replace(text, '[~_=]+', ' ', 'g'), 'VERSION 1 CONTINUED BELOW', ''), '[ \\t\\n\\x0B\\x0C\\r\\x85\\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+', ' ', 'g') AS text FROM documents")
def whitespace_prepare(spark, sf_dir):
    """Texts as one line."""
    return table(spark, sf_dir, "documents").select("doc_id", X.prepare_v1(F.col("text")).alias("text"))


FORM_TEXT = "'5. Relation: Other 6. Attachments ' || CASE o_orderkey % 4 WHEN 0 THEN 'YES' WHEN 1 THEN 'NO' WHEN 2 THEN 'N/A' ELSE 'x' END || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE ' 7. BCI P' END"


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN substr(t, s, 600) ELSE substr(t, s, strpos(t, '7.') - s) END AS part, CASE o_orderkey % 4 WHEN 0 THEN 'YES' WHEN 1 THEN 'NO' WHEN 2 THEN 'N/A' END AS answer
  FROM (SELECT *, strpos(t, '6.') AS s FROM (SELECT o_orderkey, """ + FORM_TEXT + " AS t FROM orders))")
def section_slice(spark, sf_dir):
    """The section of a question, and its answer."""
    made = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(FORM_TEXT).alias("t"))
    part = X.section(F.col("t"), 6)
    return made.select("o_orderkey", part.alias("part"), X.section_answer(part).alias("answer"))


@query("SELECT p_partkey, CASE WHEN length(n) > 20 THEN left(n, 17) || '...' ELSE n END AS name FROM (SELECT p_partkey, p_name || ' ' || p_type AS n FROM part)")
def shorten_names(spark, sf_dir):
    """Names cut with an ellipsis."""
    return table(spark, sf_dir, "part").select("p_partkey", X.shorten(F.concat_ws(" ", "p_name", "p_type"), 20).alias("name"))


def _replace_sql(column: str, pairs) -> str:
    for a, b in pairs:
        column = f"replace({column}, '{a}', '{b}')"
    return column


GARBLED_TEXT = "p_name || ' 3FRVFTUPS*OGPSNBUJPO and 0SHBOJ[BUJPO/BNF of 4FDUJPO 301 QVCMJDEPDVNFOU ' || p_type || ' ' || p_brand"


@query(f"SELECT p_partkey, {_replace_sql(f'({GARBLED_TEXT})', X.GARBLED)} AS text FROM part")
def garble_decode(spark, sf_dir):
    """Texts of a font without a proper encoding."""
    return table(spark, sf_dir, "part").select("p_partkey", X.decode_garbled(F.expr(GARBLED_TEXT)).alias("text"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'FORM HTSUS ' || p_brand ELSE '(cid:71)x' || p_brand END AS text FROM part")
def cid_decode(spark, sf_dir):
    """Texts of glyph numbers; fewer than ten stay."""
    many = "".join(f"(cid:{n})" for n in (71, 80, 83, 78, 32, 73, 85, 84, 86, 84, 32))
    return table(spark, sf_dir, "part").select("p_partkey", X.decode_cid(F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(many), F.col("p_brand"))).otherwise(F.concat(F.lit("(cid:71)x"), F.col("p_brand")))).alias("text"))


# -- classifiers ------------------------------------------------------------------------------------------------------------

PHRASES = ("", "Dear Ambassador Smith, ", "We respectfully request and hereby request on behalf of ACME LLC. ", "1. Indicate whether a section 301 form VERSION CONTINUED BCI Requestor Name Organization Name ", "Public Document Smith,John of Acme Inc code 8711600000 ", "Section 301 code 8711600000 ")


def _injected(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(F.expr(cases("doc_id % 6", PHRASES)), F.coalesce("text", F.lit(""))).alias("full"))


@query(f"""SELECT doc_id, regexp_matches(t, 'Dear\\s+(Ambassador|Mr\\.|Ms\\.|Dr\\.)') AS dear, CAST({" + ".join(f"CAST(contains(lower(t), '{p}') AS INT)" for p in C.NARRATIVE)} AS INT) AS narrative
  FROM (SELECT doc_id, {cases("doc_id % 6", PHRASES)} || coalesce(text, '') AS t FROM documents)""")
def letter_flags(spark, sf_dir):
    """Marks of letters in texts with injected phrases."""
    rows = _injected(spark, sf_dir)
    return rows.select("doc_id", F.col("full").rlike(C.DEAR).alias("dear"), X.total([F.lower("full").contains(p) for p in C.NARRATIVE]).alias("narrative"))


# -- fields --------------------------------------------------------------------------------------------------------------------

WIDGET_NAMES = ("bci", "hts", "attachments", "organization name", "2015 value", "other")
WIDGET_VALUES = ("P", "8711.60.00", "y e s", "Acme", "$1,234.50", "Off")


@query(f"""WITH w AS (SELECT user_id, event_id, {cases("event_id % 6", WIDGET_NAMES)} AS n, {cases("(event_id + user_id) % 6", WIDGET_VALUES)} AS v FROM events),
  last AS (SELECT user_id, n, v FROM w WHERE v <> 'Off' AND (n <> 'hts' OR v = '8711.60.00') QUALIFY row_number() OVER (PARTITION BY user_id, n ORDER BY event_id DESC) = 1)
  SELECT u.user_id AS doc_id, max(CASE WHEN n = 'bci' THEN CASE v WHEN 'P' THEN 'Public Document' ELSE v END END) AS q1_bci_status, max(CASE WHEN n = 'hts' THEN '8711600000' END) AS q3_htsus,
    max(CASE WHEN n = 'attachments' THEN CASE v WHEN 'y e s' THEN 'YES' ELSE v END END) AS q6_attachments, max(CASE WHEN n = 'organization name' THEN v END) AS q4_organization, max(CASE WHEN n = '2015 value' THEN replace(replace(v, '$', ''), ',', '') END) AS q10_2015_value
  FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN last l ON l.user_id = u.user_id GROUP BY u.user_id""")
def widget_pivot(spark, sf_dir):
    """Events as form widgets, turned into fields; the last value of each wins."""
    w = table(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), F.lit(1).alias("page_no"), F.col("event_id").alias("widget_no"), F.expr(cases("event_id % 6", WIDGET_NAMES)).alias("field_name"), F.expr(cases("(event_id + user_id) % 6", WIDGET_VALUES)).alias("field_value"))
    return E.from_widgets(w).select("doc_id", "q1_bci_status", "q3_htsus", "q6_attachments", "q4_organization", "q10_2015_value")


FORM_LINES = "'1. Public Document\n2. Please provide a full description of the concern: a machine part made of forged steel, polished and painted ' || o_orderpriority || '\n3. 10-digit code ' || lpad(CAST(o_orderkey AS STRING), 10, '3') || '\n4. Requestor Information Name: Smith John\nOrganization Name: Acme Corp\n6. YES 7. P 8. NO 9. N/A 10. x\n2015 Value: $' || CAST(o_custkey AS STRING) || ' Million\n'"


@query("""SELECT o_orderkey, 'Public Document' AS q1_bci_status, lpad(CAST(o_orderkey AS STRING), 10, '3') AS q3_htsus, 'Smith John' AS q4_requestor_name, 'Acme Corp' AS q4_organization, 'YES' AS q6_attachments, 'NO' AS q8_us_sources, 'N/A' AS q9_third_countries, CAST(o_custkey * 1000000 AS STRING) AS q10_2015_value FROM orders""")
def text_fields(spark, sf_dir):
    """Fields of plain-text forms."""
    fields = E.completed(E.from_text_v1(F.col("t")))
    names = ("q1_bci_status", "q3_htsus", "q4_requestor_name", "q4_organization", "q6_attachments", "q8_us_sources", "q9_third_countries", "q10_2015_value")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.expr(FORM_LINES).alias("t")).select("o_orderkey", *[fields[f].alias(f) for f in names])


@query("SELECT doc, CASE WHEN filled >= 5 THEN 'Success' ELSE 'Low' END AS own, CASE WHEN withdrawn = 1 THEN 'withdrawn' ELSE status END AS shown, CASE WHEN status = 'pdf not present' OR trim(note) = '' THEN 'PDF not present' WHEN status = 'Low' THEN 'Scanned' ELSE '' END AS notes FROM results", "results")
def status_and_notes(spark, sf_dir):
    """Statuses and notes of results."""
    c = F.col
    return base(spark, sf_dir, "results").select("doc", F.when(c("filled") >= E.ENOUGH, "Success").otherwise("Low").alias("own"), E.result_status(c("status"), c("withdrawn")).alias("shown"), E.result_notes(c("status"), c("note"), F.lit("")).alias("notes"))


MESSAGES = ("Form (patterns: 3)", "EXCLUDED: Dear letter format", "Not Section 301", "Error: HTTP 429", "Error: x", None)


@query(f"""WITH a AS (SELECT doc, pos, url, title, score, {cases("(doc + pos) % 6", MESSAGES)} AS msg FROM files JOIN candidates USING (doc, pos) WHERE doc % 3 <> 0),
  f AS (SELECT doc, count(*) AS checked, count(*) FILTER (msg IN ('Form (patterns: 3)', 'EXCLUDED: Dear letter format', 'Not Section 301')) AS fetched, max(score) FILTER (msg = 'Form (patterns: 3)') AS best FROM a GROUP BY doc)
  SELECT i.doc, CAST(CASE WHEN doc % 7 = 0 THEN 'API error' WHEN best IS NOT NULL THEN 'Scanned' ELSE 'pdf not present' END AS STRING) AS status,
    CASE WHEN doc % 7 = 0 THEN 'API error 500' WHEN best IS NOT NULL THEN 'BEST (score=' || CAST(best AS STRING) || ')' WHEN checked IS NULL THEN 'No non-Re_ PDF attachments' WHEN fetched > 0 THEN 'Checked PDFs, none matched' ELSE 'All PDFs failed to fetch (404/error)' END AS selection_reason,
    coalesce(best, 0) AS best_score, coalesce(checked, 0) AS total_attachments_checked FROM ids i LEFT JOIN f USING (doc)""", "files", "candidates", "ids")
def status_machine(spark, sf_dir):
    """Documents' statuses from their attachments' outcomes."""
    rows = base(spark, sf_dir, "files").join(base(spark, sf_dir, "candidates").select("doc", "pos", "score"), ["doc", "pos"]).where("doc % 3 != 0")
    rows = rows.withColumn("msg", F.expr(cases("(doc + pos) % 6", MESSAGES))).withColumns({"is_form": F.coalesce(F.col("msg").startswith("Form"), F.lit(False)), "method": F.lit("Text")})
    docs = base(spark, sf_dir, "ids").withColumn("api_error", F.when(F.col("doc") % 7 == 0, "API error 500"))
    return E.document_status(rows, docs, "doc").select("doc", "status", "selection_reason", "best_score", "total_attachments_checked")


# -- reports ---------------------------------------------------------------------------------------------------------------------

METRICS = {
    "withdrawn_summary": {"withdrawn": "withdrawn = 1", "active": "withdrawn = 0", "unknown": "withdrawn IS NULL"},
    "extraction_summary": {"form_fields": "extraction_method = 'Form Fields'", "scanned_ocr": "extraction_method = 'Scanned (OCR)'", "success": "status = 'Success'", "low": "status = 'Low'", "error": "status = 'Error'", "no_url": "note = ''"},
    "docket_summary": {"low": "status = 'Low'", "not_present": "status = 'pdf not present'", "new_pattern": "status = 'new pattern'", "withdrawn": "withdrawn = 1", "text": "contains(extraction_method, 'Text') AND NOT contains(extraction_method, 'Scanned')"},
    "sibling_summary": {"total": "true", "success": "status = 'Success'", "form_fields": "contains(extraction_method, 'Form Fields')", "not_present": "status = 'pdf not present'", "scanned": "status = 'Scanned'", "api_error": "status = 'API error'", "withdrawn": "withdrawn = 1"},
}


def _summary(name: str):
    def run(spark, sf_dir):
        return R.metrics(base(spark, sf_dir, "results"), **{k: R.count_where(F.expr(c)) for k, c in METRICS[name].items()}, **({"avg_filled": F.bround(F.avg("filled"), 1)} if name == "extraction_summary" else {}))

    run.__name__, run.__doc__ = name, "Counts of a report, as metric and value."
    extra = " UNION ALL SELECT 'avg_filled', round_even(avg(filled), 1) FROM results" if name == "extraction_summary" else ""
    return query(" UNION ALL ".join(f"SELECT '{k}' AS metric, CAST(count(*) FILTER ({c}) AS DOUBLE) AS value FROM results" for k, c in METRICS[name].items()) + extra, "results")(run)


for _name in METRICS:
    _summary(_name)


@query("""SELECT doc, CASE WHEN contains(extraction_method, 'Scanned') THEN 'FFE6E6' END AS v1, CASE WHEN withdrawn = 1 THEN 'FF0000' END AS cell, CASE WHEN withdrawn = 1 THEN 'FFFF00' WHEN status = 'Low' THEN 'FFCCCB' WHEN status = 'pdf not present' THEN 'E8E8E8' WHEN status = 'new pattern' THEN 'FFA500' END AS v2,
  CASE WHEN withdrawn = 1 THEN 'FFFF00' WHEN status = 'pdf not present' THEN 'E8E8E8' END AS sibling FROM results""", "results")
def row_fill(spark, sf_dir):
    """Fills of rows and cells."""
    s, w = F.col("status"), F.col("withdrawn")
    return base(spark, sf_dir, "results").select("doc", R.fill_v1(F.col("extraction_method")).alias("v1"), R.fill_withdrawn_cell(w).alias("cell"), R.fill_v2(s, w).alias("v2"), R.fill_sibling(s, w).alias("sibling"))


@query("SELECT quality, toxic, count(*) AS n FROM labels GROUP BY ALL")
def label_counts(spark, sf_dir):
    """Labels by kind."""
    return table(spark, sf_dir, "labels").groupBy("quality", "toxic").agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT page_id, {cases("page_id % 3", ("Employment", "accessions", "Separations"))} AS source, 'July ' || CAST(2000 + page_id % 20 AS STRING) AS "dateLabel", CASE WHEN page_id % 2 = 0 THEN CAST(page_id % 5 AS STRING) ELSE '1' END AS version, page_id % 4 = 0 AS "isCurrent" FROM pages""")
def html_cards(spark, sf_dir):
    """Download cards of pages that hold one each."""
    card = "'<h3>Federal ' || " + cases("page_id % 3", ("Employment", "accessions", "Separations")) + " || ' Raw Data (July ' || CAST(2000 + page_id % 20 AS STRING) || ' )</h3>' || CASE WHEN page_id % 2 = 0 THEN '<p>Version: ' || CAST(page_id % 5 AS STRING) || '</p>' ELSE '' END || CASE WHEN page_id % 4 = 0 THEN '<b>Current</b>' ELSE '' END"
    return L.cards(table(spark, sf_dir, "pages").select("page_id", F.expr(card).alias("html"))).select("page_id", "source", "dateLabel", "version", "isCurrent")
