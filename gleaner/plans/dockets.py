"""Queries of the classifiers, extractors and reports, with inputs of many shapes and the SQL that gives the same rows.

They join the catalogue's. Inputs are made by SQL that both engines read alike; the rules are written again in SQL, over
the same fixed phrases and patterns.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions import codes as K
from ..functions import text as X
from ..operators import classify as C
from ..operators import extract as E
from ..operators import relational as R
from ..sources import landing as L
from . import pipelines as P
from .catalogue import BASES, base, cases, query, spread, table

# -- SQL of the building blocks ------------------------------------------------------------------------------------


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rx(pattern: str) -> str:
    """A pattern as DuckDB takes it, quoted: it reads Unicode and line ends as the flags U and d ask anyway (on ASCII)."""
    plain = re.sub(r"\(\?([a-zA-Z]+)\)", lambda m: f"(?{f})" if (f := "".join(c for c in m[1] if c in "ims")) else "", pattern)
    return lit(plain)


def matches(c: str, pattern: str) -> str:
    return f"regexp_matches({c}, {rx(pattern)})"


def got(c: str, pattern: str, group: int = 1) -> str:
    return f"nullif(regexp_extract({c}, {rx(pattern)}, {group}), '')"


def replaced(c: str, pairs) -> str:
    for a, b in pairs:
        c = f"replace({c}, {lit(a)}, {lit(b)})"
    return c


def dropped(c: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({c}, {rx(pattern)}, {lit(by)}, 'g')"


def stripped(c: str) -> str:
    return dropped(c, r"^\s+|\s+$")


def squeezed(c: str) -> str:
    return dropped(c, r"\s+", " ")


def has_any(c: str, words) -> str:
    return "(" + " OR ".join(f"contains({c}, {lit(w)})" for w in words) + ")"


def total(flags) -> str:
    return "(" + " + ".join(f"CAST(coalesce({f}, false) AS INT)" for f in flags) + ")"


def bci(v: str) -> str:
    u = f"upper({stripped(v)})"
    return f"""CASE WHEN {v} IS NULL OR {v} = '' THEN '' WHEN {u} = 'P' THEN 'Public Document' WHEN {u} = 'PV' THEN 'Public Version of BCI' WHEN {u} IN ('B', 'BCI') THEN 'BCI'
      WHEN contains({u}, 'PUBLIC VERSION') THEN 'Public Version of BCI' WHEN contains({u}, 'PUBLIC') THEN 'Public Document' ELSE {v} END"""


def yes_no(v: str) -> str:
    u = "upper(" + dropped(v, r"\s+") + ")"
    return f"CASE WHEN {v} IS NULL OR {v} = '' THEN '' WHEN {u} IN ('YES', 'Y', 'ON') THEN 'YES' WHEN {u} IN ('NO', 'N', 'OFF') THEN 'NO' WHEN {u} IN ('N/A', 'NA') THEN 'N/A' ELSE {v} END"


def repair1(c: str) -> str:
    for p in (r"^[I|!]", r"^[.,_\-';:|\s]+", r"[_\-;:=]{2,}.*$", r"[~=]{3,}", r"['\-.;:]+"):
        c = dropped(c, p)
    c = replaced(c, (("_ln_c_", "Inc"), ("ln_c", "Inc"), ("*ln*c", "Inc"), ("IO_t_h_er", "Other"), ("N-1-A", "N/A"), ("N1A", "N/A")))
    return f"coalesce({stripped(squeezed(dropped(c, r'[.]{2,}')))}, '')"


def repair2(c: str) -> str:
    for p in (r"^[I|!]", r"^[.,_\-';:|\s]+", r"[_\-;:=]{2,}.*$"):
        c = dropped(c, p)
    return f"coalesce({stripped(squeezed(replaced(c, (('_ln_c_', 'Inc'), ('ln_c', 'Inc'), ('IO_t_h_er', 'Other'), ('N-1-A', 'N/A')))))}, '')"


def sanitized(c: str) -> str:
    return f"coalesce({stripped(dropped(c, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F-\\x{9F}]'))}, '')"


def decoded(c: str) -> str:
    return f"CASE WHEN length({c}) < 50 THEN {c} ELSE {replaced(c, X.GARBLED)} END"


#: A text with ten glyph numbers or more, word by word and then number by number.
CID_PIECE = "CASE WHEN regexp_matches(p, '^[0-9]+\\)') THEN CASE WHEN CAST(regexp_extract(p, '^([0-9]+)\\)', 1) AS INT) BETWEEN 32 AND 126 THEN chr(CAST(regexp_extract(p, '^([0-9]+)\\)', 1) AS INT)) ELSE ' ' END || regexp_replace(p, '^[0-9]+\\)', '') ELSE '(cid:' || p END"


def cid(c: str) -> str:
    words = replaced(c, X.CID_WORDS)
    pieces = f"string_split({words}, '(cid:')"
    return f"CASE WHEN len(regexp_extract_all({c}, '\\(cid:[0-9]+\\)')) < 10 THEN {c} ELSE {pieces}[1] || array_to_string(list_transform({pieces}[2:], lambda p: {CID_PIECE}), '') END"


# -- normalisers ---------------------------------------------------------------------------------------------------

ODD_NAMES = ("I Smith__ John -- left", "...Acme ln_c of;; the: Coast", "|_ln_c_ Widgets", "N-1-A", "N1A", "*ln*c", "IO_t_h_er  way", "O'Hara - Sons, Inc.", "==== ~~~~ Acme", "", "Jane  Roe ; Dept. 5", "!Plain")
NAMED = f"SELECT o_orderkey, {cases('o_orderkey % 12', ODD_NAMES)} || CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE ' ' || o_orderpriority END AS v FROM orders"


def values(spark, sf_dir, text: str, name: str = "orders", costly: bool = False):
    """Rows made by SQL from a table, which is dealt over all cores beforehand if what follows is ``costly``."""
    text = re.sub(rf"FROM {name}\b", f"FROM {{{name}}}", text.replace("{", "{{").replace("}", "}}"))
    rows = table(spark, sf_dir, name)
    return spark.sql(text, **{name: spread(rows) if costly else rows})


@query(f"SELECT o_orderkey, {repair1('v')} AS first, {repair2('v')} AS second FROM ({NAMED})")
def repair_names(spark, sf_dir):
    """Recognition repairs of both dockets."""
    return values(spark, sf_dir, NAMED).select("o_orderkey", X.repair_v1(F.col("v")).alias("first"), X.repair_v2(F.col("v")).alias("second"))


CONTROLLED = "SELECT doc_id, coalesce(text, '') || CASE doc_id % 4 WHEN 0 THEN ' /BNF 4FDUJPO' || chr(7) || 'x' WHEN 1 THEN chr(10) || '7&34*0/ $0/5*/6&%' WHEN 2 THEN '<br>a<BR />b<br  >c' ELSE chr(127) END AS v FROM documents"


@query(f"SELECT doc_id, {dropped('v', '[\\x00-\\x1f\\x7f-\\x{9f}]', ' ')} AS blanks, {replaced('v', X.GARBLED_SHORT)} AS decoded, {dropped('v', '(?i)<br\\s*/?>', chr(10))} AS lines FROM ({CONTROLLED})")
def clean_texts(spark, sf_dir):
    """Control characters as blanks, the classifier's short table, and breaks as line ends."""
    v = F.col("v")
    return values(spark, sf_dir, CONTROLLED, "documents").select("doc_id", X.controls_to_blanks(v).alias("blanks"), X.replaced(v, X.GARBLED_SHORT).alias("decoded"), X.breaks_to_newlines(v).alias("lines"))


PREPARED_TEXT = ("3FRVFTUPS/BNF  and  0SHBOJ[BUJPO/BNF of the 1SPEVDU", "~~__==~ VERSION 1 CONTINUED BELOW 4FDUJPO 301", "short", "&YDMVTJPO  3FRVFTU JOEJDBUF HMPCBM BWBJMBCJMJUZ", "plain words")
PREPARED = f"SELECT p_partkey, {cases('p_partkey % 5', PREPARED_TEXT)} || chr(10) || p_name || '  ' || p_type AS v FROM part"


@query(f"SELECT p_partkey, {squeezed(replaced(dropped(decoded('v'), '[~_=]+', ' '), ((X.BANNER, ''),)))} AS line FROM ({PREPARED})")
def prepare_texts(spark, sf_dir):
    """Decoded texts as one line, without rules and the banner."""
    return values(spark, sf_dir, PREPARED, "part").select("p_partkey", X.prepare_v2(F.col("v")).alias("line"))


DOTTED = ("code 8711.60.0090 x", "8711 60 00 9", "8504.40.95.10 and 8711.60.0090", "8504 40 95 1234", "12.34.56", "none", "9999.99.99.123", "x1234.56.7890y")


@query(f"""SELECT o_orderkey, CASE WHEN regexp_matches(v, '\\d{{4}}\\.\\d{{2}}\\.\\d{{4}}') THEN replace(regexp_extract(v, '\\d{{4}}\\.\\d{{2}}\\.\\d{{4}}'), '.', '')
  WHEN regexp_matches(v, '\\d{{4}}[.\\s]\\d{{2}}[.\\s]\\d{{2}}[.\\s]\\d{{2,4}}') THEN regexp_replace(regexp_extract(v, '\\d{{4}}[.\\s]\\d{{2}}[.\\s]\\d{{2}}[.\\s]\\d{{2,4}}'), '[.\\s]', '', 'g') END AS code
  FROM (SELECT o_orderkey, {cases("o_orderkey % 8", DOTTED)} || ' ' || o_orderpriority AS v FROM orders)""")
def dotted_codes(spark, sf_dir):
    """Codes written with dots or blanks."""
    return values(spark, sf_dir, f"SELECT o_orderkey, {cases('o_orderkey % 8', DOTTED)} || ' ' || o_orderpriority AS v FROM orders").select("o_orderkey", K.dotted_code(F.col("v")).alias("code"))


@query("SELECT p_partkey, 1 - levenshtein(p_name, p_type) / CAST(greatest(length(p_name), length(p_type), 1) AS DOUBLE) AS likeness FROM part")
def name_similarity(spark, sf_dir):
    """Fuzzy likeness of two columns."""
    return table(spark, sf_dir, "part").select("p_partkey", X.similarity(F.col("p_name"), F.col("p_type")).alias("likeness"))


ANSWERED = ("Here: {\"q3_htsus\": \"8711600000\", \"score\": \"7\"} done", "no json, 250 of 100", "{\"score\": \"042\"}", "score 88 or 99", "")


@query(f"""SELECT event_id, json_extract_string(CASE WHEN contains(v, '{{') THEN regexp_extract(v, '(?s)\\{{.*\\}}') END, '$.score') AS given,
  CASE WHEN regexp_matches(v, '\\d') THEN greatest(0, least(100, CAST(regexp_extract(v, '(\\d{{1,3}})', 1) AS INT))) END AS score FROM (SELECT event_id, {cases("event_id % 5", ANSWERED)} AS v FROM events)""")
def model_answers(spark, sf_dir):
    """JSON and scores in a model's answers."""
    v = F.col("v")
    rows = values(spark, sf_dir, f"SELECT event_id, {cases('event_id % 5', ANSWERED)} AS v FROM events", "events")
    return rows.select("event_id", F.try_element_at(X.json_object(v), F.lit("score")).alias("given"), X.first_score(v).alias("score"))


ATTACHED = ("3917290090 ECM FLX-3410B P", " 8544429090 primex 12_A-b P ", "3917290090 ECM FLX P x", "391729009 ECM FLX P", "Form", "8544429090 Other x P")
REMARKS = (C.NEW_PATTERN_COMMENTS["ECM"] + " 8504409510.", C.NEW_PATTERN_COMMENTS["Primex"] + " and more", "please see the file", None)
METADATA = f"SELECT l_orderkey AS doc, l_linenumber AS line, {cases('(l_orderkey + l_linenumber) % 6', ATTACHED)} AS a, {cases('(l_partkey + l_suppkey) % 6', ATTACHED)} AS b, {cases('l_suppkey % 4', REMARKS)} AS remark FROM lineitem"
TITLE = r"(?i)^\s*(\d{10})\s+(ECM|Primex)\s+([\w-]+)\s+P\s*$"


@query(f"""SELECT doc, line, hit IS NOT NULL OR contains(coalesce(remark, ''), {lit(C.NEW_PATTERN_COMMENTS["ECM"])}) OR contains(coalesce(remark, ''), {lit(C.NEW_PATTERN_COMMENTS["Primex"])}) AS new_pattern,
  coalesce({got("hit", TITLE)}, {got("remark", "(?i)HTS\\s+Code\\s+(\\d{10})")}) AS code, {got("hit", TITLE, 3)} AS item,
  CASE who WHEN 'ECM' THEN 'ECM Industries LLC' WHEN 'Primex' THEN 'Primex Family of Companies' END AS organization, CASE who WHEN 'ECM' THEN 'ECM Industries LLC' WHEN 'Primex' THEN 'Primex' END AS requestor, place
  FROM (SELECT *, CASE WHEN hit IS NOT NULL THEN CASE WHEN upper({got("hit", TITLE, 2)}) = 'ECM' THEN 'ECM' ELSE 'Primex' END WHEN contains(remark, {lit(C.NEW_PATTERN_COMMENTS["ECM"])}) THEN 'ECM' WHEN contains(remark, {lit(C.NEW_PATTERN_COMMENTS["Primex"])}) THEN 'Primex' END AS who
    FROM (SELECT *, CASE WHEN {matches("a", TITLE)} THEN a WHEN {matches("b", TITLE)} THEN b END AS hit, CASE WHEN {matches("a", TITLE)} THEN 0 WHEN {matches("b", TITLE)} THEN 1 END AS place FROM ({METADATA})))""")
def metadata_kinds(spark, sf_dir):
    """What titles and comments tell, without a download."""
    titles, remark = F.array("a", "b"), F.col("remark")
    rows = X.fenced(values(spark, sf_dir, METADATA, "lineitem"), {"m": C.metadata_fields(titles, remark), "n": C.new_pattern_by_metadata(titles, remark)})
    return rows.select("doc", "line", F.col("n").alias("new_pattern"), F.col("m.q3_htsus").alias("code"), F.col("m.q2_product_description").alias("item"), F.col("m.q4_organization").alias("organization"), F.col("m.q4_requestor_name").alias("requestor"), F.col("m.place").alias("place"))


# -- classifiers -----------------------------------------------------------------------------------------------------

INJECTED = (
    "", "Dear Ambassador Smith, ", "We respectfully request and hereby request on behalf of ACME. ", "We request this exclusion request\n\n a \n\n b \n\n c \n\n d \n\n e \n\n f \n\n seeks an exclusion, ",
    "ACME WIDGETS LLC, Inc 12 Main Street Suite 5 Phone: 555 Email: a@b.com hereby submit ", "This exclusion request is for pumps. ",
    "1. Indicate whether a section 301 form VERSION CONTINUED BCI Requestor Name Organization Name\n2. Provide the list\n3. List all china acts ", "RequestorName OrganizationName Section301 formtorequestexclusion BCI version, indicate the and provide any ",
    "Public Document Smith,John of Acme Inc code 8711600000 ", "Public Version 8711.60.00.90 HTSUS 8504.40.95 and 1234567890 ", "Section 301 code 8711600000 ", "form to request, U.S. Trade Representative, htsus subheading ",
    "PublicDocument ContainsBCI U.S.Producer Smith,John 8711.60.00.90 continued Inc.", "3FRVFTUPS/BNF 0SHBOJ[BUJPO/BNF 7&34*0/ $0/5*/6&% indicate whether provide any section 301 ",
    "(cid:71)(cid:80)(cid:83)(cid:78)(cid:32)(cid:73)(cid:85)(cid:84)(cid:86)(cid:84)(cid:200)(cid:66)(cid:67) (cid:52)(cid:70)(cid:68)(cid:85)(cid:74)(cid:80)(cid:79) ", None,
)
#: Every document with an injected phrase; some are cut short, doubled, or left with a word.
DETECTED = f"""SELECT doc_id, CASE WHEN doc_id % 16 = 15 THEN CASE WHEN doc_id % 3 = 0 THEN ' short ' ELSE 'vveerrssiioonn  hhttss  ccoonnttiinnuueedd  bbccii 1234 and some more words' END
  WHEN doc_id % 5 < 2 THEN {cases("doc_id % 16", INJECTED)} || left(coalesce(text, ''), 600) ELSE {cases("doc_id % 16", INJECTED)} || coalesce(text, '') END AS t FROM documents"""


def patterns(c: str, ps) -> list[str]:
    return [matches(c, f"(?i){re.sub(r'^[(][?][a-zA-Z]+[)]', '', p)}") for p in ps]


def guarded(c: str, words, pattern: str) -> str:
    return "(" + " AND ".join([f"contains({c}, {lit(w)})" for w in words] + ([matches(c, pattern)] if pattern else [])) + ")"


RUNS = "len(list_filter(range(2, len(s) + 1), lambda i: substr(s, i, 1) = substr(s, i - 1, 1)))"
COLLAPSED = "array_to_string(list_transform(list_filter(range(1, length(s) + 1), lambda i: i = 1 OR cs[i] <> cs[i - 1]), lambda i: cs[i]), '')"
QUESTION_LISTS = ", ".join(f"regexp_extract_all(b, {rx(q)}, 1)" for q in C.QUESTIONS)
CODE_LISTS = ", ".join(f"regexp_extract_all(full_text || ' ' || cl, {rx(p)}, {g})" for p, g in K.CODE_PATTERNS)
MARKER_FLAGS = [f"contains(la, {lit(m)})" for m in C.MARKERS] + [f"contains(lall, '{x}') AND contains(lall, '{y}')" for x, y in (("section", "301"), ("requestor", "organization"), ("public", "bci"), ("version", "continued"))]
MARKER_FLAGS += ["contains(lall, 'exclusion') AND (contains(lall, 'form') OR contains(lall, 'request'))", matches("lall", r"\b1\b.*\bindicate\b"), matches("lall", r"\b2\b.*\bprovide\b")]
GOVERNMENT_FLAGS = [guarded("lall", w, p) for w, p in C.GOVERNMENT] + [r"len(regexp_extract_all(cl, '\b\d+\.\s*[A-Za-z]')) >= 5"]
FILLED_FLAGS = [matches("c", r"\b\d{4}\.\d{2}\.\d{2}\.\d{2}\b"), *[has_any("c", w) for w in C.FILLED_WORDS], matches("c", "[A-Z][a-z]+,[A-Z][a-z]+"), has_any("c", ("Inc.", "LLC")), "length(c) < 2000"]
everywhere = lambda words: f"({has_any('lower(full_text)', words)} OR {has_any('lower(cl)', words)})"
DETECT_SQL = f"""WITH raw AS ({DETECTED}), one AS (SELECT doc_id, t AS full_text, {cid(dropped("t", "[\\x00-\\x1f\\x7f-\\x{9f}]", " "))} AS s FROM raw),
  two AS (SELECT doc_id, full_text, s, (SELECT len(list_filter(range(2, len(h) + 1), lambda i: h[i] = h[i - 1])) FROM (SELECT string_split(substr(s, 1, 500), '') AS h)) > 0.3 * length(substr(s, 1, 500)) AS doubled FROM one),
  three AS (SELECT doc_id, full_text, {replaced(f"CASE WHEN doubled THEN (SELECT {COLLAPSED} FROM (SELECT string_split(s, '') AS cs)) ELSE s END", X.GARBLED_SHORT)} AS cl FROM two),
  four AS (SELECT *, full_text || cl AS a, full_text || cl AS b, full_text || cl AS c, lower(full_text || cl) AS la, lower(full_text || cl || cl) AS lall FROM three),
  five AS (SELECT *, len(list_filter(list_distinct(list_concat({QUESTION_LISTS})), lambda x: x IN ({", ".join(f"'{n}'" for n in range(1, 13))}))) AS questions,
    list_sort(list_distinct(list_filter(list_transform(list_concat({CODE_LISTS}), lambda h: regexp_replace(h, '[.\\s]', '', 'g')), lambda h: regexp_matches(h, '^\\d+$') AND length(h) IN (8, 10) AND h NOT IN ({", ".join(lit(d) for d in K.DUMMIES)})))) AS codes,
    {total(f"contains(la, {lit(p)})" for p in C.NARRATIVE)} AS narrative, {total(guarded("a", w, p) for w, p in C.LETTERHEAD)} AS head, {total(MARKER_FLAGS)} AS markers, {total(GOVERNMENT_FLAGS)} AS government, {total(FILLED_FLAGS)} AS filled,
    {total(everywhere(w) for w in C.ELEMENTS)} AS f, {matches("c", r"[A-Z][a-z]+,\s*[A-Z][a-z]+")} AS name, {matches("c", r"[A-Za-z\s] (LLC|Inc|Corp|Ltd)")} AS company, {everywhere(("public document", "public version"))} AS public FROM four),
  six AS (SELECT *, len(codes) AS n, questions >= 3 OR markers >= 3 OR government >= 2 OR filled >= 4 AS form, CASE WHEN length({stripped("full_text")}) < 50 THEN 'short' WHEN {matches("a", C.DEAR)} THEN 'dear'
      WHEN (narrative >= 2 AND length(full_text) > 3000 AND len(regexp_extract_all(full_text, '\\n\\n')) > 5) OR (narrative >= 3 AND length(full_text) > 2000) THEN 'narrative' WHEN head >= 4 THEN 'head' WHEN length(a) > 1000 AND {has_any("la", C.ABOUT)} THEN 'about' END AS out FROM five),
  seven AS (SELECT *, CASE WHEN out IS NOT NULL THEN out WHEN form AND f >= 1 THEN 'form' WHEN public AND n > 0 AND (name OR company) THEN 'scrambled' WHEN n > 0 AND f >= 1 THEN 'minimal' ELSE 'not' END AS kind FROM six)
  SELECT doc_id, kind IN ('form', 'scrambled', 'minimal') AS is_form, CASE kind WHEN 'short' THEN 'Text extraction failed' WHEN 'dear' THEN 'EXCLUDED: Dear letter format' WHEN 'narrative' THEN 'EXCLUDED: Narrative business letter (indicators:' || narrative || ')'
      WHEN 'head' THEN 'EXCLUDED: Business letterhead (indicators:' || head || ')' WHEN 'about' THEN 'EXCLUDED: Document about exclusion, not the form itself' WHEN 'form' THEN 'Form (patterns: ' || f || ')' WHEN 'scrambled' THEN 'Scrambled (HTSUS: ' || codes[1] || ')' WHEN 'minimal' THEN 'Minimal (HTSUS: ' || codes[1] || ')' ELSE 'Not Section 301' END AS msg,
    CAST(CASE WHEN kind IN ('dear', 'narrative', 'head', 'about') THEN -100 WHEN kind = 'form' THEN 10 * f + CASE WHEN f >= 3 THEN 20 ELSE 0 END + CASE WHEN f >= 5 THEN 30 ELSE 0 END WHEN kind = 'scrambled' THEN 15 + 3 * n + CASE WHEN name THEN 5 ELSE 0 END + CASE WHEN company THEN 5 ELSE 0 END WHEN kind = 'minimal' THEN 10 + 2 * n + 5 * f ELSE 0 END AS INT) AS score FROM seven"""


@query(DETECT_SQL)
def classify_messages(spark, sf_dir):
    """The form detector over every document with an injected phrase."""
    rows = values(spark, sf_dir, DETECTED, "documents", costly=True).select("doc_id", F.col("t").alias("first2"), F.col("t").alias("full"))
    return C.detect(rows, "first2", "full").select("doc_id", "is_form", "msg", "score")


#: Whole texts whose first pages say something else than all of them.
TWO_TEXTS = f"""SELECT doc_id, {cases("doc_id % 16", INJECTED)} || left(coalesce(text, ''), 700) AS first2, {cases("doc_id % 16", INJECTED)} || coalesce(text, '') || {cases("doc_id % 7", ("", " Public Document of Smith,John Inc code 8711600000 ", " section 301 form to request, htsus subheading ", None, " version continued 1234567890 LLC ", " provide any bci ", " Dear Ambassador Smith, "))} AS full_text FROM documents"""
TWO_SQL = (
    f"WITH two_texts AS ({TWO_TEXTS}), raw AS (SELECT doc_id * 2 AS doc_id, coalesce(first2, '') AS t FROM two_texts UNION ALL SELECT doc_id * 2 + 1, coalesce(full_text, '') FROM two_texts), one AS "
    + DETECT_SQL.split(", one AS ", 1)[1].split("four AS (", 1)[0]
    + """four AS (SELECT f.doc_id // 2 AS doc_id, g.full_text AS full_text, g.cl AS cl, f.full_text || f.cl AS a, f.full_text || g.cl AS b, g.full_text || g.cl AS c, lower(f.full_text || f.cl) AS la, lower(f.full_text || f.cl || g.cl) AS lall
    FROM three f JOIN three g ON g.doc_id = f.doc_id + 1 WHERE f.doc_id % 2 = 0),
  five AS ("""
    + DETECT_SQL.split("five AS (", 1)[1]
)


@query(TWO_SQL)
def classify_two_texts(spark, sf_dir):
    """The form detector over all whole documents, whose first pages differ from the rest."""
    return C.detect(values(spark, sf_dir, TWO_TEXTS, "documents", costly=True), "first2", "full_text").select("doc_id", "is_form", "msg", "score")


KINDS_TEXT = (
    "", "HTS subheading: 8711.60.0090 of Primex ", "Item: 12ab part for ECM Industries I. Product Description ", "RE: Product Exclusion Request Number: 7 ", "Dear Ambassador, we hereby submit this request ", "requestor information Dear Ambassador section 301 investigation 2015 value ",
    "Request for Exclusion from Section 301; Subject: Procedures To Consider ", "Attachment A - drawing ", "Public Document, attachment ", "respectfully submits supplemental data, petitioner name ",
    "Section 301 investigation form to request exclusion requestor information 10-digit HTS htsus code product description 2015 value 2016 value ", "The purpose of this letter is to inform you ", "II. Primex cannot source; Item: 5 pumps and valves ", "Re: Exclusion from additional tariff ",
)
KINDS = f"SELECT doc_id, {cases('doc_id % 14', KINDS_TEXT)} || CASE doc_id % 3 WHEN 0 THEN left(coalesce(text, ''), 90) WHEN 1 THEN left(coalesce(text, ''), 450) ELSE coalesce(text, '') END AS t FROM documents"
NEW_SQL = f"""((({matches("l", r"hts\s+subheading\s*:\s*\d{4}\.\d{2}\.\d{4}")} OR {matches("l", r"item\s*:\s*\d+\w*\s+")}) AND ({has_any("l", ("primex", "ecm industries", "ecm "))} OR {matches("l", r"i\.\s*\n?\s*product\s+description")}))
  OR {total(patterns("t", C.NEW_PATTERN_MARKERS))} >= 2)"""


@query(f"""WITH raw AS ({KINDS}), d AS (SELECT doc_id, t, lower(t) AS l, length({stripped("t")}) AS size FROM (SELECT doc_id, {decoded("t")} AS t FROM raw)),
  f AS (SELECT *, {NEW_SQL} AS new_pattern, {" OR ".join(patterns("t", C.RESPONSE_MARKERS))} AS response, {total(patterns("l", C.LETTER_MARKERS))} AS letters, {total(patterns("l", C.FORM_MARKERS))} AS forms,
    (size < 600 AND {matches("t", r"(?i)Attachment\s+[A-Z]\s*[-–]")}) OR (size < 400 AND contains(l, 'public document') AND contains(l, 'attachment')) AS product FROM d),
  g AS (SELECT *, CASE WHEN new_pattern THEN false WHEN regexp_matches(l, 'dear\\s+ambassador') AND NOT contains(l, 'requestor information') THEN true WHEN forms >= 4 THEN false WHEN letters >= 2 AND forms <= 1 THEN true
    WHEN letters >= 1 AND forms = 0 AND size > 200 THEN true WHEN letters >= 1 AND regexp_matches(l, 'supplemental|supplement\\s+to\\s+#\\d') AND forms <= 2 THEN true ELSE false END AS cover FROM f)
  SELECT doc_id, new_pattern, response, cover, product, NOT new_pattern AND (response OR cover OR product) AS wrong, CASE WHEN size >= 200 AND 5 * forms >= CASE WHEN forms >= 5 THEN 25 ELSE 8 END THEN least(5 * forms, 100) END AS rescue FROM g""")
def document_kinds(spark, sf_dir):
    """The second docket's tests over every document with an injected phrase."""
    t = F.col("d")
    rows = X.fenced(values(spark, sf_dir, KINDS, "documents", costly=True), {"d": X.decode_garbled(F.col("t"))})
    return rows.select("doc_id", C.new_pattern(t).alias("new_pattern"), C.response_letter(t).alias("response"), C.cover_letter(t, t).alias("cover"), C.product_attachment(t).alias("product"), C.wrong_type(t, t, t).alias("wrong"), C.rescue_score(t).alias("rescue"))


@query(f"""SELECT doc_id, {", ".join(f"{total(f'contains(lower(t), {lit(w)})' for w in words)} >= 1 AS {field}" for field, words in E.GATES.items())},
  length({stripped("t")}) >= 80 AND {has_any("lower(t)", E.FORM_WORDS)} AS likely_form,
  length({stripped("t")}) >= 100 AND ({matches("lower(t)", r"hts\s+subheading\s*:\s*\d{4}\.\d{2}\.\d{4}")} OR {matches("lower(t)", r"item\s*:\s*\d+\w*\s+")}) AND {has_any("lower(t)", ("primex", "ecm ", "product description"))} AS likely_letter FROM ({KINDS})""")
def field_gates(spark, sf_dir):
    """The words that let a field be looked for, and the tests of the two layouts."""
    t = F.col("t")
    return values(spark, sf_dir, KINDS, "documents", costly=True).select("doc_id", *[E.gate(t, f).alias(f) for f in E.GATES], E.likely_form(t).alias("likely_form"), E.likely_new_pattern(t).alias("likely_letter"))


PAGED = "SELECT doc_id, left(coalesce(text, ''), CAST(doc_id % 400 AS INT)) || CASE WHEN doc_id % 7 = 0 THEN ' 3FRVFTUPS ' || left(coalesce(text, ''), 350) ELSE '' END AS one, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE substr(text, 300, CAST(doc_id % 90 AS INT)) END AS two FROM documents"
PAGES_SIZE = f"(length({stripped('coalesce(one, {0})').format(chr(39) * 2)}) + length({stripped('coalesce(two, {0})').format(chr(39) * 2)}))"


@query(f"""SELECT doc_id, {PAGES_SIZE} < 200 AS first, {PAGES_SIZE} < 300 OR length({stripped(decoded("one"))}) < 200 OR ({has_any("one", [g for g, _ in X.GARBLED[:20]])} AND length({stripped("one")}) > 300) AS second FROM ({PAGED})""")
def scanned_pages(spark, sf_dir):
    """Whether the first pages count as scanned, for both dockets."""
    pages = F.array("one", "two")
    return values(spark, sf_dir, PAGED, "documents", costly=True).select("doc_id", C.scanned_v1(pages).alias("first"), C.scanned_v2(pages, F.col("one")).alias("second"))


LAYOUT = f"SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'HTSUS;Product Description;x' WHEN 1 THEN '2015 Value;Requestor Name' END AS names, p_size % 25 AS boxes, rpad(p_name, CAST(p_partkey % 7 * 100 + 20 AS INT), 'x') AS v FROM part"
NAME_SCORES = " + ".join(f"CASE WHEN contains(lower(coalesce(names, '')), {lit(n)}) THEN 10 ELSE 0 END" for n in C.FIELD_NAMES)


@query(f"""SELECT p_partkey, least(100, CASE WHEN names IS NULL AND size < 500 THEN least(score, 20) ELSE score END) AS score FROM (
  SELECT *, {NAME_SCORES} + CASE WHEN names IS NOT NULL THEN 15 ELSE 0 END + CASE WHEN names IS NOT NULL OR size >= 500 THEN CASE WHEN boxes >= 20 THEN 50 WHEN boxes >= 10 THEN 30 WHEN boxes >= 5 THEN 15 ELSE 0 END ELSE 0 END AS score
  FROM (SELECT *, length({stripped("v")}) AS size FROM ({LAYOUT})))""")
def layout_scores(spark, sf_dir):
    """Scores of pages by their fields and rectangles."""
    names = F.split("names", ";")
    return values(spark, sf_dir, LAYOUT, "part").select("p_partkey", C.layout_score(names, F.col("boxes"), F.col("v")).alias("score"))


# -- fields --------------------------------------------------------------------------------------------------------------

#: Parts of forms, each of several shapes.
Q1 = ("1. Public Document\n", "1. Status: PV here\n", "1. Contains BCI\n", "Nothing here\n", "1. Public Version of it\n")
Q2 = ("2. Please provide a full description of the concern: a machine part made of forged steel, polished and painted in many colours\n", "2. Please provide the concern: short one\n", "2. provide details of the product: 3. none\n", "2. Please provide the concern: 7. begins with a number and goes on for more than fifty characters\n")
Q3 = ("3. 10-digit code 8711600090\n", "3. 10-digit example 1023456789 then 8504409510\n", "3. 10-digit code 8711.60.0090\nSmith,  Anna\n", "3. none\n")
Q4 = ("4. Requestor Information Name: I Smith John\nOrganization Name: Acme ln_c\nRepresentative: Jane Roe\n", "4. Requestor Information Name (Last, First): Organization x\nOrganization Name: see note\nRepresentative: N/A\n", "4. Requestor Information Name: -- \nRepresentative Name: Bo\n", "Roe, Jane\nAcme Widgets Inc.\n", "\n")
Q5 = ("5. Indicate relationship to the product: Importer\n", "5. The relationship with the product: VERSION 1 CONTINUED\n", "Distributor\n", "5.\n")
Q6 = ("6. YES 7. P 8. NO 9. N/A 10. x\n", "6. x N1A 7. NJA 8. DOMESTIC AVAIL: YES or NO 9. y N 1 A 10. z\n", "6. attachments 7. BCI attachment PV 8. none 9. GLOBAL NO\n", "6 no 7 B 8 N/A 9 yes\n")
Q10 = ("2015 Value: $1,200 Million\n2015 Quant units\n500 kg\n2016 Value 12.5 Thousand\n2017 Value: 1.2.3 million\n", "2015 Value 77\n2017 Quantity:\n\n9 t\n", "no values\n")
Q11 = ("11. Supporting (use the box) text\nA long statement about why the exclusion should be granted, in more than one hundred characters, with details. END\n", "11. Comments box) of it\nPlease provide information here, which is the form's own text and goes on for one hundred characters and more VERSION\n", "")
FORMS = "SELECT o_orderkey, " + " || ".join(cases(f"(o_orderkey + {i} * o_custkey) % {len(q)}", q) for i, q in enumerate((Q1, Q2, Q3, Q4, Q5, Q6, Q10, Q11))) + " AS t FROM orders"


def section(n: int) -> str:
    s, e = f"strpos(c, '{n}.')", f"strpos(c, '{n + 1}.')"
    return f"CASE WHEN {s} = 0 THEN '' WHEN {e} = 0 THEN substr(c, {s}, 600) ELSE substr(c, {s}, greatest(0, {e} - {s})) END"


def scaled(year: str) -> str:
    p = rf"(?i){year}\s*Value[:\s]*\$?\s*([\d,.]+)\s*(Million|Thousand)?"
    raw = f"replace(regexp_extract(t, {rx(p)}, 1), ',', '')"
    return f"CASE WHEN {matches('t', p)} THEN CASE WHEN lower(regexp_extract(t, {rx(p)}, 2)) = 'million' THEN coalesce(CAST(CAST(trunc(TRY_CAST({raw} AS DOUBLE) * 1000000) AS BIGINT) AS STRING), {raw}) ELSE {raw} END END"


def where(value: str, name: str, ok: str) -> str:
    """A value if a test of it, under a name, holds."""
    return f"(SELECT CASE WHEN {ok} THEN {name} END FROM (SELECT {value} AS {name}))"


def answer1(n: int) -> str:
    raw = f"replace(upper({got('t', rf'(?i){n}[^0-9]{{0,40}}(YES|NO|N/?A|N\s*1\s*A|NJA|jNJA|P|PV|B)')}), ' ', '')"
    fallback = f"(SELECT CASE WHEN contains(r, '1A') OR contains(r, 'JA') THEN 'N/A' WHEN starts_with(r, 'Y') THEN 'YES' WHEN r IN ('P', 'PV', 'B') THEN {bci('r')} ELSE r END FROM (SELECT {raw} AS r))"
    extra = f"WHEN contains(s, 'NJA') THEN 'N/A' WHEN regexp_matches(s, '\\b(P|PV|B)\\b') THEN {bci(got('s', r'\b(P|PV|B)\b'))}" if n == 7 else ""
    own = f"(SELECT CASE WHEN contains(s, 'NO') AND NOT contains(s, 'YES') THEN 'NO' WHEN contains(s, 'YES') THEN 'YES' WHEN contains(s, 'N/A') THEN 'N/A' {extra} END FROM (SELECT {section(n)} AS s))"
    return f"coalesce({own}, {fallback})"


V1 = {
    "q1_bci_status": f"CASE WHEN contains(t, 'Public Document') THEN 'Public Document' ELSE (SELECT CASE WHEN h IS NOT NULL THEN {bci('h')} END FROM (SELECT {got('substr(t, 1, 500)', r'(?i)1\..*?(P|PV|B|BCI)')} AS h)) END",
    "q2_product_description": f"(SELECT CASE WHEN length(a) > 50 AND NOT regexp_matches(a, '^\\d+\\.') THEN {squeezed('a')} END FROM (SELECT {stripped(got('t', r'(?is)2\.\s*Please provide.*?concern[:\s]*(.+?)(?:3\.|10-digit)'))} AS a))",
    "q3_htsus": "list_filter(regexp_extract_all(t, '\\b(\\d{10})\\b', 1), lambda h: h <> '1023456789')[1]",
    "q4_requestor_name": where(repair1(got("t", r"(?is)4\.\s*Requestor Information.*?Name.*?:\s*([^\n]{3,100})")), "x", f"length(x) > 2 AND NOT {matches('x', '(?i)organization|public|note')}"),
    "q4_organization": where(repair1(got("t", r"(?is)4\.\s*Requestor Information.*?Organization\s+Name[^\n:]*:\s*([^\n]+)")), "x", f"length(x) > 2 AND NOT {matches('x', '(?i)note|representative')}"),
    "q4_representative": where(repair1(got("t", r"(?is)4\.\s*Requestor Information.*?Representative[^\n:]*:\s*([^\n]+)")), "x", f"length(x) > 1 AND NOT {matches('x', r'(?i)^N\s*/?\s*A')}"),
    "q5_relationship": where(repair1(got("t", r"(?is)5\..*?relationship.*?product[^\n]*:\s*([^\n]+)")), "x", f"length(x) > 1 AND NOT {matches('x', r'CONTINUED|^\d+\.')}"),
    **{f: answer1(int(n)) for n, f in E.ANSWERS},
    **{f"q10_{y}_value": scaled(y) for y in E.YEARS},
    **{f"q10_{y}_quantity": stripped(got("t", rf"(?i){y}\s*Quant[^\n]*\n+([^\n]+)")) for y in E.YEARS},
    "q11_supporting_info": where(squeezed(stripped(got("t", r"(?is)11\..*?box\).*?\n+(.{100,}?)(?:VERSION|END)"))), "x", f"NOT {matches('substr(x, 1, 50)', '(?i)please provide information')}"),
}
PREPARED_V1 = squeezed(f"replace(regexp_replace(t, '[~_=]+', ' ', 'g'), {lit(X.BANNER)}, '')")


@query(f"WITH f AS ({FORMS}) SELECT o_orderkey, {', '.join(f'{sanitized(V1[n])} AS {n}' for n in E.FIELDS)} FROM (SELECT *, {PREPARED_V1} AS c FROM f)")
def form_fields_v1(spark, sf_dir):
    """All fields of the first docket's plain texts, of many shapes."""
    rows = X.fenced(values(spark, sf_dir, FORMS, costly=True), {"c": X.prepare_v1(F.col("t"))})
    return X.fenced(rows, E.completed(E.from_text_v1(F.col("t"), F.col("c")))).select("o_orderkey", *E.FIELDS)


def gated(field: str, value: str) -> str:
    return f"CASE WHEN {has_any('l', E.GATES[field])} THEN {value} END"


RELATED = "CASE " + " ".join(f"WHEN strpos(t, {lit(r)}) BETWEEN 1 AND 4000 THEN {lit(r)}" for r in E.RELATIONS) + " END"
V2 = {
    "q1_bci_status": f"CASE WHEN contains(l, 'public document') AND NOT contains(substr(l, 1, 800), 'public version') THEN 'Public Document' WHEN contains(l, 'public version') OR regexp_matches(substr(t, 1, 500), '\\bPV\\b') THEN 'Public Version of BCI' ELSE (SELECT CASE WHEN h IS NOT NULL THEN {bci('h')} END FROM (SELECT {got('substr(t, 1, 500)', r'(?i)1\..*?(P|PV|B|BCI)')} AS h)) END",
    "q2_product_description": f"(SELECT CASE WHEN length(a) > 15 AND NOT regexp_matches(a, '^\\d+\\.') THEN {squeezed('a')} END FROM (SELECT {repair2(got('t', r'(?is)2\.\s*(?:Please provide|provide).*?(?:concern|product)[:\s]*(.+?)(?:3\.|10-digit|10 digit)'))} AS a))",
    "q3_htsus": f"coalesce({V1['q3_htsus']}, CASE WHEN {matches('t', r'\d{4}\.\d{2}\.\d{4}')} THEN replace(regexp_extract(t, '\\d{{4}}\\.\\d{{2}}\\.\\d{{4}}'), '.', '') WHEN {matches('t', r'\d{4}[.\s]\d{2}[.\s]\d{2}[.\s]\d{2,4}')} THEN {dropped('regexp_extract(t, ' + rx(r'\d{4}[.\s]\d{2}[.\s]\d{2}[.\s]\d{2,4}') + ')', r'[.\s]')} END)",
    "q4_requestor_name": "coalesce("
    + where(repair2(got("t", r"(?is)4\.\s*Requestor Information.*?Name.*?:\s*([^\n]{3,100})")), "x", f"length(x) > 2 AND NOT {matches('x', '(?i)organization|public|note')}")
    + ", " + where(repair2(got("t", r"([A-Z][a-z]+,\s*[A-Z][a-z]{2,})\s*(?:\n|Organization|$)")), "x", "length(x) > 5 AND NOT contains(lower(x), 'organization')")
    + f", nullif({repair2(got('t', r'\d{4}\.\d{2}\.\d{4}\s*\n\s*([A-Z][a-z]+,\s*[A-Z][a-z]+)'))}, ''))",
    "q4_organization": f"coalesce(nullif({repair2(got('t', r'(?is)4\.\s*Requestor Information.*?Organization\s+Name[^\n:]*:\s*([^\n]+)'))}, ''), nullif({repair2(got('t', r'[A-Z][a-z]+,\s*[A-Z][a-z]+\s*\n\s*([A-Za-z0-9\s,.]+(?:Inc|LLC|Corp|Ltd)\.?)'))}, ''))",
    "q5_relationship": f"coalesce(nullif({repair2(got('t', r'(?is)5\..*?relationship.*?product[^\n]*:\s*([^\n]+)'))}, ''), {RELATED})",
    **{f: f"(SELECT CASE WHEN x IS NOT NULL THEN {yes_no('x')} END FROM (SELECT {got('t', rf'(?i){n}[^0-9]{{0,40}}(YES|NO|N/?A|N\s*1\s*A)')} AS x))" for n, f in E.ANSWERS},
    **{f"q10_{y}_value": f"replace({got('t', rf'(?i){y}\s*Value[:\s]*\$?\s*([\d,.]+)')}, ',', '')" for y in E.YEARS},
    "q11_supporting_info": f"(SELECT CASE WHEN x IS NOT NULL THEN {repair2(squeezed(stripped('x')))} END FROM (SELECT {got('t', r'(?is)11\..*?box\).*?\n+(.{50,}?)(?:VERSION|END|$)')} AS x))",
}


@query(f"WITH f AS ({FORMS}) SELECT o_orderkey, {', '.join((sanitized(gated(n, V2[n])) if n in V2 else lit('')) + f' AS {n}' for n in E.FIELDS)} FROM (SELECT *, lower(t) AS l FROM f)")
def form_fields_v2(spark, sf_dir):
    """All fields of the second docket's standard forms, of many shapes, with line ends kept."""
    return X.fenced(values(spark, sf_dir, FORMS, costly=True), E.completed(E.from_form_v2(F.col("t")))).select("o_orderkey", *E.FIELDS)


LETTERS_TEXT = (
    "Item: 12ab steel valve, 3 inch HTS subheading: 8481.80.3090 of Primex Family of Companies (PFC) hereby submits. Importer. ", "Item Description: a brass fitting for water pipes\nACME Industries Inc. hereby submits this; not available in the US. ",
    "We request that USTR exclude the copper tube that is imported from China. ECM  Industries is the importer; 7412.20.0035. ", "Blue Sky Corp of Ohio hereby submits; product not available anywhere outside of china ", "nothing to see ",
)
LETTERS = f"SELECT o_orderkey, {cases('o_orderkey % 5', LETTERS_TEXT)} || o_orderpriority || CASE WHEN o_orderkey % 3 = 0 THEN ' primex' ELSE '' END AS t FROM orders"


def named2(p: str) -> str:
    return f"nullif({repair2(stripped(got('t', p)))}, '')"


def joined_code(p: str) -> str:
    return f"CASE WHEN {matches('t', p)} THEN " + " || ".join(f"regexp_extract(t, {rx(p)}, {g})" for g in (1, 2, 3)) + " END"


KNOWN = r"CASE WHEN contains(l, 'primex') THEN 'Primex' WHEN regexp_matches(l, 'ecm\s+industries') THEN 'ECM Industries' END"
ABSENT = f"CASE WHEN {matches('t', r'(?i)not available in the U\.?S\.?|not available.*outside.*china')} THEN 'NO' END"
LETTER = {
    "q2_product_description": f"coalesce({named2(r'(?i)Item\s*:\s*(\d+\w*\s+[^\n]+?)(?:\s*HTS\s+subheading|\n\n|\nItem\s+Description)')}, {named2(r'(?i)Item\s+Description\s*:\s*([^\n]{10,200})')}, {named2(r'(?i)We request that USTR exclude the ([^.]+) that is imported')})",
    "q3_htsus": f"coalesce({joined_code(r'(?i)HTS\s+subheading\s*:\s*(\d{4})\.(\d{2})\.(\d{4})')}, {joined_code(r'\b(\d{4})\.(\d{2})\.(\d{4})\b')})",
    "q4_organization": f"coalesce(org, {KNOWN})",
    "q4_requestor_name": f"coalesce({stripped('string_split(org, {0})[1]').format(lit('('))}, {KNOWN})",
    "q5_relationship": "CASE WHEN strpos(l, 'importer') BETWEEN 1 AND 3000 THEN 'Importer' END",
    "q8_us_sources": ABSENT, "q9_third_countries": ABSENT,
}
ORG = where(repair2(stripped(got("t", r"([A-Za-z\s]+(?:Family of Companies|Industries|Inc\.?|LLC|Corp))[^\n]*hereby submits"))), "x", "length(x) > 3")


@query(f"WITH f AS ({LETTERS}) SELECT o_orderkey, {', '.join(f'{sanitized(v)} AS {n}' for n, v in LETTER.items())} FROM (SELECT *, lower(t) AS l, {ORG} AS org FROM f)")
def letter_fields(spark, sf_dir):
    """Fields of new-pattern letters."""
    fields = E.completed(E.from_letter(F.col("t")))
    return X.fenced(values(spark, sf_dir, LETTERS), {f: fields[f] for f in LETTER}).select("o_orderkey", *LETTER)


EXTRACTED = """SELECT o_orderkey AS doc_id, CASE o_orderkey % 4 WHEN 0 THEN 'short' ELSE rpad('1. Public Document 3. 8711600090 6. YES 7. P 8. NO 9. N/A 10. ', 420, 'Item: 5x widget of primex, a form ') END AS page,
  CASE WHEN o_orderkey % 8 = 0 THEN rpad('1. Status PV 3. 8504409510 6. NO 7. PV 8. YES 10. ', 260, 'recognised ') END AS ocr_text, o_orderkey % 5 = 0 AS has_widgets FROM orders"""


def _extracted(spark, sf_dir):
    rows = values(spark, sf_dir, EXTRACTED, costly=True).select("doc_id", F.array("page").alias("pages"), "ocr_text", F.lit(None).cast("string").alias("raw_text"), "has_widgets")
    names = (("bci", "P"), ("hts", "8711.60.00"), ("relationship", "Importer"), ("attachments", "yes"), ("2015 value", "$1,000"), ("comments", "Off"))
    widgets = rows.where("has_widgets").select("doc_id", F.lit(1).alias("page_no"), F.inline(F.array(*[F.struct(F.lit(i).alias("widget_no"), F.lit(n).alias("field_name"), F.lit(v).alias("field_value")) for i, (n, v) in enumerate(names)])))
    return rows.drop("has_widgets"), widgets


@query(f"""WITH x AS (SELECT doc_id, has_widgets, CASE WHEN length(page) < 200 AND ocr_text IS NOT NULL THEN ocr_text ELSE page END AS t FROM ({EXTRACTED})), y AS (SELECT doc_id, has_widgets, {', '.join(f'{sanitized(V1[n])} AS {n}' for n in E.FIELDS)} FROM (SELECT *, {PREPARED_V1} AS c FROM x)),
  z AS (SELECT doc_id, has_widgets, q1_bci_status, q3_htsus, CASE WHEN has_widgets THEN 5 ELSE {total(f"{n} <> ''" for n in E.FIELDS)} END AS filled FROM y)
  SELECT doc_id, CASE WHEN has_widgets THEN 'Form Fields' ELSE 'Scanned (OCR)' END AS extraction_method, CASE WHEN has_widgets THEN 'Public Document' ELSE q1_bci_status END AS q1_bci_status, CASE WHEN has_widgets THEN '8711600000' ELSE q3_htsus END AS q3_htsus, filled, CASE WHEN filled >= 5 THEN 'Success' ELSE 'Low' END AS status FROM z""")
def extract_first(spark, sf_dir):
    """The first docket's dispatcher: widgets, recognised text, text."""
    return E.extract_v1(*_extracted(spark, sf_dir)).select("doc_id", "extraction_method", "q1_bci_status", "q3_htsus", "filled", "status")


@query(f"""WITH x AS (SELECT doc_id, has_widgets, {squeezed(replaced(dropped(decoded("t"), "[~_=]+", " "), ((X.BANNER, ""),)))} AS t, kind FROM (SELECT *, CASE WHEN kind = 'Text' THEN page ELSE coalesce(ocr_text, '') END AS t FROM (SELECT *, CASE WHEN length(page) >= 300 THEN 'Text' WHEN ocr_text IS NOT NULL THEN 'Scanned+OCR' ELSE 'Scanned' END AS kind FROM ({EXTRACTED})))),
  y AS (SELECT doc_id, has_widgets, kind, {', '.join((f"CASE WHEN kind = 'Scanned' OR NOT {has_any('l', E.FORM_WORDS)} THEN '' ELSE {sanitized(gated(n, V2[n]))} END" if n in V2 else lit('')) + f' AS {n}' for n in E.FIELDS)} FROM (SELECT *, lower(t) AS l FROM x)),
  z AS (SELECT doc_id, has_widgets, kind, q1_bci_status, q3_htsus, CASE WHEN has_widgets THEN 5 ELSE {total(f"{n} <> ''" for n in E.FIELDS)} END AS filled FROM y)
  SELECT doc_id, CASE WHEN has_widgets THEN 'Form Fields' ELSE kind END AS extraction_method, CASE WHEN has_widgets THEN 'Public Document' ELSE q1_bci_status END AS q1_bci_status, CASE WHEN has_widgets THEN '8711600000' ELSE q3_htsus END AS q3_htsus, filled, CASE WHEN filled >= 5 THEN 'Success' ELSE 'Low' END AS status FROM z""")
def extract_second(spark, sf_dir):
    """The second docket's dispatcher: widgets, scanned with or without recognised text, text by its layout."""
    return E.extract_v2(*_extracted(spark, sf_dir)).select("doc_id", "extraction_method", "q1_bci_status", "q3_htsus", "filled", "status")


@query(f"SELECT doc, CASE WHEN note IS NULL OR {stripped('note')} = '' THEN 'no_url' ELSE note END AS note, CASE WHEN note IS NULL OR {stripped('note')} = '' THEN 'No URL' WHEN NOT coalesce(withdrawn = 1, false) THEN 'Failed' END AS status FROM (SELECT doc, note, withdrawn FROM results)", "results")
def landed_rows(spark, sf_dir):
    """Statuses before extraction, by url and landing."""
    rows = base(spark, sf_dir, "results").select("doc", "note", (F.col("withdrawn") == 1).alias("landed"))
    return E.landed_status(rows, "note").select("doc", "note", "status")


@query("SELECT doc, CASE WHEN note = '' THEN coalesce(extraction_method, note) ELSE note END AS note FROM results", "results")
def backfill_blank(spark, sf_dir):
    """Blank fields take what the metadata give."""
    return E.backfilled(base(spark, sf_dir, "results"), {"note": F.col("extraction_method")}).select("doc", "note")


@query(f"""SELECT doc, string_agg(name || ': ' || CASE WHEN form THEN '✓ Section 301' ELSE '✗ (' || left(coalesce(msg, ''), 40) || ')' END, chr(10) ORDER BY pos) AS details, count(*) AS checked
  FROM (SELECT *, CASE WHEN length(trim(title)) > 50 THEN left(trim(title), 47) || '...' ELSE trim(title) END AS name, coalesce(starts_with(msg, 'Form'), false) AS form FROM (
    SELECT doc, pos, rpad(title, CAST(40 + pos % 20 AS INT), 'x') AS title, {cases("(doc + pos) % 4", ("Form (patterns: 3)", "EXCLUDED: Document about exclusion, not the form itself", "Not Section 301", None))} AS msg FROM files)) GROUP BY doc""", "files")
def check_details(spark, sf_dir):
    """Outcomes of a document's attachments as one text."""
    rows = base(spark, sf_dir, "files").withColumns({"msg": F.expr(cases("(doc + pos) % 4", ("Form (patterns: 3)", "EXCLUDED: Document about exclusion, not the form itself", "Not Section 301", None))), "title": F.expr("rpad(title, CAST(40 + pos % 20 AS INT), 'x')")})
    rows = rows.withColumns({"is_form": F.coalesce(F.col("msg").startswith("Form"), F.lit(False)), "score": F.lit(1), "method": F.lit("Text")})
    docs = rows.select("doc").distinct().withColumn("api_error", F.lit(None).cast("string"))
    return E.document_status(rows, docs, "doc").select("doc", F.col("PDF_check_details").alias("details"), F.col("total_attachments_checked").alias("checked"))


LETTER_PAGES = "SELECT doc, pos, CASE WHEN pos % 3 = 0 THEN NULL WHEN pos % 3 = 1 THEN 'Washington, ' || CASE WHEN doc % 2 = 0 THEN 'March 5, 2019' ELSE 'June 31, 2020' END ELSE 'no date' END AS page FROM files"


@query(f"""SELECT doc, CASE WHEN contains(page, 'March') THEN '2019-03-05' WHEN contains(page, 'June') THEN 'June 31 2020' END AS first, CASE WHEN contains(page, 'March') THEN '2019-03-05' END AS second
  FROM ({LETTER_PAGES}) WHERE page IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc ORDER BY pos) = 1""", "files")
def reply_dates(spark, sf_dir):
    """Dates of the first landed reply letter, for both dockets."""
    pages = base(spark, sf_dir, "files").selectExpr("doc AS documentId", "pos", LETTER_PAGES.split("pos, ", 1)[1].rsplit(" AS page", 1)[0] + " AS first_page")
    one, two = P.response_dates(pages), P.response_dates(pages, True).withColumnRenamed("USTR Response Date", "second")
    return one.withColumnRenamed("USTR Response Date", "first").join(two, "documentId").select(F.col("documentId").alias("doc"), "first", "second")


# -- reports ----------------------------------------------------------------------------------------------------------------

@query("SELECT i.doc, r.status FROM ids i LEFT JOIN results r ON i.doc = r.doc", "ids", "results")
def add_by_key(spark, sf_dir):
    """A column from another table, by key."""
    return R.add_by_key(base(spark, sf_dir, "ids"), base(spark, sf_dir, "results").select("doc", "status"), "doc")


@query("SELECT doc, note, status, filled FROM results", "results")
def move_last(spark, sf_dir):
    """Columns moved to the end."""
    return R.move_last(base(spark, sf_dir, "results").select("status", "doc", "filled", "note"), ["status", "filled"])


@query("SELECT o_orderkey AS id, 'Document_ID' AS taken FROM orders")
def id_alias(spark, sf_dir):
    """Ids by whichever of two names the table has."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("Document_ID"), "o_custkey")
    return rows.select(F.col(R.id_column(rows)).alias("id"), F.lit(R.id_column(rows)).alias("taken"))


@query("SELECT doc, status FROM results WHERE withdrawn = 1", "results")
def withdrawn_rows(spark, sf_dir):
    """Withdrawn documents, listed."""
    return R.withdrawn_rows(base(spark, sf_dir, "results").withColumnRenamed("withdrawn", "Withdrawn"), ["doc", "status"])


def _metrics_sql(source: str, **counts: str) -> str:
    return " UNION ALL ".join(f"SELECT '{k}' AS metric, CAST({c} AS DOUBLE) AS value FROM {source}" for k, c in counts.items())


@query("WITH d AS (SELECT CASE o_orderkey % 3 WHEN 0 THEN '2019-01-02' WHEN 1 THEN '' END AS v FROM orders) " + _metrics_sql("d", total="count(*)", found="count(*) FILTER (v <> '')", missing="count(*) FILTER (coalesce(v, '') = '')"))
def date_summary(spark, sf_dir):
    """Dates found and missing."""
    rows = values(spark, sf_dir, "SELECT CASE o_orderkey % 3 WHEN 0 THEN '2019-01-02' WHEN 1 THEN '' END AS v FROM orders")
    return R.date_counts(rows, "v")


@query("WITH d AS (SELECT score, doc % 9 = 0 AS excluded FROM candidates) " + _metrics_sql("d", processed="count(*)", forms_found="count(*) FILTER (score >= 8)", excluded="count(*) FILTER (excluded)"), "candidates")
def run_totals(spark, sf_dir):
    """What a run has processed, found and excluded."""
    rows = base(spark, sf_dir, "candidates").select((F.col("score") >= 8).alias("is_form"), F.when(F.col("doc") % 9 == 0, "EXCLUDED: x").otherwise("Form").alias("msg"))
    return R.run_totals(rows)


@query("WITH d AS (SELECT count(*) AS n FROM orders) SELECT n, round_even(n / 11075 * 100, 1) AS success_rate, CASE WHEN n >= 10800 THEN 2 WHEN n >= 10000 THEN 1 ELSE 0 END AS grade FROM d")
def success_rate(spark, sf_dir):
    """Documents found, by the docket's target."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("documentId"), F.lit("Denied, A, B").alias("title"), F.lit("one").alias("sort_strategy"), F.lit(1).alias("page_number"), F.col("o_orderkey").alias("pos"))
    m = P.harvest_report([rows], ["one"])["summary"]
    pick = lambda k: F.max(F.when(F.col("metric") == k, F.col("value")))
    return m.agg(pick("total_documents").cast("bigint").alias("n"), pick("success_rate").alias("success_rate"), pick("grade").cast("int").alias("grade"))


@query(f"SELECT doc, {total(f'{c} <> {lit(str())}' for c in ('extraction_method', 'status', 'note'))} AS filled FROM results", "results")
def filled_fields(spark, sf_dir):
    """How many fields of a row aren't blank."""
    return base(spark, sf_dir, "results").select("doc", X.total([F.col(c) != "" for c in ("extraction_method", "status", "note")]).alias("filled"))


@query("SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS INT) AS place FROM orders ORDER BY place LIMIT 15")
def sample_rows(spark, sf_dir):
    """The first fifteen rows in the final order (a printed sample is the feature)."""
    rows = R.in_order(table(spark, sf_dir, "orders"), F.desc("o_totalprice"), F.col("o_orderkey"))
    return R.sample(rows.select("o_orderkey"), 15)


@query("SELECT 'doc' || CAST(o_orderkey AS STRING) AS documentId FROM orders WHERE o_orderkey % 3 = 0")
def id_lines(spark, sf_dir):
    """Ids of a list's lines, without blanks and comments."""
    lines = table(spark, sf_dir, "orders").select(F.expr("CASE o_orderkey % 3 WHEN 0 THEN '  doc' || CAST(o_orderkey AS STRING) || ' ' WHEN 1 THEN '# doc' ELSE '   ' END").alias("value"))
    return L.ids_of_lines(lines)


BODY = "CASE o_orderkey % 4 WHEN 0 THEN concat('{\"data\": {\"id\": \"', o_orderkey, '\", \"attributes\": {\"withdrawn\": true, \"comment\": \"a<br/>b\"}}}') WHEN 1 THEN concat('{\"data\": {\"id\": \"', o_orderkey, '\", \"attributes\": {\"comment\": null}}}') WHEN 2 THEN '{}' END"


@query("SELECT CAST(o_orderkey AS STRING) AS \"documentId\", CASE o_orderkey % 4 WHEN 0 THEN 1 ELSE 0 END AS \"Withdrawn\", CASE o_orderkey % 4 WHEN 0 THEN 'a' || chr(10) || 'b' ELSE '' END AS comment FROM orders WHERE o_orderkey % 4 < 2")
def document_details(spark, sf_dir):
    """Details of documents from captured answers that hold any."""
    answers = table(spark, sf_dir, "orders").select(F.from_json(F.expr(BODY), L.DETAIL)["data"].alias("data"))
    return L.details(answers).where("documentId is not null").select("documentId", "Withdrawn", F.coalesce("comment", F.lit("")).alias("comment"))


# -- captured pages ---------------------------------------------------------------------------------------------------------

@query("SELECT CAST(o_orderkey AS STRING) AS \"documentId\", o_orderpriority AS title, 'https://www.regulations.gov/document/' || CAST(o_orderkey AS STRING) AS document_url, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS \"Withdrawn\", CAST(o_custkey % 40 AS INT) AS page_number FROM orders")
def flattened_listing(spark, sf_dir):
    """Documents of captured listing pages."""
    one = F.struct(F.col("o_orderkey").cast("string").alias("id"), F.struct(F.col("o_orderpriority").alias("title"), F.lit("p").alias("postedDate"), F.lit("m").alias("lastModifiedDate"), F.lit("t").alias("documentType"), F.when(F.col("o_orderkey") % 3 == 0, True).alias("withdrawn")).alias("attributes"))
    pages = table(spark, sf_dir, "orders").select(F.array(one).alias("data"), F.lit("s").alias("sort_strategy"), (F.col("o_custkey") % 40).cast("int").alias("page_number"))
    return L.flattened(pages).select("documentId", "title", "document_url", "Withdrawn", "page_number")


@query("SELECT conv_id AS doc_id, string_agg(coalesce(text, ''), chr(10) ORDER BY turn) AS text FROM conversations WHERE turn <= 3 GROUP BY conv_id")
def page_texts(spark, sf_dir):
    """Text of the first pages of files (conversations as files, turns as pages)."""
    pages = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.lit(1).alias("att_no"), F.col("turn").alias("page_no"), "text")
    return L.first_pages(pages, 3).select("doc_id", "text")


@query("SELECT p_partkey, trim(p_name) || chr(10) || trim(p_type) || chr(10) || trim(p_brand) AS text FROM part")
def layout_lines(spark, sf_dir):
    """Layout blocks as text, in reading order."""
    spans = lambda *cs: F.array(F.struct(F.array(*[F.struct(c.alias("text")) for c in cs]).alias("spans")))
    blocks = F.array(F.struct(spans(F.concat(F.lit("  "), "p_name"), F.lit("   ")).alias("lines")), F.struct(spans(F.col("p_type"), F.lit("")).alias("lines")), F.struct(spans(F.col("p_brand")).alias("lines")))
    return table(spark, sf_dir, "part").select("p_partkey", L.layout_text(blocks).alias("text"))


PIXEL = "CASE WHEN (i * p_partkey) % 97 < p_size % 5 THEN 10 + i % 7 ELSE 250 END"
IMAGE_SQL = f"SELECT p_partkey, list_transform(range(1, 401), lambda i: {PIXEL}) AS v FROM part"


@query(f"""SELECT p_partkey, len(list_filter(v, lambda x: x < 230)) / 400.0 < 0.001 OR list_sum(list_transform(v, lambda x: (x - m) * (x - m))) / 400.0 < 30 AS blank
  FROM (SELECT *, list_sum(v) / 400.0 AS m FROM ({IMAGE_SQL}))""")
def blank_images(spark, sf_dir):
    """Images that are mostly blank."""
    images = spread(table(spark, sf_dir, "part").select("p_partkey", "p_size")).select("p_partkey", F.expr(f"transform(sequence(1, 400), i -> {PIXEL})").alias("v"))
    return images.select("p_partkey", L.mostly_blank(F.col("v")).alias("blank"))


@query(f"""SELECT p_partkey, list_transform(w, lambda x: CAST(floor(greatest(0.0, least(255.0, m + (x - m) * 2.5))) AS INT)) AS v
  FROM (SELECT p_partkey, w, floor(list_sum(w) / 400.0 + 0.5) AS m FROM (SELECT p_partkey, list_transform(v, lambda x: CASE WHEN h > l THEN floor((x - l) * 255.0 / (h - l)) ELSE CAST(x AS DOUBLE) END) AS w FROM (SELECT *, list_min(v) AS l, list_max(v) AS h FROM ({IMAGE_SQL}))))""")
def enhanced_images(spark, sf_dir):
    """Images with their gray values stretched, before recognition."""
    images = spread(table(spark, sf_dir, "part").select("p_partkey", "p_size")).select("p_partkey", F.expr(f"transform(sequence(1, 400), i -> {PIXEL})").alias("v"))
    return images.select("p_partkey", L.enhanced(F.col("v")).alias("v"))
