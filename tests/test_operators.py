"""Golden rows of classifiers, extractors, merges, sources and sinks."""

import pytest
from pyspark.sql import functions as F

from gleaner.functions import codes as K
from gleaner.operators import classify as C
from gleaner.operators import extract as E
from gleaner.operators import relational as R
from gleaner.sources import landing as L
from gleaner.sources import sinks as S
from gleaner.streaming import landing as stream

PAD = " nothing of interest is said in these words" * 2


@pytest.mark.parametrize(("first", "full", "want"), [
    ("short", "short", (False, "Text extraction failed", 0)), (None, None, (False, "Text extraction failed", 0)),
    ("Dear Ambassador" + PAD, "Dear Ambassador" + PAD, (False, "EXCLUDED: Dear letter format", -100)),
    ("We respectfully request, we hereby request, on behalf of x" + PAD, "x\n\n" * 8 + "y" * 3000, (False, "EXCLUDED: Narrative business letter (indicators:3)", -100)),
    ("ACME LLC\n12 Main Street Suite 5\nPhone: 555\nEmail: a@b" + PAD, PAD * 3, (False, "EXCLUDED: Business letterhead (indicators:4)", -100)),
    ("exclusion would undermine" + PAD * 20, PAD * 3, (False, "EXCLUDED: Document about exclusion, not the form itself", -100)),
    ("indicate whether, provide any, indicate the version" + PAD, "version" + PAD, (True, "Form (patterns: 1)", 10)),
    ("indicate whether, provide any, indicate the" + PAD, "VERSION CONTINUED BCI Requestor Name Organization Name Section 301 Form to Request Exclusion China Acts" + PAD, (True, "Form (patterns: 8)", 130)),
    ("x" + PAD, "Public Document of Smith, John of Acme Inc 8711600000 8711600001 " + "z" * 2000, (True, "Scrambled (HTSUS: 8711600000)", 31)),
    ("x" + PAD, "China Acts 8711600000 " + "z" * 2000, (True, "Minimal (HTSUS: 8711600000)", 17)),
    ("x" + PAD, "z" * 2100, (False, "Not Section 301", 0)),
])
def test_detect(spark, first, full, want):
    df = spark.createDataFrame([(1, first, full, "kept")], "id int, first2 string, full string, msg2 string")
    row = C.detect(df).first()
    assert (row.is_form, row.msg, row.score) == want and row.msg2 == "kept"


def flag(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first().x


def test_second_docket_kinds(spark):
    t = F.col("t")
    letter = "Item: 00208CA 8 Thermometer HTS subheading: 9025.19.8080 by Primex"
    assert flag(spark, C.new_pattern(t), t=letter)
    assert not flag(spark, C.new_pattern(t), t="plain") and not flag(spark, C.new_pattern(t), t=None)
    assert flag(spark, C.response_letter(t), t="The purpose of this  letter is to inform you")
    assert flag(spark, C.cover_letter(t, t), t="Dear Ambassador X")
    assert not flag(spark, C.cover_letter(t, t), t="Dear Ambassador X: requestor information, product description, organization name, 2015 value")
    assert not flag(spark, C.cover_letter(t, t), t=letter + " Dear Ambassador")
    assert flag(spark, C.product_attachment(t), t="Attachment A - Slush Drape") and not flag(spark, C.product_attachment(t), t="x" * 700)
    assert flag(spark, C.wrong_type(t, t, t), t="Dear Ambassador X") and not flag(spark, C.wrong_type(t, t, t), t=letter)
    assert flag(spark, C.rescue_score(t), t="2015 value and 2016 value" + "x" * 200) == 10 and flag(spark, C.rescue_score(t), t="2015 value" + "x" * 200) is None


def test_metadata(spark):
    df = spark.createDataFrame([(["Re_1", " 3917290090 ECM FLX-3410B P "], ""), (["x"], C.NEW_PATTERN_COMMENTS["Primex"] + " 9025198080"), ([], None)], "titles array<string>, comment string")
    rows = df.select(C.new_pattern_by_metadata(F.col("titles"), F.col("comment")).alias("n"), C.metadata_fields(F.col("titles"), F.col("comment")).alias("m")).collect()
    assert [r.n for r in rows] == [True, True, False]
    assert (rows[0].m.q3_htsus, rows[0].m.q2_product_description, rows[0].m.q4_organization, rows[0].m.place) == ("3917290090", "FLX-3410B", "ECM Industries LLC", 1)
    assert (rows[1].m.q3_htsus, rows[1].m.q4_requestor_name, rows[1].m.place) == ("9025198080", "Primex", None)


def test_layout_score(spark):
    df = spark.createDataFrame([(["HTS", "bci"], 25, ""), ([], 25, "x"), ([], 25, "x" * 500), (None, 3, None)], "names array<string>, n int, t string")
    assert [r.x for r in df.select(C.layout_score(F.col("names"), F.col("n"), F.col("t")).alias("x")).collect()] == [85, 0, 50, 0]


def test_widgets(spark):
    rows = [("a", 1, 1, "BCI", "p"), ("a", 1, 2, "hts", "8711.60.00"), ("a", 2, 1, "bci", "PV"), ("a", 2, 2, "HTSUS", "12"), ("a", 2, 3, "2015value", "$1,0"), ("b", 1, 1, "comments", "Off"), ("b", 1, 2, None, None)]
    got = {r.doc_id: r for r in E.from_widgets(spark.createDataFrame(rows, L.WIDGETS)).collect()}
    assert (got["a"].q1_bci_status, got["a"].q3_htsus, got["a"].q10_2015_value) == ("Public Version of BCI", "8711600000", "10")
    assert got["b"].q11_supporting_info is None


def test_extract_both_dockets(spark):
    form = "1. Public Document 2. Please provide x concern: a long description of a forged and polished machine part of steel 3. 10-digit 8711600000 4. Requestor Information Name: Smith John\nOrganization Name: Acme Corp\n6. YES 7. P 8. NO 9. N/A 10. 2015 Value: 5 Million\n" + "word " * 60
    letter = "Primex Family of Companies hereby submits. Item: 12A Thermometer HTS subheading: 9025.19.8080 not available in the U.S. " + "word " * 60
    docs = spark.createDataFrame([("w", [form], form, None), ("t", [form], form, None), ("s", ["x"], "x", form), ("n", ["x"], "x", None), ("l", [letter], letter, None)], "doc_id string, pages array<string>, raw_text string, ocr_text string")
    widgets = spark.createDataFrame([("w", 1, 1, "bci", "P")], L.WIDGETS)
    one = {r.doc_id: r for r in E.extract_v1(docs, widgets).collect()}
    assert (one["w"].extraction_method, one["w"].filled, one["w"].status) == ("Form Fields", 1, "Low")
    assert (one["t"].extraction_method, one["t"].status, one["t"].q10_2015_value, one["t"].q4_organization) == ("Scanned (OCR)", "Success", "5000000", "Acme Corp")
    assert one["s"].q3_htsus == "8711600000" and one["n"].filled == 0
    two = {r.doc_id: r for r in E.extract_v2(docs, widgets).collect()}
    assert [two[k].extraction_method for k in "wtsnl"] == ["Form Fields", "Text", "Scanned+OCR", "Scanned", "Text"]
    assert two["t"].q6_attachments == "YES" and two["t"].q3_htsus == "8711600000" and two["l"].extraction_method == "Text"
    fields = docs.where("doc_id = 'l'").select(*[c.alias(f) for f, c in E.completed(E.from_letter(F.col("raw_text"))).items()]).first()
    assert (fields.q3_htsus, fields.q4_requestor_name, fields.q8_us_sources) == ("9025198080", "Primex Family of Companies", "NO")


def test_union_of_scans_keeps_last_row_of_first_scan(spark):
    a = spark.createDataFrame([("X", 1), ("Y", 2), ("X", 30)], "id string, pos int")
    b = spark.createDataFrame([("X", 1), ("Z", 2), ("Z", 3)], "id string, pos int")
    got = {r.id: (r.strategy, r.pos, r.first_seen) for r in R.union_scans([a, b], "id").collect()}
    assert got == {"X": (1, 30, 1), "Y": (1, 2, 2), "Z": (2, 2, 2)}


def test_candidates(spark):
    rows = [("a", 1, 5, 3), ("a", 2, 9, 4), ("a", 3, 9, 6), ("a", 4, 1, 9), ("b", 1, 1, 3), ("b", 2, 1, 3), ("b", 3, 1, 2)]
    df = spark.createDataFrame(rows, "doc string, pos int, score int, filled int")
    assert {r.doc: r.pos for r in R.best_candidate(df, "doc", "score", "pos").collect()} == {"a": 2, "b": 1}
    assert {r.doc: r.pos for r in R.repick(df, "doc", "pos", "filled").collect()} == {"a": 3, "b": 1}


def test_merges(spark):
    ids = spark.createDataFrame([("a",), ("b",)], "id string")
    res = spark.createDataFrame([("a", None)], "id string, w int")
    assert {r.id: r.w for r in R.merge_with_default(ids, res, "id", {"w": 7}).collect()} == {"a": None, "b": 7}
    assert [r.id for r in R.merge_present(ids, res, "id").collect()] == ["a"]
    assert {r.id: (r.w, r.cached) for r in R.cache_lookup(ids, res, "id", "w").collect()} == {"a": (None, True), "b": (None, False)}
    assert not any(r.cached for r in R.cache_lookup(ids, res, "id", "w", retry_null=True).collect())


def test_status_notes_and_fills(spark):
    df = spark.createDataFrame([("Low", 1, "u"), ("Scanned", 1, "u"), ("API error", 0, "")], "status string, w int, url string")
    rows = df.select(E.result_status(F.col("status"), F.col("w")).alias("s"), E.result_notes(F.col("status"), F.col("url"), F.lit(None)).alias("n"), R.fill_sibling(F.col("status"), F.col("w")).alias("f"), E.status_notes(F.col("status"), F.lit("why"), F.col("url")).alias("m")).collect()
    assert [tuple(r) for r in rows] == [("withdrawn", "Scanned", "FFFF00", ""), ("withdrawn", "", "FFFF00", "Scanned"), ("API error", "PDF not present", "E8E8E8", "why")]


def test_listing_source_pages_until_a_short_one(spark):
    def fetch(sort, page, size):
        n = 2 if page < 3 else 1
        return 200, {"data": [{"id": f"{sort}-{page}-{i}", "attributes": {"title": "t"}} for i in range(n)]}

    spark.dataSource.register(L.listing_source(fetch))
    df = spark.read.format("listing").option("sorts", "x,-x").option("pageSize", 2).option("delay", 0).load()
    assert sorted(r.id for r in df.collect()) == sorted(f"{s}-{p}-{i}" for s in ("x", "-x") for p, i in ((1, 0), (1, 1), (2, 0), (2, 1), (3, 0)))


def test_listing_is_complete_or_an_error():
    def fetch(sort, page, size):
        return (500, None) if page == bad else (200, {"data": [{"id": f"{page}-{i}"} for i in range(min(size, 5 - (page - 1) * size))], "meta": {"totalElements": 5}})

    bad = 0
    reader = L.ListingReader({"pagesize": 2, "delay": 0, "wait": 0, "pagespertask": 1}, fetch)
    parts = reader.partitions()
    assert [(p.first, p.last) for p in parts] == [(1, 1), (2, 2), (3, 3)] and [r[0] for p in parts for r in reader.read(p)] == ["1-0", "1-1", "2-0", "2-1", "3-0"]
    bad = 2
    with pytest.raises(L.Unanswered):
        list(reader.read(parts[1]))


def test_acceptable_pdfs(spark):
    rows = [(2000, "application/pdf", b"%PDF-1.7"), (2000, None, b"%PDF"), (2000, "text/html", b"%PDF"), (900, "application/pdf", b"%PDF"), (2000, "", b"<html>"), (2000, "", None)]
    df = spark.createDataFrame(rows, "n int, kind string, head binary")
    assert [r.ok for r in df.select(L.acceptable_pdf(F.col("n"), F.col("kind"), F.col("head")).alias("ok")).collect()] == [True, True, False, False, False, False]


def test_throttle_waits_longer_and_gives_up():
    waits, answers = [], iter([(429, None), (429, None), (200, {"a": 1})])
    assert L.Throttle(0, wait=60, sleep=waits.append).call(lambda: next(answers)) == {"a": 1}
    assert [w for w in waits if w >= 60] == [60, 120]
    assert L.Throttle(0, sleep=waits.append).call(lambda: (500, None)) is None


def test_captured_listing_details_ids_and_pages(spark, tmp_path):
    (tmp_path / "l.json").write_text('{"data":[{"id":"A","attributes":{"title":"t","withdrawn":true}},{"id":"B","attributes":{}}],"meta":{"totalElements":2},"sort_strategy":"s","page_number":1}\n')
    assert [(r.documentId, r.title, r.Withdrawn, r.pos) for r in L.flattened(L.read_listing(spark, str(tmp_path / "l.json"))).collect()] == [("A", "t", 1, 0), ("B", "", 0, 1)]
    (tmp_path / "ids.txt").write_text("a\n\n# no\n  b \n # kept\n")
    assert [r.documentId for r in L.read_ids(spark, str(tmp_path / "ids.txt")).collect()] == ["a", "b", "# kept"]
    detail = spark.createDataFrame([((("A", (None, None, True, "x<br>y"))),), (None,)], f"{L.DETAIL}")
    assert [(r.Withdrawn, r.comment) for r in L.details(detail).collect()] == [(1, "x\ny"), (None, "")]
    pages = spark.createDataFrame([("d", 1, 2, "two"), ("d", 1, 1, "one"), ("d", 1, 3, "three")], L.PAGES)
    assert L.first_pages(pages, 2).first().text == "one\ntwo"


def test_files_and_progress(spark, tmp_path):
    folder = f"file://{tmp_path}/files"
    S.write_files(spark.createDataFrame([("a.txt", bytearray(b"x")), (None, bytearray(b"y"))], "file_name string, content binary"), folder)
    files = L.read_files(spark, folder).collect()
    assert [bytes(r.content) for r in files] == [b"x"]
    path, schema = f"{tmp_path}/progress", "id string, w int"
    assert S.read_progress(spark, path, schema).count() == 0
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    for _ in range(2):  # a second run finds nothing to do
        todo = R.cache_lookup(ids, S.read_progress(spark, path, schema), "id", "w").where("not cached").select("id", F.lit(1).alias("w"))
        if todo.count():
            S.append_progress(todo, path)
    assert S.read_progress(spark, path, schema).count() == 3
    S.clear_progress(spark, path)
    assert S.read_progress(spark, path, schema).count() == 0


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([("Denied",)] * 3 + [("Approved",)] + [(None,)] * 4, "d string")
    assert {r.d: (r.n, r.percentage) for r in R.breakdown(df, "d").collect()} == {"Denied": (3, 37.5), "Approved": (1, 12.5)}
    S.write_report({"data": df, "decisions": R.breakdown(df, "d")}, str(tmp_path / "report"), "csv")
    assert spark.read.option("header", "true").csv(str(tmp_path / "report/decisions")).count() == 2


def test_landing_stream_takes_each_file_once(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    run = lambda: stream.process_new(spark, src, "id long", lambda d: d.withColumn("x", F.col("id") * 2), out, f"{tmp_path}/ck")
    spark.range(3).write.parquet(src)
    run()
    run()
    spark.range(3, 5).write.mode("append").parquet(src)
    run()
    assert sorted(r.x for r in spark.read.parquet(out).collect()) == [0, 2, 4, 6, 8]


def test_detector_cleans_a_text_once(spark):
    """The optimizer must not copy a cleaning step into its uses: each would clean the text anew."""
    df = spark.createDataFrame([(1, "a", "b")], "id int, first2 string, full string")
    plan = C.detect(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"[\x00-\x1f\x7f-\x9f]") <= 2 and plan.count(r"\(cid:[0-9]+\)") <= 2
    garbled = "vveerrssiioonn" * 10 + "\x07" + "7&34*0/" + "(cid:72)" * 12
    rows = C.clean_texts(spark.createDataFrame([(garbled, garbled), (garbled, "aabcd"), ("aabcd", garbled), ("", "")], "a string, b string"), "a", "b").select("_cf", "_cl").collect()
    assert rows[0]._cf == rows[0]._cl == "version" * 10 + " VERSIONH" and (rows[1]._cf, rows[1]._cl) == (rows[0]._cf, "abcd")
    assert rows[2]._cf == "aabcd" and rows[2]._cl == "vveerrssiioonn" * 10 + " VERSION" + "H" * 12 and rows[3]._cf == rows[3]._cl == ""


def test_codes_in_every_way_to_write_them(spark):
    text = "a 8711600000 b 8711.60.00.01 c 8711 60 00 02 d 8711.60.0003 e HTS: 87116004 f HTSUS#8711 60 0005x"
    alone = {w: flag(spark, K.codes(F.col("t")), t=w) for w in ("8711600000", "8711.60.00.01", "8711 60 00 02", "8711.60.0003", "HTS: 87116004", "HTSUS#8711 60.0005x", "8711 6", "1234")}
    assert [v for v in alone.values()] == [["8711600000"], ["8711600001"], ["8711600002"], ["8711600003"], ["87116004"], ["8711600005"], [], []]
    assert flag(spark, K.codes(F.col("t")), t=text) == sorted(v[0] for v in list(alone.values())[:6])
