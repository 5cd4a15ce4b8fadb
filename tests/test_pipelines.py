"""The harvests end to end on small tables."""

import numpy as np
from pyspark.sql import functions as F

from gleaner.operators import classify as C
from gleaner.operators import extract as E
from gleaner.plans import pipelines as P
from gleaner.sources import landing as L
from gleaner.sources import rasters
from gleaner.sources.config import Config

FORM = "1. Public Document\n2. Please provide the concern: a long description of a forged and polished machine part made of steel\n3. 10-digit 8711600000\n4. Requestor Information Name: Smith John\nOrganization Name: Acme Corp\n6. YES 7. P 8. NO 9. N/A 10. 2015 Value: 5\nVERSION CONTINUED BCI Section 301 " + "word " * 50


def test_harvest_report(spark):
    rows = [("A", "Exclusion Denied, Acme, ring, HTSUS 1234567890", "s1", 1, 0), ("B", "granted, X, y", "s1", 1, 1)]
    scans = [spark.createDataFrame(r, "documentId string, title string, sort_strategy string, page_number int, pos int") for r in (rows, [(*rows[1][:2], "s2", 1, 0), ("C", "?", "s2", 1, 1)])]
    sheets = P.harvest_report(scans, ["s1", "s2"], 4)
    assert {r.documentId: r.decision_normalized for r in sheets["data"].collect()} == {"A": "Denied", "B": "Approved", "C": None}
    assert {r.metric: r.value for r in sheets["summary"].collect()} == {"total_documents": 3, "target_documents": 4, "success_rate": 75.0, "grade": 0}
    assert [(r.name, r.new, r.total) for r in sheets["new_per_strategy"].orderBy("strategy").collect()] == [("s1", 2, 2), ("s2", 1, 3)]
    assert {r.sort_strategy: r.Documents_Found for r in sheets["strategies"].collect()} == {"s1": 2, "s2": 1}


def test_first_docket(spark):
    def att(title, url, size):
        return (url, (title, [("docx", "no", 1), ("pdf", url, size)]))

    docs = spark.createDataFrame([("A", "2019"), ("B", "2020")], "documentId string, `Other Date` string")
    listed = spark.createDataFrame([("A", [att("Re_x", "u0", 9000), att("letter", "u1", 9000), att("form", "u2", 9000), att("tiny", "u3", 10)])], f"doc_id string, attachments {L.ATTACHMENT}")
    pages = spark.createDataFrame([("A", 2, 1, "Dear Ambassador " + "x " * 60), ("A", 3, 2, "end"), ("A", 3, 1, FORM), ("A", 4, 1, FORM)], L.PAGES)
    chosen = P.choose_forms(docs, listed, pages)
    assert {r.documentId: r.attachment_url for r in chosen.collect()} == {"A": "u2", "B": None}
    letters = spark.createDataFrame([("A", 1, None), ("A", 2, "Washington May 1, 2019"), ("A", 3, "June 1, 2019")], "documentId string, pos int, first_page string")
    details = spark.createDataFrame([("A", 1), ("B", None)], "documentId string, Withdrawn int")
    rows = {r.documentId: r for r in P.enriched(chosen, P.response_dates(letters), details).collect()}
    assert rows["A"]["USTR Response Date"] == "2019-05-01" and rows["A"].Withdrawn == 1 and "Other Date" not in rows["A"]
    ready = spark.createDataFrame([("A", "A", "u2", True, [FORM], None, 1), ("B", "B", None, False, None, None, None), ("C", "C", "u", False, None, None, 0)], "documentId string, doc_id string, attachment_url string, landed boolean, pages array<string>, ocr_text string, Withdrawn int")
    sheets = P.fields_report(ready, spark.createDataFrame([], L.WIDGETS))
    got = {r.documentId: r for r in sheets["data"].collect()}
    assert [got[k].status for k in "ABC"] == ["Success", "No URL", "Failed"] and got["A"].q4_organization == "Acme Corp" and got["A"].cell_fill == "FF0000"
    assert {r.metric: r.value for r in sheets["summary"].collect()}["no_url"] == 1


def test_recognised_text_takes_the_place_of_too_little(spark):
    pages = spark.createDataFrame([("A", 1, 1, "x"), ("A", 2, 1, FORM), ("A", 2, 2, None), ("A", 2, 3, "third")], L.PAGES)
    assert [tuple(r) for r in P.needs_ocr(pages).collect()] == [("A", 1)]
    ocr = spark.createDataFrame([("A", 1, "\n".join(f"line {i}" for i in range(150))), ("A", 2, "unused"), ("A", 3, "no pages")], "doc_id string, att_no int, ocr_text string")
    got = {r.pos: (r.first2, r.full) for r in P.file_texts(pages, ocr).collect()}
    assert got[1][0].split("\n")[-1] == "line 99" and got[1][1].endswith("line 149")
    assert got[2] == (FORM + "\n\n", FORM + "\n\nthird\n") and got[3] == ("no pages", "no pages")
    assert {r.pos: r.full for r in P.file_texts(pages, ocr, Config(ocr_least_text=1)).collect()}[1] == "x\n"


def test_second_docket_is_incremental(spark):
    ids = spark.createDataFrame([(x,) for x in "ABCDEF"], "documentId string")
    info = spark.createDataFrame([("A", "d/A", "p", "m", 0, None), ("B", "d/B", "p", "m", 1, None), ("C", "d/C", "p", "m", 0, "too large to attach"), ("D", "d/D", "p", "m", 0, ""), ("E", "d/E", "p", "m", 0, "")], "documentId string, `Document URL` string, `Posted Date` string, `Last Modified Date` string, Withdrawn int, comment string")
    letter = "Dear Ambassador, we write. " + "words of a letter " * 20
    files = spark.createDataFrame(
        [("A", 1, "a1", "form", [FORM], FORM, None, 60), ("B", 1, "b1", "letter", [letter], letter, None, 60), ("B", 2, "b2", "form", [FORM], FORM, None, 50), ("C", 1, "c1", "form", [FORM], FORM, None, 60), ("D", 1, "d1", "3917290090 ECM FLX-3410B P", ["x"], "x", None, 0), ("E", 1, "e1", "Re_x", [FORM], FORM, None, 60)],
        "documentId string, pos int, url string, title string, pages array<string>, raw_text string, ocr_text string, score int",
    )
    existing = spark.createDataFrame([("F", "Form Fields", "Success"), ("A", "Text", "Low")], "documentId string, extraction_method string, status string")
    dates = spark.createDataFrame([("A", "2019-05-01")], "documentId string, `USTR Response Date` string")
    got = {r.documentId: r for r in P.second_docket(ids, existing, info, files, spark.createDataFrame([], L.WIDGETS), dates).collect()}
    assert set(got) == set("ABCDEF") and list(got["A"].asDict()) == list(P.FINAL)
    assert (got["A"].status, got["A"].attachment_url, got["A"].q3_htsus, got["A"]["USTR Response Date"]) == ("Success", "a1", "8711600000", "2019-05-01")
    assert (got["B"].status, got["B"].attachment_url) == ("withdrawn", "b2")
    assert (got["C"].status, got["C"].Notes, got["E"].status) == ("pdf not present", "PDF not present", "pdf not present")
    assert (got["D"].status, got["D"].extraction_method, got["D"].q3_htsus, got["D"].filled) == ("new pattern", "Metadata", "3917290090", 4)
    assert got["F"].extraction_method == "Form Fields"
    sheets = P.second_docket_report(spark.createDataFrame([tuple(got[k]) for k in got], P_SCHEMA))
    assert {r.metric: r.value for r in sheets["summary"].collect()}["not_present"] == 2


P_SCHEMA = ", ".join(f"`{c}` {'int' if c in ('Withdrawn', 'filled', 'form_match_score') else 'string'}" for c in P.FINAL)


def test_rules_only_docket(spark):
    ids = spark.createDataFrame([("A",), ("B",), ("C",)], "documentId string")
    existing = spark.createDataFrame([("B", "Form Fields", "Success", "p", 1), ("A", "Text", "x", " ", None)], "documentId string, extraction_method string, status string, `Posted Date` string, Withdrawn int")
    atts = spark.createDataFrame([("A", 1, "u1", "x" * 60, True, "Form (patterns: 1)", 10, "Text"), ("A", 2, "u2", "", False, "Not Section 301", 0, None)], "doc_id string, pos int, url string, title string, is_form boolean, msg string, score int, method string")
    docs = spark.createDataFrame([("A", None), ("B", None)], "doc_id string, api_error string")
    got = {r.documentId: r for r in P.rules_only_docket(ids, existing, atts, docs).collect()}
    assert (got["A"].status, got["A"].Notes, got["A"].attachment_url) == ("Scanned", "Scanned", "u1") and got["A"].PDF_check_details.split("\n")[1] == "u2: ✗ (Not Section 301)"
    assert (got["B"].extraction_method, got["C"].status, got["C"].Notes) == ("Form Fields", "pdf not present", "PDF not present")


def test_form_score_cascade(spark):
    df = spark.createDataFrame([(FORM, 0, None, None), ("Dear Ambassador", 60, None, None), ("x", 60, None, None), ("x", 0, "2015 value 2016 value", None), ("x", 0, None, 77)], "t string, layout int, ocr string, v int")
    t = F.col("t")
    assert [r.s for r in df.select(P.form_score(t, t, t, F.col("layout"), F.col("ocr"), F.col("v")).alias("s")).collect()] == [20, 0, 60, 10, 77]


def test_download_cards(spark):
    card = "<h3>Federal Employment Raw Data (July 2023)</h3><p>Version: 2</p><b>Current</b>"
    pages = spark.createDataFrame([("e", 1, card), ("e", 2, ""), ("e", 3, card.replace("July", "May")), ("e", 4, ""), ("e", 5, ""), ("e", 6, card.replace("July", "June"))], "folder string, page_no int, html string")
    files = spark.createDataFrame([("employment_202305_2.txt",)], "file_name string")
    assert [r.file_name for r in P.download_cards(pages, files).collect()] == ["employment_202307_2.txt"]


def test_config_and_template(tmp_path):
    assert Config.load(str(tmp_path / "none.json")) == Config()
    Config(form_score=9).save(str(tmp_path / "c.json"))
    assert Config.load(str(tmp_path / "c.json")).form_score == 9
    assert C.FORM_SCORE == 8 and E.ENOUGH == 5


def test_images_are_prepared_searched_and_read(spark):
    rng = np.random.default_rng(1)
    logo = np.kron(rng.integers(0, 2, (10, 8)) * 255, np.ones((4, 4), int))  # 40 by 32
    page = np.full((120, 90), 255)
    page[60:100, 50:82] = logo
    larger = np.full((120, 90), 200)
    larger[5:55, 3:43] = rasters.resized(logo, 1.25)
    noise = rng.integers(0, 255, (120, 90))
    rows = [("a", 1, page), ("b", 1, larger), ("c", 1, noise), ("d", 2, page), ("e", 1, np.full((120, 90), 7)), ("f", 1, page[:10, :10])]
    images = spark.createDataFrame([(k, n, p.ravel().tolist(), p.shape[1]) for k, n, p in rows] + [("g", 1, None, None)], "path string, page_no int, pixels array<int>, width int")
    assert {r.path for r in rasters.holding(images, logo, "path").where("found").collect()} == {"a", "b", "d"}
    own = {r.path: r.pixels for r in rasters.prepared(images.where("path in ('c', 'e')"), 1.0).collect()}
    flat, cut = np.sort(noise.ravel()), noise.size // 100
    low, high = flat[cut], flat[-1 - cut]
    want = np.clip((noise.ravel() * (255.0 / (high - low)) - low * (255.0 / (high - low))).astype(int), 0, 255)
    assert own["c"] == np.where(want < 170, 0, 255).tolist() and set(own["e"]) == {0}

    def recognise(array):
        assert set(np.unique(array)) <= {0, 255}
        return "2015 value 2016 value" if array.shape == (120, 90) else 1 / 0

    text = F.lit("x").alias("text"), F.lit("x").alias("text2"), F.lit("x").alias("text5"), F.lit(0).alias("layout")
    got = {r.path: (r.vision, r.ocr_text, r.form_score) for r in P.scored_files(images.select("path", *text).distinct(), images, template=logo, recognise=recognise).collect()}
    assert got["a"] == got["b"] == (100, None, 100) and got["c"] == (None, "2015 value 2016 value\n", 10) and got["f"] == (None, "\n", 0)
    assert P.scored_files(images.select("path", *text).distinct(), images).count() == 7
