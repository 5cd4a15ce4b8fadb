"""Golden rows of the scalar functions, quirks included."""

import time

import pytest
from pyspark.sql import functions as F

from gleaner.functions import codes as K
from gleaner.functions import text as X
from gleaner.functions import titles as T


def one(spark, f, *values):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"v{i} string" for i in range(len(values))))
    return df.select(f(*[F.col(f"v{i}") for i in range(len(values))]).alias("x")).first()["x"]


@pytest.mark.parametrize(("title", "want"), [
    ("Exclusion Denied, Acme Corp, steel ring, HTSUS 1234567890", ("Exclusion Denied", "Acme Corp", "steel ring", "1234567890")),
    ("Exclusion Denied - Acme, ring", ("Exclusion Denied", "ring", None, None)),
    ("Exclusion Granted", ("Exclusion Granted", None, None, None)),
    ("", (None, None, None, None)), (None, (None, None, None, None)), ("   ", (None, "", None, None)),
    ("acme, x,y , HTS12345678", (None, "acme", "x, y", "12345678")),
])
def test_title(spark, title, want):
    assert tuple(one(spark, T.parse_title, title)) == want


@pytest.mark.parametrize(("decision", "want"), [("Exclusion Partially Granted", "Partially Approved"), ("Exclusion Request Withdrawn", "Withdrawn"), ("denied", "Denied"), ("granted", "Approved"), ("on hold", "On Hold"), ("", None), (None, None)])
def test_decision(spark, decision, want):
    assert one(spark, T.normalize_decision, decision) == want


@pytest.mark.parametrize(("f", "value", "want"), [
    (X.bci_status, "pv", "Public Version of BCI"), (X.bci_status, " b ", "BCI"), (X.bci_status, "public version x", "Public Version of BCI"), (X.bci_status, " other ", " other "), (X.bci_status, None, ""),
    (X.yes_no, "y e s", "YES"), (X.yes_no, "off", "NO"), (X.yes_no, "na", "N/A"), (X.yes_no, "maybe", "maybe"), (X.yes_no, "", ""),
    (K.padded_code, "8711.60.00", "8711600000"), (K.padded_code, "1234567", None), (K.money, "$1,234.50", "1234.50"),
    (lambda c: K.scaled_value(c, "2015"), "2015 Value: $2.5 Million", "2500000"), (lambda c: K.scaled_value(c, "2015"), "2015 Value: 7 Thousand", "7"), (lambda c: K.scaled_value(c, "2015"), "2015 Value: 1.2.3 Million", "1.2.3"), (lambda c: K.scaled_value(c, "2016"), "2015 Value: 1", None),
    (K.letter_date, "September 26, 2019", "2019-09-26"), (K.letter_date, "february 4 2019", None), (K.letter_date, "February 31, 2019", "February 31 2019"), (lambda c: K.letter_date(c, True), "February 31, 2019", None), (K.letter_date, "x" * 1000 + "May 1, 2019", None), (K.letter_date, None, None),
    (X.collapse_runs, "aabbcc", "abc"), (X.doubled_count, "aabbcc", 3), (X.is_doubled, "aabbcc", True), (X.is_doubled, "abcabc", False),
    (X.shorten, "x" * 51, "x" * 47 + "..."), (X.shorten, "x" * 50, "x" * 50),
    (X.sanitize, "\x00a\tb\x85 ", "a\tb"), (X.sanitize, None, ""),
    (X.repair_v1, "|. Acme ln_c; x", "Acme Inc x"), (X.repair_v1, "a.b-c", "abc"), (X.repair_v2, "I- Acme ln_c. x", "Acme Inc. x"), (X.repair_v2, "a__ b", "a"),
    (X.decode_garbled, "3FRVFTUPS/BNF", "3FRVFTUPS/BNF"), (X.decode_garbled, "3FRVFTUPS/BNF" + " " * 50, "Requestor Name" + " " * 50),
    (X.decode_cid, "(cid:72)" * 9, "(cid:72)" * 9), (X.decode_cid, "(cid:72)" * 9 + "(cid:7)y(cid:300)", "H" * 9 + " y "), (X.decode_cid, "x" + "".join(f"(cid:{n})" for n in (52, 70, 68, 85, 74, 80, 79)) + "(cid:65)" * 3, "xSECTIONAAA"),
    (X.breaks_to_newlines, "a<br>b<BR />c", "a\nb\nc"), (X.prepare_v1, "a ~~ b\n\nc", "a b c"),
    (lambda c: X.section(c, 6), "1. 6. YES 7. x", "6. YES "), (lambda c: X.section(c, 6), "7. a 6. b", ""), (lambda c: X.section(c, 6), "nothing", ""), (lambda c: X.section(c, 6), "6." + "x" * 700, "6." + "x" * 598),
    (X.section_answer, "NO YES", "YES"), (X.section_answer, "NO", "NO"), (X.section_answer, "N/A", "N/A"), (X.section_answer, "no", None),
    (X.first_score, "about 250 of 1000", 100), (X.first_score, "none", None), (lambda c: F.try_element_at(X.json_object(c), F.lit("a")), 'so: {"a": "b"} ok', "b"),
    (K.first_code, "1023456789 then 8711600000", "8711600000"), (K.dotted_code, "see 8711.60.0000", "8711600000"), (K.dotted_code, "see 8711.60.00.5", None), (K.dotted_code, "8711.60.00.05", "8711600005"),
    (K.codes, "HTS 8711.60.00.00 and 1234567890", ["87116000", "8711600000"]), (K.codes, "8711.60.00.00", ["8711600000"]), (K.codes, None, []), (lambda c: K.title_code(c)["item"], "3917290090 ECM FLX-3410B P", "FLX-3410B"), (lambda c: K.title_code(c)["item"], "x", None),
])
def test_scalar(spark, f, value, want):
    assert one(spark, f, value) == want


def test_file_name(spark):
    assert one(spark, K.file_name, "Employment", "July 2023", "1") == "employment_202307_1.txt"
    assert one(spark, K.file_name, "Employment", "Foo 2023", "1") is None
    assert one(spark, K.file_name, "Employment", "2023", "1") is None


def test_similarity(spark):
    assert one(spark, X.similarity, "requestor", "requester") == pytest.approx(8 / 9)


@pytest.mark.parametrize(("title", "material"), [
    ("Denied, Acme, pump, HTS 12345678", "pump"), ("Denied, Acme, pump HTSUS12345678", "pump"), ("Denied, Acme, HTS 12345678", None), ("Denied, Acme, a, , HTS 12345678", "a,"),
    ("Denied, Acme, HTS 12345678, b", "HTS 12345678, b"), ("Denied, Acme, a,", "a,"), ("Denied, Acme,", None), ("Denied, Acme", None), ("Acme, a, xHTS 12345678 ", "a, x"), (None, None),
])
def test_material_of_titles(spark, title, material):
    assert spark.createDataFrame([(title,)], "t string").select(T.parse_title(F.col("t")).alias("p")).first().p.material == material


@pytest.mark.parametrize("title", ["Denied, Acme, a{}b, HTS 12345678", "Denied, Acme, a{}b HTS 12345678"])
def test_titles_with_long_runs_of_blanks_take_time_by_their_length(spark, title):
    began = time.monotonic()
    found = spark.createDataFrame([(title.format(" " * 400_000),)], "t string").select(T.parse_title(F.col("t")).alias("p")).first().p
    assert found.material == f"a{' ' * 400_000}b" and found.hts == "12345678" and time.monotonic() - began < 20
