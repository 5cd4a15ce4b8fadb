"""Tariff codes, money, dates and file names as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import found, let, squeeze, strip

#: How codes are written, and codes that are only examples.
CODE_PATTERNS = ((r"(?iU)\b\d{10}\b", 0), (r"(?iU)\b\d{4}\.\d{2}\.\d{2}\.\d{2}\b", 0), (r"(?iU)\b\d{4}\s\d{2}\s\d{2}\s\d{2}\b", 0), (r"(?iU)\b\d{4}\.\d{2}\.\d{4}\b", 0), (r"(?iU)(?:HTSUS|HTS)[\s:#]*(\d{4}[.\s]?\d{2}[.\s]?\d{2,4})", 1))
DUMMIES = ("1234567890", "0000000000", "1111111111", "1023456789")
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
DATE = r"(?U)(January|February|March|April|May|June|July|August|September|October|November|December)\s+(\d{1,2}),?\s+(\d{4})"


def codes(text: Column) -> Column:
    """Sorted distinct codes of 8 or 10 digits in a text, but the examples."""
    none = F.array().cast("array<string>")

    def listed(t: Column) -> Column:
        hits = F.concat(*[F.coalesce(F.regexp_extract_all(t, F.lit(p), g), none) for p, g in CODE_PATTERNS])
        plain = F.transform(hits, lambda h: F.regexp_replace(h, r"(?U)[.\s]", ""))
        return F.array_sort(F.array_distinct(F.filter(plain, lambda h: h.rlike(r"^\d+$") & F.length(h).isin(8, 10) & ~h.isin(*DUMMIES))))

    # every way to write a code has four, two and two digits with a dot or a blank between at most: most texts need one scan
    return let(text, lambda t: F.when(t.rlike(r"(?U)\d{4}[.\s]?\d{2}[.\s]?\d{2}"), listed(t)).otherwise(none))


def padded_code(value: Column) -> Column:
    """The digits of a value of 8 to 10 digits, filled with zeros to 10; else null."""
    digits = F.regexp_replace(value, r"(?U)\D", "")
    return F.when(F.length(digits).between(8, 10), F.rpad(digits, 10, "0"))


def first_code(text: Column) -> Column:
    """The first number of ten digits that isn't the form's example."""
    return F.get(F.filter(F.regexp_extract_all(text, F.lit(r"(?U)\b(\d{10})\b"), 1), lambda h: h != "1023456789"), F.lit(0))


def dotted_code(text: Column) -> Column:
    """dddd.dd.dddd, else dddd.dd.dd.dd to dddd.dd.dd.dddd with dots or blanks; digits only."""
    one, two = r"(\d{4})\.(\d{2})\.(\d{4})", r"(?U)(\d{4})[.\s](\d{2})[.\s](\d{2})[.\s](\d{2,4})"
    digits = lambda p: F.regexp_replace(found(text, p, 0), r"(?U)[.\s]", "")
    return F.coalesce(digits(one), digits(two))


def money(value: Column) -> Column:
    return F.translate(value, "$,", "")


def scaled_value(text: Column, year: str) -> Column:
    """The value given for a year; ``Million`` multiplies it (cut to whole), a number that can't be read stays as it is."""
    pattern = rf"(?iU){year}\s*Value[:\s]*\$?\s*([\d,.]+)\s*(Million|Thousand)?"

    def scaled(hit: Column) -> Column:
        raw = F.replace(F.regexp_extract(hit, pattern, 1), F.lit(","), F.lit(""))
        million = F.lower(F.regexp_extract(hit, pattern, 2)) == "million"
        return F.when(million, F.coalesce((raw.try_cast("double") * 1_000_000).cast("bigint").cast("string"), raw)).otherwise(raw)

    return let(F.regexp_extract(text, pattern, 0), lambda hit: F.when(hit != "", scaled(hit)))


def letter_date(text: Column, strict: bool = False) -> Column:
    """The first date like ``September 26, 2019`` in the first 1000 characters, in ISO form.

    A date that doesn't exist is given without its comma, or as null if ``strict``.
    """
    head = F.substring(text, 1, 1000)
    raw = F.replace(found(head, DATE, 0), F.lit(","), F.lit(""))
    iso = F.date_format(F.try_to_timestamp(squeeze(raw), F.lit("MMMM d yyyy")), "yyyy-MM-dd")
    return iso if strict else F.coalesce(iso, raw)


def file_name(source: Column, label: Column, version: Column) -> Column:
    """``source_yyyymm_version.txt`` for a label like ``July 2023``; null for other labels."""
    pattern = r"(?U)^(\w+)\s+(\d{4})"
    months = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS) for x in (m, f"{i + 1:02d}")])
    month = F.try_element_at(months, F.lower(F.regexp_extract(label, pattern, 1)))
    return F.concat(F.lower(source), F.lit("_"), F.regexp_extract(label, pattern, 2), month, F.lit("_"), version, F.lit(".txt"))


def title_code(title: Column) -> Column:
    """Struct of code, company and item of an attachment title like ``3917290090 ECM FLX-3410B P``; null otherwise."""
    pattern = r"(?iU)^(\d{10})\s+(ECM|Primex)\s+([\w-]+)\s+P\s*$"
    parts = lambda t: F.struct(*[F.regexp_extract(t, pattern, i + 1).alias(n) for i, n in enumerate(("code", "company", "item"))])
    return let(strip(title), lambda t: F.when(t.rlike(pattern), parts(t)))
