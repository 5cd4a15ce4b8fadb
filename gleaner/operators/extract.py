"""Field extractors: questionnaire fields from form widgets, plain text and letters, and the row's status.

Every field is one native expression. A field that isn't found is null inside an extractor and '' in the final
row, as ``finished`` makes it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes as K
from ..functions import text as X

YEARS = ("2015", "2016", "2017")
#: The questionnaire's fields in their order.
FIELDS = ("q1_bci_status", "q2_product_description", "q3_htsus", "q4_requestor_name", "q4_organization", "q4_representative", "q5_relationship", "q6_attachments", "q7_attachment_bci", "q8_us_sources", "q9_third_countries", *[f"q10_{y}_{k}" for y in YEARS for k in ("value", "quantity")], "q11_supporting_info")
#: Names of form widgets by field.
ALIASES = {
    "q1_bci_status": ("bci",), "q2_product_description": ("prod name/descrip", "product description"), "q3_htsus": ("hts 10 digit", "hts", "htsus"),
    "q4_requestor_name": ("petitioner name", "requestor name"), "q4_organization": ("organization name",), "q4_representative": ("petitioner representative", "requestor representative"),
    "q5_relationship": ("relationship to prod", "relationship"), "q6_attachments": ("attachments",), "q7_attachment_bci": ("bci attachment", "attachment bci"),
    "q8_us_sources": ("dom avail", "domestic avail"), "q9_third_countries": ("global avail", "global availability"), "q11_supporting_info": ("comments", "comment"),
    **{f"q10_{y}_{k}": names for y in YEARS for k, names in (("value", (f"{y} value", f"{y}value")), ("quantity", (f"{y} quant", f"{y} quantity")))},
}
#: Words of which one must occur for a field to be looked for.
GATES = {
    "q1_bci_status": ("public document", "public version", "bci", "business confidential", "1."), "q2_product_description": ("2.", "product", "concern", "please provide", "description"),
    "q3_htsus": ("3.", "10-digit", "10 digit", "htsus", "hts", "item number"), "q4_requestor_name": ("4.", "requestor", "name", "last", "first"), "q4_organization": ("organization", "name"),
    "q5_relationship": ("5.", "relationship", "product", "importer", "producer"), "q6_attachments": ("6.", "attachments"), "q7_attachment_bci": ("7.", "bci", "attachment"),
    "q8_us_sources": ("8.", "domestic", "avail", "us sources"), "q9_third_countries": ("9.", "global", "avail", "third countr"),
    **{f"q10_{y}_value": (y, "value") for y in YEARS}, "q11_supporting_info": ("11.", "supporting", "comments", "box"),
}
FORM_WORDS = ("section 301", "requestor", "product", "htsus", "10-digit", "10 digit", "relationship", "domestic", "2015", "2016", "2017", "exclusion", "form")
RELATIONS = ("Importer", "U.S. Producer", "Other", "Manufacturer", "Distributor")
ANSWERS = (("6", "q6_attachments"), ("7", "q7_attachment_bci"), ("8", "q8_us_sources"), ("9", "q9_third_countries"))
ENOUGH = 5


def gate(text: Column, field: str, least: int = 1) -> Column:
    return X.total([F.lower(text).contains(w) for w in GATES[field]]) >= least


def likely_form(text: Column) -> Column:
    return (F.length(X.strip(text)) >= 80) & X.has_any(F.lower(text), FORM_WORDS)


def likely_new_pattern(text: Column) -> Column:
    t = F.lower(text)
    code, item = t.rlike(r"(?U)hts\s+subheading\s*:\s*\d{4}\.\d{2}\.\d{4}"), t.rlike(r"(?U)item\s*:\s*\d+\w*\s+")
    return (F.length(X.strip(text)) >= 100) & (code | item) & X.has_any(t, ("primex", "ecm ", "product description"))


def alias_table(spark: SparkSession) -> DataFrame:
    """(name, field): a table of a few dozen rows, whatever the input."""
    return spark.createDataFrame([(n, f) for f, names in ALIASES.items() for n in names], "name string, field string")


def from_widgets(widgets: DataFrame, doc_col: str = "doc_id") -> DataFrame:
    """One row per document of widgets (doc_id, page_no, widget_no, field_name, field_value): the FIELDS.

    Blank and ``Off`` values are skipped; of several values the last on the last page wins. Documents with widgets
    but no usable value keep their row.
    """
    spark = widgets.sparkSession
    value = X.strip(F.coalesce("field_value", F.lit("")))
    rows = widgets.select(doc_col, "page_no", "widget_no", F.lower(F.coalesce("field_name", F.lit(""))).alias("name"), value.alias("v"))
    rows = rows.join(F.broadcast(alias_table(spark)), "name", "left")
    field, v = F.col("field"), F.col("v")
    cleaned = (
        F.when(field.isin("q1_bci_status", "q7_attachment_bci"), X.bci_status(v))
        .when(field.isin("q6_attachments", "q8_us_sources", "q9_third_countries"), X.yes_no(v))
        .when(field == "q3_htsus", K.padded_code(v))
        .when(field.isin(*[f"q10_{y}_value" for y in YEARS]), K.money(v))
        .otherwise(v)
    )
    rows = rows.withColumn("v", F.when(~v.isin("", "Off"), cleaned))
    order = F.struct("page_no", "widget_no")
    # one aggregate per field instead of a pivot: a single pass with partial aggregation
    return rows.groupBy(doc_col).agg(*[F.max_by("v", F.when((F.col("field") == f) & F.col("v").isNotNull(), order)).alias(f) for f in FIELDS])


def kept_if(value: Column, ok) -> Column:
    """A value that passes a test, computed once for both."""
    return X.let(value, lambda x: F.when(ok(x), x))


def status_of(code: Column) -> Column:
    return X.let(code, lambda x: F.when(x.isNotNull(), X.bci_status(x)))


def from_text_v1(text: Column, clean: Column | None = None) -> dict[str, Column]:
    """The fields of the first docket's plain text; rules see line ends as they are.

    ``clean``: a column that holds ``X.prepare_v1(text)``, so that the four answers don't each prepare the text.
    """
    clean = X.prepare_v1(text) if clean is None else clean
    named = lambda p: X.repair_v1(X.found(text, p))
    head = X.found(F.substring(text, 1, 500), r"(?idU)1\..*?(P|PV|B|BCI)")
    out = {"q1_bci_status": F.when(text.contains("Public Document"), "Public Document").otherwise(status_of(head))}
    about = X.strip(X.found(text, r"(?isdU)2\.\s*Please provide.*?concern[:\s]*(.+?)(?=3\.|10-digit)"))
    out["q2_product_description"] = X.squeeze(kept_if(about, lambda x: (F.length(x) > 50) & ~x.rlike(r"^\d+\.")))
    out["q3_htsus"] = K.first_code(text)
    name = named(r"(?isdU)4\.\s*Requestor Information.*?Name.*?:\s*([^\n]{3,100})")
    out["q4_requestor_name"] = kept_if(name, lambda x: (F.length(x) > 2) & ~x.rlike("(?iU)organization|public|note"))
    org = named(r"(?isdU)4\.\s*Requestor Information.*?Organization\s+Name[^\n:]*:\s*([^\n]+)")
    out["q4_organization"] = kept_if(org, lambda x: (F.length(x) > 2) & ~x.rlike("(?iU)note|representative"))
    rep = named(r"(?isdU)4\.\s*Requestor Information.*?Representative[^\n:]*:\s*([^\n]+)")
    out["q4_representative"] = kept_if(rep, lambda x: (F.length(x) > 1) & ~x.rlike(r"(?iU)^N\s*/?\s*A"))
    relation = named(r"(?isdU)5\..*?relationship.*?product[^\n]*:\s*([^\n]+)")
    out["q5_relationship"] = kept_if(relation, lambda x: (F.length(x) > 1) & ~x.rlike(r"CONTINUED|^\d+\."))

    def by_section(part: Column, n: str) -> Column:
        extra = F.when(part.contains("NJA"), "N/A").otherwise(status_of(X.found(part, r"\b(P|PV|B)\b"))) if n == "7" else None
        return X.section_answer(part, extra)

    def sectioned(n: str) -> Column:
        return X.let(clean, lambda c: X.let(X.section(c, int(n)), lambda part: by_section(part, n)))

    def anywhere(raw: Column) -> Column:
        return F.when(raw.contains("1A") | raw.contains("JA"), "N/A").when(raw.startswith("Y"), "YES").when(raw.isin("P", "PV", "B"), X.bci_status(raw)).otherwise(raw)

    for n, field in ANSWERS:
        # the furthest answer within 40 characters after the number; a number's digits end the search
        raw = F.replace(F.upper(X.found(text, rf"(?iU){n}\D{{0,40}}(YES|NO|N/?A|N\s*1\s*A|NJA|jNJA|P|PV|B)")), F.lit(" "), F.lit(""))
        out[field] = F.coalesce(sectioned(n), X.let(raw, anywhere))
    for y in YEARS:
        out[f"q10_{y}_value"] = K.scaled_value(text, y)
        out[f"q10_{y}_quantity"] = X.strip(X.found(text, rf"(?idU){y}\s*Quant[^\n]*\n+([^\n]+)"))
    info = X.squeeze(X.strip(X.found(text, r"(?isdU)11\..*?box\).*?\n+(.{100,}?)(?=VERSION|END)")))
    out["q11_supporting_info"] = kept_if(info, lambda x: ~F.substring(x, 1, 50).rlike("(?iU)please provide information"))
    return out


def from_form_v2(text: Column) -> dict[str, Column]:
    """The fields of a prepared standard form of the second docket; each behind its gate."""
    low, head = F.lower(text), F.substring(text, 1, 500)
    named = lambda p: X.repair_v2(X.found(text, p))
    code = X.found(head, r"(?idU)1\..*?(P|PV|B|BCI)")
    out: dict[str, Column] = {}
    out["q1_bci_status"] = (
        F.when(low.contains("public document") & ~F.substring(low, 1, 800).contains("public version"), "Public Document")
        .when(low.contains("public version") | head.rlike(r"(?U)\bPV\b"), "Public Version of BCI")
        .otherwise(status_of(code))
    )
    about = named(r"(?isdU)2\.\s*(?:Please provide|provide).*?(?:concern|product)[:\s]*(.+?)(?=3\.|10-digit|10 digit)")
    out["q2_product_description"] = X.squeeze(kept_if(about, lambda x: (F.length(x) > 15) & ~x.rlike(r"^\d+\.")))
    out["q3_htsus"] = F.coalesce(K.first_code(text), K.dotted_code(text))
    one = named(r"(?isdU)4\.\s*Requestor Information.*?Name.*?:\s*([^\n]{3,100})")
    two = named(r"(?U)([A-Z][a-z]+,\s*[A-Z][a-z]{2,})\s*(?:\n|Organization|$)")
    three = F.nullif(named(r"(?U)\d{4}\.\d{2}\.\d{4}\s*\n\s*([A-Z][a-z]+,\s*[A-Z][a-z]+)"), F.lit(""))
    out["q4_requestor_name"] = F.coalesce(kept_if(one, lambda x: (F.length(x) > 2) & ~x.rlike("(?iU)organization|public|note")), kept_if(two, lambda x: (F.length(x) > 5) & ~F.lower(x).contains("organization")), three)
    out["q4_organization"] = F.coalesce(F.nullif(named(r"(?isdU)4\.\s*Requestor Information.*?Organization\s+Name[^\n:]*:\s*([^\n]+)"), F.lit("")), F.nullif(named(r"(?U)[A-Z][a-z]+,\s*[A-Z][a-z]+\s*\n\s*([A-Za-z0-9\s,.]+(?:Inc|LLC|Corp|Ltd)\.?)"), F.lit("")))
    listed = reduce(lambda c, r: c.when(F.instr(text, r).between(1, 4000), r), RELATIONS[1:], F.when(F.instr(text, RELATIONS[0]).between(1, 4000), RELATIONS[0]))
    out["q5_relationship"] = F.coalesce(F.nullif(named(r"(?isdU)5\..*?relationship.*?product[^\n]*:\s*([^\n]+)"), F.lit("")), listed)
    for n, field in ANSWERS:
        answer = X.found(text, rf"(?iU){n}\D{{0,40}}(YES|NO|N/?A|N\s*1\s*A)")
        out[field] = X.let(answer, lambda x: F.when(x.isNotNull(), X.yes_no(x)))
    for y in YEARS:
        out[f"q10_{y}_value"] = F.replace(X.found(text, rf"(?iU){y}\s*Value[:\s]*\$?\s*([\d,.]+)"), F.lit(","), F.lit(""))
    info = X.found(text, r"(?isdU)11\..*?box\).*?\n+(.{50,}?)(?=VERSION|END|$)")
    out["q11_supporting_info"] = X.let(info, lambda x: F.when(x.isNotNull(), X.repair_v2(X.squeeze(X.strip(x)))))
    return {f: F.when(gate(text, f), c) for f, c in out.items()}


def from_letter(text: Column) -> dict[str, Column]:
    """The fields of a prepared new-pattern letter."""
    low = F.lower(text)
    named = lambda p: F.nullif(X.repair_v2(X.strip(X.found(text, p))), F.lit(""))
    code = lambda p: X.let(F.regexp_extract(text, p, 0), lambda hit: F.when(hit != "", F.concat(*[F.regexp_extract(hit, p, g) for g in (1, 2, 3)])))
    org = X.repair_v2(X.strip(X.found(text, r"(?dU)([A-Za-z\s]+(?:Family of Companies|Industries|Inc\.?|LLC|Corp))[^\n]*hereby submits")))
    org = kept_if(org, lambda x: F.length(x) > 3)
    known = F.when(low.contains("primex"), "Primex").when(low.rlike(r"(?U)ecm\s+industries"), "ECM Industries")
    absent = F.when(text.rlike(r"(?idU)not available in the U\.?S\.?|not available.*outside.*china"), "NO")
    return {
        "q2_product_description": F.coalesce(named(r"(?idU)Item\s*:\s*(\d+\w*\s+[^\n]+?)(?=\s*HTS\s+subheading|\n\n|\nItem\s+Description)"), named(r"(?iU)Item\s+Description\s*:\s*([^\n]{10,200})"), named(r"(?iU)We request that USTR exclude the ([^.]+) that is imported")),
        "q3_htsus": F.coalesce(code(r"(?iU)HTS\s+subheading\s*:\s*(\d{4})\.(\d{2})\.(\d{4})"), code(r"(?U)\b(\d{4})\.(\d{2})\.(\d{4})\b")),
        "q4_organization": F.coalesce(org, known),
        "q4_requestor_name": F.coalesce(X.strip(F.substring_index(org, "(", 1)), known),
        "q5_relationship": F.when(F.instr(low, "importer").between(1, 3000), "Importer"),
        "q8_us_sources": absent,
        "q9_third_countries": absent,
    }


def completed(values: dict[str, Column]) -> dict[str, Column]:
    """All FIELDS, sanitised; '' where nothing was found."""
    return {f: X.sanitize(values[f]) if f in values else F.lit("") for f in FIELDS}


def finished(docs: DataFrame, method: Column) -> DataFrame:
    """Rows with FIELDS and extraction_method, with filled and status added."""
    filled = X.total([F.col(f) != "" for f in FIELDS])
    return X.fenced(docs, {"extraction_method": method, "filled": filled}).withColumn("status", F.when(F.col("filled") >= ENOUGH, "Success").otherwise("Low"))


def merged_widgets(docs: DataFrame, widgets: DataFrame, doc_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Documents with widgets, with their FIELDS, and the others; two frames, so that only the others reach text rules."""
    own = from_widgets(widgets, doc_col)
    with_widgets = docs.join(own, doc_col).withColumns({f: X.sanitize(F.col(f)) for f in FIELDS})
    return finished(with_widgets, F.lit("Form Fields")), docs.join(own.select(doc_col), doc_col, "left_anti")


def extract_v1(docs: DataFrame, widgets: DataFrame, doc_col: str = "doc_id") -> DataFrame:
    """First docket: widgets, else recognised text if scanned, else text; the latter two have one method name.

    docs: doc_id, pages (array of the first pages' text), ocr_text (null: not recognised).
    """
    from . import classify as C

    forms, rest = merged_widgets(docs, widgets, doc_col)
    plain = F.array_join(F.slice(F.coalesce("pages", F.array()), 1, 3), "\n")
    rest = X.fenced(rest, {"_text": F.when(C.scanned_v1(F.col("pages")) & F.col("ocr_text").isNotNull(), F.col("ocr_text")).otherwise(plain)})
    rest = X.fenced(rest, {"_clean": X.prepare_v1(F.col("_text"))})
    rest = X.fenced(rest, completed(from_text_v1(F.col("_text"), F.col("_clean")))).drop("_text", "_clean")
    return forms.unionByName(finished(rest, F.lit("Scanned (OCR)")))


def extract_v2(docs: DataFrame, widgets: DataFrame, doc_col: str = "doc_id", keep_newlines: bool = False) -> DataFrame:
    """Second docket: widgets; scanned with recognised text of 200 characters; scanned; text. Columns as for extract_v1, with raw_text (layout text)."""
    from . import classify as C

    forms, rest = merged_widgets(docs, widgets, doc_col)
    pages = F.array_join(F.slice(F.coalesce("pages", F.array()), 1, 5), "\n")
    raw = F.when(F.length(X.strip(F.coalesce("raw_text", F.lit("")))) < 100, pages).otherwise(F.col("raw_text"))
    rest = X.fenced(rest, {"_raw": raw})
    rest = X.fenced(rest, {"_seen": X.decode_garbled(F.col("_raw")), "_read": X.decode_garbled(F.coalesce("ocr_text", F.lit("")))})
    scanned = C.scanned_v2(F.col("pages"), F.col("_raw"), F.col("_seen"))
    rest = X.fenced(rest, {"_kind": F.when(scanned & (F.length(X.strip(F.col("_read"))) >= 200), "Scanned+OCR").when(scanned, "Scanned").otherwise("Text")})
    rest = X.fenced(rest, {"_text": X.unruled_v2(F.when(F.col("_kind") == "Text", F.col("_seen")).otherwise(F.col("_read")), keep_newlines)})
    kind = F.when(F.col("_kind") == "Scanned", "none").when(likely_form(F.col("_text")), "form").when(likely_new_pattern(F.col("_text")), "letter").otherwise("none")
    rest = X.fenced(rest, {"_rule": kind})
    # native branches run only for their own rows; one frame for each rule would read and prepare everything once more
    form, letter = (completed(f(F.col("_text"))) for f in (from_form_v2, from_letter))
    rest = X.fenced(rest, {f: F.when(F.col("_rule") == "form", form[f]).when(F.col("_rule") == "letter", letter[f]).otherwise("") for f in FIELDS})
    return forms.unionByName(finished(rest, F.col("_kind")).drop("_raw", "_seen", "_read", "_kind", "_text", "_rule"))


def with_llm_fields(docs: DataFrame, ask, text_col: str = "text") -> DataFrame:
    """Fields that a language model gives: ``ask`` takes and returns a pandas Series (text to JSON text)."""
    answer = F.pandas_udf(ask, "string")(F.substring(text_col, 1, 6000))
    return docs.withColumn("_a", X.json_object(answer)).withColumns({f: X.sanitize(F.try_element_at("_a", F.lit(f))) for f in FIELDS}).drop("_a")


def with_llm_score(docs: DataFrame, ask, text_col: str = "text") -> DataFrame:
    """A score from 0 to 100 that a language model gives to the first 3000 characters."""
    return docs.withColumn("llm_score", X.first_score(F.pandas_udf(ask, "string")(F.substring(text_col, 1, 3000))))


def landed_status(docs: DataFrame, url_col: str = "attachment_url", landed_col: str = "landed") -> DataFrame:
    """Before extraction: ``No URL``, ``Failed`` (nothing landed) or null; a blank url becomes ``no_url``."""
    missing = F.coalesce(X.strip(F.col(url_col)) == "", F.lit(True))
    return docs.withColumn("status", F.when(missing, "No URL").when(~F.coalesce(F.col(landed_col), F.lit(False)), "Failed")).withColumn(url_col, F.when(missing, "no_url").otherwise(F.col(url_col)))


def result_status(status: Column, withdrawn: Column) -> Column:
    return F.when(withdrawn == 1, "withdrawn").otherwise(status)


def result_notes(status: Column, url: Column, notes: Column) -> Column:
    """Notes by the status from before a withdrawal."""
    return F.when((status == "pdf not present") | F.coalesce(X.strip(url) == "", F.lit(True)), "PDF not present").when(status == "Low", "Scanned").otherwise(F.coalesce(notes, F.lit("")))


def backfilled(docs: DataFrame, meta: dict[str, Column]) -> DataFrame:
    """Blank fields take what the metadata give."""
    return docs.withColumns({f: F.when(X.blank(F.col(f)), F.coalesce(c, F.col(f))).otherwise(F.col(f)) for f, c in meta.items()})


def document_status(attachments: DataFrame, documents: DataFrame, doc_col: str = "doc_id") -> DataFrame:
    """One row per document: its best attachment, status, reason and check details.

    attachments: doc_id, pos, url, title, is_form, msg, score, method (null msg: nothing was fetched; reply letters are
    left out before). documents: doc_id, api_error (null: the listing succeeded).
    """
    name = X.shorten(F.coalesce(F.nullif(X.strip(F.col("title")), F.lit("")), F.nullif(F.substring_index("url", "/", -1), F.lit("")), F.format_string("attachment_%d.pdf", "pos")))
    limited = F.coalesce(F.col("msg").contains("429") | F.col("msg").contains("Too Many"), F.lit(False))
    excluded = F.coalesce(F.col("msg").contains("EXCLUDED:"), F.lit(False))
    rows = attachments.where(F.col("url").isNotNull() & (F.col("url") != "")).withColumns({
        "_ok": ~limited & (F.coalesce("msg", F.lit("")) != "") & ~F.lower(X.strip(F.coalesce("msg", F.lit("")))).startswith("error:"),
        "_form": F.coalesce(F.col("is_form"), F.lit(False)) & ~excluded & ~limited,
        "_line": F.concat(name, F.lit(": "), F.when(F.coalesce(F.col("is_form"), F.lit(False)) & ~excluded & ~limited, "✓ Section 301").otherwise(F.concat(F.lit("✗ ("), F.substring(F.when(limited, "Rate limited (429)").otherwise(F.coalesce("msg", F.lit(""))), 1, 40), F.lit(")")))),
    })
    best = F.max_by(F.struct("url", "title", "msg", "score", F.coalesce("method", F.lit("Text")).alias("method")), F.when(F.col("_form"), F.struct("score", (-F.col("pos")).alias("p"))))
    agg = rows.groupBy(doc_col).agg(F.count(F.lit(1)).alias("checked"), F.count_if("_ok").alias("fetched"), best.alias("best"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "_line"))), lambda x: x["_line"]), "\n").alias("PDF_check_details"))
    out = documents.join(agg, doc_col, "left")
    has, score = F.col("best.score").isNotNull(), F.coalesce("best.score", F.lit(0))
    status = F.when(F.col("api_error").isNotNull(), "API error").when(has & F.col("best.method").isin("Scanned", "Text"), "Scanned").when(has, "Success").otherwise("pdf not present")
    reason = (
        F.when(F.col("api_error").isNotNull(), F.col("api_error"))
        .when(has, F.format_string("BEST (score=%d)", score))
        .when(F.col("checked").isNull(), "No non-Re_ PDF attachments")
        .when(F.col("fetched") > 0, "Checked PDFs, none matched")
        .otherwise("All PDFs failed to fetch (404/error)")
    )
    return out.select(
        *documents.columns, F.coalesce("best.url", F.lit("")).alias("attachment_url"), F.coalesce("best.msg", F.lit("")).alias("detection_result"), score.alias("best_score"), status.alias("status"), reason.alias("selection_reason"),
        F.coalesce("best.method", F.lit("")).alias("extraction_method"), F.coalesce("checked", F.lit(0)).alias("total_attachments_checked"), F.coalesce("PDF_check_details", F.lit("")).alias("PDF_check_details"),
    )


def status_notes(status: Column, reason: Column, url: Column) -> Column:
    return F.when(status == "Scanned", "Scanned").when(status == "API error", reason).when((status == "pdf not present") | X.blank(url), "PDF not present").otherwise("")
