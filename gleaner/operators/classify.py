"""Rule classifiers of documents, as one projection of flags and one ordered decision.

``detect`` is the form detector; the other functions are the tests of the second docket, which take texts that
``text.decode_garbled`` has been over, once, in a column of its own. Every flag is a native expression.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes as K
from ..functions import text as X

# The rules' phrases and patterns.
DEAR = r"(?U)Dear\s+(Ambassador|Mr\.|Ms\.|Dr\.)"
NARRATIVE = ("respectfully request", "hereby request", "we request", "submits this request", "request to exclude", "exclude certain products", "exclusion from the tariff", "seeks an exclusion", "request for exclusion", "this exclusion request", "on behalf of")
#: (words without which it can't match, pattern); repeats at either end of a pattern are left out, as one character decides.
LETTERHEAD = (((" LLC",), r"(?U)[A-Z\s] LLC"), ((" GROUP",), r"(?U)[A-Z\s] GROUP"), ((), r"(?U)[A-Z\s],?\s+(INC|Inc)"), (("Street", "Suite"), r"(?dU)\d.*Street.*Suite"), (("Phone",), r"(?dU)Phone.*\d{3}"), (("Email:",), r"(?d)Email:.*@"), (("On behalf of",), ""), (("hereby submit",), ""), (("respectfully request",), ""), (("Office of U.S. Trade Representative",), ""))
ABOUT = ("exclusion request is being submitted", "this exclusion request is for", "exclusion would undermine", "respectfully request that you exclude", "we request that you exclude", "section 301 exclusion request")
VERBS, MORE_VERBS = "Indicate|Provide|List|Identify", "Specify|Enter|Submit"
QUESTIONS = (rf"(?imdU)^\s*(\d+)\.\s*(?:{VERBS}|{MORE_VERBS})", rf"(?iU)\n\s*(\d+)\.\s*(?:{VERBS}|{MORE_VERBS})", rf"(?iU)(\d+)\.(?:{VERBS})", rf"(?imdU)^\s*(\d+)\s+(?:{VERBS}|Specify)")
MARKERS = ("indicate whether", "provide any", "indicate the", "provide the", "complete and correct", "best of your knowledge", "product exclusion request", "section 301")
GOVERNMENT = ((("form", "request"), r"(?U)form\s+to\s+request"), (("representative",), r"(?U)u\.?s\.?\s+trade\s+representative"), (("office", "trade", "representative"), r"(?d)office.*trade.*representative"), (("china", "acts", "section", "301"), r"(?d)china.*acts.*section.*301"), (("htsus", "subheading"), r"(?d)htsus.*subheading"), (("product", "exclusion", "301"), r"(?d)product.*exclusion.*301"), (("business", "confidential", "information"), r"(?d)business.*confidential.*information"))
FILLED_WORDS = (("PublicDocument", "Public Document"), ("ContainsBCI", "Contains BCI"), ("U.S.Producer", "U.S. Producer"), ("Pleaseseeattachedsubmission", "Please see attached submission"))
ELEMENTS = (("version",), ("continued",), ("bci",), ("requestor name", "requestorname"), ("organization name", "organizationname"), ("section 301", "section301"), ("form to request exclusion", "formtorequestexclusion", "formrequestexclusion"), ("china acts",))
FORM_MARKERS = (r"section\s+301\s+investigation", r"form\s+to\s+request\s+exclusion", r"requestor\s+information", r"10-?digit\s+hts", r"htsus?\s*code", r"relationship\s+to\s+(?:the\s+)?product", r"product\s+description", r"domestic\s+avail", r"global\s+(?:avail|availability)", r"2015\s*value", r"2016\s*value", r"2017\s*value", r"bci\s*(?:status)?", r"petitioner\s+name", r"organization\s+name")
LETTER_MARKERS = (r"Dear\s+(?:Ambassador|Sir|Madam|Mr\.|Ms\.|U\.S\.\s*Trade\s*Representative)", r"hereby\s+submits?\s+(?:this\s+)?(?:request|the\s+following)", r"hereby\s+submit\s+(?:the\s+following\s+)?supplemental", r"respectfully\s+(?:submits?|requests?)", r"Submitted\s+via\s+regulations\.gov", r"Office\s+of\s+(?:the\s+)?(?:US|U\.S\.)\s*Trade\s*Representative", r"600\s+17th\s+Street", r"Subject\s*:\s*Procedures\s+To\s+Consider", r"Re\s*:\s*Procedures\s+To\s+Consider", r"Re\s*:\s*Exclusion\s+(?:from\s+)?(?:additional\s+)?[Tt]ariff", r"Request\s+for\s+Exclusion\s+from\s+Section\s+301", r"Reference\s*:\s*Request\s+for\s+Exclusion", r"supplemental\s+comments?\s+related\s+to\s+tariffs", r"HTS\s+code\s+of\s+\d{4}\.\d{2}\.\d{4}")
RESPONSE_MARKERS = (r"The\s+purpose\s+of\s+this\s+letter\s+is\s+to\s+inform\s+you", r"EXECUTIVE\s+OFFICE\s+OF\s+THE\s+PRESIDENT\s*\n\s*OFFICE\s+OF\s+THE\s+UNITED\s+STATES\s+TRADE\s+REPRESENTATIVE", r"RE:\s+Product\s+Exclusion\s+Request\s+Number\s*:")
NEW_PATTERN_MARKERS = (r"I\.\s*\n?\s*Product\s+Description", r"II\.\s*\n?\s*(?:Primex|ECM)\s+[Cc]annot\s+[Ss]ource", r"HTS\s+subheading\s*:\s*\d{4}\.\d{2}\.\d{4}", r"Item\s*:\s*\d+\w*\s+[\w\s\"']+")
NEW_PATTERN_COMMENTS = {"ECM": "ECM Industries LLC respectfully submits the attached exclusion request for HTS Code", "Primex": "Primex Family of Companies respectfully submits the attached exclusion request for HTS Code"}
FIELD_NAMES = ("bci", "hts", "htsus", "prod name", "product description", "requestor name", "petitioner name", "organization name", "relationship", "dom avail", "global avail", "2015 value", "2016 value", "2017 value")
SEPARATELY = r"(?iU)submit\s+(?:the\s+)?(?:confidential\s+)?(?:request\s+)?separately|too\s+large\s+to\s+attach"
#: Least score of a form, and characters under which the first pages count as scanned.
FORM_SCORE, SCANNED_V1, SCANNED_V2 = 8, 200, 300


def guarded(c: Column, words, pattern: str) -> Column:
    """A pattern that is tried only where all its words occur: it could scan a line once for each of its digits."""
    tests = [c.contains(w) for w in words] + ([c.rlike(pattern)] if pattern else [])
    return reduce(lambda a, b: a & b, tests)


def any_case(c: Column, patterns) -> list[Column]:
    return [c.rlike(f"(?iU){p}") for p in patterns]


def clean_texts(docs: DataFrame, first: str, full: str) -> DataFrame:
    """``docs`` with _cf and _cl: both texts without control characters, decoded, and, if the first is doubled, with runs collapsed.

    Each step has a fence of its own, so that it runs once for a text; a text that equals the other isn't cleaned again.
    """
    decoded = lambda c: X.let(X.controls_to_blanks(F.col(c)), X.decode_cid)
    even = lambda c: X.replaced(F.when(F.col("_doubled"), X.collapse_runs(F.col(c))).otherwise(F.col(c)), X.GARBLED_SHORT)
    held = X.fenced(docs, {"_df": decoded(first)})
    held = X.fenced(held, {"_dl": F.when(F.col(first) == F.col(full), F.col("_df")).otherwise(decoded(full)), "_doubled": X.is_doubled(F.col("_df"))})
    held = X.fenced(held, {"_cf": even("_df")})
    held = X.fenced(held, {"_cl": F.when(F.col("_dl") == F.col("_df"), F.col("_cf")).otherwise(even("_dl"))})
    return held.drop("_df", "_dl", "_doubled")


def detect(docs: DataFrame, first_col: str = "first2", full_col: str = "full") -> DataFrame:
    """``docs`` with is_form, msg and score, from the text of the first two pages and of all pages.

    Exclusions come first and in order; then the form rules; codes in messages are the smallest found.
    """
    held = X.fenced(docs, {"_first": F.coalesce(first_col, F.lit("")), "_full": F.coalesce(full_col, F.lit(""))})
    held = clean_texts(held, "_first", "_full")
    # one copy of each joined text and its lower case, so that no rule builds its own
    held = X.fenced(held, {"_a": F.concat("_first", "_cf"), "_b": F.concat("_first", "_cl"), "_c": F.concat("_full", "_cl")})
    held = X.fenced(held, {"_la": F.lower("_a"), "_lall": F.lower(F.concat("_a", "_cl")), "_lfull": F.lower("_full"), "_lclean": F.lower("_cl"), "_codes": K.codes(F.concat_ws(" ", "_full", "_cl"))})
    a, b, c, la, lall = (F.col(x) for x in ("_a", "_b", "_c", "_la", "_lall"))
    asked = X.has_any(F.lower(b), [v.lower() for v in f"{VERBS}|{MORE_VERBS}".split("|")])  # without a verb there is no question
    numbers = F.when(asked, F.array_distinct(F.concat(*[F.regexp_extract_all(b, F.lit(q), 1) for q in QUESTIONS])))
    pairs = (("section", "301"), ("requestor", "organization"), ("public", "bci"), ("version", "continued"))
    markers = [la.contains(m) for m in MARKERS] + [lall.contains(x) & lall.contains(y) for x, y in pairs]
    markers += [lall.contains("exclusion") & X.has_any(lall, ("form", "request")), guarded(lall, ("indicate",), r"(?dU)\b1\b.*\bindicate\b"), guarded(lall, ("provide",), r"(?dU)\b2\b.*\bprovide\b")]
    government = [guarded(lall, w, p) for w, p in GOVERNMENT] + [F.regexp_count(F.col("_cl"), F.lit(r"(?U)\b\d+\.\s*[A-Za-z]")) >= 5]
    filled = [c.rlike(r"(?U)\b\d{4}\.\d{2}\.\d{2}\.\d{2}\b"), *[X.has_any(c, w) for w in FILLED_WORDS], c.rlike("[A-Z][a-z]+,[A-Z][a-z]+"), X.has_any(c, ("Inc.", "LLC")), F.length(c) < 2000]
    everywhere = lambda words: X.has_any(F.col("_lfull"), words) | X.has_any(F.col("_lclean"), words)
    held = X.fenced(held, {
        "_narrative": X.total([la.contains(p) for p in NARRATIVE]),
        "_head": X.total([guarded(a, w, p) for w, p in LETTERHEAD]),
        "_questions": F.size(F.array_intersect(F.coalesce(numbers, F.array().cast("array<string>")), F.array(*[F.lit(str(n)) for n in range(1, 13)]))),
        "_markers": X.total(markers),
        "_government": X.total(government),
        "_filled": X.total(filled),
        "_elements": X.total([everywhere(w) for w in ELEMENTS]),
        "_name": c.rlike(r"(?U)[A-Z][a-z]+,\s*[A-Z][a-z]+"),
        "_company": X.has_any(c, (" LLC", " Inc", " Corp", " Ltd")) & c.rlike(r"(?U)[A-Za-z\s] (LLC|Inc|Corp|Ltd)"),
    })
    f, n, size = F.col("_elements"), F.size("_codes"), F.length("_full")
    is_form = (F.col("_questions") >= 3) | (F.col("_markers") >= 3) | (F.col("_government") >= 2) | (F.col("_filled") >= 4)
    told = lambda ok, msg, score: F.struct(F.lit(ok).alias("is_form"), msg.alias("msg"), score.cast("int").alias("score"))
    no = lambda msg, score: told(False, F.lit(msg) if isinstance(msg, str) else msg, F.lit(score))
    letter = ((F.col("_narrative") >= 2) & (size > 3000) & (F.regexp_count("_full", F.lit(r"\n\n")) > 5)) | ((F.col("_narrative") >= 3) & (size > 2000))
    first_code = F.get("_codes", F.lit(0))
    result = (
        F.when(F.length(X.strip(F.col("_full"))) < 50, no("Text extraction failed", 0))
        .when(a.contains("Dear") & a.rlike(DEAR), no("EXCLUDED: Dear letter format", -100))
        .when(letter, no(F.format_string("EXCLUDED: Narrative business letter (indicators:%d)", "_narrative"), -100))
        .when(F.col("_head") >= 4, no(F.format_string("EXCLUDED: Business letterhead (indicators:%d)", "_head"), -100))
        .when((F.length(a) > 1000) & X.has_any(la, ABOUT), no("EXCLUDED: Document about exclusion, not the form itself", -100))
        .when(is_form & (f >= 1), told(True, F.format_string("Form (patterns: %d)", f), f * 10 + F.when(f >= 3, 20).otherwise(0) + F.when(f >= 5, 30).otherwise(0)))
        .when(everywhere(("public document", "public version")) & (n > 0) & (F.col("_name") | F.col("_company")), told(True, F.format_string("Scrambled (HTSUS: %s)", first_code), 15 + n * 3 + F.when(F.col("_name"), 5).otherwise(0) + F.when(F.col("_company"), 5).otherwise(0)))
        .when((n > 0) & (f >= 1), told(True, F.format_string("Minimal (HTSUS: %s)", first_code), 10 + n * 2 + f * 5))
        .otherwise(no("Not Section 301", 0))
    )
    return X.fenced(held, {"_r": result}).select(*docs.columns, "_r.is_form", "_r.msg", "_r.score")


def new_pattern(text: Column) -> Column:
    """Letters of the new layout: a code or item with the company or section, or two of four marks."""
    t = F.lower(text)
    code, item = t.rlike(r"(?U)hts\s+subheading\s*:\s*\d{4}\.\d{2}\.\d{4}"), t.rlike(r"(?U)item\s*:\s*\d+\w*\s+")
    company, section = X.has_any(t, ("primex", "ecm industries", "ecm ")), t.rlike(r"(?U)i\.\s*\n?\s*product\s+description")
    return F.coalesce(((code | item) & (company | section)) | (X.total(any_case(text, NEW_PATTERN_MARKERS)) >= 2), F.lit(False))


def response_letter(text: Column) -> Column:
    """Letters of the office to a requester (text of two pages)."""
    return F.coalesce(reduce(lambda a, b: a | b, any_case(text, RESPONSE_MARKERS)), F.lit(False))


def cover_letter(text3: Column, text5: Column) -> Column:
    """Cover letters that aren't the form (texts of three and of five pages); never new-pattern letters."""
    text, t = text3, F.lower(text3)
    letters, forms = X.total(any_case(t, LETTER_MARKERS)), X.total(any_case(t, FORM_MARKERS))
    verdict = (
        F.when(new_pattern(text5), False)
        .when(t.rlike(r"(?U)dear\s+ambassador") & ~t.contains("requestor information"), True)
        .when(forms >= 4, False)
        .when((letters >= 2) & (forms <= 1), True)
        .when((letters >= 1) & (forms == 0) & (F.length(X.strip(text)) > 200), True)
        .when((letters >= 1) & t.rlike(r"(?U)supplemental|supplement\s+to\s+#\d") & (forms <= 2), True)
        .otherwise(False)
    )
    return F.coalesce(verdict, F.lit(False))


def product_attachment(text: Column) -> Column:
    """Product sheets of little text (text of three pages)."""
    size, t = F.length(X.strip(text)), F.lower(text)
    return F.coalesce(((size < 600) & text.rlike(r"(?iU)Attachment\s+[A-Z]\s*[-–]")) | ((size < 400) & t.contains("public document") & t.contains("attachment")), F.lit(False))


def wrong_type(text2: Column, text3: Column, text5: Column) -> Column:
    return ~new_pattern(text5) & (response_letter(text2) | cover_letter(text3, text5) | product_attachment(text3))


def new_pattern_by_metadata(titles: Column, comment: Column) -> Column:
    """Whether an attachment's title or the comment tells the new layout; nothing is downloaded."""
    told = X.has_any(F.coalesce(comment, F.lit("")), NEW_PATTERN_COMMENTS.values())
    return F.coalesce(F.exists(titles, lambda t: K.title_code(t).isNotNull()), F.lit(False)) | told


def metadata_fields(titles: Column, comment: Column) -> Column:
    """Fields that the first fitting title gives, or else the comment: q3, q2, q4 organization and name, and the title's place."""
    hits = F.filter(F.transform(titles, lambda t, i: F.struct(K.title_code(t).alias("t"), i.alias("i"))), lambda x: x["t"].isNotNull())

    def fields(hit: Column) -> Column:
        company = F.when(hit.isNotNull(), F.when(F.upper(hit["t"]["company"]) == "ECM", "ECM").otherwise("Primex")).when(comment.contains(NEW_PATTERN_COMMENTS["ECM"]), "ECM").when(comment.contains(NEW_PATTERN_COMMENTS["Primex"]), "Primex")
        return F.struct(
            F.coalesce(hit["t"]["code"], X.found(comment, r"(?iU)HTS\s+Code\s+(\d{10})")).alias("q3_htsus"),
            hit["t"]["item"].alias("q2_product_description"),
            F.when(company == "ECM", "ECM Industries LLC").when(company == "Primex", "Primex Family of Companies").alias("q4_organization"),
            F.when(company == "ECM", "ECM Industries LLC").when(company == "Primex", "Primex").alias("q4_requestor_name"),
            hit["i"].alias("place"),
        )

    return X.let(F.get(hits, F.lit(0)), fields)


def scanned_v1(first_pages: Column) -> Column:
    """Whether the first two pages (an array) have under 200 characters."""
    return _page_text(first_pages) < SCANNED_V1


def scanned_v2(first_pages: Column, raw: Column, decoded: Column | None = None) -> Column:
    """Under 300 characters on two pages, under 200 after decoding, or text in a font without a proper encoding.

    ``decoded``: a column that holds ``X.decode_garbled(raw)``, if there is one.
    """
    decoded = X.decode_garbled(raw) if decoded is None else decoded
    garbled = X.has_any(raw, [g for g, _ in X.GARBLED[:20]]) & (F.length(X.strip(raw)) > 300)
    return (_page_text(first_pages) < SCANNED_V2) | (F.length(X.strip(decoded)) < 200) | garbled


def _page_text(pages: Column) -> Column:
    return F.aggregate(F.slice(F.coalesce(pages, F.array()), 1, 2), F.lit(0), lambda n, p: n + F.length(X.strip(F.coalesce(p, F.lit("")))))


def rescue_score(ocr_text: Column) -> Column:
    """Score of a recognised text by form marks; null if it is too short or below its threshold."""
    n = X.total(any_case(F.lower(ocr_text), FORM_MARKERS))
    enough = n * 5 >= F.when(n >= 5, 25).otherwise(FORM_SCORE)
    return F.when((F.length(X.strip(ocr_text)) >= 200) & enough, F.least(n * 5, F.lit(100)))


def _named(names: Column, word: str) -> Column:
    return F.exists(names, lambda f: f.contains(word))


def layout_score(field_names: Column, rectangles: Column, text: Column) -> Column:
    """Score of a page's structure: known field names, any fields, rectangles where text or fields allow; capped."""
    names = F.transform(F.coalesce(field_names, F.array().cast("array<string>")), F.lower)
    has, size = F.size(names) > 0, F.length(X.strip(F.coalesce(text, F.lit(""))))
    fields = reduce(lambda a, b: a + b, [F.when(_named(names, n), 10).otherwise(0) for n in FIELD_NAMES]) + F.when(has, 15).otherwise(0)
    boxes = F.when(has | (size >= 500), F.when(rectangles >= 20, 50).when(rectangles >= 10, 30).when(rectangles >= 5, 15).otherwise(0)).otherwise(0)
    score = fields + boxes
    return F.least(F.lit(100), F.when(~has & (size < 500), F.least(score, F.lit(20))).otherwise(score))


def not_attached(comment: Column) -> Column:
    """Comments that say the form comes separately."""
    return F.coalesce(comment.rlike(SEPARATELY), F.lit(False))
