"""The three harvests from landed tables to reports, each one lineage of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes as K
from ..functions import text as X
from ..functions import titles as T
from ..operators import classify as C
from ..operators import extract as E
from ..operators import relational as R
from ..sources import landing as L
from ..sources import rasters
from ..sources.config import Config

#: The columns of a final row, in their order.
FINAL = ("documentId", "Document URL", "Posted Date", "Last Modified Date", "attachment_url", "USTR Response Date", "Withdrawn", *E.FIELDS, "extraction_method", "pipeline_script", "status", "filled", "form_match_score", "Notes")
TARGET, NEARLY, MOST = 11_075, 10_800, 10_000


def harvest_report(scans: list[DataFrame], names: list[str], target: int = TARGET) -> dict[str, DataFrame]:
    """Listings under several sort orders (documentId, title, sort_strategy, page_number, pos, ...) to the sheets of the report."""
    united = R.union_scans(scans, "documentId")
    parsed = united.withColumn("t", T.parse_title(F.col("title"))).withColumns({"decision": F.col("t.decision"), "requester": F.col("t.requester"), "material": F.col("t.material"), "hts": F.col("t.hts")})
    data = parsed.withColumn("decision_normalized", T.normalize_decision(F.col("decision"))).withColumnRenamed("title", "title_raw").drop("t")
    n = F.count(F.lit(1))
    grade = F.when(n >= NEARLY, 2).when(n >= MOST, 1).otherwise(0)
    return {
        "data": data,
        "summary": R.metrics(data, total_documents=n, target_documents=F.max(F.lit(target)), success_rate=F.bround(n / target * 100, 1), grade=grade),
        "strategies": R.value_counts(data, "sort_strategy", "Documents_Found"),
        "decisions": R.breakdown(data, "decision_normalized"),
        "new_per_strategy": R.found_per_strategy(united, names),
    }


def file_texts(pages: DataFrame, ocr: DataFrame | None = None, config: Config = Config()) -> DataFrame:
    """doc_id, pos, first2 and full of landed files, each page closed by a line end.

    pages: doc_id, att_no, page_no, text. ocr: doc_id, att_no, ocr_text of files that ``needs_ocr`` names; where the pages
    give too little text, the recognised text takes its place, its first hundred lines that of the first two pages.
    """
    # a file's pages are few
    ordered = F.array_sort(F.collect_list(F.struct("page_no", "text")))
    texts = pages.groupBy("doc_id", F.col("att_no").alias("pos")).agg(ordered.alias("p"))
    closed = lambda p: F.array_join(F.transform(p, lambda x: F.concat(F.coalesce(x["text"], F.lit("")), F.lit("\n"))), "")
    texts = texts.select("doc_id", "pos", closed(F.slice("p", 1, 2)).alias("first2"), closed(F.col("p")).alias("full"))
    if ocr is None:
        return texts
    texts = texts.join(ocr.select("doc_id", F.col("att_no").alias("pos"), "ocr_text"), ["doc_id", "pos"], "full")
    short = F.length(X.strip(F.coalesce("full", F.lit("")))) < config.ocr_least_text
    read = short & F.coalesce(F.col("ocr_text") != "", F.lit(False))
    lines = F.array_join(F.slice(F.split("ocr_text", "\n", -1), 1, 100), "\n")
    return texts.select("doc_id", "pos", F.when(read, lines).otherwise(F.col("first2")).alias("first2"), F.when(read, F.col("ocr_text")).otherwise(F.col("full")).alias("full"))


def needs_ocr(pages: DataFrame, config: Config = Config()) -> DataFrame:
    """(doc_id, att_no) of files whose pages give too little text; only these are worth recognising."""
    return file_texts(pages).where(F.length(X.strip(F.col("full"))) < config.ocr_least_text).select("doc_id", F.col("pos").alias("att_no"))


def choose_forms(docs: DataFrame, attachments: DataFrame, pages: DataFrame, ocr: DataFrame | None = None, config: Config = Config()) -> DataFrame:
    """First docket: each document (documentId, ...) with its best form among its attachments (doc_id, attachments) by their text.

    pages and ocr: as for ``file_texts``. Reply letters and small files never reach the classifier.
    """
    files = R.large_enough(R.pdf_urls(R.attachments(attachments)))
    judged = C.detect(files.join(file_texts(pages, ocr, config), ["doc_id", "pos"])).drop("first2", "full")
    best = R.best_candidate(judged.where("is_form"), "doc_id", "score", "pos")
    picked = best.select(F.col("doc_id").alias("documentId"), F.col("url").alias("attachment_url"), F.col("title").alias("attachment_title"), "msg", "score")
    return docs.join(picked, "documentId", "left")


def response_dates(letters: DataFrame, strict: bool = False) -> DataFrame:
    """Dates of reply letters (documentId, pos, first_page): the first landed letter of each document decides."""
    first = R.first_rows(letters.where(F.col("first_page").isNotNull()), ["documentId"], "pos")
    return first.select("documentId", K.letter_date(F.col("first_page"), strict).alias("USTR Response Date"))


def enriched(docs: DataFrame, dates: DataFrame, details: DataFrame, keep: tuple[str, ...] = ("Posted Date", "Last Modified Date")) -> DataFrame:
    """Documents with the reply's date and whether they are withdrawn; other date columns go."""
    return R.drop_date_columns(docs, keep).join(dates, "documentId", "left").join(details.select("documentId", "Withdrawn"), "documentId", "left")


def fields_report(docs: DataFrame, widgets: DataFrame) -> dict[str, DataFrame]:
    """First docket: fields of the chosen forms, and their report. docs: documentId, doc_id, attachment_url, landed, pages, ocr_text, Withdrawn."""
    marked = E.landed_status(docs)
    early = marked.where(F.col("status").isNotNull()).withColumns({**{f: F.lit("") for f in E.FIELDS}, "extraction_method": F.lit(""), "filled": F.lit(0)})
    late = E.extract_v1(marked.where(F.col("status").isNull()).drop("status"), widgets)
    data = early.unionByName(late).drop("pages", "ocr_text", "landed")
    data = data.withColumns({"row_fill": R.fill_v1(F.col("extraction_method")), "cell_fill": R.fill_withdrawn_cell(F.col("Withdrawn"))})
    c = F.col
    summary = R.metrics(
        data, total=F.count(F.lit(1)), form_fields=R.count_where(c("extraction_method") == "Form Fields"), scanned_ocr=R.count_where(c("extraction_method") == "Scanned (OCR)"), success=R.count_where(c("status") == "Success"),
        low=R.count_where(c("status") == "Low"), error=R.count_where(c("status") == "Error"), no_url=R.count_where(c("attachment_url") == "no_url"), withdrawn=R.count_where(c("Withdrawn") == 1), avg_filled=F.bround(F.avg("filled"), 1),
    )
    return {"data": data, "summary": summary}


def second_docket(ids: DataFrame, existing: DataFrame, info: DataFrame, files: DataFrame, widgets: DataFrame, dates: DataFrame, threshold: int = Config().form_score) -> DataFrame:
    """Second docket, incremental: new results for ids that aren't done, kept rows for those that are, by id.

    ids: documentId. info: documentId, Document URL, Posted Date, Last Modified Date, Withdrawn, comment. files: documentId, pos,
    url, title, pages (array of the first pages' text), raw_text, ocr_text, score (of the form detector). Results have FINAL's columns.
    """
    todo = R.not_done(ids, existing, "documentId").join(info, "documentId", "left")
    titles = files.groupBy("documentId").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "title", "url"))), lambda x: F.struct(x["title"].alias("title"), x["url"].alias("url"))).alias("listed"))
    todo = todo.join(titles, "documentId", "left").withColumn("listed", F.coalesce("listed", F.array().cast("array<struct<title:string,url:string>>")))
    names, comment = F.transform("listed", lambda x: x["title"]), F.coalesce("comment", F.lit(""))
    todo = X.fenced(todo, {"by_meta": C.new_pattern_by_metadata(names, comment), "meta": C.metadata_fields(names, comment), "absent": C.not_attached(comment)})
    by_meta = todo.where("by_meta and not absent")
    meta_fields = {f: F.coalesce(F.col(f"meta.{f}"), F.lit("")) for f in ("q3_htsus", "q2_product_description", "q4_organization", "q4_requestor_name")}
    listed_url = F.coalesce(F.get("listed", F.col("meta.place"))["url"], F.get(F.filter("listed", lambda x: ~R.reply_any_case(x["title"])), F.lit(0))["url"], F.get("listed", F.lit(0))["url"], F.lit(""))
    by_meta = by_meta.withColumns({**{f: meta_fields.get(f, F.lit("")) for f in E.FIELDS}, "attachment_url": listed_url, "extraction_method": F.lit("Metadata"), "own": F.lit("new pattern"), "form_match_score": F.lit(100), "own_notes": F.lit("New pattern")})
    by_meta = by_meta.withColumn("filled", X.total([F.col(f) != "" for f in E.FIELDS]))
    rest = todo.where("absent or not by_meta")

    # only files that can matter are read: reply letters and documents that metadata settle are left out before
    judged = files.where(~R.reply_any_case(F.col("title"))).join(rest.where("not absent").select("documentId"), "documentId", "left_semi")
    page = lambda n: F.array_join(F.slice(F.coalesce("pages", F.array().cast("array<string>")), 1, n), "\n")
    judged = X.fenced(judged, {**{f"_p{n}": X.decode_garbled(page(n)) for n in (2, 3, 5)}, "_ocr": X.decode_garbled(F.col("ocr_text"))})
    judged = X.fenced(judged, {"letter": C.new_pattern(F.col("_p5")), "rescue": C.rescue_score(F.col("_ocr")), "wrong": C.wrong_type(F.col("_p2"), F.col("_p3"), F.col("_p5"))}).drop("_p2", "_p3", "_p5", "_ocr")
    judged = R.ranked(judged.drop("rank"), "documentId", "score", "pos").drop("pos", "title")
    top = R.first_rows(judged, ["documentId"], "rank")
    saved = R.rescued(judged.join(top.where(F.col("score") < threshold).select("documentId"), "documentId", "left_semi"), "documentId", "rank", "rescue").withColumn("score", F.col("rescue"))
    pick = top.where(F.col("score") >= threshold).unionByName(saved)
    good = pick.where("not wrong")
    other = judged.where((F.col("rank") > 0) & (F.col("score") >= threshold) & ~F.col("wrong")).join(pick.where("wrong").select("documentId"), "documentId", "left_semi")
    chosen = good.unionByName(R.first_rows(other, ["documentId"], "rank")).withColumnRenamed("documentId", "doc_id")
    fields = E.extract_v2(chosen, widgets).withColumnsRenamed({"doc_id": "documentId", "score": "form_match_score", "url": "attachment_url"})
    fields = fields.select("documentId", "attachment_url", "form_match_score", "letter", "extraction_method", "filled", F.col("status").alias("own"), *E.FIELDS)
    rest = rest.join(fields, "documentId", "left")
    rest = E.backfilled(rest.withColumns({f: F.coalesce(f, F.lit("")) for f in E.FIELDS}), {f: F.when(F.col("by_meta"), c) for f, c in meta_fields.items()})
    new = F.coalesce("letter", F.lit(False)) | (F.col("by_meta") & F.col("own").isNotNull())
    rest = rest.withColumns({
        "own": F.when(new, "new pattern").otherwise(F.coalesce("own", F.lit("pdf not present"))), "own_notes": F.when(new, "New pattern").when(F.col("extraction_method") == "Scanned", "Scanned").otherwise(""),
        "attachment_url": F.coalesce("attachment_url", F.lit("")), "extraction_method": F.coalesce("extraction_method", F.lit("")), "filled": F.coalesce("filled", F.lit(0)), "form_match_score": F.coalesce("form_match_score", F.lit(0)),
    })
    columns = ["documentId", "Document URL", "Posted Date", "Last Modified Date", "Withdrawn", "attachment_url", "extraction_method", "own", "own_notes", "filled", "form_match_score", *E.FIELDS]
    results = by_meta.select(*columns).unionByName(rest.select(*columns)).join(dates, "documentId", "left")
    results = results.withColumns({
        "status": E.result_status(F.col("own"), F.col("Withdrawn")), "Notes": E.result_notes(F.col("own"), F.col("attachment_url"), F.col("own_notes")),
        "USTR Response Date": F.coalesce("USTR Response Date", F.lit("")), "pipeline_script": F.lit("second_docket"),
    }).select(*FINAL)
    kept = R.keep_existing(R.done_rows(R.listed_columns(existing, list(FINAL))), ids, "documentId")
    return results.unionByName(kept, allowMissingColumns=True)


def second_docket_report(results: DataFrame) -> dict[str, DataFrame]:
    """Results with their fills, and the summary."""
    c = F.col
    data = results.withColumn("row_fill", R.fill_v2(c("status"), c("Withdrawn")))
    text = R.contains_word(c("extraction_method"), "Text") & ~R.contains_word(c("extraction_method"), "Scanned")
    return {"data": data, "summary": R.metrics(
        results, total=F.count(F.lit(1)), low=R.count_where(c("status") == "Low"), not_present=R.count_where(c("status") == "pdf not present"), new_pattern=R.count_where(c("status") == "new pattern"),
        withdrawn=R.count_where(c("Withdrawn") == 1), success=R.count_where(c("status") == "Success"), form_fields=R.count_where(R.contains_word(c("extraction_method"), "Form Fields")), text=R.count_where(text),
    )}


def rules_only_docket(ids: DataFrame, existing: DataFrame, attachments: DataFrame, documents: DataFrame) -> DataFrame:
    """The sibling of ``second_docket`` without extraction: statuses of every id, defaults and existing dates merged in.

    attachments and documents: as for ``extract.document_status``, with doc_id.
    """
    todo = R.not_done(ids, existing, "documentId")
    own = documents.join(todo.select(F.col("documentId").alias("doc_id")), "doc_id", "left_semi")
    found = E.document_status(attachments.where(~R.reply_any_case(F.col("title"))), own).withColumnRenamed("doc_id", "documentId")
    found = found.withColumns({"Notes": E.status_notes(F.col("status"), F.col("selection_reason"), F.col("attachment_url")), "filled": F.lit(0), "Withdrawn": F.lit(None).cast("int"), "Posted Date": F.lit(""), "USTR Response Date": F.lit("")}).withColumnRenamed("best_score", "form_match_score")
    found = found.select("documentId", "attachment_url", "extraction_method", "status", "filled", "form_match_score", "Notes", "PDF_check_details", "Withdrawn", "Posted Date", "USTR Response Date")
    merged = R.merge_with_default(todo, found, "documentId", {"status": "pdf not present", "filled": 0, "form_match_score": 0, "Notes": "PDF not present", "attachment_url": "", "extraction_method": ""})
    merged = R.overlay(merged, existing, "documentId", [c for c in ("Posted Date", "USTR Response Date", "Withdrawn") if c in existing.columns])
    return merged.unionByName(R.keep_existing(R.done_rows(R.listed_columns(existing, merged.columns)), ids, "documentId"), allowMissingColumns=True)


def form_score(text: Column, text2: Column, text5: Column, layout: Column, ocr_text: Column, vision: Column | None = None, model: Column | None = None) -> Column:
    """Score of a file by the cascade: wrong kinds 0, vision, layout of 50, model, marks, recognised text, vision again.

    Texts are decoded ones. vision and model: scores that pluggable functions gave (null: none); give them columns filled only where they are needed.
    """
    vision, model = (F.lit(None).cast("int") if c is None else c for c in (vision, model))
    marks = lambda t: X.total(C.any_case(F.lower(t), C.FORM_MARKERS)) * 5
    own, short = layout + marks(text), F.length(X.strip(text)) < 500
    read = F.when(X.strip(F.coalesce(ocr_text, F.lit(""))) != "", layout + marks(ocr_text))
    return (
        F.when(C.cover_letter(text, text5) | C.product_attachment(text), 0)
        .when(vision.isNotNull(), vision)
        .when(layout >= 50, layout)
        .when(model.isNotNull(), model)
        .when((own < C.FORM_SCORE) & short & (read >= C.FORM_SCORE), F.least(read, F.lit(100)))
        .otherwise(F.least(own, F.lit(100)))
    )


def scored_files(files: DataFrame, images: DataFrame, key: str = "path", template=None, recognise=None) -> DataFrame:
    """``files`` (key, text, text2, text5, layout) with vision, ocr_text and form_score.

    images: key, page_no, pixels, width. The first page of a file is searched for ``template``, which makes its vision score
    100; files with under 500 characters are recognised by ``recognise`` (a prepared page to its text). Only the images
    that are needed go to Python workers.
    """
    none = files.select(key).limit(0)
    seen = none.select(key, F.lit(True).alias("found")) if template is None else rasters.holding(images.where("page_no = 1"), template, key).where("found")
    files = files.join(seen, key, "left").withColumn("vision", F.when(F.col("found"), 100)).drop("found")
    short = files.where(F.col("vision").isNull() & (F.length(X.strip(F.coalesce("text", F.lit("")))) < 500)).select(key)
    read = none.select(key, F.lit("").alias("ocr_text")) if recognise is None else rasters.recognised_pages(images.join(short, key, "left_semi"), recognise, key)
    score = form_score(F.col("text"), F.col("text2"), F.col("text5"), F.col("layout"), F.col("ocr_text"), F.col("vision"))
    return files.join(read, key, "left").withColumn("form_score", score)


def download_cards(pages: DataFrame, files: DataFrame) -> DataFrame:
    """Cards of captured site pages (folder, page_no, html) whose file isn't there: with file_name, the current version only."""
    cards = L.cards(L.until_empty(pages)).where("isCurrent")
    return R.missing_files(cards.withColumn("file_name", K.file_name(F.col("source"), F.col("dateLabel"), F.col("version"))), files)
