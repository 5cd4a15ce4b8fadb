"""Download cards of captured pages by the structure of their HTML, so that each card's version and mark are its own.

Pages become rows of tags and texts. A running sum of opened less closed tags gives each its depth; an opening tag is closed by
the next closing one of its depth, which gives elements their places and so their texts. All windows are within a page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Comments, scripts and styles (left out), tags, and texts between them.
PARTS = r"(?is)<!--.*?(?:-->|$)|<script\b.*?(?:</script\s*>|$)|<style\b.*?(?:</style\s*>|$)|<[!?][^>]*>|</?[a-z][^>]*>|[^<]+|<"
#: Elements without an end tag, and those whose end tag pages leave out.
UNCLOSED = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "p", "li", "dt", "dd", "option", "td", "th", "tr", "thead", "tbody", "colgroup")
#: What a card's heading says, and where its version stands.
HEADING, VERSION = r"(?iU)Federal\s+(Employment|Accessions|Separations)\s+Raw\s+Data\s*\(([^)]+)\)", r"(?iU)Version:\s*(\d+)"
ENTITIES = (("&nbsp;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#40;", "("), ("&#41;", ")"), ("&amp;", "&"))


def decoded(text: Column, entities=ENTITIES) -> Column:
    """Texts with entities, the usual ones if none are named, as characters."""
    for name, character in entities:
        text = F.replace(text, F.lit(name), F.lit(character))
    return text


def elements(pages: DataFrame, key: str, html_col: str = "html", entities=ENTITIES) -> DataFrame:
    """Elements of pages: key, name, class, level, first and last (places of its tags), start and end (in the page's text).

    ``key`` must be one page's. Elements that are never closed, and those of ``UNCLOSED``, are left out; null pages have none.
    """
    parts = pages.select(key, F.posexplode(F.regexp_extract_all(html_col, F.lit(PARTS), F.lit(0))).alias("place", "part"))
    name = F.lower(F.regexp_extract("part", r"^</?([a-zA-Z][a-zA-Z0-9]*)", 1))
    tag = (name != "") & ~name.isin(*UNCLOSED) & ~F.col("part").endswith("/>") & ~name.isin("script", "style")
    step = F.when(tag & F.col("part").startswith("</"), -1).when(tag, 1).otherwise(0)
    text = F.when(F.col("part").startswith("<") & (F.length("part") > 1), "").otherwise(decoded(F.col("part"), entities))
    before = W.partitionBy(key).orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = parts.select(key, "place", "part", name.alias("name"), step.alias("step"), F.length(text).alias("size"))
    placed = placed.withColumn("depth", F.sum("step").over(before)).withColumn("at", F.sum("size").over(before)).where("step <> 0")
    placed = placed.withColumn("level", F.when(F.col("step") == 1, F.col("depth")).otherwise(F.col("depth") + 1))
    same = W.partitionBy(key, "level").orderBy("place")
    paired = placed.withColumn("last", F.lead("place").over(same)).withColumn("end", F.lead("at").over(same)).withColumn("closes", F.lead("step").over(same))
    found = F.lower(F.regexp_extract("part", r"""(?is)\bclass\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", 1))
    return paired.where("step = 1 AND closes = -1").select(key, "name", F.regexp_replace(found, "^[\"']|[\"']$", "").alias("class"), "level", F.col("place").alias("first"), "last", F.col("at").alias("start"), "end")


def page_text(html: Column, entities=ENTITIES) -> Column:
    """The text of a page, in which ``elements`` of the same entities has its places."""
    parts = F.regexp_extract_all(html, F.lit(PARTS), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.when(p.startswith("<") & (F.length(p) > 1), "").otherwise(decoded(p, entities))), "")


def structured_cards(pages: DataFrame, key: str, html_col: str = "html") -> DataFrame:
    """Cards of pages: key, card_no (from 0, in the page's order), source, dateLabel, version (``1`` if none), isCurrent.

    A card's heading is an h1 to h6 or an element whose class holds ``title``. Its container is the nearest element around it
    (or itself) whose class holds ``card``, or else the parent of its parent; version and mark are sought in there alone.
    """
    from ..kept import keep

    spark = pages.sparkSession
    own = keep(spark, elements(pages, key, html_col), "elements")
    texts = pages.select(F.col(key).alias("_key"), page_text(F.col(html_col)).alias("_text"))
    part = lambda a, b: F.substring("_text", F.col(a) + 1, F.col(b) - F.col(a))
    heads = own.where(F.col("name").rlike("^h[1-6]$") | F.col("class").contains("title"))
    heads = heads.join(texts, F.col(key) == F.col("_key")).withColumn("_head", part("start", "end")).where(F.col("_head").rlike(HEADING)).drop("_text", "_key")
    around = own.select(F.col(key).alias("_key"), F.col("class").contains("card").alias("card"), F.col("level").alias("_level"), F.col("first").alias("_first"), F.col("last").alias("_last"), F.struct("start", "end").alias("box"))
    near = heads.join(around, (F.col(key) == F.col("_key")) & (F.col("_first") <= F.col("first")) & (F.col("_last") >= F.col("last")), "left")
    card = F.max_by(F.when(F.col("card"), F.col("box")), F.when(F.col("card"), F.col("_first")))
    parent = F.max_by(F.when(F.col("_level") == F.col("level") - 2, F.col("box")), F.when(F.col("_level") == F.col("level") - 2, F.col("_first")))
    boxed = near.groupBy(key, "first", "_head").agg(F.coalesce(card, parent).alias("box")).select(key, "first", "_head", F.col("box")["start"].alias("start"), F.col("box")["end"].alias("end"))
    held = boxed.join(texts, F.col(key) == F.col("_key")).withColumn("_own", F.coalesce(part("start", "end"), F.lit("")))
    version = F.regexp_extract("_own", VERSION, 1)
    order = W.partitionBy(key).orderBy("first")
    return held.select(
        key, (F.row_number().over(order) - 1).alias("card_no"), F.regexp_extract("_head", HEADING, 1).alias("source"), F.regexp_replace(F.regexp_extract("_head", HEADING, 2), r"(?U)^\s+|\s+$", "").alias("dateLabel"),
        F.when(version == "", "1").otherwise(version).alias("version"), F.col("_own").contains("Current").alias("isCurrent"),
    )
