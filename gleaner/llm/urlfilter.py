"""URL filters: explicit rules, and a path-template tree per host judged by labelled purity.

Urls that a rule covers are the labelled ones. Paths are first generalised segment by segment (numbers,
long hexadecimal names), and equal shapes of a host are counted once. The tree of shapes is then merged level by level
from the top: under each merged parent a branch becomes a wildcard if it has no labels of its own, or if its share of
blocked labels, as a beta posterior, does not differ from that of its labelled siblings; what stands below the branches
that became one wildcard is pooled before the next level is judged. Shapes that now read alike form a template, and a
template is rejected when its smoothed share of blocked labels reaches REJECT.

DataFrame functions only. Pages are aggregated to shapes before anything is exploded, so a host with a
third of all rows is a few rows; the verdicts come back by an equi-join whose hot keys Spark can split. There is a pass
for each level over the shapes that still share their merged parent with others: a shape that is alone there can't merge any
more and gets the rest of its template at once, so one very deep path costs no passes.

Edge cases: a null url or one without ``://`` has an empty host and path and is allowed unless its template is
rejected; without labels nothing is rejected; an empty table gives no rows; rows that repeat are judged each;
paths of any depth are judged by all their segments; other columns are not carried.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, lower_ascii

#: (verdict, host, path) of the rules for the driver's pages.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Prior labels of a rate, standard errors that tell branches apart, rejected purity.
PRIOR, ERRORS, REJECT = 2.0, 2.0, 0.8
#: Levels that the SQL writes out, since it can't loop; no path of the driver's tables has more than four segments.
SQL_LEVELS = 8
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; empty where there is no ``://``."""
    url = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(url, PARTS, 1)), F.regexp_extract(url, PARTS, 2)


def best_rule(host: Column, path: Column, rules=RULES) -> Column:
    """(size, rule, verdict) of the longest rule that fits, as a struct; null if none does."""
    fits = [
        F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
        for v, h, p in rules
    ]
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<size:int,rule:string,verdict:string>")


def shape(path: Column) -> Column:
    """The segments of a path, with variable ones generalised by how they are written."""
    return F.transform(
        F.split(path, "/", -1),
        lambda s: F.when(s.rlike("^[0-9]+$"), F.lit("{n}"))
        .when(s.rlike("^[0-9]+[.][A-Za-z0-9]+$"), F.regexp_replace(s, "^[0-9]+", "{n}"))
        .when(s.rlike("^[0-9a-f-]{16,}$"), F.lit("{h}"))
        .otherwise(s),
    )


def posterior(blocked: Column, labels: Column, prior: float) -> tuple[Column, Column]:
    """Mean and variance of the blocked share."""
    mean = (blocked + F.lit(PRIOR * prior)) / (labels + F.lit(PRIOR))
    return mean, mean * (1 - mean) / (labels + F.lit(PRIOR + 1))


def templates(spark: SparkSession, shapes: DataFrame, prior: float) -> DataFrame:
    """(host, shape, template): each shape after the tree's similar branches have merged, from the top down."""
    active = shapes.select("host", "shape", "blocked", "labels", F.lit("").alias("template"))
    finished, level = [], 1
    while True:
        steps = active.withColumn("segment", F.get("shape", F.lit(level)))
        node = steps.where("segment is not null").groupBy("host", "template", "segment").agg(*[F.sum(c).alias(c) for c in ("blocked", "labels")], F.count(F.lit(1)).alias("shapes"))
        total = node.groupBy("host", "template").agg(F.count(F.lit(1)).alias("kids"), F.sum("shapes").alias("all_shapes"), *[F.sum(c).alias(f"all_{c}") for c in ("blocked", "labels")])
        other = F.col("all_labels") - F.col("labels")
        mean, var = posterior(F.col("blocked"), F.col("labels"), prior)
        rest, rest_var = posterior(F.col("all_blocked") - F.col("blocked"), other, prior)
        alike = (other > 0) & ((mean - rest) * (mean - rest) <= F.lit(ERRORS * ERRORS) * (var + rest_var))
        wild = (F.col("kids") > 1) & ((F.col("labels") == 0) | alike)
        merged = node.join(total, ["host", "template"]).select("host", "template", "segment", F.when(wild, F.lit("*")).otherwise(F.col("segment")).alias("as"), (F.col("all_shapes") == 1).alias("alone"))
        steps = steps.join(merged, ["host", "template", "segment"], "left")
        rest_of = F.array_join(F.slice("shape", level + 1, F.size("shape")), "/")
        named = F.when(F.col("as").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), F.when(F.col("alone"), rest_of).otherwise(F.col("as"))))
        over = F.col("as").isNull() | F.col("alone") | (F.size("shape") <= level + 1)
        kept = keep(spark, steps.select("host", "shape", "blocked", "labels", named.alias("template"), over.alias("over")), "tree")
        finished.append(kept.where("over"))
        active, level = kept.where("not over").drop("over"), level + 1
        if active.isEmpty():
            return reduce(DataFrame.unionByName, finished).select("host", "shape", "template")


def judge(spark: SparkSession, pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, and the template with its purity."""
    host, path = parts(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("best", best_rule(F.col("host"), F.col("path"), rules)).withColumn("shape", shape(F.col("path")))
    known = F.col("best").isNotNull()
    shapes = keep(spark, rows.groupBy("host", "shape").agg(F.count_if(known & (F.col("best")["verdict"] == "block")).alias("blocked"), F.count_if(known).alias("labels")), "shapes")
    blocked, labels = shapes.agg(F.coalesce(F.sum("blocked"), F.lit(0)), F.coalesce(F.sum("labels"), F.lit(0))).first()  # one row
    prior = blocked / labels if labels else 0.0
    named = templates(spark, shapes, prior)
    counted = shapes.join(named, ["host", "shape"]).groupBy("host", "template").agg(F.sum("blocked").alias("blocked"), F.sum("labels").alias("labels"))
    judged = counted.select("host", "template", posterior(F.col("blocked"), F.col("labels"), prior)[0].alias("purity"))
    verdicts = keep(spark, named.join(judged, ["host", "template"]), "verdicts")
    out = rows.join(verdicts, ["host", "shape"], "left")
    return out.select(
        "page_id", "host", "path", F.col("best")["rule"].alias("rule"),
        F.coalesce(F.col("best")["verdict"], F.when(F.col("purity") >= REJECT, F.lit("block")), F.lit("allow")).alias("verdict"),
        "template", "purity",
    )


def sql() -> str:
    """The same rows as DuckDB SQL, over the view ``pages``."""
    fits = ", ".join(
        f"CASE WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN {{'size': {len(h + p)}, 'rule': '{h + p}', 'verdict': '{v}'}} END" for v, h, p in RULES
    )

    def mean(b: str, n: str) -> str:
        return f"(({b}) + {PRIOR!r} * prior) / (({n}) + {PRIOR!r})"

    def var(b: str, n: str) -> str:
        return f"{mean(b, n)} * (1 - {mean(b, n)}) / (({n}) + {PRIOR + 1!r})"

    own, rest = ("blocked", "labels"), ("all_blocked - blocked", "all_labels - labels")
    levels = "".join(f"""
node{k} AS MATERIALIZED (SELECT host, template, shape[{k + 1}] AS segment, sum(blocked) AS blocked, sum(labels) AS labels FROM tree{k - 1} WHERE len(shape) > {k} GROUP BY ALL),
total{k} AS MATERIALIZED (SELECT host, template, count(*) AS kids, sum(blocked) AS all_blocked, sum(labels) AS all_labels FROM node{k} GROUP BY ALL),
merged{k} AS MATERIALIZED (
  SELECT host, template, segment, CASE WHEN kids > 1 AND (labels = 0 OR (all_labels - labels > 0
    AND ({mean(*own)} - {mean(*rest)}) * ({mean(*own)} - {mean(*rest)}) <= {ERRORS * ERRORS} * ({var(*own)} + {var(*rest)}))) THEN '*' ELSE segment END AS named
  FROM node{k} JOIN total{k} USING (host, template), one),
tree{k} AS MATERIALIZED (
  SELECT t.host, t.shape, t.blocked, t.labels, CASE WHEN named IS NULL THEN t.template ELSE t.template || '/' || named END AS template
  FROM tree{k - 1} t LEFT JOIN merged{k} m ON m.host = t.host AND m.template = t.template AND m.segment = t.shape[{k + 1}] AND len(t.shape) > {k}),""" for k in range(1, SQL_LEVELS + 1))
    return f"""
WITH cut AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{PARTS}', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '{PARTS}', 2) AS path FROM pages),
ruled AS (
  SELECT page_id, host, path, list_max([{fits}]) AS best,
         list_transform(string_split(path, '/'), lambda s: CASE WHEN regexp_matches(s, '^[0-9]+$') THEN '{{n}}'
           WHEN regexp_matches(s, '^[0-9]+[.][A-Za-z0-9]+$') THEN regexp_replace(s, '^[0-9]+', '{{n}}')
           WHEN regexp_matches(s, '^[0-9a-f-]{{16,}}$') THEN '{{h}}' ELSE s END) AS raw FROM cut),
shaped AS MATERIALIZED (SELECT page_id, host, path, best, raw AS shape FROM ruled),
shapes AS MATERIALIZED (
  SELECT host, shape, count(*) FILTER (best.verdict = 'block') AS blocked, count(*) FILTER (best IS NOT NULL) AS labels
  FROM shaped GROUP BY host, shape),
one AS MATERIALIZED (SELECT CASE WHEN sum(labels) > 0 THEN sum(blocked) / sum(labels) ELSE 0.0 END AS prior FROM shapes),
tree0 AS MATERIALIZED (SELECT host, shape, blocked, labels, '' AS template FROM shapes),{levels}
judged AS (SELECT host, template, {mean("sum(blocked)", "sum(labels)")} AS purity FROM tree{SQL_LEVELS}, one GROUP BY host, template, prior)
SELECT page_id, host, path, best.rule AS rule,
       coalesce(best.verdict, CASE WHEN purity >= {REJECT} THEN 'block' END, 'allow') AS verdict
FROM shaped LEFT JOIN (SELECT host, shape, purity FROM tree{SQL_LEVELS} JOIN judged USING (host, template)) USING (host, shape)
"""
