"""Queries against their SQL on inputs that the test tables lack."""

import os
import random
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F
from test_catalogue import spark_rows

from gleaner.functions import text as X
from gleaner.operators import likeness
from gleaner.plans import catalogue


def agrees(spark, name: str, **tables) -> list:
    """The rows of a query over the given frames, which must be those of its SQL."""
    folder, con = tempfile.mkdtemp(prefix="gleaner-test-"), duckdb.connect()
    for t, df in tables.items():
        df.coalesce(1).write.parquet(f"file://{folder}/{t}.parquet")
        con.execute(f"create view {t} as select * from read_parquet('{os.path.join(folder, t)}.parquet/*.parquet')")
    cols, got = spark_rows(catalogue.QUERIES[name](spark, "file://" + folder))
    want = con.execute(f"select {', '.join(f'"{c}"' for c in cols)} from ({catalogue.SQL[name]})").fetchall()
    assert got == sorted((tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in want), key=repr)
    return got


def test_headings_read_no_entity_but_amp(spark):
    pages = [(1, "<p>&quot;x&quot;</p><h1>a &quot;b&quot; &amp; c &lt;<b>d</b>&nbsp;&#39;</h1><h1>&amp;quot;</h1>"), (2, "<h1></h1>"), (3, None)]
    got = agrees(spark, "page_headings", pages=spark.createDataFrame(pages, "page_id bigint, html string"))
    assert ("a &quot;b&quot; & c &lt;d&nbsp;&#39;", 1) in got


def test_grays_are_of_float_products(spark):
    # as float these thousandfold values are whole numbers, as double a little less
    rows = [(i, [0.7799999713897705, 0.671999990940094, 0.6269999742507935, 0.1 * i, -0.35]) for i in range(6)]
    agrees(spark, "prepared_images", embeddings=spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_second_dispatcher_prepares_its_rows_once(spark):
    assert plan(catalogue.QUERIES["extract_second"](spark, "/root/testdata/sf0.001")).count("LeftAnti") == 1


@pytest.mark.parametrize("name", ["extract_second", "form_fields_v1", "form_fields_v2", "blank_images", "enhanced_images"])
def test_costly_rows_of_small_files_are_dealt_over_all_cores(spark, name):
    assert "REPARTITION_BY_NUM" in plan(catalogue.QUERIES[name](spark, "/root/testdata/sf0.001"))


def test_quicker_text_steps_give_what_patterns_give(spark):
    ends = ["", *"\t\n\x0b\x0c\r\x1c\x85\xa0 ᠎  ​    　 ", "\r\n", " \n\n", "　\xa0"]
    rows = [(a + m + b,) for a in ends for b in ends for m in ("", "x", "x  y")] + [(None,)]
    df = spark.createDataFrame(rows, "v string")
    assert df.where(~X.strip(F.col("v")).eqNullSafe(F.regexp_replace("v", r"(?U)^\s+|\s+$", ""))).count() == 0
    words = spark.createDataFrame([("3FRVFTUPS*OGPSNBUJPO",), ("3FRVFTU3FRVFTUPS/BNF QVCMJDEPDVNFOU",), ("7&34*0",), ("",), (None,)], "v string")
    plain = F.col("v")
    for a, b in X.GARBLED:
        plain = F.replace(plain, F.lit(a), F.lit(b))
    assert words.where(~X.replaced(F.col("v"), X.GARBLED).eqNullSafe(plain)).count() == 0


def test_names_of_few_syllables_seldom_meet(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice(("an", "ma", "jo", "el", "to", "ren", "vic", "son", "dal", "ber", "tan", "lo")) for _ in range(n))
    names = spark.createDataFrame([(n,) for n in {f"{word(3)} {word(4)}" for _ in range(600)}], "name string")
    met = likeness.shorter_tokens(names, 80).join(likeness.longer_tokens(names, 80), "token").where("a <> b").count()
    assert met < 0.05 * names.count() ** 2 / 2  # by seldom q-grams alone most pairs met
