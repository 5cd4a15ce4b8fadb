"""Pairs of like names, without comparing all with all.

If the shorter of two names within k edits is cut into k + 2 pieces, two pieces or more occur in the longer name as they are. Take
the first two. The edits before, between and after them are at least as many as the pieces that were changed there, and as
the places by which what follows has moved; together they are k at the most. Only names that meet in two pieces so placed
are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def edits(length: Column, percent: int) -> Column:
    """Most edits of two names, the longer of which has so many characters."""
    return F.floor(length * (100 - percent) / 100).cast("int")


def upto(first: Column, last: Column) -> Column:
    """One row for each whole number from first to last; none if there is none."""
    return F.explode(F.when(first <= last, F.sequence(first.cast("int"), last.cast("int"))))


def token(one: Column, two: Column) -> Column:
    """Two pieces with all that must agree; that others share the hash costs a comparison and changes nothing."""
    piece = lambda start, k: F.substring("name", start + 1, F.col(f"wide_{k}"))
    return F.xxhash64("short", "most", "i", "j", piece(one, "i"), piece(two, "j")).alias("token")


def placed(rows: DataFrame) -> DataFrame:
    """Rows of (short, most) with each two pieces i < j of a name of ``short`` characters cut for ``most`` edits: at (from 0), wide."""
    rows = rows.select("*", upto(F.lit(0), F.col("most")).alias("i"))
    rows = rows.select("*", upto(F.col("i") + 1, F.col("most") + 1).alias("j"))
    cut = lambda i: F.floor(i * F.col("short") / (F.col("most") + 2)).cast("int")
    return rows.withColumns({f"at_{k}": cut(F.col(k)) for k in "ij"} | {f"wide_{k}": cut(F.col(k) + 1) - cut(F.col(k)) for k in "ij"})


def shorter_tokens(names: DataFrame, percent: int) -> DataFrame:
    """(token, a): the pieces of each name as the shorter one, for every number of edits that a partner's length allows."""
    short = F.length("name")
    longest = F.floor(short * 100 / percent).cast("int")
    rows = names.select("name", short.alias("short"), upto(edits(short, percent), edits(longest, percent)).alias("most"))
    return placed(rows).select(token(F.col("at_i"), F.col("at_j")), F.col("name").alias("a"))


def longer_tokens(names: DataFrame, percent: int) -> DataFrame:
    """(token, b): what stands in each name as the longer one where two pieces of a shorter one, of any allowed length, may be."""
    rows = names.withColumn("long", F.length("name")).withColumn("most", edits(F.col("long"), percent))
    rows = placed(rows.select("*", upto(F.greatest(F.lit(1), F.col("long") - F.col("most")), F.col("long")).alias("short")))
    i, most, moved_i, moved_j = (F.col(c) for c in ("i", "most", "moved_i", "moved_j"))
    one, two, changed = F.col("at_i") + moved_i, F.col("at_j") + moved_j, F.col("j") - i - 1
    before = F.greatest(i, F.abs(moved_i))
    rows = rows.select("*", upto(changed - most, most - changed).alias("moved_i")).where((before + changed <= most) & (one >= 0))
    rows = rows.select("*", upto(-most, most).alias("moved_j"))
    edited = before + F.greatest(changed, F.abs(moved_j - moved_i)) + F.abs(F.col("long") - F.col("short") - moved_j)
    fits = (one + F.col("wide_i") <= two) & (two + F.col("wide_j") <= F.col("long"))
    return rows.where((edited <= most) & fits).select(token(one, two), F.col("name").alias("b")).distinct()


def like_pairs(df: DataFrame, name_col: str, percent: int = 80, q: int = 2) -> DataFrame:
    """Distinct names a < b (in UTF-8 order) with edits * 100 <= (100 - percent) * the longer one's characters: a, b, edits.

    No pair is lost. Each name counts once, however many rows have it; null and empty names are like nothing. Names that
    share a hot piece meet by an equi-join that adaptive execution can split, and are compared up to the allowed edits only. As
    ever, q * (100 - percent) may be 100 at the most: of names less alike, pieces say next to nothing.
    """
    if q < 1 or not 0 < percent <= 100 or q * (100 - percent) > 100:
        raise ValueError(f"names {percent} % alike may share no {q} characters")
    names = df.select(F.col(name_col).alias("name")).where(F.length("name") > 0).distinct()
    same = F.length("a") == F.length("b")
    # the rows made of a name aren't in Spark's estimate, which would take them for few and send them all through the driver
    met = shorter_tokens(names, percent).join(longer_tokens(names, percent).hint("merge"), "token").where(~same | (F.col("a") < F.col("b")))
    most = edits(F.greatest(F.length("a"), F.length("b")), percent)
    near = met.select("a", "b", F.call_function("levenshtein", "a", "b", most).alias("edits")).where("edits >= 0 AND a <> b")
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("edits").cast("bigint").alias("edits")).distinct()
