"""Titles of decisions: ``decision, requester, material, code``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank, found, let, strip

#: How a title begins that names a decision.
DECISIONS = ("exclusion\\s+denied", "exclusion\\s+granted", "exclusion\\s+approved", "exclusion\\s+partially\\s+approved", "exclusion\\s+partially\\s+granted", "exclusion\\s+request\\s+withdrawn", "denied", "approved", "granted")
DECISION = "(?iU)^(?:" + "|".join(DECISIONS) + ")"
#: The look ahead spares the test of a word's beginning at characters that aren't an H.
CODE = r"(?iU)(?=H)\bHTS(?:US)?\s*([0-9]{8,10})\b"
#: At the end of a part, which is stripped and has no comma; tried once for a run of blanks.
CODE_AT_END = r"(?iU)(?<!\s)\s*HTS(?:US)?\s*[0-9]{8,10}$"


def decision_of(title: Column) -> Column:
    """The decision that a title begins with; null without one."""
    return F.initcap(found(strip(title), DECISION, 0))


def parse_title(title: Column) -> Column:
    """Struct of decision, requester, material and hts. A title of blanks has the requester ''; null and '' have none."""
    return let(strip(title), lambda raw: let(F.initcap(found(raw, DECISION, 0)), lambda decision: let(F.transform(F.split(raw, ",", -1), strip), lambda parts: _cut(title, raw, decision, parts))))


def _cut(title: Column, raw: Column, decision: Column, parts: Column) -> Column:
    # the place of the requester: the first part, or the second after a decision
    first = F.when(F.contains(F.lower(F.get(parts, F.lit(0))), F.lower(decision)), 1).otherwise(0)
    # the parts between the requester and the last one, which may end with the code or be nothing else
    between = lambda n: F.slice(parts, n + 2, F.greatest(F.size(parts) - n - 2, F.lit(0)))

    def material(n: Column) -> Column:
        last = F.get(parts, F.size(parts) - 1)
        return let(F.regexp_replace(last, CODE_AT_END, ""), lambda kept: strip(F.array_join(F.when((kept == "") & (last != ""), between(n)).otherwise(F.concat(between(n), F.array(kept))), ", ")))

    return let(first, lambda n: F.struct(
        decision.alias("decision"),
        F.when(~blank(title), F.get(parts, n)).alias("requester"),
        F.when(~blank(title) & (F.size(parts) > n + 1), F.nullif(material(n), F.lit(""))).alias("material"),
        found(raw, CODE).alias("hts"),
    ))


def normalize_decision(decision: Column) -> Column:
    def kind(d: Column) -> Column:
        granted = d.contains("approved") | d.contains("granted")
        return (
            F.when(blank(d), None)
            .when(d.contains("withdrawn"), "Withdrawn")
            .when(d.contains("denied"), "Denied")
            .when(d.contains("partially") & granted, "Partially Approved")
            .when(granted, "Approved")
            .otherwise(F.initcap(d))
        )

    return let(F.lower(decision), kind)
