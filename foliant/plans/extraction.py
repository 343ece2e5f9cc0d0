"""Affiliations, mails and links out of batch results of a language model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.documents import call_to_json, parse_json
from foliant.functions.text import strip_fence
from foliant.operators.aggregates import extraction_quality
from foliant.operators.joins import by_ordinal

FIELDS = ("title", "authors", "aff", "email", "github", "project")


def decoded(results: DataFrame) -> DataFrame:
    """row_ix, the fields, ok and missing (names of the fields that an answer lacks) of each result (row_ix, content).

    Clean JSON is parsed in the JVM; only answers that it can't read go through repair and, if that fails, are read as a
    call expression.
    """
    schema = "map<string,string>"
    fenced = results.select("row_ix", strip_fence(F.col("content")).alias("c"))
    direct = fenced.withColumn("m", F.from_json("c", schema, {"mode": "PERMISSIVE"}))
    # An unreadable answer parses to NULL or to no entries.
    good = direct.where(F.size("m") > 0)
    bad = direct.where(F.coalesce(F.size("m"), F.lit(-1)) <= 0).select("row_ix", F.from_json(F.coalesce(parse_json("c"), call_to_json("c")), schema).alias("m"))
    both = good.select("row_ix", "m").unionByName(bad)
    values = [F.coalesce(F.try_element_at("m", F.lit(f)), F.lit("")).alias(f) for f in FIELDS]
    missing = F.array_join(F.filter(F.array(*[F.when(F.try_element_at("m", F.lit(f)).isNull(), f) for f in FIELDS]), lambda x: x.isNotNull()), ";")
    return both.select("row_ix", *values, (F.coalesce(F.size("m"), F.lit(-1)) > 0).alias("ok"), F.when(F.coalesce(F.size("m"), F.lit(-1)) > 0, missing).otherwise(";".join(FIELDS)).alias("missing"))


def classes() -> dict[str, Column]:
    """The error classes of an extraction, as conditions over decoded rows."""

    def n(c: str) -> Column:
        return F.when(F.col(c) == "", 0).otherwise(F.size(F.split(c, ";")))

    return {
        "unreadable": ~F.col("ok"),
        "no_email": F.col("ok") & (F.col("email") == ""),
        "no_authors": F.col("ok") & (F.col("authors") == ""),
        "no_github": F.col("ok") & (F.col("github") == ""),
        "no_project": F.col("ok") & (F.col("project") == ""),
        "affs_differ": F.col("ok") & (n("authors") != n("aff")),
        "emails_differ": F.col("ok") & (n("authors") != n("email")),
    }


def applied(papers: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(papers with what was extracted, papers without a result, counts and shares of the error classes)."""
    d = decoded(results)
    extracted = d.select("row_ix", *[F.col(f).alias(f"x_{f}") for f in FIELDS], "ok", "missing")
    joined, without = by_ordinal(papers, extracted)
    return joined, without, extraction_quality(d, classes())
