"""Survey responses to papers: one plan for all venues, driven by a FormSpec."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.scores import score_join, score_list, score_mean
from foliant.functions.text import privacy_hash, rebuttal_column
from foliant.operators import filters as P
from foliant.operators.rows import last_scores_first_facts
from foliant.specs import FormSpec

ALL, NOW, INITIAL = "all", "now", "initial"


def responses(rows: DataFrame, spec: FormSpec, mode: str = ALL) -> DataFrame:
    """row_ix, id, status, track, primary_area, open2public and for each dimension its scores and average.

    rows: a sheet of strings with row_ix. all: initial scores of all responses. now: scores after the rebuttal, of those
    that give any. initial: initial scores of the same responses.
    """
    main = next(iter(spec.dimensions.values()))
    df = rows
    if spec.first_column:
        df = P.first_submissions(df, spec.first_column)
    if spec.enforce:
        df = P.valid_scores(df, main, P.LATIN_OR_CJK if spec.cjk else P.LATIN)
    if mode != ALL:
        df = P.with_rebuttal(df, rebuttal_column(main, spec.suffix))
    source = {d: rebuttal_column(c, spec.suffix) if mode == NOW else c for d, c in spec.dimensions.items()}

    def cell(column: str | None, default: str = "") -> Column:
        return F.coalesce(F.nullif(F.trim(F.col(column)), F.lit("")), F.lit(default)) if column else F.lit(default)

    facts = [
        F.col("row_ix"),
        (F.coalesce(F.nullif(F.trim(F.col(spec.id_column)), F.lit("")), F.col("row_ix").cast("string")) if spec.id_column else F.col("row_ix").cast("string")).alias("id"),
        cell(spec.status_column, "Active").alias("status"),
        cell(spec.track_column, "main").alias("track"),
        cell(spec.area_column).alias("primary_area"),
        cell(spec.consent_column, "No").alias("open2public"),
    ]
    df = df.select(*facts, *[score_list(F.coalesce(F.trim(F.col(f"`{c}`")), F.lit(""))).alias(f"{d}_list") for d, c in source.items()])
    if spec.equal_lengths:
        df = P.same_length(df, *(f"{d}_list" for d in spec.equal_lengths))
    df = df.select("*", *[score_mean(F.col(f"{d}_list")).alias(f"{d}_avg") for d in spec.dimensions], *[score_join(F.col(f"{d}_list")).alias(d) for d in spec.dimensions])
    if spec.cap is not None:
        df = P.range_guard(df, f"{next(iter(spec.dimensions))}_avg", spec.cap, spec.cap_action, spec.cap_inclusive)
    return df.drop(*[f"{d}_list" for d in spec.dimensions])


def papers(df: DataFrame, spec: FormSpec, hash_ids: bool = True) -> DataFrame:
    """One row an id: scores of its last response, everything else of its first; ids hashed for privacy."""
    scores = tuple(c for d in spec.dimensions for c in (d, f"{d}_avg"))
    out = last_scores_first_facts(df, "id", scores, ("status", "track", "primary_area", "open2public", "row_ix"))
    return out.withColumn("id", privacy_hash(F.col("id"))) if hash_ids else out


def published(df: DataFrame) -> DataFrame:
    """Papers whose authors agreed to be shown."""
    return P.consented(df)
