"""Review-platform notes to papers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.arrays import filter_author_ids
from foliant.functions.scores import label_score, score_join, score_mean, value_or_wrapped
from foliant.functions.text import join_items, title_normalise


def _field(name: str) -> Column:
    return value_or_wrapped(F.try_element_at("content", F.lit(name)))


def _list(name: str) -> Column:
    """A JSON array field, or a single value, as an array."""
    v = _field(name)
    return F.when(F.startswith(v, F.lit("[")), F.from_json(v, "array<string>")).when(v.isNull(), F.array().cast("array<string>")).otherwise(F.array(v))


def decision(kind: str, replies: Column, pattern: str = "Decision") -> Column:
    """The raw decision by where it stands: venue, note_decision, reply_decision or type_plus_decision."""
    found = F.filter(replies, lambda r: F.contains(F.coalesce(r["invitation"], F.array_join(r["invitations"], " "), F.lit("")), F.lit(pattern)))
    said = F.transform(found, lambda r: F.coalesce(value_or_wrapped(F.try_element_at(r["content"], F.lit("decision"))), value_or_wrapped(F.try_element_at(r["content"], F.lit("recommendation")))))
    reply = F.try_element_at(F.filter(said, lambda x: x.isNotNull()), F.lit(-1))  # the last that has one
    if kind == "venue":
        return _field("venue")
    if kind == "note_decision":
        return _field("decision")
    if kind == "reply_decision":
        return F.coalesce(reply, _field("decision"))
    text = F.coalesce(reply, _field("decision"), F.lit(""))
    return F.when(F.contains(F.lower(text), F.lit("reject")), "Reject").otherwise(F.concat_ws(" ", _field("Submission_Type"), text))


def papers(notes: DataFrame, dimensions: dict[str, str], tiers: dict[str, str], *, status_kind: str = "venue", review_part: str = "Official_Review", meta_part: str | None = None, labels: dict[str, int] | None = None, default_status: str = "Unknown") -> DataFrame:
    """id, title, keywords, areas, authors, status, reply counts, and for each dimension its scores and average.

    notes: id, content map<string, json>, details. dimensions: name -> field of a review. tiers: raw decision -> name.
    """
    replies = F.coalesce(F.col("details.directReplies"), F.from_json(F.lit("[]"), "array<struct<invitation:string,invitations:array<string>,content:map<string,string>>>"))

    def invited(part: str) -> Column:
        return F.filter(replies, lambda r: F.contains(F.coalesce(r["invitation"], F.array_join(r["invitations"], " "), F.lit("")), F.lit(part)))

    def score_of(field: str):
        return lambda r: label_score(value_or_wrapped(F.try_element_at(r["content"], F.lit(field))), labels).cast("double")

    reviews = invited(review_part)
    raw = decision(status_kind, replies)
    names = F.create_map(*[x for k, v in tiers.items() for x in (F.lit(k), F.lit(v))]) if tiers else None
    status = F.coalesce(F.try_element_at(names, raw) if names is not None else F.lit(None), F.nullif(raw, F.lit("")), F.lit(default_status))
    out = notes.select(
        "id",
        title_normalise(_field("title")).alias("title"),
        join_items(_list("keywords")).alias("keywords"),
        F.coalesce(_field("primary_area"), _field("primary_subject_area"), F.lit("")).alias("primary_area"),
        join_items(_list("authors")).alias("author"),
        join_items(filter_author_ids(_list("authorids"))).alias("authorids"),
        F.size(_list("authors")).alias("authors#"),
        status.alias("status"),
        F.coalesce(F.col("details.replyCount"), F.lit(0)).alias("replies"),
        F.size(reviews).alias("n_reviews"),
        *[F.transform(reviews, score_of(f)).alias(f"{d}_list") for d, f in dimensions.items()],
        *([F.try_element_at(F.transform(invited(meta_part), score_of(next(iter(dimensions.values())))), F.lit(1)).alias("meta_score")] if meta_part else []),
    )
    main = next(iter(dimensions))
    if meta_part:
        out = out.withColumn(f"{main}_list", F.when(F.col("meta_score").isNotNull(), F.array_repeat("meta_score", F.size(f"{main}_list"))).otherwise(F.col(f"{main}_list"))).drop("meta_score")
    return out.select(*[c for c in out.columns if not c.endswith("_list")], *[score_join(F.col(f"{d}_list")).alias(d) for d in dimensions], *[score_mean(F.col(f"{d}_list")).alias(f"{d}_avg") for d in dimensions])
