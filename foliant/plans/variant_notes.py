"""Review-platform notes as VARIANT: one column of JSON, read by paths, whatever the year's layout.

Fields are plain or wrapped in {"value": ..}, lists are lists or one value, replies name one invitation or several. A path
that a note lacks, or whose value has another type, is NULL; a text that is not JSON is a note without fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.text import join_items, title_normalise


def parsed(lines: DataFrame, text: str = "value") -> DataFrame:
    """lines with the column `note`."""
    return lines.withColumn("note", F.try_parse_json(F.col(text)))


def at(v: Column, path: str, kind: str = "string") -> Column:
    """The value at a path below a note or reply, plain or wrapped."""
    return F.coalesce(F.try_variant_get(v, f"$.{path}.value", kind), F.try_variant_get(v, f"$.{path}", kind))


def items(v: Column, path: str) -> Column:
    """A list of strings at a path, or a single one as a list; no items where there is nothing."""
    one = at(v, path)
    return F.coalesce(at(v, path, "array<string>"), F.when(F.coalesce(one, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array(one)))


def replies(v: Column, invitation: str) -> Column:
    """The replies whose (first) invitation contains a text, in order."""
    every = F.coalesce(F.try_variant_get(v, "$.details.directReplies", "array<variant>"), F.array().cast("array<variant>"))
    return F.filter(every, lambda r: F.contains(F.coalesce(F.try_variant_get(r, "$.invitation", "string"), F.try_variant_get(r, "$.invitations[0]", "string"), F.lit("")), F.lit(invitation)))


def reply_decision(v: Column, invitation: str = "Decision") -> Column:
    """The decision, or else the recommendation, of the last reply that has one."""
    found = F.filter(F.transform(replies(v, invitation), lambda r: F.coalesce(at(r, "content.decision"), at(r, "content.recommendation"))), lambda x: x.isNotNull())
    return F.try_element_at(found, F.lit(-1))


def status(kind: str, v: Column, tiers: dict[str, str] | None = None, invitation: str = "Decision") -> Column:
    """A note's status by where decisions stand: venue (through the tiers' names), note, reply, or type_and_reply, which
    puts the type of submission before it unless it is a rejection."""
    if kind == "venue":
        raw = at(v, "content.venue")
        names = F.create_map(*[x for k, n in tiers.items() for x in (F.lit(k), F.lit(n))]) if tiers else None
        return F.coalesce(F.try_element_at(names, raw), raw) if tiers else raw
    if kind == "note":
        return at(v, "content.decision")
    decided = reply_decision(v, invitation)
    if kind == "reply":
        return decided
    if kind == "type_and_reply":
        return F.when(F.contains(F.lower(decided), F.lit("reject")), "Reject").otherwise(F.concat_ws(" ", at(v, "content.Submission_Type"), decided))
    raise ValueError(kind)


def papers(notes: DataFrame, kind: str, *, tiers: dict[str, str] | None = None, review: str = "Official_Review", scores: tuple[str, ...] = ("rating",)) -> DataFrame:
    """id, title, keywords, authors, status ('' without one), n_reviews, and each score's values joined by ';'."""
    n = F.col("note")
    reviews = replies(n, review)

    def joined(field: str) -> Column:
        first = F.transform(reviews, lambda r: F.split_part(at(r, f"content.{field}"), F.lit(":"), F.lit(1)))
        return F.array_join(F.filter(first, lambda x: x.isNotNull()), ";")

    return notes.select(F.try_variant_get(n, "$.id", "string").alias("id"), title_normalise(at(n, "content.title")).alias("title"), join_items(items(n, "content.keywords")).alias("keywords"), join_items(items(n, "content.authors")).alias("author"), F.coalesce(status(kind, n, tiers), F.lit("")).alias("status"), F.size(reviews).alias("n_reviews"), *[joined(s).alias(s) for s in scores])


def layouts(notes: DataFrame, by: str) -> DataFrame:
    """by, field, kind and n: how often each field of the notes' content has which schema, which shows where layouts drift."""
    fields = F.map_entries(F.coalesce(F.try_variant_get("note", "$.content", "map<string,variant>"), F.create_map().cast("map<string,variant>")))
    rows = notes.select(by, F.explode(fields).alias("e")).select(by, F.col("e.key").alias("field"), F.schema_of_variant("e.value").alias("kind"))
    return rows.groupBy(by, "field", "kind").agg(F.count("*").alias("n"))


def merged_schema(notes: DataFrame, by: str) -> DataFrame:
    """by and the one schema that all notes of a group fit."""
    return notes.groupBy(by).agg(F.schema_of_variant_agg("note").alias("schema"))
