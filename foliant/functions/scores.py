"""Review scores: parsing of cells and labels, and exact histogram bins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

BINS = 100


def score_list(c: Column) -> Column:
    """Scores of a form cell, as array<double>.

    Only digits and dots: one value if there is a dot or it is 10, else one score a digit. Otherwise spaces alone separate,
    or the first of , ， / - ; that occurs. Anything else is an error. Blank parts are dropped; NULL and '' give no scores.
    """
    rest = F.regexp_replace(c, r"[0-9.]", "")
    single = F.when(F.contains(c, F.lit(".")) | (c == "10"), F.array(c)).otherwise(F.regexp_extract_all(c, F.lit(r"(.)"), 1))
    parts = F.when(rest == "", single).when(rest.rlike(r"^ +$"), F.split(c, " "))
    for mark in (",", "，", "/", "-", ";"):
        parts = parts.when(F.contains(c, F.lit(mark)), F.split(c, mark))
    parts = parts.otherwise(F.raise_error(F.concat(F.lit("no separator is known in "), c)))
    kept = F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")
    return F.when(c.isNull() | (c == ""), F.array().cast("array<double>")).otherwise(F.transform(kept, lambda x: x.cast("double")))


def label_score(c: Column, labels: dict[str, int] | None = None) -> Column:
    """Score of a review field: the text before ':' looked up in labels, else its first word; 0 unless that is a number."""
    head = F.split_part(F.when(F.coalesce(c, F.lit("")) == "", "0").otherwise(c), F.lit(":"), F.lit(1))
    first = F.split_part(F.trim(head), F.lit(" "), F.lit(1))
    if labels:
        known = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), F.lit(str(v)))])
        first = F.coalesce(F.try_element_at(known, head), first)
    return F.when(first.rlike("^[0-9]+$"), first.cast("int")).otherwise(0)


def value_or_wrapped(c: Column) -> Column:
    """A JSON scalar, or the `value` of a JSON object that wraps it."""
    return F.coalesce(F.get_json_object(c, "$.value"), c)


def score_join(scores: Column) -> Column:
    return F.array_join(F.transform(scores, lambda x: x.cast("string")), ";")


def score_mean(scores: Column) -> Column:
    """0 of no scores or zeros alone, else the mean with zeros."""
    total = F.aggregate(scores, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(scores) <= 0, 0.0).when(F.forall(scores, lambda x: x == 0), 0.0).otherwise(total / F.greatest(F.size(scores), F.lit(1)))


def edges(top: float = 10.0, bins: int = BINS) -> list[float]:
    """The bins' edges as numpy.linspace gives them; some differ from k * top / bins in the last place."""
    return np.linspace(0.0, top, bins + 1).tolist()


def histogram_bin(x: Column, top: float = 10.0, bins: int = BINS) -> Column:
    """Number of the bin [edge, next edge) of x clipped to 0 .. top; the last bin holds the top.

    The quotient's floor is a candidate that is off by one at most and corrected against the true edges.
    """
    e = F.array(*[F.lit(v) for v in edges(top, bins)])
    v = F.least(F.greatest(F.coalesce(x, F.lit(0.0)), F.lit(0.0)), F.lit(float(top)))
    c = F.least(F.floor(v * (bins / top)).cast("int"), F.lit(bins - 1))
    down = F.when(v < F.get(e, c), c - 1).otherwise(c)
    return F.when((c < bins - 1) & (v >= F.get(e, c + 1)), c + 1).otherwise(down)


def transfer_cell(before: Column, after: Column, top: float = 10.0) -> tuple[Column, Column]:
    """Row and column of a transfer matrix: the initial score, and the change from the middle column, both truncated
    toward zero and clamped to 0 .. 99."""
    s = BINS / top
    row = (before * s).cast("int")
    col = F.lit(50) + ((after - before) * s).cast("int")

    def clamp(c: Column) -> Column:
        return F.least(F.greatest(c, F.lit(0)), F.lit(BINS - 1))

    return clamp(row), clamp(col)


def transfer_clamped(before: Column, after: Column, top: float = 10.0) -> Column:
    """Whether transfer_cell had to clamp."""
    s = BINS / top
    row, col = (before * s).cast("int"), F.lit(50) + ((after - before) * s).cast("int")
    return ~(row.between(0, BINS - 1) & col.between(0, BINS - 1))


def argsort_by_main(main: Column, *others: Column) -> Column:
    """Array of structs (main, o0, o1, ..) in ascending order of the main score, ties by place."""
    ord_ = F.transform(main, lambda x, i: i)
    zipped = F.arrays_zip(main.alias("main"), ord_.alias("ix"), *[o.alias(f"o{k}") for k, o in enumerate(others)])
    return F.array_sort(zipped)
