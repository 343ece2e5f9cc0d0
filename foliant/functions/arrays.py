"""Arrays and maps: zero-run coding, key:value strings, ordered sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rle_encode(a: Column, threshold: int = 3) -> Column:
    """Numbers joined by ';', runs of more than `threshold` zeros as 0*n."""

    def close(text: Column, zeros: Column) -> Column:
        run = F.when(zeros > threshold, F.concat(F.lit(";0*"), zeros.cast("string"))).otherwise(F.repeat(F.lit(";0"), zeros))
        return F.concat(text, run)

    start = F.struct(F.lit("").alias("t"), F.lit(0).alias("z"))
    folded = F.aggregate(
        a,
        start,
        lambda s, x: F.when(x == 0, F.struct(s["t"].alias("t"), (s["z"] + 1).alias("z"))).otherwise(F.struct(F.concat(close(s["t"], s["z"]), F.lit(";"), x.cast("string")).alias("t"), F.lit(0).alias("z"))),
        lambda s: close(s["t"], s["z"]),
    )
    return F.substring(folded, 2, 2**31 - 1)


def rle_decode(c: Column) -> Column:
    """The array<int> of an rle_encode() string."""
    parts = F.split(c, ";")

    def expand(x: Column) -> Column:
        n = F.substring_index(x, "*", -1).cast("int")
        return F.when(F.contains(x, F.lit("*")), F.array_repeat(F.substring_index(x, "*", 1).cast("int"), n)).otherwise(F.array(x.cast("int")))

    return F.when(c == "", F.array().cast("array<int>")).otherwise(F.flatten(F.transform(parts, expand)))


def reshape(a: Column, width: int) -> Column:
    """Rows of `width` elements."""
    return F.transform(F.sequence(F.lit(0), (F.size(a) / width).cast("int") - 1), lambda i: F.slice(a, i * width + 1, width))


def key_values(m: Column) -> Column:
    """'k:v;k:v' of a map, in its order."""
    return F.array_join(F.transform(F.map_entries(m), lambda e: F.concat_ws(":", e["key"].cast("string"), e["value"].cast("string"))), ";")


def sorted_map(m: Column) -> Column:
    return F.map_from_entries(F.array_sort(F.map_entries(m)))


def inverted_map(m: Column) -> Column:
    """value -> key; among equal values the last key wins."""
    entries = F.transform(F.map_entries(m), lambda e: F.struct(e["value"].alias("key"), e["key"].alias("value")))
    last = F.filter(F.transform(entries, lambda e, i: F.struct(e["key"].alias("key"), e["value"].alias("value"), i.alias("i"))), lambda e: ~F.exists(F.transform(entries, lambda o, j: F.struct(o["key"].alias("key"), j.alias("i"))), lambda o: (o["key"] == e["key"]) & (o["i"] > e["i"])))
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["key"], e["value"])))


def without_blank_values(m: Column) -> Column:
    return F.map_filter(m, lambda k, v: v.isNotNull() & (v != ""))


def integer_keys(m: Column) -> Column:
    """The entries whose keys are digits, with integer keys."""
    return F.transform_keys(F.map_filter(m, lambda k, v: k.rlike("^[0-9]+$")), lambda k, v: k.cast("int"))


def filter_author_ids(a: Column) -> Column:
    """Author ids of the profile form ~Name1."""
    return F.filter(a, lambda x: x.rlike(r"^~.*\d+$"))


def lengths_differ(a: Column, b: Column, separator: str = ";") -> Column:
    """Whether two joined lists have different numbers of items."""
    return F.size(F.split(a, separator)) != F.size(F.split(b, separator))


def overwrite_all(scores: Column, value: Column) -> Column:
    """Every score replaced by one value, as a meta-review does."""
    return F.array_repeat(value, F.size(scores))
