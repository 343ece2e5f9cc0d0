"""Row predicates and projections. Each returns a DataFrame or a Column, so Catalyst pushes them to the scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOT_ACCEPTED = ("Withdraw", "Reject", "Desk Reject")
LATIN, LATIN_OR_CJK = "[a-zA-Z]", r"[a-zA-Z一-鿿]"


def optional_filters(df: DataFrame, **wanted: str) -> DataFrame:
    """Keeps rows that equal every wanted value that is not blank."""
    conditions = [F.col(k) == v for k, v in wanted.items() if v]
    return df.where(reduce(lambda a, b: a & b, conditions)) if conditions else df


def not_rejected(status: str = "status") -> Column:
    """A missing status counts as not rejected."""
    return ~F.coalesce(F.col(status), F.lit("")).isin(*NOT_ACCEPTED)


def consented(df: DataFrame, column: str = "open2public") -> DataFrame:
    return df.where(F.col(column) == "Yes")


def valid_scores(df: DataFrame, column: str, letters: str = LATIN_OR_CJK) -> DataFrame:
    """Drops responses whose main score holds letters."""
    return df.where(~F.coalesce(F.col(column), F.lit("")).rlike(letters))


def first_submissions(df: DataFrame, column: str) -> DataFrame:
    return df.where(~F.col(column).eqNullSafe(F.lit("No")))


def with_rebuttal(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.trim(F.coalesce(F.col(column), F.lit(""))) != "")


def range_guard(df: DataFrame, column: str, cap: float, action: str = "skip", inclusive: bool = False) -> DataFrame:
    """Rows over the cap (or at it, if inclusive) are skipped or, with action 'raise', an error."""
    over = F.col(column) >= cap if inclusive else F.col(column) > cap
    if action == "skip":
        return df.where(~F.coalesce(over, F.lit(False)))
    return df.withColumn(column, F.when(over, F.raise_error(F.concat(F.lit(f"{column} is out of range: "), F.col(column).cast("string")))).otherwise(F.col(column)))


def same_length(df: DataFrame, a: str, b: str) -> DataFrame:
    """An error where two score lists of a row differ in length."""
    return df.withColumn(a, F.when(F.size(a) != F.size(b), F.raise_error(F.lit(f"{a} and {b} differ in length"))).otherwise(F.col(a)))


def default_fill(df: DataFrame, column: str, value: str | Column) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(value) if isinstance(value, str) else value))


def accepted_list_status(df: DataFrame, accepted: DataFrame, id_col: str = "id") -> DataFrame:
    """Status by a list of accepted ids: Unknown for ids that are no plain numbers, else Reject if blank, else Poster for
    those in the list; later rules win, and a status that none touches stays."""
    flag = accepted.select(F.col(id_col).alias("__id")).distinct().withColumn("__accepted", F.lit(True))
    out = df.join(flag, F.col(id_col) == F.col("__id"), "left")
    blank = F.coalesce(F.col("status"), F.lit("")) == ""
    status = F.when(~F.col(id_col).rlike("^[0-9]+$"), "Unknown").when(F.col("__accepted"), "Poster").when(blank, "Reject").otherwise(F.col("status"))
    return out.withColumn("status", status).drop("__id", "__accepted")


def map_values(df: DataFrame, column: str, mapping: DataFrame, strict: bool = False) -> DataFrame:
    """Replaces values by a table (raw, name), such as tiers, tracks or institutions' names.

    Values that the table lacks stay, or are an error if strict. The planner broadcasts the table if its size allows.
    """
    m = mapping.select(F.col("raw").alias("__raw"), F.col("name").alias("__name"))
    out = df.join(m, F.col(column) == F.col("__raw"), "left")
    missing = F.raise_error(F.concat(F.lit(f"no {column} named "), F.col(column))) if strict else F.col(column)
    return out.withColumn(column, F.when(F.col("__name").isNotNull(), F.col("__name")).otherwise(missing)).drop("__raw", "__name")


def track_by_content(column: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """The track of the first rule whose text the column contains."""
    out = reduce(lambda w, r: w.when(F.contains(column, F.lit(r[0])), r[1]), rules[1:], F.when(F.contains(column, F.lit(rules[0][0])), rules[0][1]))
    return out.otherwise(default)


def without_value(column: str, part: str = "double-blind") -> Column:
    return ~F.contains(F.col(column), F.lit(part))


def add_column(df: DataFrame, name: str, value: Column | str = "", before: str | None = None) -> DataFrame:
    """A new column, in front of `before` if given, else at the end."""
    columns = [c for c in df.columns if c != name]
    at = columns.index(before) if before in columns else len(columns)
    return df.withColumn(name, F.lit(value) if isinstance(value, str) else value).select(*columns[:at], name, *columns[at:])


def move_column(df: DataFrame, name: str, before: str) -> DataFrame:
    columns = [c for c in df.columns if c != name]
    at = columns.index(before)
    return df.select(*columns[:at], name, *columns[at:])


def clear_column(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.lit(""))


def id_first(df: DataFrame, id_col: str = "id") -> DataFrame:
    return df.select(id_col, *[c for c in df.columns if c != id_col])


def shown(df: DataFrame, column: str = "show") -> DataFrame:
    """Meta rows that are shown on their own."""
    return df.where(~F.col(column).eqNullSafe(F.lit("OTHERS")))


def apply_overrides(df: DataFrame, overrides: DataFrame, id_col: str = "id") -> DataFrame:
    """Patches rows by id; blank and missing cells of the patch leave a value alone."""
    cells = [c for c in overrides.columns if c != id_col and c in df.columns]
    patch = overrides.select(F.col(id_col).alias("__id"), *[F.nullif(F.col(c), F.lit("")).alias(f"__{c}") for c in cells])
    out = df.join(patch, F.col(id_col) == F.col("__id"), "left")
    return out.select(*[F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in cells else F.col(c) for c in df.columns])


def status_in_text(text: Column) -> Column:
    """The decision that a page's text names."""
    return F.when(F.contains(text, F.lit("Oral")), "Oral").when(F.contains(text, F.lit("Spotlight")), "Spotlight").when(F.contains(text, F.lit("Highlight")), "Highlight").otherwise("Poster")
