"""String functions of the bibliographic model, as Column builders. A missing value is '' at the edges and NULL inside."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def null_to_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def title_normalise(c: Column) -> Column:
    """Zero-width spaces become spaces, runs of white space one space, ends are trimmed."""
    return F.trim(F.regexp_replace(F.replace(c, F.lit("​"), F.lit(" ")), r"(?U)\s+", " "))


def surrogate_id(title: Column, prefix: str = "site_") -> Column:
    """An id from the title for rows that have none."""
    return F.concat(F.lit(prefix), F.substring(F.md5(title), 1, 10))


def privacy_hash(c: Column, prefix: str = "GF_") -> Column:
    return F.concat(F.lit(prefix), F.md5(c))


def forum_id(url: Column) -> Column:
    """What stands after the last `forum?id=`; the whole text without it."""
    return F.substring_index(url, "forum?id=", -1)


def conference_id(conf: Column, year: Column, track: Column) -> Column:
    """conf + year, and for tracks other than main an underscore and the letters of the track's first four characters."""
    letters = F.lower(F.regexp_replace(F.substring(track, 1, 4), r"[^\p{L}]", ""))
    return F.concat(conf, year.cast("string"), F.when(track == "main", "").otherwise(F.concat(F.lit("_"), letters)))


def comma_number(c: Column) -> Column:
    """'1,234' as 1234; NULL where it is no number."""
    return F.replace(c, F.lit(","), F.lit("")).try_cast("bigint")


def semicolon_list(c: Column) -> Column:
    """Trimmed items of a ;-joined string; no items of a blank one."""
    return F.transform(F.filter(F.split(F.coalesce(c, F.lit("")), ";"), lambda x: F.trim(x) != ""), lambda x: F.trim(x))


def join_items(c: Column, separator: str = ";") -> Column:
    """Joins the items that are not blank."""
    return F.array_join(F.filter(c, lambda x: x != ""), separator)


def comma_to_semicolon(c: Column) -> Column:
    """Comma-separated keywords as ;-joined ones, items trimmed."""
    return F.array_join(F.transform(F.split(c, ","), lambda x: F.trim(x)), ";")


def author_delimiters(c: Column) -> Column:
    """Author lists of pages: ' · ' separates names, stray semicolons go."""
    return F.replace(F.replace(c, F.lit(" · "), F.lit(", ")), F.lit(";"), F.lit(""))


def authors_by_semicolon(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(";"))


def status_cleanup(c: Column) -> Column:
    """The part after the last '/', without 'paper' and 'accept'."""
    last = F.substring_index(c, "/", -1)
    return F.trim(F.replace(F.replace(last, F.lit("paper"), F.lit("")), F.lit("accept"), F.lit("")))


def custom_id(name: Column, ix: Column) -> Column:
    return F.concat_ws("-", F.lit("request"), name, ix.cast("string"))


def custom_id_index(c: Column) -> Column:
    return F.substring_index(c, "-", -1).try_cast("int")


def level_shift(c: Column) -> Column:
    """Inner semicolons become commas, so that the outer level can use semicolons."""
    return F.translate(c, ";", ",")


def rebuttal_column(column: str, suffix: str = "after Rebuttal") -> str:
    """The name of a form's second-round column for an initial one."""
    return f"[Optional] {column.removeprefix('Initial ')} {suffix}"


# --- URLs ---------------------------------------------------------------------------------------------------------------


def url_last_segment(url: Column) -> Column:
    """The last path segment, without query and fragment."""
    return F.regexp_extract(url, r"([^/?#]*)(?:[?#].*)?$", 1)


def url_scheme(url: Column) -> Column:
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def url_join(base: Column, href: Column) -> Column:
    """Resolves a reference against a base: absolute, scheme-relative, root-relative and plain relative ones."""
    root = F.concat(url_scheme(base), F.lit("://"), url_host(base))
    folder = F.regexp_replace(F.regexp_extract(base, r"^([^?#]*)", 1), r"(?<=[^/:])/[^/]*$", "/")
    folder = F.when(F.endswith(folder, F.lit("/")), folder).otherwise(F.concat(folder, F.lit("/")))
    plain = F.concat(folder, F.regexp_replace(href, r"^(\./)+", ""))
    # One pass removes the innermost 'name/..' pair; references of pages hold three at most.
    for _ in range(3):
        plain = F.regexp_replace(plain, r"(?<=[^/:]/|[a-z0-9]/)(?!\.\./)[^/]+/\.\./", "")
    return (
        F.when(href.isNull() | (href == ""), base)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(F.startswith(href, F.lit("//")), F.concat(url_scheme(base), F.lit(":"), href))
        .when(F.startswith(href, F.lit("/")), F.concat(root, href))
        .otherwise(plain)
    )


def url_rewrite(url: Column, old: str, new: str) -> Column:
    return F.replace(url, F.lit(old), F.lit(new))


def is_github(url: Column) -> Column:
    return F.contains(F.lower(url), F.lit("github.com"))


def github_and_project(url: Column) -> tuple[Column, Column]:
    """(github, project): a link goes to one of them, the other is ''."""
    return F.when(is_github(url), url).otherwise(""), F.when(is_github(url), "").otherwise(F.coalesce(url, F.lit("")))


_URL = r"(https?://[^\s<>\"'(){}\[\]]+)"


def links(text: Column) -> Column:
    """All links of a text, closing punctuation removed."""
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_URL), 1), lambda u: F.regexp_replace(u, r"[.,;:!?]+$", ""))


def first_link(text: Column, github: bool) -> Column:
    """The first link that is (or is not) a github one; NULL without."""
    return F.try_element_at(F.filter(links(text), lambda u: is_github(u) if github else ~is_github(u)), F.lit(1))


def strip_fence(c: Column) -> Column:
    """What stands between ```json (or ```) and ```; the whole text without a fence."""
    inner = F.regexp_extract(c, r"(?s)```(?:json)?\s*(.*?)\s*```", 1)
    return F.when(c.rlike(r"(?s)```(?:json)?.*?```"), inner).otherwise(c)
