"""Entity resolution and enrichment joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions.text import blank_to_null, forum_id, surrogate_id


def exact_matches(site: DataFrame, platform: DataFrame, *, site_key: Column, platform_key: Column) -> DataFrame:
    """Pairs (left_ix, right_ix) of rows whose keys are equal and not blank; each row is in one pair at most.

    Equal keys are paired by rank of row_ix on both sides, so duplicates neither vanish nor multiply.
    """
    left = site.select(F.col("row_ix").alias("left_ix"), blank_to_null(site_key).alias("key")).where("key is not null")
    right = platform.select(F.col("row_ix").alias("right_ix"), blank_to_null(platform_key).alias("key")).where("key is not null")
    left = left.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("left_ix")))
    right = right.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("right_ix")))
    return left.join(right, ["key", "n"]).select("left_ix", "right_ix")


def by_forum(site: DataFrame, platform: DataFrame) -> DataFrame:
    """Site pages and review-platform papers by the forum id in the page's link."""
    return exact_matches(site, platform, site_key=forum_id(F.col("openreview")), platform_key=F.col("id"))


def by_page(site: DataFrame, open_access: DataFrame) -> DataFrame:
    """Site pages and open-access pages by the page's address."""
    return exact_matches(site, open_access, site_key=F.col("oa"), platform_key=F.col("site"))


def leftovers(df: DataFrame, matches: DataFrame, ix: str) -> DataFrame:
    return df.join(matches.select(F.col(ix).alias("row_ix")), "row_ix", "left_anti")


def with_leftovers(merged: DataFrame, left: DataFrame, right: DataFrame, *, drop_left: bool = False) -> DataFrame:
    """Matched rows with what is left on either side; left-hand rows without id get one from their title."""
    rest = left.withColumn("id", F.coalesce(blank_to_null(F.col("id")), surrogate_id(F.col("title"))) if "id" in left.columns else surrogate_id(F.col("title")))
    out = merged if drop_left else merged.unionByName(rest, allowMissingColumns=True)
    return out.unionByName(right, allowMissingColumns=True)


def coalesced(matches: DataFrame, site: DataFrame, platform: DataFrame, *, prefer_site: tuple[str, ...] = (), site_only: tuple[str, ...] = ()) -> DataFrame:
    """One row a match: the platform's row is the base, blank cells come from the site.

    prefer_site: columns where the site's cell wins unless blank; site_only: columns taken from the site. The site's title
    is kept as title_site where it differs.
    """
    s = site.select(*[F.col(c).alias(f"s_{c}") for c in site.columns])
    p = platform.select(*[F.col(c).alias(f"p_{c}") for c in platform.columns])
    j = matches.join(s, F.col("left_ix") == F.col("s_row_ix")).join(p, F.col("right_ix") == F.col("p_row_ix"))
    out: list[Column] = []
    for c in dict.fromkeys([*platform.columns, *site_only, *(x for x in site.columns if x in prefer_site)]):
        a, b = (F.col(f"{k}_{c}") if c in own.columns else None for k, own in (("p", platform), ("s", site)))
        if c == "row_ix" or a is None and b is None:
            continue
        first, second = (b, a) if c in prefer_site else (a, b)
        out.append(F.coalesce(*[blank_to_null(x.cast("string")) if dict([*platform.dtypes, *site.dtypes])[c] == "string" else x for x in (first, second) if x is not None]).alias(c))
    different = F.when(F.col("s_title") != F.col("p_title"), F.col("s_title"))
    return j.select("left_ix", "right_ix", *out, different.alias("title_site"))


def meta_with_ranking(meta: DataFrame, ranking: DataFrame, key: str = "conference") -> DataFrame:
    """Left join on the conference without its four-digit year; a clash of names keeps the meta column."""
    short = F.expr(f"left({key}, length({key}) - 4)")
    r = ranking.select(F.col("conf").alias("__conf"), *[c for c in ranking.columns if c != "conf" and c not in meta.columns])
    return meta.withColumn("__short", short).join(r, F.col("__short") == F.col("__conf"), "left").drop("__short", "__conf")


def meta_lookup(stats: DataFrame, meta: DataFrame, key: str = "conference") -> DataFrame:
    """Stats with their meta row; a conference without one is an error."""
    m = meta.withColumn("__found", F.lit(True))
    j = stats.join(m, key, "left")
    return j.withColumn(key, F.when(F.col("__found").isNull(), F.raise_error(F.concat(F.lit("no meta row for "), F.col(key)))).otherwise(F.col(key))).drop("__found")


def meta_only(meta: DataFrame, stats: DataFrame, key: str = "conference") -> DataFrame:
    return meta.join(stats.select(key), key, "left_anti")


def at_date(entries: DataFrame, points: DataFrame, *, on: str, start: str = "start", end: str = "end", at: str = "at", value: str = "value", order: str = "ord", now: int) -> DataFrame:
    """The last entry (by order) whose interval holds the point; blank starts are 0, blank ends are `now`. A row for each
    different row of points.

    Intervals are cut into pieces that start at multiples of their lengths, powers of two; a date lies in one piece of each
    length, so points and intervals meet by equality. Of a piece's entries the last one stays before they meet, and equal
    points of a key are one, so rows grow with entries and points times the logarithm of the points' span, for any key.
    """
    span = points.agg(F.min(at).alias("lo"), F.max(at).alias("hi")).first()
    lo, hi = (int(span.lo), int(span.hi)) if span.lo is not None else (0, 0)
    levels = F.sequence(F.lit(0), F.lit((hi - lo).bit_length()))
    s, e = F.coalesce(F.expr(f"try_cast({start} as int)"), F.lit(0)), F.coalesce(F.expr(f"try_cast({end} as int)"), F.lit(now))
    # Within the points' span, as [a, b) from 0.
    own = entries.select(F.col(on).alias("__k"), F.greatest(s - lo, F.lit(0)).cast("long").alias("a"), (F.least(e, F.lit(hi)) - lo + 1).cast("long").alias("b"), F.struct(F.col(order).alias("o"), F.col(value).alias("v")).alias("last")).where("a < b")

    def pieces(j: Column) -> Column:
        size = F.pow(F.lit(2), j).cast("long")
        left, right = F.ceil(F.col("a") / size), F.floor(F.col("b") / size)
        odd = lambda here, place: F.when((left < right) & (here % 2 == 1), F.struct(j.alias("j"), place.alias("p")))
        return F.array(odd(left, left), odd(right, right - 1))

    cut = F.filter(F.flatten(F.transform(levels, pieces)), lambda x: x.isNotNull())
    best = own.select("__k", "last", F.explode(cut).alias("x")).groupBy("__k", F.col("x.j").alias("j"), F.col("x.p").alias("p")).agg(F.max("last").alias("last"))
    dates = points.select(F.col(on).alias("__k"), F.col(at).cast("long").alias("__at")).distinct()
    asked = dates.select("__k", "__at", F.explode(F.transform(levels, lambda j: F.struct(j.alias("j"), F.floor((F.col("__at") - lo) / F.pow(F.lit(2), j).cast("long")).alias("p")))).alias("x"))
    found = asked.select("__k", "__at", "x.j", "x.p").join(best, ["__k", "j", "p"]).groupBy("__k", "__at").agg(F.max("last").alias("last"))
    rows = points.distinct()
    return rows.join(found, (rows[on] == F.col("__k")) & (rows[at] == F.col("__at")), "left").select(*[rows[c] for c in points.columns], F.col("last.v").alias(value))


def ordered_lookup(rows: DataFrame, array_col: str, table: DataFrame, key: str, value: str, row_key: str = "id") -> DataFrame:
    """Values for the items of an array, in the array's order; items that the table lacks leave gaps ('')."""
    items = rows.select(row_key, F.posexplode(array_col).alias("pos", key))
    found = items.join(table.select(key, value), key, "left")
    return found.groupBy(row_key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.coalesce(F.col(value), F.lit("")).alias("v")))), lambda x: x["v"]).alias(value))


def snapshot_pairs(now: DataFrame, initial: DataFrame, id_col: str = "id", order: str = "row_ix") -> DataFrame:
    """Current rows with their initial score and, if the initial one lacks it, their area: now's columns and `before`.

    Of rows that repeat an id the first counts, on both sides; ids that one side lacks are left out.
    """
    w = Window.partitionBy(id_col).orderBy(order)
    a = now.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
    b = initial.withColumn("__n", F.row_number().over(w)).where("__n = 1").select(id_col, F.col("avg").alias("before"))
    return a.join(b, id_col)


def enriched(df: DataFrame, details: DataFrame, key: str) -> DataFrame:
    """Left join whose right-hand cells win unless they are missing."""
    both = [c for c in details.columns if c in df.columns and c != key]
    d = details.select(key, *[F.col(c).alias(f"__{c}") if c in both else F.col(c) for c in details.columns if c != key])
    j = df.join(d, key, "left")
    for c in both:
        j = j.withColumn(c, F.coalesce(F.col(f"__{c}"), F.col(c))).drop(f"__{c}")
    return j


def with_truth(df: DataFrame, truth: DataFrame, key: str = "site", column: str = "aff") -> DataFrame:
    return enriched(df, truth.select(key, column), key)


def by_ordinal(papers: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Papers joined with results of the same row_ix, and the papers that have none."""
    return papers.join(results, "row_ix"), papers.join(results.select("row_ix"), "row_ix", "left_anti")


def multi_source(sources: dict[str, DataFrame], key: str = "conference") -> DataFrame:
    """One row a conference from several sources' rows (key, n_accept, n_total), in the sources' order.

    bot_mark lists the sources that have the row; s<k> and su<k> are their counts, 0 where a source lacks it.
    """
    out: DataFrame | None = None
    for k, (name, df) in enumerate(sources.items()):
        own = df.select(key, F.col("n_accept").alias(f"s{k}"), F.col("n_total").alias(f"su{k}"), F.lit(name).alias(f"__{k}"))
        out = own if out is None else out.join(own, key, "full")
    n = len(sources)
    counts = [F.coalesce(F.col(f"{p}{k}"), F.lit(0)).cast("bigint").alias(f"{p}{k}") for k in range(n) for p in ("s", "su")]
    return out.select(key, *counts, F.concat_ws(";", *[f"__{k}" for k in range(n)]).alias("bot_mark"))


#: Whose row is the base when two kinds of sources meet; kinds that are not listed have no rule.
MERGE_RULES = {("site", "openreview"): "openreview", ("site", "openaccess"): "openaccess", ("openreview", "openaccess"): "openreview"}


def merge_rule(left: str, right: str) -> str | None:
    """The base of a merge of two kinds of sources: the left of equal kinds, None for unknown pairs."""
    return left if left == right else MERGE_RULES.get((left, right))
