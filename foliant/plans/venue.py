"""A venue's year from its sources: entity resolution, summaries and the wide row for a server."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions.scores import histogram_bin
from foliant.functions.text import semicolon_list
from foliant.operators import aggregates as A
from foliant.operators import fuzzy
from foliant.operators import joins as J
from foliant.operators.filters import not_rejected
from foliant.operators.rows import union
from foliant.specs import merge_policy


def resolve(site: DataFrame, platform: DataFrame, venue: str, *, block: str = "block") -> tuple[DataFrame, DataFrame]:
    """(merged list, matches) of a site's list and a platform's.

    Both have row_ix, id, title, status and a block column. Only papers that are not rejected take part; rejected ones of
    the platform are added back. Rows match by forum id where the site has links, then by title.
    """
    policy = merge_policy(venue)
    rejected = platform.where(~not_rejected())
    candidates = platform.where(not_rejected())
    exact = J.by_forum(site, candidates) if "openreview" in site.columns else None
    rest_l = J.leftovers(site, exact, "left_ix") if exact is not None else site
    rest_r = J.leftovers(candidates, exact, "right_ix") if exact is not None else candidates
    named = fuzzy.fuzzy_match(*(d.select(F.col(block).cast("string").alias("block"), F.col("row_ix").alias("ix"), "title") for d in (rest_l, rest_r)))
    matches = named.select("left_ix", "right_ix", "level")
    if exact is not None:
        matches = exact.withColumn("level", F.lit(None).cast("int")).unionByName(matches)
    site_only = tuple(c for c in policy.site_only if c in site.columns)
    merged = J.coalesced(matches, site, candidates, prefer_site=policy.prefer_site, site_only=site_only).drop("left_ix", "right_ix")
    for old, new in policy.rename.items():
        if old in merged.columns:
            merged = merged.withColumnRenamed(old, new)
    out = J.with_leftovers(merged, J.leftovers(site, matches, "left_ix"), J.leftovers(candidates, matches, "right_ix"), drop_left=policy.drop_site_leftovers)
    return union(out, rejected), matches


def summaries(papers: DataFrame, dimensions: tuple[str, ...], *, tier: str = "status", area: str = "primary_area") -> DataFrame:
    """(dim, tier, area, bin, n): the long fact table of a track's histograms, all groupings included, from one scan.

    replies and authors# have bins up to 100, all others up to 10.
    """
    bins = [F.struct(F.lit(d).alias("dim"), histogram_bin(F.col(f"`{d}_avg`" if f"{d}_avg" in papers.columns else f"`{d}`").cast("double"), 100.0 if d in ("replies", "authors#") else 10.0).alias("bin")) for d in dimensions]
    rows = papers.select(F.col(tier).alias("tier"), F.coalesce(F.nullif(F.col(area), F.lit("")), F.lit("Others")).alias("area"), F.explode(F.array(*bins)).alias("b")).select("b.dim", "tier", "area", "b.bin")
    return A.count_cube(rows, ("dim", "bin"), [("tier", "area"), ("tier",), ("area",), ()])


def top_lists(papers: DataFrame, statuses: list[str] | None, *, track: str = "track", k: int = 200) -> DataFrame:
    """The thirteen lists of every track in one scan: affiliations, authors, positions and keywords by their modes.

    statuses: None where a venue's statuses are not to be told apart: all papers count.
    """
    lists = {}
    for column, modes in {"aff": ("all", "unique", "first", "last"), "position": ("all", "unique", "first", "last"), "keywords": ("all", "first")}.items():
        items = semicolon_list(F.col(column))
        if column == "aff":  # a blank item keeps its place and isn't counted
            items = F.transform(items, lambda x: F.when(F.contains(x, F.lit("double-blind")), "").otherwise(x))
        lists |= {f"{column}_{m}": A.named(A.picked(items, m)) for m in modes}
    for m in ("all", "first", "last"):
        lists[f"author_{m}"] = A.picked(A.identified(semicolon_list(F.col("author")), semicolon_list(F.col("authorids"))), m)
    return A.top_lists(papers, lists, statuses, by=(track,), k=k)


def recounted(stats: DataFrame, papers: DataFrame, totals: DataFrame, key: str = "conference") -> DataFrame:
    """Tier counts (conference, tier, n) of a year whose platform only told accepted papers from others: each tier counts what
    the merged list of papers (conference, status) has, if that is more, and acceptance is the platform's.

    totals: conference, accept and total. Adds accept and ac_rate, 0 where the total is.
    """
    merged = papers.groupBy(key, F.col("status").alias("tier")).agg(F.count("*").alias("own"))
    rate = F.coalesce(F.try_divide(F.col("accept").cast("double"), F.col("total").cast("double")), F.lit(0.0))
    counted = stats.join(merged, [key, "tier"], "left").select(key, "tier", F.greatest("n", F.coalesce("own", F.lit(0))).alias("n"))
    return counted.join(totals, key).select(key, "tier", "n", "accept", rate.alias("ac_rate"))


def server_row(summary: DataFrame, meta: DataFrame, tiers: list[str], key: str = "conference") -> DataFrame:
    """One wide row a conference: a column for each tier's count, its share, and acceptance with the meta sheet's totals."""
    wide = summary.groupBy(key).pivot("tier", tiers).agg(F.sum("n")).na.fill(0, tiers)
    j = J.meta_lookup(wide, meta, key)
    total = F.coalesce(F.nullif(F.try_to_number(F.nullif(F.replace("total", F.lit(","), F.lit("")), F.lit("")), F.lit("99999999")).cast("bigint"), F.lit(0)), sum(F.col(f"`{t}`") for t in tiers))
    accepted = sum(F.col(f"`{t}`") for t in tiers if t not in ("Reject", "Withdraw", "Desk Reject", "Active"))
    j = j.withColumns({"total": total, "accept": accepted})
    shares = {f"{t}_share": F.coalesce(F.try_divide(F.col(f"`{t}`").cast("double"), F.col("total").cast("double")), F.lit(0.0)) for t in tiers}
    return j.withColumns(shares | {"ac_rate": F.coalesce(F.try_divide(F.col("accept").cast("double"), F.col("total").cast("double")), F.lit(0.0))})
