"""Tables out of stored web pages (url, html): cards, tables, listings and detail pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.documents import parse_page
from foliant.functions.text import author_delimiters, title_normalise, url_join, url_last_segment


def parsed(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages with one parsed column; the parser runs once a page."""
    return pages.withColumn("page", parse_page(html))


def cards(pages: DataFrame, part: str) -> DataFrame:
    """title, author, site and id of the cards of a list: anchors whose address holds `part`, and the authors that follow."""
    a = parsed(pages).select("url", F.posexplode("page.anchors").alias("pos", "a"), "page.authors").where(F.contains("a.href", F.lit(part)) & (F.col("a.text") != ""))
    site = url_join(F.col("url"), F.col("a.href"))
    own = F.try_element_at(F.filter("authors", lambda x: x["anchor"] == F.col("pos")), F.lit(1))["text"]
    author = F.coalesce(author_delimiters(own), F.lit(""))
    return a.select("url", "pos", title_normalise(F.col("a.text")).alias("title"), author.alias("author"), site.alias("site"), url_last_segment(site).alias("id"))


def tables(pages: DataFrame) -> DataFrame:
    """url, table, section (the heading of the same ordinal), row and cells of all tables of pages.

    Pages whose numbers of headings and tables differ have NULL sections.
    """
    p = parsed(pages).select("url", F.col("page.headings").alias("headings"), F.posexplode("page.tables").alias("table", "rows"), F.size("page.tables").alias("n"))
    section = F.when(F.size("headings") == F.col("n"), F.get("headings", F.col("table")))
    return p.select("url", "table", section.alias("section"), F.posexplode("rows").alias("row", "cells"))


def listing(pages: DataFrame, part: str) -> DataFrame:
    """title and absolute site of an open-access listing."""
    return cards(pages, part).select("url", "pos", "title", "site")


def rankings(pages: DataFrame) -> DataFrame:
    """category, subcategory, conference, rank, h5_index and h5_median out of stored ranking pages (category, subcategory,
    url, html), in order of category, subcategory and rank. Rows whose first cell is no number, such as headers, go."""
    rows = tables(pages).join(pages.select("url", "category", "subcategory").distinct(), "url")
    cell = [F.get("cells", F.lit(i)) for i in range(4)]
    out = rows.select("category", "subcategory", cell[1].alias("conference"), cell[0].try_cast("double").alias("rank"), cell[2].alias("h5_index"), cell[3].alias("h5_median"))
    return out.where("rank is not null").orderBy("category", "subcategory", "rank")


def doi_lookup(papers: DataFrame, hits: DataFrame) -> DataFrame:
    """papers with the doi of the first search hit (title, hit_title, hit_ix, doi) of their title, if that hit has the same
    title but for case; '' without."""
    first = hits.groupBy("title").agg(F.min_by(F.struct("hit_title", "doi"), "hit_ix").alias("hit"))
    same = F.upper(F.col("hit.hit_title")) == F.upper(F.col("title"))
    return papers.join(first, "title", "left").withColumn("doi", F.when(same, F.coalesce("hit.doi", F.lit(""))).otherwise("")).drop("hit")


def link_by_text(anchors: Column, *texts: str) -> Column:
    """The address of the first anchor with one of the visible texts; '' without."""
    found = F.filter(anchors, lambda a: F.lower(F.trim(a["text"])).isin(*[t.lower() for t in texts]))
    return F.coalesce(F.try_element_at(F.transform(found, lambda a: a["href"]), F.lit(1)), F.lit(""))


def details(pages: DataFrame) -> DataFrame:
    """The authors and links of detail pages: poster, openreview, pdf (absolute), proceeding, slides, video, project, github,
    arxiv and doi."""
    authors = F.coalesce(F.replace(F.get("page.authors", F.lit(0))["text"], F.lit(";"), F.lit("")), F.lit(""))
    p = parsed(pages).select("url", F.col("page.anchors").alias("anchors"), F.col("page.title").alias("title"), authors.alias("author"))

    def by_address(part: str) -> Column:
        return F.coalesce(F.try_element_at(F.transform(F.filter("anchors", lambda a: F.contains(a["href"], F.lit(part))), lambda a: a["href"]), F.lit(1)), F.lit(""))

    links = {"poster": ("poster",), "slides": ("slides",), "video": ("video",), "pdf": ("pdf", "paper pdf"), "proceeding": ("proceedings", "paper"), "project": ("project page", "project")}
    arxiv = F.coalesce(F.nullif(url_last_segment(by_address("arxiv.org/")), F.lit("")), F.lit(""))
    doi = F.regexp_extract(by_address("doi.org/"), r"doi\.org/(.+)$", 1)
    found = {k: link_by_text(F.col("anchors"), *t) for k, t in links.items()}
    found["pdf"] = F.when(found["pdf"] == "", "").otherwise(url_join(F.col("url"), found["pdf"]))
    return p.select("url", "title", "author", *[c.alias(k) for k, c in found.items()], by_address("openreview.net/").alias("openreview"), by_address("github.com/").alias("github"), arxiv.alias("arxiv"), doi.alias("doi"))


def status_rows(rows: DataFrame, kinds: tuple[str, ...] = ("papers", "paperstog", "pos")) -> DataFrame:
    """Rendered session rows of wanted kinds; of rows that repeat an ssid the first stays."""
    kept = rows.where(F.col("kind").isin(*kinds))
    return kept.groupBy("ssid").agg(F.min_by(F.struct(*rows.columns), "row_ix").alias("r")).select("r.*")
