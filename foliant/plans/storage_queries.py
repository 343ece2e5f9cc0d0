"""Queries that write through a sink, read back through a source, and compare what came back; and those of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant import sinks
from foliant.functions import arrays, scores, text
from foliant.functions.documents import call_to_json
from foliant.operators import aggregates as A
from foliant.operators import filters as P
from foliant.operators import joins as J
from foliant.operators import rows as R
from foliant.operators import scans
from foliant.plans import forms, notes, variant_notes, venue
from foliant.plans.registry import query
from foliant.plans.review_queries import bin_sql
from foliant.plans.views import PAPERS, Tables
from foliant.schema import strings
from foliant.sources import files, pages, rest, summaries
from foliant.specs import FORM_RULES, VENUES, form_spec, source_kind
from foliant.storage import shared_dir, stored
from foliant.streaming import incremental, stateful


def _written_text(t: Tables, df: DataFrame, name: str) -> str:
    """The folder of df's lines of text, one file a partition."""
    folder = shared_dir(t.spark, name)
    df.write.text(folder)
    return folder


def _one_file_a_block(t: Tables, lines: DataFrame, name: str) -> str:
    """The folder of texts (block, value), one file each."""
    folder = shared_dir(t.spark, name)
    lines.repartition("block").write.partitionBy("block").text(folder)
    return folder


def _blocks(key: str, size: int = 200) -> Column:
    return F.floor(F.col(key) / size).alias("block")


# --- lists, sheets and documents --------------------------------------------------------------------------------------------


@query("SELECT c_custkey::VARCHAR AS id, c_name AS title, 'none' AS status FROM customer")
def paper_list_scan(t: Tables) -> DataFrame:
    """Lists of 200 papers, each an array of one file."""
    item = F.struct(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("title"), F.lit("none").alias("status"))
    lists = t.customer.groupBy(_blocks("c_custkey")).agg(F.to_json(F.collect_list(item)).alias("value"))
    return files.paper_list(t.spark, _one_file_a_block(t, lists, "list.json"), strings("id", "title", "status")).select("id", "title", "status")


@query("SELECT r_name AS folder, n_nationkey::VARCHAR AS id, n_name AS title FROM nation JOIN region ON n_regionkey = r_regionkey")
def paper_tree_scan(t: Tables) -> DataFrame:
    own = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    lists = own.groupBy(F.col("r_name").alias("conf")).agg(F.to_json(F.collect_list(F.struct(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("title")))).alias("value"))
    folder = shared_dir(t.spark, "tree")
    lists.write.partitionBy("conf").text(folder)
    found = files.paper_tree(t.spark, folder, strings("id", "title"), pattern="*.txt")
    return found.select(F.regexp_replace(F.replace("folder", F.lit("%20"), F.lit(" ")), "^conf=", "").alias("folder"), "id", "title")


@query("SELECT o_orderkey AS id, o_orderstatus AS status, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE year(o_orderdate) END AS year FROM orders")
def save_list_partitions(t: Tables) -> DataFrame:
    """An overwrite of one partition leaves the others."""
    rows = t.orders.select(F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("status"))
    folder = shared_dir(t.spark, "lists")
    sinks.save_list(rows, folder, partitions=("status",))
    sinks.save_list(rows.where("status = 'F'").withColumn("year", F.lit(0)), folder, partitions=("status",))
    sinks.save_list(rows.limit(0), folder, partitions=("status",))  # nothing is written
    return t.spark.read.schema("id bigint, year bigint, status string").json(folder).select("id", "status", "year")


@query("SELECT c_custkey AS id, c_name AS title FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def save_list_append(t: Tables) -> DataFrame:
    folder = shared_dir(t.spark, "lists")
    sinks.save_list(t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title")), folder, "append")
    sinks.save_list(t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("title")), folder, "append")
    return t.spark.read.schema("id bigint, title string").json(folder)


@query("SELECT r_regionkey AS id, r_name AS title FROM region")
def save_document_round_trip(t: Tables) -> DataFrame:
    folder = shared_dir(t.spark, "document")
    sinks.save_document(t.region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("title")), folder)
    return t.spark.read.schema("id bigint, title string").json(folder)


@query("SELECT c_custkey::VARCHAR AS id, c_name AS title, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment || ', \"' || c_nationkey || '\"' END AS note FROM customer")
def csv_round_trip(t: Tables) -> DataFrame:
    note = F.when(F.col("c_custkey") % 3 != 0, F.concat("c_mktsegment", F.lit(', "'), F.col("c_nationkey").cast("string"), F.lit('"')))
    folder = shared_dir(t.spark, "csv")
    t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title"), note.alias("note")).write.option("header", True).option("escape", '"').csv(folder)
    return files.csv(t.spark, folder)


@query("SELECT n_nationkey::VARCHAR AS id, n_name AS title FROM nation")
def save_csv_round_trip(t: Tables) -> DataFrame:
    folder = shared_dir(t.spark, "csv")
    sinks.save_csv(t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("title")), folder)
    return files.csv(t.spark, folder)


@query("SELECT n_name AS title, n_nationkey AS row_ix FROM nation WHERE n_nationkey >= 2")
def sheet_scan(t: Tables) -> DataFrame:
    """A sheet from its third row on; rows keep their numbers."""
    folder = shared_dir(t.spark, "sheet")
    t.nation.orderBy("n_nationkey").select(F.col("n_name").alias("title")).coalesce(1).write.option("header", True).csv(folder)
    return files.sheet(t.spark, folder, content_start=3)


@query("SELECT o_orderkey::VARCHAR AS id, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_ix FROM orders QUALIFY row_number() OVER (ORDER BY o_orderkey) >= 3")
def sheet_of_many_files(t: Tables) -> DataFrame:
    """A sheet in as many files as there are partitions, whose rows are numbered as one sheet's."""
    folder = shared_dir(t.spark, "sheet")
    t.orders.select(F.col("o_orderkey").alias("id")).repartitionByRange(7, "id").sortWithinPartitions("id").write.option("header", True).csv(folder)
    return files.sheet(t.spark, folder, content_start=3)


@query("SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS row_ix FROM lineitem")
def row_numbers(t: Tables) -> DataFrame:
    """Numbers along a total order, without a task that sees all rows."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return scans.numbered(rows, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").drop("l_suppkey")


@query("SELECT c_custkey::INTEGER AS k, c_name AS v FROM customer")
def json_map_scan(t: Tables) -> DataFrame:
    """Maps of files of 200 entries; those whose key is no number go."""
    pairs = F.struct(F.col("c_custkey").cast("string").alias("k"), F.col("c_name").alias("v")), F.struct(F.concat(F.lit("r"), F.col("c_custkey").cast("string")).alias("k"), F.lit("other").alias("v"))
    rows = t.customer.select(_blocks("c_custkey"), F.explode(F.array(*pairs)).alias("e"))
    objects = rows.groupBy("block").agg(F.to_json(F.map_from_entries(F.collect_list("e"))).alias("value"))
    return files.json_map(t.spark, _one_file_a_block(t, objects, "map")).where("entries is not null").select(F.explode("entries").alias("k", "v"))


@query("SELECT 2024 AS year, 'site' AS source, r_name AS track, n_name AS raw, lower(n_name) AS name FROM nation JOIN region ON n_regionkey = r_regionkey")
def settings_tiers(t: Tables) -> DataFrame:
    own = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("r_name", "n_name")
    tracks = own.groupBy("r_name").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("n_name", F.lower("n_name"))))).alias("m"))
    doc = tracks.agg(F.map_from_entries(F.collect_list(F.struct("r_name", "m"))).alias("tname")).select(F.to_json(F.create_map(F.lit("2024"), F.create_map(F.lit("site"), F.struct("tname")))).alias("value"))
    return files.settings(t.spark, _written_text(t, doc.coalesce(1), "settings"))["dim_tier"].select("year", "source", "track", "raw", "name")


@query("SELECT 'request-nips-' || c_custkey AS custom_id, c_name AS answer, c_custkey AS row_ix FROM customer")
def json_lines_scan(t: Tables) -> DataFrame:
    folder = shared_dir(t.spark, "lines")
    sinks.save_list(t.customer.select(text.custom_id(F.lit("nips"), F.col("c_custkey")).alias("custom_id"), F.col("c_name").alias("answer")), folder)
    return files.json_lines(t.spark, folder, strings("custom_id", "answer"))


@query("SELECT 'request-nips-' || c_custkey AS custom_id, '/v4/chat/completions' AS url, 'extract' AS prompt, c_mktsegment AS aff FROM customer WHERE c_custkey % 2 = 1")
def request_lines(t: Tables) -> DataFrame:
    papers = t.customer.select(F.col("c_custkey").alias("row_ix"), F.when(F.col("c_custkey") % 2 == 1, F.col("c_mktsegment")).alias("aff"))
    folder = shared_dir(t.spark, "requests")
    sinks.save_requests(papers, folder, "nips", "extract", "model")
    path = {"custom_id": "custom_id", "url": "url", "prompt": "body.messages[0].content", "aff": "body.messages[1].content"}
    return t.spark.read.text(folder).select(*[F.get_json_object("value", f"$.{p}").alias(c) for c, p in path.items()])


@query("SELECT c_custkey AS id, c_name || ' of ' || c_nationkey AS title FROM customer")
def atom_scan(t: Tables) -> DataFrame:
    """Feeds of 200 entries, one file each; titles have line breaks."""
    entry = F.concat(F.lit("<entry><id>"), F.col("c_custkey").cast("string"), F.lit("</id><title>"), "c_name", F.lit("\n  of "), F.col("c_nationkey").cast("string"), F.lit("</title></entry>"))
    feeds = t.customer.groupBy(_blocks("c_custkey")).agg(F.concat(F.lit("<feed>"), F.array_join(F.collect_list(entry), "\n"), F.lit("</feed>")).alias("value"))
    return files.atom_entries(t.spark, _one_file_a_block(t, feeds, "atom")).select(F.col("id").cast("bigint").alias("id"), "title")


def _stored_notes(t: Tables, rows: DataFrame, order: str, limit: int) -> str:
    folder = shared_dir(t.spark, "pages")
    rest.register(t.spark)
    rest.store_pages(rows, folder, order, limit=limit)
    return folder


_STORED = {"fetch": "foliant.sources.rest.stored_fetch", "count": "foliant.sources.rest.stored_count"}


@query("SELECT row_number() OVER (ORDER BY event_id) - 1 AS row_ix, 'n' || event_id AS id, event_type AS kind FROM events")
def paged_notes(t: Tables) -> DataFrame:
    """Stored pages of 1,000 notes, each an input partition; the last one is short."""
    notes = t.events.select("event_id", _joined("n", F.col("event_id")).alias("id"), F.col("event_type").alias("kind"))
    folder = _stored_notes(t, notes, "event_id", 1000)
    read = t.spark.read.format("paged_notes").options(url=folder, limit=1000, **_STORED).load()
    return read.select("row_ix", "id", F.get_json_object("note", "$.kind").alias("kind"))


@query("SELECT row_number() OVER (ORDER BY s_suppkey) - 1 AS row_ix, 's' || s_suppkey AS id FROM supplier")
def throttled_notes(t: Tables) -> DataFrame:
    """With a gap between requests one reader fetches all pages in turn."""
    folder = _stored_notes(t, t.supplier.select("s_suppkey", _joined("s", F.col("s_suppkey")).alias("id")), "s_suppkey", 40)
    read = t.spark.read.format("paged_notes").options(url=folder, limit=40, gap=0.001, jitter=0, **_STORED).load()
    return read.select("row_ix", "id")


@query("SELECT row_number() OVER (ORDER BY event_id) - 1 AS row_ix, 'n' || event_id AS id, event_type AS kind FROM events")
def stream_paged_notes(t: Tables) -> DataFrame:
    """The same pages as a stream of several micro-batches, stopped after some and started again."""
    notes = t.events.select("event_id", _joined("n", F.col("event_id")).alias("id"), F.col("event_type").alias("kind"))
    half = t.events.agg(F.expr("percentile_approx(event_id, 0.5)")).first()[0]
    folder = _stored_notes(t, notes, "event_id", 1000)
    out, checkpoint = shared_dir(t.spark, "notes"), shared_dir(t.spark, "checkpoint")
    for rows in (2000, max(4000, int(half or 0) // 2)):
        stream = t.spark.readStream.format("paged_notes").options(url=folder, limit=1000, batch=rows, checkpointLocation=checkpoint, **_STORED).load()
        running = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(**({"availableNow": True} if rows == 2000 else {"processingTime": "0 seconds"})).start()
        if rows == 2000:
            running.awaitTermination()
        else:
            running.processAllAvailable()
            running.stop()
    return t.spark.read.schema("row_ix bigint, id string, note string").parquet(out).select("row_ix", "id", F.get_json_object("note", "$.kind").alias("kind"))


# --- summaries --------------------------------------------------------------------------------------------------------------

_HIST = "hist AS (SELECT r_name AS tier, n_name AS area, (n_nationkey || ';0*' || n_regionkey) AS s FROM nation JOIN region ON n_regionkey = r_regionkey)"


def _hist(t: Tables, value: str) -> DataFrame:
    own = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return own.select(F.lit("main").alias("track"), F.lit('a "dim"').alias("dim"), F.col("r_name").alias("tier"), F.col("n_name").alias("area"), F.concat(F.col("n_nationkey").cast("string"), F.lit(";0*"), F.col("n_regionkey").cast("string")).alias(value))


@query(f"WITH {_HIST} SELECT kind, 'a \"dim\"' AS dim, tier, area, s AS value FROM hist CROSS JOIN (VALUES ('hist'), ('tsf')) k(kind)")
def summary_round_trip(t: Tables) -> DataFrame:
    """The nested document of histograms and matrices, written and taken apart again; names may hold quotes."""
    doc = sinks.summary_document(_hist(t, "hist"), _hist(t, "tsf"))
    folder = shared_dir(t.spark, "summary")
    doc.select("document").coalesce(1).write.text(folder)
    whole = t.spark.read.text(folder).select(F.explode(F.from_json("value", "map<string,map<string,map<string,map<string,string>>>>")).alias("kind", "m"))
    return whole.select("kind", F.explode("m").alias("dim", "m")).select("kind", "dim", F.explode("m").alias("tier", "m")).select("kind", "dim", "tier", F.explode("m").alias("area", "value"))


def _stored_summary(t: Tables, old: bool) -> str:
    """A stored summary of nations as tiers, in the older or the newer layout."""
    k = F.col("n_nationkey").cast("string")
    by_tier = lambda v: F.map_from_entries(F.collect_list(F.struct(k, v)))
    string = F.concat(k, F.lit(";0*5"))
    own = t.nation.agg(by_tier(F.col("n_name")).alias("names"), by_tier(F.col("n_nationkey") * 10).alias("counts"), by_tier(string if old else F.create_map(F.lit("0"), string, F.lit("3"), F.lit("1"))).alias("strings"))
    none, rating, by_dim = F.create_map().cast("map<string,string>"), F.create_map(F.lit("0"), F.lit("rating")), F.create_map(F.lit("0"), "strings")
    fields = [none.alias("src"), by_dim.alias("hist"), by_dim.alias("tsf")]
    if old:
        fields += [F.struct(none.alias("hist")).alias("sum"), F.col("counts").alias("tnum"), F.col("names").alias("tname"), rating.alias("rname"), F.col("names").alias("tid")]
    else:
        fields += [F.struct(none.alias("hist"), F.col("counts").alias("count")).alias("sum"), F.struct(F.col("names").alias("tier"), rating.alias("review"), F.col("names").alias("tier_raw")).alias("name")]
    doc = own.select(F.to_json(F.create_map(F.lit("2024"), F.create_map(F.lit("main"), F.struct(*fields)))).alias("value"))
    return _written_text(t, doc.coalesce(1), "summary")


@query("SELECT layout, n_nationkey::INTEGER AS tier, n_name AS name, n_nationkey * 10 AS n FROM nation CROSS JOIN (VALUES ('old'), ('new')) l(layout)")
def summary_counts(t: Tables) -> DataFrame:
    def counts(layout: str) -> DataFrame:
        s = summaries.summary(t.spark, _stored_summary(t, layout == "old"), 2024, "main")
        return s["counts"].join(s["tiers"], "tier").join(s["ids"].select("name", F.col("tid").alias("own")), "name").where("own = tier").select(F.lit(layout).alias("layout"), "tier", "name", "n")

    return counts("old").unionByName(counts("new"))


@query("SELECT 'old' AS layout, k AS kind, 'rating' AS label, n_nationkey::INTEGER AS tier, 0 AS area, n_nationkey || ';0*5' AS value FROM nation CROSS JOIN (VALUES ('hist'), ('tsf')) l(k) UNION ALL SELECT 'new', k, 'rating', n_nationkey::INTEGER, a, CASE WHEN a = 0 THEN n_nationkey || ';0*5' ELSE '1' END FROM nation CROSS JOIN (VALUES ('hist'), ('tsf')) l(k) CROSS JOIN (VALUES (0), (3)) r(a)")
def summary_strings(t: Tables) -> DataFrame:
    out = []
    for layout in ("old", "new"):
        s = summaries.summary(t.spark, _stored_summary(t, layout == "old"), 2024, "main")
        out += [s[kind].select(F.lit(layout).alias("layout"), F.lit(kind).alias("kind"), "label", "tier", "area", "value") for kind in ("hist", "tsf")]
    return R.union(*out)


@query(f"WITH {PAPERS} SELECT primary_area AS conf, max(CASE WHEN year = 1995 THEN status END) AS \"1995\", max(CASE WHEN year = 1996 THEN status END) AS \"1996\" FROM papers GROUP BY 1")
def status_grid(t: Tables) -> DataFrame:
    return sinks.status_grid(t.orders_status().select(F.col("primary_area").alias("conf"), "year", F.col("status").alias("state")), [1995, 1996])


# --- pages ------------------------------------------------------------------------------------------------------------------


def _joined(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


@query("""SELECT 'https://x.org/list' || s_suppkey AS url, pos, title, author, site, id FROM (
 SELECT s_suppkey, 1 AS pos, s_name || ' one' AS title, 'Ann Lee, Bob ' || s_suppkey AS author, 'https://x.org/paper/a' || s_suppkey AS site, 'a' || s_suppkey AS id FROM supplier
 UNION ALL SELECT s_suppkey, 2, s_name || ' two', '', 'https://y.org/paper/b' || s_suppkey, 'b' || s_suppkey FROM supplier)""")
def html_cards(t: Tables) -> DataFrame:
    """Cards with and without authors; an address that is no card's, and a link without text, are left out."""
    k = F.col("s_suppkey")
    html = _joined("<a href='/home'>home</a><div class=card><a class='small-title' href='/paper/a", k, "'> ", F.col("s_name"), "\n one</a><div class='author-str'>Ann Lee · Bob ", k, "</div></div><div><a href='https://y.org/paper/b", k, "'>", F.col("s_name"), " two</a></div><a href='/paper/none'></a>")
    return pages.cards(t.supplier.select(_joined("https://x.org/list", k).alias("url"), html.alias("html")), "/paper/")


@query("""SELECT 'u' || c_custkey AS url, tab::INTEGER AS "table", CASE WHEN c_custkey % 2 = 0 THEN section END AS section, r::INTEGER AS "row", cells FROM customer CROSS JOIN (VALUES (0, 'Posters', 0), (0, 'Posters', 1), (1, 'Orals', 0)) v(tab, section, r)
 CROSS JOIN LATERAL (SELECT CASE WHEN tab = 0 AND r = 0 THEN 'No.|Title' WHEN tab = 0 THEN c_custkey || '|' || c_name ELSE c_name || '|' || c_mktsegment END AS cells)""")
def html_tables(t: Tables) -> DataFrame:
    """Two tables a page; every second page has a heading too many, so its sections are unknown."""
    k = F.col("c_custkey")
    more = F.when(k % 2 == 0, "").otherwise("<h2>Stray</h2>")
    html = _joined(more, "<h3>Posters</h3><table><tr><th>No.<th>Title</tr><tr><td>", k, "</td><td><b>", F.col("c_name"), "</b></td></tr></table><h3>Orals</h3><table><tr><td>", F.col("c_name"), "<td> ", F.col("c_mktsegment"), "\n</table>")
    got = pages.tables(t.customer.select(_joined("u", k).alias("url"), html.alias("html")))
    return got.select("url", "table", "section", "row", F.array_join("cells", "|").alias("cells"))


@query("""SELECT 'https://oa.org/p/' || c_custkey AS url, c_name AS title, 'Ann Lee, Bob Roe' AS author, 'https://oa.org/pdf/' || c_custkey || '.pdf' AS pdf, '2401.' || c_custkey AS arxiv, CASE WHEN c_custkey % 2 = 0 THEN 'https://github.com/x/' || c_custkey ELSE '' END AS github,
 '10.1/' || c_custkey AS doi, CASE WHEN c_custkey % 3 = 0 THEN '/s/' || c_custkey ELSE '' END AS slides FROM customer""")
def page_details(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    html = _joined("<title>", F.col("c_name"), "</title><div id='authors'><b>Ann Lee,; Bob Roe</b></div><a href='../pdf/", k, ".pdf'>pdf</a> <a href='https://arxiv.org/abs/2401.", k, "'>arXiv</a> <a href='https://doi.org/10.1/", k, "'>doi</a>", F.when(k % 2 == 0, _joined("<a href='https://github.com/x/", k, "'>Code</a>")).otherwise(""), F.when(k % 3 == 0, _joined("<a href='/s/", k, "'> Slides </a>")).otherwise(""))
    return pages.details(t.customer.select(_joined("https://oa.org/p/", k).alias("url"), html.alias("html"))).select("url", "title", "author", "pdf", "arxiv", "github", "doi", "slides")


@query("SELECT 'https://x.org/l' || c_custkey // 50 AS url, (row_number() OVER (PARTITION BY c_custkey // 50 ORDER BY c_custkey))::INTEGER AS pos, c_name AS title, 'https://x.org/content/' || c_custkey || '.html' AS site FROM customer")
def page_listing(t: Tables) -> DataFrame:
    """Listing pages of 50 papers; a link that is no paper's comes first on each."""
    item = lambda s: F.concat(F.lit("<dt><a href='/content/"), s["c_custkey"].cast("string"), F.lit(".html'>"), s["c_name"], F.lit("</a></dt>"))
    papers = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "c_name"))), item), "")
    pages_ = t.customer.groupBy(_blocks("c_custkey", 50)).agg(F.concat(F.lit("<a href='/home'>home</a>"), papers).alias("html"))
    return pages.listing(pages_.select(_joined("https://x.org/l", F.col("block")).alias("url"), "html"), "/content/")


@query("SELECT r_name AS category, 'sub' || r_regionkey AS subcategory, n_name AS conference, (n_nationkey + 1)::DOUBLE AS rank, (100 - n_nationkey)::VARCHAR AS h5_index, (n_nationkey * 2)::VARCHAR AS h5_median FROM nation JOIN region ON n_regionkey = r_regionkey")
def venue_rankings(t: Tables) -> DataFrame:
    k = F.col("n_nationkey")
    row = _joined("<tr><td>", k + 1, ".</td><td>", F.col("n_name"), "</td><td>", F.lit(100) - k, "</td><td>", k * 2, "</td></tr>")
    own = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("r_name", "n_regionkey", row.alias("row"))
    html = F.concat(F.lit("<table><tr><th></th><th>Publication</th><th>h5-index</th><th>h5-median</th></tr>"), F.array_join(F.collect_list("row"), ""), F.lit("</table>"))
    g = own.groupBy("r_name", "n_regionkey").agg(html.alias("html"))
    return pages.rankings(g.select(F.col("r_name").alias("category"), _joined("sub", F.col("n_regionkey")).alias("subcategory"), _joined("u", F.col("n_regionkey")).alias("url"), "html"))


@query("SELECT c_name AS title, CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN '10.1/' || c_custkey ELSE '' END AS doi FROM customer")
def doi_lookup(t: Tables) -> DataFrame:
    """Of a title's hits the first counts: the same title in other letters, another title, or no hit at all."""
    k = F.col("c_custkey")
    first = t.customer.where(k % 3 != 0).select(F.col("c_name").alias("title"), F.when(k % 3 == 1, F.upper("c_name")).otherwise("another").alias("hit_title"), F.lit(0).alias("hit_ix"), _joined("10.1/", k).alias("doi"))
    second = t.customer.where(k % 3 == 2).select(F.col("c_name").alias("title"), F.col("c_name").alias("hit_title"), F.lit(1).alias("hit_ix"), F.lit("second").alias("doi"))
    return pages.doi_lookup(t.customer.select(F.col("c_name").alias("title")), first.union(second))


@query("SELECT user_id AS ssid, arg_min(event_type, event_id) AS kind, min(event_id) AS row_ix FROM events WHERE event_type IN ('view', 'click') GROUP BY 1")
def rendered_rows(t: Tables) -> DataFrame:
    return pages.status_rows(t.events.select(F.col("user_id").alias("ssid"), F.col("event_type").alias("kind"), F.col("event_id").alias("row_ix")), ("view", "click"))


# --- columns ----------------------------------------------------------------------------------------------------------------


@query(f"WITH {PAPERS} SELECT id, coalesce(nullif(CASE WHEN id % 2 = 0 THEN '' ELSE status END, ''), 'Unknown') AS status FROM papers")
def default_fill(t: Tables) -> DataFrame:
    rows = t.orders_status().select("id", F.when(F.col("id") % 2 == 0, "").otherwise(F.col("status")).alias("status"))
    return P.default_fill(rows, "status", "Unknown")


@query("SELECT p_partkey, CASE WHEN contains(p_type, 'STEEL') THEN 'main' WHEN contains(p_type, 'BRASS') THEN 'ads' ELSE 'other' END AS track FROM part")
def track_by_content(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", P.track_by_content(F.col("p_type"), [("STEEL", "main"), ("BRASS", "ads")], "other").alias("track"))


@query("SELECT p_partkey, p_type FROM part WHERE NOT contains(p_type, 'STEEL')")
def without_value(t: Tables) -> DataFrame:
    return t.part.where(P.without_value("p_type", "STEEL")).select("p_partkey", "p_type")


@query("SELECT c_custkey, 0 AS p_id, 1 AS p_note, 2 AS p_name, 3 AS p_seg, '' AS note, c_name, c_mktsegment FROM customer")
def column_order(t: Tables) -> DataFrame:
    """Places of columns after one was added, one moved and the id put first."""
    df = t.customer.select("c_mktsegment", "c_name", "c_custkey")
    df = P.id_first(P.move_column(P.add_column(df, "note", "", before="c_mktsegment"), "c_mktsegment", "c_custkey"), "c_custkey")
    at = {c: i for i, c in enumerate(df.columns)}
    df = P.move_column(df, "c_name", "c_mktsegment")
    return df.select("c_custkey", F.lit(at["c_custkey"]).alias("p_id"), F.lit(at["note"]).alias("p_note"), F.lit(at["c_name"]).alias("p_name"), F.lit(at["c_mktsegment"]).alias("p_seg"), "note", "c_name", "c_mktsegment")


@query("SELECT n_name FROM nation WHERE n_regionkey <> 2")
def shown_rows(t: Tables) -> DataFrame:
    return P.shown(t.nation.withColumn("show", F.when(F.col("n_regionkey") == 2, "OTHERS").when(F.col("n_regionkey") == 1, F.lit(None)).otherwise("YES"))).select("n_name")


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'a:' || c_name ELSE '' END || CASE WHEN c_custkey % 2 = 0 AND c_custkey % 3 = 0 THEN ';' ELSE '' END || CASE WHEN c_custkey % 3 = 0 THEN 'b:' || c_mktsegment ELSE '' END AS kept FROM customer")
def without_blank_values(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    m = F.create_map(F.lit("a"), F.when(k % 2 == 0, F.col("c_name")).otherwise(""), F.lit("b"), F.when(k % 3 == 0, F.col("c_mktsegment")))
    return t.customer.select("c_custkey", arrays.key_values(arrays.without_blank_values(m)).alias("kept"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '~A_B' || c_custkey ELSE '' END AS ids FROM customer")
def author_id_filter(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    a = F.array(F.when(k % 2 == 0, _joined("~A_B", k)).otherwise("~A_B"), F.lit("a@b.org"), F.lit("A1"))
    return t.customer.select("c_custkey", text.join_items(arrays.filter_author_ids(a)).alias("ids"))


@query("SELECT p_partkey, CASE WHEN contains(p_type, 'STEEL') THEN 'Oral' WHEN contains(p_type, 'BRASS') THEN 'Spotlight' ELSE 'Poster' END AS status FROM part")
def status_in_text(t: Tables) -> DataFrame:
    page = F.replace(F.replace("p_type", F.lit("STEEL"), F.lit("an Oral talk")), F.lit("BRASS"), F.lit("Spotlight: 5 min"))
    return t.part.select("p_partkey", P.status_in_text(page).alias("status"))


@query("SELECT p_partkey, trim(p_type) AS status FROM part")
def status_cleanup(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", text.status_cleanup(_joined("venue/2024/accept ", F.col("p_type"), " paper")).alias("status"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'https://GitHub.com/' || c_custkey ELSE '' END AS github, CASE WHEN c_custkey % 2 = 0 THEN '' WHEN c_custkey % 3 = 0 THEN '' ELSE 'https://p.org/' || c_custkey END AS project FROM customer")
def github_and_project(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    github, project = text.github_and_project(F.when(k % 2 == 0, _joined("https://GitHub.com/", k)).when(k % 3 != 0, _joined("https://p.org/", k)))
    return t.customer.select("c_custkey", F.coalesce(github, F.lit("")).alias("github"), project.alias("project"))


@query("SELECT c_custkey, c_name || CASE WHEN c_custkey % 2 = 0 THEN ';' || c_mktsegment ELSE '' END AS kw FROM customer")
def join_items(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", text.join_items(F.array(F.lit(""), F.col("c_name"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise(""))).alias("kw"))


@query("SELECT c_custkey, 'x:' || CASE WHEN c_custkey % 2 = 0 THEN 'c' ELSE 'a' END || CASE WHEN c_custkey % 2 = 0 THEN '' ELSE ';y:c' END AS inverted FROM customer")
def inverted_map(t: Tables) -> DataFrame:
    """Of keys with one value the last stays."""
    other = F.when(F.col("c_custkey") % 2 == 0, "x").otherwise("y")
    return t.customer.select("c_custkey", arrays.key_values(arrays.sorted_map(arrays.inverted_map(F.create_map(F.lit("a"), F.lit("x"), F.lit("c"), other)))).alias("inverted"))


@query("SELECT event_id, event_id % 7 AS initial, CASE WHEN event_id % 3 = 0 THEN event_id % 5 END AS now, CASE WHEN event_id % 4 = 0 THEN event_id % 11 END AS revised FROM events")
def rebuttal_columns(t: Tables) -> DataFrame:
    """A form's second-round answers, under the columns that its first-round ones name."""
    k = F.col("event_id")
    sheet = t.events.select("event_id", (k % 7).alias("Initial Rating"), F.when(k % 3 == 0, k % 5).alias("[Optional] Rating after Rebuttal"), F.when(k % 4 == 0, k % 11).alias("[Optional] Rating after Revision"))
    second = [text.rebuttal_column("Initial Rating", s) for s in ("after Rebuttal", "after Revision")]
    return sheet.select("event_id", F.col("Initial Rating").alias("initial"), F.col(f"`{second[0]}`").alias("now"), F.col(f"`{second[1]}`").alias("revised"))


@query("SELECT c_custkey, '{\"a\": ' || c_custkey || ', \"b\": \"' || c_name || '\"}' AS args FROM customer")
def call_arguments(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", call_to_json(_joined("f(b='", F.col("c_name"), "', a=", F.col("c_custkey"), ")")).alias("args"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 5 ELSE greatest(o_orderkey % 7, o_orderkey % 3) END AS n, greatest(0, o_orderkey % 7 - o_orderkey % 5) AS late FROM orders")
def tier_counts(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    meta = F.when(k % 5 != 0, k % 5).when(k % 2 == 0, F.lit(0))
    return t.orders.select("o_orderkey", A.tier_count(meta, k % 7, k % 3).alias("n"), A.late_withdrawals(k % 7, k % 5).alias("late"))


@query("SELECT user_id AS file, 'k' AS key, sum((props ->> '$.k')::BIGINT) AS n FROM events GROUP BY 1 UNION ALL SELECT user_id, 'one', count(*) FROM events GROUP BY 1")
def token_usage(t: Tables) -> DataFrame:
    usage = F.create_map(F.lit("k"), F.get_json_object("props", "$.k").cast("bigint"), F.lit("one"), F.lit(1).cast("bigint"))
    return A.token_usage(t.events.select(F.col("user_id").alias("file"), usage.alias("usage")))


@query("SELECT l_orderkey, array_to_string(list_transform(list(l_linenumber), lambda x: max_line::VARCHAR), ';') AS scores FROM (SELECT l_orderkey, l_linenumber, max(l_linenumber) OVER (PARTITION BY l_orderkey) AS max_line FROM lineitem) GROUP BY l_orderkey, max_line")
def overwritten_scores(t: Tables) -> DataFrame:
    g = t.lineitem.groupBy("l_orderkey").agg(F.collect_list("l_linenumber").alias("a"), F.max("l_linenumber").alias("m"))
    return g.select("l_orderkey", F.array_join(arrays.overwrite_all(F.col("a"), F.col("m")).cast("array<string>"), ";").alias("scores"))


@query("""SELECT c_custkey AS k, row_number() OVER (ORDER BY c_name) - 1 AS a, row_number() OVER (ORDER BY c_custkey::VARCHAR) - 1 AS b, row_number() OVER (ORDER BY c_custkey DESC) - 1 AS c,
 row_number() OVER (ORDER BY c_nationkey, c_name DESC) - 1 AS d, row_number() OVER (ORDER BY c_nationkey DESC, c_custkey) - 1 AS e FROM customer""")
def row_orders(t: Tables) -> DataFrame:
    """The place of each row under five orders."""
    orders = {"a": ["c_name"], "b": [F.col("c_custkey").cast("string")], "c": [F.desc("c_custkey")], "d": ["c_nationkey", F.desc("c_name")], "e": [F.desc("c_nationkey"), "c_custkey"]}
    out = t.customer.select(F.col("c_custkey").alias("k"))
    for name, by in orders.items():
        out = out.join(scans.numbered(t.customer.select("c_custkey", "c_name", "c_nationkey"), *by, name=name).select(F.col("c_custkey").alias("k"), name), "k")
    return out


# --- joins ------------------------------------------------------------------------------------------------------------------


@query("SELECT c_custkey AS left_ix, s_suppkey AS right_ix FROM customer JOIN supplier ON c_custkey = s_suppkey WHERE c_custkey % 2 = 0")
def join_by_page(t: Tables) -> DataFrame:
    site = t.customer.select(F.col("c_custkey").alias("row_ix"), F.when(F.col("c_custkey") % 2 == 0, _joined("https://oa.org/", F.col("c_custkey"))).otherwise("").alias("oa"))
    return J.by_page(site, t.supplier.select(F.col("s_suppkey").alias("row_ix"), _joined("https://oa.org/", F.col("s_suppkey")).alias("site")))


@query("SELECT n_name AS conference, count(*) AS n, n_regionkey AS total FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 3")
def meta_lookup(t: Tables) -> DataFrame:
    stats = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("conference")).agg(F.count("*").alias("n"))
    meta = t.nation.select(F.col("n_name").alias("conference"), F.col("n_regionkey").alias("total"))
    return J.meta_lookup(stats, meta, "conference").select("conference", "n", "total")


@query("SELECT l_orderkey AS id, string_agg(CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE s_name END, ';' ORDER BY l_linenumber, l_suppkey, l_partkey) AS name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1")
def ordered_lookup(t: Tables) -> DataFrame:
    """Names of an array's items, in its order, with gaps where the table lacks them."""
    lists = t.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey", "l_partkey"))), lambda x: x["l_suppkey"]).alias("keys"))
    table = t.supplier.where("s_suppkey % 3 != 0").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return J.ordered_lookup(lists, "keys", table, "key", "name").select("id", F.array_join("name", ";").alias("name"))


@query("SELECT c_custkey, 's' || c_custkey AS site, CASE WHEN c_custkey % 4 = 0 THEN 'truth ' || c_custkey ELSE c_mktsegment END AS aff FROM customer")
def join_truth(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", _joined("s", F.col("c_custkey")).alias("site"), F.col("c_mktsegment").alias("aff"))
    truth = rows.where("c_custkey % 4 = 0").select("site", _joined("truth ", F.col("c_custkey")).alias("aff"))
    return J.with_truth(rows, truth).select("c_custkey", "site", "aff")


_KINDS = ("site", "openreview", "openaccess", "form")


@query("""WITH p AS (SELECT list_extract(['site', 'openreview', 'openaccess', 'form'], 1 + c_custkey % 4) AS a, list_extract(['site', 'openreview', 'openaccess', 'form'], 1 + c_nationkey % 4) AS b FROM customer)
SELECT a, b, CASE WHEN a = b THEN a WHEN a = 'site' AND b IN ('openreview', 'openaccess') THEN b WHEN a = 'openreview' AND b = 'openaccess' THEN a END AS base, count(*) AS n FROM p GROUP BY 1, 2, 3""")
def merge_rules(t: Tables) -> DataFrame:
    """Whose row is the base of a merge, for customers whose sources are two of four."""
    kind = lambda c: F.get(F.array(*map(F.lit, _KINDS)), (F.col(c) % 4).cast("int"))
    rules = t.spark.createDataFrame([(a, b, J.merge_rule(a, b)) for a in _KINDS for b in _KINDS], "a string, b string, base string")
    return t.customer.select(kind("c_custkey").alias("a"), kind("c_nationkey").alias("b")).join(rules, ["a", "b"]).groupBy("a", "b", "base").agg(F.count("*").alias("n"))


_SITED = ("cvpr", "eccv", "iclr", "wacv", "siggraph", "kdd", "aistats")


@query(f"""WITH v AS (SELECT list_extract([{", ".join(f"'{v}'" for v in _SITED)}], 1 + o_custkey % 7) AS venue, year(o_orderdate) + 27 AS year FROM orders)
SELECT venue, year, CASE WHEN venue = 'cvpr' THEN CASE WHEN year >= 2023 THEN 'cards' ELSE 'tables' END WHEN venue = 'eccv' THEN CASE WHEN year >= 2024 THEN 'cards' ELSE 'tables' END WHEN venue = 'iclr' THEN 'cards' WHEN venue = 'wacv' THEN 'tables' WHEN venue = 'siggraph' THEN 'browser' WHEN venue = 'kdd' THEN 'stub' END AS kind, count(*) AS n FROM v GROUP BY 1, 2, 3""")
def source_kinds(t: Tables) -> DataFrame:
    """How the sites of papers' venues are read in their years; a venue without a site has no kind."""
    venue = F.get(F.array(*map(F.lit, _SITED)), (F.col("o_custkey") % 7).cast("int"))
    papers = t.orders.select(venue.alias("venue"), (F.year("o_orderdate") + 27).cast("bigint").alias("year"))
    known = t.spark.createDataFrame([(v, y, source_kind(v, "site", y)) for v in _SITED if v in VENUES for y in range(2000, 2040)], "venue string, year bigint, kind string")
    return papers.join(known, ["venue", "year"]).groupBy("venue", "year", "kind").agg(F.count("*").alias("n"))


# --- venues -----------------------------------------------------------------------------------------------------------------


@query("SELECT 'n' || o_orderkey AS id, 'Paper ' || o_orderkey AS title, 'a;b' AS keywords, CASE WHEN o_orderstatus = 'F' THEN 'Reject' WHEN o_orderstatus = 'O' THEN 'Oral' ELSE 'venue P' END AS status, s.n AS n_reviews, s.ratings AS rating, round(s.avg, 6) AS rating_avg FROM orders JOIN (SELECT l_orderkey, count(*)::INTEGER AS n, string_agg(l_linenumber::DOUBLE::VARCHAR, ';' ORDER BY l_linenumber, l_suppkey, l_partkey) AS ratings, avg(l_linenumber) AS avg FROM lineitem GROUP BY 1) s ON l_orderkey = o_orderkey")
def notes_to_papers(t: Tables) -> DataFrame:
    """Notes whose fields are plain or wrapped, with their reviews, to papers."""
    scores = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey", "l_partkey")))
    review = lambda x: F.struct(F.lit("V/Official_Review").alias("invitation"), F.lit(None).cast("array<string>").alias("invitations"), F.create_map(F.lit("rating"), _joined('{"value":', x["l_linenumber"], "}")).alias("content"))
    # Reviews are built after the join: until then an order holds three numbers a review.
    g = t.lineitem.groupBy("l_orderkey").agg(scores.alias("scores"))
    title = F.when(F.col("o_orderkey") % 2 == 0, _joined('{"value":"Paper ', F.col("o_orderkey"), '"}')).otherwise(_joined("Paper ", F.col("o_orderkey")))
    content = F.create_map(F.lit("title"), title, F.lit("keywords"), F.lit('["a","","b"]'), F.lit("venue"), _joined("venue ", F.col("o_orderstatus")))
    own = t.orders.join(g, F.col("o_orderkey") == F.col("l_orderkey")).select(_joined("n", F.col("o_orderkey")).alias("id"), content.alias("content"), F.struct(F.lit(0).alias("replyCount"), F.transform("scores", review).alias("directReplies")).alias("details"))
    return notes.papers(own, {"rating": "rating"}, {"venue F": "Reject", "venue O": "Oral"}).select("id", "title", "keywords", "status", "n_reviews", "rating", F.round("rating_avg", 6).alias("rating_avg"))


def _note_lines(t: Tables) -> DataFrame:
    """Notes as lines of JSON in drifting layouts: fields plain or wrapped, one invitation or several, decisions in replies,
    some of them under another name, some twice."""
    k = F.col("o_orderkey")
    wrapped = lambda x: F.when(k % 2 == 0, _joined('{"value":', x, "}")).otherwise(x)
    decision = F.when(F.col("o_orderstatus") == "F", '"Reject and resubmit"').otherwise('"Accept"')
    invited = lambda x: F.when(k % 3 == 0, _joined('"invitations":["', x, '","V/Edit"]')).otherwise(_joined('"invitation":"', x, '"'))
    first = _joined("{", invited(F.lit("V/Paper/Decision")), ',"content":{"decision":"Pending"}}')
    second = _joined("{", invited(F.lit("V/Paper/Decision")), ',"content":{', F.when(k % 5 == 0, '"recommendation"').otherwise('"decision"'), ":", wrapped(decision), "}}")
    review = _joined("{", invited(F.lit("V/Official_Review")), ',"content":{"rating":', wrapped(F.when(k % 4 == 0, (k % 10).cast("string")).otherwise(_joined('"', k % 10, ': good"'))), "}}")
    empty = _joined("{", invited(F.lit("V/Paper/Decision")), ',"content":{"comment":"x"}}')
    replies = F.when(k % 7 == 0, _joined(review, ",", empty)).when(k % 7 == 1, _joined(review, ",", second, ",", empty)).otherwise(_joined(first, ",", review, ",", second))
    content = _joined('{"title":', wrapped(_joined('"Paper  ', k, '"')), ',"keywords":', wrapped(F.when(k % 3 == 1, '"one"').otherwise('["a","","b"]')), ',"venue":', wrapped(_joined('"venue ', F.col("o_orderstatus"), '"')), F.when(k % 11 == 0, ',"decision":"Oral"').otherwise(""), ',"Submission_Type":', wrapped(F.lit('"Long"')), "}")
    line = _joined('{"id":"n', k, '","content":', content, ',"details":{"directReplies":[', replies, "]}}")
    return t.orders.select(k, (k % 2).alias("layout"), line.alias("value"))


_DECIDED = "CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'Reject and resubmit' ELSE 'Accept' END"


@query(f"""SELECT 'n' || o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 'Reject' WHEN 'O' THEN 'Oral' ELSE 'venue P' END AS venue, CASE WHEN o_orderkey % 11 = 0 THEN 'Oral' END AS note, {_DECIDED} AS reply,
 CASE WHEN o_orderkey % 7 = 0 THEN 'Long' WHEN o_orderstatus = 'F' THEN 'Reject' ELSE 'Long Accept' END AS typed FROM orders""")
def notes_decisions(t: Tables) -> DataFrame:
    """The four rules for where a note's status stands, over notes of several layouts."""
    n = F.col("note")
    rows = variant_notes.parsed(_note_lines(t))
    kinds = {"venue": "venue", "note": "note", "reply": "reply", "typed": "type_and_reply"}
    return rows.select(F.try_variant_get(n, "$.id", "string").alias("id"), *[variant_notes.status(kind, n, {"venue F": "Reject", "venue O": "Oral"}).alias(c) for c, kind in kinds.items()])


@query(f"SELECT 'n' || o_orderkey AS id, 'Paper ' || o_orderkey AS title, CASE WHEN o_orderkey % 3 = 1 THEN 'one' ELSE 'a;b' END AS keywords, coalesce({_DECIDED}, '') AS status, 1 AS n_reviews, (o_orderkey % 10)::VARCHAR AS rating FROM orders")
def notes_as_variant(t: Tables) -> DataFrame:
    return variant_notes.papers(variant_notes.parsed(_note_lines(t)), "reply").drop("author")


@query("SELECT o_orderkey % 2 AS layout, f AS field, CASE WHEN f = 'decision' THEN 'STRING' WHEN f = 'keywords' AND o_orderkey % 3 <> 1 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'OBJECT<value: ARRAY<STRING>>' ELSE 'ARRAY<STRING>' END WHEN o_orderkey % 2 = 0 THEN 'OBJECT<value: STRING>' ELSE 'STRING' END AS kind, count(*) AS n FROM orders CROSS JOIN (VALUES ('title'), ('keywords'), ('venue'), ('decision'), ('Submission_Type')) v(f) WHERE f <> 'decision' OR o_orderkey % 11 = 0 GROUP BY ALL")
def notes_layouts(t: Tables) -> DataFrame:
    """Which field has which type how often, by layout."""
    return variant_notes.layouts(variant_notes.parsed(_note_lines(t)), "layout")


_FORM_CAPS = " ".join(f"WHEN venue = '{v}' THEN {r.get('cap', 100)}" for v, r in FORM_RULES.items())


@query(f"""SELECT venue, event_id AS row_ix, CASE WHEN event_id % 4 = 0 THEN 'main' ELSE 'ads' END AS track, (event_id % 4 + 1)::DOUBLE || ';' || (event_id % 3 + 1)::DOUBLE AS rating, (event_id % 4 + event_id % 3 + 2) / 2.0 AS rating_avg FROM events CROSS JOIN (VALUES {", ".join(f"('{v}')" for v in FORM_RULES)}) f(venue)
 WHERE event_id % 11 <> 0 AND (event_id % 4 + event_id % 3 + 2) / 2.0 <= CASE {_FORM_CAPS} END""")
def venue_forms(t: Tables) -> DataFrame:
    """Initial scores of all venues' forms: answers with letters and averages over the venue's cap are left out."""
    k = F.col("event_id")
    rating = F.when(k % 11 == 0, "none").otherwise(_joined(k % 4 + 1, ";", k % 3 + 1))
    sheet = t.events.select(k.alias("row_ix"), rating.alias("Initial Rating"), F.lit("3;3").alias("Initial Confidence"), F.lit("2;2").alias("Initial Novelty"), F.when(k % 4 == 0, "main").otherwise("ads").alias("Track"))
    out = []
    for v in FORM_RULES:
        spec = form_spec(v, 2024, {"rating": "Initial Rating", "confidence": "Initial Confidence", "novelty": "Initial Novelty"}, track_column="Track")
        out.append(forms.responses(sheet, spec).select(F.lit(v).alias("venue"), "row_ix", "track", "rating", "rating_avg"))
    return R.union(*out)


@query("""WITH s AS (SELECT c_custkey AS k, md5('v' || c_custkey) AS title, c_mktsegment AS status FROM customer), p AS (SELECT k, k::VARCHAR AS id, title || repeat('z', (k * 7 % 20)::INTEGER) AS title, CASE WHEN k % 5 = 0 THEN 'Reject' ELSE 'Poster' END AS status FROM s)
SELECT coalesce(p.id, 'site_' || substr(md5(s.title), 1, 10)) AS id, coalesce(p.title, s.title) AS title, coalesce(p.status, s.status) AS status FROM s LEFT JOIN (SELECT * FROM p WHERE k % 5 <> 0) p USING (k)
 UNION ALL SELECT id, title, status FROM p WHERE k % 5 = 0""")
def venue_resolution(t: Tables) -> DataFrame:
    """Site and platform lists of a venue as one: by forum id, then by title, which is one of many in its block and longer on
    the platform; rejected papers come from the platform."""
    k = F.col("c_custkey")
    block, title = F.col("c_nationkey").cast("string"), F.md5(_joined("v", k).cast("binary"))
    site = t.customer.select(k.alias("row_ix"), F.when(k % 2 == 0, _joined("https://openreview.net/forum?id=", k)).otherwise("").alias("openreview"), title.alias("title"), F.col("c_mktsegment").alias("status"), block.alias("block"))
    longer = F.concat(title, F.expr("repeat('z', cast(c_custkey * 7 % 20 as int))"))
    platform = t.customer.select(k.alias("row_ix"), k.cast("string").alias("id"), longer.alias("title"), F.when(k % 5 == 0, "Reject").otherwise("Poster").alias("status"), block.alias("block"))
    merged, _ = venue.resolve(site, platform, "nips")
    return merged.select("id", "title", "status")


@query(f"""WITH {PAPERS}, c AS (SELECT primary_area AS conference, count(*) FILTER (status = 'Oral') AS Oral, count(*) FILTER (status = 'Poster') AS Poster, count(*) FILTER (status = 'Reject') AS Reject FROM papers GROUP BY 1),
m AS (SELECT *, CASE WHEN conference LIKE '1%' THEN 12345 ELSE Oral + Poster + Reject END AS total FROM c)
SELECT conference, Oral, Poster, Reject, total::BIGINT AS total, Oral + Poster AS accept, round(Oral::DOUBLE / total, 9) AS Oral_share, round(Poster::DOUBLE / total, 9) AS Poster_share, round(Reject::DOUBLE / total, 9) AS Reject_share, round((Oral + Poster)::DOUBLE / total, 9) AS ac_rate FROM m""")
def server_rows(t: Tables) -> DataFrame:
    """The wide row of each conference, one of them with the meta sheet's total."""
    tiers = ["Oral", "Poster", "Reject"]
    counts = t.orders_status().groupBy(F.col("primary_area").alias("conference"), F.col("status").alias("tier")).agg(F.count("*").alias("n"))
    meta = t.orders.select(F.col("o_orderpriority").alias("conference")).distinct().withColumn("total", F.when(F.startswith("conference", F.lit("1")), "12,345").otherwise(""))
    row = venue.server_row(counts, meta, tiers)
    shares = [f"{x}_share" for x in tiers] + ["ac_rate"]
    return row.select("conference", *tiers, "total", "accept", *[F.round(c, 9).alias(c) for c in shares])


@query(f"""WITH {PAPERS}, m AS (SELECT primary_area AS conference, status AS tier, count(*) AS n FROM papers GROUP BY 1, 2), s AS (SELECT conference, tier, CASE WHEN tier = 'Oral' THEN n + 5 ELSE n // 2 END AS t FROM m WHERE tier <> 'Reject')
SELECT conference, tier, greatest(t, n) AS n, accept, round(accept::DOUBLE / 100000, 9) AS ac_rate FROM s JOIN m USING (conference, tier) JOIN (SELECT primary_area AS conference, count(*) FILTER (status <> 'Reject') AS accept FROM papers GROUP BY 1) a USING (conference)""")
def recounted_tiers(t: Tables) -> DataFrame:
    """Tiers of a year whose platform knows accepted papers only, counted again from the merged list."""
    papers = t.orders_status().select(F.col("primary_area").alias("conference"), "status")
    counted = papers.groupBy("conference", F.col("status").alias("tier")).agg(F.count("*").alias("n"))
    stats = counted.where("tier != 'Reject'").select("conference", "tier", F.when(F.col("tier") == "Oral", F.col("n") + 5).otherwise(F.floor(F.col("n") / 2)).alias("n"))
    accepted = papers.where("status != 'Reject'").groupBy("conference").agg(F.count("*").alias("accept"))
    totals = accepted.select("conference", "accept", F.lit(100_000).cast("bigint").alias("total"))
    return venue.recounted(stats, papers, totals).withColumn("ac_rate", F.round("ac_rate", 9))


# --- streams ----------------------------------------------------------------------------------------------------------------


def _events(t: Tables, in_order: bool = False) -> DataFrame:
    """The events as a stream of three parts, one in each micro-batch; in order of their ids, or dealt by hash. A part is as
    many files of about a million rows as it takes, so that no task writes or reads all of it."""
    folder = shared_dir(t.spark, "events")
    rows = t.events.select("event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    size = t.events.agg(F.max("event_id").alias("m"), F.count("*").alias("n")).first()
    most, files = (size.m or 0) + 1, 1 + size.n // 3_000_000
    file = F.floor(F.col("event_id") * 3 / most) if in_order else F.pmod(F.xxhash64("event_id"), F.lit(3))
    for k in range(3):
        part = rows.where(file == k)
        (part.repartition(files) if files > 1 else part.coalesce(1)).write.mode("append").parquet(folder)
    return t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1")
def stream_upserts(t: Tables) -> DataFrame:
    """Stored rows replaced by key, batch by batch, in buckets; events come in no order, so most batches hold late ones."""
    rows = _events(t).select("user_id", "event_id", "event_type")
    path = shared_dir(t.spark, "table")
    incremental.upsert_stream(rows, path, "user_id", shared_dir(t.spark, "checkpoint"), order="event_id").awaitTermination()
    return incremental.stored_rows(t.spark, path, rows.schema, "user_id", "event_id").read()


@query("SELECT user_id, min(event_id) AS event_id, arg_min(event_type, event_id) AS event_type FROM events GROUP BY 1")
def stream_first(t: Tables) -> DataFrame:
    """The first row of each key by its order, not by its arrival: all rows are as good, and the earliest of equal ones stays."""
    rows = _events(t).select("user_id", "event_id", "event_type").withColumn("score", F.lit(0.0))
    first = stateful.keep_best_stream(rows, "user_id", "score", "event_id").withColumn("rank", -F.col("event_id"))
    path = shared_dir(t.spark, "first")
    incremental.upsert_stream(first, path, "user_id", shared_dir(t.spark, "checkpoint"), order="rank").awaitTermination()
    return incremental.stored_rows(t.spark, path, first.schema, "user_id", "rank").read().select("user_id", "event_id", "event_type")


@query("SELECT user_id, count(*) AS n FROM (SELECT DISTINCT user_id FROM events) GROUP BY 1")
def stream_distinct(t: Tables) -> DataFrame:
    """One row a key within the watermark, whichever came first."""
    path = shared_dir(t.spark, "first")
    rows = incremental.first_of_stream(_events(t), "user_id", "ts", late="3650 days")
    rows.select("user_id").writeStream.format("parquet").option("path", path).option("checkpointLocation", shared_dir(t.spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.schema("user_id bigint").parquet(path).groupBy("user_id").agg(F.count("*").alias("n"))


@query(f"SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, {bin_sql('value', 50.0)} AS bin, count(*) AS n FROM events GROUP BY 1, 2")
def stream_histograms(t: Tables) -> DataFrame:
    """Histograms by day of event time, kept up to date; counts only grow, so the largest one of a cell is the last."""
    hist = incremental.histogram_stream(_events(t), "value", "ts", late="3650 days", top=50.0)
    rows = hist.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "bin", "n").withColumn("cell", _joined(F.col("day"), "/", F.col("bin")))
    path = shared_dir(t.spark, "histograms")
    incremental.upsert_stream(rows, path, "cell", shared_dir(t.spark, "checkpoint"), order="n").awaitTermination()
    return incremental.stored_rows(t.spark, path, rows.schema, "cell", "n").read().drop("cell")


_BEST = "CASE WHEN length(event_type || '/' || user_id) > 6 THEN event_type || '/' || user_id ELSE event_type || '/' || user_id || '#' || event_id END"


@query(f"SELECT key, event_id, value, event_type FROM (SELECT {_BEST} AS key, event_id, value, event_type, row_number() OVER (PARTITION BY {_BEST} ORDER BY value DESC, event_id) AS k FROM events WHERE value IS NOT NULL) WHERE k = 1")
def stream_keep_best(t: Tables) -> DataFrame:
    """The best row of each key while rows arrive in no order, stored by key; keys of few letters are too vague and keep all
    their rows."""
    rows = _events(t)
    key = F.concat("event_type", F.lit("/"), F.col("user_id").cast("string"))
    rows = rows.withColumn("key", F.when(F.length(key) > 6, key).otherwise(F.concat(key, F.lit("#"), F.col("event_id").cast("string"))))
    best = stateful.keep_best_stream(rows.select("key", "event_id", "value", "event_type"), "key", "value", "event_id")
    best = best.withColumn("rank", F.struct("value", -F.col("event_id")))
    path = shared_dir(t.spark, "best")
    incremental.upsert_stream(best, path, "key", shared_dir(t.spark, "checkpoint"), order="rank").awaitTermination()
    return incremental.stored_rows(t.spark, path, best.schema, "key", "rank").read().drop("rank")


@query("""WITH e AS (SELECT user_id, event_id, event_type, first_value(value / 5) OVER w AS before, value / 5 AS avg, row_number() OVER (PARTITION BY user_id, event_id % 50 ORDER BY event_id DESC) AS k FROM events WINDOW w AS (PARTITION BY user_id, event_id % 50 ORDER BY event_id))
SELECT event_type AS status, least(greatest(trunc(before * 10)::INTEGER, 0), 99) AS r, least(greatest(50 + trunc((avg - before) * 10)::INTEGER, 0), 99) AS c, count(*) AS n FROM e WHERE k = 1 GROUP BY 1, 2, 3""")
def stream_transfer_counts(t: Tables) -> DataFrame:
    """A transfer matrix by status kept up to date by signed changes: a paper's event takes it out of its old cell and puts
    it into a new one; events come in no order. The initial scores are a static snapshot."""
    paper = lambda: F.concat(F.col("user_id").cast("string"), F.lit("/"), (F.col("event_id") % 50).cast("string"))
    initial = stored(t.events.groupBy(paper().alias("id")).agg((F.min_by("value", "event_id") / 5).alias("avg")), "initial")
    rows = incremental.snapshot_changes(_events(t).withColumn("id", paper()), initial)
    r, c = scores.transfer_cell(F.col("before"), F.col("value") / 5)
    cells = rows.select("id", "event_id", F.col("event_type").alias("status"), r.alias("r"), c.alias("c"))
    changes = stateful.cell_changes(cells, "id", "event_id", ["status", "r", "c"])
    path = shared_dir(t.spark, "cells")
    incremental.count_stream(changes, path, ["status", "r", "c"], shared_dir(t.spark, "checkpoint")).awaitTermination()
    return incremental.stored_counts(t.spark, path, changes.schema, ["status", "r", "c"]).read()


@query("""WITH o AS (SELECT user_id, CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' ELSE 'no_record' END AS outcome, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
f AS (SELECT user_id, count(*) AS n, min(k) FILTER (outcome <> 'no_record') AS final, arg_min(outcome, k) FILTER (outcome <> 'no_record') AS how FROM o GROUP BY 1)
SELECT user_id::VARCHAR AS title, least(coalesce(final, n), 4, n)::INTEGER AS tries, CASE WHEN final <= 4 THEN how WHEN n >= 4 THEN 'no_record' ELSE 'pending' END AS status FROM f""")
def stream_retries(t: Tables) -> DataFrame:
    """Final states and tries of tasks whose outcomes are replayed: three more tries after no record."""
    outcome = F.when(F.col("event_type") == "purchase", "success").when(F.col("event_type") == "error", "failed").otherwise("no_record")
    rows = _events(t, in_order=True).select(F.col("user_id").cast("string").alias("title"), F.col("event_id").alias("order"), outcome.alias("outcome"), F.col("ts").alias("time")).withWatermark("time", "1 day")
    states = stateful.retry_stream(rows, most=3, forget_ms=3650 * 86_400_000).where("event = 'outcome'").select("title", "tries", "status")
    path = shared_dir(t.spark, "tasks")
    incremental.upsert_stream(states, path, "title", shared_dir(t.spark, "checkpoint"), order="tries").awaitTermination()
    return incremental.stored_rows(t.spark, path, states.schema, "title", "tries").read()


@query("SELECT event_id, event_type, n AS before FROM events JOIN (SELECT user_id, count(*)::DOUBLE AS n FROM events GROUP BY 1) USING (user_id)")
def stream_snapshot_changes(t: Tables) -> DataFrame:
    path = shared_dir(t.spark, "changes")
    initial = t.events.groupBy("user_id").agg(F.count("*").cast("double").alias("avg"))
    rows = incremental.snapshot_changes(_events(t), initial, "user_id").select("event_id", "event_type", "before")
    rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", shared_dir(t.spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.schema("event_id bigint, event_type string, before double").parquet(path)


@query("SELECT c_name AS title, CASE c_custkey % 4 WHEN 0 THEN c_custkey % 3 ELSE c_custkey % 3 + 1 END AS attempts, CASE c_custkey % 4 WHEN 0 THEN 'pending' WHEN 1 THEN 'success' WHEN 2 THEN CASE WHEN c_custkey % 3 + 1 <= 2 THEN 'pending' ELSE 'no_record' END ELSE 'failed' END AS status FROM customer")
def retry_round(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    work = t.customer.select(F.col("c_name").alias("title"), (k % 3).alias("attempts"), F.lit("pending").alias("status"))
    outcome = t.customer.where(k % 4 != 0).select(F.col("c_name").alias("title"), F.when(k % 4 == 1, "success").when(k % 4 == 2, "no_record").otherwise("failed").alias("status"))
    return incremental.retry_queue(work, outcome)


@query("SELECT outcome, count(*) AS n FROM (SELECT CASE c_custkey % 3 WHEN 0 THEN 'success' WHEN 1 THEN 'no_record' ELSE 'pending' END AS outcome FROM customer) GROUP BY 1")
def outcome_counts(t: Tables) -> DataFrame:
    k = F.col("c_custkey") % 3
    return A.status_counts(t.customer.select(F.when(k == 0, "success").when(k == 1, "no_record").otherwise("pending").alias("outcome")), "outcome")


@query("SELECT r_regionkey AS id, r_name AS title FROM region")
def resumed_table(t: Tables) -> DataFrame:
    """A stored table that has rows is not fetched again."""
    folder = shared_dir(t.spark, "stored")
    own = t.region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("title"))
    sinks.save_list(own, folder)

    def fetch() -> DataFrame:
        raise AssertionError("fetched though rows are stored")

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("title", T.StringType())])
    return incremental.resumed(lambda: t.spark.read.schema(schema).json(folder), fetch)
