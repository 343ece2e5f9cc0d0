"""Queries of scalar functions, extraction and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions import arrays, scores, text
from foliant.functions.documents import extract_affiliations, parse_json, phrase, similarity, written_title
from foliant.operators import aggregates as A
from foliant.plans.registry import query
from foliant.plans.views import Tables
from foliant.sources import pages as pages_source

_MARKS = ["", ",", "/", "-", ";", " "]


def _cells(t: Tables) -> DataFrame:
    """Score cells made of quantities, their separator chosen by the order's key."""
    q = F.col("l_quantity").cast("int") % 10
    g = t.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_list(F.struct("l_partkey", "l_suppkey", "l_extendedprice", q.alias("q")))).alias("a"))
    values = F.transform("a", lambda x: x["q"].cast("string"))
    cell = F.array_join(values, "")
    for k, mark in enumerate(_MARKS):
        cell = F.when(F.col("id") % 6 == k, F.array_join(values, mark)).otherwise(cell)
    return g.select("id", cell.alias("cell"))


_CELLS = """c AS (SELECT l_orderkey AS id, list((l_quantity::INTEGER % 10)::VARCHAR ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity::INTEGER % 10) AS q FROM lineitem GROUP BY 1),
cells AS (SELECT id, CASE id % 6 WHEN 0 THEN array_to_string(q, '') WHEN 1 THEN array_to_string(q, ',') WHEN 2 THEN array_to_string(q, '/') WHEN 3 THEN array_to_string(q, '-') WHEN 4 THEN array_to_string(q, ';') ELSE array_to_string(q, ' ') END AS cell, q FROM c)"""


@query(f"WITH {_CELLS} SELECT id, cell, CASE WHEN cell = '10' THEN '10.0' ELSE array_to_string(list_transform(q, lambda x: x || '.0'), ';') END AS scores FROM cells")
def auto_split_scores(t: Tables) -> DataFrame:
    return _cells(t).select("id", "cell", scores.score_join(scores.score_list(F.col("cell"))).alias("scores"))


@query(f"WITH {_CELLS}, s AS (SELECT id, CASE WHEN cell = '10' THEN [10] ELSE list_transform(q, lambda x: x::INTEGER) END AS v FROM cells) SELECT id, round(list_sum(v)::DOUBLE / len(v), 6) AS avg FROM s")
def score_means(t: Tables) -> DataFrame:
    return _cells(t).select("id", F.round(scores.score_mean(scores.score_list(F.col("cell"))), 6).alias("avg"))


@query("SELECT l_orderkey AS id, l_linenumber AS line, CASE WHEN l_linenumber = 2 THEN 0 ELSE l_quantity::INTEGER END AS score FROM lineitem")
def label_scores(t: Tables) -> DataFrame:
    q = F.col("l_quantity").cast("int").cast("string")
    label = F.when(F.col("l_linenumber") == 1, F.concat(q, F.lit(": accept"))).when(F.col("l_linenumber") == 2, "none").otherwise(F.concat(q, F.lit(" points")))
    return t.lineitem.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), scores.label_score(label).alias("score"))


@query("SELECT doc_id, 'site_' || substr(md5(text), 1, 10) AS sid, 'GF_' || md5(doc_id::VARCHAR) AS gid FROM documents")
def surrogate_ids(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.surrogate_id(F.col("text")).alias("sid"), text.privacy_hash(F.col("doc_id").cast("string")).alias("gid"))


@query(r"SELECT page_id, regexp_extract(url, '([^/?#]*)([?#].*)?$', 1) AS last, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS host, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) AS scheme FROM pages")
def url_parts(t: Tables) -> DataFrame:
    u = F.col("url")
    return t.pages.select("page_id", text.url_last_segment(u).alias("last"), text.url_host(u).alias("host"), text.url_scheme(u).alias("scheme"))


@query("SELECT page_id, replace(url, '/', '|') AS changed, url LIKE '%github.com%' AS is_github FROM pages")
def url_rewrite(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.url_rewrite(F.col("url"), "/", "|").alias("changed"), text.is_github(F.col("url")).alias("is_github"))


@query("SELECT page_id, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || '/a/b.pdf' AS root, 'https://x.org/y' AS absolute FROM pages")
def url_join(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.url_join(F.col("url"), F.lit("/a/b.pdf")).alias("root"), text.url_join(F.col("url"), F.lit("https://x.org/y")).alias("absolute"))


@query(r"SELECT doc_id, trim(regexp_replace(replace(text, chr(8203), ' '), '\s+', ' ', 'g')) AS title FROM documents")
def title_normalise(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.title_normalise(F.col("text")).alias("title"))


@query("SELECT c_custkey, 'nips' || 2024 || CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE '_' || lower(regexp_replace(left(c_mktsegment, 4), '[^A-Za-z]', '', 'g')) END AS cid FROM customer")
def cid_build(t: Tables) -> DataFrame:
    track = F.when(F.col("c_mktsegment") == "BUILDING", "main").otherwise(F.col("c_mktsegment"))
    return t.customer.select("c_custkey", text.conference_id(F.lit("nips"), F.lit(2024), track).alias("cid"))


@query("SELECT o_orderkey, (trunc(o_totalprice))::BIGINT AS n FROM orders")
def money_parse(t: Tables) -> DataFrame:
    whole = F.format_number(F.floor("o_totalprice").cast("double"), 0)
    return t.orders.select("o_orderkey", text.comma_number(whole).alias("n"))


@query("SELECT c_custkey, replace(c_name || ', ' || c_mktsegment, ',', ';') AS semi, replace(replace(c_name || ' · ' || c_mktsegment || ';', ' · ', ', '), ';', '') AS comma FROM customer")
def author_delims(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", text.authors_by_semicolon(F.concat_ws(", ", "c_name", "c_mktsegment")).alias("semi"), text.author_delimiters(F.concat("c_name", F.lit(" · "), "c_mktsegment", F.lit(";"))).alias("comma"))


@query("SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda x: trim(x)), ';') AS kw FROM part")
def keyword_delims(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", text.comma_to_semicolon(F.replace("p_name", F.lit(" "), F.lit(","))).alias("kw"))


@query("SELECT event_id, (props ->> '$.k') AS k FROM events")
def json_props(t: Tables) -> DataFrame:
    return t.events.select("event_id", scores.value_or_wrapped(F.concat(F.lit('{"value":"'), F.get_json_object("props", "$.k"), F.lit('"}'))).alias("k"))


@query(r"SELECT conv_id, turn, regexp_extract('before ```json' || chr(10) || text || chr(10) || '``` after', '```(?:json)?[\s\x0B]*(.*?)[\s\x0B]*```', 1, 's') AS inner_text FROM conversations")
def json_fence_strip(t: Tables) -> DataFrame:
    fenced = F.concat(F.lit("before ```json\n"), F.col("text"), F.lit("\n``` after"))
    return t.conversations.select("conv_id", "turn", text.strip_fence(fenced).alias("inner_text"))


@query("SELECT event_id, '{\"k\": ' || (props ->> '$.k') || '}' AS parsed FROM events")
def json_repair(t: Tables) -> DataFrame:
    broken = F.concat(F.lit("Sure: {"), F.regexp_replace("props", r"\}\s*$", ",}}"), F.lit(" done"))
    return t.events.select("event_id", parse_json(broken).alias("parsed"))


@query("SELECT conv_id, turn, (len(string_split(text, ' ')) <> len(string_split(role || ' ' || role, ' '))) AS differ FROM conversations")
def array_length_mismatch(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", arrays.lengths_differ(F.col("text"), F.concat_ws(" ", "role", "role"), " ").alias("differ"))


@query("""WITH n AS (SELECT count(*) AS rows, count(*) FILTER (text LIKE '%@%') AS mail, count(*) FILTER (length(text) < 100) AS short FROM documents)
SELECT 'mail' AS class, mail AS n, round(mail::DOUBLE / rows, 6) AS share FROM n UNION ALL SELECT 'short', short, round(short::DOUBLE / rows, 6) FROM n""")
def extraction_qa(t: Tables) -> DataFrame:
    q = A.extraction_quality(t.documents, {"mail": F.contains("text", F.lit("@")), "short": F.length("text") < 100})
    return q.select("class", "n", F.round("share", 6).alias("share"))


@query("SELECT p_brand, string_agg(p_type || ':' || n, ';' ORDER BY p_type) AS dims FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL) GROUP BY 1")
def dimension_strings(t: Tables) -> DataFrame:
    g = t.part.groupBy("p_brand", "p_type").agg(F.count("*").alias("n")).groupBy("p_brand").agg(F.map_from_entries(F.collect_list(F.struct("p_type", "n"))).alias("m"))
    return g.select("p_brand", arrays.key_values(arrays.sorted_map(F.col("m"))).alias("dims"))


@query("SELECT p_brand, string_agg(replace(p_type, ' ', ','), ';' ORDER BY p_type) AS shifted FROM (SELECT DISTINCT p_brand, p_type FROM part) GROUP BY 1")
def level_shift(t: Tables) -> DataFrame:
    g = t.part.select("p_brand", "p_type").distinct().groupBy("p_brand").agg(F.array_sort(F.collect_list("p_type")).alias("a"))
    return g.select("p_brand", F.array_join(F.transform("a", lambda x: text.level_shift(F.replace(x, F.lit(" "), F.lit(";")))), ";").alias("shifted"))


@query("SELECT o_orderkey, 'request-' || o_orderpriority || '-' || o_orderkey AS custom_id, o_orderkey::INTEGER AS ix FROM orders")
def custom_ids(t: Tables) -> DataFrame:
    c = text.custom_id(F.col("o_orderpriority"), F.col("o_orderkey"))
    return t.orders.select("o_orderkey", c.alias("custom_id"), text.custom_id_index(c).alias("ix"))


# --- pages and texts that need Python workers -------------------------------------------------------------------------------


@query(r"SELECT page_id, trim(regexp_replace(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g')) AS title FROM pages")
def html_title(t: Tables) -> DataFrame:
    return t.pages.select("page_id", written_title(F.col("html")).alias("title"))


@query()
def html_text(t: Tables) -> DataFrame:
    p = pages_source.parsed(t.pages).select("page_id", "page.*")
    return p.select("page_id", "title", "lang", F.length("text").alias("n_chars"), F.size("anchors").alias("n_anchors"), F.size("tables").alias("n_tables"))


@query(r"SELECT page_id, len(regexp_extract_all(html, 'https?://[^\s<>\"''(){}\[\]]+')) AS n FROM pages")
def page_links(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.size(text.links(F.col("html"))).cast("bigint").alias("n"))


@query("SELECT c_custkey, c_mktsegment || ' University; Institute of ' || c_mktsegment AS aff FROM customer")
def affiliation_rules(t: Tables) -> DataFrame:
    page = F.concat(F.col("c_name"), F.lit(" 1 "), F.col("c_mktsegment"), F.lit(" University 2 Institute of "), F.col("c_mktsegment"), F.lit(" a@b.org Abstract x"))
    return t.customer.select("c_custkey", extract_affiliations(page, F.col("c_name")).alias("aff"))


@query("SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'AI2XL; 42dot' WHEN 1 THEN 'I2R; University of Ulm' ELSE '3Dwe.ai; Lab' END AS aff FROM supplier")
def affiliations_with_digits(t: Tables) -> DataFrame:
    """Institutions whose names hold digits, which are no marks."""
    k = F.col("s_suppkey")
    own = F.when(k % 3 == 0, "1 AI2XL 2 42dot").when(k % 3 == 1, F.lit("1 I2R 2 University of Ulm")).otherwise("1 3Dwe.ai 2 Lab")
    page = F.concat(F.col("s_name"), F.lit(" "), own, F.lit("\nAbstract text"))
    return t.supplier.select("s_suppkey", extract_affiliations(page, F.col("s_name")).alias("aff"))


@query("SELECT p_partkey, lower(p_name) || '-( x)' AS phrase FROM part")
def phrase_normalise(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", phrase(F.concat(F.lit(" "), "p_name", F.lit(" - (  X ) "))).alias("phrase"))


@query()
def title_similarity(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.round(similarity(F.col("p_name"), F.col("p_type")), 6).alias("score"))
