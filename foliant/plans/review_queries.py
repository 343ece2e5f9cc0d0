"""Queries of review analytics: histograms, transfer matrices, top-k lists, decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions import arrays, scores
from foliant.operators import aggregates as A
from foliant.operators import joins as J
from foliant.operators import rows as R
from foliant.operators.checks import checked
from foliant.plans import venue
from foliant.plans.registry import query
from foliant.plans.views import INITIAL, LISTS, PAPERS, REVIEWS, SCORES, STATUSES, Tables
from foliant.storage import shared_dir


def _edges(top: float) -> str:
    return "[" + ", ".join(f"{e!r}::DOUBLE" for e in scores.edges(top)) + "]"


def bin_sql(x: str, top: float = 10.0) -> str:
    clipped = f"least(greatest(coalesce({x}, 0), 0), {top})"
    return f"least(len(list_filter({_edges(top)}, lambda e: e <= {clipped})) - 1, 99)::INTEGER"


_SCORED = f"{PAPERS}, {SCORES}, scored AS (SELECT papers.*, scores.avg, scores.n FROM papers JOIN scores USING (id))"


@query(f"WITH {_SCORED} SELECT status, {bin_sql('avg')} AS bin, count(*) AS n FROM scored GROUP BY 1, 2")
def hist_by_status(t: Tables) -> DataFrame:
    return A.histogram(t.scored_papers(), F.col("avg"), ("status",))


@query(f"""WITH {_SCORED}, b AS (SELECT status AS tier, primary_area AS area, {bin_sql('avg')} AS bin FROM scored)
SELECT coalesce(tier, 'overall') AS tier, coalesce(area, 'overall') AS area, bin, count(*) AS n FROM b GROUP BY GROUPING SETS ((tier, area, bin), (tier, bin), (area, bin), (bin))""")
def hist_cube(t: Tables) -> DataFrame:
    df = t.scored_papers().select(F.col("status").alias("tier"), F.col("primary_area").alias("area"), "avg")
    return A.histogram_cube(df, F.col("avg"), [("tier", "area"), ("tier",), ("area",), ()])


_DENSE = "SELECT status, string_agg(coalesce(n, 0)::VARCHAR, ';' ORDER BY b) AS hist, sum(coalesce(n, 0))::BIGINT AS total FROM (SELECT DISTINCT status FROM h) CROSS JOIN (SELECT unnest(range(100)) AS b) g LEFT JOIN h USING (status, b) GROUP BY 1"


@query(f"WITH {_SCORED}, h AS (SELECT status, {bin_sql('avg')} AS b, count(*) AS n FROM scored GROUP BY 1, 2) {_DENSE}")
def hist_dense_string(t: Tables) -> DataFrame:
    return A.dense_string(A.histogram(t.scored_papers(), F.col("avg"), ("status",)), ("status",))


@query(f"WITH {REVIEWS} SELECT {bin_sql('rating')} AS bin, sum(confidence)::BIGINT AS n FROM reviews GROUP BY 1")
def hist_weighted(t: Tables) -> DataFrame:
    return A.histogram(t.reviews(), F.col("rating"), weight=F.col("confidence"))


@query(f"WITH {SCORES} SELECT {bin_sql('n::DOUBLE', 100.0)} AS bin, count(*) AS n FROM scores GROUP BY 1")
def hist_replies(t: Tables) -> DataFrame:
    return A.histogram(t.scores().withColumn("replies", F.col("n").cast("double")), F.col("replies"), top=100.0)


_TIERED = f"{_SCORED}, h AS (SELECT CASE WHEN id % 500 = 0 THEN 'Active' ELSE status END AS tier, {bin_sql('avg')} AS bin, count(*) AS n FROM scored GROUP BY 1, 2)"


@query(f"""WITH {_TIERED}, total AS (SELECT sum(n) AS s, coalesce(sum(n) FILTER (tier = 'Active'), 0) AS a FROM h)
SELECT tier, bin, sum(n)::BIGINT AS n FROM (SELECT tier, bin, n FROM h UNION ALL SELECT 'Active', bin, n FROM h, total WHERE tier IN ('Poster', 'Oral') AND a < s * 0.01) GROUP BY 1, 2""")
def active_rollup(t: Tables) -> DataFrame:
    df = t.scored_papers().withColumn("tier", F.when(F.col("id") % 500 == 0, "Active").otherwise(F.col("status")))
    return A.active_rollup(A.histogram(df, F.col("avg"), ("tier",)), ["Poster", "Oral"])


_CELLS = "least(greatest(trunc(before * 10)::INTEGER, 0), 99) AS r, least(greatest(50 + trunc((avg - before) * 10)::INTEGER, 0), 99) AS c"
_PAIRS = f"{PAPERS}, {SCORES}, {INITIAL}, pairs AS (SELECT scores.id, scores.avg, initial.avg AS before, papers.status FROM scores JOIN initial USING (id) JOIN papers USING (id))"


def _pairs(t: Tables) -> DataFrame:
    now = t.scored_papers().select("id", "row_ix", "status", "avg")
    return J.snapshot_pairs(now, t.scores(initial=True).withColumn("row_ix", F.col("id")))


@query(f"WITH {_PAIRS} SELECT {_CELLS}, count(*) AS n FROM pairs GROUP BY 1, 2")
def transfer_matrix(t: Tables) -> DataFrame:
    return A.transfer_matrix(_pairs(t))


@query(f"WITH {_PAIRS} SELECT status, {_CELLS}, count(*) AS n FROM pairs GROUP BY 1, 2, 3")
def transfer_by_status(t: Tables) -> DataFrame:
    return A.transfer_matrix(_pairs(t), ("status",))


@query(f"""WITH {_PAIRS}, cells AS (SELECT status, {_CELLS}, count(*) AS n FROM pairs GROUP BY 1, 2, 3),
k AS (SELECT status, r * 100 + c AS k, n FROM cells UNION ALL SELECT DISTINCT status, 10000, NULL FROM cells),
gap AS (SELECT *, k - coalesce(lag(k) OVER (PARTITION BY status ORDER BY k), -1) - 1 AS z FROM k),
part AS (SELECT status, k, CASE WHEN z > 3 THEN '0*' || z ELSE nullif(repeat('0;', z)[:2 * z - 1], '') END AS zeros, n::VARCHAR AS n FROM gap)
SELECT status, string_agg(concat_ws(';', zeros, n), ';' ORDER BY k) FILTER (zeros IS NOT NULL OR n IS NOT NULL) AS tsf FROM part GROUP BY 1""")
def transfer_rle(t: Tables) -> DataFrame:
    return A.transfer_string(A.transfer_matrix(_pairs(t), ("status",)), ("status",))


@query(f"WITH {_PAIRS} SELECT count(*) FILTER (NOT (trunc(before * 10)::INTEGER BETWEEN 0 AND 99 AND 50 + trunc((avg - before) * 10)::INTEGER BETWEEN 0 AND 99)) AS clamped, count(*) AS n FROM pairs")
def transfer_clamped(t: Tables) -> DataFrame:
    return _pairs(t).agg(F.count(F.when(scores.transfer_clamped(F.col("before"), F.col("avg")), 1)).alias("clamped"), F.count("*").alias("n"))


def _topk_sql(items: str, source: str, statuses: list[str] = STATUSES, extra: str = "") -> str:
    counts = ", ".join(f"count(*) FILTER (status = '{s}') AS c{i}" for i, s in enumerate(statuses))
    wanted = ", ".join(f"'{s}'" for s in statuses)
    return f"""SELECT name, count(*) AS total, {counts}, min(row_ix * 1048576 + pos) AS first_seen
FROM (SELECT row_ix, status, unnest({items}) AS name, unnest(range(len({items}))) AS pos FROM {source} WHERE status IN ({wanted})) WHERE name <> '' {extra} GROUP BY name ORDER BY total DESC, first_seen LIMIT 200"""


_MODES = {"all": "{0}", "unique": "list_filter({0}, lambda x, i: list_position({0}, x) = i)", "first": "{0}[1:1]", "last": "{0}[len({0}):len({0})]"}
_PARTS = "kw AS (SELECT p_partkey AS row_ix, 'Poster' AS status, string_split(p_name, ' ') AS items FROM part)"


def _register_topk() -> None:
    lists = f"{PAPERS}, {LISTS}, l AS (SELECT lists.*, papers.status FROM lists JOIN papers USING (row_ix))"
    for mode, items in _MODES.items():

        def affiliations(t: Tables, mode=mode) -> DataFrame:
            return A.topk(t.affiliation_lists(), F.col("affs"), STATUSES, mode=mode, without="double-blind")

        query(f"WITH {lists} {_topk_sql(items.format('affs'), 'l')}", f"topk_affiliations_{mode}")(affiliations)
    for mode in ("all", "first", "unique"):

        def keywords(t: Tables, mode=mode) -> DataFrame:
            df = t.part.select(F.col("p_partkey").alias("row_ix"), F.lit("Poster").alias("status"), F.split("p_name", " ").alias("items"))
            return A.topk(df, F.col("items"), ["Poster"], mode=mode)

        query(f"WITH {_PARTS} {_topk_sql(_MODES[mode].format('items'), 'kw', ['Poster'])}", f"topk_keywords_{mode}")(keywords)
    for mode in ("all", "first", "last"):

        def authors(t: Tables, mode=mode) -> DataFrame:
            return A.topk_authors(t.affiliation_lists(), F.col("names"), F.col("ids"), STATUSES, mode=mode)

        counts = ", ".join(f"count(*) FILTER (status = '{s}') AS c{i}" for i, s in enumerate(STATUSES))
        ids, names = (_MODES[mode].format(c) for c in ("ids", "names"))
        query(
            f"""WITH {lists}, flat AS (SELECT row_ix, status, unnest({names}) AS name, unnest({ids}) AS key, unnest(range(len({ids}))) AS pos FROM l)
SELECT arg_min(name, row_ix * 1048576 + pos) AS name, key AS author_id, count(*) AS total, {counts}, min(row_ix * 1048576 + pos) AS first_seen FROM flat GROUP BY key ORDER BY total DESC, first_seen LIMIT 200""",
            f"topk_authors_{mode}",
        )(authors)


_register_topk()


def _track_papers(t: Tables) -> DataFrame:
    """Papers with their four lists as ';'-joined text; some affiliations are withheld, some authors have no id."""
    lists = t.affiliation_lists()
    more = t.papers().select("row_ix", F.col("primary_area").alias("track"), F.concat_ws(";", "position", F.col("year").cast("string")).alias("position"))
    odd = F.col("row_ix") % 5 == 0
    affs = F.when(odd, F.concat(F.lit("double-blind review;"), F.array_join("affs", ";"))).otherwise(F.array_join("affs", ";"))
    ids = F.when(F.col("row_ix") % 7 == 0, "").when(F.col("row_ix") % 11 == 0, "one").otherwise(F.array_join("ids", ";"))
    columns = [affs.alias("aff"), F.array_join("names", ";").alias("author"), ids.alias("authorids"), F.concat_ws(";", "status", "aff1").alias("keywords")]
    return lists.withColumn("aff1", F.get("affs", F.lit(0))).join(more, "row_ix").select("row_ix", "status", "track", "position", *columns)


def _lists_sql(statuses: list[str] | None) -> str:
    wanted = f"WHERE status IN ({', '.join(repr(s) for s in statuses)})" if statuses else ""
    parts = {f"{c}_{m}": (_MODES[m].format(c), _MODES[m].format(c)) for c, modes in {"aff": ("all", "unique", "first", "last"), "position": ("all", "unique", "first", "last"), "keywords": ("all", "first")}.items() for m in modes}
    parts |= {f"author_{m}": (_MODES[m].format("author"), _MODES[m].format("keys")) for m in ("all", "first", "last")}
    rows = " UNION ALL ".join(f"SELECT track, status, row_ix, '{n}' AS list, unnest({names}) AS name, unnest({keys}) AS key, unnest(range(len({keys}))) AS pos FROM p {wanted}" for n, (names, keys) in parts.items())
    counts = "".join(f", count(*) FILTER (status = '{s}') AS c{i}" for i, s in enumerate(statuses or ()))
    return f"""WITH {PAPERS}, {LISTS}, l AS (SELECT lists.*, papers.status, primary_area AS track, [position, year::VARCHAR] AS position FROM lists JOIN papers USING (row_ix)),
p AS (SELECT row_ix, status, track, CASE WHEN row_ix % 5 = 0 THEN list_prepend('double-blind review', affs) ELSE affs END AS aff, list_filter(position, lambda x: x IS NOT NULL) AS position, [status, affs[1]] AS keywords,
 CASE WHEN row_ix % 7 <> 0 AND row_ix % 11 = 0 AND len(names) <> 1 THEN [] ELSE names END AS author, CASE WHEN row_ix % 7 = 0 THEN names WHEN row_ix % 11 = 0 THEN CASE WHEN len(names) = 1 THEN ['one'] ELSE [] END ELSE ids END AS keys FROM l),
flat AS ({rows}), g AS (SELECT track, list, key, arg_min(name, row_ix * 1048576 + pos) AS name, count(*) AS total{counts}, min(row_ix * 1048576 + pos) AS first_seen FROM flat WHERE name <> '' AND NOT contains(name, 'double-blind') GROUP BY 1, 2, 3)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY track, list ORDER BY total DESC, first_seen)::INTEGER AS rank FROM g) WHERE rank <= 200"""


@query(_lists_sql(STATUSES))
def top_lists_by_track(t: Tables) -> DataFrame:
    """Thirteen lists of every track, from one scan."""
    return venue.top_lists(_track_papers(t), STATUSES)


@query(_lists_sql(None))
def top_lists_without_status(t: Tables) -> DataFrame:
    """The same where a venue's statuses are not told apart."""
    return venue.top_lists(_track_papers(t), None)


@query(f"""WITH {_SCORED}, b AS (SELECT 'rating' AS dim, status AS tier, primary_area AS area, {bin_sql('avg')} AS bin FROM scored UNION ALL SELECT 'replies', status, primary_area, {bin_sql('n::DOUBLE', 100.0)} FROM scored)
SELECT dim, coalesce(tier, 'overall') AS tier, coalesce(area, 'overall') AS area, bin, count(*) AS n FROM b GROUP BY GROUPING SETS ((dim, tier, area, bin), (dim, tier, bin), (dim, area, bin), (dim, bin))""")
def venue_summaries(t: Tables) -> DataFrame:
    """All histograms of two dimensions and all their groupings, from one scan."""
    return venue.summaries(t.scored_papers().withColumnsRenamed({"avg": "rating_avg", "n": "replies"}), ("rating", "replies"))


@query(f"WITH {PAPERS}, p AS (SELECT row_ix, status, [position] AS items FROM papers WHERE position IS NOT NULL) {_topk_sql('items', 'p')}")
def topk_positions(t: Tables) -> DataFrame:
    return A.topk(t.papers().where("position is not null"), F.array("position"), STATUSES)


@query(f"WITH {_PARTS}, top AS ({_topk_sql('items', 'kw', ['Poster'])}) SELECT string_agg(name || ':' || total || ':' || c0, ';' ORDER BY total DESC, first_seen) AS top FROM top")
def topk_string(t: Tables) -> DataFrame:
    df = t.part.select(F.col("p_partkey").alias("row_ix"), F.lit("Poster").alias("status"), F.split("p_name", " ").alias("items"))
    return A.topk_string(A.topk(df, F.col("items"), ["Poster"]), 1)


@query("SELECT keyword, count(*) AS n FROM (SELECT unnest(string_split(lower(p_name), ' ')) AS keyword FROM part) WHERE keyword <> '' GROUP BY 1")
def keyword_frequency(t: Tables) -> DataFrame:
    return A.keyword_frequency(t.part, F.split(F.lower("p_name"), " "))


@query(f"WITH {PAPERS} SELECT status, count(*) AS n FROM papers GROUP BY 1")
def status_counter(t: Tables) -> DataFrame:
    return A.status_counts(t.orders_status())


@query(f"WITH {PAPERS} SELECT status, row_number() OVER (ORDER BY min(row_ix)) - 1 AS tid, count(*) AS n FROM papers GROUP BY 1")
def tier_ids(t: Tables) -> DataFrame:
    return A.tier_ids(t.orders_status())


@query(f"WITH {PAPERS} SELECT 'overall' AS area, 0::BIGINT AS ord UNION ALL SELECT primary_area, row_number() OVER (ORDER BY primary_area) FROM (SELECT DISTINCT primary_area FROM papers WHERE primary_area <> '')")
def distinct_areas(t: Tables) -> DataFrame:
    return A.areas(t.orders_status())


@query(f"WITH {PAPERS} SELECT year, count(*) AS total, count(*) FILTER (status <> 'Reject') AS accept, count(*) FILTER (status <> 'Reject')::DOUBLE / count(*) AS rate FROM papers GROUP BY 1")
def acceptance_rate(t: Tables) -> DataFrame:
    return A.acceptance(t.orders_status(), ("year",))


@query(f"WITH {PAPERS} SELECT year, count(*) FILTER (status = 'Poster') AS Poster, count(*) FILTER (status = 'Oral') AS Oral, count(*) FILTER (status = 'Reject') AS Reject FROM papers GROUP BY 1")
def tier_pivot(t: Tables) -> DataFrame:
    return A.tier_pivot(t.orders_status(), "year", STATUSES)


@query(f"""WITH {PAPERS}, g AS (SELECT status, count(*) AS n, min(row_ix) AS f FROM papers GROUP BY 1), x AS (SELECT 'Oral' AS status, 0 AS rank UNION ALL SELECT 'Spotlight', 1)
SELECT status, coalesce(n, 0) AS n, row_number() OVER (ORDER BY coalesce(rank, 2), coalesce(n, 0) DESC, f) AS ord FROM g FULL JOIN x USING (status)""")
def tier_order(t: Tables) -> DataFrame:
    return A.tier_order(t.orders_status(), ["Oral", "Spotlight"])


@query(f"WITH {PAPERS}, i AS (SELECT year::VARCHAR AS invitation, count(*) AS n FROM papers GROUP BY 1 UNION ALL SELECT 'Total', max(id) FROM papers) SELECT sum(n) FILTER (invitation = 'Total')::BIGINT AS total FROM i")
def submission_totals(t: Tables) -> DataFrame:
    p = t.orders_status()
    counts = p.groupBy(F.col("year").cast("string").alias("invitation")).agg(F.count("*").alias("n"))
    return A.submission_totals(counts.union(p.agg(F.lit("Total"), F.max("id"))))


@query(f"""WITH {REVIEWS} SELECT id, count(*) AS n, CASE WHEN max(rating) = 0 THEN 0 ELSE round(sum(rating * 5)::BIGINT / (count(*) * 5.0::DOUBLE), 6) END AS rating_avg,
round(coalesce(covar_pop(rating, confidence) / nullif(stddev_pop(rating) * stddev_pop(confidence), 0), 0), 4) + 0.0 AS corr FROM reviews GROUP BY 1""")
def review_mean_corr(t: Tables) -> DataFrame:
    r = t.reviews()
    # The exact zero of a constant vector: a deviation that rounding leaves counts as none.
    means = r.groupBy("id").agg(F.round(F.sum((F.col("rating") * 5).cast("bigint")) / (F.count("*") * 5.0), 6).alias("rating_avg"))
    return A.correlation(r.withColumn("confidence", F.col("confidence").cast("double")), "id", "rating", "confidence").join(means, "id").select("id", "n", "rating_avg", (F.round("corr", 4) + 0.0).alias("corr"))


@query("""WITH w AS (SELECT l_orderkey AS id, list((l_quantity::BIGINT) ORDER BY l_quantity, l_partkey, l_suppkey, l_extendedprice) AS main, list(round(l_discount * 100)::BIGINT ORDER BY l_quantity, l_partkey, l_suppkey, l_extendedprice) AS conf FROM lineitem GROUP BY 1)
SELECT id, array_to_string(main, ';') AS ratings, array_to_string(conf, ';') AS confidences FROM w""")
def scores_by_main(t: Tables) -> DataFrame:
    g = t.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_list(F.struct("l_partkey", "l_suppkey", "l_extendedprice", F.col("l_quantity").cast("bigint").alias("q"), F.round(F.col("l_discount") * 100).cast("bigint").alias("d")))).alias("a"))
    s = g.select("id", scores.argsort_by_main(F.transform("a", lambda x: x["q"]), F.transform("a", lambda x: x["d"])).alias("s"))
    return s.select("id", F.array_join(F.transform("s", lambda x: x["main"].cast("string")), ";").alias("ratings"), F.array_join(F.transform("s", lambda x: x["o0"].cast("string")), ";").alias("confidences"))


@query("SELECT user_id, arg_max(event_type, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 WHEN 'purchase' THEN 5 ELSE 4 END) AS event_type FROM events GROUP BY 1")
def highest_status(t: Tables) -> DataFrame:
    """The event of highest priority of each user; kinds that have none come between."""
    return A.highest_status(t.events, "user_id", {"view": 1, "click": 2, "signup": 3, "purchase": 5}, "event_type", default=4).select("user_id", "event_type")


@query("SELECT p_type, p_partkey, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part")
def rank_within_category(t: Tables) -> DataFrame:
    return R.ranked(t.part, "p_type", F.desc("p_retailprice"), "p_partkey").select("p_type", "p_partkey", "rank")


@query(f"WITH {_SCORED}, h AS (SELECT 'rating' AS dim, status, {bin_sql('avg')} AS bin, count(*) AS n FROM scored GROUP BY 1, 2, 3 UNION ALL SELECT 'replies', status, {bin_sql('n::DOUBLE', 100.0)}, count(*) FROM scored GROUP BY 1, 2, 3), s AS (SELECT status, dim, sum(n) AS s FROM h GROUP BY 1, 2) SELECT status, min(s)::BIGINT AS lo, max(s)::BIGINT AS hi, min(s) = max(s) AS equal FROM s GROUP BY 1")
def invariant_hist_sums(t: Tables) -> DataFrame:
    p = t.scored_papers()
    one = A.histogram(p, F.col("avg"), ("status",)).withColumn("dim", F.lit("rating"))
    two = A.histogram(p.withColumn("n", F.col("n").cast("double")), F.col("n"), ("status",), 100.0).withColumn("dim", F.lit("replies"))
    return A.compared_sums(one.unionByName(two), ("status",), "dim")


@query(f"WITH {_PAIRS}, a AS (SELECT count(*) AS n FROM pairs), b AS (SELECT sum(n) AS n FROM (SELECT {_CELLS}, count(*) AS n FROM pairs GROUP BY 1, 2)) SELECT least(a.n, b.n)::BIGINT AS lo, greatest(a.n, b.n)::BIGINT AS hi, a.n = b.n AS equal FROM a, b")
def invariant_tsf_sums(t: Tables) -> DataFrame:
    pairs = _pairs(t)
    total = pairs.agg(F.count("*").alias("n")).withColumn("dim", F.lit("rows"))
    cells = A.transfer_matrix(pairs).select("n").withColumn("dim", F.lit("cells"))
    return A.compared_sums(total.unionByName(cells), (), "dim")


@query(f"WITH {_SCORED} SELECT status, count(*) AS lo, count(*) + 1 AS hi FROM scored WHERE status = 'Oral' GROUP BY 1")
def planted_sum_violation(t: Tables) -> DataFrame:
    """One bin of one status counts a paper too many: the check names that status and no other."""
    p = t.scored_papers()
    hist = A.histogram(p, F.col("avg"), ("status",))
    planted = hist.where("status = 'Oral'").groupBy("status").agg(F.min("bin").alias("bin"), F.lit(1).cast("bigint").alias("n"))
    wrong = hist.unionByName(planted).withColumn("dim", F.lit("bins"))
    rows = p.groupBy("status").agg(F.count("*").alias("n")).withColumn("dim", F.lit("rows"))
    return A.unequal_sums(wrong.select("status", "dim", "n").unionByName(rows.select("status", "dim", "n")), ("status",), "dim")


@query(f"""WITH {_SCORED} SELECT 'average in range' AS name, count(*) AS rows, count(*) FILTER (NOT (avg BETWEEN 0 AND 10)) AS violations, min(status) FILTER (NOT (avg BETWEEN 0 AND 10)) AS first, max(status) FILTER (NOT (avg BETWEEN 0 AND 10)) AS last FROM scored
UNION ALL SELECT 'few reviews', count(*), count(*) FILTER (n > 6), min(status) FILTER (n > 6), max(status) FILTER (n > 6) FROM scored""")
def inline_checks(t: Tables) -> DataFrame:
    """Checks of scored papers, seen while their table is written, with the groups of what violates them."""
    job = checked(t.scored_papers().select("id", "status", "avg", "n"), {"average in range": F.col("avg").between(0, 10), "few reviews": F.col("n") <= 6}, F.col("status"))
    job.frame.write.parquet(shared_dir(t.spark, "scored"))
    return t.spark.createDataFrame(job.report(), "name string, rows bigint, violations bigint, first string, last string")


@query("WITH a AS (SELECT l_orderkey AS id, string_agg((CASE WHEN l_quantity::BIGINT % 3 = 0 THEN l_quantity::BIGINT ELSE 0 END)::VARCHAR, ';' ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity) AS s, count(*) AS n FROM lineitem GROUP BY 1) SELECT id, s AS decoded, n FROM a")
def rle_roundtrip(t: Tables) -> DataFrame:
    q = F.col("l_quantity").cast("int")
    g = t.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_list(F.struct("l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", F.when(q % 3 == 0, q).otherwise(0).alias("v")))).alias("a"), F.count("*").alias("n"))
    coded = g.select("id", "n", arrays.rle_encode(F.transform("a", lambda x: x["v"])).alias("coded"))
    return coded.select("id", F.array_join(F.transform(arrays.rle_decode(F.col("coded")), lambda x: x.cast("string")), ";").alias("decoded"), "n")
