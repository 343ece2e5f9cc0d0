"""Histograms, transfer matrices, top-k lists and decision statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions.scores import BINS, histogram_bin, transfer_cell

# --- histograms -----------------------------------------------------------------------------------------------------------


def histogram(df: DataFrame, value: Column, by: tuple[str, ...] = (), top: float = 10.0, weight: Column | None = None) -> DataFrame:
    """Rows (by.., bin, n) of the bins that occur; n sums truncated weights if given."""
    extra = [] if weight is None else [weight.alias("__w")]
    n = F.count("*") if weight is None else F.sum("__w").cast("bigint")
    return df.select(*by, histogram_bin(value, top).alias("bin"), *extra).groupBy(*by, "bin").agg(n.alias("n"))


def histogram_cube(df: DataFrame, value: Column, dims: list[tuple[str, ...]], top: float = 10.0) -> DataFrame:
    """Histograms under several groupings in one pass: columns of all groupings ('overall' where one is summed over)."""
    columns = list(dict.fromkeys(c for d in dims for c in d))
    return count_cube(df.select(*columns, histogram_bin(value, top).alias("bin")), ("bin",), dims)


def count_cube(rows: DataFrame, fixed: tuple[str, ...], dims: list[tuple[str, ...]]) -> DataFrame:
    """Counts by the fixed columns under several groupings of others in one pass; 'overall' where one is summed over."""
    columns = list(dict.fromkeys(c for d in dims for c in d))
    sets = ", ".join("(" + ", ".join([*d, *fixed]) + ")" for d in dims)
    names = ", ".join(f"CASE WHEN grouping({c}) = 1 THEN 'overall' ELSE {c} END AS {c}" for c in columns)
    return rows.sparkSession.sql(f"SELECT {names}, {', '.join(fixed)}, count(*) AS n FROM {{rows}} GROUP BY GROUPING SETS ({sets})", rows=rows)


def dense_string(hist: DataFrame, by: tuple[str, ...], bins: int = BINS) -> DataFrame:
    """One ';'-joined string of all bins for each group: a fixed number of entries, so a group's list is bounded."""
    m = hist.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("m"), F.sum("n").alias("total"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda b: F.coalesce(F.try_element_at("m", b), F.lit(0)).cast("string"))
    return m.select(*by, F.array_join(dense, ";").alias("hist"), "total")


def active_rollup(hist: DataFrame, tiers: list[str], share: float = 0.01) -> DataFrame:
    """Adds the tiers' bins to Active where Active holds less than `share` of the rows of all of them."""
    total = hist.agg(F.sum("n").alias("all_n"), F.sum(F.when(F.col("tier") == "Active", F.col("n")).otherwise(0)).alias("active_n"))
    few = F.coalesce(F.col("active_n"), F.lit(0)) < F.coalesce(F.col("all_n"), F.lit(0)) * share
    added = hist.where(F.col("tier").isin(*tiers)).join(F.broadcast(total)).where(few).select(F.lit("Active").alias("tier"), "bin", "n")
    return hist.select("tier", "bin", "n").unionByName(added).groupBy("tier", "bin").agg(F.sum("n").alias("n"))


def late_withdrawals(withdrawn: Column, counted: Column) -> Column:
    return F.greatest(F.lit(0), withdrawn - counted)


# --- transfer matrices ------------------------------------------------------------------------------------------------------


def transfer_matrix(pairs: DataFrame, by: tuple[str, ...] = (), before: str = "before", after: str = "avg", top: float = 10.0) -> DataFrame:
    """Rows (by.., r, c, n) of the cells that occur."""
    r, c = transfer_cell(F.col(before), F.col(after), top)
    return pairs.select(*by, r.alias("r"), c.alias("c")).groupBy(*by, "r", "c").agg(F.count("*").alias("n"))


def transfer_string(cells: DataFrame, by: tuple[str, ...], size: int = BINS, threshold: int = 3) -> DataFrame:
    """The zero-run coded matrix of each group, row-major, from the gaps between its cells: size * size cells at most."""
    end = F.array(F.struct(F.lit(size * size).cast("bigint").alias("k"), F.lit(None).cast("bigint").alias("n")))
    listed = F.array_sort(F.collect_list(F.struct((F.col("r") * size + F.col("c")).cast("bigint").alias("k"), "n")))
    m = cells.groupBy(*by).agg(F.concat(listed, end).alias("m"))

    def part(x: Column, i: Column) -> Column:
        gap = (x["k"] - F.coalesce(F.get("m", i - 1)["k"], F.lit(-1)) - 1).cast("int")
        zeros = F.when(gap > threshold, F.concat(F.lit("0*"), gap.cast("string"))).when(gap > 0, F.array_join(F.array_repeat(F.lit("0"), gap), ";"))
        return F.concat_ws(";", zeros, x["n"].cast("string"))

    parts = F.filter(F.transform("m", part), lambda s: s != "")
    return m.select(*by, F.array_join(parts, ";").alias("tsf"))


# --- top-k lists ------------------------------------------------------------------------------------------------------------


def picked(items: Column, mode: str) -> Column:
    """The items that count: all, the different ones, the first or the last."""
    if mode == "all":
        return items
    if mode == "unique":
        return F.array_distinct(items)
    if mode == "first":
        return F.slice(items, 1, 1)
    if mode == "last":
        return F.slice(items, F.greatest(F.size(items), F.lit(1)), F.lit(1))
    raise ValueError(mode)


def topk(df: DataFrame, items: Column, statuses: list[str], *, mode: str = "all", k: int = 200, row_ix: str = "row_ix", without: str | None = None, most: int = 1 << 20) -> DataFrame:
    """name, total, one count a status (c0, c1, ..) and first_seen of the k most frequent items.

    Ties go to the item seen first, by row_ix and place within the row (`most` items a row at most). Rows of other
    statuses do not count. Counting is partial before the shuffle, and the limit is a top-k operator.
    """
    rows = df.where(F.col("status").isin(*statuses)).select("status", row_ix, F.posexplode(picked(items, mode)).alias("pos", "name"))
    rows = rows.where(F.col("name") != "")
    counts = [F.sum(F.when(F.col("status") == s, 1).otherwise(0)).cast("bigint").alias(f"c{i}") for i, s in enumerate(statuses)]
    out = rows.groupBy("name").agg(F.count("*").alias("total"), *counts, F.min(F.col(row_ix) * F.lit(most) + F.col("pos")).alias("first_seen"))
    if without:
        out = out.where(~F.contains(F.col("name"), F.lit(without)))
    return out.orderBy(F.desc("total"), "first_seen").limit(k)


def topk_authors(df: DataFrame, names: Column, ids: Column, statuses: list[str], *, mode: str = "all", k: int = 200, row_ix: str = "row_ix", most: int = 1 << 20) -> DataFrame:
    """As topk(), by author id where there is one and else by name; the name shown is the one seen first.

    Rows whose lists differ in length do not count, unless they have no ids at all.
    """
    rows = df.where(F.col("status").isin(*statuses)).select("status", row_ix, names.alias("names"), ids.alias("ids"))
    rows = rows.where((F.size("ids") == F.size("names")) | (F.size("ids") == 0))
    zipped = F.arrays_zip("names", "ids")
    flat = rows.select("status", row_ix, F.posexplode(picked(zipped, mode)).alias("pos", "e")).select("status", (F.col(row_ix) * F.lit(most) + F.col("pos")).alias("seen"), F.col("e.names").alias("name"), F.coalesce(F.nullif(F.col("e.ids"), F.lit("")), F.col("e.names")).alias("key"))
    counts = [F.sum(F.when(F.col("status") == s, 1).otherwise(0)).cast("bigint").alias(f"c{i}") for i, s in enumerate(statuses)]
    out = flat.groupBy("key").agg(F.min_by("name", "seen").alias("name"), F.count("*").alias("total"), *counts, F.min("seen").alias("first_seen"))
    shown = F.when(F.col("key") == F.col("name"), "").otherwise(F.col("key"))
    return out.select("name", shown.alias("author_id"), "total", *[f"c{i}" for i in range(len(statuses))], "first_seen").orderBy(F.desc("total"), "first_seen").limit(k)


def named(items: Column) -> Column:
    """Items for top_lists() that are counted by their names."""
    return F.transform(items, lambda x: F.struct(x.alias("key"), x.alias("name")))


def identified(names: Column, ids: Column) -> Column:
    """Names for top_lists() that are counted by their ids where they have one; nothing where the lists differ in length,
    unless there are no ids at all."""
    zipped = F.transform(F.arrays_zip(names.alias("names"), ids.alias("ids")), lambda x: F.struct(F.coalesce(F.nullif(x["ids"], F.lit("")), x["names"]).alias("key"), x["names"].alias("name")))
    return F.when((F.size(ids) == F.size(names)) | (F.size(ids) == 0), zipped)


def top_lists(df: DataFrame, lists: dict[str, Column], statuses: list[str] | None, *, by: tuple[str, ...] = ("track",), k: int = 200, row_ix: str = "row_ix", most: int = 1 << 20) -> DataFrame:
    """The k most frequent items of several lists by group, in one scan: by.., list, rank, name, key, total, one count a
    status (c0, c1, ..) and first_seen. rank is by total, items that were seen first before others.

    lists: by name, arrays of (key, name); null ones are empty, and so are items without a name. statuses: rows of others do
    not count; None: all rows count, and there are no counts by status. Counts are partial before they are shuffled, and each
    task passes k items of a list on at most, so neither a frequent item nor a large group meets in one task.
    """
    def tagged(name: str, items: Column) -> Column:
        own = F.transform(items, lambda x, i: F.struct(F.lit(name).alias("list"), x["key"].alias("key"), x["name"].alias("name"), i.alias("pos")))
        return F.coalesce(own, F.array().cast("array<struct<list:string,key:string,name:string,pos:int>>"))

    rows = df if statuses is None else df.where(F.col("status").isin(*statuses))
    status = [] if statuses is None else [F.col("status")]
    flat = rows.select(*by, *status, F.col(row_ix).alias("__ix"), F.explode(F.concat(*[tagged(n, x) for n, x in lists.items()])).alias("e")).where("e.name != ''")
    # A name is shuffled where it differs from its key. Names are told apart first: their counts are of fixed width, which hash
    # aggregation takes, and only then is the first name of a key looked for, among few rows.
    other = F.when(~F.col("e.name").eqNullSafe(F.col("e.key")), F.col("e.name"))
    flat = flat.select(*by, *status, "e.list", "e.key", other.alias("__other"), (F.col("__ix") * F.lit(most) + F.col("e.pos")).alias("seen"))
    counts = [F.sum(F.when(F.col("status") == s, 1).otherwise(0)).cast("bigint").alias(f"c{i}") for i, s in enumerate(statuses or ())]
    named = flat.groupBy(*by, "list", "key", "__other").agg(F.count("*").alias("total"), *counts, F.min("seen").alias("seen"))
    first = F.min_by(F.coalesce("__other", "key"), "seen").alias("name")
    found = named.groupBy(*by, "list", "key").agg(first, *[F.sum(c).alias(c) for c in ("total", *(f"c{i}" for i in range(len(counts))))], F.min("seen").alias("first_seen"))
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by, "list").orderBy(F.desc("total"), "first_seen")))
    return ranked.where(F.col("rank") <= k).select(*by, "list", "rank", "name", "key", "total", *[f"c{i}" for i in range(len(counts))], "first_seen")


def topk_string(top: DataFrame, n_statuses: int) -> DataFrame:
    """'name:total:c0,c1;..' of a top-k list: k entries at most."""
    cell = F.concat_ws(":", "name", F.col("total").cast("string"), F.concat_ws(",", *[F.col(f"c{i}").cast("string") for i in range(n_statuses)]))
    ordered = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("total")).alias("o"), "first_seen", cell.alias("s")))).alias("a"))
    return ordered.select(F.array_join(F.transform("a", lambda x: x["s"]), ";").alias("top"))


def keyword_frequency(df: DataFrame, items: Column, most: int = 100_000) -> DataFrame:
    """keyword and n of the most frequent keywords, in alphabetical order."""
    counts = df.select(F.explode(items).alias("keyword")).where("keyword != ''").groupBy("keyword").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "keyword").limit(most).orderBy("keyword")


# --- decisions --------------------------------------------------------------------------------------------------------------


def status_counts(df: DataFrame, status: str = "status") -> DataFrame:
    return df.groupBy(status).agg(F.count("*").alias("n"))


def tier_ids(df: DataFrame, status: str = "status", row_ix: str = "row_ix") -> DataFrame:
    """Statuses with their count and an id in order of first appearance; a handful of rows after grouping."""
    g = df.groupBy(status).agg(F.min(row_ix).alias("first"), F.count("*").alias("n"))
    return g.select(status, (F.row_number().over(Window.orderBy("first")) - 1).cast("bigint").alias("tid"), "n")


def submission_totals(df: DataFrame, name: str = "invitation", n: str = "n", keep: tuple[str, ...] = ()) -> DataFrame:
    """The submissions of a track: those of the 'Total' invitation if there is one (with those of `keep`), else the sum."""
    total = F.sum(F.when(F.col(name) == "Total", F.col(n)))
    kept = F.sum(F.when(F.col(name).isin(*keep), F.col(n)).otherwise(0)) if keep else F.lit(0)
    return df.agg(F.when(total.isNotNull(), total + kept).otherwise(F.sum(n)).cast("bigint").alias("total"))


def acceptance(df: DataFrame, by: tuple[str, ...], accepted: list[str] | None = None) -> DataFrame:
    """total, accept and rate (0 without submissions); all but Reject count as accepted if no tiers are given."""
    ok = F.col("status").isin(*accepted) if accepted else F.col("status") != "Reject"
    g = df.groupBy(*by).agg(F.count("*").alias("total"), F.sum(F.when(ok, 1).otherwise(0)).cast("bigint").alias("accept"))
    return g.withColumn("rate", F.coalesce(F.try_divide(F.col("accept").cast("double"), F.col("total").cast("double")), F.lit(0.0)))


def tier_count(meta: Column, stat: Column, processed: Column) -> Column:
    """The meta sheet's count unless it is 0 or missing, else the larger of the others."""
    return F.when(F.coalesce(meta, F.lit(0)) != 0, meta).otherwise(F.greatest(stat, processed))


def tier_pivot(df: DataFrame, by: str, tiers: list[str], status: str = "status") -> DataFrame:
    return df.groupBy(by).pivot(status, tiers).agg(F.count(F.lit(1))).na.fill(0, tiers)


def tier_order(df: DataFrame, fixed: list[str], status: str = "status", row_ix: str = "row_ix") -> DataFrame:
    """Statuses with counts: the fixed ones first in their order (0 if absent), then the others by count."""
    g = df.groupBy(status).agg(F.count("*").alias("n"), F.min(row_ix).alias("first"))
    names = df.sparkSession.createDataFrame([(t, i) for i, t in enumerate(fixed)], f"{status} string, rank int")
    out = g.join(names, status, "full").withColumns({"n": F.coalesce("n", F.lit(0)), "rank": F.coalesce("rank", F.lit(len(fixed)))})
    return out.select(status, "n", F.row_number().over(Window.orderBy("rank", F.desc("n"), "first")).cast("bigint").alias("ord"))


def areas(df: DataFrame, column: str = "primary_area") -> DataFrame:
    """Different areas in order, 'overall' first with ordinal 0; areas are a short list by nature."""
    found = df.where(F.coalesce(F.col(column), F.lit("")) != "").select(F.col(column).alias("area")).distinct()
    ordered = found.select("area", F.row_number().over(Window.orderBy("area")).cast("bigint").alias("ord"))
    return df.sparkSession.createDataFrame([("overall", 0)], "area string, ord bigint").unionByName(ordered)


def highest_status(df: DataFrame, key: str, priority: dict[str, int], status: str = "status", default: int | None = None) -> DataFrame:
    """The status of highest priority for each key; an unknown status, or none, has the default priority. Without a default
    an unknown status is an error."""
    rank = F.create_map(*[x for k, v in priority.items() for x in (F.lit(k), F.lit(v))])
    own = F.try_element_at(rank, F.col(status))
    if default is not None:
        own = F.coalesce(own, F.lit(default))
    else:
        own = F.when(own.isNull() & F.col(status).isNotNull(), F.raise_error(F.concat(F.lit("no priority for "), F.col(status))).cast("int")).otherwise(own)
    return df.groupBy(key).agg(F.max_by(status, own).alias(status))


# --- reviews ----------------------------------------------------------------------------------------------------------------


def correlation(df: DataFrame, by: str, x: str, y: str) -> DataFrame:
    """Pearson correlation for each group, 0 where it is undefined."""
    n = F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1))
    g = df.groupBy(by).agg(F.covar_pop(x, y).alias("__c"), F.stddev_pop(x).alias("__x"), F.stddev_pop(y).alias("__y"), n.alias("n"))
    return g.select(by, "n", F.coalesce(F.try_divide(F.col("__c"), F.col("__x") * F.col("__y")), F.lit(0.0)).alias("corr"))


def extraction_quality(df: DataFrame, classes: dict[str, Column]) -> DataFrame:
    """Rows, and for each error class its count and share, one row a class; a fixed number of classes."""
    counts = df.agg(F.count("*").alias("rows"), *[F.sum(F.when(c, 1).otherwise(0)).alias(k) for k, c in classes.items()])
    flat = F.explode(F.array(*[F.struct(F.lit(k).alias("class"), F.col(k).cast("bigint").alias("n")) for k in classes]))
    return counts.select("rows", flat.alias("e")).select("e.class", "e.n", F.coalesce(F.try_divide(F.col("e.n").cast("double"), F.col("rows").cast("double")), F.lit(0.0)).alias("share"))


def token_usage(df: DataFrame, by: str = "file") -> DataFrame:
    """Sums of each usage key over all rows of a file."""
    return df.select(by, F.explode("usage").alias("key", "n")).groupBy(by, "key").agg(F.sum("n").alias("n"))


def compared_sums(hist: DataFrame, group: tuple[str, ...], over: str) -> DataFrame:
    """The smallest and the largest sum among the values of `over` in each group, and whether they are equal."""
    sums = hist.groupBy(*group, over).agg(F.sum("n").alias("s"))
    return sums.groupBy(*group).agg(F.min("s").alias("lo"), F.max("s").alias("hi")).withColumn("equal", F.col("lo") == F.col("hi"))


def unequal_sums(hist: DataFrame, group: tuple[str, ...], over: str) -> DataFrame:
    """Groups whose sums differ among the values of `over`: no rows if all is well."""
    return compared_sums(hist, group, over).where("not equal").drop("equal")
