"""The bibliographic tables as views of the driver's tables, for Spark and, as common table expressions, for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATUSES = ["Poster", "Oral", "Reject"]


class Tables:
    """The Parquet tables of a folder and the views over them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def orders_status(self) -> DataFrame:
        status = F.when(F.col("o_orderstatus") == "F", "Reject").when(F.col("o_orderstatus") == "O", "Oral").otherwise("Poster")
        return self.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("row_ix"), "o_custkey", F.year("o_orderdate").cast("bigint").alias("year"), status.alias("status"), F.col("o_orderpriority").alias("primary_area"))

    def papers(self) -> DataFrame:
        people = self.customer.join(self.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        people = people.select("c_custkey", F.col("c_name").alias("author"), F.col("c_mktsegment").alias("position"), F.col("n_name").alias("aff"))
        return self.orders_status().join(people, F.col("o_custkey") == F.col("c_custkey"), "left").drop("o_custkey", "c_custkey")

    def reviews(self) -> DataFrame:
        return self.lineitem.select(F.col("l_orderkey").alias("id"), (F.col("l_quantity") / 5).alias("rating"), F.round(F.col("l_discount") * 100).cast("bigint").alias("confidence"), F.round(F.col("l_tax") * 100).cast("bigint").alias("correctness"), F.col("l_suppkey").alias("reviewer"))

    def scores(self, initial: bool = False) -> DataFrame:
        rows = self.lineitem.where("l_linestatus = 'O'") if initial else self.lineitem
        g = rows.groupBy(F.col("l_orderkey").alias("id")).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("s"), F.count("*").alias("n"))
        return g.select("id", "n", (F.col("s").cast("double") / (F.col("n") * 5)).alias("avg"))

    def scored_papers(self) -> DataFrame:
        return self.orders_status().join(self.scores(), "id").drop("o_custkey")

    def titles(self, parity: int) -> DataFrame:
        """Site (even ids) and platform (odd ids) papers: the first sentence as a title."""
        title = F.trim(F.regexp_replace(F.split_part(F.col("text"), F.lit("."), F.lit(1)), r"\s+", " "))
        return self.documents.where(F.col("doc_id") % 2 == parity).select(F.col("doc_id").alias("ix"), F.col("lang").alias("block"), title.alias("title"))

    def affiliation_lists(self) -> DataFrame:
        """Each paper's reviewers' nations, in order of a total order of its line items."""
        s = self.supplier.join(self.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), "s_name", F.col("n_name").alias("aff"))
        items = self.lineitem.select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey").join(s, "l_suppkey")
        g = items.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "aff", "s_name"))).alias("a"))
        p = self.orders_status()
        return p.join(g, F.col("id") == F.col("l_orderkey")).select("row_ix", "status", F.transform("a", lambda x: x["aff"]).alias("affs"), F.transform("a", lambda x: x["s_name"]).alias("names"), F.transform("a", lambda x: x["l_suppkey"].cast("string")).alias("ids"))


PAPERS = """papers AS (SELECT o_orderkey AS id, o_orderkey AS row_ix, year(o_orderdate) AS year, CASE o_orderstatus WHEN 'F' THEN 'Reject' WHEN 'O' THEN 'Oral' ELSE 'Poster' END AS status,
 o_orderpriority AS primary_area, c_name AS author, c_mktsegment AS position, n_name AS aff FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey)"""
SCORES = "scores AS (SELECT l_orderkey AS id, count(*) AS n, sum(l_quantity::BIGINT)::DOUBLE / (count(*) * 5) AS avg FROM lineitem GROUP BY 1)"
INITIAL = "initial AS (SELECT l_orderkey AS id, count(*) AS n, sum(l_quantity::BIGINT)::DOUBLE / (count(*) * 5) AS avg FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1)"
REVIEWS = "reviews AS (SELECT l_orderkey AS id, l_quantity / 5 AS rating, round(l_discount * 100)::BIGINT AS confidence, round(l_tax * 100)::BIGINT AS correctness, l_suppkey AS reviewer FROM lineitem)"
TITLES = r"""titles AS (SELECT doc_id AS ix, lang AS block, trim(regexp_replace(split_part(text, '.', 1), '\s+', ' ', 'g')) AS title FROM documents),
site AS (SELECT * FROM titles WHERE ix % 2 = 0), platform AS (SELECT * FROM titles WHERE ix % 2 = 1)"""
LISTS = """lists AS (SELECT l_orderkey AS row_ix, list(n_name ORDER BY l_linenumber, l_partkey, l_suppkey, n_name, s_name) AS affs, list(s_name ORDER BY l_linenumber, l_partkey, l_suppkey, n_name, s_name) AS names,
 list(l_suppkey::VARCHAR ORDER BY l_linenumber, l_partkey, l_suppkey, n_name, s_name) AS ids FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1)"""
