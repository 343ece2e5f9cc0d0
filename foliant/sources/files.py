"""File scans. Missing files give empty tables; schemas are given, never inferred, except for sheets of strings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from foliant.functions.arrays import integer_keys
from foliant.schema import strings
from foliant.storage import stored


def _or_empty(spark: SparkSession, schema: T.StructType, read) -> DataFrame:
    try:
        return read()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def paper_list(spark: SparkSession, path: str, schema: T.StructType, key: str | None = "id") -> DataFrame:
    """A JSON array of papers, sorted by the key; anything but a .json file is an empty list."""
    if ".json" not in path:
        return spark.createDataFrame([], schema)
    df = _or_empty(spark, schema, lambda: spark.read.schema(schema).option("multiLine", True).json(path))
    return df.orderBy(key) if key else df


def paper_tree(spark: SparkSession, root: str, schema: T.StructType, pattern: str = "*.json") -> DataFrame:
    """All lists under root/<conf>/, with the file's path and the conference that its folder names."""
    df = _or_empty(spark, T.StructType([*schema.fields, T.StructField("source_file", T.StringType()), T.StructField("folder", T.StringType())]), lambda: spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", pattern).option("recursiveFileLookup", True).json(root).withColumn("source_file", F.col("_metadata.file_path")).withColumn("folder", F.element_at(F.split("source_file", "/"), -2)))
    return df


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Results of batch jobs: one JSON a line; row_ix is the number that ends custom_id."""
    df = _or_empty(spark, schema, lambda: spark.read.schema(schema).json(path))
    return df.withColumn("row_ix", F.substring_index("custom_id", "-", -1).try_cast("bigint"))


def csv(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """A sheet of strings; blank cells are ''."""
    df = spark.read.option("header", header).option("multiLine", True).option("escape", '"').csv(path)
    return df.na.fill("")


def sheet(spark: SparkSession, path: str, content_start: int = 1) -> DataFrame:
    """A form's sheet whose first row names the columns, from its row `content_start` on, with row_ix.

    Rows are numbered from 0 without gaps: files in order of their names, rows in order within a file. A sheet of many files
    is numbered as one, each file counting its rows and then starting after those before it.
    """
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).na.fill("")
    # A file of quoted line breaks is not split, so its rows are in one task, in order.
    placed = raw.withColumns({"__file": F.col("_metadata.file_path"), "__at": F.monotonically_increasing_id()})
    placed = stored(placed, "sheet")
    sizes = placed.groupBy("__file").agg(F.count("*").alias("n"))  # a row a file
    before = Window.partitionBy(F.lit(1)).orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    own = F.row_number().over(Window.partitionBy("__file").orderBy("__at")) - 1
    numbered = placed.withColumn("row_ix", own.cast("bigint")).join(starts, "__file").withColumn("row_ix", F.col("row_ix") + F.col("__start"))
    return numbered.where(F.col("row_ix") >= content_start - 1).drop("__file", "__at", "__start")


def excel(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The first sheet of Excel files, trimmed, as the schema's strings. Needs a reader that pandas can import."""
    names = [f.name for f in schema.fields]

    def read(batches):
        import io

        import pandas as pd

        for b in batches:
            for content in b["content"]:
                sheet_ = pd.read_excel(io.BytesIO(content), dtype=str).fillna("")
                sheet_.columns = [str(c).strip() for c in sheet_.columns]
                yield sheet_.reindex(columns=names, fill_value="").apply(lambda c: c.str.strip())

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(read, schema)


def json_map(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object as one map<int,string> of its numbered entries."""
    text = spark.read.option("wholetext", True).text(path)
    return text.select(integer_keys(F.from_json("value", "map<string,string>")).alias("entries"))


def settings(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """A venue's settings file (year -> source -> options) as dimension tables.

    dim_track (year, source, track), dim_tier (.., raw, name, ord), dim_review (.., key, label, ord), dim_area (.., area,
    ord) and dim_score (.., label, score).
    """
    text = spark.read.option("wholetext", True).text(path)
    years = text.select(F.explode(F.from_json("value", "map<string,map<string,string>>")).alias("year", "sources")).select("year", F.explode("sources").alias("source", "options"))
    base = [F.col("year").cast("int").alias("year"), "source"]

    def tracks(option: str) -> DataFrame:
        # An option is one map, or one map for each track.
        m = years.select(*base, F.get_json_object("options", f"$.{option}").alias("v")).where("v is not null")
        nested = F.from_json("v", "map<string,string>")
        return m.select("year", "source", F.explode(nested).alias("track", "v"))

    def flat(option: str, key: str, value: str) -> DataFrame:
        own = tracks(option)
        inner = own.where(F.startswith("v", F.lit("{"))).select("year", "source", "track", F.posexplode(F.map_entries(F.from_json("v", "map<string,string>"))).alias("ord", "e"))
        outer = own.where(~F.startswith("v", F.lit("{"))).select("year", "source", F.lit("main").alias("track"), F.lit(0).alias("ord"), F.struct(F.col("track").alias("key"), F.col("v").alias("value")).alias("e"))
        return inner.unionByName(outer).select("year", "source", "track", F.col("e.key").alias(key), F.col("e.value").alias(value), "ord")

    areas = tracks("aname").where(F.startswith("v", F.lit("["))).select("year", "source", "track", F.posexplode(F.from_json("v", "array<string>")).alias("ord", "area"))
    listed = years.select(*base, F.explode(F.from_json(F.get_json_object("options", "$.track"), "map<string,string>")).alias("track", "value"))
    return {"dim_track": listed, "dim_tier": flat("tname", "raw", "name"), "dim_review": flat("rname", "key", "label"), "dim_area": areas, "dim_score": flat("rmap", "label", "score")}


def atom_entries(spark: SparkSession, path: str) -> DataFrame:
    """id and title of the entries of Atom files."""
    schema = strings("id", "title")
    return _or_empty(spark, schema, lambda: spark.read.format("xml").option("rowTag", "entry").schema(schema).load(path)).select("id", F.trim(F.regexp_replace("title", r"\s+", " ")).alias("title"))


def pdf_pages(spark: SparkSession, path: str) -> DataFrame:
    """path, author and text of the first pages of PDF files; text of uncompressed and Flate streams, without layout."""

    def read(batches):
        import pandas as pd

        from foliant.sources.pdf import first_page

        for b in batches:
            found = [first_page(c) for c in b["content"]]
            yield pd.DataFrame({"path": b["path"], "author": [a for a, _ in found], "text": [t for _, t in found]})

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path).select("path", "content").mapInPandas(read, "path string, author string, text string")
