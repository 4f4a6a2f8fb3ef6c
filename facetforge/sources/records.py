"""Scans of the files that jobs leave: records line by line, whole files of lists, maps and results, folders of pairs, and
job specifications. Readers take Spark paths and schemas; no file is opened by the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lines(spark: SparkSession, path: str | list[str], schema: str | T.StructType) -> DataFrame:
    """A record a line; a line that isn't one is a row of nulls."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def listed(spark: SparkSession, path: str | list[str], schema: str | T.StructType) -> DataFrame:
    """The elements of files that hold one list each."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def upto(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """The rows (file, block, at) with the sum of `value` over all rows of the file before them: over the blocks, of which a
    file has few, and inside each block."""
    rows = rows.withColumn("_v", value)
    sums = rows.groupBy("file", "block").agg(F.sum("_v").alias("_s"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("file", "block", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_b"))
    inside = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    own = rows.withColumn("_i", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
    return own.join(sums, ["file", "block"]).withColumn(name, F.col("_b") + F.col("_i")).drop("_v", "_b", "_i")


def mapped(spark: SparkSession, path: str | list[str], value: str = "string") -> DataFrame:
    """key, value of files that hold one map each; of a repeated key the last.

    A map may be of any size: Spark splits files at commas, into blocks that are read by tasks of their own. How many quotes
    came before a piece says whether it starts inside a string, how many brackets were opened and not closed outside of
    strings how deep it is; the commas of the map itself, outside of strings and one deep, end its entries.
    """
    pieces = spark.read.option("lineSep", ",").text(path).select("_metadata.file_path", "_metadata.file_block_start", "value")
    pieces = pieces.toDF("file", "block", "text").withColumn("at", F.monotonically_increasing_id())
    bare = F.regexp_replace("text", r"(?s)\\.", "")  # without what a backslash takes its meaning
    quotes = F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))
    rows = upto(pieces.withColumns({"bare": bare, "quotes": quotes}), F.col("quotes"), "odd")
    within = F.col("odd") % 2 == 1
    plain = F.regexp_replace(F.concat(F.when(within, '"').otherwise(""), "bare"), r'(?s)"[^"]*("|$)', "")
    many = lambda signs: F.length(plain) - F.length(F.translate(plain, signs, ""))
    rows = upto(rows.withColumn("step", many("{[") - many("}]")), F.col("step"), "deep")
    ends = ((F.col("odd") + F.col("quotes")) % 2 == 0) & (F.col("deep") + F.col("step") == 1)
    rows = upto(rows.select("file", "block", "at", "text", ends.alias("ends")), F.col("ends").cast("long"), "entry")
    entries = rows.groupBy("file", "entry").agg(F.array_sort(F.collect_list(F.struct("block", "at", "text"))).alias("p"))
    last = rows.groupBy("file").agg(F.max("entry").alias("last"))
    whole = entries.select("file", "entry", F.array_join("p.text", ",").alias("t")).join(last, "file")
    opened = F.when(F.col("entry") == 0, F.regexp_replace("t", r"(?s)^\s*\{", "")).otherwise(F.col("t"))
    closed = F.when(F.col("entry") == F.col("last"), F.regexp_replace(opened, r"(?s)\}\s*$", "")).otherwise(opened)
    found = whole.select("file", "entry", F.explode(F.from_json(F.concat(F.lit("{"), closed, F.lit("}")), f"map<string,{value}>")).alias("key", "value"))
    return found.groupBy("file", "key").agg(F.max_by("value", "entry").alias("value")).select("key", "value")


def results(spark: SparkSession, path: str | list[str], record: str, key: str) -> DataFrame:
    """The records under `results` of each file; of those with one key the last, as they stand."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", f"results array<struct<{record}>>").results.alias("r"), F.input_file_name().alias("file"))
    rows = whole.select("file", F.posexplode("r").alias("pos", "r"))
    last = rows.groupBy(F.col("r").getField(key).alias("k")).agg(F.max_by("r", F.struct("file", "pos")).alias("r"))
    return last.select("r.*")


def nth_from_end(path: Column, n: int) -> Column:
    """The n-th part of a path from its end, from 1; null if there are fewer."""
    return F.try_element_at(F.split(path, "/"), F.lit(-n))


def pairs(spark: SparkSession, root: str, schema: str | T.StructType, name: str = "meta.json") -> DataFrame:
    """A record for each folder of pairs, <root>/<task>/<name>/meta.json: path, task, name, and the record's columns, which
    are null where it can't be read."""
    rows = spark.read.schema(schema).option("multiLine", True).json(f"{root}/*/*/{name}").select("_metadata.file_path", "*")
    return catalog(rows, F.col("file_path")).drop("file_path")


def catalog(rows: DataFrame, path: Column) -> DataFrame:
    """The rows with path, task and name, read from the end of the path."""
    return rows.withColumns({"path": path, "task": nth_from_end(path, 3), "name": nth_from_end(path, 2)})


def by_pattern(paths: DataFrame, path: str, patterns: list[str]) -> DataFrame:
    """The rows with `pattern`, the first of the patterns that the path ends as; those of no pattern go. Ordered by pattern
    and path, they stand as if each pattern were listed by itself."""
    which = F.coalesce(*(F.when(F.col(path).rlike(p), F.lit(i)) for i, p in enumerate(patterns)))
    return paths.withColumn("pattern", which).where("pattern is not null")


def jobs(specs: DataFrame, spec: str = "spec") -> DataFrame:
    """source and target of specifications written as source:target; those without a colon have no target."""
    parts = F.split(spec, ":", 2)
    return specs.select(F.get(parts, 0).alias("source"), F.get(parts, 1).alias("target"))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark's file systems know the path; a pattern exists if anything matches it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def optional(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The records of a file that may be missing: then none, of the same schema."""
    if exists(spark, path):
        return lines(spark, path, schema)
    return spark.createDataFrame([], schema)


def versioned(spark: SparkSession, newer: str, older: str, schema: str | T.StructType) -> DataFrame:
    """The newer files if there are any, else the older ones; `version` says which."""
    new = exists(spark, newer)
    return listed(spark, newer if new else older, schema).withColumn("version", F.lit("new" if new else "old"))
