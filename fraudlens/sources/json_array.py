"""JSON arrays of objects, written as files of bounded size and read by many tasks.

One array is one text without line ends to cut at.  It is read in pieces that end at a
closing brace, which the text source splits at any byte range.  Whether a brace lies
within a string, and how deep, follows from all that comes before; so each range is
summed up for either case of its beginning, the ranges' sums are chained, and then
every piece knows where it stands.  The running sums are windows over one byte range each, which
the split size bounds, and over the ranges of a file.  The numbered pieces are written once, as two
readers follow, and a lost executor reads them again.  Most objects are one piece and are parsed where they were
read; the pieces of objects with braces inside are put together by their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.session import scratch_dir

ROWS_PER_FILE = 50_000
_LEAD = r"^[\s,\[\x{FEFF}]*"    # what may stand between two objects of an array


def write_json_arrays(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> str:
    """Write ``df`` as files that hold one JSON array each, of about ``rows_per_file``
    objects; null fields are written."""
    n = df.count()
    files = max(1, -(-n // rows_per_file))
    dealt = df.select(F.struct(*df.columns).alias("row"), F.pmod(F.monotonically_increasing_id(), F.lit(files)).alias("file"))
    arrays = dealt.groupBy("file").agg(F.to_json(F.collect_list("row"), {"ignoreNullFields": "false"}).alias("value"))
    arrays.select("value").write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)
    return path


def _outside(text: Column, within: bool) -> Column:
    """What of ``text`` (without escapes) lies outside strings, if it begins within one or not."""
    return F.regexp_replace(F.regexp_replace(text, '^[^"]*("|$)', "") if within else text, '"[^"]*("|$)', "")


def _braces(text: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, "{", ""))).cast("long")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, block, at (the order within a block), value, flips (1: the number of quotes is odd)
    and the change of depth if the piece begins outside (d0) or within (d1) a string."""
    raw = spark.read.option("lineSep", "}").text(path)
    plain = F.regexp_replace("value", r"\\.", "")  # a backslash before the brace would be no JSON
    quotes = F.length("plain") - F.length(F.translate("plain", '"', ""))
    return (
        raw.select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
            "value",
            plain.alias("plain"),
        )
        .withColumn("flips", (quotes % 2).cast("long"))
        .withColumn("d0", _braces(_outside(F.col("plain"), False)) - (1 - F.col("flips")))
        .withColumn("d1", _braces(_outside(F.col("plain"), True)) - F.col("flips"))
        .drop("plain")
    )


def _numbered(pieces: DataFrame) -> DataFrame:
    """Pieces with the depth before and after (0 after: the brace that ends an object of
    the array) and the number of the object they belong to, by file."""
    before = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    turned = (F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2).alias("turned")
    local = pieces.select("*", turned).select(
        "file", "block", "at", "value", "flips", "turned",
        F.when(F.col("turned") == 0, F.col("d0")).otherwise(F.col("d1")).alias("c0"),
        F.when(F.col("turned") == 0, F.col("d1")).otherwise(F.col("d0")).alias("c1"),
    )
    local = local.withColumns({"s0": F.sum("c0").over(upto), "s1": F.sum("c1").over(upto)})

    blocks = local.groupBy("file", "block").agg(
        (F.sum("flips") % 2).alias("flips"), F.sum("c0").alias("c0"), F.sum("c1").alias("c1")
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # rows: blocks of a file
    begins = blocks.withColumn("within", F.coalesce(F.sum("flips").over(earlier), F.lit(0)) % 2)
    change = F.when(F.col("within") == 0, F.col("c0")).otherwise(F.col("c1"))
    begins = begins.withColumn("change", change).select(
        "file", "block", "within", F.coalesce(F.sum("change").over(earlier), F.lit(0)).alias("depth")
    )
    placed = local.join(begins, ["file", "block"])
    outside = F.col("within") == 0
    after = F.col("depth") + F.when(outside, F.col("s0")).otherwise(F.col("s1"))
    placed = placed.select(
        "file", "block", "at", "value",
        (after - F.when(outside, F.col("c0")).otherwise(F.col("c1"))).alias("depth_before"),
        after.alias("depth_after"),
        ((F.col("within") + F.col("turned")) % 2).alias("begins_within"),
        ((F.col("within") + F.col("turned") + F.col("flips")) % 2).alias("ends_within"),
    )
    closing = ((F.col("depth_after") == 0) & (F.col("ends_within") == 0)).cast("long")
    placed = placed.withColumn("closes", closing).withColumn("own", F.coalesce(F.sum("closes").over(before), F.lit(0)))
    closed = placed.groupBy("file", "block").agg(F.sum("closes").alias("closes"))
    first = closed.select("file", "block", F.coalesce(F.sum("closes").over(earlier), F.lit(0)).alias("first"))
    return placed.join(first, ["file", "block"]).withColumn("number", F.col("first") + F.col("own"))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The objects of every array below ``path`` (files of UTF-8 text, one array or object
    each), by ``schema``.

    An object that can't be parsed, and what a file that is cut short ends with, give a
    row of nulls, as Spark's own JSON reader does in its permissive mode.  A file without
    objects gives no row.
    """
    numbered = _numbered(_pieces(spark, path))
    stored = scratch_dir(spark, "json-pieces")
    numbered.write.parquet(stored)
    pieces = spark.read.schema(numbered.schema).parquet(stored)
    whole = (F.col("depth_before") == 0) & (F.col("begins_within") == 0) & (F.col("closes") == 1)
    single = pieces.where(whole).select(F.concat("value", F.lit("}")).alias("text"))
    parts = pieces.where(~whole).groupBy("file", "number").agg(
        F.sort_array(F.collect_list(F.struct("block", "at", "value", "closes"))).alias("parts")
    )
    ends = F.when(F.element_at("parts", -1)["closes"] == 1, F.lit("}")).otherwise(F.lit(""))
    several = parts.select(F.concat(F.array_join(F.col("parts.value"), "}"), ends).alias("text"))
    texts = single.unionByName(several).select(F.regexp_replace("text", _LEAD, "").alias("text"))
    objects = texts.where(~F.col("text").rlike(r"^[\s\]]*$"))
    return objects.select(F.from_json("text", schema).alias("o")).select("o.*")
