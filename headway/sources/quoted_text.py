"""Records of CSV text whose quoted fields may hold line breaks, read by many tasks per file.

A file is read in byte ranges, line by line. Whether a line begins inside a quoted field depends on the
number of quotes before it, of which only the parity counts: each range reports its own, and the
parities of the ranges before it, added up, tell how a range begins. Ranges are few, so that sum is taken
over a small table. A line with an even number of quotes that begins outside of quotes is a record by
itself, and stays where it was read. Only the lines of the other records are shuffled, to be joined
again; a record may span any number of ranges. Ranges without a line break in quotes are not shuffled
at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

QUOTE = '"'


def read_quoted_records(spark: SparkSession, path: str, header: str) -> DataFrame:
    """(record, file_name): the records of all files under `path`, without the header that each begins with.

    Lines end in LF or CRLF; within quotes either counts as LF. Blank lines between records are left out.
    A file that does not begin with `header` stops the read, and so does one that ends within quotes.
    """
    value = F.regexp_replace("value", r"\r$", "")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        value.alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("range"),
        # In the order of the lines of a range, which one task reads.
        F.monotonically_increasing_id().alias("line"),
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    lines = lines.withColumn("odd", (quotes % 2).cast("int"))

    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    found = lines.groupBy("file", "range").agg(
        F.sum("odd").alias("odds"), F.min("line").alias("first"), F.max("line").alias("last")
    )
    # A row per range of a file.
    begins = F.coalesce(F.sum("odds").over(before), F.lit(0)) % 2
    is_last = F.lead(F.lit(1)).over(Window.partitionBy("file").orderBy("range")).isNull()
    ranges = found.withColumn("inside", begins.cast("int")).withColumn(
        "cut", is_last & ((F.col("inside") + F.col("odds")) % 2 == 1)
    )
    ranges = ranges.withColumn("whole", (F.col("odds") == 0) & (F.col("inside") == 0)).withColumn(
        "opening", F.when(F.col("range") == 0, F.col("first"))
    )
    placed = lines.join(ranges.select("file", "range", "inside", "whole", "opening", "cut"), ["file", "range"])
    # Every file's header: checked, then left out.
    is_header = F.col("line").eqNullSafe(F.col("opening"))
    told = F.when(
        is_header & (F.col("value") != header),
        F.raise_error(F.concat(F.lit("another header than expected in "), F.col("file"), F.lit(": "), F.col("value"))),
    ).when(F.col("cut"), F.raise_error(F.concat(F.lit("MALFORMED: quotes left open in "), F.col("file"))))
    placed = placed.withColumn("value", F.coalesce(told, F.col("value")))

    single = placed.where(F.col("whole") & ~is_header & (F.col("value") != "")).select(
        F.col("value").alias("record"), "file_name"
    )
    return single.unionByName(_assembled(placed.where(~F.col("whole"))))


def _assembled(lines: DataFrame) -> DataFrame:
    """Records of ranges with a line break in quotes, or that begin within quotes."""
    so_far = Window.partitionBy("file", "range").orderBy("line")
    earlier = F.coalesce(F.sum("odd").over(so_far.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begun = lines.withColumn("within", ((F.col("inside") + earlier) % 2) == 1)
    number = F.sum(F.when(~F.col("within"), 1).otherwise(0)).over(
        so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    begun = begun.withColumn("number", number)
    is_header = F.col("line").eqNullSafe(F.col("opening"))
    alone = begun.where(~F.col("within") & (F.col("odd") == 0) & ~is_header & (F.col("value") != ""))

    parts = begun.where(F.col("within") | (F.col("odd") == 1)).withColumn(
        "home", F.when(F.col("number") > 0, F.struct("range", "number"))
    )
    # Lines before the first record of a range go on with the last one that an earlier range began.
    last = parts.groupBy("file", "range").agg(F.max("home").alias("begun"))
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    last = last.withColumn("open", F.last("begun", ignorenulls=True).over(before)).select("file", "range", "open")
    joined = parts.join(last, ["file", "range"]).withColumn("home", F.coalesce("home", "open"))
    records = joined.groupBy("file", "file_name", "home").agg(
        F.array_sort(F.collect_list(F.struct("range", "line", "value"))).alias("lines")
    )
    text = F.array_join(F.transform("lines", lambda x: x["value"]), "\n")
    return alone.select(F.col("value").alias("record"), "file_name").unionByName(
        records.select(text.alias("record"), "file_name")
    )
