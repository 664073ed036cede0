"""Landed source files: JSON payloads of the API and text members of the GTFS feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from headway.operators.cleaning import flatten_structs, nested_to_json
from headway.schemas import (
    ENDPOINT_LINEAGE,
    ENDPOINT_TABLES,
    FEED_COLUMNS,
    FILE_LINEAGE,
    PARTITION_COLUMN,
    feed_schema,
)
from headway.sources.quoted_text import read_quoted_records
from headway.sources.tables import entity_name, raw_path, replace_day


def read_json_payload(
    spark: SparkSession,
    path: str,
    endpoint: str,
    schema: StructType | None = None,
    shape: str = "records",
    multi_line: bool = True,
) -> DataFrame:
    """Rows of landed API answers, nested cells as JSON text, with the endpoint as lineage.

    shape: `records`, a list of row objects; `data`, an object whose `data` holds
    that list; `object`, one object that becomes one row with dotted columns.
    `schema` describes one row object; a field declared as text keeps a nested
    value as its JSON text. Without it Spark reads the files twice to infer one.
    multi_line: True where a file is one document. With False a file holds one
    document per line, and Spark splits large files over many tasks.
    A document that cannot be read whole, and one without `data` where that is its
    shape, stops the read: no row is lost or made up.
    """
    def scan(declared: StructType | None) -> DataFrame:
        return spark.read.json(path, schema=declared, multiLine=multi_line, mode="FAILFAST")

    if shape == "records":
        rows = scan(schema)
    elif shape == "data":
        wrapper = schema and StructType().add("data", ArrayType(schema))
        documents = scan(wrapper)
        if "data" not in documents.columns:
            raise ValueError(f"no document under {path} has `data`")
        absent = F.raise_error(F.lit(f"a document under {path} has no `data`"))
        listed = F.when(F.col("data").isNull(), absent).otherwise(F.col("data"))
        rows = documents.select(F.explode(listed).alias("row")).select("row.*")
    elif shape == "object":
        rows = flatten_structs(scan(schema))
    else:
        raise ValueError(f"unknown payload shape: {shape}")
    return nested_to_json(rows).withColumn(ENDPOINT_LINEAGE, F.lit(endpoint))


def read_gtfs_text(
    spark: SparkSession, path: str, schema: StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """Rows of a GTFS member (CSV with a header) with the file name as lineage.

    Quotes within quoted text are doubled, as the CSV standard has it. multi_line: quoted
    text may hold line breaks; the records are then put together from lines, by as many tasks as
    the files have ranges (the header is one line). A row with more or fewer fields than the
    header, such as a cut one, stops the read.

    Columns are matched by header name, whatever their order; one that the file
    lacks is NULL and one the schema lacks is left out. Without a schema every
    column is text. Files under one path must share their header: a different one
    stops the read instead of shifting columns.
    """
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST"}
    text = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .options(**options)
        # A row is judged by all its fields, whichever of them are read.
        .option("columnPruning", False)
        .csv(path)
    )
    file_name = F.col("_metadata.file_name")
    names = text.columns
    if multi_line:
        header = spark.read.option("lineSep", "\n").text(path).first()
        records = read_quoted_records(spark, path, header.value.removesuffix("\r") if header else "")
        plain = ", ".join(f"`{c}` string" for c in names)
        parsed = F.from_csv("record", F.lit(plain), options)
        text = records.select(parsed.alias("row"), "file_name").select("row.*", "file_name")
        file_name = F.col("file_name")
    fields = text.select(names).schema if schema is None else schema
    typed = [_typed(f, f.name in names).alias(f.name) for f in fields]
    return text.select(*typed, file_name.alias(FILE_LINEAGE))


def land(df: DataFrame, root: str, source: str, entity: str, day: str) -> str:
    """Write one extraction day (`yyyyMMdd`) of an entity to the raw layer; a re-run replaces it."""
    path = raw_path(root, source, entity)
    replace_day(df, path, day)
    return path


def landed_endpoints(spark: SparkSession, landing: str) -> list[str]:
    """Names of the landed API entities: every file or folder of the landing but the feed."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(landing)
    statuses = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = (status.getPath().getName() for status in statuses)
    return sorted(n for n in names if n != "gtfs" and not n.startswith(("_", ".")))


def land_endpoint(
    spark: SparkSession,
    landing: str,
    root: str,
    endpoint: str,
    day: str,
    shape: str = "records",
    multi_line: bool = True,
) -> str:
    """Landed JSON of one API endpoint to its raw table."""
    entity = entity_name(endpoint)
    schema = _declared(entity, "endpoint")
    rows = read_json_payload(spark, f"{landing}/{entity}", endpoint, schema, shape, multi_line)
    return land(rows, root, "endpoint", entity, day)


def gtfs_members(spark: SparkSession, landing: str) -> list[str]:
    """Names of the landed feed members, each `<name>.txt`, a file or a folder of files.

    Only paths are listed; the files are not opened.
    """
    paths = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(f"{landing}/gtfs")
        .select(F.regexp_extract("path", r"/gtfs/([^/]+)\.txt(/|$)", 1).alias("member"))
    )
    return sorted(r.member for r in paths.distinct().collect() if r.member)


def land_gtfs(
    spark: SparkSession,
    landing: str,
    root: str,
    member: str,
    day: str,
    multi_line: bool = False,
) -> str:
    """Landed text of one GTFS member to its raw table."""
    path = f"{landing}/gtfs/{member}.txt"
    rows = read_gtfs_text(spark, path, _declared(member, "gtfs"), multi_line)
    return land(rows, root, "gtfs", member, day)


def _declared(entity: str, source: str) -> StructType | None:
    """The declared columns of an entity from one source; None where only its file knows them."""
    for table in (f"{source}_{entity}", entity):
        if table in FEED_COLUMNS and (table in ENDPOINT_TABLES) == (source == "endpoint"):
            return feed_schema(table)
    return None


def _typed(field: StructField, present: bool) -> Column:
    if not present:
        return F.lit(None).cast(field.dataType)
    text = F.col(f"`{field.name}`")
    if isinstance(field.dataType, StringType):
        return text
    if isinstance(field.dataType, LongType):
        # An integer column with gaps is often printed as 5.0; 5.7 is no integer.
        number = text.try_cast("double")
        whole = F.when(number == F.floor(number), number.try_cast("bigint"))
        return F.coalesce(text.try_cast("bigint"), whole)
    return text.try_cast(field.dataType)
