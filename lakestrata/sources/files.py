"""CSV feeds: positional text columns, file and row lineage, bad rows kept apart."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.config import Entity
from lakestrata.operators.keys import ROW_BITS, long_array
from lakestrata.session import materialize

BAD = "_bad"

# The feed format.  A quote inside a quoted field is doubled.
FORMAT = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "lineSep": "\n",
    "mode": "PERMISSIVE",
    "enforceSchema": "true",
    "columnNameOfCorruptRecord": BAD,
}


def feed_schema(entity: Entity) -> T.StructType:
    return T.StructType([*entity.text_schema.fields, T.StructField(BAD, T.StringType())])


def _name(encoded: Column) -> Column:
    """File names come URL-encoded; a plus sign is a plus sign."""
    return F.try_url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def file_name(path: Column, home: str | None = None) -> Column:
    """A file's path below the folder ``home``; its bare name if it is not there."""
    bare = F.element_at(F.split(path, "/"), -1)
    if home is None:
        return bare
    folder = urlsplit(home).path.rstrip("/") + "/"
    place = F.locate(folder, path)
    return F.when(place > 0, F.substr(path, place + F.lit(len(folder)))).otherwise(bare)


def _with_origin(df: DataFrame, entity: Entity, home: str | None) -> DataFrame:
    return df.select(
        *entity.columns,
        BAD,
        file_name(_name(F.col("_metadata.file_path")), home).alias("_source_file"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def read_feed(
    spark: SparkSession,
    path: str | list[str],
    entity: Entity,
    home: str | None = None,
    **options: str,
) -> DataFrame:
    """All rows of the files under ``path`` with their origin, before numbering.  Files are told
    by their path below ``home``, or by their bare name."""
    reader = spark.read.schema(feed_schema(entity)).options(**{**FORMAT, **options})
    return _with_origin(reader.csv(path), entity, home)


def number_file_rows(rows: DataFrame) -> DataFrame:
    """Add ``_file_row_number``, from 1 in file order, the header not counted.

    Must see the scan's rows before any filter or shuffle.  A split's rows are
    consecutive in one task, so a row's number is the rows in the file's earlier
    splits plus its place in its split: no window over the rows of a file, which
    would put one large file into one task.

    Rows are written once with their place, and stay where they are: one count per split
    reaches the driver (as the list of splits itself did when the scan was planned), and what to
    add goes back as arrays by partition.  A partition may hold several splits, found by place.
    """
    placed = materialize(rows.withColumn("_place", F.monotonically_increasing_id()))
    splits = (
        placed.groupBy("_path", "_block")
        .agg(F.min("_place").alias("first"), F.count(F.lit(1)).alias("n"))
        .collect()
    )
    shifts, path, earlier = {}, None, 0
    for s in sorted(splits, key=lambda s: (s["_path"], s["_block"])):
        earlier = earlier if s["_path"] == path else 0
        path = s["_path"]
        shifts[s["first"]] = earlier - s["first"]
        earlier += s["n"]
    firsts = sorted(shifts)
    parts = (firsts[-1] >> ROW_BITS) + 1 if firsts else 1
    begin = [bisect_left(firsts, p << ROW_BITS) for p in range(parts + 1)]

    part = F.shiftright("_place", ROW_BITS).cast("int")
    at = F.get(long_array(begin), part).cast("int")
    end = F.get(long_array(begin), part + 1).cast("int")
    own = F.slice(long_array(firsts), at + 1, end - at)
    nth = F.size(F.filter(own, lambda first: first <= F.col("_place")))
    return placed.withColumn(
        "_file_row_number", F.get(long_array(shifts[f] for f in firsts), at + nth - 1) + F.col("_place") + 1
    ).drop("_path", "_block", "_place")


def preview(spark: SparkSession, path: str, entity: Entity, n: int = 5) -> DataFrame:
    """First rows of a feed, as text."""
    return read_feed(spark, path, entity).select(*entity.columns).limit(n)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Files under a folder; their content is not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.select("path", F.col("modificationTime").alias("modified"), "length")


def snapshots(listed: Iterable[Row], folder: str) -> list[list[Row]]:
    """Listed files as snapshots: a file in ``folder``, or all files of a folder in it.

    In the order of their last change, then by name.
    """
    home = urlsplit(folder).path.rstrip("/") + "/"
    found: dict[str, list[Row]] = {}
    for row in listed:
        entry = row["path"].split(home, 1)[-1].split("/")[0]
        found.setdefault(entry, []).append(row)
    order = sorted(found.items(), key=lambda e: (max(r["modified"] for r in e[1]), e[0]))
    return [rows for _, rows in order]


def write_feed(df: DataFrame, path: str, entity: Entity) -> None:
    """Write text rows in the feed format (fixtures, exports)."""
    (
        df.select(*entity.columns)
        .write.option("header", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )
