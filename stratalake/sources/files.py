"""Readers for landing CSV, layer tables, text lines and directories of table files."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.sources.boundaries import BLOCK_BYTES, csv_records
from stratalake.sources.listing import largest_file, names_with_suffix, recover

# Quotes inside a value are doubled, and a quoted value may hold line breaks.
CSV_OPTIONS = {"header": "true", "escape": '"', "charToEscapeQuoteEscaping": '"'}


# From this size on it pays to look whether a landing file can be read by several tasks.
LARGE_FILE = 256 * 1024 * 1024


class HeadersDiffer(ValueError):
    """The files of a landing table do not have one header."""


def read_landing(spark: SparkSession, path: str, large_file: int = LARGE_FILE) -> DataFrame:
    """A landing CSV, file or directory, with every column as string.

    A file whose values may hold line breaks cannot be cut at arbitrary bytes, so each file is one task; the
    landing sink bounds the bytes of a file to keep such tasks even. Where another program left a large file, its
    lines are looked through first, in parallel: if every line is surely a record, the file is read in pieces; if the
    quotes show where each record ends, it is cut there (``read_records``). Both give the same rows as one task. Columns go
    by place, so files with another header than the first one stop the read.
    """
    large = largest_file(spark, path) >= large_file
    in_pieces = large and lines_are_records(spark, path)
    if large and not in_pieces and (cut := read_records(spark, path)) is not None:
        return cut
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", str(not in_pieces))
    rows = reader.csv(path)
    # A name that ends with its place may stand for an empty or repeated one, and is then not what the file says.
    if any(name.endswith(str(place)) for place, name in enumerate(rows.columns)):
        if not headers_agree(spark, path):
            raise HeadersDiffer(f"the files of {path} have different headers")
        return rows
    # The reader itself compares each file's header with the schema.
    return reader.option("enforceSchema", "false").schema(rows.schema).csv(path) if rows.columns else rows


def read_records(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame | None:
    """The rows of CSV files whose values hold line breaks, each file read by many tasks; None where its quotes leave a doubt."""
    records = csv_records(spark, path, block_bytes)
    names = spark.read.options(**CSV_OPTIONS).option("multiLine", "true").csv(path).columns
    if records is None or not names:
        return None
    schema = ", ".join(f"c{place} string" for place in range(len(names)))
    options = {**CSV_OPTIONS, "multiLine": "true"}
    parsed = records.select(((F.col("block") == 0) & (F.col("place") == 0)).alias("head"), F.from_csv("value", schema, options).alias("row"))
    if parsed.where("head").select("row").distinct().limit(2).count() > 1:
        raise HeadersDiffer(f"the files of {path} have different headers")
    return parsed.where("not head").select("row.*").toDF(*names)


def headers_agree(spark: SparkSession, path: str) -> bool:
    """Whether the first records of all files are equal; a pass over the files that leaves one record for each."""
    records = spark.read.options(**CSV_OPTIONS).option("header", "false").option("multiLine", "true").csv(path)
    if not records.columns:
        return True
    placed = records.select(
        F.struct(*(f"`{name}`" for name in records.columns)).alias("record"),
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("place"),
    )
    heads = placed.groupBy("file").agg(F.min_by("record", "place").alias("head"))
    return heads.select("head").distinct().limit(2).count() <= 1


# A line that is a record whichever way the file is read. Its fields have no quotes, or are quoted from
# first to last character with doubled quotes inside; no carriage return, no comment, not only white space. Possessive
# quantifiers take no stack, however long the line.
RECORD_LINE = (
    r'^(?![\x00-\x20]+\z)(?!\x00)(?:"(?:[^"\r]|"")*+"|[^",\r\uFEFF]*+)(?:,(?:"(?:[^"\r]|"")*+"|[^",\r]*+))*+\z'
)


def lines_are_records(spark: SparkSession, path: str) -> bool:
    """Whether reading the file line by line is sure to give the same rows as reading it whole."""
    return spark.read.text(path, lineSep="\n").filter(~F.col("value").rlike(RECORD_LINE)).isEmpty()


def read_table(spark: SparkSession, path: str, table_format: str = "parquet") -> DataFrame:
    """A bronze or silver table by its path; one that was left half replaced comes back first (``recover``)."""
    if table_format != "delta":
        recover(spark, path)
    return spark.read.format(table_format).load(path)


def read_lines(spark: SparkSession, pattern: str) -> DataFrame:
    """The lines of all files that match a path or glob, in a column ``value``."""
    return spark.read.text(pattern)


@dataclass(frozen=True)
class TableDirectory:
    """A source of tables that lie as ``{table}{suffix}`` entries in one directory."""

    root: str
    table_format: str = "parquet"
    suffix: str = ".parquet"
    options: dict[str, str] = field(default_factory=dict)

    def tables(self, spark: SparkSession) -> list[str]:
        return names_with_suffix(spark, self.root, self.suffix)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        path = f"{self.root.rstrip('/')}/{table}{self.suffix}"
        return spark.read.format(self.table_format).options(**self.options).load(path)

    def probe(self, spark: SparkSession) -> DataFrame:
        """One row ``ok = 1`` if the first line of any file can be read."""
        return probe_lines(spark, f"{self.root.rstrip('/')}/*")


def probe_lines(spark: SparkSession, pattern: str) -> DataFrame:
    """One row ``ok = 1`` if a line can be read; raises, or stays empty, otherwise."""
    return read_lines(spark, pattern).limit(1).selectExpr("1 AS ok")
