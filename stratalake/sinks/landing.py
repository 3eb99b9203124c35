"""The landing sink: one CSV directory per table."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.names import column
from stratalake.functions.text import as_text
from stratalake.operators.audit import observed_counts
from stratalake.sources.files import CSV_OPTIONS
from stratalake.sources.listing import files, move, remove

# A landing file is read back by one task, so the bytes of a file bound the work of a task: about so many, for rows
# as wide as the ones looked at.
FILE_BYTES = 64 * 1024 * 1024
ROWS_PER_FILE = 250_000
ROWS_LOOKED_AT = 1_000

# Further options of codecs. Gzip's usual level takes twice the time of this one and saves 6 % of the bytes.
CODEC_OPTIONS = {"gzip": {"zlib.compress.level": "FOUR"}}


def rows_for(df: DataFrame, file_bytes: int = FILE_BYTES) -> int:
    """Rows for a file of about ``file_bytes``, and ``ROWS_PER_FILE`` at most.

    The width is that of some rows, ``ROWS_LOOKED_AT`` of them. It only decides how rows are dealt out to files.
    """
    text = df.limit(ROWS_LOOKED_AT).transform(as_text)
    widths = [F.coalesce(F.octet_length(column(name)), F.lit(0)) + 3 for name in text.columns]
    width = text.select(sum(widths[1:], widths[0]).alias("width")).agg(F.avg("width")).first()[0]
    return max(1, min(ROWS_PER_FILE, int(file_bytes / width))) if width else ROWS_PER_FILE


def write_landing(
    df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, file_bytes: int = FILE_BYTES, codec: str | None = None
) -> None:
    """Replaces ``path`` by the rows of ``df`` as quoted CSV with a header; nulls and empty text are empty fields.

    A file has at most ``rows_per_file`` rows and, whatever their widths, at most about twice ``file_bytes``, or one row: files that
    came out larger, as rows grew wider than the ones that ``rows_per_file`` was judged by, are dealt out anew. ``codec`` compresses
    the files; the bytes are those of the text all the same, since that is what a task has to read.
    """
    if not df.columns:
        # CSV has no form for rows without columns; an empty line is what such a table looks like.
        df.sparkSession.createDataFrame([("",)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return
    text = df.transform(as_text)
    if codec is None:
        _write_csv(text, path, rows_per_file, codec)
    else:
        longest = Observation()
        _write_csv(text.observe(longest, F.max(_most_bytes(text)).alias("n")), path, rows_per_file, codec)
        n = observed_counts(longest, lambda: df.sparkSession.createDataFrame([(None,)], "n bigint"))["n"]
        if n is not None and n * rows_per_file <= 2 * file_bytes:
            return  # no file can be too large, so none need be looked through
    _bound_files(df.sparkSession, path, rows_per_file, file_bytes, codec)


def _most_bytes(text: DataFrame) -> Column:
    """The most bytes a row can take as a line: all of its letters doubled quotes."""
    widths = [2 * F.coalesce(F.octet_length(column(name)), F.lit(0)).cast("long") + 3 for name in text.columns]
    return sum(widths[1:], widths[0])


def _larger_files(spark: SparkSession, path: str, most: int, codec: str | None) -> dict[str, int]:
    """Bytes of text of each file that has more than ``most``; those of compressed files are counted by a pass over them."""
    if codec is None:
        return {name: size for name, size in files(spark, path).items() if size > most}
    # lines without their ends, which are counted as one byte each
    lines = spark.read.text(path, lineSep="\n").select(F.col("_metadata.file_path").alias("file"), (F.octet_length("value") + 1).alias("n"))
    sizes = lines.groupBy("file").agg(F.sum("n").alias("n")).where(F.col("n") > most).collect()
    return {row["file"].rpartition("/")[2]: row["n"] for row in sorted(sizes)}


def _bound_files(spark: SparkSession, path: str, rows_per_file: int, file_bytes: int, codec: str | None) -> None:
    """Writes files of more than twice the goal again with fewer rows each, until none is left or each has one row.

    Only those files are read, each by one task, which writes its rows in order. A file's new parts take its place after they are whole.
    """
    while rows_per_file > 1:
        large = _larger_files(spark, path, 2 * file_bytes, codec)
        if not large:
            return
        rows_per_file = max(1, int(rows_per_file * file_bytes / max(large.values())))
        apart = f"{path}/_apart-{uuid.uuid4().hex[:12]}"
        columns = spark.read.options(**CSV_OPTIONS).option("multiLine", "true").csv(f"{path}/{next(iter(large))}").schema
        again = spark.read.options(**CSV_OPTIONS).option("multiLine", "true").schema(columns)
        # one job for each file: two small ones would share a task, and their rows a file
        for at, name in enumerate(large):
            _write_csv(again.csv(f"{path}/{name}"), f"{apart}/{at}", rows_per_file, codec)
        for at, name in enumerate(large):
            for part in files(spark, f"{apart}/{at}"):
                move(spark, f"{apart}/{at}/{part}", f"{path}/{part}")
            remove(spark, f"{path}/{name}")
        remove(spark, apart)


def _write_csv(text: DataFrame, path: str, rows_per_file: int, codec: str | None) -> None:
    if len(text.columns) == 1:
        # A lone null would be a blank line, which readers skip; quoted empty text is read back as null.
        text = text.na.fill("")
    (
        text.write.mode("overwrite")
        .options(**CSV_OPTIONS, **({} if codec is None else {"compression": codec, **CODEC_OPTIONS.get(codec, {})}))
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )
