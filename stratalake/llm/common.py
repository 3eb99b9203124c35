"""What several operators share: reading, ASCII text rules, scratch tables, places in a total order."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.checks.workspace import new_folder
from stratalake.sources.listing import remove

#: The white space of all contracts: space and U+0009 to U+000D.
WHITE = " \t\n\x0b\x0c\r"
SPACED_WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case and nothing else; pure ASCII text takes the short way."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once for each row, also where lambdas inside the body use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scratch(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared folder and read again: computed once, and safe from lost executors."""
    path = f"{new_folder(df.sparkSession, purpose)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, most: int) -> Iterator[None]:
    """Jobs begun inside send Python functions Arrow batches of about so many bytes, or of one row that is wider.

    By default a batch is bounded by its number of rows, so that its memory, in the executor and in its Python worker, grows with the
    rows' width. The session's own bound comes back at the end, and is kept throughout where it is lower.
    """
    own = spark.conf.get(BATCH_BYTES)
    reader = spark._jvm.org.apache.spark.network.util.JavaUtils
    if 0 < reader.byteStringAsBytes(own) <= most:
        yield
        return
    spark.conf.set(BATCH_BYTES, str(most))
    try:
        yield
    finally:
        spark.conf.set(BATCH_BYTES, own)


def discard(*tables: DataFrame) -> None:
    """Removes the files of scratch tables that nothing will read any more."""
    for df in tables:
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            remove(df.sparkSession, folder)


def numbered(df: DataFrame, order: Sequence[Column], purpose: str, name: str = "place") -> DataFrame:
    """Adds each row's place (from 1) in the order, without one task that sees all rows.

    The rows are dealt out by ranges of the order and written with the number of their range, which then is fixed;
    a range's first place follows from the sizes of the ranges before it (one row for each range).
    """
    dealt = scratch(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), purpose)
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")
    starts = sizes.select("_part", before.alias("_before"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        dealt.join(F.broadcast(starts), "_part")
        .withColumn(name, (F.col("_before") + within).cast("long"))
        .drop("_part", "_before")
    )
