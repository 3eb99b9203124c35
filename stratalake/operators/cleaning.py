"""Cleaning steps: each takes a DataFrame and returns one, and none of them runs a job.

Use them with ``df.transform(step, ...)``. ``clean`` chains them in the order silver tables are defined by;
that order matters, since duplicates are compared before text is upper-cased.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.names import column, columns, is_case_sensitive, repeated, unused

# Metadata columns of bronze and silver tables.
INGESTION_STAMP = "_ingestion_timestamp"
SILVER_STAMP = "_silver_ingestion_timestamp"
PROVENANCE = "_source_table"

# The column names that silver spells out.
RENAME_MAP = {
    "CD": "CODIGO",
    "TP": "TIPO",
    "DT": "DATA",
    "NM": "NOME",
    "DS": "DESCRICAO",
}


def dedupe_rows(df: DataFrame) -> DataFrame:
    """One of each set of equal rows; nulls count as equal."""
    return df.dropDuplicates()


def fingerprint(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes that equal rows share, by the rule of ``dedupe_rows``: nulls are equal, as are 0.0 and -0.0."""

    def plain(f: T.StructField) -> Column:
        value = column(f.name)
        return F.when(value == 0, F.lit(0).cast(f.dataType)).otherwise(value) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else value

    values = [plain(f) for f in df.schema.fields]
    values += [column(f.name).isNull() for f in df.schema.fields if f.nullable]  # a hash passes over nulls
    return [F.xxhash64(*values), F.xxhash64(F.lit("row"), *values)]


def _has_nested_floats(kind: T.DataType, top: bool = True) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_nested_floats(f.dataType, False) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_nested_floats(kind.elementType, False)
    return not top and isinstance(kind, (T.DoubleType, T.FloatType))


#: Bits of the map that tells which fingerprints occur again: 8 MB at any size of table.
MAP_BITS = 1 << 26


def mark_repeated(
    df: DataFrame, name: str, hashes: Callable[[DataFrame], list[Column]] = fingerprint, map_bits: int = MAP_BITS
) -> DataFrame:
    """Adds whether a row may occur again: true for all that do, and for few others.

    Only the first of a row's hashes is shuffled and counted. Rows that share its 64 bits by chance, about three pairs among 10^10
    rows, are marked without need. The places of those that occur again go into a bitmap of fixed size, which every
    task gets; the fuller it is, the more rows are marked without need.
    """
    first = hashes(df)[0]
    place = (F.pmod(F.col("h1"), F.lit(map_bits)) + 1).alias("place")
    again = df.select(first.alias("h1")).groupBy("h1").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bits = (
        again.select(place)
        .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    )
    bucket, bitmap, at = (unused(df, n) for n in ("__bucket", "__bits", "__place"))
    placed = df.withColumn(at, F.pmod(first, F.lit(map_bits)) + 1)
    spot = F.bitmap_bit_position(column(at))
    octet = F.substring(column(bitmap), (F.floor(spot / 8) + 1).cast("int"), F.lit(1))
    mask = F.element_at(F.array(*(F.lit(1 << k) for k in range(8))), (spot % 8 + 1).cast("int"))
    bit = F.conv(F.hex(octet), 16, 10).cast("int").bitwiseAND(mask) > 0
    met = placed.join(F.broadcast(bits.toDF(bucket, bitmap)), F.bitmap_bucket_number(column(at)) == column(bucket), "left")
    return met.select(*columns(df), F.coalesce(bit, F.lit(False)).alias(name))


def dedupe_wide(df: DataFrame, copies: str | None = None, **marking) -> DataFrame:
    """``dedupe_rows`` for wide rows: only rows that may have copies are shuffled, the others never move.

    Fingerprints are counted first (``mark_repeated``); the marked rows are then compared whole, so the result does not rest on
    hashes. Takes three reads of the rows in place of one exchange of them all, which pays where rows are wide and few repeat.
    ``copies`` names a column for how often each row was there. Rows with floats inside nested values take the exchange.
    """
    n = F.count(F.lit(1)).alias(copies or unused(df, "__copies"))
    if any(_has_nested_floats(f.dataType) for f in df.schema.fields):
        counted = df.groupBy(*columns(df)).agg(n)
        return counted if copies else counted.select(*columns(df))
    mark = unused(df, "__repeated")
    marked = mark_repeated(df, mark, **marking)
    alone = marked.where(~column(mark)).select(*columns(df), *([F.lit(1).cast("long").alias(copies)] if copies else []))
    moved = marked.where(column(mark)).groupBy(*columns(df)).agg(n)
    return alone.unionAll(moved if copies else moved.select(*columns(df)))


def is_complete(schema: T.StructType) -> Column:
    """True for rows without a null (or NaN) in any column.

    Written as one ``IS NOT NULL`` per column, which the file readers can use to skip row groups.
    """
    tests = [column(f.name).isNotNull() for f in schema.fields]
    tests += [~F.isnan(column(f.name)) for f in schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return reduce(and_, tests, F.lit(True))


def drop_incomplete_rows(df: DataFrame) -> DataFrame:
    """Rows that have a value in every column."""
    return df.filter(is_complete(df.schema))


def upper_strings(df: DataFrame) -> DataFrame:
    """Every string column upper-cased in place."""
    return df.select(
        *(
            F.upper(column(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else column(f.name)
            for f in df.schema.fields
        )
    )


def rename_by_map(df: DataFrame, mapping: Mapping[str, str] = RENAME_MAP) -> DataFrame:
    """Columns named exactly like a key, case included, take the name it maps to; others keep theirs."""
    names = list(df.columns)
    for old, new in mapping.items():
        names = [new if name == old else name for name in names]
    clash = repeated(names, is_case_sensitive(df))
    if clash:
        raise ValueError(f"renaming would give several columns the name {', '.join(clash)}")
    return df if names == df.columns else df.toDF(*names)


def stamp(df: DataFrame, name: str, now: Column | None = None) -> DataFrame:
    """Adds the time of the load: one value for the whole query, or ``now`` for a repeatable run."""
    return df.withColumn(name, F.current_timestamp() if now is None else now)


def copy_provenance(df: DataFrame) -> DataFrame:
    """Adds the provenance column, which holds the bronze ingestion time (and is a timestamp, despite its name)."""
    if INGESTION_STAMP not in df.columns:
        raise ValueError(f"{INGESTION_STAMP} is missing: this is not a bronze table")
    return df.withColumn(PROVENANCE, column(INGESTION_STAMP))


def spell_out(df: DataFrame, rename_map: Mapping[str, str] = RENAME_MAP, now: Column | None = None) -> DataFrame:
    """The row-preserving half of cleaning: upper-case, rename, stamp, provenance."""
    return (
        df.transform(upper_strings)
        .transform(rename_by_map, rename_map)
        .transform(stamp, SILVER_STAMP, now)
        .transform(copy_provenance)
    )


def clean(
    df: DataFrame, rename_map: Mapping[str, str] = RENAME_MAP, now: Column | None = None, distinct: str = "rows"
) -> DataFrame:
    """Bronze rows to silver rows.

    ``distinct="fingerprints"`` is for wide rows of which few repeat (``dedupe_wide``); the rows are the same.

    The plan has one exchange, for the distinct. Catalyst moves the completeness filter below it and into the
    scan, and equal rows are merged in every map task before they are shuffled, so a row with very many copies
    reaches its reduce task at most once per map task.
    """
    if _by_fingerprint(distinct):
        return df.transform(drop_incomplete_rows).transform(dedupe_wide).transform(spell_out, rename_map, now)
    return df.transform(dedupe_rows).transform(drop_incomplete_rows).transform(spell_out, rename_map, now)


def _by_fingerprint(distinct: str) -> bool:
    if distinct not in ("rows", "fingerprints"):
        raise ValueError(f"distinct is 'rows' or 'fingerprints', not {distinct!r}")
    return distinct == "fingerprints"


def clean_counted(
    df: DataFrame, observation, rename_map: Mapping[str, str] = RENAME_MAP, now: Column | None = None, distinct: str = "rows"
) -> DataFrame:
    """``clean``, with the row counts of each step left in ``observation`` once the result is written.

    The distinct keeps how many copies each row had, so all counts are taken at one place behind the exchange.
    That place is the last stage of a write, where Spark counts each task once however often it is retried;
    counts taken before the exchange would grow when lost map tasks are run again.
    """
    copies = unused(df, "__copies")
    counted = dedupe_wide(df, copies) if _by_fingerprint(distinct) else df.groupBy(*columns(df)).agg(F.count(F.lit(1)).alias(copies))
    return (
        counted.observe(
            observation,
            F.coalesce(F.sum(copies), F.lit(0)).alias("rows_read"),
            F.count(F.lit(1)).alias("rows_distinct"),
            F.count_if(is_complete(df.schema)).alias("rows_complete"),
        )
        .drop(copies)
        .transform(drop_incomplete_rows)
        .transform(spell_out, rename_map, now)
    )
