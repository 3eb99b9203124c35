"""Every operator as a query over the given tables, each with the SQL that must give the same rows.

All of them read whole tables. What they write (landing files, layers) goes to a folder of its own below the
session's shared checkpoint directory. Load times are fixed, since two engines do not share a clock.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.checks.database import load_database
from stratalake.checks.workspace import new_folder, new_lake
from stratalake.functions.text import as_text
from stratalake.layout import LakeLayout
from stratalake.operators.audit import preview, row_count, step_counts, table_report
from stratalake.operators.cleaning import (
    INGESTION_STAMP,
    clean,
    copy_provenance,
    dedupe_rows,
    dedupe_wide,
    drop_incomplete_rows,
    rename_by_map,
    stamp,
    upper_strings,
)
from stratalake.plans.stages import bronze_to_silver, extract_to_landing, landing_to_bronze, run_pipeline
from stratalake.sinks.landing import write_landing
from stratalake.sinks.layers import write_layer
from stratalake.sources.catalogue import CatalogueSource
from stratalake.sources.documents import DocumentSource, parse_nested
from stratalake.sources.files import TableDirectory, probe_lines, read_landing, read_lines, read_table
from stratalake.sources.listing import bronze_tables, landing_tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

INGESTED_AT = "2024-02-01 00:00:00"
REFINED_AT = "2024-02-02 00:00:00"

ALL_TABLES = [
    "benchmark",
    "conversations",
    "customer",
    "documents",
    "embeddings",
    "events",
    "labels",
    "lineitem",
    "nation",
    "orders",
    "pages",
    "part",
    "region",
    "supplier",
]


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Registers a query, with its SQL where it has one."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return TableDirectory(sf_dir).read(spark, name)


def at(moment: str):
    return F.lit(moment).cast("timestamp_ntz")


def as_bronze(df: DataFrame) -> DataFrame:
    """What a table looks like in bronze: all text, and stamped."""
    return df.transform(as_text).transform(stamp, INGESTION_STAMP, at(INGESTED_AT))


def stored(df: DataFrame) -> DataFrame:
    """The rows as a bronze table on disk, which is where cleaning starts from."""
    layout = new_lake(df.sparkSession, "bronze")
    path = layout.bronze_path("rows")
    write_layer(df, path, layout.table_format)
    return read_table(df.sparkSession, path, layout.table_format)


def refined(df: DataFrame) -> DataFrame:
    """Bronze rows, written, taken through the silver stage and read back."""
    layout = new_lake(df.sparkSession, "silver")
    write_layer(df, layout.bronze_path("rows"), layout.table_format)
    bronze_to_silver(df.sparkSession, layout, now=at(REFINED_AT))
    return read_table(df.sparkSession, layout.silver_path("rows"), layout.table_format)


def counts_by_table(tables: dict[str, DataFrame]) -> DataFrame:
    """One row (table_name, n_rows) per table."""
    counts = [row_count(df).select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


# Oracle fragments

BRONZE_STAMP = f"TIMESTAMP '{INGESTED_AT}' AS _ingestion_timestamp"
SILVER_STAMPS = (
    f"TIMESTAMP '{INGESTED_AT}' AS _ingestion_timestamp, "
    f"TIMESTAMP '{REFINED_AT}' AS _silver_ingestion_timestamp, "
    f"TIMESTAMP '{INGESTED_AT}' AS _source_table"
)


def text_columns(*names: str) -> str:
    return ", ".join(f"CAST({name} AS VARCHAR) AS {name}" for name in names)


def upper_sql(text: str) -> str:
    """Upper case as Spark maps it: sharp s becomes two letters, which this SQL function leaves as one."""
    return f"upper(replace({text}, 'ß', 'ss'))"


def upper_columns(*names: str) -> str:
    return ", ".join(f"{upper_sql(f'CAST({name} AS VARCHAR)')} AS {name}" for name in names)


def counts_sql(*names: str) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {name}" for name in names)


CUSTOMER = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
ORDERS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
LINEITEM = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)
DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")

# An at-least-once feed in bronze form: every event arrives twice, errors come without their properties, and one
# heartbeat row per event, all alike, makes up a third of the feed.
FEED_SQL = """
  SELECT CAST(event_id AS VARCHAR) AS cd, event_type AS tp, CAST(ts AS VARCHAR) AS dt,
         CASE WHEN event_type <> 'error' THEN props END AS ds,
         CAST(user_id AS VARCHAR) AS user_id, CAST(value AS VARCHAR) AS amount
  FROM events, (VALUES (1), (2)) delivery(n)
  UNION ALL
  SELECT 'heartbeat', 'heartbeat', 'heartbeat', 'heartbeat', 'heartbeat', 'heartbeat' FROM events
"""


def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given(spark, sf_dir, "events")
    once = events.select(
        F.col("event_id").alias("CD"),
        F.col("event_type").alias("TP"),
        F.col("ts").alias("DT"),
        F.when(F.col("event_type") != "error", F.col("props")).alias("DS"),
        "user_id",
        F.col("value").alias("amount"),
    ).transform(as_text)
    heartbeats = events.select(*(F.lit("heartbeat").alias(c) for c in once.columns))
    feed = once.unionByName(once).unionByName(heartbeats)
    return feed.transform(stamp, INGESTION_STAMP, at(INGESTED_AT))


# Cleaning


@query(
    "silver_events",
    f"""
    SELECT {upper_sql('cd')} AS CODIGO, {upper_sql('tp')} AS TIPO, {upper_sql('dt')} AS DATA,
           {upper_sql('ds')} AS DESCRICAO, upper(user_id) AS user_id, upper(amount) AS amount, {SILVER_STAMPS}
    FROM (SELECT DISTINCT * FROM ({FEED_SQL}) feed) bronze
    WHERE cd IS NOT NULL AND tp IS NOT NULL AND dt IS NOT NULL AND ds IS NOT NULL
      AND user_id IS NOT NULL AND amount IS NOT NULL
    """,
)
def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refined(event_feed(spark, sf_dir))


@query(
    "silver_lineitem",
    f"SELECT {upper_columns(*LINEITEM)}, {SILVER_STAMPS} FROM (SELECT DISTINCT * FROM lineitem) bronze",
)
def silver_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refined(as_bronze(given(spark, sf_dir, "lineitem")))


@query(
    "silver_documents",
    f"SELECT {upper_columns(*DOCUMENTS)}, {SILVER_STAMPS} FROM (SELECT DISTINCT * FROM documents) bronze",
)
def silver_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refined(as_bronze(given(spark, sf_dir, "documents")))


def with_copies(df: DataFrame, some: str) -> DataFrame:
    """The table with copies of itself, and once more of the rows that `some` picks."""
    return df.unionByName(df).unionByName(df.where(some))


@query("dedupe_rows", "SELECT DISTINCT * FROM events")
def dedupe_rows_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_copies(given(spark, sf_dir, "events"), "event_type = 'error'").transform(dedupe_rows)


@query("dedupe_rows_lineitem", "SELECT DISTINCT * FROM lineitem")
def dedupe_rows_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_copies(given(spark, sf_dir, "lineitem"), "l_returnflag = 'R'").transform(dedupe_rows)


@query("dedupe_wide_documents", "SELECT DISTINCT * FROM documents")
def dedupe_wide_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_copies(given(spark, sf_dir, "documents"), "lang = 'de'").transform(dedupe_wide)


@query(
    "silver_documents_by_fingerprint",
    f"SELECT {upper_columns(*DOCUMENTS)}, {SILVER_STAMPS} FROM (SELECT DISTINCT * FROM documents) bronze",
)
def silver_documents_by_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = stored(as_bronze(given(spark, sf_dir, "documents")).transform(with_copies, "lang = 'en'"))
    return bronze.transform(clean, now=at(REFINED_AT), distinct="fingerprints")


@query(
    "drop_incomplete_rows",
    """
    SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
    WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL
    """,
)
def drop_incomplete_rows_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = given(spark, sf_dir, "documents")
    return documents.join(given(spark, sf_dir, "labels"), "doc_id", "left").transform(drop_incomplete_rows)


@query(
    "upper_strings",
    f"""
    SELECT c_custkey, {upper_sql('c_name')} AS c_name, c_nationkey, c_acctbal,
           {upper_sql('c_mktsegment')} AS c_mktsegment
    FROM customer
    """,
)
def upper_strings_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "customer").transform(upper_strings)


@query(
    "upper_strings_documents",
    f"""
    SELECT doc_id, {upper_sql('text')} AS text, {upper_sql('lang')} AS lang, {upper_sql('source')} AS source, n_chars
    FROM documents
    """,
)
def upper_strings_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "documents").transform(upper_strings)


@query("rename_by_map", "SELECT * RENAME (p_partkey AS CODIGO, p_name AS NOME, p_type AS TIPO) FROM part")
def rename_by_map_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = given(spark, sf_dir, "part")
    return part.withColumnsRenamed({"p_partkey": "CD", "p_name": "NM", "p_type": "TP"}).transform(rename_by_map)


@query("bronze_stamp", f"SELECT *, {BRONZE_STAMP} FROM orders")
def bronze_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "orders").transform(stamp, INGESTION_STAMP, at(INGESTED_AT))


@query(
    "bronze_stamp_clock",
    """
    SELECT count(*) AS n_rows, 1 AS n_stamps, count(*) AS n_equal FROM orders
    """,
)
def bronze_stamp_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clock itself: one value in every row and in both columns of a query."""
    stamped = given(spark, sf_dir, "orders").transform(stamp, "first").transform(stamp, "second")
    return stamped.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("first").cast("int").alias("n_stamps"),
        F.count_if(F.col("first") == F.col("second")).alias("n_equal"),
    )


@query(
    "silver_provenance_copy",
    f"SELECT *, {BRONZE_STAMP}, TIMESTAMP '{INGESTED_AT}' AS _source_table FROM supplier",
)
def silver_provenance_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = given(spark, sf_dir, "supplier")
    return supplier.transform(stamp, INGESTION_STAMP, at(INGESTED_AT)).transform(copy_provenance)


# Landing


def through_landing(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table written to landing and read back."""
    layout = new_lake(spark, "landing")
    write_landing(given(spark, sf_dir, table), layout.landing_path(table))
    return read_landing(spark, layout.landing_path(table))


@query("landing_csv_scan", f"SELECT {text_columns(*ORDERS)} FROM orders")
def landing_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return through_landing(spark, sf_dir, "orders")


@query("landing_csv_text_fidelity", f"SELECT {text_columns(*DOCUMENTS)} FROM documents")
def landing_csv_text_fidelity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return through_landing(spark, sf_dir, "documents")


@query("landing_csv_html_fidelity", f"SELECT {text_columns('page_id', 'url', 'html')} FROM pages")
def landing_csv_html_fidelity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return through_landing(spark, sf_dir, "pages")


@query("landing_csv_across_lines", f"SELECT {text_columns(*DOCUMENTS)} FROM documents")
def landing_csv_across_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files as another program may leave them, values with line breaks in one large file, cut at their records."""
    path = new_lake(spark, "across").landing_path("documents")
    write_landing(given(spark, sf_dir, "documents"), path)
    return read_landing(spark, path, large_file=1)


@query(
    "landing_csv_json_fidelity",
    f"SELECT {text_columns('event_id', 'ts', 'user_id', 'event_type', 'value', 'props')} FROM events",
)
def landing_csv_json_fidelity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return through_landing(spark, sf_dir, "events")


@query(
    "text_line_scan",
    f"SELECT concat_ws(',', {', '.join(f'CAST({c} AS VARCHAR)' for c in ORDERS)}) AS value FROM orders",
)
def text_line_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = new_lake(spark, "lines")
    write_landing(given(spark, sf_dir, "orders"), layout.landing_path("orders"))
    # Every file starts with the header; the rows are what is left.
    return read_lines(spark, f"{layout.landing_path('orders')}/part-*").filter(F.col("value") != ",".join(ORDERS))


@query("landing_table_list", counts_sql("customer", "nation", "orders"))
def landing_table_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = new_lake(spark, "listing")
    extract_to_landing(spark, TableDirectory(sf_dir), layout, ["customer", "nation", "orders"])
    found = landing_tables(spark, layout)
    return counts_by_table({name: read_landing(spark, layout.landing_path(name)) for name in found})


# Bronze


def bronze_lake(spark: SparkSession, sf_dir: str, *tables: str) -> LakeLayout:
    layout = new_lake(spark, "bronze")
    extract_to_landing(spark, TableDirectory(sf_dir), layout, tables)
    landing_to_bronze(spark, layout, now=at(INGESTED_AT))
    return layout


@query("landing_to_bronze", f"SELECT {text_columns(*CUSTOMER)}, {BRONZE_STAMP} FROM customer")
def landing_to_bronze_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = bronze_lake(spark, sf_dir, "customer")
    return read_table(spark, layout.bronze_path("customer"))


@query("bronze_table_scan", f"SELECT {text_columns(*ORDERS)}, {BRONZE_STAMP} FROM orders")
def bronze_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(as_bronze(given(spark, sf_dir, "orders")))


@query("bronze_table_list", counts_sql("part", "region", "supplier"))
def bronze_table_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = bronze_lake(spark, sf_dir, "part", "region", "supplier")
    found = bronze_tables(spark, layout)
    return counts_by_table({name: read_table(spark, layout.bronze_path(name)) for name in found})


# Audit


STEP_COUNTS_SQL = f"""
    WITH feed AS ({FEED_SQL}), distinct_rows AS (SELECT DISTINCT * FROM feed)
    SELECT (SELECT count(*) FROM feed) AS rows_read,
           (SELECT count(*) FROM distinct_rows) AS rows_distinct,
           (SELECT count(*) FROM distinct_rows WHERE ds IS NOT NULL) AS rows_complete
"""


@query(
    "stage_row_audit",
    f"SELECT rows_read, rows_distinct, rows_complete, rows_complete AS rows_written FROM ({STEP_COUNTS_SQL}) c",
)
def stage_row_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = new_lake(spark, "audit")
    write_layer(event_feed(spark, sf_dir), layout.bronze_path("feed"))
    results = bronze_to_silver(spark, layout, now=at(REFINED_AT))
    return results.select("rows_read", "rows_distinct", "rows_complete", "rows_written")


@query("step_row_counts", STEP_COUNTS_SQL)
def step_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return step_counts(stored(event_feed(spark, sf_dir)))


@query("row_count", "SELECT count(*) AS n_rows FROM lineitem")
def row_count_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(given(spark, sf_dir, "lineitem"))


@query(
    "schema_report",
    f"""
    WITH feed AS ({FEED_SQL}),
    report(layer, ordinal, column_name, data_type) AS (VALUES
      ('bronze', 1, 'CD', 'string'), ('bronze', 2, 'TP', 'string'), ('bronze', 3, 'DT', 'string'),
      ('bronze', 4, 'DS', 'string'), ('bronze', 5, 'user_id', 'string'), ('bronze', 6, 'amount', 'string'),
      ('bronze', 7, '_ingestion_timestamp', 'timestamp_ntz'),
      ('silver', 1, 'CODIGO', 'string'), ('silver', 2, 'TIPO', 'string'), ('silver', 3, 'DATA', 'string'),
      ('silver', 4, 'DESCRICAO', 'string'), ('silver', 5, 'user_id', 'string'), ('silver', 6, 'amount', 'string'),
      ('silver', 7, '_ingestion_timestamp', 'timestamp_ntz'),
      ('silver', 8, '_silver_ingestion_timestamp', 'timestamp_ntz'), ('silver', 9, '_source_table', 'timestamp_ntz')),
    counts AS (
      SELECT 'bronze' AS layer, count(*) AS n_rows FROM feed
      UNION ALL SELECT 'silver', count(*) FROM (SELECT DISTINCT * FROM feed WHERE ds IS NOT NULL) s)
    SELECT r.layer, r.ordinal, r.column_name, r.data_type, c.n_rows FROM report r JOIN counts c ON c.layer = r.layer
    """,
)
def schema_report_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = stored(event_feed(spark, sf_dir))
    silver = bronze.transform(clean, now=at(REFINED_AT))
    reports = [
        table_report(df).select(F.lit(layer).alias("layer"), "*")
        for layer, df in (("bronze", bronze), ("silver", silver))
    ]
    return reduce(DataFrame.unionByName, reports)


@query("preview_rows", "SELECT least(20, count(*)) AS n_rows FROM orders")
def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows a preview shows is open; that they are whole rows of the table, and how many, is not."""
    orders = given(spark, sf_dir, "orders")
    # A preview has at most 20 rows, whatever the table has.
    return row_count(orders.join(F.broadcast(preview(orders)), orders.columns, "left_semi"))


# Relational sources (in-process database: local mode only, see ``database``)


@query("jdbc_table_scan", "SELECT * FROM customer")
def jdbc_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"customer": given(spark, sf_dir, "customer")}
    return load_database(spark, tables, {"customer": ["c_custkey"]}).read(spark, "customer")


@query("jdbc_table_discovery", counts_sql("customer", "nation", "region"))
def jdbc_table_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: given(spark, sf_dir, name) for name in ("customer", "nation", "region")}
    source = load_database(spark, tables)
    return counts_by_table({name: source.read(spark, name) for name in source.tables(spark)})


@query(
    "jdbc_single_table_extract",
    f"SELECT {text_columns('s_suppkey', 's_name', 's_nationkey', 's_acctbal')} FROM supplier",
)
def jdbc_single_table_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: given(spark, sf_dir, name) for name in ("supplier", "region")}
    source, layout = load_database(spark, tables), new_lake(spark, "single")
    extract_to_landing(spark, source, layout, ["supplier"])
    return read_landing(spark, layout.landing_path("supplier"))


@query("extract_schema_counts", counts_sql("customer", "nation", "region", "supplier"))
def extract_schema_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: given(spark, sf_dir, name) for name in ("customer", "nation", "region", "supplier")}
    source = load_database(spark, tables, {"customer": ["c_custkey"]})
    results = extract_to_landing(spark, source, new_lake(spark, "schema"))
    return results.select("table_name", F.col("rows_written").alias("n_rows"))


PROBE_SQL = "SELECT 'rows' AS fact, count(*) AS n FROM {table} UNION ALL SELECT 'ok', 1"


def probe_facts(rows: DataFrame, probe: DataFrame) -> DataFrame:
    """What the probe answers, next to what is there in all."""
    facts = row_count(rows).select(F.lit("rows").alias("fact"), F.col("n_rows").alias("n"))
    return facts.unionByName(probe.select(F.lit("ok").alias("fact"), F.col("ok").cast("bigint").alias("n")))


@query("jdbc_source_probe", PROBE_SQL.format(table="supplier"))
def jdbc_source_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = load_database(spark, {"supplier": given(spark, sf_dir, "supplier")})
    return probe_facts(source.read(spark, "supplier"), source.probe(spark))


@query("source_probe", PROBE_SQL.format(table="orders"))
def source_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = new_lake(spark, "probe")
    path = layout.landing_path("orders")
    write_landing(given(spark, sf_dir, "orders"), path)
    return probe_facts(read_landing(spark, path), probe_lines(spark, f"{path}/*"))


# Catalogue sources


@contextmanager
def registered(spark: SparkSession, sf_dir: str, *names: str) -> Iterator[CatalogueSource]:
    """A namespace of the session's catalogue whose tables are the given ones, where they lie."""
    space = f"given_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {space} LOCATION '{new_folder(spark, 'catalogue')}'")
    try:
        for name in names:
            place = f"{sf_dir.rstrip('/')}/{name}.parquet".replace("'", "\\'")
            spark.sql(f"CREATE TABLE {space}.{name} USING parquet LOCATION '{place}'")
        yield CatalogueSource(space)
    finally:
        spark.sql(f"DROP DATABASE {space} CASCADE")


@query("catalogue_table_discovery", counts_sql(*ALL_TABLES))
def catalogue_table_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    with registered(spark, sf_dir, *ALL_TABLES) as source:
        return counts_by_table({name: source.read(spark, name) for name in source.tables(spark)})


@query("catalogue_extract_counts", counts_sql("customer", "documents", "nation", "orders"))
def catalogue_extract_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    with registered(spark, sf_dir, "customer", "documents", "nation", "orders") as source:
        results = extract_to_landing(spark, source, new_lake(spark, "schema"))
    return results.select("table_name", F.col("rows_written").alias("n_rows"))


@query(
    "catalogue_single_table_extract",
    f"SELECT {text_columns('s_suppkey', 's_name', 's_nationkey', 's_acctbal')} FROM supplier",
)
def catalogue_single_table_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = new_lake(spark, "single")
    with registered(spark, sf_dir, "supplier", "region") as source:
        extract_to_landing(spark, source, layout, ["supplier"])
    return read_landing(spark, layout.landing_path("supplier"))


# Document sources


def exported_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as documents with nested turns."""
    return given(spark, sf_dir, "conversations").select(
        "conv_id", F.struct("turn", "role", "text").alias("message"), F.array("role").alias("tags")
    )


def exported_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as documents that differ in their keys."""
    return given(spark, sf_dir, "labels").select(
        "doc_id",
        F.when(F.col("toxic") == 1, F.col("toxic")).alias("toxic"),
        F.when(F.col("toxic") == 0, F.col("quality")).alias("quality"),
    )


def export_collections(spark: SparkSession, **collections: DataFrame) -> DocumentSource:
    """A folder of collections as JSON lines."""
    root = new_folder(spark, "documents")
    for name, rows in collections.items():
        rows.write.json(f"{root}/{name}.json")
    return DocumentSource(root)


@query("document_collection_flatten", "SELECT conv_id, turn, role, text, role AS tag FROM conversations")
def document_collection_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = export_collections(spark, conversations=exported_turns(spark, sf_dir))
    layout = new_lake(spark, "flatten")
    extract_to_landing(spark, source, layout, ["conversations"])
    landed = read_landing(spark, layout.landing_path("conversations"))
    parsed = landed.transform(parse_nested, "message", "turn bigint, role string, text string")
    parsed = parsed.transform(parse_nested, "tags", "array<string>")
    return parsed.select(F.col("conv_id").cast("bigint"), "message.*", F.col("tags")[0].alias("tag"))


@query(
    "document_key_union",
    """
    SELECT doc_id, CASE WHEN toxic = 1 THEN toxic END AS toxic, CASE WHEN toxic = 0 THEN quality END AS quality
    FROM labels
    """,
)
def document_key_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = export_collections(spark, labels=exported_labels(spark, sf_dir)).read(spark, "labels")
    return labels.select(F.col("doc_id").cast("bigint"), F.col("toxic").cast("int"), F.col("quality").cast("int"))


@query(
    "document_value_fidelity",
    """
    SELECT CAST(event_id AS VARCHAR) AS id, '1' || event_id || '00000000000000000000000000' AS large,
           event_type AS kind, CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) ELSE event_id || '.50' END AS mixed,
           '{"k":null,"m":1.50}' AS nested, props AS "Props", CASE WHEN event_type = 'error' THEN 'True' END AS flag
    FROM events
    UNION ALL
    SELECT conv_id || '-' || turn AS id, NULL, role, NULL, NULL, text, NULL FROM conversations
    """,
)
def document_value_fidelity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of two shapes, written as text letter by letter: long and mixed numbers, nested nulls, missing keys."""
    root = new_folder(spark, "documents")

    def quoted(name: str) -> Column:
        # the value as JSON text, from an array of one
        return F.regexp_extract(F.to_json(F.array(name), {"ignoreNullFields": "false"}), r"(?s)^\[(.*)\]$", 1)

    number = F.when(F.col("event_id") % 2 == 0, F.col("event_id").cast("string")).otherwise(F.concat("event_id", F.lit(".50")))
    events = given(spark, sf_dir, "events").select(
        F.concat(
            F.format_string('{"id":"%d","large":1%d00000000000000000000000000,"kind":', "event_id", "event_id"),
            quoted("event_type"),
            F.lit(',"mixed":'),
            number,
            F.lit(',"nested":{"k":null,"m":1.50},"Props":'),
            quoted("props"),
            F.when(F.col("event_type") == "error", ',"flag":true').otherwise(""),
            F.lit("}"),
        ).alias("value")
    )
    turns = given(spark, sf_dir, "conversations").select(
        F.concat(
            F.format_string('{"id":"%d-%d","kind":', "conv_id", "turn"), quoted("role"), F.lit(',"Props":'), quoted("text"), F.lit("}")
        ).alias("value")
    )
    events.unionByName(turns).write.text(f"{root}/mixed.json")
    return DocumentSource(root).read(spark, "mixed")


@query("document_spanning_lines", "SELECT conv_id, turn, role, text, role AS tag FROM conversations")
def document_spanning_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents printed over several lines, read without a schema."""
    root = new_folder(spark, "documents")
    turns = exported_turns(spark, sf_dir)
    turns.select(F.to_json(F.struct(*turns.columns), {"pretty": "true"}).alias("value")).write.text(f"{root}/turns.json")
    rows = DocumentSource(root, options={"multiLine": "true"}).read(spark, "turns")
    parsed = rows.transform(parse_nested, "message", "turn bigint, role string, text string").transform(parse_nested, "tags", "array<string>")
    return parsed.select(F.col("conv_id").cast("bigint"), "message.*", F.col("tags")[0].alias("tag"))


@query("collection_discovery", counts_sql("conversations", "labels"))
def collection_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = export_collections(
        spark, conversations=exported_turns(spark, sf_dir), labels=exported_labels(spark, sf_dir)
    )
    return counts_by_table({name: source.read(spark, name) for name in source.tables(spark)})


@query("extract_collections_counts", counts_sql("conversations", "labels"))
def extract_collections_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = export_collections(
        spark, conversations=exported_turns(spark, sf_dir), labels=exported_labels(spark, sf_dir)
    )
    results = extract_to_landing(spark, source, new_lake(spark, "collections"))
    return results.select("table_name", F.col("rows_written").alias("n_rows"))


# Whole pipelines


def refined_lake(spark: SparkSession, source, *tables: str) -> LakeLayout:
    layout = new_lake(spark, "lake")
    run_pipeline(
        spark,
        source,
        layout,
        tables=tables or None,
        ingested_at=at(INGESTED_AT),
        refined_at=at(REFINED_AT),
        distinct="fingerprints",
    )
    return layout


SILVER_CUSTOMER_SQL = f"""
    SELECT {upper_columns('c_custkey', 'c_name', 'c_nationkey', 'c_mktsegment')}, c_acctbal,
           {upper_columns('n_name', 'r_name')}, {SILVER_STAMPS}
    FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
"""


def silver_customer(spark: SparkSession, source) -> DataFrame:
    """Customers with nation and region, all from silver."""
    layout = refined_lake(spark, source, "customer", "nation", "region")
    customer, nation, region = (read_table(spark, layout.silver_path(name)) for name in ("customer", "nation", "region"))
    named = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select("n_nationkey", "n_name", "r_name")
    joined = customer.join(named, customer["c_nationkey"] == named["n_nationkey"]).drop("n_nationkey")
    return joined.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query("medallion_full", SILVER_CUSTOMER_SQL)
def medallion_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_customer(spark, TableDirectory(sf_dir))


@query("medallion_catalogue", SILVER_CUSTOMER_SQL)
def medallion_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    with registered(spark, sf_dir, "customer", "nation", "region") as source:
        return silver_customer(spark, source)


@query("medallion_jdbc", SILVER_CUSTOMER_SQL)
def medallion_jdbc(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: given(spark, sf_dir, name) for name in ("customer", "nation", "region")}
    return silver_customer(spark, load_database(spark, tables, {"customer": ["c_custkey"]}))


@query("medallion_orders", f"SELECT {upper_columns(*ORDERS)}, {SILVER_STAMPS} FROM orders")
def medallion_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = refined_lake(spark, TableDirectory(sf_dir), "orders")
    return read_table(spark, layout.silver_path("orders"))


@query(
    "medallion_audit",
    " UNION ALL ".join(
        f"SELECT '{stage}' AS stage, '{name}' AS table_name, 'written' AS status, count(*) AS rows_written FROM {rows}"
        for name in ALL_TABLES
        for stage, rows in (("extract", name), ("bronze", name), ("silver", f"(SELECT DISTINCT * FROM {name}) s"))
    ),
)
def medallion_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every given table through all layers, with the counts of every stage.

    Few rows repeat in whole tables, so hashes are counted in place of rows: a map task that counts whole rows of a large
    table spills them. All layers of all tables lie on disk at the end, landing as text, so they are compressed.
    """
    results = run_pipeline(
        spark,
        TableDirectory(sf_dir),
        replace(new_lake(spark, "audit"), landing_codec="gzip", table_codec="zstd"),
        tables=ALL_TABLES,
        ingested_at=at(INGESTED_AT),
        refined_at=at(REFINED_AT),
        distinct="fingerprints",
    )
    return results.select("stage", "table_name", "status", "rows_written")
