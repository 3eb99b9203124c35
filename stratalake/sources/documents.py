"""Document collections: one row per document, one column per key that any document has."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.names import column
from stratalake.functions.text import text_form
from stratalake.plans.sizing import session_like
from stratalake.scratch import new_folder
from stratalake.sources.boundaries import json_documents
from stratalake.sources.files import probe_lines
from stratalake.sources.listing import names_with_suffix


@dataclass(frozen=True)
class DocumentSource:
    """Collections exported as JSON lines, or read through a document connector.

    * ``DocumentSource(root)``: every ``{collection}.json`` entry of a directory, file or directory itself.
    * ``DocumentSource.over_connector("mongodb", options, collections, schemas)``: the connector must be on the
      cluster's classpath, and the caller names the collections.

    Documents are lines. With the option ``multiLine`` they may span lines, stand several on a line, or make up one array for each
    file: their ends are then found by many tasks (``json_documents``), and the documents kept as lines in scratch for the reads.

    Without a schema every top-level key of a JSON collection becomes a text column that holds the values letter by
    letter: strings without their quotes, an object id as its digits, and booleans as ``True`` and ``False`` (but as JSON
    writes them if the key also has the strings ``true`` or ``false``). Finding the keys takes one pass. Of keys that differ in case only, the first by code point keeps its name, and the others get
    a number: ``Name``, ``name__2``. A schema in ``schemas`` saves the pass and gives types; keys it leaves out are then not
    read. Connectors, which would infer from a few documents, need one for each collection.
    """

    root: str = ""
    data_format: str = "json"
    options: Mapping[str, str] = field(default_factory=dict)
    collections: Sequence[str] | None = None
    schemas: Mapping[str, T.StructType | str] = field(default_factory=dict)

    @classmethod
    def over_connector(
        cls,
        data_format: str,
        options: Mapping[str, str],
        collections: Sequence[str],
        schemas: Mapping[str, T.StructType | str] | None = None,
    ) -> DocumentSource:
        return cls("", data_format, options, tuple(collections), schemas or {})

    def tables(self, spark: SparkSession) -> list[str]:
        if self.collections is not None:
            return list(self.collections)
        return names_with_suffix(spark, self.root, ".json")

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        reader = spark.read.format(self.data_format).options(**self.options)
        if table not in self.schemas and self.data_format != "json":
            raise ValueError(f"collection {table} needs a schema: one inferred from some documents would lose keys")
        if table in self.schemas:
            reader = reader.schema(self.schemas[table])
        if self.data_format != "json":
            return flatten_documents(reader.option("collection", table).load())
        path = f"{self.root.rstrip('/')}/{table}.json"
        if table in self.schemas:
            # A malformed document stops the load instead of turning into a row of nulls.
            return flatten_documents(reader.option("mode", "FAILFAST").load(path))
        options = {name: value for name, value in self.options.items() if name.lower() != "multiline"}
        if self._spans_lines():
            whole = json_documents(spark, path)
            path = f"{new_folder(spark, 'documents')}/{table}.json"
            whole.select("value").write.text(path)
        lines = spark.read.options(**options).text(path)
        return documents_as_text(spark, path, options, keys_of(lines))

    def _spans_lines(self) -> bool:
        return any(name.lower() == "multiline" and str(value).lower() == "true" for name, value in self.options.items())

    def probe(self, spark: SparkSession) -> DataFrame:
        if self.data_format == "json":
            return probe_lines(spark, f"{self.root.rstrip('/')}/*.json")
        return self.read(spark, self.tables(spark)[0]).limit(1).selectExpr("1 AS ok")


@dataclass(frozen=True)
class Key:
    """A top-level key: whether its texts ``true`` and ``false`` are booleans in all documents that have them."""

    name: str
    boolean: bool


def keys_of(lines: DataFrame) -> list[Key]:
    """The top-level keys of all JSON lines, by code point, from one pass; only they reach the driver."""
    members = lines.select(F.explode(F.from_json("value", "map<string,variant>")))
    kind, text = F.schema_of_variant("value"), F.try_variant_get("value", "$", "string")
    found = members.groupBy("key").agg(
        F.count_if(kind == "BOOLEAN").alias("booleans"),
        F.count_if((kind == "STRING") & text.isin("true", "false")).alias("strings"),
    )
    return [Key(r["key"], r["booleans"] > 0 and r["strings"] == 0) for r in found.orderBy("key").collect()]


def documents_as_text(spark: SparkSession, path: str, options: Mapping[str, str], keys: Sequence[Key]) -> DataFrame:
    """One text column for each key of a JSON collection."""
    names = distinct_names([key.name for key in keys])
    if any(name != key for key, name in names.items()):
        # keys that are equal but for case can be told apart by a session that minds case
        spark = session_like(spark, {"spark.sql.caseSensitive": "true"})
    schema = T.StructType([T.StructField(key.name, T.StringType()) for key in keys])
    # FAILFAST: a malformed document stops the load instead of turning into a row of nulls.
    rows = spark.read.options(**options).option("mode", "FAILFAST").schema(schema).json(path)

    def value(key: Key):
        text = column(key.name)
        object_id = F.regexp_extract(text, r'^\{\s*"\$oid"\s*:\s*"([^"\\]*)"\s*\}$', 1)
        text = F.when(object_id != "", object_id).otherwise(text)
        return F.when(text.isin("true", "false"), F.initcap(text)).otherwise(text) if key.boolean else text

    return rows.select(*(value(key).alias(names[key.name]) for key in keys)) if keys else rows


def distinct_names(keys: Sequence[str]) -> dict[str, str]:
    """A column name for each key, in the given order, no two of them equal but for case."""
    taken, names = {key.lower() for key in keys}, {}
    seen: dict[str, int] = {}
    for key in keys:
        n = seen[key.lower()] = seen.get(key.lower(), 0) + 1
        name = key
        while n > 1 and (name := f"{key}__{n}").lower() in taken:
            n += 1
        taken.add(name.lower())
        names[key] = name
    return names


def flatten_documents(df: DataFrame) -> DataFrame:
    """Top-level keys as columns; nested values as JSON text, object ids as their hexadecimal text."""

    def flat(f: T.StructField):
        value = column(f.name)
        if isinstance(f.dataType, T.StructType) and f.dataType.names == ["$oid"]:
            value = value.getField("$oid")
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            value = text_form(value, f.dataType)
        return value.alias(f.name)

    return df.select(*(flat(f) for f in df.schema.fields)) if df.columns else df


def parse_nested(df: DataFrame, name: str, schema: T.DataType | str) -> DataFrame:
    """The inverse for one column: JSON text back to a nested value."""
    return df.withColumn(name, F.from_json(column(name), schema))
