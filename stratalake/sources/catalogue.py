"""Tables of a metastore: any catalogue that Spark knows, by namespace."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# What catalogues answer that know no further level, or no views.
NO_LEVEL_BELOW = ("SCHEMA_NOT_FOUND", "REQUIRES_SINGLE_PART_NAMESPACE")
NO_VIEWS = ("MISSING_CATALOG_ABILITY.VIEWS", "UNSUPPORTED_FEATURE.CATALOG_OPERATION")


def identifier(parts: Sequence[str]) -> str:
    """Name parts as SQL writes them, each in backticks."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


@dataclass(frozen=True)
class CatalogueSource:
    """All tables of one namespace: ``("sales",)``, or ``("lake", "sales", "eu")`` in a catalogue of its own.

    A catalogue is the session's metastore or a DataSource V2 catalogue set up as ``spark.sql.catalog.<name>``; executors read its
    tables as the catalogue plans them, in as many tasks as they have splits. ``nested`` takes the tables of the namespaces below
    as well, under their path from here: ``eu.orders``. Temporary views belong to a session and are no tables of a namespace.
    """

    namespace: Sequence[str]
    include_views: bool = True
    nested: bool = False

    def __post_init__(self) -> None:
        parts = (self.namespace,) if isinstance(self.namespace, str) else tuple(self.namespace)
        if not parts or not all(parts):
            raise ValueError("a namespace has at least one part, and none of them is empty")
        object.__setattr__(self, "namespace", parts)

    def tables(self, spark: SparkSession) -> list[str]:
        return sorted(self._names(spark))

    def catalog(self, spark: SparkSession) -> DataFrame:
        """The namespace's table names in a column ``table_name``."""
        return spark.createDataFrame([(name,) for name in self.tables(spark)], "table_name string")

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        if not self.nested:
            return spark.table(identifier([*self.namespace, table]))
        names = self._names(spark)
        if table not in names:
            raise ValueError(f"{identifier(self.namespace)} has no table {table}")
        return spark.table(identifier(names[table]))

    def probe(self, spark: SparkSession) -> DataFrame:
        """One row ``ok = 1`` if the catalogue knows the namespace; raises otherwise."""
        return spark.sql(f"DESCRIBE NAMESPACE {identifier(self.namespace)}").limit(1).select(F.lit(1).alias("ok"))

    def _names(self, spark: SparkSession) -> dict[str, list[str]]:
        """Each table's name here and its full name."""
        found: dict[str, list[str]] = {}
        for space in self._namespaces(spark):
            views = set() if self.include_views else self._views(spark, space)
            below = space[len(self.namespace) :]
            for row in spark.sql(f"SHOW TABLES IN {identifier(space)}").where("NOT isTemporary").collect():
                if row["tableName"] in views:
                    continue
                name = ".".join([*below, row["tableName"]])
                if name in found:
                    raise ValueError(f"two tables below {identifier(self.namespace)} are called {name}")
                found[name] = [*space, row["tableName"]]
        return found

    def _namespaces(self, spark: SparkSession) -> list[list[str]]:
        """The namespace and, if wanted, all below it; a catalogue that has namespaces is none itself."""
        if not self.nested:
            return [list(self.namespace)]
        found, waiting = [], [list(self.namespace)]
        while waiting:
            space = waiting.pop(0)
            below = self._below(spark, space)
            waiting += below
            if not below or len(space) > 1:
                found.append(space)
        return found

    def _below(self, spark: SparkSession, space: list[str]) -> list[list[str]]:
        try:
            rows = spark.sql(f"SHOW NAMESPACES IN {identifier(space)}").collect()
        except AnalysisException as error:
            # a catalogue whose namespaces have one level says so when asked for a second
            if error.getCondition() in NO_LEVEL_BELOW:
                return []
            raise
        # some catalogues name the last part only, some the whole path below the catalogue
        names = [row[0].rpartition(".")[2].strip("`") for row in rows]
        return [[*space, name] for name in names if name and [*space, name] != space]

    def _views(self, spark: SparkSession, space: Sequence[str]) -> set[str]:
        try:
            return {row["viewName"] for row in spark.sql(f"SHOW VIEWS IN {identifier(space)}").collect()}
        except AnalysisException as error:
            if error.getCondition() in NO_VIEWS:
                return set()  # such a catalogue lists tables only
            raise
