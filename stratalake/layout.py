"""Where each layer of the lake lives."""

from __future__ import annotations

from dataclasses import dataclass

LANDING_SUFFIX = ".csv"


@dataclass(frozen=True)
class LakeLayout:
    """Directory URIs of the three layers, on any file system Hadoop can reach.

    A table keeps its name through all layers: ``{landing}/{table}.csv``, ``{bronze}/{table}`` and
    ``{silver}/{table}``. ``table_format`` is any batch format on the classpath that can be loaded and
    saved by path; Parquet ships with Spark, Delta needs its package on the cluster. ``landing_codec`` compresses the
    landing files (``gzip``; plain text by default), ``table_codec`` those of bronze and silver (``zstd``; by default
    as the session says).
    """

    landing: str
    bronze: str
    silver: str
    table_format: str = "parquet"
    landing_codec: str | None = None
    table_codec: str | None = None

    def __post_init__(self) -> None:
        layers = {"landing": self.landing, "bronze": self.bronze, "silver": self.silver}
        for name, uri in layers.items():
            if not uri or not uri.strip():
                raise ValueError(f"the {name} layer has no location")
            object.__setattr__(self, name, uri.rstrip("/"))
        if len({self.landing, self.bronze, self.silver}) < len(layers):
            raise ValueError("landing, bronze and silver must be three different locations")

    @classmethod
    def under(cls, root: str, table_format: str = "parquet") -> LakeLayout:
        """All layers as sub-directories of one root."""
        root = root.rstrip("/")
        return cls(f"{root}/landing", f"{root}/bronze", f"{root}/silver", table_format)

    @classmethod
    def in_containers(
        cls,
        host: str,
        landing: str,
        bronze: str,
        silver: str,
        subdir: str = "",
        scheme: str = "abfss",
        table_format: str = "parquet",
    ) -> LakeLayout:
        """One storage container per layer: ``scheme://container@host/subdir``."""
        if not all((host, landing, bronze, silver)):
            raise ValueError("the host and a container for every layer are required")
        tail = f"/{subdir.strip('/')}" if subdir.strip("/") else ""
        return cls(*(f"{scheme}://{c}@{host}{tail}" for c in (landing, bronze, silver)), table_format)

    def landing_path(self, table: str) -> str:
        return f"{self.landing}/{_entry_name(table)}{LANDING_SUFFIX}"

    def bronze_path(self, table: str) -> str:
        return f"{self.bronze}/{_entry_name(table)}"

    def silver_path(self, table: str) -> str:
        return f"{self.silver}/{_entry_name(table)}"


def _entry_name(table: str) -> str:
    if not table or "/" in table or table in (".", ".."):
        raise ValueError(f"{table!r} cannot name one entry of a layer directory")
    return table
