"""Column references that survive dots, blanks and backticks in names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def columns(df: DataFrame) -> list[Column]:
    return [column(name) for name in df.columns]


def unused(df: DataFrame, name: str) -> str:
    """``name``, drawn out until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def repeated(names: Iterable[str], case_sensitive: bool) -> list[str]:
    """Names that occur more than once under the session's rule for comparing them."""
    seen: set[str] = set()
    again: list[str] = []
    for name in names:
        key = name if case_sensitive else name.lower()
        if key in seen and name not in again:
            again.append(name)
        seen.add(key)
    return again


def is_case_sensitive(df: DataFrame) -> bool:
    return df.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
