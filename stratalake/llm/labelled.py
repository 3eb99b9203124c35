"""Which rows may be learnt from, and bounded samples of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: crc32 of the id as text leaves 2 when divided by 4. A null id is held out too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def bounded(rows: DataFrame, most: int, seed: int = 11) -> DataFrame:
    """About `most` rows (doc_id) chosen by a seeded hash of the id, or all if there are no more."""
    n = rows.count()
    if n <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) < int((1 << 30) * most / n))
