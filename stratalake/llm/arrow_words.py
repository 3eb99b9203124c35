"""Arrow batches of texts as words, a bounded number of bytes at a time; for functions of mapInArrow."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are taken apart at once (or one text, if it is longer).
SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in pieces with at most so many bytes of text, one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(lengths, dtype=np.int64), 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def texts(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    return pc.fill_null(batch.column(column), "")


class SpacedWords:
    """Words of texts (runs without ASCII white space): `codes` into `distinct`, and where each text's words end."""

    def __init__(self, rows: pa.Array):
        split = pc.ascii_split_whitespace(rows)
        encoded = pc.list_flatten(split).dictionary_encode()
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        self.distinct: list[str] = encoded.dictionary.to_pylist()
        codes = encoded.indices.to_numpy(zero_copy_only=False)
        rows_of = np.repeat(np.arange(len(counts), dtype=np.int64), counts)
        if "" in self.distinct:  # at the ends of texts that begin or end with white space
            real = codes != self.distinct.index("")
            codes, rows_of = codes[real], rows_of[real]
        self.codes, self.rows_of = codes, rows_of
        self.counts = np.bincount(rows_of, minlength=len(counts)).astype(np.int64)
        self.ends = np.cumsum(self.counts)
        self.starts = self.ends - self.counts
