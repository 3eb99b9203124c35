"""Cuts files at the true ends of their records, where a line or a brace may also lie inside a value.

A file is read in blocks by many tasks, as units that end at a separator (lines, or texts up to a closing brace). Whether
a unit ends a record depends on all that comes before it. So each block is first run from every state it may begin in;
those runs, one short row for each block, are composed in the order of the file; then every block is cut from the state
it really begins in. A record that lies across blocks is put together from one fragment in each of them.
"""

from __future__ import annotations

import ast
from collections.abc import Hashable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.plans.sizing import session_like

#: Bytes that one task reads.
BLOCK_BYTES = 64 * 1024 * 1024


class NotCut(ValueError):
    """The files cannot be cut with certainty."""


class Machine(Protocol):
    """Tells which units end a record.

    ``separator`` ends a unit and ``closing`` is the part of it that belongs to the record. ``names`` are the columns of
    ``codes``, whole numbers that say what matters of a unit. Records end where the state is ``between`` them.
    """

    separator: str
    closing: str
    names: Sequence[str]
    starts: Sequence[Hashable]

    def codes(self, value: Column) -> Sequence[Column]: ...

    def run(self, codes: Sequence[Sequence[int]], state: Hashable, ends: list[bool] | None = None) -> Hashable:
        """The state after some units; ``ends`` gets for each unit whether it ended a record."""

    def between(self, state: Hashable) -> bool: ...

    def summary(self, codes: Sequence[Sequence[int]], run: Hashable) -> Hashable:
        """A run from one of ``starts`` (or what was summed up so far) and some more units."""

    def compose(self, state: Hashable, runs: Sequence[Hashable]) -> tuple[Hashable, bool]:
        """The state after a block and whether a record ended in it, from the runs of all ``starts``."""


@dataclass(frozen=True)
class Block:
    """One block's runs; its first and last unit's codes, and the largest and the sum of each code; the bytes of its file."""

    start: int
    runs: Sequence[Hashable]
    first: Sequence[int]
    last: Sequence[int]
    most: Sequence[int]
    total: Sequence[int]
    file_bytes: int


@dataclass(frozen=True)
class Begin:
    """How a block begins: the state, whether between records, and the block in which its open record began."""

    state: Hashable
    between: bool
    owner: int


def units(spark: SparkSession, path: str, machine: Machine, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The files' units, in order within their block: file, block (its first byte), value, and the machine's codes.

    The size of the blocks does not follow the number of executors, so each read has the same ones.
    """
    size = str(block_bytes)
    session = session_like(spark, {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": size})
    lines = session.read.option("lineSep", machine.separator).text(path)
    codes = [code.cast("int").alias(name) for name, code in zip(machine.names, machine.codes(F.col("value")), strict=True)]
    place = {"file": "file_path", "block": "file_block_start", "file_bytes": "file_size"}
    return lines.select(*(F.col(f"_metadata.{field}").alias(name) for name, field in place.items()), "value", *codes)


def _by_block(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Batches cut where another block begins; the rows of a block follow each other."""
    for batch in batches:
        blocks, files = batch.column("block").to_numpy(), batch.column("file").dictionary_encode()
        of_file = files.indices.to_numpy()
        changes = (np.flatnonzero((blocks[1:] != blocks[:-1]) | (of_file[1:] != of_file[:-1])) + 1).tolist()
        for start, stop in zip([0, *changes], [*changes, len(blocks)], strict=True):
            if stop > start:
                yield (batch.column("file")[start].as_py(), int(blocks[start])), batch.slice(start, stop - start)


def scan(rows: DataFrame, machine: Machine) -> dict[str, list[Block]]:
    """Each file's blocks in order. The driver gets a few numbers for each block."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block = None, None

        def row() -> pa.RecordBatch:
            return pa.record_batch([pa.array([now[0]]), pa.array([now[1]]), pa.array([repr(block)])], names=["file", "block", "found"])

        for at, piece in _by_block(batches):
            codes = [piece.column(name).to_pylist() for name in machine.names]
            if at != now:
                if now:
                    yield row()
                now = at
                block = [list(machine.starts), [c[0] for c in codes], None, [c[0] for c in codes], [0] * len(codes), piece.column("file_bytes")[0].as_py()]
            block[0] = [machine.summary(codes, run) for run in block[0]]
            block[2] = [c[-1] for c in codes]
            block[3] = [max(x, *c) if len(c) > 1 else max(x, c[0]) for x, c in zip(block[3], codes, strict=True)]
            block[4] = [x + sum(c) for x, c in zip(block[4], codes, strict=True)]
        if now:
            yield row()

    found = rows.select("file", "block", "file_bytes", *machine.names).mapInArrow(work, "file string, block long, found string")
    files: dict[str, list[Block]] = {}
    for r in sorted(found.collect(), key=lambda r: (r["file"], r["block"])):
        files.setdefault(r["file"], []).append(Block(r["block"], *ast.literal_eval(r["found"])))
    return files


def _unended(blocks: Sequence[Block]) -> int:
    """1 if a file ends without a separator, 0 if with one; something else if its bytes are not those on disk (compressed)."""
    return sum(block.total[-1] for block in blocks) - blocks[0].file_bytes


def prefix_scan(blocks: Sequence[Block], machine: Machine, state: Hashable) -> tuple[dict[int, Begin], Hashable]:
    """How each block of a file that begins in ``state`` begins, and the state at the file's end."""
    begins: dict[int, Begin] = {}
    between, owner = True, 0
    for block in blocks:
        begins[block.start] = Begin(state, between, block.start if between else owner)
        state, ended = machine.compose(state, block.runs)
        owner = block.start if between or ended else owner
        between = machine.between(state)
    return begins, state


def cut_records(rows: DataFrame, machine: Machine, begins: dict[str, dict[int, Begin]]) -> DataFrame:
    """The files' records: file, block and place (the first record of a file has 0 and 0), value.

    What comes after a file's last record is a row too, with ``ended`` false. Whole records come straight from the task that reads
    their block; of the others one fragment for each block they touch is shuffled, which takes a second read.
    """
    shared = rows.sparkSession.sparkContext.broadcast(begins)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = begin = state = None
        held: list[str] = []  # units of the open record
        number, own = 0, False  # of the open record; whether it began in this block

        def out(owners: list[int], places: list[int], ended: list[bool], whole: list[bool], values: pa.Array) -> pa.RecordBatch:
            n = len(owners)
            columns = [pa.array([now[0]] * n), pa.array([now[1]] * n), pa.array(owners), pa.array(places), pa.array(ended), pa.array(whole)]
            return pa.record_batch([*columns, values], names=["file", "block", "owner", "place", "ended", "whole", "value"])

        def rest() -> Iterator[pa.RecordBatch]:
            if held:
                place = (now[1], number) if own else (begin.owner, -1)
                yield out([place[0]], [place[1]], [False], [False], pa.array([machine.separator.join(held)], pa.string()))

        for at, piece in _by_block(batches):
            if at != now:
                if now:
                    yield from rest()
                now, begin, held, number = at, shared.value[at[0]][at[1]], [], 0
                state, own = begin.state, begin.between
            ends: list[bool] = []
            state = machine.run([piece.column(name).to_pylist() for name in machine.names], state, ends)
            stops, values = np.flatnonzero(ends) + 1, piece.column("value")
            if not len(stops):
                held += values.to_pylist()
                continue
            # the open record, then those that begin and end here
            head = machine.separator.join([*held, *values.slice(0, int(stops[0])).to_pylist()]) + machine.closing
            owners, places, whole, texts = [now[1] if own else begin.owner], [number if own else -1], [own], [pa.array([head], pa.string())]
            number, own = number + own, True
            if (n := len(stops) - 1) > 0:
                offsets = pa.array((stops - stops[0]).astype(np.int32))
                inner = pc.binary_join(pa.ListArray.from_arrays(offsets, values.slice(int(stops[0]), int(stops[-1] - stops[0]))), machine.separator)
                texts.append(pc.binary_join_element_wise(inner, machine.closing, "").cast(pa.string()))
                owners += [now[1]] * n
                places += range(number, number + n)
                whole += [True] * n
                number += n
            held = values.slice(int(stops[-1])).to_pylist()
            yield out(owners, places, [True] * len(owners), whole, pa.concat_arrays(texts))
        if now:
            yield from rest()

    parts = rows.select("file", "block", "value", *machine.names).mapInArrow(
        work, "file string, block long, owner long, place long, ended boolean, whole boolean, value string"
    )
    fragments = parts.where("not whole").groupBy("file", "owner").agg(
        F.max("place").alias("place"), F.max("ended").alias("ended"), F.sort_array(F.collect_list(F.struct("block", "value"))).alias("parts")
    )
    joined = F.array_join(F.col("parts.value"), machine.separator)
    columns = ["file", F.col("owner").alias("block"), "place", "ended"]
    return parts.where("whole").select(*columns, "value").unionByName(fragments.select(*columns, joined.alias("value")))


# Parts of a CSV line. A field has no quotes, or is quoted from first to last character with doubled quotes inside. A
# carriage return comes at the end of the line only. Possessive quantifiers take no stack, however long the line.
_INSIDE = r'(?:[^"\r]|"")*+'
_FIELD = rf'(?:"{_INSIDE}"|[^",\r\uFEFF]*+)'
_OPENS = rf'"{_INSIDE}\r?\z'
# What a line may be that begins between records (a record; one that goes on), and inside a quoted value (still inside;
# the record's end; another value that goes on).
RECORD = rf"^(?![\x00-\x20]+\z)(?!\x00){_FIELD}(?:,{_FIELD})*+\r?\z"
RECORD_OPENS = rf"^(?!\x00)(?:{_FIELD},)*+{_OPENS}"
GOES_ON = rf"^{_INSIDE}\r?\z"
RECORD_ENDS = rf'^{_INSIDE}"(?:,{_FIELD})*+\r?\z'
OPENS_AGAIN = rf'^{_INSIDE}"(?:,{_FIELD}(?=,))*+,{_OPENS}'

BETWEEN, QUOTED, UNSURE = 0, 1, 2


class QuotedLines:
    """Lines of CSV with doubled quotes; quoted values may hold line breaks. What other quoting may mean is not sure."""

    separator, closing, names, starts = "\n", "", ("code", "returns", "blank", "bytes"), (BETWEEN, QUOTED)
    _after = tuple((code // 3, code % 3, UNSURE) for code in range(9))

    def codes(self, value: Column) -> Sequence[Column]:
        blank, returns = value.isin("", "\r"), value.contains("\r")
        first = F.when(blank | value.rlike(RECORD), BETWEEN).when(value.rlike(RECORD_OPENS), QUOTED).otherwise(UNSURE)
        quoted = (
            F.when(value.rlike(GOES_ON), QUOTED).when(value.rlike(RECORD_ENDS), BETWEEN).when(value.rlike(OPENS_AGAIN), QUOTED).otherwise(UNSURE)
        )
        plain = ~value.contains('"') & ~returns & value.rlike(r"^[^\x00-\x20\uFEFF][^\uFEFF]*+\z")
        code = F.when(~F.is_valid_utf8(value), 3 * UNSURE + UNSURE).when(plain, 3 * BETWEEN + QUOTED).otherwise(first * 3 + quoted)
        return [code, returns, blank, F.octet_length(value) + 1]

    def run(self, codes, state, ends=None):
        after = self._after
        if ends is None:
            for code in codes[0]:
                state = after[code][state]
        else:
            for code in codes[0]:
                state = after[code][state]
                ends.append(state == BETWEEN)
        return state

    def between(self, state):
        return state == BETWEEN

    def summary(self, codes, run):
        state, ended = run if isinstance(run, tuple) else (run, False)
        ends: list[bool] = []
        state = self.run(codes, state, ends)
        return state, ended or any(ends)

    def compose(self, state, runs):
        if state == UNSURE:
            return UNSURE, False
        return runs[state]


class Documents:
    """JSON documents up to their closing braces, one after the other or as one array; a state is (inside a text, open brackets)."""

    separator, closing, names, starts = "}", "}", ("array", "parity", "outside", "inside", "bytes"), (0, 1)

    def codes(self, value: Column) -> Sequence[Column]:
        plain = F.regexp_replace(value, r"(?s)\\.", "")

        def depth(rest: Column) -> Column:
            bare = F.regexp_replace(rest, r'"[^"]*+(?:"|\z)', "")
            opened, closed = (F.length(bare) - F.length(F.translate(bare, marks, "")) for marks in ("{[", "]"))
            return opened - closed - 1  # the separator closes one

        parity = (F.length(plain) - F.length(F.translate(plain, '"', ""))) % 2
        inside = F.regexp_replace(plain, r'^[^"]*+(?:"|\z)', "")
        # a brace inside a text closes nothing
        after_out = F.when(parity == 1, depth(plain) + 1).otherwise(depth(plain))
        after_in = F.when(parity == 1, depth(inside)).otherwise(depth(inside) + 1)
        return [value.rlike(r"^\s*\[").cast("int"), parity, after_out, after_in, F.octet_length(value) + 1]

    def run(self, codes, state, ends=None):
        inside, depth = state
        for parity, outside, within in zip(*codes[1:4], strict=True):
            depth += within if inside else outside
            inside ^= parity
            if ends is not None:
                ends.append(not inside and depth == 0)
        return inside, depth

    def between(self, state):
        return state == (0, 0)

    def summary(self, codes, run):
        inside, depth, lowest = run if isinstance(run, tuple) else (run, 0, None)
        for parity, outside, within in zip(*codes[1:4], strict=True):
            depth += within if inside else outside
            inside ^= parity
            if not inside and (lowest is None or depth < lowest):
                lowest = depth
        return inside, depth, lowest

    def compose(self, state, runs):
        inside, depth, lowest = runs[state[0]]
        return (inside, state[1] + depth), lowest is not None and state[1] + lowest <= 0


def csv_records(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame | None:
    """The records of CSV files, heads included, as ``cut_records`` gives them; None where quoting leaves a doubt.

    A file whose first line ends with a carriage return may end all its lines so; elsewhere one is a doubt, as are bytes that
    are not UTF-8, a blank line before the head and a quote left open at the end.
    """
    machine = QuotedLines()
    rows = units(spark, path, machine, block_bytes)
    begins = {}
    for file, blocks in scan(rows, machine).items():
        begins[file], end = prefix_scan(blocks, machine, BETWEEN)
        first, last = ({name: codes[k] for k, name in enumerate(machine.names)} for codes in (blocks[0].first, blocks[-1].last))
        returns = any(block.most[1] for block in blocks)
        if end != BETWEEN or first["blank"] or (returns and not first["returns"]) or (last["returns"] and _unended(blocks)):
            return None
    return plain_ends(cut_records(rows, machine, begins))


def plain_ends(records: DataFrame) -> DataFrame:
    """Records without the blank ones; carriage returns go where a line ends, inside values too, as they do in a read of the whole."""
    value = F.regexp_replace(F.regexp_replace("value", r"\r\z", ""), "\r\n", "\n")
    return records.withColumn("value", value).where("value <> ''")


def json_documents(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents of JSON files in a column ``value``, letter by letter but for line breaks, which become blanks.

    Documents are objects and come one after the other, with white space between them, or in one array for each file, with commas; they
    may span lines, and a line may hold many. What else stands between them comes as rows that are no documents. A file that ends
    inside a document, and a line break inside a text, stop the read.
    """
    machine = Documents()
    rows = units(spark, path, machine, block_bytes)
    begins, kinds = {}, []
    for file, blocks in scan(rows, machine).items():
        array, open_end = blocks[0].first[0], _unended(blocks)
        if open_end not in (0, 1):
            raise NotCut(f"{file} is compressed: its documents must be lines, or need a schema")
        begins[file], end = prefix_scan(blocks, machine, (0, -array))
        if end != ((0, -1 - array) if open_end else (0, -array)):
            raise NotCut(f"{file} ends inside a document")
        kinds.append((file, bool(array)))
    files = rows.sparkSession.createDataFrame(kinds, "file string, array boolean")
    found = cut_records(rows, machine, begins).join(files, "file")
    first = (F.col("block") == 0) & (F.col("place") == 0)
    lead = F.when(~F.col("array"), r"^\s*").when(first, r"^\s*\[\s*").otherwise(r"^\s*,\s*")
    bare = F.regexp_replace("value", lead, F.lit(""))
    # what is left after the last document: nothing, or the array's end
    over = ~F.col("ended") & F.col("value").rlike(r"^\s*(?:\[\s*)?\]?\s*\z") & (F.col("array") == F.col("value").contains("]"))
    broken = F.regexp_replace("value", r'"(?:[^"\\\n\r]|\\[^\n\r])*+"', "").contains('"')
    apart = F.col("array") & ~first & F.col("ended") & ~F.col("value").rlike(r"^\s*,")
    whole = F.when(apart, F.raise_error(F.lit("no comma between the documents of a JSON array"))).when(broken, F.raise_error(F.lit("a line break inside a text of a JSON document"))).otherwise(F.regexp_replace(bare, r"[\r\n]", " "))
    return found.where(~over).select("file", "block", "place", whole.alias("value"))
