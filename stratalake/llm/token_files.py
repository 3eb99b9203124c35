"""Token ids of documents as Arrow files of equal-length sequences with masks."""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.arrow_words import SpacedWords, slices, texts

#: Lower-case letters whose UTF-8 a tokenizer neither composes nor splits, and ASCII punctuation after them.
PLAIN_WORD = re.compile(r"([a-zß-öø-ÿ]*)([!-/:-@\[-`{-~]*)")
#: Bytes of text whose different words are looked up together: the larger, the fewer words come up again.
SLICE_BYTES = 16 << 20
#: Sequences in a record batch.
BATCH_SEQUENCES = 1024


def byte_letters() -> dict[int, str]:
    """The letters byte-level vocabularies write for bytes: visible Latin-1 stands for itself, the others follow U+0100."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordTokenizer:
    """A public word-level tokenizer file, asked once for each different word of a slice of texts.

    This holds for vocabularies that drop white space and never join what it divides (`word_bpe`). Plain words go to the
    merge model at once, all others through the whole tokenizer. Pieces are kept between slices, up to a limit.
    """

    KEPT = 300_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.wide = self.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16
        self.letters = byte_letters()
        self.pieces: dict[str, list[int]] = {}

    def _piece(self, piece: str) -> list[int]:
        if not piece:
            return []
        if (ids := self.pieces.get(piece)) is None:
            as_letters = piece if piece.isascii() else "".join(map(self.letters.get, piece.encode()))
            ids = [t.id for t in self.model.tokenize(as_letters)]
            if len(self.pieces) >= self.KEPT:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids

    def _word(self, word: str) -> list[int]:
        if plain := PLAIN_WORD.fullmatch(word.lower()):
            head, tail = plain.groups()
            return self._piece(head) + self._piece(tail)
        # as written: special tokens are told by case, and some letters compose with a mark in one case only
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def encode(self, rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, and how many each text has."""
        words = SpacedWords(rows)
        each = [self._word(w) for w in words.distinct]
        sizes = np.fromiter(map(len, each), np.int64, len(each))
        flat = np.fromiter(chain.from_iterable(each), np.uint32, int(sizes.sum()))
        begins = np.cumsum(sizes) - sizes
        here = sizes[words.codes]
        ends = np.cumsum(here)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(begins[words.codes] - (ends - here), here) + np.arange(total)
        counts = np.bincount(words.rows_of, weights=here, minlength=len(rows)).astype(np.int64)
        return flat[at], counts


@lru_cache(maxsize=1)
def word_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of a worker process, which keeps it and its pieces from task to task."""
    return WordTokenizer(path)


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _schema(length: int, wide: bool) -> pa.Schema:
    kind = pa.uint32() if wide else pa.uint16()
    return pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])


INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class _Sequences:
    """Packs ids one after the other into sequences and writes full record batches; the last sequence is padded."""

    def __init__(self, sink, length: int, wide: bool):
        self.schema, self.length = _schema(length, wide), length
        self.dtype = np.uint32 if wide else np.uint16
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids.astype(self.dtype))
        self.n_waiting += len(ids)
        full = self.length * BATCH_SEQUENCES
        if self.n_waiting >= full:
            ids = np.concatenate(self.waiting)
            cut = len(ids) // full * full
            for at in range(0, cut, full):
                self._write(ids[at : at + full], full)
            self.waiting, self.n_waiting = [ids[cut:]], len(ids) - cut

    def _write(self, ids: np.ndarray, valid: int) -> None:
        mask = np.arange(len(ids)) < valid
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask)]
        self.writer.write_batch(pa.record_batch(arrays, schema=self.schema))

    def close(self) -> None:
        if self.n_waiting:
            ids = np.concatenate(self.waiting)
            self._write(np.pad(ids, (0, -len(ids) % self.length)), len(ids))
        self.writer.close()


@dataclass(frozen=True)
class Shards:
    """What was written: for each shard in doc_id order, its files' common prefix and the ids before it."""

    folder: str
    names: list[str]
    starts: list[int]


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1, length: int = 1024
) -> Shards:
    """Writes the ids of all documents (doc_id, text), each with the end id after it, in ascending doc_id order.

    Every shard (a range of doc_ids) is an Arrow file `<shard>.ids.arrow` with record batches of `BATCH_SEQUENCES` rows (ids,
    mask), both lists of fixed size `length`: sequence i lies in batch i div 1024 at row i mod 1024 and is read without
    copying from a mapped file. Documents follow each other without gaps, also across sequences; the mask is false on the
    padding after a shard's last id. `<shard>.docs.arrow` tells where in its shard each document begins and how many ids
    it has. Ids are 16 bits wide if the vocabulary allows it.

    Null and empty text gives the end id alone. Null doc_ids come first; equal doc_ids stand together in the order of
    their texts. Without documents no shard is written. Other columns are left out.

    One range shuffle of the texts; tasks stream their documents and hold one batch. A task writes under names of its own
    and renames at its end, so a repeated or lost task leaves whole files only. The driver gets one row for each shard.
    """

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name, own = f"{part:06d}", uuid.uuid4().hex
        system, root = _file_system(folder)
        tokenizer = word_tokenizer(tokenizer_path)
        temporary = {kind: f"{root}/_{name}-{own}.{kind}" for kind in ("ids", "docs")}
        with system.open_output_stream(temporary["ids"]) as ids_sink, system.open_output_stream(temporary["docs"]) as docs_sink:
            sequences, index = _Sequences(ids_sink, length, tokenizer.wide), pa.ipc.new_file(docs_sink, INDEX)
            n_docs = n_tokens = 0
            for batch in batches:
                for piece in slices(batch, most=SLICE_BYTES):
                    ids, counts = tokenizer.encode(texts(piece))
                    ends = np.cumsum(counts)
                    ids = np.insert(ids, ends, end_id)  # after each document
                    counts = counts + 1
                    starts = n_tokens + np.cumsum(counts) - counts
                    index.write_batch(
                        pa.record_batch([piece.column("doc_id").cast(pa.int64()), pa.array(starts), pa.array(counts)], schema=INDEX)
                    )
                    sequences.add(ids)
                    n_docs, n_tokens = n_docs + len(counts), n_tokens + len(ids)
            sequences.close()
            index.close()
        if n_docs:
            for kind, path in temporary.items():
                system.move(path, f"{root}/{name}.{kind}.arrow")
            yield pa.record_batch([pa.array([name]), pa.array([n_tokens])], names=["name", "n_tokens"])
        else:
            for path in temporary.values():
                system.delete_file(path)

    dealt = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    shards = sorted(dealt.mapInArrow(write, "name string, n_tokens long").collect())
    starts = np.cumsum([0, *(s["n_tokens"] for s in shards)])[:-1].tolist()
    return Shards(folder, [s["name"] for s in shards], starts)


class SequenceFile:
    """Random access to the sequences of one file; a local file is mapped, and what it gives shares its memory."""

    def __init__(self, uri: str):
        system, path = _file_system(uri)
        source = pa.memory_map(path) if system.type_name == "local" else system.open_input_file(path)
        self.reader = pa.ipc.open_file(source)
        last = self.reader.num_record_batches - 1
        self.n_sequences = last * BATCH_SEQUENCES + len(self.reader.get_batch(last)) if last >= 0 else 0

    def __len__(self) -> int:
        return self.n_sequences

    def __getitem__(self, at: int) -> tuple[np.ndarray, pa.Array]:
        """The ids (no copy) and the mask of a sequence."""
        batch = self.reader.get_batch(at // BATCH_SEQUENCES)
        ids, mask = (batch.column(k)[at % BATCH_SEQUENCES].values for k in ("ids", "mask"))
        return ids.to_numpy(zero_copy_only=True), mask

    def batches(self) -> Iterator[np.ndarray]:
        """The ids under the mask, batch by batch."""
        for k in range(self.reader.num_record_batches):
            batch = self.reader.get_batch(k)
            ids = batch.column("ids").flatten().to_numpy(zero_copy_only=True)
            mask = batch.column("mask").flatten().to_numpy(zero_copy_only=False)
            yield ids if mask.all() else ids[mask]


def read_token_files(spark: SparkSession, shards: Shards, end_id: int = 1) -> DataFrame:
    """What the files hold: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (as 32-bit words).

    One task reads one shard, batch by batch; it fails if a document does not end with the end id or ids are left over.
    """
    names, starts, folder = shards.names, shards.starts, shards.folder

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                yield from one(shard)

    def one(shard: int) -> Iterator[pa.RecordBatch]:
        prefix = f"{folder}/{names[shard]}"
        system, path = _file_system(f"{prefix}.docs.arrow")
        ids = SequenceFile(f"{prefix}.ids.arrow").batches()
        waiting = np.empty(0, np.uint32)
        with system.open_input_file(path) as source:
            index = pa.ipc.open_file(source)
            for k in range(index.num_record_batches):
                batch, sums = index.get_batch(k), []
                for n in batch.column("n_tokens").to_pylist():
                    while len(waiting) < n:
                        waiting = np.concatenate([waiting, next(ids).astype("<u4")])
                    document, waiting = waiting[:n], waiting[n:]
                    if document[-1] != end_id:
                        raise ValueError(f"{prefix}: a document does not end where the index says")
                    sums.append(zlib.crc32(document.tobytes()))
                begins = batch.column("start").to_numpy() + starts[shard]
                yield pa.record_batch(
                    [batch.column("doc_id"), pa.array(begins), batch.column("n_tokens"), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )
        if len(waiting) or next(ids, None) is not None:
            raise ValueError(f"{prefix}: ids after the last document")

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return spark.range(0, len(names), 1, max(1, len(names))).mapInArrow(read, schema)
