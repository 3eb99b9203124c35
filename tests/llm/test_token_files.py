"""Token ids in Arrow files: the tokenizer's own ids, in order, and all of them."""

from __future__ import annotations

import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratalake.checks.workspace import new_folder
from stratalake.llm.token_files import SequenceFile, WordTokenizer, read_token_files, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "it's don't we'll '### a_b", "É É́ é ΑΣ Σ'σ İstanbul K Å", "a<|startoftext|>b <|endoftext|> <|x",
    "x y z\x85w\x1cq", "1234 ½ ² Ⅷ 漢字かな", "ÀÉÿŸ ñandú, straße! ﬁ", "a\x00b\x7f \t\n\x0b\x0c\r end  ", "''s 's 'S 'RE x'",
    "👩‍🔬 ﻿", "word " * 20000, None,
]


def encoded(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [1]


def test_ids_are_those_of_the_whole_tokenizer():
    tokenizer = WordTokenizer(PATH)
    texts = [t or "" for t in ODD]
    ids, counts = tokenizer.encode(pa.array(texts))
    ends = np.cumsum(counts)
    assert [ids[e - c : e].tolist() + [1] for e, c in zip(ends, counts, strict=True)] == [encoded(t) for t in texts]


@pytest.mark.parametrize("text", [
    "<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|startoftext|>", "<|STARTOFTEXT|>", "<|StartOfText|>",
    "A<|EndOfText|>B <|endoftext|>C <|endoftexT|><|endoftext|>", "THE <|STARTOFTEXT|>The<|startoftext|>THE",
    "H\u0331 h\u0331 T\u0308 t\u0308 W\u030a w\u030a Y\u030a y\u030a J\u030c j\u030c I\u0307 i\u0307",
])
def test_case_is_that_of_the_raw_text(text):
    ids, _ = WordTokenizer(PATH).encode(pa.array([text, "Next text"]))
    assert ids.tolist() == encoded(text)[:-1] + encoded("Next text")[:-1]


@pytest.mark.parametrize("length", [8, 1024])
def test_round_trip(spark, length):
    rows = [(i * 3 % 101, t) for i, t in enumerate(ODD)] + [(500 + i, f"doc {i} text") for i in range(40)]
    rows += [(500, "doc 0 text"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("x")).repartition(5)
    folder = new_folder(spark, "tokens")
    shards = write_token_files(docs, folder, PATH, length=length)
    got = read_token_files(spark, shards).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, at = [], 0
    for doc_id, text in order:
        ids = encoded(text)
        want.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    # the files themselves, by random access: shard after shard, the ids under the masks
    stream = []
    for name in shards.names:
        file = SequenceFile(f"{folder}/{name}.ids.arrow")
        for i in range(len(file)):
            ids, mask = file[i]
            assert len(ids) == len(mask) == length
            stream += ids[mask.to_numpy(zero_copy_only=False)].tolist()
    assert stream == [i for _, text in order for i in encoded(text)]
    assert not [p for p in Path(folder.removeprefix("file:")).iterdir() if p.name.startswith("_")]


def test_empty_table(spark):
    shards = write_token_files(spark.createDataFrame([], "doc_id long, text string"), new_folder(spark, "tokens"), PATH)
    assert shards.names == [] and read_token_files(spark, shards).count() == 0
