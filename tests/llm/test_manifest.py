"""Merkle manifests, against a tree built in Python."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stratalake.llm.manifest import build, manifest_proofs, proof

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    """Each level's digests up to the root."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][at : at + 16]) for at in range(0, len(out[-1]), 16)])
    return out


def run_of(tree, at):
    """For each level the digests left and right of the node above a leaf."""
    for nodes in tree[:-1]:
        start = at // 16 * 16
        yield "".join(nodes[start:at]), "".join(nodes[at + 1 : start + 16])
        at //= 16


def brute(rows, change):
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[1]].append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        by_source[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[name] = levels([leaf_of(r) for r in by_source[name]])
    top = levels([trees[name][-1][0] for name in names])
    out = []
    for k, name in enumerate(names):
        for at, row in enumerate(by_source[name]):
            path = [*run_of(trees[name], at), *run_of(top, k)]
            folded = leaf_of(change(row))
            for left, right in path:
                folded = h(left, folded, right)
            root = top[-1][0]
            out.append((row[0], leaf_of(row), trees[name][-1][0], root, "".join(x + y for x, y in path), folded, folded == root))
    return sorted(out, key=str)


def tampered(row):
    text = row[4]
    return (*row[:4], text.lower() if text is not None and row[0] is not None and row[0] % 5 == 0 else text)


def rows_with(counts):
    rows = []
    for source, n in counts.items():
        rows += [(k * 7 % n + (k // 40) * 1000, source, ["en", None][k % 2], k, [f"Text {k} É", None, ""][k % 3]) for k in range(n)]
    return rows


CASES = [
    {"a": 1},
    {"a": 16, None: 17, "": 3},
    {"a": 300, "b": 1, "é": 2, "z": 257, None: 5},
    {f"s{k:03}": 1 + k % 3 for k in range(40)} | {"big": 500},
]


@pytest.mark.parametrize("counts", CASES)
def test_as_brute_force(spark, counts):
    rows = rows_with(counts)
    rows += [(None, "a", None, None, "no id"), (None, "a", None, None, None), *[(4, "a", "x", 1, "Twice")] * 20, (5, "a", "y", 2, "Long " * 30000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    docs = docs.withColumns({"leaf": F.lit("x"), "tree": F.lit(1), "lo": F.lit(2), "path": F.lit(3), "root": F.lit(4)})
    copy = F.when(F.col("doc_id") % 5 == 0, F.lower("text")).otherwise(F.col("text"))
    got = manifest_proofs(docs, {"text": copy}).withColumn("path", proof(F.col("path")))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "path", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, tampered)


def test_unchanged_rows_verify_and_one_letter_does_not(spark):
    docs = spark.createDataFrame(rows_with({"a": 40, "b": 3}), SCHEMA)
    assert manifest_proofs(docs).where("not verified").count() == 0
    bad = manifest_proofs(docs, {"lang": F.when(F.col("doc_id") == 3, "xx").otherwise(F.col("lang"))})
    assert {r["doc_id"] for r in bad.where("not verified").collect()} == {3}


def test_nodes_cover_intervals_of_ranks(spark):
    tree = build(spark.createDataFrame([(s, k, f"{s}{k}") for s, n in (("a", 300), ("b", 20)) for k in range(n)], "source string, doc_id long, leaf string"))
    for level in [*tree.sources, *tree.top]:
        for node in level.collect():
            spans = [(c["lo"], c["hi"]) for c in node["children"]]
            assert 1 <= len(spans) <= 16 and spans == sorted(spans)
            assert (spans[0][0], spans[-1][1]) == (node["lo"], node["hi"])
            assert all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
    assert [level.count() for level in tree.sources] == [19 + 2, 2 + 1, 1]
    assert sorted((r["tree"], r["lo"], r["hi"]) for r in tree.subroots.collect()) == [(0, 0, 1), (300, 1, 2)]


def test_empty_table(spark):
    got = manifest_proofs(spark.createDataFrame([], SCHEMA))
    assert got.count() == 0 and "verified" in got.columns
