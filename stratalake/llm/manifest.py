"""Merkle manifest of a dataset: nodes as nested intervals of leaf ranks, proofs by containment joins level by level."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import numbered, scratch

FANOUT = 16
#: Ranks that make a bucket when leaves meet the interval of their source.
SPAN = 1 << 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """The lowercase hex SHA-256 of the parts put together."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """A row's digest: each value as its UTF-8 length, a colon and itself, null as a hyphen."""
    texts = [f.cast("string") for f in fields]
    return digest(*(F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of its path."""
    return F.aggregate(path, leaf, lambda own, run: digest(run["left"], own, run["right"]))


def proof(path: Column) -> Column:
    """The digests of all siblings, level by level from the leaf to the root, left to right."""
    return F.array_join(F.transform(path, lambda run: F.concat(run["left"], run["right"])), "")


@dataclass(frozen=True)
class Manifest:
    """A dataset's tree.

    `leaves`: the given rows with `tree` (the first rank of their source), `n` (its leaves), and their interval of ranks.
    `sources[k]`, `top[k]`: nodes k + 1 levels above the leaves and above the sources' roots: tree, n, lo, hi (the interval of
    ranks they cover), digest, children (lo, hi, digest in order). `subroots`: tree, digest, and their interval [lo, hi) among sources.
    """

    leaves: DataFrame
    sources: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]


def _levels(nodes: DataFrame, largest: int, purpose: str) -> list[DataFrame]:
    """The inner nodes above nodes (tree, n, lo, hi, digest), a table for each level; trees stop at their root."""
    levels, width = [], 1
    while width < largest:
        several, width = nodes.where(F.col("n") > width), width * FANOUT
        run = F.call_function("div", F.col("lo") - F.col("tree"), F.lit(width))
        grouped = several.groupBy("tree", "n", run.alias("run")).agg(
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
            F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children"),
        )
        whole = digest(F.array_join(F.col("children.digest"), ""))
        nodes = scratch(grouped.select("tree", "n", "lo", "hi", whole.alias("digest"), "children"), purpose)
        levels.append(nodes)
    return levels


def build(rows: DataFrame) -> Manifest:
    """The tree over rows (source, doc_id, leaf, and any others that stay with their leaf).

    Leaves are ranked by source (null first, UTF-8 order), doc_id (null first), then digest, so that every node of every level
    covers one interval of ranks. Equal rows are leaves of their own. No rows give an empty manifest.
    """
    kept = scratch(rows.withColumn("tie", F.monotonically_increasing_id()), "manifest-rows")
    order = [F.asc_nulls_first("source"), F.asc_nulls_first("doc_id"), F.asc("leaf"), F.asc("tie")]
    ranked = numbered(kept, order, "manifest-ranks", "rank").withColumn("lo", F.col("rank") - 1).drop("rank", "tie")

    # a source covers an interval too; leaves find it in their bucket of ranks, so none meets all its rows in one task
    whole = ranked.groupBy("source").agg(F.min("lo").alias("tree"), F.count("*").alias("n"))
    bucket = [F.call_function("div", at, F.lit(SPAN)) for at in (F.col("tree"), F.col("tree") + F.col("n") - 1, F.col("lo"))]
    spans = whole.withColumn("bucket", F.explode(F.sequence(*bucket[:2]))).withColumnRenamed("source", "of")
    same = (F.col("here") == F.col("bucket")) & F.col("source").eqNullSafe(F.col("of"))
    inside = same & (F.col("tree") <= F.col("lo")) & (F.col("lo") < F.col("tree") + F.col("n"))
    placed = ranked.withColumn("here", bucket[2]).join(spans, inside).drop("here", "bucket", "of")
    leaves = scratch(placed.withColumn("hi", F.col("lo") + 1), "manifest-leaves")

    nodes = leaves.select("tree", "n", "lo", "hi", F.col("leaf").alias("digest"))
    largest = nodes.agg(F.max("n")).first()[0] or 0
    sources = _levels(nodes, largest, "manifest-nodes")
    roots, width = nodes.where("n = 1"), 1
    for level in sources:
        roots = roots.unionByName(level.where((F.col("n") > width) & (F.col("n") <= width * FANOUT)).select(nodes.columns))
        width *= FANOUT
    first = numbered(roots.select("tree", "digest"), [F.asc("tree")], "manifest-roots", "rank")
    subroots = scratch(first.select("tree", "digest", (F.col("rank") - 1).alias("lo"), F.col("rank").alias("hi")), "manifest-subroots")
    n = subroots.count()
    ends = subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(n).cast("long").alias("n"), "lo", "hi", "digest")
    return Manifest(leaves, sources, subroots, _levels(ends, n, "manifest-top"))


def _attached(nodes: DataFrame, above: DataFrame, width: int, gained: Sequence[str]) -> DataFrame:
    """Nodes with what the one node of the next level that contains them has gained, and the run of their siblings first in the path.

    A node of the next level lies in one bucket of `width` ranks of its tree; what its interval has beside the own one, to the left
    and to the right, are the siblings.
    """
    bucket = F.call_function("div", F.col("lo") - F.col("tree"), F.lit(width))
    up = above.select(
        F.col("tree").alias("up_tree"), bucket.alias("up_bucket"), F.col("lo").alias("up_lo"), F.col("hi").alias("up_hi"),
        F.col("children").alias("up_children"), F.col("path").alias("up_path"), *gained,
    )
    inside = (F.col("tree") == F.col("up_tree")) & (F.col("bucket") == F.col("up_bucket"))
    inside &= (F.col("up_lo") <= F.col("lo")) & (F.col("hi") <= F.col("up_hi"))

    def digests(outside) -> Column:
        return F.array_join(F.transform(F.filter("up_children", outside), lambda c: c["digest"]), "")

    run = F.struct(
        digests(lambda c: c["hi"] <= F.col("lo")).alias("left"), digests(lambda c: c["lo"] >= F.col("hi")).alias("right")
    )
    joined = nodes.withColumn("bucket", bucket).join(up, inside)
    return joined.select(*nodes.columns, *gained, F.concat(F.array(run), F.col("up_path")).alias("path"))


def proofs(manifest: Manifest) -> DataFrame:
    """The leaves with `subroot`, `root` and `path`: for each level up to the root the digests left and right of the own node.

    Paths go down from the root: each level's nodes take their parent's, so only the last join touches all leaves.
    """
    empty = F.array().cast("array<struct<left:string,right:string>>")
    ends = manifest.subroots.select(F.lit(0).cast("long").alias("tree"), "lo", "hi", "digest", F.col("tree").alias("source_tree"))
    path, width = None, FANOUT ** len(manifest.top)
    for level in [*reversed(manifest.top), ends]:
        if path is None:
            path = level.withColumns({"root": F.col("digest"), "path": empty})
        else:
            path = _attached(level, path, width, ["root"])
            width //= FANOUT
    tops = path.select(F.col("source_tree").alias("of"), F.col("digest").alias("subroot"), "root", F.col("path").alias("top_path"))

    gained, above, width = ["subroot", "root"], None, FANOUT ** len(manifest.sources)
    for level in [*reversed(manifest.sources), manifest.leaves]:
        root = level.where(F.col("n") <= width).join(tops, F.col("tree") == F.col("of")).drop("of")
        here = root.withColumnRenamed("top_path", "path")
        if above is not None:
            here = here.unionByName(_attached(level.where(F.col("n") > width), above, width * FANOUT, gained))
        above, width = here, width // FANOUT
    return above


def manifest_proofs(docs: DataFrame, changed: dict[str, Column] | None = None) -> DataFrame:
    """Leaf, subroot, root and proof of each row of `documents` (doc_id, source, lang, n_chars, text), and the root that a copy gives.

    `changed` has the columns in which the copy differs; its leaf is folded with the row's own siblings, and `verified` tells whether
    the root comes out. Returns doc_id, leaf, subroot, root, path, folded_root, verified.

    Nulls in any column have digests of their own; null sources are one source, null doc_ids come first in theirs. Rows that share a
    doc_id are ordered by digest; equal rows are all leaves, and which of them has which place cannot be told apart. Other columns
    are neither hashed nor returned. An empty table gives no rows.

    Texts are hashed where they are read and never shuffled.
    """
    copy = {name: F.col(name) for name in FIELDS} | (changed or {})
    rows = docs.select(
        "source",
        "doc_id",
        leaf_digest([F.col(name) for name in FIELDS]).alias("leaf"),
        leaf_digest([copy[name] for name in FIELDS]).alias("copy"),
    )
    found = proofs(build(rows)).withColumn("folded_root", fold(F.col("copy"), F.col("path")))
    verified = (F.col("folded_root") == F.col("root")).alias("verified")
    return found.select("doc_id", "leaf", "subroot", "root", "path", "folded_root", verified)
