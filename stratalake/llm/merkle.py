"""Document fingerprints: Merkle trees over leaves, paragraphs and sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import let

#: A paragraph's leaves: 8, 8 and 16 code points, then 32 each, so that short paragraphs have several too.
FIRST_LEAVES, LATER_LEAF = [(1, 8), (9, 8), (17, 16)], r"[\s\S]{1,32}"
#: Documents in a bucket of ids, about, and the most buckets there are.
BUCKET_ROWS, MAX_BUCKETS = 1000, 16_384


def fingerprint(text: Column) -> Column:
    """`<root>:<tree>`, the root of a text's tree and the leaf hashes from which all other nodes follow.

    Paragraphs are lines. A leaf hash is the first 8 digits of its MD5; a paragraph's hash is the MD5 of its leaf hashes,
    joined by `.`; a section's that of its paragraphs' hashes, joined by `,`; the root that of the sections' hashes, joined by
    `;`. A section ends with a paragraph whose hash begins with 0 to 3, so an inserted paragraph changes its own section
    only. In the tree leaves end with `.`, paragraphs with `,` and sections with `;` (but for the last of each). Null is
    taken as empty text.

    Parents are hashed from the cut leaf hashes, as the query's SQL has it: two texts that differ in one leaf have equal
    fingerprints about once in 4 * 10^9 such pairs.
    """

    def leaves(paragraph: Column) -> Column:
        first = F.array(*(F.substring(paragraph, at, n) for at, n in FIRST_LEAVES))
        later = F.regexp_extract_all(F.substr(paragraph, F.lit(33)), F.lit(LATER_LEAF), F.lit(0))
        found = F.concat(F.filter(first, lambda leaf: leaf != ""), later)
        return F.array_join(F.transform(found, lambda leaf: F.substring(F.md5(leaf), 1, 8)), ".")

    def separated(parts: Column, node: Column) -> Column:
        """The nodes of paragraphs with what divides them."""
        ends = F.substring(parts["hash"], 1, 1).isin("0", "1", "2", "3")
        return F.concat(node, F.when(ends, ";").otherwise(","))

    def tree(parts: Column) -> Column:
        hashes = F.array_join(F.transform(parts, lambda p: separated(p, p["hash"])), "")
        sections = F.split(F.left(hashes, F.length(hashes) - 1), ";", -1)
        root = F.md5(F.array_join(F.transform(sections, F.md5), ";"))
        nodes = F.array_join(F.transform(parts, lambda p: separated(p, p["leaves"])), "")
        return F.concat(root, F.lit(":"), F.left(nodes, F.length(nodes) - 1))

    paragraphs = F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), leaves)
    with_hash = F.transform(paragraphs, lambda p: F.struct(p.alias("leaves"), F.md5(p).alias("hash")))
    return let(with_hash, tree)


def _leaf_set(print_: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.substring_index(print_, ":", -1), "[.,;]"), lambda leaf: leaf != ""))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots, else the shared part of all different leaves of both trees (0 to 1)."""

    def share(both: Column) -> Column:
        common = F.size(F.array_intersect(both["a"], both["b"]))
        union = F.size(both["a"]) + F.size(both["b"]) - common
        return F.when(union > 0, common / union).otherwise(0.0)

    same = F.left(a, F.lit(32)) == F.left(b, F.lit(32))
    leaves = F.struct(_leaf_set(a).alias("a"), _leaf_set(b).alias("b"))
    return F.when(same, 1.0).otherwise(let(leaves, share)).cast("double")


def differing_paragraphs(a: Column, b: Column) -> Column:
    """The places (from 0) of paragraphs of tree `a` that tree `b` does not have, by way of the sections that differ."""

    def sections(print_: Column) -> Column:
        return F.split(F.substring_index(print_, ":", -1), ";", -1)

    def places(trees: Column) -> Column:
        other = F.split(F.array_join(F.array_except(trees["b"], trees["a"]), ","), ",", -1)
        own = F.transform(trees["a"], lambda s: F.struct(F.split(s, ",", -1).alias("p"), (~F.array_contains(trees["b"], s)).alias("d")))
        flat = F.flatten(F.transform(own, lambda s: F.transform(s["p"], lambda p: s["d"] & ~F.array_contains(other, p))))
        return F.filter(F.transform(flat, lambda d, at: F.when(d, at)), lambda at: at.isNotNull())

    return let(F.struct(sections(a).alias("a"), sections(b).alias("b")), places)


def _bucket(doc_id: Column, splits: list[int]) -> Column:
    """How many splits are at most the id, by binary search; null ids have the last bucket to themselves."""
    if not splits:
        return F.when(doc_id.isNull(), 1).otherwise(0)
    values = F.split(F.lit(",".join(map(str, splits))), ",").cast("array<bigint>")
    steps = F.array(*(F.lit(1 << k) for k in range(len(splits).bit_length() - 1, -1, -1)))
    found = F.aggregate(
        steps, F.lit(0), lambda low, step: F.when(F.get(values, low + step - 1) <= doc_id, low + step).otherwise(low)
    )
    return F.when(doc_id.isNull(), len(splits) + 1).otherwise(found)


def with_next(docs: DataFrame, *also: str) -> DataFrame:
    """Documents (doc_id, text) with `next_<c>` for text and `also`: those columns of the next document by ascending id.

    After the last comes the first. Rows of one id follow each other by their texts; null ids come last. No task sees
    all rows: ids are cut into buckets of about `BUCKET_ROWS` rows, and each bucket gets a copy of the next one's first row.
    One shuffle of the rows.
    """
    columns = ["doc_id", "text", *also]
    n = docs.select("doc_id").count()
    buckets = min(MAX_BUCKETS, -(-n // BUCKET_ROWS))
    shares = [k / buckets for k in range(1, buckets)]
    splits = docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 4 * buckets))).first()[0] if shares else []
    dealt = docs.select(*columns).withColumn("bucket", _bucket(F.col("doc_id"), sorted(set(splits or []))))

    first_ids = dealt.groupBy("bucket").agg(F.min("doc_id").alias("doc_id")).alias("f")
    d = dealt.alias("d")
    same = (F.col("d.bucket") == F.col("f.bucket")) & F.col("d.doc_id").eqNullSafe(F.col("f.doc_id"))
    rows = d.join(F.broadcast(first_ids), same, "left_semi")
    firsts = rows.groupBy("bucket").agg(F.min(F.struct("text", *also)).alias("row"))
    round_ = Window.orderBy("bucket")  # one row for each bucket
    order = first_ids.select("bucket").select(
        F.col("bucket").alias("to"),
        F.lead("bucket").over(round_).alias("bucket"),
        F.first("bucket").over(round_.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("start"),
    )
    order = order.select("to", F.coalesce("bucket", "start").alias("bucket"))
    copies = firsts.join(F.broadcast(order), "bucket").select(
        F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), "row.*", F.col("to").alias("bucket"), F.lit(True).alias("copy")
    )
    turn = Window.partitionBy("bucket").orderBy("copy", F.col("doc_id").asc_nulls_last(), "text")
    together = dealt.withColumn("copy", F.lit(False)).unionByName(copies)
    nexts = [F.lead(c).over(turn).alias(f"next_{c}") for c in ("text", *also)]
    return together.select(*columns, "copy", *nexts).where("not copy").drop("copy")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of texts (doc_id, text) and of their edited texts, and how alike they are.

    The edited text has its last floor(n_chars / 4) code points replaced by as many first ones (or all) of the next
    document by ascending id (see `with_next`). Returns doc_id, n_chars, edited, fingerprint, edited_fingerprint and the
    likeness of the fingerprint to the edited text's (near_edited) and to the next document's (near_next).

    Null text is empty; an empty text stays empty when edited, and equal texts, empty ones too, have equal fingerprints.
    A single document is its own next. Rows are kept one by one, also where they repeat. An empty table gives no rows.
    Other columns are left out.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(docs.withColumn("fingerprint", fingerprint(F.col("text"))), "fingerprint")
    n, cut = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.left("text", n - cut), F.left("next_text", cut))
    marked = rows.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        "fingerprint",
        "next_fingerprint",
        let(edited, lambda e: F.struct(e.alias("text"), fingerprint(e).alias("print"))).alias("edited"),
    )
    return marked.select(
        "doc_id",
        "n_chars",
        F.col("edited.text").alias("edited"),
        "fingerprint",
        F.col("edited.print").alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited.print")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
