"""Finds benchmark passages in documents by exact word windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import ascii_lower, let, scratch

#: Words of lower-cased text, and the same before A to Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Windows that may be broadcast, some 200 MB of them; more are joined by a shuffle.
MAX_BROADCAST_WINDOWS = 1_000_000


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def _windows(words: Column, size: int) -> Column:
    """The hash of each run of so many words, by where it starts."""
    count = F.size(words) - size + 1
    return F.when(
        count > 0, F.transform(F.sequence(F.lit(1), count), lambda at: F.xxhash64(F.slice(words, at, F.lit(size))))
    ).otherwise(F.array().cast("array<bigint>"))


def benchmark_windows(items: DataFrame, size: int = 10) -> DataFrame:
    """The different windows of benchmark items (item_id, text): h, window (words), k (how many), items.

    An item of fewer words is one window, one without words or with null text has none. A null item_id is shown as `null`.
    """

    def runs(words: Column) -> Column:
        k = F.least(F.size(words), F.lit(size))
        starts = F.when(k > 0, F.sequence(F.lit(1), F.size(words) - k + 1))
        return F.transform(starts, lambda at: F.slice(words, at, k))

    item = F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item")
    each = items.select(item, F.explode(let(words_of(F.col("text")), runs)).alias("window"))
    return each.groupBy("window").agg(F.collect_set("item").alias("items")).select(
        F.xxhash64("window").alias("h"), "window", F.size("window").alias("k"), "items"
    )


def _merged(spans: Column) -> Column:
    """Spans in order, those that overlap or touch as one, and how many words they cover."""
    words = F.array_sort(F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["end"] - 1)))))

    def runs(words: Column) -> Column:
        def edges(step: int) -> Column:  # words without a neighbour on that side
            edge = lambda w, at: F.get(words, at + step).isNull() | (F.get(words, at + step) != w + step)
            return F.filter(words, edge)

        span = lambda a, b: F.struct(a.alias("start"), (b + 1).alias("end"))
        return F.struct(F.zip_with(edges(-1), edges(1), span).alias("spans"), F.size(words).alias("n_hit"))

    return let(words, runs)


def _hits(docs: DataFrame, items: DataFrame, size: int, max_broadcast: int) -> DataFrame | None:
    """One row for each different document (doc_id, text_hash) with hits: hit (spans, n_hit) and items."""
    docs = docs.select("doc_id", "text")
    windows = scratch(benchmark_windows(items, size), "windows")
    sizes = {row["k"]: row["n"] for row in windows.groupBy("k").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    keys = [F.col("doc_id"), _text_hash()]
    few = sum(sizes.values()) <= max_broadcast
    lookup = F.broadcast(windows) if few else windows.hint("merge")

    # the hashes of all window sizes in one array; where those of a size begin follows from the number of words
    def hashed(words: Column) -> Column:
        return F.struct(words.alias("words"), F.concat(*(_windows(words, k) for k in sorted(sizes))).alias("hashes"))

    scanned = docs.where(F.col("text").isNotNull()).select(*keys, let(words_of(F.col("text")), hashed).alias("seen"))
    exploded = scanned.select("doc_id", "text_hash", "seen.words", F.posexplode("seen.hashes").alias("at", "h"))
    begin = reduce(
        lambda rest, k: F.when(
            F.col("k") > k, F.greatest(F.size("words") - k + 1, F.lit(0))
        ).otherwise(0) + rest,
        sorted(sizes),
        F.lit(0),
    )
    found = exploded.join(lookup, "h")
    start = F.col("at") - begin + 1
    hits = found.where(F.when(start > 0, F.slice("words", start, F.col("k")) == F.col("window"))).select(
        "doc_id", "text_hash", F.struct(start.alias("start"), (start + F.col("k")).alias("end")).alias("span"), "items"
    )
    return hits.groupBy("doc_id", "text_hash").agg(
        _merged(F.collect_set("span")).alias("hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )


def hit_spans(docs: DataFrame, items: DataFrame, size: int = 10, max_broadcast: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """Where documents hold benchmark items, by the rules of `contamination`: doc_id, n_words, n_hit, spans, items.

    A span is a struct (start, end) of word numbers, the first word being 1 and the end not in it. Spans that overlap or
    touch are one, in ascending order; a document without hits has none.
    """
    hits = _hits(docs, items, size, max_broadcast)
    n_words = F.coalesce(F.regexp_count("text", F.lit(ANY_CASE_WORD)), F.lit(0)).cast("long").alias("n_words")
    documents = docs.select("doc_id", _text_hash(), n_words)
    no_spans, no_items = F.array().cast("array<struct<start: int, end: int>>"), F.array().cast("array<string>")
    if hits is None:
        return documents.select(
            "doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), no_spans.alias("spans"), no_items.alias("items")
        )
    d, h = documents.alias("d"), hits.alias("h")
    joined = d.join(h, F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.text_hash") == F.col("h.text_hash")), "left")
    return joined.select(
        "d.doc_id",
        "d.n_words",
        F.coalesce("h.hit.n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("h.hit.spans", no_spans).alias("spans"),
        F.coalesce("h.items", no_items).alias("items"),
    )


def contamination(docs: DataFrame, items: DataFrame, size: int = 10, max_broadcast: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """What benchmark items (item_id, text) documents (doc_id, text) hold.

    Every window of `size` words of a document is looked up by its hash in the set of benchmark windows, and its words
    are then compared. The set is broadcast if it has at most `max_broadcast` windows and joined by hash otherwise, with
    the same result. Returns for each document doc_id, n_words, n_hit (words inside any occurrence), items (those found,
    sorted as strings) and contaminated.

    Null and empty text has no words and no hits. Each row is a document, also where rows repeat; a null doc_id is one
    like any other. An item that occurs twice counts once. Without documents there are no rows, without items no hits.
    Other columns of both tables are left out.

    Texts are not shuffled: windows meet the broadcast set where they are made, and only hits go on.
    """
    found = hit_spans(docs, items, size, max_broadcast)
    return found.select("doc_id", "n_words", "n_hit", "items", (F.col("n_hit") > 0).alias("contaminated"))


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the words of the spans and what stands between them; all else stays as it is."""

    def cut(parts: Column) -> Column:
        between, spans = parts["between"], parts["spans"]  # before each word and after the last
        begins = F.concat(F.array(F.lit(1)), F.transform(spans, lambda s: s["end"]))
        ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.size(between)))
        kept = F.zip_with(
            begins, ends, lambda a, b: F.concat(F.array_join(F.slice(parts["units"], a, b - a), ""), F.get(between, b - 1))
        )
        return F.array_join(kept, "")

    def with_units(parts: Column) -> Column:
        before = F.slice(parts["between"], F.lit(1), F.size(parts["words"]))
        units = F.zip_with(before, parts["words"], lambda sep, word: F.concat(sep, word))
        return let(F.struct(parts["between"].alias("between"), units.alias("units"), spans.alias("spans")), cut)

    words = F.regexp_extract_all(text, F.lit(ANY_CASE_WORD), F.lit(0))
    split = F.struct(F.split(text, ANY_CASE_WORD, -1).alias("between"), words.alias("words"))
    return F.when(F.size(spans) > 0, let(split, with_units)).otherwise(text)


def decontaminate(
    docs: DataFrame, items: DataFrame, size: int = 10, max_broadcast: int = MAX_BROADCAST_WINDOWS, whole: bool = False
) -> DataFrame:
    """The documents, all columns, with texts that have lost the spans that `hit_spans` finds; `whole` drops such documents.

    Each row is judged by its own text, also where doc_ids repeat or are null. Null texts stay null. Spans are looked for
    once: a window that only arises where a span was cut out is not. Texts are shuffled only if the hits are too many to
    be broadcast.
    """
    hits = _hits(docs, items, size, max_broadcast)
    if hits is None:
        return docs
    same = F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.xxhash64(F.coalesce("d.text", F.lit(""))) == F.col("h.text_hash"))
    d, h = docs.alias("d"), hits.alias("h")
    if whole:
        return d.join(h, same, "left_anti")
    text = without_spans(F.col("d.text"), F.coalesce("h.hit.spans", F.array().cast("array<struct<start: int, end: int>>")))
    return d.join(h, same, "left").select(*(text.alias(c) if c == "text" else F.col(f"d.`{c}`") for c in docs.columns))
