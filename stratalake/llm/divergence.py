"""How the sources of a language differ in their words: copies collapsed, terms counted once, sparse comparison of pairs."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.arrow_words import slices, texts
from stratalake.llm.common import scratch

#: Shares of a group's words are whole numbers of billionths.
SCALE = 1_000_000_000
#: Counts below this are scaled in 64 bits, larger ones in decimals; the result is the same.
MOST_SCALED = 9_000_000_000
#: Bytes of text whose terms are added up before they leave a task.
SLICE_BYTES = 16 << 20
#: Entries of common terms that a task holds before it adds them up by pair of sources.
HELD_PAIRS = 2_000_000


def _term_bytes() -> np.ndarray:
    """For each byte what stands for it in a term (A to Z lower-cased), 0 if terms end there."""
    kinds = np.zeros(256, np.uint8)
    kinds[65:91] = kinds[97:123] = np.arange(97, 123)
    kinds[128:] = np.arange(128, 256)
    return kinds


def terms_of(rows: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different terms of texts in order, and each occurrence's text and term as numbers, in the order of the texts.

    Terms are the longest runs of ASCII letters and of characters beyond ASCII, A to Z in lower case.
    """
    n = len(rows)
    offsets = np.frombuffer(rows.buffers()[1], np.int32)[rows.offset : rows.offset + n + 1].astype(np.int64)
    data = rows.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    if not len(raw):
        return pa.array([], pa.string()), np.empty(0, np.int64), np.empty(0, np.int64)
    low = _term_bytes()[raw]
    real = low != 0
    first = real.copy()
    first[1:] &= ~real[:-1]
    begins = offsets[:-1][offsets[:-1] < len(raw)]  # a term never goes on in the next text
    first[begins] = real[begins]
    starts = np.flatnonzero(first)
    places = np.cumsum(real)[starts] - 1 if len(starts) else starts
    kept = low[real]
    ends = pa.py_buffer(np.append(places, len(kept)).astype(np.int32))
    encoded = pa.StringArray.from_buffers(len(starts), ends, pa.py_buffer(kept)).dictionary_encode()
    text_of = np.searchsorted(offsets, starts, side="right") - 1
    order = pc.sort_indices(encoded.dictionary)  # neighbours in order compress well on their way
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    return encoded.dictionary.take(order), text_of, rank[encoded.indices.to_numpy(zero_copy_only=False)]


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The different keys and the sums of their values, in whole numbers."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[starts], *(np.add.reduceat(v[order], starts) if len(keys) else v for v in values)


def _collapsed(plain: DataFrame) -> DataFrame:
    """Each different text of a language once, with the sources that have it and how often: lang, text, sources.

    Only the hashes of copies are counted by source; texts are merged in each map task and shuffled once.
    """
    keyed = plain.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit("text"), "text")})
    by_source = keyed.groupBy("lang", "h1", "h2", "source").agg(F.count("*").alias("n"))
    sources = by_source.groupBy("lang", "h1", "h2").agg(F.collect_list(F.struct("source", "n")).alias("sources"))
    once = keyed.groupBy("lang", "h1", "h2").agg(F.first("text").alias("text"))
    return once.join(sources, ["lang", "h1", "h2"]).select("lang", "text", "sources")


def _counted(collapsed: DataFrame) -> DataFrame:
    """lang, source, term, how often it occurs (n) and in how many documents (docs), added up in parts.

    A text is tokenized once; its counts are then multiplied for each source by the copies there.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, most=SLICE_BYTES):
                terms, text_of, codes = terms_of(texts(piece))
                if not len(terms):
                    continue
                width = len(terms)
                pairs, n = _summed(text_of * width + codes, np.ones(len(codes), np.int64))
                text_of, codes = pairs // width, pairs % width

                lists = piece.column("sources")
                entries = lists.flatten()
                held = np.diff(lists.offsets.to_numpy(zero_copy_only=False)).astype(np.int64)
                langs = piece.column("lang").dictionary_encode()
                sources = entries.field("source").dictionary_encode()
                lang_of = np.repeat(langs.indices.to_numpy(zero_copy_only=False).astype(np.int64), held)
                group = lang_of * len(sources.dictionary) + sources.indices.to_numpy(zero_copy_only=False)
                copies = entries.field("n").to_numpy(zero_copy_only=False)

                # each (text, term) once for every source of the text
                many, begin = held[text_of], np.cumsum(held) - held
                row = np.repeat(np.arange(len(pairs)), many)
                within = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                entry = begin[text_of[row]] + within
                keys, n, docs = _summed(group[entry] * width + codes[row], n[row] * copies[entry], copies[entry])
                group_of = keys // width
                yield pa.record_batch(
                    [
                        langs.dictionary.take(pa.array(group_of // len(sources.dictionary))),
                        sources.dictionary.take(pa.array(group_of % len(sources.dictionary))),
                        terms.take(pa.array(keys % width)),
                        pa.array(n),
                        pa.array(docs),
                    ],
                    names=["lang", "source", "term", "n", "docs"],
                )

    parts = collapsed.mapInArrow(work, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column, words: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (words + 2 * kept)), exact at any size."""
    wide = (n + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = words + 2 * kept
    exact = F.call_function("div", wide, below.cast("decimal(20,0)"))
    return 1 + F.when(n < MOST_SCALED, F.call_function("div", F.lit(SCALE) * (n + 2), below)).otherwise(exact)


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _common(entries: DataFrame) -> DataFrame:
    """For each pair of sources (a < b) with common terms: how many (both), and what they add to the sum of one-sided terms.

    Works on the entries of each term, in parts; what leaves a task are sums by pair.
    """
    by_term = entries.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("no", "p", "none"))).alias("found"))

    def difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // (p + q)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            lists = batch.column("found")
            flat = lists.flatten()
            no, p, none = (flat.field(name).to_numpy(zero_copy_only=False) for name in ("no", "p", "none"))
            held = np.diff(lists.offsets.to_numpy(zero_copy_only=False))
            if not len(no):
                continue
            term = np.repeat(np.arange(len(held)), held)
            lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[term]
            width, keys, values = int(no.max()) + 1, [], []

            def sums(width=width, langs=langs, keys=keys, values=values) -> pa.RecordBatch:
                all_keys = np.concatenate(keys)
                key, value, both = _summed(all_keys, np.concatenate(values), np.ones(len(all_keys), np.int64))
                keys.clear()
                values.clear()
                a, b = key // width % width, key % width
                lang = langs.dictionary.take(pa.array(key // (width * width)))
                return pa.record_batch([lang, *map(pa.array, (a, b, value, both))], names=["lang", "a", "b", "value", "both"])

            for step in range(1, int(held.max())):  # each entry with the one so many places after it
                i = np.flatnonzero(term[:-step] == term[step:])
                j = i + step
                keys.append((lang[i] * width + no[i]) * width + no[j])
                values.append(difference(p[i], p[j]) - difference(p[i], none[j]) - difference(none[i], p[j]))
                if sum(map(len, keys)) >= HELD_PAIRS:
                    yield sums()
            if sum(map(len, keys)):
                yield sums()

    parts = by_term.select("lang", "found").mapInArrow(work, "lang string, a long, b long, value long, both long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("both").alias("both"))


def source_divergence(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """How far each source of a language is from every other, and which terms set it apart from the whole language.

    Null text, lang and source of `documents` (text, lang, source) count as empty. A language keeps the terms found in at least
    `min_docs` of its rows. A group (lang, source), and the language as a whole, gives each kept term the share
    p = 1 + floor(10^9 * (n + 2) / (words + 2 * kept terms)), n its occurrences there and words all occurrences of kept terms
    there; two shares are (p - q)^2 / (p + q) apart, rounded down. Returns lang, source, part, item, value, rank: part `pair` has each
    other source of the language with the sum over all kept terms (0 if there are none), part `term` the `top` kept terms
    that the group has with a larger share than the language. Ranks go by value, then item in UTF-8 order.

    Rows count one by one, also where they repeat or have no doc_id. A group without terms takes part with n = 0. A language of one
    source has no pairs. Other columns are left out, whatever their names. An empty table gives no rows. All sums are
    whole numbers; texts are held equal by 128-bit hashes.

    Equal texts of a language are tokenized once and counted for each source as often as they occur there. Pairs are compared
    sparsely: a term that one source alone has adds what depends on its count only, so counts are grouped;
    common terms add their differences from that; terms that neither has add the same each.
    """
    plain = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counts = _counted(_collapsed(plain))
    postings = scratch(
        counts.groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("all"), F.collect_list(F.struct("source", "n")).alias("found"))
        .where(F.col("docs") >= min_docs)
        .select("lang", "term", "all", "found"),
        "divergence-terms",
    )
    found = postings.select("lang", "term", "all", F.explode("found").alias("e")).select("lang", "term", "all", "e.*")

    # one row for each group: its number in the language, its words and terms, those of the language
    present = plain.groupBy("lang", "source").agg(F.count("*").alias("rows"))
    own = found.groupBy("lang", "source").agg(F.sum("n").alias("words"), F.count("*").alias("terms"))
    whole = postings.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("all").alias("lang_words"))
    zero = ["words", "terms", "kept", "lang_words"]
    numbers = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = scratch(
        present.join(own, ["lang", "source"], "left")
        .join(whole, "lang", "left")
        .select("lang", "source", numbers.cast("long").alias("no"), *(F.coalesce(c, F.lit(0)).alias(c) for c in zero))
        .withColumn("none", F.when(F.col("kept") > 0, _share(F.lit(0), F.col("words"), F.col("kept"))).otherwise(1)),
        "divergence-groups",
    )
    shares = found.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("words"), F.col("kept")))
    entries = scratch(
        shares.withColumn("q", _share(F.col("all"), F.col("lang_words"), F.col("kept"))).select(
            "lang", "source", "term", "no", "p", "none", "q"
        ),
        "divergence-shares",
    )

    apart = entries.where("p > q").select("lang", "source", F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = apart.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    a = groups.select("lang", "source", F.col("no").alias("a"), "kept", F.col("terms").alias("ta"), F.col("none").alias("pa"))
    b = groups.select("lang", F.col("source").alias("item"), F.col("no").alias("b"), F.col("terms").alias("tb"), F.col("none").alias("pb"))
    # what the terms of a add while b has none of them: by (group, share), not by term
    shared = entries.groupBy("lang", F.col("no").alias("a"), "p").agg(F.count("*").alias("m"))
    alone = (
        shared.join(b.select("lang", "b", "pb"), "lang")
        .where("a <> b")
        .groupBy("lang", "a", "b")
        .agg(F.sum(F.col("m") * _apart(F.col("p"), F.col("pb"))).alias("alone"))
    )
    back = alone.select("lang", F.col("a").alias("b"), F.col("b").alias("a"), F.col("alone").alias("back"))
    common = scratch(_common(entries), "divergence-common")
    mirrored = common.unionByName(common.select("lang", F.col("a").alias("b"), F.col("b").alias("a"), "value", "both"))
    neither = F.col("kept") - F.col("ta") - F.col("tb") + F.coalesce("both", F.lit(0))
    parts = [F.coalesce(c, F.lit(0)) for c in ("alone", "back", "value")]
    keys = ["lang", "a", "b"]
    pairs = (
        a.join(b, "lang")
        .where("a <> b")
        .join(alone, keys, "left")
        .join(back, keys, "left")
        .join(mirrored, keys, "left")
        .select("lang", "source", "item", (parts[0] + parts[1] + parts[2] + neither * _apart(F.col("pa"), F.col("pb"))).alias("value"))
        .withColumn("rank", F.row_number().over(order))
    )
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.withColumn("part", F.lit("pair")).select(columns).unionByName(terms.withColumn("part", F.lit("term")).select(columns))
    )
