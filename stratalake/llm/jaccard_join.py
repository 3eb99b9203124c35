"""Joins texts with similar sets of word n-grams: rare-first prefixes, length and positional filters, sketches, one check."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stratalake.llm.arrow_words import SLICE_BYTES, SpacedWords, slices, texts
from stratalake.llm.common import batches_of, discard, scratch
from stratalake.llm.components import components

#: Counters of the frequency table (a power of two) and how many of them make a row while they are added up.
COUNTERS, CHUNK = 1 << 20, 1 << 14
#: Cells of the sketches that are compared before whole sets, and the most n-grams of a set for which none overflows.
CELLS, MOST_SKETCHED = 256, (1 << 15) - 1
#: Ids of texts that may be broadcast to fetch their sets, 16 MB of numbers (of text ids an eighth as many); more are
#: joined by a shuffle.
MAX_BROADCAST_IDS = 2_000_000
#: Tokens of at most so many classes have all their pairs filtered at once; larger ones go by pivots.
SMALL_TOKEN = 16
#: Pivot rounds go on while more pairs than this many times the rows are open: in all, and of a token.
OPEN_PAIRS = 4
#: What is left open of a token is dealt into so many parts at most, of about so many pairs.
MOST_PARTS, PART_PAIRS = 256, 1_000_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)  # odd


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(rows: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text its different n-grams of words as sorted 64-bit hashes.

    Words are runs without ASCII white space, A to Z lower-cased. A text of fewer words is one n-gram, one without words none.
    """
    words = SpacedWords(pc.ascii_lower(rows))
    of_word = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.distinct), np.uint64, len(words.distinct))
    hashes = of_word[words.codes]

    def runs(starts: np.ndarray | slice, count: int, n: int) -> np.ndarray:
        acc = np.full(n, count, np.uint64)
        for k in range(count):
            at = slice(k, k + n) if isinstance(starts, slice) else starts + k
            acc = acc * FACTOR + hashes[at]
        return _mixed(acc)

    full = runs(slice(0, None), size, max(len(hashes) - size + 1, 0))  # those across two texts are never used
    for start, count in zip(words.starts.tolist(), words.counts.tolist(), strict=True):
        if count >= size:
            yield np.unique(full[start : start + count - size + 1])
        elif count:
            yield runs(np.array([start]), count, 1)
        else:
            yield np.empty(0, np.uint64)


def _class_of(grams: np.ndarray) -> int:
    """The class of all texts with this set of n-grams, a signed 64-bit hash."""
    return xxhash.xxh3_64_intdigest(grams.tobytes()) - (1 << 63)


def _counter(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - COUNTERS.bit_length() + 1)).astype(np.int64)


def _sketch(grams: np.ndarray) -> np.ndarray | None:
    if 0 < len(grams) <= MOST_SKETCHED:
        return np.bincount((grams % np.uint64(CELLS)).astype(np.int64), minlength=CELLS).astype(np.int16)
    return None


def _signed(grams: np.ndarray) -> pa.Array:
    return pa.array(grams.view(np.int64))


def _survey(docs: DataFrame, size: int) -> DataFrame:
    """One row (doc_id, class, n, sketch) for each text, and for each task rows (chunk, counts) of its n-gram counters.

    The sketch tells how many n-grams fall into each of `CELLS` cells; a class has it once in a task.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "class", "n", "sketch", "chunk", "counts"]
    shorts = pa.list_(pa.int16())

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, seen, ids = np.zeros(COUNTERS, np.uint32), set(), None
        for batch in batches:
            ids = batch.column("doc_id").type
            for piece in slices(batch):
                classes, sizes, sketches, new = [], [], [], []
                for grams in shingle_sets(texts(piece), size):
                    classes.append(c := _class_of(grams))
                    sizes.append(len(grams))
                    sketches.append(None)
                    if c not in seen:  # copies count once in a task
                        seen.add(c)
                        new.append(grams)
                        sketches[-1] = _sketch(grams)
                if new:
                    counters += np.bincount(_counter(np.concatenate(new)), minlength=COUNTERS).astype(np.uint32)
                n = len(classes)
                yield pa.record_batch(
                    [piece.column("doc_id"), pa.array(classes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(sketches, shorts), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                    names=names,
                )
        if ids is not None:
            chunks = [counters[at : at + CHUNK].tobytes() for at in range(0, COUNTERS, CHUNK)]
            n = len(chunks)
            yield pa.record_batch(
                [pa.nulls(n, ids), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, shorts), pa.array(range(n), pa.int32()), pa.array(chunks, pa.binary())],
                names=names,
            )

    return docs.mapInArrow(work, f"doc_id {kind}, class long, n int, sketch array<smallint>, chunk int, counts binary")


def _frequencies(chunks: DataFrame) -> np.ndarray:
    """The counters of all tasks added up, chunk by chunk in tasks; the driver gets the sums, a table of fixed size."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts"), strict=True):
                own = sums.setdefault(chunk, np.zeros(CHUNK, np.uint64))
                own += np.frombuffer(counts.as_buffer(), np.uint32)
        for chunk, counts in sums.items():
            yield pa.record_batch([pa.array([chunk], pa.int32()), pa.array([counts.tobytes()], pa.binary())], names=["chunk", "counts"])

    table = np.zeros(COUNTERS, np.uint64)
    for row in chunks.repartition("chunk").mapInArrow(add, "chunk int, counts binary").collect():
        table[row["chunk"] * CHUNK :][:CHUNK] = np.frombuffer(row["counts"], np.uint64)
    return table


def _prefixes(docs: DataFrame, size: int, percent: int, frequencies: np.ndarray) -> DataFrame:
    """The prefix n-grams of each class, rarest first: token, class, n (of the set) and pos."""
    shared = docs.sparkSession.sparkContext.broadcast(frequencies)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = shared.value, set()
        for batch in batches:
            for piece in slices(batch):
                tokens, classes, sizes, places = [], [], [], []
                for grams in shingle_sets(texts(piece), size):
                    n, c = len(grams), _class_of(grams)
                    if not n or c in seen:
                        continue
                    seen.add(c)
                    first = n - (percent * n + 99) // 100 + 1
                    # equally frequent ones stay in the order of their hashes
                    tokens.append(grams[np.argsort(table[_counter(grams)], kind="stable")[:first]])
                    classes.append(np.full(first, c, np.int64))
                    sizes.append(np.full(first, n, np.int32))
                    places.append(np.arange(first, dtype=np.int32))
                if tokens:
                    columns = [_signed(np.concatenate(tokens)), *(pa.array(np.concatenate(x)) for x in (classes, sizes, places))]
                    yield pa.record_batch(columns, names=["token", "class", "n", "pos"])

    return docs.select("text").mapInArrow(work, "token long, class long, n int, pos int")


def _shared_tokens(prefixes: DataFrame) -> DataFrame:
    """The prefix rows of tokens that several classes have, each row once; streamed in order, so no group is held."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, with_last = None, False  # the last row so far, and whether its token has had another row
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
            token, group = rows["token"].to_numpy(), rows["class"].to_numpy()
            real = np.ones(len(token), bool)
            real[1:] = (token[1:] != token[:-1]) | (group[1:] != group[:-1])
            rows, token = rows.filter(pa.array(real)), token[real]
            if not len(token):
                continue
            shared = np.zeros(len(token), bool)
            shared[1:] = token[1:] == token[:-1]
            after = shared.copy()
            after[:-1] |= shared[1:]
            after[0] |= with_last and kept is not None
            kept, with_last = rows.slice(len(token) - 1), bool(after[-1])
            yield from rows.slice(0, len(token) - 1).filter(pa.array(after[:-1])).to_batches()
        if kept is not None and with_last:
            yield from kept.to_batches()

    return prefixes.repartition("token").sortWithinPartitions("token", "class").mapInArrow(work, prefixes.schema)


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """class and the whole set of n-grams."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for piece in slices(batch):
                classes, sets = [], []
                for grams in shingle_sets(texts(piece), size):
                    if len(grams) and (c := _class_of(grams)) not in seen:
                        seen.add(c)
                        classes.append(c)
                        sets.append(grams.view(np.int64))
                if classes:
                    grams = pa.ListArray.from_arrays(np.cumsum([0, *map(len, sets)]).astype(np.int32), pa.array(np.concatenate(sets)))
                    yield pa.record_batch([pa.array(classes, pa.int64()), grams], names=["class", "grams"])

    return docs.select("text").mapInArrow(work, "class long, grams array<bigint>")


def _needed(n: Column, m: Column, percent: int) -> Column:
    """The n-grams that two sets of these sizes must share."""
    return F.ceil(percent * (n + m) / (100 + percent))


def _passes(a: str, b: str, percent: int) -> Column:
    """Length and positional filter on two rows of one token; a similar pair passes at its first common token."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    left = F.least(n - F.col(f"{a}.pos"), m - F.col(f"{b}.pos"))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (left >= _needed(n, m, percent))


def _pair(a: str, b: str) -> list[Column]:
    swap = F.col(f"{a}.class") < F.col(f"{b}.class")
    one, two = (F.struct(F.col(f"{x}.class").alias("c"), F.col(f"{x}.n").alias("n")) for x in (a, b))
    low, high = F.when(swap, one).otherwise(two), F.when(swap, two).otherwise(one)
    return [low["c"].alias("u"), high["c"].alias("v"), low["n"].alias("n"), high["n"].alias("m")]


def _alike_by_sketch(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v, n, m) whose sketches allow enough common n-grams; those of sets without a sketch stay.

    This bound over the whole sets stands in for a suffix filter: suffixes after the common n-gram are not looked at.
    """
    a, b = (sketches.select(F.col("class").alias(x), F.col("sketch").alias(f"s{x}")) for x in ("u", "v"))
    both = pairs.join(a, "u", "left").join(b, "v", "left")
    common = F.aggregate(F.zip_with("su", "sv", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y.cast("int"))
    enough = common >= _needed(F.col("n"), F.col("m"), percent)
    return both.where(F.coalesce(enough, F.lit(True))).select("u", "v", "n", "m")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that the whole sets link."""
    a, b = (sets.select(F.col("class").alias(x), F.col("grams").alias(f"g{x}")) for x in ("u", "v"))
    overlap = F.size(F.array_intersect("gu", "gv"))
    sized = pairs.join(a, "u").join(b, "v").select("u", "v", (F.col("n") + F.col("m")).alias("sum"), overlap.alias("both"))
    return sized.where(100 * F.col("both") >= percent * (F.col("sum") - F.col("both"))).select("u", "v").distinct()


def _alive(rows: DataFrame, percent: int) -> DataFrame:
    """Token rows that may pass the filters with some other row of their token, judged by the smallest set there."""
    sizes = rows.groupBy("token").agg(F.min("n").alias("smallest"), F.count("*").alias("k")).where("k > 1").drop("k")
    partner = F.greatest("smallest", F.ceil(percent * F.col("n") / 100))
    bounded = rows.join(sizes, "token").where(F.col("n") - F.col("pos") >= _needed(F.col("n"), partner, percent))
    return bounded.drop("smallest")


def _labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Token rows with the component of their class so far; a class without links is its own."""
    roots = components(links).select(F.col("node").alias("class"), "root")
    return rows.join(roots, "class", "left").withColumn("label", F.coalesce("root", "class")).drop("root")


def _split(rows: DataFrame) -> DataFrame:
    """Open rows (token, class, n, pos, label) with the token's largest component and its open pairs; closed tokens go.

    Open pairs, at most: each row outside the largest component with every row of the token.
    """
    counts = rows.groupBy("token", "label").agg(F.count("*").alias("c"))
    tokens = counts.groupBy("token").agg(F.sum("c").alias("k"), F.max("c").alias("m"), F.max_by("label", "c").alias("most"))
    return rows.join(tokens.where("k > m").select("token", "k", "most", ((F.col("k") - F.col("m")) * F.col("k")).alias("open")), "token")


def _remaining(rows: DataFrame, percent: int) -> DataFrame:
    """All open pairs of the rows that pass the filters, from both sides dealt out by size and, where there are many, in parts."""
    # sizes that the length filter allows are in the same or in neighbouring bands
    band = F.floor(F.log("n") / max(math.log(100 / percent) * 1.000001, 0.01)).cast("int")
    parts = F.least(F.lit(MOST_PARTS), 1 + F.floor(F.col("open") / PART_PAIRS)).cast("int")
    sided = rows.withColumns({"band": band, "parts": parts})
    # rows of a token's largest component are on one side only
    part = F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")
    a = sided.where("label <> most").withColumn("part", part).alias("a")
    near = sided.withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    b = near.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).alias("b")
    same = reduce(and_, (F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("token", "band", "part")))
    once = (F.col("b.label") == F.col("b.most")) | (F.col("a.class") < F.col("b.class"))
    open_pair = same & (F.col("a.label") != F.col("b.label")) & once & _passes("a", "b", percent)
    return a.join(b, open_pair).select(*_pair("a", "b")).distinct()


def _links(
    live: DataFrame, sketches: DataFrame, fetch: Callable[[DataFrame], DataFrame], percent: int
) -> DataFrame:
    """Links between classes that join all that are connected; pairs that are known to be connected are not compared.

    Tokens of few classes give all their pairs that pass the filters. Of a larger token one row is compared with all others: the most
    central one, which has the fewest rarer n-grams of its own before the token. In a family of near copies nearly all others link
    with it, and those that do not have so many n-grams of their own that the positional filter drops them. Such rounds go on with the most
    central row outside the token's largest component until few pairs are open in all; a token that few are open of, or whose open pairs a
    round does not halve, waits. What is open at the end passes the filters once. Rows that no partner in their token can match go before every
    round. Comparing takes the sketches first; `fetch` gives the sets of the classes that are left. No pair is compared twice.
    """
    sizes = live.groupBy("token").agg(F.count("*").alias("k"))
    large = live.join(sizes.where(F.col("k") > SMALL_TOKEN).select("token"), "token", "left_semi")
    small = live.join(sizes.where(F.col("k") <= SMALL_TOKEN).select("token"), "token", "left_semi")
    a, b = small.alias("a"), small.alias("b")
    few = (F.col("a.token") == F.col("b.token")) & (F.col("a.class") < F.col("b.class")) & _passes("a", "b", percent)

    def compared(pairs: DataFrame) -> DataFrame:
        near = scratch(_alike_by_sketch(pairs, sketches, percent), "near-pairs")
        sets = fetch(near.select(F.explode(F.array("u", "v")).alias("class")).distinct())
        links = scratch(_verified(near, sets, percent), "links")
        discard(near, sets)
        return links

    tested = scratch(a.join(b, few).select(*_pair("a", "b")).distinct(), "pairs")
    links = compared(tested)
    rows = scratch(large.withColumn("before", F.lit(None).cast("long")), "large-tokens")
    discard(live)
    n_rows, first = rows.count(), True
    left: list[DataFrame] = []
    columns = ["token", "class", "n", "pos"]
    while True:
        # at first each class counts as a component of its own
        named = rows.withColumn("label", F.col("class")) if first else _labelled(rows, links)
        open_rows = scratch(_split(_alive(named, percent)), "open-rows")
        discard(rows)
        n_open = open_rows.agg(F.sum(F.col("open") / F.col("k"))).first()[0] or 0
        if n_open <= OPEN_PAIRS * n_rows:
            break
        ends = (F.col("open") <= OPEN_PAIRS * F.col("k")) | (2 * F.col("open") > F.col("before"))
        ending = open_rows.withColumn("ends", F.coalesce(ends, F.lit(False)))
        if not first:
            left.append(scratch(ending.where("ends").select(columns), "left-rows"))
        going = ending.where("NOT ends")
        # by place, then by a hash of the class, so that tokens of one family choose alike
        turn = F.struct(~F.lit(first) & (F.col("label") == F.col("most")), "pos", F.xxhash64("class"), "class")
        pivots = scratch(
            going.groupBy("token").agg(F.min_by(F.struct("class", "n", "pos", "label"), turn).alias("p")).select("token", "p.*"), "pivots"
        )
        a, b = going.alias("a"), pivots.alias("b")
        apart = (F.col("a.token") == F.col("b.token")) & (F.col("a.label") != F.col("b.label"))
        found = a.join(b, apart & _passes("a", "b", percent)).select(*_pair("a", "b")).distinct()
        pairs = scratch(found.join(tested.select("u", "v"), ["u", "v"], "left_anti"), "pairs")
        links = links.unionByName(compared(pairs))
        tested = tested.unionByName(pairs)
        rest = ending.join(pivots.select("token", "class"), ["token", "class"], "left_anti")
        rest = rest if first else rest.where("NOT ends")
        rows = scratch(rest.select(*columns, F.col("open").alias("before")), "large-tokens")
        discard(open_rows, pivots)
        first = False
    if left:
        every = reduce(DataFrame.unionByName, left, open_rows.select(columns))
        over = scratch(_split(_alive(_labelled(every, links), percent)), "open-rows")
        discard(open_rows, *left)
    else:
        over = open_rows
    pairs = scratch(_remaining(over, percent).join(tested.select("u", "v"), ["u", "v"], "left_anti"), "pairs")
    discard(over)
    return links.unionByName(compared(pairs))


def similar_groups(docs: DataFrame, percent: int = 75, size: int = 5) -> DataFrame:
    """Groups of documents (doc_id, text) linked by similar sets of n-grams: doc_id, n_shingles, component_id.

    A text's set are its different n-grams of `size` words (a shorter text: all its words as one). Two link if `percent` times
    the union's size is at most 100 times the intersection's. A component's id is the smallest doc_id that links
    reach. Null, empty and wordless texts have empty sets and link with nothing, not even with each other. Rows are
    documents, also where they repeat or share an id; null ids are never the smallest. An empty table gives no rows.
    Other columns are left out. N-grams, and sets, are held equal by 64-bit hashes.

    Texts with equal sets are one class. N-grams are ordered by a table of hashed counts over all texts, of fixed size:
    any order gives the same links, and frequent n-grams go last. Classes that share a token of their prefixes are
    compared (see `_links`), each pair once. Only prefixes and sketches are
    shuffled, and the sets of classes whose sketches are alike. Texts reach Python in batches of bounded bytes.
    """
    with batches_of(docs.sparkSession, SLICE_BYTES):
        return _grouped(docs.select("doc_id", "text"), percent, size)


def _grouped(docs: DataFrame, percent: int, size: int) -> DataFrame:
    """The groups; every job over texts is run here, and the result reads scratch tables only."""
    survey = scratch(_survey(docs, size), "survey")
    members = survey.where("chunk is null").select("doc_id", "class", "n")
    frequencies = _frequencies(survey.where("chunk is not null").select("chunk", "counts"))
    live = scratch(_shared_tokens(_prefixes(docs, size, percent, frequencies)), "shared-tokens")

    sketches = survey.where("sketch is not null").select("class", "sketch").dropDuplicates(["class"])
    sketches = scratch(sketches, "sketches")

    def fetch(classes: DataFrame) -> DataFrame:
        chosen = members.join(classes, "class", "left_semi").groupBy("class").agg(F.min("doc_id").alias("doc_id"))
        chosen = scratch(chosen.select(F.col("doc_id").alias("id")).distinct(), "chosen")
        most = MAX_BROADCAST_IDS // (8 if isinstance(chosen.schema["id"].dataType, StringType) else 1)
        ids = F.broadcast(chosen) if chosen.count() <= most else chosen
        found = _sets(docs.join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi"), size)
        return scratch(found, "sets")

    roots = components(_links(live, sketches, fetch, percent)).select(F.col("node").alias("class"), "root")
    placed = members.join(roots, "class", "left").select(
        "doc_id", "n", F.when(F.col("n") > 0, F.coalesce("root", "class")).alias("root")
    )
    least = placed.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return placed.join(least, "root", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")
    )
