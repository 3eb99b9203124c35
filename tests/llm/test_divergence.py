"""How sources differ in their words, against a dense computation in Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratalake.llm.divergence import _share, source_divergence, terms_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, min_docs, top):
    """All values of all kept terms for all pairs, in Python's whole numbers."""
    rows = [tuple(v or "" for v in row) for row in rows]
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        docs[lang].update(set(terms(text)))
        counts[lang, source].update(terms(text))
    kept = {lang: sorted(t for t, n in found.items() if n >= min_docs) for lang, found in docs.items()}
    whole = {lang: sum((c for (at, _), c in counts.items() if at == lang), Counter()) for lang in kept}

    def shares(count, lang):
        total = sum(count[t] for t in kept[lang])
        return [1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept[lang])) for t in kept[lang]]

    def far(p, q):
        return (p - q) * (p - q) // (p + q)

    out = []
    for (lang, source), count in counts.items():
        own, others = shares(count, lang), {}
        for at, other in counts:
            if at == lang and other != source:
                others[other] = sum(map(far, own, shares(counts[lang, other], lang)))
        said = {t: far(p, q) for t, p, q in zip(kept[lang], own, shares(whole[lang], lang)) if count[t] and p > q}
        for part, values, most in (("pair", others, None), ("term", said, top)):
            ranked = sorted(values.items(), key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, item, value, k) for k, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def random_rows(seed):
    pick = random.Random(seed)
    words = ["the", "The", "état", "ÉTAT", "x1y", "漢字", "a'b", "zip\u0000zap", "İ", "w7", *(f"w{chr(97 + k)}" for k in range(12))]
    rows = [("en", "a", "Shared copy of the words")] * 40 + [("en", "b", "Shared copy of the words")] * 3
    for _ in range(120):
        text = " ".join(pick.choices(words, k=pick.randint(0, 30)))
        rows.append((pick.choice(["en", "de", None, ""]), pick.choice(["a", "b", "c", "ç", None]), pick.choice([text, text, text, None, ""])))
    rows += [("fr", "only", "un deux"), ("xx", "quiet", None), ("xx", "empty", "123 !?"), ("en", "silent", ""), ("en", "long", "the wa " * 20000)]
    return rows


@pytest.mark.parametrize(("seed", "min_docs", "top"), [(1, 1, 10), (2, 3, 2), (3, 10, 10), (4, 1000, 5)])
def test_as_brute_force(spark, seed, min_docs, top):
    rows = random_rows(seed)
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(5)
    docs = docs.withColumns({"term": F.lit("x"), "n": F.lit(1), "value": F.lit("y"), "no": F.lit(0)})
    got = source_divergence(docs, min_docs, top)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows, min_docs, top)


def test_empty_table(spark):
    assert source_divergence(spark.createDataFrame([], "lang string, source string, text string")).count() == 0


def test_terms_never_cross_texts():
    rows = pa.array(["ab", "cd", "", None, "Éé ab-CD", "9", "x"]).fill_null("").slice(1)
    found, text_of, codes = terms_of(rows)
    assert [(int(t), found[int(c)].as_py()) for t, c in zip(text_of, codes)] == [(0, "cd"), (3, "Éé"), (3, "ab"), (3, "cd"), (5, "x")]


def test_terms_of_nothing():
    for rows in ([], ["", ""], ["1 2", "!"]):
        found, text_of, codes = terms_of(pa.array(rows, pa.string()))
        assert len(found) == len(text_of) == len(codes) == 0 and codes.dtype == np.int64


def test_shares_are_exact_beyond_64_bits(spark):
    rows = [(n, n * 3 + 1, 7) for n in (0, 5, 8_999_999_999, 9_000_000_000, 10**12 + 1, 10**17)]
    table = spark.createDataFrame(rows, "n long, words long, kept long")
    got = table.select("n", "words", "kept", _share(F.col("n"), F.col("words"), F.col("kept")).alias("p")).collect()
    assert len(got) == len(rows)
    assert all(r["p"] == 1 + 10**9 * (r["n"] + 2) // (r["words"] + 2 * r["kept"]) for r in got)
