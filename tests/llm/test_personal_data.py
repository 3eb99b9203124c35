"""Personal data: the base patterns to the letter, votes, EM and the spans that the classifier adds."""

from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import functions as F

from stratalake.llm.personal_data import (
    EXPECTED,
    KINDS,
    KNOWN,
    LABELERS,
    better_than_chance,
    candidates,
    estimate,
    estimate_by_kind,
    personal_data,
    span_list,
    train,
    votes,
)

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PIECES = [
    "a@b.c", "x.y%z@q-1.com", "..", "@", "1.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+12", "-",
    "+1 (123) 555-1234", " ", ".", " at ", "é", "😀", "\n", "_", "5500005555555559", "123-456-7890", "(123) 456-7890",
    "bob (at) mail (dot) com", "1" * 25, "+", "0.0.0.0", "a.b@c..d", "co_x@d.e", "mail ", "card ",
]


def passes_luhn(digits):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in twice) % 10 == 0


def brute(text):
    out = []
    for number, kind in enumerate(KINDS, 1):
        for m in re.finditer(PATTERNS[kind], text or ""):
            digits = re.sub(r"[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(part) <= 255 for part in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and passes_luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), number, m.end(), kind))
    return sorted(out)


def test_base_spans_as_brute_force(spark):
    pick = random.Random(3)
    rows = [(i, "".join(pick.choice(PIECES) for _ in range(pick.randint(0, 14)))) for i in range(600)]
    rows += [(1000, None), (1000, None), (None, "a@b.c"), (1001, ""), (1002, "1 2-" * 1000 + "4111111111111111")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kind", F.lit("x")).withColumn("spans", F.lit(1))
    got = personal_data(docs).collect()
    shown = [(r["doc_id"], [tuple(s) for s in r["base"]]) for r in got]
    assert sorted(shown, key=str) == sorted(((i, brute(t)) for i, t in rows), key=str)
    assert all({tuple(s) for s in r["base"]} <= {tuple(s) for s in r["spans"]} for r in got)


def test_very_long_texts_need_no_stack_and_no_square_of_time(spark):
    rows = [(1, "1" * 300_000), (2, "a" * 300_000 + "@b" + ".c" * 100_000), (3, "+1 " * 100_000 + "1-1 " * 100_000), (4, "1.1" * 100_000)]
    got = {r["doc_id"]: r["base"] for r in personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(s) for s in got[2]] == [(0, 1, 500_002, "email")]
    assert got[1] == []


def test_spans_are_added_where_labelers_agree(spark):
    lines = ["call me: (212) 555-0134 today", "mail: ann (at) example (dot) com", "order no. 4000 0000 0000 0001"]
    lines += [f"phone: +1 (212) 555-{i:04d} ok, mail: u{i}@example.com" for i in range(60)] + ["build 1234567890123"] * 20
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r["doc_id"]: r["s"] for r in personal_data(docs).select("doc_id", span_list(F.col("spans")).alias("s")).collect()}
    assert got[0] == "phone:9:23" and got[1] == "email:6:32"
    assert got[2] == "" and got[70] == ""


def test_em_finds_the_reliabilities_that_made_the_votes():
    pick, n = np.random.default_rng(1), 40_000
    truth = pick.random(n) < 0.3
    right = np.array([0.95, 0.8, 0.7, 0.9, 0.75])
    agree = pick.random((n, 5)) < right
    cast = np.where(agree == truth[:, None], 1, -1)
    kinds = pick.choice(KINDS, n)
    counted = {}
    for kind, row in zip(kinds, map(tuple, cast.tolist()), strict=True):
        counted[kind, row] = counted.get((kind, row), 0) + 1
    posterior, chances = estimate([(k, v, c) for (k, v), c in counted.items()])
    assert np.abs(chances[1, :, 2] - right).max() < 0.03 and np.abs(chances[0, :, 0] - right).max() < 0.03
    assert posterior.min() >= 0 and posterior.max() <= 1


def test_labelers_vote_and_empty_table(spark):
    docs = spark.createDataFrame([(1, 5, "v 1.2.3.4 card 4111111111111111")], "doc_id long, text_hash long, text string")
    cast = votes(candidates(docs)).collect()
    assert len(cast) == 2 and all(r[name] in (-1, 0, 1) for r in cast for name in LABELERS)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert personal_data(empty).count() == 0
    assert train(votes(candidates(docs.limit(0)))).reliabilities == {}


def test_no_vote_speaks_for_the_other_class():
    pick = np.random.default_rng(2)
    for _ in range(50):
        chances = pick.dirichlet([0.5] * 3, (3, 2, 6))
        fixed = better_than_chance(chances)
        assert np.allclose(fixed.sum(axis=-1), 1) and fixed.min() >= 0
        assert (fixed[:, 1, :, 2] >= fixed[:, 0, :, 2] - 1e-12).all() and (fixed[:, 0, :, 0] >= fixed[:, 1, :, 0] - 1e-12).all()
        good = fixed.copy()
        assert np.allclose(better_than_chance(good), good, atol=1e-5)


def test_kinds_in_which_all_votes_agree_are_not_turned_round():
    sure, doubt = (1, 1, 1, 0, 1, 0), (-1, 1, 1, 0, 1, 0)
    counted = [("card", sure, 174), ("card", doubt, 164), ("email", sure, 186), ("ip", (1, 1, 0, 0, 1, 0), 180)]
    posterior, chances, _ = estimate_by_kind(counted, [EXPECTED[name] for name in LABELERS], [name in KNOWN for name in LABELERS])
    assert posterior[0] > 0.95 and posterior[1] < 0.5 and posterior[2] > 0.95 and posterior[3] > 0.95
    assert (chances[:, 1, :, 2] >= chances[:, 0, :, 2] - 1e-9).all()


def planted(count):
    """Texts with one thing each, and whether it is personal data: spelled forms, numbers without a country, secrets, look-alikes."""
    pick = random.Random(8)
    digits = lambda n: "".join(pick.choice("0123456789") for _ in range(n))
    hexed = lambda n: "".join(pick.choice("0123456789abcdef") for _ in range(n))
    makers = [
        (True, lambda: f"mail u{digits(3)} (at) host{digits(2)} (dot) com please"),
        (True, lambda: f"call ({digits(3)}) {digits(3)}-{digits(4)} now"),
        (True, lambda: f"phone 0049 30 {digits(4)} {digits(4)} now"),
        (True, lambda: f"server 10[.]{pick.randrange(256)}[.]{pick.randrange(256)}[.]7 up"),
        (True, lambda: f'and token = "{hexed(40)}" there'),
        (False, lambda: f"build {digits(13)}0 of it"),
        (False, lambda: f"order no. 4000 0000 0000 {pick.choice(['0003', '0005', '0011'])} sent"),
        (False, lambda: f"commit {hexed(40)} fixed it"),
        (False, lambda: f"version {pick.randrange(300, 999)}.1.1.1 came"),
        (False, lambda: "thanertheandtiononhalytheinerthstorthit words only"),
    ]
    return [(kind, make()) for kind, make in makers for _ in range(count)]


def test_planted_forms_are_found_and_look_alikes_left(spark):
    things = planted(30)
    rows = [(k, text) for k, (_, text) in enumerate(things)]
    rows += [(10_000 + k, f"write u{k}@mail{k % 9}.example.com or +1 (212) 555-{k:04d} or 10.2.3.{k}, card 4111111111111111") for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: len(r["spans"]) for r in personal_data(docs).collect()}
    found = [got[k] > 0 for k in range(len(things))]
    true = sum(f for f, (real, _) in zip(found, things) if real)
    recall, precision = true / sum(real for real, _ in things), true / max(sum(found), 1)
    assert recall >= 0.95 and precision >= 0.95, (recall, precision)
    assert all(got[10_000 + k] >= 4 for k in range(100))


def test_added_spans_do_not_overlap(spark):
    texts = ['token = "' + "4111.1111.1111.1111" * 2 + '"', "call (212) 555-0134, 0049 (212) 555-0134 and bob (at) mail (dot) com"] * 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in personal_data(docs).collect():
        ends = [(s["start"], s["end"]) for s in r["spans"]]
        assert all(x[1] <= y[0] for x, y in zip(ends, ends[1:]))
