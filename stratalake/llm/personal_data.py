"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs them, a classifier decides."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import let, scratch

KINDS = ["email", "ip", "card", "phone"]
#: Kinds that only the method finds; they come after the others.
MORE_KINDS = ["secret"]
ALL_KINDS = [*KINDS, *MORE_KINDS]
#: Code points of a text's surroundings that labelers see on each side.
CONTEXT = 24

_LOCAL = r"[A-Za-z0-9._%+-]"
# Each pattern takes time in proportion to the text and no stack: runs are possessive, begin only where a run or the
# last match ends, and no group repeats without bound.
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@(?=[A-Za-z0-9-]++\.[A-Za-z0-9-])[A-Za-z0-9.-]+?(?=\.\.|\.?(?![A-Za-z0-9.-]))"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: What divides runs of digits with single spaces or hyphens in between; a run of at least two digits is a card candidate.
CARD_BREAK = r"[^0-9]{2,}+|[^0-9\x20-]|\A[\x20-]|[\x20-]\z"
#: Further candidates: numbers without a country code or with 00 before it, cards in groups with other signs between, addresses with
#: their signs spelled out, addresses of version 6, long runs of letters and digits.
LOCAL_PHONE = r"(?<![0-9+])(?:\([0-9]{3}\)[\x20-]?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"
SPELLED_EMAIL = (
    rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++\x20?(?:\(dot\)|\[dot\]|\.)\x20?[A-Za-z]{{2,12}}"
)
DIALLED_PHONE = r"(?<![0-9+.])00[1-9][0-9]{0,2}[\x20./()-][\x20./()0-9-]{6,20}[0-9](?![0-9])"
GROUPED_CARD = r"(?<![0-9./_])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9./_])"
SPELLED_IP = r"(?<![0-9.])[0-9]{1,3}(?:\x20?(?:\[\.\]|\(dot\)|\[dot\])\x20?[0-9]{1,3}){3}(?![0-9])"
IP6 = r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"
SECRET = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{20,}+={0,2}"

# The gazetteers, and the words that labelers look for before a span.
TOP_DOMAINS = "com org net edu gov mil int info io co uk de fr es it nl eu us ca au jp cn ru br in ch at be se no pl".split()
COUNTRY_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92".split()
CARD_PREFIXES = "34 36 37 38 4 51 52 53 54 55 2 30 60 62 64 65".split()
FOR_KIND = {
    "email": "mail|contact|write|courriel|correo|kontakt",
    "ip": r"\bip\b|addr|host|server|client|login",
    "card": "card|visa|master|amex|credit|debit|carte|tarjeta|karte",
    "phone": r"phone|\btel\b|call|mobile|fax|tél|teléfono|telefon",
    "secret": r"token|secret|passw|pwd|api.?key|access.?key|private.?key|bearer|auth",
}
AGAINST = r"version|\bv$|\bno\.?\s*$|order|invoice|isbn|serial|build|token|key|id\s*[:=#]?\s*$"

LABELERS = ["pattern", "shape", "gazetteer", "context", "edge", "company"]

# How often a labeler's opinion is expected to be right, before any votes are seen.
EXPECTED = {"pattern": 0.95, "shape": 0.65, "gazetteer": 0.7, "context": 0.85, "edge": 0.65, "company": 0.6}
#: Labelers whose reliability is not estimated.
KNOWN = ["pattern"]
#: What the expectation and the other kinds weigh against a kind's own votes: so many votes, or this share of its own.
PRIOR_VOTES, PRIOR_SHARE = 20.0, 0.1


#: What other personal data near by looks like.
COMPANY = r"[A-Za-z0-9]@[A-Za-z0-9]|\+[0-9]|[0-9]{1,3}(?:\.[0-9]{1,3}){3}|[0-9]{13}"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""

    def doubled(at: Column) -> Column:
        digit = F.substring(F.reverse(digits), at, F.lit(1)).cast("int")
        return F.when(at % 2 == 1, digit).otherwise(2 * digit - F.when(digit > 4, 9).otherwise(0))

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), doubled), F.lit(0), lambda a, b: a + b) % 10 == 0


def _matches(text: Column, kind: str, pattern: str, base: bool, when: Column) -> Column:
    """A pattern's matches in order: gap (code points since the last one), match and what is around it."""

    def rows(parts: Column) -> Column:
        return F.transform(
            parts["matches"],
            lambda match, at: F.struct(
                F.lit(kind).alias("kind"),
                F.lit(base).alias("base"),
                at.alias("at"),
                F.length(F.get(parts["between"], at)).alias("gap"),
                match.alias("match"),
                F.right(F.get(parts["between"], at), F.lit(CONTEXT)).alias("left"),
                F.left(F.get(parts["between"], at + 1), F.lit(CONTEXT)).alias("right"),
            ),
        )

    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"), F.split(text, pattern, -1).alias("between")
    )
    return F.when(when, let(found, rows))


def _runs(text: Column, when: Column) -> Column:
    """The card candidates' rows, as `_matches` gives them: here the pattern finds what lies between."""

    def rows(parts: Column) -> Column:
        return F.transform(
            parts["runs"],
            lambda run, at: F.struct(
                F.lit("card").alias("kind"),
                F.lit(True).alias("base"),
                at.alias("at"),
                F.when(at > 0, F.length(F.get(parts["breaks"], at - 1))).otherwise(0).alias("gap"),
                run.alias("match"),
                F.right(F.when(at > 0, F.get(parts["breaks"], at - 1)).otherwise(""), F.lit(CONTEXT)).alias("left"),
                F.left(F.coalesce(F.get(parts["breaks"], at), F.lit("")), F.lit(CONTEXT)).alias("right"),
            ),
        )

    found = F.struct(
        F.split(text, CARD_BREAK, -1).alias("runs"), F.regexp_extract_all(text, F.lit(CARD_BREAK), F.lit(0)).alias("breaks")
    )
    return F.when(when, let(found, rows))


def candidates(docs: DataFrame) -> DataFrame:
    """Candidate spans of rows (doc_id, text_hash, text): kind, start, end, match, surroundings, base and valid.

    `base` marks matches of the contract's patterns, leftmost and without overlap within their kind; `valid` those that
    also pass its checks. Positions are sums over the gaps and matches before, by a window over each text's matches of
    one pattern.
    """
    text = F.col("text")
    patterns = F.array(
        _matches(text, "email", EMAIL, True, F.contains(text, F.lit("@"))),
        _matches(text, "ip", IP, True, text.rlike(r"[0-9]\.[0-9]")),
        _runs(text, text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}")),
        _matches(text, "phone", PHONE, True, text.rlike(r"\+[0-9]")),
        _matches(text, "phone", LOCAL_PHONE, False, text.rlike(r"[0-9]{3}[\x20.-][0-9]{4}")),
        _matches(text, "email", SPELLED_EMAIL, False, text.rlike(r"\(at\)|\[at\]")),
        _matches(text, "phone", DIALLED_PHONE, False, text.rlike(r"(?<![0-9+.])00[1-9]")),
        _matches(text, "card", GROUPED_CARD, False, text.rlike(r"[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1")),
        _matches(text, "ip", SPELLED_IP, False, text.rlike(r"[0-9]\x20?(?:\[\.\]|\(dot\)|\[dot\])")),
        _matches(text, "ip", IP6, False, text.rlike(r"(?:[0-9A-Fa-f]{1,4}:){7}")),
        _matches(text, "secret", SECRET, False, text.rlike(r"[A-Za-z0-9+/_-]{20}")),
    )
    # a pattern's number keeps its matches apart from those of others of its kind
    patterns = F.transform(patterns, lambda found, form: F.transform(found, lambda m: F.struct(form.alias("form"), m["kind"].alias("kind"), m["base"].alias("base"), m["at"].alias("at"), m["gap"].alias("gap"), m["match"].alias("match"), m["left"].alias("left"), m["right"].alias("right"))))
    each = docs.select("doc_id", "text_hash", F.explode(F.flatten(F.array_compact(patterns))).alias("c")).select(
        "doc_id", "text_hash", "c.*"
    )
    run = Window.partitionBy("doc_id", "text_hash", "form").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("match")).over(run)
    placed = each.dropDuplicates(["doc_id", "text_hash", "form", "at"]).withColumn("end", end)
    digits = _digits(F.col("match"))
    n = F.length(digits)
    octets = F.transform(F.split("match", r"\."), lambda part: F.coalesce(part.try_cast("int"), F.lit(256)))
    checked = {
        "email": F.lit(True),
        "ip": F.forall(octets, lambda octet: octet <= 255),
        "card": F.when(n.between(12, 19), luhn(digits)).otherwise(False),
        "phone": n.between(9, 15),
        "secret": F.lit(False),
    }
    valid = F.coalesce(*(F.when(F.col("kind") == kind, test) for kind, test in checked.items()))
    found = placed.where((F.col("kind") != "card") | (n >= 12)).select(
        "doc_id",
        "text_hash",
        "kind",
        "base",
        (F.col("end") - F.length("match")).alias("start"),
        "end",
        "match",
        "left",
        "right",
        n.alias("n_digits"),
        valid.alias("checked"),
        (F.col("base") & valid).alias("valid"),
    )
    return _apart(found)


def _apart(spans: DataFrame) -> DataFrame:
    """The valid base spans and the candidates that overlap none of them."""
    keys, each = ["start", "end", "kind", "base"], Window.partitionBy("doc_id", "text_hash")
    # running frames both ways: one that ends with the last row would be gone through anew for every row
    before = each.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    after = each.orderBy(*map(F.desc, keys)).rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max(F.when(F.col("valid"), F.col("end"))).over(before)
    following = F.min(F.when(F.col("valid"), F.col("start"))).over(after)
    inside = (F.coalesce(reached, F.lit(-1)) > F.col("start")) | (F.coalesce(following, F.col("end")) < F.col("end"))
    marked = spans.withColumn("inside", inside)
    return marked.where(F.col("valid") | ~F.col("inside")).drop("inside")


def votes(spans: DataFrame) -> DataFrame:
    """Adds a vote of each labeler: 1 personal data, -1 not, 0 no opinion."""
    kind, match, digits = F.col("kind"), F.col("match"), _digits(F.col("match"))

    def by_kind(**tests: Column) -> Column:
        return F.coalesce(*(F.when(kind == k, test) for k, test in tests.items()), F.lit(0))

    def sign(test: Column) -> Column:
        return F.when(test, 1).otherwise(-1)

    first = F.substring(digits, 1, 2)
    octet = F.substring_index(match, ".", 1).try_cast("int")
    return spans.withColumns(
        {
            # a check that says much of any form: Luhn's, octets, the count of digits, an assignment
            "pattern": F.when(kind == "secret", sign(F.col("left").rlike(r"[:=]\s?[\"']?\z")))
            .when(F.col("base") | kind.isin("card"), sign(F.col("checked")))
            .otherwise(0),
            "shape": by_kind(
                email=sign(F.length(match) <= 64),
                ip=sign(~match.rlike(r"(?:^|\.)0[0-9]") & ~match.rlike(r"[0-9]{4}\.")),
                card=sign(match.rlike(r"^(?:[0-9]{15,16}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4})$")),
                phone=sign(match.rlike(r"[0-9][\x20().-]+[0-9]")),
                secret=sign(match.rlike(r"^(?:[0-9a-f]{24,}|[0-9A-F]{24,})$") | (match.rlike("[a-z]") & match.rlike("[A-Z]") & match.rlike("[0-9]"))),
            ),
            "gazetteer": by_kind(
                email=F.when(F.lower(F.regexp_extract(F.right(match, F.lit(CONTEXT)), r"([A-Za-z]+)$", 1)).isin(TOP_DOMAINS), 1).otherwise(0),
                ip=F.when(octet.isNull(), 0).when(octet.isin(0, 127, 255) | (octet >= 240), -1).otherwise(1),
                card=sign(first.isin(CARD_PREFIXES) | F.left(first, F.lit(1)).isin(CARD_PREFIXES)),
                phone=F.when(
                    match.startswith("+"), sign(first.isin(COUNTRY_CODES) | F.left(first, F.lit(1)).isin(COUNTRY_CODES))
                ).otherwise(0),
                secret=F.when(F.lower("left").rlike(r"commit|sha-?[0-9]|\bmd5|checksum|digest|hash|href|src"), -1).otherwise(0),
            ),
            "context": F.when((kind != "secret") & F.lower("left").rlike(AGAINST), -1).otherwise(
                by_kind(**{k: F.when(F.lower("left").rlike(words), 1).otherwise(0) for k, words in FOR_KIND.items()})
            ),
            "edge": sign(~F.col("left").rlike(r"[\p{L}\p{N}_]\z") & ~F.col("right").rlike(r"\A[\p{L}\p{N}_]")),
            "company": F.when(F.concat_ws(" ", "left", "right").rlike(COMPANY), 1).otherwise(0),
        }
    )


#: What the classifier sees: kind, votes, the number of digits in steps, and whether the span is of a base pattern.
STEPS = [9, 12, 16]


def _features(rows: DataFrame) -> DataFrame:
    size = sum((F.when(F.col("n_digits") >= step, 1).otherwise(0) for step in STEPS), F.lit(0))
    return rows.withColumn("size", size)


@dataclass(frozen=True)
class SpanModel:
    """Reliabilities of the labelers (by kind, class, labeler, vote), and the classifier's weights by kind, feature and value.

    Weights without a kind hold for all of them.
    """

    reliabilities: dict[str, dict[int, dict[str, list[float]]]]
    weights: dict[tuple[str, str, str], float]

    def score(self) -> Column:
        """The probability that a row of `_features` is personal data."""
        total = F.lit(self.weights.get(("", "", ""), 0.0))
        for (kind, name, value), weight in self.weights.items():
            test = F.col(name).cast("string") == value if name else F.lit(True)
            if kind or name:
                total = total + F.when((F.col("kind") == kind) & test if kind else test, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


Patterns = Sequence[tuple[str, tuple[int, ...], int]]


def better_than_chance(chances: np.ndarray) -> np.ndarray:
    """The nearest chances, P(vote | kind, class, labeler), by which a vote never speaks for the other class.

    A vote in favour is at least as likely for personal data as for other spans, one against at most; where the counts say the opposite, both
    classes get the mean, and the vote then says nothing.
    """
    fixed = chances.copy()
    for vote, sign in ((2, 1), (0, -1)):
        no, yes = fixed[:, 0, :, vote], fixed[:, 1, :, vote]
        wrong, mean = sign * (yes - no) < 0, (yes + no) / 2
        no[wrong], yes[wrong] = mean[wrong], mean[wrong]
    # what is left goes to no opinion; where there is nothing left, both opinions give way alike in both classes
    said = fixed[..., 0] + fixed[..., 2]
    fixed[..., [0, 2]] /= np.maximum(1.0, said.max(axis=1, keepdims=True) * (1 + 1e-6))[..., None]
    fixed[..., 1] = 1 - fixed[..., 0] - fixed[..., 2]
    return fixed


def estimate_by_kind(
    patterns: Patterns, expected: Sequence[float], known: Sequence[bool] = (), rounds: int = 200
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """EM over counted vote patterns (kind, votes, count): posteriors, P(vote | kind, class, labeler), and the counts behind it.

    Labelers are independent given kind and class. A kind's reliabilities are its own counts and a prior: half the expected ones, half
    those of all kinds together; `known` labelers keep the expected ones, as a check whose chance hits are known needs no estimate, and
    without one a kind whose other votes agree could be all of one class. In each round no vote may speak for the other class (`better_than_chance`). Each kind has its own share
    of personal data. The start are the votes weighed by the expected reliabilities.
    """
    names = sorted({k for k, _, _ in patterns})
    kinds = np.array([names.index(k) for k, _, _ in patterns])
    signed = np.array([v for _, v, _ in patterns])
    counts = np.array([c for _, _, c in patterns], float)
    right = np.clip(np.array(expected, float), 0.5, 0.99)
    n_labelers = signed.shape[1]
    total = np.array([counts[kinds == k].sum() for k in range(len(names))])
    cast = np.stack([(signed == v) for v in (-1, 0, 1)], axis=-1).astype(float)  # pattern, labeler, vote
    silent = (counts[:, None] * cast[:, :, 1]).sum(axis=0) / counts.sum()
    prior = np.empty((2, n_labelers, 3))
    for c, favour in ((0, 1 - right), (1, right)):
        prior[c] = np.stack([(1 - silent) * (1 - favour), silent, (1 - silent) * favour], axis=-1)
    strength = np.maximum(PRIOR_VOTES, PRIOR_SHARE * total)[:, None, None, None]
    posterior = 1 / (1 + np.exp(-(signed * np.log(right / (1 - right))).sum(axis=1)))
    for _ in range(rounds):
        by_class = np.stack([1 - posterior, posterior]) * counts
        seen = np.stack([np.einsum("cp,plv->clv", by_class * (kinds == k), cast) for k in range(len(names))])
        pooled = (seen.sum(axis=0) + prior) / (seen.sum(axis=0) + prior).sum(axis=-1, keepdims=True)
        chances = seen + strength * (prior + pooled) / 2
        if len(known):
            chances[:, :, np.flatnonzero(known)] = prior[:, np.flatnonzero(known)]
        chances = better_than_chance(np.maximum(chances / chances.sum(axis=-1, keepdims=True), 1e-6))
        share = np.array([(by_class[1][kinds == k].sum() + 1) / (total[k] + 2) for k in range(len(names))])
        logs = np.log(np.stack([1 - share[kinds], share[kinds]]))
        own = np.log(np.maximum(chances[kinds], 1e-9))  # pattern, class, labeler, vote
        logs += np.einsum("pclv,plv->cp", own, cast)
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
        if np.abs(new - posterior).max() < 1e-9:
            break
        posterior = new
    return posterior, chances, seen


def estimate(patterns: Patterns, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of counted vote patterns and P(vote | class, labeler) over all kinds, for labelers of which nothing is known."""
    posterior, _, seen = estimate_by_kind(patterns, [0.7] * len(patterns[0][1]), rounds=rounds)
    every = seen.sum(axis=0) + 1
    return posterior, every / every.sum(axis=-1, keepdims=True)


def train(spans: DataFrame) -> SpanModel:
    """Trains on all candidates with votes; tasks count them by vote pattern and feature, the driver sees only the counts.

    There are at most as many counts as value combinations, whatever the corpus. The classifier is a ridge logistic
    regression on the posteriors that EM gives the patterns; each value has a weight for all kinds and one for its own.
    """
    names = ["kind", *LABELERS, "size", "base"]
    rows = _features(spans).groupBy(*names).agg(F.count("*").alias("n")).orderBy(*names).collect()
    if not rows:
        return SpanModel({}, {("", "", ""): -math.inf})
    patterns = [(r["kind"], tuple(r[name] for name in LABELERS), r["n"]) for r in rows]
    posterior, chances, _ = estimate_by_kind(
        patterns, [EXPECTED[name] for name in LABELERS], [name in KNOWN for name in LABELERS]
    )

    def values(row) -> list[tuple[str, str, str]]:
        own = [(name, str(row[name]).lower()) for name in names[1:]]
        return [(row["kind"], "", ""), *(("", *pair) for pair in own), *((row["kind"], *pair) for pair in own)]

    columns = sorted({key for r in rows for key in values(r)})
    place = {key: at for at, key in enumerate(columns, 1)}
    x = np.zeros((len(rows), len(columns) + 1))
    x[:, 0] = 1
    for at, r in enumerate(rows):
        x[at, [place[key] for key in values(r)]] = 1
    counts = np.array([r["n"] for r in rows], float)
    ridge = np.full(x.shape[1], 0.1)
    weights = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (counts * (posterior - p)) - ridge * weights
        curve = x.T @ (x * (counts * np.maximum(p * (1 - p), 1e-4))[:, None]) + np.diag(ridge)
        step = np.linalg.solve(curve, gradient)
        weights += step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    kinds = sorted({k for k, _, _ in patterns})
    reliabilities = {
        k: {c: {name: chances[at, c, place].tolist() for place, name in enumerate(LABELERS)} for c in (0, 1)} for at, k in enumerate(kinds)
    }
    return SpanModel(reliabilities, dict(zip([("", "", ""), *columns], weights.tolist(), strict=True)))


def _before(o: Column, m: Column) -> Column:
    """Whether a span stands in another's place: they overlap, and it is longer, or as long and earlier, or of an earlier kind."""
    longer, other = o["end"] - o["start"], m["end"] - m["start"]
    rank = F.struct(-longer, o["start"], o["kind_no"]) < F.struct(-other, m["start"], m["kind_no"])
    return (o["start"] < m["end"]) & (m["start"] < o["end"]) & rank


def personal_data(docs: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Personal data in documents (doc_id, text): doc_id, base and spans, arrays of (start, kind_no, end, kind) in order.

    `base` are the valid matches of the base patterns. `spans` are these and the candidates that are not, but that the
    classifier gives at least `threshold`; candidates that overlap a base span are none, and of added spans that overlap the
    first of the longest ones stays. Kinds of the method's own (`MORE_KINDS`) come after the others. Positions are code points, ends exclusive.

    Null text is empty; it and texts without candidates get empty arrays. Rows that repeat a doc_id and text get the same
    spans each; null ids are ids like others. An empty table gives no rows. Other columns are left out.

    Texts are read once and never shuffled: candidates, with a few code points around them, are written to the shared folder,
    counted for EM, scored, and joined with the ids.
    """
    keyed = docs.select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), F.coalesce("text", F.lit("")).alias("text")
    )
    spans = scratch(votes(candidates(keyed)).drop("match", "left", "right"), "candidates")
    model = train(spans)
    number = F.array_position(F.array(*map(F.lit, ALL_KINDS)), F.col("kind")).cast("int")
    span = F.struct("start", number.alias("kind_no"), "end", "kind")
    scored = _features(spans).where(F.col("valid") | (model.score() >= threshold))
    by_doc = scored.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.when(F.col("valid"), span)).alias("base"),
        F.collect_set(F.when(~F.col("valid"), span)).alias("more"),
    )
    apart = F.filter("more", lambda m: ~F.exists("more", lambda o: _before(o, m)))
    done = by_doc.select(
        "doc_id", "text_hash", F.array_sort("base").alias("base"), F.array_sort(F.array_union("base", apart)).alias("spans")
    ).alias("s")
    d = keyed.select("doc_id", "text_hash").alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.text_hash") == F.col("s.text_hash"))
    kind = done.schema["base"].dataType
    none = F.array().cast(kind)
    return d.join(done, same, "left").select(
        "d.doc_id", F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans")
    )


def span_list(spans: Column) -> Column:
    """`kind:start:end` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
