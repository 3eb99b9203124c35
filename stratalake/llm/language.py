"""Language identification: known words first, shorter and shorter character n-grams for the others."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.arrow_words import SpacedWords, slices, texts
from stratalake.llm.common import scratch
from stratalake.llm.labelled import bounded

LETTERS = regex.compile(r"\p{L}+")
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    """Log frequencies by language: of words, and of n-grams of different words; prior log shares of documents."""

    languages: list[str]
    prior: np.ndarray
    words: dict[str, int]
    word_logs: np.ndarray
    grams: dict[str, int]
    gram_logs: np.ndarray
    longest: int


def _logs(rows: list, languages: list[str], totals: np.ndarray) -> tuple[dict[str, int], np.ndarray]:
    """Smoothed log frequencies of the collected keys: a hundredth of a sighting is added to each language."""
    place, column = {}, {name: i for i, name in enumerate(languages)}
    counts = np.zeros((len({r["key"] for r in rows}), len(languages)), np.float64)
    for row in rows:
        counts[place.setdefault(row["key"], len(place)), column[row["lang"]]] = row["n"]
    return place, np.log((counts + 0.01) / (totals + 1)).astype(np.float32)


def train(
    docs: DataFrame, max_docs: int = 10_000, max_words: int = 100_000, max_grams: int = 100_000, longest: int = 5
) -> LanguageModel:
    """Learns from documents (doc_id, text, lang) that have a language.

    At most about `max_docs` documents are read, chosen by a hash of their ids and used with their whole texts, however
    large the table. Kept are the `max_words` words and the `max_grams` n-grams of 1 to `longest` letters (a space
    at either end of a word) that are most frequent in them: bounded tables that go to every task. Null texts teach nothing;
    without labelled rows the model knows no language.
    """
    labelled = bounded(docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull()), max_docs)
    labelled = scratch(labelled, "language-sample")
    shares = labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").collect()
    languages = [r["lang"] for r in shares]
    counted = scratch(
        labelled.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("key"))
        .groupBy("lang", "key")
        .agg(F.count("*").alias("n")),
        "language-words",
    )

    def kept(counts: DataFrame, most: int) -> tuple[list, list[str], np.ndarray]:
        top = counts.groupBy("key").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "key").limit(most)
        totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
        rows = counts.join(F.broadcast(top.select("key")), "key").orderBy("key", "lang").collect()
        return rows, languages, np.array([float(totals.get(name, 0)) for name in languages])

    padded = F.concat(F.lit(" "), "key", F.lit(" "))
    grams = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.lit(longest)),
            lambda n: F.when(
                F.length(padded) >= n,
                F.transform(F.sequence(F.lit(1), F.length(padded) - n + 1), lambda at: F.substring(padded, at, n)),
            ).otherwise(F.array().cast("array<string>")),
        )
    )
    gram_counts = scratch(
        counted.select("lang", F.explode(grams).alias("key")).where("key <> ' '").groupBy("lang", "key").agg(F.count("*").alias("n")),
        "language-grams",
    )
    words, word_logs = _logs(*kept(counted, max_words))
    gram_places, gram_logs = _logs(*kept(gram_counts, max_grams))
    known = np.array([float(r["n"]) for r in shares])
    return LanguageModel(languages, np.log(known / max(known.sum(), 1.0)), words, word_logs, gram_places, gram_logs, longest)


class Scorer:
    """Scores words by a model; a limited number of scores is kept."""

    KEPT = 60_000

    def __init__(self, model: LanguageModel):
        self.model = model
        self.none = np.zeros(len(model.languages), np.float32)
        self.scores: dict[str, np.ndarray] = {}

    def word(self, word: str) -> np.ndarray:
        """A known word's log frequencies, else the mean of its longest known n-grams', else nothing."""
        m = self.model
        if (at := m.words.get(word)) is not None:
            return m.word_logs[at]
        if (score := self.scores.get(word)) is None:
            padded = f" {word} "
            score = self.none
            for n in range(min(m.longest, len(padded)), 0, -1):
                known = [m.grams[g] for i in range(len(padded) - n + 1) if (g := padded[i : i + n]) in m.grams]
                if known:
                    score = m.gram_logs[known].mean(axis=0)
                    break
            if len(self.scores) >= self.KEPT:
                self.scores.clear()
            self.scores[word] = score
        return score

    def spaced(self, word: str) -> tuple[int, np.ndarray]:
        """How many runs of letters a word has, and the sum of their scores."""
        runs = LETTERS.findall(word)
        return len(runs), sum(map(self.word, runs), self.none)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The language of every whole text (doc_id, text): doc_id, lang_pred, score.

    A text's runs of letters, lower-cased, are scored by `Scorer.word`; sums and the prior give each language's
    probability, the highest of which is the score (of equal ones the language that comes first by name). Null texts and
    texts without a letter are `und` with score 0, as are all texts for a model without languages. A text of which the model
    knows nothing gets the most frequent language. Null doc_ids and repeated rows are kept row by row; other columns are
    left out.

    One pass, no shuffle; each different word of a few megabytes of text is looked up once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, languages = Scorer(shared.value), np.array([*shared.value.languages, UNKNOWN], object)
        for batch in batches:
            for piece in slices(batch):
                words = SpacedWords(texts(piece))
                each = [scorer.spaced(w.lower()) for w in words.distinct]
                runs = np.array([n for n, _ in each] or [0], np.int64)
                scores = np.array([s for _, s in each], np.float32).reshape(len(each), len(languages) - 1)
                n_rows = len(piece)
                letters = np.bincount(words.rows_of, weights=runs[words.codes], minlength=n_rows)
                best, chance = np.full(n_rows, len(languages) - 1), np.zeros(n_rows)
                if len(languages) > 1:
                    # of no words at all numpy gives whole numbers
                    sums = np.stack(
                        [np.bincount(words.rows_of, weights=s[words.codes], minlength=n_rows) for s in scores.T], axis=1, dtype=np.float64
                    )
                    sums += shared.value.prior
                    odds = np.exp(sums - sums.max(axis=1, keepdims=True))
                    some = letters > 0
                    best[some] = odds.argmax(axis=1)[some]
                    chance[some] = (odds.max(axis=1) / odds.sum(axis=1))[some]
                yield pa.record_batch(
                    [piece.column("doc_id"), pa.array(languages[best], pa.string()), pa.array(chance)],
                    names=["doc_id", "lang_pred", "score"],
                )

    columns = docs.select("doc_id", "text")
    kind = columns.schema["doc_id"].dataType.simpleString()
    return columns.mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double")
