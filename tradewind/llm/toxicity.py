"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: lower case, compatibility forms, homoglyphs and digits or
signs that stand for letters become that letter, everything else a space. The
lexicon holds words and word beginnings with the log odds of toxic against clean
documents that have them, learned from labelled rows. A word counts once, by
its heaviest entry, unless it lies in an exception phrase. The weights found in a
text, as they are and normalised by its length, give the score by a logistic fit.

The fit sees at most SAMPLE_ROWS labelled rows of each class, chosen by a hash of
their ids. Null and empty texts have no hit and score like any clean text. Labels
that are null are not used; a document labelled both ways counts as toxic. Without
labelled rows of both classes no word is known and every score is 0. Repeated
rows are scored each.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.shared import ROW_KEY, keyed, without_rows, written

#: Labelled rows of each class that the lexicon and the fit see.
SAMPLE_ROWS = 10_000
#: Entries of the lexicon, and what an entry must show: documents, log odds, and their ratio to the standard error.
#: It weighs its log odds less one standard error.
ENTRIES = 2_000
LEAST_DOCUMENTS = 3
LEAST_ODDS = 1.5
LEAST_RATIO = 2.5
#: Lengths of the word beginnings that may become entries.
STEMS = (4, 5, 6, 7, 8)
#: Learned exception phrases: a hit with a neighbouring word, in so many clean documents and no toxic one.
LEAST_EXCEPTION = 5
THRESHOLD = 0.3
#: Words that a text counts as longer when hits are normalised.
PRIOR_WORDS = 50

# Characters that stand for a letter.
LOOKALIKES = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i",
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ɡ": "g", "ı": "i",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
}
# Phrases in which a lexicon word is harmless.
EXCEPTIONS = ("clown fish", "trash bag", "trash bin", "trash can", "pond scum")


class Folding(dict):
    """For ``str.translate``: works out each character once."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        plain = unicodedata.normalize("NFKC", char.lower())
        folded = "".join(LOOKALIKES.get(c, c) for c in plain)
        self[code] = value = folded if folded.isalpha() else ("" if unicodedata.category(char) in ("Mn", "Cf") else " ")
        return value


FOLDING = Folding()


#: Signs that stand for a letter only in front of another one: elsewhere they end sentences.
SIGNS = re.compile(r"[!|$@]+(?![^\W_])")


def fold(text: str | None) -> str:
    return f" {SIGNS.sub(' ', text or '').translate(FOLDING)} "


class Lexicon:
    """Entries: (pattern, weight); a pattern begins with a space, and ends with one if it is a whole word."""

    def __init__(self, entries: Sequence[tuple[str, float]], exceptions: Sequence[str] = ()) -> None:
        self.automaton = ahocorasick.Automaton()
        for phrase in exceptions:
            pattern = f" {' '.join(fold(phrase).split())} "
            self.automaton.add_word(pattern, (len(pattern), None))
        for pattern, weight in entries:
            self.automaton.add_word(pattern, (len(pattern), weight))
        self.empty = not entries
        if not self.empty:
            self.automaton.make_automaton()

    def hits(self, folded: str) -> dict[int, float]:
        """Weight by where the word begins."""
        found, excused = {}, []
        if self.empty:
            return found
        for end, (length, weight) in self.automaton.iter(folded):
            start = end - length + 1
            if weight is None:
                excused.append((start, end))
            else:
                found[start] = max(weight, found.get(start, 0.0))
        if excused:
            found = {s: w for s, w in found.items() if not any(a <= s < b for a, b in excused)}
        return found


def joined(text: str | None) -> tuple[str, int]:
    """The folded text with single spaces, and its words."""
    words = fold(text).split()
    return f" {' '.join(words)} ", len(words)


def labelled_sample(documents: DataFrame, labels: DataFrame, learn: Column) -> tuple[DataFrame, int, int]:
    """(text, toxic) of at most SAMPLE_ROWS rows of each class, and how many rows either class has."""
    known = (
        labels.where(learn & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))
    )
    known = written(known, "toxic-labels")
    totals = dict(known.groupBy("toxic").count().collect())
    order = F.xxhash64(F.lit("sample"), "doc_id")
    chosen = [known.where(F.col("toxic") == k).orderBy(order, "doc_id").limit(SAMPLE_ROWS) for k in (0, 1)]
    # At most 2 * SAMPLE_ROWS pairs of numbers.
    chosen = F.broadcast(chosen[0].union(chosen[1]).withColumnRenamed("doc_id", "__tw_id"))
    texts = documents.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("__tw_id"))
    sample = texts.groupBy("text").agg(F.max("toxic").alias("toxic"))  # copies count once
    return written(sample, "toxic-sample"), totals.get(1, 0), totals.get(0, 0)


def learn_entries(sample: DataFrame) -> list[tuple[str, float]]:
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic"), strict=True):
                words = {w for w in fold(text.as_py()).split() if len(w) > 2}
                terms = {f" {w[:n]}" for w in words for n in STEMS if len(w) > n} | {f" {w} " for w in words}
                seen[toxic.as_py()].update(terms)
        terms = list(seen[0].keys() | seen[1].keys())
        counts = [pa.array([seen[k][t] for t in terms], pa.int64()) for k in (1, 0)]
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *counts], ["term", "toxic", "clean"])

    toxic, clean = (sample.where(F.col("toxic") == k).count() for k in (1, 0))
    if not toxic or not clean:
        return []
    t, c = F.col("t") + 0.5, F.col("c") + 0.5
    odds = F.log(t / (toxic + 1)) - F.log(c / (clean + 1))
    scored = (
        sample.mapInArrow(counted, "term string, toxic long, clean long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
        .where(F.col("t") >= LEAST_DOCUMENTS)
        .select("term", odds.alias("odds"), F.sqrt(1 / t + 1 / c).alias("error"))
        .where((F.col("odds") >= LEAST_ODDS) & (F.col("odds") >= LEAST_RATIO * F.col("error")))
        .select("term", (F.col("odds") - F.col("error")).alias("weight"), (F.col("odds") / F.col("error")).alias("ratio"))
    )
    best = scored.orderBy(F.desc("ratio"), F.desc(F.length("term")), "term").limit(ENTRIES).collect()
    entries: dict[str, float] = {}
    for term, value, _ in best:  # a word goes with the beginning that shows more
        if not any(term[:n] in entries for n in range(len(term))):
            entries[term] = value
    return list(entries.items())


def learn_exceptions(sample: DataFrame, entries: list[tuple[str, float]]) -> list[str]:
    """Hits with the word before or behind them that only clean documents have."""

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(entries)
        for batch in batches:
            found, labels = [], []
            for text, toxic in zip(batch.column("text"), batch.column("toxic"), strict=True):
                folded, _ = joined(text.as_py())
                own = set()
                for start in lexicon.hits(folded):
                    word, _, rest = folded[start + 1 :].partition(" ")
                    before, after = folded[: start].rpartition(" ")[2], rest.partition(" ")[0]
                    own |= {f"{before} {word}", f"{word} {after}"}
                own = sorted(x for x in own if x == x.strip())
                found += own
                labels += [toxic.as_py()] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(labels, pa.int32())], ["phrase", "toxic"])

    if not entries:
        return []
    counts = (
        sample.mapInArrow(phrases, "phrase string, toxic int")
        .groupBy("phrase")
        .agg(F.count("*").alias("n"), F.max("toxic").alias("toxic"))
        .where((F.col("toxic") == 0) & (F.col("n") >= LEAST_EXCEPTION))
    )
    return [r[0] for r in counts.orderBy(F.desc("n"), "phrase").limit(ENTRIES).collect()]


def features(weight: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(weight)), np.log1p(weight), np.log1p(100 * weight / (words + PRIOR_WORDS))], 1)


def measured(texts: pa.Array, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weight, hits, words) of each text."""
    weight, hits, words = np.zeros(len(texts)), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        folded, words[k] = joined(text.as_py())
        found = lexicon.hits(folded)
        weight[k], hits[k] = sum(found.values()), len(found)
    return weight, hits, words


def fit(x: np.ndarray, y: np.ndarray, sample_weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method, with a small ridge."""
    b = np.zeros(x.shape[1])
    ridge = np.diag([1e-6, *[1e-2] * (x.shape[1] - 1)]) * max(1.0, sample_weight.sum() / 1000)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (sample_weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, x.T @ (sample_weight * (y - p)) - ridge @ b)
        b += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return b


class Model:
    """Entries, exceptions and the coefficients of the score."""

    def __init__(self, entries: list, exceptions: list, coefficients: np.ndarray | None) -> None:
        self.entries, self.exceptions, self.coefficients = entries, exceptions, coefficients

    def score(self, weight: np.ndarray, words: np.ndarray) -> np.ndarray:
        if self.coefficients is None:
            return np.zeros(len(weight))
        return 1 / (1 + np.exp(-np.clip(features(weight, words) @ self.coefficients, -30, 30)))


def train(documents: DataFrame, labels: DataFrame, learn: Column) -> Model:
    """``learn``: a condition on the labels' rows; only those are learned from."""
    sample, toxic, clean = labelled_sample(documents, labels, learn)
    entries = learn_entries(sample)
    exceptions = [*EXCEPTIONS, *learn_exceptions(sample, entries)]
    if not entries:
        return Model([], [], None)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(entries, exceptions)
        for batch in batches:
            weight, _, words = measured(batch.column("text"), lexicon)
            columns = [pa.array(weight), pa.array(words), batch.column("toxic")]
            yield pa.RecordBatch.from_arrays(columns, ["weight", "words", "toxic"])

    rows = sample.mapInArrow(measure, "weight double, words long, toxic int").toArrow()  # 2 * SAMPLE_ROWS at most
    y = rows.column("toxic").to_numpy()
    # The classes count as often as the labels have them.
    share = np.where(y == 1, toxic / max(1, (y == 1).sum()), clean / max(1, (y == 0).sum()))
    x = features(rows.column("weight").to_numpy(), rows.column("words").to_numpy())
    return Model(entries, exceptions, fit(x, y, share * len(y) / share.sum()))


def score_documents(documents: DataFrame, model: Model) -> DataFrame:
    """Per document row: doc_id, row key, score, n_hits, n_words."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.entries, model.exceptions)
        for batch in batches:
            weight, hits, words = measured(batch.column("text"), lexicon)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column(ROW_KEY), pa.array(model.score(weight, words)), pa.array(hits), pa.array(words)],
                ["doc_id", ROW_KEY, "score", "n_hits", "n_words"],
            )

    return keyed(documents).mapInArrow(scored, f"doc_id long, {ROW_KEY} long, score double, n_hits long, n_words long")


def learned_rows() -> Column:
    """Rows held out of learning are those whose crc32 of the id, modulo 4, is 2."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 != 2


def drop_toxic(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored below the threshold, with their own columns."""
    model = train(documents, labels, learned_rows())
    toxic = score_documents(documents, model).where(F.col("score") >= threshold)
    return without_rows(documents, toxic)
