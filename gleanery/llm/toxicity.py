"""Toxicity by a counterfactual-regularised classifier.

A logistic model over the words that a text holds. Beside the labelled texts it sees their counterfactuals, in which
identity terms are swapped for others of the same group, and a change of the score between the two is penalised, so that mentioning
a group says nothing by itself. The words worth a weight are found in Spark on a bounded sample of labelled rows; only the
sample's selected words reach the driver, where the weights are fitted; every text is then scored in its partition.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from gleanery.session import materialize

#: Labelled rows that are learned from, at most; words with a weight, at most; how surprising a word's counts must be.
SAMPLE_ROWS, WORDS, LEAST_CHI2, LEAST_TEXTS = 20_000, 4000, 15.0, 5
RIDGE, COUNTERFACTUAL, STEPS = 0.03, 4.0, 200
#: Terms that may stand for one another in a sentence, by group.
IDENTITY = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics", "protestants"),
    ("gay", "lesbian", "straight", "bisexual", "queer", "transgender", "heterosexual", "homosexual"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "indigenous"),
    ("man", "woman"),
    ("men", "women"),
    ("american", "mexican", "german", "french", "spanish", "chinese", "indian", "turkish", "polish"),
    ("deaf", "blind", "disabled", "autistic"),
    ("young", "old", "elderly"),
    ("homme", "femme"),
    ("hommes", "femmes"),
    ("mann", "frau"),
    ("männer", "frauen"),
    ("hombre", "mujer"),
    ("hombres", "mujeres"),
    ("chrétiens", "musulmans", "juifs"),
    ("christen", "muslime", "juden"),
    ("cristianos", "musulmanes", "judíos"),
)
WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    """The different words of a text, lower-cased; none for a null."""
    return set(WORD.findall(text.lower())) if text else set()


def counterfactual(found: set[str], groups: tuple[tuple[str, ...], ...] = IDENTITY) -> set[str] | None:
    """The words with every identity term replaced by the next of its group; None where there is none."""
    swaps = {term: group[(i + 1) % len(group)] for group in groups for i, term in enumerate(group)}
    if not any(w in swaps for w in found):
        return None
    return {swaps.get(w, w) for w in found}


@dataclass(frozen=True)
class Classifier:
    weights: dict[str, float]
    base: float

    def score(self, found: set[str]) -> float:
        total = self.base + math.fsum(self.weights[w] for w in found if w in self.weights)
        return 1 / (1 + math.exp(-min(max(total, -700.0), 700.0)))


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(words(t)) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found, pa.list_(pa.string()))], names=["label", "words"])


def fit(labelled: DataFrame, text: str = "text", label: str = "label", key: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> Classifier:
    """Learn from at most ``sample_rows`` rows with a label of 0 or 1, taken in the order of the hash of their key.

    Without both classes every text gets the share of toxic rows as its score (0 without rows).
    """
    rows = labelled.where(F.col(label).isin(0, 1)).select(F.col(text).alias("text"), F.col(label).cast("int").alias("label"))
    # Copies of a text count once, so that words of a text copied often are not taken for signs of its label.
    listed = materialize(rows.mapInArrow(_listed, "label int, words array<string>").distinct(), "toxicity-words")
    n, positive = listed.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < positive < n:
        return Classifier({}, 700.0 if n and positive else -700.0)
    # In texts of either class with and without a word: how far the counts are from independence.
    counted = listed.select("label", F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"), F.sum("label").alias("p"))
    expected = F.col("n") * positive / n
    spread = expected * (1 - F.col("n") / n) * (1 - positive / n)
    ranked = counted.withColumn("chi2", F.when(spread > 0, (F.col("p") - expected) ** 2 / spread).otherwise(0.0))
    chosen = ranked.where((F.col("n") >= LEAST_TEXTS) & (F.col("chi2") >= LEAST_CHI2)).orderBy(F.desc("chi2"), "word").limit(WORDS).collect()
    vocabulary = sorted({r["word"] for r in chosen} | {t for group in IDENTITY for t in group})
    place = {w: i for i, w in enumerate(vocabulary)}
    known = F.array(*[F.lit(w) for w in vocabulary])
    sample = listed.select("label", F.array_intersect("words", known).alias("words")).groupBy("label", "words").agg(F.count("*").alias("n")).collect()
    weights, base = _weights([(r["label"], r["n"], r["words"]) for r in sample], place)
    return Classifier({w: float(weights[i]) for w, i in place.items() if abs(weights[i]) > 1e-6}, base)


def _weights(sample: list[tuple[int, int, list[str]]], place: dict[str, int]) -> tuple[np.ndarray, float]:
    """Newton steps by conjugate gradients on the log loss, a ridge, and the squared change under counterfactuals."""

    def sparse(sets: list[tuple[int, list[str]]]) -> tuple[np.ndarray, np.ndarray]:
        pairs = [(row, place[w]) for row, found in sets for w in found if w in place]
        table = np.asarray(pairs, np.int64).reshape(-1, 2)
        return table[:, 0], table[:, 1]

    y, n = (np.array([s[i] for s in sample], float) for i in (0, 1))
    row, column = sparse(list(enumerate(s[2] for s in sample)))
    swapped = [(i, found) for i, s in enumerate(sample) if (found := counterfactual(set(s[2]))) is not None]
    other_row, other = sparse([(i, sorted(found)) for i, found in swapped])
    own = np.isin(row, [i for i, _ in swapped])
    m, size = len(sample), len(place)

    def times(v: np.ndarray) -> np.ndarray:
        return np.bincount(row, v[column], m) + v[-1]

    def change(v: np.ndarray) -> np.ndarray:
        return np.bincount(row[own], v[column[own]], m) - np.bincount(other_row, v[other], m)

    def back(u: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(column, u[row], size), u.sum())

    def change_back(u: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(column[own], u[row[own]], size) - np.bincount(other, u[other_row], size), 0.0)

    ridge = np.append(np.full(size, RIDGE), 1e-6)
    w = np.zeros(size + 1)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(times(w), -50, 50)))
        gradient = back(n * (p - y)) + COUNTERFACTUAL * change_back(n * change(w)) + ridge * w
        curve = n * np.maximum(p * (1 - p), 1e-6)
        step, rest = np.zeros(size + 1), -gradient
        direction, norm = rest.copy(), rest @ rest
        for _ in range(STEPS):
            if norm < 1e-10:
                break
            image = back(curve * times(direction)) + COUNTERFACTUAL * change_back(n * change(direction)) + ridge * direction
            size_of = norm / (direction @ image)
            step, rest = step + size_of * direction, rest - size_of * image
            direction, norm = rest + (rest @ rest) / norm * direction, rest @ rest
        w = w + step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _scored(model: Classifier, text: str, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frozenset(model.weights)
        for batch in batches:
            scores = [model.score(words(t) & known) for t in batch.column(text).to_pylist()]
            names = [n for n in batch.schema.names if n != out]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(scores, pa.float64())], names=[*names, out])

    return run


def scored(docs: DataFrame, model: Classifier, text: str = "text", out: str = "score") -> DataFrame:
    """The rows with the score of their whole text in ``out``, which replaces a column of that name.

    Null and empty texts get the score of a text without known words. All other columns and repeated rows stay.
    """
    kept = docs.drop(out)
    schema = StructType([*kept.schema.fields, StructField(out, DoubleType())])
    return kept.mapInArrow(_scored(model, text, out), schema)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> Classifier:
    """Fit on labelled documents whose crc32(key) modulo 5 is not 0, at most ``sample_rows`` of them in hash order.

    Of several labels for one key the largest counts; null keys and labels are left out.
    """
    usable = labels.where(F.col(key).isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(key))
    one = usable.groupBy(F.col(key).alias("__key")).agg(F.max("toxic").cast("int").alias("__label"))
    chosen = materialize(one.orderBy(F.xxhash64("__key"), "__key").limit(sample_rows), "toxicity-labels")
    # At most sample_rows short rows: a proven bound for sending them to every task.
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("text")).join(F.broadcast(chosen), "__key")
    return fit(rows, "text", "__label", "__key", sample_rows)


def held_out(key: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """key, held_out, score, predicted (1 from a score of 0.5) of every document. Cases as in :func:`scored`."""
    model = train(docs, labels, key, text, sample_rows)
    rows = scored(docs.select(F.col(key), F.col(text).alias("text")), model, "text", "score")
    return rows.select(key, held_out(key).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
