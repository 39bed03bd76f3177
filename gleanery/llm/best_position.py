"""Ranked lexical search by the Best Position Algorithm.

One pass over the documents counts the items' terms and writes one short row for each document that has a term. A second pass reads
these rows in fragments of bounded size. In a fragment every term has a list of its documents, highest impact first, and every item is answered by BPA: its lists are read in
step (sorted access), a document met in one of them is looked up in all others (direct access), and every position that either
access meets is marked. The best position of a list is the last one before the first gap in its marks; a document not met yet stands behind it in every list, so the
sum of the impacts there bounds its score. That bound lies below the one of last-read positions, as direct accesses fill gaps further down. An item stops where its
bound falls strictly below its k-th score, so that ties are settled by key. The k-th score is carried from fragment to fragment of a task.

Fragments are ranges of rows, not groups: documents are not shuffled, only k hits an item and task are.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gleanery.session import materialize

#: Bytes of item texts that are searched for at a time, which bounds what is sent to the executors; more items are taken in blocks.
BLOCK_BYTES = 8 << 20
#: Documents and postings of a fragment.
FRAGMENT_DOCS, FRAGMENT_POSTINGS = 1 << 16, 1 << 21
#: Positions that the first round reads of each list; every further round reads twice as many.
FIRST_ROUND = 32
#: Bytes of a text whose terms are held at a time.
TEXT_BYTES = 1 << 22
# Term bytes: digits, ASCII letters, lower-cased, and everything beyond ASCII; all else separates.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, in parts of bounded size."""
    start = 0
    while start < len(text):
        part = text[start : start + TEXT_BYTES].translate(_TERM_BYTES)
        cut = len(part)
        if start + cut < len(text) and (last := part.rfind(b" ")) >= 0:
            cut = last + 1
        elif start + cut < len(text):
            # One term fills the part: it goes on to its own end.
            rest = text[start:].translate(_TERM_BYTES)
            cut = rest.find(b" ") + 1 or len(rest)
            part = rest
        yield part[:cut].split()
        start += cut


@dataclass(frozen=True)
class Items:
    """Items of one block: ids, the numbers of their terms, and the numbers of all terms."""

    ids: list
    terms: list[np.ndarray]
    numbers: dict[bytes, int]

    @staticmethod
    def of(rows: list[tuple]) -> Items:
        """From (id, text). An id that repeats is one item with the terms of all its rows; a null text has none."""
        found: dict = {}
        for item, text in rows:
            own = found.setdefault(item, set())
            for part in terms((text or "").encode()):
                own.update(part)
        numbers = {term: n for n, term in enumerate(sorted(set().union(*found.values())))}
        return Items(list(found), [np.array(sorted(numbers[t] for t in own), np.int64) for own in found.values()], numbers)


def counted(docs: DataFrame, items: Items, key: str = "doc_id", text: str = "text") -> DataFrame:
    """__key, n, terms, tfs of every document with a term: all its terms, and the items' terms among them with their occurrences."""
    shared = docs.sparkSession.sparkContext.broadcast(items.numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            at, totals, lists = [], [], []
            texts = batch.column("text").cast(pa.binary())
            for i in range(batch.num_rows):
                total, counts = 0, Counter()
                for part in terms(texts[i].as_py() or b""):
                    total += len(part)
                    counts.update(map(number, part))
                if total:
                    counts.pop(None, None)
                    at.append(i)
                    totals.append(total)
                    lists.append(counts)
            ends = pa.array(np.cumsum([0, *map(len, lists)]), pa.int32())
            known = pa.array([t for c in lists for t in c], pa.int32())
            tfs = pa.array([n for c in lists for n in c.values()], pa.int64())
            columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(totals, pa.int64()), pa.ListArray.from_arrays(ends, known), pa.ListArray.from_arrays(ends, tfs)]
            yield pa.RecordBatch.from_arrays(columns, names=["__key", "n", "terms", "tfs"])

    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"__key {rows.schema[0].dataType.simpleString()}, n long, terms array<int>, tfs array<long>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Best:
    """The k best (score, key) of an item so far: highest score first, then the smallest key, null keys last."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    @property
    def kth(self) -> int:
        """The score that a further document must reach; 1 while there are fewer than k."""
        return self.rows[-1][0] if len(self.rows) == self.k else 1

    def offer(self, scores: np.ndarray, keys: pa.Array) -> None:
        fit = np.flatnonzero(scores >= self.kth)
        if len(fit) > self.k:
            # Ties with the k-th of them stay, their keys decide.
            fit = fit[scores[fit] >= np.partition(scores[fit], len(fit) - self.k)[len(fit) - self.k]]
        if len(fit):
            found = zip(scores[fit].tolist(), keys.take(pa.array(fit)).to_pylist(), strict=True)
            self.rows = sorted([*self.rows, *found], key=_order)[: self.k]


def _order(hit: tuple) -> tuple:
    score, key = hit
    return (-score, key is None, 0 if key is None else key)


class Fragment:
    """Documents with their postings, by document and by term."""

    def __init__(self, keys: pa.Array, n: np.ndarray, starts: np.ndarray, term: np.ndarray, tf: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int):
        self.keys, self.starts, self.term = keys, starts, term
        doc = np.repeat(np.arange(len(n)), np.diff(starts))
        m = 50 + (50 * n * n_docs) // n_terms
        self.impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
        order = np.lexsort((doc, -self.impact, term))
        self.docs, self.impacts = doc[order], self.impact[order]
        self.lists = np.searchsorted(term[order], np.arange(len(weights) + 1))
        self.position = np.empty(len(term), np.int64)
        self.position[order] = np.arange(len(term)) - self.lists[term[order]]

    def search(self, own: np.ndarray, best: Best, slot: np.ndarray) -> int:
        """Offer the documents that can be among the best for the terms ``own``; returns how many were scored. ``slot`` is scratch
        space: -1 for every term."""
        own = own[self.lists[own + 1] > self.lists[own]]
        if not len(own):
            return 0
        slot[own] = np.arange(len(own))
        heads, sizes = self.lists[own], self.lists[own + 1] - self.lists[own]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        # A mark for every position, and one behind each list that is never set: the gap that ends it.
        marks = np.zeros(offsets[-1] + len(own), bool)
        offsets = offsets[:-1] + np.arange(len(own))
        seen, gap = np.zeros(len(self.keys), bool), np.zeros(len(own), np.int64)
        depth, step, scored = 0, FIRST_ROUND, 0
        while depth < sizes.max():
            read = [self.docs[h + depth : h + min(depth + step, s)] for h, s in zip(heads, sizes, strict=True) if s > depth]
            fresh = np.unique(np.concatenate(read))
            fresh = fresh[~seen[fresh]]
            if len(fresh):
                seen[fresh] = True
                scored += len(fresh)
                best.offer(self._look_up(fresh, slot, offsets, marks), self.keys.take(pa.array(fresh)))
            depth, step = depth + step, 2 * step
            bound = 0
            for i in range(len(own)):
                first = offsets[i] + gap[i]
                gap[i] += np.argmin(marks[first : offsets[i] + sizes[i] + 1])
                if gap[i] < sizes[i]:
                    bound += int(self.impacts[heads[i] + gap[i]])
            if bound < best.kth:
                break
        slot[own] = -1
        return scored

    def _look_up(self, docs: np.ndarray, slot: np.ndarray, offsets: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """Scores of documents from all lists, marking where they stand there."""
        counts = self.starts[docs + 1] - self.starts[docs]
        ends = np.cumsum(counts)
        at = np.arange(ends[-1]) + np.repeat(self.starts[docs] - ends + counts, counts)
        lists = slot[self.term[at]]
        of, at, lists = np.repeat(np.arange(len(docs)), counts)[lists >= 0], at[lists >= 0], lists[lists >= 0]
        marks[offsets[lists] + self.position[at]] = True
        scores = np.zeros(len(docs), np.int64)
        np.add.at(scores, of, self.impact[at])
        return scores


def _searched(items: Items, weights: np.ndarray, n_docs: int, n_terms: int, k: int, fields: list[T.StructField]):
    """k hits of every item from the rows of a task, fragment by fragment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, slot = [Best(k) for _ in items.ids], np.full(len(weights), -1, np.int64)
        for rows in _fragments(batches):
            starts = np.concatenate([[0], np.cumsum(rows.column("terms").combine_chunks().value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            flat = [pc.list_flatten(rows.column(c).combine_chunks()).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("terms", "tfs")]
            fragment = Fragment(rows.column("__key").combine_chunks(), rows.column("n").to_numpy(), starts, *flat, weights, n_docs, n_terms)
            for own, found in zip(items.terms, best, strict=True):
                fragment.search(own, found, slot)
        hits = [(item, score, key) for item, found in zip(items.ids, best, strict=True) for score, key in found.rows]
        kinds = to_arrow_schema(T.StructType(fields))
        columns = zip(*hits, strict=True) if hits else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)

    return run


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, docs, postings = [], 0, 0
    for batch in batches:
        sizes = np.cumsum(batch.column("terms").value_lengths().to_numpy(zero_copy_only=False))
        held.append(batch)
        docs, postings = docs + batch.num_rows, postings + (int(sizes[-1]) if len(sizes) else 0)
        if docs >= FRAGMENT_DOCS or postings >= FRAGMENT_POSTINGS:
            yield pa.Table.from_batches(held)
            held, docs, postings = [], 0, 0
    if docs:
        yield pa.Table.from_batches(held)


def search(docs: DataFrame, items: DataFrame, k: int = 50, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """item key, rank (from 1), key, score: the k documents of the highest score above 0 for each item, ties to the smaller key.

    Every row is a document, so rows that repeat are ranked one after another. A null key comes last among equal scores. Documents
    without a term, null texts among them, count for nothing. An item without terms finds nothing; rows that repeat an item's id are one item with
    the terms of all. An empty table on either side gives no rows; long texts are read in parts; other columns are ignored,
    whatever their names.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_key).alias("item"), F.col(item_text).alias("text"))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = math.ceil(size / BLOCK_BYTES) or 1
    fields = [T.StructField(item_key, asked.schema["item"].dataType), T.StructField("score", T.LongType()), T.StructField("__key", docs.schema[key].dataType)]
    found = None
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).collect()
        own = Items.of([tuple(row) for row in rows])
        hits = _block(docs, own, k, key, text, fields)
        found = hits if found is None else found.unionByName(hits)
    order = Window.partitionBy(item_key).orderBy(F.desc("score"), F.asc_nulls_last("__key"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(item_key, "rank", F.col("__key").alias(key), "score")


def _block(docs: DataFrame, items: Items, k: int, key: str, text: str, fields: list[T.StructField]) -> DataFrame:
    rows = materialize(counted(docs, items, key, text), "search-terms")
    n_docs, n_terms = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One row a term of the block's items, whose texts are bounded.
    held = rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weights = np.zeros(len(items.numbers), np.int64)
    for term, df in held:
        weights[term] = weight(n_docs, df)
    return rows.mapInArrow(_searched(items, weights, n_docs, max(1, n_terms), k, fields), T.StructType(fields))
