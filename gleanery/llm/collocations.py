"""Phrases whose words stand together more often than chance, by ERA-style vertical partitioning.

Counting. Words are counted first, then prefixes of two words; phrases below the least frequency end there, as none of their extensions
can reach it. The prefixes that remain are grouped so that the suffixes that start with them fit a budget of memory; a prefix
above the budget is extended, here at once to the whole truncated suffix. Every suffix is cut after ``MOST`` words, and where its next two words are no
frequent prefix. Each group builds its subtree on its own: its suffixes in order are the leaves, equal beginnings of neighbours the nodes, and
the count of a node is the total of its leaves. Groups are ranges of the prefixes' hash, so no table of all prefixes is needed to find a
suffix's group, and frequent prefixes are told by a bitmap of fixed size, whose rare false hits cost a row and no more: a subtree
counts the words themselves.

Scoring. Cuts, scores and inclusion are joins on the counted phrases, whose number follows the frequent phrases and not the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.words import mixed, slices
from gleanery.session import materialize

LEAST, MOST, FIRST = 100, 5, 2000
UNKNOWN_LANG = "und"
#: Occurrences of prefixes that a group takes; more where the text is so large that there would be more than ``GROUPS`` groups.
BUDGET, GROUPS = 1 << 18, 1 << 20
#: Bits that tell frequent prefixes, 16 MB.
FILTER_BITS = 1 << 27
#: The prefixes' hashes fall into so many ranges; a group is a run of them.
RANGES = 1 << 16
#: Bytes of text that a task takes at a time, and rows that it combines before it hands them on.
TEXT_BYTES, COMBINED = 1 << 21, 1 << 19
BREAK = "."
U = np.uint64


class Words:
    """Words of a slice of rows: lang and word as codes, -1 for a break between pieces."""

    def __init__(self, part: pa.RecordBatch):
        texts = pc.replace_substring_regex(pc.ascii_lower(pc.fill_null(part.column("text"), "")), r"[.,;:!?\n\x0b\x0c\r]", f" {BREAK} ")
        lists = pc.ascii_split_whitespace(texts)
        flat = lists.flatten()
        rows = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
        keep = pc.not_equal(pc.binary_length(flat), 0)
        rows, coded = rows[keep.to_numpy(zero_copy_only=False)], flat.filter(keep).dictionary_encode()
        self.words = coded.dictionary
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        gap = pc.index(self.words, BREAK).as_py()
        self.code = np.where(code == gap, -1, code) if gap >= 0 else code
        langs = pc.fill_null(part.column("lang"), UNKNOWN_LANG).dictionary_encode()
        self.langs = langs.dictionary
        self.lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[rows]
        self.row = rows

    def pairs(self) -> np.ndarray:
        """The hash of every two words next to each other in one piece, by the place of the first; 0 where there are none."""
        out = np.zeros(len(self.code), U)
        if len(out) > 1:
            hashes = pd.util.hash_array(self.words.to_numpy(zero_copy_only=False).astype(object), categorize=False)
            lang = pd.util.hash_array(self.langs.to_numpy(zero_copy_only=False).astype(object), categorize=False)
            own = (self.code[:-1] >= 0) & (self.code[1:] >= 0) & (self.row[:-1] == self.row[1:])
            at = np.flatnonzero(own)
            with np.errstate(over="ignore"):
                out[at] = mixed(mixed(hashes[self.code[at]] + lang[self.lang[at]]) * U(3) + hashes[self.code[at + 1]])
        return out


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", TEXT_BYTES):
            words = Words(part)
            own = words.code >= 0
            both, n = np.unique(words.lang[own] * len(words.words) + words.code[own], return_counts=True)
            columns = [words.langs.take(pa.array(both // max(1, len(words.words)))), words.words.take(pa.array(both % max(1, len(words.words)))), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "n"])


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash and count of pairs, combined over the slices of a task while they are few enough."""
    keys, counts = np.empty(0, U), np.empty(0, np.int64)
    for batch in batches:
        for part in slices(batch, "text", TEXT_BYTES):
            pairs = Words(part).pairs()
            found, n = np.unique(pairs[pairs > 0], return_counts=True)
            keys, at = np.unique(np.concatenate([keys, found]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, n]), minlength=len(keys)).astype(np.int64)
            if len(keys) > COMBINED:
                yield _counts(keys, counts)
                keys, counts = np.empty(0, U), np.empty(0, np.int64)
    if len(keys):
        yield _counts(keys, counts)


def _counts(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["pair", "n"])


class Partition:
    """What a task needs to deal out suffixes: the bitmap of frequent prefixes, those above the budget, and each range's group."""

    def __init__(self, bitmap: np.ndarray, large: np.ndarray, group: np.ndarray):
        self.bitmap, self.large, self.group = bitmap, large, group

    @staticmethod
    def of(frequent: DataFrame, budget: int = BUDGET) -> Partition:
        """From the frequent prefixes (pair, n)."""
        total = frequent.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        budget = max(budget, total // GROUPS)
        # Fewer than total / budget, that is GROUPS, are above the budget.
        large = sorted((r["pair"] % 2**64, r["n"]) for r in frequent.where(F.col("n") > budget).collect())
        load = np.full(RANGES, sum(n for _, n in large) / RANGES)
        of = F.shiftrightunsigned("pair", 64 - 16)
        for at, n in frequent.where(F.col("n") <= budget).groupBy(of).agg(F.sum("n")).collect():
            load[at] += n
        group, held = np.zeros(RANGES, np.int32), 0.0
        for at in range(1, RANGES):
            held += load[at - 1]
            full = held + load[at] > budget
            group[at] = group[at - 1] + full
            held = 0.0 if full else held
        return Partition(_bitmap(frequent), np.array([p for p, _ in large], U), group)

    def frequent(self, pairs: np.ndarray) -> np.ndarray:
        bit = pairs & U(FILTER_BITS - 1)
        return (pairs > 0) & ((self.bitmap[bit >> U(3)] >> (bit & U(7)).astype(np.uint8)) & 1).astype(bool)


def _bitmap(frequent: DataFrame) -> np.ndarray:
    """A bit for every frequent prefix, made in Spark in blocks of 4 KB."""
    bit = F.col("pair").bitwiseAND(F.lit(FILTER_BITS - 1).cast("long")) + 1
    blocks = frequent.groupBy(F.bitmap_bucket_number(bit).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for block, bits in blocks.toLocalIterator():
        out[(block - 1) * 4096 : (block - 1) * 4096 + len(bits)] = np.frombuffer(bits, np.uint8)
    return out


def _suffixes(partition: Partition):
    """part, lang, suffix, whole, n: the truncated suffixes of two words or more. ``whole`` tells that all suffixes with this prefix are in this group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                found = _of_slice(Words(part), partition)
                held.append(found)
                rows += found.num_rows
                if rows > COMBINED:
                    held = [_combined(held)]
                    rows = held[0].num_rows
                    if rows > COMBINED // 2:
                        yield from held.pop().to_batches()
                        rows = 0
                        # What Arrow keeps for reuse would stay with the worker, beside the next stages.
                        pa.default_memory_pool().release_unused()
        if held:
            yield from _combined(held).to_batches()
            held.clear()
            pa.default_memory_pool().release_unused()

    return run


def _combined(tables: list[pa.Table]) -> pa.Table:
    names = ["part", "lang", "suffix", "whole"]
    # One thread: each would hold groups of its own.
    return pa.concat_tables(tables).group_by(names, use_threads=False).aggregate([("n", "sum")]).rename_columns([*names, "n"]).combine_chunks()


def _of_slice(words: Words, partition: Partition) -> pa.Table:
    pairs = words.pairs()
    go = partition.frequent(pairs)
    start = np.flatnonzero(go)
    matrix = np.full((len(start), MOST + 1), -1, np.int64)
    matrix[:, 0] = words.lang[start]
    matrix[:, 1], alive = words.code[start], np.ones(len(start), bool)
    for k in range(1, MOST):
        alive &= go[np.minimum(start + k - 1, len(go) - 1)]
        matrix[alive, k + 1] = words.code[start[alive] + k]
    order = np.lexsort(matrix.T[::-1])
    matrix, pair = matrix[order], pairs[start[order]]
    first = np.flatnonzero((np.diff(matrix, axis=0, prepend=np.full((1, MOST + 1), -2)) != 0).any(axis=1))
    counts, matrix, pair = np.diff(first, append=len(matrix)), matrix[first], pair[first]
    columns = [words.words.take(pa.array(c, mask=c < 0)) for c in matrix[:, 1:].T]
    suffix = pc.binary_join_element_wise(*columns, " ", null_handling="skip")
    large = np.isin(pair, partition.large)
    if large.any():
        texts = suffix.filter(pa.array(large)).to_numpy(zero_copy_only=False).astype(object)
        pair[large] = mixed(pd.util.hash_array(texts, categorize=False))
    group = partition.group[(pair >> U(48)).astype(np.int64)]
    lang = words.langs.take(pa.array(matrix[:, 0]))
    return pa.table([pa.array(group, pa.int32()), lang, suffix, pa.array(~large), pa.array(counts, pa.int64())], names=["part", "lang", "suffix", "whole", "n"])


def _subtree(least: int):
    """The nodes of a group's suffix subtree: lang, phrase, size, n."""

    def build(group: pa.Table) -> pa.Table:
        split = pc.split_pattern(group.column("suffix").combine_chunks(), " ")
        lengths = split.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        coded, langs = split.flatten().dictionary_encode(), group.column("lang").combine_chunks().dictionary_encode()
        rows = np.repeat(np.arange(len(lengths)), lengths)
        leaves = np.full((len(lengths), MOST + 1), -1, np.int64)
        leaves[:, 0] = langs.indices.to_numpy(zero_copy_only=False)
        leaves[rows, 1 + np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = coded.indices.to_numpy(zero_copy_only=False)
        order = np.lexsort(leaves.T[::-1])
        leaves, n = leaves[order], group.column("n").to_numpy()[order]
        least_of = np.where(group.column("whole").to_numpy()[order], least, 1)
        # Where two neighbours part: a node ends where they differ in one of its words.
        differ = (np.diff(leaves, axis=0, prepend=np.full((1, MOST + 1), -2)) != 0).argmax(axis=1)
        differ[(leaves[1:] == leaves[:-1]).all(axis=1).nonzero()[0] + 1] = MOST + 1
        tables = []
        for size in range(2, MOST + 1):
            first = np.flatnonzero(differ <= size)
            total = np.add.reduceat(n, first)
            keep = (leaves[first, size] >= 0) & (total >= least_of[first])
            first, total = first[keep], total[keep]
            phrase = pc.binary_join_element_wise(*[coded.dictionary.take(pa.array(leaves[first, k])) for k in range(1, size + 1)], " ")
            tables.append(pa.table([langs.dictionary.take(pa.array(leaves[first, 0])), phrase, pa.array(np.full(len(first), size, np.int32)), pa.array(total)], names=["lang", "phrase", "size", "n"]))
        return pa.concat_tables(tables)

    return build


def phrase_counts(docs: DataFrame, least: int = LEAST, text: str = "text", lang: str = "lang", budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """(counts, totals): lang, phrase, size, n of all words and phrases of up to ``MOST`` words that occur ``least`` times, and all
    words of each lang as lang, words."""
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    words = rows.mapInArrow(_word_counts, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    words = materialize(words, "phrase-words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("words"))
    pairs = rows.mapInArrow(_pair_counts, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    partition = Partition.of(materialize(pairs, "phrase-prefixes"), budget)
    suffixes = rows.mapInArrow(_suffixes(partition), "part int, lang string, suffix string, whole boolean, n long")
    nodes = suffixes.groupBy("part").applyInArrow(_subtree(least), "lang string, phrase string, size int, n long")
    nodes = nodes.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    single = words.where(F.col("n") >= least).select("lang", "phrase", F.lit(1).alias("size"), "n")
    return materialize(nodes.unionByName(single), "phrase-nodes"), totals


def _first_words(phrase: Column, count: Column) -> Column:
    return F.call_function("substring_index", phrase, F.lit(" "), count)


def _last_words(phrase: Column, count: Column) -> Column:
    return F.call_function("substring_index", phrase, F.lit(" "), -count)


def collocations(docs: DataFrame, least: int = LEAST, first: int = FIRST, text: str = "text", lang: str = "lang", budget: int = BUDGET) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``first`` phrases of each lang by score, count and text.

    A phrase of 2 to ``MOST`` words that occurs a >= ``least`` times in pieces of the texts of its lang is cut where a * n / (l * r) is
    lowest, l and r being the counts of both parts and n all words of the lang; a thousand times that, rounded down, is its score. Phrases within a longer one that
    is as frequent are left out. Null langs count as ``und``; null, empty and wordless texts add nothing; rows that repeat count each;
    a long text is one slice of its own. Without a frequent phrase, as in an empty table, the result is empty; other columns are ignored, whatever their names.
    """
    counts, totals = phrase_counts(docs, least, text, lang, budget)
    phrases = counts.where("size > 1")
    cuts = phrases.select("lang", "phrase", "size", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumns({"left": _first_words(F.col("phrase"), F.col("k")), "right": _last_words(F.col("phrase"), F.col("size") - F.col("k"))})
    for side, out in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(out)), ["lang", side])
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")}
    # Counts stay below 10 ** 16, so products of two fit 38 digits; the integral division of decimals is exact.
    above = (wide["a"] * 1000).cast("decimal(22,0)") * F.col("words").cast("decimal(16,0)")
    score = F.call_function("div", above, (wide["l"] * wide["r"]).cast("decimal(38,0)"))
    scored = cuts.join(totals, "lang").withColumn("score", score)
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r", "words")).alias("cut"))
    # A phrase within a longer one of its frequency is within one longer by a word, at its start or end.
    within = phrases.where("size > 2").select("lang", F.col("n").alias("a"), "phrase", "size")
    parts = F.array(_first_words(F.col("phrase"), F.col("size") - 1), _last_words(F.col("phrase"), F.col("size") - 1))
    within = within.select("lang", "a", F.explode(parts).alias("phrase")).distinct()
    kept = lowest.join(within, ["lang", "phrase", "a"], "left_anti")
    found = kept.select("lang", "phrase", "a", "cut.l", "cut.r", F.col("cut.words").alias("n"), "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
