"""Packing of tokenised documents into sequences, shortest pack first over the length histogram.

Documents are cut into pieces of at most a sequence. Only the histogram of piece lengths (at most one count for each
length) reaches the driver: lengths are placed longest first, each into the packs that hold least so far and still have
room, and what is kept are patterns (lists of lengths) with counts. Pieces then find their place by rank: the
r-th piece of a length belongs to the pattern whose range of that length holds r.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.session import materialize

SEQUENCE = 2048
END = 1
#: Words that a worker remembers the ids of; beyond it the memory starts anew.
REMEMBERED = 500_000
PIECES = "start long, length long, ids_crc32 long, doc_tokens long"


@lru_cache(maxsize=2)
def tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path), {}


def _bytes(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def _words(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased as the tokenizer does, but for texts that may hold its special tokens."""
    raw = (text or "").encode()
    return raw.split() if b"<|" in raw else raw.lower().split()


def _remember(known, memory: dict[bytes, bytes], words: set[bytes]) -> None:
    """Encode new words. A letter and a full stop or comma behind it are never one token, so such a last mark is
    encoded apart and its word found again without it."""
    cut = {word for word in words if word[-1] in b".," and word[-2:-1].isalpha()}
    new = list(({word[:-1] for word in cut} | {word[-1:] for word in cut} | (words - cut)).difference(memory))
    found = known.encode_batch_fast([word.decode() for word in new], add_special_tokens=False)
    memory.update((word, _bytes(x.ids)) for word, x in zip(new, found, strict=True))
    memory.update((word, memory[word[:-1]] + memory[word[-1:]]) for word in cut)


def _pieces(path: str, sequence: int, end: int):
    """Each document's ids, cut into whole sequences and a rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from gleanery.llm import packing

        known, memory = packing.tokenizer(path)
        last = np.uint32(end).tobytes()
        for whole in batches:
            for a in range(0, whole.num_rows, 256):
                batch = whole.slice(a, 256)
                # The tokenizer drops white space and joins nothing across it, so words can be encoded one by one.
                texts = [_words(text) for text in batch.column("text").to_pylist()]
                if len(memory) > REMEMBERED:
                    memory.clear()
                _remember(known, memory, set().union(*texts).difference(memory))
                rows, starts, lengths, sums, totals = [], [], [], [], []
                for i, text in enumerate(texts):
                    ids = b"".join(map(memory.__getitem__, text)) + last
                    for start in range(0, len(ids), 4 * sequence):
                        piece = ids[start : start + 4 * sequence]
                        rows.append(i)
                        starts.append(start // 4)
                        lengths.append(len(piece) // 4)
                        sums.append(zlib.crc32(piece))
                        totals.append(len(ids) // 4)
                keys = batch.column(0).take(pa.array(rows, pa.int64()))
                columns = [pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals)]
                yield pa.RecordBatch.from_arrays([keys, *columns], names=[batch.schema.names[0], "start", "length", "ids_crc32", "doc_tokens"])

    return run


def pieces(docs: DataFrame, path: str, sequence: int = SEQUENCE, end: int = END, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, start, length, ids_crc32, doc_tokens of every piece; each text is tokenised whole and ended by ``end``."""
    kind = docs.select(key).schema[0].dataType.simpleString()
    return docs.select(F.col(key), F.col(text).alias("text")).mapInArrow(_pieces(path, sequence, end), f"{key} {kind}, {PIECES}")


def shortest_pack_first(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a pack, number of such packs)."""
    room: dict[int, dict[tuple[int, ...], int]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            most = max((r for r in room if r >= length), default=None)
            if most is None:
                room.setdefault(sequence - length, {})
                room[sequence - length][(length,)] = room[sequence - length].get((length,), 0) + left
                break
            pattern, count = next(iter(room[most].items()))
            taken = min(left, count)
            if taken == count:
                del room[most][pattern]
                if not room[most]:
                    del room[most]
            else:
                room[most][pattern] = count - taken
            grown = (*pattern, length)
            group = room.setdefault(most - length, {})
            group[grown] = group.get(grown, 0) + taken
            left -= taken
    return sorted((pattern, count) for group in room.values() for pattern, count in group.items())


def _ranges(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by length, first rank: (length, first rank, first sequence, offset) of every place in a pattern."""
    used: dict[int, int] = {}
    rows, first = [], 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            rank = used.get(length, 0)
            rows.append((length, rank, first, offset))
            used[length], offset = rank + count, offset + length
        first += count
    table = np.asarray(sorted(rows), np.int64).reshape(-1, 4)
    return table[:, 0], table[:, 1], table[:, 2], table[:, 3]


def _place(ranges: tuple[np.ndarray, ...], names: list[str]):
    lengths, ranks, firsts, offsets = ranges

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = lengths.astype(np.uint64) << np.uint64(48) | ranks.astype(np.uint64)
        for batch in batches:
            length, rank = (batch.column(c).to_numpy().astype(np.uint64) for c in ("length", "rank"))
            at = np.searchsorted(keys, length << np.uint64(48) | rank, side="right") - 1
            sequence = firsts[at] + rank.astype(np.int64) - ranks[at]
            columns = [batch.column(c) for c in names] + [pa.array(sequence), pa.array(offsets[at])]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, path: str, sequence: int = SEQUENCE, end: int = END, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece of every document.

    A null text counts as empty and holds the end id alone. Equal lengths are told apart by a row number given when the
    pieces are written, so repeated rows and ids are placed like any others. Pieces of one length are ranked
    in as many buckets as there are shuffle partitions, so a length that a third of all pieces share has no single task.
    An empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    names = [key, "start", "length", "ids_crc32", "doc_tokens"]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = pieces(docs, path, sequence, end, key, text).withColumn("row", F.monotonically_increasing_id())
    cut = materialize(cut.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int")), "pack-pieces")
    counts = cut.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    counts = materialize(counts, "pack-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "bucket").orderBy("row")
    ranked = cut.withColumn("in_bucket", F.row_number().over(within) - 1).join(starts, ["length", "bucket"])
    ranked = ranked.select(*names, (F.col("first") + F.col("in_bucket")).alias("rank"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.select(*names).schema)
    ranges = _ranges(shortest_pack_first(histogram, sequence))
    return ranked.mapInArrow(_place(ranges, names), f"{schema}, sequence_id long, offset long")
