"""Near copies by fingerprints: SimHash over word shingles, linked by deletion-variant signatures.

A fingerprint is cut into as many segments as leave one of them with at most one differing bit, half of what the plain
pigeonhole needs, so a segment is twice as long and selects more. Each segment is indexed under its one-wildcard variants, the segment with one bit taken
out, one for every bit: segments that differ in at most one bit share a variant. An equality join on (segment, wildcard, value) finds all pairs,
the number of differing bits is then verified.

A variant that many fingerprints share is not joined. Its fingerprints are indexed whole, under every choice of as many wildcards as bits may differ:
such a key holds at most 2 ** LIMIT fingerprints, all of them linked, so the cost is the same for every fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.components import components
from gleanery.llm.words import slices
from gleanery.session import materialize

WIDTH, SEED, BITS = 3, 42, 64
#: Bits in which linked fingerprints may differ, and the segments that leave one with at most one of them.
LIMIT = 2
SEGMENTS = LIMIT // 2 + 1
LENGTH = BITS // SEGMENTS
#: Shingles whose bits are counted at a time.
AT_ONCE = 1 << 18
#: A variant of more fingerprints is crowded: were all its variants as large, a fingerprint would meet as many others as it has whole keys.
CROWDED = 2 * comb(BITS, LIMIT) // BITS + 1


def fingerprints(texts: pa.Array, width: int = WIDTH, seed: int = SEED) -> np.ndarray:
    """The fingerprint of each text; 0 without words. Only ``AT_ONCE`` shingles are held at a time."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    words = lists.flatten()
    empty = pc.equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    if empty.any():
        lengths = np.bincount(np.repeat(np.arange(len(lengths)), lengths)[~empty], minlength=len(lengths))
        words = words.filter(pa.array(~empty))
    ends = np.cumsum(lengths)
    set_bits, totals = np.zeros((len(lengths), BITS), np.int64), np.zeros(len(lengths), np.int64)

    def count(rows: np.ndarray, shingles: list[bytes]) -> None:
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in shingles), np.uint64, len(shingles))
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.flatnonzero(np.diff(rows, prepend=-1))
        set_bits[rows[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        totals[rows[first]] += np.diff(first, append=len(rows))

    row_of = np.repeat(np.arange(len(lengths)), lengths)
    for start in range(0, len(words) - width + 1, AT_ONCE):
        size = min(AT_ONCE, len(words) - width + 1 - start)
        rows = row_of[start : start + size]
        own = np.arange(start, start + size) + width <= ends[rows]
        if own.any():
            joined = pc.binary_join_element_wise(*[words.slice(start + k, size) for k in range(width)], " ").filter(pa.array(own))
            count(rows[own], joined.cast(pa.binary()).to_pylist())
    for i in np.flatnonzero((lengths > 0) & (lengths < width)):
        count(np.array([i]), [" ".join(words.slice(ends[i] - lengths[i], lengths[i]).to_pylist()).encode()])
    return np.packbits(2 * set_bits > totals[:, None], axis=1, bitorder="little").view("<u8").ravel()


def fingerprinted(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """key, fingerprint (long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = fingerprints(part.column("text"), width, seed)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.view(np.int64))], names=[part.schema.names[0], "fingerprint"])

    rows = docs.select(F.col(key), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"`{key}` {rows.schema[0].dataType.simpleString()}, fingerprint long")


def _without(value: Column, bit: Column) -> Column:
    return value.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), bit)))


def _differing(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(prints: DataFrame) -> DataFrame:
    """a, b: pairs of distinct ``fingerprint`` values at most ``LIMIT`` bits apart. Pairs that share a crowded variant may come as a path."""
    mask = (1 << LENGTH) - 1
    place = F.col("place")
    segment = F.call_function("shiftrightunsigned", "fingerprint", (place / LENGTH).cast("int") * LENGTH).bitwiseAND(F.lit(mask).cast("long"))
    placed = prints.select("fingerprint", F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS * LENGTH - 1))).alias("place"))
    variants = placed.select("fingerprint", "place", _without(segment, place % LENGTH).alias("value"))
    at = ["place", "value"]
    # Counted first, combined ahead of the shuffle: what stands alone, nearly all of it, goes no further.
    shared = variants.groupBy(*at).agg(F.count("*").alias("n")).where("n > 1")
    # Both sides are taken for as small as the fingerprints, though either has up to 64 rows for each of them: neither may be broadcast.
    met = materialize(variants.hint("merge").join(shared.hint("merge"), at), "variants-met")

    few = met.where(F.col("n") <= CROWDED)
    x, y = (few.select(*at, F.col("fingerprint").alias(c)).hint("merge") for c in ("a", "b"))
    pairs = x.join(y, at).where((F.col("a") < F.col("b")) & (_differing(F.col("a"), F.col("b")) <= LIMIT) & _first_meeting())
    crowd = met.where(F.col("n") > CROWDED).select("fingerprint").distinct()
    # Every choice of LIMIT ascending wildcards.
    whole, rest, last = crowd, F.col("fingerprint"), F.lit(-1)
    for i in range(LIMIT):
        whole = whole.withColumn(f"w{i}", F.explode(F.sequence(last + 1, F.lit(BITS - LIMIT + i))))
        rest, last = _without(rest, F.col(f"w{i}")), F.col(f"w{i}")
    # A key leaves LIMIT bits open: a list holds at most 2 ** LIMIT fingerprints.
    alike = whole.groupBy(*[f"w{i}" for i in range(LIMIT)], rest.alias("rest")).agg(F.collect_list("fingerprint").alias("all")).where(F.size("all") > 1)
    stars = alike.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a != b").distinct()
    return materialize(pairs.select("a", "b").unionByName(stars), "print-links")


def _first_meeting() -> Column:
    """Of the variants that a pair shares, the first of the first segment in which it differs in at most one bit."""
    apart = F.col("a").bitwiseXOR(F.col("b"))
    mask = F.lit((1 << LENGTH) - 1).cast("long")
    counts = [F.bit_count(F.shiftrightunsigned(apart, s * LENGTH).bitwiseAND(mask)) for s in range(SEGMENTS)]
    first, found = F.lit(False), F.lit(False)
    for s, n in enumerate(counts):
        here = (F.col("place") >= s * LENGTH) & (F.col("place") < (s + 1) * LENGTH)
        # Equal segments share all variants and meet in the first; others share one only.
        first = first | (~found & here & ((n == 1) | ((n == 0) & (F.col("place") == s * LENGTH))))
        found = found | (n <= 1)
    return first


def grouped(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """key, fingerprint (16 hex digits), component_id of every row: the smallest key that links reach, its own included.

    Null texts and texts without words have the fingerprint zero and are linked like any other; fewer words than ``width`` are one
    shingle. Rows that repeat a key are judged by their own texts. A null key is never the smallest and connects like any other; a
    row that reaches none but null keys has a null component. Equal fingerprints are one throughout, however many rows have
    it. A long text costs its length; an empty table stays empty; other columns are ignored, whatever their names.
    """
    rows = materialize(fingerprinted(docs, key, text, width, seed).withColumnRenamed(key, "__key"), "prints")
    least = materialize(rows.groupBy("fingerprint").agg(F.min("__key").alias("least")), "prints-distinct")
    found = components(links(least.select("fingerprint"))).withColumnRenamed("node", "fingerprint")
    tagged = least.join(found, "fingerprint", "left").withColumn("part", F.coalesce("component", "fingerprint"))
    of_part = tagged.groupBy("part").agg(F.min("least").alias("component_id"))
    of_print = tagged.select("fingerprint", "part").join(of_part, "part").select("fingerprint", "component_id")
    text_form = F.lpad(F.lower(F.hex("fingerprint")), BITS // 4, "0").alias("fingerprint")
    return rows.join(of_print, "fingerprint").select(F.col("__key").alias(key), text_form, "component_id")
