"""Whether new ids are published already, without shuffling the published ones.

The published ids are folded into a Bloom filter: every id sets a few bits of a bitmap, built in blocks by partial aggregation, so that
what is shuffled is bounded by the bitmap. New ids that miss a bit are new for certain. The rest, the clashes and a few false hits, are looked
up exactly; they are few and written first, so the planner sends them to the published ids and not the other way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.session import materialize

#: Bits an id sets, bits kept for each id, and the most bits of a filter: 64 MB. Beyond some 50 million ids false hits grow, results stay exact.
HASHES, BITS_PER_ID, MOST_BITS = 4, 10, 1 << 29
BLOCK = 32_768


def _bits(key: str, size: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(n)), F.lit(size)) for n in range(HASHES)]


def bloom_filter(ids: DataFrame, key: str) -> np.ndarray:
    """The bitmap of the ids, at most ``MOST_BITS``."""
    wanted = max(BLOCK, BITS_PER_ID * ids.count())
    size = min(MOST_BITS, 1 << (wanted - 1).bit_length())
    bit = ids.where(F.col(key).isNotNull()).select(F.explode(F.array(*_bits(key, size))).alias("bit")).select((F.col("bit") + 1).alias("bit"))
    blocks = bit.groupBy(F.bitmap_bucket_number("bit").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    out = np.zeros(size // 8, np.uint8)
    for block, bits in blocks.toLocalIterator():
        start = (block - 1) * BLOCK // 8
        out[start : start + len(bits)] = np.frombuffer(bits, np.uint8)
    return out


def possibly_known(new: DataFrame, key: str, bitmap: np.ndarray) -> DataFrame:
    """The rows of ``new`` whose id may be one of the filter's."""
    size, shared = 8 * len(bitmap), new.sparkSession.sparkContext.broadcast(bitmap)

    def hit(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        bitmap = shared.value
        for columns in batches:
            found = np.ones(len(columns[0]), bool)
            for column in columns:
                bit = column.to_numpy(zero_copy_only=False)
                found &= (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
            yield pa.array(found)

    hit.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    return new.where(F.col(key).isNotNull()).where(F.arrow_udf(hit, "boolean")(*_bits(key, size)))


def clashes(new: DataFrame, published: DataFrame, key: str) -> DataFrame:
    """key, new_rows, published_rows of every id of ``new`` that ``published`` holds. Null ids clash with nothing."""
    suspects = possibly_known(new.select(key), key, bloom_filter(published.select(key), key))
    suspects = materialize(suspects.groupBy(key).agg(F.count("*").alias("new_rows")), "suspect-ids")
    # Counted after the join: only ids that clash are shuffled.
    held = published.select(key).join(suspects, key).groupBy(key, "new_rows").agg(F.count("*").alias("published_rows"))
    return held.select(key, "new_rows", "published_rows")
