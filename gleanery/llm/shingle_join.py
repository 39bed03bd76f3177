"""Similarity join on sets of word shingles by universe partition.

Sets fall into size bands, so that a partner lies in the same or a neighbouring band. In a band every shingle is hashed to one
of more segments than two similar sets can differ in, so some segments must be equal. The smaller set of a pair indexes
as many segments as that takes, the cheapest first: segments that are empty or whose content many sets share are avoided,
and where too few are left, segments are indexed with the neighbourhood of one deletion, which also finds
a segment that differs by one shingle. The larger set looks all its segments up. Sets that meet are verified exactly.

Equal sets are one set throughout. Every set is first compared with one other, its hub: of all sets that it meets the one that meets most. Sets of
different components that still meet are then compared by what sets them apart from one centre, the largest hub of their segment: sets that
differ from it little are linked with it, any others that are linked share some of their differences, so a prefix of the
differences, rarest first, joined on centre and shingle, finds them. A group of near copies thus has one centre for nearly all its segments and costs rows in proportion
to its size. Segments with no more pairs than sets are spared the texts and compared pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.components import components
from gleanery.llm.words import mixed, slices, split
from gleanery.session import materialize

WIDTH = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Spare segments of a band, as a share of those needed; of every so many segments one may be indexed with deletions.
SPARE, DELETABLE = 0.25, 16
#: Contents of a segment that this many sets share in one task are counted; the commonest of them are avoided in indexing.
COMMON, COMMON_KEPT = 8, 50_000
#: Parts of a sketch.
PARTS = 64
U = np.uint64


def shingles(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles, sorted. Fewer words than ``width`` are one shingle, no words none."""
    hashes, codes, lengths = split(texts)
    ends = np.cumsum(lengths)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    with np.errstate(over="ignore"):
        words = hashes[codes] if len(codes) else np.empty(0, U)
        factors = mixed(np.arange(1, width + 1, dtype=U))
        factors |= U(1)
        total = np.zeros(max(0, len(words) - width + 1), U)
        for k in range(width):
            total += words[k : len(words) - width + 1 + k] * factors[k] if len(total) else 0
        own = np.arange(len(total)) + width <= ends[rows[: len(total)]] if len(total) else np.empty(0, bool)
        row, value = rows[: len(total)][own], mixed(total[own])
        for i in np.flatnonzero((lengths > 0) & (lengths < width)):
            few = words[ends[i] - lengths[i] : ends[i]]
            short = mixed(np.array([(few * factors[: len(few)]).sum(dtype=U) + U(len(few))], U))
            row, value = np.append(row, i), np.append(value, short)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[first], value[first]


def digests(row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit number of each text's set; equal for equal sets. Empty sets have 0."""
    out = np.zeros(n, U)
    with np.errstate(over="ignore"):
        np.add.at(out, row, mixed(value ^ U(0x9E3779B97F4A7C15)))
    return out


def sketches(row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """For each text the sizes and 16-bit sums of the parts of its set, which bound from below how far two sets differ."""
    part = row * PARTS + (value & U(PARTS - 1)).astype(np.int64)
    sizes = np.minimum(np.bincount(part, minlength=n * PARTS), 65535)
    sums = np.zeros(n * PARTS, np.uint16)
    np.add.at(sums, part, (mixed(value) >> U(48)).astype(np.uint16))
    return np.hstack([sizes.astype("<u2").reshape(n, PARTS), sums.astype("<u2").reshape(n, PARTS)])


def _possible(percent: int):
    """Pairs whose sketches allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, 2 * PARTS).astype(np.int64) for c in ("sketch_a", "sketch_b"))
            apart = np.abs(x[:, :PARTS] - y[:, :PARTS])
            differ = np.maximum(apart, x[:, PARTS:] != y[:, PARTS:]).sum(axis=1)
            sizes = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            keep = pa.array(differ * (100 + percent) <= sizes * (100 - percent))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])

    return run


class Bands:
    """Size bands and their segments for a threshold in percent."""

    def __init__(self, percent: int):
        self.percent = percent
        self.edges = [1]

    def of(self, size: int) -> int:
        while self.edges[-1] <= size:
            self.edges.append(max(self.edges[-1] + 1, -(-self.edges[-1] * 100 // self.percent)))
        return int(np.searchsorted(self.edges, size, side="right")) - 1

    def differ(self, size: int) -> int:
        """Shingles that a set of this size and a larger or equal one can differ in, together, and still be linked."""
        return (size + size * 100 // self.percent) * (100 - self.percent) // (100 + self.percent)

    def segments(self, band: int) -> int:
        """Segments of a band; 0 where only equal sets can be linked."""
        most = self.differ(self.edges[band + 1] - 1)
        return most if most < 2 else most + 1 + int(np.ceil(SPARE * (most + 1)))

    def deletable(self, band: int) -> int:
        """Every so many segments one may be indexed with deletions."""
        return 1 if self.differ(self.edges[band + 1] - 1) <= 4 else DELETABLE


def _segments(value: np.ndarray, count: int) -> np.ndarray:
    """The segment of each shingle; it rises with the hash, so sorted shingles are grouped already."""
    return ((value >> U(32)) * U(count) >> U(32)).astype(np.int64)


def _spread(value: np.ndarray) -> np.ndarray:
    """What a shingle adds to the content of its segment."""
    return mixed(value ^ U(0xD1B54A32D192ED03))


def _contents(value: np.ndarray, spread: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Content and size of every segment of a sorted set, empty ones too, and the segment of each shingle."""
    at = _segments(value, count)
    sizes = np.bincount(at, minlength=count)
    full = np.flatnonzero(sizes)
    sums = np.zeros(count, U)
    sums[full] = np.add.reduceat(spread, (np.cumsum(sizes) - sizes)[full])
    return sums, sizes, at


@lru_cache(maxsize=4096)
def _places(band: int, count: int) -> np.ndarray:
    return mixed(np.arange(count).astype(U) + (U(band) << U(40)) + U(1))


def signatures(value: np.ndarray, bands: Bands, common: tuple[np.ndarray, np.ndarray] | None = None, spread: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of a sorted set: (indexed and looked up, indexed only, looked up only)."""
    spread = _spread(value) if spread is None else spread
    own = bands.of(len(value))
    both, index, look_up = np.empty(0, U), np.empty(0, U), []
    for b in (own, own - 1):
        count = bands.segments(b) if b >= 0 else 0
        if not count:
            continue
        places, every = _places(b, count), bands.deletable(b)
        with np.errstate(over="ignore"):
            sums, sizes, at = _contents(value, spread, count)
            keys = mixed(sums + places)
            some = at % every == 0
            look_up.append(mixed(sums[at[some]] - spread[some] + places[at[some]]))
            if b < own:
                look_up.append(keys)
                continue
            chosen, widened = _allocate(keys, sizes, every, bands.differ(len(value)) + 1, common)
            both = keys[chosen]
            left = np.ones(count, bool)
            left[chosen] = False
            look_up.append(keys[left])
            if len(widened):
                some = np.isin(at, widened)
                index = mixed(sums[at[some]] - spread[some] + places[at[some]])
    return both, index, np.concatenate(look_up) if look_up else np.empty(0, U)


def _allocate(keys: np.ndarray, sizes: np.ndarray, every: int, needed: int, common: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
    """(segments to index, those of them to index with deletions too): plain ones in the order of their cost, then deletions, then
    common and empty ones."""
    cost = np.zeros(len(keys), np.int64)
    if common is not None and len(common[0]):
        place = np.minimum(np.searchsorted(common[0], keys), len(common[0]) - 1)
        cost = np.where(common[0][place] == keys, common[1][place], 0)
    cost[sizes == 0] = np.iinfo(np.int64).max
    order = np.lexsort((-sizes, cost))
    cheap = order[: int((cost == 0).sum())]
    none = np.empty(0, np.int64)
    if len(cheap) >= needed:
        return cheap[:needed], none
    # A deletion widens a segment that is indexed already; the smallest ones cost least, those of one shingle select nothing.
    allowed = cheap[(cheap % every == 0) & ((sizes[cheap] > 1) | (len(keys) == 1))]
    widened = allowed[np.argsort(sizes[allowed], kind="stable")][: needed - len(cheap)]
    rest = order[len(cheap) :][: needed - len(cheap) - len(widened)]
    return np.concatenate([cheap, rest]), widened


def _summaries(width: int, percent: int):
    """Of each text: its key, place, size and digest. At the end: contents of segments that many sets of the task share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen, held = Bands(percent), set(), []
        for batch in batches:
            for part in slices(batch, "text"):
                row, value = shingles(part.column("text"), width)
                sizes = np.bincount(row, minlength=part.num_rows)
                found = digests(row, value, part.num_rows)
                ends, spread = np.cumsum(sizes), _spread(value)
                for i in np.flatnonzero(sizes):
                    if found[i] in seen:
                        continue
                    seen.add(found[i])
                    band = bands.of(int(sizes[i]))
                    if count := bands.segments(band):
                        own = slice(ends[i] - sizes[i], ends[i])
                        sums, full, _ = _contents(value[own], spread[own], count)
                        held.append(mixed(sums + _places(band, count))[full > 0])
                nothing = pa.nulls(part.num_rows, pa.int64())
                sketch = pa.array([x.tobytes() for x in sketches(row, value, part.num_rows)], pa.binary())
                columns = [part.column(0), part.column("place"), pa.array(sizes, pa.int64()), pa.array(found.view(np.int64)), sketch, nothing, nothing]
                yield pa.RecordBatch.from_arrays(columns, names=[part.schema.names[0], "place", "n_shingles", "digest", "sketch", "common", "sets"])
        if held:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            many = counts >= COMMON
            keys, counts = keys[many], counts[many]
            none = pa.nulls(len(keys), pa.int64())
            columns = [pa.nulls(len(keys), part.schema.field(0).type), none, none, none, pa.nulls(len(keys), pa.binary()), pa.array(keys.view(np.int64)), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[part.schema.names[0], "place", "n_shingles", "digest", "sketch", "common", "sets"])

    return run


def _keys(width: int, percent: int, common: tuple[np.ndarray, np.ndarray]):
    """The keys of every set, once for each task that meets it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(percent), set()
        for batch in batches:
            for part in slices(batch, "text"):
                row, value = shingles(part.column("text"), width)
                sizes = np.bincount(row, minlength=part.num_rows)
                found = digests(row, value, part.num_rows)
                ends, spread = np.cumsum(sizes), _spread(value)
                rows, lists = [], ([], [], [])
                for i in np.flatnonzero(sizes):
                    if found[i] in seen:
                        continue
                    seen.add(found[i])
                    own = slice(ends[i] - sizes[i], ends[i])
                    keys = signatures(value[own], bands, common, spread[own])
                    if len(keys[0]) + len(keys[2]):
                        rows.append(i)
                        for into, k in zip(lists, keys, strict=True):
                            into.append(k)
                arrays = [_lists(x) for x in lists]
                yield pa.RecordBatch.from_arrays([pa.array(found[rows].view(np.int64)), *arrays], names=["digest", "both", "indexed", "looked_up"])

    return run


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *(len(p) for p in parts)])
    values = np.concatenate(parts).view(np.int64) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def _verify(width: int, percent: int):
    """Pairs of texts that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_b"):
                n = part.num_rows
                # The texts on the left repeat: each is cut into shingles once.
                texts = part.column("text_a").dictionary_encode()
                a_row, a = shingles(texts.dictionary, width)
                b_row, b = shingles(part.column("text_b"), width)
                at, a_sizes = texts.indices.to_numpy(), np.bincount(a_row, minlength=len(texts.dictionary))
                b_sizes = np.bincount(b_row, minlength=n)
                a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
                keep = np.zeros(n, bool)
                for i in range(n):
                    left = a[a_ends[at[i]] - a_sizes[at[i]] : a_ends[at[i]]]
                    right = b[b_ends[i] - b_sizes[i] : b_ends[i]]
                    common = len(np.intersect1d(left, right, assume_unique=True))
                    keep[i] = 100 * common >= percent * (len(left) + len(right) - common) and common > 0
                yield pa.RecordBatch.from_arrays([part.column("a").filter(pa.array(keep)), part.column("b").filter(pa.array(keep))], names=["a", "b"])

    return run


def place(key: str, text: str) -> Column:
    """A number for a row by its key and text, null keys included."""
    return F.xxhash64(key, text)


def join(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, links): ``members`` has key, place, n_shingles, digest of every row; ``links`` has pairs a < b of digests whose sets are
    linked: enough of them to connect every two sets that links connect, not all within a group.
    """
    rows = docs.select(F.col(key), F.col(text).alias("text"), place(key, text).alias("place"))
    kind = rows.schema[0].dataType.simpleString()
    summaries = rows.mapInArrow(_summaries(width, percent), f"{key} {kind}, place long, n_shingles long, digest long, sketch binary, common long, sets long")
    summaries = materialize(summaries, "join-summaries")
    members = summaries.where("digest is not null").select(key, "place", "n_shingles", "digest")
    common = summaries.where("common is not null").groupBy("common").agg(F.sum("sets").alias("n")).orderBy(F.desc("n"), "common")
    known = sorted((r["common"] % 2**64, r["n"]) for r in common.limit(COMMON_KEPT).collect())
    avoided = np.array([k for k, _ in known], U), np.array([n for _, n in known], np.int64)

    found = rows.select("text").mapInArrow(_keys(width, percent, avoided), "digest long, both array<long>, indexed array<long>, looked_up array<long>")
    # 3: indexed and looked up, 1: indexed, 2: looked up.
    roles = F.array(*[F.struct(F.lit(r).alias("role"), F.col(c).alias("keys")) for r, c in ((3, "both"), (1, "indexed"), (2, "looked_up"))])
    keyed = found.select("digest", F.explode(roles).alias("x")).select("digest", F.col("x.role").alias("role"), F.explode("x.keys").alias("at"))
    same = Window.partitionBy("at")
    indexed = F.when(F.col("role") != 2, F.col("digest"))
    met = keyed.select("at", "digest", "role", *[f("digest").over(same).alias(n) for f, n in ((F.min, "low"), (F.max, "high"))], F.min(indexed).over(same).alias("first"))
    met = met.where("first is not null and low < high").select("at", "digest", "role")
    met = materialize(met.dropDuplicates(["at", "digest", "role"]), "join-segments")
    # A set's hub is the set that shares most segments with others, among all that it meets: near the middle of a group of copies.
    shared = met.withColumn("sets", F.count("*").over(same)).groupBy("digest").agg(F.sum("sets").alias("shared"))
    met = met.join(shared, "digest").withColumn("middle", F.max(F.struct("shared", "digest")).over(same)).drop("shared")
    met = materialize(met, "join-meeting")
    hubs = materialize(met.groupBy("digest").agg(F.max("middle").alias("hub")), "join-hubs")

    sets = summaries.where("n_shingles > 0").groupBy("digest").agg(F.max("n_shingles").alias("n"), F.max("sketch").alias("sketch"))

    def linked(pairs: DataFrame) -> DataFrame:
        return materialize(_linked(_pairs(pairs, sets, percent), rows, members, width, percent), "join-links")

    links = linked(hubs.where("digest != hub.digest").select(F.col("hub.digest").alias("x"), F.col("digest").alias("y")))
    # Only segments where sets of different components still meet, one of the two indexed.
    now = met.drop("middle").join(components(links).withColumnRenamed("node", "digest"), "digest", "left").withColumn("part", F.coalesce("component", "digest"))
    now = now.drop("component").join(hubs, "digest")
    number = {"sets": F.count("*").over(same), "own": F.count_if(F.col("role") != 2).over(same), "centre": F.max("hub").over(same)["digest"]}
    span = {"least": F.min("part").over(same), "most": F.max("part").over(same)}
    now = now.withColumns({**number, **span}).where("least < most").drop("least", "most", "hub")
    # Where there are no more pairs than sets, as where one set is indexed, the pairs are the cheaper way.
    few = F.col("own") * (F.col("sets") - F.col("own")) + F.col("own") * (F.col("own") - 1) / 2 <= F.col("sets")
    now = materialize(now.withColumn("few", few).drop("sets", "own"), "join-apart")

    left = now.where("few and role != 2").select("at", F.col("digest").alias("x"), F.col("part").alias("x_part"))
    right = now.where("few and role != 1").select("at", F.col("digest").alias("y"), F.col("part").alias("y_part"))
    pairs = left.join(right, (left["at"] == right["at"]) & (left["x_part"] != right["y_part"])).select("x", "y")

    many = now.where("not few and digest != centre").select(F.col("centre").alias("a"), F.col("digest").alias("b"), "part")
    many = materialize(many.distinct(), "join-centres")
    apart = _with_texts(many, rows, members, width).mapInArrow(_differences(width, percent), _DIFFERENCES)
    apart = materialize(apart, "join-differences")
    near = apart.where("near").select(F.least("centre", "digest").alias("a"), F.greatest("centre", "digest").alias("b"))
    links = links.unionByName(near).unionByName(linked(pairs.unionByName(_overlapping(_prefixes(apart), percent))))
    return members, links


def _pairs(met: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs a < b whose sizes and sketches allow a link."""
    pairs = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    for c in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("digest").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}")), c)
    pairs = pairs.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    return pairs.mapInArrow(_possible(percent), "a long, b long")


def _linked(pairs: DataFrame, rows: DataFrame, members: DataFrame, width: int, percent: int) -> DataFrame:
    pairs = materialize(pairs, "join-pairs")
    return _with_texts(pairs, rows, members, width).mapInArrow(_verify(width, percent), "a long, b long")


def _with_texts(pairs: DataFrame, rows: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """Pairs a, b of digests with text_a and text_b. The pairs are read several times."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("digest")).distinct()
    # One row stands for all with its set; its text is fetched by its place, so rows without a key count too.
    chosen = members.where("n_shingles > 0").groupBy("digest").agg(F.min("place").alias("place")).join(asked, "digest")
    texts = rows.join(chosen.select("place").distinct(), "place", "left_semi").select("text").mapInArrow(_texts(width), "digest long, text string")
    texts = materialize(texts.dropDuplicates(["digest"]).join(asked, "digest", "left_semi"), "join-texts")
    full = pairs.join(texts.select(F.col("digest").alias("b"), F.col("text").alias("text_b")), "b")
    return full.join(texts.select(F.col("digest").alias("a"), F.col("text").alias("text_a")), "a").select(*pairs.columns, "text_a", "text_b")


_DIFFERENCES = "centre long, digest long, part long, n int, apart int, near boolean, index int, look_up int, elements array<long>"


def _differences(width: int, percent: int):
    """Rows (a, b, part, text_a, text_b) to the shingles in which b's set and its centre a's differ, and how many of them to index and look up.

    Let r be (100 - percent) / (100 + percent): x and y are linked if they differ in at most r (x + y) shingles. With d(x) differences to the
    centre c, they share at least (d(x) + d(y) - r (x + y)) / 2 of them. Where that is no bound, both are linked to c. So of two
    linked sets the one with fewer differences shares at least d(x) - r (x + y) / 2, which leaves a short prefix to index, and the
    other d(y) - r (x + y), which leaves a longer one to look up. A set that is linked to c shares, with a set that is not, more than
    (d(x) + r (c - x)) / 2.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in _DIFFERENCES.split(", ")]
        over, under = 100 + percent, 100 - percent
        for batch in batches:
            for rows in slices(batch, "text_b"):
                texts = rows.column("text_a").dictionary_encode()
                a_row, a = shingles(texts.dictionary, width)
                b_row, b = shingles(rows.column("text_b"), width)
                a_at = np.searchsorted(a_row, np.arange(len(texts.dictionary) + 1))
                b_at = np.searchsorted(b_row, np.arange(rows.num_rows + 1))
                elements, numbers = [], []
                for i, c in enumerate(texts.indices.to_numpy()):
                    centre, own = a[a_at[c] : a_at[c + 1]], b[b_at[i] : b_at[i + 1]]
                    elements.append(np.setxor1d(own, centre, assume_unique=True))
                    d, n, m = len(elements[-1]), len(own), len(centre)
                    most = (n + n * 100 // percent) * under
                    near = d * over <= (n + m) * under
                    least = (d * over + under * (m - n)) // (2 * over) + 1 if near else 1
                    numbers.append((n, d, near, d - max(least, d - most // (2 * over)) + 1, d - max(least, d - most // over) + 1))
                n, d, near, index, look_up = (pa.array(x, pa.bool_() if isinstance(x[0], bool) else pa.int32()) for x in zip(*numbers, strict=True))
                columns = [*(rows.column(c) for c in ("a", "b", "part")), n, d, near, index, look_up, _lists(elements)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _prefixes(apart: DataFrame) -> DataFrame:
    """A row for every difference to be looked up that other sets have too, the rarest of a centre first: a passage that many texts share comes late."""
    each = apart.withColumn("element", F.explode("elements")).drop("elements")
    often = each.groupBy("centre", "element").agg(F.count("*").alias("times")).where("times > 1")
    each = each.join(often, ["centre", "element"], "left").withColumn("times", F.coalesce("times", F.lit(1)))
    order = Window.partitionBy("centre", "digest").orderBy("times", "element")
    each = each.withColumn("place", F.row_number().over(order) - 1).where("place < look_up and times > 1")
    each = each.withColumn("indexed", F.col("place") < F.col("index"))
    return materialize(each.drop("index", "look_up", "times"), "join-prefixes")


def _overlapping(apart: DataFrame, percent: int) -> DataFrame:
    """x, y of different components whose differences to one centre share a shingle early enough for a link."""
    columns = ("digest", "part", "place", "n", "apart", "near")
    x = apart.where("indexed").select("centre", "element", *[F.col(c).alias(f"x_{c}") for c in columns])
    y = apart.select("centre", "element", *[F.col(c).alias(f"y_{c}") for c in columns])
    rest = F.least(F.col("x_apart") - F.col("x_place"), F.col("y_apart") - F.col("y_place"))
    enough = 2 * (100 + percent) * rest >= (100 + percent) * (F.col("x_apart") + F.col("y_apart")) - (100 - percent) * (F.col("x_n") + F.col("y_n"))
    alike = F.least("x_n", "y_n") * 100 >= F.greatest("x_n", "y_n") * percent
    fewer = (F.col("x_apart") < F.col("y_apart")) | ((F.col("x_apart") == F.col("y_apart")) & (F.col("x_digest") < F.col("y_digest")))
    apart_from_one = ~(F.col("x_near") & F.col("y_near"))
    on = (x["centre"] == y["centre"]) & (x["element"] == y["element"]) & (F.col("x_part") != F.col("y_part")) & enough & alike & fewer & apart_from_one
    return x.join(y, on).select(F.col("x_digest").alias("x"), F.col("y_digest").alias("y"))


def _texts(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                row, value = shingles(part.column("text"), width)
                found = digests(row, value, part.num_rows)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), part.column("text")], names=["digest", "text"])

    return run


def _parts(members: DataFrame, links: DataFrame) -> DataFrame:
    """digest, part of every set that is not empty: sets that links connect have the same part."""
    sets = members.where("n_shingles > 0").select("digest").distinct()
    found = components(links).withColumnRenamed("node", "digest")
    return sets.join(found, "digest", "left").select("digest", F.coalesce("component", "digest").alias("part"))


def grouped(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, component_id of every row: the smallest key that links reach, its own included.

    Null texts and texts without words have an empty set and are linked with nothing, not even with each other. Rows that
    repeat a key are judged by their own texts. A null key is never the smallest, and connects like any other; a row that
    reaches none but null keys has a null component. An empty table stays empty; other columns are ignored.
    """
    members, links = join(docs, percent, width, key, text)
    least = members.where("n_shingles > 0").groupBy("digest").agg(F.min(key).alias("least"))
    tagged = least.join(_parts(members, links), "digest")
    by_part = tagged.groupBy("part").agg(F.min("least").alias("component_id"))
    of_set = tagged.select("digest", "part").join(by_part, "part").select("digest", "component_id")
    none = members.where("n_shingles = 0").select(key, "n_shingles", F.col(key).alias("component_id"))
    return members.where("n_shingles > 0").join(of_set, "digest").select(key, "n_shingles", "component_id").unionByName(none)


def first_of_groups(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group, that of the smallest key, with all its columns; of several rows of that key the one of the smallest place.

    Groups are made of rows, so rows that repeat a key may be in different groups. A row with a null key is the one of its
    group only where all keys are null. Rows without words stay. Of rows that repeat both key and text only one stays; which one is
    settled by the order of their columns' hash.
    """
    members, links = join(docs, percent, width, key, text)
    row = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), "place")
    of_set = members.where("n_shingles > 0").groupBy("digest").agg(F.min(row).alias("row"))
    first = of_set.join(_parts(members, links), "digest").groupBy("part").agg(F.min("row").alias("row")).select("row.key", "row.place")
    wordless = members.where("n_shingles = 0").select(F.col(key).alias("key"), "place").distinct()
    keep = first.unionByName(wordless).select(F.col("key").alias("__kept"), F.col("place").alias("__at"))
    rows = docs.withColumn("__place", place(key, text))
    rows = rows.join(keep, (F.col("__place") == F.col("__at")) & F.col(key).eqNullSafe(F.col("__kept")), "left_semi")
    same = Window.partitionBy(key, "__place").orderBy(F.xxhash64(*docs.columns))
    return rows.withColumn("__copy", F.row_number().over(same)).where("__copy = 1").drop("__copy", "__place")
