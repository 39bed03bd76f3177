"""N-gram model with interpolated modified Kneser-Ney smoothing, counted in Spark.

Counts are gathered in tasks, dealt out by hash and summed shard by shard, the longest n-grams first; each level hands the next what it needs of
it. Each shard is written to the shared folder as plain sorted arrays, which workers map into memory and search: word hashes give a word
its number (shard and place), pairs of numbers, and hashes of longer n-grams, find an n-gram. N-grams are dealt by their inner
words, which both shorter n-grams share, so a shard hands on each but once; those with common inner words are dealt by all their words.

p(w | u v) = (c(uvw) - D(c(uvw))) / c(uv.) + g(uv) p(w | v), with three discounts of the order from its counts of counts. In the
lower orders the number of different words before an n-gram stands for its count; n-grams that begin a text keep their counts,
as nothing stands before them. The rest of the words' order is spread evenly over the vocabulary and one unknown word.
"""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.words import mixed, slices, split
from gleanery.session import materialize, work_dir

#: Tokens that a task counts before it hands its counts over.
FLUSH_TOKENS = 3_000_000
#: N-grams of a shard that a task merges at a time.
GRAMS_AT_ONCE = 1 << 17
#: Passes' worth of shorter n-grams, in narrow columns, that a task gathers before it hands them on: together they pack better.
GATHERED = 16
#: A word is common from this share of all tokens in a shard of average size on.
SPREAD = 0.25
#: Words of the longest n-grams, unless a caller says otherwise.
ORDER = 3
#: Counts below this are kept in one byte, whose highest bit marks a context that was seen once.
SMALL = 128
STATS = ("a", "total", "seen1", "seen2", "seen3")
U = np.uint64
END = U(0xE5D)
BLOBS = "shard int, blob binary"


def open_array(folder: str, name: str, dtype: str) -> np.ndarray:
    """An array of the shared folder, mapped into memory: in place where the folder is a file system of this machine, else
    from a copy that is deleted as soon as it is mapped."""
    path = _local(folder)
    if path:
        full = f"{path}/{name}"
        return np.memmap(full, dtype, "r") if os.path.getsize(full) else np.empty(0, dtype)
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    with tempfile.TemporaryFile() as copy, store.open_input_stream(f"{root}/{name}") as source:
        while part := source.read(1 << 22):
            copy.write(part)
        copy.flush()
        return np.memmap(copy, dtype, "r") if copy.tell() else np.empty(0, dtype)


def save_array(folder: str, name: str, array: np.ndarray) -> None:
    """Written under a name of its own and then renamed, so a repeated task leaves one whole file."""
    import uuid

    path, own = _local(folder), f"{name}.{uuid.uuid4().hex}"
    if path:
        os.makedirs(path, exist_ok=True)
        array.tofile(f"{path}/{own}")
        os.replace(f"{path}/{own}", f"{path}/{name}")
        return
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/{own}") as out:
        out.write(array.tobytes())
    store.move(f"{root}/{own}", f"{root}/{name}")


def _local(folder: str) -> str | None:
    if "://" not in folder:
        return re.sub(r"^file:", "", folder)
    return folder[len("file://") :] if folder.startswith("file://") else None


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the distinct words, the end last; each token's place among them; number of tokens of each text)."""
    hashes, codes, lengths = split(texts)
    hashes = np.append(mixed(hashes) | U(1 << 12), END)
    ends = np.cumsum(lengths) + np.arange(len(lengths))
    out = np.empty(len(codes) + len(lengths), np.int64)
    is_end = np.zeros(len(out), bool)
    is_end[ends] = True
    out[is_end], out[~is_end] = len(hashes) - 1, codes
    return hashes, out, lengths + 1


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """By the leading bits, so that shards are ranges of sorted keys."""
    return ((keys >> U(32)) * U(shards) >> U(32)).astype(np.int64)


def _blobs(shard_of: np.ndarray, shards: int, *columns: np.ndarray, deltas: int = 0) -> Iterator[pa.RecordBatch]:
    """Columns, ordered by shard, as a row for each shard that has any; the first ``deltas`` as differences, all byte by byte, as that packs best."""

    def packed_bytes(i: int, column: np.ndarray) -> bytes:
        if i < deltas:
            column = np.diff(column, prepend=column.dtype.type(0))
        return np.ascontiguousarray(column).view("u1").reshape(len(column), -1).T.tobytes()

    edges = np.searchsorted(shard_of, np.arange(shards + 1))
    rows = [s for s in range(shards) if edges[s] < edges[s + 1]]
    blobs = [pa.compress(b"".join(packed_bytes(i, c[edges[s] : edges[s + 1]]) for i, c in enumerate(columns)), "zstd", asbytes=True) for s in rows]
    sizes = [int(edges[s + 1] - edges[s]) for s in rows]
    packed = [np.int64(n).tobytes() + blob for n, blob in zip(sizes, blobs, strict=True)]
    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array(packed, pa.binary())], names=["shard", "blob"])


def _columns(blobs: pa.ChunkedArray, *dtypes: str) -> list[np.ndarray]:
    """The columns that :func:`_blobs` packed; ``delta`` stands for 32-bit numbers kept as differences."""
    parts = []
    types = [np.dtype("<u4" if d == "delta" else d) for d in dtypes]
    for blob in blobs:
        raw = blob.as_py()
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        data = pa.decompress(raw[8:], n * sum(t.itemsize for t in types), "zstd", asbytes=True)
        at, columns = 0, []
        for d, t in zip(dtypes, types, strict=True):
            column = np.ascontiguousarray(np.frombuffer(data, "u1", n * t.itemsize, at).reshape(t.itemsize, n).T).view(t).reshape(n)
            columns.append(np.cumsum(column, dtype="<u4") if d == "delta" else column)
            at += n * t.itemsize
        parts.append(columns)
    return [np.concatenate([p[i] for p in parts]) for i in range(len(dtypes))]


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, int)
    return keys[starts], *[np.add.reduceat(v[order].astype(np.int64), starts) if len(keys) else v for v in values]


def _count_words(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, codes, _ = _tokens(part.column("text"))
                keys.append(hashes)
                counts.append(np.bincount(codes, minlength=len(hashes)))
                held += len(hashes)
                if held > FLUSH_TOKENS:
                    yield from flush(keys, counts)
                    keys, counts, held = [], [], 0
        if keys:
            yield from flush(keys, counts)

    def flush(keys: list[np.ndarray], counts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        words, totals = _summed(np.concatenate(keys), np.concatenate(counts))
        words, totals = words[totals > 0], totals[totals > 0]
        _give_back()
        return _blobs(_shard(words, shards), shards, words, totals.astype("<i8"))

    return run


def _save_words(folder: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        words, counts = _summed(*_columns(table.column("blob"), "<u8", "<i8"))
        save_array(folder, f"words-{shard}", words)
        save_array(folder, f"counts-{shard}", counts)
        top = np.argsort(-counts, kind="stable")[:64]
        lists = [pa.array([x], pa.list_(pa.int64())) for x in (words[top].view(np.int64), counts[top])]
        return pa.table([pa.array([shard], pa.int32()), pa.array([len(words)]), pa.array([int(counts.sum())]), *lists], names=["shard", "n", "total", "top", "top_n"])

    return run


@dataclass(frozen=True)
class Words:
    """The numbered vocabulary: a word's number is its place among all words sorted by hash."""

    folder: str
    shards: int
    starts: tuple[int, ...]
    total: int

    @property
    def distinct(self) -> int:
        return self.starts[-1]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each hash, -1 for unknown words."""
        out = np.full(len(hashes), -1, np.int64)
        order = np.argsort(hashes)
        asked = hashes[order]
        edges = np.searchsorted(_shard(asked, self.shards), np.arange(self.shards + 1))
        for s in range(self.shards):
            part = slice(edges[s], edges[s + 1])
            if edges[s] < edges[s + 1] and self.starts[s + 1] > self.starts[s]:
                words = array_of(self.folder, f"words-{s}", "<u8")
                at = np.minimum(np.searchsorted(words, asked[part]), len(words) - 1)
                out[order[part]] = np.where(words[at] == asked[part], at + self.starts[s], -1)
        return out

    def look_up(self, name: str, dtype: str, numbers: np.ndarray, missing: float) -> np.ndarray:
        """The value of each known number in arrays kept beside the words."""
        out = np.full(len(numbers), missing, np.float64)
        shard = np.searchsorted(np.asarray(self.starts), numbers, side="right") - 1
        for s in np.unique(shard[numbers >= 0]):
            own = (shard == s) & (numbers >= 0)
            out[own] = array_of(self.folder, f"{name}-{s}", dtype)[numbers[own] - self.starts[s]]
        return out


@lru_cache(maxsize=16384)
def array_of(folder: str, name: str, dtype: str) -> np.ndarray:
    return open_array(folder, name, dtype)


def _grams(numbers: np.ndarray, lengths: np.ndarray, begin: int, order: int) -> list[np.ndarray]:
    """The columns of each token's n-gram. A text's first token follows ``begin``; what lies before that is ``begin + 1``, an unknown word ``begin + 2``."""
    numbers = np.where(numbers < 0, begin + 2, numbers)
    place = np.arange(len(numbers)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    columns = [numbers]
    for back in range(1, order):
        before = np.full(len(numbers), begin + 1)
        before[back:] = numbers[: len(numbers) - back] if back < len(numbers) else before[back:]
        columns.insert(0, np.where(place >= back, before, np.where(place == back - 1, begin, begin + 1)))
    return [c.astype(U) for c in columns]


def _keys(grams: list[np.ndarray]) -> np.ndarray:
    """A word's number, a pair of numbers, or the hash of a longer n-gram."""
    if len(grams) == 1:
        return grams[0]
    key = grams[0] << U(32) | grams[1]
    for word in grams[2:]:
        key = mixed(key + mixed(word + U(1)))
    return key


def _home(grams: list[np.ndarray], shards: int, spread: np.ndarray) -> np.ndarray:
    """Shard by the inner words; where all of these are in ``spread``, and for pairs, by all words."""
    inner = grams[1:-1]
    if not inner:
        return _shard(mixed(_keys(grams)), shards)
    common = np.logical_and.reduce([np.isin(word, spread) for word in inner])
    return _shard(np.where(common, mixed(_keys(grams)), mixed(_keys(inner) + U(1))), shards)


def _merged(grams: list[np.ndarray], stats: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Distinct n-grams in the order of their keys, with summed columns."""
    keys = _keys(grams)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, int)
    sums = [np.add.reduceat(v[order].astype(np.int64), starts) if len(keys) else v.astype(np.int64) for v in stats]
    return keys[starts], [g[order[starts]] for g in grams], sums


def _dealt(shard: np.ndarray, shards: int, grams: list[np.ndarray], *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    order = np.argsort(shard, kind="stable")
    yield from _blobs(shard[order], shards, *[g[order].astype("<u4") for g in grams], *[c[order] for c in columns], deltas=len(grams))


def _count_grams(words: Words, order: int, spread: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, codes, lengths = _tokens(part.column("text"))
                held.append([g.astype("<u4") for g in _grams(words.numbers(hashes)[codes], lengths, words.distinct, order)])
                n += len(codes)
                if n > FLUSH_TOKENS:
                    yield from flush(held)
                    held, n = [], 0
        if held:
            yield from flush(held)

    def flush(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        grams = [np.concatenate([h[i] for h in held]) for i in range(order)]
        held.clear()
        # Sorted by words, the inner ones first, not by hash: so they pack well.
        first, second, *rest = [*range(1, order - 1), 0, order - 1]
        key = grams[first].astype(U)
        for i in (second, *rest):
            if i != second:
                key = np.unique(key, return_inverse=True)[1].astype(U, copy=False)
            key <<= U(32)
            key |= grams[i]
        at, counts = np.unique(key, return_index=True, return_counts=True)[1:]
        del key
        grams, counts = [g[at] for g in grams], counts.astype("<u4")
        del at
        home = [_home([g[i : i + GRAMS_AT_ONCE].astype(U) for g in grams], words.shards, spread) for i in range(0, len(counts), GRAMS_AT_ONCE)]
        yield from _dealt(np.concatenate(home), words.shards, grams, counts)
        _give_back()

    return run


def _give_back() -> None:
    """What Arrow keeps for reuse would stay with the worker, beside the other workers and the next stages."""
    pa.default_memory_pool().release_unused()


def _width(column: np.ndarray) -> int:
    return np.min_scalar_type(int(column.max()) if len(column) else 0).itemsize


def _save_grams(words: Words, n: int, top: bool, spread: np.ndarray):
    """Write a shard of the n-grams and hand on what the shorter ones need of it: context counts and different words before."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        columns = _columns(table.column("blob"), *["delta"] * n, *(["<u4"] if top else ["<i8"] * 5))
        passes = -(-max(1, len(columns[0])) // GRAMS_AT_ONCE)
        # By an inner word, as in shards, so that few n-grams are handed on by several passes.
        of = _shard(mixed(columns[1 if n > 2 else 0].astype(U) + U(1)), passes).astype("<u4")
        kept, handed, held = [], [], []
        for number in range(passes):
            own = np.flatnonzero(of == number) if passes > 1 else slice(None)
            arrays, below = part([c[own] for c in columns])
            kept.append(arrays)
            held.append(below)
            if number + 1 == passes or sum(len(h[0]) for h in held) >= GATHERED * GRAMS_AT_ONCE:
                handed.extend(hand_on(held))
        columns.clear()
        keys, small, wide, *columns = (np.concatenate([arrays[i] for arrays in kept]) for i in range(3 + len(STATS)))
        kept.clear()
        order = np.argsort(keys, kind="stable")
        place = order[wide[order]]
        place = np.searchsorted(np.flatnonzero(wide), place)
        # Each column as narrow as its largest value allows; the tally tells the bytes.
        columns = [x[place].astype(f"<u{_width(x)}") for x in columns]
        once = [(small & (SMALL - 1) == i).sum() for i in (1, 2, 3, 4)]
        arrays = {"keys": keys[order], "small": small[order], "at": np.flatnonzero(wide[order]).astype("<u4"), **dict(zip(STATS, columns, strict=True))}
        for name, array in arrays.items():
            save_array(words.folder, f"{name}{n}-{shard}", array)
        save_array(words.folder, f"tally{n}-{shard}", np.array(once + [c.itemsize for c in columns], "<i8"))
        _give_back()
        return pa.Table.from_batches(handed, pa.schema([("shard", pa.int32()), ("blob", pa.binary())]))

    def part(columns: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """(keys, small, wide, the statistics of the wide ones) of some n-grams of a shard, and the columns that they hand on."""
        stats = columns[n:] + [np.zeros(len(columns[n]), np.int64)] * 4 if top else columns[n:]
        keys, grams, stats = _merged([c.astype(U) for c in columns[:n]], stats)
        whole = grams[0] != U(words.distinct + 1)
        shorter = [g[~whole] for g in grams[1:]]
        passed = stats[0][~whole]
        keys, grams, (a, total, *seen) = keys[whole], [g[whole] for g in grams], [x[whole] for x in stats]
        wide = (a >= SMALL) | (total > 1)
        small = np.minimum(a, SMALL - 1).astype("u1") | (total == 1).astype("u1") << 7
        arrays = [keys, small, wide, *(x[wide] for x in (a, total, *seen))]
        none, one = np.zeros(len(a), np.int64), np.ones(len(a), np.int64)
        grams = [np.concatenate([x, y, z]) for x, y, z in zip(grams[:-1], grams[1:], shorter, strict=True)]
        spare = np.zeros(len(passed), np.int64)
        after = [np.concatenate([x, none, spare]) for x in (a, a == 1, a == 2, a > 2)]
        _, grams, stats = _merged(grams, [np.concatenate([none, one, passed]), *after])
        return arrays, [*(g.astype("<u4") for g in grams), *(x.astype(f"<u{_width(x)}") for x in stats)]

    def hand_on(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate([h[i] for h in held]) for i in range(n - 1 + len(STATS))]
        held.clear()
        if n > 2:
            parts = range(0, len(columns[0]), GRAMS_AT_ONCE)
            home = np.concatenate([_home([c[i : i + GRAMS_AT_ONCE].astype(U) for c in columns[: n - 1]], words.shards, spread) for i in parts] or [np.empty(0, np.int64)])
        else:
            home = np.minimum(np.searchsorted(np.asarray(words.starts), columns[0], side="right") - 1, words.shards)
        order = np.argsort(home, kind="stable")
        edges = np.searchsorted(home[order], np.arange(words.shards + 2))
        for s in range(words.shards + 1):
            own = order[edges[s] : edges[s + 1]]
            if len(own) > GRAMS_AT_ONCE:
                own = own[np.argsort(_keys([c[own].astype(U) for c in columns[: n - 1]]), kind="stable")]
            for i in range(0, len(own), GRAMS_AT_ONCE):
                some = own[i : i + GRAMS_AT_ONCE]
                _, grams, stats = _merged([c[some].astype(U) for c in columns[: n - 1]], [c[some] for c in columns[n - 1 :]])
                yield from _dealt(np.full(len(stats[0]), s), words.shards + 1, grams, *stats)

    return run


def _save_contexts(words: Words):
    """Beside the words: how often a context was seen, with words once, twice or more often after it, and the number of different words before a word."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        _, (number,), stats = _merged(*(lambda c: ([c[0].astype(U)], c[1:]))(_columns(table.column("blob"), "delta", *["<i8"] * 5)))
        # The beginning of a text, as a context, lies behind the last word.
        size = words.starts[shard + 1] - words.starts[shard] if shard < words.shards else 1
        for name, column in zip(STATS, stats, strict=True):
            array = np.zeros(size, "<i8")
            array[number.astype(np.int64) - words.starts[shard]] = column
            save_array(words.folder, f"{name}1-{shard}", array)
        a = stats[0]
        return pa.table({f"t{i}": [int((a == i).sum())] for i in (1, 2, 3, 4)} | {"more": [int((a > 2).sum())], "total": [int(a.sum())]})

    return run


def discounts(t1: int, t2: int, t3: int, t4: int) -> tuple[float, float, float]:
    """The three discounts from the counts of counts; each stays between 0 and its count where these are too few."""
    y = t1 / (t1 + 2 * t2) if t1 + t2 else 0.5
    raw = [i - (i + 1) * y * b / a if a else i * y for i, a, b in ((1, t1, t2), (2, t2, t3), (3, t3, t4))]
    return tuple(float(min(max(d, 0.05), i - 0.05)) for i, d in enumerate(raw, 1))


@dataclass(frozen=True)
class Model:
    words: Words
    order: int
    spread: tuple[int, ...]
    #: The discounts of each order, words first.
    cuts: tuple[tuple[float, float, float], ...]
    low_total: int
    low_mass: float

    def found(self, grams: list[np.ndarray]) -> np.ndarray:
        """Rows a, total, seen 1, 2, 3 of each of these distinct n-grams, 0 where unknown."""
        keys, n = _keys(grams), len(grams)
        out = np.zeros((5, len(keys)), np.int64)
        shard = _home(grams, self.words.shards, np.asarray(self.spread, U))
        order = np.argsort(shard, kind="stable")
        edges = np.searchsorted(shard[order], np.arange(self.words.shards + 1))
        for s in range(self.words.shards):
            own = order[edges[s] : edges[s + 1]]
            known = array_of(self.words.folder, f"keys{n}-{s}", "<u8") if len(own) else ()
            if not len(known):
                continue
            at = np.minimum(np.searchsorted(known, keys[own]), len(known) - 1)
            hit = known[at] == keys[own]
            own, at = own[hit], at[hit]
            small = array_of(self.words.folder, f"small{n}-{s}", "u1")[at]
            out[0, own], out[1, own] = small & (SMALL - 1), small >> 7
            # What a context seen once goes on with was seen once.
            out[2, own] = small >> 7
            wide = array_of(self.words.folder, f"at{n}-{s}", "<u4")
            if len(wide) and len(at):
                place = np.minimum(np.searchsorted(wide, at), len(wide) - 1)
                big = wide[place] == at
                widths = array_of(self.words.folder, f"tally{n}-{s}", "<i8")[4:]
                for row, (name, width) in enumerate(zip(STATS, widths, strict=True)):
                    out[row, own[big]] = array_of(self.words.folder, f"{name}{n}-{s}", f"<u{width}")[place[big]]
        return out

    def score(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """(tokens, known tokens, base score, log10 probability) of each text."""
        words = self.words
        hashes, codes, lengths = _tokens(texts)
        numbers = words.numbers(hashes)
        counts = words.look_up("counts", "<i8", numbers, 0.0)
        rows = np.repeat(np.arange(len(lengths)), lengths)
        base = np.log10((counts + 0.5) / (words.total + 0.5 * (words.distinct + 1)))
        known = numbers >= 0
        spare = self.low_mass / (words.distinct + 1)
        one = np.array([words.look_up(f"{c}1", "<i8", numbers, 0.0) for c in STATS]) if self.cuts else np.zeros((5, len(numbers)))
        lower = np.maximum(one[0] - _discount(one[0], self.cuts[0]), 0) / max(self.low_total, 1) + spare if self.cuts else np.full(len(numbers), spare)
        p = lower[codes]
        starts = np.cumsum(lengths) - lengths
        grams = _grams(numbers[codes], lengths, words.distinct, self.order) if self.cuts else []
        level = one[:, codes]
        for n in range(2, self.order + 1 if self.cuts else 2):
            context = np.zeros_like(level)
            context[:, 1:] = level[:, :-1]
            context[:, starts] = 0
            if n == 2:
                begin = [array_of(words.folder, f"{c}1-{words.shards}", "<i8")[0] for c in STATS]
                context[:, starts] = np.array(begin)[:, None]
            _, first, place = np.unique(_keys(grams[-n:]), return_index=True, return_inverse=True)
            level = self.found([g[first] for g in grams[-n:]])[:, place]
            total = np.maximum(context[1], 1)
            mass = (np.asarray(self.cuts[n - 1]) @ context[2:]) / total
            own = np.maximum(level[0] - _discount(level[0], self.cuts[n - 1]), 0) / total
            p = np.where(context[1] > 0, own + mass * p, p)
        sums = [np.bincount(rows, weights=x, minlength=len(lengths)) for x in (known[codes], base[codes], np.log10(p))]
        return lengths, sums[0].astype(np.int64), sums[1], sums[2]


def _discount(counts: np.ndarray, values: tuple[float, float, float]) -> np.ndarray:
    return np.select([counts == 1, counts == 2, counts > 2], values, 0.0)


def fit(texts: DataFrame, shards: int | None = None, order: int = ORDER) -> Model:
    """A model of the column ``text`` with n-grams of up to ``order`` words (2 at least): all counts over all rows. A null text counts as
    empty (its end only).

    Vocabularies are numbered in 32 bits: up to 4.29 thousand million different words.
    """
    if order < 2:
        raise ValueError("order is 2 at least")
    spark = texts.sparkSession
    shards = shards or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    folder = work_dir(spark, "kneser-ney")
    rows = texts.select("text")
    one = rows.mapInArrow(_count_words(shards), BLOBS).groupBy("shard").applyInArrow(_save_words(folder), "shard int, n long, total long, top array<long>, top_n array<long>")
    saved = sorted(materialize(one, "kneser-ney-words").collect(), key=lambda r: r["shard"])
    sizes = {r["shard"]: r["n"] for r in saved}
    starts = np.cumsum([0] + [sizes.get(s, 0) for s in range(shards)]).tolist()
    words = Words(folder, shards, tuple(starts), sum(r["total"] for r in saved))
    if words.distinct >= 2**32 - 4:
        raise ValueError("more than 4.29 thousand million different words")
    if not saved:
        return Model(words, order, (), (), 0, 1.0)
    least = SPREAD * words.total / shards
    top = np.array([h % 2**64 for r in saved for h, n in zip(r["top"], r["top_n"], strict=True) if n >= least], U)
    spread = np.sort(np.append(words.numbers(top), [words.distinct]).astype(U))
    # Every shard has files, so that none is missed by a reader.
    for s in range(shards):
        for n in range(2, order + 1):
            for name in ("keys", "tally"):
                save_array(folder, f"{name}{n}-{s}", np.empty(0, "<i8"))
    level = rows.mapInArrow(_count_grams(words, order, spread), BLOBS)
    for n in range(order, 1, -1):
        level = level.groupBy("shard").applyInArrow(_save_grams(words, n, n == order, spread), BLOBS)
    tallies = ("t1", "t2", "t3", "t4", "more", "total")
    contexts = level.groupBy("shard").applyInArrow(_save_contexts(words), ", ".join(f"{c} long" for c in tallies))
    t = materialize(contexts, "kneser-ney-contexts").agg(*[F.sum(c).alias(c) for c in tallies]).first()
    cuts = [discounts(t["t1"], t["t2"], t["t3"], t["t4"])]
    for n in range(2, order + 1):
        held = [open_array(folder, f"tally{n}-{s}", "<i8") for s in range(shards)]
        cuts.append(discounts(*np.sum([h[:4] for h in held if len(h)] or [[0] * 4], axis=0).tolist()))
    low = cuts[0]
    low_mass = (low[0] * t["t1"] + low[1] * t["t2"] + low[2] * t["more"]) / max(t["total"], 1)
    return Model(words, order, tuple(int(x) for x in spread), tuple(cuts), t["total"], low_mass)


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                n_tokens, known, base, score = model.score(part.column("text"))
                n = len(n_tokens)
                columns = [part.column(0), part.column(1), pa.array(n_tokens), pa.array(known), pa.array(np.full(n, model.words.total)), pa.array(base), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names[:2], "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def score(docs: DataFrame, held_out: F.Column, key: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score of every whole text.

    The model learns from the rows that ``held_out`` does not mark; a null mark counts as false. Null texts count as
    empty: their only token is the end. Repeated rows count and are scored each. With no training rows every token is unknown.
    Other columns are ignored; an empty table stays empty.
    """
    rows = docs.select(F.col(key), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text).alias("text"))
    model = fit(rows.where("not held_out"), order=order)
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(_scores(model), f"{key} {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
