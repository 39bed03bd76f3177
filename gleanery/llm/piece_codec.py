"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A score-ordered agenda of adjacent symbol pairs merges the best pair first, the leftmost among equals. Where no piece of the
vocabulary holds a space mark behind another character, merges never cross into the next space mark, so a text
falls into chunks (space marks and what follows them) that are encoded by themselves and remembered by a worker. A chunk in
turn falls apart between any two characters that no piece holds side by side.
Every distinct chunk of an Arrow batch is checked against the sentencepiece library; decoding is the library's.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Chunks that a worker remembers; beyond it the memory starts anew.
REMEMBERED = 500_000
OUT = "n_tokens long, ids_sha256 string, decoded_sha256 string"


class Vocabulary:
    """Pieces, scores and byte pieces of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.get_piece_size()
        skip = {i for i in range(n) if self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i) or self.library.is_unused(i)}
        pieces = [self.library.id_to_piece(i) for i in range(n)]
        self.ids = {pieces[i]: i for i in range(n) if i not in skip}
        self.scores = {pieces[i]: self.library.get_score(i) for i in range(n) if i not in skip}
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = self.library.unk_id()
        self.fallback = all(i != self.unknown for i in self.bytes)
        self.separable = not any(MARK in p[1:] and p.strip(MARK) for p in self.ids)
        self.side_by_side = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.costs = {p: -score for p, score in self.scores.items()}
        self.memory: dict[str, bytes] = {}
        self.parts: dict[str, list[int]] = {}

    def chunks(self, text: str) -> list[str]:
        marked = MARK + text.replace(" ", MARK) if text else ""
        if not self.separable:
            return [marked] if marked else []
        return re.findall(f"{MARK}+[^{MARK}]*", marked)

    def encode_chunk(self, chunk: str) -> list[int]:
        """Ids of a chunk: its parts by the agenda."""
        near, parts, start, ids = self.side_by_side, self.parts, 0, []
        for i in range(1, len(chunk) + 1):
            if i == len(chunk) or chunk[i - 1 : i + 1] not in near:
                part = chunk[start:i]
                found = parts.get(part)
                if found is None:
                    found = parts[part] = self.agenda(part)
                ids += found
                start = i
        return ids

    def agenda(self, part: str) -> list[int]:
        whole = self.ids.get(part)
        if len(part) == 1:
            if whole is not None:
                return [whole]
            return [self.bytes[b] for b in part.encode()] if self.fallback else [self.unknown]
        cost = self.costs.get
        symbols: list[str | None] = list(part)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(c, i, part[i : i + 2]) for i in range(n - 1) if (c := cost(part[i : i + 2])) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, i, pair = heapq.heappop(agenda)
            left = symbols[i]
            # Stale: one of the two symbols has been merged since.
            if left is None or (j := after[i]) >= n or left + symbols[j] != pair:
                continue
            symbols[i], symbols[j] = pair, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                longer = pair + symbols[k]
                if (c := cost(longer)) is not None:
                    heapq.heappush(agenda, (c, i, longer))
            h = before[i]
            if h >= 0:
                longer = symbols[h] + pair
                if (c := cost(longer)) is not None:
                    heapq.heappush(agenda, (c, h, longer))
        ids: list[int] = []
        for symbol in symbols:
            if symbol is not None:
                found = self.ids.get(symbol)
                ids += [found] if found is not None else self.agenda(symbol)
        return ids

    def checked(self, chunks: list[str]) -> list[list[int]]:
        """Ids of chunks; raises where the library gives others."""
        ours = [self.encode_chunk(chunk) for chunk in chunks]
        # The library puts a space mark in front of a text, which takes the place of a chunk's first.
        theirs = self.library.encode([chunk[1:].replace(MARK, " ") if len(chunk) > 1 else "" for chunk in chunks])
        for chunk, a, b in zip(chunks, ours, theirs, strict=True):
            if a != b and len(chunk) > 1:
                raise ValueError(f"agenda and library differ on {chunk!r}: {a} {b}")
        return ours


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _encode(path: str, decode: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from gleanery.llm import piece_codec

        known = piece_codec.vocabulary(path)
        begin, end = (np.uint32(i).tobytes() for i in (known.library.bos_id(), known.library.eos_id()))
        memory = known.memory
        for whole in batches:
            for a in range(0, whole.num_rows, 256):
                batch = whole.slice(a, 256)
                texts = [known.chunks(text or "") for text in batch.column("text").to_pylist()]
                if len(memory) > REMEMBERED:
                    memory.clear()
                    known.parts.clear()
                new = list(set().union(*texts).difference(memory))
                memory.update((c, np.asarray(ids, "<u4").tobytes()) for c, ids in zip(new, known.checked(new), strict=True))
                ids = [begin + b"".join(map(memory.__getitem__, text)) + end for text in texts]
                columns = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "text"]
                names = [name for name in batch.schema.names if name != "text"]
                if decode:
                    decoded = known.library.decode([np.frombuffer(x, "<u4").tolist() for x in ids])
                    columns += [
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded]),
                    ]
                    names += ["n_tokens", "ids_sha256", "decoded_sha256"]
                else:
                    columns.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids (array<int>) of every whole text, with begin and end ids. A null text is encoded like an empty one; repeated
    rows stay, other columns are ignored, an empty table stays empty. ``model`` must be readable on every executor."""
    rows = docs.select(F.col(key), F.col(text).alias("text"))
    return rows.mapInArrow(_encode(model, False), f"{key} {_type(docs, key)}, ids array<int>")


def digests(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256: every text encoded, then decoded again. Cases as in :func:`encode`."""
    rows = docs.select(F.col(key), F.col(text).alias("text"))
    return rows.mapInArrow(_encode(model, True), f"{key} {_type(docs, key)}, {OUT}")


def _type(df: DataFrame, column: str) -> str:
    return df.select(column).schema[0].dataType.simpleString()
