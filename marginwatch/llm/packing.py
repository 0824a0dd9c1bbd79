"""Hierarchical packing of documents into windows of several lengths.

Documents are routed by length to tiers of windows. Whole windows are cut from long documents; what
remains of a document opens a window of its tier, longest tier first, and the gap behind it is filled
from the same and shorter tiers: the longest pieces that fit, then a cut of the shortest that does not.
Full windows of a tier are dealt into step groups of equal tokens and near-equal attention cost.

Packing needs no shuffle: each task packs what it reads, a bounded pool of tokens at a time, and carries
what fills no window into its next pool. The last pieces of a task form windows of falling powers of two.
"""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import encoder

TIERS = (256, 512, 1024, 2048)
#: Tokens a task holds before it packs them.
POOL_IDS = 4_000_000
#: Tokens of a step group.
STEP_IDS = 32_768

_FIELDS = [(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window", "step_group")]


class Packer:
    """Takes documents as lengths and gives windows as lists of pieces (document, start, length)."""

    def __init__(self, tiers: tuple[int, ...] = TIERS, step_ids: int = STEP_IDS) -> None:
        if any(t & (t - 1) for t in tiers):
            raise ValueError("window lengths are powers of two")
        self.tiers, self.step_ids = sorted(tiers), step_ids
        self.top = self.tiers[-1]
        self.bins: list[list[tuple[int, int]]] = [[] for _ in range(self.top + 1)]  # pieces by length
        self.lengths = 0  # the set of lengths that have pieces, as bits
        self.waiting: dict[int, list] = {t: [] for t in self.tiers}  # windows that are in no step group yet
        self.groups = 0

    def put(self, doc: int, start: int, length: int) -> None:
        if length:
            self.bins[length].append((doc, start))
            self.lengths |= 1 << length

    def _take(self, length: int) -> tuple[int, int, int]:
        doc, start = self.bins[length].pop()
        if not self.bins[length]:
            self.lengths &= ~(1 << length)
        return doc, start, length

    def add(self, doc: int, length: int) -> None:
        """A document: whole windows of the longest tier, and the rest as a piece."""
        whole = length - length % self.top
        for start in range(0, whole, self.top):
            self.waiting[self.top].append([(doc, start, self.top)])
        self.put(doc, whole, length - whole)

    def _fill(self, window: int, pieces: list[tuple[int, int, int]]) -> int:
        """Fills the gap behind pieces from the bins; the gap that is left is 0 unless they ran out."""
        gap = window - sum(p[2] for p in pieces)
        while gap and self.lengths:
            fitting = self.lengths & ((2 << gap) - 1)
            if fitting:
                pieces.append(self._take(fitting.bit_length() - 1))
                gap -= pieces[-1][2]
            else:
                doc, start, length = self._take((self.lengths & -self.lengths).bit_length() - 1)
                pieces.append((doc, start, gap))
                self.put(doc, start + gap, length - gap)
                gap = 0
        return gap

    def pack(self, last: bool) -> list[tuple[int, int, list]]:
        """What is ready, as (window length, step group, pieces); at the last call everything."""
        enough = True
        for window, shorter in zip(self.tiers[::-1], [*self.tiers[-2::-1], 0]):
            while enough and self.lengths >> (shorter + 1):
                pieces = [self._take(self.lengths.bit_length() - 1)]
                if self._fill(window, pieces):
                    for p in pieces:  # less than a window is left: into the next pool
                        self.put(*p)
                    enough = False
                else:
                    self.waiting[window].append(pieces)
        if last:
            left, size = sum(length * len(b) for length, b in enumerate(self.bins)), self.top
            while left:
                while size > left:
                    size //= 2
                pieces = []
                self._fill(size, pieces)
                self.waiting.setdefault(size, []).append(pieces)
                left -= size
        return [x for window in sorted(self.waiting, reverse=True) for x in self._groups(window, last)]

    def _groups(self, window: int, last: bool) -> list[tuple[int, int, list]]:
        """Step groups of a tier: windows by attention cost, dealt back and forth over the groups."""
        size = max(1, self.step_ids // window)
        ready = self.waiting[window]
        n = -(-len(ready) // size) if last else len(ready) // size
        if not n:
            return []
        now, self.waiting[window] = (ready, []) if last else (ready[: n * size], ready[n * size:])
        now.sort(key=lambda pieces: -sum(p[2] ** 2 for p in pieces))
        deal = [*range(n), *range(n - 1, -1, -1)]
        out = [(window, self.groups + deal[k % (2 * n)], pieces) for k, pieces in enumerate(now)]
        self.groups += n
        return out


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", tiers: tuple[int, ...] = TIERS, pool_ids: int = POOL_IDS, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start (ids of its document before it), length, ids_crc32, doc_tokens,
    sequence_id, offset (in its sequence), window (the sequence's length), step_group; with_ids adds the ids.

    Sequences are gapless from offset 0 and as long as their window, so that none is padded. A null text
    is an empty one, whose document is its end id alone. Rows that repeat an id are packed one by one; a
    null id stays null. An empty table gives no row; other columns are ignored. Sequences and step groups
    are numbered by task: the numbers are unique, not consecutive.
    """
    schema = pa.schema(_FIELDS + [("ids", pa.list_(pa.int32()))] * with_ids)

    def run(batches):
        words, packer = encoder(tokenizer), Packer(tiers)
        task = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        pool: dict[int, tuple[int | None, np.ndarray]] = {}  # ids of documents with pieces that are in no sequence yet
        left: dict[int, int] = {}
        number = held = sequences = 0

        def rows(last: bool):
            nonlocal sequences
            out, count = [], 0
            for window, group, pieces in packer.pack(last):
                offset = 0
                for doc, start, length in pieces:
                    key, ids = pool[doc]
                    some = ids[start:start + length]
                    out.append((key, start, length, zlib.crc32(some.astype("<u4")), len(ids), task + sequences, offset, window, task + group, *[some.astype(np.int32)] * with_ids))
                    offset += length
                    left[doc] -= length
                    if not left[doc]:
                        del pool[doc], left[doc]
                sequences += 1
                count += offset
                if len(out) >= 20_000:
                    yield batch_of(out)
                    out = []
            if out:
                yield batch_of(out)
            return count

        def batch_of(out):
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)

        for batch in batches:
            keys, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for i in range(0, len(texts), 256):
                flat, bounds = words.encode(texts[i:i + 256])
                for k, a, b in zip(keys[i:i + 256], bounds[:-1].tolist(), bounds[1:].tolist()):
                    pool[number], left[number] = (k, flat[a:b]), b - a
                    packer.add(number, b - a)
                    number += 1
                held += len(flat)
                if held >= pool_ids:
                    held -= yield from rows(False)
        yield from rows(True)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("text"))
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c, _ in _FIELDS) + (", ids array<int>" if with_ids else ""))
