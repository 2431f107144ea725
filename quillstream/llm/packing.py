"""Operator 5: hierarchical multi-length packing.

Each document's ids, with an end id, are cut into full windows of `max_length`; what remains is routed to the
smallest of the power-of-two tiers that holds it. Every tier is packed from the longest down: a sequence opens
with a document of its tier, its gap is filled with the longest fitting remainder of shorter tiers, and by a cut
when none fits. Thus each sequence is exactly as long as its tier and has no padding. What a task has left at its
end is cut into powers of two. Steps of equal tokens are groups of sequences of one tier.

The work is map-only: each task packs its own input split in blocks of `block` documents, so memory is bounded
by a block and nothing is shuffled. Input splits are deterministic, hence so are the ids after a lost executor.

Nulls: a null text counts as empty (one piece with the end id alone); null or repeated ids stay as they are, each row
is packed for itself. An empty table gives no piece. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier int, step_group long"


class Packer:
    """Packs pieces (document, start, ids) into sequences of exact power-of-two lengths."""

    def __init__(self, max_length: int, shortest: int, step_tokens: int, task: int):
        if max_length & (max_length - 1) or shortest & (shortest - 1):
            raise ValueError("tiers are powers of two")
        self.most, self.shortest, self.step, self.task = max_length, shortest, step_tokens, task
        self.pool: list[list] = [[] for _ in range(max_length + 1)]
        self.mask = self.count = 0
        self.steps: dict[int, int] = {}
        self.out: list[tuple] = []

    def add(self, doc, ids: np.ndarray) -> None:
        n, cut = len(ids), 0
        while n - cut >= self.most:
            self.emit([(doc, n, cut, ids[cut : cut + self.most])])
            cut += self.most
        if cut < n:
            self.put((doc, n, cut, ids[cut:]))

    def put(self, piece: tuple) -> None:
        k = len(piece[3])
        self.pool[k].append(piece)
        self.mask |= 1 << k

    def take(self, k: int) -> tuple:
        piece = self.pool[k].pop()
        if not self.pool[k]:
            self.mask &= ~(1 << k)
        return piece

    def emit(self, pieces: list[tuple]) -> None:
        tier, at = sum(len(p[3]) for p in pieces), 0
        row = self.steps.get(tier, 0)
        self.steps[tier] = row + 1
        group = (self.task << 33) + ((row // max(1, self.step // tier)) << 5) + tier.bit_length()
        for doc, total, start, ids in pieces:
            self.out.append((doc, start, len(ids), ids.tobytes(), total, (self.task << 33) + self.count, at, tier, group))
            at += len(ids)
        self.count += 1

    def pack(self) -> None:
        """Fills sequences tier by tier; what cannot fill one waits for the next block."""
        wait, tier = [], self.most
        while tier >= self.shortest:
            low = tier // 2 if tier > self.shortest else 0
            while opening := self.mask & ((1 << (tier + 1)) - 1) & ~((1 << (low + 1)) - 1):
                pieces = [self.take(opening.bit_length() - 1)]
                gap = tier - len(pieces[0][3])
                while gap and self.mask & ((1 << (tier + 1)) - 1):
                    fits = self.mask & ((1 << (gap + 1)) - 1)
                    if fits:
                        pieces.append(self.take(fits.bit_length() - 1))
                    else:
                        above = self.mask >> (gap + 1)
                        doc, total, start, ids = self.take(gap + (above & -above).bit_length())
                        pieces.append((doc, total, start, ids[:gap]))
                        self.put((doc, total, start + gap, ids[gap:]))
                    gap -= len(pieces[-1][3])
                if gap:
                    wait += pieces
                else:
                    self.emit(pieces)
            tier //= 2
        for piece in wait:
            self.put(piece)

    def finish(self) -> None:
        self.pack()
        while self.mask:
            doc, total, start, ids = self.take(self.mask.bit_length() - 1)
            while len(ids):
                k = 1 << (len(ids).bit_length() - 1)
                self.emit([(doc, total, start, ids[:k])])
                start, ids = start + k, ids[k:]

    def batches(self, most: int = 4096):
        schema = pa.schema([(n, t) for n, t in zip(SCHEMA.replace(",", "").split()[::2], [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()], strict=True)])
        for i in range(0, len(self.out), most):
            columns = zip(*self.out[i : i + most], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        self.out = []


def pack(docs: DataFrame, max_length: int = 1024, shortest: int = 64, end_id: int = 0, step_tokens: int = 1 << 16, block: int = 2048, ranks_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece, with its ids (little-endian uint32) and its place."""
    ranks_path = ranks_path or tokens.default_ranks()

    def run(batches):
        context = TaskContext.get()
        packer, seen = Packer(max_length, shortest, step_tokens, context.partitionId() if context else 0), 0
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packer.add(doc, np.concatenate([tokens.ids(text.as_py(), ranks_path), end]))
                seen += 1
                if seen % block == 0:
                    packer.pack()
                if len(packer.out) >= 1024:
                    yield from packer.batches()
        packer.finish()
        yield from packer.batches()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def with_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group")
