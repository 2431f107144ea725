"""Operator 4: suffix-array dedup of byte strings by merging shard Burrows-Wheeler transforms.

Repeated runs come from `repeats`. A solver's runs are dealt to shards. Each shard has a Burrows-Wheeler transform of its
own; the transforms are merged by iterative interleave refinement: a vector says from which shard each row of the merged
transform comes. Each round walks it, takes each shard's next symbols in order, and sorts them stably, so that after r rounds the
rows are in the order of their first r symbols. Borders between rows of unequal prefixes appear in the round that equals their
common prefix plus one; rows without a border after `length` bytes form the repeated intervals. No suffix is sorted
again. Symbols are four bytes (or two), taken at each offset, which divides the rounds by as much.

A text is UTF-8 bytes; matches never cross documents. Every byte covered by a string of `length` bytes that also starts
earlier (smaller id, or same document and earlier start) goes; overlaps count. Nulls: a null text is empty; a null id counts as
the largest. Of repeated rows with one id none removes the other. Texts shorter than `length` stay whole. An empty table gives
an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import core, repeats


def shard_transform(symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of strings laid end to end, each closed by its own end symbol (0), and the transform.

    `ends`: where the end symbols are. The symbol before a string's first is its end symbol. By prefix doubling; only suffixes
    that still share their rank are sorted again.
    """
    n = len(symbols)
    rank = symbols.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))  # end symbols are less than others, and in the order of the strings
    order = np.argsort(rank, kind="stable")
    stop = np.repeat(ends, np.diff(np.append(-1, ends)))
    new = np.append(True, np.diff(rank[order]) != 0)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))  # of a block: its first place
    step = 1
    while True:
        tied = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(tied):
            break
        own = order[tied]
        block, beyond = rank[own], rank[np.minimum(own + step, stop[own])]
        sub = np.argsort(block * n + beyond, kind="stable")
        own, block, beyond = own[sub], block[sub], beyond[sub]
        order[tied] = own
        new[tied] = np.append(True, (block[1:] != block[:-1]) | (beyond[1:] != beyond[:-1]))
        rank[own] = np.maximum.accumulate(np.where(new[tied], tied, 0))
        step *= 2
    return order, before(symbols, ends)[order]


def before(x: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The value before each, cyclic within each string."""
    out = np.empty_like(x)
    out[1:] = x[:-1]
    out[np.append(0, ends[:-1] + 1)] = x[ends]
    return out


def merge(shards: list[np.ndarray], strings: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the shards' transforms after `rounds` rounds (the shard of each row), and the interval of each row.

    strings: the shard of each string, in the merged order of their end symbols.
    """
    z = np.repeat(np.arange(len(shards), dtype=np.uint8), [len(b) for b in shards])
    border = np.zeros(len(z), bool)
    border[0] = True
    symbol = np.empty(len(z), shards[0].dtype)
    for _ in range(rounds):
        for k, transform in enumerate(shards):
            symbol[z == k] = transform
        order = np.argsort(symbol, kind="stable")[len(strings) :]  # the end symbols come first
        along, interval = symbol[order], np.cumsum(border, dtype=np.int32)[order]
        z[len(strings) :] = z[order]
        z[: len(strings)] = strings
        border[: len(strings) + 1] = True
        np.logical_or(along[1:] != along[:-1], interval[1:] != interval[:-1], out=border[len(strings) + 1 :])
    return z, np.cumsum(border, dtype=np.int32)


def solver(bodies: list[bytes], counts: list[int], length: int, n_shards: int = 2) -> np.ndarray:
    """Classes of equal windows of `length` bytes, from the merged transforms of the shards."""
    sizes = np.array([len(b) for b in bodies])
    data = np.frombuffer(b"".join(bodies), np.uint8)
    first = np.cumsum(sizes) - sizes
    for step in (4, 2, 1):
        if length % step:
            continue
        # A symbol at each place; those that reach beyond their string are laid nowhere.
        symbols = np.zeros(len(data), np.uint32)
        for j in range(step):
            symbols[: len(data) - j] = symbols[: len(data) - j] << np.uint32(8) | data[j:]
        dense, codes = np.unique(symbols, return_inverse=True)
        if len(dense) < 65535 or step == 1:
            break
    codes = (codes + 1).astype(np.uint16)
    # A string for each offset of the start within a symbol.
    n = np.concatenate([np.maximum(sizes - p, 0) // step for p in range(step)])
    start = np.concatenate([first + p for p in range(step)])[n > 0]
    shard = np.tile(np.arange(len(sizes)) % n_shards, step)[n > 0]
    n = n[n > 0]
    used = np.unique(shard)
    transforms, places = [], []
    for z in used:
        own = shard == z
        size = n[own] + 1
        stops = np.cumsum(size) - 1
        place = np.repeat(start[own], size) + step * (np.arange(stops[-1] + 1) - np.repeat(stops + 1 - size, size))
        place[stops] = -1
        order, transform = shard_transform(np.where(place < 0, np.uint16(0), codes[place]), stops)
        transforms.append(transform)
        places.append(place[order])
    z, interval = merge(transforms, np.searchsorted(used, shard).astype(np.uint8), length // step)
    found = np.full(len(data), -1, np.int64)
    for k, place in enumerate(places):
        own = interval[z == k]
        found[place[place >= 0]] = own[place >= 0]
    n = np.array(counts)
    of = np.repeat(np.arange(len(n)), n)
    return found[np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + first[of]]


def remove_repeats(docs: DataFrame, length: int = 100, gram: int = 28, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept): the remaining bytes; spans are maximal removed runs."""
    rows = repeats.removals(docs, repeats.Bytes(), solver, length, gram, id_col, text_col)

    def run(batches):
        for batch in batches:
            data, offsets = core.text_buffers(batch.column("t"))
            cuts, removed, spans, kept = batch.column("cut").to_pylist(), [], [], []
            for i, cut in enumerate(cuts):
                text = data[offsets[i] : offsets[i + 1]]
                if not cut:
                    removed.append(0), spans.append(0), kept.append(text.tobytes())
                    continue
                gone = repeats.covered(len(text), cut, length)
                removed.append(int(gone.sum()))
                spans.append(len(core.spans_of(gone)[0]))
                kept.append(text[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], names=["id", "n_bytes", "n_removed", "n_spans", "kept"]
            )

    return rows.select("id", "t", "cut").mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, kept binary").withColumnRenamed("id", id_col)
