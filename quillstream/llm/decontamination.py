"""Operator 1: benchmark decontamination by CGK embedding and bit sampling, with exact edit verification.

Texts are words: runs of ASCII letters and digits and of non-ASCII bytes, ASCII letters in lower case. A document is
contaminated by an item if a stretch of it is within (1 - similarity) * (the item's words) word edits of the item.

1. Embedding: a CGK random walk copies a text word by word; after each step a random bit of the word, drawn anew for the
   step, says whether to move on. Equal stretches thus give equal steps, and two walks that an edit has put out of step may meet again,
   so word edits become differing steps (Hamming distance). A walk begins at each word of an item, and at each word of a document.
2. Bit sampling: of the first `REACH` steps each walk samples `SAMPLES` (its first is the start); the first m of them are a
   signature. A document's word that has a signature of an item's word says where a window of the item's size lies.
3. Recall: m and the number of walks follow for each length from the target recall, measured on random items with the whole
   edit budget spent at random places (`plan`): the largest m that reaches the target with at most `WALKS` walks. An item
   without an edit budget (fewer than 5 words at 0.8) has equal signatures wherever it occurs, so its recall is 1.
4. Windows that hold too few of the item's words are left out; the others are verified by the exact semi-global edit distance.

The items are a stated query set. They are taken in blocks of at most `block` items and about `block_bytes` of text; with several
blocks each one's rows are written before the next is built, so one block is held at a time. Documents are only mapped,
never shuffled. Nulls: a null or empty text or item matches nothing; null or repeated ids keep their rows. Very long texts are searched
whole, one at a time. Of equal distances the earliest place is returned. An empty table gives an empty result. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import core

#: Bytes between words: all of ASCII but letters and digits.
BETWEEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
SCHEMA = "doc_id long, item_id long, distance int, start_word int, n_words int"


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    """(hash of each word, first word of each document)."""
    low = core.lower_ascii(data)
    starts, ends, bounds = core.words(low, offsets, BETWEEN)
    return core.Hasher(core.byte_symbols(low)).of(starts, ends), bounds


#: Steps of a walk, sampled steps, and walks at most.
REACH, SAMPLES, WALKS = 12, 8, 4
_CHANCE = np.random.default_rng(7)
#: The steps that each walk samples, in order.
COORDINATES = [np.append(0, np.sort(_CHANCE.choice(np.arange(1, REACH), SAMPLES - 1, replace=False))) for _ in range(WALKS)]
_SALTS = [np.uint64(x) for x in _CHANCE.integers(1, 1 << 63, WALKS)]


def signatures(symbols: np.ndarray, walk: int, most: int = SAMPLES):
    """For m = 1..most the first m sampled steps, as one hash, of the walk that begins at each symbol. The symbol 0 ends a text:
    it is never left."""
    bits = np.where(symbols == 0, np.uint64(0), core.mix(symbols + _SALTS[walk]) >> np.uint64(7))
    at, signature, last = np.arange(len(symbols)), np.zeros(len(symbols), np.uint64), 0
    for step in COORDINATES[walk][:most].tolist():
        for j in range(last, step):
            at = at + ((bits[at] >> np.uint64(j)) & np.uint64(1)).astype(np.int64)
        last = step
        signature = (signature + symbols[at]) * core.BASE
        signature ^= signature >> np.uint64(29)
        yield signature


def edits_of(n: int, similarity: float) -> int:
    return math.floor((1 - similarity) * n + 1e-9)


def edited(words: list, edits: int, rng) -> list:
    """The words after so many random substitutions, insertions and deletions."""
    out = list(words)
    for kind in rng.integers(0, 3, edits).tolist():
        at, new = int(rng.integers(len(out) + (kind == 1))) if out else 0, int(rng.integers(1, 1 << 62))
        out[at : at + (kind != 1)] = [] if kind == 2 else [new]
    return out


def recalls(n: int, edits: int, trials: int = 500, seed: int = 1) -> np.ndarray:
    """[m - 1, walks - 1]: the share of random items of n words, edited so often, that a signature of the first walks finds."""
    rng = np.random.default_rng(seed + n)
    items, texts = [], []
    for _ in range(trials):
        words, around = (rng.integers(1, 1 << 62, k).tolist() for k in (n, 2 * REACH))
        items.append([*words, 0])
        texts.append([*around[:REACH], *edited(words, edits, rng), *around[REACH:], 0])
    trial, other = (np.repeat(np.arange(trials), [len(x) for x in y]) for y in (items, texts))
    item, text = (np.array([w for x in y for w in x], np.uint64) for y in (items, texts))
    hit = np.zeros((SAMPLES, WALKS, trials), bool)
    for t in range(WALKS):
        for m, (x, y) in enumerate(zip(signatures(item, t), signatures(text, t), strict=True)):
            found = np.isin(x ^ core.mix(trial.astype(np.uint64)), y ^ core.mix(other.astype(np.uint64))) & (item != 0)
            hit[m, t, trial[found]] = True
    return np.maximum.accumulate(hit, 1).mean(2)


@functools.cache
def plan(n: int, edits: int, target: float) -> tuple[int, int]:
    """(sampled steps, walks) for items of n words: the most steps that reach the target recall, with the fewest walks."""
    if edits == 0:
        return int((COORDINATES[0] < n).sum()), 1  # these steps never leave the item
    enough = recalls(n, edits) >= target
    m = max(np.flatnonzero(enough.any(1)), default=0)
    return int(m) + 1, int(np.argmax(enough[m])) + 1 if enough[m].any() else WALKS


class Items:
    """The items' words and, for each walk and signature length, the table of their signatures."""

    def __init__(self, ids: list, texts: list[str], similarity: float, target: float = 0.999):
        if similarity <= 0:
            raise ValueError("similarity must be above 0")
        self.similarity, self.ids, self.words = similarity, [], []
        for i, t in zip(ids, texts, strict=True):
            data = np.frombuffer(t.encode(), np.uint8)
            hashes = word_hashes(data, np.array([0, len(data)]))[0] if len(data) else np.zeros(0, np.uint64)
            if len(hashes):
                self.ids.append(i)
                self.words.append(hashes)
        self.sorted = [np.sort(w) for w in self.words]
        self.tables = {}
        if not self.words:
            return
        plans = np.array([self.plan(k, target) for k in range(len(self.words))])
        budget = np.array([self.edits(k) for k in range(len(self.words))])
        size = np.array([len(w) for w in self.words])
        flat = np.concatenate([np.append(w, np.uint64(0)) for w in self.words])
        own = np.repeat(np.arange(len(size)), size + 1)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(size + 1) - size - 1, size + 1)
        for t in range(WALKS):
            for m, signature in enumerate(signatures(flat, t), 1):
                used = (plans[own, 0] == m) & (plans[own, 1] > t) & (flat != 0) & ((place == 0) | (budget[own] > 0))
                if used.any():
                    known, where = signature[used], np.flatnonzero(used)
                    order = np.argsort(known, kind="stable")
                    quick = np.zeros(1 << min(24, max(16, (16 * len(known)).bit_length())), bool)
                    quick[(known >> np.uint64(20)).astype(np.int64) % len(quick)] = True
                    self.tables[t, m] = known[order], own[where][order], place[where][order], quick

    def edits(self, k: int) -> int:
        return edits_of(len(self.words[k]), self.similarity)

    def plan(self, k: int, target: float) -> tuple[int, int]:
        """That of the shortest item with the same budget, the hardest to find; above 60 words that of about 60."""
        n, share = min(len(self.words[k]), 60), 1 - self.similarity
        edits = edits_of(n, self.similarity)
        return plan(n if edits == 0 else max(1, math.ceil(edits / share - 1e-9)), edits, target)

    def hits(self, symbols: np.ndarray, bounds: np.ndarray):
        """(item, where it would begin, document) of each signature of an item that a word of a document has; bounds: the first word of each document."""
        n, found = len(bounds) - 1, []
        # Each document ends with the symbol 0, so no walk leaves it.
        owner = core.owners(bounds)
        ended = np.zeros(len(symbols) + n, np.uint64)
        where = np.arange(len(symbols)) + owner
        ended[where] = symbols
        for t in range(WALKS):
            wanted = [m for x, m in self.tables if x == t]
            if not wanted:
                continue
            for m, signature in enumerate(signatures(ended, t, max(wanted)), 1):
                if m not in wanted:
                    continue
                known, own, place, quick = self.tables[t, m]
                signature = signature[where]
                at = np.flatnonzero(quick[(signature >> np.uint64(20)).astype(np.int64) % len(quick)])
                low, high = np.searchsorted(known, signature[at], "left"), np.searchsorted(known, signature[at], "right")
                many = high - low
                row = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
                at = np.repeat(at, many)
                found.append((own[row], at - place[row], owner[at]))
        return [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3


def best_match(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, length) of the stretch of the window nearest to the item; ties: the earliest end, then the shortest."""
    w = len(window)
    cost, begin = np.zeros(w + 1, np.int64), np.arange(w + 1)
    ladder = np.arange(w + 1)
    for x in item:
        stay, move = cost + 1, cost[:-1] + (window != x)
        new, origin = stay, begin.copy()
        better = move < new[1:]
        new[1:][better] = move[better]
        origin[1:][better] = begin[:-1][better]
        # Words of the window that the item lacks: a running minimum along the row.
        key = (new - ladder) * (w + 2) + (w - origin)
        run = np.minimum.accumulate(key)
        cost, begin = run // (w + 2) + ladder, w - run % (w + 2)
    end = int(np.argmin(cost))
    return int(cost[end]), int(begin[end]), end - int(begin[end])


def shared_words(symbols: np.ndarray, item: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """How many symbols of each window [low, high) are among those of the sorted item."""

    def member(x):
        return item[np.minimum(np.searchsorted(item, x), len(item) - 1)] == x

    width = int((high - low).max())
    if len(low) * width > len(symbols):
        sums = np.append(0, np.cumsum(member(symbols)))
        return sums[high] - sums[low]
    at = low[:, None] + np.arange(width)
    return (member(symbols[np.minimum(at, len(symbols) - 1)]) & (at < high[:, None])).sum(1)


def search(data: np.ndarray, offsets: np.ndarray, items: Items) -> dict[tuple[int, int], tuple[int, int, int]]:
    """{(document, item): (edits, start word, words)} of all contaminated documents."""
    hashes, bounds = word_hashes(data, offsets)
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    if not len(hashes):
        return found
    own, begin, doc = items.hits(hashes, bounds)
    order = np.lexsort((begin, own))
    own, begin, doc = own[order], begin[order], doc[order]
    edge = np.append(np.flatnonzero(np.diff(own, prepend=-1)), len(own)).tolist()
    for i, j in zip(edge[:-1], edge[1:], strict=True):
        k = int(own[i])
        item, most, docs = items.words[k], items.edits(k), doc[i:j]
        low = np.maximum(bounds[docs], begin[i:j] - most)
        high = np.minimum(bounds[docs + 1], begin[i:j] + len(item) + most)
        order = np.lexsort((begin[i:j], docs))
        docs, low, high = docs[order], low[order], high[order]
        likely = shared_words(hashes, items.sorted[k], low, high) >= len(item) - most
        docs, low, high = docs[likely], low[likely], high[likely]
        if not len(docs):
            continue
        # Windows of a document that overlap are verified as one.
        head = np.flatnonzero(np.append(True, (docs[1:] != docs[:-1]) | (low[1:] > high[:-1])))
        for d, first, end in zip(docs[head].tolist(), low[head].tolist(), np.append(high[head[1:] - 1], high[-1]).tolist(), strict=True):
            if found.get((d, k), (1,))[0] == 0:  # no later place is nearer
                continue
            if most == 0 and np.array_equal(hashes[first : first + len(item)], item):
                edits, start, n = 0, 0, len(item)
            else:
                edits, start, n = best_match(item, hashes[first:end])
            value = (edits, first + start - int(bounds[d]), n)
            if edits <= most and value < found.get((d, k), (1 << 60, 0, 0)):
                found[d, k] = value
    return found


def contaminated(
    docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, recall: float = 0.999, block: int = 20000, block_bytes: int = 1 << 26, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, item_id, distance, start_word, n_words): the nearest stretch of each document to each item that it holds."""
    spark = docs.sparkSession
    items = benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).collect()[0]
    blocks = max(1, -(-n // block), -(-size // block_bytes))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    out = None
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        held = spark.sparkContext.broadcast(Items([r["item_id"] for r in rows], [r["text"] for r in rows], similarity, recall))

        def run(batches, held=held):
            for batch in batches:
                data, offsets = core.text_buffers(batch.column("t"))
                ids, found = batch.column("doc_id").to_pylist(), []
                for i, j in core.slices(offsets):
                    hits = search(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], held.value)
                    found += [(ids[i + doc], held.value.ids[k], *v) for (doc, k), v in sorted(hits.items())]
                columns = zip(*found, strict=True) if found else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()], strict=True)], names=["doc_id", "item_id", "distance", "start_word", "n_words"])

        part = texts.mapInArrow(run, SCHEMA)
        if blocks > 1:
            part = core.written(part)
            held.unpersist()
        out = part if out is None else out.unionByName(part)
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    spoiled = contaminated(docs, benchmark, **parameters).select(F.col("doc_id").alias("_spoiled")).distinct()
    return docs.join(spoiled, docs["doc_id"].eqNullSafe(spoiled["_spoiled"]), "left_anti")
