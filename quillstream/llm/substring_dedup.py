"""Operator 3: substring dedup of word windows by prefix-partitioned suffix trees.

Repeated runs come from `repeats`. Their suffixes are split by variable-length prefixes into groups of at most `most`
suffixes, a prefix being lengthened by a word while its group is too large. Each group's subtree is grown level by level; a
node splits by its next word and leaves with one suffix are dropped. The internal nodes at depth `length` are the repeated
windows, and the paths that lead on through them the maximal repeats.

A word is a run of bytes other than U+0020 and U+0009-U+000D, unchanged. Every word covered by a window of `length` words that
also starts earlier (smaller id, or same document and earlier start) goes. Nulls: a null text has no words; a null id counts
as the largest. Of repeated rows with one id none removes the other. Documents shorter than a window stay whole. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import core, repeats


def prefix_groups(ids: np.ndarray, starts: np.ndarray, length: int, most: int) -> list[np.ndarray]:
    """Suffixes (indices into starts) in groups of at most `most`, each the union of whole prefixes of up to `length` words."""
    groups: list[np.ndarray] = []
    todo = [(np.arange(len(starts)), 0)]
    small: list[np.ndarray] = []
    held = 0
    while todo:
        members, depth = todo.pop()
        if len(members) <= most or depth == length:
            small.append(members)
            held += len(members)
            if held >= most:
                groups.append(np.concatenate(small))
                small, held = [], 0
            continue
        word = ids[starts[members] + depth]
        order = np.argsort(word, kind="stable")
        cut = np.flatnonzero(np.diff(word[order])) + 1
        todo += [(members[x], depth + 1) for x in np.split(order, cut)]
    return groups + [np.concatenate(small)] * bool(small)


def subtree(ids: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The node at depth `length` of each suffix, -1 for a leaf above it."""
    node = np.full(len(starts), -1)
    alive, at = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    for depth in range(length):
        key = at * (int(ids.max()) + 1) + ids[starts[alive] + depth]
        _, child, size = np.unique(key, return_inverse=True, return_counts=True)
        inner = size[child] > 1
        alive, at = alive[inner], child[inner]
        if not len(alive):
            return node
    node[alive] = at
    return node


def solver(bodies: list[bytes], counts: list[int], length: int, most: int = 1 << 17) -> np.ndarray:
    """Classes of equal windows, by the subtrees of all prefix groups."""
    known: dict[bytes, int] = {}
    flat = [[known.setdefault(w, len(known)) for w in b.split(b" ")] for b in bodies]
    ids = np.array([w for f in flat for w in f], np.int64)
    first = np.cumsum([0] + [len(f) for f in flat[:-1]])
    starts = np.concatenate([np.arange(f, f + n) for f, n in zip(first, counts, strict=True)])
    classes = np.arange(len(starts)) + len(starts)  # a class of its own for each window that is not repeated
    for k, members in enumerate(prefix_groups(ids, starts, length, most)):
        node = subtree(ids, starts[members], length)
        deep = node >= 0
        classes[members[deep]] = (k + 2) * 2 * len(starts) + node[deep]
    return classes


def remove_repeats(docs: DataFrame, length: int = 20, gram: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept): the words that stay, joined by one space."""
    rows = repeats.removals(docs, repeats.Words(), solver, length, gram, id_col, text_col)

    def run(batches):
        for batch in batches:
            data, offsets = core.text_buffers(batch.column("t"))
            cuts, total, removed, kept = batch.column("cut").to_pylist(), [], [], []
            for i, cut in enumerate(cuts):
                text = data[offsets[i] : offsets[i + 1]].copy()
                starts, ends, _ = core.words(text, np.array([0, len(text)]))
                gone = repeats.covered(len(starts), cut, length)
                stay = ~gone
                inside = np.zeros(len(text) + 1, np.int8)
                inside[starts[stay]] += 1
                inside[ends[stay]] -= 1
                keep = np.cumsum(inside[:-1]) > 0
                gap = ends[stay][:-1]
                text[gap] = 32
                keep[gap] = True
                total.append(len(starts))
                removed.append(int(gone.sum()))
                kept.append(text[keep].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())], names=["id", "n_words", "n_removed", "kept"])

    found = rows.select("id", "t", "cut").mapInArrow(run, "id long, n_words long, n_removed long, kept binary")
    return found.select(F.col("id").alias(id_col), "n_words", "n_removed", F.decode("kept", "UTF-8").alias("kept"))


ORACLE_SQL = r"""
WITH docs AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda t: t <> '') AS w FROM documents),
  windows AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM docs)),
  later AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1 AS goes FROM windows),
  words AS (SELECT doc_id, w[i] AS word, i FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs)),
  marked AS (SELECT doc_id, word, i, max(coalesce(goes, FALSE)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM words LEFT JOIN later USING (doc_id, i)),
  kept AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS t FROM marked GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM docs LEFT JOIN kept USING (doc_id)
"""
