"""Finding every repeated window of `length` symbols (words or bytes) over a whole corpus, for operators 3 and 4.

1. Each window is represented by its anchor, the smallest hash among its grams of `gram` symbols. Consecutive windows of
   one anchor form a run. Equal windows have equal anchors at equal offsets, so repeats meet if runs are dealt out by anchor.
   Of runs that are equal byte for byte a batch sends one on, with a list of its copies, so a hot passage costs a batch one row.
2. Hashes only choose what is looked at: two runs can share a window only if they agree on half of what a window holds beside the
   anchor, to its left or to its right; a hash of each side shows which do. All runs that agree with another, and those with copies, are fetched
   as text, whatever their number, and dealt out by anchor.
3. Texts decide. Of an anchor's runs, equal ones are made one text. An anchor with several texts goes to a solver (suffix
   subtrees, or merged Burrows-Wheeler transforms), which returns classes of equal windows; of one text every window is a class of its
   own. In each class all but the first window go, and are joined to their documents.

First means the smallest (id, start). A null id counts as the largest. Rows of one id are told apart by a hash of their text;
equal rows of one id have equal starts, so neither is earlier than the other and neither removes the other.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import core

_LOW = np.uint64((1 << 24) - 1)
#: Window starts taken at once from one long document.
SEGMENT = 1 << 22
RUNS = "a long, sides long, n int, d long, h int, s int, more binary"


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive values."""
    reach = 1
    while 2 * reach <= width:
        x = np.minimum(x[:-reach], x[reach:])
        reach *= 2
    return np.minimum(x[: len(x) - (width - reach)], x[width - reach :]) if width > reach else x


def runs_of(symbols: np.ndarray, bounds: np.ndarray, length: int, gram: int):
    """(document, start, windows, anchor, content hash, side hashes) of all runs; bounds: first symbol of each document, and the end.

    Side hashes: 32 bits of the anchor with its left half context, and 32 bits of it with its right one.
    """
    n = len(symbols)
    if n < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, np.uint64))
    if n > 2 * SEGMENT and len(bounds) == 2:
        parts = []
        for i in range(0, n - length + 1, SEGMENT):
            doc, s, k, a, c, x = runs_of(symbols[i : i + SEGMENT + length - 1], np.array([0, min(n - i, SEGMENT + length - 1)]), length, gram)
            parts.append((doc, s + i, k, a, c, x))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
    hashed = core.Hasher(symbols)
    at = np.arange(n - gram + 1)
    grams = hashed.of(at, at + gram)
    anchors = (sliding_min((grams & ~_LOW) | at.astype(np.uint64), length - gram + 1) & _LOW).astype(np.int64)
    owner = core.owners(bounds)[: len(anchors)]
    valid = np.arange(length, len(anchors) + length) <= bounds[owner + 1]
    opens = valid.copy()
    opens[1:] &= (anchors[1:] != anchors[:-1]) | ~valid[:-1]
    start = np.flatnonzero(opens)
    stops = np.append(np.flatnonzero(opens | ~valid), len(anchors))
    count = stops[np.searchsorted(stops, start, "right")] - start
    doc, at = owner[start], anchors[start]
    content, half = hashed.of(start, start + count - 1 + length), (length - gram + 1) // 2
    # Where a document ends before half a context, that side agrees with nothing.
    left = np.where(at - half >= bounds[doc], hashed.of(np.maximum(at - half, 0), at + gram), content)
    right = np.where(at + gram + half <= bounds[doc + 1], hashed.of(at, np.minimum(at + gram + half, n)), content)
    sides = (left & ~np.uint64(0xFFFFFFFF)) | (right >> np.uint64(32))
    return doc, start - bounds[doc], count, grams[at], content, sides


class Words:
    """Symbols are words; a run's text is its words joined by one space."""

    def symbols(self, data, offsets):
        starts, ends, bounds = core.words(data, offsets)
        return core.Hasher(core.byte_symbols(data)).of(starts, ends), bounds

    def pieces(self, data: np.ndarray, places: list[tuple[int, int]]) -> list[bytes]:
        starts, ends, _ = core.words(data, np.array([0, len(data)]))
        raw = data.tobytes()
        return [b" ".join(raw[a:b] for a, b in zip(starts[i:j].tolist(), ends[i:j].tolist(), strict=True)) for i, j in places]


class Bytes:
    """Symbols are bytes."""

    def symbols(self, data, offsets):
        return core.byte_symbols(data), offsets

    def pieces(self, data: np.ndarray, places: list[tuple[int, int]]) -> list[bytes]:
        return [data[i:j].tobytes() for i, j in places]


def without_copies(group: np.ndarray, bodies: Callable[[np.ndarray], list[bytes]]) -> np.ndarray:
    """Whether each row is the first of its group (sorted) with its body; `bodies` gives those of the rows asked for."""
    first = np.append(True, group[1:] != group[:-1]) if len(group) else np.zeros(0, bool)
    ask = np.flatnonzero(~first | np.append(~first[1:], False))
    seen: set[bytes] = set()
    for k, body in zip(ask.tolist(), bodies(ask), strict=True):
        if first[k]:
            seen = {body}
        elif body not in seen:
            seen.add(body)
            first[k] = True  # one hash, but another text
    return first


def find_runs(texts: DataFrame, kind, length: int, gram: int) -> DataFrame:
    """The runs of all texts (d, h, t); each batch joins equal runs, with the places of the later ones in `more`."""

    def run(batches):
        for batch in batches:
            data, offsets = core.text_buffers(batch.column("t"))
            ids, hashes = batch.column("d").to_numpy(), batch.column("h").to_numpy()
            found = []
            for i, j in core.slices(offsets):
                doc, s, n, a, c, x = runs_of(*kind.symbols(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]), length, gram)
                found.append((a.view(np.int64), c.view(np.int64), n, i + doc, s, x.view(np.int64)))
            if not found:
                continue
            a, c, n, doc, s, sides = (np.concatenate(x) for x in zip(*found, strict=True))
            if not len(a):
                continue
            order = np.lexsort((s, ids[doc], a, c))
            a, c, n, doc, s, sides = (x[order] for x in (a, c, n, doc, s, sides))
            group = np.cumsum(np.append(True, (c[1:] != c[:-1]) | (a[1:] != a[:-1])))

            def bodies(ask, doc=doc, s=s, n=n, data=data, offsets=offsets):
                out = [b""] * len(ask)
                by_doc = np.argsort(doc[ask], kind="stable")
                for part in np.split(by_doc, np.flatnonzero(np.diff(doc[ask][by_doc])) + 1):
                    if len(part):
                        k, rows = doc[ask[part[0]]], ask[part]
                        places = list(zip(s[rows].tolist(), (s[rows] + n[rows] - 1 + length).tolist(), strict=True))
                        for at, body in zip(part.tolist(), kind.pieces(data[offsets[k] : offsets[k + 1]], places), strict=True):
                            out[at] = body
                return out

            first = without_copies(group, bodies)
            d, h = ids[doc], hashes[doc]
            # A copy belongs to the first row of its text; groups of one hash and several texts are not joined at all.
            odd = np.isin(group, group[first][1:][np.diff(group[first]) == 0])
            first |= odd
            rest = np.ascontiguousarray(np.stack([d, h, s], 1)[~first]).tobytes()
            head = np.flatnonzero(first)
            ends = (np.cumsum(~first)[np.append(head[1:], len(a)) - 1]) * 24
            more = pa.BinaryArray.from_buffers(pa.large_binary(), len(head), [None, pa.py_buffer(np.append(0, ends).astype(np.int64)), pa.py_buffer(rest)]).cast(pa.binary())
            back = np.lexsort((s[head], doc[head]))  # in reading order, which compresses better
            columns = [pa.array(x[head][back]) for x in (a, sides)] + [pa.array(n[head][back], pa.int32()), pa.array(d[head][back]), pa.array(h[head][back], pa.int32()), pa.array(s[head][back], pa.int32()), more.take(pa.array(back))]
            whole = pa.RecordBatch.from_arrays(columns, names=["a", "sides", "n", "d", "h", "s", "more"])
            for i in range(0, len(head), 1 << 16):
                yield whole.slice(i, 1 << 16)

    return texts.select("d", "h", "t").mapInArrow(run, RUNS)


def whole_groups(batches, key: str, most_rows: int, most_bytes: int = 1 << 23):
    """Tables of about `most_rows` rows that hold all rows of each key, from batches sorted by key."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= most_rows or size >= most_bytes:
            table = pa.Table.from_batches(held).combine_chunks()
            keys = table.column(key).to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
            rows, size = table.num_rows - cut, 0
            if not cut:
                size = -size
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        if table.num_rows:
            yield table


def agrees(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether another member of the group has the same value."""
    order = np.lexsort((value, group))
    same = (group[order][1:] == group[order][:-1]) & (value[order][1:] == value[order][:-1])
    out = np.zeros(len(group), bool)
    out[order] = np.append(same, False) | np.append(False, same)
    return out


def compare_runs(runs: DataFrame) -> DataFrame:
    """The runs whose text is asked for: those that agree on a side with another run of their anchor, and those with copies."""

    def run(batches):
        for table in whole_groups(batches, "a", 1 << 17):
            a, sides = (table.column(x).to_numpy() for x in ("a", "sides"))
            copies = np.array([len(x) > 0 for x in table.column("more").to_pylist()])
            asked = copies | agrees(a, sides >> 32) | agrees(a, sides & 0xFFFFFFFF)
            yield from table.filter(pa.array(asked)).drop_columns(["sides"]).combine_chunks().to_batches()

    return runs.repartition("a").sortWithinPartitions("a").mapInArrow(run, RUNS.replace("sides long, ", ""))


def fetch(texts: DataFrame, asked: DataFrame, kind, length: int) -> DataFrame:
    """The text of each run asked for: (a, d, h, s, n, more, body)."""
    wanted = asked.groupBy("d", "h").agg(F.collect_list(F.struct("s", "n", "a", "more")).alias("ask"))
    names, types = ["a", "d", "h", "s", "n", "more", "body"], [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]

    def run(batches):
        for batch in batches:
            rows = batch.filter(batch.column("ask").is_valid())
            data, offsets = core.text_buffers(rows.column("t"))
            out, size = [], 0
            for k, (d, h) in enumerate(zip(rows.column("d").to_pylist(), rows.column("h").to_pylist(), strict=True)):
                ask = rows.column("ask")[k].as_py()
                bodies = kind.pieces(data[offsets[k] : offsets[k + 1]], [(x["s"], x["s"] + x["n"] - 1 + length) for x in ask])
                out += [(x["a"], d, h, x["s"], x["n"], x["more"], body) for x, body in zip(ask, bodies, strict=True)]
                size += sum(map(len, bodies))
                if size >= 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    # All columns of the texts, so that this exchange of the texts also serves the join in removals().
    return texts.join(wanted, ["d", "h"], "left").mapInArrow(run, "a long, d long, h int, s int, n int, more binary, body binary")


def later_spans(table: pa.Table, solver: Callable[[list[bytes], list[int], int], np.ndarray], length: int):
    """(d, h, s, n) of the windows that also start earlier, among all runs of some anchors (a, d, h, s, n, more, body)."""
    a, d, h, s, n = (table.column(x).to_numpy().astype(np.int64) for x in ("a", "d", "h", "s", "n"))
    known: dict[tuple[int, bytes], int] = {}
    text = np.array([known.setdefault(x, len(known)) for x in zip(a.tolist(), table.column("body").to_pylist(), strict=True)])
    bodies, anchor = [b for _, b in known], np.array([x for x, _ in known])
    counts = np.zeros(len(bodies), np.int64)
    counts[text] = n
    # All copies of each text.
    copies = [np.frombuffer(x or b"", np.int64).reshape(-1, 3) for x in table.column("more").to_pylist()]
    text = np.concatenate([text, np.repeat(text, [len(x) for x in copies])])
    d, h, s = np.concatenate([np.stack([d, h, s], 1), *copies]).T
    order = np.lexsort((s, d, text))
    text, d, h, s = text[order], d[order], h[order], s[order]
    _, of, size = np.unique(anchor, return_inverse=True, return_counts=True)
    open_texts = size[of] > 1
    # Anchors with one text: its copies but the first go, with all their windows.
    head = np.flatnonzero(np.append(True, text[1:] != text[:-1]))[text]
    goes = np.flatnonzero(~open_texts[text] & ((d > d[head]) | (d == d[head]) & (s > s[head])))
    out = [(d[goes], h[goes], s[goes], counts[text[goes]])]
    # Anchors with several texts: the solver tells which windows are equal.
    ask = np.flatnonzero(open_texts)
    if len(ask):
        classes = solver([bodies[k] for k in ask.tolist()], counts[ask].tolist(), length)
        begin = np.zeros(len(bodies), np.int64)
        begin[ask] = np.cumsum(counts[ask]) - counts[ask]
        rows = np.flatnonzero(open_texts[text])
        text, d, h, s, n = text[rows], d[rows], h[rows], s[rows], counts[text[rows]]
        run = np.repeat(np.arange(len(rows)), n)
        step = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
        k, dd, ss = classes[begin[text[run]] + step], d[run], s[run] + step
        order = np.lexsort((ss, dd, k))
        new = np.append(True, k[order][1:] != k[order][:-1])
        first = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
        later = np.zeros(len(run), bool)
        later[order] = (dd[order] > dd[first]) | (dd[order] == dd[first]) & (ss[order] > ss[first])
        goes = np.flatnonzero(later)
        opens = np.flatnonzero(np.append(True, (run[goes][1:] != run[goes][:-1]) | (np.diff(goes) != 1))) if len(goes) else goes
        at = goes[opens]
        out.append((dd[at], h[run[at]], ss[at], np.diff(np.append(opens, len(goes)))))
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def solve(bodies: DataFrame, solver: Callable[[list[bytes], list[int], int], np.ndarray], length: int) -> DataFrame:
    """Spans (d, h, s, n) of windows that also start earlier; solver(bodies, counts, length) gives each window's class."""

    def run(batches):
        for table in whole_groups(batches, "a", 1 << 20, 1 << 20):
            d, h, s, n = later_spans(table, solver, length)
            if len(d):
                yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(h, pa.int32()), pa.array(s, pa.int32()), pa.array(n, pa.int32())], names=["d", "h", "s", "n"])

    return bodies.repartition("a").sortWithinPartitions("a").mapInArrow(run, "d long, h int, s int, n int")


def removals(docs: DataFrame, kind, solver, length: int, gram: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's (id, d, h, t) and `cut`, the spans (s, n) of window starts that also start earlier; null if none."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(id_col), F.lit((1 << 63) - 1)).cast("long").alias("d"), F.hash(text).alias("h"), text.alias("t"))
    found = core.written(compare_runs(find_runs(texts, kind, length, gram)))
    solved = solve(fetch(texts, found, kind, length), solver, length)
    cuts = solved.groupBy("d", "h").agg(F.collect_list(F.struct("s", "n")).alias("cut"))
    return texts.join(cuts, ["d", "h"], "left")


def covered(n: int, cut: list | None, length: int) -> np.ndarray:
    """Which of a document's n symbols are covered by the windows of `cut`."""
    edge = np.zeros(n + 1, np.int32)
    if cut:
        s, k = np.array([x["s"] for x in cut]), np.array([x["n"] for x in cut])
        np.add.at(edge, s, 1)
        np.add.at(edge, np.minimum(s + k - 1 + length, n), -1)
    return np.cumsum(edge[:-1]) > 0
