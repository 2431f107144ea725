"""Operator 7: n-gram Jaccard join by vertical partitioning.

A document's set holds the distinct shingles of `words` words (the whole sequence if it has fewer). Two documents link when
their sets' Jaccard similarity is at least `percent` / 100. Equal sets are one class from the start, known by a hash of
128 bits.

1. The global order of shingles puts the frequent ones last. A task reports every shingle that it meets again, so one that is
   reported nowhere occurs in at most as many sets as there are tasks; the `FREQUENT` most frequent are ranked. The order only
   saves work; any order is exact.
2. The order is cut into `FRAGMENTS` pieces: the unranked shingles in equal ranges, and the ranked ones. Every set has, for each
   fragment, the size of its part and a bitmap of parities, which bound the overlap of two parts from above:
   at most (nx + ny - differing bits) / 2 of each fragment, summed over the fragments.
3. Candidates: the first n - ceil(0.8 n) + 1 shingles of a set in that order (two linked sets share one of them), dealt out by
   shingle; a frequent shingle's sets are split into blocks, compared pair of blocks by pair of blocks. A pair leaves its bucket only if
   its sizes, the places of the shared shingle and the summed bounds of the fragments allow a link.
4. Verification: the overlap of a pair is counted in each fragment separately, one after the other, and summed per pair.
5. The links' components become labels, in three rounds: each bucket's sets against a few centres; of each two labels that
   still meet in a bucket the nearest pair; then every remaining candidate pair with different labels. So no link between
   different components is lost, while pairs within a component need not be tried.

Shingles are compared by 64-bit hashes. Nulls: a null or empty text has an empty set, linked with nothing; a null id
counts as the largest and is returned as null. Rows of one id are linked by their sets like others. Very long texts are
handled one at a time, whole. Ties do not arise: a component has one smallest id. An empty table gives an empty result. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import components, core
from .repeats import whole_groups

FREQUENT, FRAGMENTS, SALTS = 1 << 20, 4, 32
#: Centres of a bucket in the first round; a bucket of one set more is thereby done.
CENTRES = 3
#: Sets of one shingle that are compared in one task; those of a more frequent one are split into blocks of about this size.
BLOCK = 1 << 13
#: 64-bit words of parities in each fragment's bitmap.
PARITY = 2
#: Slots in which a task remembers the shingles that it has met, and the reports that it holds before it sends them on.
MET, HELD = 1 << 25, 1 << 20
#: Shingles that are counted or sent together, bits of the ranges into which a batch's shingles are cut for that, and pairs whose sketches are compared together.
TOGETHER, RANGE_BITS, SKETCHED = 1 << 18, 6, 1 << 15
NO_ID = (1 << 63) - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (int64) of each document."""
    data = core.lower_ascii(data)
    starts, ends, bounds = core.words(data, offsets)
    hashes = core.Hasher(core.byte_symbols(data)).of(starts, ends)
    grams = core.Hasher(hashes)
    out = []
    for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        k = max(1, j - i - words + 1) if j > i else 0
        at = np.arange(i, i + k)
        found = np.sort(grams.of(at, np.minimum(at + words, j)).view(np.int64))
        out.append(found[np.append(True, found[1:] != found[:-1])] if k else found)
    return out


def set_id(found: np.ndarray, renamed: frozenset = frozenset()) -> tuple[int, int]:
    """Two independent hashes of the set. The first is its id, unless that is `renamed`; then the second is."""
    x = found.view(np.uint64)
    sums = np.array([core.mix(x).sum(), core.mix(x ^ np.uint64(0x5851F42D4C957F2D)).sum()], np.uint64) + np.uint64(len(found))
    e, e2 = core.mix(sums).view(np.int64).tolist()
    return (e2 if e in renamed else e), e2


def _sets(batch: pa.RecordBatch, words: int, renamed: frozenset = frozenset()):
    """(row, set id, second hash, set) of each row of a batch with the column t."""
    data, offsets = core.text_buffers(batch.column("t"))
    for i, j in core.slices(offsets):
        for k, found in enumerate(shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words)):
            yield i + k, *(set_id(found, renamed) if len(found) else (0, 0)), found


def counted(x: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values and the sums of their counts (1 each if none are given)."""
    order = np.argsort(x, kind="stable")
    x = x[order]
    head = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)
    return x[head], np.diff(np.append(head, len(x))) if n is None else np.add.reduceat(n[order], head) if len(x) else n


def met_again(kept: list[np.ndarray], met: np.ndarray):
    """The shingles of these sets that were met before or lie in several of them, and in how many; marks all as met.

    Range by range of the hash, whose ends are also ends of slots, so beside the sets a task holds the counting of one range only.
    """
    bits = min(RANGE_BITS, (sum(map(len, kept)) // TOGETHER).bit_length())
    edges = ((np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) ^ np.uint64(1 << 63)).view(np.int64) if bits else np.zeros(0, np.int64)
    cuts = [np.concatenate([[0], np.searchsorted(found, edges), [len(found)]]) for found in kept]
    for r in range(1 << bits):
        x, n = counted(np.concatenate([found[c[r] : c[r + 1]] for found, c in zip(kept, cuts, strict=True)]))
        slot = (x.view(np.uint64) >> np.uint64(39)).astype(np.int64) % MET
        again = met[slot] | (n > 1)
        met[slot] = True
        yield x[again], n[again]


def census(texts: DataFrame, words: int) -> DataFrame:
    """Rows of two kinds: (id, e, e2, n) for each document, and (e = shingle, n = how often) for those that a task meets again."""

    def reports(held):
        x, n = counted(*(np.concatenate(c) for c in zip(*held, strict=True)))
        void = pa.nulls(len(x), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(np.zeros(len(x), bool)), void, pa.array(x), void, pa.array(n.astype(np.int64))], names=["doc", "id", "e", "e2", "n"])

    def run(batches):
        met, held, size = np.zeros(MET, bool), [], 0
        for batch in batches:
            ids, sizes, seen, kept = [], [], set(), []
            for _, e, e2, found in _sets(batch, words):
                ids.append((e, e2))
                sizes.append(len(found))
                if len(found) and e not in seen:
                    seen.add(e)
                    kept.append(found)
            e, e2 = np.array(ids, np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([pa.array([True] * len(ids), pa.bool_()), batch.column("id"), pa.array(e), pa.array(e2), pa.array(sizes, pa.int64())], names=["doc", "id", "e", "e2", "n"])
            if kept:
                found = list(met_again(kept, met))
                held += found
                size += sum(len(x) for x, _ in found)
                if size >= HELD:
                    yield reports(held)
                    held, size = [], 0
        if held:
            yield reports(held)

    return texts.select("id", "t").mapInArrow(run, "doc boolean, id long, e long, e2 long, n long")


class Order:
    """The global order of shingles: rare ones by value, then the frequent ones by frequency; and its fragments."""

    def __init__(self, shingles: np.ndarray, counts: np.ndarray, block: int = BLOCK):
        at = np.argsort(shingles)
        self.shingles, self.counts, self.block = shingles[at], counts[at], block
        self.tiers = np.log2(np.maximum(self.counts, 1)).astype(np.int64) + 1

    def place(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the place in the table of the frequent ones, whether a shingle is there)."""
        if not len(self.shingles):
            return np.zeros(len(found), np.int64), np.zeros(len(found), bool)
        at = np.minimum(np.searchsorted(self.shingles, found), len(self.shingles) - 1)
        return at, self.shingles[at] == found

    def sort(self, found: np.ndarray) -> np.ndarray:
        at, known = self.place(found)
        return found[np.lexsort((found, np.where(known, self.tiers[at], 0)))] if known.any() else found

    def blocks(self, found: np.ndarray) -> np.ndarray:
        """Into how many blocks the sets of each shingle are split."""
        at, known = self.place(found)
        return np.where(known, -(-self.counts[at] // self.block), 1) if known.any() else np.ones(len(found), np.int64)

    def fragments(self, found: np.ndarray) -> np.ndarray:
        """The piece of the order in which each shingle lies."""
        rare = ((found.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(32)) * np.uint64(FRAGMENTS - 1) >> np.uint64(32)
        return np.where(self.place(found)[1], FRAGMENTS - 1, rare.astype(np.int64))


def sketch(found: np.ndarray, fragment: np.ndarray) -> np.ndarray:
    """Of each fragment the parities of the set's part, then of each its size."""
    bit = (core.mix(found.view(np.uint64)) % np.uint64(64 * PARITY)).astype(np.int64) + 64 * PARITY * fragment
    parity = np.bincount(bit, minlength=64 * PARITY * FRAGMENTS) & 1
    size = np.bincount(fragment, minlength=FRAGMENTS).astype(np.int64)
    return np.concatenate([np.packbits(parity.astype(np.uint8), bitorder="little").view(np.int64), size])


def may_overlap(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The bound of the overlaps of two lists of sketches, summed over the fragments."""
    bits = PARITY * FRAGMENTS
    differ = np.bitwise_count((x[:, :bits] ^ y[:, :bits]).view(np.uint64)).reshape(len(x), FRAGMENTS, PARITY).sum(2).astype(np.int64)
    return np.minimum((x[:, bits:] + y[:, bits:] - differ) // 2, np.minimum(x[:, bits:], y[:, bits:])).sum(1)


def bounds(sketches: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The bounds of the pairs (i, j), a few at a time: a pair's two sketches are far larger than its bound."""
    found = [may_overlap(sketches[i[k : k + SKETCHED]], sketches[j[k : k + SKETCHED]]) for k in range(0, len(i), SKETCHED)]
    return np.concatenate([np.zeros(0, np.int64), *found])


def required(n: np.ndarray | int, percent: int):
    """The least overlap of a set of n with any partner."""
    return -(-percent * n // 100)


BUCKET = "tok long, e long, n int, pos int, part int, blocks int, sketch binary"
MEMBERS = BUCKET + ", size int"


def prefixes(texts: DataFrame, order, words: int, percent: int, renamed: frozenset) -> DataFrame:
    """The prefix of every distinct set of a task, a row for each shingle, and its sketch, a row with tok = e and pos = -1."""

    def run(batches):
        for batch in batches:
            seen, out, held = set(), [], 0
            for _, e, _, found in _sets(batch, words, renamed):
                n = len(found)
                if n and e not in seen:
                    seen.add(e)
                    k = n - int(required(n, percent)) + 1
                    out.append((order.value.sort(found)[:k], e, n, sketch(found, order.value.fragments(found))))
                    held += k
                if held >= 1 << 16:
                    yield from rows(out)
                    out, held = [], 0
            if out:
                yield from rows(out)

    def rows(out):
        size = [len(x) for x, *_ in out]
        tok, ids, n = np.concatenate([x for x, *_ in out]), np.array([e for _, e, *_ in out], np.int64), np.array([x[2] for x in out], np.int32)
        e, blocks = np.repeat(ids, size), order.value.blocks(tok).astype(np.int32)
        pos = np.concatenate([np.arange(k, dtype=np.int32) for k in size])
        own = (e.view(np.uint64) % blocks.astype(np.uint64)).astype(np.int32)
        names = ["tok", "e", "n", "pos", "part", "blocks", "sketch"]
        yield pa.RecordBatch.from_arrays([*map(pa.array, (tok, e, np.repeat(n, size), pos, own, blocks)), pa.nulls(len(tok), pa.binary())], names=names)
        one = np.ones(len(ids), np.int32)
        yield pa.RecordBatch.from_arrays([*map(pa.array, (ids, ids, n, -one, 0 * one, one)), pa.array([x[3].tobytes() for x in out], pa.binary())], names=names)

    return texts.select("t").mapInArrow(run, BUCKET)


def may_link(n1, p1, n2, p2, percent: int):
    """Whether sets of these sizes, with their first common shingle at these places of the order, can link."""
    need = -(-percent * (n1 + n2) // (100 + percent))
    return 1 + np.minimum(n1 - p1 - 1, n2 - p2 - 1) >= need


def bucket_members(rows: DataFrame) -> DataFrame:
    """The distinct rows of buckets with several sets, those of split buckets, and the distinct sketches."""

    def run(batches):
        for table in whole_groups(batches, "tok", 1 << 17):
            tok, e, pos, part, blocks = (table.column(x).to_numpy() for x in ("tok", "e", "pos", "part", "blocks"))
            order = np.lexsort((e, pos < 0, part, tok))
            tok, e, pos, part, blocks = (x[order] for x in (tok, e, pos, part, blocks))
            head = np.append(True, (tok[1:] != tok[:-1]) | (part[1:] != part[:-1]) | ((pos[1:] < 0) != (pos[:-1] < 0)))
            new = head | np.append(True, e[1:] != e[:-1])
            size = np.bincount(np.cumsum(head) - 1, new)[np.cumsum(head) - 1]
            keep = new & ((size > 1) | (blocks > 1) | (pos < 0))
            kept = table.take(pa.array(order[keep])).append_column("size", pa.array(size[keep].astype(np.int32)))
            yield from kept.combine_chunks().to_batches()

    return rows.repartition("tok", "part").sortWithinPartitions("tok").mapInArrow(run, MEMBERS)


def expanded(row: np.ndarray, low: np.ndarray, high: np.ndarray, most: int = 1 << 18):
    """Chunks (i, j) of the pairs of each row with all of [low, high), cut between rows."""
    many = high - low
    ends, a = np.cumsum(many), 0
    while a < len(row):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, "right")))
        k = many[a:b]
        if k.sum():
            yield np.repeat(row[a:b], k), np.repeat(low[a:b] - np.cumsum(k) + k, k) + np.arange(k.sum())
        a = b


def distinct_pairs(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Places of the first of each equal pair."""
    order = np.lexsort((y, x))
    return order[np.append(True, (np.diff(x[order]) != 0) | (np.diff(y[order]) != 0))] if len(x) else order


def candidates(members: DataFrame, percent: int, mode: str) -> DataFrame:
    """Distinct pairs (x, y, nx, ny), x < y, of sets with different labels that share a bucket and whose bounds allow a link.

    mode `centres`: those with a bucket's centres, the first in a scrambled order that is alike in every bucket; these pairs are
    few, so their sketches are looked at afterwards (`near_enough`) rather than sent to every bucket. `nearest`: of each two labels in a bucket the pair with the largest bound. `all`: all of them.
    """

    def run(batches):
        for table in whole_groups(batches, "tok", 1 << 17):
            tok, e, n, pos, part, blocks, label = (table.column(x).to_numpy().astype(np.int64) for x in ("tok", "e", "n", "pos", "part", "blocks", "label"))
            order = np.lexsort((e, label, part, tok))
            tok, e, n, pos, part, blocks, label = (x[order] for x in (tok, e, n, pos, part, blocks, label))
            if mode != "centres":
                sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.int64).reshape(len(tok), -1)[order]
            new = np.append(True, (tok[1:] != tok[:-1]) | (part[1:] != part[:-1]))
            group, head = np.cumsum(new) - 1, np.flatnonzero(new)
            end = np.append(head[1:], len(tok))
            row = np.arange(len(tok))
            if mode == "centres":
                scrambled = np.lexsort((core.mix(e.view(np.uint64)), group))
                row = np.sort(scrambled[row - head[group] < CENTRES])
                low = head[group[row]]
            else:
                run_ends = np.flatnonzero(np.append(new[1:] | (label[1:] != label[:-1]), True)) + 1
                low = run_ends[np.searchsorted(run_ends, row, "right")]  # behind the sets of its own label
            own = (e.view(np.uint64) % blocks.astype(np.uint64)).astype(np.int64)
            within = part // blocks == part % blocks
            held: list[np.ndarray] = []
            for i, j in expanded(row, low, end[group[row]]):
                ok = (label[i] != label[j]) & may_link(n[i], pos[i], n[j], pos[j], percent)
                if mode != "centres":
                    ok &= within[i] | (own[i] != own[j])
                i, j = i[ok], j[ok]
                if mode != "centres":
                    bound = bounds(sketches, i, j)
                    ok = 100 * bound >= percent * (n[i] + n[j] - bound)
                    i, j, bound = i[ok], j[ok], bound[ok]
                if mode == "nearest" and len(i):
                    a, b = np.minimum(label[i], label[j]), np.maximum(label[i], label[j])
                    order = np.lexsort((-bound / (n[i] + n[j]), b, a, group[i]))
                    a, b, g = a[order], b[order], group[i][order]
                    first = order[np.append(True, (np.diff(a) != 0) | (np.diff(b) != 0) | (np.diff(g) != 0))]
                    i, j = i[first], j[first]
                swap = e[i] > e[j]
                i, j = np.where(swap, j, i), np.where(swap, i, j)
                keep = distinct_pairs(e[i], e[j])
                held.append(np.stack([i[keep], j[keep]]))
            if held:
                i, j = np.concatenate(held, 1)
                keep = distinct_pairs(e[i], e[j])
                for k in range(0, len(keep), 1 << 16):
                    x, y = i[keep[k : k + (1 << 16)]], j[keep[k : k + (1 << 16)]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (e[x], e[y], n[x], n[y])], names=["x", "y", "nx", "ny"])

    if mode != "centres":  # every block of a split bucket meets every other one
        met = F.expr("transform(sequence(0, blocks - 1), o -> least(o, part) * blocks + greatest(o, part))")
        members = members.withColumn("part", F.explode(F.when(F.col("blocks") > 1, met).otherwise(F.array(F.lit(0)))))
    found = members.repartition("tok", "part").sortWithinPartitions("tok").mapInArrow(run, "x long, y long, nx long, ny long")
    return found.groupBy("x", "y").agg(F.first("nx").alias("nx"), F.first("ny").alias("ny"))


def near_enough(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs whose summed bounds allow a link."""

    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int64).reshape(batch.num_rows, -1) for c in ("sx", "sy"))
            n, bound = batch.column("nx").to_numpy() + batch.column("ny").to_numpy(), may_overlap(x, y)
            yield batch.select(["x", "y", "nx", "ny"]).filter(pa.array(100 * bound >= percent * (n - bound)))

    left = pairs.join(growing(sketches.select(F.col("e").alias("x"), F.col("sketch").alias("sx"))), "x")
    both = left.join(growing(sketches.select(F.col("e").alias("y"), F.col("sketch").alias("sy"))), "y")
    return both.select("x", "y", "nx", "ny", "sx", "sy").mapInArrow(run, "x long, y long, nx long, ny long")


def least_count(shingles: DataFrame) -> int:
    """The least count for which at most FREQUENT shingles (e, n) are as frequent; from a histogram of at most 4,096 steps."""
    steps = shingles.groupBy(F.least("n", F.lit(4096)).alias("n")).agg(F.count("*").alias("k")).collect()
    total, least = 0, 1 << 62
    for r in sorted(steps, key=lambda r: -r["n"]):
        total += r["k"]
        if total > FREQUENT:
            break
        least = r["n"]
    return least


def growing(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the data: never broadcast, so the plan is the same at every size."""
    return df.hint("merge")


def unresolved(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of the buckets that still hold several labels, with their labels."""
    labelled = members.drop("label").join(growing(labels.withColumnRenamed("v", "e")), "e", "left").withColumn("label", F.coalesce("label", "e"))
    several = labelled.groupBy("tok").agg(F.min("label").alias("_a"), F.max("label").alias("_b")).where("_a < _b").select("tok")
    return labelled.join(growing(several), "tok", "left_semi")


def among(rows: DataFrame, key: str, wanted: DataFrame, bits: int = 1 << 24) -> DataFrame:
    """The rows whose key may be among the wanted ones, by a bitmap of `bits` hashes (2 MB at any size); none that is goes."""
    slot = F.pmod(F.xxhash64(key), F.lit(bits))
    bitmap = wanted.select(F.bitmap_bucket_number(slot).alias("_bucket"), F.bitmap_bit_position(slot).alias("_bit")).groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bitmap"))
    placed = rows.withColumns({"_bucket": F.bitmap_bucket_number(slot), "_bit": F.bitmap_bit_position(slot)})
    octet = F.conv(F.hex(F.expr("substring(_bitmap, CAST(_bit div 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    hit = placed.join(F.broadcast(bitmap), "_bucket").where(octet.bitwiseAND(F.expr("shiftleft(1, CAST(_bit % 8 AS INT))")) != 0)
    return hit.select(*rows.columns)


def fragments(texts: DataFrame, wanted: DataFrame, order, words: int, renamed: frozenset) -> DataFrame:
    """(e, f, part, many): the part of each wanted set in each fragment, from every row of d. wanted: (d, e, many)."""

    def run(batches):
        for batch in batches:
            want, many = batch.column("want").to_pylist(), batch.column("many").to_pylist()
            out, held = [], 0
            for k, e, _, found in _sets(batch, words, renamed):
                if e in want[k]:
                    of = order.value.fragments(found)
                    out += [(e, f, found[of == f], e in many[k]) for f in np.unique(of).tolist()]
                    held += len(found)
                if held >= TOGETHER:
                    yield rows(out)
                    out, held = [], 0
            if out:
                yield rows(out)

    def rows(out):
        e, f, part, m = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(e, pa.int64()), pa.array(f, pa.int32()), pa.array(part, pa.list_(pa.int64())), pa.array(m, pa.bool_())], names=["e", "f", "part", "many"])

    by_doc = wanted.groupBy("d").agg(F.collect_set("e").alias("want"), F.collect_set(F.when(F.col("many"), F.col("e"))).alias("many"))
    return among(texts.select("d", "t"), "d", wanted).join(growing(by_doc), "d").select("t", "want", "many").mapInArrow(run, "e long, f int, part array<long>, many boolean")


def distinct_parts(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The parts, and one row for each e and f of the sets that may stand on several rows of their id; only these are compared."""
    return found, core.written(found.where("many").select("e", "f", "part").dropDuplicates(["e", "f"]))


def verified(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """The pairs that link, by the sum of their overlaps in the fragments.

    One fragment is exchanged at a time, and of it only the parts of sets that may be in a pair, so the disk holds one fragment's exchange at once.
    """
    counts = []
    for f in range(FRAGMENTS):
        of = parts.where(F.col("f") == f)
        x, y = (among(of, "e", pairs.select(F.col(c).alias("e"))).select(F.col("e").alias(c), F.col("part").alias(f"part_{c}")) for c in "xy")
        both = pairs.join(growing(x), "x").join(growing(y), "y")
        counts.append(core.written(both.select("x", "y", "nx", "ny", F.size(F.array_intersect("part_x", "part_y")).alias("k")).where("k > 0")))
    every = functools.reduce(DataFrame.unionByName, counts)
    shared = every.groupBy("x", "y").agg(F.first("nx").alias("nx"), F.first("ny").alias("ny"), F.sum("k").alias("k"))
    found = core.written(shared.where(F.lit(100) * F.col("k") >= F.lit(percent) * (F.col("nx") + F.col("ny") - F.col("k"))).select("x", "y"))
    core.dropped(*counts)
    return found


def join_documents(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(id, n_shingles, component_id) of every document."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(id_col), F.lit(NO_ID)).cast("long").alias("d"), text.alias("t"))

    met = core.written(census(texts, words))
    # Different sets with one hash: of n sets, n * n / 2^65 are expected, so this list is short at any size.
    renamed = frozenset(r["e"] for r in met.where("doc AND n > 0").groupBy("e").agg(F.min("e2").alias("a"), F.max("e2").alias("b")).where("a <> b").select("e").collect())
    own = F.when(F.col("e").isin(list(renamed)), F.col("e2")).otherwise(F.col("e")) if renamed else F.col("e")
    documents = met.where("doc").select("id", F.coalesce("id", F.lit(NO_ID)).alias("d"), own.alias("e"), "n").withColumn("salt", F.pmod(F.hash("d"), F.lit(SALTS)))
    shingles = core.written(met.where("NOT doc").groupBy("e").agg(F.sum("n").alias("n")).where("n > 1"))
    frequent = shingles.where(F.col("n") >= least_count(shingles)).select("e", "n").toArrow()
    order = spark.sparkContext.broadcast(Order(frequent.column("e").to_numpy(), frequent.column("n").to_numpy(), block))

    sets = core.written(documents.where("n > 0").groupBy("e").agg(F.min("d").alias("d"), F.bit_or(F.expr("shiftleft(1L, salt)")).alias("salts"), F.count("*").alias("rows")))
    # Rows of different salts have different ids; with fewer salts than rows an id may be repeated.
    sets = sets.select("e", "d", "salts", (F.col("rows") > F.bit_count("salts")).alias("many"))
    buckets = core.written(bucket_members(prefixes(texts, order, words, percent, renamed)))
    sketches = buckets.where("pos < 0").select("e", "sketch")
    members = buckets.where("pos >= 0").drop("sketch").withColumn("label", F.col("e"))

    def ends(pairs):
        return pairs.select(F.col("x").alias("e")).union(pairs.select("y")).distinct()

    def wanted(found, past):
        asked = core.written(found.join(growing(sets), "e").select("d", "e", "many"))
        once, several = distinct_parts(core.written(fragments(texts, asked, order, words, renamed), by=["f"]))
        past += [asked, once, several]
        return once.where("NOT many").select("e", "f", "part").unionByName(several)

    tried = parts = links = labels = None
    past = [shingles, buckets]
    for mode in ("centres", "nearest", "all"):
        if mode == "centres":
            pairs = near_enough(candidates(members, percent, mode), sketches, percent)
            # Buckets without a pair that has no centre are done.
            members = members.where(f"size > {CENTRES + 1} OR blocks > 1")
        else:
            pairs = candidates(members.join(growing(sketches), "e"), percent, mode)
        pairs = core.written(pairs if tried is None else pairs.join(tried, ["x", "y"], "left_anti"))
        past.append(pairs)
        if not pairs.limit(1).count():
            if mode == "nearest":  # no two labels have a pair left
                break
            continue
        tried = pairs.select("x", "y") if tried is None else tried.unionByName(pairs.select("x", "y"))
        lacking = ends(pairs) if parts is None else ends(pairs).join(parts.select("e").distinct(), "e", "left_anti")
        if parts is None:
            parts = wanted(lacking, past)
        elif lacking.limit(1).count():
            parts = parts.unionByName(wanted(lacking, past))
        found = verified(pairs, parts, percent)
        links = found if links is None else links.unionByName(found)
        past += [found] if labels is None else [found, labels]
        labels = components.components(links)
        if mode != "all":
            members = core.written(unresolved(members, labels))
            past.append(members)
    core.dropped(*past)
    labels = spark.createDataFrame([], "v long, label long") if labels is None else labels

    whole = sets.join(labels.withColumnRenamed("v", "e"), "e", "left").withColumn("label", F.coalesce("label", "e"))
    least = whole.groupBy("label").agg(F.min("d").alias("component"))
    spread = whole.join(least, "label").select("e", "component", F.explode(F.expr(f"filter(sequence(0, {SALTS - 1}), i -> shiftright(salts, i) & 1L = 1L)")).alias("salt"))
    found = documents.join(spread, ["e", "salt"], "left")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.nullif(F.col("component"), F.lit(NO_ID)))
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents without a component of smaller id, with all their columns."""
    found = join_documents(docs, words, percent).where("doc_id = component_id OR component_id IS NULL").select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_kept_id"]), "left_semi")


ORACLE_SQL = r"""
WITH RECURSIVE docs AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda t: t <> '') AS w FROM documents),
  shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM docs WHERE len(w) > 0)),
  sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
  links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id JOIN sizes na ON na.doc_id = a.doc_id JOIN sizes nb ON nb.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(na.n) + any_value(nb.n) - count(*))),
  reach(x, y) AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, least(d.doc_id, coalesce(min(y), d.doc_id)) AS component_id
FROM docs d LEFT JOIN sizes USING (doc_id) LEFT JOIN reach ON reach.x = d.doc_id GROUP BY d.doc_id
"""
