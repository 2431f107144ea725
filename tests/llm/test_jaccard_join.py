"""Operator 7 against all pairs."""

import random
import re
import tracemalloc

import numpy as np
import pytest

from quillstream.llm import components, jaccard_join


def brute(rows):
    sets = []
    for d, t in rows:
        t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if k and 100 * k >= 80 * (len(sets[i]) + len(sets[j]) - k):
                top[find(i)] = find(j)
    key = lambda i: 1 << 63 if rows[i][0] is None else rows[i][0]
    least = {}
    for i in range(len(rows)):
        least[find(i)] = min(least.get(find(i), 1 << 64), key(i))
    return sorted((key(i), len(sets[i]), least[find(i)]) for i in range(len(rows)))


def same(documents, rows):
    none = lambda x: 1 << 63 if x is None else x
    got = [(none(r.doc_id), r.n_shingles, none(r.component_id)) for r in jaccard_join.join_documents(documents(rows, 3)).collect()]
    assert sorted(got) == brute(rows)


def corpus(seed, n=120):
    """Chains of edits, so that groups link through members that are unlike each other."""
    rng = random.Random(seed)
    vocab = [f"W{i}" for i in range(300)]
    rows, texts = [], []
    for i in range(n):
        if texts and rng.random() < 0.75:
            w = rng.choice(texts[-12:]).split()
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            w += [rng.choice(vocab) for _ in range(rng.randint(0, 6))]
        else:
            w = [rng.choice(vocab) for _ in range(rng.choice([6, 30, 80, 120]))]
        texts.append(" ".join(w))
        rows.append((i * 2, texts[-1] if rng.random() < 0.5 else texts[-1].lower()))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, documents, seed):
    odd = [(900, None), (901, ""), (902, " \t"), (903, "one two"), (904, "One TWO"), (905, "one"), (905, "one"), (906, "x " * 4000), (907, "x " * 5000), (None, "y z y z y z y z"), (908, "É a b c d e f"), (909, "é a b c d e f")]
    same(documents, corpus(seed) + (odd if seed == 1 else []))


def test_hot_group_of_near_copies_and_a_common_passage(spark, documents):
    rng = random.Random(9)
    base, passage = [f"b{i}" for i in range(100)], " ".join(f"p{i}" for i in range(20))
    rows = []
    for i in range(80):
        w = list(base)
        w[rng.randrange(100)] = f"z{i}"
        w[rng.randrange(100)] = f"y{i}"
        rows.append((i, " ".join(w)))
    rows += [(200 + i, " ".join(f"q{rng.randrange(10**6)}" for _ in range(40)) + " " + passage) for i in range(80)]
    same(documents, rows)


def test_empty_table_and_clashing_columns(spark, documents):
    assert jaccard_join.join_documents(documents([])).count() == 0
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g")]
    clash = documents(rows).withColumnRenamed("lang", "e").withColumnRenamed("source", "label")
    assert [r.component_id for r in jaccard_join.join_documents(clash).collect()] == [1, 1]
    assert [r.doc_id for r in jaccard_join.keep_one(documents(rows + [(3, None)])).orderBy("doc_id").collect()] == [1, 3]


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "x long, y long")
    got = {r.v: r.label for r in components.components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_repeated_rows_of_one_id_do_not_multiply_the_overlap(spark, documents):
    """Rows of one id, or null ids, with one text stand next to a document of similarity 0.5 to 0.7."""
    rows = []
    for g in range(24):
        w = [f"g{g}w{i}" for i in range(60)]
        cut = (12, 14, 18)[g % 3]
        other = [f"g{g}n{i}" for i in range(cut)]
        rows += [(10 * g if g % 3 else None, " ".join(w))] * (2 + g % 2)
        rows += [(10 * g + 1, " ".join(w[: 60 - cut] + other))] * (1 + g // 12)
        # Documents that hold the tails make all shingles as frequent as the common ones, so the pair is a candidate.
        rows += [(10 * g + 3 + k, " ".join(w[56 - cut : 60 - cut] + tail + [f"g{g}z{k}x{i}" for i in range(90)])) for k, tail in enumerate((w[60 - cut :], other))]
    same(lambda r, parts: documents(r, 1), rows)
    same(documents, rows)


def test_split_buckets_and_many_sets_that_barely_miss(spark, documents):
    """Blocks of two sets; groups whose pairs lie on both sides of the threshold, so that all three rounds have work."""
    rng, rows = random.Random(4), []
    for g in range(6):
        base = [f"g{g}b{i}" for i in range(60)]
        for i in range(25):
            w = list(base)
            for _ in range(rng.randrange(1, 3)):
                w[rng.randrange(60)] = f"v{g}x{i}y{rng.randrange(4)}"
            rows.append((100 * g + i, " ".join(w)))
    got = {r.doc_id: r.component_id for r in jaccard_join.join_documents(documents(rows, 3), block=2).collect()}
    assert got == {d: c for d, _, c in brute(rows)}


def test_bounds_and_fragments():
    rng = np.random.default_rng(3)
    every = rng.integers(-(1 << 63), 1 << 63, 4000)
    order = jaccard_join.Order(every[:500], rng.integers(2, 100, 500))
    for _ in range(50):
        x, y = (np.sort(rng.choice(every, rng.integers(1, 900), replace=False)) for _ in range(2))
        fx, fy = order.fragments(x), order.fragments(y)
        assert set(fx) <= set(range(jaccard_join.FRAGMENTS)) and (order.place(x)[1] == (fx == jaccard_join.FRAGMENTS - 1)).all()
        # A fragment is a piece of the order: along the sorted set its number never falls.
        assert (np.diff(order.fragments(order.sort(x))) >= 0).all()
        bound = jaccard_join.may_overlap(jaccard_join.sketch(x, fx)[None], jaccard_join.sketch(y, fy)[None])[0]
        assert len(np.intersect1d(x, y)) <= bound <= min(len(x), len(y))


def peak(run):
    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_batch_is_counted_in_ranges():
    """The counting of a batch holds less than its sets themselves (at once it held six times as much); no shingle is lost or added."""
    rng = np.random.default_rng(5)
    common = rng.integers(-(1 << 63), 1 << 63, 20000)
    kept = [np.unique(np.concatenate([rng.integers(-(1 << 63), 1 << 63, 900), rng.choice(common, 100)])) for _ in range(3000)]
    met = np.zeros(jaccard_join.MET, bool)
    met[(common[:50].view(np.uint64) >> np.uint64(39)).astype(np.int64)] = True
    x, n = jaccard_join.counted(np.concatenate(kept))
    slot = (x.view(np.uint64) >> np.uint64(39)).astype(np.int64)
    again = met[slot] | (n > 1)
    got, most = peak(lambda: list(jaccard_join.met_again(kept, met)))
    order = np.argsort(found := np.concatenate([a for a, _ in got]))
    assert (found[order] == x[again]).all() and (np.concatenate([b for _, b in got])[order] == n[again]).all()
    assert met[slot].all() and most < sum(a.nbytes for a in kept)
    assert not sum(len(a) for a, _ in jaccard_join.met_again([np.zeros(0, np.int64)], met))


def test_bounds_of_many_pairs_hold_few_sketches():
    rng = np.random.default_rng(6)
    order = jaccard_join.Order(np.zeros(0, np.int64), np.zeros(0, np.int64))
    sets = [np.sort(rng.integers(-(1 << 63), 1 << 63, 50)) for _ in range(300)]
    sketches = np.stack([jaccard_join.sketch(x, order.fragments(x)) for x in sets])
    i, j = rng.integers(0, 300, (2, 200_000))
    got, most = peak(lambda: jaccard_join.bounds(sketches, i, j))
    assert (got == jaccard_join.may_overlap(sketches[i], sketches[j])).all() and most < sketches[i].nbytes
    assert len(jaccard_join.bounds(sketches, i[:0], j[:0])) == 0


def test_a_shared_hash_gives_way_to_the_second_one():
    found = np.array([3, 5, 8], np.int64)
    e, e2 = jaccard_join.set_id(found)
    assert e != e2 and jaccard_join.set_id(found, frozenset([e])) == (e2, e2)


def test_bitmap_of_wanted_keys_loses_none(spark):
    rows, wanted = spark.range(20000).withColumnRenamed("id", "d"), spark.range(0, 20000, 37).withColumnRenamed("id", "d")
    got = {r.d for r in jaccard_join.among(rows, "d", wanted, 1 << 20).collect()}
    assert set(range(0, 20000, 37)) <= got and len(got) < 1000
