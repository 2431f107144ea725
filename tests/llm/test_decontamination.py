"""Operator 1 against all stretches, with planted items; the pipeline against its stages by brute force."""

import random
import re
import time

import numpy as np
import pytest

import corpus_pipeline
from quillstream.llm import decontamination, language_id
from quillstream.llm.core import table
from tests.llm.test_jaccard_join import brute as jaccard


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def edit_distance(item, window):
    """Least edits from the item to any stretch of the window, by the plain recurrence."""
    row = [0] * (len(window) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(window, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_best_match_is_exact():
    rng = np.random.default_rng(1)
    for _ in range(200):
        item, window = rng.integers(0, 4, rng.integers(1, 9)), rng.integers(0, 4, rng.integers(0, 14))
        edits, start, n = decontamination.best_match(item, window)
        assert edits == edit_distance(item.tolist(), window.tolist())
        part = window[start : start + n].tolist()
        row = list(range(len(part) + 1))
        for i, x in enumerate(item.tolist(), 1):
            new = [i]
            for j, y in enumerate(part, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        assert row[-1] == edits


def planted(seed=2):
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(500)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.randint(12, 60)).capitalize() + ".") for i in range(30)]
    rows, want = [], set()
    for d in range(300):
        t = text(rng.randint(0, 200))
        if d % 3 == 0:
            i = rng.randrange(30)
            w = items[i][1].split()
            for _ in range(rng.randint(0, int(0.1 * len(w)))):
                k, op = rng.randrange(len(w)), rng.random()
                if op < 0.5:
                    w[k] = rng.choice(vocab)
                elif op < 0.75:
                    w.insert(k, rng.choice(vocab))
                else:
                    del w[k]
            t = f"{t} {' '.join(w)} {text(rng.randint(0, 60))}"
            want.add((d, i))
        rows.append((d, t))
    return items, rows, want


def test_planted_items(spark, documents):
    items, rows, want = planted()
    found = decontamination.contaminated(documents(rows), items_of(spark, items)).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert got <= want and len(got) >= 0.97 * len(want)
    texts, bench = dict(rows), dict(items)
    words = lambda t: "".join(c if c.isalnum() else " " for c in t.lower()).split()
    for r in found[:40]:
        assert r.distance == edit_distance(words(bench[r.item_id]), words(texts[r.doc_id]))
    blocks = decontamination.contaminated(documents(rows), items_of(spark, items), block=7).collect()
    assert {(r.doc_id, r.item_id) for r in blocks} == got


def test_exact_items_are_always_found(spark, sf_dir):
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    want = {(d.doc_id, b.item_id) for d in docs.collect() for b in bench.collect() if b.text in d.text}
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench).where("distance = 0").collect()}
    assert want <= got


def test_odd_rows(spark, documents):
    item = "one two three four five six seven eight"
    rows = [(1, None), (2, ""), (3, "x " * 40000 + item), (4, item.upper() + "!"), (None, item), (4, item), (5, "four five six")]
    items = items_of(spark, [(1, item), (1, item), (2, None), (3, ""), (4, "the")])
    got = sorted((r.doc_id or 0, r.item_id, r.distance) for r in decontamination.contaminated(documents(rows), items).collect())
    assert set(got) == {(3, 1, 0), (4, 1, 0), (0, 1, 0)}
    assert decontamination.contaminated(documents([]), items).count() == 0
    assert decontamination.contaminated(documents(rows), items_of(spark, [])).count() == 0
    kept = decontamination.keep_clean(documents(rows).withColumnRenamed("lang", "item_id"), items)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 5]


def test_plan_reaches_the_target_recall():
    """Measured again on other random items: every length class, the whole edit budget spent."""
    for n in (5, 7, 10, 14, 16, 20, 30, 59, 200):
        k = n // 5
        m, walks = decontamination.plan(5 * min(k, 12), min(k, 12), 0.99)
        assert 1 <= walks <= decontamination.WALKS and decontamination.recalls(n, k, 300, 99)[m - 1, walks - 1] >= 0.97
    assert decontamination.plan(4, 0, 0.99)[1] == 1


def test_equal_stretches_walk_alike_and_texts_are_not_left():
    rng = np.random.default_rng(5)
    words = rng.integers(1, 1 << 62, 30).astype(np.uint64)
    x = np.concatenate([words, [0], words[:3], [0]]).astype(np.uint64)
    for t in range(decontamination.WALKS):
        for m, s in enumerate(decontamination.signatures(x, t), 1):
            assert len(np.unique(s[:25])) == 25
            reach = decontamination.COORDINATES[t][m - 1] + 1
            if reach <= 3:
                assert s[0] == s[31]
        again = list(decontamination.signatures(np.concatenate([words[:3], [0], rng.integers(1, 9, 20), [0]]).astype(np.uint64), t))[-1]
        assert again[0] == s[31]


def test_pipeline(spark, sf_dir):
    """Each stage keeps what a brute-force version of it keeps; the pieces hold the rest."""
    docs = sorted(((r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()), key=lambda r: r[0])
    docs = [r for r in docs if r[1] and language_id.LETTER.search(r[1])]
    seen, distinct = set(), []
    for d, t in docs:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", t)
        if key not in seen:
            seen.add(key)
            distinct.append((d, t))
    least = {d: c for d, _, c in jaccard(distinct)}
    single = [(d, t) for d, t in distinct if least[d] == d]
    bench = [r.text for r in table(spark, sf_dir, "benchmark").collect()]
    clean = [d for d, t in single if not any(b in t for b in bench)]
    got = {r.doc_id for r in corpus_pipeline.run(spark, sf_dir).select("doc_id").distinct().collect()}
    assert got <= set(clean) and len(got) >= 0.97 * len(clean)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "packing"]
    assert pytest.approx(0.99, abs=0.03) == len(got) / len(clean)


def edited(rng, w, edits, vocab):
    w = list(w)
    for _ in range(edits):
        k, op = rng.randrange(len(w)), rng.random()
        if op < 0.4:
            w[k] = rng.choice(vocab)
        elif op < 0.7 or len(w) == 1:
            w.insert(k, rng.choice(vocab))
        else:
            del w[k]
    return w


def test_every_position_and_the_full_edit_budget(spark, documents):
    """Lower-case items of 5-60 words at every word position, with none and with all of the edits, as by brute force."""
    rng = random.Random(4)
    vocab = [f"v{i}" for i in range(60)] + ["слово", "語"]
    items = [(n, " ".join(rng.choice(vocab) for _ in range(n))) for n in (5, 6, 7, 9, 10, 15, 30, 60)]
    rows = []
    for n, t in items:
        for position in range(9):
            for edits in (0, n // 5):
                w = [rng.choice(vocab) for _ in range(position)] + edited(rng, t.split(), edits, vocab) + [rng.choice(vocab) for _ in range(7)]
                rows.append((len(rows), " ".join(w)))
    got = {(r.doc_id, r.item_id): r.distance for r in decontamination.contaminated(documents(rows), items_of(spark, items)).collect()}
    want = {(d, i): edit_distance(t.split(), x.split()) for d, x in rows for i, t in items}
    assert got == {k: v for k, v in want.items() if v <= k[1] // 5}
    assert len(got) >= len(rows)


def test_items_of_a_few_words(spark, documents):
    """Items under 5 words are found word for word; a longer item is not, beyond its edits."""
    items = items_of(spark, [(1, "Alpha"), (2, "beta gamma"), (3, "delta, alpha beta"), (4, "one two three four"), (5, "..."), (5, "alpha")])
    rows = [(1, "the ALPHA beta; gamma"), (2, "beta x gamma alphabet"), (3, "x delta alpha beta"), (4, "so one two three four five"), (5, "one two four three"), (6, "beta"), (7, "gamma")]
    got = sorted((r.doc_id, r.item_id, r.distance, r.start_word, r.n_words) for r in decontamination.contaminated(documents(rows), items).collect())
    assert got == [(1, 1, 0, 1, 1), (1, 2, 0, 2, 2), (1, 5, 0, 1, 1), (3, 1, 0, 2, 1), (3, 3, 0, 1, 3), (3, 5, 0, 2, 1), (4, 4, 0, 1, 4)]


def test_recall_at_the_full_edit_budget():
    """Every planted copy with all of its edits is found, with the distance of brute force."""
    rng = random.Random(6)
    vocab = [f"v{i}" for i in range(2000)]
    texts = [" ".join(rng.choice(vocab) for _ in range(n)) for n in (5, 8, 15, 20, 30, 45, 60) for _ in range(20)]
    items = decontamination.Items(list(range(len(texts))), texts, 0.8)
    docs = [" ".join([*rng.choices(vocab, k=rng.randrange(40)), *edited(rng, t.split(), len(t.split()) // 5, vocab), *rng.choices(vocab, k=20)]) for t in texts]
    data, offsets = np.frombuffer("".join(docs).encode(), np.uint8), np.cumsum([0] + [len(d) for d in docs])
    found = decontamination.search(data, offsets, items)
    assert {(i, i): found[i, i][0] for i in range(len(texts))} == {(i, i): edit_distance(t.split(), d.split()) for i, (t, d) in enumerate(zip(texts, docs, strict=True))}


def test_many_items_are_indexed_quickly():
    rng = random.Random(1)
    vocab = [f"v{i}" for i in range(3000)]
    texts = [" ".join(rng.choices(vocab, k=rng.randint(5, 60))) for _ in range(5000)]
    began = time.time()
    items = decontamination.Items(list(range(5000)), texts, 0.8)
    assert time.time() - began < 15 and len(items.words) == 5000


def test_clashing_columns_repeated_rows_and_a_very_long_text(spark, documents):
    item = " ".join(f"w{i}" for i in range(20))
    rows = [(1, "x " * 200000 + item), (2, item), (2, item), (3, "clean")]
    clash = documents(rows).withColumnRenamed("lang", "t").withColumnRenamed("source", "distance")
    got = sorted((r.doc_id, r.distance, r.start_word) for r in decontamination.contaminated(clash, items_of(spark, [(7, item), (7, item)])).collect())
    assert got == [(1, 0, 200000)] * 2 + [(2, 0, 0)] * 4


def test_pipeline_stages_on_odd_tables(spark, documents, sf_dir):
    """Each stage on an empty table, and on nulls, repeated rows, ties and an extra column."""
    copy = " ".join(f"w{i}" for i in range(40))
    rows = documents([(1, copy), (2, copy + "  "), (3, copy), (3, copy), (4, None), (None, "no id here"), (5, ""), (6, copy + " end"), (7, "123 ²")])
    odd = rows.withColumnRenamed("n_chars", "e")
    kept = {"language ID": [None, 1, 2, 3, 3, 6], "exact dedup": [None, 1, 2, 6], "n-gram Jaccard join": [None, 1], "benchmark decontamination": [None, 1], "packing": [None, 1]}
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, documents([]), sf_dir)
        assert empty.count() == 0
        odd = stage(spark, odd, sf_dir)
        assert name == "packing" or odd.columns == ["doc_id", "text", "lang", "source", "e"]
        rows = odd.select("doc_id").distinct() if name == "packing" else odd  # a document may be cut into several pieces
        assert sorted((r.doc_id for r in rows.select("doc_id").collect()), key=lambda d: d or 0) == kept[name], name
