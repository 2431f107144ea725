"""Operators 3 and 4 against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from quillstream.llm import repeats, substring_dedup, suffix_dedup


def brute(docs, length, split):
    """docs: (id, text). Flags of removed symbols for each row."""
    seqs = [split(t) for _, t in docs]
    key = lambda r: 1 << 62 if docs[r][0] is None else docs[r][0]
    first = {}
    for r, s in enumerate(seqs):
        for i in range(len(s) - length + 1):
            w = tuple(s[i : i + length])
            first[w] = min(first.get(w, (1 << 63, 0)), (key(r), i))
    out = []
    for r, s in enumerate(seqs):
        gone = np.zeros(len(s), bool)
        for i in range(len(s) - length + 1):
            if first[tuple(s[i : i + length])] < (key(r), i):
                gone[i : i + length] = True
        out.append(gone)
    return seqs, out


def corpus(seed, n=60, words=40, vocabulary=400):
    rng = random.Random(seed)
    vocab = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(vocabulary)]
    base = [" ".join(rng.choice(vocab) for _ in range(rng.randint(0, words * 3))) for _ in range(n)]
    shared = [" ".join(rng.choice(vocab) for _ in range(30)) for _ in range(3)]
    rows = []
    for i in range(n):
        t = base[i]
        if rng.random() < 0.5:
            w = rng.choice(base[: i + 1]).split()
            for _ in range(rng.randint(0, 3)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(vocab)
            t = " ".join(w)
        if rng.random() < 0.5:
            t = t + rng.choice(["\n", "\t ", " "]) + rng.choice(shared) + " " + rng.choice(vocab)
        rows.append((i * 3, t))
    rng.shuffle(rows)
    return rows


ODD = [(1000, None), (1001, ""), (1002, "a " * 3000), (1003, "a " * 2000), (1004, " \n\t"), (1005, "short"), (1006, "x" * 5000), (None, "a " * 500)]


def same_words(documents, rows):
    got = substring_dedup.remove_repeats(documents(rows, 3), 20, 5).collect()
    seqs, gone = brute(rows, 20, lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = sorted((r[0] is None, r[0] or 0, len(s), int(g.sum()), " ".join(w for w, x in zip(s, g) if not x)) for r, s, g in zip(rows, seqs, gone))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept) for r in got) == want


def same_bytes(documents, rows, length=100, gram=28):
    got = suffix_dedup.remove_repeats(documents(rows, 3), length, gram).collect()
    seqs, gone = brute(rows, length, lambda t: list((t or "").encode()))
    spans = lambda g: int((np.diff(np.append(0, g.astype(int))) == 1).sum())
    want = sorted((r[0] is None, r[0] or 0, len(s), int(g.sum()), spans(g), hashlib.sha256(bytes(b for b, x in zip(s, g) if not x)).hexdigest()) for r, s, g in zip(rows, seqs, gone))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got) == want


@pytest.mark.parametrize("seed", [1, 2])
def test_words_against_brute_force(spark, documents, seed):
    same_words(documents, corpus(seed) + (ODD if seed == 1 else []))


@pytest.mark.parametrize("seed", [3, 4])
def test_bytes_against_brute_force(spark, documents, seed):
    same_bytes(documents, corpus(seed) + (ODD if seed == 3 else []))


def test_small_vocabulary(spark, documents):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 200)))) for i in range(60)]
    same_words(documents, rows)
    same_bytes(documents, rows)


def test_repeated_ids_and_rows(spark, documents):
    text = " ".join(f"v{i}" for i in range(60))
    same_words(documents, [(1, text), (1, text), (2, text + " end"), (2, "lead " + text)])
    same_bytes(documents, [(1, text), (1, text), (2, text + " end"), (2, "lead " + text)])
    clash = documents([(1, text), (2, text)]).withColumnRenamed("lang", "cut").withColumnRenamed("source", "d")
    assert sorted(r.n_removed for r in substring_dedup.remove_repeats(clash).collect()) == [0, 60]


def test_empty_table(spark, documents):
    assert substring_dedup.remove_repeats(documents([])).count() == suffix_dedup.remove_repeats(documents([])).count() == 0


def test_solvers_agree_with_equal_windows():
    rng = random.Random(6)
    for alphabet in (b"ab", b"abcdefgh"):
        bodies = [bytes(rng.choice(alphabet) for _ in range(rng.randint(12, 60))) for _ in range(80)]
        counts = [len(b) - 12 + 1 for b in bodies]
        windows = [b[i : i + 12] for b, n in zip(bodies, counts) for i in range(n)]
        for shards in (1, 2, 3):
            classes = suffix_dedup.solver(bodies, counts, 12, shards)
            pairs = set(zip(classes.tolist(), windows))
            assert len(pairs) == len({c for c, _ in pairs}) == len(set(windows))
        texts = [b" ".join(b[i : i + 1] for i in range(len(b))) for b in bodies]
        for most in (10, 1 << 17):
            classes = substring_dedup.solver(texts, counts, 12, most)
            pairs = set(zip(classes.tolist(), windows))
            assert len(pairs) == len({c for c, _ in pairs}) == len(set(windows))


def test_long_documents_are_cut_into_segments(monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT", 64)
    symbols = np.random.default_rng(7).integers(0, 1 << 60, 1000).astype(np.uint64)
    doc, s, n, *_ = repeats.runs_of(symbols, np.array([0, 1000]), 20, 5)
    assert sorted(i for a, k in zip(s, n) for i in range(a, a + k)) == list(range(981))


def test_no_window_goes_by_a_hash_alone():
    """Runs of one anchor, one hash and different texts: nothing is joined and nothing goes."""
    texts = [b"x%02d " % k * 25 for k in range(3)]
    group, body = np.array([0, 0, 0, 1, 1, 2]), [texts[0], texts[1], texts[0], texts[2], texts[2], texts[0]]
    assert repeats.without_copies(group, lambda ask: [body[k] for k in ask]).tolist() == [True, True, False, True, False, True]
    void, copy = b"", np.array([[9, 0, 4], [1, 0, 0]], np.int64).tobytes()

    def spans(rows):
        names = ["a", "d", "h", "s", "n", "more", "body"]
        table = pa.table({k: list(v) for k, v in zip(names, zip(*rows, strict=True), strict=True)})
        for solver, length in ((substring_dedup.solver, 20), (suffix_dedup.solver, 100)):
            yield sorted(zip(*(x.tolist() for x in repeats.later_spans(table, solver, length)), strict=True))

    words = [" ".join(f"w{i}{k}" for i in range(40)).encode() for k in "abc"]
    for found in spans([(7, 1, 0, 0, 5, void, words[0]), (7, 2, 0, 0, 5, void, words[1]), (7, 3, 0, 3, 5, void, words[2])]):
        assert found == []
    # Equal texts of one anchor and listed copies: all but the first place go, with all windows.
    for found in spans([(7, 5, 0, 0, 5, copy, words[0]), (7, 2, 0, 8, 5, void, words[0])]):
        assert found == [(2, 0, 8, 5), (5, 0, 0, 5), (9, 0, 4, 5)]
