"""Goldens, traps and round trips of the lexicon, transition, dictionary and file operators."""

import random
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quillstream.functions import bengali, english
from quillstream.operators import aliases, automaton, lexicon, ordinals, transitions
from quillstream.sources import binary, readers, seeds, sinks
from quillstream.streaming import counts

SHORTCUTS = Path(__file__).parent / "shortcuts.combined"


def lists(df):
    return {r.w1: r.succs for r in transitions.successor_lists(df).collect()}


def test_seed_goldens(spark):
    bn = transitions.rank(transitions.blend(transitions.seed_pairs(seeds.inline(spark, seeds.BENGALI), transitions.BENGALI)), transitions.BENGALI)
    rows = bn.collect()
    assert len({r.w1 for r in rows}) == 26 and len(rows) == 110
    got = {w: [(r.w2, r.cnt) for r in sorted(rows, key=lambda r: r.rk) if r.w1 == w] for w in ("শুভ", "খুব")}
    assert got["শুভ"] == [("কামনা", 1600), ("সকাল", 1000), ("রাত্রি", 950), ("জন্মদিন", 900), ("সন্ধ্যা", 800)]
    assert got["খুব"] == [("সুন্দর", 1850), ("ভালো", 1000), ("কষ্ট", 850), ("খুশি", 800)]
    en = transitions.rank(transitions.blend(transitions.seed_pairs(seeds.inline(spark, seeds.ENGLISH), transitions.ENGLISH, english.clean)), transitions.ENGLISH)
    assert lists(en)["i"] == ["am", "will", "have", "can", "know"]
    assert lists(en)["good"] == ["morning", "night", "luck", "job", "idea"]


def pairs(spark, rows):
    return spark.createDataFrame([(a, b, c, c, i) for i, (a, b, c) in enumerate(rows)], "w1 string, w2 string, cnt long, total long, first_seen long")


def test_english_seeds_are_whole(spark):
    found = seeds.parse(seeds.ENGLISH)
    assert len({k for k, *_ in found}) == 71 and found[0] == (0, "how", 0, "are") and found[-1] == (70, "very", 4, "happy")


def test_no_window_sorts_all_successors_of_a_word(spark):
    """The limit of the first ranking works before its exchange."""
    rows = pairs(spark, [("a", f"w{i}", i) for i in range(50)])
    plan = transitions.rank(rows, transitions.BENGALI)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_self_loops_cost_a_place_only_in_the_shorter_cut(spark):
    rows = pairs(spark, [("a", x, 50 - i) for i, x in enumerate("bcdaefgh")])
    assert lists(transitions.rank(rows, transitions.BENGALI))["a"] == list("bcde")
    assert lists(transitions.rank(rows, transitions.ENGLISH))["a"] == list("bcdef")


def test_pruning_and_ties(spark):
    rows = pairs(spark, [("rare", "x", 1), ("ten", "x", 10), ("nine", "x", 9), ("two", "y", 1), ("two", "x", 1)])
    assert lists(transitions.rank(rows, transitions.ENGLISH)) == {"ten": ["x"], "two": ["y", "x"]}
    assert set(lists(transitions.rank(rows, transitions.BENGALI))) == {"ten", "nine", "two"}


def test_invalid_tokens_are_bridged(spark):
    docs = spark.createDataFrame([(0, "Alpha 123 beta, gamma.  a,b delta"), (1, None), (2, "")], "block_id long, text string")
    got = transitions.corpus_pairs(docs, transitions.english_words(F.col("text")), weight=5).collect()
    assert [(r.w1, r.w2, r.cnt) for r in sorted(got, key=lambda r: r.first_seen)] == [("alpha", "beta", 5), ("beta", "gamma", 5)]
    bn = spark.createDataFrame([(0, "আমি ১২ ভালো। চাঁদ")], "block_id long, text string")
    assert [(r.w1, r.w2) for r in transitions.corpus_pairs(bn, transitions.bengali_words(F.col("text"))).collect()] == [("আমি", "ভালো")]


def test_log_weights(spark):
    table = spark.createDataFrame([("a", "b", 1, 0), ("a", "c", 100, 1), ("a", "d", 123456, 2), ("a", "a", 10**6, 3)], "w1 string, w2 string, cnt long, line_no long")
    assert {r.w2: r.cnt for r in transitions.counted_pairs(table).collect()} == {"b": 20, "c": 40, "d": 101}


def test_predict_and_accuracy(spark):
    ranked = spark.createDataFrame([("a", 1, "b", 9), ("a", 2, "c", 5)], "w1 string, rk int, w2 string, cnt long")
    probes = spark.createDataFrame([(" A ",), ("zz",)], "word string")
    assert [(r.word, r.rk, r.w2) for r in transitions.predict(ranked, probes).orderBy("rk").collect()] == [(" A ", 1, "b"), (" A ", 2, "c")]
    expected = spark.createDataFrame([("a", "x"), ("a", "c"), ("q", "b")], "word string, expected string")
    assert transitions.accuracy(ranked, expected).collect()[0][:] == (2, 1, 0.5)


def test_scores(spark):
    words = spark.createDataFrame([(f"s{k}", w) for w, n in [("five", 5), ("one", 1), ("ranked", 1), ("based", 2)] for k in range(n)] + [("s0", "one")] * 4, "source string, word string")
    ranks = spark.createDataFrame([("ranked", 400), ("one", 150001)], "word string, rank long")
    base = spark.createDataFrame([("based", 7), ("(raw)", 9)], "word string, freq int")
    got = {r.word: r.freq for r in lexicon.scores(words, ranks, base, lambda w: bengali.F.btrim(w, F.lit("()"))).collect()}
    assert got == {"five": 190, "one": 70, "ranked": 245, "based": 7, "raw": 70}


def test_quantiser_is_the_loop(spark):
    rng = random.Random(2)
    for n in (1, 5, 16, 40, 333):
        f = [rng.choice([1, 5, 9, rng.randint(1, 255)]) for _ in range(n)]
        got = {r.i: r.code for r in ordinals.quantise(spark.createDataFrame(list(enumerate(f)), "i int, freq int")).collect()}
        order = sorted(f)
        assert got == {i: min(15, order.index(x) // max(1, n // 16)) for i, x in enumerate(f)}


def test_orders(spark):
    words = ["", "a", "ab", "abc", "abd", "বাংলা", "🔥", "ﾮ", "b"] + [f"abc{i}" for i in range(50)]
    got = [r.word for r in ordinals.word_order(spark.createDataFrame([(w,) for w in words], "word string")).orderBy("idx").collect()]
    assert got == sorted(words, key=str.encode)
    rows = spark.createDataFrame([(i * 1000, i) for i in range(200)], "k long, v long")
    assert [r.offset for r in ordinals.running_offset(rows, "k", F.col("v"), buckets=5).orderBy("k").collect()] == [i * (i - 1) // 2 for i in range(200)]


@pytest.fixture(scope="module")
def shortcuts(spark):
    vocabulary, links = aliases.build(readers.combined_entries(readers.lines(spark, f"file://{SHORTCUTS}")))
    return vocabulary.cache(), links.cache()


def brute_dictionary():
    """{word: (idx, freq, code)} and {key ordinal: target ordinal} of the fixture, entry by entry."""
    entries = []
    for line in map(str.strip, SHORTCUTS.read_text().splitlines()):
        kind, _, rest = line.partition("=")
        if kind == "word":
            f = [x[2:] for x in rest.split(",")[1:] if x.startswith("f=")]
            entries.append((rest.split(",")[0], int(f[-1]) if f else 1, []))
        elif kind == "shortcut" and entries:
            entries[-1][2].append(rest.split(",")[0])
    known = {}
    for word, freq, targets in entries:
        known.setdefault(word, (freq, targets))
        for t in targets:
            known.setdefault(t, (1, []))
    words = sorted(known, key=str.encode)
    order = sorted(f for f, _ in known.values())
    rows = {w: (i, known[w][0], min(15, order.index(known[w][0]) // max(1, len(words) // 16))) for i, w in enumerate(words)}
    links = {}
    for w in words:
        at = w
        while known[at][1]:
            at = known[at][1][0]
        if at != w:
            links[rows[w][0]] = rows[at][0]
    return rows, links


def test_shortcut_dictionary_is_the_brute_one(spark, shortcuts):
    rows, links = brute_dictionary()
    assert len(rows) > 40 and len(links) > 30
    assert {r.word: (r.idx, r.freq, r.code) for r in shortcuts[0].collect()} == rows
    assert {r.key_idx: r.target_idx for r in shortcuts[1].collect()} == links


def test_automaton_is_minimal(spark, shortcuts):
    words = sorted(r.word.encode() for r in shortcuts[0].select("word").collect())
    states, root = binary.minimal_automaton(words)
    # Of a minimal automaton there is one state for each set of endings; a final edge leads to its target's endings and ends a word.
    endings = lambda p: frozenset(w[len(p) :] for w in words if w.startswith(p))
    prefixes = {w[:n] for w in words for n in range(len(w) + 1)}
    kinds = {frozenset(x for x in endings(p) if x): p for p in prefixes}
    assert (len(states), sum(map(len, states))) == (len(kinds), sum(len({x[:1] for x in k}) for k in kinds))
    small = spark.createDataFrame([(w,) for w in ("tap", "taps", "top", "tops", "x")], "word string")
    assert automaton.state_counts(small).collect()[0][:] == (9, 5, 6)
    assert {r.prefix: r.number for r in automaton.transition_numbers(small).collect()}["746F"] == 2


def test_dictionary_round_trip(spark, shortcuts, tmp_path):
    vocabulary, links = shortcuts
    data = binary.dictionary_bytes({"emoji": (vocabulary, links), "main": (vocabulary.where("false"), links.where("false"))})
    (tmp_path / "d.dict").write_bytes(data)
    reader = binary.DictionaryReader(data)
    rows = sorted(vocabulary.collect(), key=lambda r: r.idx)
    assert list(reader.words("emoji")) == [r.word for r in rows] and list(reader.words("main")) == []
    assert reader.query("emoji", "helios") == (True, brute_dictionary()[0]["helios"][0], "☀️") and reader.query("emoji", "helio") == reader.query("emoji", "") == reader.query("main", "love") == (False, None, None)
    assert all(reader.ordinal("emoji", r.word) == r.idx and reader.word("emoji", r.idx) == r.word and reader.code("emoji", r.idx) == r.code for r in rows)
    assert {r.name: r.n_words for r in binary.check_dictionary(spark, f"file://{tmp_path}/d.dict").collect()} == {"emoji": len(rows), "main": 0}
    again = {r.word: (r.idx, r.target) for r in binary.read_dictionary(spark, f"file://{tmp_path}/d.dict").collect()}
    joined = {r.word: (r.idx, r.target) for r in aliases.lookup(vocabulary, links, vocabulary.select("word")).collect()}
    assert again == joined


def test_index_round_trip(spark, tmp_path):
    ranked = transitions.rank(transitions.blend(transitions.seed_pairs(seeds.inline(spark, seeds.BENGALI), transitions.BENGALI)), transitions.BENGALI)
    data = binary.index_bytes(ranked)
    (tmp_path / "i.bin").write_bytes(data)
    want = lists(ranked)
    reader = binary.IndexReader(data)
    assert {w: reader.predict(w) for w in want} == want and reader.predict("x") == []
    assert sorted(binary.read_index(spark, f"file://{tmp_path}/i.bin").collect()) == sorted((w, i, s) for w, ss in want.items() for i, s in enumerate(ss, 1))
    with pytest.raises(ValueError):
        binary.IndexReader(b"XXXX" + data[4:])


def test_packed_integers():
    rng = random.Random(8)
    for bits, low, high, signed in ((4, 0, 15, False), (4, -8, 7, True), (8, -128, 127, True), (16, 0, 65535, False), (24, -(1 << 23), (1 << 23) - 1, True)):
        values = [low, high] + [rng.randint(low, high) for _ in range(7)]
        assert binary.width_of(values, signed) == bits
        assert binary.unpack_ints(binary.pack_ints(values, bits), 0, bits, len(values), signed) == values
    with pytest.raises(OverflowError):
        binary.width_of([1 << 24], False)
    for n in range(40):
        order, at = binary.tree_order(n), 0
        assert sorted(order) == list(range(n))
        for wanted in range(n):
            at = 0
            while order[at] != wanted:
                at = 2 * at + (1 if wanted < order[at] else 2)


def test_alias_chains_and_cycles(spark):
    rows = [("a", 0, ["b"]), ("b", 1, ["c", "z"]), ("c", 2, []), ("x", 3, ["y"]), ("y", 4, ["x"]), ("q", 5, ["nowhere"])]
    got = aliases.resolve(spark.createDataFrame(rows, "word string, idx long, shortcuts array<string>")).collect()
    assert sorted((r.key_idx, r.target_idx) for r in got) == [(0, 2), (1, 2)]


def test_first_of_equal_entries_stays(spark):
    rows = [(0, "k", 5, ["t"]), (1, "t", 9, ["u"]), (2, "k", 7, [])]
    got = {r.word: (r.freq, r.shortcuts) for r in aliases.expand(spark.createDataFrame(rows, "pos long, word string, freq int, shortcuts array<string>")).collect()}
    assert got == {"k": (5, ["t"]), "t": (1, [])} or got == {"k": (5, ["t"]), "t": (1, []), "u": (1, [])}


def write(path, content):
    path.write_bytes(content)
    return f"file://{path}"


def test_text_sources(spark, tmp_path):
    path = write(tmp_path / "words.txt", "বাংলা চাঁদ\n১২ abc\n(ছয়),\n".encode() + b"\xff\xe0\xa6\x95\n")
    lines = readers.lines(spark, path)
    got = [(r.source, r.word) for r in readers.bengali_words(readers.line_candidates(lines)).collect()]
    six = "".join(map(chr, (0x99B, 0x9DF)))
    assert sorted(w for _, w in got) == sorted(["বাংলা", "চাঁদ", six, "ক"]) and {s for s, _ in got} == {"words.txt"}
    csv = readers.lines(spark, write(tmp_path / "t.csv", "1;x;আমি/ভালো,(কাজ);z\na;b\n".encode()))
    assert sorted(r.token for r in readers.csv_candidates(csv).collect()) == sorted(["আমি", "ভালো", "কাজ"])
    assert [r.value for r in readers.csv_field(csv).collect()] == ["আমি/ভালো,(কাজ)"]
    assert readers.lines(spark, f"file://{tmp_path}/none.txt", optional=True).count() == 0
    with pytest.raises(AnalysisException):
        readers.lines(spark, f"file://{tmp_path}/none.txt")
    assert readers.first_existing(spark, f"file://{tmp_path}/none", path) == path
    ranks = readers.occurrence_ranks(readers.lines(spark, write(tmp_path / "r.txt", b"b\n\na\nb\nc\n")), F.col("value"), F.col("value") != "")
    assert {r.word: r["rank"] for r in ranks.collect()} == {"b": 1, "a": 2, "c": 4}
    assert {r.word: r.freq for r in readers.plain_words(readers.lines(spark, write(tmp_path / "p.txt", b" a \na\n\nb c\n"))).collect()} == {"a": 2, "b c": 1}
    table = readers.pair_counts(readers.lines(spark, write(tmp_path / "c.tsv", b"a b\t7\na b c\t7\na\t1\na b\tx\n")))
    assert [r[:] for r in table.collect()] == [("a", "b", 7)]
    base = readers.baseline(readers.lines(spark, write(tmp_path / "b.combined", b"dictionary=x\nword=a,f=3\nword=a,f=4\nword=b\nword=c,f=q\n")))
    assert {r.word: r.freq for r in base.collect()} == {"a": 4, "b": 200, "c": 200}
    imported = lexicon.import_wordlist(readers.lines(spark, write(tmp_path / "i.txt", b"# c\nx 5\nx f=9\ny\nz 999\nq zz\n")))
    assert {r.word: r.freq for r in imported.collect()} == {"x": 9, "y": 200, "z": 255, "q": 200}


def test_json_sources(spark, tmp_path):
    listed = '["bare", {"text": "t", "instruction": "i", "input": 5, "other": "no"}, 7, {"qas": [{"question": "deep"}]}]'
    keyed = '{"a": "top", "b": [{"context": "c", "question": "q", "qas": [{"question": "deep"}]}, "skipped"], "n": 3}'
    rows = spark.createDataFrame([(1, listed), (2, keyed), (3, "{broken"), (4, None)], "block_id long, value string")
    got = sorted((r.block_id, r.text) for r in readers.json_texts(rows).collect())
    assert got == [(1, "bare"), (1, "i"), (1, "t"), (2, "c"), (2, "q"), (2, "top")]
    (tmp_path / "small.json").write_text('["x"]')
    (tmp_path / "large.json").write_text('["' + "y" * 1200 + '"]')
    assert [r.text for r in readers.json_texts(readers.json_files(spark, f"file://{tmp_path}")).collect()] == ["y" * 1200]
    alpaca = spark.createDataFrame([(0, "a", "", "c")], "block_id long, instruction string, input string, output string")
    assert [(r.k, r.text) for r in readers.instruction_texts(alpaca).collect()] == [(0, "a"), (2, "c")]


def test_text_sinks(spark, tmp_path):
    words = spark.createDataFrame([("b", 9, 2), ("a", 9, 5), ("c", 200, 1)], "word string, freq int, first_line long").repartition(3)

    def lines(name):
        return "".join(p.read_text() for p in sorted((tmp_path / name).glob("part-*"))).splitlines()

    sinks.write_lexicon(words, f"file://{tmp_path}/lex")
    assert lines("lex")[1:] == ["word=c,f=200", "word=a,f=9", "word=b,f=9"]
    sinks.write_imported(words, f"file://{tmp_path}/imp")
    assert lines("imp")[1:] == ["word=c,f=200", "word=b,f=9", "word=a,f=9"]
    sinks.write_transitions(spark.createDataFrame([("b", ["x", "y"]), ("a", ["z"])], "w1 string, succs array<string>"), f"file://{tmp_path}/tr", single=False)
    assert lines("tr")[1:] == ["a\tz", "b\tx,y"]
    again = readers.baseline(readers.lines(spark, f"file://{tmp_path}/lex"))
    assert {r.word: r.freq for r in again.collect()} == {"a": 9, "b": 9, "c": 200}


def test_seed_file(spark, tmp_path):
    path = write(tmp_path / "s.txt", b"hi: there you\nso: what\n")
    assert [r[:] for r in seeds.read(spark, path).collect()] == [(0, "hi", 0, "there"), (0, "hi", 1, "you"), (1, "so", 0, "what")]


def test_streaming_counts(spark, tmp_path):
    spark.createDataFrame([(0, "One two three. One two.")], "block_id long, text string").write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema("block_id long, text string").parquet(f"file://{tmp_path}/in")
    q = counts.pair_counts(stream, transitions.english_words(F.col("text"))).writeStream.outputMode("complete").format("memory").queryName("pc").option("checkpointLocation", f"file://{tmp_path}/cp").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.w1, r.w2, r.cnt) for r in spark.table("pc").collect()) == [("one", "two", 2), ("two", "three", 1)]


def test_alias_chains_of_any_length_end_and_cycles_do_not(spark):
    chain = [(f"w{i:02}", i, [f"w{i + 1:02}"] if i < 70 else []) for i in range(71)]
    cycle = [("a", 100, ["b"]), ("b", 101, ["c"]), ("c", 102, ["a"]), ("in", 103, ["a"]), ("self", 104, ["self"]), ("lost", 105, ["nowhere"])]
    vocabulary = spark.createDataFrame(chain + cycle, "word string, idx long, shortcuts array<string>")
    assert sorted(tuple(r) for r in aliases.resolve(vocabulary).collect()) == [(i, 70) for i in range(70)]
