"""The queries of the text-analytics operators over the tables, each with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bengali, english, text
from ..operators import aliases, automaton, lexicon, ordinals, transitions
from ..sources import readers, seeds
from . import sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(said: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = said
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def spread(df: DataFrame) -> DataFrame:
    """Deals a scan of fewer partitions than cores out to all cores: a small file's row group is a single task's work otherwise.

    Larger scans stay as they are read.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def english_documents(spark, sf_dir) -> DataFrame:
    return spread(table(spark, sf_dir, "documents", "doc_id", "text", "lang").where("lang = 'en'").select(F.col("doc_id").alias("block_id"), "text"))


def source_words(spark, sf_dir) -> DataFrame:
    """(source, word) of all documents' English-cleaned tokens."""
    docs = spread(table(spark, sf_dir, "documents", "source", "text"))
    return docs.select("source", F.explode(english.words(english.prepared(F.col("text")), True)).alias("word"))


SOURCE_WORDS = f"SELECT source, unnest({sql.words(sql.prepared('text'))}) AS word FROM documents"
EN_SENTENCES = sql.sentence_rows("documents", "doc_id", "lang = 'en'")


@query(f"SELECT doc_id, CAST(pos - 1 AS INTEGER) AS pos, sentence FROM (SELECT doc_id, unnest(p) AS sentence, generate_subscripts(p, 1) AS pos FROM (SELECT doc_id, list_filter({sql.pieces('text', english.DELIMITERS)}, lambda s: length(s) > 3) AS p FROM documents))")
def sentence_split_en(spark, sf_dir):
    pieces = F.filter(text.sentences(F.col("text"), english.DELIMITERS), lambda s: F.length(s) > 3)
    return table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.posexplode(pieces).alias("pos", "sentence"))


@query(f"SELECT doc_id, CAST(pos - 1 AS INTEGER) AS pos, sentence FROM (SELECT doc_id, unnest(p) AS sentence, generate_subscripts(p, 1) AS pos FROM (SELECT doc_id, {sql.pieces('text', bengali.DELIMITERS)} AS p FROM documents))")
def sentence_split_bn(spark, sf_dir):
    return table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.posexplode(text.sentences(F.col("text"), bengali.DELIMITERS)).alias("pos", "sentence"))


@query(f"SELECT word, count(*) AS n FROM ({SOURCE_WORDS}) GROUP BY word")
def clean_tokens_en(spark, sf_dir):
    return source_words(spark, sf_dir).groupBy("word").agg(F.count("*").alias("n"))


#: Tokens that tell the profiles apart; joiners, decomposed letters, marks out of order, punctuation.
TOKENS = [
    "বাংলা", "বাংলাদেশ", "দুঃখ", "সুতরাং", "চাঁদ", "হাঁটা", "অংশ", "জন্য", "ছয়", "মধযে", "াক", "অণ্", "১২", "ক১", "কাা", "ক্্ক", "কৄা", "abc", "ক" * 21, "ক" * 25, "ক" * 26,
]
#: The same as code points: forms apart, joiners, marks out of order, edges.
TOKEN_CODES = """
09DC; 09A1 09BC; 09A1 200C 09BC; 09C7 09BE; 09C7 09D7; FEFF 0995; 28 0995 29 2C; 09B6 09AC 09CD 09A6 0964; 2003 0995 A0; 0995 09BC 09CD; 0995 09CD 09BC;
0995 09FE 09CD 09BC; 0995 09CD 200D 09B7; 200C 0995; 09AF 09BC 09BE; 2D; 09E7; 0995 0981; 0981 0995; 0995 09BC; 0995 0981 0982
"""
TOKENS += ["".join(chr(int(c, 16)) for c in codes.split()) for codes in TOKEN_CODES.split(";")] + [""]
TOKEN_ROWS = [(i, t) for i, t in enumerate(TOKENS)]
TOKEN_SQL = sql.values(TOKEN_ROWS, "id, token")


def token_table(spark) -> DataFrame:
    return spark.createDataFrame(TOKEN_ROWS, "id int, token string")


def _profile_queries() -> None:
    for profile in ("lexicon", "transition", "dictionary", "profile"):

        def normalised(spark, sf_dir, profile=profile):
            return token_table(spark).select("id", bengali.normalise(F.col("token"), profile).alias("normalised"))

        QUERIES[f"normalize_{profile}_bn"] = normalised
        ORACLE[f"normalize_{profile}_bn"] = f"SELECT id, {sql.normalise('token', profile)} AS normalised FROM {TOKEN_SQL}"
    for profile in ("lexicon", "transition", "profile"):

        def validated(spark, sf_dir, profile=profile):
            return token_table(spark).select("id", bengali.normalise(F.col("token"), profile).alias("word")).withColumn("valid", bengali.valid(F.col("word"), profile))

        QUERIES[f"validate_{profile}_bn"] = validated
        ORACLE[f"validate_{profile}_bn"] = f"SELECT id, word, {sql.valid('word', profile)} AS valid FROM (SELECT id, {sql.normalise('token', profile)} AS word FROM {TOKEN_SQL})"


_profile_queries()


def english_pairs(spark, sf_dir) -> DataFrame:
    return transitions.blend(transitions.corpus_pairs(english_documents(spark, sf_dir), transitions.english_words(F.col("text")), weight=5))


EN_PAIRS = sql.blended(sql.pair_rows(EN_SENTENCES, sql.words("sentence"), 5, 1))


@query(f"SELECT w1, w2, CAST(cnt AS BIGINT) AS cnt FROM ({EN_PAIRS})")
def bigram_counts_en(spark, sf_dir):
    return english_pairs(spark, sf_dir).select("w1", "w2", "cnt")


@query(sql.ranked(EN_PAIRS, transitions.ENGLISH))
def ranked_transitions_en(spark, sf_dir):
    return transitions.rank(english_pairs(spark, sf_dir), transitions.ENGLISH)


OTHER_SENTENCES = f"SELECT block, unnest(p) AS sentence, generate_subscripts(p, 1) AS s FROM (SELECT doc_id AS block, {sql.pieces('text', bengali.DELIMITERS)} AS p FROM documents WHERE lang <> 'en')"
LETTERS = f"list_filter({sql.tokens('sentence')}, lambda t: regexp_full_match(t, '\\p{{L}}{{1,25}}'))"


@query(sql.ranked(sql.blended(sql.pair_rows(OTHER_SENTENCES, LETTERS, 1, 1)), transitions.BENGALI))
def ranked_transitions_bn_rules(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents", "doc_id", "text", "lang").where("lang <> 'en'").select(F.col("doc_id").alias("block_id"), "text"))
    words = F.transform(text.sentences(F.col("text"), bengali.DELIMITERS), lambda s: F.filter(text.tokens(s), lambda t: t.rlike(r"^\p{L}{1,25}$")))
    return transitions.rank(transitions.blend(transitions.corpus_pairs(docs, words)), transitions.BENGALI)


def _seed_sql(lines: str, profile) -> str:
    rows = sql.values(seeds.parse(lines), "seed_no, w1, pos, w2")
    total = profile.seed_weight if profile.flat_seed_total else f"{profile.seed_weight} - {profile.seed_step} * pos"
    return f"SELECT w1, w2, {profile.seed_weight} - {profile.seed_step} * pos AS cnt, {total} AS total, 2 * 1000000000000000 + seed_no * 1000 + pos AS fs FROM {rows}"


@query(sql.ranked(sql.blended(_seed_sql(seeds.BENGALI, transitions.BENGALI)), transitions.BENGALI))
def seed_transitions_bn(spark, sf_dir):
    return transitions.rank(transitions.blend(transitions.seed_pairs(seeds.inline(spark, seeds.BENGALI), transitions.BENGALI)), transitions.BENGALI)


@query(sql.ranked(sql.blended(_seed_sql(seeds.ENGLISH, transitions.ENGLISH)), transitions.ENGLISH))
def seed_transitions_en(spark, sf_dir):
    rows = transitions.seed_pairs(seeds.inline(spark, seeds.ENGLISH), transitions.ENGLISH, clean=english.clean)
    return transitions.rank(transitions.blend(rows), transitions.ENGLISH)


def benchmark_counts(spark, sf_dir) -> DataFrame:
    """(w1, w2, cnt, line_no): a pre-aggregated count table made from benchmark, a thousand for each occurrence."""
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    words = english.words(english.prepared(F.col("text")), True)
    each = items.select("item_id", F.posexplode(text.adjacent_pairs(words)).alias("k", "p"))
    return each.groupBy("p.w1", "p.w2").agg((F.count("*") * 1000).alias("cnt"), F.min(F.col("item_id") * 100000 + F.col("k")).alias("line_no"))


BENCH_WORDS = f"SELECT item_id, {sql.words(sql.prepared('text'))} AS w FROM benchmark"
BENCH_COUNTS = f"SELECT w[i] AS w1, w[i + 1] AS w2, count(*) * 1000 AS c, min(item_id * 100000 + i) AS line FROM (SELECT item_id, w, unnest(range(1, len(w))) AS i FROM ({BENCH_WORDS})) GROUP BY ALL"
BENCH_PAIRS = f"SELECT w1, w2, CAST(floor(log10(greatest(10, c)) * 20) AS BIGINT) AS cnt, CAST(floor(log10(greatest(10, c)) * 20) AS BIGINT) AS total, line AS fs FROM ({BENCH_COUNTS}) WHERE w1 <> w2"


@query(f"SELECT w1, w2, cnt FROM ({BENCH_PAIRS})")
def scaled_pair_counts(spark, sf_dir):
    return transitions.counted_pairs(benchmark_counts(spark, sf_dir)).select("w1", "w2", "cnt")


CONVERSATION_SENTENCES = sql.sentence_rows("conversations", "conv_id * 1000 + turn")


@query(sql.ranked(sql.blended(BENCH_PAIRS, sql.pair_rows(CONVERSATION_SENTENCES, sql.words("sentence"), 5, 1), _seed_sql(seeds.ENGLISH, transitions.ENGLISH)), transitions.ENGLISH))
def blended_transitions_en(spark, sf_dir):
    talk = spread(table(spark, sf_dir, "conversations", "conv_id", "turn", "text")).select((F.col("conv_id") * 1000 + F.col("turn")).alias("block_id"), "text")
    corpus = transitions.corpus_pairs(talk, transitions.english_words(F.col("text")), weight=5)
    first = transitions.counted_pairs(benchmark_counts(spark, sf_dir))
    seeded = transitions.seed_pairs(seeds.inline(spark, seeds.ENGLISH), transitions.ENGLISH, clean=english.clean)
    return transitions.rank(transitions.blend(first, corpus, seeded), transitions.ENGLISH)


@query("SELECT conv_id * 1000 + turn AS block_id, 0 AS k, text FROM conversations UNION ALL SELECT conv_id * 1000 + turn, 1, role FROM conversations")
def json_text_extract(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    value = F.to_json(F.array(F.struct(F.col("text").alias("instruction"), F.col("role").alias("input"), F.col("turn").alias("output"))))
    found = readers.json_texts(rows.select((F.col("conv_id") * 1000 + F.col("turn")).alias("block_id"), value.alias("value")))
    return found.select("block_id", "k", "text")


@query("SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY ALL")
def json_attribute_counts(spark, sf_dir):
    events = table(spark, sf_dir, "events", "event_type", "props")
    return events.select("event_type", F.expr("try_variant_get(try_parse_json(props), '$.k', 'bigint')").alias("k")).groupBy("event_type", "k").agg(F.count("*").alias("n"))


WORD_SOURCES = f"SELECT word, CAST(count(DISTINCT source) AS INTEGER) AS n_sources, count(*) AS n FROM ({SOURCE_WORDS}) GROUP BY word"


@query(WORD_SOURCES)
def word_source_sets(spark, sf_dir):
    return lexicon.word_sources(source_words(spark, sf_dir))


@query(f"SELECT source, count(*) AS n, count(DISTINCT word) AS n_words FROM ({SOURCE_WORDS}) GROUP BY source")
def source_profile(spark, sf_dir):
    return lexicon.source_profile(source_words(spark, sf_dir))


@query(f"SELECT n_sources, count(*) AS n_words FROM ({WORD_SOURCES}) GROUP BY n_sources")
def source_overlap_histogram(spark, sf_dir):
    return lexicon.overlap_histogram(source_words(spark, sf_dir))


def ranks(spark, sf_dir) -> DataFrame:
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    lines = items.select("item_id", F.posexplode(text.tokens(english.prepared(F.col("text")))).alias("k", "t")).select((F.col("item_id") * 100000 + F.col("k")).alias("line_no"), english.clean(F.col("t"), True).alias("w"))
    return readers.occurrence_ranks(lines, F.col("w"), F.col("w") != "")


RANKS = f"SELECT word, min(r) AS rank FROM (SELECT w[i] AS word, row_number() OVER (ORDER BY item_id, i) AS r FROM (SELECT item_id, w, unnest(range(1, len(w) + 1)) AS i FROM ({BENCH_WORDS}))) GROUP BY word"


@query(RANKS)
def occurrence_ranks(spark, sf_dir):
    return ranks(spark, sf_dir)


def baseline(spark, sf_dir) -> DataFrame:
    """Words of the documents labelled toxic: 180 and one more for each such document, at most 255."""
    marked = table(spark, sf_dir, "labels", "doc_id", "toxic").where("toxic = 1").select("doc_id").distinct()
    docs = table(spark, sf_dir, "documents", "doc_id", "text").join(marked, "doc_id", "left_semi")
    each = docs.select("doc_id", F.explode(english.words(english.prepared(F.col("text")), True)).alias("word")).distinct()
    return each.groupBy("word").agg(F.least(F.lit(255), 180 + F.count("*")).cast("int").alias("freq"))


BASELINE = f"SELECT word, CAST(least(255, 180 + count(DISTINCT doc_id)) AS INTEGER) AS freq FROM (SELECT doc_id, unnest({sql.words(sql.prepared('text'))}) AS word FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)) GROUP BY word"
_RANK_CASE = "CASE " + " ".join(f"WHEN rank <= {r} THEN {s}" for r, s in lexicon.BY_RANK) + " ELSE 0 END"
_SOURCE_CASE = "CASE " + " ".join(f"WHEN n_sources >= {n} THEN {s}" for n, s in lexicon.BY_SOURCES) + " END"
SCORES = f"""
    WITH base AS ({BASELINE}), ranks AS ({RANKS}),
      known AS (SELECT word, count(DISTINCT source) AS n_sources FROM (SELECT source, word FROM ({SOURCE_WORDS}) UNION ALL SELECT 'baseline', word FROM base) GROUP BY word)
    SELECT word, CAST(least(255, greatest(1, coalesce(base.freq, greatest({_SOURCE_CASE}, {_RANK_CASE})))) AS INTEGER) AS freq
    FROM known LEFT JOIN base USING (word) LEFT JOIN ranks USING (word)"""


@query(SCORES)
def lexicon_scores(spark, sf_dir):
    return lexicon.scores(source_words(spark, sf_dir), ranks(spark, sf_dir), baseline(spark, sf_dir))


_TIER_CASE = "CASE " + " ".join(f"WHEN freq >= {f} THEN '{t}'" for f, t in lexicon.TIERS) + " END"


@query(f"SELECT {_TIER_CASE} AS tier, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS percent FROM ({SCORES}) GROUP BY 1")
def lexicon_tiers(spark, sf_dir):
    return lexicon.tiers(lexicon_scores(spark, sf_dir))


@query("SELECT replace(p_name, ' ', '_') AS word, CAST(least(255, greatest(1, max(p_size * 10))) AS INTEGER) AS freq, min(p_partkey) AS first_line FROM part GROUP BY 1")
def wordlist_import(spark, sf_dir):
    part = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_size")
    line = F.concat(F.lit(" "), F.translate("p_name", " ", "_"), F.when(F.col("p_partkey") % 2 == 0, F.lit(" f=")).otherwise(F.lit(" ")), (F.col("p_size") * 10).cast("string"))
    return lexicon.import_wordlist(part.select(F.col("p_partkey").alias("line_no"), line.alias("value")))


COMBINED = ["dictionary=main:x", "", "# comment", "shortcut=early,f=3", "word=love,f=14,not_a_word=true", " shortcut=❤️,f=14", "word=ভালবাসা,f=20,f=30", " shortcut=love,f=1", " shortcut=x", "word=plain", "word=love,f=99", "word=❤️,f=7", "word=100,f=14", " shortcut=💯"]
COMBINED_ROWS = [("f", i, x) for i, x in enumerate(COMBINED)]
#: The entries of these lines, worked out by hand.
ENTRY_ROWS = [(0, "love", 14, "❤️"), (1, "ভালবাসা", 30, "love|x"), (2, "plain", 1, ""), (3, "love", 99, ""), (4, "❤️", 7, ""), (5, "100", 14, "💯")]


def combined_lines(spark) -> DataFrame:
    return spark.createDataFrame(COMBINED_ROWS, "source string, line_no long, value string")


_LINES = f"(SELECT line_no, trim(value) AS x FROM {sql.values(COMBINED_ROWS, 'source, line_no, value')})"
ENTRIES = f"""
    SELECT entry - 1 AS pos, max(word) AS word, CAST(max(f) AS INTEGER) AS freq, coalesce(list(shortcut ORDER BY line_no) FILTER (shortcut IS NOT NULL), []) AS shortcuts FROM (
      SELECT line_no, sum(CASE WHEN starts_with(x, 'word=') THEN 1 ELSE 0 END) OVER (ORDER BY line_no) AS entry,
        CASE WHEN starts_with(x, 'word=') THEN substr(string_split(x, ',')[1], 6) END AS word, CASE WHEN starts_with(x, 'shortcut=') THEN substr(string_split(x, ',')[1], 10) END AS shortcut,
        CASE WHEN starts_with(x, 'word=') THEN coalesce(CAST(substr(list_filter(string_split(x, ','), lambda p: starts_with(p, 'f='))[-1], 3) AS INTEGER), 1) END AS f
      FROM {_LINES} WHERE starts_with(x, 'word=') OR starts_with(x, 'shortcut='))
    WHERE entry > 0 GROUP BY entry"""


@query(f"SELECT CAST(pos AS BIGINT) AS pos, word, freq, array_to_string(shortcuts, '|') AS shortcuts FROM ({ENTRIES})")
def combined_parse(spark, sf_dir):
    found = readers.combined_entries(combined_lines(spark))
    return found.select("pos", "word", "freq", F.array_join("shortcuts", "|").alias("shortcuts"))


EXPANDED = f"""
    SELECT word, first(freq ORDER BY place) AS freq, first(target ORDER BY place) AS target FROM (
      SELECT word, freq, shortcuts[1] AS target, pos * 100 AS place FROM ({ENTRIES})
      UNION ALL SELECT shortcuts[i], 1, NULL, pos * 100 + i FROM (SELECT pos, shortcuts, unnest(range(1, len(shortcuts) + 1)) AS i FROM ({ENTRIES})))
    GROUP BY word"""
VOCABULARY = f"""
    SELECT word, freq, target, idx, CAST(least(15, (r - 1) // greatest(1, n // 16)) AS INTEGER) AS code FROM (
      SELECT *, row_number() OVER (ORDER BY word) - 1 AS idx, rank() OVER (ORDER BY freq) AS r, count(*) OVER () AS n FROM ({EXPANDED}))"""
ALIASES = f"""
    WITH RECURSIVE v AS ({VOCABULARY}), hop(word, target, k) AS (
      SELECT word, target, 1 FROM v WHERE target IS NOT NULL
      UNION ALL SELECT hop.word, v.target, k + 1 FROM hop JOIN v ON v.word = hop.target WHERE v.target IS NOT NULL AND k < 32)
    SELECT a.idx AS key_idx, b.idx AS target_idx FROM hop JOIN v a ON a.word = hop.word JOIN v b ON b.word = hop.target WHERE b.target IS NULL"""


@query(ALIASES)
def alias_resolution(spark, sf_dir):
    return aliases.build(readers.combined_entries(combined_lines(spark)))[1]


@query(f"SELECT word, CAST(idx AS BIGINT) AS idx, CAST(freq AS INTEGER) AS freq, code FROM ({VOCABULARY})")
def dictionary_entries(spark, sf_dir):
    return aliases.build(readers.combined_entries(combined_lines(spark)))[0].select("word", "idx", "freq", "code")


def told(found: DataFrame) -> DataFrame:
    """Lookups with -1 and an empty target for misses."""
    return found.fillna({"idx": -1, "target": ""})


PROBES = ["love", "❤️", "ভালবাসা", "100", "💯", "x", "plain", "", "missing"]


@query(f"WITH v AS ({VOCABULARY}), a AS ({ALIASES}) SELECT p.word, v.idx IS NOT NULL AS found, coalesce(v.idx, -1) AS idx, coalesce(t.word, '') AS target FROM {sql.values([(p,) for p in PROBES], 'word').replace('AS v(', 'AS p(')} LEFT JOIN v ON v.word = p.word LEFT JOIN a ON a.key_idx = v.idx LEFT JOIN v t ON t.idx = coalesce(a.target_idx, v.idx)")
def shortcut_lookup(spark, sf_dir):
    vocabulary, found = aliases.build(readers.combined_entries(combined_lines(spark)))
    return told(aliases.lookup(vocabulary, found, spark.createDataFrame([(p,) for p in PROBES], "word string")))


def line_words(spark, sf_dir) -> DataFrame:
    """(word, freq): how often each raw token occurs in documents."""
    docs = spread(table(spark, sf_dir, "documents", "text"))
    return readers.plain_words(docs.select(F.explode(F.split("text", " ")).alias("value")))


LINE_WORDS = f"SELECT word, count(*) AS freq FROM (SELECT {sql.strip('t')} AS word FROM (SELECT unnest(string_split(text, ' ')) AS t FROM documents)) WHERE word <> '' GROUP BY word"


@query(LINE_WORDS)
def plain_word_count(spark, sf_dir):
    return line_words(spark, sf_dir)


@query(f"SELECT word, row_number() OVER (ORDER BY word) - 1 AS idx FROM ({LINE_WORDS})")
def vocab_ordinals(spark, sf_dir):
    return ordinals.word_order(line_words(spark, sf_dir).select("word"))


@query(f"SELECT idx, word FROM (SELECT word, row_number() OVER (ORDER BY word) - 1 AS idx FROM ({LINE_WORDS})) WHERE idx IN (SELECT item_id * 7 FROM benchmark)")
def ordinal_to_word(spark, sf_dir):
    wanted = table(spark, sf_dir, "benchmark", "item_id").select((F.col("item_id") * 7).alias("idx"))
    return ordinals.word_at(vocab_ordinals(spark, sf_dir), wanted)


@query(f"SELECT word, freq, CAST(least(15, (rank() OVER (ORDER BY freq) - 1) // greatest(1, count(*) OVER () // 16)) AS INTEGER) AS code FROM ({LINE_WORDS})")
def freq_quantize16(spark, sf_dir):
    return ordinals.quantise(line_words(spark, sf_dir))


TALK_WORDS = f"SELECT DISTINCT word FROM (SELECT unnest({sql.words(sql.prepared('text'))}) AS word FROM conversations)"


def talk_words(spark, sf_dir) -> DataFrame:
    talk = table(spark, sf_dir, "conversations", "text")
    return talk.select(F.explode(english.words(english.prepared(F.col("text")), True)).alias("word")).distinct()


@query(f"WITH v AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS idx FROM (SELECT DISTINCT word FROM ({SOURCE_WORDS}))) SELECT t.word, v.idx IS NOT NULL AS found, coalesce(v.idx, -1) AS idx, coalesce(v.word, '') AS target FROM ({TALK_WORDS}) t LEFT JOIN v USING (word)")
def lexicon_lookup(spark, sf_dir):
    words = source_words(spark, sf_dir).select("word").distinct()
    vocabulary = ordinals.word_order(words)
    none = spark.createDataFrame([], "key_idx long, target_idx long")
    return told(aliases.lookup(vocabulary, none, talk_words(spark, sf_dir)))


EN_RANKED = sql.ranked(EN_PAIRS, transitions.ENGLISH)


@query(f"SELECT t.word, r.rk, r.w2 FROM ({TALK_WORDS}) t JOIN ({EN_RANKED}) r ON r.w1 = t.word")
def next_word_lookup(spark, sf_dir):
    return transitions.predict(ranked_transitions_en(spark, sf_dir), talk_words(spark, sf_dir))


TALK_PAIRS = f"SELECT DISTINCT w1 AS word, w2 AS expected FROM ({sql.pair_rows(CONVERSATION_SENTENCES, sql.words('sentence'), 1, 1)})"


@query(f"SELECT count(*) AS n, CAST(sum(hit) AS BIGINT) AS hits, round(sum(hit) / count(*), 6) AS accuracy FROM (SELECT word, max(CASE WHEN r.w1 IS NULL THEN 0 ELSE 1 END) AS hit FROM ({TALK_PAIRS}) t LEFT JOIN ({EN_RANKED}) r ON r.w1 = t.word AND r.w2 = t.expected GROUP BY word)")
def prediction_accuracy(spark, sf_dir):
    talk = table(spark, sf_dir, "conversations", "conv_id", "text").withColumnRenamed("conv_id", "block_id")
    expected = transitions.corpus_pairs(talk, transitions.english_words(F.col("text"))).select(F.col("w1").alias("word"), F.col("w2").alias("expected"))
    return transitions.accuracy(ranked_transitions_en(spark, sf_dir), expected)


@query(f"""
    WITH r AS ({EN_RANKED}), a AS (SELECT w1, row_number() OVER (ORDER BY w1) - 1 AS o FROM (SELECT DISTINCT w1 FROM r)),
      uses AS (SELECT w1 AS word, o * 16 AS place FROM a UNION ALL SELECT r.w2, a.o * 16 + r.rk FROM r JOIN a USING (w1)),
      firsts AS (SELECT word, min(place) AS place FROM uses GROUP BY word)
    SELECT word, CAST(sum(strlen(word) + 1) OVER (ORDER BY place) - strlen(word) - 1 AS BIGINT) AS "offset" FROM firsts""")
def string_pool_offsets(spark, sf_dir):
    from ..sources import binary

    return binary.string_pool(ranked_transitions_en(spark, sf_dir)).select("word", "offset")


PART_PREFIXES = "SELECT w, substr(w, 1, n) AS p, substr(w, n + 1) AS s FROM (SELECT w, unnest(range(0, length(w) + 1)) AS n FROM (SELECT DISTINCT p_name AS w FROM part))"


def part_words(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part", "p_name").select(F.col("p_name").alias("word")).distinct()


@query(f"""
    WITH st AS (SELECT p, coalesce(string_agg(s, '|' ORDER BY s) FILTER (s <> ''), '') AS k, count(DISTINCT left(s, 1)) FILTER (s <> '') AS e FROM ({PART_PREFIXES}) GROUP BY p)
    SELECT CAST(sum(c) AS BIGINT) AS n_nodes, count(*) AS n_states, CAST(sum(e) AS BIGINT) AS n_transitions FROM (SELECT k, count(*) AS c, max(e) AS e FROM st GROUP BY k)""")
def dawg_states(spark, sf_dir):
    return automaton.state_counts(part_words(spark, sf_dir))


@query(f"""
    WITH o AS (SELECT w, row_number() OVER (ORDER BY w) - 1 AS idx FROM (SELECT DISTINCT p_name AS w FROM part)),
      f AS (SELECT p, min(idx) AS first, max(CASE WHEN p = w THEN 1 ELSE 0 END) AS is_word FROM ({PART_PREFIXES}) JOIN o USING (w) GROUP BY p)
    SELECT hex(c.p) AS prefix, c.first - u.first - u.is_word AS number FROM f c JOIN f u ON u.p = substr(c.p, 1, length(c.p) - 1) WHERE c.p <> ''""")
def dawg_numbers(spark, sf_dir):
    return automaton.transition_numbers(part_words(spark, sf_dir))


INTS = [("a", 0), ("a", 15), ("b", 16), ("c", -8), ("c", 7), ("d", -9), ("e", 255), ("f", 256), ("g", 65535), ("h", 65536), ("i", -32769), ("j", 1 << 24), ("k", -129), ("k", 5)]


@query(f"SELECT name, CAST(coalesce(CASE WHEN lo < 0 THEN CASE WHEN m <= 7 THEN 4 WHEN m <= 127 THEN 8 WHEN m <= 32767 THEN 16 WHEN m <= 8388607 THEN 24 END ELSE CASE WHEN m <= 15 THEN 4 WHEN m <= 255 THEN 8 WHEN m <= 65535 THEN 16 WHEN m <= 16777215 THEN 24 END END, 0) AS INTEGER) AS bits FROM (SELECT name, min(x) AS lo, greatest(max(x), -min(x) - 1) AS m FROM {sql.values(INTS, 'name, x')} GROUP BY name)")
def int_width_detect(spark, sf_dir):
    return ordinals.int_width(spark.createDataFrame(INTS, "name string, value long"), "name", "value").fillna({"bits": 0})


@query(f"""
    SELECT prefix, CAST(rk AS INTEGER) AS rk, word FROM (SELECT prefix, word, row_number() OVER (PARTITION BY prefix ORDER BY freq DESC, word) AS rk
      FROM (SELECT DISTINCT substr(word, 1, 2) AS prefix FROM ({TALK_WORDS}) WHERE length(word) >= 2) p JOIN (SELECT word, count(*) AS freq FROM ({SOURCE_WORDS}) GROUP BY word) w ON starts_with(w.word, p.prefix))
    WHERE rk <= 5""")
def prefix_completion(spark, sf_dir):
    wanted = talk_words(spark, sf_dir).where("length(word) >= 2").select(F.substring("word", 1, 2).alias("prefix")).distinct()
    counted = source_words(spark, sf_dir).groupBy("word").agg(F.count("*").alias("freq"))
    return aliases.complete(counted, wanted)
