"""Scans: text and JSON files to DataFrames with explicit schemas. A missing source raises; a missing optional one is an empty table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import bengali, text

#: Keys whose text is taken, in this order, from objects of a list and from objects in lists of an object.
LIST_KEYS = ("instruction", "input", "output", "context", "question", "answer", "text")
DICT_KEYS = ("context", "question", "text", "title")
INSTRUCTION_KEYS = ("instruction", "input", "output")


def valid_utf8(df: DataFrame) -> DataFrame:
    """Drops bytes that are not UTF-8."""
    return df.withColumn("value", F.replace(F.make_valid_utf8("value"), F.lit("�"), F.lit("")))


def lines(spark: SparkSession, path: str, optional: bool = False) -> DataFrame:
    """(source, line_no, value); line_no increases along each file. An absent path raises, unless the source is optional."""
    try:
        df = spark.read.text(path)
    except AnalysisException:
        if not optional:
            raise
        return spark.createDataFrame([], "source string, line_no long, value string")
    named = df.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("source"), (F.col("_metadata.file_block_start") * 4096 + F.monotonically_increasing_id() % (1 << 33)).alias("line_no"), "value")
    return valid_utf8(named)


def first_existing(spark: SparkSession, *paths: str) -> str:
    """The first path that can be read, else the last."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            return path
    return paths[-1]


def line_candidates(df: DataFrame) -> DataFrame:
    """(source, token) of word lists: a line may hold many words."""
    return df.select("source", F.explode(text.tokens(F.col("value"))).alias("token"))


def csv_field(df: DataFrame) -> DataFrame:
    """The third field of semicolon lines, unquoted; shorter lines go."""
    parts = F.split("value", ";")
    return df.where(F.size(parts) >= 3).withColumn("value", F.get(parts, F.lit(2)))


def csv_candidates(df: DataFrame) -> DataFrame:
    """(source, token) of the third field, with / , ( ) as spaces."""
    return line_candidates(csv_field(df).withColumn("value", F.translate("value", "/,()", "    ")))


def json_texts(df: DataFrame) -> DataFrame:
    """(block_id, seq, text) of JSON documents (block_id, value): strings, and strings under known keys, two levels deep.

    A list gives its strings and its objects' LIST_KEYS; an object its string values and, of its lists, the objects'
    DICT_KEYS. Broken JSON gives nothing.
    """
    parsed = df.select("block_id", F.expr("try_parse_json(value)").alias("v"))
    top = parsed.select("block_id", F.expr("schema_of_variant(v)").alias("kind"), "v").where("v IS NOT NULL")
    top.createOrReplaceTempView("_json_top")
    spark = df.sparkSession
    keys = lambda names, v: ", ".join(f"try_variant_get({v}, '$.{k}', 'variant')" for k in names)
    items = spark.sql("SELECT block_id, kind LIKE 'ARRAY%' AS listed, pos, value FROM _json_top, LATERAL variant_explode(v) WHERE kind LIKE 'ARRAY%' OR kind LIKE 'OBJECT%'")
    items.createOrReplaceTempView("_json_items")
    flat = spark.sql(
        f"""
        SELECT block_id, pos, 0 AS pos2, 0 AS k, value AS found FROM _json_items
        UNION ALL
        SELECT block_id, pos, 0, k, found FROM _json_items, LATERAL posexplode(array({keys(LIST_KEYS, 'value')})) AS t(k, found)
        WHERE listed AND schema_of_variant(value) LIKE 'OBJECT%'
        UNION ALL
        SELECT i.block_id, i.pos, e.pos, t.k, t.found FROM _json_items i, LATERAL variant_explode(i.value) AS e, LATERAL posexplode(array({keys(DICT_KEYS, 'e.value')})) AS t(k, found)
        WHERE NOT listed AND schema_of_variant(i.value) LIKE 'ARRAY%' AND schema_of_variant(e.value) LIKE 'OBJECT%'
        """
    )
    strings = flat.where("found IS NOT NULL AND schema_of_variant(found) = 'STRING'")
    # The place of a text in its block: item, item within the item (below 2^20), key (below 16).
    seq = F.shiftleft(F.col("pos").cast("long"), 24) + F.shiftleft(F.col("pos2").cast("long"), 4) + F.col("k")
    return strings.select("block_id", "pos", "pos2", "k", seq.alias("seq"), F.expr("CAST(found AS STRING)").alias("text"))


def json_files(spark: SparkSession, folder: str, least_bytes: int = 1000, names: str = "*.json") -> DataFrame:
    """(block_id, value): each *.json file of more than `least_bytes`; block_id is its ordinal by path."""
    from ..operators.ordinals import word_order

    df = spark.read.text(folder, wholetext=True, pathGlobFilter=names).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
    kept = valid_utf8(df).where(F.col("size") > least_bytes)
    numbered = word_order(kept.select("path"), "path", "block_id")
    return kept.join(numbered, "path").select("block_id", "value")


def instruction_texts(df: DataFrame) -> DataFrame:
    """(block_id, k, text) of (block_id, instruction, input, output) rows; empty ones go."""
    each = F.posexplode(F.array(*[F.col(k) for k in INSTRUCTION_KEYS]))
    return df.select("block_id", each.alias("k", "text")).where("text <> ''")


def pair_counts(df: DataFrame) -> DataFrame:
    """(w1, w2, cnt) of `w1 w2<TAB>count` lines; other lines go."""
    parts = F.split("value", "\t")
    words, number = text.tokens(F.get(parts, F.lit(0))), text.strip(F.get(parts, F.lit(1)))
    rows = df.where((F.size(parts) == 2) & (F.size(words) == 2))
    count = F.when(number.rlike("^[+-]?[0-9]+$"), number.try_cast("long"))
    return rows.select(F.get(words, F.lit(0)).alias("w1"), F.get(words, F.lit(1)).alias("w2"), count.alias("cnt")).where("cnt IS NOT NULL")


def combined_entries(df: DataFrame) -> DataFrame:
    """(source, pos, word, freq, shortcuts) of `.combined` lines (source, line_no, value).

    `word=` opens an entry, the `shortcut=` lines below it are its shortcuts. The running count of openings is taken per
    source; a source is one dictionary file.
    """
    x = text.strip(F.col("value"))
    kept = df.select("source", "line_no", x.alias("x")).where(x.startswith("word=") | x.startswith("shortcut="))
    entry = F.sum(F.col("x").startswith("word=").cast("int")).over(Window.partitionBy("source").orderBy("line_no"))
    marked = kept.withColumn("entry", entry).where("entry > 0")
    head = F.split("x", ",")[0]
    named = marked.select("source", "entry", "line_no", F.when(F.col("x").startswith("word="), F.substring(head, 6, 1 << 20)).alias("word"), F.coalesce(text.attribute(F.col("x"), "f").cast("int"), F.lit(1)).alias("f"), F.when(F.col("x").startswith("shortcut="), F.substring(head, 10, 1 << 20)).alias("shortcut"))
    listed = F.transform(F.array_sort(F.collect_list(F.when(F.col("shortcut").isNotNull(), F.struct("line_no", "shortcut")))), lambda s: s["shortcut"])
    grouped = named.groupBy("source", "entry").agg(F.max("word").alias("word"), F.max(F.when(F.col("word").isNotNull(), F.col("f"))).alias("freq"), listed.alias("shortcuts"))
    return grouped.select("source", (F.col("entry") - 1).cast("long").alias("pos"), "word", "freq", "shortcuts")


def keyword_tokens(df: DataFrame) -> DataFrame:
    """(source, token) of the `word=` lines of a `.combined` file."""
    return df.where(F.col("value").startswith("word=")).select("source", F.regexp_extract("value", "^word=([^,]*)", 1).alias("token"))


def baseline(df: DataFrame) -> DataFrame:
    """(word, freq) of a previous lexicon: default 200, the last of repeated words wins."""
    rows = df.where(F.col("value").startswith("word=")).select("line_no", F.regexp_extract("value", "^word=([^,]*)", 1).alias("word"), text.whole_number(text.attribute(F.col("value"), "f"), 200).alias("f"))
    return rows.groupBy("word").agg(F.max_by("f", "line_no").alias("freq"))


def occurrence_ranks(df: DataFrame, word: Column, valid: Column) -> DataFrame:
    """(word, rank): the ordinal of a word's first line among valid lines (line_no, ...), duplicates counted."""
    from ..operators.ordinals import dense_order

    rows = df.select("line_no", word.alias("word"), valid.alias("ok")).where("ok")
    return dense_order(rows, "line_no").groupBy("word").agg((F.min("idx") + 1).alias("rank"))


def plain_words(df: DataFrame) -> DataFrame:
    """(word, freq): how often each stripped, non-empty line occurs."""
    word = text.strip(F.col("value"))
    return df.select(word.alias("word")).where("word <> ''").groupBy("word").agg(F.count("*").alias("freq"))


def bengali_words(candidates: DataFrame, profile: str = "lexicon") -> DataFrame:
    """(source, word) of the candidates that are valid once normalised."""
    edges = F.col("token")
    return candidates.select("source", bengali.normalise(edges, profile).alias("word")).where(bengali.valid(F.col("word"), profile))
