"""Multi-source lexicon: corroboration by distinct sources, rank boost, baseline, tiers, overlap, import."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text

#: Fixed values: (least number of sources, score), (last rank, score), (least frequency, tier).
BY_SOURCES = [(5, 190), (4, 165), (3, 140), (2, 110), (0, 70)]
BY_RANK = [(500, 245), (1500, 235), (5000, 220), (15000, 195), (40000, 165), (80000, 135), (150000, 105)]
TIERS = [(220, "220-255"), (180, "180-219"), (140, "140-179"), (100, "100-139"), (50, "50-99"), (0, "1-49")]


def _steps(x: Column, steps: list, at_least: bool) -> Column:
    out = F.lit(None)
    for bound, value in reversed(steps):
        out = F.when(x >= bound if at_least else x <= bound, F.lit(value)).otherwise(out)
    return out


def word_sources(words: DataFrame) -> DataFrame:
    """(word, n_sources, n) of (source, word) rows. Two levels of grouping, so a frequent word is combined map-side."""
    each = words.groupBy("word", "source").agg(F.count("*").alias("n"))
    return each.groupBy("word").agg(F.count("*").cast("int").alias("n_sources"), F.sum("n").alias("n"))


def scores(words: DataFrame, ranks: DataFrame, baseline: DataFrame, clean=lambda w: w) -> DataFrame:
    """(word, freq): the baseline's frequency, else the better of the source and rank scores, within 1..255.

    Baseline words join the vocabulary, cleaned by `clean`, as one more source; the override looks the cleaned word up
    among the baseline's raw words.
    """
    extra = baseline.select(F.lit("baseline").alias("source"), clean(F.col("word")).alias("word")).where("word <> ''")
    known = word_sources(words.select("source", "word").unionByName(extra))
    joined = known.join(baseline.select("word", F.col("freq").alias("_base")), "word", "left").join(ranks.select("word", "rank"), "word", "left")
    found = F.greatest(_steps(F.col("n_sources"), BY_SOURCES, True), _steps(F.col("rank"), BY_RANK, False))
    return joined.select("word", text.clamp(F.coalesce("_base", found)).cast("int").alias("freq"))


def tiers(lexicon: DataFrame) -> DataFrame:
    """(tier, n, percent) of a lexicon's frequencies."""
    each = lexicon.groupBy(_steps(F.col("freq"), TIERS, True).alias("tier")).agg(F.count("*").alias("n"))
    return each.withColumn("percent", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 4))


def source_profile(words: DataFrame) -> DataFrame:
    """(source, n, n_words): occurrences and distinct words of each source."""
    each = words.groupBy("source", "word").agg(F.count("*").alias("n"))
    return each.groupBy("source").agg(F.sum("n").alias("n"), F.count("*").alias("n_words"))


def overlap_histogram(words: DataFrame) -> DataFrame:
    """(n_sources, n_words): how many words occur in so many sources."""
    return word_sources(words).groupBy("n_sources").agg(F.count("*").alias("n_words"))


def import_wordlist(lines: DataFrame, default: int = 200) -> DataFrame:
    """(word, freq, first_line) of `word [f=]N` lines (line_no, value): the greatest clamped frequency of each word."""
    x = text.strip(F.col("value"))
    parts = text.tokens(x)
    number = F.regexp_replace(F.try_element_at(parts, F.lit(2)), "^f=", "")
    rows = lines.where((x != "") & ~x.startswith("#")).select(parts[0].alias("word"), text.clamp(text.whole_number(number, default)).alias("f"), "line_no")
    return rows.groupBy("word").agg(F.max("f").alias("freq"), F.min("line_no").alias("first_line"))
