"""Shortcut expansion, alias resolution and vocabulary lookups, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ordinals, staging


def expand(entries: DataFrame) -> DataFrame:
    """(word, freq, shortcuts): entries and, behind each, its shortcuts with frequency 1; the first of equal words stays."""
    own = entries.select("word", "freq", "shortcuts", F.struct(F.col("pos"), F.lit(0).alias("k")).alias("at"))
    extra = entries.select(F.posexplode("shortcuts").alias("i", "word"), "pos").select("word", F.lit(1).alias("freq"), F.array().cast("array<string>").alias("shortcuts"), F.struct(F.col("pos"), (F.col("i") + 1).alias("k")).alias("at"))
    return own.unionByName(extra).groupBy("word").agg(F.min_by(F.struct("freq", "shortcuts"), "at").alias("e")).select("word", "e.freq", "e.shortcuts")


def resolve(vocabulary: DataFrame) -> DataFrame:
    """(key_idx, target_idx) of (word, idx, shortcuts): each word's first shortcut, followed while it has one itself.

    Each round doubles the hops, so chains of any length end; what is still open after as many hops as there are words runs
    into a cycle and is left out.
    """
    first = staging.staged(vocabulary.where(F.size("shortcuts") > 0).select("word", F.col("shortcuts")[0].alias("target")))
    hops = first
    for _ in range(first.count().bit_length()):
        if not hops.join(first.select(F.col("word").alias("target")), "target", "left_semi").limit(1).count():
            break
        on = hops.select(F.col("word").alias("_w"), F.col("target").alias("_t"))
        hops = staging.staged(hops.join(on, F.col("target") == F.col("_w"), "left").select("word", F.coalesce("_t", "target").alias("target")))
    ended = hops.join(first.select(F.col("word").alias("target")), "target", "left_anti")
    key = vocabulary.select("word", F.col("idx").alias("key_idx"))
    goal = vocabulary.select(F.col("word").alias("target"), F.col("idx").alias("target_idx"))
    return ended.join(key, "word").join(goal, "target").select("key_idx", "target_idx")


def build(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(word, idx, freq, code, shortcuts) and the aliases of dictionary entries."""
    vocabulary = staging.staged(ordinals.quantise(ordinals.word_order(expand(entries))))
    return vocabulary, resolve(vocabulary)


def lookup(vocabulary: DataFrame, aliases: DataFrame, probes: DataFrame) -> DataFrame:
    """(word, found, idx, target) of probe words (word): the alias target's word, or the word itself."""
    known = vocabulary.select(F.col("word").alias("_w"), "idx")
    hit = probes.select("word").join(known, F.col("word") == F.col("_w"), "left")
    aimed = hit.join(aliases, hit["idx"] == aliases["key_idx"], "left").withColumn("_goal", F.coalesce("target_idx", "idx"))
    names = vocabulary.select(F.col("idx").alias("_i"), F.col("word").alias("target"))
    return aimed.join(names, aimed["_goal"] == names["_i"], "left").select("word", F.col("idx").isNotNull().alias("found"), "idx", "target")


def complete(lexicon: DataFrame, prefixes: DataFrame, top: int = 5) -> DataFrame:
    """(prefix, rk, word): an extension, the most frequent words with a prefix; joins on the prefix itself."""
    from pyspark.sql import Window

    lengths = [r["n"] for r in prefixes.select(F.length("prefix").alias("n")).distinct().collect()]
    each = lexicon.select("word", "freq", F.explode(F.array(*[F.lit(n) for n in sorted(lengths)])).alias("n")).where("length(word) >= n")
    cut = each.select(F.expr("substring(word, 1, n)").alias("prefix"), "word", "freq").join(prefixes.select("prefix").distinct(), "prefix")
    r = F.row_number().over(Window.partitionBy("prefix").orderBy(F.desc("freq"), "word"))
    return cut.withColumn("rk", r).where(f"rk <= {top}").select("prefix", "rk", "word")
