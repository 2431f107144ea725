"""The minimal acyclic automaton of a vocabulary in set form: states by level-wise hashing, ordinals of transitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ordinals, staging


def prefixes(words: DataFrame) -> DataFrame:
    """(prefix, n) with its hex bytes: every prefix of every word, the empty one included."""
    coded = words.select(F.hex(F.encode("word", "UTF-8")).alias("h")).distinct()
    return coded.select(F.explode(F.expr("transform(sequence(0, length(h) div 2), n -> substring(h, 1, 2 * n))")).alias("prefix"), "h")


def states(words: DataFrame) -> DataFrame:
    """(prefix, state): the minimal state that each prefix leads to; equal states have equal hashes.

    Bottom-up by length: a state is the hash of its sorted (byte, final, next state) edges, so no task ever holds the
    suffixes of the root. One grouping per level; the number of levels is the longest word's bytes.
    """
    all_prefixes = prefixes(words).select("prefix", (F.col("prefix") == F.col("h")).alias("word")).groupBy("prefix").agg(F.max("word").alias("word"))
    all_prefixes = staging.staged(all_prefixes.withColumn("n", (F.length("prefix") / 2).cast("int")))
    longest = all_prefixes.agg(F.max("n")).collect()[0][0] or 0
    done, below = None, None
    for n in range(longest, -1, -1):
        level = all_prefixes.where(F.col("n") == n)
        if below is not None:
            edges = below.select(F.expr("substring(prefix, 1, length(prefix) - 2)").alias("_p"), F.struct(F.expr("right(prefix, 2)").alias("b"), "word", "state").alias("e"))
            level = level.join(edges.groupBy("_p").agg(F.md5(F.to_json(F.array_sort(F.collect_list("e")))).alias("state"), F.count("*").alias("n_edges")), level["prefix"] == F.col("_p"), "left").drop("_p")
            level = level.select("prefix", "word", F.coalesce("state", F.lit("")).alias("state"), F.coalesce("n_edges", F.lit(0)).cast("long").alias("n_edges"))
        else:
            level = level.select("prefix", "word", F.lit("").alias("state"), F.lit(0).cast("long").alias("n_edges"))
        level = staging.staged(level)
        done, below = (level if done is None else done.unionByName(level)), level
    return done


def state_counts(words: DataFrame) -> DataFrame:
    """(n_nodes, n_states, n_transitions) of the trie and the minimal automaton."""
    each = states(words).groupBy("state").agg(F.count("*").alias("k"), F.max("n_edges").alias("n_edges"))
    return each.agg(F.sum("k").alias("n_nodes"), F.count("*").alias("n_states"), F.sum("n_edges").alias("n_transitions"))


def transition_numbers(words: DataFrame) -> DataFrame:
    """(prefix, number) of each non-empty prefix (hex): how many words its siblings before it hold, the ordinal step of its edge."""
    placed = ordinals.word_order(words.select("word").distinct())
    each = placed.select(F.hex(F.encode("word", "UTF-8")).alias("h"), "idx").select(F.explode(F.expr("transform(sequence(0, length(h) div 2), n -> substring(h, 1, 2 * n))")).alias("prefix"), "h", "idx")
    first = each.groupBy("prefix").agg(F.min("idx").alias("first"), F.max((F.col("prefix") == F.col("h")).cast("int")).alias("word"))
    up = first.select(F.col("prefix").alias("_p"), (F.col("first") + F.col("word")).alias("_first"))
    child = first.where("prefix <> ''").withColumn("_parent", F.expr("substring(prefix, 1, length(prefix) - 2)"))
    return child.join(up, F.col("_parent") == F.col("_p")).select("prefix", (F.col("first") - F.col("_first")).alias("number"))
