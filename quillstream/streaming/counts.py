"""Extension: next-word pair counts kept up to date over a stream of text blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import transitions


def pair_counts(stream: DataFrame, words: Column) -> DataFrame:
    """(w1, w2, cnt) of a stream of (block_id, ...) blocks, for the update or complete mode."""
    rows = transitions.corpus_pairs(stream, words)
    return rows.groupBy("w1", "w2").agg(F.sum("cnt").alias("cnt"))


def windowed_pair_counts(stream: DataFrame, words: Column, time: str, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """(window, w1, w2, cnt) by event time; state older than the watermark is dropped."""
    pairs = F.flatten(F.filter(F.transform(words, transitions.text.adjacent_pairs), lambda p: p.isNotNull()))
    rows = stream.withWatermark(time, late).select(time, F.explode(pairs).alias("p"))
    return rows.groupBy(F.window(time, width), "p.w1", "p.w2").agg(F.count("*").alias("cnt"))
