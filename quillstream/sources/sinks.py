"""Ordered text sinks and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_ordered(df: DataFrame, line: Column, order: list[Column], header: str, path: str, single: bool = True) -> None:
    """Text lines in order below a header: in one file, sorted by the one task that writes it, or in range-sorted files."""
    keys = [k.alias(f"k{i}") for i, k in enumerate(order)]
    body = df.select(F.lit(1).alias("part"), *keys, line.alias("value"))
    head = df.sparkSession.range(1).select(F.lit(0).alias("part"), *[F.lit(None).cast(t).alias(n) for n, t in body.dtypes[1:-1]], F.lit(header).alias("value"))
    whole, names = head.union(body), ["part", *(f"k{i}" for i in range(len(order)))]
    placed = whole.repartition(1).sortWithinPartitions(*names) if single else whole.orderBy(*names)
    placed.select("value").write.mode("overwrite").text(path)


def write_lexicon(lexicon: DataFrame, path: str, single: bool = True) -> None:
    """`word=W,f=N` lines, the most frequent first, ties in byte order."""
    header = "dictionary=main:bn,description=Lexicon,locale=bn,date=1700000000,version=1"
    write_ordered(lexicon, F.concat(F.lit("word="), "word", F.lit(",f="), F.col("freq").cast("string")), [-F.col("freq"), F.col("word")], header, path, single)


def write_imported(words: DataFrame, path: str, single: bool = True) -> None:
    """As `write_lexicon`, ties in order of first appearance (word, freq, first_line)."""
    header = "dictionary=main:bn,description=Imported Wordlist,locale=bn,date=1700000000,version=1"
    write_ordered(words, F.concat(F.lit("word="), "word", F.lit(",f="), F.col("freq").cast("string")), [-F.col("freq"), F.col("first_line")], header, path, single)


def write_transitions(lists: DataFrame, path: str, header: str = "# antecedent<TAB>successors", single: bool = True) -> None:
    """`w1<TAB>s1,s2,...` lines in byte order of (w1, succs)."""
    write_ordered(lists, F.concat("w1", F.lit("\t"), F.array_join("succs", ",")), [F.col("w1")], header, path, single)
