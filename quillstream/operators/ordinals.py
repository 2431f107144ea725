"""Order-preserving ordinals, running sums and quantisation without a single-partition window over the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import staging


#: Ranges into which rows are dealt for an order over all of them, and sampled keys for each.
BUCKETS, SAMPLED = 64, 32


def range_bounds(df: DataFrame, key: str, buckets: int) -> list:
    """Bounds of ranges of about equal numbers of rows, from a sample of about SAMPLED * buckets keys, chosen by their hash."""
    share = max(1, df.count() // (SAMPLED * buckets))
    sample = [r[0] for r in df.where(F.pmod(F.xxhash64(key), F.lit(share)) == 0).select(key).where(F.col(key).isNotNull()).distinct().collect()]
    sample.sort(key=lambda x: x.encode() if isinstance(x, str) else x)
    return sample[SAMPLED::SAMPLED]


def _bucketed(df: DataFrame, key: str, value: Column, out: str, buckets: int) -> DataFrame:
    """Adds `out`, the sum of `value` over all rows with a smaller key.

    Rows are dealt into ranges of the key. Ranges are summed with map-side combining, only the table of ranges (at most
    `buckets` rows) is summed along in one task, and rows are ordered within their own range.
    """
    rows = staging.staged(df.withColumn("_v", value))
    bounds = F.array(*[F.lit(x) for x in range_bounds(rows, key, buckets)]).cast(f"array<{dict(rows.dtypes)[key]}>")
    rows = rows.withColumn("_b", F.size(F.filter(bounds, lambda x: x <= F.col(key))))
    sums = rows.groupBy("_b").agg(F.sum("_v").alias("_s"))
    offsets = sums.select(F.col("_b").alias("_ob"), (F.sum("_s").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_s")).alias("_base"))
    local = F.sum("_v").over(Window.partitionBy("_b").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_v")
    placed = rows.withColumn("_l", local).join(F.broadcast(offsets), F.col("_b") == F.col("_ob"))
    return placed.withColumn(out, (F.col("_l") + F.col("_base")).cast("long")).drop("_b", "_v", "_l", "_ob", "_base")


def word_order(words: DataFrame, word: str = "word", out: str = "idx", buckets: int = BUCKETS) -> DataFrame:
    """Adds the 0-based ordinal of each distinct word in UTF-8 byte order."""
    return _bucketed(words, word, F.lit(1), out, buckets)


def dense_order(df: DataFrame, key: str, out: str = "idx", buckets: int = BUCKETS) -> DataFrame:
    """Adds the 0-based ordinal by a unique long key."""
    return _bucketed(df, key, F.lit(1), out, buckets)


def running_offset(df: DataFrame, key: str, value: Column, out: str = "offset", buckets: int = BUCKETS) -> DataFrame:
    """Adds the sum of `value` over all rows with a smaller unique long key."""
    return _bucketed(df, key, value, out, buckets)


def quantise(df: DataFrame, freq: str = "freq", levels: int = 16, out: str = "code") -> DataFrame:
    """Adds the equal-population bucket of each frequency; ties share the bucket of their first member.

    Ranks come from the table of distinct frequencies, so the data is only grouped, never ordered as a whole.
    """
    each = df.groupBy(F.col(freq).alias("_f")).agg(F.count("*").alias("_n"))
    along = Window.orderBy("_f").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.orderBy("_f").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = each.withColumns({"_before": F.sum("_n").over(along) - F.col("_n"), "_all": F.sum("_n").over(whole)})
    code = F.least(F.lit(levels - 1), F.floor(F.col("_before") / F.greatest(F.lit(1), F.floor(F.col("_all") / levels))))
    return df.join(ranked.select("_f", code.cast("int").alias(out)), F.col(freq).eqNullSafe(F.col("_f"))).drop("_f")


def word_at(ordinals: DataFrame, wanted: DataFrame) -> DataFrame:
    """(idx, word) of the wanted ordinals."""
    return wanted.select("idx").join(ordinals.select("idx", "word"), "idx")


#: Codes of the integer widths of 4, 8, 16 and 24 bits.
WIDTHS = {4: 1, 8: 2, 16: 4, 24: 6}


def int_width(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, bits): the narrowest width for a group's integers; null if 24 bits are too few."""
    low, high = F.min(value), F.max(value)
    reach = F.when(low < 0, F.greatest(-low - 1, high)).otherwise(high)
    bits = F.lit(None).cast("int")
    for w in (24, 16, 8, 4):
        limit = F.when(low < 0, F.lit((1 << (w - 1)) - 1)).otherwise(F.lit((1 << w) - 1))
        bits = F.when(reach <= limit, F.lit(w)).otherwise(bits)
    return df.groupBy(group).agg(bits.alias("bits"))
